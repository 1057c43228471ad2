"""Which events earn the credit for a target event."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from footfall.plans.scan import running_total

MODELS = ("first", "last", "linear", "position", "time")


def keep_journeys(events: DataFrame, cands: Sequence[str], target: str, guid: str = "guid", event: str = "eventid") -> DataFrame:
    """Candidate and target events of the users who have a target event at all."""
    chosen = events.where(F.col(event).isin(*cands, target))
    converted = chosen.where(F.col(event) == target).select(guid).distinct()
    return chosen.join(converted, guid, "left_semi")


def segments(
    events: DataFrame, target: str, cands: Sequence[str], guid: str = "guid", event: str = "eventid",
    ts: str = "ts", event_id: str | None = None, parts: int | None = None,
) -> DataFrame:
    """Candidates per conversion: (guid, segment, event, first_at, last_at, touches).

    Every target event ends a segment; candidates after the last target belong to none. The result
    has one row per distinct candidate of a segment, so it is as narrow as the candidate list. Without
    ``event_id`` events of one time follow by name. ``parts`` is the number of ranges the events are cut into.
    """
    order = [F.col(ts).alias("t"), F.col(event_id or event).alias("i")]
    rows = events.where(F.col(event).isin(*cands, target)).select(
        F.col(guid).alias("guid"), F.col(event).alias("event"), F.struct(*order).alias("at")
    )
    is_target = F.when(F.col("event") == target, 1).otherwise(0)
    placed = running_total(rows, ["guid"], ["at"], is_target, "segment", "_targets", parts)
    return (
        placed.where((F.col("event") != target) & (F.col("segment") < F.col("_targets")))
        .groupBy("guid", "segment", "event")
        .agg(F.min("at").alias("first_at"), F.max("at").alias("last_at"), F.count(F.lit(1)).alias("touches"))
    )


def _ranked(seg: DataFrame) -> DataFrame:
    """Add rank by first touch, size of the segment, and the latest touch of the segment."""
    whole = Window.partitionBy("guid", "segment")
    return seg.withColumns(
        {
            "_rn": F.row_number().over(whole.orderBy("first_at", "event")),
            "_n": F.count(F.lit(1)).over(whole),
            "_latest": F.max("last_at").over(whole),
        }
    )


def _weights(factor: float, edge: float, newest_first: bool) -> dict[str, Column]:
    rn, n = F.col("_rn"), F.col("_n")
    middle = (1.0 - 2.0 * edge) * 100.0
    power = (n - rn) if newest_first else (rn - 1)
    norm = (F.lit(1.0) - F.pow(F.lit(factor), n)) / F.lit(1.0 - factor) if factor != 1.0 else n.cast("double")
    return {
        "first": F.when(rn == 1, F.lit(100.0)),
        "last": F.when(F.col("last_at") == F.col("_latest"), F.lit(100.0)),
        "linear": F.lit(100.0) / n,
        "position": F.when(n == 1, F.lit(100.0))
        .when(n == 2, F.lit(50.0))
        .when((rn == 1) | (rn == n), F.lit(edge * 100.0))
        .otherwise(F.lit(middle) / (n - 2)),
        "time": F.pow(F.lit(factor), power) * 100.0 / norm,
    }


def attribution(
    seg: DataFrame, target: str, models: Sequence[str] = MODELS, factor: float = 0.9, edge: float = 0.4,
    newest_first: bool = False, digits: int = 2,
) -> DataFrame:
    """(model, target, guid, segment, event, weight) for every model asked for, in one pass.

    The time model gives the earliest candidate the greatest weight; ``newest_first`` turns that round.
    """
    weights = _weights(factor, edge, newest_first)
    listed = F.array(
        *[F.struct(F.lit(m).alias("model"), F.round(weights[m], digits).alias("weight")) for m in models]
    )
    return (
        _ranked(seg)
        .select("guid", "segment", "event", F.inline(listed))
        .where(F.col("weight").isNotNull())
        .select("model", F.lit(target).alias("target"), "guid", "segment", "event", "weight")
    )


def first_touch(seg: DataFrame, target: str) -> DataFrame:
    return attribution(seg, target, ["first"])


def last_touch(seg: DataFrame, target: str) -> DataFrame:
    return attribution(seg, target, ["last"])


def linear(seg: DataFrame, target: str) -> DataFrame:
    return attribution(seg, target, ["linear"])


def position(seg: DataFrame, target: str, edge: float = 0.4) -> DataFrame:
    return attribution(seg, target, ["position"], edge=edge)


def time_decay(seg: DataFrame, target: str, factor: float = 0.9, newest_first: bool = False) -> DataFrame:
    return attribution(seg, target, ["time"], factor=factor, newest_first=newest_first)
