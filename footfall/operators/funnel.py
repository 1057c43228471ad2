"""How far users get along a business path."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from footfall.plans.scan import by_part, fresh, in_order


def furthest_step(
    events: DataFrame, steps: Sequence[str], by: Sequence[str], event: str = "eventid", ts: str = "timestamp",
    event_id: str = "event_id", parts: int | None = None,
) -> DataFrame:
    """(by..., furthest): how many of the steps each journey completes in order.

    Step events are cut into ranges by (journey, time, event id). The part of a journey in one range is summed up by
    where it takes a journey that enters it with 0, 1, ... steps done; matching each step as early as possible finds
    that out. These step functions compose, one short row per journey and range. Events equal in time and id
    cannot both be steps of a journey. ``parts`` is the number of ranges.
    """
    by, k = list(by), len(steps)
    part = fresh(by, "_part")
    path = events.where(F.col(event).isin(*set(steps))).select(
        *by, F.col(event).alias("_step"), F.struct(F.col(ts).alias("t"), F.col(event_id).alias("i")).alias("_at")
    )
    cell = [part, *by]
    path = by_part(in_order(path, by, ["_at"], part, parts), part, parts)
    in_cell = Window.partitionBy(*cell)
    # _m{s}_{j}: earliest time step j is done within the range by a journey entering with s done.
    for j in range(1, k + 1):
        here = F.col("_step") == steps[j - 1]
        earliest = {}
        for s in range(j):
            cond = here if s == j - 1 else here & (F.col("_at") > F.col(f"_m{s}_{j - 1}"))
            earliest[f"_m{s}_{j}"] = F.min(F.when(cond, F.col("_at"))).over(in_cell)
        path = path.withColumns(earliest)
    leaves_with = F.array(
        *[
            sum((F.col(f"_m{s}_{j}").isNotNull().cast("int") for j in range(s + 1, k + 1)), F.lit(s))
            for s in range(k)
        ],
        F.lit(k),
    )
    moves = path.groupBy(*cell).agg(F.max(leaves_with).alias("_move"))
    # A journey has at most one row per range.
    return moves.groupBy(*by).agg(
        F.aggregate(
            F.sort_array(F.collect_list(F.struct(part, "_move"))),
            F.lit(0),
            lambda done, x: F.element_at(x["_move"], done + 1),
        )
        .cast("long")
        .alias("furthest")
    )


def funnel(
    events: DataFrame, steps: Sequence[str], by: Sequence[str], event: str = "eventid", ts: str = "timestamp",
    event_id: str = "event_id", parts: int | None = None,
) -> DataFrame:
    """Journeys per step reached: (step_no, step, reached), one row per step."""
    done = furthest_step(events, steps, by, event, ts, event_id, parts)
    counts = done.agg(*[F.count_if(F.col("furthest") >= i).alias(f"_r{i}") for i in range(1, len(steps) + 1)])
    rows = F.array(
        *[
            F.struct(F.lit(i).cast("long").alias("step_no"), F.lit(s).alias("step"), F.col(f"_r{i}").alias("reached"))
            for i, s in enumerate(steps, 1)
        ]
    )
    return counts.select(F.inline(rows))
