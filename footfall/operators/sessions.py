"""Sessions and what they add up to."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from footfall.functions.columns import hour_stamp
from footfall.plans.joins import left_join
from footfall.plans.scan import fresh, running_total

HALF_HOUR_MS = 30 * 60 * 1000
_LAST = ["location", "devicetype", "osname", "releasechannel"]


def _numbered_slices(slices: DataFrame, key: str, gap_ms: int) -> DataFrame:
    """Add ``_n``, the number of long gaps before each slice of the key."""
    by_key = Window.partitionBy(key).orderBy("_slice")
    pause = F.col("_lo") - F.lag("_hi").over(by_key)
    return slices.withColumn("_cut", F.when(pause > gap_ms, 1).otherwise(0)).withColumn(
        "_n", F.sum("_cut").over(by_key.rowsBetween(Window.unboundedPreceding, 0))
    )


def _slice(ts: str, gap_ms: int) -> Column:
    # Two events of one slice are never more than the gap apart, so a session can only end
    # between slices and a slice's first and last time say all there is to know about it.
    return F.floor(F.col(ts) / F.lit(gap_ms)).cast("long")


def sessionize(
    df: DataFrame, key: str = "sessionid", ts: str = "timestamp", gap_ms: int = HALF_HOUR_MS, out: str = "newsessionid"
) -> DataFrame:
    """Split sessions at pauses longer than ``gap_ms``; the new id is ``key_n`` with n from 0.

    An event without a key or a time belongs to no session and has no id.

    Events collapse to one row per (key, slice) before any ordering, so a key with a huge number
    of events costs one window row per half hour; the events themselves are joined back by slice.
    """
    at, number = fresh(df.columns, "_slice"), fresh(df.columns, "_n")
    slim = df.select(F.col(key).alias("_key"), _slice(ts, gap_ms).alias("_slice"), F.col(ts).alias("_ms"))
    slices = slim.groupBy("_key", "_slice").agg(F.min("_ms").alias("_lo"), F.max("_ms").alias("_hi"))
    numbers = _numbered_slices(slices, "_key", gap_ms).select("_key", "_slice", F.col("_n").alias(number))
    marked = df.withColumn(at, _slice(ts, gap_ms))
    return (
        left_join(marked, numbers, {key: "_key", at: "_slice"})
        .withColumn(out, F.concat(F.col(key).cast("string"), F.lit("_"), F.col(number).cast("string")))
        .drop(at, number)
    )


def _session_measures(ts: str, event_id: str, page: str) -> list[Column]:
    at = F.struct(ts, event_id)
    paged = F.when(F.col(page).isNotNull(), at)
    return [
        F.min(ts).alias("start_time"),
        F.max(ts).alias("end_time"),
        F.min(F.when(F.col(page).isNotNull(), F.struct(ts, event_id, page))).alias("_first"),
        F.max(F.when(F.col(page).isNotNull(), F.struct(ts, event_id, page))).alias("_final"),
        F.count(paged).alias("pv_cnt"),
        F.min(hour_stamp(ts)).alias("hour_range"),
    ]


def session_agg(
    df: DataFrame, session: str = "newsessionid", ts: str = "timestamp", event_id: str = "event_id", page: str = "page",
    isnew: str = "newflag", hours: bool = False,
) -> DataFrame:
    """One row per session: times, start and end page, page views, first hour, dimensions of the last event.

    Events without a page do not count as views. Only partial aggregates are shuffled. ``hours`` adds ``hour_set``, the
    sorted hour stamps the session touches: at most one per hour it lasts, however many events it has.
    """
    dims = ["guid", isnew, *[c for c in _LAST if c in df.columns]]
    last = F.max(F.struct(ts, event_id, *dims)).alias("_last")
    touched = [F.sort_array(F.collect_set(hour_stamp(ts))).alias("hour_set")] if hours else []
    grouped = df.groupBy(session).agg(*_session_measures(ts, event_id, page), last, *touched)
    return _session_row(grouped, session, dims, page, isnew, ["hour_set"] if hours else [])


def _session_row(grouped: DataFrame, session: str, dims: list[str], page: str, isnew: str, more: Sequence[str] = ()) -> DataFrame:
    names = {isnew: "isnew", "devicetype": "device_type", "osname": "os_name", "releasechannel": "release_ch"}
    return grouped.select(
        F.col(session).alias("session_id"),
        "start_time",
        "end_time",
        F.col(f"_first.{page}").alias("start_page"),
        F.col(f"_final.{page}").alias("end_page"),
        "pv_cnt",
        "hour_range",
        *[F.col(f"_last.{c}").alias(names.get(c, c)) for c in dims],
        *more,
    )


def sessions_from_events(
    df: DataFrame, key: str = "sessionid", ts: str = "timestamp", event_id: str = "event_id", page: str = "page",
    isnew: str = "newflag", gap_ms: int = HALF_HOUR_MS,
) -> DataFrame:
    """``session_agg(sessionize(df))`` without ever shuffling an event.

    Events fold into (key, slice) partial sessions map-side, slices are numbered per key, and the
    partial sessions fold again into sessions.
    """
    dims = ["guid", isnew, *[c for c in _LAST if c in df.columns]]
    slices = (
        df.withColumn("_slice", _slice(ts, gap_ms))
        .groupBy(key, "_slice")
        .agg(
            *_session_measures(ts, event_id, page),
            F.max(F.struct(ts, event_id, *dims)).alias("_last"),
        )
        .withColumns({"_lo": F.col("start_time"), "_hi": F.col("end_time")})
    )
    grouped = (
        _numbered_slices(slices, key, gap_ms)
        .groupBy(key, "_n")
        .agg(
            F.min("start_time").alias("start_time"),
            F.max("end_time").alias("end_time"),
            F.min("_first").alias("_first"),
            F.max("_final").alias("_final"),
            F.sum("pv_cnt").alias("pv_cnt"),
            F.min("hour_range").alias("hour_range"),
            F.max("_last").alias("_last"),
        )
        .withColumn("newsessionid", F.concat(F.col(key).cast("string"), F.lit("_"), F.col("_n").cast("string")))
    )
    return _session_row(grouped, "newsessionid", dims, page, isnew)


def session_hours(df: DataFrame, session: str = "newsessionid", ts: str = "timestamp") -> DataFrame:
    """The set of hours a session touches, one row per (session, hour)."""
    return df.select(F.col(session).alias("session_id"), hour_stamp(ts).alias("hour_stamp")).distinct()


def session_pages(
    df: DataFrame, session: str = "newsessionid", ts: str = "timestamp", event_id: str = "event_id",
    page: str = "page", chunk: int = 1000, parts: int | None = None,
) -> DataFrame:
    """The ordered page list of a session, in chunks of at most ``chunk`` pages.

    Nearly every session is one chunk; a session of any length keeps its whole list without a task
    ever holding more than one chunk of it. ``parts`` is the number of ranges the views are cut into.
    """
    views = df.where(F.col(page).isNotNull()).select(session, ts, event_id, page)
    placed = running_total(views, [session], [ts, event_id], F.lit(1), "_pos", parts=parts)
    return (
        placed.withColumn("chunk", F.floor((F.col("_pos") - 1) / F.lit(chunk)).cast("long"))
        .groupBy(F.col(session).alias("session_id"), "chunk")
        .agg(F.sort_array(F.collect_list(F.struct("_pos", page))).alias("_pages"))
        .select("session_id", "chunk", F.col(f"_pages.{page}").alias("page_list"))
    )


USER_DIMS = ["location", "hour_range", "device_type", "os_name", "start_page", "end_page", "isnew"]


def user_traffic(sessions: DataFrame, dims: list[str] | None = None) -> DataFrame:
    """Per user and dimensions: sessions, time, bounces (fewer than two views) and views."""
    dims = USER_DIMS if dims is None else dims
    return sessions.groupBy("guid", *dims).agg(
        F.count("session_id").alias("session_cnt"),
        F.sum(F.col("end_time") - F.col("start_time")).alias("time_long"),
        F.count_if(F.col("pv_cnt") < 2).alias("jumpout_cnt"),
        F.sum("pv_cnt").alias("pv_cnt"),
    )
