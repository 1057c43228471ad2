"""Activity over days: active ranges, one bit per day, retention, streaks and silence."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from footfall.functions.columns import OPEN_END

WINDOW_DAYS = 30


def _day(day: str) -> Column:
    return F.lit(day).cast("date")


def _open() -> Column:
    return F.lit(OPEN_END).cast("date")


def ranges_from_days(active: DataFrame, day: str) -> DataFrame:
    """Active ranges as of ``day`` straight from (guid, dt) rows: the back-fill of ``roll_ranges``.

    A user has at most one row per day after the distinct, which bounds the window.
    """
    days = active.select("guid", F.col("dt").cast("date").alias("dt")).where(F.col("dt") <= _day(day)).distinct()
    by_user = Window.partitionBy("guid").orderBy("dt")
    islands = days.withColumns(
        {
            "_island": F.date_sub("dt", F.row_number().over(by_user)),
            "first_dt": F.min("dt").over(Window.partitionBy("guid")),
        }
    )
    return (
        islands.groupBy("guid", "first_dt", "_island")
        .agg(F.min("dt").alias("range_start"), F.max("dt").alias("_last"))
        .select(
            "first_dt", "guid", "range_start",
            F.when(F.col("_last") == _day(day), _open()).otherwise(F.col("_last")).alias("range_end"),
        )
    )


def roll_ranges(prev: DataFrame, active: DataFrame, day: str) -> DataFrame:
    """Ranges of ``day`` from those of the day before and today's users.

    Open and active: unchanged. Open and not active: ends the day before. New user: a new open range.
    Returning user without an open range: one more open range. Closed ranges pass through unchanged;
    what has to be decided per user comes from one grouping with map-side combine.
    """
    is_open = F.col("range_end") == _open()
    seen = prev.select(
        "guid",
        "first_dt",
        F.when(is_open, F.col("range_start")).alias("_open_start"),
        F.lit(False).alias("_today"),
    )
    today = active.select(
        "guid",
        F.lit(None).cast("date").alias("first_dt"),
        F.lit(None).cast("date").alias("_open_start"),
        F.lit(True).alias("_today"),
    )
    user = (
        seen.unionByName(today)
        .groupBy("guid")
        .agg(F.min("first_dt").alias("first_dt"), F.max("_open_start").alias("_open_start"), F.max("_today").alias("_today"))
        .where(F.col("_today") | F.col("_open_start").isNotNull())
    )
    current = user.select(
        F.coalesce("first_dt", _day(day)).alias("first_dt"),
        "guid",
        F.coalesce("_open_start", _day(day)).alias("range_start"),
        F.when(F.col("_today"), _open()).otherwise(F.date_sub(_day(day), 1)).alias("range_end"),
    )
    return prev.where(~is_open).select(*current.columns).unionByName(current)


def first_days(active: DataFrame) -> DataFrame:
    """(guid, first_dt) out of the rows written when users first came; a day that was run again may hold some twice."""
    return active.groupBy("guid").agg(F.min("first_dt").alias("first_dt"))


def step_ranges(opened: DataFrame, known: DataFrame, active: DataFrame, day: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(closed, opened, first) of ``day``: the ranges that end the day before, those open now, and (guid, first_dt) of new users.

    ``opened`` are the open ranges of the day before, ``known`` the first days up to it. Users who are not active on either day
    need no row, so what is written follows the active users, not all ranges there ever were.
    """
    before = opened.select("guid", "first_dt", "range_start", F.lit(False).alias("_today"))
    today = active.select("guid", F.lit(True).alias("_today"))
    user = before.unionByName(today, allowMissingColumns=True).groupBy("guid").agg(
        F.min("first_dt").alias("first_dt"), F.min("range_start").alias("range_start"), F.max("_today").alias("_today")
    )
    closed = user.where(~F.col("_today")).select("first_dt", "guid", "range_start", F.date_sub(_day(day), 1).alias("range_end"))
    known = known.withColumnRenamed("first_dt", "_known")
    here = user.where("_today").select("guid", "range_start").join(known, "guid", "left")
    now = here.select(
        F.coalesce("_known", _day(day)).alias("first_dt"), "guid", F.coalesce("range_start", _day(day)).alias("range_start"), _open().alias("range_end")
    )
    return closed, now, here.where(F.col("_known").isNull()).select("guid", _day(day).alias("first_dt"))


def step_status(words: DataFrame, active: DataFrame, day: str, n: int = WINDOW_DAYS) -> DataFrame:
    """(guid, since, active_status) of the users of ``day``: their words, from the rows of the ``n`` days before."""
    age = F.datediff(_day(day), F.col("since"))
    old = words.where(age.between(1, n)).select("guid", _aged("active_status", age, n).alias("_word"))
    new = active.select("guid", F.lit(1).cast("long").alias("_word"), F.lit(True).alias("_today"))
    both = old.unionByName(new, allowMissingColumns=True).groupBy("guid").agg(F.bit_or("_word").alias("active_status"), F.max("_today").alias("_today"))
    return both.where(F.col("_today")).select("guid", _day(day).alias("since"), "active_status")


def _aged(word: str, days: Column, n: int) -> Column:
    """A word some days later: bits move up, and those past the window drop out."""
    return F.call_function("shiftleft", F.col(word), days).bitwiseAND(F.lit((1 << (n + 1)) - 1).cast("long"))


def status_on(words: DataFrame, known: DataFrame, day: str, n: int = WINDOW_DAYS) -> DataFrame:
    """(guid, first_dt, active_status) of every user who came up to ``day``, from the rows of its last ``n`` days.

    A later row holds what is left of the earlier ones, so the aged words may simply be merged.
    """
    age = F.datediff(_day(day), F.col("since"))
    recent = words.where(age.between(0, n)).groupBy("guid").agg(F.bit_or(_aged("active_status", age, n)).alias("active_status"))
    rows = known.where(F.col("first_dt") <= _day(day)).join(recent, "guid", "left")
    return rows.select("guid", "first_dt", F.coalesce("active_status", F.lit(0).cast("long")).alias("active_status"))


def init_status(active: DataFrame, day: str, n: int = WINDOW_DAYS) -> DataFrame:
    """Bit i of ``active_status`` says whether the user was active i days before ``day`` (0 to n)."""
    age = F.datediff(_day(day), F.col("dt").cast("date"))
    return (
        active.select("guid", F.col("dt").cast("date").alias("dt"))
        .where(F.col("dt").between(F.date_sub(_day(day), n), _day(day)))
        .groupBy("guid")
        .agg(F.min("dt").alias("first_dt"), F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), age)).alias("active_status"))
    )


def roll_status(prev: DataFrame, active: DataFrame, day: str, n: int = WINDOW_DAYS) -> DataFrame:
    """Shift every user's word by one day and set bit 0 for today's users; the oldest bit drops out."""
    old = prev.select("guid", "first_dt", "active_status", F.lit(0).cast("long").alias("_today"))
    new = active.select(
        "guid",
        F.lit(None).cast("date").alias("first_dt"),
        F.lit(None).cast("long").alias("active_status"),
        F.lit(1).cast("long").alias("_today"),
    )
    kept = F.coalesce(F.max("active_status"), F.lit(0).cast("long")).bitwiseAND(F.lit((1 << n) - 1).cast("long"))
    return (
        old.unionByName(new)
        .groupBy("guid")
        .agg(
            F.coalesce(F.min("first_dt"), _day(day)).alias("first_dt"),
            (kept * 2 + F.max("_today")).alias("active_status"),
        )
    )


def activity_string(status: DataFrame, n: int = WINDOW_DAYS + 1) -> DataFrame:
    """The last n days as text, oldest first, one 0 or 1 per day."""
    low = F.col("active_status").bitwiseAND(F.lit((1 << n) - 1).cast("long"))
    return status.select("guid", F.lpad(F.bin(low), n, "0").alias("activity"))


def _retention(rows: DataFrame, day: str, max_days: int) -> DataFrame:
    days = F.datediff(_day(day), F.col("first_dt")).cast("long")
    return (
        rows.where(days <= max_days)
        .groupBy(F.date_format(_day(day), "yyyy-MM-dd").alias("calc_dt"), "first_dt", days.alias("retention_days"))
        .agg(F.count(F.lit(1)).alias("retention_users"))
    )


def retention(ranges: DataFrame, day: str, max_days: int = 30) -> DataFrame:
    """Users active on ``day`` by the day they first came, from open ranges; ``max_days`` included."""
    return _retention(ranges.where(F.col("range_end") == _open()), day, max_days)


def retention_bits(status: DataFrame, day: str, max_days: int = 29) -> DataFrame:
    """The same from the status words: active today means the word is odd."""
    return _retention(status.where(F.col("active_status") % 2 == 1), day, max_days)


def retention_pivot(tall: DataFrame, days: Sequence[int]) -> DataFrame:
    """First day by day-N table from tall retention rows; ``dnu`` is day 0."""
    wide = tall.groupBy("first_dt").pivot("retention_days", list(days)).agg(F.sum("retention_users"))
    return wide.select("first_dt", *[F.col(str(d)).alias("dnu" if d == 0 else f"day_{d}") for d in days])


def retention_history(active: DataFrame, max_days: int = 30) -> DataFrame:
    """Tall retention rows of every day at once, from (guid, dt) rows."""
    days = active.select("guid", F.col("dt").cast("date").alias("dt")).distinct()
    first = days.groupBy("guid").agg(F.min("dt").alias("first_dt"))
    gap = F.datediff("dt", "first_dt").cast("long")
    return (
        days.join(first, "guid")
        .where(gap <= max_days)
        .groupBy(F.date_format("dt", "yyyy-MM-dd").alias("calc_dt"), "first_dt", gap.alias("retention_days"))
        .agg(F.count(F.lit(1)).alias("retention_users"))
    )


def active_lengths(ranges: DataFrame, day: str) -> DataFrame:
    """Ranges and users per range length (end minus start; an open range ends on ``day``)."""
    end = F.when(F.col("range_end") == _open(), _day(day)).otherwise(F.col("range_end"))
    return (
        ranges.groupBy(F.datediff(end, "range_start").cast("long").alias("active_days"))
        .agg(F.count(F.lit(1)).alias("ranges"), F.countDistinct("guid").alias("users"))
    )


def silent_lengths(ranges: DataFrame, day: str, last_days: int | None = None) -> DataFrame:
    """Pauses per length: start of the next range minus end of this one, per user.

    ``last_days`` keeps only pauses that end within that many days before ``day``. A user has at most
    one range per two days, which bounds the window.
    """
    by_user = Window.partitionBy("guid").orderBy("range_start")
    pauses = ranges.withColumn("_next", F.lead("range_start").over(by_user)).where(F.col("_next").isNotNull())
    if last_days is not None:
        pauses = pauses.where(F.col("_next") > F.date_sub(_day(day), last_days))
    return pauses.groupBy(F.datediff("_next", "range_end").cast("long").alias("silent_days")).agg(
        F.count(F.lit(1)).alias("pauses"), F.countDistinct("guid").alias("users")
    )


def active_every_day(status: DataFrame, day: str, start: str, end: str) -> DataFrame:
    """Users active on every day from ``start`` to ``end``, by a mask on the status words of ``day``."""
    return status.where(F.col("active_status").bitwiseAND(_mask(day, start, end)) == _mask(day, start, end)).select("guid")


def silent_every_day(status: DataFrame, day: str, start: str, end: str) -> DataFrame:
    """Users active on none of the days from ``start`` to ``end``."""
    return status.where(F.col("active_status").bitwiseAND(_mask(day, start, end)) == 0).select("guid")


def _mask(day: str, start: str, end: str) -> Column:
    from datetime import date

    newest = (date.fromisoformat(day) - date.fromisoformat(end)).days
    oldest = (date.fromisoformat(day) - date.fromisoformat(start)).days
    if not 0 <= newest <= oldest <= 62:
        raise ValueError("the window must lie within the days a status word can hold")
    return F.lit(((1 << (oldest + 1)) - 1) ^ ((1 << newest) - 1)).cast("long")


def active_streak(ranges: DataFrame, start: str, end: str, n: int) -> DataFrame:
    """Users with at least ``n`` active days in a row between ``start`` and ``end``, and their longest run."""
    lo = F.greatest(F.col("range_start"), _day(start))
    hi = F.least(F.col("range_end"), _day(end))
    run = F.datediff(hi, lo) + 1
    return (
        ranges.where(run >= n).groupBy("guid").agg(F.max(run).cast("long").alias("longest_run"))
    )
