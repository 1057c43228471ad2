"""Activity, retention, streaks."""

from pyspark.sql import functions as F

from catalog.base import LAST_DAY, MID_DAY, Registry, active_days, sql, text
from footfall.operators import activity
from footfall.session import stored

QUERIES = Registry()
DAY_BEFORE = "2024-01-29"

DAYS = "days AS (SELECT DISTINCT user_id AS guid, CAST(ts AS DATE) AS dt FROM events)"


def ranges_sql(day: str, name: str = "ranges") -> str:
    return f"""{name} AS (SELECT first_dt, guid, min(dt) AS range_start,
      CASE WHEN max(dt) = DATE '{day}' THEN DATE '9999-12-31' ELSE max(dt) END AS range_end
    FROM (SELECT guid, dt, min(dt) OVER (PARTITION BY guid) AS first_dt,
            dt - CAST(row_number() OVER (PARTITION BY guid ORDER BY dt) AS INTEGER) AS island FROM days WHERE dt <= DATE '{day}')
    GROUP BY first_dt, guid, island)"""


def status_sql(day: str, n: int = 30, name: str = "status") -> str:
    return f"""{name} AS (SELECT guid, min(dt) AS first_dt, bit_or(1::BIGINT << date_diff('day', dt, DATE '{day}')) AS active_status
    FROM days WHERE dt BETWEEN DATE '{day}' - {n} AND DATE '{day}' GROUP BY guid)"""


def today(spark, sf, day=LAST_DAY):
    return active_days(spark, sf).where(F.col("dt") == F.lit(day).cast("date"))


def rolled_ranges(spark, sf):
    """Ranges of the last day, rolled from those of the day before."""
    before = activity.ranges_from_days(active_days(spark, sf), DAY_BEFORE)
    return activity.roll_ranges(before, today(spark, sf), LAST_DAY)


def rolled_status(spark, sf, n=30):
    before = activity.init_status(active_days(spark, sf), DAY_BEFORE, n)
    return activity.roll_status(before, today(spark, sf), LAST_DAY, n)


def dated(df, *cols):
    return df.withColumns({c: text(c) for c in cols})


RANGE_ROWS = """SELECT CAST(first_dt AS VARCHAR) AS first_dt, guid, CAST(range_start AS VARCHAR) AS range_start,
  CAST(range_end AS VARCHAR) AS range_end FROM ranges"""


@QUERIES.add("active_ranges", sql([DAYS, ranges_sql(LAST_DAY)], RANGE_ROWS))
def ranges(spark, sf):
    return dated(activity.ranges_from_days(active_days(spark, sf), LAST_DAY), "first_dt", "range_start", "range_end")


@QUERIES.add("active_range_roll", sql([DAYS, ranges_sql(LAST_DAY)], RANGE_ROWS))
def range_roll(spark, sf):
    return dated(rolled_ranges(spark, sf), "first_dt", "range_start", "range_end")


STEP_DAYS = ["2024-01-27", "2024-01-28", "2024-01-29", LAST_DAY]


@QUERIES.add("active_range_steps", sql([DAYS, ranges_sql(LAST_DAY)], RANGE_ROWS))
def range_steps(spark, sf):
    """Four days in steps that write only what changes, after a start from all days before."""
    days = active_days(spark, sf)
    rows = stored(activity.ranges_from_days(days, "2024-01-26"), "ranges")
    is_open = F.col("range_end") == F.lit("9999-12-31").cast("date")
    closed, opened = [rows.where(~is_open)], rows.where(is_open)
    known = rows.groupBy("guid").agg(F.min("first_dt").alias("first_dt"))
    for day in STEP_DAYS:
        steps = activity.step_ranges(opened, activity.first_days(known), today(spark, sf, day), day)
        ended, opened, first = (stored(s, "step") for s in steps)
        closed.append(ended)
        known = known.unionByName(first)
    for ended in closed:
        opened = opened.unionByName(ended)
    return dated(opened, "first_dt", "range_start", "range_end")


@QUERIES.add(
    "active_bits_steps",
    sql([DAYS, status_sql(LAST_DAY), "firsts AS (SELECT guid, min(dt) AS first_dt FROM days GROUP BY guid)"],
        "SELECT guid, CAST(f.first_dt AS VARCHAR) AS first_dt, coalesce(active_status, 0) AS active_status FROM firsts f LEFT JOIN status USING (guid)"),
)
def bits_steps(spark, sf):
    """The same for the words: rows of active users only, aged when they are read."""
    days = active_days(spark, sf)
    start = activity.init_status(days, "2024-01-26").select("guid", F.lit("2024-01-26").cast("date").alias("since"), "active_status")
    words = stored(start, "words")
    for day in STEP_DAYS:
        words = words.unionByName(stored(activity.step_status(words, today(spark, sf, day), day), "step"))
    known = days.groupBy("guid").agg(F.min("dt").alias("first_dt"))
    return dated(activity.status_on(words, known, LAST_DAY), "first_dt")


@QUERIES.add(
    "active_bits",
    sql([DAYS, status_sql(LAST_DAY)], "SELECT guid, CAST(first_dt AS VARCHAR) AS first_dt, active_status FROM status"),
)
def bits(spark, sf):
    return dated(activity.init_status(active_days(spark, sf), LAST_DAY), "first_dt")


@QUERIES.add(
    "active_bits_roll",
    sql([DAYS, status_sql(LAST_DAY)], "SELECT guid, CAST(first_dt AS VARCHAR) AS first_dt, active_status FROM status"),
)
def bits_roll(spark, sf):
    return dated(rolled_status(spark, sf), "first_dt")


@QUERIES.add(
    "active_bits_roll_week",
    sql([DAYS, status_sql(DAY_BEFORE, 6, "old"), status_sql(LAST_DAY, 6, "cur")],
        """SELECT coalesce(o.guid, c.guid) AS guid, CAST(coalesce(o.first_dt, c.first_dt) AS VARCHAR) AS first_dt,
           coalesce(c.active_status, 0) AS active_status FROM old o FULL JOIN cur c ON o.guid = c.guid"""),
)
def week_roll(spark, sf):
    return dated(rolled_status(spark, sf, 6), "first_dt")


@QUERIES.add(
    "activity_string",
    sql([DAYS, "users AS (SELECT DISTINCT guid FROM days)",
         f"cal AS (SELECT CAST(d AS DATE) AS dt FROM (SELECT unnest(generate_series(DATE '{LAST_DAY}' - 30, DATE '{LAST_DAY}', INTERVAL 1 DAY)) AS d))"],
        """SELECT u.guid, string_agg(CASE WHEN d.dt IS NULL THEN '0' ELSE '1' END, '' ORDER BY cal.dt) AS activity
           FROM users u CROSS JOIN cal LEFT JOIN days d ON d.guid = u.guid AND d.dt = cal.dt GROUP BY u.guid"""),
)
def strings(spark, sf):
    return activity.activity_string(rolled_status(spark, sf))


@QUERIES.add(
    "retention_from_ranges",
    sql([DAYS, "first AS (SELECT guid, min(dt) AS first_dt FROM days GROUP BY guid)"],
        f"""SELECT '{LAST_DAY}' AS calc_dt, CAST(first_dt AS VARCHAR) AS first_dt,
            date_diff('day', first_dt, DATE '{LAST_DAY}') AS retention_days, count(*) AS retention_users
            FROM first JOIN days USING (guid) WHERE dt = DATE '{LAST_DAY}' AND date_diff('day', first_dt, dt) <= 30 GROUP BY ALL"""),
)
def retention(spark, sf):
    return dated(activity.retention(rolled_ranges(spark, sf), LAST_DAY), "first_dt")


@QUERIES.add(
    "retention_from_bits",
    sql([DAYS, "first AS (SELECT guid, min(dt) AS first_dt FROM days GROUP BY guid)"],
        f"""SELECT '{LAST_DAY}' AS calc_dt, CAST(first_dt AS VARCHAR) AS first_dt,
            date_diff('day', first_dt, DATE '{LAST_DAY}') AS retention_days, count(*) AS retention_users
            FROM first JOIN days USING (guid) WHERE dt = DATE '{LAST_DAY}' AND date_diff('day', first_dt, dt) < 30 GROUP BY ALL"""),
)
def retention_bits(spark, sf):
    return dated(activity.retention_bits(rolled_status(spark, sf), LAST_DAY), "first_dt")


TALL = """tall AS (SELECT CAST(dt AS VARCHAR) AS calc_dt, first_dt, date_diff('day', first_dt, dt) AS retention_days, count(*) AS retention_users
  FROM days JOIN (SELECT guid, min(dt) AS first_dt FROM days GROUP BY guid) USING (guid)
  WHERE date_diff('day', first_dt, dt) <= 30 GROUP BY ALL)"""


@QUERIES.add("retention_history", sql([DAYS, TALL], "SELECT calc_dt, CAST(first_dt AS VARCHAR) AS first_dt, retention_days, retention_users FROM tall"))
def history(spark, sf):
    return dated(activity.retention_history(active_days(spark, sf)), "first_dt")


PIVOT_DAYS = [0, 1, 2, 3, 7, 14, 30]


@QUERIES.add(
    "retention_triangle",
    sql([DAYS, TALL], "SELECT CAST(first_dt AS VARCHAR) AS first_dt, "
        + ", ".join(
            f"CAST(sum(retention_users) FILTER (WHERE retention_days = {d}) AS BIGINT) AS {'dnu' if d == 0 else f'day_{d}'}"
            for d in PIVOT_DAYS
        )
        + " FROM tall GROUP BY first_dt"),
)
def triangle(spark, sf):
    return dated(activity.retention_pivot(activity.retention_history(active_days(spark, sf)), PIVOT_DAYS), "first_dt")


@QUERIES.add(
    "active_lengths",
    sql([DAYS, ranges_sql(LAST_DAY)], f"""SELECT date_diff('day', range_start, least(range_end, DATE '{LAST_DAY}')) AS active_days,
        count(*) AS ranges, count(DISTINCT guid) AS users FROM ranges GROUP BY 1"""),
)
def lengths(spark, sf):
    return activity.active_lengths(rolled_ranges(spark, sf), LAST_DAY)


SILENT = """gaps AS (SELECT guid, range_end, lead(range_start) OVER (PARTITION BY guid ORDER BY range_start) AS nxt FROM ranges)"""


@QUERIES.add(
    "silent_lengths",
    sql([DAYS, ranges_sql(LAST_DAY), SILENT], """SELECT date_diff('day', range_end, nxt) AS silent_days, count(*) AS pauses,
        count(DISTINCT guid) AS users FROM gaps WHERE nxt IS NOT NULL GROUP BY 1"""),
)
def silence(spark, sf):
    return activity.silent_lengths(rolled_ranges(spark, sf), LAST_DAY)


@QUERIES.add(
    "silent_lengths_recent",
    sql([DAYS, ranges_sql(LAST_DAY), SILENT], f"""SELECT date_diff('day', range_end, nxt) AS silent_days, count(*) AS pauses,
        count(DISTINCT guid) AS users FROM gaps WHERE nxt > DATE '{LAST_DAY}' - 10 GROUP BY 1"""),
)
def recent_silence(spark, sf):
    return activity.silent_lengths(rolled_ranges(spark, sf), LAST_DAY, 10)


@QUERIES.add(
    "active_every_day",
    sql([DAYS], f"""SELECT guid FROM days WHERE dt BETWEEN DATE '{MID_DAY}' AND DATE '{MID_DAY}' + 5 GROUP BY guid HAVING count(*) = 6"""),
)
def every_day(spark, sf):
    return activity.active_every_day(rolled_status(spark, sf), LAST_DAY, MID_DAY, "2024-01-20")


@QUERIES.add(
    "silent_every_day",
    sql([DAYS], f"""SELECT DISTINCT guid FROM days WHERE guid NOT IN (SELECT guid FROM days WHERE dt = DATE '{MID_DAY}')"""),
)
def silent_days(spark, sf):
    return activity.silent_every_day(rolled_status(spark, sf), LAST_DAY, MID_DAY, MID_DAY)


@QUERIES.add(
    "active_streak",
    sql([DAYS, ranges_sql(LAST_DAY)], """SELECT guid, max(run) AS longest_run FROM (
        SELECT guid, date_diff('day', greatest(range_start, DATE '2024-01-10'), least(range_end, DATE '2024-01-25')) + 1 AS run FROM ranges)
        WHERE run >= 5 GROUP BY guid"""),
)
def streak(spark, sf):
    return activity.active_streak(rolled_ranges(spark, sf), "2024-01-10", "2024-01-25", 5)
