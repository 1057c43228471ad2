"""Funnels and attribution."""

from pyspark.sql import functions as F

from catalog.base import Registry, app_log, sql, table, text
from footfall.operators import attribution, funnel

QUERIES = Registry()
STEPS = ["view", "click", "purchase"]
CANDS = ["view", "click", "signup"]
TARGET = "purchase"


def path_events(spark, sf):
    return app_log(spark, sf).select(F.col("user_id").alias("guid"), "dt", "eventid", "timestamp", "event_id")


EV = "e AS (SELECT user_id AS guid, CAST(ts AS DATE) AS dt, event_type AS ev, epoch_us(ts) // 1000 AS ms, event_id FROM events)"


def reach_sql(by: str, steps) -> list[str]:
    """t1, t2, ...: earliest time each step is done in order, per journey."""
    ctes = [EV, f"t1 AS (SELECT {by}, min((ms, event_id)) AS at FROM e WHERE ev = '{steps[0]}' GROUP BY {by})"]
    for i, step in enumerate(steps[1:], 2):
        ctes.append(
            f"t{i} AS (SELECT {by}, min((ms, event_id)) AS at FROM e JOIN t{i - 1} p USING ({by}) "
            f"WHERE ev = '{step}' AND (ms, event_id) > p.at GROUP BY {by})"
        )
    return ctes


def funnel_sql(by: str, steps) -> str:
    parts = " UNION ALL ".join(
        f"SELECT {i}::BIGINT AS step_no, '{s}' AS step, count(*) AS reached FROM t{i}" for i, s in enumerate(steps, 1)
    )
    return sql(reach_sql(by, steps), parts)


@QUERIES.add("funnel_by_day", funnel_sql("guid, dt", STEPS))
def by_day(spark, sf):
    return funnel.funnel(path_events(spark, sf), STEPS, ["guid", "dt"])


LONG_PATH = ["view", "click", "view", "signup", "purchase"]


@QUERIES.add("funnel_by_user", funnel_sql("guid", LONG_PATH))
def by_user(spark, sf):
    return funnel.funnel(path_events(spark, sf), LONG_PATH, ["guid"])


@QUERIES.add(
    "furthest_step",
    sql(reach_sql("guid, dt", STEPS), """SELECT guid, CAST(dt AS VARCHAR) AS dt,
        CASE WHEN t3.at IS NOT NULL THEN 3 WHEN t2.at IS NOT NULL THEN 2 WHEN t1.at IS NOT NULL THEN 1 ELSE 0 END::BIGINT AS furthest
        FROM (SELECT DISTINCT guid, dt FROM e WHERE ev IN ('view', 'click', 'purchase'))
        LEFT JOIN t1 USING (guid, dt) LEFT JOIN t2 USING (guid, dt) LEFT JOIN t3 USING (guid, dt)"""),
)
def furthest(spark, sf):
    return funnel.furthest_step(path_events(spark, sf), STEPS, ["guid", "dt"]).withColumn("dt", text("dt"))


SEG = [
    EV,
    """marked AS (SELECT *, sum(CASE WHEN ev = 'purchase' THEN 1 ELSE 0 END) OVER (PARTITION BY guid ORDER BY ms, event_id)::BIGINT AS segment,
        sum(CASE WHEN ev = 'purchase' THEN 1 ELSE 0 END) OVER (PARTITION BY guid) AS targets
      FROM e WHERE ev IN ('view', 'click', 'signup', 'purchase'))""",
    """seg AS (SELECT guid, segment, ev AS event, min((ms, event_id)) AS first_at, max((ms, event_id)) AS last_at, count(*) AS touches
      FROM marked WHERE ev <> 'purchase' AND segment < targets GROUP BY ALL)""",
    """ranked AS (SELECT *, row_number() OVER (PARTITION BY guid, segment ORDER BY first_at) AS rn,
        count(*) OVER (PARTITION BY guid, segment) AS n, max(last_at) OVER (PARTITION BY guid, segment) AS latest FROM seg)""",
]
WEIGHTS = {
    "first": "CASE WHEN rn = 1 THEN 100e0 END",
    "last": "CASE WHEN last_at = latest THEN 100e0 END",
    "linear": "round(100e0 / n, 2)",
    "position": "round(CASE WHEN n = 1 THEN 100e0 WHEN n = 2 THEN 50e0 WHEN rn IN (1, n) THEN 40e0 ELSE 20e0 / (n - 2) END, 2)",
    "time": "round(pow(0.9e0, rn - 1) * 100 / (1 - pow(0.9e0, n)) * 0.1e0, 2)",
}


def model_sql(*models: str) -> str:
    parts = " UNION ALL ".join(
        f"SELECT '{m}' AS model, 'purchase' AS target, guid, segment, event, {WEIGHTS[m]} AS weight FROM ranked" for m in models
    )
    return sql(SEG, f"SELECT * FROM ({parts}) WHERE weight IS NOT NULL")


def seg(spark, sf):
    return attribution.segments(
        path_events(spark, sf), TARGET, CANDS, event="eventid", ts="timestamp", event_id="event_id"
    )


@QUERIES.add(
    "journeys_with_target",
    sql([EV], """SELECT event_id, guid, ev AS eventid FROM e WHERE ev IN ('view', 'click', 'purchase')
        AND guid IN (SELECT guid FROM e WHERE ev = 'purchase')"""),
)
def journeys(spark, sf):
    kept = attribution.keep_journeys(path_events(spark, sf), ["view", "click"], TARGET)
    return kept.select("event_id", "guid", "eventid")


@QUERIES.add(
    "conversion_segments",
    sql(SEG, "SELECT guid, segment, event, first_at[1] AS first_ms, last_at[1] AS last_ms, touches FROM seg"),
)
def segments(spark, sf):
    return seg(spark, sf).select(
        "guid", "segment", "event", F.col("first_at.t").alias("first_ms"), F.col("last_at.t").alias("last_ms"), "touches"
    )


@QUERIES.add("attribution_first", model_sql("first"))
def first(spark, sf):
    return attribution.first_touch(seg(spark, sf), TARGET)


@QUERIES.add("attribution_last", model_sql("last"))
def last(spark, sf):
    return attribution.last_touch(seg(spark, sf), TARGET)


@QUERIES.add("attribution_linear", model_sql("linear"))
def linear(spark, sf):
    return attribution.linear(seg(spark, sf), TARGET)


@QUERIES.add("attribution_position", model_sql("position"))
def position(spark, sf):
    return attribution.position(seg(spark, sf), TARGET)


@QUERIES.add("attribution_time", model_sql("time"))
def time(spark, sf):
    return attribution.time_decay(seg(spark, sf), TARGET)


@QUERIES.add("attribution_models", model_sql(*WEIGHTS))
def models(spark, sf):
    return attribution.attribution(seg(spark, sf), TARGET)
