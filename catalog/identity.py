"""Devices, accounts, users."""

from pyspark.sql import functions as F

from catalog.base import (
    CLEAN, IDS, LOG, MID_DAY, NOW_MS, SCORES, TO_GUID, Registry, app_log, cleaned, guid_ids, known_users, sql, text, with_guid,
)
from footfall.operators import identity, quality
from footfall.operators.clean import clean_events, is_clean
from footfall.session import stored

QUERIES = Registry()


@QUERIES.add("device_account_scores", sql([LOG, CLEAN, SCORES], "SELECT * FROM scores"))
def scores(spark, sf):
    return identity.daily_scores(cleaned(spark, sf))


# The first half of the month is the state of the day before, the second half is the day.
HALVES = [
    LOG,
    CLEAN,
    f"""prev0 AS (SELECT deviceid, account, (count(DISTINCT sessionid) * 100)::DOUBLE AS score, min(ms) AS t
      FROM clean WHERE deviceid IS NOT NULL AND dt <= DATE '{MID_DAY}' GROUP BY deviceid, account)""",
    f"""cur AS (SELECT deviceid, account, (count(DISTINCT sessionid) * 100)::DOUBLE AS score, min(ms) AS t
      FROM clean WHERE deviceid IS NOT NULL AND dt > DATE '{MID_DAY}' GROUP BY deviceid, account)""",
    f"""prev AS (SELECT deviceid, account, score, t AS first_time, t AS last_time FROM prev0 p
      WHERE account IS NOT NULL
      UNION ALL
      SELECT deviceid, NULL, 0e0, {NOW_MS}::BIGINT, {NOW_MS}::BIGINT FROM prev0 p WHERE account IS NULL
        AND NOT EXISTS (SELECT 1 FROM prev0 q WHERE q.deviceid = p.deviceid AND q.account IS NOT NULL))""",
    """rolled AS (SELECT coalesce(p.deviceid, c.deviceid) AS deviceid, coalesce(p.account, c.account) AS account,
        CASE WHEN c.deviceid IS NULL THEN p.score * 0.7e0 ELSE coalesce(p.score, 0) + c.score END AS score,
        coalesce(p.first_time, c.t) AS first_time, coalesce(c.t, p.last_time) AS last_time
      FROM prev p FULL JOIN cur c ON p.deviceid = c.deviceid AND p.account IS NOT DISTINCT FROM c.account)""",
    f"""relation AS (SELECT * FROM rolled WHERE account IS NOT NULL
      UNION ALL
      SELECT DISTINCT deviceid, NULL, 0e0, {NOW_MS}::BIGINT, {NOW_MS}::BIGINT FROM rolled r WHERE account IS NULL
        AND NOT EXISTS (SELECT 1 FROM rolled q WHERE q.deviceid = r.deviceid AND q.account IS NOT NULL))""",
]


def empty_relation(spark):
    return spark.createDataFrame([], "deviceid string, account string, score double, first_time long, last_time long")


def relation(spark, sf):
    events = cleaned(spark, sf)
    mid = F.lit(MID_DAY).cast("date")
    before = identity.roll_scores(
        empty_relation(spark), identity.daily_scores(events.where(F.col("dt") <= mid)), NOW_MS
    )
    return identity.roll_scores(before, identity.daily_scores(events.where(F.col("dt") > mid)), NOW_MS)


@QUERIES.add(
    "device_account_roll",
    sql(HALVES, "SELECT deviceid, account, round(score, 4) AS score, first_time, last_time FROM relation"),
)
def rolled(spark, sf):
    return relation(spark, sf).withColumn("score", F.round("score", 4))


@QUERIES.add(
    "device_account_steps",
    sql(HALVES, "SELECT deviceid, account, round(score, 4) AS score, first_time, last_time FROM relation"),
)
def steps(spark, sf):
    """The same relation from rows of the contacts of each half, aged when they are read."""
    events, mid = cleaned(spark, sf), F.lit(MID_DAY).cast("date")
    empty = empty_relation(spark).withColumn("since", F.lit(MID_DAY).cast("date"))
    one = stored(identity.step_scores(empty, identity.daily_scores(events.where(F.col("dt") <= mid)), MID_DAY), "step")
    day = "2024-01-16"
    two = stored(identity.step_scores(identity.latest_contacts(one), identity.daily_scores(events.where(F.col("dt") > mid)), day), "step")
    found = identity.scores_on(identity.latest_contacts(one.unionByName(two)), day, NOW_MS)
    return found.withColumn("score", F.round("score", 4))


@QUERIES.add(
    "anonymous_devices",
    sql(HALVES, """SELECT deviceid, bool_or(account IS NOT NULL) AS has_account, count(*) AS rows FROM relation GROUP BY deviceid"""),
)
def anonymous(spark, sf):
    return relation(spark, sf).groupBy("deviceid").agg(
        F.bool_or(F.col("account").isNotNull()).alias("has_account"), F.count(F.lit(1)).alias("rows")
    )


@QUERIES.add(
    "best_account",
    sql(HALVES, """SELECT deviceid, account AS best_account FROM (SELECT *, row_number() OVER (
        PARTITION BY deviceid ORDER BY score DESC, last_time DESC, account DESC) AS rn FROM relation WHERE account IS NOT NULL) WHERE rn = 1"""),
)
def best(spark, sf):
    return identity.best_account(relation(spark, sf))


@QUERIES.add("guid_resolution", sql(TO_GUID, "SELECT event_id, guid FROM ev"))
def guids(spark, sf):
    events = cleaned(spark, sf)
    scores = identity.daily_scores(events).withColumnRenamed("min_time", "last_time")
    return identity.resolve_guid(events, identity.best_account(scores)).select("event_id", "guid")


@QUERIES.add("new_visitor_flag", sql(TO_GUID, "SELECT event_id, guid, newflag FROM ev"))
def new_flag(spark, sf):
    events = cleaned(spark, sf)
    scores = identity.daily_scores(events).withColumnRenamed("min_time", "last_time")
    resolved = identity.resolve_guid(events, identity.best_account(scores))
    return identity.flag_new(resolved, known_users(spark, sf)).select("event_id", "guid", "newflag")


@QUERIES.add("event_identity", sql(TO_GUID, "SELECT event_id, guid, newflag FROM ev"))
def event_identity(spark, sf):
    return with_guid(spark, sf).select("event_id", "guid", "newflag")


@QUERIES.add(
    "new_contact_flag",
    sql(HALVES, """SELECT event_id, NOT EXISTS (SELECT 1 FROM prev p WHERE p.deviceid = c.deviceid)
        AND NOT EXISTS (SELECT 1 FROM prev p WHERE p.account = c.account) AS newflag FROM clean c"""),
)
def new_contact(spark, sf):
    events = cleaned(spark, sf)
    before = identity.roll_scores(
        empty_relation(spark),
        identity.daily_scores(events.where(F.col("dt") <= F.lit(MID_DAY).cast("date"))),
        NOW_MS,
    )
    return identity.flag_new_by_contact(events, before).select("event_id", "newflag")


@QUERIES.add(
    "dense_ids",
    sql([*TO_GUID, "gids AS (SELECT row_number() OVER (ORDER BY guid) AS id, guid FROM (SELECT DISTINCT guid FROM ev))"],
        "SELECT id, guid FROM gids"),
)
def dense(spark, sf):
    return guid_ids(spark, sf)


ALLOCATED = """alloc AS (SELECT (SELECT max(s_suppkey) + 1 FROM supplier) + row_number() OVER (ORDER BY guid) AS id, guid
  FROM (SELECT DISTINCT guid FROM ev WHERE newflag))"""


@QUERIES.add("id_allocation", sql([*TO_GUID, ALLOCATED], "SELECT id, guid FROM alloc"))
def allocation(spark, sf):
    return identity.allocate_ids(with_guid(spark, sf).select("guid"), known_users(spark, sf))


@QUERIES.add("daily_active", sql(TO_GUID, "SELECT DISTINCT guid, CAST(dt AS VARCHAR) AS dt FROM ev"))
def daily(spark, sf):
    return identity.daily_active(with_guid(spark, sf)).withColumn("dt", text("dt"))


@QUERIES.add(
    "check_mixed_rows",
    sql(HALVES, """SELECT deviceid, count(*) FILTER (WHERE account IS NULL) AS without_account, count(account) AS with_account
        FROM relation GROUP BY deviceid HAVING count(account) > 0 AND count(*) > count(account)"""),
)
def mixed(spark, sf):
    return quality.check_mixed(relation(spark, sf))


@QUERIES.add(
    "check_mixed_raw",
    sql([LOG, CLEAN, SCORES], """SELECT deviceid, count(*) FILTER (WHERE account IS NULL) AS without_account, count(account) AS with_account
        FROM scores GROUP BY deviceid HAVING count(account) > 0 AND count(*) > count(account)"""),
)
def mixed_raw(spark, sf):
    return quality.check_mixed(identity.daily_scores(cleaned(spark, sf)))


@QUERIES.add(
    "check_cardinality",
    sql(HALVES, """SELECT 'source' AS side, count(DISTINCT deviceid) AS keys FROM clean
        UNION ALL SELECT 'target', count(DISTINCT deviceid) FROM relation"""),
)
def cardinality(spark, sf):
    from footfall.functions.columns import blank_to_null

    source = cleaned(spark, sf).withColumn("deviceid", blank_to_null("deviceid"))
    return quality.check_cardinality(source, relation(spark, sf), "deviceid")


@QUERIES.add(
    "check_dense_ids",
    sql(TO_GUID, "SELECT count(DISTINCT guid) AS max_id, count(DISTINCT guid) AS rows, count(DISTINCT guid) AS users FROM ev"),
)
def dense_check(spark, sf):
    return quality.check_dense(guid_ids(spark, sf))


def _gate(name: str, value: str) -> str:
    highest = quality.GATES[name]
    return f"SELECT '{name}' AS gate, ({value})::DOUBLE AS value, {highest}::DOUBLE AS highest, ({value}) <= {highest} AS passed"


@QUERIES.add(
    "gate_report",
    sql([*TO_GUID, IDS], " UNION ALL ".join(_gate(*g) for g in [
        ("dirty_share", "SELECT 1 - (SELECT count(*) FROM clean)::DOUBLE / count(*) FROM log"),
        ("lost_rows", "SELECT abs(count(*) - (SELECT count(*) FROM clean)) FROM ev"),
        ("unresolved_rows", "SELECT count(*) FROM ev WHERE guid IS NULL"),
        ("mixed_devices", "SELECT count(*) FROM (SELECT deviceid FROM scores GROUP BY 1 HAVING count(account) BETWEEN 1 AND count(*) - 1)"),
        ("id_gaps", "SELECT max(id) - min(id) + 1 - count(*) FROM ids"),
    ])),
)
def gates(spark, sf):
    """All events as one day: counted while they are scored, named and numbered, then judged."""
    logs = app_log(spark, sf)
    rule = (["eventid", "sessionid"], ["account", "deviceid"])
    counts = stored(identity.contact_counts(logs, is_clean(logs, *rule)), "counts")
    scores = identity.scores_of(counts)
    best = identity.best_account(scores.withColumnRenamed("min_time", "last_time"))
    named = stored(identity.identify(clean_events(logs, *rule), best, known_users(spark, sf)).select("guid"), "named")
    values = quality.gate_values(counts, named, identity.allocate_ids(named), scores)
    return quality.gate_report(spark, values, quality.GATES)
