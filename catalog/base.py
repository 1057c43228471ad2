"""How the test tables stand in for logs, users and dimensions; the same expressions as SQL text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from footfall.functions.columns import epoch_millis
from footfall.operators import identity, sessions
from footfall.operators.clean import clean_events, extract_props
from footfall.session import apply_runtime_conf, scratch_path

LAST_DAY = "2024-01-30"
MID_DAY = "2024-01-15"
NOW_MS = 1706659200000


class Registry:
    def __init__(self) -> None:
        self.entries: dict[str, tuple[Callable, str | None]] = {}

    def add(self, name: str, sql: str | None = None):
        def keep(fn):
            def run(spark: SparkSession, sf_dir: str) -> DataFrame:
                return fn(apply_runtime_conf(spark), sf_dir)

            self.entries[name] = (run, sql)
            return fn

        return keep


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def text(col):
    return F.col(col).cast("string") if isinstance(col, str) else col.cast("string")


def app_log(spark: SparkSession, sf: str) -> DataFrame:
    """``events`` in the shape of a raw app log."""
    k = F.col("k")
    user, kind = F.col("user_id"), F.col("event_type")
    ts = F.col("ts").cast("timestamp")
    events = table(spark, sf, "events").withColumn("k", F.get_json_object("props", "$.k").cast("long"))
    return events.select(
        "event_id",
        "user_id",
        "k",
        F.when(kind == "view", F.lit(None).cast("string"))
        .when(kind == "error", F.lit("  "))
        .otherwise(F.concat(F.lit("u"), text("user_id")))
        .alias("account"),
        F.when(k >= 95, F.lit("")).otherwise(F.concat(F.lit("d"), text(F.floor(user / 3)))).alias("deviceid"),
        F.concat(F.lit("phone"), text(user % 4)).alias("devicetype"),
        F.when(user % 3 == 0, "ios").otherwise("android").alias("osname"),
        F.concat(F.lit("ch"), text(k % 3)).alias("releasechannel"),
        kind.alias("eventid"),
        F.concat_ws(".", text(k * 2 + 1), text(user % 256), text(F.col("event_id") % 256), text(k)).alias("ip"),
        (F.lit(20.0) + (user % 60) / F.lit(4.0)).alias("latitude"),
        (F.lit(100.0) + (k % 50) / F.lit(4.0)).alias("longitude"),
        F.create_map(
            F.lit("pageId"), F.when(k % 10 != 0, text((k % 25) * 13)),
            F.lit("productId"), text(k * 30),
            F.lit("shareMethod"), F.element_at(F.array(F.lit("friend"), F.lit("group"), F.lit("qr")), (k % 3 + 1).cast("int")),
        ).alias("properties"),
        F.concat(F.lit("s"), text("user_id"), F.lit("-"), F.date_format(ts, "yyyyMMdd")).alias("sessionid"),
        epoch_millis("ts").alias("timestamp"),
        F.to_date(ts).alias("dt"),
        "value",
    )


LOG = """log AS (
  SELECT event_id, user_id, k,
    CASE WHEN event_type = 'view' THEN NULL WHEN event_type = 'error' THEN '  '
         ELSE 'u' || user_id END AS account,
    CASE WHEN k >= 95 THEN '' ELSE 'd' || (user_id // 3) END AS deviceid,
    'phone' || (user_id % 4) AS devicetype,
    CASE WHEN user_id % 3 = 0 THEN 'ios' ELSE 'android' END AS osname,
    'ch' || (k % 3) AS releasechannel,
    event_type AS eventid,
    (k * 2 + 1) || '.' || (user_id % 256) || '.' || (event_id % 256) || '.' || k AS ip,
    ((k * 2 + 1) * 16777216 + (user_id % 256) * 65536 + (event_id % 256) * 256 + k)::BIGINT AS ip_number,
    20e0 + (user_id % 60) / 4e0 AS latitude,
    100e0 + (k % 50) / 4e0 AS longitude,
    CASE WHEN k % 10 <> 0 THEN CAST((k % 25) * 13 AS VARCHAR) END AS page,
    CAST(k * 30 AS VARCHAR) AS product,
    ['friend', 'group', 'qr'][(k % 3 + 1)] AS share_method,
    's' || user_id || '-' || strftime(ts, '%Y%m%d') AS sessionid,
    epoch_us(ts) // 1000 AS ms, strftime(ts, '%Y%m%d%H')::BIGINT AS hour_stamp, hour(ts)::BIGINT AS hour_of_day,
    CAST(ts AS DATE) AS dt, ts, value
  FROM (SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k FROM events)
)"""

CLEAN = """clean AS (
  SELECT * REPLACE (nullif(trim(account), '') AS account, nullif(trim(deviceid), '') AS deviceid) FROM log
  WHERE nullif(trim(account), '') IS NOT NULL OR nullif(trim(deviceid), '') IS NOT NULL
)"""

SCORES = """scores AS (
  SELECT deviceid, account, (count(DISTINCT sessionid) * 100)::DOUBLE AS score, min(ms) AS min_time
  FROM clean WHERE deviceid IS NOT NULL GROUP BY deviceid, account
)"""

BEST = """best AS (
  SELECT deviceid, account AS best_account FROM (
    SELECT *, row_number() OVER (PARTITION BY deviceid ORDER BY score DESC, min_time DESC, account DESC) AS rn
    FROM scores WHERE account IS NOT NULL) WHERE rn = 1
)"""

GUID = """ev AS (
  SELECT c.*, coalesce(c.account, b.best_account, c.deviceid) AS guid,
         k.guid IS NULL AS newflag
  FROM clean c LEFT JOIN best b ON c.deviceid = b.deviceid
  LEFT JOIN (SELECT DISTINCT 'u' || s_suppkey AS guid FROM supplier) k
    ON k.guid = coalesce(c.account, b.best_account, c.deviceid)
)"""

IDS = "ids AS (SELECT row_number() OVER (ORDER BY guid) AS id, guid FROM (SELECT DISTINCT guid FROM ev))"

SPLIT = """split AS (
  SELECT *, sessionid || '_' || CAST(sum(cut) OVER (PARTITION BY sessionid ORDER BY ms, event_id) AS BIGINT) AS newsessionid
  FROM (SELECT *, CASE WHEN ms - lag(ms) OVER (PARTITION BY sessionid ORDER BY ms, event_id) > 1800000
                       THEN 1 ELSE 0 END AS cut FROM ev)
)"""

PLACE = """place AS (
  SELECT s.*, coalesce(r_name || '|' || n_name, 'UNKNOWN') AS location, r_name AS area, n_name AS nation_name
  FROM split s LEFT JOIN customer ON c_custkey = s.user_id
  LEFT JOIN nation ON n_nationkey = c_nationkey LEFT JOIN region ON r_regionkey = n_regionkey
)"""

SESSIONS = """sess AS (
  SELECT newsessionid AS session_id, min(ms) AS start_time, max(ms) AS end_time,
    arg_min(page, (ms, event_id)) FILTER (WHERE page IS NOT NULL) AS start_page,
    arg_max(page, (ms, event_id)) FILTER (WHERE page IS NOT NULL) AS end_page,
    count(page) AS pv_cnt, min(hour_stamp) AS hour_range,
    arg_max(guid, (ms, event_id)) AS guid, arg_max(newflag, (ms, event_id)) AS isnew,
    arg_max(location, (ms, event_id)) AS location, arg_max(devicetype, (ms, event_id)) AS device_type,
    arg_max(osname, (ms, event_id)) AS os_name, arg_max(releasechannel, (ms, event_id)) AS release_ch
  FROM place GROUP BY newsessionid
)"""

TRAFFIC = """usertraffic AS (
  SELECT guid, location, hour_range, device_type, os_name, start_page, end_page, isnew,
    count(*) AS session_cnt, sum(end_time - start_time)::BIGINT AS time_long,
    count(*) FILTER (WHERE pv_cnt < 2) AS jumpout_cnt, sum(pv_cnt)::BIGINT AS pv_cnt
  FROM sess GROUP BY ALL
)"""

TO_GUID = [LOG, CLEAN, SCORES, BEST, GUID]
TO_TRAFFIC = [*TO_GUID, IDS, SPLIT, PLACE, SESSIONS, TRAFFIC]


def sql(ctes: list[str], body: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + body


def cleaned(spark: SparkSession, sf: str) -> DataFrame:
    return clean_events(app_log(spark, sf), ["eventid", "sessionid"], ["account", "deviceid"])


def known_users(spark: SparkSession, sf: str) -> DataFrame:
    """Global id table of earlier days: suppliers stand in for users already known."""
    return table(spark, sf, "supplier").select(
        (F.col("s_suppkey") + 1).alias("id"), F.concat(F.lit("u"), text("s_suppkey")).alias("guid")
    )


def with_guid(spark: SparkSession, sf: str) -> DataFrame:
    """Cleaned events with guid and newflag."""
    events = cleaned(spark, sf)
    scores = identity.daily_scores(events).select("deviceid", "account", "score", F.col("min_time").alias("last_time"))
    best = identity.best_account(scores)
    return identity.identify(events, best, known_users(spark, sf))


def with_location(spark: SparkSession, sf: str, events: DataFrame) -> DataFrame:
    place = (
        table(spark, sf, "customer")
        .join(table(spark, sf, "nation"), F.col("n_nationkey") == F.col("c_nationkey"), "left")
        .join(table(spark, sf, "region"), F.col("r_regionkey") == F.col("n_regionkey"), "left")
        .select(F.col("c_custkey").alias("user_id"), F.col("r_name").alias("area"), F.col("n_name").alias("nation_name"))
    )
    return events.join(place, "user_id", "left").withColumn(
        "location", F.coalesce(F.concat(F.col("area"), F.lit("|"), F.col("nation_name")), F.lit("UNKNOWN"))
    )


def detail(spark: SparkSession, sf: str) -> DataFrame:
    """Events ready for session reports: user, flag, place and page."""
    return extract_props(with_location(spark, sf, with_guid(spark, sf)), {"pageId": "page", "productId": "product"})


def stored_detail(spark: SparkSession, sf: str) -> DataFrame:
    """The same as a stored table, for reports that read it more than once and only some of its columns."""
    rows = detail(spark, sf)
    path = scratch_path(spark, "detail")
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def session_rows(spark: SparkSession, sf: str) -> DataFrame:
    return sessions.sessions_from_events(detail(spark, sf))


def user_rows(spark: SparkSession, sf: str) -> DataFrame:
    return sessions.user_traffic(session_rows(spark, sf))


def users_and_ids(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """User traffic rows and the id table, both from one stored detail table."""
    rows = stored_detail(spark, sf)
    return sessions.user_traffic(sessions.sessions_from_events(rows)), identity.allocate_ids(rows.select("guid"))


def guid_ids(spark: SparkSession, sf: str) -> DataFrame:
    return identity.allocate_ids(with_guid(spark, sf).select("guid"))


def active_days(spark: SparkSession, sf: str) -> DataFrame:
    """(guid, dt) of every day, with the user number as guid."""
    return identity.daily_active(
        table(spark, sf, "events").select(F.col("user_id").alias("guid"), F.to_date("ts").alias("dt"))
    )
