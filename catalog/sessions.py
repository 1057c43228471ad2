"""Sessions and traffic."""

from pyspark.sql import functions as F

from catalog.base import (
    CLEAN, LOG, PLACE, SESSIONS, SPLIT, TO_GUID, TO_TRAFFIC, Registry, cleaned, detail, session_rows, sql, stored_detail, user_rows, with_guid,
)
from footfall.operators import sessions
from footfall.operators.clean import extract_props
from footfall.session import scratch_path, stored
from footfall.streaming import sessions as streamed

QUERIES = Registry()
SESSION_COLUMNS = """session_id, start_time, end_time, start_page, end_page, pv_cnt, hour_range, guid, isnew, location,
  device_type, os_name, release_ch"""


@QUERIES.add("session_split", sql([*TO_GUID, SPLIT], "SELECT event_id, newsessionid FROM split"))
def split(spark, sf):
    return sessions.sessionize(with_guid(spark, sf)).select("event_id", "newsessionid")


@QUERIES.add("session_aggregate", sql([*TO_GUID, SPLIT, PLACE, SESSIONS], f"SELECT {SESSION_COLUMNS} FROM sess"))
def aggregate(spark, sf):
    return sessions.session_agg(sessions.sessionize(detail(spark, sf)))


@QUERIES.add(
    "session_with_hours",
    sql([*TO_GUID, SPLIT, PLACE, SESSIONS, """hours AS (SELECT newsessionid AS session_id, string_agg(DISTINCT hour_stamp::VARCHAR, ',' ORDER BY hour_stamp::VARCHAR) AS hours
        FROM split GROUP BY 1)"""], f"SELECT {SESSION_COLUMNS}, hours FROM sess JOIN hours USING (session_id)"),
)
def with_hours(spark, sf):
    """Session rows with the set of their hours, in one table."""
    rows = sessions.session_agg(sessions.sessionize(detail(spark, sf)), hours=True)
    return rows.withColumn("hours", F.array_join("hour_set", ",")).drop("hour_set")


@QUERIES.add("sessions_from_events", sql([*TO_GUID, SPLIT, PLACE, SESSIONS], f"SELECT {SESSION_COLUMNS} FROM sess"))
def direct(spark, sf):
    return session_rows(spark, sf)


@QUERIES.add(
    "session_page_list",
    sql([*TO_GUID, SPLIT], """SELECT newsessionid AS session_id, (pos - 1) // 1000 AS chunk, string_agg(page, ',' ORDER BY pos) AS pages
        FROM (SELECT *, row_number() OVER (PARTITION BY newsessionid ORDER BY ms, event_id) AS pos FROM split WHERE page IS NOT NULL)
        GROUP BY newsessionid, chunk"""),
)
def pages(spark, sf):
    lists = sessions.session_pages(sessions.sessionize(stored_detail(spark, sf)))
    return lists.select("session_id", "chunk", F.array_join("page_list", ",").alias("pages"))


@QUERIES.add(
    "daily_page_list",
    sql([*TO_GUID], """SELECT sessionid AS session_id, (pos - 1) // 2 AS chunk, string_agg(page, ',' ORDER BY pos) AS pages
        FROM (SELECT *, row_number() OVER (PARTITION BY sessionid ORDER BY ms, event_id) AS pos FROM ev WHERE page IS NOT NULL)
        GROUP BY sessionid, chunk"""),
)
def daily_pages(spark, sf):
    lists = sessions.session_pages(stored_detail(spark, sf), session="sessionid", chunk=2)
    return lists.select("session_id", "chunk", F.array_join("page_list", ",").alias("pages"))


@QUERIES.add(
    "session_hour_set",
    sql([*TO_GUID, SPLIT], "SELECT DISTINCT newsessionid AS session_id, hour_stamp FROM split"),
)
def hours(spark, sf):
    return sessions.session_hours(sessions.sessionize(with_guid(spark, sf)))


@QUERIES.add("user_traffic", sql(TO_TRAFFIC, "SELECT * FROM usertraffic"))
def user_traffic(spark, sf):
    return user_rows(spark, sf)


NOON_MS = 1_705_320_000_000
HOUR_MS = 3_600_000


def stream_events(spark, sf):
    rows = extract_props(cleaned(spark, sf), {"pageId": "page"})
    return stored(rows.select("event_id", "user_id", "sessionid", "timestamp", "page"), "stream-events")


@QUERIES.add(
    "session_stream",
    sql([*TO_GUID, SPLIT], """SELECT newsessionid AS session_id, min(ms) AS start_time, max(ms) AS end_time, count(*) AS events,
        arg_min(page, (ms, event_id)) FILTER (WHERE page IS NOT NULL) AS start_page,
        arg_max(page, (ms, event_id)) FILTER (WHERE page IS NOT NULL) AS end_page, count(page) AS pv_cnt
        FROM split GROUP BY newsessionid"""),
)
def session_stream(spark, sf):
    """Events arrive in two drops that overlap by an hour, then a record closes what is open: the sessions of the batch split."""
    events, delay = stream_events(spark, sf), 2 * HOUR_MS
    src, table, sink, at = (scratch_path(spark, n) for n in ("drops", "dealt", "sessions", "progress"))
    first = F.col("timestamp") < NOON_MS + (F.col("event_id") % 2) * HOUR_MS
    last = events.agg(F.max("timestamp")).first()[0] or 0
    for drop in (events.where(first), events.where(~first), streamed.closing(spark, events.schema, last, delay)):
        drop.write.mode("append").parquet(src)
        streamed.deal(spark, src, table, f"{at}/deal", events.schema, delay).awaitTermination()
        streamed.session_stream(spark, table, sink, f"{at}/sessions", events.schema, delay).awaitTermination()
    found = streamed.numbered(spark.read.parquet(sink))
    return found.select("session_id", "start_time", "end_time", "events", "start_page", "end_page", "pv_cnt")


@QUERIES.add(
    "late_events",
    sql([LOG, CLEAN], f"""SELECT event_id, sessionid FROM clean
        WHERE user_id % 7 = 0 AND ms < (SELECT max(ms) FROM clean WHERE user_id % 7 <> 0 AND ms < {NOON_MS}) - {HOUR_MS}"""),
)
def late_events(spark, sf):
    """Every seventh user's rows come after the morning of the others: those more than an hour behind are set aside."""
    events = stream_events(spark, sf)
    src, table, at = (scratch_path(spark, n) for n in ("drops", "dealt", "progress"))
    first = (F.col("user_id") % 7 != 0) & (F.col("timestamp") < NOON_MS)
    for drop in (events.where(first), events.where(~first)):
        drop.write.mode("append").parquet(src)
        streamed.deal(spark, src, table, at, events.schema, HOUR_MS).awaitTermination()
    return streamed.late_rows(spark, table, events.schema).select("event_id", "sessionid")
