"""Sources and sinks: written, read back, and compared."""

from pyspark.ml.classification import NaiveBayesModel
from pyspark.sql import functions as F, types as T

from catalog.base import LOG, MID_DAY, NOW_MS, TO_TRAFFIC, Registry, app_log, session_rows, sql, table, text
from catalog.profile import BAYES_SQL, TRAITS, traits
from footfall.operators import activity, geo, profile
from footfall.session import scratch_path
from footfall.sources import models, tables
from footfall.streaming.ingest import ingest

QUERIES = Registry()


def event_days(spark, sf):
    return app_log(spark, sf).select("event_id", "user_id", "eventid", "timestamp", "dt")


@QUERIES.add(
    "day_scan",
    sql([LOG], f"SELECT event_id, eventid, ms AS timestamp FROM log WHERE dt = DATE '{MID_DAY}'"),
)
def day_scan(spark, sf):
    path = scratch_path(spark, "days")
    event_days(spark, sf).write.partitionBy("dt").parquet(path)
    return tables.scan_day(spark, path, MID_DAY, ["event_id", "eventid", "timestamp"])


@QUERIES.add("day_rewrite", sql([LOG], "SELECT CAST(dt AS VARCHAR) AS dt, count(*) AS events, sum(event_id)::BIGINT AS ids FROM log GROUP BY dt"))
def day_rewrite(spark, sf):
    """Every day is written, then one of them twice more: the table stays the same."""
    path = scratch_path(spark, "rewrite")
    rows = event_days(spark, sf)
    rows.write.partitionBy("dt").parquet(path)
    for _ in range(2):
        tables.write_day(rows.where(F.col("dt") == F.lit(MID_DAY).cast("date")), path, MID_DAY)
    return spark.read.parquet(path).groupBy(text("dt").alias("dt")).agg(
        F.count(F.lit(1)).alias("events"), F.sum("event_id").alias("ids")
    )


@QUERIES.add("day_append", sql([LOG], f"""SELECT CAST(dt AS VARCHAR) AS dt, count(*) * CASE WHEN dt = DATE '{MID_DAY}' THEN 2 ELSE 1 END AS events
    FROM log GROUP BY dt"""))
def day_append(spark, sf):
    """Appending a day again duplicates it; that is why rewriting is the default."""
    path = scratch_path(spark, "append")
    rows = event_days(spark, sf)
    rows.write.partitionBy("dt").parquet(path)
    tables.write_day(rows.where(F.col("dt") == F.lit(MID_DAY).cast("date")), path, MID_DAY, mode="append")
    return spark.read.parquet(path).groupBy(text("dt").alias("dt")).agg(F.count(F.lit(1)).alias("events"))


@QUERIES.add("parquet_round_trip", "SELECT c_mktsegment, count(*) AS customers, round(sum(c_acctbal), 2) AS balance FROM customer GROUP BY 1")
def parquet_trip(spark, sf):
    path = scratch_path(spark, "customer")
    tables.write_parquet(table(spark, sf, "customer"), path)
    return tables.read_parquet(spark, path).groupBy("c_mktsegment").agg(
        F.count(F.lit(1)).alias("customers"), F.round(F.sum("c_acctbal"), 2).alias("balance")
    )


@QUERIES.add("csv_scan", "SELECT c_custkey, c_name, c_nationkey::BIGINT AS c_nationkey, c_acctbal, c_mktsegment FROM customer")
def csv_scan(spark, sf):
    path = scratch_path(spark, "csv")
    table(spark, sf, "customer").write.csv(path, header=True)
    return tables.read_csv(spark, path, "c_custkey long, c_name string, c_nationkey long, c_acctbal double, c_mktsegment string")


@QUERIES.add(
    "labelled_text",
    """SELECT quality::DOUBLE AS label, sum(len(string_split(text, chr(10))))::BIGINT AS lines
       FROM documents JOIN labels USING (doc_id) GROUP BY quality""",
)
def labelled_text(spark, sf):
    rows = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id")
    sources = {}
    for quality in (0, 1):
        path = scratch_path(spark, f"quality{quality}")
        rows.where(F.col("quality") == quality).select("text").write.text(path)
        sources[path] = float(quality)
    return tables.read_labelled_text(spark, sources).groupBy("label").agg(F.count(F.lit(1)).alias("lines"))


@QUERIES.add(
    "vector_lines",
    """SELECT CAST(label AS VARCHAR) AS label, count(*) AS vectors, round(sum(list_sum(list_transform(embedding, lambda x: x::DOUBLE))), 4) AS total
       FROM embeddings GROUP BY label""",
)
def vector_lines(spark, sf):
    path = scratch_path(spark, "vectors")
    items = F.concat(F.col("embedding").cast("array<double>").cast("array<string>"), F.array(text("label")))
    table(spark, sf, "embeddings").select(F.array_join(items, ",").alias("value")).write.text(path)
    rows = tables.parse_vectors(spark.read.text(path))
    total = F.aggregate("vec", F.lit(0.0), lambda a, x: a + x)
    return rows.groupBy("label").agg(F.count(F.lit(1)).alias("vectors"), F.round(F.sum(total), 4).alias("total"))


LOG_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("account", T.StringType()),
        T.StructField("eventid", T.StringType()),
        T.StructField("ip", T.StringType()),
        T.StructField("timestamp", T.LongType()),
        T.StructField("properties", T.MapType(T.StringType(), T.StringType())),
    ]
)


@QUERIES.add(
    "json_logs",
    sql([LOG], """SELECT coalesce(eventid, 'corrupt') AS eventid, count(*) AS lines, count(page) AS pages, sum(event_id)::BIGINT AS ids
        FROM (SELECT eventid, page, event_id FROM log UNION ALL SELECT NULL, NULL, NULL FROM benchmark) GROUP BY 1"""),
)
def json_logs(spark, sf):
    """Log lines with lines of plain prose among them: the prose ends up as corrupt, nothing fails."""
    path = scratch_path(spark, "json")
    good = app_log(spark, sf).select(F.to_json(F.struct(*[f.name for f in LOG_SCHEMA.fields])).alias("value"))
    bad = table(spark, sf, "benchmark").select(F.concat(F.lit("# "), F.translate("text", "\r\n", "  ")).alias("value"))
    good.unionByName(bad).write.text(path)
    rows = tables.read_logs(spark, path, LOG_SCHEMA)
    kind = F.when(F.col(tables.CORRUPT).isNotNull(), "corrupt").otherwise(F.col("eventid"))
    return rows.groupBy(kind.alias("eventid")).agg(
        F.count(F.lit(1)).alias("lines"), F.count(F.col("properties")["pageId"]).alias("pages"), F.sum("event_id").alias("ids")
    )


@QUERIES.add(
    "json_export",
    "SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS dt, count(DISTINCT user_id) AS users FROM events GROUP BY 1",
)
def json_export(spark, sf):
    path = scratch_path(spark, "out")
    days = app_log(spark, sf).select("user_id", text("dt").alias("dt")).distinct()
    tables.write_json(days, path)
    back = spark.read.schema("user_id long, dt string").json(path)
    return back.groupBy("dt").agg(F.count(F.lit(1)).alias("users"))


KV_COLUMNS = ["guid", "session_id", "start_page", "end_page", "pv_cnt", "location", "device_type", "os_name"]
KV = [c for c in KV_COLUMNS]
KV_TEXT = ", ".join(
    f"CASE WHEN {c} IS NULL OR CAST({c} AS VARCHAR) IN ('UNKNOWN', '内网IP', '0') THEN '\\N' ELSE CAST({c} AS VARCHAR) END AS {c}" for c in KV
)


@QUERIES.add(
    "key_value_export",
    sql([*TO_TRAFFIC, f"kv AS (SELECT {KV_TEXT} FROM sess)"],
        f"""SELECT md5(location) || md5(device_type) || md5(start_page) AS row_key, 'f' AS family, 'q' AS qualifier,
            CAST(to_json({{{', '.join(f"'{c}': {c}" for c in KV)}}}) AS VARCHAR) AS value FROM kv"""),
)
def key_values(spark, sf):
    path = scratch_path(spark, "kv")
    tables.export_kv(session_rows(spark, sf).select(*KV), ["location", "device_type", "start_page"], path)
    return spark.read.parquet(path)


@QUERIES.add("model_round_trip", sql(BAYES_SQL, "SELECT c_custkey, prediction FROM scored"))
def model_trip(spark, sf):
    path = scratch_path(spark, "model")
    rows = traits(spark, sf)
    models.save_model(profile.fit_traits(rows, TRAITS), path)
    return profile.predict(models.load_model(NaiveBayesModel, path), rows, TRAITS).select("c_custkey", "prediction")


EVENT_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
    ]
)


@QUERIES.add(
    "stream_ingest",
    """SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS dt, event_id, event_type, sha256(CAST(user_id AS VARCHAR)) AS user_id FROM events""",
)
def stream(spark, sf):
    """The event files as a stream, run twice: the second run finds nothing new."""
    sink, seen = scratch_path(spark, "sink"), scratch_path(spark, "seen")
    for _ in range(2):
        ingest(
            spark, sf, sink, seen, EVENT_SCHEMA, F.unix_millis(F.col("ts").cast("timestamp")), ["user_id"],
            fmt="parquet", pathGlobFilter="events.parquet",
        ).awaitTermination()
    return spark.read.parquet(sink).select(text("dt").alias("dt"), "event_id", "event_type", "user_id")


@QUERIES.add(
    "terminal_day_scan",
    sql([LOG], f"""SELECT event_id, eventid, 'web' AS terminal, CAST(dt AS VARCHAR) AS dt FROM log WHERE dt = DATE '{MID_DAY}' AND k % 4 = 2"""),
)
def terminal_day_scan(spark, sf):
    """Logs of four terminals as JSON lines by terminal and day; one folder of them is read."""
    path = scratch_path(spark, "terminals")
    names = F.array(*[F.lit(t) for t in ("app", "mini-program", "web", "h5")])
    rows = app_log(spark, sf).select("event_id", "eventid", "dt", F.element_at(names, (F.col("k") % 4 + 1).cast("int")).alias("terminal"))
    tables.write_logs(rows, path)
    schema = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("eventid", T.StringType())])
    return tables.scan_logs(spark, path, schema, MID_DAY, "web").select("event_id", "eventid", "terminal", text("dt").alias("dt"))
