"""Sessions of a stream of log files, with a watermark; rows later than it go to a table of their own.

Two streams follow each other. The first deals every row to the rows in time or to the late ones; the second folds the rows
in time into sessions with Spark's session windows and writes each session once the watermark is past its end. The first
works with the highest time of earlier micro-batches, the second with that of files already read, which is never higher:
what the first lets pass the second never drops.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from footfall.operators.sessions import HALF_HOUR_MS
from footfall.plans.scan import running_total
from footfall.streaming.ingest import arriving

LATE, BATCH = "is_late", "micro_batch"


def deal(
    spark: SparkSession, src: str, table: str, checkpoint: str, schema: T.StructType, delay_ms: int, ts: str = "timestamp",
    fmt: str = "parquet", **options: str,
) -> StreamingQuery:
    """Take in every file not seen yet and stop; rows go to ``table/is_late=false`` or ``table/is_late=true``.

    A row is late if its time is more than ``delay_ms`` before the highest time of earlier micro-batches. A row without a
    time is not late. A micro-batch that is repeated after a failure replaces its own rows, so none is lost or written
    twice. The columns ``is_late`` and ``micro_batch`` are added; the source may not have them.
    """
    if {LATE, BATCH} & {f.name.lower() for f in schema.fields}:
        raise ValueError(f"the source has a column {LATE} or {BATCH}")
    marks = f"{table}/_marks"
    known = T.StructType([T.StructField("high", T.LongType())])

    def write(rows: DataFrame, batch: int) -> None:
        session = rows.sparkSession
        session.createDataFrame([], known).write.mode("append").parquet(f"{marks}/batch=-1")
        high = session.read.schema("high long, batch long").parquet(marks).where(F.col("batch") < batch).agg(F.max("high")).first()[0]
        late = F.coalesce(F.col(ts) < high - delay_ms, F.lit(False)) if high is not None else F.lit(False)
        dealt = rows.withColumns({LATE: late, BATCH: F.lit(batch)})
        dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(LATE, BATCH).parquet(table)
        # Only the micro-batch just written is read back; its mark counts for the next ones.
        own = session.read.schema(dealt.schema).parquet(table).where(F.col(BATCH) == batch)
        own.agg(F.max(ts).cast("long").alias("high")).write.mode("overwrite").parquet(f"{marks}/batch={batch}")

    stream = arriving(spark, src, schema, fmt, **options).writeStream.foreachBatch(write)
    return stream.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _dealt(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(LATE, T.BooleanType()), T.StructField(BATCH, T.LongType())])


def late_rows(spark: SparkSession, table: str, schema: T.StructType) -> DataFrame:
    """Rows that came after the watermark, with the micro-batch that brought them."""
    return spark.read.schema(_dealt(schema)).parquet(table).where(F.col(LATE)).drop(LATE)


def late_counts(spark: SparkSession, table: str, schema: T.StructType) -> DataFrame:
    """(micro_batch, in_time, late) of every micro-batch that brought rows."""
    rows = spark.read.schema(_dealt(schema)).parquet(table)
    return rows.groupBy(BATCH).agg(F.count_if(~F.col(LATE)).alias("in_time"), F.count_if(F.col(LATE)).alias("late"))


def session_stream(
    spark: SparkSession, table: str, sink: str, checkpoint: str, schema: T.StructType, delay_ms: int, key: str = "sessionid",
    ts: str = "timestamp", event_id: str = "event_id", page: str = "page", gap_ms: int = HALF_HOUR_MS,
) -> StreamingQuery:
    """Fold the rows in time that are not read yet into sessions, write those that have ended, and stop.

    A session ends at a pause longer than ``gap_ms``; it is written when no row in time can reach it any more. Open
    sessions wait in the state of the stream. A row without a key or a time is in no session, but its time counts
    for the watermark, so a record of ``closing`` ends whatever is open.
    """
    rows = arriving(spark, table, _dealt(schema), "parquet").where(~F.col(LATE))
    rows = rows.withColumn("_at", F.timestamp_millis(F.col(ts).cast("long")))
    # A pause of exactly the gap stays inside: one millisecond more, and a row at the watermark itself cannot be in a session
    # that is written.
    rows = rows.withWatermark("_at", f"{delay_ms + 1} milliseconds")
    # The second condition keeps the optimizer from filtering before the watermark is taken.
    rows = rows.where(F.col(key).isNotNull() | F.col("_at").isNull())
    paged = F.col(page).isNotNull()
    folded = rows.groupBy(F.col(key).alias("session_key"), F.session_window("_at", f"{gap_ms} milliseconds").alias("_window")).agg(
        F.min(ts).alias("start_time"),
        F.max(ts).alias("end_time"),
        F.count(F.lit(1)).alias("events"),
        F.min(F.when(paged, F.struct(ts, event_id, page))).alias("_first"),
        F.max(F.when(paged, F.struct(ts, event_id, page))).alias("_final"),
        F.count(page).alias("pv_cnt"),
    )
    out = folded.select(
        "session_key", "start_time", "end_time", "events",
        F.col(f"_first.{page}").alias("start_page"), F.col(f"_final.{page}").alias("end_page"), "pv_cnt",
    )
    return (
        out.writeStream.format("parquet").outputMode("append").option("path", sink).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def closing(spark: SparkSession, schema: T.StructType, after_ms: int, delay_ms: int, ts: str = "timestamp", gap_ms: int = HALF_HOUR_MS) -> DataFrame:
    """One record for the source that ends every session open at ``after_ms``, the highest time so far.

    Whatever comes with an earlier time after it is late.
    """
    at = after_ms + gap_ms + delay_ms + 2
    return spark.createDataFrame([tuple(at if f.name == ts else None for f in schema.fields)], schema)


def numbered(sessions: DataFrame) -> DataFrame:
    """Add ``session_id``: ``key_n`` with n from 0, as the batch split names them.

    Sessions of a key are written in the order of their times, so a number once given stays.
    """
    placed = running_total(sessions, ["session_key"], ["start_time"], F.lit(1), "_n")
    return placed.withColumn("session_id", F.concat(F.col("session_key").cast("string"), F.lit("_"), (F.col("_n") - 1).cast("string"))).drop("_n")
