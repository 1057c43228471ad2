"""Log files as they arrive, each record into the folder of the day it happened."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from footfall.operators.clean import mask_fields


def arriving(spark: SparkSession, src: str, schema: T.StructType, fmt: str = "json", **options: str) -> DataFrame:
    return spark.readStream.schema(schema).format(fmt).options(**options).load(src)


def routed(stream: DataFrame, event_ms: Column, private: Iterable[str] = ()) -> DataFrame:
    """Add ``dt`` from the event time and hide private fields. Works on a batch just as well."""
    return mask_fields(stream.withColumn("dt", F.to_date(F.timestamp_millis(event_ms))), private)


def ingest(
    spark: SparkSession, src: str, sink: str, checkpoint: str, schema: T.StructType, event_ms: Column,
    private: Iterable[str] = (), fmt: str = "json", prepare: Callable[[DataFrame], DataFrame] | None = None,
    levels: Iterable[str] = ("dt",), **options: str,
) -> StreamingQuery:
    """Take in every file not seen yet and stop; the checkpoint remembers which ones were.

    Records are written under ``sink/dt=...``, or under other ``levels`` such as ("terminal", "dt"); a late record goes
    to its own day.
    """
    stream = arriving(spark, src, schema, fmt, **options)
    if prepare is not None:
        stream = prepare(stream)
    return (
        routed(stream, event_ms, private)
        .writeStream.format("parquet")
        .partitionBy(*levels)
        .option("path", sink)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
