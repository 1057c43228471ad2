"""Helpers the operators share: durable intermediate tables, global row numbers, ASCII words."""

from __future__ import annotations

from collections.abc import Callable, Hashable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from footfall.session import scratch_path

#: A word is a run of bytes other than space, tab, line feed, vertical tab, form feed, carriage return.
#: ``bytes.split()`` cuts at exactly these, and ``bytes.lower()`` changes only A-Z.
WORD = r"[^\x20\x09-\x0D]+"


#: What a Python worker remembers from task to task.
_remembered: dict[Hashable, Any] = {}


def remembered(what: Hashable, make: Callable[[], Any]) -> Any:
    """The same object in every task of a worker process; of several only the one asked for last is kept."""
    if what not in _remembered:
        forget()
        _remembered[what] = make()
    return _remembered[what]


def forget() -> None:
    """Drop it. Spark hands a worker from stage to stage, and what one has learned is room another lacks."""
    _remembered.clear()
    pa.default_memory_pool().release_unused()


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: nothing before it is ever recomputed."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete the stored tables that ``df`` reads, once nothing reads it or them any more."""
    spark = df.sparkSession
    root = spark._jvm.org.apache.hadoop.fs.Path(scratch_path(spark, "any")).getParent().toUri().getPath().rstrip("/")
    for name in {name.rpartition("/")[0] for name in df.inputFiles()}:
        folder = spark._jvm.org.apache.hadoop.fs.Path(name)
        if folder.toUri().getPath().startswith(root + "/"):
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def words(text: str | None) -> list[bytes]:
    """Words of a text with A-Z in lower case."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def word_count(text: Column) -> Column:
    """Number of words of a text, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def held_out(doc_id: Column, folds: int, fold: int) -> Column:
    """Whether crc32 of the id as text falls into ``fold``; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == fold, F.lit(False))


def numbered(df: DataFrame, order: list[Column], out: str) -> DataFrame:
    """Add ``out``: 0, 1, 2 ... over all rows by ``order``, without sorting in one task.

    Rows are range-partitioned and stored with their place in the partition; what partitions hold before
    them is one row per partition. Rows equal in ``order`` get neighbouring numbers in any order.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Equal rows may be many: the last key only serves to cut them into several partitions.
    placed = stored(
        df.withColumn("_cut", F.monotonically_increasing_id())
        .repartitionByRange(parts, *order, F.col("_cut"))
        .sortWithinPartitions(*order, F.col("_cut"))
        .drop("_cut")
        .withColumns({"_part": F.spark_partition_id(), "_pos": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))}),
        "numbered",
    )
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"))
    # One row per partition, so the window over all of them and the broadcast are both bounded.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    return (
        placed.join(F.broadcast(offsets), "_part")
        .withColumn(out, F.col("_before") + F.col("_pos"))
        .drop("_part", "_pos", "_before")
    )


def text_rows(batch: pa.RecordBatch, column: str = "text") -> Iterator[tuple[int, str]]:
    """Position and text of each row of a batch, null as the empty text."""
    values = batch.column(batch.schema.get_field_index(column))
    for i in range(len(values)):
        yield i, values[i].as_py() or ""


def total_bytes(df: DataFrame, text: str = "text") -> int:
    """UTF-8 bytes of all texts."""
    return int(df.agg(F.coalesce(F.sum(F.octet_length(F.col(text))), F.lit(0))).first()[0])
