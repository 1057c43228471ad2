"""Readers and writers for day-partitioned tables, files and exports."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from footfall.functions.columns import export_text

CORRUPT = "_corrupt"


def scan_day(spark: SparkSession, path: str, day: str, columns: Sequence[str] | None = None) -> DataFrame:
    """One day of a table partitioned by ``dt``; only that folder and the named columns are read."""
    df = spark.read.parquet(path).where(F.col("dt") == F.lit(day).cast("date"))
    return df.select(*columns) if columns else df


def scan_through(spark: SparkSession, path: str, day: str, columns: Sequence[str] | None = None) -> DataFrame:
    """All days of a table up to and including ``day``: for tables that only grow, such as the id table."""
    df = spark.read.parquet(path).where(F.col("dt") <= F.lit(day).cast("date"))
    return df.select(*columns) if columns else df


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str, header: bool = True) -> DataFrame:
    """CSV with a stated schema; blanks around values are ignored."""
    return spark.read.csv(
        path, schema=schema, header=header, ignoreLeadingWhiteSpace=True, ignoreTrailingWhiteSpace=True
    )


def read_labelled_text(spark: SparkSession, sources: Mapping[str, float]) -> DataFrame:
    """(label, text): every line of every file, labelled by the path it came from."""
    parts = [
        spark.read.text(path).select(F.lit(float(label)).alias("label"), F.col("value").alias("text"))
        for path, label in sources.items()
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def parse_vectors(lines: DataFrame, label_at: str = "last", col: str = "value") -> DataFrame:
    """Comma lists to (label, vec); the label is the ``first`` or the ``last`` item."""
    if label_at not in ("first", "last"):
        raise ValueError("label_at must be 'first' or 'last'")
    items = F.split(F.col(col), ",")
    n = F.size(items)
    label, start = (F.get(items, n - 1), F.lit(1)) if label_at == "last" else (F.get(items, F.lit(0)), F.lit(2))
    return lines.select(
        F.trim(label).alias("label"),
        F.transform(F.slice(items, start, n - 1), lambda x: F.trim(x).cast("double")).alias("vec"),
    )


def read_logs(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """JSON lines; a line that does not parse keeps its text in ``_corrupt`` instead of failing the job."""
    return _json(spark, schema, path, {})


def _json(spark: SparkSession, schema: T.StructType, path: str, options: Mapping[str, str]) -> DataFrame:
    full = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    return spark.read.schema(full).options(**options).json(path, mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT)


#: Levels of a log folder: where a record comes from (app, mini-program, web, h5, ...), and its day.
LOG_LEVELS = ("terminal", "dt")


def write_logs(df: DataFrame, path: str, mode: str = "append") -> None:
    """JSON lines under ``terminal=.../dt=...``; a record without terminal or day goes to Spark's default folder of that level."""
    df.write.mode(mode).partitionBy(*LOG_LEVELS).json(path)


def scan_logs(spark: SparkSession, path: str, schema: T.StructType, day: str, terminal: str | None = None) -> DataFrame:
    """One day of the logs of one terminal, or of all, with ``terminal`` and ``dt``; no other folder is listed or read.

    A terminal without logs of that day gives no rows.
    """
    try:
        rows = _json(spark, schema, f"{path}/terminal={terminal or '*'}/dt={day}", {"basePath": path})
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        rows = spark.createDataFrame([], T.StructType([*schema.fields, *(T.StructField(c, T.StringType()) for c in (CORRUPT, *LOG_LEVELS))]))
    return rows.withColumns({"terminal": F.col("terminal").cast("string"), "dt": F.col("dt").cast("date")})


def rows(spark: SparkSession, data: Iterable, schema: T.StructType | str, view: str | None = None) -> DataFrame:
    """Literal rows, for fixtures; ``view`` also registers them under a name."""
    df = spark.createDataFrame(list(data), schema)
    if view:
        df.createOrReplaceTempView(view)
    return df


def write_parquet(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).parquet(path)


def write_json(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).json(path)


def write_day(df: DataFrame, path: str, day: str, mode: str = "overwrite") -> None:
    """Write one day of a table. The default replaces that day only, all or not at all.

    Spark writes the rows aside and moves them into place when the job commits, so a write that fails leaves the
    day as it was. A result without rows replaces the day too: a file that holds only the schema takes its place.
    """
    rows, before = df.drop("dt"), _files(df.sparkSession, f"{path}/dt={day}")
    rows.withColumn("dt", F.lit(day)).write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy("dt").parquet(path)
    # Files carry the name of their job: the same ones as before mean that there was no row to put in their place.
    if mode == "overwrite" and _files(df.sparkSession, f"{path}/dt={day}") == before:
        _empty_day(df.sparkSession, rows.schema, path, day)


def _files(spark: SparkSession, folder: str) -> set[str]:
    """Names in a folder, none where there is no folder."""
    at = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    return {f.getPath().getName() for f in fs.listStatus(at)} if fs.exists(at) else set()


def stage_day(df: DataFrame, path: str, day: str) -> DataFrame:
    """Write a day of a table where no reader of the table looks, and read it back with its ``dt``."""
    rows, aside = df.drop("dt"), _staged(path, day)
    rows.write.mode("overwrite").parquet(aside)
    return df.sparkSession.read.schema(rows.schema).parquet(aside).withColumn("dt", F.lit(day).cast("date"))


def _staged(path: str, day: str) -> str:
    return f"{path}/_staged-{day}"


def publish_day(spark: SparkSession, path: str, day: str) -> None:
    """Put a staged day in place of the day in the table."""
    _put(spark, _staged(path, day), f"{path}/dt={day}")


def discard_day(spark: SparkSession, path: str, day: str) -> None:
    """Drop a staged day that is not to be published."""
    aside = spark._jvm.org.apache.hadoop.fs.Path(_staged(path, day))
    aside.getFileSystem(spark._jsc.hadoopConfiguration()).delete(aside, True)


def _empty_day(spark: SparkSession, schema: T.StructType, path: str, day: str) -> None:
    """Put a file without rows in place of a day."""
    aside = f"{path}/_empty-{uuid.uuid4().hex}"
    spark.createDataFrame([], schema).coalesce(1).write.parquet(aside)
    _put(spark, aside, f"{path}/dt={day}")


def _put(spark: SparkSession, aside: str, folder: str) -> None:
    """Move a finished folder into place. The old one is kept beside it until then and comes back if the move fails."""
    source, target, old = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (aside, folder, f"{folder.rsplit('/', 1)[0]}/_old-{uuid.uuid4().hex}"))
    fs = source.getFileSystem(spark._jsc.hadoopConfiguration())
    had = fs.exists(target)
    if had and not fs.rename(target, old):
        raise OSError(f"{folder} could not be moved aside")
    if not fs.rename(source, target):
        if had:
            fs.rename(old, target)
        raise OSError(f"{aside} could not be moved to {folder}")
    if had:
        fs.delete(old, True)


def key_values(df: DataFrame, key_cols: Sequence[str]) -> DataFrame:
    """(row_key, family, qualifier, value): md5 of the key columns side by side, and the row as JSON text."""
    text = df.select(*[export_text(c).alias(c) for c in df.columns])
    return text.select(
        F.concat(*[F.md5(F.col(c)) for c in key_cols]).alias("row_key"),
        F.lit("f").alias("family"),
        F.lit("q").alias("qualifier"),
        F.to_json(F.struct(*[F.col(c) for c in df.columns])).alias("value"),
    )


def export_kv(df: DataFrame, key_cols: Sequence[str], path: str) -> None:
    """Write key-value rows in total key order.

    The value takes part in the range partitioning, so rows of one very frequent key spread over files
    whose key ranges still follow each other.
    """
    order = ["row_key", "family", "qualifier", "value"]
    key_values(df, key_cols).repartitionByRange(*order).sortWithinPartitions(*order).write.mode("overwrite").parquet(path)
