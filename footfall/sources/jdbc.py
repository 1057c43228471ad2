"""Dimension tables in a relational database, through Spark's JDBC source."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def jdbc_options(
    url: str, table: str, properties: Mapping[str, str] | None = None, split_on: str | None = None,
    bounds: tuple[int, int] | None = None, parts: int = 1, fetch_size: int = 10_000,
) -> dict[str, str]:
    """Reader options. ``split_on`` with ``bounds`` reads a large table in ``parts`` ranges of a numeric column."""
    opts = {"url": url, "dbtable": table, "fetchsize": str(fetch_size), **(properties or {})}
    if split_on:
        if bounds is None or parts < 2:
            raise ValueError("split_on needs bounds and at least two parts")
        opts |= {
            "partitionColumn": split_on,
            "lowerBound": str(bounds[0]),
            "upperBound": str(bounds[1]),
            "numPartitions": str(parts),
        }
    return opts


def read_dim(spark: SparkSession, url: str, table: str, properties: Mapping[str, str] | None = None, **split) -> DataFrame:
    return spark.read.format("jdbc").options(**jdbc_options(url, table, properties, **split)).load()


def append_jdbc(
    df: DataFrame, url: str, table: str, properties: Mapping[str, str] | None = None, connections: int = 8
) -> None:
    """Append rows; ``connections`` caps how many tasks write at once."""
    opts = {"url": url, "dbtable": table, "numPartitions": str(connections), **(properties or {})}
    df.write.format("jdbc").mode("append").options(**opts).save()
