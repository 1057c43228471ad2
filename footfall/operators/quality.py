"""Checks on the tables the jobs write."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F


def check_mixed(relation: DataFrame) -> DataFrame:
    """Devices that hold both a row with and a row without an account; should be empty."""
    return (
        relation.groupBy("deviceid")
        .agg(
            F.count_if(F.col("account").isNull()).alias("without_account"),
            F.count_if(F.col("account").isNotNull()).alias("with_account"),
        )
        .where((F.col("without_account") > 0) & (F.col("with_account") > 0))
    )


def check_cardinality(src: DataFrame, dst: DataFrame, key: str) -> DataFrame:
    """Distinct keys of the source and of the target table, one row each."""
    one = src.agg(F.countDistinct(key).alias("keys")).select(F.lit("source").alias("side"), "keys")
    two = dst.agg(F.countDistinct(key).alias("keys")).select(F.lit("target").alias("side"), "keys")
    return one.unionByName(two)


def check_dense(ids: DataFrame, id_col: str = "id", key: str = "guid") -> DataFrame:
    """Highest id, number of rows and of distinct users: all three agree when the ids are dense."""
    return ids.agg(
        F.max(id_col).alias("max_id"), F.count(F.lit(1)).alias("rows"), F.countDistinct(key).alias("users")
    )


#: Highest value of each gate that lets a day pass.
GATES = {"dirty_share": 0.5, "lost_rows": 0.0, "unresolved_rows": 0.0, "mixed_devices": 0.0, "id_gaps": 0.0}


class GateFailed(ValueError):
    """A day that is not published, and the gates that kept it."""


def gate_values(contacts: DataFrame, named: DataFrame, fresh_ids: DataFrame, relation: DataFrame) -> dict[str, float]:
    """The value of every gate, from what a day's jobs wrote: no scan of the events of its own.

    ``contacts`` (clean, events) are counts folded from all raw rows, ``named`` the detail, of which the guid is read,
    ``fresh_ids`` the ids given out, and ``relation`` the state after the day.
    """
    read, kept = contacts.agg(F.coalesce(F.sum("events"), F.lit(0)), F.coalesce(F.sum(F.when(F.col("clean"), F.col("events"))), F.lit(0))).first()
    written, unresolved = named.agg(F.count(F.lit(1)), F.count_if(F.col("guid").isNull())).first()
    low, high, ids = fresh_ids.agg(F.min("id"), F.max("id"), F.count(F.lit(1))).first()
    return {
        "dirty_share": 1 - kept / read if read else 0.0,
        "lost_rows": abs(kept - written),
        "unresolved_rows": unresolved,
        "mixed_devices": check_mixed(relation).count(),
        "id_gaps": high - low + 1 - ids if ids else 0,
    }


def gate_report(spark: SparkSession, values: Mapping[str, float], limits: Mapping[str, float]) -> DataFrame:
    """(gate, value, highest, passed), one row per gate; a gate without a limit always passes."""
    rows = [(g, float(v), float(limits[g]) if g in limits else None, g not in limits or v <= limits[g]) for g, v in sorted(values.items())]
    return spark.createDataFrame(rows, "gate string, value double, highest double, passed boolean")


def hold_back(values: Mapping[str, float], limits: Mapping[str, float]) -> None:
    """Raise if a value is above its limit."""
    failed = {g: v for g, v in values.items() if g in limits and v > limits[g]}
    if failed:
        raise GateFailed(", ".join(f"{g} is {v:g}, at most {limits[g]:g} may pass" for g, v in sorted(failed.items())))
