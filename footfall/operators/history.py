"""History tables and dimension lookups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from footfall.functions.columns import OPEN_END, UNKNOWN_LABEL
from footfall.plans.joins import left_join


def scd2_roll(prev: DataFrame, delta: DataFrame, day: str, key: str = "oid") -> DataFrame:
    """Version table of ``day``: an open row with a new version ends the day before, the new version opens.

    ``prev`` and ``delta`` share their value columns; ``prev`` adds start_dt and end_dt. Closed rows
    pass through without a join. Of several versions of a key in ``delta`` the largest by its values counts, and
    an open row that starts on ``day`` is replaced, so a repeated roll changes nothing.
    """
    values = [c for c in prev.columns if c not in ("start_dt", "end_dt")]
    versions = delta.groupBy(key).agg(F.max(F.struct(*values)).alias("_v")).select("_v.*")
    opened = versions.withColumns(
        {"start_dt": F.lit(day).cast("date"), "end_dt": F.lit(OPEN_END).cast("date")}
    )
    is_open = F.col("end_dt") == F.lit(OPEN_END).cast("date")
    changed = delta.select(key).distinct().withColumn("_changed", F.lit(True))
    still = (
        prev.where(is_open)
        .join(changed, key, "left")
        .where(F.col("_changed").isNull() | (F.col("start_dt") < F.lit(day).cast("date")))
        .withColumn("end_dt", F.when(F.col("_changed"), F.date_sub(F.lit(day).cast("date"), 1)).otherwise(F.col("end_dt")))
        .select(*prev.columns)
    )
    closed = prev.where(~is_open)
    return closed.unionByName(still).unionByName(opened)


def as_of_level(
    orders: DataFrame, levels: DataFrame, key: str = "member_id", level: str = "member_level_id",
    amount: str = "order_amt", at: str = "create_time",
) -> DataFrame:
    """Orders and their sum per member and level, each order counted at the level valid on its day.

    Orders fold to one row per member and day first, so a member with very many orders stays small.
    """
    per_day = (
        orders.groupBy(key, F.to_date(at).alias("_day"))
        .agg(F.count(F.lit(1)).alias("_cnt"), F.sum(amount).alias("_sum"))
    )
    return (
        per_day.join(levels.select(key, level, "start_dt", "end_dt"), key)
        .where(F.col("_day").between(F.col("start_dt"), F.col("end_dt")))
        .groupBy(key, level)
        .agg(F.sum("_cnt").alias("order_cnt"), F.sum("_sum").alias("order_amt"))
    )


def enrich(
    fact: DataFrame, dims: Sequence[tuple[DataFrame, str, str]], default: str | None = UNKNOWN_LABEL
) -> DataFrame:
    """Left join of a fact table with dimensions: (dimension, fact column, dimension key).

    Text attributes of a missing dimension row get ``default``. An attribute whose name the fact table or an earlier
    dimension has is added as ``<fact column>_<name>``. Dimension keys must be unique; the optimizer broadcasts a
    dimension only when its measured size is under the threshold. Rows without a key match nothing; they are spread by
    the partition they come from, not sent to one task.
    """
    for dim, fact_col, dim_key in dims:
        taken = {c.lower() for c in fact.columns}
        names = {c: f"{fact_col}_{c}" for c in dim.columns if c != dim_key and c.lower() in taken}
        dim = dim.withColumnsRenamed(names)
        attrs = [f for f in dim.schema.fields if f.name != dim_key]
        fact = left_join(fact, dim, {fact_col: dim_key})
        if default is not None:
            fact = fact.withColumns(
                {
                    f.name: F.coalesce(F.col(f.name), F.lit(default))
                    for f in attrs
                    if f.dataType.typeName() == "string"
                }
            )
    return fact
