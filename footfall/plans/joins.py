"""Left joins in which rows without a key do not meet in one task."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from footfall.plans.scan import fresh


def left_join(left: DataFrame, right: DataFrame, keys: Mapping[str, str]) -> DataFrame:
    """Left join on pairs of column names (left, right); the right keys are dropped.

    A left row with a null among its keys matches nothing. Such rows are spread by the partition they come from; the
    optimizer still broadcasts a right side it measures to be small. The other right columns must have names of their own.
    """
    taken = [*left.columns, *right.columns]
    spread, zero = fresh(taken, "_spread"), fresh(taken, "_zero")
    names = {r: fresh(taken, f"_key{i}") for i, r in enumerate(keys.values())}
    # Always 0, but not a literal: the optimizer would take that out of the join's keys.
    right = right.withColumnsRenamed(names).withColumn(zero, F.pmod(F.xxhash64(*names.values()), F.lit(1)))
    no_key = reduce(lambda a, b: a | b, (F.col(k).isNull() for k in keys))
    left = left.withColumn(spread, F.when(no_key, F.spark_partition_id()).otherwise(0))
    same = F.col(spread) == F.col(zero)
    for mine, other in keys.items():
        same = same & (F.col(mine) == F.col(names[other]))
    return left.join(right, same, "left").drop(spread, zero, *names.values())
