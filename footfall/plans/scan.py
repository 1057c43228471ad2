"""Ordered computations over keys of any size: a prefix scan over ranges of rows.

A window over a whole key puts all its rows into one task. Here rows are range-partitioned by (key, order) and stored,
so that a crowded key, or a crowded moment of it, is cut like any other run of rows; a part is worked on by one task, and
what a part adds up to is carried into the next. Only the first and the last key of a part can reach into another part,
so what is carried is at most two rows per part, however many rows or keys there are. Rows equal in key and order stay
together: an event id at the end of the order lets them part.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from footfall.session import stored


def fresh(columns: Iterable[str], name: str) -> str:
    """``name``, with as many underscores before it as it takes to differ from all ``columns``."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def _parts(spark: SparkSession, parts: int | None) -> int:
    return parts or int(spark.conf.get("spark.sql.shuffle.partitions"))


def in_order(rows: DataFrame, keys: Sequence[str], order: Sequence[str], part: str, parts: int | None = None) -> DataFrame:
    """The rows as a stored table with ``part``, the number of the range they fall into, ascending with (keys, order)."""
    parts = _parts(rows.sparkSession, parts)
    return stored(rows.repartitionByRange(parts, *keys, *order).withColumn(part, F.spark_partition_id()), "ordered")


def by_part(placed: DataFrame, part: str, parts: int | None = None) -> DataFrame:
    """One task per part; windows and groups whose keys include ``part`` need no further shuffle."""
    return placed.repartitionById(_parts(placed.sparkSession, parts), F.col(part))


def carried(placed: DataFrame, keys: Sequence[str], part: str, value: str) -> DataFrame:
    """(_p, _k0, ..., _before, _all): sum of ``value`` before a part and in all parts, for keys at the edge of a part.

    At most two rows per part.
    """
    key = F.struct(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)])
    edges = placed.groupBy(F.col(part).alias("_p")).agg(F.min(key).alias("_lo"), F.max(key).alias("_hi"))
    slim = placed.select(F.col(part).alias("_at"), key.alias("_key"), F.col(value).alias("_add"))
    ends = slim.join(F.broadcast(edges), F.col("_at") == F.col("_p")).where(F.col("_key").eqNullSafe(F.col("_lo")) | F.col("_key").eqNullSafe(F.col("_hi")))
    sums = ends.groupBy("_p", "_key").agg(F.sum("_add").alias("_add"))
    whole = Window.partitionBy("_key")
    before = whole.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    return sums.select("_p", "_key.*", F.coalesce(F.sum("_add").over(before), F.lit(0)).alias("_before"), F.sum("_add").over(whole).alias("_all"))


def running_total(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], value: Column, out: str, total: str | None = None, parts: int | None = None
) -> DataFrame:
    """Add ``out``: sum of ``value`` over the rows of the key up to and including this row; null keys are one key.

    ``total`` names one more column to add: the sum over the whole key. Rows that ``order`` leaves equal follow
    each other in any order. ``df`` is read twice, once to draw the ranges; its columns may have any names.
    """
    part, v, here = (fresh([*df.columns, out, total or out], n) for n in ("_part", "_value", "_whole"))
    placed = in_order(df.withColumn(v, F.coalesce(value.cast("long"), F.lit(0))), keys, order, part, parts)
    inside = Window.partitionBy(part, *keys)
    rows = by_part(placed, part, parts).withColumns(
        {out: F.sum(v).over(inside.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)), here: F.sum(v).over(inside)}
    )
    # Names of the carried columns that the rows do not have either.
    edge = carried(placed, keys, part, v)
    names = {c: fresh([*rows.columns, total or out], c) for c in edge.columns}
    edge = edge.withColumnsRenamed(names)
    same = F.col(part) == F.col(names["_p"])
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(names[f"_k{i}"]))
    rows = rows.join(F.broadcast(edge), same, "left")
    added = {out: F.col(out) + F.coalesce(F.col(names["_before"]), F.lit(0))}
    if total:
        added[total] = F.coalesce(F.col(names["_all"]), F.col(here))
    return rows.withColumns(added).drop(part, v, here, *names.values())


def dense_rank_ids(distinct_keys: DataFrame, key: str, out: str) -> DataFrame:
    """Number distinct keys 1, 2, 3 ... in key order without a one-partition sort.

    The keys are range-partitioned, sorted and stored with their place in the partition; the offsets are one row per
    partition, so the rows are shuffled once.
    """
    part, place = fresh([key, out], "_part"), fresh([key, out], "_place")
    ranged = distinct_keys.select(key).repartitionByRange(_parts(distinct_keys.sparkSession, None), key).sortWithinPartitions(key)
    # Within a partition that id counts rows from 0 in its lower 33 bits.
    numbers = {part: F.spark_partition_id(), place: F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))}
    placed = stored(ranged.withColumns(numbers), "numbered")
    before = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    sizes = placed.groupBy(F.col(part).alias("_p")).agg(F.count(F.lit(1)).alias("_n"))
    # One row per partition, so the global window and the broadcast are both bounded.
    offsets = sizes.select("_p", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return placed.join(F.broadcast(offsets), F.col(part) == F.col("_p")).select((F.col(place) + F.col("_before") + 1).cast("long").alias(out), key)
