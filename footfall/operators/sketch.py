"""Distinct counts that can be merged later: exact bitmaps over dense ids, and sketches.

A native bitmap covers 32,768 ids, so a set is one row per (keys, bucket). Merging groups those
rows again; the size of a set is the sum over its buckets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

BUCKET = "bucket"


def bitmap_bucket(id_col: Column | str) -> Column:
    return F.bitmap_bucket_number(F.col(id_col) if isinstance(id_col, str) else id_col)


def bitmap_of(id_col: Column | str, when: Column | None = None) -> Column:
    """Aggregate: bitmap of the ids, of those rows only where ``when`` holds. Null ids set no bit."""
    col = F.col(id_col) if isinstance(id_col, str) else id_col
    if when is not None:
        col = F.when(when, col)
    return F.bitmap_construct_agg(F.bitmap_bit_position(col))


def bitmap_base(df: DataFrame, id_col: str, keys: list[str], out: str = "bitmap") -> DataFrame:
    """One bitmap per (keys, bucket). Rows with a null id keep their group alive with an empty set."""
    return df.groupBy(*keys, bitmap_bucket(id_col).alias(BUCKET)).agg(bitmap_of(id_col).alias(out))


def bitmap_merge(df: DataFrame, keys: list[str], col: str = "bitmap") -> DataFrame:
    """Union of the sets of every group of ``keys``, still one row per bucket."""
    return df.groupBy(*keys, BUCKET).agg(F.bitmap_or_agg(col).alias(col))


def bitmap_cardinality(df: DataFrame, keys: list[str], col: str = "bitmap", out: str = "cardinality") -> DataFrame:
    """Size of each merged set."""
    return df.groupBy(*keys).agg(F.sum(F.bitmap_count(col)).cast("long").alias(out))


def first_members(df: DataFrame, keys: list[str], id_col: str, k: int) -> DataFrame:
    """The k smallest distinct ids per group, ranked. Spark keeps k per task before shuffling."""
    rank = Window.partitionBy(*keys).orderBy(id_col)
    return (
        df.where(F.col(id_col).isNotNull())
        .select(*keys, id_col)
        .distinct()
        .withColumn("rank", F.row_number().over(rank).cast("long"))
        .where(F.col("rank") <= k)
    )


def set_union(df: DataFrame, keys: list[str], col: str, out: str = "member") -> DataFrame:
    """Distinct union of an array column over each group, one row per member."""
    return (
        df.select(*keys, F.explode(F.array_distinct(col)).alias(out)).where(F.col(out).isNotNull()).distinct()
    )


def hll_base(df: DataFrame, col: str, keys: list[str], lg_k: int = 12, out: str = "sketch") -> DataFrame:
    return df.groupBy(*keys).agg(F.hll_sketch_agg(col, lg_k).alias(out))


def hll_collection(df: DataFrame, keys: list[str], col: str, lg_k: int = 12, out: str = "sketch") -> DataFrame:
    """Sketch of the members of an array column."""
    return hll_base(df.select(*keys, F.explode(col).alias("_m")), "_m", keys, lg_k, out)


def hll_merge(df: DataFrame, keys: list[str], col: str = "sketch") -> DataFrame:
    return df.groupBy(*keys).agg(F.hll_union_agg(col).alias(col))


def hll_row_merge(a: Column | str, b: Column | str) -> Column:
    """Union of two sketches of one row."""
    return F.hll_union(a, b)


def overlap_estimate(a: DataFrame, b: DataFrame, col: str, lg_k: int = 14) -> DataFrame:
    """Estimated size of both sets, their union and their intersection, as one row."""
    sketched = a.agg(F.theta_sketch_agg(col, lg_k).alias("_a")).withColumn(
        "_b", b.agg(F.theta_sketch_agg(col, lg_k)).scalar()
    )
    return sketched.select(
        F.theta_sketch_estimate("_a").alias("size_a"),
        F.theta_sketch_estimate("_b").alias("size_b"),
        F.theta_sketch_estimate(F.theta_union("_a", "_b")).alias("size_union"),
        F.theta_sketch_estimate(F.theta_intersection("_a", "_b")).alias("size_both"),
    )


def approx_distinct(df: DataFrame, col: str, rsds: list[float]) -> DataFrame:
    """One row per relative error: the estimate of the distinct count at that precision."""
    estimates = df.agg(*[F.approx_count_distinct(col, r).alias(f"_e{i}") for i, r in enumerate(rsds)])
    pairs = F.array(
        *[F.struct(F.lit(float(r)).alias("rsd"), F.col(f"_e{i}").alias("estimate")) for i, r in enumerate(rsds)]
    )
    return estimates.select(F.inline(pairs))


def sketch_to_hex(df: DataFrame, col: str = "sketch") -> DataFrame:
    return df.withColumn(col, F.hex(col))


def sketch_from_hex(df: DataFrame, col: str = "sketch") -> DataFrame:
    return df.withColumn(col, F.unhex(col))


def compare_distinct(df: DataFrame, col: str, rsd: float = 0.05, lg_k: int = 12) -> DataFrame:
    """One row: exact count, bitmap count (``col`` holds whole numbers), and the two estimates."""
    per_bucket = df.groupBy(bitmap_bucket(col).alias(BUCKET)).agg(bitmap_of(col).alias("_b"))
    by_bitmap = per_bucket.agg(F.sum(F.bitmap_count("_b")).cast("long")).scalar()
    return df.agg(
        F.countDistinct(col).alias("exact_cnt"),
        F.approx_count_distinct(col, rsd).alias("approx_cnt"),
        F.hll_sketch_estimate(F.hll_sketch_agg(col, lg_k)).alias("hll_cnt"),
    ).select("exact_cnt", by_bitmap.alias("bitmap_cnt"), "approx_cnt", "hll_cnt")
