"""Mergeable distinct counts."""

from pyspark.sql import functions as F

from catalog.base import Registry, table
from footfall.functions.columns import first_k, flatten_distinct
from footfall.operators import sketch

QUERIES = Registry()
KEYS = ["l_returnflag", "l_linestatus"]


def lines(spark, sf):
    return table(spark, sf, "lineitem")


@QUERIES.add(
    "bitmap_base",
    """SELECT l_returnflag, l_linestatus, CASE WHEN l_orderkey > 0 THEN 1 + (l_orderkey - 1) // 32768 ELSE 0 END AS bucket,
         count(DISTINCT l_orderkey) AS members
       FROM lineitem GROUP BY ALL""",
)
def base(spark, sf):
    sets = sketch.bitmap_base(lines(spark, sf), "l_orderkey", KEYS)
    return sets.select(*KEYS, "bucket", F.bitmap_count("bitmap").alias("members"))


@QUERIES.add(
    "bitmap_cardinality",
    "SELECT l_returnflag, l_linestatus, count(DISTINCT l_partkey) AS cardinality FROM lineitem GROUP BY ALL",
)
def cardinality(spark, sf):
    return sketch.bitmap_cardinality(sketch.bitmap_base(lines(spark, sf), "l_partkey", KEYS), KEYS)


@QUERIES.add(
    "bitmap_merge",
    "SELECT l_returnflag, count(DISTINCT l_orderkey) AS cardinality FROM lineitem GROUP BY ALL",
)
def merge(spark, sf):
    finest = sketch.bitmap_base(lines(spark, sf), "l_orderkey", KEYS)
    return sketch.bitmap_cardinality(sketch.bitmap_merge(finest, ["l_returnflag"]), ["l_returnflag"])


@QUERIES.add(
    "bitmap_null_ids",
    """SELECT c_mktsegment, count(DISTINCT CASE WHEN o_orderstatus = 'F' THEN o_orderkey END) AS cardinality
       FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY ALL""",
)
def null_ids(spark, sf):
    rows = table(spark, sf, "customer").join(
        table(spark, sf, "orders").where("o_orderstatus = 'F'"), F.col("o_custkey") == F.col("c_custkey"), "left"
    )
    return sketch.bitmap_cardinality(sketch.bitmap_base(rows, "o_orderkey", ["c_mktsegment"]), ["c_mktsegment"])


@QUERIES.add(
    "first_members",
    """SELECT l_returnflag, l_linestatus, l_suppkey, rank FROM (
         SELECT *, row_number() OVER (PARTITION BY l_returnflag, l_linestatus ORDER BY l_suppkey) AS rank
         FROM (SELECT DISTINCT l_returnflag, l_linestatus, l_suppkey FROM lineitem)) WHERE rank <= 10""",
)
def first_members(spark, sf):
    return sketch.first_members(lines(spark, sf), KEYS, "l_suppkey", 10)


@QUERIES.add(
    "first_k_of_array",
    """SELECT doc_id, array_to_string(list_sort(list_distinct(string_split(text, ' ')))[1:5], '|') AS words FROM documents""",
)
def first_words(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id", F.array_join(first_k(F.split("text", " "), 5), "|").alias("words")
    )


@QUERIES.add(
    "set_union",
    "SELECT DISTINCT lang, source, unnest(string_split(text, ' ')) AS word FROM documents",
)
def union(spark, sf):
    words = table(spark, sf, "documents").withColumn("words", F.split("text", " "))
    return sketch.set_union(words, ["lang", "source"], "words", "word")


@QUERIES.add(
    "flatten_distinct",
    """SELECT doc_id, len(list_distinct(flatten(list_transform(string_split(text, chr(10)), lambda l: string_split(l, ' ')))))::BIGINT AS words
       FROM documents""",
)
def flatten(spark, sf):
    nested = F.transform(F.split("text", "\n"), lambda line: F.split(line, " "))
    return table(spark, sf, "documents").select("doc_id", F.size(flatten_distinct(nested)).cast("long").alias("words"))


def checked(sketches, exact, keys, col, bound):
    """Exact count and whether the estimate is within the bound."""
    return sketches.join(exact, keys).select(
        *keys, "exact_cnt", (F.abs(F.hll_sketch_estimate(col) - F.col("exact_cnt")) <= F.col("exact_cnt") * bound).alias("within_bound")
    )


# Three standard errors of a sketch with 2**12 buckets.
HLL_BOUND = 3 * 1.04 / 64
BY_FLAG = "SELECT l_returnflag, count(DISTINCT l_partkey) AS exact_cnt, TRUE AS within_bound FROM lineitem GROUP BY l_returnflag"


def exact_parts(spark, sf, keys):
    return lines(spark, sf).groupBy(*keys).agg(F.countDistinct("l_partkey").alias("exact_cnt"))


@QUERIES.add("hll_estimate", BY_FLAG)
def hll(spark, sf):
    sketches = sketch.hll_base(lines(spark, sf), "l_partkey", ["l_returnflag"])
    return checked(sketches, exact_parts(spark, sf, ["l_returnflag"]), ["l_returnflag"], "sketch", HLL_BOUND)


@QUERIES.add("hll_merge", BY_FLAG)
def hll_merge(spark, sf):
    merged = sketch.hll_merge(sketch.hll_base(lines(spark, sf), "l_partkey", KEYS), ["l_returnflag"])
    return checked(merged, exact_parts(spark, sf, ["l_returnflag"]), ["l_returnflag"], "sketch", HLL_BOUND)


@QUERIES.add(
    "hll_collection",
    """SELECT lang, count(DISTINCT word) AS exact_cnt, TRUE AS within_bound
       FROM (SELECT lang, unnest(string_split(text, ' ')) AS word FROM documents) GROUP BY lang""",
)
def hll_collection(spark, sf):
    docs = table(spark, sf, "documents").select("lang", F.split("text", " ").alias("words"))
    exact = docs.select("lang", F.explode("words").alias("w")).groupBy("lang").agg(F.countDistinct("w").alias("exact_cnt"))
    return checked(sketch.hll_collection(docs, ["lang"], "words"), exact, ["lang"], "sketch", HLL_BOUND)


@QUERIES.add("hll_row_merge", BY_FLAG)
def hll_row_merge(spark, sf):
    halves = lines(spark, sf).groupBy("l_returnflag").agg(
        F.hll_sketch_agg(F.when(F.col("l_linestatus") == "F", F.col("l_partkey"))).alias("a"),
        F.hll_sketch_agg(F.when(F.col("l_linestatus") != "F", F.col("l_partkey"))).alias("b"),
    )
    merged = halves.select("l_returnflag", sketch.hll_row_merge("a", "b").alias("sketch"))
    return checked(merged, exact_parts(spark, sf, ["l_returnflag"]), ["l_returnflag"], "sketch", HLL_BOUND)


@QUERIES.add("sketch_hex", BY_FLAG)
def hex_text(spark, sf):
    stored = sketch.sketch_to_hex(sketch.hll_base(lines(spark, sf), "l_partkey", ["l_returnflag"]))
    back = sketch.sketch_from_hex(stored)
    return checked(back, exact_parts(spark, sf, ["l_returnflag"]), ["l_returnflag"], "sketch", HLL_BOUND)


@QUERIES.add(
    "overlap_estimate",
    """SELECT (SELECT count(DISTINCT l_suppkey) FROM lineitem WHERE l_returnflag = 'A') AS size_a,
              (SELECT count(DISTINCT l_suppkey) FROM lineitem WHERE l_returnflag = 'R') AS size_b,
              (SELECT count(DISTINCT l_suppkey) FROM lineitem WHERE l_returnflag IN ('A', 'R')) AS size_union,
              (SELECT count(*) FROM (SELECT l_suppkey FROM lineitem WHERE l_returnflag = 'A'
                 INTERSECT SELECT l_suppkey FROM lineitem WHERE l_returnflag = 'R')) AS size_both""",
)
def overlap(spark, sf):
    rows = lines(spark, sf)
    return sketch.overlap_estimate(rows.where("l_returnflag = 'A'"), rows.where("l_returnflag = 'R'"), "l_suppkey")


RSDS = [0.005, 0.01, 0.02, 0.05, 0.1]


@QUERIES.add(
    "approx_distinct_sweep",
    """SELECT rsd, n AS exact_cnt, TRUE AS within_bound FROM (SELECT count(DISTINCT l_partkey) AS n FROM lineitem),
       (SELECT unnest([0.005e0, 0.01e0, 0.02e0, 0.05e0, 0.1e0]) AS rsd)""",
)
def sweep(spark, sf):
    exact = lines(spark, sf).agg(F.countDistinct("l_partkey")).scalar()
    got = sketch.approx_distinct(lines(spark, sf), "l_partkey", RSDS).withColumn("exact_cnt", exact)
    return got.select(
        "rsd", "exact_cnt",
        (F.abs(F.col("estimate") - F.col("exact_cnt")) <= 3 * F.col("rsd") * F.col("exact_cnt")).alias("within_bound"),
    )


@QUERIES.add(
    "compare_distinct",
    """SELECT n AS exact_cnt, n AS bitmap_cnt, TRUE AS approx_ok, TRUE AS hll_ok
       FROM (SELECT count(DISTINCT l_orderkey) AS n FROM lineitem)""",
)
def compare(spark, sf):
    row = sketch.compare_distinct(lines(spark, sf), "l_orderkey")

    def near(col, bound):
        return F.abs(F.col(col) - F.col("exact_cnt")) <= bound * F.col("exact_cnt")

    return row.select(
        "exact_cnt", "bitmap_cnt", near("approx_cnt", 0.15).alias("approx_ok"), near("hll_cnt", HLL_BOUND).alias("hll_ok")
    )
