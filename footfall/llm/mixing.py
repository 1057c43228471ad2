"""Mix sources to target weights by Pareto order sampling."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from footfall.llm.common import numbered, stored, word_count

BUCKETS = 1 << 16


def row_hash(seed: int, doc_id: str, text: str) -> Column:
    """What a document's random number hangs on."""
    return F.xxhash64(F.lit(seed), F.col(doc_id), F.col(text))


def targets(sources: DataFrame, weight: Column, budget: float, cap: float) -> DataFrame:
    """Add ``target`` to rows (source, source_size, place): shares of ``budget`` times all sizes by weight.

    A target stops at ``cap`` times its source's size; what is cut off goes to the others by weight until
    none is above. The level (target per unit of weight) rises with every round and settles once no further
    source is cut, so the loop only moves two sums to the driver each time.
    """
    rows = stored(sources.withColumns({"_w": weight.cast("double"), "_cap": F.col("source_size") * F.lit(float(cap))}), "sources")
    whole = float(rows.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]) * budget
    level, before = 0.0, -1
    while True:
        full = F.col("_cap") <= F.col("_w") * F.lit(level)
        n, taken, open_weight = rows.agg(
            F.count_if(full), F.coalesce(F.sum(F.when(full, F.col("_cap"))), F.lit(0.0)), F.coalesce(F.sum(F.when(~full, F.col("_w"))), F.lit(0.0))
        ).first()
        if n == before or open_weight == 0:
            break
        before, level = n, (whole - taken) / open_weight
    return rows.withColumn("target", F.least(F.col("_cap"), F.col("_w") * F.lit(level))).drop("_w", "_cap")


def levels(groups: DataFrame, cap: float, per_source: Callable[[DataFrame, DataFrame], DataFrame]) -> DataFrame:
    """(_s, _level): copies per unit of tilt at which a source's expected words meet its target.

    ``groups`` has (source, target, _tilt, _words, _salt). Copies stop at ``cap``: what a document cannot take goes to
    the others of its source by tilt. As with targets a level only rises, until no further document is cut.
    """
    same = F.col("source").alias("_s")
    rise = groups.select(same).distinct().withColumn("_level", F.lit(0.0))
    before = -1
    while True:
        known = per_source(groups, rise)
        full = F.col("_level") * F.col("_tilt") >= cap
        sums = known.groupBy("source").agg(
            F.max("target").alias("target"), F.sum("_words").alias("_all"), F.max("_level").alias("_level"), F.count_if(full).alias("_n"),
            F.coalesce(F.sum(F.when(full, F.col("_words"))), F.lit(0)).alias("_full"),
            F.coalesce(F.sum(F.when(~full, F.col("_words") * F.col("_tilt"))), F.lit(0.0)).alias("_open"),
        )
        # At the cap of the whole source every document is certain.
        new = F.when(F.col("target") >= F.col("_all") * cap, F.lit(float("inf"))).when(F.col("_open") > 0, (F.col("target") - cap * F.col("_full")) / F.col("_open"))
        rise = stored(sums.select(same, F.coalesce(new, F.col("_level")).alias("_level"), "_n"), "levels")
        n = rise.agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0]
        rise = rise.drop("_n")
        if n == before:
            return rise
        before = n


def mix(
    docs: DataFrame, weights: list[float], budget: float = 1.5, cap: float = 2.0, seed: int = 0,
    doc_id: str = "doc_id", text: str = "text", source: str = "source", tilt: Column | None = None,
) -> DataFrame:
    """How often each document enters the mix: (doc_id, size, source_size, target, copies, taken) and the keys.

    ``weights`` repeat over the sources in code-point order, null last. A source's ratio target / size is
    the number of copies each of its documents should get on average; with ``tilt`` (a positive column) the
    documents of a source get copies in proportion to it, up to ``cap``, at a level where their expected words
    meet the target; without it they have equal odds. The whole part is certain. The rest
    is the inclusion probability p of one more copy: documents rank by (u / (1-u)) / (p / (1-p)) with u
    uniform from the seed and the row, and the lowest ranks get a copy until the words missing to the
    target are reached, to within half a document. The sample is thus of fixed size in words.

    u hangs on (doc_id, text) alone, so reruns agree; equal rows rank together and share the same fate up
    to their number. A null text has size 0 and takes 0 words; a source with no words has target 0; an
    empty table gives no rows; other columns are not carried.

    The rank at which a source is full is found from sums over 65,536 bins of ranks; only rows of the one
    bin in which it fills are ordered, so a source that holds a third of all rows needs no sort of them.
    """
    rows = stored(
        docs.select(
            F.col(doc_id).alias("doc_id"),
            F.col(source).alias("source"),
            word_count(F.col(text)).alias("size"),
            row_hash(seed, doc_id, text).alias("_hash"),
            (tilt if tilt is not None else F.lit(1.0)).cast("double").alias("_tilt"),
        ),
        "sizes",
    )
    sums = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = [F.col("source").isNull().cast("int"), F.col("source")]
    placed = numbered(sums, order, "place")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    aims = stored(targets(placed, weight, budget, cap), "targets")
    same = F.col("source").eqNullSafe(F.col("_s"))
    salts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def per_source(left: DataFrame, facts: DataFrame) -> DataFrame:
        """Join a row of facts per source; the facts are repeated per salt, so no source's rows meet in one task."""
        spread = facts.withColumn("_z", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        return left.join(spread, same & (F.col("_salt") == F.col("_z"))).drop("_s", "_z")

    rows = rows.withColumn("_salt", F.pmod("_hash", F.lit(salts)).cast("int"))
    facts = aims.select(F.col("source").alias("_s"), "source_size", "target", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0)).alias("_level"))
    if tilt is not None:
        groups = rows.where(F.col("size") > 0).groupBy("source", "_tilt").agg(F.sum("size").alias("_words"))
        groups = groups.withColumn("_salt", F.pmod(F.xxhash64("_tilt"), F.lit(salts)).cast("int"))
        groups = stored(per_source(groups, facts.select("_s", "target")), "groups")
        level = levels(groups, float(cap), per_source).withColumnRenamed("_s", "_of")
        facts = facts.drop("_level").join(level, F.col("_s").eqNullSafe(F.col("_of")), "left").drop("_of").fillna(0.0, ["_level"])
        facts = stored(facts, "facts")
    joined = per_source(rows, facts)
    copies = F.least(F.lit(float(cap)), F.col("_level") * F.col("_tilt"))
    # Uniform in (0, 1): the middle of one of 2^53 steps.
    u = (F.shiftrightunsigned(F.col("_hash"), 11).cast("double") + 0.5) / F.lit(float(1 << 53))
    parted = joined.withColumn("_copies", copies).withColumn("_sure", F.floor("_copies").cast("long"))
    p = F.col("_copies") - F.col("_sure")
    odds = (u / (1 - u)) * ((1 - p) / p)
    ranked = parted.withColumn("_rank", F.when((p > 0) & (F.col("size") > 0), odds / (1 + odds)))
    ranked = ranked.withColumn("_bin", F.least(F.floor(F.col("_rank") * BUCKETS), F.lit(BUCKETS - 1)).cast("int"))

    sure = ranked.groupBy("source").agg(F.sum(F.col("_sure") * F.col("size")).alias("_given"))
    missing = aims.join(sure.select(F.col("source").alias("_s"), "_given"), same).select(
        "source", (F.col("target") - F.col("_given")).alias("_missing")
    )
    bins = ranked.where(F.col("_bin").isNotNull()).groupBy("source", "_bin").agg(F.sum("size").alias("_words"))
    upto = Window.partitionBy("source").orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    # At most 65,536 rows of a source are ordered here.
    filled = (
        bins.withColumn("_before", F.coalesce(F.sum("_words").over(upto), F.lit(0)))
        .join(missing.select(F.col("source").alias("_s"), "_missing"), same)
        .where((F.col("_before") <= F.col("_missing")) & (F.col("_before") + F.col("_words") > F.col("_missing")))
        .select(F.col("_s"), F.col("_bin").alias("_full"), (F.col("_missing") - F.col("_before")).alias("_left"))
    )
    # A source without such a bin has words enough for none or for all of its ranks.
    edge = missing.select("source", "_missing").join(filled, same, "left").select(
        F.col("source").alias("_s"),
        F.coalesce("_full", F.when(F.col("_missing") > 0, F.lit(BUCKETS)).otherwise(F.lit(-1))).alias("_full"),
        F.coalesce("_left", F.lit(0.0)).alias("_left"),
    )
    known = per_source(ranked, edge)
    inside = known.where(F.col("_bin") == F.col("_full"))
    running = Window.partitionBy("source").orderBy("_rank", "doc_id", "_hash", "size").rowsBetween(Window.unboundedPreceding, -1)
    # Taking a document as long as its middle lies before the end leaves half a document at most.
    inside = inside.withColumn("_extra", (F.coalesce(F.sum("size").over(running), F.lit(0)) + F.col("size") / 2 <= F.col("_left")).cast("long"))
    outside = known.where(F.col("_bin").isNull() | (F.col("_bin") != F.col("_full"))).withColumn(
        "_extra", F.coalesce((F.col("_bin") < F.col("_full")).cast("long"), F.lit(0).cast("long"))
    )
    total = F.col("_sure") + F.col("_extra")
    return inside.unionByName(outside).select(
        "doc_id", "source", "size", "source_size", "target", total.alias("copies"), (total * F.col("size")).alias("taken"), F.col("_hash").alias("row_hash")
    )


def by_length(text: str = "text") -> Column:
    """A tilt: the square root of a text's words, so that longer texts enter more often."""
    return F.sqrt(F.greatest(word_count(F.col(text)), F.lit(1)).cast("double"))


def mixed(docs: DataFrame, weights: list[float], budget: float = 1.5, cap: float = 2.0, seed: int = 0, tilt: Column | None = None) -> DataFrame:
    """The mix itself: the rows of ``docs`` with all their columns, each as often as it is taken.

    Equal rows share the copies of all of them.
    """
    chosen = mix(docs, weights, budget, cap, seed, tilt=tilt).groupBy(F.col("row_hash").alias("_row")).agg(F.sum("copies").alias("_copies"))
    rows = docs.withColumn("_row", row_hash(seed, "doc_id", "text")).join(chosen.where(F.col("_copies") > 0), "_row")
    once = rows.dropDuplicates(["_row"])
    return once.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), "_copies"))).select(*docs.columns)
