"""Which filter removes what, in every order: wide packed counters.

Five filters give a document one of 32 masks of failures. A mask, with the two labels, decides what happens to the document
at each step of each of the 120 orders, so it maps to one big integer whose fields are those outcomes, 0 or 1. Adding the
integers of all documents of a part counts every outcome at once; a field is 64 bits wide, so no count can overflow into
the next one. Only after the last addition are the fields read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from footfall.llm.common import stored, text_rows

FILTERS = "ABCDE"
ORDERS = ["".join(o) for o in permutations(FILTERS)]
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")
STEPS = len(ORDERS) * len(FILTERS)
FIELDS = len(COUNTS) * STEPS
WIDTH = 64
#: Parts a task holds integers of before it passes them on.
HELD = 256
#: Bytes of a text whose words are held at once.
PIECE = 1 << 20

MIN_WORDS, MIN_DISTINCT, MAX_CAPITALS = 100, 80, 10
SIGNS = b"#$%&*|"
CAPITALS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
BLANKS = b" \t\n\v\f\r"


def outcomes(mask: int, good: bool, toxic: bool) -> np.ndarray:
    """0 or 1 for (count, order, step): what happens to a document that fails the filters of ``mask``."""
    out = np.zeros((len(COUNTS), len(ORDERS), len(FILTERS)), np.int64)
    for o, order in enumerate(ORDERS):
        there = True
        for s, letter in enumerate(order):
            bit = 1 << FILTERS.index(letter)
            fails = bool(mask & bit)
            goes = there and fails
            out[:, o, s] = (there and not fails, goes, fails and not there, mask == bit, goes and good, goes and toxic)
            there = there and not fails
    return out


def packed(fields: np.ndarray) -> int:
    return int.from_bytes(fields.astype("<u8").tobytes(), "little")


def unpacked(total: int) -> np.ndarray:
    return np.frombuffer(total.to_bytes(FIELDS * WIDTH // 8, "little"), "<u8").astype(np.int64).reshape(len(COUNTS), len(ORDERS), len(FILTERS))


def _words(data: bytes) -> tuple[int, int]:
    """(words, distinct words) of a text, some of its bytes at a time."""
    total, seen, at = 0, set(), 0
    while at < len(data):
        end = at + PIECE
        # A piece ends after a word.
        while end < len(data) and data[end] not in BLANKS:
            end += 1
        found = data[at:end].split()
        total += len(found)
        seen.update(found)
        at = end
    return total, len(seen)


def mask_of(text: str) -> int:
    """Bits of A to D: the filters a text fails by itself. E depends on other texts."""
    data = text.encode("utf-8", "surrogatepass")
    n, distinct = _words(data)
    capitals = len(data) - len(data.translate(None, CAPITALS))
    signs = len(data) != len(data.translate(None, SIGNS))
    return (n < MIN_WORDS) | (100 * distinct < MIN_DISTINCT * n) << 1 | (100 * capitals > MAX_CAPITALS * len(text)) << 2 | signs << 3


def _judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [t for _, t in text_rows(batch, "_text")]
        masks = pa.array([mask_of(t) for t in texts], pa.int32())
        prints = pa.array([hashlib.sha256(t.encode("utf-8", "surrogatepass")).digest() for t in texts], pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), masks, prints], ["_id", "_part", "_mask", "_print"])


def judged(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """(_id, _part, _mask, _print) per document: its failures A to D and the SHA-256 of its text."""
    slim = docs.select(F.col(doc_id).alias("_id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("_part"), F.col(text).alias("_text"))
    return slim.mapInArrow(_judged, f"_id {dict(slim.dtypes)['_id']}, _part string, _mask int, _print binary")


def cells(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """(_part, _mask, _good, _toxic, n): documents by text, part and labels, with E known.

    E fails where the same text has a smaller id. Documents are first grouped with their id among the keys, then per
    text, part and labels, where the smallest id and the documents that have it are kept; so however many copies a text
    has, at most one row per part and label of it meets the others.
    """
    marks = labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("_of")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("_good"), F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("_toxic")
    )
    # Documents without an id match no label; they are spread by where they are read.
    spread = F.when(F.col("_id").isNull(), F.spark_partition_id()).otherwise(0)
    marks = marks.withColumn("_zero", F.pmod(F.xxhash64("_of"), F.lit(1)).cast("int"))
    rows = judged(docs, doc_id, text, part).withColumn("_spread", spread)
    rows = rows.join(marks, (F.col("_id") == F.col("_of")) & (F.col("_spread") == F.col("_zero")), "left")
    rows = rows.withColumns({c: F.coalesce(F.col(c), F.lit(False)) for c in ("_good", "_toxic")})
    kind = ["_print", "_part", "_mask", "_good", "_toxic"]
    by_id = rows.groupBy(*kind, "_id").agg(F.count(F.lit(1)).alias("_n"))
    # A null id is neither smaller than another nor has it a smaller one.
    known = F.col("_id").isNotNull()
    per_text = by_id.groupBy(*kind).agg(
        F.sum(F.when(known, F.col("_n"))).alias("_n"), F.sum(F.when(~known, F.col("_n"))).alias("_free"), F.min(F.when(known, F.struct("_id", "_n"))).alias("_first"),
    )
    per_text = per_text.withColumn("_least", F.min("_first._id").over(Window.partitionBy("_print")))
    leads = F.when(F.col("_first._id") == F.col("_least"), F.col("_first._n")).otherwise(0)
    free = F.coalesce(leads, F.lit(0)) + F.coalesce(F.col("_free"), F.lit(0))
    fails = F.coalesce(F.col("_n") - leads, F.lit(0))
    e = 1 << FILTERS.index("E")
    both = F.array(F.struct(F.col("_mask").alias("_mask"), free.alias("n")), F.struct((F.col("_mask") + e).alias("_mask"), fails.alias("n")))
    return per_text.select("_part", "_good", "_toxic", F.inline(both)).where(F.col("n") > 0)


def _added(batches: Iterator[pa.RecordBatch], start: bool) -> Iterator[pa.RecordBatch]:
    """Sums of the integers per part; ``start``: of cells, else of sums."""
    one: dict[tuple, int] = {}
    total: dict[str, int] = {}

    def flush():
        size = FIELDS * WIDTH // 8
        found = [pa.array(list(total), pa.string()), pa.array([t.to_bytes(size, "little") for t in total.values()], pa.binary())]
        total.clear()
        return pa.RecordBatch.from_arrays(found, ["_part", "_sum"])

    for batch in batches:
        names = batch.schema.names
        columns = [batch.column(names.index(c)).to_pylist() for c in (("_part", "_mask", "_good", "_toxic", "n") if start else ("_part", "_sum"))]
        for row in zip(*columns):
            if row[0] not in total and len(total) >= HELD:
                yield flush()
            if start:
                key = row[1:4]
                if key not in one:
                    one[key] = packed(outcomes(*key))
                add = one[key] * row[4]
            else:
                add = int.from_bytes(row[1], "little")
            total[row[0]] = total.get(row[0], 0) + add
    if total:
        yield flush()


def _first_sums(batches):
    return _added(batches, True)


def _sums(batches):
    return _added(batches, False)


def _report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["part", "filter_order", "step", *COUNTS, "shapley"]
    for batch in _sums(batches):
        for part, total in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            found = unpacked(int.from_bytes(total, "little"))
            letters = np.array([[FILTERS.index(c) for c in o] for o in ORDERS])
            over_orders = np.zeros(len(FILTERS), np.int64)
            np.add.at(over_orders, letters.ravel(), found[COUNTS.index("removed")].ravel())
            yield pa.RecordBatch.from_arrays(
                [pa.array([part] * STEPS), pa.array(np.repeat(ORDERS, len(FILTERS)).tolist()), pa.array(np.tile(np.arange(1, 6), len(ORDERS)), pa.int32())]
                + [pa.array(f.ravel()) for f in found] + [pa.array(over_orders[letters.ravel()])],
                names,
            )


def audit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """(part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley), 600 rows a part.

    Parts are the values of ``part``, null as the empty one. A null text is the empty one, so null and empty texts are
    copies of each other. A document without an id never fails E and makes no other fail it; rows that repeat an id with
    its text do not fail E by each other. A document is good or toxic if any of its labels says so. An empty table
    gives no rows; other columns are not carried.
    """
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    schema = "_part string, _sum binary"
    sums = cells(docs, labels, doc_id, text, part).mapInArrow(_first_sums, schema)
    # One integer per task and part; a part's integers are added in as many tasks before they meet, one per task.
    sums = sums.withColumn("_z", F.spark_partition_id()).repartition(tasks, "_part", "_z").select("_part", "_sum").mapInArrow(_sums, schema)
    sums = stored(sums, "packed-sums")
    counts = ", ".join(f"{c} long" for c in (*COUNTS, "shapley"))
    met = sums.repartition(tasks, "_part").sortWithinPartitions("_part")
    return met.mapInArrow(_report, f"part string, filter_order string, step int, {counts}")
