"""Near-duplicate texts by SimHash fingerprints and a pigeonring filter."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from footfall.llm.common import forget, stored, text_rows, words
from footfall.llm.components import components

#: Shingles whose bits are unpacked at once.
BLOCK = 1 << 15
#: Candidate pairs checked at once, and fingerprints of one key compared within one task.
PAIRS = 1 << 20
CELL = 4096


def fingerprint(tokens: list[bytes], shingle: int, seed: int) -> int:
    """A bit is 1 if over half of the shingles' hashes have it; no words give 0."""
    if not tokens:
        return 0
    joined = b" ".join(tokens)
    ends = list(accumulate((len(w) + 1 for w in tokens), initial=0))
    span = min(shingle, len(tokens))
    count = len(tokens) - span + 1
    ones = np.zeros(64, np.int64)
    hashed = xxhash.xxh64_intdigest
    for lo in range(0, count, BLOCK):
        hi = min(count, lo + BLOCK)
        h = np.fromiter(
            (hashed(joined[s : e - 1], seed) for s, e in zip(ends[lo:hi], ends[lo + span : hi + span])), np.uint64, hi - lo
        )
        bits = np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(0, dtype=np.int64)
    return int(sum(1 << i for i in np.flatnonzero(2 * ones > count).tolist()))


def fingerprints(docs: DataFrame, shingle: int, seed: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fp): the fingerprint of every whole text as a signed 64-bit number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in batches:
            found = [fingerprint(words(t), shingle, seed) for _, t in text_rows(batch, "_text")]
            fps = pa.array(np.array(found, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), fps], ["doc_id", "fp"])

    slim = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("_text"))
    kind = dict(slim.dtypes)["doc_id"]
    return slim.mapInArrow(run, f"doc_id {kind}, fp long")


class Ring:
    """64 bits cut into ``bits + 1`` segments on a ring.

    If two fingerprints differ in at most t bits over m segments, some start has every chain of l
    consecutive segments differ in at most l * t / m bits. With m = t + 1 the first segment of such a chain
    is equal and the first two differ in one bit at most: that is what keys are made of.
    """

    def __init__(self, bits: int) -> None:
        self.bits, self.m = bits, bits + 1
        at = [64 * i // self.m for i in range(self.m + 1)]
        self.masks = [((1 << (at[i + 1] - at[i])) - 1) << at[i] for i in range(self.m)]
        self.cuts = at

    def keys(self, fps: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(key, fp, probe): one stored key per start, and one probe per zero bit of the second segment.

        Of two fingerprints that differ in one bit of that segment, exactly one has a zero there.
        """
        for i in range(self.m):
            second = (i + 1) % self.m
            kept = np.uint64(self.masks[i] | self.masks[second])
            tag = np.uint64(i + 1) * np.uint64(0x9E3779B97F4A7C15)
            base = fps & kept
            yield base ^ tag, fps, np.zeros(len(fps), bool)
            if self.m > 1:
                for b in range(self.cuts[second], self.cuts[second + 1]):
                    bit = np.uint64(1) << np.uint64(b)
                    at = np.flatnonzero((fps & bit) == 0)
                    yield (base[at] | bit) ^ tag, fps[at], np.ones(len(at), bool)

    def linked(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Chains of growing length first, the full distance for those that are left."""
        diff = a ^ b
        parts = np.stack([np.bitwise_count(diff & np.uint64(m)) for m in self.masks])
        alive = np.zeros(len(a), bool)
        for start in range(self.m):
            ok, total = np.ones(len(a), bool), np.zeros(len(a), np.int64)
            for step in range(self.m):
                total = total + parts[(start + step) % self.m]
                ok &= total <= (step + 1) * self.bits // self.m
            alive |= ok
        alive[alive] &= np.bitwise_count(diff[alive]) <= self.bits
        return alive


def _reduce(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """As few links as connect the same nodes: each node to the smallest one it reaches."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    i, j = at[: len(a)], at[len(a) :]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[i], root[j])
        new = root.copy()
        np.minimum.at(new, root[i], low)
        np.minimum.at(new, root[j], low)
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        new = new[new]
        if (new == root).all():
            break
        root = new
    moved = root != np.arange(len(nodes))
    return nodes[moved], nodes[root[moved]]


def _runs(key: np.ndarray, fp: np.ndarray, probe: np.ndarray, ring: Ring) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links among rows that share a key; rows are sorted by key, stored ones before probes."""
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    size = np.diff(np.append(first, len(key)))
    held = np.add.reduceat((~probe).astype(np.int64), first)
    # Each row meets the stored rows of its key that stand before it.
    run = np.repeat(np.arange(len(first)), size)
    place = np.arange(len(key)) - first[run]
    partners = np.where(probe, held[run], place)
    todo = np.flatnonzero(partners)
    if not len(todo):
        return
    upto = np.cumsum(partners[todo])
    lo = 0
    while lo < len(todo):
        hi = max(lo + 1, int(np.searchsorted(upto, (upto[lo - 1] if lo else 0) + PAIRS, "right")))
        rows = todo[lo:hi]
        count = partners[rows]
        left = np.repeat(rows, count)
        right = first[run[left]] + (np.arange(len(left)) - np.repeat(np.cumsum(count) - count, count))
        ok = ring.linked(fp[left], fp[right])
        if ok.any():
            yield fp[left][ok], fp[right][ok]
        lo = hi


def links(distinct: DataFrame, bits: int) -> DataFrame:
    """(a, b): links that connect exactly the fingerprints connected by pairs within ``bits`` bits.

    ``distinct`` has one column ``fp`` without repeats. Rows meet by key; within a task pairs are checked in
    numpy and leave it as a spanning set, so a crowded key costs comparisons but never a row per pair. A key
    with more than 4,096 rows is cut: its rows are spread over cells, and each pair of cells is a group of
    its own, so every pair still meets.
    """
    ring = Ring(bits)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            for lo in range(0, len(fps), 1 << 14):
                parts = list(ring.keys(fps[lo : lo + (1 << 14)]))
                key, fp, probe = (np.concatenate(x) for x in zip(*parts))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key.view(np.int64)), pa.array(fp.view(np.int64)), pa.array(probe)], ["key", "fp", "probe"]
                )

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Rows arrive sorted; a run that may go on in the next batch is kept back.
        rest = None
        names = ["group", "fp", "probe"]

        def solve(cols):
            for a, b in _runs(cols[0], cols[1].view(np.uint64), cols[2], ring):
                x, y = _reduce(a, b)
                yield pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)), pa.array(y.view(np.int64))], ["a", "b"])

        for batch in batches:
            cols = [batch.column(batch.schema.get_field_index(n)).to_numpy(zero_copy_only=False) for n in names]
            if not len(cols[0]):
                continue
            if rest is not None:
                cols = [np.concatenate([r, c]) for r, c in zip(rest, cols)]
            last = int(np.searchsorted(cols[0], cols[0][-1]))
            rest = [c[last:] for c in cols]
            if last:
                yield from solve([c[:last] for c in cols])
        if rest is not None:
            yield from solve(rest)

    rows = distinct.select("fp").mapInArrow(emit, "key long, fp long, probe boolean")
    sizes = stored(rows.groupBy("key").agg(F.count_if(~F.col("probe")).alias("held"), F.count(F.lit(1)).alias("n")).where((F.col("held") > 0) & (F.col("n") > 1)), "keys")
    rows = rows.join(sizes, "key")
    cells = F.ceil(F.col("n") / CELL).cast("long")
    rows = rows.withColumn("cells", cells).withColumn("cell", F.pmod(F.xxhash64("fp"), F.col("cells")))
    # Cell x of c meets cell y in the group (min, max): a row of cell x belongs to c groups.
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("cells") - 1))
    rows = rows.withColumn("other", other).select(
        F.xxhash64("key", F.least("cell", "other"), F.greatest("cell", "other")).alias("group"), "fp", "probe"
    )
    grouped = rows.repartition("group").sortWithinPartitions("group", "probe")
    return grouped.mapInArrow(match, "a long, b long")


def near_duplicates(
    docs: DataFrame, shingle: int, bits: int, seed: int = 42, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row: texts whose fingerprints chain within ``bits`` bits.

    Texts are lower-cased (A-Z) and cut into words; fewer words than a shingle form one shingle, none give
    the fingerprint zero (null text too), which links like any other. ``component_id`` is the smallest
    doc_id reachable; a component of null ids only has null. Equal fingerprints are one node, so copies
    never meet in pairs; repeated rows give repeated rows. An empty table gives no rows.
    """
    rows = stored(fingerprints(docs, shingle, seed, doc_id, text), "fingerprints")
    nodes = rows.groupBy("fp").agg(F.min("doc_id").alias("least"))
    roots = components(links(nodes, bits), "a", "b")
    labelled = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = labelled.groupBy("root").agg(F.min("least").alias("component_id"))
    of_fp = stored(labelled.join(least, "root").select("fp", "component_id"), "classes")
    return rows.join(of_fp, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def first_of_each(docs: DataFrame, shingle: int, bits: int) -> DataFrame:
    """One row of each group, all columns as they are: that with the smallest doc_id.

    Where an id has several texts of a group, that with the smallest xxhash64 of the text leads; of rows that
    agree in doc_id and text any one stays. A document without an id goes by its text and leads a group only
    if no member has an id.
    """
    stand_in = F.xxhash64(F.lit(1), F.col("text")).bitwiseAND(F.lit((1 << 62) - 1)) + F.lit(1 << 62)
    row = F.struct(F.coalesce(F.col("doc_id").cast("long"), stand_in).alias("doc"), F.xxhash64("text").alias("text"))
    keyed = docs.withColumn("_key", row)
    classes = near_duplicates(keyed, shingle, bits, doc_id="_key")
    lead = classes.where(F.col("doc_id") == F.col("component_id")).select(F.col("doc_id").alias("_key"))
    return keyed.join(lead, "_key", "left_semi").dropDuplicates(["_key"]).select(*docs.columns)
