"""Vector code compression: a vector becomes one codebook index per part, found by slicing and intersecting bit masks.

A part's nearest entry is searched exactly. Per dimension the entries are sorted by their coordinate, and prefix masks say
which entries lie before each place of that order; the entries within a radius of a query are then two binary searches and
one exclusive or. The masks of all dimensions, ANDed as 64-bit words, leave the entries inside a box around the query. The
first radius is the distance to an entry already looked at, so the box holds the nearest entry and every tie with it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from footfall.llm.common import stored

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256


class Slices:
    """Entries of one part, sorted per dimension, with prefix masks over each order."""

    def __init__(self, entries: np.ndarray) -> None:
        self.entries = entries
        self.order = np.argsort(entries, axis=0, kind="stable")
        self.sorted = np.ascontiguousarray(np.take_along_axis(entries, self.order, 0).T)
        bits = np.left_shift(np.uint64(1), self.order.astype(np.uint64))
        self.prefix = np.zeros((entries.shape[1], len(entries) + 1), np.uint64)
        self.prefix[:, 1:] = np.bitwise_or.accumulate(bits, axis=0).T

    def _distance(self, x: np.ndarray, entry: np.ndarray) -> np.ndarray:
        gap = x - self.entries[entry]
        return np.einsum("ij,ij->i", gap, gap)

    def radius(self, x: np.ndarray) -> np.ndarray:
        """A distance within which each row has an entry: to the best of the entries next to it in one dimension."""
        best = None
        for d, values in enumerate(self.sorted):
            place = np.minimum(np.searchsorted(values, x[:, d]), len(values) - 1)
            found = self._distance(x, self.order[place, d])
            best = found if best is None else np.minimum(best, found)
        # Rounded up: a box that is too large by one loses nothing.
        return np.sqrt(best.astype(np.float64)).astype(np.int64) + 1

    def inside(self, x: np.ndarray, radius: np.ndarray) -> np.ndarray:
        """Mask per row of the entries that no dimension puts further away than ``radius``."""
        mask = np.full(len(x), ~np.uint64(0))
        for d, values in enumerate(self.sorted):
            low = np.searchsorted(values, x[:, d] - radius, "left")
            high = np.searchsorted(values, x[:, d] + radius, "right")
            mask &= self.prefix[d, high] ^ self.prefix[d, low]
        return mask

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(entry, squared distance) per row; ties go to the lower entry."""
        if not x.shape[0]:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        mask = self.inside(x, self.radius(x))
        set_bits = np.unpackbits(mask.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        row, entry = np.nonzero(set_bits)
        found = self._distance(x[row], entry)
        first = np.searchsorted(row, np.arange(len(x)))
        best = np.minimum.reduceat(found, first)
        return np.minimum.reduceat(np.where(found == best[row], entry, len(self.entries)), first), best


def _checked(x: np.ndarray) -> np.ndarray:
    top = max(int(x.max()), -int(x.min())) if x.size else 0
    if x.shape[1] * (2 * top) ** 2 >= 1 << 63:
        raise ValueError("components too large: squared distances would not fit 64 bits")
    return x


def integers(rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str | None = "label", scale: int = SCALE) -> DataFrame:
    """(_id, _label, _v): components as floor(scale * x).

    Rows without a vector, and vectors with null or non-finite components or no component at all, are left out.
    """
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    whole = F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("long"))
    group = F.col(label) if label else F.lit(None).cast("int")
    slim = rows.select(F.col(vec_id).alias("_id"), group.alias("_label"), whole.alias("_v"), bad.alias("_bad"))
    return slim.where(F.col("_v").isNotNull() & (F.size("_v") > 0) & ~F.col("_bad")).drop("_bad")


def _parts(column: pa.Array, parts: int) -> np.ndarray:
    """Vectors of a batch as (part, row, place)."""
    n = len(column)
    x = _checked(column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(n, -1))
    return x.reshape(n, parts, -1).transpose(1, 0, 2)


def _refined(whole: DataFrame, books: np.ndarray) -> np.ndarray:
    """The codebooks after one round: every entry the floor of the mean of its parts; unused entries stay."""
    parts, entries, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = [Slices(b) for b in books]
        sums, counts = np.zeros((parts, entries, width), np.int64), np.zeros((parts, entries), np.int64)
        for batch in batches:
            for p, x in enumerate(_parts(batch.column(0), parts)):
                entry, _ = index[p].nearest(x)
                np.add.at(sums[p], entry, x)
                counts[p] += np.bincount(entry, minlength=entries)
        p, e = np.nonzero(counts)
        if len(p):
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(a, width)) for a in (p, e)]
                + [pa.array(np.tile(np.arange(width), len(p))), pa.array(sums[p, e].ravel()), pa.array(np.repeat(counts[p, e], width))],
                ["p", "e", "d", "s", "n"],
            )

    # One row per component of the codebooks comes back, however many vectors there are.
    added = whole.select("_v").mapInArrow(run, "p long, e long, d long, s long, n long")
    out = books.copy()
    for r in added.groupBy("p", "e", "d").agg(F.sum("s").alias("s"), F.sum("n").alias("n")).collect():
        out[r["p"], r["e"], r["d"]] = r["s"] // r["n"]
    return out


def fit(whole: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> np.ndarray:
    """Codebooks as (part, entry, place) over rows of ``integers``.

    They start as the parts of the smallest ids (null ids last, ties by the vector), fewer if there are fewer rows.
    """
    if not 0 < entries <= 64:
        raise ValueError("a mask has 64 bits: 1 to 64 entries")
    low, high = whole.agg(F.min(F.size("_v")), F.max(F.size("_v"))).first()
    if low != high or (low or 0) % parts:
        raise ValueError(f"vectors of {low} to {high} numbers cannot be cut into {parts} equal parts")
    first = whole.orderBy(F.col("_id").asc_nulls_last(), "_v").limit(entries).select("_v").collect()
    if not first:
        return np.zeros((parts, 0, 0), np.int64)
    books = _checked(np.array([r["_v"] for r in first], np.int64)).reshape(len(first), parts, -1).transpose(1, 0, 2)
    for _ in range(rounds):
        books = _refined(whole, books)
    return books


def encode(whole: DataFrame, books: np.ndarray) -> DataFrame:
    """(_id, _label, code, error): entry of each part as two hex digits, and the squared distances added up."""
    parts = len(books)
    types = dict(whole.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = [Slices(b) for b in books]
        for batch in batches:
            found = [index[p].nearest(x) for p, x in enumerate(_parts(batch.column(2), parts))]
            code = np.stack([entry for entry, _ in found], 1).astype(np.uint8)
            error = sum(distance for _, distance in found)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([c.tobytes().hex() for c in code], pa.string()), pa.array(error, pa.int64())],
                ["_id", "_label", "code", "error"],
            )

    return whole.mapInArrow(run, f"_id {types['_id']}, _label {types['_label']}, code string, error long")


def decode(codes: DataFrame, books: np.ndarray, scale: int = SCALE, code: str = "code", out: str = "vector") -> DataFrame:
    """Add ``out``: the vector a code stands for, each component the middle of its step."""
    entry = F.transform(F.sequence(F.lit(0), F.lit(len(books) - 1)), lambda p: F.conv(F.substring(F.col(code), p * 2 + 1, F.lit(2)), 16, 10).cast("int"))
    # The codebooks are one small constant: parts x entries x width numbers.
    table = F.lit(((books + 0.5) / scale).reshape(-1).tolist())
    _, entries, width = books.shape
    at = F.sequence(F.lit(1), F.lit(width))
    value = F.flatten(F.transform(entry, lambda e, p: F.transform(at, lambda d: F.element_at(table, (p * entries + e) * width + d))))
    return codes.withColumn(out, value)


def digest(books: np.ndarray) -> str:
    """SHA-256 of all components in decimal, by part, entry and place."""
    return hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()


def _with_group_total(coded: DataFrame, out: str) -> DataFrame:
    """Add ``out``: the errors of all rows with the same label.

    A label with more than a thousandth of the rows is one of fewer than a thousand such, so those are broadcast;
    of the other labels none is large, and they are joined by a shuffle.
    """
    totals = stored(coded.groupBy(F.col("_label").alias("_l")).agg(F.sum("error").alias(out), F.count(F.lit(1)).alias("_n")), "label-errors")
    rows = totals.agg(F.sum("_n")).first()[0] or 0
    large = F.col("_n") * 1000 > rows
    same: Column = F.col("_label").eqNullSafe(F.col("_l"))
    hot = F.broadcast(totals.where(large).drop("_n"))
    cold = totals.where(~large).drop("_n")
    return coded.join(hot, same).drop("_l").unionByName(coded.join(hot, same, "left_anti").join(cold, same).drop("_l"))


def compress(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE,
             vec_id: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) of every vector that can be encoded.

    Null vectors, empty ones and those with null or non-finite components are dropped; zero vectors take part. A null id
    is encoded like any other and stands last among the starting entries; repeated rows give repeated rows; null labels
    form one group; other columns, whatever their names, are not carried. No vector gives no row. Vectors of unequal
    length, of a length ``parts`` does not divide, or with components whose squares overflow raise.
    """
    whole = stored(integers(rows, vec_id, vector, label, scale), "integers")
    books = fit(whole, parts, entries, rounds)
    coded = stored(encode(whole, books), "codes")
    out = _with_group_total(coded, "label_error").withColumn("codebooks_sha256", F.lit(digest(books)))
    return out.select(F.col("_id").alias("vec_id"), "code", "error", "label_error", "codebooks_sha256")
