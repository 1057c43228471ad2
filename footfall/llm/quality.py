"""Quality classifier: random-indexing word vectors, pooled, under a two-layer network."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator
from functools import partial
from itertools import count

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, FloatType, StructField, StructType

from footfall.llm.classify import Adam, kept, sample, scored, sigmoid
from footfall.llm.common import forget, stored, total_bytes

#: Numbers of a word's vector; signed ones in its index vector; neighbours on either side, in words.
DIM, ONES, WINDOW = 32, 4, 2
#: A chunk of texts ends at so many characters or so many different words; where texts travel along it is a quarter.
CHUNK, VOCABULARY = 64 << 20, 1 << 20
CARRIED = CHUNK // 4
#: Bytes of text for each part of the hash space.
PART = 32 << 20
#: More tasks than these do not help a shuffle.
TASKS = 100_000
#: Bound of the training sample (a documented parameter); share of it that sets the temperature.
LABELLED, CALIBRATION = 10_000, 0.2
HIDDEN, EPOCHS, RATE, DECAY = 32, 300, 0.01, 1e-3
BLOCK = 1 << 16
SIZE = 2 * DIM + 3
#: Pooled numbers, between -1 and 1, are stored to the nearest multiple of this.
GRID = 2.0**-14


class Words:
    """The words of a chunk of texts as numbers, in the order of their 64-bit hashes.

    A word goes by its hash: any two of n words share one with a chance of n^2 / 2^65.
    """

    def __init__(self) -> None:
        self.seen: dict[str, int] = defaultdict(count().__next__)
        self.found: list[np.ndarray] = []
        self.size = 0

    def add(self, text: str | None) -> None:
        tokens = text.split() if text else []
        self.found.append(np.fromiter(map(self.seen.__getitem__, tokens), np.int32, len(tokens)))
        self.size += len(text) if text else 0

    def close(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hashes of the words, the words of all texts by number, and how many each text has."""
        own = np.fromiter((xxhash.xxh64_intdigest(w.encode("utf-8", "surrogatepass")) for w in self.seen), np.uint64, len(self.seen))
        self.seen.clear()
        hashes, place = np.unique(own, return_inverse=True)
        lengths = np.array([len(f) for f in self.found], np.int32)
        seq = np.concatenate([np.zeros(0, np.int32), *self.found])
        self.found.clear()
        return hashes, place.astype(np.int32)[seq], lengths


def cuts(hashes: np.ndarray, parts: int) -> list[int]:
    """Where the words of each part of the hash space begin, and the end."""
    edges = np.array([(i << 64) // parts for i in range(1, parts)], np.uint64)
    return [0, *np.searchsorted(hashes, edges).tolist(), len(hashes)]


def index_vectors(hashes: np.ndarray) -> np.ndarray:
    """Each word's own sparse vector of signed ones, read off its hash; a last row of zeros, of a gap."""
    out = np.zeros((len(hashes) + 1, DIM), np.int8)
    rows = np.arange(len(hashes))
    for j in range(ONES):
        bits = hashes >> np.uint64(6 * j)
        out[rows, (bits & np.uint64(DIM - 1)).astype(np.int64)] += np.where(bits & np.uint64(DIM), 1, -1).astype(np.int8)
    return out


def context_sums(hashes: np.ndarray, seq: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """For each word the sum of its neighbours' index vectors over all places where it stands."""
    index = index_vectors(hashes)
    out = np.zeros((len(index), DIM), np.int32)
    # Gaps stand before, between and after the texts.
    starts = np.cumsum(lengths, dtype=np.int64) - lengths
    spaced = np.insert(seq, np.repeat(np.append(starts, len(seq)), WINDOW), len(hashes))
    for lo in range(WINDOW, len(spaced) - WINDOW, BLOCK):
        hi = min(lo + BLOCK, len(spaced) - WINDOW)
        near = sum(index[spaced[lo + d : hi + d]] for d in range(-WINDOW, WINDOW + 1) if d)
        order = np.argsort(spaced[lo:hi], kind="stable")
        own = spaced[lo:hi][order]
        first = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
        out[own[first]] += np.add.reduceat(near[order], first, axis=0, dtype=np.int32)
    return out[:-1]


def squeeze(*arrays: np.ndarray) -> bytes:
    """Arrays of whole numbers, byte by byte of their values, compressed one by one."""
    out = []
    for a in arrays:
        body = a.reshape(-1).view(np.uint8).reshape(-1, a.dtype.itemsize).T.tobytes()
        held = pa.compress(body, codec="zstd", asbytes=True)
        out += [len(body).to_bytes(8, "little"), len(held).to_bytes(8, "little"), held]
    return b"".join(out)


def expand(data: bytes, *kinds: str) -> list[np.ndarray]:
    out, at = [], 0
    for kind in kinds:
        size, held = (int.from_bytes(data[at + i : at + i + 8], "little") for i in (0, 8))
        body = pa.decompress(data[at + 16 : at + 16 + held], size, codec="zstd", asbytes=True)
        width = np.dtype(kind).itemsize
        out.append(np.frombuffer(body, np.uint8).reshape(width, -1).T.copy().reshape(-1).view(kind))
        at += 16 + held
    return out


#: Rows of sums are packed together whose largest number is at most so large, in so wide numbers.
KINDS = [(1, "<i1"), (2, "<i1"), (4, "<i1"), (10, "<i1"), (30, "<i1"), (127, "<i1"), (2**15 - 1, "<i2"), (2**31 - 1, "<i4"), (2**63 - 1, "<i8")]


def packed(sums: np.ndarray) -> bytes:
    """Rows of whole numbers, those of like size together: a rare word takes a few bytes."""
    kind = np.searchsorted([k for k, _ in KINDS], np.abs(sums).max(1, initial=0)).astype(np.uint8)
    return squeeze(kind, *(sums[kind == i].astype(w) for i, (_, w) in enumerate(KINDS)))


def unpacked(data: bytes) -> np.ndarray:
    kind, *rows = expand(data, "<u1", *(w for _, w in KINDS))
    out = np.zeros((len(kind), DIM), np.int64 if len(rows[-1]) else np.int32)
    for i, own in enumerate(rows):
        out[kind == i] = own.reshape(-1, DIM)
    return out


def ranked(seq: np.ndarray, words: int) -> bytes:
    """A sequence of the numbers below ``words``: frequent ones are made small, so that they take few bits."""
    often = np.bincount(seq, minlength=words).astype(np.int32)
    rank = np.empty(words, np.int32)
    rank[np.argsort(-often, kind="stable")] = np.arange(words, dtype=np.int32)
    return squeeze(often, rank[seq])


def unranked(data: bytes) -> np.ndarray:
    often, seq = expand(data, "<i4", "<i4")
    return np.argsort(-often, kind="stable").astype(np.int32)[seq]


def steps(hashes: np.ndarray) -> bytes:
    """Sorted hashes by their differences."""
    return squeeze(np.diff(hashes, prepend=np.uint64(0)))


def summed(words: list[np.ndarray], sums: Iterable[np.ndarray]) -> Iterator[np.ndarray]:
    """For each list of words, which has a word once, the sums of its words over all lists.

    Only the totals are held: lists are added and given back one at a time.
    """
    same = np.unique(np.concatenate(words))
    total = np.zeros((len(same), DIM), np.int64)
    for own, rows in zip(words, sums, strict=True):
        total[np.searchsorted(same, own)] += rows
    for own in words:
        yield total[np.searchsorted(same, own)]


def directions(sums: np.ndarray) -> np.ndarray:
    """Direction, not frequency, is the vector of a word."""
    norm = np.linalg.norm(sums.astype(np.float64), axis=1, keepdims=True)
    return np.divide(sums, norm, out=np.zeros(sums.shape), where=norm > 0).astype(np.float32)


def pool(u: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Mean and spread of a text's vectors, how alike neighbouring words are, and whether there are any."""
    if not len(u):
        return np.zeros(SIZE)
    first, second, near, next_near = np.zeros(DIM), np.zeros(DIM), 0.0, 0.0
    for lo in range(0, len(u), BLOCK):
        v = vectors[u[lo : lo + BLOCK + 2]]
        own = v[:BLOCK]
        first += own.sum(0, dtype=np.float64)
        second += np.square(own).sum(0, dtype=np.float64)
        near += float(np.einsum("ij,ij->", v[:-1][:BLOCK], v[1:][:BLOCK]))
        next_near += float(np.einsum("ij,ij->", v[:-2][:BLOCK], v[2:][:BLOCK])) if len(v) > 2 else 0.0
    n = len(u)
    mean = first / n
    return np.concatenate([mean, np.sqrt(np.maximum(0, second / n - mean * mean)), [near / n, next_near / n, 1.0]])


def free_name(docs: DataFrame, name: str) -> str:
    """``name`` with as many underscores as it takes to differ from all columns."""
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name = "_" + name
    return name


def pooled(
    docs: DataFrame, text: str = "text", out: str = "_x", carry: list[str] | None = None, chunk: int = CHUNK, part: int = PART
) -> DataFrame:
    """The columns ``carry`` (None: all) of every row, and in ``out`` the pooled vectors of its words, in a stored table.

    Every word of the table has a context vector of its own, from all places where it stands. A task cuts its
    texts into chunks. A chunk is sent on as the numbers of its words, not as text, and sends the sums of its
    words to parts of the hash space. A part adds up each word over all chunks and returns the totals in the
    chunk's order; there they meet the numbers. Chunks grow in number with the text, parts too, so neither a
    vocabulary nor a frequent word must fit into one task: a word sends one row a chunk, however often it stands
    there. Only parts that hold a word of a chunk get a message, so there are no more messages than pairs of chunk and word.

    Both uses of the chunks read one shuffle. A chunk's key holds a digest of its texts, so a recomputed task
    that saw other rows than before would be noticed, not mixed in; ``docs`` is to be a table or what is read off one.
    """
    carry = docs.columns if carry is None else carry
    size = total_bytes(docs, text)
    parts = max(1, -(-size // part))
    fields = [docs.schema[c] for c in carry]
    # Small pieces of the input are read together, to some three quarters of a chunk: a chunk then says each word once for more text.
    pieces = max(1, 4 * size // (3 * chunk))
    source = docs.select(*carry, F.col(text).alias(free_name(docs, "_text"))).coalesce(pieces)
    # Tasks grow in number with the keys, chunks and parts.
    tasks = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), min(2 * (pieces + parts), TASKS))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        words, rows, digest = Words(), [], xxhash.xxh64(seed=TaskContext.get().partitionId())

        def flush() -> Iterator[pa.RecordBatch]:
            # Chunks have even keys, parts odd ones.
            key = digest.intdigest() >> 2 << 1
            hashes, seq, lengths = words.close()
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, rows[0].schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
                for own in rows:
                    writer.write_batch(own)
            yield message(key, key, sink.getvalue().to_pybytes(), squeeze(lengths) + ranked(seq, len(hashes)))
            sums, at = context_sums(hashes, seq, lengths), cuts(hashes, parts)
            for i in range(parts):
                if at[i] < at[i + 1]:
                    yield message(2 * i + 1, key, steps(hashes[at[i] : at[i + 1]]), packed(sums[at[i] : at[i + 1]]))

        for batch in batches:
            texts, lo = batch.column(len(carry)), 0
            for i in range(len(texts)):
                body = texts[i].as_py()
                words.add(body)
                digest.update(b"\0" if body is None else b"\1" + body.encode("utf-8", "surrogatepass"))
                if words.size >= chunk or len(words.seen) >= VOCABULARY:
                    rows.append(batch.slice(lo, i + 1 - lo).select(range(len(carry))))
                    yield from flush()
                    words, rows, lo = Words(), [], i + 1
            if lo < len(texts):
                rows.append(batch.slice(lo).select(range(len(carry))))
        if rows:
            yield from flush()

    def message(key: int, to: int, a: bytes, b: bytes) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([key], pa.int64()), pa.array([to], pa.int64()), pa.array([a], pa.binary()), pa.array([b], pa.binary())], ["key", "to", "a", "b"])

    def add(key: tuple, rows: pa.Table) -> pa.Table:
        if not key[0].as_py() & 1:
            return rows.select(["key", "to", "b"]).slice(0, 0)
        forget()
        words = [np.cumsum(expand(a.as_py(), "<u8")[0], dtype=np.uint64) for a in rows.column("a")]
        totals = summed(words, (unpacked(b.as_py()) for b in rows.column("b")))
        return pa.table({"key": rows.column("key"), "to": rows.column("to"), "b": pa.array(map(packed, totals), pa.binary())})

    def meet(key: tuple, rows: pa.Table, totals: pa.Table) -> pa.Table:
        if rows.num_rows and key[0].as_py() & 1:
            return empty
        if rows.num_rows != 1:
            raise RuntimeError("a recomputed task saw other rows than before")
        forget()
        body = rows.column("b")[0].as_py()
        seq, lengths = unranked(body[16 + int.from_bytes(body[8:16], "little") :]), expand(body, "<i4")[0]
        order = np.argsort(totals.column("key").to_numpy())
        vectors, filled = np.empty((seq.max(initial=-1) + 1, DIM), np.float32), 0
        for i in order.tolist():
            own = directions(unpacked(totals.column("b")[i].as_py()))
            if filled + len(own) > len(vectors):
                raise RuntimeError("a recomputed task saw other rows than before")
            vectors[filled : filled + len(own)] = own
            filled += len(own)
        if filled < len(vectors):
            raise RuntimeError("a recomputed task saw other rows than before")
        found = [pool(u, vectors) for u in np.split(seq, np.cumsum(lengths)[:-1])]
        own = pa.ipc.open_stream(rows.column("a")[0].as_py()).read_all()
        values = pa.array((np.rint(np.concatenate(found) / GRID) * GRID).astype(np.float32))
        return own.append_column(out, pa.ListArray.from_arrays(pa.array(np.arange(len(found) + 1, dtype=np.int32) * SIZE), values))

    schema = StructType([*fields, StructField(out, ArrayType(FloatType()))])
    empty = to_arrow_schema(schema).empty_table()
    sent = source.mapInArrow(cut, "key long, to long, a binary, b binary").repartition(tasks, "key")
    totals = sent.groupBy("key").applyInArrow(add, "key long, to long, b binary")
    return stored(sent.groupBy("key").cogroup(totals.groupBy("to")).applyInArrow(meet, schema), "pooled")


class Network:
    """Two layers of weights over standardised features, and the temperature that divides their output."""

    def __init__(self, x: np.ndarray, y: np.ndarray) -> None:
        rng = np.random.default_rng(11)
        hold = np.arange(len(y)) % round(1 / CALIBRATION) == 0 if len(y) >= 50 else np.zeros(len(y), bool)
        self.mean, self.scale = x.mean(0), x.std(0) + 1e-6
        z = (x - self.mean) / self.scale
        self.w1 = rng.normal(0, np.sqrt(2 / x.shape[1]), (x.shape[1], HIDDEN))
        self.b1, self.w2, self.b2 = np.zeros(HIDDEN), rng.normal(0, np.sqrt(1 / HIDDEN), HIDDEN), np.zeros(1)
        self.heat = 1.0
        fit_x, fit_y = z[~hold], y[~hold]
        optimiser = Adam([self.w1, self.b1, self.w2, self.b2], RATE)
        size = 512
        for _ in range(max(1, min(EPOCHS, 6000 * size // max(1, len(fit_y)))) if len(fit_y) else 0):
            order = rng.permutation(len(fit_y))
            for lo in range(0, len(order), size):
                rows = order[lo : lo + size]
                h, out = self._forward(fit_x[rows])
                g = (sigmoid(out) - fit_y[rows]) / len(rows)
                gh = np.outer(g, self.w2) * (h > 0)
                optimiser.step([fit_x[rows].T @ gh + DECAY * self.w1, gh.sum(0), h.T @ g + DECAY * self.w2, np.array([g.sum()])])
        if hold.any():
            out, want = self._forward(z[hold])[1], y[hold]
            heats = np.exp(np.linspace(np.log(0.25), np.log(8), 141))
            loss = [np.mean(np.logaddexp(0, out / t) - want * out / t) for t in heats]
            self.heat = float(heats[int(np.argmin(loss))])

    def _forward(self, z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        h = np.maximum(0, z @ self.w1 + self.b1)
        return h, h @ self.w2 + self.b2[0]

    def probability(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(self._forward((x - self.mean) / self.scale)[1] / self.heat)


class Model:
    def __init__(self, network: Network) -> None:
        self.network = network

    def scorer(self) -> Callable[[list[float]], float]:
        return lambda x: float(self.network.probability(np.array(x, np.float64)[None])[0])


def fit(rows: DataFrame, labels: DataFrame, doc_id: str = "doc_id", label: str = "quality", x: str = "_x") -> Model:
    """The network from at most 10,000 labelled rows of a pooled table outside the held-out fold.

    Every fifth of these rows is kept from training and sets the temperature. Without labelled rows of both
    kinds the network learns what there is; with none it answers one half.
    """
    known = list(sample(rows, labels, label, None, LABELLED, doc_id, x).toLocalIterator())
    x = np.array([r["_text"] for r in known], np.float64).reshape(len(known), SIZE)
    y = np.array([r["_label"] for r in known], np.float64)
    if not len(known):
        x, y = np.zeros((2, SIZE)), np.array([0.0, 1.0])
    return Model(Network(x, y))


def quality(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row.

    Only the texts decide a score. A null text is scored as the empty one; repeated rows give repeated rows;
    an empty table gives none; other columns are not carried.
    """
    rows = pooled(docs.select(doc_id, text), text, carry=[doc_id])
    return scored(rows, fit(rows, labels, doc_id).scorer, threshold, doc_id, "_x")


def _passes(threshold: float, score: float) -> bool:
    return score >= threshold


def of_quality(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows that are predicted of good quality, with all their columns."""
    x = free_name(docs, "_x")
    rows = pooled(docs, text, x, chunk=CARRIED)
    return kept(rows, fit(rows, labels, doc_id, x=x).scorer, partial(_passes, threshold), x).drop(x)
