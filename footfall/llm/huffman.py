"""Token ids in files: canonical length-limited Huffman codes over independent blocks."""

from __future__ import annotations

import json
from codecs import charmap_decode
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from footfall.llm.common import remembered, stored, total_bytes
from footfall.llm.pieces import Cutter, Memory, blobs, slices

#: Ids after which a block is closed, at the end of a document, and ids between two checkpoints in it.
BLOCK_IDS = 1 << 16
LANE = 1024
#: Longest code in bits, and the most a 32-bit window at any bit offset can hold.
LIMIT = 18
WIDEST = 24
#: Bytes of text per range of documents.
RANGE_BYTES = 16 << 20
#: Pieces a worker remembers, and bytes of text that are encoded together, or one text.
PIECES = 600_000
SLICE = 4 << 20
#: Ids that are read at once, or one block.
TOGETHER = 1 << 21


def code_lengths(counts: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """Lengths of an optimal prefix code with no code above ``limit`` bits (package-merge); 0: id not used."""
    lengths = np.zeros(len(counts), np.int64)
    used = np.flatnonzero(counts)
    n = len(used)
    if n < 2:
        lengths[used] = 1
        return lengths
    limit = max(limit, (n - 1).bit_length())
    if limit > WIDEST:
        raise ValueError("too many ids for a one-step table")
    order = used[np.argsort(counts[used], kind="stable")]
    leaves = counts[order].astype(np.float64)
    row, kinds = leaves, [np.ones(n, bool)]
    for _ in range(limit - 1):
        packages = row[: len(row) // 2 * 2].reshape(-1, 2).sum(1)
        both = np.concatenate([leaves, packages])
        place = np.argsort(both, kind="stable")
        row = both[place]
        kinds.append(place < n)
    need, found = 2 * n - 2, np.zeros(n, np.int64)
    for kind in reversed(kinds):
        own = int(kind[:need].sum())
        found[:own] += 1
        need = 2 * (need - own)
    lengths[order] = found
    return lengths


def canonical(lengths: np.ndarray) -> np.ndarray:
    """Codes that lengths alone decide: shorter ones first, then by id."""
    codes = np.zeros(len(lengths), np.uint64)
    code, before = 0, 0
    used = np.flatnonzero(lengths)
    for i in used[np.lexsort((used, lengths[used]))].tolist():
        code <<= int(lengths[i]) - before
        before = int(lengths[i])
        codes[i] = code
        code += 1
    return codes


def pack(ids: np.ndarray, codes: np.ndarray, lengths: np.ndarray) -> tuple[bytes, np.ndarray]:
    """Bits of a block, first bit highest, and the bit offset of every 1,024th id."""
    if not len(ids):
        return b"", np.zeros(0, np.uint64)
    size = lengths[ids]
    ends = np.cumsum(size)
    at = ends - size
    word, shift = at >> 6, 64 - (at & 63) - size
    code = codes[ids]
    out = np.zeros(int(ends[-1] >> 6) + 2, np.uint64)
    high = np.where(shift >= 0, code << np.maximum(shift, 0).astype(np.uint64), code >> np.maximum(-shift, 0).astype(np.uint64))
    first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
    out[word[first]] = np.bitwise_or.reduceat(high, first)
    over = np.flatnonzero(shift < 0)
    # A word has one code at most that runs over into the next.
    out[word[over] + 1] |= code[over] << (64 + shift[over]).astype(np.uint64)
    return out.astype(">u8").tobytes()[: int(ends[-1] + 7) // 8], at[::LANE].astype(np.uint64)


def table(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """For each value of the next ``width`` bits: the id that begins there, and its length."""
    used = np.flatnonzero(lengths)
    width = int(lengths.max(initial=1))
    order = used[np.lexsort((used, lengths[used]))]
    spans = np.int64(1) << (width - lengths[order])
    symbol, size = np.zeros(1 << width, np.uint32), np.ones(1 << width, np.int64)
    symbol[: spans.sum()] = np.repeat(order, spans)
    size[: spans.sum()] = np.repeat(lengths[order], spans)
    return symbol, size, width


def unpack(blocks: list[tuple[bytes, np.ndarray, int]], symbol: np.ndarray, size: np.ndarray, width: int) -> list[np.ndarray]:
    """Ids of each block (bits, checkpoints, number of ids); all lanes of all blocks step together."""
    base, joined, lanes = 0, [], []
    for bits, marks, _ in blocks:
        lanes.append(marks.astype(np.int64) + base * 8)
        joined.append(bits)
        base += len(bits)
    data = np.frombuffer(b"".join(joined) + b"\0" * 8, np.uint8)
    window = data[:-3].astype(np.uint32)
    for i in (1, 2, 3):
        window <<= 8
        window |= data[i : len(data) - 3 + i]
    at = np.concatenate(lanes) if lanes else np.zeros(0, np.int64)
    # Id and length in one number: one look-up a step.
    kind = np.uint32 if int(symbol.max(initial=0)) < 1 << 27 else np.uint64
    entry = symbol.astype(kind) << kind(5) | size.astype(kind)
    out = np.zeros((LANE, len(at)), kind)
    down = np.uint32(32 - width)
    for step in range(LANE if len(at) else 0):
        value = window.take(at >> 3, mode="clip")
        value <<= (at & 7).astype(np.uint32)
        value >>= down
        found = entry.take(value)
        out[step] = found
        at += (found & kind(31)).astype(np.int64)
    out >>= kind(5)
    whole = np.ascontiguousarray(out.T, np.uint32)
    parts, lane = [], 0
    for _, marks, n in blocks:
        parts.append(whole[lane : lane + len(marks)].reshape(-1)[:n])
        lane += len(marks)
    return parts


class Encoder:
    """The tokenizers library, asked once for each different piece of text that a worker remembers.

    A byte-level BPE tokenizer cuts texts into pieces by one pattern and merges within them; its own pre-tokenizer
    and model are used. Any other tokenizer encodes whole texts.
    """

    def __init__(self, path: str) -> None:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.lib = Tokenizer.from_file(path)
        self.lib.encode_special_tokens = True
        self.memory = None
        with open(path, encoding="utf-8") as spec:
            if self._byte_level(json.load(spec)):
                self.memory = Memory(Cutter(self.lib.pre_tokenizer.pre_tokenize_str), self._piece(self.lib.model.tokenize), PIECES)

    @staticmethod
    def _byte_level(spec: dict) -> bool:
        cut, model = spec.get("pre_tokenizer") or {}, spec["model"]
        return (
            (cut.get("type"), cut.get("add_prefix_space"), cut.get("use_regex", True)) == ("ByteLevel", False, True)
            and (model.get("type"), model.get("dropout")) == ("BPE", None)
            and not any(spec.get(k) for k in ("normalizer", "truncation", "padding"))
            and all(t["special"] for t in spec.get("added_tokens") or [])
        )

    @staticmethod
    def _piece(tokenize: Callable[[str], list]) -> Callable[[bytes], list[int]]:
        """Encoder of one piece; the vocabulary spells bytes that are no visible Latin-1 as letters from U+0100 on."""
        seen = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
        odd = [b for b in range(256) if b not in seen]
        letters = "".join(chr(b if b in seen else 0x100 + odd.index(b)) for b in range(256))
        return lambda piece: [t.id for t in tokenize(charmap_decode(piece, "strict", letters)[0])]

    def flat(self, texts: list[str], end: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, ``end`` after each, and how many are each text's."""
        if self.memory is not None:
            return self.memory.encode(texts, [end])
        found = [[*e.ids, end] for e in self.lib.encode_batch_fast(texts, add_special_tokens=False)]
        return np.array([i for x in found for i in x], np.uint32), np.array([len(x) for x in found], np.int64)

    def encode(self, texts: list[str], end: int) -> list[np.ndarray]:
        ids, sizes = self.flat(texts, end)
        return np.split(ids, np.cumsum(sizes)[:-1]) if texts else []


def encoder(path: str) -> Encoder:
    """One encoder per worker process, while it encodes."""
    return remembered((Encoder, path), lambda: Encoder(path))


def _encode_ranges(path: str, end: int):
    """Rows of one range with their ids, and one row more that has only ``seen``: how often each id occurs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, start, total = encoder(path), 0, np.zeros(0, np.int64)
        names = ["part", "local", "doc_id", "n_tokens", "ids", "seen"]
        kind = None
        for batch in batches:
            kind = batch.schema.field(1).type
            length = pc.fill_null(pc.binary_length(batch.column(2)), 0).to_numpy(zero_copy_only=False)
            for lo, hi in slices(length, SLICE):
                part = batch.slice(lo, hi - lo)
                ids, sizes = own.flat([t or "" for t in part.column(2).to_pylist()], end)
                total = added(total, np.bincount(ids))
                starts = start + np.cumsum(sizes) - sizes
                start += int(sizes.sum())
                rows = [part.column(0), pa.array(starts), part.column(1), pa.array(sizes), blobs(ids, sizes), pa.nulls(len(sizes), pa.binary())]
                yield pa.RecordBatch.from_arrays(rows, names)
        if kind is not None:
            nulls = [pa.nulls(1, t) for t in (pa.int32(), pa.int64(), kind, pa.int64(), pa.binary())]
            yield pa.RecordBatch.from_arrays([*nulls, pa.array([total.astype("<i8").tobytes()], pa.binary())], names)

    return run


def added(total: np.ndarray, seen: np.ndarray) -> np.ndarray:
    """Sum of two arrays of counts, of which one may be shorter."""
    if len(seen) > len(total):
        seen, total = total, seen.astype(np.int64)
    total[: len(seen)] += seen
    return total


def _count_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(0, np.int64)
    for batch in batches:
        for blob in batch.column(0):
            total = added(total, np.frombuffer(blob.as_py(), "<i8"))
    used = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["id", "n"])


def write_ids(
    docs: DataFrame, path: str, tokenizer: str, end: int, limit: int = LIMIT, doc_id: str = "doc_id", text: str = "text"
) -> None:
    """Encode all texts and write their ids under ``path`` in ascending doc_id order, nulls first.

    ``path/lengths`` holds (id, length), from which the canonical code follows; ``path/blocks`` holds, in
    one folder per range of documents, blocks of whole documents: start (ids before it), doc_ids, sizes,
    marks (bit offset of every 1,024th id) and bits. A block is decoded without any other. Each document
    ends with ``end``; a null text has that id only. Documents of one doc_id stand in the order of their
    text's hash. An empty table writes no block.
    """
    slim = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("_text"))
    parts = max(1, -(-total_bytes(slim, "_text") // RANGE_BYTES))
    tie = F.xxhash64("_text")
    ranged = (
        slim.withColumn("_tie", tie)
        .repartitionByRange(parts, "doc_id", "_tie")
        .sortWithinPartitions("doc_id", "_tie")
        .select(F.spark_partition_id().alias("part"), "doc_id", "_text")
    )
    kind = dict(slim.dtypes)["doc_id"]
    encoded = stored(
        ranged.mapInArrow(_encode_ranges(tokenizer, end), f"part int, local long, doc_id {kind}, n_tokens long, ids binary, seen binary"), "ids"
    )
    rows = encoded.where(F.col("seen").isNull()).drop("seen")
    seen = encoded.select("seen").where(F.col("seen").isNotNull())
    # At most one row per id of the vocabulary.
    counted = seen.mapInArrow(_count_ids, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(max((r["id"] for r in counted), default=0) + 1, np.int64)
    for r in counted:
        counts[r["id"]] = r["n"]
    lengths = code_lengths(counts, limit)
    codes = canonical(lengths)
    spark = docs.sparkSession
    spark.createDataFrame(
        [(int(i), int(lengths[i])) for i in np.flatnonzero(lengths)], "id long, length long"
    ).coalesce(1).write.parquet(f"{path}/lengths")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per range.
    offsets = rows.groupBy("part").agg(F.sum("n_tokens").alias("_n")).select("part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    placed = rows.join(F.broadcast(offsets), "part").select("part", (F.col("_before") + F.col("local")).alias("start"), "doc_id", "n_tokens", "ids")
    book = spark.sparkContext.broadcast((codes, lengths))

    def block(docs_in: list, part: int) -> pa.RecordBatch:
        codes, lengths = book.value
        bits, marks = pack(np.frombuffer(b"".join(d[3] for d in docs_in), "<u4"), codes, lengths)
        one = [[part], [docs_in[0][0]], [[d[1] for d in docs_in]], [[d[2] for d in docs_in]], [marks.astype("<u8").tobytes()], [bits]]
        return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(one, types)], names)

    names = ["part", "start", "doc_ids", "sizes", "marks", "bits"]
    field = pa.int64() if kind == "bigint" else pa.int32() if kind == "int" else pa.string()
    types = [pa.int32(), pa.int64(), pa.list_(field), pa.list_(pa.int64()), pa.binary(), pa.binary()]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, part = [], 0, None
        for batch in batches:
            for p, start, doc, n, ids in zip(*(batch.column(i).to_pylist() for i in range(5))):
                if held and (p != part or start != held[-1][0] + held[-1][2] or size >= BLOCK_IDS):
                    yield block(held, part)
                    held, size = [], 0
                part = p
                held.append((start, doc, n, ids))
                size += n
        if held:
            yield block(held, part)

    blocks = placed.mapInArrow(encode, f"part int, start long, doc_ids array<{kind}>, sizes array<long>, marks binary, bits binary")
    blocks.sortWithinPartitions("part", "start").write.partitionBy("part").parquet(f"{path}/blocks")


def read_ids(spark: SparkSession, path: str, kind: str = "bigint") -> DataFrame:
    """(doc_id, start, n_tokens, ids) of every document in the files; ids are little-endian 32-bit numbers."""
    found = spark.read.parquet(f"{path}/lengths").collect()  # one row per id of the vocabulary
    lengths = np.zeros(max((r["id"] for r in found), default=0) + 1, np.int64)
    for r in found:
        lengths[r["id"]] = r["length"]
    book = spark.sparkContext.broadcast(lengths)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        symbol, size, width = table(book.value)
        for batch in batches:
            ends = np.concatenate([[0], np.cumsum(pc.list_value_length(batch.column(2)).to_numpy(zero_copy_only=False))])
            held = np.diff(np.concatenate([[0], np.cumsum(batch.column(2).flatten().to_numpy())])[ends])
            for lo, hi in slices(held, TOGETHER):
                some = batch.slice(lo, hi - lo)
                sizes = some.column(2).flatten().to_numpy()
                blocks = [(b.as_py(), np.frombuffer(m.as_py(), "<u8"), int(n)) for m, b, n in zip(some.column(3), some.column(4), held[lo:hi])]
                ids = np.concatenate(unpack(blocks, symbol, size, width))
                first = np.cumsum(held[lo:hi]) - held[lo:hi]
                begins = np.cumsum(sizes) - sizes + np.repeat(some.column(0).to_numpy() - first, np.diff(ends[lo : hi + 1]))
                yield pa.RecordBatch.from_arrays(
                    [some.column(1).flatten(), pa.array(begins), pa.array(sizes), blobs(ids, sizes)], ["doc_id", "start", "n_tokens", "ids"]
                )

    schema = f"part int, start long, doc_ids array<{kind}>, sizes array<long>, marks binary, bits binary"
    blocks = spark.read.schema(schema).parquet(f"{path}/blocks").select("start", "doc_ids", "sizes", "marks", "bits")
    return blocks.mapInArrow(decode, f"doc_id {kind}, start long, n_tokens long, ids binary")


def digest(rows: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of rows of ``read_ids``."""
    return rows.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
