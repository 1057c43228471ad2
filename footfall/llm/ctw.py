"""Language-model scores by context-tree weighting over bytes.

A text is the bytes of its words (A-Z in lower case), each followed by a space, and a line feed at the end.
The byte after any ``depth`` bytes is decided by eight binary steps, highest bit first. For each step and each
context of 0 ... depth bytes a node counts zeros and ones of the training texts; Krichevsky-Trofimov
estimates of all depths are mixed with the weights that context-tree weighting gives them after training.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from footfall.llm.common import discard, forget, held_out, stored, total_bytes, words

#: Bytes of context; context and byte fit into a positive 64-bit number up to 6.
DEPTH = 5
#: Bytes of text that are scored together, and positions worked on at once.
CHUNK_BYTES = 24 << 20
BLOCK = 1 << 20
#: Distinct keys a counting task keeps before it hands them on.
HELD = 1 << 22
LN2 = math.log(2.0)


#: The end of a text, as a token.
END = b"\n"


def stream(tokens: list[bytes], depth: int) -> bytes:
    """The bytes of a text after ``depth`` line feeds."""
    return b"\n" * depth + (b" ".join(tokens) + b" \n" if tokens else b"\n")


def grams(joined: bytes, depth: int) -> np.ndarray:
    """Context and byte of every position but the first ``depth``: the latest byte of the context is its lowest."""
    a = np.frombuffer(joined, np.uint8).astype(np.int64)
    out = a[depth:].copy()
    for back in range(1, depth + 1):
        out |= a[depth - back : len(a) - back] << (8 * back)
    return out


def word_keys(tokens: list[bytes]) -> np.ndarray:
    """Negative numbers that stand for words, by 63 bits of hash: of ten billion words, some five pairs share one.

    Grams are positive numbers, so both fit into one column.
    """
    h = np.fromiter(map(xxhash.xxh64_intdigest, tokens, repeat(7)), np.uint64, len(tokens))
    return (h | np.uint64(1 << 63)).view(np.int64)


def _summed(keys: list[np.ndarray], counts: list[np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and how often each occurs, or the sum of its counts; empties the lists."""
    key = np.concatenate([*keys, np.zeros(0, np.int64)])
    keys.clear()
    if counts is None:
        key.sort()
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
        return key[first], np.diff(np.append(first, len(key)))
    n = np.concatenate([*counts, np.zeros(0, np.int64)])
    counts.clear()
    order = np.argsort(key)
    key, n = key[order], n[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    return key[first], np.add.reduceat(n, first) if len(key) else n


class Lookup:
    """Values by key for keys that are all there: open addressing, in numpy."""

    def __init__(self, key: np.ndarray, value: np.ndarray) -> None:
        bits = max(4, (2 * len(key)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        # A slot holds a place in the arrays, which stay as they are; a free one the last place, as good as any.
        self.key, self.value, self.place = key, value, np.full(1 << bits, -1, np.int32)
        for lo in range(0, len(key), BLOCK):
            todo = np.arange(lo, min(lo + BLOCK, len(key)), dtype=np.int32)
            at = self._slot(key[todo])
            while len(todo):
                # One of those that want a free slot gets it; the others go one on.
                free = self.place[at] < 0
                self.place[at[free]] = todo[free]
                left = self.place[at] != todo
                todo, at = todo[left], (at[left] + 1) & self.mask

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def __call__(self, key: np.ndarray) -> np.ndarray:
        at = self._slot(key)
        place = self.place[at]
        far = np.flatnonzero(self.key[place] != key)
        while len(far):
            at[far] = (at[far] + 1) & self.mask
            place[far] = self.place[at[far]]
            far = far[self.key[place[far]] != key[far]]
        return self.value[place]


def _log_gamma(x: Column) -> Column:
    """ln gamma for x >= 0.5, by Stirling's series eight steps up."""
    z = x + 8
    shifted = x
    for i in range(1, 8):
        shifted = shifted * (x + i)
    series = 1 / (12 * z) - 1 / (360 * z * z * z) + 1 / (1260 * z * z * z * z * z)
    return (z - 0.5) * F.log(z) - z + 0.5 * math.log(2 * math.pi) + series - F.log(shifted)


def _kt(zeros: Column, ones: Column) -> Column:
    """ln of the Krichevsky-Trofimov probability of the counts."""
    a, b = zeros.cast("double"), ones.cast("double")
    return F.when(zeros + ones == 0, F.lit(0.0)).otherwise(
        _log_gamma(a + 0.5) + _log_gamma(b + 0.5) - _log_gamma(a + b + 1) - math.log(math.pi)
    )


def counts(docs: DataFrame, depth: int) -> DataFrame:
    """(key, n): how often each gram and word occurs in training rows; 0 for those of other rows only.

    ``docs`` has text and held. Every gram and word of every text is there, so scoring finds all it asks for.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        keys, sums, size = [], [], 0
        open_: dict[bool, list] = {False: [], True: []}
        pending = {False: 0, True: 0}

        def fold(held: bool) -> None:
            key, n = _summed(open_[held])
            keys.append(key)
            sums.append(n * 0 if held else n)
            open_[held], pending[held] = [], 0

        def flush() -> pa.RecordBatch:
            for held in (False, True):
                fold(held)
            key, n = _summed(keys, sums)
            return pa.RecordBatch.from_arrays([pa.array(key), pa.array(n.astype(np.int64))], ["key", "n"])

        for batch in batches:
            for text, held in zip(batch.column(0), batch.column(1)):
                held = held.as_py()
                tokens = words(text.as_py())
                body = grams(stream(tokens, depth), depth)
                tokens.append(END)
                open_[held] += [body, word_keys(tokens)]
                pending[held] += len(body)
                if pending[held] >= 2 * BLOCK:
                    fold(held)
                    size += len(keys[-1])
                if size >= HELD:
                    yield flush()
                    size = 0
        yield flush()

    rows = docs.select("text", "held").mapInArrow(run, "key long, n long")
    return rows.groupBy("key").agg(F.sum("n").alias("n"))


def train(gram_counts: DataFrame, depth: int) -> DataFrame:
    """(key, lp): log10 probability of each gram's byte after its context, from counts (key, n).

    A node is context << 8 | place in the byte's binary tree. Upwards, counts and the logarithms of what the
    children are worth are summed per parent; downwards, a node hands on what it has mixed so far and the
    share that is left to its children. Each level is one grouping and one join. The nodes of a gram have one
    context: grams are dealt by it before they are split into nodes, and meet the nodes of a context as one map.
    """
    place = [F.expr(f"shiftleft(1L, {j}) | shiftright(byte, {8 - j})") for j in range(8)]
    bit = [F.expr(f"shiftright(byte, {7 - j}) & 1") for j in range(8)]
    context, byte = F.shiftright("key", 8).alias("context"), F.col("key").bitwiseAND(255).alias("byte")
    dealt = gram_counts.select(context, byte, "n").repartition("context")
    at = dealt.select("context", "n", F.explode(F.array(*[F.struct(p.alias("place"), b.alias("bit")) for p, b in zip(place, bit)])).alias("s"))
    leaves = at.groupBy("context", F.col("s.place").alias("place")).agg(
        F.sum(F.when(F.col("s.bit") == 0, F.col("n")).otherwise(0)).alias("zeros"), F.sum(F.when(F.col("s.bit") == 1, F.col("n")).otherwise(0)).alias("ones")
    )
    # What follows from the counts is worked out again where it is needed: whole numbers take less room.
    kt = _kt(F.col("zeros"), F.col("ones"))
    levels = {depth: stored(leaves.select(F.shiftleft("context", 8).bitwiseOR(F.col("place")).alias("node"), "zeros", "ones"), "ctw")}

    def parent(d: int) -> Column:
        """The node one byte of context up from depth ``d``: without its oldest byte."""
        return F.col("node").bitwiseAND(F.lit((1 << (8 * d)) - 1))

    for d in range(depth, 0, -1):
        up = levels[d].groupBy(parent(d).alias("node")).agg(
            F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones"), F.sum(kt if d == depth else "worth").alias("below")
        )
        high, low = F.greatest(kt, "below"), F.least(kt, "below")
        levels[d - 1] = stored(up.select("node", "zeros", "ones", (high + F.log1p(F.exp(low - high)) - LN2).alias("worth")), "ctw")

    one = (F.col("ones") + 0.5) / (F.col("zeros") + F.col("ones") + 1.0)
    share = F.exp(kt - F.col("worth") - LN2)
    down = levels[0].select("node", (share * one).alias("mixed"), (1 - share).alias("left"))
    for d in range(1, depth + 1):
        above = down.select(F.col("node").alias("up"), F.col("mixed").alias("m"), F.col("left").alias("l"))
        own = share if d < depth else F.lit(1.0)
        down = levels[d].join(above, parent(d) == F.col("up")).select(
            "node", (F.col("m") + F.col("l") * own * one).alias("mixed"), (F.col("l") * (1 - own)).alias("left")
        )
    # 255 nodes at most.
    nodes = down.groupBy(F.shiftright("node", 8).alias("context")).agg(
        F.map_from_entries(F.collect_list(F.struct(F.col("node").bitwiseAND(255).cast("int"), "mixed"))).alias("nodes")
    )
    steps = [F.element_at("nodes", p.cast("int")) for p in place]
    lp = sum((F.log10(F.when(b == 1, m).otherwise(1 - m)) for b, m in zip(bit, steps)), F.lit(0.0))
    return gram_counts.select("key", context, byte).join(nodes, "context").select("key", lp.alias("lp"))


def score(docs: DataFrame, depth: int = DEPTH, doc_id: str = "doc_id", text: str = "text", folds: int = 10, fold: int = 0) -> DataFrame:
    """Score every whole text under a model of the rows outside the held-out fold.

    Columns: doc_id, held_out, n_tokens (words and the end), n_known, train_tokens, base_score (smoothed
    unigram), score (log10 probability of the bytes), n_bytes, bits_per_byte. A null text is the empty one;
    a null id trains; repeated rows give repeated rows; an empty table gives none; other columns are not carried.

    Counts are summed over all texts. Scoring never sends the model whole anywhere: texts are dealt into
    chunks of some 24 MB, each asks once for each distinct gram and word it holds, and the answers return
    to it.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), held_out(F.col(doc_id), folds, fold).alias("held"))
    chunks = max(1, -(-total_bytes(rows) // CHUNK_BYTES))
    # Small input files are read together: a task then says each key once for more text.
    found = stored(counts(rows.coalesce(2 * chunks), depth), "counts")
    is_word = F.col("key") < 0
    n, v = found.where(is_word & (F.col("n") > 0)).agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    lps = train(found.where(~is_word), depth)
    # A gram is told its logarithm, a word its count.
    answers = stored(
        lps.select("key", F.col("lp").alias("value")).unionByName(found.where(is_word).select("key", F.col("n").cast("double").alias("value"))), "model"
    )
    # The answers are all that is read from here on.
    discard(lps)
    parts = max(chunks, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = rows.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "text"), F.lit(chunks)).cast("int")).repartition(parts, "chunk")

    def ask(table: pa.Table) -> pa.Table:
        forget()
        parts, some, size = [], [], 0
        for t in table.column("text"):
            tokens = words(t.as_py())
            some.append(grams(stream(tokens, depth), depth))
            tokens.append(END)
            some.append(word_keys(tokens))
            size += len(some[-2])
            if size >= BLOCK:
                parts.append(_summed(some)[0])
                some, size = [], 0
        key = _summed(parts + some)[0]
        chunk = table.column("chunk")[0].as_py()
        return pa.table({"chunk": pa.array(np.full(len(key), chunk, np.int32)), "key": pa.array(key)})

    def answer(left: pa.Table, right: pa.Table) -> pa.Table:
        forget()
        if not left.num_rows:
            return out_schema.empty_table()
        told = Lookup(right.column("key").to_numpy(), right.column("value").to_numpy())
        whole = n + 0.1 * (v + 1)
        found = []
        for doc, held, t in zip(left.column("doc_id"), left.column("held"), left.column("text")):
            tokens = words(t.as_py())
            body = grams(stream(tokens, depth), depth)
            total = math.fsum(float(told(body[lo : lo + BLOCK]).sum()) for lo in range(0, len(body), BLOCK))
            tokens.append(END)
            c = told(word_keys(tokens))
            base = float(np.log10((c + 0.1) / whole).sum())
            found.append((doc.as_py(), held.as_py(), len(tokens), int(np.count_nonzero(c)), base, total, len(body)))
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found), out_schema)], schema=out_schema)

    kind_of_id = pa.int64() if dict(rows.dtypes)["doc_id"] == "bigint" else pa.int32() if dict(rows.dtypes)["doc_id"] == "int" else pa.string()
    out_schema = pa.schema([
        ("doc_id", kind_of_id), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
        ("base_score", pa.float64()), ("score", pa.float64()), ("n_bytes", pa.int64()),
    ])
    wanted = dealt.groupBy("chunk").applyInArrow(ask, "chunk int, key long")
    told_all = wanted.join(answers, "key").select("chunk", "key", "value")
    scored = dealt.groupBy("chunk").cogroup(told_all.groupBy("chunk")).applyInArrow(
        answer, f"doc_id {dict(rows.dtypes)['doc_id']}, held_out boolean, n_tokens long, n_known long, base_score double, score double, n_bytes long"
    )
    return scored.select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"), "base_score", "score", "n_bytes",
        (-F.col("score") / F.col("n_bytes") * math.log2(10)).alias("bits_per_byte"),
    )
