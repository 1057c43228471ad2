"""Language of every word of a text by a linear-chain conditional random field, and of the text from its words.

A word, a run of letters, speaks for a language through its character n-grams (1 to 3, its borders included), its affixes
(2 to 4 letters at either end) and the lexicons that hold it; how often one language follows another is learned with
these weights. Training sequences are passages of labelled texts, half of them spliced from two passages, so that
switches occur. Forward-backward gives each word a probability per language; a text is in the language with most
expected words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from footfall.llm.classify import FOLD, FOLDS, SPREAD, Adam
from footfall.llm.common import held_out, stored, text_rows

#: Bounds of the training sample (documented parameters): texts per language, passages per text, words per passage.
TEXTS, PASSAGES, LENGTH = 250, 8, 24
#: Longest word of a passage.
LONGEST = 64
#: Rows of the weight table that n-grams and affixes are hashed to; one more row stands for no feature.
SPACE = 1 << 17
AFFIXES = (2, 3, 4)
#: A word enters the lexicon of a language if so many of its passages hold it.
LEXICON = 3
EPOCHS, BATCH, RATE, RIDGE = 6, 256, 0.05, 1e-5
#: Letters turned into features at once, and words whose marginals are worked out at once (a text is never cut).
LETTERS, WORDS = 1 << 20, 1 << 18
UNKNOWN = "und"

_letter = np.full(0x110000, -1, np.int32)


def _lowered(text: str) -> np.ndarray:
    """Code point of each letter in lower case, 0 for all else; as long as the text."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    found = _letter[codes]
    if (found < 0).any():
        for c in np.unique(codes[found < 0]).tolist():
            low = chr(c).lower()
            _letter[c] = (ord(low) if len(low) == 1 else c) if chr(c).isalpha() else 0
        found = _letter[codes]
    return found.astype(np.uint32)


def _bucket(kind: int, *codes: np.ndarray) -> np.ndarray:
    """Row of the weight table for a group of letters of one kind."""
    h = np.full(len(codes[0]), kind * 0x9E3779B1 & 0xFFFFFFFF, np.uint32)
    for c in codes:
        h ^= c
        h *= np.uint32(0x85EBCA6B)
        h ^= h >> np.uint32(13)
    h *= np.uint32(0xC2B2AE35)
    return (h >> np.uint32(32 - 17)).astype(np.int32)


_POWERS = np.multiply.accumulate(np.full(256, 0x9E3779B97F4A7C15, np.uint64))


class Features:
    """Words of some text and the rows of the weight table that speak for each."""

    def __init__(self, text: str) -> None:
        z = np.zeros(len(text) + 2, np.uint32)
        z[1:-1] = _lowered(text)
        a, b = z[1:], z[:-1]
        is_letter = a > 0
        self.starts = np.flatnonzero(is_letter & (b == 0))
        self.ends = np.flatnonzero(~is_letter & (b > 0))
        sizes = self.ends - self.starts
        c = np.zeros_like(b)
        c[1:] = z[:-2]
        c[b == 0] = 0
        # A word's own letters and the place after it, which closes its last n-grams.
        spoken = is_letter | (b > 0)
        self.word = np.repeat(np.arange(len(sizes)), sizes + 1)
        a, b, c = a[spoken], b[spoken], c[spoken]
        one = _bucket(1, a)
        one[a == 0] = SPACE
        self.grams = np.stack([one, _bucket(2, b, a), _bucket(3, c, b, a)])
        self.first = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]]).astype(np.int64) if len(sizes) else np.zeros(0, np.int64)
        affixes, short = [], np.uint32(0)
        for n in AFFIXES:
            for kind, at in ((10 + n, self.starts), (20 + n, self.ends - n)):
                letters = [np.where(sizes >= n, z[np.clip(at + 1 + k, 0, len(z) - 1)], short) for k in range(n)]
                rows = _bucket(kind, *letters)
                rows[sizes < n] = SPACE
                affixes.append(rows)
        self.affixes = np.stack(affixes)
        place = np.arange(len(a)) - self.first[self.word] if len(sizes) else np.zeros(0, np.int64)
        self.names = np.add.reduceat((a.astype(np.uint64) + np.uint64(1)) * _POWERS[place & 255], self.first) if len(sizes) else np.zeros(0, np.uint64)

    def __len__(self) -> int:
        return len(self.starts)


class Model:
    """Languages, weights of features (row, language), lexicons, start and transition weights."""

    def __init__(self, langs: list[str], lexicon: np.ndarray, member: np.ndarray) -> None:
        n = len(langs)
        self.langs, self.lexicon, self.member = langs, lexicon, member
        self.weights = np.zeros((SPACE + 1, n))
        self.known = np.zeros((n, n))
        self.bias, self.start, self.step = np.zeros(n), np.zeros(n), np.zeros((n, n))

    def members(self, f: Features) -> np.ndarray:
        """Row of ``member`` per word; the last row, all zeros, for words in no lexicon."""
        at = np.searchsorted(self.lexicon, f.names)
        at[at == len(self.lexicon)] = 0
        return np.where(self.lexicon[at] == f.names, at, len(self.lexicon)) if len(self.lexicon) else np.zeros(len(f), np.int64)

    def evidence(self, f: Features) -> np.ndarray:
        """(word, language): what the features of a word add up to."""
        if not len(f):
            return np.zeros((0, len(self.langs)))
        by_letter = self.weights[f.grams[0]]
        by_letter += self.weights[f.grams[1]]
        by_letter += self.weights[f.grams[2]]
        out = np.add.reduceat(by_letter, f.first, axis=0)
        for rows in f.affixes:
            out += self.weights[rows]
        return out + (self.member @ self.known)[self.members(f)] + self.bias

    def compact(self) -> Model:
        """The same for scoring: weights at half the size."""
        self.weights = self.weights.astype(np.float32)
        return self


def _scaled(x: np.ndarray) -> np.ndarray:
    return np.exp(x - x.max(axis=-1, keepdims=True))


def marginals(evidence: np.ndarray, begins: np.ndarray, start: np.ndarray, step: np.ndarray) -> np.ndarray:
    """(word, language) probabilities of words in a row, where ``begins`` marks the first word of each text.

    Exact forward-backward over many texts at once. The words are cut into as many blocks as a block has words; all
    blocks are multiplied out side by side, messages pass from block to block, then all blocks are walked side by side
    again. So a text of any length takes no more steps than the square root of all words.
    """
    n, k = evidence.shape
    if not n:
        return np.zeros((0, k))
    size = int(np.ceil(np.sqrt(n)))
    blocks = -(-n // size)
    pad = blocks * size - n
    e = np.concatenate([_scaled(evidence.astype(np.float64)), np.ones((pad, k))]).reshape(blocks, size, k).transpose(1, 0, 2)
    # Padding is a text of its own.
    fresh = np.concatenate([begins, np.ones(pad, bool)]).reshape(blocks, size).T
    first, trans = _scaled(start), np.exp(step - step.max())

    whole = np.broadcast_to(np.eye(k), (blocks, k, k)).copy()
    for t in range(size):
        on = whole @ trans
        cut = fresh[t]
        on[cut] = whole[cut].sum(2, keepdims=True) * first
        on *= e[t][:, None, :]
        whole = on / on.sum((1, 2), keepdims=True)

    into, back = np.ones((blocks, k)), np.ones((blocks, k))
    for b in range(1, blocks):
        v = into[b - 1] @ whole[b - 1]
        into[b] = v / v.sum()
    for b in range(blocks - 2, -1, -1):
        v = whole[b + 1] @ back[b + 1]
        back[b] = v / v.sum()

    alpha, v = np.empty((size, blocks, k)), into
    for t in range(size):
        v = np.where(fresh[t][:, None], first, v @ trans) * e[t]
        v /= v.sum(1, keepdims=True)
        alpha[t] = v
    v = back
    for t in range(size - 1, -1, -1):
        alpha[t] *= v
        v = e[t] * v
        v = np.where(fresh[t][:, None], (v @ first)[:, None], v @ trans.T)
        v /= v.sum(1, keepdims=True)
    out = alpha.transpose(1, 0, 2).reshape(-1, k)[:n]
    return out / out.sum(1, keepdims=True)


def _expected(e: np.ndarray, real: np.ndarray, start: np.ndarray, step: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Marginals (sequence, place, language) and expected transitions of padded sequences of one length."""
    n, length, k = e.shape
    e, first, trans = _scaled(e), _scaled(start), np.exp(step - step.max())
    alpha, beta = np.empty_like(e), np.ones_like(e)
    v = np.broadcast_to(first, (n, k))
    for t in range(length):
        v = (v if t == 0 else v @ trans) * e[:, t]
        v = v / v.sum(1, keepdims=True)
        alpha[:, t] = v
    for t in range(length - 2, -1, -1):
        v = (e[:, t + 1] * beta[:, t + 1]) @ trans.T
        beta[:, t] = np.where(real[:, t + 1, None], v / v.sum(1, keepdims=True), 1.0)
    both = alpha * beta
    pairs = np.zeros((k, k))
    for t in range(1, length):
        p = alpha[:, t - 1, :, None] * trans * (e[:, t] * beta[:, t])[:, None, :]
        pairs += (p / p.sum((1, 2), keepdims=True))[real[:, t]].sum(0)
    return both / both.sum(2, keepdims=True), pairs


def train(passages: list[tuple[str, str]], epochs: int = EPOCHS, seed: int = 7) -> Model:
    """A model from (language, words with blanks between) pairs; the order of the pairs does not matter."""
    passages = sorted(passages)
    langs = sorted({lang for lang, _ in passages})
    words = [p.split(" ") for _, p in passages]
    own = np.array([langs.index(lang) for lang, _ in passages], np.int64)
    k = len(langs)
    held: dict[tuple[int, int], int] = {}
    for lang, (_, p) in zip(own.tolist(), passages):
        for name in np.unique(Features(p).names).tolist():
            held[name, lang] = held.get((name, lang), 0) + 1
    common = sorted(key for key, n in held.items() if n >= LEXICON)
    lexicon = np.unique(np.array([name for name, _ in common], np.uint64))
    member = np.zeros((len(lexicon) + 1, k))
    for name, lang in common:
        member[np.searchsorted(lexicon, np.uint64(name)), lang] = 1.0
    model = Model(langs, lexicon, member)
    if k < 2:
        return model

    rng = np.random.default_rng(seed)
    texts, labels = [], []
    for i, w in enumerate(words):
        label = [own[i]] * len(w)
        if i % 2 and len(w) > 1:
            other = int(rng.integers(len(words)))
            cut = int(rng.integers(1, len(w)))
            w = w[:cut] + words[other][cut:]
            label = label[:cut] + [own[other]] * (len(w) - cut)
        texts.append(" ".join(w))
        labels.append(label)
    length = max(map(len, labels))
    params = [model.weights, model.known, model.bias, model.start, model.step]
    optimiser = Adam(params, RATE)
    for _ in range(epochs):
        order = rng.permutation(len(texts))
        for lo in range(0, len(order), BATCH):
            some = order[lo:lo + BATCH]
            f = Features(" ".join(texts[i] for i in some))
            sizes = np.array([len(labels[i]) for i in some])
            real = np.arange(length) < sizes[:, None]
            gold = np.concatenate([labels[i] for i in some])
            e = np.zeros((len(some), length, k))
            e[real] = model.evidence(f)
            found, pairs = _expected(e, real, model.start, model.step)
            one = np.zeros((len(some), length, k))
            one[real] = np.eye(k)[gold]
            gap = (found - one)[real] / len(gold)
            seen = np.zeros((k, k))
            follows = np.flatnonzero(real[:, 1:].ravel())
            at = one.argmax(2)
            np.add.at(seen, (at[:, :-1].ravel()[follows], at[:, 1:].ravel()[follows]), 1.0)
            g = np.empty_like(model.weights)
            by_letter = gap[f.word]
            for lang in range(k):
                w = np.bincount(f.grams.ravel(), np.tile(by_letter[:, lang], 3), SPACE + 1)
                g[:, lang] = w + np.bincount(f.affixes.ravel(), np.tile(gap[:, lang], len(f.affixes)), SPACE + 1)
            g += RIDGE * model.weights
            # The row of no feature stays zero.
            g[SPACE] = 0.0
            known = member[model.members(f)].T @ gap + RIDGE * model.known
            optimiser.step([g, known, gap.sum(0), (found[:, 0] - one[:, 0]).sum(0) / len(gold), (pairs - seen) / len(gold)])
    return model


def _pieces(text: str, most: int) -> Iterator[str]:
    """A text in pieces of some ``most`` characters that cut no word."""
    at = 0
    while at < len(text):
        end = at + most
        while end < len(text) and text[end - 1].isalpha() and text[end].isalpha():
            end += 1
        yield text[at:end]
        at = end


def _passages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        langs, found = [], []
        for i, text in text_rows(batch, "_text"):
            words = [text[s:e] for piece in _pieces(text, LETTERS) for text, f in [(piece, Features(piece))] for s, e in zip(f.starts.tolist(), f.ends.tolist()) if e - s <= LONGEST]
            cuts = range(0, len(words), LENGTH)
            # Spread over the whole text.
            for j in sorted({len(cuts) * p // PASSAGES for p in range(PASSAGES)}) if words else ():
                langs.append(batch.column(0)[i].as_py())
                found.append(" ".join(words[cuts[j]:cuts[j] + LENGTH]))
        yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(found, pa.string())], ["lang", "passage"])


def fit(docs: DataFrame, texts: int = TEXTS, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> Model:
    """Train on at most ``texts`` different texts of each language outside the held-out fold, chosen by a hash of the text.

    Copies of a text are one text; rows without an id, a text or a language teach nothing. At most 8 passages of 24
    words of a text, spread over all of it, come to the driver.
    """
    rows = docs.select(F.col(doc_id).alias("_id"), F.col(lang).cast("string").alias("_lang"), F.col(text).alias("_text"))
    rows = rows.where(F.col("_id").isNotNull() & F.col("_lang").isNotNull() & F.col("_text").isNotNull() & ~held_out(F.col("_id"), FOLDS, FOLD))
    rows = rows.withColumn("_h", F.xxhash64(F.lit(29), "_text"))
    once = stored(rows.groupBy("_lang", "_h").agg(F.min("_id").alias("_id")), "texts-of-languages")
    # One row per language, of which the model holds a column each.
    counts = once.groupBy(F.col("_lang").alias("_l")).agg(F.count(F.lit(1)).alias("_n"))
    # Some 4 x ``texts`` of a language, however many it has, are then ranked in one task.
    place = F.pmod(F.xxhash64(F.lit(31), "_h"), F.lit(1 << 40))
    near = once.join(F.broadcast(counts), F.col("_lang") == F.col("_l")).where(place.cast("double") * F.col("_n") < F.lit(4 * texts) * F.lit(float(1 << 40)))
    rank = F.row_number().over(Window.partitionBy("_lang").orderBy("_h"))
    chosen = near.withColumn("_rank", rank).where(F.col("_rank") <= texts).select("_lang", "_h", "_id")
    picked = rows.join(F.broadcast(chosen), ["_lang", "_h", "_id"], "left_semi").dropDuplicates(["_lang", "_h"])
    found = picked.select("_lang", "_text").repartition(SPREAD).mapInArrow(_passages, "lang string, passage string").collect()
    return train([(r["lang"], r["passage"]) for r in found]).compact()


def _told(model: Model, texts: list[str]) -> Iterator[tuple[list[int], np.ndarray, np.ndarray, list[tuple]]]:
    """Some texts at a time: their numbers, words of each, marginals of all words, and (text, offset, features) of pieces."""
    group: list[int] = []
    sizes: list[int] = []
    evidence: list[np.ndarray] = []
    places: list[tuple] = []
    parts: list[tuple[int, int, str]] = []
    letters = 0

    def read():
        nonlocal letters
        f = Features(" ".join(p for _, _, p in parts))
        evidence.append(model.evidence(f).astype(np.float32))
        edge = np.cumsum([len(p) + 1 for _, _, p in parts])
        begin = np.concatenate([[0], edge[:-1]])
        of = np.searchsorted(edge, f.starts, "right")
        for j, n in enumerate(np.bincount(of, minlength=len(parts)).tolist()):
            sizes[parts[j][0]] += n
        offset = np.array([o for _, o, _ in parts]) - begin
        places.append((f.starts + offset[of], f.ends + offset[of]))
        parts.clear()
        letters = 0

    def done():
        if parts:
            read()
        counts = np.array(sizes, np.int64)
        e = np.concatenate(evidence) if evidence else np.zeros((0, len(model.langs)))
        begins = np.zeros(len(e), bool)
        begins[(np.cumsum(counts) - counts)[counts > 0]] = True
        return list(group), counts, marginals(e, begins, model.start, model.step), list(places)

    for i, text in enumerate(texts):
        group.append(i)
        sizes.append(0)
        at = 0
        for piece in _pieces(text, LETTERS):
            parts.append((len(sizes) - 1, at, piece))
            at += len(piece)
            letters += len(piece)
            if letters >= LETTERS:
                read()
        if sum(map(len, evidence)) + letters // 6 >= WORDS:
            yield done()
            for held in (group, sizes, evidence, places):
                held.clear()
    if group:
        yield done()


def predict(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, held_out, lang_pred, score, n_words, n_switches) of every row.

    ``score`` is the expected share of the text's words in that language (ties: the first in code point order),
    ``n_switches`` how often the likeliest language changes from a word to the next. Without a letter, or without a
    language learned, a text is ``und`` with score 0.
    """
    slim = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            names, score, n_words, switches = [UNKNOWN] * n, np.zeros(n), np.zeros(n, np.int64), np.zeros(n, np.int64)
            texts = [t for _, t in text_rows(batch, "_text")] if model.langs else []
            for group, counts, found, _ in _told(model, texts):
                some = np.flatnonzero(counts)
                if not len(some):
                    continue
                rows = np.array(group)[some]
                first = (np.cumsum(counts) - counts)[some]
                totals = np.add.reduceat(found, first, axis=0)
                best = totals.argmax(1)
                score[rows] = np.minimum(1.0, totals[np.arange(len(some)), best] / counts[some])
                label = found.argmax(1)
                change = np.concatenate([[0], label[1:] != label[:-1]])
                change[first] = 0
                n_words[rows], switches[rows] = counts[some], np.add.reduceat(change, first)
                for row, b in zip(rows.tolist(), best.tolist()):
                    names[row] = model.langs[b]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(names, pa.string()), pa.array(score), pa.array(n_words), pa.array(switches)],
                ["doc_id", "lang_pred", "score", "n_words", "n_switches"],
            )

    told = slim.mapInArrow(run, f"doc_id {dict(slim.dtypes)['doc_id']}, lang_pred string, score double, n_words long, n_switches long")
    return told.select("doc_id", held_out(F.col("doc_id"), FOLDS, FOLD).alias("held_out"), "lang_pred", "score", "n_words", "n_switches")


def spans(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, start, end, lang, n_words, score): runs of words in one language, by characters from 0.

    A run reaches from its first word's first letter to after its last word's last letter; its score is the mean
    probability of its language. A text without a letter has no run.
    """
    slim = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t for _, t in text_rows(batch, "_text")] if model.langs else []
            for group, counts, found, places in _told(model, texts):
                if not len(found):
                    continue
                starts, ends = (np.concatenate([p[j] for p in places]) for j in (0, 1))
                of, label = np.repeat(np.array(group), counts), found.argmax(1)
                first = np.flatnonzero(np.concatenate([[True], (of[1:] != of[:-1]) | (label[1:] != label[:-1])]))
                last = np.concatenate([first[1:], [len(of)]]) - 1
                mean = np.add.reduceat(found[np.arange(len(of)), label], first) / (last - first + 1)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(of[first])), pa.array(starts[first]), pa.array(ends[last]),
                     pa.array([model.langs[b] for b in label[first].tolist()], pa.string()), pa.array(last - first + 1), pa.array(np.minimum(1.0, mean))],
                    ["doc_id", "start", "end", "lang", "n_words", "score"],
                )

    return slim.mapInArrow(run, f"doc_id {dict(slim.dtypes)['doc_id']}, start long, end long, lang string, n_words long, score double")


def language(docs: DataFrame, texts: int = TEXTS, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """``predict`` with a model of the table's own labelled rows outside the held-out fold.

    Only the text decides a prediction. A null text is ``und`` with score 0, as is every text where no row can be learned
    from; a row without an id is not held out; repeated rows give repeated rows; an empty table gives none; other
    columns, whatever their names, are not carried.
    """
    return predict(docs, fit(docs, texts, doc_id, text, lang), doc_id, text)
