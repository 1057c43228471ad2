"""Toxicity by non-negative positive-unlabelled learning."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from footfall.llm.classify import FOLD, FOLDS, Adam, kept, pick, sample, scored, sigmoid
from footfall.llm.common import forget, held_out, text_rows, words

#: Hashed feature space; beginnings of words that are features beside the word itself.
SPACE = 1 << 20
STEMS = (4, 5, 6, 7)
EDGE = b".,;:!?\"'()[]{}|*&%$#@-_/\\"
#: Bounds of the training sample (documented parameters) and of the features a model uses.
POSITIVE, UNLABELLED = 2000, 6000
FEATURES = 2048
#: A feature needs this standard score.
GAP = 5.0
EPOCHS, RATE, RIDGE = 400, 0.05, 1e-4
#: Words a worker remembers the weight of.
KNOWN = 300_000


def features(word: bytes) -> list[int]:
    """The word and its beginnings, each hashed."""
    w = word.strip(EDGE)
    if not w:
        return []
    return [zlib.crc32(w) % SPACE] + [zlib.crc32(w[:n], n) % SPACE for n in STEMS if len(w) >= n]


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    forget()
    for batch in batches:
        found = [[f for w in set(words(t)) for f in features(w)] for _, t in text_rows(batch, "_text")]
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.int32()))], ["f"])


def _collect(rows: DataFrame) -> list[np.ndarray]:
    """Features of the sampled texts; copies count once, or their words would look like marks of toxicity."""
    once = rows.select("_text").distinct()
    found = [np.unique(np.array(r["f"], np.int64)) for r in once.mapInArrow(_vectors, "f array<int>").toLocalIterator()]
    return sorted(found, key=lambda f: (len(f), f.tolist()))


def train(positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float) -> tuple[np.ndarray, np.ndarray, float]:
    """(features, weights, bias) of a logistic model by the non-negative risk estimator.

    Risk: prior * R+(positive) + max(0, R-(unlabelled) - prior * R-(positive)). Where the bracket turns
    negative the model has begun to fit unlabelled positives as negatives, and the step goes back on it.
    Features are those that positives have more often than unlabelled texts, by their standard score.
    """
    n_p, n_u = max(1, len(positive)), max(1, len(unlabelled))
    df_p = np.bincount(np.concatenate([*positive, np.zeros(0, np.int64)]), minlength=SPACE)
    df_u = np.bincount(np.concatenate([*unlabelled, np.zeros(0, np.int64)]), minlength=SPACE)
    both = (df_p + df_u) / (n_p + n_u)
    gap = (df_p / n_p - df_u / n_u) / np.sqrt(both * (1 - both) * (1 / n_p + 1 / n_u) + 1e-12)
    chosen = np.argsort(-np.where(gap > GAP, gap, 0), kind="stable")[:FEATURES]
    chosen = np.sort(chosen[gap[chosen] > GAP])

    def matrix(rows):
        at = [np.searchsorted(chosen, r[np.isin(r, chosen, assume_unique=True)]) for r in rows]
        return np.repeat(np.arange(len(at)), [len(a) for a in at]), np.concatenate([*at, np.zeros(0, np.int64)])

    (rp, cp), (ru, cu) = matrix(positive), matrix(unlabelled)
    w, b = np.zeros(len(chosen)), np.array([np.log(prior / (1 - prior))])
    optimiser = Adam([w, b], RATE)
    for _ in range(EPOCHS):
        sp, su = (sigmoid(np.bincount(r, w[c], n) + b[0]) for r, c, n in ((rp, cp, len(positive)), (ru, cu, len(unlabelled))))
        # Sigmoid losses, as positive 1 - s and as negative s: bounded, so the bracket estimates a true risk.
        rest = su.sum() / n_u - prior * sp.sum() / n_p
        slope_p, slope_u = sp * (1 - sp) / n_p, su * (1 - su) / n_u
        if rest >= 0:
            gp, gu = -2 * prior * slope_p, slope_u
        else:
            gp, gu = prior * slope_p, -slope_u
        g = np.bincount(cp, gp[rp], len(w)) + np.bincount(cu, gu[ru], len(w))
        optimiser.step([g + RIDGE * w, np.array([gp.sum() + gu.sum()])])
    return chosen, w, float(b[0])


class Model:
    """Weights of features; scores whole texts."""

    def __init__(self, chosen: np.ndarray, weights: np.ndarray, bias: float) -> None:
        self.chosen, self.weights, self.bias = chosen, weights, bias

    def scorer(self) -> Callable[[str], float]:
        of = dict(zip(self.chosen.tolist(), self.weights.tolist()))
        known: dict[bytes, tuple] = {}

        def score(text: str) -> float:
            if len(known) > KNOWN:
                known.clear()
            hits: set[int] = set()
            for w in set(words(text)):
                found = known.get(w)
                if found is None:
                    found = known[w] = tuple(f for f in features(w) if f in of)
                if found:
                    hits.update(found)
            return float(sigmoid(self.bias + sum(of[f] for f in sorted(hits))))

        return score


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic") -> Model:
    """Train on at most 2,000 confirmed toxic and some 6,000 unlabelled texts, both chosen by hash.

    Only rows outside the held-out fold are used. The class prior is the share of toxic rows among labelled
    ones there, kept within 0.001 and 0.5. Without a toxic row the prior alone is the score.
    """
    known = labels.where(F.col(label).isNotNull() & ~held_out(F.col("doc_id"), FOLDS, FOLD))
    toxic, all_rows = known.agg(F.count_if(F.col(label) == 1), F.count(F.lit(1))).first()
    prior = min(0.5, max(0.001, toxic / all_rows if all_rows else 0.0))
    total = docs.count()
    positive = _collect(sample(docs, labels, label, 1, POSITIVE, doc_id, text))
    unlabelled = _collect(pick(docs, UNLABELLED, total, doc_id, text))
    return Model(*train(positive, unlabelled, prior))


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row.

    Only the text decides a score. A null text is scored as the empty one; repeated rows give repeated rows;
    an empty table gives none; other columns are not carried.
    """
    model = fit(docs, labels, doc_id, text)
    return scored(docs, model.scorer, threshold, doc_id, text)


def _passes(threshold: float, score: float) -> bool:
    return score < threshold


def without_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows that are not predicted toxic, with all their columns."""
    return kept(docs, fit(docs, labels, doc_id, text).scorer, partial(_passes, threshold), text)
