"""What the two classifiers share: a bounded sample of labelled rows, numpy optimisation, scoring of whole texts."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from footfall.llm.common import forget, held_out, text_rows

FOLDS, FOLD = 4, 2
#: A cut leaves its rows in one partition; work on them spreads over so many.
SPREAD = 24


def sample(docs: DataFrame, labels: DataFrame, label: str, value: int | None, limit: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(text, label) of at most ``limit`` rows outside the held-out fold, chosen by a hash of the id.

    Rows whose label is ``value`` (None: either). A document with several labels counts as its largest. The
    hash, not the order of the input, picks the rows, so reruns agree.
    """
    key = F.xxhash64(F.lit(17), F.col("_id"))
    rows = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("_text")).where(~held_out(F.col("_id"), FOLDS, FOLD))
    known = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull())
    known = known.groupBy(F.col("doc_id").alias("_id")).agg(F.max(label).alias("_label"))
    known = known.where(~held_out(F.col("_id"), FOLDS, FOLD))
    if value is not None:
        known = known.where(F.col("_label") == value)
    # At most ``limit`` rows, so this broadcast is bounded.
    rows = rows.join(F.broadcast(known.orderBy(key, "_id").limit(limit)), "_id")
    # Repeated ids cannot exceed the limit either.
    return rows.orderBy(key, "_id", F.xxhash64("_text")).limit(limit).select("_text", "_label").repartition(SPREAD)


def pick(docs: DataFrame, limit: int, total: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """About ``limit`` unlabelled rows outside the held-out fold: those whose row hash falls below a share.

    The share is limit / total, so the expected number is bounded at any size.
    """
    share = min(1.0, limit / max(1, total))
    place = F.pmod(F.xxhash64(F.lit(23), F.col("_id"), F.col("_text")), F.lit(1 << 30))
    rows = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("_text")).where(~held_out(F.col("_id"), FOLDS, FOLD))
    return rows.where(place < int(share * (1 << 30))).limit(2 * limit).select("_text", F.lit(None).cast("int").alias("_label")).repartition(SPREAD)


class Adam:
    def __init__(self, params: list[np.ndarray], rate: float) -> None:
        self.params, self.rate, self.t = params, rate, 0
        self.m = [np.zeros_like(p) for p in params]
        self.v = [np.zeros_like(p) for p in params]

    def step(self, grads: list[np.ndarray]) -> None:
        self.t += 1
        for p, g, m, v in zip(self.params, grads, self.m, self.v):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            p -= self.rate * (m / (1 - 0.9**self.t)) / (np.sqrt(v / (1 - 0.999**self.t)) + 1e-8)


def sigmoid(z):
    return 0.5 * (1.0 + np.tanh(0.5 * np.asarray(z, np.float64)))


def scored(docs: DataFrame, score: Callable[[], Callable[[str], float]], threshold: float, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row; ``score`` makes the scoring function once per task."""
    slim = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        own = score()
        for batch in batches:
            found = np.array([own(t) for _, t in text_rows(batch, "_text")], np.float64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found)], ["doc_id", "score"])

    rows = slim.mapInArrow(run, f"doc_id {dict(slim.dtypes)['doc_id']}, score double")
    return rows.select(
        "doc_id", held_out(F.col("doc_id"), FOLDS, FOLD).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )


def kept(docs: DataFrame, score: Callable[[], Callable[[str], float]], keep: Callable[[float], bool], text: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns as they are, whose score passes ``keep``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        own = score()
        for batch in batches:
            yield batch.filter(pa.array([keep(own(t)) for _, t in text_rows(batch, text)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
