"""From raw documents to token ids: filter, deduplicate, mix, encode."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from footfall.llm import bpe, mixing, quality, simhash, toxicity
from footfall.llm.common import documents, stored

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the toxicity model rejects go."""
    return toxicity.without_toxic(docs, _labels(spark, sf_dir))


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the quality model rejects go."""
    return quality.of_quality(docs, _labels(spark, sf_dir))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: the one with the smallest doc_id."""
    return simhash.first_of_each(docs, shingle=4, bits=4)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it; those it does not take go."""
    return mixing.mixed(docs, [3, 1, 2], tilt=mixing.by_length())


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every document of the mix, as digests, and of what they decode to."""
    return bpe.round_trip(docs, RANKS, public_tokenizers.PATTERN)


STAGES = [
    ("toxicity", drop_toxic),
    ("quality classifier", keep_quality),
    ("SimHash near-dedup", drop_near_copies),
    ("mixing sources", mix_sources),
    ("byte-level BPE", encode),
]

#: Models, hashes and tokenizers are not in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn over ``documents``; what each returns is stored and read again by the next."""
    docs = documents(spark, sf_dir)
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), "stage")
    return STAGES[-1][1](spark, docs, sf_dir)
