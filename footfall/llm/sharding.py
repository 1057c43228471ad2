"""Shards from a Feistel permutation of global row numbers."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from footfall.llm.common import numbered

ROUNDS = 6
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def _round(half: np.ndarray, key: int, mask: np.uint64) -> np.ndarray:
    x = (half + np.uint64(key)) * _MIX[0]
    x = (x ^ (x >> np.uint64(30))) * _MIX[1]
    x = (x ^ (x >> np.uint64(27))) * _MIX[2]
    return (x ^ (x >> np.uint64(31))) & mask


def _keys(seed: int) -> list[int]:
    return [int.from_bytes(np.random.default_rng([seed, r]).bytes(8), "little") for r in range(ROUNDS)]


def _walk(numbers: np.ndarray, n: int, seed: int, back: bool) -> np.ndarray:
    half = np.uint64(max(1, ((max(n, 2) - 1).bit_length() + 1) // 2))
    mask = (np.uint64(1) << half) - np.uint64(1)
    keys = _keys(seed)[::-1] if back else _keys(seed)

    def once(x: np.ndarray) -> np.ndarray:
        left, right = x >> half, x & mask
        for key in keys:
            if back:
                left, right = right ^ _round(left, key, mask), left
            else:
                left, right = right, left ^ _round(right, key, mask)
        return (left << half) | right

    out = once(np.asarray(numbers, np.uint64))
    # Cycle walking: the network permutes a power of four of at most 4n numbers; those past n go round again.
    while (far := out >= np.uint64(n)).any():
        out[far] = once(out[far])
    return out.astype(np.int64)


def permute(numbers: np.ndarray, n: int, seed: int) -> np.ndarray:
    """Where each of the row numbers 0 ... n-1 goes: a permutation that only ``n`` and ``seed`` decide."""
    return _walk(numbers, n, seed, False)


def row_at(places: np.ndarray, n: int, seed: int) -> np.ndarray:
    """The row number that stands at a place: inverse of ``permute``."""
    return _walk(places, n, seed, True)


def shard_rows(docs: DataFrame, shards: int, seed: int = 0, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Put all rows into ``shards`` shards by the law ``rows``: counts differ by one at most.

    Row numbers follow (doc_id, text) over all rows, nulls first; the permuted number gives shard (its
    remainder) and slot (its quotient), so both can be computed for any row number without the table, and
    runs agree however the input is cut. Repeated rows are rows of their own; a null text has size 8 and
    the checksum of no bytes; an empty table gives no rows; other columns are not carried.
    """
    body = F.coalesce(F.col(text).cast("binary"), F.lit(b""))
    slim = docs.select(
        F.col(doc_id).alias("doc_id"),
        (F.length(body) + 8).cast("long").alias("size"),
        F.crc32(body).alias("text_crc32"),
        F.xxhash64(F.col(text)).alias("_tie"),
    )
    rows = numbered(slim, [F.col("doc_id"), F.col("size"), F.col("text_crc32"), F.col("_tie")], "row_number").drop("_tie")
    n = rows.count()

    @F.pandas_udf("long")
    def place(number: pd.Series) -> pd.Series:
        return pd.Series(permute(number.to_numpy(), n, seed))

    at = F.col("place")
    return rows.withColumn("place", place("row_number")).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        (at % shards).cast("int").alias("shard"),
        F.floor(at / shards).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        "row_number",
    )
