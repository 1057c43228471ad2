"""One query per operator, with the parameters it would run with, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from footfall.llm import ann, audit, bpe, codes, cosine, ctw, huffman, langid, mixing, quality, sharding, simhash, toxicity
from footfall.llm.common import documents
from footfall.session import scratch_path

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ctw.score(documents(spark, sf_dir))


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_rows(documents(spark, sf_dir), 24)


def op3_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "embeddings")
    return ann.nearest(rows, F.col("vec_id") % 100 == 0, 10)


def op4_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir), [3, 1, 2], tilt=mixing.by_length()).select("doc_id", "source", "size", "source_size", "target", "copies", "taken")


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(documents(spark, sf_dir), RANKS, public_tokenizers.PATTERN)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(documents(spark, sf_dir), _table(spark, sf_dir, "labels"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(documents(spark, sf_dir), _table(spark, sf_dir, "labels"))


def op8_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cosine.near_duplicates(_table(spark, sf_dir, "embeddings"), 0.93)


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-files")
    huffman.write_ids(documents(spark, sf_dir), path, TOKENIZER, end=2)
    return huffman.digest(huffman.read_ids(spark, path))


def op10_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, sf_dir), shingle=4, bits=4)


def op11_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.language(documents(spark, sf_dir))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.audit(documents(spark, sf_dir), _table(spark, sf_dir, "labels"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codes.compress(_table(spark, sf_dir, "embeddings"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


#: Links and reachability of op8 over all pairs of a label.
OP8_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, x -> x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, x -> x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= 0.93
), reach(x, y) AS (
  SELECT vec_id, vec_id FROM embeddings UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x
), least AS (SELECT x, min(y) AS component_id FROM reach GROUP BY x),
direct AS (SELECT x, count(*) AS n_links FROM links GROUP BY x)
SELECT vec_id, coalesce(n_links, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN least ON least.x = vec_id LEFT JOIN direct ON direct.x = vec_id
"""


#: op12 with every document at every step of every order.
OP12_SQL = """
WITH words AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), failed AS (
  SELECT part, len(w) < 100 AS a, 100 * len(list_distinct(w)) < 80 * len(w) AS b,
    100 * len(regexp_extract_all(t, '[A-Z]')) > 10 * length(t) AS c, regexp_matches(t, '[#$%&*|]') AS d,
    coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false) AS e, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic
  FROM words LEFT JOIN (SELECT doc_id AS i, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY 1) ON i = doc_id
), kinds AS (
  SELECT part, a::INT + 2 * b::INT + 4 * c::INT + 8 * d::INT + 16 * e::INT AS mask, good, toxic, count(*) AS n FROM failed GROUP BY ALL
), letter AS (SELECT substr('ABCDE', i::INT, 1) AS l, 1 << (i::INT - 1) AS bit FROM range(1, 6) t(i)
), orders AS (
  SELECT a.l || b.l || c.l || d.l || e.l AS filter_order
  FROM letter a, letter b, letter c, letter d, letter e
  WHERE a.bit | b.bit | c.bit | d.bit | e.bit = 31
), steps AS (
  SELECT filter_order, step::INT AS step, bit,
    (SELECT sum(o.bit) FROM letter o WHERE position(o.l IN filter_order) < step)::INT AS before
  FROM orders, range(1, 6) s(step), letter WHERE l = substr(filter_order, step::INT, 1)
), told AS (
  SELECT part, filter_order, step, bit,
    sum(n) FILTER (WHERE mask & (coalesce(before, 0) | bit) = 0) AS kept,
    sum(n) FILTER (WHERE mask & coalesce(before, 0) = 0 AND mask & bit > 0) AS removed,
    sum(n) FILTER (WHERE mask & coalesce(before, 0) > 0 AND mask & bit > 0) AS redundant,
    sum(n) FILTER (WHERE mask = bit) AS unique_fails,
    sum(n) FILTER (WHERE mask & coalesce(before, 0) = 0 AND mask & bit > 0 AND good) AS good_lost,
    sum(n) FILTER (WHERE mask & coalesce(before, 0) = 0 AND mask & bit > 0 AND toxic) AS toxic_lost
  FROM kinds, steps GROUP BY part, filter_order, step, bit
)
SELECT part, filter_order, step, coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed,
  coalesce(redundant, 0)::BIGINT AS redundant, coalesce(unique_fails, 0)::BIGINT AS unique_fails,
  coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
  coalesce(sum(removed) OVER (PARTITION BY part, bit), 0)::BIGINT AS shapley
FROM told
"""


def _op13_round(n: int) -> str:
    """Assignment n to codebook n, and the codebook after it."""
    return f"""
a{n} AS (
  SELECT rid, p, min((d, e)) AS best FROM (
    SELECT rid, x.p, e, list_sum([(z[1] - z[2]) * (z[1] - z[2]) for z in list_zip(x, c)])::BIGINT AS d
    FROM x JOIN b{n} ON b{n}.p = x.p) GROUP BY rid, p
), m{n} AS (
  SELECT p, e, k, sum(v)::BIGINT AS s, count(*) AS n FROM (
    SELECT a{n}.p, best[2] AS e, unnest(x) AS v, generate_subscripts(x, 1) AS k FROM a{n} JOIN x ON x.rid = a{n}.rid AND x.p = a{n}.p)
  GROUP BY p, e, k
), b{n + 1} AS (
  SELECT b.p, b.e, coalesce(l.c, b.c) AS c FROM b{n} b LEFT JOIN (
    SELECT p, e, list((s - ((s % n) + n) % n) // n ORDER BY k) AS c FROM m{n} GROUP BY p, e) l ON l.p = b.p AND l.e = b.e
)"""


#: op13 with every distance worked out.
OP13_SQL = f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, vec_id, label, [floor(x::DOUBLE * 256)::BIGINT for x in embedding] AS v FROM embeddings
  WHERE len(embedding) > 0 AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
), x AS MATERIALIZED (
  SELECT rid, p, v[p * (len(v) // 16) + 1 : (p + 1) * (len(v) // 16)] AS x FROM kept, range(16) t(p)
), b0 AS (
  SELECT p, e, x AS c FROM x JOIN (SELECT rid, row_number() OVER (ORDER BY vec_id NULLS LAST, v) - 1 AS e FROM kept) USING (rid) WHERE e < 64
), {_op13_round(0)}, {_op13_round(1)}, {_op13_round(2)},
coded AS (
  SELECT rid, string_agg(printf('%02x', best[2]), '' ORDER BY p) AS code, sum(best[1])::BIGINT AS error FROM a2 GROUP BY rid
)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
  (SELECT sha256(string_agg(i, ',' ORDER BY p, e, k)) FROM (SELECT p, e, unnest(c)::VARCHAR AS i, generate_subscripts(c, 1) AS k FROM b2)) AS codebooks_sha256
FROM coded JOIN kept USING (rid)
"""

#: SQL twins. The others rest on hashes, models, permutations, approximate search or tokenizers, which SQL lacks.
SQL = {"op8_embedding_near_dedup": OP8_SQL, "op12_filter_audit": OP12_SQL, "op13_vector_codes": OP13_SQL}

#: name -> (query, SQL twin or None)
QUERIES: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {
    f.__name__: (f, SQL.get(f.__name__))
    for f in (
        op1_lm_scoring, op2_sharding, op3_nearest_neighbours, op4_source_mixing, op5_byte_bpe, op6_toxicity, op7_quality,
        op8_embedding_near_dedup, op9_token_files, op10_simhash_near_dedup, op11_language_id, op12_filter_audit, op13_vector_codes,
        pipeline,
    )
}
