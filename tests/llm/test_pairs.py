"""Neighbour search, embedding and text near-duplicates against brute force."""

import math
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from footfall.llm import ann, cosine, simhash

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
VECTORS = "vec_id long, embedding array<float>, label int, id long, vector string, node long, cell int"


def roots(nodes, pairs):
    top = {n: n for n in nodes}

    def find(n):
        while top[n] != n:
            n = top[n]
        return n

    for a, b in pairs:
        a, b = find(a), find(b)
        top[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


@pytest.fixture(scope="module")
def embeddings(spark):
    return spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")


@pytest.fixture(scope="module")
def odd(spark):
    """Vectors that take no part, copies, signed zeros, repeated rows, and columns with names of the operators."""
    some = [
        (0, [1.0, 0.0, 0.0], 1), (0, [1.0, 0.0, 0.0], 1), (1, [1.0, -0.0, 0.0], 1), (2, None, 1), (3, [0.0, 0.0, 0.0], 1),
        (4, [float("nan"), 1.0, 0.0], 1), (5, [1.0, None, 0.0], 1), (6, [float("inf"), 0.0, 0.0], 1), (7, [1.0, 0.0, 0.0], None),
        (8, [1.0, 0.0, 0.0], 2), (9, [2.0, 0.1, 0.0], 1), (100, [0.0, 1.0, 0.0], 1), (None, [1.0, 0.0, 0.0], 1),
    ]
    return spark.createDataFrame([(*r, 1, "clash", 2, 3) for r in some], VECTORS)


def usable(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)


def neighbours(rows, k):
    ok = sorted((i, v) for i, v in rows if i is not None and usable(v))
    ids, m = np.array([i for i, _ in ok]), np.array([v for _, v in ok], np.float64)
    out = {}
    for at, q in enumerate(ids):
        if q % 100 == 0:
            d = np.sqrt(np.square(m - m[at]).sum(1))
            order = [j for j in np.lexsort((ids, d)) if j != at][:k]
            out[int(q)] = [(int(ids[j]), float(d[j])) for j in order]
    return out


def test_nearest_recall_and_distances(embeddings):
    many = embeddings.unionByName(
        embeddings.withColumn("vec_id", F.col("vec_id") + 10_000).withColumn("embedding", F.transform("embedding", lambda x, i: (x + F.sin(i + F.col("vec_id")) * 0.05).cast("float")))
    )
    for rows in (embeddings, many):
        want = neighbours([(r["vec_id"], r["embedding"]) for r in rows.collect()], 10)
        out = ann.nearest(rows, F.col("vec_id") % 100 == 0, 10).collect()
        got = {}
        for r in sorted(out, key=lambda r: (r["query_id"], r["rank"])):
            got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert got.keys() == want.keys() and all(len(v) == 10 for v in got.values())
        hit = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want) / (10 * len(want))
        assert hit >= 0.9
        exact = {q: dict(neighbours([(r["vec_id"], r["embedding"]) for r in rows.collect()], 10**9)[q]) for q in list(want)[:1]}
        for q, near in exact.items():
            assert all(s == pytest.approx(near[i], rel=1e-12) for i, s in got[q])
        assert all(v == sorted(v, key=lambda x: (x[1], x[0])) for v in got.values())


def test_nearest_edges(odd):
    out = [tuple(r) for r in ann.nearest(odd, F.col("vec_id") % 100 == 0, 10).orderBy("query_id", "rank").collect()]
    assert [(r[0], r[2]) for r in out if r[0] == 0] == [(0, 1), (0, 7), (0, 8), (0, 9), (0, 100)]
    assert [r[2] for r in out if r[0] == 100] == [0, 1, 7, 8, 9]
    assert [r[1] for r in out] == [1, 2, 3, 4, 5] * 2
    assert ann.nearest(odd.limit(0), F.col("vec_id") % 100 == 0, 10).count() == 0


def cosines(rows, threshold):
    """(links, component) by comparing all pairs."""
    ids = [i for i, _, _ in rows]
    ok = [(i, np.array(v, np.float64), lab) for i, v, lab in rows if usable(v) and lab is not None]
    pairs = []
    for at, (i, a, lab) in enumerate(ok):
        for j, b, other in ok[at + 1 :]:
            if lab == other and a @ b / (np.sqrt(a @ a) * np.sqrt(b @ b)) >= threshold:
                pairs.append((i, j))
    links = dict.fromkeys(ids, 0)
    for i, j in pairs:
        links[i] += 1
        links[j] += 1
    return links, roots(ids, pairs)


@pytest.mark.parametrize("threshold", [0.93, 0.6])
def test_cosine_links(embeddings, threshold):
    links, root = cosines([(r["vec_id"], r["embedding"], r["label"]) for r in embeddings.collect()], threshold)
    out = cosine.near_duplicates(embeddings, threshold).collect()
    assert {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in out} == {i: (links[i], root[i], root[i] == i) for i in links}
    assert len(out) == len(links)


def test_cosine_edges(odd):
    out = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in cosine.near_duplicates(odd, 0.93).collect()}
    assert len(out) == odd.distinct().count()
    assert out[0] == (2, 0, True) and out[1] == (2, 0, False) and out[9] == (2, 0, False)
    assert out[None] == (0, None, False)
    assert all(out[i] == (0, i, True) for i in (2, 3, 4, 5, 6, 7, 8, 100))
    assert cosine.near_duplicates(odd.limit(0), 0.93).count() == 0


def test_cosine_tiles(spark, monkeypatch):
    """Labels of many tiles: links between tiles and across their borders, crowds, copies, ids with several vectors."""
    monkeypatch.setattr(cosine, "TILE", 40)
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(4, 16))
    some = np.concatenate([rng.normal(size=(200, 16)), centres[rng.integers(0, 4, 300)] + rng.normal(size=(300, 16)) * 0.25])
    rows = [(int(i) + (1 << 60), [float(np.float32(x)) for x in v], int(at % 3 > 0)) for at, (i, v) in enumerate(zip(rng.permutation(1000), some))]
    rows += [((1 << 60) + 1000 + i, rows[i][1], rows[i][2]) for i in range(0, 500, 7)]
    links, root = cosines(rows, 0.8)
    assert max(links.values()) > 40 and 0 in links.values()
    out = cosine.near_duplicates(spark.createDataFrame(rows + rows[:50], "vec_id long, embedding array<float>, label int"), 0.8).collect()
    assert {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in out} == {i: (links[i], root[i], root[i] == i) for i in links}
    assert len(out) == len(links)
    # One vector in several labels, each its label's only one.
    alone = spark.createDataFrame([(i, [1.0, 2.0], f"label {i}") for i in range(40)], "vec_id long, embedding array<float>, label string")
    assert {tuple(r) for r in cosine.near_duplicates(alone, 0.93).collect()} == {(i, 0, i, True) for i in range(40)}
    # A second vector of an id counts with its own links.
    twice = spark.createDataFrame([(1, [1.0, 0.0], 1), (1, [0.0, 1.0], 1), (2, [0.0, 1.0], 1), (3, [1.0, 0.01], 1)], "vec_id long, embedding array<double>, label int")
    got = sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in cosine.near_duplicates(twice, 0.93).collect())
    assert got == [(1, 1, 1), (1, 2, 1), (2, 2, 1), (3, 1, 1)]


def test_cosine_disk(spark):
    """What is shuffled and stored grows with the vectors, not with their pairs."""
    n, d = 12_000, 64
    rows = spark.range(n).select(
        F.col("id").alias("vec_id"), F.transform(F.sequence(F.lit(1), F.lit(d)), lambda k: (F.pmod(F.xxhash64("id", k), F.lit(2001)) - 1000).cast("float")).alias("embedding"),
        F.lit(1).alias("label"),
    )
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def used():
        files = folders.getAllFiles()
        return {files.apply(i).getPath(): files.apply(i).length() for i in range(files.size())}

    before = used()
    assert cosine.near_duplicates(rows, 0.93).count() == n
    assert sum(size for path, size in used().items() if path not in before) < 4 * n * d * 4


def fingerprint(text, shingle=4):
    words = [w.decode() for w in WORD.findall((text or "").encode().lower())]
    if not words:
        return 0
    span = min(shingle, len(words))
    h = [xxhash.xxh64_intdigest(" ".join(words[i : i + span]).encode(), 42) for i in range(len(words) - span + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_simhash_groups(docs, texts, edge, nothing):
    fps = {i: fingerprint(t) for i, t in texts.items()}
    ids = sorted(fps)
    pairs = [(i, j) for at, i in enumerate(ids) for j in ids[at + 1 :] if (fps[i] ^ fps[j]).bit_count() <= 4]
    root = roots(ids, pairs)
    out = simhash.near_duplicates(docs, 4, 4).collect()
    assert {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in out} == {i: (f"{fps[i]:016x}", root[i]) for i in ids}
    kept = {r["doc_id"] for r in simhash.first_of_each(docs, 4, 4).collect()}
    assert kept == set(root.values())
    out = simhash.near_duplicates(edge, 4, 4).collect()
    assert len(out) == edge.count()
    assert {r["component_id"] for r in out if r["doc_id"] in (10, 11, 12)} == {10}
    assert {r["component_id"] for r in out if r["doc_id"] in (15, 16)} == {15}
    first = simhash.first_of_each(edge, 4, 4)
    assert first.columns == edge.columns
    assert sorted(str(r["doc_id"]) for r in first.collect()) == ["10", "13", "14", "15", "17", "18", "None"]
    assert simhash.near_duplicates(nothing, 4, 4).count() == 0 and simhash.first_of_each(nothing, 4, 4).count() == 0


@pytest.mark.parametrize("bits", [0, 2, 4, 9])
def test_ring_loses_no_pair(spark, bits):
    rng = np.random.default_rng(bits)
    base = rng.integers(0, 1 << 63, 60, dtype=np.int64).tolist()
    fps = set(base)
    for b in base:
        for _ in range(8):
            fps.add(b ^ sum(1 << int(x) for x in rng.choice(63, rng.integers(1, bits + 4), replace=False)))
    # One crowded key: many fingerprints that agree but for their lowest bits.
    fps |= set(range(300))
    pairs = [(a, b) for a in fps for b in fps if a < b and (a ^ b).bit_count() <= bits]
    want = roots(fps, pairs)
    simhash.CELL, before = 64, simhash.CELL
    try:
        found = simhash.links(spark.createDataFrame([(f,) for f in fps], "fp long"), bits).collect()
    finally:
        simhash.CELL = before
    assert roots(fps, [(r["a"], r["b"]) for r in found]) == want
    assert all((r["a"], r["b"]) and want[r["a"]] == want[r["b"]] for r in found)


def test_recall_over_many_cells(embeddings):
    """Cells of some 32 rows, crowded ones in blocks: the tree's top, the stopping test and second visits take part."""
    rows = [(r["vec_id"], r["embedding"]) for r in embeddings.collect()]
    want = neighbours(rows, 10)
    out = ann.nearest(embeddings, F.col("vec_id") % 100 == 0, 10, cell=32).collect()
    got = {}
    for r in out:
        got.setdefault(r["query_id"], {})[r["vec_id"]] = r["score"]
    assert got.keys() == want.keys() and all(len(v) == 10 for v in got.values())
    assert sum(len(got[q].keys() & dict(want[q]).keys()) for q in want) >= 0.95 * 10 * len(want)
    assert all(got[q][i] == pytest.approx(s, rel=1e-9) for q in want for i, s in want[q] if i in got[q])


def test_one_row_of_each_group_leads(spark):
    """An id may carry several texts: each group keeps one row, whatever leads another group."""
    rng = np.random.default_rng(3)
    x, other = (" ".join(f"w{i}" for i in rng.integers(0, 10_000, 400)) for _ in range(2))
    near = x + " end"
    assert (fingerprint(x) ^ fingerprint(near)).bit_count() <= 4 < (fingerprint(x) ^ fingerprint(other)).bit_count()
    rows = [(3, x), (5, near), (5, other), (5, other), (7, other + " end")]
    first = simhash.first_of_each(spark.createDataFrame(rows, "doc_id long, text string"), 4, 4).collect()
    assert sorted(tuple(r) for r in first) == [(3, x), (5, other)]
    first = simhash.first_of_each(spark.createDataFrame([(1, x), (1, near)], "doc_id long, text string"), 4, 4).collect()
    assert len(first) == 1
