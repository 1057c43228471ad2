"""Vector codes: mask search against all distances, whole rounds against plain Python, twin, edges."""

import math
from collections import defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from footfall.llm import codes
from footfall.llm.queries import QUERIES

VECTORS = "vec_id long, embedding array<float>, label int, _id string, _v int, _label string, error long, code string, e int"


@pytest.mark.parametrize("entries,width,spread", [(64, 4, 40), (64, 8, 3), (1, 4, 5), (17, 1, 6), (64, 2, 1), (5, 3, 10**8)])
def test_nearest_is_exact(entries, width, spread):
    rng = np.random.default_rng(entries * 100 + width)
    books = rng.integers(-spread, spread + 1, (entries, width))
    x = np.concatenate([rng.integers(-spread, spread + 1, (500, width)), books, rng.integers(-9 * spread, 9 * spread + 1, (50, width))])
    found, error = codes.Slices(books).nearest(x)
    every = ((x[:, None, :] - books[None]) ** 2).sum(2)
    assert (found == every.argmin(1)).all() and (error == every.min(1)).all()


def test_masks_hold_the_box():
    rng = np.random.default_rng(1)
    books, x, r = rng.integers(-9, 10, (40, 3)), rng.integers(-9, 10, (200, 3)), rng.integers(0, 8, 200)
    masks = codes.Slices(books).inside(x, r)
    for i, m in enumerate(masks.tolist()):
        assert {e for e in range(64) if m >> e & 1} == {e for e in range(40) if (abs(books[e] - x[i]) <= r[i]).all()}


def brute(rows, parts=16, entries=64, rounds=2):
    kept = [(i, [math.floor(256 * c) for c in v], g) for i, v, g in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    if not kept:
        return []
    w = len(kept[0][1]) // parts
    cut = [[tuple(v[p * w:(p + 1) * w]) for p in range(parts)] for _, v, _ in kept]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]

    def assign(p, part):
        return min((sum((a - b) ** 2 for a, b in zip(part, c)), e) for e, c in enumerate(books[p]))

    for _ in range(rounds):
        groups = defaultdict(list)
        for c in cut:
            for p in range(parts):
                groups[p, assign(p, c[p])[1]].append(c[p])
        for (p, e), members in groups.items():
            books[p][e] = tuple(sum(m[d] for m in members) // len(members) for d in range(w))
    total, out = defaultdict(int), []
    for (i, _, g), c in zip(kept, cut):
        best = [assign(p, c[p]) for p in range(parts)]
        out.append((i, "".join(f"{e:02x}" for _, e in best), sum(d for d, _ in best), g))
        total[g] += out[-1][2]
    sha = codes.digest(np.array(books))
    return sorted(((i, c, e, total[g], sha) for i, c, e, g in out), key=repr)


def table(spark, rows):
    return spark.createDataFrame([(i, v, g, "x", 1, "y", 2, "z", 3) for i, v, g in rows], VECTORS)


def test_against_plain_python(spark, rows):
    rng = np.random.default_rng(5)
    some = [(i, rng.normal(0, 0.4, 32).astype(np.float32).tolist(), int(i % 3)) for i in range(150)]
    # Copies under other ids, one whole row repeated, vectors that are dropped, and ids or labels that are null.
    some += [(200 + i, some[0][1], None) for i in range(40)] + [some[7], some[7], (None, some[9][1], 1), (300, [0.0] * 32, None)]
    some += [(301, None, 1), (302, [math.nan] * 32, 1), (303, [math.inf] + [0.0] * 31, 1), (304, [None] + [0.0] * 31, 1), (305, [], 1)]
    assert rows(codes.compress(table(spark, some))) == brute(some)
    assert rows(codes.compress(table(spark, some[:3]).repartition(3))) == brute(some[:3])


def test_edges(spark):
    out = codes.compress(table(spark, [(1, None, 1), (2, [math.nan], 1)]))
    assert out.count() == 0 and out.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    for bad in ([[0.0] * 17], [[0.0] * 16, [0.0] * 32], [[3e38] * 16, [-3e38] * 16]):
        with pytest.raises(Exception, match="parts|too large"):
            codes.compress(table(spark, [(i, v, 1) for i, v in enumerate(bad)])).collect()


def test_codes_decode_to_near_vectors(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    whole = codes.integers(rows).cache()
    books = codes.fit(whole)
    back = codes.decode(codes.encode(whole, books), books).join(rows, F.col("_id") == F.col("vec_id")).collect()
    assert len(back) == rows.count()
    for r in back:
        gap = sum((256 * a - 256 * b) ** 2 for a, b in zip(r["vector"], r["embedding"]))
        assert abs(math.sqrt(gap) - math.sqrt(r["error"])) <= math.sqrt(64)


@pytest.mark.parametrize("name", ["op12_filter_audit", "op13_vector_codes"])
def test_twins(spark, rows, name):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("documents", "labels", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    fn, sql = QUERIES[name]
    got = fn(spark, sf)
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    assert rows(got, *names) == sorted((tuple(r) for r in cur.fetchall()), key=repr)
