"""Language of words: marginals against all labelings, features against plain strings, held-out rows, spliced texts, edges."""

import math
import zlib
from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

from footfall.llm import langid

SF = "/root/testdata/sf0.01"


def every_labeling(e, start, step):
    """Marginals and expected transitions of one text, from the weights of all its labelings."""
    n, k = e.shape
    p, pairs, total = np.zeros((n, k)), np.zeros((k, k)), 0.0
    for y in product(range(k), repeat=n):
        w = math.exp(start[y[0]] + sum(e[t, y[t]] for t in range(n)) + sum(step[a, b] for a, b in zip(y, y[1:])))
        total += w
        for t in range(n):
            p[t, y[t]] += w
        for a, b in zip(y, y[1:]):
            pairs[a, b] += w
    return p / total, pairs / total


@pytest.mark.parametrize("sizes,k", [([1], 2), ([5, 1, 3, 6, 2, 1, 1, 4], 3), ([7], 3), ([1] * 30, 2), ([6, 5], 4)])
def test_marginals(sizes, k):
    rng = np.random.default_rng(sum(sizes) + k)
    start, step, e = rng.normal(0, 2, k), rng.normal(0, 2, (k, k)), rng.normal(0, 3, (sum(sizes), k))
    begins = np.zeros(len(e), bool)
    begins[np.cumsum([0, *sizes[:-1]])] = True
    cut = np.split(e, np.cumsum(sizes)[:-1])
    want = np.concatenate([every_labeling(x, start, step)[0] for x in cut])
    assert np.allclose(langid.marginals(e, begins, start, step), want, atol=1e-9)
    padded, real = np.zeros((len(sizes), max(sizes), k)), np.arange(max(sizes)) < np.array(sizes)[:, None]
    padded[real] = e
    found, pairs = langid._expected(padded, real, start, step)
    assert np.allclose(found[real], want, atol=1e-9)
    assert np.allclose(pairs, sum(every_labeling(x, start, step)[1] for x in cut), atol=1e-9)


def test_marginals_of_strong_evidence():
    """Thousands of words whose weights are far apart stay finite and sum to one."""
    rng = np.random.default_rng(4)
    e = rng.normal(0, 200, (5000, 3))
    begins = rng.random(5000) < 0.01
    begins[0] = True
    found = langid.marginals(e, begins, np.zeros(3), np.array([[2.0, -9, -9], [-9, 2, -9], [-9, -9, 2]]))
    assert np.isfinite(found).all() and np.allclose(found.sum(1), 1)


def test_features_against_strings():
    """Evidence is the sum of the weights of n-grams with borders, affixes and lexicons, spelled out per word."""
    rng = np.random.default_rng(2)
    text = "Der Hund, l'été 123 ÇA! a bb İx ßß 漢字 " + "q" * 300 + " Hund"
    model = langid.Model(["a", "b"], np.unique(langid.Features("hund ca").names), rng.normal(size=(3, 2)))
    model.member[-1] = 0
    model.weights[:] = rng.normal(size=model.weights.shape)
    model.weights[langid.SPACE] = 0
    model.known[:] = rng.normal(size=(2, 2))

    def row(kind, letters):
        return model.weights[langid._bucket(kind, *[np.array([ord(c) if c else 0], np.uint32) for c in letters])[0]]

    words, word = [], ""
    for c in text + " ":
        if c.isalpha():
            word += c.lower() if len(c.lower()) == 1 else c
        elif word:
            words.append(word)
            word = ""
    want = []
    for w in words:
        closed = ["", "", *w, ""]
        total = sum((row(1, [c]) for c in w), np.zeros(2))
        total = total + sum(row(2, closed[i - 1:i + 1]) for i in range(2, len(closed)))
        total = total + sum(row(3, closed[i - 2:i + 1]) for i in range(2, len(closed)))
        for n in langid.AFFIXES:
            if len(w) >= n:
                total = total + row(10 + n, w[:n]) + row(20 + n, w[-n:])
        at = np.flatnonzero(model.lexicon == langid.Features(w).names[0])
        want.append(total + (model.member[at[0]] @ model.known if len(at) else 0))
    f = langid.Features(text)
    assert [text[s:e].lower() for s, e in zip(f.starts, f.ends)][:3] == ["der", "hund", "l"]
    assert np.allclose(model.evidence(f), np.array(want))


def test_training_raises_the_likelihood():
    """Steps along the gradient make the given labels likelier than without training."""
    passages = [("x", "abra kadab raab dabra"), ("y", "olmo temol momel tolem")] * 12
    model = langid.train(passages, epochs=5)
    text = langid.Features("dabra raab olmo tolem")
    found = langid.marginals(model.evidence(text), np.array([True, False, False, False]), model.start, model.step)
    assert found.argmax(1).tolist() == [0, 0, 1, 1] and model.step[0, 0] > model.step[0, 1] and model.step[1, 1] > model.step[1, 0]
    assert np.abs(model.weights[langid.SPACE]).max() == 0


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def model(docs):
    return langid.fit(docs)


def test_held_out(docs, model):
    out = {r["doc_id"]: r for r in langid.predict(docs, model).collect()}
    rows = docs.select("doc_id", "lang").collect()
    assert len(out) == len(rows)
    for r in rows:
        assert out[r["doc_id"]]["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) and 0 <= out[r["doc_id"]]["score"] <= 1
    away = [out[r["doc_id"]]["lang_pred"] == r["lang"] for r in rows if out[r["doc_id"]]["held_out"]]
    assert sum(away) >= 0.98 * len(away)


def test_only_text_decides(docs):
    """Languages of held-out rows, sources and ids change no prediction."""
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    small = docs.where("doc_id < 300")
    other = small.withColumns({"lang": F.when(held, "zz").otherwise(F.col("lang")), "source": F.lit("s")})
    one, two = ({r["doc_id"]: r["lang_pred"] for r in langid.language(d).collect()} for d in (small, other))
    assert one == two


def test_spliced_texts(spark, docs, model):
    """A text of two languages falls into runs of both, nearly word by word."""
    texts = {r["lang"]: r["text"] for r in docs.where("doc_id % 4 = 2 and n_chars between 800 and 3000").collect()}
    one, two = texts["de"][:600].rsplit(" ", 1)[0], texts["en"][:500].rsplit(" ", 1)[0]
    table = spark.createDataFrame([(1, f"{one} {two} {one}"), (2, "12 34 !"), (3, None), (4, "")], "doc_id long, text string")
    runs = [r.asDict() for r in langid.spans(table, model).orderBy("doc_id", "start").collect()]
    assert {r["doc_id"] for r in runs} == {1}
    text, right = f"{one} {two} {one}", 0
    for r in runs:
        f = langid.Features(text[r["start"]:r["end"]])
        assert len(f) == r["n_words"] and f.starts[0] == 0 and f.ends[-1] == r["end"] - r["start"]
        for s in f.starts.tolist():
            right += r["lang"] == ("en" if len(one) < r["start"] + s <= len(one) + len(two) else "de")
    assert right >= 0.9 * len(langid.Features(text))
    got = {r["doc_id"]: r for r in langid.predict(table, model).collect()}
    assert got[1]["lang_pred"] == "de" and 0.4 < got[1]["score"] < 0.9 and got[1]["n_switches"] == len(runs) - 1
    assert all(got[i]["lang_pred"] == "und" and got[i]["score"] == 0 for i in (2, 3, 4))


def test_pieces_and_groups_change_nothing(docs, model, monkeypatch):
    some = [r["text"] for r in docs.where("doc_id < 60").collect()] + ["", "x" * 5000, "12"]

    def told():
        return [(i, c, f[a:a + c]) for g, n, f, _ in langid._told(model, some) for i, c, a in zip(g, n, np.cumsum(n) - n)]

    whole = told()
    monkeypatch.setattr(langid, "LETTERS", 700)
    monkeypatch.setattr(langid, "WORDS", 1000)
    for (i, c, f), (j, d, g) in zip(whole, told(), strict=True):
        assert (i, c) == (j, d) and np.allclose(f, g, atol=1e-6)


def test_edges(spark, edge, nothing, docs):
    out = langid.language(edge)
    assert out.count() == edge.count() and {r["lang_pred"] for r in out.collect()} == {"und"}
    assert langid.language(nothing).count() == 0 and langid.spans(edge, langid.fit(nothing)).count() == 0
    taught = edge.withColumn("lang", F.when(F.col("source") == "a", "l1").when(F.col("source") == "c", "l2"))
    got = langid.language(taught).collect()
    assert len(got) == edge.count() and {r["lang_pred"] for r in got} <= {"l1", "l2", "und"}
    assert all(r["lang_pred"] == "und" for r in got if r["doc_id"] in (11, 12))
    assert len({(r["doc_id"], r["lang_pred"], r["score"]) for r in got if r["doc_id"] in (10, 14)}) == 2
