"""Models and neighbours on small tables."""

import math
import random

import pytest
from pyspark.ml.classification import NaiveBayesModel

from footfall.operators import neighbours, profile, text
from footfall.operators.clean import encode
from footfall.sources import models


@pytest.mark.parametrize("block_rows,pivots", [(4096, 16), (7, 5), (50, 1)])
def test_neighbours_equal_brute_force(spark, block_rows, pivots):
    rnd = random.Random(3)
    # A third of the samples sit on one spot, so ties and a crowded cell both occur.
    train = [(i, i % 4, [0.0, 0.0, 0.0] if i % 3 == 0 else [rnd.uniform(-5, 5) for _ in range(3)]) for i in range(150)]
    test = [(i, [rnd.uniform(-6, 6) for _ in range(3)]) for i in range(40)] + [(99, [0.0, 0.0, 0.0])]
    got = neighbours.nearest(
        spark.createDataFrame(train, "id long, label long, vec array<double>"),
        spark.createDataFrame(test, "id long, vec array<double>"), 3, pivots=pivots, block_rows=block_rows)
    found = {(r["test_id"], r["rank"]): r["train_id"] for r in got.collect()}
    expect = {}
    for tid, v in test:
        near = sorted((sum((a - b) ** 2 for a, b in zip(v, s)), i) for i, _, s in train)[:3]
        expect |= {(tid, n): i for n, (_, i) in enumerate(near, 1)}
    assert found == expect


def test_samples_are_sent_as_often_as_batches_visit(spark, monkeypatch):
    """Far clusters: queries of one see no sample of the others, and samples nobody asks for stay where they are."""
    sent = []
    plain = neighbours._rows_to_send

    def counted(celled, visits, batch):
        held, asked = plain(celled, visits, batch)
        sent.append((held.count(), asked.count()))
        return held, asked

    monkeypatch.setattr(neighbours, "_rows_to_send", counted)
    rnd = random.Random(4)
    train = [(i, i % 2, [100.0 * (i % 8) + rnd.random(), rnd.random()]) for i in range(800)]
    test = [(i, [rnd.random(), rnd.random()]) for i in range(90)]
    got = neighbours.nearest(
        spark.createDataFrame(train, "id long, label long, vec array<double>"), spark.createDataFrame(test, "id long, vec array<double>"), 3,
        pivots=32, block_rows=40)
    assert got.count() == 270
    # Ninety queries are three batches at most, a cluster has a hundred samples, and either visit reaches one cluster only.
    assert sum(held for held, _ in sent) <= 2 * 3 * 100 and all(held > 0 for held, _ in sent[:1])


def test_few_pairs_are_measured_and_copies_of_a_vector_once(spark, monkeypatch):
    import numpy as np

    rng = np.random.default_rng(2)
    samples = rng.normal(size=(3000, 24))
    samples[::4] = samples[0]
    points, ids = samples[:200], np.arange(3000)
    dist = ((samples[None] - points[:, None]) ** 2).sum(axis=2)
    dist[np.arange(200), np.arange(200)] = np.inf
    want = dist.argsort(axis=1, kind="stable")[:, :3]
    monkeypatch.setattr(neighbours, "SAMPLES", 500)
    for scale in (1.0, 1e-9, 1e9, 1e20):
        for bounds in (np.full(200, np.inf), scale**2 * np.take_along_axis(dist, want, 1)[:, 2]):
            q, s, found = neighbours._closest(scale * samples, ids, scale * points, ids[:200], bounds, 3, True)
            assert (s.reshape(200, 3) == want).all() and (q == np.repeat(np.arange(200), 3)).all()
            assert np.allclose(found, scale**2 * np.take_along_axis(dist, want, 1).ravel(), rtol=1e-12)
    # Vectors are stored once a query, not once for every block it visits.
    stored, tables = neighbours.stored, {}

    def kept(df, name):
        tables.setdefault(name, []).append(out := stored(df, name))
        return out

    monkeypatch.setattr(neighbours, "stored", kept)
    rows = spark.createDataFrame([(i, i % 3, v.tolist()) for i, v in enumerate(samples[:600])], "id long, label long, vec array<float>")
    got = neighbours.nearest(rows, rows, 3, skip_same_id=True, block_rows=50)
    single = samples[:600].astype("float32").astype("float64")
    dist = ((single[None] - single[:, None]) ** 2).sum(axis=2)
    dist[np.arange(600), np.arange(600)] = np.inf
    order = dist.argsort(axis=1, kind="stable")[:, :3]
    assert {(r["test_id"], r["rank"]): (r["train_id"], r["dist"]) for r in got.collect()} == {
        (i, n + 1): (int(order[i, n]), dist[i, order[i, n]]) for i in range(600) for n in range(3)}
    assert [t.count() for t in tables["visits"]] == [600, 600]


def test_no_majority_no_row(spark):
    train = spark.createDataFrame([(1, "a", [0.0]), (2, "b", [1.0]), (3, "c", [2.0]), (4, "c", [2.5])], "id long, label string, vec array<double>")
    test = spark.createDataFrame([(10, [0.9]), (11, [2.2])], "id long, vec array<double>")
    assert [tuple(r) for r in neighbours.knn(train, test).collect()] == [(11, "c", 2)]


def test_linear_and_metrics(spark):
    rows = spark.createDataFrame([(100.0, 20.0, 140.0), (150.0, 10.0, 165.0), (120.0, 20.0, 162.0), (110.0, 30.0, 172.0), (50.0, 20.0, 89.0)],
                                 "area double, floor double, price double")
    pred = profile.predict(profile.fit_linear(rows, ["area", "floor"], "price"), rows, ["area", "floor"])
    got = profile.regression_metrics(pred, "price").head()
    from pyspark.ml.evaluation import RegressionEvaluator

    for name in ("mse", "rmse", "r2", "mae"):
        assert got[name] == pytest.approx(RegressionEvaluator(labelCol="price", metricName=name).evaluate(pred))
    pairs = {(r["a"], r["b"]): r["corr"] for r in profile.correlation(rows, ["area", "floor", "price"]).collect()}
    assert pairs["area", "area"] == pytest.approx(1) and pairs["area", "price"] == pytest.approx(rows.stat.corr("area", "price"))


def test_churn(spark):
    quiet = [(1.0, 0.0, i % 3 * 1.0, 14.0 - i % 2) for i in range(10)]
    busy = [(0.0, 6.0 + i % 3, 28.0 + i, 1.0 + i % 2) for i in range(10)]
    rows = spark.createDataFrame(quiet + busy, "label double, n_3 double, n_15 double, last double")
    cols = ["n_3", "n_15", "last"]
    pred = profile.predict(profile.fit_churn(rows, cols), rows, cols)
    assert profile.classification_metrics(pred).head()["accuracy"] == 1.0
    assert profile.area_under_roc(pred) == 1.0


def test_trait_coding_and_saved_model(spark, tmp_path):
    people = spark.createDataFrame(
        [("teacher", "20002", 1.0), ("teacher", "20000", 1.0), ("coder", "42000", 1.0), ("clerk", "5000", 0.0), ("clerk", "15000", 0.0), ("pilot", "x", 0.0)],
        "job string, income string, label double")
    coded = encode(people, {"job": {"teacher": 1, "coder": 2, "clerk": 3}}, {"income": [(0, 10000), (10001, 20000), (20001, 30000), (30001, 40000)]})
    assert [(r["job_code"], r["income_code"]) for r in coded.collect()] == [(1, 3), (1, 2), (2, 5), (3, 1), (3, 2), (None, 5)]
    cols = ["job_code", "income_code"]
    with pytest.raises(Exception):
        profile.fit_traits(coded, cols)
    model = profile.fit_traits(coded, cols, fill=0.0)
    models.save_model(model, str(tmp_path / "m"))
    again = models.load_model(NaiveBayesModel, str(tmp_path / "m"))
    one = [r["prediction"] for r in profile.predict(model, coded, cols).collect()]
    assert one == [r["prediction"] for r in profile.predict(again, coded, cols).collect()]
    assert [p is None for p in one] == [False] * 5 + [True]


def test_scaling_uses_the_training_range(spark):
    train = spark.createDataFrame([(0.0, 5.0), (10.0, 15.0)], "a double, b double")
    test = spark.createDataFrame([(5.0, 25.0)], "a double, b double")
    assert tuple(profile.minmax(train, test, ["a", "b"]).select("a_norm", "b_norm").head()) == (0.5, 2.0)
    gaps = spark.createDataFrame([(None, 25.0)], "a double, b double")
    assert tuple(profile.minmax(train, gaps, ["a", "b"]).select("a_norm", "b_norm").head()) == (None, 2.0)


def test_gender_models(spark):
    rows = spark.createDataFrame([(i % 2 * 1.0, 105.0 + 7 * (i % 2), 107.0 + 9 * (i % 2), 5.0 + i, 100.0 + 2000 * (i % 2)) for i in range(12)],
                                 "label double, category1 double, category2 double, cnts double, amt double")
    _, by_amount = profile.fit_gender(rows, ["category1", "category2"], ["cnts", "amt"])
    assert profile.classification_metrics(by_amount.transform(rows)).head()["accuracy"] == 1.0


def test_split_is_repeatable(spark):
    ids = spark.range(5000)
    train, test = profile.split(ids, "id", 0.8)
    assert train.count() + test.count() == 5000 and train.join(test, "id").count() == 0
    assert 3850 < train.count() < 4150
    assert train.exceptAll(profile.split(ids.repartition(5), "id", 0.8)[0]).count() == 0
    assert train.exceptAll(profile.split(ids, "id", 0.8, seed="x")[0]).count() > 0


def test_text_model(spark):
    rows = spark.createDataFrame([(i, i % 2 * 1.0, "Good fine great the" if i % 2 else "bad  poor\nawful the") for i in range(20)], "id long, label double, text string")
    words = text.drop_stopwords(text.tokenise(rows, "text"), ["the"])
    assert words.where("id = 0").head()["words"] == ["bad", "poor", "awful"]
    weights = {r["word"]: r["weight"] for r in text.tfidf(words, "id").where("id = 0").collect()}
    import math

    assert weights == pytest.approx({w: math.log(21 / 11) for w in ("bad", "poor", "awful")})
    model = text.fit_text(rows, stopwords=["the"])
    assert profile.classification_metrics(model.transform(text.prepare_text(rows, stopwords=["the"]))).head()["accuracy"] == 1.0


def test_word_bayes_against_sums(spark):
    """Scores summed word by word in plain Python; null and empty texts, unseen words, and a class with a single text."""
    data = [(1, "good fine good", 1.0), (2, "bad poor", 0.0), (3, "good bad fine", 1.0), (4, "poor poor bad good", 0.0), (5, "odd", 2.0), (6, None, 1.0), (7, "x", None)]
    new = [(10, "good good poor"), (11, "bad bad odd"), (12, "never seen"), (13, None), (14, ""), (15, "odd odd")]
    train = text.prepare_text(spark.createDataFrame(data, "id long, text string, label double"))
    test = text.prepare_text(spark.createDataFrame(new, "id long, text string"))
    got = {r["id"]: r["prediction"] for r in text.classify_words(text.fit_words(train, "id", "label"), test, "id").collect()}
    known = [(t.split() if t else [], c) for _, t, c in data if c is not None]
    vocabulary = {w for words, _ in known for w in words}
    idf = {w: math.log((len(known) + 1) / (sum(w in words for words, _ in known) + 1)) for w in vocabulary}
    classes = sorted({c for _, c in known})
    for i, t in new:
        scores = []
        for c in classes:
            own = [words for words, d in known if d == c]
            weight = {w: sum(words.count(w) for words in own) * idf[w] for w in vocabulary}
            whole = math.log(sum(weight.values()) + len(vocabulary))
            score = math.log((len(own) + 1) / (len(known) + len(classes)))
            scores.append(score + sum(idf[w] * (math.log(weight[w] + 1) - whole) for w in (t or "").split() if w in idf))
        assert got[i] == classes[scores.index(max(scores))]
    table, none = text.fit_words(train.limit(0), "id", "label")
    assert table.count() == 0 and none == []
