"""Numeric models."""

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from catalog.base import LAST_DAY, LOG, Registry, app_log, sql, table
from footfall.functions.columns import squared_distance
from footfall.operators import neighbours, profile
from footfall.operators.clean import encode

QUERIES = Registry()
COLS = ["l_quantity", "l_discount", "l_tax", "l_extendedprice"]


@QUERIES.add(
    "feature_vector",
    "SELECT l_orderkey, l_linenumber, round(l_quantity + l_discount + l_tax + l_extendedprice, 4) AS total FROM lineitem",
)
def vectors(spark, sf):
    rows = profile.assemble(table(spark, sf, "lineitem"), COLS)
    items = vector_to_array("features")
    return rows.select("l_orderkey", "l_linenumber", F.round(sum((items[i] for i in range(1, 4)), items[0]), 4).alias("total"))


@QUERIES.add(
    "correlation_matrix",
    "SELECT a, b, round(corr(x, y), 6) AS corr FROM (" + " UNION ALL ".join(
        f"SELECT '{a}' AS a, '{b}' AS b, {a} AS x, {b} AS y FROM lineitem" for a in COLS for b in COLS
    ) + ") GROUP BY a, b",
)
def correlation(spark, sf):
    return profile.correlation(table(spark, sf, "lineitem"), COLS).withColumn("corr", F.round("corr", 6) + F.lit(0.0))


# Two-feature ridge in closed form: standardised moments, the penalty scaled by the label's deviation.
RIDGE = """m AS (SELECT stddev_samp(l_quantity) AS s1, stddev_samp(l_discount) AS s2, stddev_samp(l_extendedprice) AS sy,
    corr(l_quantity, l_discount) AS r12, corr(l_quantity, l_extendedprice) AS r1, corr(l_discount, l_extendedprice) AS r2,
    avg(l_quantity) AS m1, avg(l_discount) AS m2, avg(l_extendedprice) AS my FROM lineitem),
  w AS (SELECT *, 1 + 0.1e0 / sy AS d FROM m),
  model AS (SELECT (r1 * d - r2 * r12) / (d * d - r12 * r12) * sy / s1 AS b1, (r2 * d - r1 * r12) / (d * d - r12 * r12) * sy / s2 AS b2,
    m1, m2, my FROM w)"""
FEATURES = ["l_quantity", "l_discount"]


@QUERIES.add(
    "linear_regression",
    sql([RIDGE], """SELECT 'l_quantity' AS term, round(b1, 3) AS value FROM model UNION ALL SELECT 'l_discount', round(b2, 3) FROM model
        UNION ALL SELECT 'intercept', round(my - b1 * m1 - b2 * m2, 3) FROM model"""),
)
def linear(spark, sf):
    model = profile.fit_linear(table(spark, sf, "lineitem"), FEATURES, "l_extendedprice")
    terms = [*zip(FEATURES, map(float, model.coefficients)), ("intercept", float(model.intercept))]
    return spark.createDataFrame(terms, "term string, value double").withColumn("value", F.round("value", 3))


@QUERIES.add(
    "regression_metrics",
    sql([RIDGE, """err AS (SELECT l_extendedprice AS y, l_extendedprice - (my + b1 * (l_quantity - m1) + b2 * (l_discount - m2)) AS e
        FROM lineitem, model)"""],
        """SELECT round(avg(e * e), 0) AS mse, round(sqrt(avg(e * e)), 3) AS rmse, round(1 - avg(e * e) / var_pop(y), 6) AS r2,
           round(avg(abs(e)), 3) AS mae FROM err"""),
)
def metrics(spark, sf):
    rows = table(spark, sf, "lineitem")
    model = profile.fit_linear(rows, FEATURES, "l_extendedprice")
    got = profile.regression_metrics(profile.predict(model, rows, FEATURES), "l_extendedprice")
    return got.select(
        F.round("mse", 0).alias("mse"), F.round("rmse", 3).alias("rmse"), F.round("r2", 6).alias("r2"), F.round("mae", 3).alias("mae")
    )


HASH = "('0x' || substr(md5({}), 1, 8))::BIGINT < 3435973836"
#: Tight enough that what is left of the way to the optimum does not show in three decimals.
TIGHT = 1e-12


def logistic_sql(source: str, key: str, label: str, features: list[str], body: str) -> str:
    """Ridge logistic regression worked out in SQL, by gradient steps with momentum over standardised features.

    Fitted on the rows of ``source`` whose key falls into the training split; ``scored`` holds the others with ``p``, the
    probability of label 1. The penalty is on standardised weights, the intercept is free.
    """
    train = HASH.format(f"CAST({key} AS VARCHAR)")
    spread = ", ".join(f"avg({f}) AS m{i}, stddev_samp({f}) AS s{i}" for i, f in enumerate(features))
    unit = ", ".join(f"coalesce(({f} - m{i}) / nullif(s{i}, 0), 0)" for i, f in enumerate(features))
    step = ", ".join(f"w[{i}] + 0.9e0 * (w[{i}] - o[{i}]) - 0.25e0 * (avg(e * z[{i}]) + 0.1e0 * w[{i}])" for i in range(2, len(features) + 2))
    zeros = "[" + ", ".join(["0e0"] * (len(features) + 1)) + "]"
    return f"""WITH RECURSIVE {source},
spread AS (SELECT {spread} FROM input WHERE {train}),
z AS MATERIALIZED (SELECT {key}, {label} AS label, {train} AS train, [1e0, {unit}]::DOUBLE[] AS z FROM input, spread),
walk(i, w, o) AS (
  SELECT 0, {zeros}, {zeros} UNION ALL
  SELECT i + 1, [w[1] + 0.9e0 * (w[1] - o[1]) - 0.25e0 * avg(e), {step}], w
  FROM (SELECT i, w, o, z, 1 / (1 + exp(-list_dot_product(z, w))) - label AS e FROM walk, z WHERE train AND i < 600) GROUP BY i, w, o
), scored AS (
  SELECT {key}, label, 1 / (1 + exp(-list_dot_product(z, (SELECT arg_max(w, i) FROM walk)))) AS p FROM z WHERE NOT train
)
{body}"""


KINDS = ["view", "click", "signup", "purchase", "error"]
CHURN = [*[f"{e}_{n}" for e in KINDS for n in (3, 15)], "last_seen", "last_buy"]
CHURN_SQL = f"""feat AS (SELECT user_id, {', '.join(
    f"count(*) FILTER (WHERE event_type = '{e}' AND age < {n}) AS {e}_{n}" for e in KINDS for n in (3, 15))},
    min(age) AS last_seen, coalesce(min(age) FILTER (WHERE event_type = 'purchase'), 30) AS last_buy,
    CASE WHEN count(*) FILTER (WHERE age < 15) < 20 THEN 1e0 ELSE 0e0 END AS label
  FROM (SELECT *, date_diff('day', CAST(ts AS DATE), DATE '{LAST_DAY}') AS age FROM events) GROUP BY user_id)"""


def churn_features(spark, sf):
    age = F.datediff(F.lit(LAST_DAY).cast("date"), F.col("dt")).cast("long")
    log = app_log(spark, sf).select("user_id", "eventid", age.alias("age"))
    counts = [
        F.count_if((F.col("eventid") == e) & (F.col("age") < n)).alias(f"{e}_{n}") for e in KINDS for n in (3, 15)
    ]
    return log.groupBy("user_id").agg(
        *counts,
        F.min("age").alias("last_seen"),
        F.coalesce(F.min(F.when(F.col("eventid") == "purchase", F.col("age"))), F.lit(30)).cast("long").alias("last_buy"),
        F.when(F.count_if(F.col("age") < 15) < 20, 1.0).otherwise(0.0).alias("label"),
    )


@QUERIES.add("churn_features", sql([CHURN_SQL], "SELECT * FROM feat"))
def churn_input(spark, sf):
    return churn_features(spark, sf)


@QUERIES.add(
    "churn_probability",
    logistic_sql(CHURN_SQL + ", input AS (SELECT * FROM feat)", "user_id", "label", CHURN, """SELECT user_id, label,
        (p > 0.5)::INT::DOUBLE AS prediction, round(p, 3) AS churn FROM scored"""),
)
def churn(spark, sf):
    """Fitted on four fifths of the users, told for the others."""
    train, test = profile.split(churn_features(spark, sf), "user_id")
    pred = profile.predict(profile.fit_churn(train, CHURN, tol=TIGHT), test, CHURN)
    return pred.select("user_id", "label", "prediction", F.round(vector_to_array("probability")[1], 3).alias("churn"))


TRAITS = ["segment_code", "balance_code", "nation"]
SEGMENTS = {"AUTOMOBILE": 1, "BUILDING": 2, "FURNITURE": 3, "HOUSEHOLD": 4, "MACHINERY": 5}
BALANCES = [(0, 2500), (2501, 5000), (5001, 7500)]
TRAIT_SQL = """traits AS (SELECT c_custkey,
    CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 1e0 WHEN 'BUILDING' THEN 2e0 WHEN 'FURNITURE' THEN 3e0 WHEN 'HOUSEHOLD' THEN 4e0 WHEN 'MACHINERY' THEN 5e0 END AS segment_code,
    CASE WHEN b BETWEEN 0 AND 2500 THEN 1e0 WHEN b BETWEEN 2501 AND 5000 THEN 2e0 WHEN b BETWEEN 5001 AND 7500 THEN 3e0 ELSE 4e0 END AS balance_code,
    (c_nationkey + 1)::DOUBLE AS nation, CASE WHEN coalesce(n, 0) >= 10 THEN 1e0 ELSE 0e0 END AS label
  FROM (SELECT *, floor(c_acctbal) AS b FROM customer) LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) ON o_custkey = c_custkey)"""
# Multinomial Bayes with smoothing 1: log prior plus value times log share of each feature.
BAYES_SQL = [
    TRAIT_SQL,
    """sums AS (SELECT label, count(*) AS n, sum(segment_code) AS f1, sum(balance_code) AS f2, sum(nation) AS f3 FROM traits GROUP BY label)""",
    """bayes AS (SELECT label, ln((n + 1) / (sum(n) OVER () + count(*) OVER ())) AS prior, ln((f1 + 1) / (f1 + f2 + f3 + 3)) AS t1,
        ln((f2 + 1) / (f1 + f2 + f3 + 3)) AS t2, ln((f3 + 1) / (f1 + f2 + f3 + 3)) AS t3 FROM sums)""",
    """scored AS (SELECT c_custkey, t.label, arg_max(m.label, prior + segment_code * t1 + balance_code * t2 + nation * t3) AS prediction
        FROM traits t, bayes m GROUP BY c_custkey, t.label)""",
]


def traits(spark, sf, segments=SEGMENTS):
    orders = table(spark, sf, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    rows = (
        table(spark, sf, "customer")
        .join(orders, F.col("o_custkey") == F.col("c_custkey"), "left")
        .select(
            "c_custkey", F.col("c_mktsegment").alias("segment"), F.floor("c_acctbal").alias("balance"),
            (F.col("c_nationkey") + 1).cast("double").alias("nation"),
            F.when(F.coalesce("n", F.lit(0)) >= 10, 1.0).otherwise(0.0).alias("label"),
        )
    )
    return encode(rows, {"segment": segments}, {"balance": BALANCES})


@QUERIES.add(
    "trait_counts",
    sql([TRAIT_SQL], """SELECT label, feature, count(*) AS rows, sum(v) AS total FROM (
        SELECT label, 'segment_code' AS feature, segment_code AS v FROM traits UNION ALL
        SELECT label, 'balance_code', balance_code FROM traits UNION ALL SELECT label, 'nation', nation FROM traits) GROUP BY label, feature"""),
)
def trait_counts(spark, sf):
    return profile.trait_counts(traits(spark, sf), TRAITS)


def trait_predictions(spark, sf):
    rows = traits(spark, sf)
    return profile.predict(profile.fit_traits(rows, TRAITS), rows, TRAITS)


@QUERIES.add("trait_classifier", sql(BAYES_SQL, "SELECT c_custkey, label, prediction FROM scored"))
def trait_classifier(spark, sf):
    return trait_predictions(spark, sf).select("c_custkey", "label", "prediction")


# One segment has no code: those customers stay, without a prediction.
@QUERIES.add(
    "trait_missing",
    sql([TRAIT_SQL.replace("WHEN 'FURNITURE' THEN 3e0 ", ""), *BAYES_SQL[1:]], "SELECT c_custkey, label, prediction FROM scored"),
)
def trait_missing(spark, sf):
    rows = traits(spark, sf, {name: code for name, code in SEGMENTS.items() if name != "FURNITURE"})
    pred = profile.predict(profile.fit_traits(rows, TRAITS, fill=0.0), rows, TRAITS)
    return pred.select("c_custkey", "label", "prediction")


@QUERIES.add(
    "classification_accuracy",
    sql(BAYES_SQL, """SELECT count(*) FILTER (WHERE label = prediction) AS correct, count(*) AS total,
        round(count(*) FILTER (WHERE label = prediction) / count(*), 6) AS accuracy FROM scored"""),
)
def accuracy(spark, sf):
    return profile.classification_metrics(trait_predictions(spark, sf)).withColumn("accuracy", F.round("accuracy", 6))


# Area under the curve by ranks, ties counting half; class 1 scored by the difference of the two logs.
@QUERIES.add(
    "area_under_roc",
    sql([*BAYES_SQL[:3], """pts AS (SELECT t.c_custkey, t.label, sum(CASE WHEN m.label = 1 THEN 1 ELSE -1 END
          * (prior + segment_code * t1 + balance_code * t2 + nation * t3)) AS score FROM traits t, bayes m GROUP BY 1, 2)""",
         """rk AS (SELECT label, rank() OVER (ORDER BY round(score, 9)) + (count(*) OVER (PARTITION BY round(score, 9)) - 1) / 2e0 AS r FROM pts)"""],
        """SELECT round((sum(r) FILTER (WHERE label = 1) - count(*) FILTER (WHERE label = 1) * (count(*) FILTER (WHERE label = 1) + 1) / 2e0)
           / (count(*) FILTER (WHERE label = 1) * count(*) FILTER (WHERE label = 0)), 6) AS auc FROM rk"""),
)
def auc(spark, sf):
    value = profile.area_under_roc(trait_predictions(spark, sf), score="probability")
    return spark.createDataFrame([(round(value, 6),)], "auc double")


def buyers(spark, sf):
    """Traits with spending, the two kinds of features of the two-model profile."""
    spent = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count(F.lit(1)).cast("double").alias("buy_cnts"), F.sum("o_totalprice").alias("buy_amt")
    )
    return traits(spark, sf).join(spent, "c_custkey", "left").na.fill(0.0, ["buy_cnts", "buy_amt"])


AMOUNTS = ["buy_cnts", "buy_amt"]


@QUERIES.add("gender_by_category", sql(BAYES_SQL, "SELECT c_custkey, label, prediction FROM scored"))
def gender_by_category(spark, sf):
    rows = buyers(spark, sf)
    by_category, _ = profile.fit_gender(rows, TRAITS, AMOUNTS)
    return by_category.transform(rows).select("c_custkey", "label", "prediction")


@QUERIES.add(
    "gender_by_amount",
    logistic_sql(
        TRAIT_SQL + """, input AS (SELECT t.c_custkey, label, coalesce(n, 0)::DOUBLE AS buy_cnts, coalesce(amt, 0) AS buy_amt FROM traits t
          LEFT JOIN (SELECT o_custkey, count(*) AS n, sum(o_totalprice) AS amt FROM orders GROUP BY 1) ON o_custkey = t.c_custkey)""",
        "c_custkey", "label", AMOUNTS, "SELECT c_custkey, label, (p > 0.5)::INT::DOUBLE AS prediction, round(p, 3) AS p FROM scored"),
)
def gender_by_amount(spark, sf):
    """Fitted on four fifths of the customers, told for the others."""
    train, test = profile.split(buyers(spark, sf), "c_custkey")
    _, by_amount = profile.fit_gender(train, TRAITS, AMOUNTS, tol=TIGHT)
    return by_amount.transform(test).select("c_custkey", "label", "prediction", F.round(vector_to_array("probability")[1], 3).alias("p"))


@QUERIES.add(
    "min_max_scaling",
    f"""WITH b AS (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM orders WHERE {HASH.format("CAST(o_orderkey AS VARCHAR)")})
        SELECT o_orderkey, round((o_totalprice - lo) / (hi - lo), 6) AS o_totalprice_norm FROM orders, b
        WHERE NOT ({HASH.format("CAST(o_orderkey AS VARCHAR)")})""",
)
def scaling(spark, sf):
    train, test = profile.split(table(spark, sf, "orders"), "o_orderkey")
    scaled = profile.minmax(train, test, ["o_totalprice"])
    return scaled.select("o_orderkey", F.round("o_totalprice_norm", 6).alias("o_totalprice_norm"))


@QUERIES.add(
    "random_split",
    f"SELECT o_orderkey, CASE WHEN {HASH.format('CAST(o_orderkey AS VARCHAR)')} THEN 'train' ELSE 'test' END AS side FROM orders",
)
def random_split(spark, sf):
    train, test = profile.split(table(spark, sf, "orders"), "o_orderkey")
    return train.select("o_orderkey", F.lit("train").alias("side")).unionByName(
        test.select("o_orderkey", F.lit("test").alias("side"))
    )


NEAR = """near AS (SELECT test_id, train_id, label, dist, row_number() OVER (PARTITION BY test_id ORDER BY dist, train_id) AS rank FROM (
    SELECT a.vec_id AS test_id, b.vec_id AS train_id, b.label AS label,
      list_sum(list_transform(list_zip(a.embedding, b.embedding), lambda p: (p[1]::DOUBLE - p[2]::DOUBLE) * (p[1]::DOUBLE - p[2]::DOUBLE))) AS dist
    FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id))"""


def vectors_of(spark, sf):
    return table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), "label", F.col("embedding").alias("vec"))


@QUERIES.add("nearest_neighbours", sql([NEAR], "SELECT test_id, train_id, label, rank, round(dist, 6) AS dist FROM near WHERE rank <= 3"))
def nearest(spark, sf):
    rows = vectors_of(spark, sf)
    return neighbours.nearest(rows, rows, 3, skip_same_id=True).withColumn("dist", F.round("dist", 6))


@QUERIES.add(
    "neighbour_votes",
    sql([NEAR], "SELECT test_id, label, count(*) AS votes FROM near WHERE rank <= 3 GROUP BY test_id, label HAVING count(*) >= 2"),
)
def votes(spark, sf):
    rows = vectors_of(spark, sf)
    return neighbours.knn(rows, rows, 3, 2, skip_same_id=True)


@QUERIES.add(
    "distance_to_mean",
    """WITH flat AS (SELECT vec_id, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS i FROM embeddings),
         mean AS (SELECT i, avg(x) AS m FROM flat GROUP BY i)
       SELECT vec_id, round(sum((x - m) * (x - m)), 6) AS dist FROM flat JOIN mean USING (i) GROUP BY vec_id""",
)
def to_mean(spark, sf):
    rows = table(spark, sf, "embeddings")
    dims = rows.select(F.posexplode("embedding").alias("i", "x")).groupBy("i").agg(F.avg(F.col("x").cast("double")).alias("m"))
    # One value per dimension.
    centre = dims.agg(F.transform(F.sort_array(F.collect_list(F.struct("i", "m"))), lambda s: s["m"])).scalar()
    return rows.withColumn("centre", centre).select(
        "vec_id", F.round(squared_distance(F.col("embedding").cast("array<double>"), "centre"), 6).alias("dist")
    )


@QUERIES.add(
    "digit_regression",
    logistic_sql("input AS (SELECT vec_id, (label % 2)::DOUBLE AS target, embedding::DOUBLE[] AS e FROM embeddings)", "vec_id", "target",
                 [f"e[{i}]" for i in range(1, 65)], "SELECT vec_id, label AS target, (p > 0.5)::INT::DOUBLE AS prediction, round(p, 3) AS p FROM scored"),
)
def digits(spark, sf):
    """Fitted on four fifths of the vectors, told for the others."""
    rows = table(spark, sf, "embeddings").select("vec_id", "embedding", (F.col("label") % 2).cast("double").alias("target"))
    train, test = profile.split(rows, "vec_id")
    pred = profile.predict_binary(profile.fit_binary(train, "embedding", "target", tol=TIGHT), test, "embedding")
    return pred.select("vec_id", "target", "prediction", F.round(vector_to_array("probability")[1], 3).alias("p"))
