"""Comment classification: words, weights, and a model over them."""

from __future__ import annotations

import math
from collections.abc import Iterable

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import NaiveBayes
from pyspark.ml.feature import IDF, HashingTF, IDFModel
from pyspark.sql import Column, DataFrame, functions as F

from footfall.session import stored

# Word separators, number of hash buckets, smoothing.
SEPARATORS = "[ \\t\\r\\n]+"
BUCKETS = 1_000_000
SMOOTHING = 1.0


def words_of(text: Column | str) -> Column:
    """Lower-case words of a text, in order."""
    text = F.col(text) if isinstance(text, str) else text
    return F.array_remove(F.split(F.lower(text), SEPARATORS), "")


def tokenise(df: DataFrame, col: str, out: str = "words") -> DataFrame:
    return df.withColumn(out, words_of(col))


def drop_stopwords(df: DataFrame, stopwords: Iterable[str], col: str = "words") -> DataFrame:
    """Word lists without the stop words; order and repeats of the others stay."""
    stop = sorted(set(stopwords))
    if not stop:
        return df
    return df.withColumn(col, F.filter(F.col(col), lambda w: ~w.isin(*stop)))


def drop_stopword_table(df: DataFrame, stopwords: DataFrame, id_col: str, col: str = "words") -> DataFrame:
    """(id, pos, word) without the words of a table of any size."""
    return df.select(id_col, F.posexplode(col).alias("pos", "word")).join(
        stopwords.select("word").distinct(), "word", "left_anti"
    )


def hashed_tf(df: DataFrame, n: int = BUCKETS, col: str = "words", out: str = "tf") -> DataFrame:
    return HashingTF(inputCol=col, outputCol=out, numFeatures=n).transform(df)


def bucket_counts(df: DataFrame, id_col: str, n: int = BUCKETS, col: str = "words") -> DataFrame:
    """(id, bucket, frequency) of hashed words, one row per bucket that a text fills; no row without words.

    The bucket is the first 32 bits of the word's MD5 modulo ``n``. Words fold before their shuffle.
    """
    bucket = (F.conv(F.substring(F.md5("_word"), 1, 8), 16, 10).cast("long") % n).alias("bucket")
    words = df.select(F.col(id_col), F.explode_outer(col).alias("_word")).where(F.col("_word").isNotNull())
    return words.select(id_col, bucket).groupBy(id_col, "bucket").agg(F.count(F.lit(1)).cast("double").alias("frequency"))


def fit_idf(tf: DataFrame, col: str = "tf", out: str = "tfidf") -> IDFModel:
    return IDF(inputCol=col, outputCol=out).fit(tf)


def tfidf(df: DataFrame, id_col: str, col: str = "words") -> DataFrame:
    """(id, word, tf, weight) over the real words, without hashing: tf * ln((N + 1) / (df + 1)).

    Words fold to one row per document before they meet the document frequencies.
    """
    # The outer form keeps the optimizer from testing the word list in a filter of its own.
    words = df.select(id_col, F.explode_outer(col).alias("word")).where(F.col("word").isNotNull())
    tf = words.groupBy(id_col, "word").agg(F.count(F.lit(1)).alias("tf"))
    # Counting through ``tf`` lets both sides of the join read one shuffle.
    freq = tf.groupBy("word").agg(F.count_if(F.col("tf") > 0).alias("_df"))
    docs = df.agg(F.count(F.lit(1))).scalar()
    return (
        tf.join(freq, "word")
        .withColumn("weight", F.col("tf") * F.log((docs + 1) / (F.col("_df") + 1)))
        .select(id_col, "word", "tf", "weight")
    )


def fit_words(train: DataFrame, id_col: str, label: str, col: str = "words") -> tuple[DataFrame, list[tuple]]:
    """Naive Bayes over weighted real words: a table of words, and (label, log prior, log of all its weight) per class.

    The table holds per word its inverse document frequency and, for class i, ``_c{i}``: the log of the weight the word has in
    texts of the class, plus the smoothing. Classes are few: one row each comes to the driver. Rows without label are left out.
    """
    train = train.where(F.col(label).isNotNull())
    weights = tfidf(train, id_col, col).join(train.select(id_col, F.col(label).alias("_label")), id_col)
    sums = stored(
        weights.groupBy("word", "_label").agg(F.sum("weight").alias("_sum"), F.count(F.lit(1)).alias("_docs")), "word-weights"
    )
    size, rows = sums.select("word").distinct().count(), train.groupBy(label).agg(F.count(F.lit(1)).alias("n")).collect()
    total = {r["_label"]: r["_all"] for r in sums.groupBy("_label").agg(F.sum("_sum").alias("_all")).collect()}
    n = sum(r["n"] for r in rows)
    classes = [
        (r[label], math.log((r["n"] + SMOOTHING) / (n + SMOOTHING * len(rows))), math.log(total.get(r[label], 0.0) + SMOOTHING * size) if size else 0.0)
        for r in sorted(rows, key=lambda r: r[label])
    ]
    per_class = [
        F.log(F.coalesce(F.sum(F.when(F.col("_label") == c, F.col("_sum"))), F.lit(0.0)) + SMOOTHING).alias(f"_c{i}") for i, (c, *_) in enumerate(classes)
    ]
    idf = F.log((F.lit(n) + 1) / (F.sum("_docs") + 1)).alias("_idf")
    return sums.groupBy("word").agg(idf, *per_class), classes


def classify_words(model: tuple[DataFrame, list[tuple]], df: DataFrame, id_col: str, col: str = "words") -> DataFrame:
    """(id, prediction): the class with the highest sum of logs; words the model never saw say nothing, ties go to the lower class.

    Words fold to one row per text before they meet the model, and to one row per text again after it.
    """
    table, classes = model
    words = df.select(id_col, F.explode_outer(col).alias("word")).where(F.col("word").isNotNull())
    counts = words.groupBy(id_col, "word").agg(F.count(F.lit(1)).alias("_n"))
    x = F.col("_n") * F.col("_idf")
    sums = counts.join(table, "word").groupBy(id_col).agg(
        F.sum(x).alias("_x"), *[F.sum(x * F.col(f"_c{i}")).alias(f"_s{i}") for i in range(len(classes))]
    )
    zero = F.lit(0.0)
    scores = [
        F.struct((F.lit(prior) + F.coalesce(f"_s{i}", zero) - F.coalesce("_x", zero) * F.lit(whole)).alias("score"), F.lit(-i).alias("order"), F.lit(c).alias("label"))
        for i, (c, prior, whole) in enumerate(classes)
    ]
    return df.select(id_col).join(sums, id_col, "left").select(id_col, F.array_max(F.array(*scores))["label"].alias("prediction"))


def text_model(n: int = BUCKETS, label: str = "label") -> Pipeline:
    return Pipeline(
        stages=[
            HashingTF(inputCol="words", outputCol="tf", numFeatures=n),
            IDF(inputCol="tf", outputCol="tfidf"),
            NaiveBayes(featuresCol="tfidf", labelCol=label, smoothing=SMOOTHING),
        ]
    )


def fit_text(df: DataFrame, text: str = "text", stopwords: Iterable[str] = (), label: str = "label", n: int = BUCKETS) -> PipelineModel:
    """Words to hashed weights to naive Bayes, fitted as one model."""
    return text_model(n, label).fit(prepare_text(df, text, stopwords))


def prepare_text(df: DataFrame, text: str = "text", stopwords: Iterable[str] = ()) -> DataFrame:
    return drop_stopwords(tokenise(df, text), stopwords)
