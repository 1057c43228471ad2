"""Comments."""

from pyspark.sql import functions as F

from catalog.base import Registry, sql, table
from footfall.operators import profile, text

QUERIES = Registry()
STOP = ["the", "and", "de", "la", "le", "les", "des", "der", "die", "und"]
WORDS = "w AS (SELECT doc_id, list_filter(string_split_regex(lower(text), '[ \\t\\r\\n]+'), lambda x: x <> '') AS words FROM documents)"
STOP_SQL = ", ".join(f"'{s}'" for s in STOP)
KEPT = f"kept AS (SELECT doc_id, list_filter(words, lambda x: x NOT IN ({STOP_SQL})) AS words FROM w)"


def docs(spark, sf):
    return table(spark, sf, "documents")


@QUERIES.add("tokens", sql([WORDS], "SELECT doc_id, len(words)::BIGINT AS n, md5(array_to_string(words, ' ')) AS digest FROM w"))
def tokens(spark, sf):
    return text.tokenise(docs(spark, sf), "text").select(
        "doc_id", F.size("words").cast("long").alias("n"), F.md5(F.array_join("words", " ")).alias("digest")
    )


@QUERIES.add("stopwords_removed", sql([WORDS, KEPT], "SELECT doc_id, len(words)::BIGINT AS n, md5(array_to_string(words, ' ')) AS digest FROM kept"))
def stopwords(spark, sf):
    rows = text.drop_stopwords(text.tokenise(docs(spark, sf), "text"), STOP)
    return rows.select("doc_id", F.size("words").cast("long").alias("n"), F.md5(F.array_join("words", " ")).alias("digest"))


@QUERIES.add(
    "stopword_table",
    sql([WORDS], """SELECT doc_id, count(*) AS n FROM (SELECT doc_id, unnest(words) AS word FROM w)
        WHERE word NOT IN (SELECT unnest(string_split(lower(text), ' ')) FROM benchmark) GROUP BY doc_id"""),
)
def stopword_table(spark, sf):
    listed = table(spark, sf, "benchmark").select(F.explode(F.split(F.lower("text"), " ")).alias("word"))
    rows = text.drop_stopword_table(text.tokenise(docs(spark, sf), "text"), listed, "doc_id")
    return rows.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))


@QUERIES.add(
    "hashed_term_frequency",
    sql([WORDS], """SELECT doc_id, ('0x' || substr(md5(word), 1, 8))::BIGINT % 1000000 AS bucket, count(*)::DOUBLE AS frequency
        FROM (SELECT doc_id, unnest(words) AS word FROM w) GROUP BY ALL"""),
)
def hashed(spark, sf):
    return text.bucket_counts(text.tokenise(docs(spark, sf), "text"), "doc_id")


@QUERIES.add(
    "tfidf_weights",
    sql([WORDS, "tf AS (SELECT doc_id, word, count(*) AS tf FROM (SELECT doc_id, unnest(words) AS word FROM w) GROUP BY ALL)",
         "f AS (SELECT word, count(*) AS n FROM tf GROUP BY word)"],
        """SELECT doc_id, count(*) AS words, round(sum(tf * ln(((SELECT count(*) FROM documents) + 1) / (n + 1))), 3) AS weight
           FROM tf JOIN f USING (word) GROUP BY doc_id"""),
)
def weights(spark, sf):
    rows = text.tfidf(text.tokenise(docs(spark, sf), "text"), "doc_id")
    return rows.groupBy("doc_id").agg(F.count(F.lit(1)).alias("words"), F.round(F.sum("weight"), 3).alias("weight"))


@QUERIES.add("comment_classifier")
def classifier(spark, sf):
    labels = table(spark, sf, "labels").select("doc_id", F.col("quality").cast("double").alias("label"))
    train, test = profile.split(docs(spark, sf).join(labels, "doc_id"), "doc_id")
    model = text.fit_text(train, stopwords=STOP)
    return profile.classification_metrics(model.transform(text.prepare_text(test, stopwords=STOP)))


# Weighted counts per class, and the class whose logs add up highest, for documents outside the training split.
BAYES_WORDS = [
    WORDS, KEPT,
    """rated AS (SELECT doc_id, words, quality::DOUBLE AS label, ('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 8))::BIGINT < 3435973836 AS train
      FROM kept JOIN labels USING (doc_id) WHERE quality IS NOT NULL)""",
    "tf AS (SELECT doc_id, train, label, word, count(*) AS tf FROM (SELECT doc_id, train, label, unnest(words) AS word FROM rated) GROUP BY ALL)",
    """idf AS (SELECT word, ln(((SELECT count(*) FROM rated WHERE train) + 1) / (count(*) + 1)) AS idf FROM tf WHERE train GROUP BY word)""",
    "seen AS (SELECT label, word, sum(tf * idf) AS s FROM tf JOIN idf USING (word) WHERE train GROUP BY ALL)",
    """class AS (SELECT label, ln((n + 1) / (sum(n) OVER () + count(*) OVER ())) AS prior, ln(coalesce(s, 0) + (SELECT count(*) FROM idf)) AS whole
      FROM (SELECT label, count(*) AS n FROM rated WHERE train GROUP BY label) LEFT JOIN (SELECT label, sum(s) AS s FROM seen GROUP BY label) USING (label))""",
    """told AS (SELECT r.doc_id, r.label, c.label AS class, prior + coalesce(sum(tf * idf * (ln(coalesce(s, 0) + 1) - whole)), 0) AS score
      FROM rated r CROSS JOIN class c LEFT JOIN (SELECT doc_id, word, tf, idf FROM tf JOIN idf USING (word) WHERE NOT train) t ON t.doc_id = r.doc_id
      LEFT JOIN seen x ON x.word = t.word AND x.label = c.label WHERE NOT r.train GROUP BY r.doc_id, r.label, c.label, prior)""",
]


@QUERIES.add("comment_words", sql(BAYES_WORDS, "SELECT doc_id, label, arg_max(class, score) AS prediction FROM told GROUP BY doc_id, label"))
def comment_words(spark, sf):
    """Sentiment of comments by Bayes over real words, for comments the model was not fitted on."""
    labels = table(spark, sf, "labels").select("doc_id", F.col("quality").cast("double").alias("label")).where("label is not null")
    rows = text.prepare_text(docs(spark, sf).join(labels, "doc_id"), stopwords=STOP)
    train, test = profile.split(rows, "doc_id")
    found = text.classify_words(text.fit_words(train, "doc_id", "label"), test, "doc_id")
    return test.select("doc_id", "label").join(found, "doc_id")
