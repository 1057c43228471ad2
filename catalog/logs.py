"""Cleaning and flat projections."""

from pyspark.sql import functions as F

from catalog.base import CLEAN, LOG, Registry, app_log, cleaned, sql, table, text
from footfall.functions.columns import (
    array_cardinality, blank_to_null, day_offset, month_offset, normalise_null, text_to_epoch_seconds, with_default,
)
from footfall.operators.clean import encode, extract_props, mask_fields

QUERIES = Registry()


@QUERIES.add("dirty_log_filter", sql([LOG, CLEAN], "SELECT event_id, eventid, ms AS timestamp FROM clean"))
def dirty_log_filter(spark, sf):
    return cleaned(spark, sf).select("event_id", "eventid", "timestamp")


@QUERIES.add(
    "blank_to_null",
    sql([LOG], """SELECT event_id, nullif(trim(account), '') AS account, nullif(trim(deviceid), '') AS deviceid FROM log"""),
)
def blanks(spark, sf):
    return app_log(spark, sf).select(
        "event_id", blank_to_null("account").alias("account"), blank_to_null("deviceid").alias("deviceid")
    )


@QUERIES.add("property_extraction", sql([LOG], "SELECT event_id, page, product, share_method, NULL::VARCHAR AS coupon FROM log"))
def properties(spark, sf):
    flat = extract_props(
        app_log(spark, sf), {"pageId": "page", "productId": "product", "shareMethod": "share_method", "couponId": "coupon"}
    )
    return flat.select("event_id", "page", "product", "share_method", "coupon")


SEGMENTS = {"AUTOMOBILE": 1, "BUILDING": 2, "FURNITURE": 3}
BALANCES = [(0, 2500), (2501, 5000), (5001, 7500)]


@QUERIES.add(
    "category_coding",
    """SELECT c_custkey,
         CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 1e0 WHEN 'BUILDING' THEN 2e0 WHEN 'FURNITURE' THEN 3e0 END AS segment_code,
         CASE WHEN b BETWEEN 0 AND 2500 THEN 1e0 WHEN b BETWEEN 2501 AND 5000 THEN 2e0
              WHEN b BETWEEN 5001 AND 7500 THEN 3e0 ELSE 4e0 END AS balance_code
       FROM (SELECT *, floor(c_acctbal) AS b FROM customer)""",
)
def coding(spark, sf):
    rows = table(spark, sf, "customer").select(
        "c_custkey", F.col("c_mktsegment").alias("segment"), F.floor("c_acctbal").alias("balance")
    )
    return encode(rows, {"segment": SEGMENTS}, {"balance": BALANCES}).select("c_custkey", "segment_code", "balance_code")


@QUERIES.add(
    "default_for_missing",
    sql([LOG], """SELECT event_id, coalesce(p_type, '未知') AS cat_name FROM log LEFT JOIN part ON p_partkey = CAST(product AS BIGINT)"""),
)
def defaults(spark, sf):
    part = table(spark, sf, "part").select(F.col("p_partkey").cast("string").alias("product"), "p_type")
    events = extract_props(app_log(spark, sf), {"productId": "product"})
    return events.join(part, "product", "left").select("event_id", with_default("p_type").alias("cat_name"))


@QUERIES.add(
    "masked_fields",
    sql([LOG], "SELECT event_id, sha256(account) AS account, sha256(ip) AS ip FROM log"),
)
def masked(spark, sf):
    return mask_fields(app_log(spark, sf).select("event_id", "account", "ip"), ["account", "ip"])


@QUERIES.add(
    "masked_shape",
    """SELECT c_custkey, regexp_replace(regexp_replace(regexp_replace(c_name, '[A-Z]', 'X', 'g'), '[a-z]', 'x', 'g'), '[0-9]', 'n', 'g') AS c_name
       FROM customer""",
)
def masked_shape(spark, sf):
    return mask_fields(table(spark, sf, "customer").select("c_custkey", "c_name"), ["c_name"], how="mask")


@QUERIES.add(
    "null_tokens",
    sql([LOG], """SELECT CASE WHEN CAST(k AS VARCHAR) NOT IN ('UNKNOWN', '内网IP', '0') THEN CAST(k AS VARCHAR) END AS token,
                  count(*) AS events FROM log GROUP BY 1"""),
)
def null_tokens(spark, sf):
    return app_log(spark, sf).groupBy(normalise_null("k").alias("token")).agg(F.count(F.lit(1)).alias("events"))


@QUERIES.add(
    "date_arithmetic",
    """SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) + 7 AS VARCHAR) AS plus_week, CAST(CAST(o_orderdate AS DATE) - 1 AS VARCHAR) AS day_before,
         CAST(CAST(CAST(o_orderdate AS DATE) + INTERVAL 1 MONTH AS DATE) AS VARCHAR) AS plus_month,
         CAST(epoch(o_orderdate) - 28800 AS BIGINT) AS epoch_east_8
       FROM orders""",
)
def date_arithmetic(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey",
        text(day_offset("o_orderdate", 7)).alias("plus_week"),
        text(day_offset("o_orderdate", -1)).alias("day_before"),
        text(month_offset("o_orderdate", 1)).alias("plus_month"),
        text_to_epoch_seconds(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")).alias("epoch_east_8"),
    )


@QUERIES.add(
    "array_cardinality",
    "SELECT doc_id, len(list_distinct(string_split(text, ' ')))::BIGINT AS words FROM documents",
)
def distinct_words(spark, sf):
    return table(spark, sf, "documents").select("doc_id", array_cardinality(F.split("text", " ")).alias("words"))
