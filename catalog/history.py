"""History tables and dimensions."""

from pyspark.sql import functions as F

from catalog.base import Registry, sql, table, text
from footfall.operators import history

QUERIES = Registry()
DAY = "2003-01-01"

ZIP = """prev AS (SELECT o_orderkey AS oid, o_totalprice AS amount, o_orderstatus AS status, CAST(o_orderdate AS DATE) AS start_dt,
    CASE WHEN o_orderstatus = 'O' THEN DATE '9999-12-31' ELSE CAST(o_orderdate AS DATE) + 30 END AS end_dt FROM orders)"""
ADDED = """added AS (SELECT o_orderkey AS oid, o_totalprice AS amount, 'S' AS status FROM orders WHERE o_orderpriority = '1-URGENT')"""


@QUERIES.add(
    "version_roll",
    sql([ZIP, ADDED], f"""SELECT oid, amount, status, CAST(start_dt AS VARCHAR) AS start_dt, CAST(end_dt AS VARCHAR) AS end_dt FROM (
        SELECT oid, amount, status, start_dt, CASE WHEN end_dt = DATE '9999-12-31' AND oid IN (SELECT oid FROM added)
          THEN DATE '{DAY}' - 1 ELSE end_dt END AS end_dt FROM prev
        UNION SELECT oid, amount, status, DATE '{DAY}', DATE '9999-12-31' FROM added)"""),
)
def roll(spark, sf):
    orders = table(spark, sf, "orders")
    placed = F.to_date("o_orderdate")
    prev = orders.select(
        F.col("o_orderkey").alias("oid"), F.col("o_totalprice").alias("amount"), F.col("o_orderstatus").alias("status"),
        placed.alias("start_dt"),
        F.when(F.col("o_orderstatus") == "O", F.lit("9999-12-31").cast("date")).otherwise(F.date_add(placed, 30)).alias("end_dt"),
    )
    added = orders.where("o_orderpriority = '1-URGENT'").select(
        F.col("o_orderkey").alias("oid"), F.col("o_totalprice").alias("amount"), F.lit("S").alias("status")
    )
    rolled = history.scd2_roll(prev, added, DAY)
    return rolled.withColumns({"start_dt": text("start_dt"), "end_dt": text("end_dt")})


LEVELS = """levels AS (
  SELECT c_custkey AS member_id, 'basic' AS member_level_id, DATE '1900-01-01' AS start_dt, DATE '1997-06-30' + CAST(c_custkey % 700 AS INTEGER) AS end_dt FROM customer
  UNION ALL
  SELECT c_custkey, c_mktsegment, DATE '1997-07-01' + CAST(c_custkey % 700 AS INTEGER), DATE '9999-12-31' FROM customer)"""


@QUERIES.add(
    "orders_at_level",
    sql([LEVELS], """SELECT member_id, member_level_id, count(*) AS order_cnt, round(sum(o_totalprice), 2) AS order_amt
        FROM orders JOIN levels ON member_id = o_custkey AND CAST(o_orderdate AS DATE) BETWEEN start_dt AND end_dt GROUP BY ALL"""),
)
def at_level(spark, sf):
    customer = table(spark, sf, "customer")
    shift = (F.col("c_custkey") % 700).cast("int")
    basic = customer.select(
        F.col("c_custkey").alias("member_id"), F.lit("basic").alias("member_level_id"),
        F.lit("1900-01-01").cast("date").alias("start_dt"), F.date_add(F.lit("1997-06-30").cast("date"), shift).alias("end_dt"),
    )
    later = customer.select(
        F.col("c_custkey").alias("member_id"), F.col("c_mktsegment").alias("member_level_id"),
        F.date_add(F.lit("1997-07-01").cast("date"), shift).alias("start_dt"), F.lit("9999-12-31").cast("date").alias("end_dt"),
    )
    orders = table(spark, sf, "orders").select(
        F.col("o_custkey").alias("member_id"), F.col("o_totalprice").alias("order_amt"), F.col("o_orderdate").alias("create_time")
    )
    return history.as_of_level(orders, basic.unionByName(later)).withColumn("order_amt", F.round("order_amt", 2))


@QUERIES.add(
    "star_enrichment",
    """SELECT l_returnflag, p_type, coalesce(p_brand, '未知') AS p_brand, n_name AS supplier_nation, count(*) AS lines, round(sum(l_quantity), 2) AS quantity
       FROM lineitem LEFT JOIN part ON p_partkey = l_partkey
       LEFT JOIN supplier ON s_suppkey = l_suppkey LEFT JOIN nation ON n_nationkey = s_nationkey
       GROUP BY ALL""".replace("p_type,", "coalesce(p_type, '未知') AS p_type,", 1),
)
def star(spark, sf):
    part = table(spark, sf, "part").select("p_partkey", "p_brand", "p_type")
    supplier = table(spark, sf, "supplier").select("s_suppkey", "s_nationkey")
    nation = table(spark, sf, "nation").select("n_nationkey", F.col("n_name").alias("supplier_nation"))
    rows = history.enrich(
        table(spark, sf, "lineitem"),
        [(part, "l_partkey", "p_partkey"), (supplier, "l_suppkey", "s_suppkey"), (nation, "s_nationkey", "n_nationkey")],
    )
    return rows.groupBy("l_returnflag", "p_type", "p_brand", "supplier_nation").agg(
        F.count(F.lit(1)).alias("lines"), F.round(F.sum("l_quantity"), 2).alias("quantity")
    )
