"""Multi-dimensional reports."""

from pyspark.sql import functions as F

from catalog.base import (
    IDS, LOG, PLACE, SPLIT, TO_GUID, TO_TRAFFIC, Registry, detail, known_users, sql, stored_detail, table, text, users_and_ids,
)
from footfall.functions.columns import hour_of_day
from footfall.operators import cube, identity
from footfall.operators.history import enrich
from footfall.operators.sessions import USER_DIMS

QUERIES = Registry()
MEASURES = ["pv_cnt", "session_cnt", "time_long", "jumpout_cnt", "uv_cnt", "return_user_cnt", "jumpout_user_cnt"]
MEASURES_SQL = """sum(pv_cnt)::BIGINT AS pv_cnt, sum(session_cnt)::BIGINT AS session_cnt, sum(time_long)::BIGINT AS time_long,
  sum(jumpout_cnt)::BIGINT AS jumpout_cnt, count(DISTINCT id) AS uv_cnt,
  count(DISTINCT CASE WHEN session_cnt > 1 THEN id END) AS return_user_cnt,
  count(DISTINCT CASE WHEN jumpout_cnt > 0 THEN id END) AS jumpout_user_cnt"""
FROM_TRAFFIC = "FROM usertraffic u LEFT JOIN ids USING (guid)"
DIMS_SQL = ", ".join(USER_DIMS)


def base(spark, sf, dims, per_user=False):
    return cube.traffic_base(*users_and_ids(spark, sf), dims, per_user)


@QUERIES.add("traffic_base", sql(TO_TRAFFIC, f"SELECT {DIMS_SQL}, {MEASURES_SQL} {FROM_TRAFFIC} GROUP BY {DIMS_SQL}"))
def traffic_base(spark, sf):
    return cube.traffic_report(*users_and_ids(spark, sf), USER_DIMS)


@QUERIES.add(
    "traffic_cube",
    sql(TO_TRAFFIC, f"""SELECT grouping_id, count(*) AS cells, {', '.join(f'sum({m})::BIGINT AS {m}' for m in MEASURES)},
        max(uv_cnt)::BIGINT AS top_uv FROM (
          SELECT GROUPING({DIMS_SQL})::BIGINT AS grouping_id, {MEASURES_SQL} {FROM_TRAFFIC} GROUP BY CUBE ({DIMS_SQL})) GROUP BY grouping_id"""),
)
def traffic_cube(spark, sf):
    cells = cube.traffic_cube(base(spark, sf, USER_DIMS), USER_DIMS)
    return cells.groupBy("grouping_id").agg(
        F.count(F.lit(1)).alias("cells"), *[F.sum(m).alias(m) for m in MEASURES], F.max("uv_cnt").alias("top_uv")
    )


THREE = ["location", "device_type", "isnew"]


@QUERIES.add(
    "traffic_cube_cells",
    sql(TO_TRAFFIC, f"""SELECT {', '.join(THREE)}, GROUPING({', '.join(THREE)})::BIGINT AS grouping_id, {MEASURES_SQL}
        {FROM_TRAFFIC} GROUP BY CUBE ({', '.join(THREE)})"""),
)
def cells(spark, sf):
    return cube.traffic_cube(base(spark, sf, THREE), THREE)


@QUERIES.add(
    "cube_slice",
    sql(TO_TRAFFIC, f"SELECT device_type, {MEASURES_SQL} {FROM_TRAFFIC} GROUP BY device_type"),
)
def cube_slice(spark, sf):
    cells = cube.traffic_cube(base(spark, sf, THREE), THREE)
    return cube.cube_slice(cells, THREE, ["device_type"]).drop("grouping_id", "location", "isnew")


@QUERIES.add(
    "traffic_report",
    sql(TO_TRAFFIC, f"SELECT location, os_name, {MEASURES_SQL} {FROM_TRAFFIC} GROUP BY location, os_name"),
)
def report(spark, sf):
    return cube.traffic_report(*users_and_ids(spark, sf), ["location", "os_name"])


@QUERIES.add(
    "return_users_overall",
    sql(TO_TRAFFIC, f"""SELECT location, os_name, {MEASURES_SQL.replace('session_cnt > 1', 'sessions > 1')}
        FROM (SELECT *, sum(session_cnt) OVER (PARTITION BY guid) AS sessions FROM usertraffic) LEFT JOIN ids USING (guid)
        GROUP BY location, os_name"""),
)
def return_users(spark, sf):
    return cube.traffic_report(*users_and_ids(spark, sf), ["location", "os_name"], per_user=True)


@QUERIES.add(
    "grouping_sets_report",
    sql(TO_TRAFFIC, f"""SELECT location, device_type, os_name, GROUPING(location, device_type, os_name)::BIGINT AS grouping_id,
        {MEASURES_SQL} {FROM_TRAFFIC} GROUP BY GROUPING SETS ((location), (device_type, os_name), ())"""),
)
def chosen_sets(spark, sf):
    dims = ["location", "device_type", "os_name"]
    return cube.traffic_cube(base(spark, sf, dims), dims, [["location"], ["device_type", "os_name"], []])


@QUERIES.add(
    "region_rollup",
    """SELECT r_name, n_name, c_mktsegment, GROUPING(r_name, n_name, c_mktsegment)::BIGINT AS grouping_id,
         count(DISTINCT o_custkey) AS users
       FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
       JOIN region ON r_regionkey = n_regionkey GROUP BY ROLLUP (r_name, n_name, c_mktsegment)""",
)
def region_rollup(spark, sf):
    levels = ["r_name", "n_name", "c_mktsegment"]
    rows = (
        table(spark, sf, "orders")
        .join(table(spark, sf, "customer"), F.col("c_custkey") == F.col("o_custkey"))
        .join(table(spark, sf, "nation"), F.col("n_nationkey") == F.col("c_nationkey"))
        .join(table(spark, sf, "region"), F.col("r_regionkey") == F.col("n_regionkey"))
    )
    return cube.bitmap_rollup(cube.set_base(rows, "o_custkey", levels), levels, {"users_bitmap": "users"})


def product_dim(spark, sf):
    return table(spark, sf, "part").select(
        F.col("p_partkey").alias("id"), F.col("p_type").alias("cat_name"), F.col("p_brand").alias("brand_name")
    )


def page_dim(spark, sf):
    return table(spark, sf, "pages").select(
        F.col("page_id").alias("id"), F.concat(F.lit("column"), text(F.col("page_id") % 21)).alias("lanmu_name")
    )


STAR = """star AS (
  SELECT e.*, coalesce(p_type, '未知') AS cat_name, coalesce(p_brand, '未知') AS brand_name,
    coalesce('column' || (page_id % 21), '未知') AS lanmu_name
  FROM {src} e LEFT JOIN part ON p_partkey = CAST(product AS BIGINT) LEFT JOIN pages ON page_id = CAST(page AS BIGINT)
)"""
SHARE = """share AS (
  SELECT cat_name, brand_name, page AS page_id, lanmu_name, share_method, hour_of_day AS hour_range, devicetype AS device_type,
    s_suppkey + 1 AS id
  FROM star JOIN supplier ON guid = 'u' || s_suppkey WHERE eventid = 'click'
)"""
SHARE_SQL = "cat_name, brand_name, page_id, lanmu_name, share_method, hour_range, device_type"


def shares(spark, sf):
    return cube.share_base(detail(spark, sf), product_dim(spark, sf), page_dim(spark, sf), known_users(spark, sf), "click")


@QUERIES.add(
    "share_base",
    sql([*TO_GUID, STAR.format(src="ev"), SHARE],
        f"SELECT {SHARE_SQL}, count(*) AS share_cnt, count(DISTINCT id) AS share_users FROM share GROUP BY {SHARE_SQL}"),
)
def share_base(spark, sf):
    return cube.share_cube(shares(spark, sf), [cube.SHARE_DIMS]).drop("grouping_id")


@QUERIES.add(
    "share_cube",
    sql([*TO_GUID, STAR.format(src="ev"), SHARE], f"""SELECT grouping_id, count(*) AS cells, sum(share_cnt)::BIGINT AS share_cnt,
        sum(share_users)::BIGINT AS share_users, max(share_users) AS top_users FROM (
          SELECT GROUPING({SHARE_SQL})::BIGINT AS grouping_id, count(*) AS share_cnt, count(DISTINCT id) AS share_users
          FROM share GROUP BY CUBE ({SHARE_SQL})) GROUP BY grouping_id"""),
)
def share_cube(spark, sf):
    return cube.share_cube(shares(spark, sf)).groupBy("grouping_id").agg(
        F.count(F.lit(1)).alias("cells"), F.sum("share_cnt").alias("share_cnt"),
        F.sum("share_users").alias("share_users"), F.max("share_users").alias("top_users"),
    )


def star(spark, sf, events):
    """Detail rows with product, page and report dimensions."""
    rows = enrich(
        events,
        [
            (product_dim(spark, sf).withColumn("id", text("id")), "product", "id"),
            (page_dim(spark, sf).withColumn("id", text("id")), "page", "id"),
        ],
    )
    k = F.col("k")
    return rows.select(
        "guid", "eventid", "cat_name", "brand_name", "page", "lanmu_name", "area", "nation_name",
        F.col("releasechannel").alias("channel"), hour_of_day("timestamp").alias("hour_of_day"), "devicetype", "osname",
        F.concat(F.lit("type"), text(k % 4)).alias("order_type"), F.concat(F.lit("pay"), text(k % 3)).alias("pay_method"),
        (k % 2 == 0).alias("with_coupon"), (k % 5 == 0).alias("group_buy"), F.concat(F.lit("ad"), text(k % 6)).alias("ad_source"),
        F.concat(F.lit("slot"), text(k % 7)).alias("slot"), F.concat(F.lit("campaign"), text(k % 5)).alias("campaign"),
    )


REPORT_DIMS_SQL = """rep AS (
  SELECT s.*, releasechannel AS channel, 'type' || (k % 4) AS order_type, 'pay' || (k % 3) AS pay_method,
    k % 2 = 0 AS with_coupon, k % 5 = 0 AS group_buy, 'ad' || (k % 6) AS ad_source, 'slot' || (k % 7) AS slot,
    'campaign' || (k % 5) AS campaign, id
  FROM star s JOIN ids USING (guid)
)"""


def overview_sql(dims, metrics):
    cols = ", ".join(dims)
    parts = ", ".join(
        f"count(*) FILTER (WHERE eventid = '{e}') AS {m}_cnt, count(DISTINCT CASE WHEN eventid = '{e}' THEN id END) AS {m}_users"
        for m, e in metrics.items()
    )
    kinds = ", ".join(f"'{e}'" for e in metrics.values())
    return sql(
        [*TO_GUID, IDS, SPLIT, PLACE, STAR.format(src="place"), REPORT_DIMS_SQL],
        f"SELECT {cols}, {parts} FROM rep WHERE eventid IN ({kinds}) GROUP BY {cols}",
    )


def overview(spark, sf, dims, metrics):
    preds = {m: F.col("eventid") == e for m, e in metrics.items()}
    rows = stored_detail(spark, sf)
    ids = identity.allocate_ids(rows.select("guid"))
    base_ = cube.event_overview(star(spark, sf, rows), ids, dims, preds)
    return cube.overview_report(base_, dims, metrics, [dims]).drop("grouping_id")


INTERACTION = ["channel", "cat_name", "brand_name", "page", "lanmu_name", "area", "nation_name", "hour_of_day", "devicetype"]
LIKES = {"like": "click", "favourite": "view"}
TRADE = ["channel", "cat_name", "order_type", "pay_method", "with_coupon", "group_buy", "ad_source", "devicetype"]
STEPS = {"add_cart": "signup", "submit": "view", "pay": "purchase"}
SLOTS = ["slot", "page", "campaign", "area", "osname"]
ADS = {"exposure": "view", "click": "click"}


@QUERIES.add("interaction_overview", overview_sql(INTERACTION, LIKES))
def interaction(spark, sf):
    return overview(spark, sf, INTERACTION, LIKES)


@QUERIES.add("trade_overview", overview_sql(TRADE, STEPS))
def trade(spark, sf):
    return overview(spark, sf, TRADE, STEPS)


@QUERIES.add("slot_overview", overview_sql(SLOTS, ADS))
def slots(spark, sf):
    return overview(spark, sf, SLOTS, ADS)
