"""Places."""

from pyspark.sql import functions as F

from catalog.base import CLEAN, LOG, Registry, app_log, cleaned, sql, table
from footfall.functions.columns import ip_to_long
from footfall.functions.geohash import geohash
from footfall.operators import geo

QUERIES = Registry()


def geohash_sql(lat: str, lon: str, precision: int) -> str:
    """The cell text in SQL: interleaved bits of the two scaled coordinates."""
    total = 5 * precision
    lon_bits, lat_bits = (total + 1) // 2, total // 2
    x = f"CAST(floor(({lon} + 180e0) / 360e0 * {1 << lon_bits}e0) AS BIGINT)"
    y = f"CAST(floor(({lat} + 90e0) / 180e0 * {1 << lat_bits}e0) AS BIGINT)"
    chars = []
    for j in range(precision):
        bits = []
        for t in range(5):
            p = 5 * j + t
            axis, width = (x, lon_bits) if p % 2 == 0 else (y, lat_bits)
            bits.append(f"(({axis} >> {width - 1 - p // 2}) & 1) * {16 >> t}")
        chars.append(f"substr('0123456789bcdefghjkmnpqrstuvwxyz', CAST(1 + {' + '.join(bits)} AS INTEGER), 1)")
    return " || ".join(chars)


@QUERIES.add(
    "geohash_cells",
    sql([LOG], f"""SELECT event_id, {geohash_sql('latitude', 'longitude', 5)} AS cell5,
        {geohash_sql('latitude', 'longitude', 6)} AS cell6, {geohash_sql('latitude', 'longitude', 12)} AS cell12 FROM log"""),
)
def cells(spark, sf):
    return app_log(spark, sf).select(
        "event_id", *[geohash("latitude", "longitude", p).alias(f"cell{p}") for p in (5, 6, 12)]
    )


AREA = """area AS (SELECT 20e0 + (c_custkey % 60) / 4e0 AS lat, 100e0 + ((c_custkey * 7) % 50) / 4e0 AS lon,
    r_name AS province, n_name AS city, c_mktsegment AS region
  FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey)"""
DICT = f"""places AS (SELECT geohash, p.province AS province, p.city AS city, p.region AS region FROM (
    SELECT {geohash_sql('lat', 'lon', 6)} AS geohash, min({{'province': province, 'city': city, 'region': region}}) AS p FROM area GROUP BY 1))"""
RANGES = """ranges AS (SELECT p_partkey * 1500000 AS lo, p_partkey * 1500000 + 999999 AS hi,
    'C' || (p_size % 5) AS country, p_type AS province, p_brand AS city FROM part)"""
LOCATED = f"""located AS (
  SELECT c.event_id, c.latitude, c.longitude, c.cell,
    CASE WHEN p.geohash IS NOT NULL THEN 'gps' WHEN r.lo IS NOT NULL THEN 'ip' ELSE 'none' END AS located_by,
    CASE WHEN p.geohash IS NULL AND r.lo IS NOT NULL THEN r.country ELSE 'UNKNOWN' END AS country,
    coalesce(p.province, r.province, 'UNKNOWN') AS province, coalesce(p.city, r.city, 'UNKNOWN') AS city,
    coalesce(p.region, 'UNKNOWN') AS region
  FROM (SELECT *, {geohash_sql('latitude', 'longitude', 6)} AS cell FROM clean) c
  LEFT JOIN places p ON p.geohash = c.cell LEFT JOIN ranges r ON c.ip_number BETWEEN r.lo AND r.hi)"""


def area_points(spark, sf):
    key = F.col("c_custkey")
    return (
        table(spark, sf, "customer")
        .join(table(spark, sf, "nation"), F.col("n_nationkey") == F.col("c_nationkey"))
        .join(table(spark, sf, "region"), F.col("r_regionkey") == F.col("n_regionkey"))
        .select(
            (F.lit(20.0) + (key % 60) / F.lit(4.0)).alias("lat"),
            (F.lit(100.0) + ((key * 7) % 50) / F.lit(4.0)).alias("lon"),
            F.col("r_name").alias("province"), F.col("n_name").alias("city"), F.col("c_mktsegment").alias("region"),
        )
    )


def places(spark, sf):
    return geo.build_geo_dict(area_points(spark, sf), "lat", "lon")


def ip_ranges(spark, sf):
    return table(spark, sf, "part").select(
        (F.col("p_partkey") * 1500000).alias("lo"), (F.col("p_partkey") * 1500000 + 999999).alias("hi"),
        F.concat(F.lit("C"), (F.col("p_size") % 5).cast("string")).alias("country"),
        F.col("p_type").alias("province"), F.col("p_brand").alias("city"),
    )


def located(spark, sf):
    return geo.locate(cleaned(spark, sf), places(spark, sf), ip_ranges(spark, sf))


@QUERIES.add("geo_dictionary", sql([AREA, DICT], "SELECT * FROM places"))
def dictionary(spark, sf):
    return places(spark, sf)


@QUERIES.add(
    "gps_lookup",
    sql([LOG, CLEAN, AREA, DICT], f"""SELECT event_id, p.province AS gps_province, p.city AS gps_city, p.region AS gps_region
        FROM clean LEFT JOIN places p ON p.geohash = {geohash_sql('latitude', 'longitude', 6)}"""),
)
def gps(spark, sf):
    return geo.locate_gps(cleaned(spark, sf), places(spark, sf)).select("event_id", "gps_province", "gps_city", "gps_region")


@QUERIES.add(
    "ip_lookup",
    sql([LOG, CLEAN, RANGES], """SELECT event_id, ip_number, country AS ip_country, province AS ip_province, city AS ip_city
        FROM clean LEFT JOIN ranges ON ip_number BETWEEN lo AND hi"""),
)
def by_ip(spark, sf):
    return geo.locate_ip(cleaned(spark, sf), ip_ranges(spark, sf)).select(
        "event_id", ip_to_long("ip").alias("ip_number"), "ip_country", "ip_province", "ip_city"
    )


@QUERIES.add(
    "place_fallback",
    sql([LOG, CLEAN, AREA, DICT, RANGES, LOCATED], "SELECT event_id, located_by, country, province, city, region FROM located"),
)
def fallback(spark, sf):
    return located(spark, sf).select("event_id", "located_by", "country", "province", "city", "region")


@QUERIES.add(
    "unresolved_points",
    sql([LOG, CLEAN, AREA, DICT, RANGES, LOCATED], """SELECT cell AS geohash, count(*) AS events, min(latitude) AS latitude,
        min(longitude) AS longitude FROM located WHERE located_by = 'none' GROUP BY cell"""),
)
def unresolved(spark, sf):
    return geo.unresolved_points(located(spark, sf))
