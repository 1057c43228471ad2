"""Where it happened: geohash dictionary, IPv4 ranges, and the fallback between them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from footfall.functions.columns import ip_to_long
from footfall.functions.geohash import geohash
from footfall.plans.joins import left_join
from footfall.plans.scan import by_part, fresh, in_order

UNKNOWN_PLACE = "UNKNOWN"
_PLACE = ["province", "city", "region"]


def build_geo_dict(area: DataFrame, lat: str, lon: str, precision: int = 6) -> DataFrame:
    """One place per cell; of several points in a cell the smallest (province, city, region) wins."""
    return (
        area.withColumn("geohash", geohash(lat, lon, precision))
        .where(F.col("geohash").isNotNull())
        .groupBy("geohash")
        .agg(F.min(F.struct(*_PLACE)).alias("_p"))
        .select("geohash", *[F.col(f"_p.{c}").alias(c) for c in _PLACE])
    )


def locate_gps(
    events: DataFrame, places: DataFrame, precision: int = 6, lat: str = "latitude", lon: str = "longitude"
) -> DataFrame:
    """Add gps_province, gps_city, gps_region (null when the cell is not in the dictionary)."""
    named = places.select("geohash", *[F.col(c).alias(f"gps_{c}") for c in _PLACE])
    cell = fresh([*events.columns, *named.columns], "_cell")
    return left_join(events.withColumn(cell, geohash(lat, lon, precision)), named, {cell: "geohash"}).drop(cell)


#: A dictionary of so many ranges is broadcast; its rows hold two numbers and three names.
BROADCAST_RANGES = 1_000_000
_IP_PLACE = ["country", "province", "city"]


def locate_ip(events: DataFrame, ranges: DataFrame, ip: str = "ip", broadcast_ranges: int = BROADCAST_RANGES, parts: int | None = None) -> DataFrame:
    """Add ip_country, ip_province, ip_city from disjoint ranges (lo, hi, country, province, city).

    Up to ``broadcast_ranges`` ranges, counted first, go to every task, and no event is moved. A larger dictionary is merged
    with the events in the order of addresses. An address that is null or malformed has no place.
    """
    known = ranges.where(F.col("lo").isNotNull() & F.col("hi").isNotNull())
    if known.limit(broadcast_ranges + 1).count() <= broadcast_ranges:
        return _by_block(events, known, ip)
    return _by_merge(events, known, ip, parts)


def _by_block(events: DataFrame, ranges: DataFrame, ip: str) -> DataFrame:
    """The range condition gets an equality on the upper 16 bits, so it runs as a keyed join.

    A range is listed once per /16 block it touches, at most 65,536 extra rows over the whole dictionary.
    """
    taken = events.columns
    lo, hi, block, number = (fresh(taken, n) for n in ("_lo", "_hi", "_block", "_ip"))
    named = ranges.select(
        F.col("lo").alias(lo), F.col("hi").alias(hi), *[F.col(c).alias(f"ip_{c}") for c in _IP_PLACE],
        F.explode(F.sequence(F.shiftright("lo", 16), F.shiftright("hi", 16))).alias(block),
    )
    numbered = events.withColumn(number, ip_to_long(ip))
    hit = (F.shiftright(F.col(number), 16) == F.col(block)) & F.col(number).between(F.col(lo), F.col(hi))
    return numbered.join(F.broadcast(named), hit, "left").drop(number, block, lo, hi)


def _by_merge(events: DataFrame, ranges: DataFrame, ip: str, parts: int | None) -> DataFrame:
    """Ranges and events in one order of addresses, cut into parts; every event takes the last range before it.

    Events of one address, and those without one, are told apart by a number of their own, so they spread over as many parts
    as they fill. The range that is open where a part begins comes from the parts before it, one row per part.
    """
    part, at, order, found = (fresh(events.columns, n) for n in ("_part", "_at", "_order", "_range"))
    place = F.struct("lo", "hi", *_IP_PLACE)
    both = events.withColumns({at: ip_to_long(ip), order: F.monotonically_increasing_id()}).unionByName(
        # A range comes before the events at its first address.
        ranges.select(F.col("lo").cast("long").alias(at), F.lit(-1).cast("long").alias(order), place.alias(found)), allowMissingColumns=True
    )
    placed = in_order(both, [], [at, order], part, parts)
    last = placed.where(F.col(found).isNotNull()).groupBy(F.col(part).alias("_p")).agg(F.max(found).alias("_last"))
    before = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    # One row per part.
    every = placed.select(F.col(part).alias("_p")).distinct().join(F.broadcast(last), "_p", "left")
    names = {c: fresh(both.columns, c) for c in ("_p", "_open")}
    every = every.select(F.col("_p").alias(names["_p"]), F.last("_last", ignorenulls=True).over(before).alias(names["_open"]))
    so_far = Window.partitionBy(part).orderBy(at, order).rowsBetween(Window.unboundedPreceding, 0)
    rows = by_part(placed, part, parts).withColumn(found, F.last(found, ignorenulls=True).over(so_far))
    rows = rows.where(F.col(order) >= 0).join(F.broadcast(every), F.col(part) == F.col(names["_p"]))
    rows = rows.withColumn(found, F.coalesce(found, names["_open"]))
    hit = F.col(at).between(F.col(found)["lo"], F.col(found)["hi"])
    return rows.withColumns({f"ip_{c}": F.when(hit, F.col(found)[c]) for c in _IP_PLACE}).select(*events.columns, *[f"ip_{c}" for c in _IP_PLACE])


def locate(events: DataFrame, places: DataFrame, ranges: DataFrame, precision: int = 6) -> DataFrame:
    """Add country, province, city, region and ``located_by``: GPS first, then IP, else UNKNOWN.

    A GPS hit is taken whole; it never mixes with fields of the IP hit.
    """
    both = locate_ip(locate_gps(events, places, precision), ranges)
    by_gps = F.col("gps_province").isNotNull()
    by_ip = F.col("ip_country").isNotNull()
    unknown = F.lit(UNKNOWN_PLACE)

    def pick(gps, ip):
        return F.when(by_gps, gps).when(by_ip, ip).otherwise(unknown)

    return both.withColumns(
        {
            "located_by": F.when(by_gps, "gps").when(by_ip, "ip").otherwise("none"),
            "country": pick(unknown, F.col("ip_country")),
            "province": pick(F.col("gps_province"), F.col("ip_province")),
            "city": pick(F.col("gps_city"), F.col("ip_city")),
            "region": pick(F.col("gps_region"), unknown),
        }
    ).drop("gps_province", "gps_city", "gps_region", "ip_country", "ip_province", "ip_city")


def unresolved_points(located: DataFrame, precision: int = 6) -> DataFrame:
    """Cells that no dictionary knows, with their number of events: the list to look up later."""
    return (
        located.where((F.col("located_by") == "none") & F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
        .groupBy(geohash("latitude", "longitude", precision).alias("geohash"))
        .agg(
            F.count(F.lit(1)).alias("events"),
            F.min("latitude").alias("latitude"),
            F.min("longitude").alias("longitude"),
        )
    )
