"""Joins with missing keys, clashing names, and addresses that crowd in one block."""

import random

import pytest
from pyspark.sql import functions as F

from footfall.operators import geo, history, identity, sessions
from footfall.plans.joins import left_join

PLAN = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "8"}


@pytest.fixture
def shuffled(spark):
    """Joins by shuffle, with as many tasks as partitions."""
    old = {k: spark.conf.get(k) for k in PLAN}
    for k, v in PLAN.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in old.items():
        spark.conf.set(k, v)


def sizes(df):
    return [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]


def test_rows_without_a_key_spread(shuffled, rows):
    """Nine of ten rows have no key: no task of a join holds more than half again its share of them by partitions read."""
    events = shuffled.range(0, 8000, 1, 40).select(
        F.when(F.col("id") % 10 == 0, F.concat(F.lit("d"), F.col("id") % 50)).alias("deviceid"), F.lit(None).cast("string").alias("account"), "id"
    )
    best = shuffled.createDataFrame([(f"d{i}", f"a{i}") for i in range(0, 50, 20)], "deviceid string, best_account string")
    known = shuffled.createDataFrame([("a0",), ("d10",)], "guid string")
    resolved = identity.resolve_guid(events, best)
    assert rows(resolved.groupBy("guid").count()) == sorted([("a0", 160), ("a20", 160), ("a40", 160), ("d10", 160), ("d30", 160), (None, 7200)], key=repr)
    flagged = identity.flag_new(resolved, known)
    assert flagged.where("not newflag").count() == 320
    place = shuffled.createDataFrame([("u4pruy", "p", "c", "r")], "geohash string, province string, city string, region string")
    where = events.withColumns({c: F.when(F.col("id") % 10 == 0, F.lit(v)) for c, v in (("latitude", 57.64911), ("longitude", 10.40744))})
    located = geo.locate_gps(where, place)
    assert located.where("gps_city = 'c'").count() == 800
    contact = identity.flag_new_by_contact(events, best.select("deviceid", F.col("best_account").alias("account")))
    assert contact.where("not newflag").count() == 480
    for df in (resolved, flagged, located, contact):
        assert max(sizes(df)) <= 3000 and sum(sizes(df)) == 8000


def test_names_of_the_tables_stay(spark, rows):
    fact = spark.createDataFrame([(1, "x", 7, "s"), (None, "y", 8, "t")], "k int, name string, _spread int, _zero string")
    dim = spark.createDataFrame([(1, "one", 3), (2, "two", 4)], "id int, name string, _key0 int")
    got = left_join(fact, dim.withColumnRenamed("name", "label"), {"k": "id"})
    assert got.columns == ["k", "name", "_spread", "_zero", "label", "_key0"]
    assert rows(got) == sorted([(1, "x", 7, "s", "one", 3), (None, "y", 8, "t", None, None)], key=repr)
    rich = history.enrich(fact, [(dim, "k", "id"), (dim.withColumnRenamed("id", "n"), "_spread", "n")])
    assert rich.columns == ["k", "name", "_spread", "_zero", "k_name", "_key0", "_spread_name", "_spread__key0"]
    assert {(r["name"], r["k_name"], r["_spread_name"]) for r in rich.collect()} == {("x", "one", "未知"), ("y", "未知", "未知")}
    log = spark.createDataFrame([("s", 0, 5, "a"), ("s", 10**7, 6, "b"), (None, 3, 7, "c"), ("t", None, 8, "d")], "sessionid string, timestamp long, _slice long, _n string")
    cut = sessions.sessionize(log)
    assert cut.columns == [*log.columns, "newsessionid"]
    assert rows(cut.select("_slice", "_n", "newsessionid")) == sorted([(5, "a", "s_0"), (6, "b", "s_1"), (7, "c", None), (8, "d", None)], key=repr)


RANGES = "lo long, hi long, country string, province string, city string"


def crowd(spark, n=6000):
    """Half the events in one /16, a third of these from one address, and four in ten without an address."""
    rnd = random.Random(9)
    ranges, lo = [], 0
    while lo < 1 << 32:
        # Short ranges in the crowded block, and gaps between ranges.
        span = rnd.randrange(1, 300) if 10 << 24 <= lo < (10 << 24) + (1 << 16) else rnd.randrange(1, 1 << 24)
        ranges.append((lo, min(lo + span, (1 << 32) - 1), f"C{lo % 7}", f"P{lo}", "T"))
        lo += span + 1 + rnd.choice([0, 0, 50])
    events = []
    for i in range(n):
        if i % 10 < 4:
            ip = None if i % 20 < 10 else "no address"
        elif i % 10 < 9:
            ip = "10.0.77.5" if i % 3 == 0 else f"10.0.{rnd.randrange(256)}.{rnd.randrange(256)}"
        else:
            ip = ".".join(str(rnd.randrange(256)) for _ in range(4))
        events.append((i, ip, "x", 1))
    return events, ranges, spark.createDataFrame(events, "event_id long, ip string, _range string, _part int").repartition(7), spark.createDataFrame(ranges, RANGES)


def test_addresses_merge_or_broadcast(spark):
    events, ranges, frame, table = crowd(spark)

    def place(ip):
        if ip is None or not ip[0].isdigit():
            return None
        n = 0
        for p in ip.split("."):
            n = n * 256 + int(p)
        return next((r[2:] for r in ranges if r[0] <= n <= r[1]), None)

    want = {i: place(ip) for i, ip, *_ in events}
    for few, parts in ((10**6, None), (0, 1), (0, 5), (0, 16)):
        got = geo.locate_ip(frame, table, broadcast_ranges=few, parts=parts)
        assert got.columns == [*frame.columns, "ip_country", "ip_province", "ip_city"]
        found = {r["event_id"]: (r["ip_country"], r["ip_province"], r["ip_city"]) for r in got.collect()}
        assert len(found) == len(events) and all(found[i] == (w or (None, None, None)) for i, w in want.items())
    assert geo.locate_ip(frame, table.limit(0), broadcast_ranges=-1).where("ip_country is not null").count() == 0
    assert geo.locate_ip(frame.limit(0), table, broadcast_ranges=0).count() == 0


def test_a_crowded_block_spreads(spark):
    _, _, frame, table = crowd(spark)
    for few in (10**6, 0):
        work = sizes(geo.locate_ip(frame, table, broadcast_ranges=few, parts=8))
        assert max(work) <= 2 * 6000 / len(work) and sum(work) == 6000
