"""Small tables with known answers."""

import hashlib

import pytest
from pyspark.sql import functions as F

from catalog import text as catalog_text
from footfall.functions import columns as c
from footfall.functions.geohash import geohash
from footfall.operators import activity, attribution, cube, geo, history, identity, quality, sketch, text
from footfall.session import cut_lineage

RELATION = "deviceid string, account string, score double, first_time long, last_time long"


def test_score_roll(spark):
    prev = spark.createDataFrame(
        [("d1", "c1", 200.0, 1, 10), ("d2", "c2", 800.0, 2, 8), ("d2", "c3", 600.0, 3, 7), ("d3", None, None, None, None),
         ("d4", "c4", 200.0, 1, 10), ("d5", None, None, None, None)], RELATION)
    cur = spark.createDataFrame(
        [("d1", "c1", 200.0, 11), ("d1", "c5", 100.0, 11), ("d2", "c3", 100.0, 11), ("d5", "c5", 200.0, 11),
         ("d6", "c6", 200.0, 11), ("d7", None, None, None)],
        "deviceid string, account string, score double, min_time long")
    got = {(r["deviceid"], r["account"]): (round(r["score"], 6), r["first_time"], r["last_time"])
           for r in identity.roll_scores(prev, cur, 99).collect()}
    assert got == {
        ("d1", "c1"): (400, 1, 11), ("d1", "c5"): (100, 11, 11), ("d2", "c2"): (560, 2, 8), ("d2", "c3"): (700, 3, 11),
        ("d3", None): (0, 99, 99), ("d4", "c4"): (140, 1, 10), ("d5", "c5"): (200, 11, 11), ("d6", "c6"): (200, 11, 11),
        ("d7", None): (0, 99, 99),
    }
    again = identity.roll_scores(prev, cur, 99)
    assert quality.check_mixed(again).count() == 0
    best = {r["deviceid"]: r["best_account"] for r in identity.best_account(again).collect()}
    assert best == {"d1": "c1", "d2": "c3", "d4": "c4", "d5": "c5", "d6": "c6"}


def test_guid_and_ids(spark):
    events = spark.createDataFrame(
        [("c1", "d1"), (None, "d1"), (" ", "d9"), (None, None)], "account string, deviceid string")
    best = spark.createDataFrame([("d1", "c7")], "deviceid string, best_account string")
    got = identity.resolve_guid(events, best)
    assert sorted((r["guid"] or "") for r in got.collect()) == ["", "c1", "c7", "d9"]
    table = spark.createDataFrame([(1, "c1"), (2, "x")], "id long, guid string")
    new = identity.allocate_ids(got, table)
    assert sorted(map(tuple, new.collect())) == [(3, "c7"), (4, "d9")]
    assert tuple(quality.check_dense(table.unionByName(new)).head()) == (4, 4, 4)
    # The same guids again need no new ids.
    assert identity.allocate_ids(got, table.unionByName(new)).count() == 0


ATTRIBUTION = [("g001", 1, "e1"), ("g001", 2, "e3"), ("g001", 3, "e5"), ("g001", 4, "e6"), ("g001", 5, "e5"), ("g001", 6, "e6"),
               ("g002", 1, "e3"), ("g002", 2, "e1"), ("g002", 3, "e5"), ("g002", 4, "e6")]


def weights(spark, data, cands=("e1", "e3", "e5"), **options):
    frame = spark.createDataFrame(data, "guid string, ts long, eventid string")
    seg = attribution.segments(frame, "e6", cands)
    return sorted((r["model"], r["guid"], r["segment"], r["event"], r["weight"]) for r in attribution.attribution(seg, "e6", **options).collect())


def test_attribution(spark):
    got = weights(spark, ATTRIBUTION)
    expect = []
    for model, one, two in [
        ("first", [("e1", 100.0)], [("e3", 100.0)]),
        ("last", [("e5", 100.0)], [("e5", 100.0)]),
        ("linear", [("e1", 33.33), ("e3", 33.33), ("e5", 33.33)], [("e3", 33.33), ("e1", 33.33), ("e5", 33.33)]),
        ("position", [("e1", 40.0), ("e3", 20.0), ("e5", 40.0)], [("e3", 40.0), ("e1", 20.0), ("e5", 40.0)]),
        ("time", [("e1", 36.9), ("e3", 33.21), ("e5", 29.89)], [("e3", 36.9), ("e1", 33.21), ("e5", 29.89)]),
    ]:
        expect += [(model, "g001", 0, e, w) for e, w in one] + [(model, "g002", 0, e, w) for e, w in two]
        expect.append((model, "g001", 1, "e5", 100.0))
    assert len(got) == 27
    assert got == sorted(expect)


def test_attribution_edges(spark):
    # Nothing before the target, events after the last target, a pair, late times, names with an underscore.
    data = [("a", 5, "e6"), ("b", 1, "e1"), ("b", 120, "e_3"), ("b", 1000, "e6"), ("b", 1001, "e1")]
    got = weights(spark, data, ("e1", "e_3"), models=["position", "last"])
    assert got == [("last", "b", 0, "e_3", 100.0), ("position", "b", 0, "e1", 50.0), ("position", "b", 0, "e_3", 50.0)]
    six = [("c", i, f"e{n}") for i, n in enumerate([11, 12, 13, 14, 15, 16])] + [("c", 99, "e6")]
    got = weights(spark, six, [f"e{n}" for n in range(11, 17)], models=["position"])
    assert [w for *_, w in got] == [40.0, 5.0, 5.0, 5.0, 5.0, 40.0]
    newest = weights(spark, ATTRIBUTION[:4], models=["time"], newest_first=True)
    assert [(e, w) for *_, e, w in newest] == [("e1", 29.89), ("e3", 33.21), ("e5", 36.9)]


PLACES = [(1, "南通市", "下关区"), (1, "南通市", "下关区"), (2, "南通市", "下关区"), (2, "南通市", "白领区"), (3, "南通市", "白领区"),
          (3, "南通市", "富豪区"), (1, "苏州市", "园林区"), (1, "苏州市", "园林区"), (4, "苏州市", "虎跳区")]


def test_roll_up_of_sets(spark):
    frame = spark.createDataFrame([(g, "江苏省", c_, r) for g, c_, r in PLACES], "guid long, province string, city string, region string")
    levels = ["province", "city", "region"]
    got = cube.bitmap_rollup(cube.set_base(frame, "guid", levels), levels, {"users_bitmap": "users"})
    counts = {(r["city"], r["region"]): r["users"] for r in got.where("grouping_id < 4 AND province IS NOT NULL").collect()}
    assert counts == {(None, None): 4, ("南通市", None): 3, ("苏州市", None): 2, ("南通市", "下关区"): 2, ("南通市", "白领区"): 2,
                      ("南通市", "富豪区"): 1, ("苏州市", "园林区"): 1, ("苏州市", "虎跳区"): 1}
    native = sketch.bitmap_merge(sketch.bitmap_base(frame, "guid", levels), ["city"])
    assert {r[0]: r[1] for r in sketch.bitmap_cardinality(native, ["city"]).collect()} == {"南通市": 3, "苏州市": 2}
    members = sketch.set_union(frame.withColumn("a", F.array("region")), ["city"], "a")
    assert members.count() == 5


def test_cube_in_two_steps_equals_one(spark, rows):
    frame = spark.range(3000).select(
        F.when(F.col("id") % 7 > 0, F.col("id") * 31 % 500).alias("id"), (F.col("id") % 3).alias("a"),
        F.when(F.col("id") % 5 > 0, F.col("id") % 5).alias("b"), (F.col("id") % 2).alias("c"), F.lit(1).alias("n"))
    base = frame.groupBy("a", "b", "c", cube.id_block("id").alias("block")).agg(F.sum("n").alias("n"), cube.word_of("id").alias("w"))
    one = cube.bitmap_cube(base, ["a", "b", "c"], ["n"], {"w": "users"})
    two = cube.bitmap_cube(base, ["a", "b", "c"], ["n"], {"w": "users"}, wide=["c", "a"])
    plain = frame.cube("a", "b", "c").agg(F.grouping_id().alias("grouping_id"), F.sum("n").alias("n"), F.countDistinct("id").alias("users"))
    order = ["a", "b", "c", "grouping_id", "n", "users"]
    assert rows(one, *order) == rows(two, *order) == rows(plain, *order)
    assert cube.cube_slice(two, ["a", "b", "c"], ["b"]).count() == 5


def test_cube_shuffles_the_base_and_not_its_copies(spark, rows, monkeypatch):
    frame = spark.range(4000).select(
        F.when(F.col("id") % 7 > 0, F.col("id") * 31 % 500).alias("id"), (F.col("id") % 3).alias("a"),
        F.when(F.col("id") % 5 > 0, F.col("id") % 5).alias("b"), (F.col("id") % 11).alias("c"), F.lit(1).alias("n"))
    base = frame.groupBy("a", "b", "c", cube.id_block("id").alias("block")).agg(F.sum("n").alias("n"), cube.word_of("id").alias("w"))
    order = ["a", "b", "c", "grouping_id", "n", "users"]
    want = rows(cube.bitmap_cube(base, ["a", "b", "c"], ["n"], {"w": "users"}), *order)
    got = cube.bitmap_cube(base, ["a", "b", "c"], ["n"], {"w": "users"}, wide=["b", "c"])
    above, multiplied = [], 0
    for line in got._jdf.queryExecution().executedPlan().toString().split("\n"):
        depth = len(line) - len(line.lstrip(" :+-*(0123456789)"))
        above = [(d, name) for d, name in above if d < depth] + [(depth, line.lstrip(" :+-*(0123456789)"))]
        if above[-1][1].startswith("Generate"):
            multiplied += 1
            assert not any(name.startswith("Exchange") for _, name in above)
    assert multiplied == 2 and rows(got, *order) == want
    # Values with more rows than a task takes are dealt by block, too.
    monkeypatch.setattr(cube, "VALUE_ROWS", 40)
    assert rows(cube.bitmap_cube(base, ["a", "b", "c"], ["n"], {"w": "users"}, wide=["b", "c"]), *order) == want


def test_sketches(spark):
    ids = spark.range(100_000)
    row = sketch.compare_distinct(ids, "id").head()
    assert row["exact_cnt"] == row["bitmap_cnt"] == 100_000
    assert abs(row["approx_cnt"] - 100_000) < 15_000 and abs(row["hll_cnt"] - 100_000) < 5_000
    ten = sketch.hll_base(ids.withColumn("g", F.col("id") % 10), "id", ["g"])
    back = sketch.sketch_from_hex(sketch.sketch_to_hex(ten))
    two = sketch.hll_merge(back.withColumn("h", F.col("g") % 2), ["h"])
    for r in two.select(F.hll_sketch_estimate("sketch").alias("n")).collect():
        assert abs(r["n"] - 50_000) < 2_500
    both = sketch.overlap_estimate(ids.where("id < 60000"), ids.where("id >= 40000"), "id").head()
    assert abs(both["size_both"] - 20_000) < 2_000 and abs(both["size_union"] - 100_000) < 4_000
    nulls = spark.createDataFrame([("a", 5), ("a", None), ("b", None)], "k string, id long")
    assert dict(map(tuple, sketch.bitmap_cardinality(sketch.bitmap_base(nulls, "id", ["k"]), ["k"]).collect())) == {"a": 1, "b": 0}


def test_geohash(spark):
    points = spark.createDataFrame(
        [(57.64911, 10.40744, "u4pruydqqvj"), (30.228535040660184, 115.43071891393716, "wt65fwyjfxq7"), (90.0, 180.0, "zzzzz"),
         (-90.0, -180.0, "00000"), (91.0, 0.0, None), (None, 1.0, None)], "lat double, lon double, cell string")
    for r in points.select("cell", geohash("lat", "lon", 5).alias("c5"), geohash("lat", "lon", 11).alias("c11"), geohash("lat", "lon", 12).alias("c12")).collect():
        if r["cell"] is None:
            assert r["c5"] is None
        else:
            full = {5: r["c5"], 11: r["c11"], 12: r["c12"]}[len(r["cell"])]
            assert full == r["cell"] and r["c12"].startswith(r["c11"])
    with pytest.raises(ValueError):
        geohash("lat", "lon", 13)


def test_place_of_an_address(spark):
    ranges = spark.createDataFrame(
        [(3735000000, 3735999999, "中国", "上海", "上海市"), (0, 70000, "x", "y", "z")],
        "lo long, hi long, country string, province string, city string")
    events = spark.createDataFrame(
        [(1, "222.160.158.53", 0.0, 0.0), (2, "9.9.9.9", 50.0, 50.0), (3, "0.1.0.1", 10.0, 10.0), (4, "no address", 0.0, 0.0),
         (5, "1.2.3", None, None), (6, "1.2.3.999", 50.0, 50.0)], "id long, ip string, latitude double, longitude double")
    area = spark.createDataFrame([(50.0, 50.0, "p2", "c", "r"), (50.0, 50.0, "p1", "c", "r")], "lat double, lon double, province string, city string, region string")
    located = geo.locate(events, geo.build_geo_dict(area, "lat", "lon"), ranges)
    got = {r["id"]: (r["located_by"], r["country"], r["province"], r["region"]) for r in located.collect()}
    assert got[2] == got[6] == ("gps", "UNKNOWN", "p1", "r")
    assert got[3] == ("ip", "x", "y", "UNKNOWN")
    assert got[4] == got[5] == ("none", "UNKNOWN", "UNKNOWN", "UNKNOWN")
    assert got[1] == ("ip", "中国", "上海", "UNKNOWN")
    assert [r["events"] for r in geo.unresolved_points(located).collect()] == [1]


def test_version_roll(spark):
    prev = spark.createDataFrame(
        [(1, 10.0, "new", "2021-01-20", "9999-12-31"), (2, 20.0, "new", "2021-01-19", "2021-01-20"), (2, 20.0, "paid", "2021-01-21", "9999-12-31")],
        "oid long, amount double, status string, start_dt string, end_dt string").withColumns(
        {"start_dt": F.col("start_dt").cast("date"), "end_dt": F.col("end_dt").cast("date")})
    delta = spark.createDataFrame([(2, 20.0, "sent"), (2, 20.0, "sent"), (3, 5.0, "new")], "oid long, amount double, status string")
    got = sorted((r["oid"], r["status"], str(r["start_dt"]), str(r["end_dt"])) for r in history.scd2_roll(prev, delta, "2021-01-23").collect())
    assert got == [
        (1, "new", "2021-01-20", "9999-12-31"), (2, "new", "2021-01-19", "2021-01-20"), (2, "paid", "2021-01-21", "2021-01-22"),
        (2, "sent", "2021-01-23", "9999-12-31"), (3, "new", "2021-01-23", "9999-12-31")]


def test_members_at_level(spark):
    levels = spark.createDataFrame([(1, "A", "2021-01-01", "2021-01-10"), (1, "B", "2021-01-11", "9999-12-31")],
                                   "member_id long, member_level_id string, start_dt string, end_dt string")
    levels = levels.withColumns({c_: F.col(c_).cast("date") for c_ in ("start_dt", "end_dt")})
    orders = spark.createDataFrame([(1, 5.0, "2021-01-10 23:59:59"), (1, 7.0, "2021-01-11 00:00:00"), (1, 1.0, "2021-02-01 00:00:00"), (2, 9.0, "2021-01-01 00:00:00")],
                                   "member_id long, order_amt double, create_time string").withColumn("create_time", F.col("create_time").cast("timestamp"))
    got = sorted(map(tuple, history.as_of_level(orders, levels).collect()))
    assert got == [(1, "A", 1, 5.0), (1, "B", 2, 8.0)]


ACTIVE = {"G1": [1, 2, 3, 6, 7], "G2": [1, 3], "G3": [7], "G4": [2, 3, 4, 5, 6, 7], "G5": [6]}


def test_activity_over_days(spark, rows):
    days = spark.createDataFrame([(g, f"2020-09-0{d}") for g, ds in ACTIVE.items() for d in ds], "guid string, dt string").withColumn("dt", F.col("dt").cast("date"))
    ranges = activity.ranges_from_days(days, "2020-09-01")
    status = activity.init_status(days, "2020-09-01", 4)
    for d in range(2, 8):
        day = f"2020-09-0{d}"
        today = days.where(F.col("dt") == F.lit(day).cast("date"))
        # Each day starts from a stored table, as the daily jobs do.
        ranges = cut_lineage(activity.roll_ranges(ranges, today, day))
        status = cut_lineage(activity.roll_status(status, today, day, 4))
        order = ["first_dt", "guid", "range_start", "range_end"]
        assert rows(ranges, *order) == rows(activity.ranges_from_days(days, day), *order)
        words = {r["guid"]: r["active_status"] for r in activity.init_status(days, day, 4).collect()}
        assert all(words.get(r["guid"], 0) == r["active_status"] for r in status.collect())
    day = "2020-09-07"
    assert rows(activity.retention(ranges, day)) == rows(activity.retention_bits(status, day))
    assert dict(map(tuple, activity.activity_string(status, 5).collect())) == {
        "G1": "10011", "G2": "10000", "G3": "00001", "G4": "11111", "G5": "00010"}
    assert sorted(r[0] for r in activity.active_every_day(status, day, "2020-09-06", day).collect()) == ["G1", "G4"]
    assert sorted(r[0] for r in activity.silent_every_day(status, day, "2020-09-04", "2020-09-05").collect()) == ["G1", "G2", "G3", "G5"]
    assert sorted(map(tuple, activity.active_streak(ranges, "2020-09-01", day, 3).collect())) == [("G1", 3), ("G4", 6)]
    assert sorted(map(tuple, activity.silent_lengths(ranges, day).collect())) == [(2, 1, 1), (3, 1, 1)]
    overlaps = ranges.alias("a").join(ranges.alias("b"), "guid").where("a.range_start < b.range_start AND a.range_end >= b.range_start")
    assert overlaps.count() == 0
    wide = activity.retention_pivot(activity.retention_history(days), [0, 1, 2])
    assert [tuple(r)[1:] for r in wide.orderBy("first_dt").collect()] == [(2, 1, 2), (1, 1, 1), (1, None, None), (1, None, None)]


def test_columns(spark):
    frame = spark.createDataFrame([(" a ", [3, 1, None, 3], [[1, 2], [2, 3]])], "s string, a array<long>, n array<array<long>>")
    row = frame.select(
        c.blank_to_null("s").alias("s"), c.array_cardinality("a").alias("n"), c.first_k("a", 2).alias("k"),
        c.flatten_distinct("n").alias("f"), c.normalise_null(F.lit("0")).alias("z"), c.export_text(F.lit("UNKNOWN")).alias("e"),
        c.with_default(F.lit(None).cast("string")).alias("d"), c.text_to_epoch_seconds(F.lit("1970-01-01 08:00:01")).alias("t"),
        c.ip_to_long(F.lit("222.64.158.53")).alias("ip"), c.month_offset(F.lit("2021-01-31"), 1).cast("string").alias("m"),
        c.squared_distance(F.array(F.lit(1.0), F.lit(2.0)), F.array(F.lit(4.0), F.lit(6.0))).alias("q"),
    ).head()
    assert tuple(row) == ("a", 2, [1, 3], [1, 2, 3], None, "\\N", "未知", 1, 222 * 2**24 + 64 * 2**16 + 158 * 256 + 53, "2021-02-28", 25.0)


def murmur3(data, seed=42):
    """Murmur3, 32 bits, as a signed number."""
    word, h = lambda k: (lambda x: (x << 15 | x >> 17) & 0xFFFFFFFF)(k * 0xCC9E2D51 & 0xFFFFFFFF) * 0x1B873593 & 0xFFFFFFFF, seed
    whole = len(data) // 4 * 4
    for i in range(0, whole, 4):
        h ^= word(int.from_bytes(data[i : i + 4], "little"))
        h = ((h << 13 | h >> 19) & 0xFFFFFFFF) * 5 + 0xE6546B64 & 0xFFFFFFFF
    if data[whole:]:
        h ^= word(int.from_bytes(data[whole:], "little"))
    h ^= len(data)
    for shift, by in ((16, 0x85EBCA6B), (13, 0xC2B2AE35), (16, 1)):
        h = (h ^ h >> shift) * by & 0xFFFFFFFF
    return h - (1 << 32) if h >> 31 else h


def test_hashed_words_by_bucket(spark):
    """Bucket and frequency of every text, by the operator's own size, against the hash's definition."""
    texts = {1: "a b a longer-word été 漢字 a", 2: "", 3: "Word word WORDS", 4: " ".join(f"w{i}" for i in range(5000))}
    rows = text.tokenise(spark.createDataFrame(list(texts.items()), "doc_id long, text string"), "text")
    vectors = {r["doc_id"]: dict(zip(r["tf"].indices.tolist(), r["tf"].values.tolist())) for r in text.hashed_tf(rows).collect()}
    sparse = {i: {} for i in texts}
    for r in text.bucket_counts(rows, "doc_id").collect():
        sparse[r["doc_id"]][r["bucket"]] = r["frequency"]
    for got, at in ((vectors, murmur3), (sparse, lambda w: int(hashlib.md5(w).hexdigest()[:8], 16))):
        for i, t in texts.items():
            want = {}
            for w in t.lower().split():
                want[at(w.encode()) % 1_000_000] = want.get(at(w.encode()) % 1_000_000, 0) + 1
            assert got[i] == want
        assert len(got[4]) > 4096


def test_hashed_query_uses_the_operators_size(spark):
    query = catalog_text.QUERIES.entries["hashed_term_frequency"][0]
    assert 900_000 < query(spark, "/root/testdata/sf0.001").agg(F.max("bucket")).head()[0] < 1_000_000
