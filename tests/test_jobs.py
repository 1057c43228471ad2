"""The daily jobs over several days, sources and sinks."""

import json

import pytest
from pyspark.sql import functions as F, types as T

from footfall.functions.geohash import geohash
from footfall.operators import activity, history, identity, neighbours, quality, sessions
from footfall.operators.clean import clean_events
from footfall.plans import daily
from footfall.session import scratch_path
from footfall.sources import jdbc, tables
from footfall.streaming.ingest import ingest

LOG = """account string, deviceid string, devicetype string, eventid string, ip string, latitude double, longitude double,
osname string, releasechannel string, properties map<string,string>, sessionid string, timestamp long, event_id long"""
DAY = 86_400_000
START = 1_704_067_200_000


def logs(spark, day):
    rows, n = [], 0
    for u in range(8):
        if (u + day) % 3 == 0:
            continue
        for e in range(4):
            n += 1
            rows.append((
                None if e == 3 else f"u{u}", "" if u == 7 else f"d{u // 2}", "phone", "view", f"1.2.3.{u}", 50.0 if u % 2 else 10.0, 50.0,
                "ios", "web", {"pageId": str(e)} if e else {}, f"s{u}-{day}", START + day * DAY + u * 1000 + e * 20 * 60_000 * (1 + u % 2), day * 1000 + n))
    return spark.createDataFrame(rows, LOG)


@pytest.fixture(scope="module")
def warehouse(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("root"))
    places = spark.createDataFrame([("v00000", "p", "c", "r")], "geohash string, province string, city string, region string").limit(0)
    ranges = spark.createDataFrame([(16909056, 16909311, "C", "P", "T")], "lo long, hi long, country string, province string, city string")
    days = [f"2024-01-0{d}" for d in (1, 2, 3)]
    for i, day in enumerate(days):
        tables.write_day(logs(spark, i), f"{root}/ods_event_app_log", day)
        daily.run_day(spark, root, day, places, ranges, START + i * DAY)
    return root, days, places, ranges


TABLES = ["device_account_contact", "event_app_detail", "user_guid_global", "user_active_day", "app_flow_agg_session", "app_flow_agg_user",
          "app_flow_overview_bitmap", "app_flow_overview_cube", "user_range_closed", "user_range_open", "user_first_day", "user_active_word",
          "user_retention", "run_of_day"]


def snapshot(spark, root, names):
    out = {}
    for name in names:
        df = spark.read.parquet(f"{root}/{name}")
        df = df.select(*[F.col(c).cast("string") for c in sorted(df.columns)])
        out[name] = sorted(map(repr, df.collect()))
    return out


def test_days_build_on_each_other(spark, warehouse):
    root, days, *_ = warehouse
    ids = tables.scan_through(spark, f"{root}/user_guid_global", days[-1])
    assert len(set(quality.check_dense(ids).head())) == 1
    first, last = (tables.scan_day(spark, f"{root}/user_guid_global", d) for d in (days[0], days[1]))
    assert last.count() > 0 and last.agg(F.min("id")).head()[0] == first.agg(F.max("id")).head()[0] + 1
    met = spark.read.parquet(f"{root}/event_app_detail").groupBy("guid").agg(F.min("dt").alias("dt"), F.min_by("newflag", "dt").alias("new"))
    assert met.where("new").join(ids.select("guid", F.col("dt").alias("since")), "guid").where("dt <> since").count() == 0
    relation = daily.relation_on(spark, root, days[-1], START)
    assert quality.check_mixed(relation).count() == 0
    detail = spark.read.parquet(f"{root}/event_app_detail")
    assert detail.where("guid IS NULL").count() == 0
    assert detail.where("located_by = 'ip' AND province = 'P'").count() == detail.count()
    cube = tables.scan_day(spark, f"{root}/app_flow_overview_cube", days[-1])
    top = cube.orderBy(F.desc("grouping_id")).head()
    per_session = tables.scan_day(spark, f"{root}/app_flow_agg_session", days[-1])
    assert top["uv_cnt"] == per_session.select("guid").distinct().count()
    day_rows = detail.where(F.col("dt") == F.lit(days[-1]).cast("date"))
    assert top["session_cnt"] == per_session.count() == day_rows.select("newsessionid").distinct().count()
    assert top["pv_cnt"] == day_rows.where("properties['pageId'] IS NOT NULL").count()


def test_any_day_reads_back_as_it_was_rolled(spark, warehouse, rows):
    """Rows of changes give the tables that rolling everything day by day gives, also after a snapshot."""
    root, days, *_ = warehouse
    relation = spark.createDataFrame([], "deviceid string, account string, score double, first_time long, last_time long")
    status, ranges = (spark.createDataFrame([], s) for s in ("guid string, first_dt date, active_status long", "first_dt date, guid string, range_start date, range_end date"))
    for i, day in enumerate(days):
        active = tables.scan_day(spark, f"{root}/user_active_day", day).select("guid")
        met = clean_events(tables.scan_day(spark, f"{root}/ods_event_app_log", day), daily.REQUIRED, daily.ANY_OF)
        relation = identity.roll_scores(relation, identity.daily_scores(met), START + i * DAY)
        ranges = activity.roll_ranges(ranges, active, day).cache()
        status = activity.roll_status(status, active, day).cache()
        assert rows(daily.relation_on(spark, root, day, START + i * DAY)) == rows(relation)
        assert rows(daily.ranges_on(spark, root, day)) == rows(ranges)
        assert rows(daily.status_on(spark, root, day)) == rows(status)
        # What a day writes follows its users, not the ranges there are.
        written = {t: tables.scan_day(spark, f"{root}/{t}", day).count() for t in daily.CHANGES}
        assert written["user_range_open"] == written["user_active_word"] == active.count()
        assert written["user_range_closed"] <= 8 and written["user_first_day"] <= active.count()
    before = rows(daily.relation_on(spark, root, days[-1], 0))
    tables.write_day(daily.contacts_on(spark, root, days[1]), f"{root}/device_account_snapshot", days[1])
    scan = daily.contacts_on(spark, root, days[-1])
    assert rows(daily.relation_on(spark, root, days[-1], 0)) == before
    filters = [p.split("]")[0] for p in scan._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: [")[1:]]
    assert any(f"> {days[1]}" in f for f in filters) and any(f"= {days[1]}" in f for f in filters)


def test_idle_days_count_like_daily_rolls(spark, rows):
    """A contact met once and read weeks later has the score of as many daily rolls, to the last digit."""
    cur = spark.createDataFrame([("d", "a", 300.0, 5), ("d", None, 100.0, 6), ("e", None, 100.0, 7)], "deviceid string, account string, score double, min_time long")
    none = cur.limit(0)
    relation = spark.createDataFrame([], "deviceid string, account string, score double, first_time long, last_time long")
    step = identity.step_scores(relation.withColumn("since", F.current_date()), cur, "2024-01-01")
    for day in range(1, 24):
        relation = spark.createDataFrame(identity.roll_scores(relation, cur if day == 1 else none, 9).collect(), relation.schema)
    assert rows(identity.scores_on(step, "2024-01-23", 9)) == rows(relation)
    again = identity.step_scores(step, cur, "2024-01-24")
    assert rows(identity.scores_on(identity.latest_contacts(step.unionByName(again)), "2024-01-24", 9)) == rows(identity.roll_scores(relation, cur, 9))


def test_a_day_can_run_again(spark, warehouse):
    root, days, places, ranges = warehouse
    before = snapshot(spark, root, TABLES)
    daily.run_day(spark, root, days[-1], places, ranges, START + 2 * DAY)
    assert snapshot(spark, root, TABLES) == before


def test_a_bad_day_is_not_published(spark, warehouse, tmp_path):
    """Two of three rows without account and device: the day stays as it was before, and so do all its tables."""
    root, places, ranges = str(tmp_path), *warehouse[2:]
    day, good = "2024-01-01", logs(spark, 0)
    tables.write_day(good, f"{root}/ods_event_app_log", day)
    values = daily.run_day(spark, root, day, places, ranges, START)
    dirty = good.where("account is null and deviceid = ''").count()
    assert dirty and values == {"dirty_share": 1 - (good.count() - dirty) / good.count(), "lost_rows": 0, "unresolved_rows": 0, "mixed_devices": 0, "id_gaps": 0}
    before = snapshot(spark, root, TABLES)
    nobody = good.withColumns({"account": F.lit(" "), "deviceid": F.lit(None).cast("string")})
    tables.write_day(good.unionByName(nobody).unionByName(nobody), f"{root}/ods_event_app_log", day)
    with pytest.raises(quality.GateFailed, match="dirty_share"):
        daily.run_day(spark, root, day, places, ranges, START)
    assert snapshot(spark, root, TABLES) == before
    # Places that name a cell twice would double events; that is seen before anything is published, too.
    tables.write_day(good, f"{root}/ods_event_app_log", day)
    twice = good.select(geohash("latitude", "longitude", 6).alias("geohash"), *[F.lit(c).alias(c) for c in ("province", "city", "region")]).distinct()
    with pytest.raises(quality.GateFailed, match="lost_rows"):
        daily.run_day(spark, root, day, twice.unionByName(twice), ranges, START)
    assert snapshot(spark, root, TABLES) == before
    # With a wider gate it passes, with the share reports.
    dims = [spark.createDataFrame([], "id string, cat_name string, brand_name string"), spark.createDataFrame([], "id string, lanmu_name string")]
    daily.run_day(spark, root, day, places, ranges, START, *dims, gates={"dirty_share": 1.0})
    assert snapshot(spark, root, TABLES) == before
    assert spark.read.parquet(f"{root}/share_event_overview_cube").count() == 0


def test_one_day_is_scanned(spark, warehouse):
    root, days, *_ = warehouse
    scan = tables.scan_day(spark, f"{root}/event_app_detail", days[1], ["guid"])
    assert scan.count() == spark.read.parquet(f"{root}/event_app_detail").where(F.col("dt") == F.lit(days[1]).cast("date")).count()
    assert len(scan.inputFiles()) >= 1


def test_key_value_order(spark, tmp_path):
    rows = spark.createDataFrame([(f"p{i % 3}", "UNKNOWN" if i % 2 else "c", str(i), i) for i in range(50)], "province string, city string, start string, n long")
    tables.export_kv(rows, ["province", "city", "start"], str(tmp_path / "kv"))
    files = sorted((tmp_path / "kv").glob("part-*.parquet"))
    keys = []
    for f in files:
        keys += [r["row_key"] for r in spark.read.parquet(str(f)).collect()]
    assert keys == sorted(keys) and len(keys) == 50 and all(len(k) == 96 for k in keys)
    value = json.loads(spark.read.parquet(str(tmp_path / "kv")).where("value LIKE '%\"n\":\"1\"%'").head()["value"])
    assert value == {"province": "p1", "city": "\\N", "start": "1", "n": "1"}


def test_text_and_vector_lines(spark, tmp_path):
    (tmp_path / "good").write_text("fine\nnice\n")
    (tmp_path / "poor").write_text("bad\n")
    got = tables.read_labelled_text(spark, {str(tmp_path / "good"): 0, str(tmp_path / "poor"): 2})
    assert sorted(map(tuple, got.collect())) == [(0.0, "fine"), (0.0, "nice"), (2.0, "bad")]
    lines = spark.createDataFrame([("1, 2.5,7",)], "value string")
    assert tuple(tables.parse_vectors(lines).head()) == ("7", [1.0, 2.5])
    assert tuple(tables.parse_vectors(lines, "first").head()) == ("1", [2.5, 7.0])


def test_literal_rows_and_view(spark):
    tables.rows(spark, [(1, "a")], "id long, name string", view="literal_rows")
    assert spark.sql("SELECT count(*) FROM literal_rows").head()[0] == 1


def test_csv_with_blanks(spark, tmp_path):
    (tmp_path / "t.csv").write_text("area,floor,price\n90, 10,110\n")
    assert tuple(tables.read_csv(spark, str(tmp_path), "area double, floor double, price double").head()) == (90.0, 10.0, 110.0)


def test_jdbc_options():
    plain = jdbc.jdbc_options("jdbc:x", "dim", {"user": "u"})
    assert plain["dbtable"] == "dim" and plain["user"] == "u" and "partitionColumn" not in plain
    split = jdbc.jdbc_options("jdbc:x", "dim", split_on="id", bounds=(0, 100), parts=4)
    assert (split["partitionColumn"], split["lowerBound"], split["upperBound"], split["numPartitions"]) == ("id", "0", "100", "4")
    with pytest.raises(ValueError):
        jdbc.jdbc_options("jdbc:x", "dim", split_on="id")


def test_late_log_lines_reach_their_day(spark, tmp_path):
    src, schema = tmp_path / "in", T.StructType([T.StructField("account", T.StringType()), T.StructField("timestamp", T.LongType())])
    src.mkdir()

    def run():
        ingest(spark, str(src), str(tmp_path / "out"), str(tmp_path / "seen"), schema, F.col("timestamp"), ["account"]).awaitTermination()
        got = spark.read.parquet(str(tmp_path / "out"))
        assert got.where(F.length("account") != 64).count() == 0
        return {str(r["dt"]): r["count"] for r in got.groupBy("dt").count().collect()}

    (src / "a.json").write_text("\n".join(json.dumps({"account": f"u{i}", "timestamp": START + i * DAY}) for i in (0, 0, 1)))
    assert run() == {"2024-01-01": 2, "2024-01-02": 1}
    (src / "b.json").write_text(json.dumps({"account": "late", "timestamp": START + 5}))
    assert run() == {"2024-01-01": 3, "2024-01-02": 1}
    assert run() == {"2024-01-01": 3, "2024-01-02": 1}


def test_logs_by_terminal_and_day(spark, tmp_path):
    path, schema = str(tmp_path / "logs"), T.StructType([T.StructField("n", T.LongType()), T.StructField("name", T.StringType())])
    rows_ = [(1, "a", "web", "2024-01-01"), (2, "b", "app", "2024-01-01"), (3, "c", "web", "2024-01-02"), (4, "d", None, "2024-01-01")]
    tables.write_logs(spark.createDataFrame(rows_, "n long, name string, terminal string, dt string"), path)
    (tmp_path / "logs" / "terminal=web" / "dt=2024-01-01" / "more.json").write_text('{"n": 9, "name": "x"}\nnot json\n')
    web = tables.scan_logs(spark, path, schema, "2024-01-01", "web")
    assert {f.split("/logs/")[1].rsplit("/", 1)[0] for f in web.inputFiles()} == {"terminal=web/dt=2024-01-01"}
    assert sorted((r["n"], r["terminal"], str(r["dt"]), r["_corrupt"]) for r in web.collect() if r["n"]) == [(1, "web", "2024-01-01", None), (9, "web", "2024-01-01", None)]
    assert [r["_corrupt"] for r in web.collect() if r["n"] is None] == ["not json"]
    assert sorted(r["n"] for r in tables.scan_logs(spark, path, schema, "2024-01-01").where("n is not null").collect()) == [1, 2, 4, 9]
    none = tables.scan_logs(spark, path, schema, "2024-01-02", "app")
    assert none.count() == 0 and set(none.columns) == {"n", "name", "_corrupt", "terminal", "dt"}


def test_scratch_paths_are_fresh(spark):
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def test_failed_rewrite_keeps_the_day(spark, tmp_path):
    path, day = str(tmp_path / "kept"), "2024-01-01"
    old = spark.range(5).withColumn("v", F.lit("old"))
    tables.write_day(old, path, day)
    tables.write_day(old, path, "2024-01-02")
    # Some tasks finish and write their rows before one fails.
    bad = spark.range(0, 100, 1, 8).withColumn("v", F.when(F.col("id") == 99, F.raise_error(F.lit("broken"))).otherwise(F.lit("new")))
    with pytest.raises(Exception, match="broken"):
        tables.write_day(bad, path, day)
    kept = tables.scan_day(spark, path, day)
    assert sorted(r["id"] for r in kept.collect()) == list(range(5)) and {r["v"] for r in kept.collect()} == {"old"}
    assert spark.read.parquet(path).count() == 10
    # The day can be rewritten from itself, by fewer rows, and by none.
    tables.write_day(kept.where("id < 2"), path, day)
    assert spark.read.parquet(path).groupBy("dt").count().orderBy("dt").collect()[0]["count"] == 2
    tables.write_day(tables.scan_day(spark, path, day).where("id > 7"), path, day)
    assert tables.scan_day(spark, path, day).count() == 0 and spark.read.parquet(path).count() == 5


def test_empty_result_replaces_a_day(spark, tmp_path):
    path, row = str(tmp_path / "t"), spark.createDataFrame([(1, "a")], "n long, name string")
    tables.write_day(row.limit(0), path, "2024-01-01")
    assert tables.scan_day(spark, path, "2024-01-01").count() == 0
    tables.write_day(row, path, "2024-01-02")
    tables.write_day(row, path, "2024-01-01")
    tables.write_day(row.limit(0), path, "2024-01-01")
    assert [str(r["dt"]) for r in spark.read.parquet(path).collect()] == ["2024-01-02"]


def _event(user, day, n):
    return (user, f"x{user}", "phone", "view", "1.2.3.4", 50.0, 50.0, "ios", "web", {"pageId": "1"}, f"s{user}{day}", START + day * DAY + n, day * 1000 + n)


def test_late_user_and_missing_day(spark, tmp_path):
    root, places = str(tmp_path), spark.createDataFrame([], "geohash string, province string, city string, region string")
    ranges = spark.createDataFrame([(16909056, 16909311, "C", "P", "T")], "lo long, hi long, country string, province string, city string")
    days = [f"2024-01-0{d}" for d in (1, 2, 3, 4)]

    def run(day, users):
        at = days.index(day)
        tables.write_day(spark.createDataFrame([_event(u, at, n) for n, u in enumerate(users)], LOG), f"{root}/ods_event_app_log", day)
        daily.run_day(spark, root, day, places, ranges, START)

    def ids():
        return {r["guid"]: r["id"] for r in spark.read.parquet(f"{root}/user_guid_global").collect()}

    run(days[0], ["a", "b"])
    run(days[1], ["a", "c"])
    before = ids()
    run(days[0], ["a", "b", "late"])
    after = ids()
    assert len(after) == 4 and sorted(after.values()) == [1, 2, 3, 4] and before.items() <= after.items()
    with pytest.raises(ValueError, match="2024-01-02"):
        run(days[3], ["a"])
    daily.run_days(spark, root, days[2], days[3], places, ranges, START)
    ranges_now = daily.ranges_on(spark, root, days[3])
    assert {str(r["first_dt"]) for r in ranges_now.where(F.col("guid") == next(iter(before))).collect()} <= {days[0], days[1]}
    assert ranges_now.select("guid").distinct().count() == 3


def test_version_roll_can_be_repeated(spark):
    prev = spark.createDataFrame([(1, "x", "2024-01-01", "9999-12-31"), (2, "y", "2024-01-01", "9999-12-31")], "oid long, status string, start_dt string, end_dt string")
    prev = prev.withColumns({c: F.col(c).cast("date") for c in ("start_dt", "end_dt")})
    delta = spark.createDataFrame([(1, "p"), (1, "q"), (3, "n")], "oid long, status string")
    once = history.scd2_roll(prev, delta, "2024-01-05")
    assert sorted((r["oid"], r["status"], str(r["end_dt"])) for r in once.collect()) == [
        (1, "q", "9999-12-31"), (1, "x", "2024-01-04"), (2, "y", "9999-12-31"), (3, "n", "9999-12-31")
    ]
    assert sorted(map(repr, history.scd2_roll(once, delta, "2024-01-05").collect())) == sorted(map(repr, once.collect()))


def test_no_session_without_key_or_time(spark):
    rows = spark.createDataFrame([(None, 5), ("s", None), ("s", 5)], "sessionid string, timestamp long")
    assert sorted((str(r["newsessionid"]) for r in sessions.sessionize(rows).collect())) == ["None", "None", "s_0"]


def test_no_neighbours_without_samples(spark):
    rows = spark.createDataFrame([(1, 2, [0.0, 1.0])], "id long, label int, vec array<double>")
    assert neighbours.nearest(rows.limit(0), rows, 3).count() == 0 and neighbours.nearest(rows, rows.limit(0), 3).count() == 0
