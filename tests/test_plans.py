"""What the plans must look like whatever the size of the tables."""

import pytest
from pyspark.sql import functions as F

import catalog
from catalog import base
from footfall.operators import cube, sessions, sketch
from footfall.sources import tables

SF = "/root/testdata/sf0.001"
LAZY = [
    "device_account_scores", "best_account", "guid_resolution", "event_identity", "place_fallback", "ip_lookup", "session_split",
    "sessions_from_events", "user_traffic", "region_rollup", "share_cube", "first_members", "active_range_roll", "active_bits_roll",
    "retention_history", "furthest_step", "attribution_models", "version_roll", "orders_at_level", "star_enrichment", "tfidf_weights",
]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_join_and_no_row_by_row_python(spark, name):
    text = plan(catalog.load()[name][0](spark, SF))
    for banned in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"):
        assert banned not in text


def test_events_are_folded_before_their_shuffle(spark):
    events = base.table(spark, SF, "events").select(
        "event_id", F.col("user_id").cast("string").alias("sessionid"), base.epoch_millis("ts").alias("timestamp"),
        F.col("event_type").alias("page"), F.col("user_id").alias("guid"), F.lit(True).alias("newflag"),
    )
    text = plan(sessions.sessions_from_events(events))
    assert text.count("Exchange") == 2
    assert text.rindex("partial_min") > text.rindex("Exchange")


def test_top_members_are_limited_before_the_shuffle(spark):
    rows = base.table(spark, SF, "lineitem")
    assert "WindowGroupLimit" in plan(sketch.first_members(rows, ["l_returnflag"], "l_suppkey", 10))


def test_a_day_scan_reads_one_folder_and_few_columns(spark, tmp_path):
    path = str(tmp_path / "days")
    rows = spark.range(10).withColumns({"wide": F.lit("x"), "dt": F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 3).cast("int"))})
    rows.write.partitionBy("dt").parquet(path)
    scan = tables.scan_day(spark, path, "2024-01-02", ["id"])
    text = plan(scan)
    assert "dt" in text.split("PartitionFilters:")[1].split("]")[0]
    assert "wide" not in text.split("ReadSchema:")[1]
    assert sorted(r["id"] for r in scan.collect()) == [1, 4, 7]


def test_sets_merge_in_hash_aggregates(spark):
    users = spark.range(1000).select((F.col("id") % 5).alias("a"), (F.col("id") % 3).alias("b"), "id")
    base_rows = cube.set_base(users, "id", ["a", "b"])
    text = plan(cube.bitmap_cube(base_rows, ["a", "b"], [], {"users_bitmap": "users"}))
    assert "bit_or" in text and "SortAggregate" not in text
