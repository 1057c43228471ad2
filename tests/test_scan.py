"""One key holds a third of all rows or more; results are compared with plain Python."""

import random
import re

import pytest
from pyspark.sql import functions as F

from footfall.operators import attribution, funnel, sessions
from footfall.plans.scan import carried, dense_rank_ids, in_order, running_total

MINUTE = 60_000
START = 1_704_067_200_000


@pytest.fixture(scope="module")
def events():
    rnd = random.Random(7)
    out = []
    for i in range(3000):
        user = "hot" if i % 3 == 0 else f"u{rnd.randrange(60)}"
        step = rnd.choice([0, 1, 5, 29, 30, 31, 45, 300]) * MINUTE
        out.append((i, user, START + rnd.randrange(400) * 10 * MINUTE + step, rnd.choice("abcde")))
    # Equal times, times on slice borders, gaps of exactly the limit.
    out += [(3000 + j, "hot", START + j // 3 * 30 * MINUTE, "abc"[j % 3]) for j in range(90)]
    return out


@pytest.fixture(scope="module")
def frame(spark, events):
    return spark.createDataFrame(events, "event_id long, sessionid string, timestamp long, eventid string").repartition(7).cache()


def by_user(events):
    users = {}
    for i, user, ms, kind in sorted(events, key=lambda e: (e[2], e[0])):
        users.setdefault(user, []).append((ms, i, kind))
    return users


def split_ids(events, gap):
    out = {}
    for user, rows in by_user(events).items():
        n, before = 0, None
        for ms, i, _ in rows:
            if before is not None and ms - before > gap:
                n += 1
            before = ms
            out[i] = f"{user}_{n}"
    return out


@pytest.mark.parametrize("gap", [MINUTE, 30 * MINUTE, 7 * 30 * MINUTE + 1])
def test_sessionize(frame, events, gap):
    got = {r["event_id"]: r["newsessionid"] for r in sessions.sessionize(frame, gap_ms=gap).collect()}
    assert got == split_ids(events, gap)


def test_direct_sessions_equal_two_steps(frame, rows):
    dressed = frame.withColumns(
        {"guid": F.col("sessionid"), "newflag": F.col("event_id") % 2 == 0,
         "page": F.when(F.col("eventid") != "a", F.col("eventid")), "location": F.col("eventid")}
    )
    one = sessions.session_agg(sessions.sessionize(dressed))
    two = sessions.sessions_from_events(dressed)
    assert rows(one) == rows(two)
    assert one.agg(F.sum("pv_cnt")).head()[0] == dressed.where("page IS NOT NULL").count()


@pytest.mark.parametrize("parts", [1, 3, 40, 400])
def test_running_total(frame, events, parts):
    placed = running_total(
        frame, ["sessionid"], ["timestamp", "event_id"], F.when(F.col("eventid") == "c", 1).otherwise(0), "n", total="all", parts=parts
    )
    expect = {}
    for user, rows_ in by_user(events).items():
        n = 0
        whole = sum(kind == "c" for _, _, kind in rows_)
        for _, i, kind in rows_:
            n += kind == "c"
            expect[i] = (n, whole)
    assert {r["event_id"]: (r["n"], r["all"]) for r in placed.collect()} == expect


@pytest.mark.parametrize("parts", [1, 2, 5])
def test_running_total_of_a_null_key(spark, parts):
    frame = spark.createDataFrame([(None, 1, "x"), (None, 10**9, "x"), ("a", 5, "x"), (None, 7, "y")], "_k0 string, _part long, _before string")
    got = running_total(frame, ["_k0"], ["_part"], F.lit(1), "n", total="_all", parts=parts)
    assert set(got.columns) == {"_k0", "_part", "_before", "n", "_all"}
    assert sorted((r["_k0"] or "", r["_part"], r["n"], r["_all"]) for r in got.collect()) == [("", 1, 1, 3), ("", 7, 2, 3), ("", 10**9, 3, 3), ("a", 5, 1, 1)]
    assert running_total(frame.limit(0), ["_k0"], ["_part"], F.lit(1), "n", total="all", parts=parts).count() == 0


def burst(spark, n=5000):
    """One key with all its events within five milliseconds, and a few others."""
    rows_ = [(i, "hot" if i % 50 else f"u{i % 7}", START + i % 5, "abcd"[i * 7 % 11 % 4]) for i in range(n)]
    return rows_, spark.createDataFrame(rows_, "event_id long, sessionid string, timestamp long, eventid string").repartition(6)


def test_a_burst_spreads_over_the_tasks(spark):
    """5,000 rows within 5 ms: no task works on more than twice the mean, and what is carried stays small."""
    _, frame = burst(spark)
    placed = in_order(frame, ["sessionid"], ["timestamp", "event_id"], "_part", 8)
    for rows_ in (placed.groupBy("_part"), running_total(frame, ["sessionid"], ["timestamp", "event_id"], F.lit(1), "n", parts=8).groupBy(F.spark_partition_id())):
        sizes = [r["count"] for r in rows_.count().collect()]
        assert len(sizes) == 8 and sum(sizes) == 5000 and max(sizes) <= 2 * 5000 / 8
    assert carried(placed.withColumn("v", F.lit(1)), ["sessionid"], "_part", "v").count() <= 16


def test_a_burst_in_every_operator(spark):
    events, frame = burst(spark)
    users = by_user(events)
    got = {r["sessionid"]: r["furthest"] for r in funnel.furthest_step(frame, list("abcdabcd"), ["sessionid"], parts=8).collect()}
    for user, rows_ in users.items():
        done = 0
        for _, _, kind in rows_:
            done += done < 8 and kind == "abcdabcd"[done]
        assert got[user] == done
    seg = attribution.segments(frame, "d", ["a", "b"], guid="sessionid", ts="timestamp", event_id="event_id", parts=8)
    touches, open_ = 0, dict.fromkeys(users, 0)
    for user, rows_ in users.items():
        for _, _, kind in rows_:
            if kind == "d":
                touches, open_[user] = touches + open_[user], 0
            open_[user] += kind in "ab"
    assert seg.agg(F.sum("touches")).head()[0] == touches
    lists = sessions.session_pages(frame, session="sessionid", page="eventid", chunk=100, parts=8).where("session_id = 'hot'").orderBy("chunk").collect()
    assert [p for r in lists for p in r["page_list"]] == [kind for _, _, kind in users["hot"]]


def test_events_are_read_twice_at_most(spark):
    """Once to draw the ranges and once to store them, whatever the operator does with them."""
    _, frame = burst(spark, 1000)
    frame = frame.cache()
    for use in (
        lambda e: funnel.funnel(e, ["a", "b", "c"], ["sessionid"]),
        lambda e: attribution.attribution(attribution.segments(e, "d", ["a", "b"], guid="sessionid", ts="timestamp", event_id="event_id"), "d"),
        lambda e: sessions.session_pages(e, session="sessionid", page="eventid"),
    ):
        read = spark.sparkContext.accumulator(0)

        def counted(batches, read=read):
            for batch in batches:
                read.add(batch.num_rows)
                yield batch

        use(frame.mapInArrow(counted, frame.schema)).collect()
        assert 1000 <= read.value <= 2000


def test_page_list_in_chunks(frame, events):
    lists = sessions.session_pages(frame, session="sessionid", page="eventid", chunk=5).collect()
    got = {}
    for r in sorted(lists, key=lambda r: r["chunk"]):
        assert len(r["page_list"]) <= 5
        got.setdefault(r["session_id"], []).extend(r["page_list"])
    assert got == {u: [kind for _, _, kind in rows_] for u, rows_ in by_user(events).items()}


@pytest.mark.parametrize("steps", [["a"], ["a", "b"], ["a", "b", "c"], ["a", "a", "b", "a", "e", "d"]])
@pytest.mark.parametrize("parts", [1, 4, 60])
def test_furthest_step(frame, events, steps, parts):
    got = funnel.furthest_step(frame, steps, ["sessionid"], parts=parts)
    expect = {}
    for user, rows_ in by_user(events).items():
        path = "".join(kind for _, _, kind in rows_ if kind in steps)
        # The textual rule: the steps in order with anything between them.
        expect[user] = max(n for n in range(len(steps) + 1) if re.search(".*".join(steps[:n]), path))
    assert {r["sessionid"]: r["furthest"] for r in got.collect()} == expect


def test_short_journeys(spark):
    data = [(1, "x", 1, "b"), (2, "x", 2, "a"), (3, "y", 5, "a"), (4, "y", 5, "b"), (5, "z", 1, "b")]
    frame = spark.createDataFrame(data, "event_id long, guid string, timestamp long, eventid string")
    got = funnel.furthest_step(frame, ["a", "b"], ["guid"])
    assert {r["guid"]: r["furthest"] for r in got.collect()} == {"x": 1, "y": 2, "z": 0}
    steps = [tuple(r) for r in funnel.funnel(frame, ["a", "b"], ["guid"]).collect()]
    assert steps == [(1, "a", 2), (2, "b", 1)]


def test_segments(frame, events):
    got = attribution.segments(
        frame, "e", ["a", "b", "d"], guid="sessionid", ts="timestamp", event_id="event_id", parts=30
    )
    expect = {}
    for user, rows_ in by_user(events).items():
        seg, open_rows = 0, []
        for ms, i, kind in rows_:
            if kind == "e":
                for ms2, i2, k2 in open_rows:
                    cell = expect.setdefault((user, seg, k2), [(ms2, i2), (ms2, i2), 0])
                    cell[0], cell[1], cell[2] = min(cell[0], (ms2, i2)), max(cell[1], (ms2, i2)), cell[2] + 1
                seg, open_rows = seg + 1, []
            elif kind in "abd":
                open_rows.append((ms, i, kind))
    found = {
        (r["guid"], r["segment"], r["event"]): [tuple(r["first_at"]), tuple(r["last_at"]), r["touches"]] for r in got.collect()
    }
    assert found == expect
    sums = (
        attribution.attribution(got, "e", digits=9).groupBy("model", "guid", "segment").agg(F.sum("weight").alias("w")).collect()
    )
    assert sums and all(abs(r["w"] - 100) < 1e-6 for r in sums)


def test_dense_ids(spark):
    keys = [f"k{i * 7919 % 1000:04d}" for i in range(1000)]
    got = dense_rank_ids(spark.createDataFrame([(k,) for k in keys], "guid string"), "guid", "id").collect()
    assert {r["guid"]: r["id"] for r in got} == {k: i for i, k in enumerate(sorted(keys), 1)}
