"""Sessions of a stream: drops out of order, late rows, a repeated micro-batch, against plain Python."""

import os
import random

import pytest
from pyspark.sql import functions as F, types as T

from footfall.operators import sessions as batch
from footfall.streaming import sessions

MINUTE, GAP, DELAY = 60_000, 30 * 60_000, 20 * 60_000
START = 1_704_067_200_000
SCHEMA = T.StructType([T.StructField("sessionid", T.StringType()), T.StructField("timestamp", T.LongType()), T.StructField("event_id", T.LongType()), T.StructField("page", T.StringType())])


class Line:
    """The two streams over one source folder."""

    def __init__(self, spark, root):
        self.spark, self.src, self.table, self.sink, self.at = spark, *(f"{root}/{n}" for n in ("src", "table", "sink", "at"))

    def drop(self, rows):
        self.spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(self.src)

    def deal(self):
        sessions.deal(self.spark, self.src, self.table, f"{self.at}/deal", SCHEMA, DELAY).awaitTermination()

    def run(self):
        self.deal()
        sessions.session_stream(self.spark, self.table, self.sink, f"{self.at}/sessions", SCHEMA, DELAY).awaitTermination()

    def close(self, high):
        self.drop([tuple(r) for r in sessions.closing(self.spark, SCHEMA, high, DELAY).collect()])
        self.run()

    def found(self):
        rows = sessions.numbered(self.spark.read.parquet(self.sink)).collect()
        return sorted((r["session_id"], r["start_time"], r["end_time"], r["events"], r["start_page"], r["end_page"], r["pv_cnt"]) for r in rows)


def expected(rows):
    keys = {}
    for k, t, i, p in sorted((r for r in rows if r[0] is not None and r[1] is not None), key=lambda r: (r[1], r[2])):
        own = keys.setdefault(k, [])
        if not own or t - own[-1][-1][1] > GAP:
            own.append([])
        own[-1].append((k, t, i, p))
    out = []
    for k, own in keys.items():
        for n, s in enumerate(own):
            pages = [p for *_, p in s if p is not None]
            out.append((f"{k}_{n}", s[0][1], s[-1][1], len(s), pages[0] if pages else None, pages[-1] if pages else None, len(pages)))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def line(spark, tmp_path_factory):
    line = Line(spark, str(tmp_path_factory.mktemp("stream")))
    rnd = random.Random(5)
    times = [START + rnd.randrange(600) * MINUTE for _ in range(400)]
    # Pauses of exactly the gap and one millisecond more, and rows without key, time or page.
    times += [START + n * GAP for n in range(4)] + [START + 4 * GAP + 1]
    rows = [(f"k{i % 5}" if i < 400 else "edge", t, i, rnd.choice(["a", "b", None])) for i, t in enumerate(times)]
    rows += [(None, START + 5 * MINUTE, 900, "a"), ("k1", None, 901, "a")]
    # A row arrives at most a delay after a later one: none is late.
    rows.sort(key=lambda r: (r[1] or START) + rnd.randrange(DELAY))
    cut = [rows[:130], rows[130:280], rows[280:]]
    line.early, line.rows, line.late = [], rows, []
    for n, drop in enumerate(cut):
        if n == 2:
            high = max(r[1] for r in cut[0] + cut[1] if r[1] is not None)
            line.late = [("k0", high - DELAY - 1, 950, "late"), ("new", START, 951, "late")]
            drop = drop + line.late + [("edge2", high - DELAY, 952, None)]
            line.rows = rows + [drop[-1]]
        line.drop(drop)
        line.run()
        line.early.append(line.found())
    return line


def test_open_sessions_wait(line):
    done = set(expected(line.rows))
    assert line.early[0] and set(line.early[0]) <= set(line.early[1]) <= set(line.early[2]) < done


def test_streamed_sessions_equal_the_batch_split(spark, line):
    line.close(max(r[1] for r in line.rows if r[1] is not None))
    want = expected(line.rows)
    assert line.found() == sorted(want)
    frame = spark.createDataFrame(line.rows, SCHEMA).where("sessionid is not null and timestamp is not null")
    split = batch.sessionize(frame).groupBy("newsessionid").agg(F.min("timestamp"), F.max("timestamp"), F.count(F.lit(1)))
    assert sorted(tuple(r) for r in split.collect()) == [r[:4] for r in sorted(want)]


def test_late_rows_have_their_own_table(spark, line):
    late = sessions.late_rows(spark, line.table, SCHEMA)
    assert sorted((r["sessionid"], r["timestamp"], r["event_id"], r["page"]) for r in late.collect()) == sorted(line.late)
    counts = {r["micro_batch"]: (r["in_time"], r["late"]) for r in sessions.late_counts(spark, line.table, SCHEMA).collect()}
    assert counts[0] == (130, 0) and counts[1] == (150, 0) and counts[2][1] == 2
    # After closing, an earlier time is late, too.
    line.drop([("k0", START, 999, "a")])
    line.run()
    assert sessions.late_rows(spark, line.table, SCHEMA).count() == 3 and line.found() == sorted(expected(line.rows))


def test_a_repeated_micro_batch_writes_nothing_twice(spark, tmp_path):
    line = Line(spark, str(tmp_path))
    for n in range(2):
        line.drop([("k", START + n * MINUTE + i, n * 10 + i, "a") for i in range(4)])
        line.deal()
    before = sorted(tuple(r) for r in spark.read.parquet(line.table).collect())
    # The last micro-batch wrote its rows but not its commit.
    commits = f"{line.at}/deal/commits"
    last = max(n for n in os.listdir(commits) if n.isdigit())
    for name in (last, f".{last}.crc"):
        os.remove(f"{commits}/{name}")
    line.deal()
    assert sorted(tuple(r) for r in spark.read.parquet(line.table).collect()) == before and len(before) == 8


def test_names_and_empty_source(spark, tmp_path):
    with pytest.raises(ValueError, match="is_late"):
        sessions.deal(spark, str(tmp_path), str(tmp_path), str(tmp_path), T.StructType([T.StructField("IS_LATE", T.LongType())]), 1)
    line = Line(spark, str(tmp_path))
    line.drop([])
    line.run()
    assert sessions.late_rows(spark, line.table, SCHEMA).count() == 0
