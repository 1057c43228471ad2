"""Multi-dimensional reports: group once with user sets, then merge over any set of dimensions.

A cell of a many-dimensional report holds few users, so sets are kept as 64-bit words rather than as
fixed 4 KB bitmaps: one row per (dims, block) where block is id / 64. Words merge with ``bit_or`` in
a plain hash aggregate, and the size of a set is the sum of ``bit_count`` over its blocks.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, functions as F

from footfall.functions.columns import hour_of_day, with_default
from footfall.operators.history import enrich
from footfall.session import stored

BLOCK = "block"
#: Rows a task of a cube multiplies its own into, and the most that one value of a dimension is before its blocks are dealt out.
TASK_ROWS, VALUE_ROWS = 1 << 20, 1 << 23
#: More tasks than these do not help a shuffle.
MOST_PARTS = 20_000

TRAFFIC_SUMS = ["pv_cnt", "session_cnt", "time_long", "jumpout_cnt"]
TRAFFIC_WIDE = ["hour_range", "start_page", "end_page"]
TRAFFIC_SETS = {"uv_bitmap": "uv_cnt", "return_user_bitmap": "return_user_cnt", "jumpout_user_bitmap": "jumpout_user_cnt"}


def id_block(id_col: Column | str) -> Column:
    return F.shiftright(F.col(id_col) if isinstance(id_col, str) else id_col, 6)


def word_of(id_col: Column | str, when: Column | None = None) -> Column:
    """Aggregate: word with the bits of the ids of one block, of rows only where ``when`` holds."""
    col = F.col(id_col) if isinstance(id_col, str) else id_col
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(col, F.lit(64)).cast("int"))
    return F.coalesce(F.bit_or(bit if when is None else F.when(when, bit)), F.lit(0).cast("long"))


def cube_sets(dims: Sequence[str]) -> list[list[str]]:
    return [list(c) for n in range(len(dims), -1, -1) for c in combinations(dims, n)]


def rollup_sets(dims: Sequence[str]) -> list[list[str]]:
    return [list(dims[:n]) for n in range(len(dims), -1, -1)]


def _fold(df: DataFrame, fixed: list[str], dims: list[str], sets, sums: list[str], bitmaps, gid: str) -> DataFrame:
    """Sums and merged words for every set of ``dims``, within each value of ``fixed``."""
    return df.groupingSets([[*fixed, *s] for s in sets], *fixed, *dims).agg(
        F.grouping_id().alias(gid),
        *[F.sum(c).alias(c) for c in sums],
        *[F.bit_or(b).alias(b) for b in bitmaps],
    )


def bitmap_cube(
    base: DataFrame,
    dims: Sequence[str],
    sums: Iterable[str],
    bitmaps: Mapping[str, str],
    sets: Sequence[Sequence[str]] | None = None,
    wide: Sequence[str] = (),
) -> DataFrame:
    """Sums and exact distinct counts for every grouping set (all 2**n when ``sets`` is left out).

    ``base`` holds one row per (dims, block); ``bitmaps`` maps set column to count column.
    ``grouping_id`` tells a grouped-away dimension from one whose value is null: bit i from the
    right is 1 when the i-th last dimension is grouped away.

    A full cube with ``wide`` dimensions (those with many values) takes these one after the other: rows are dealt by
    the values of one, which decides all groupings that keep it within a task, and are folded over it for the next. So
    a shuffle holds merged rows of the base, never their copies for every grouping.
    """
    dims, sums, names = list(dims), list(sums), dict(bitmaps)
    wide = [d for d in dims if d in set(wide)] if sets is None else []
    if not wide:
        return _counted(_fold(base, [BLOCK], dims, cube_sets(dims) if sets is None else sets, sums, names, "_gid"), dims, sums, names)
    place = {d: 1 << (len(dims) - 1 - i) for i, d in enumerate(dims)}
    kinds = {d: base.schema[d].dataType for d in dims}
    pieces, rest, gone = [], dims, 0
    for d in wide:
        others = [o for o in rest if o != d]
        base = stored(base, "cube")
        pieces += _keeping(base, d, others, {o: place[o] for o in others}, gone, sums, names)
        base = base.groupBy(*others, BLOCK).agg(*_merged(sums, names))
        rest, gone = others, gone | place[d]
    # What is left has few values: a task says each cell once for all its blocks.
    left = bitmap_cube(base, rest, sums, names)
    gid = F.lit(gone).cast("long")
    for i, d in enumerate(rest):
        gid = gid + F.shiftright("grouping_id", len(rest) - 1 - i).bitwiseAND(F.lit(1)) * place[d]
    left = left.withColumn("grouping_id", gid)

    def whole(piece: DataFrame) -> DataFrame:
        """A piece with all dimensions, those it has folded over as null."""
        gone = {d: F.lit(None).cast(kinds[d]) for d in dims if d not in piece.columns}
        return piece.withColumns(gone).select(*dims, "grouping_id", *sums, *names.values())

    return reduce(DataFrame.unionByName, map(whole, [*pieces, left]))


def _merged(sums: Iterable[str], bitmaps: Iterable[str]) -> list[Column]:
    return [*[F.sum(c).alias(c) for c in sums], *[F.bit_or(b).alias(b) for b in bitmaps]]


def _counted(merged: DataFrame, dims: list[str], sums: list[str], bitmaps: Mapping[str, str]) -> DataFrame:
    """Cells from the merged words of all blocks."""
    counted = merged.select(*dims, "_gid", *sums, *[F.bit_count(b).cast("long").alias(n) for b, n in bitmaps.items()])
    return (
        counted.groupBy(*dims, "_gid")
        .agg(*[F.sum(c).alias(c) for c in sums], *[F.sum(n).alias(n) for n in bitmaps.values()])
        .withColumnRenamed("_gid", "grouping_id")
    )


def _keeping(
    base: DataFrame, dim: str, others: list[str], place: Mapping[str, int], gone: int, sums: list[str], bitmaps: Mapping[str, str]
) -> list[DataFrame]:
    """Cells of every grouping that keeps ``dim``, for any choice of ``others``; dimensions in ``gone`` are grouped away.

    All rows of a value are in one task, so its cells need no second shuffle. A value with too many rows for one task is
    dealt by its blocks, too, and what the tasks found of a cell is summed up.
    """
    masks = [gone + sum(place[o] for o in c) for n in range(len(others) + 1) for c in combinations(others, n)]
    limit = max(1, VALUE_ROWS // len(masks))
    parts = max(int(base.sparkSession.conf.get("spark.sql.shuffle.partitions")), min(MOST_PARTS, -(-base.count() * len(masks) // TASK_ROWS)))
    # No more values than rows / limit.
    crowded = stored(
        base.groupBy(F.col(dim).alias("_value")).agg(F.ceil(F.count(F.lit(1)) / limit).cast("int").alias("_salts")).where(F.col("_salts") > 1), "crowded"
    )
    same = F.col(dim).eqNullSafe(F.col("_value"))
    keys = [dim, *others, "_gid"]

    def cells(rows: DataFrame, *more: str) -> DataFrame:
        at = rows.select("*", F.explode(F.array(*[F.lit(m).cast("long") for m in masks])).alias("_gid"))
        away = {o: F.when(F.col("_gid").bitwiseAND(F.lit(place[o])) == 0, F.col(o)) for o in others}
        merged = at.withColumns(away).groupBy(*keys, *more, BLOCK).agg(*_merged(sums, bitmaps))
        counted = merged.select(*keys, *more, *sums, *[F.bit_count(b).cast("long").alias(n) for b, n in bitmaps.items()])
        return counted.groupBy(*keys, *more).agg(*[F.sum(c).alias(c) for c in [*sums, *bitmaps.values()]])

    found = [cells(base.join(F.broadcast(crowded), same, "left_anti").repartition(parts, dim))]
    if not crowded.isEmpty():
        salted = base.join(F.broadcast(crowded), same).withColumn("_salt", F.pmod(F.xxhash64(BLOCK), F.col("_salts"))).drop("_value", "_salts")
        some = cells(salted.repartition(parts, dim, "_salt"), "_salt")
        found.append(some.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in [*sums, *bitmaps.values()]]))
    return [f.withColumnRenamed("_gid", "grouping_id") for f in found]


def cube_slice(cube: DataFrame, dims: Sequence[str], keep: Iterable[str]) -> DataFrame:
    """Rows of a cube grouped by exactly the ``keep`` dimensions."""
    kept = set(keep)
    wanted = sum(1 << (len(dims) - 1 - i) for i, d in enumerate(dims) if d not in kept)
    return cube.where(F.col("grouping_id") == wanted)


def bitmap_rollup(base: DataFrame, levels: Sequence[str], bitmaps: Mapping[str, str], sums: Iterable[str] = ()) -> DataFrame:
    """Distinct counts per level of a hierarchy, from the finest sets upward."""
    return bitmap_cube(base, levels, sums, bitmaps, rollup_sets(levels))


def traffic_base(user: DataFrame, ids: DataFrame, dims: Sequence[str], per_user: bool = False) -> DataFrame:
    """Per (dims, block): views, sessions, time, bounces, and bitmaps of users, return users, bounced users.

    A return user has more than one session within one row of ``user``, that is within the same
    dimension values; ``per_user`` counts the sessions of the user over all rows instead.
    """
    if per_user:
        total = user.groupBy("guid").agg(F.sum("session_cnt").alias("_sessions"))
        user = user.join(total, "guid", "left")
    else:
        user = user.withColumn("_sessions", F.col("session_cnt"))
    return (
        user.join(ids.select("guid", "id"), "guid", "left")
        .groupBy(*dims, id_block("id").alias(BLOCK))
        .agg(
            *[F.sum(c).alias(c) for c in TRAFFIC_SUMS],
            word_of("id").alias("uv_bitmap"),
            word_of("id", F.col("_sessions") > 1).alias("return_user_bitmap"),
            word_of("id", F.col("jumpout_cnt") > 0).alias("jumpout_user_bitmap"),
        )
    )


def traffic_cube(base: DataFrame, dims: Sequence[str], sets: Sequence[Sequence[str]] | None = None) -> DataFrame:
    return bitmap_cube(base, dims, TRAFFIC_SUMS, TRAFFIC_SETS, sets, [d for d in TRAFFIC_WIDE if d in dims])


def traffic_report(user: DataFrame, ids: DataFrame, dims: Sequence[str], per_user: bool = False) -> DataFrame:
    """Views, users, sessions, time, return users, bounces and bounced users by the listed dimensions."""
    return traffic_cube(traffic_base(user, ids, dims, per_user), dims, [list(dims)]).drop("grouping_id")


def event_overview(
    events: DataFrame, ids: DataFrame, dims: Sequence[str], metrics: Mapping[str, Column], inner: bool = False,
) -> DataFrame:
    """Base table of an event report: per (dims, block) and metric the number of events and the user set.

    Metric ``m`` gives the columns ``m_cnt`` and ``m_bitmap``. Only events that some metric counts are
    read on. ``inner`` drops events of users without an id, as a report on known users does.
    """
    any_metric = None
    for pred in metrics.values():
        any_metric = pred if any_metric is None else (any_metric | pred)
    # A user's events fold to one row per dimension values before they are joined with the ids.
    per_user = events.where(any_metric).groupBy("guid", *dims).agg(
        *[F.count_if(pred).alias(f"{name}_cnt") for name, pred in metrics.items()]
    )
    aggs = []
    for name in metrics:
        aggs.append(F.sum(f"{name}_cnt").alias(f"{name}_cnt"))
        aggs.append(word_of("id", F.col(f"{name}_cnt") > 0).alias(f"{name}_bitmap"))
    known = per_user.join(ids.select("guid", "id"), "guid", "inner" if inner else "left")
    return known.groupBy(*dims, id_block("id").alias(BLOCK)).agg(*aggs)


def overview_report(
    base: DataFrame, dims: Sequence[str], metrics: Iterable[str], sets: Sequence[Sequence[str]] | None = None,
    wide: Sequence[str] = (),
) -> DataFrame:
    """Counts and distinct users per metric (``m_cnt``, ``m_users``) from an ``event_overview`` base."""
    names = list(metrics)
    return bitmap_cube(base, dims, [f"{m}_cnt" for m in names], {f"{m}_bitmap": f"{m}_users" for m in names}, sets, wide)


SHARE_WIDE = ["brand_name", "page_id", "hour_range"]
SHARE_DIMS = ["cat_name", "brand_name", "page_id", "lanmu_name", "share_method", "hour_range", "device_type"]


def share_base(events: DataFrame, product: DataFrame, page: DataFrame, ids: DataFrame, event: str = "share") -> DataFrame:
    """Share events with product and page names: user sets and counts by seven dimensions.

    Events fold to one row per user and raw dimension values before they meet any other table. Users
    without an id are left out; an unknown product or page gets the default label.
    """
    shares = (
        events.where(F.col("eventid") == event)
        .groupBy(
            "guid",
            F.col("devicetype").alias("device_type"),
            hour_of_day("timestamp").alias("hour_range"),
            F.col("properties")["productId"].alias("_product"),
            F.col("properties")["pageId"].alias("page_id"),
            F.col("properties")["shareMethod"].alias("share_method"),
        )
        .agg(F.count(F.lit(1)).alias("_shares"))
    )
    named = enrich(
        shares,
        [
            (product.select(F.col("id").cast("string").alias("id"), "cat_name", "brand_name"), "_product", "id"),
            (page.select(F.col("id").cast("string").alias("id"), "lanmu_name"), "page_id", "id"),
        ],
    )
    return (
        named.join(ids.select("guid", "id"), "guid")
        .groupBy(*SHARE_DIMS, id_block("id").alias(BLOCK))
        .agg(F.sum("_shares").alias("share_cnt"), word_of("id").alias("share_bitmap"))
    )


def share_cube(base: DataFrame, sets: Sequence[Sequence[str]] | None = None) -> DataFrame:
    return overview_report(base, SHARE_DIMS, ["share"], sets, SHARE_WIDE)


def set_base(df: DataFrame, id_col: str, keys: Sequence[str], out: str = "users_bitmap") -> DataFrame:
    """The finest sets of a report on its own: one word per (keys, block)."""
    return df.groupBy(*keys, id_block(id_col).alias(BLOCK)).agg(word_of(id_col).alias(out))
