"""Nearest neighbours from low-dimensional stable projections and a kd-tree, with a chi-square stopping test.

A Gaussian (2-stable) projection to m numbers turns a distance r into r times the root of a chi-square variable
with m degrees of freedom. So once the next projected distance d of a search satisfies d^2 > t * r_k^2, where
t is the chi-square quantile of ``sure`` and r_k the k-th distance found, a true neighbour is missed with a
probability of 1 - ``sure`` at most, and the search may stop.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from footfall.llm.common import stored
from footfall.llm.vectors import matrix, usable, width

#: Projected dimensions (even), probability of the stopping test, seed of the projection.
DIMS, SURE, SEED = 8, 0.98, 3
#: Rows the top of the tree is cut by (a documented, bounded sample; every row is indexed) and rows per cell aimed at.
SAMPLE, CELL = 65_536, 4096
#: Rows of a leaf within a cell; queries that meet a cell at once.
LEAF, QUERIES = 128, 2048


def chi_square_quantile(p: float, m: int) -> float:
    """Inverse of the chi-square distribution function for even m, by bisection."""

    def below(x: float) -> float:
        return 1 - math.exp(-x / 2) * sum((x / 2) ** i / math.factorial(i) for i in range(m // 2))

    lo, hi = 0.0, 1000.0
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if below(mid) < p else (lo, mid)
    return hi


class Top:
    """The top of the kd-tree: cuts at medians of a sample, and the cells below them."""

    def __init__(self, points: np.ndarray, cells: int) -> None:
        m = points.shape[1] if points.ndim == 2 and len(points) else DIMS
        self.axis, self.at, self.child = [], [], []
        self.low, self.high = [], []
        self._grow(points, max(1, cells), np.full(m, -np.inf), np.full(m, np.inf))
        self.low, self.high = np.array(self.low), np.array(self.high)

    def _grow(self, points: np.ndarray, cells: int, low: np.ndarray, high: np.ndarray) -> int:
        """Number of the node; cells are negative numbers."""
        spread = points.max(0) - points.min(0) if len(points) else np.zeros(len(low))
        axis = int(np.argmax(spread)) if len(spread) else 0
        if cells < 2 or len(points) < 2 or spread[axis] == 0:
            self.low.append(low)
            self.high.append(high)
            return -len(self.low)
        cut = float(np.median(points[:, axis]))
        if cut == points[:, axis].min():
            cut = float(np.min(points[:, axis][points[:, axis] > cut]))
        left = points[:, axis] < cut
        node = len(self.axis)
        self.axis.append(axis)
        self.at.append(cut)
        self.child.append([0, 0])
        lower, upper = high.copy(), low.copy()
        lower[axis] = upper[axis] = cut
        self.child[node][0] = self._grow(points[left], cells // 2, low, lower)
        self.child[node][1] = self._grow(points[~left], cells - cells // 2, upper, high)
        return node

    def cell(self, points: np.ndarray) -> np.ndarray:
        if not self.axis:
            return np.zeros(len(points), np.int64)
        axis, at, child = np.array(self.axis), np.array(self.at), np.array(self.child)
        node, open_ = np.zeros(len(points), np.int64), np.ones(len(points), bool)
        while open_.any():
            i = np.flatnonzero(open_)
            node[i] = child[node[i], (points[i, axis[node[i]]] >= at[node[i]]).astype(int)]
            open_[i] = node[i] >= 0
        return -node - 1

    def distance(self, point: np.ndarray) -> np.ndarray:
        """Squared distance of a point to the box of each cell."""
        gap = np.maximum(0, np.maximum(self.low - point, point - self.high))
        return np.square(gap).sum(1)


class Leaves:
    """The tree within a cell, down to leaves of some 128 rows, with the box of each."""

    def __init__(self, points: np.ndarray) -> None:
        self.rows, low, high = [], [], []
        todo = [np.arange(len(points))]
        while todo:
            rows = todo.pop()
            part = points[rows]
            axis = int(np.argmax(part.max(0) - part.min(0)))
            if len(rows) <= LEAF:
                self.rows.append(rows)
                low.append(part.min(0))
                high.append(part.max(0))
                continue
            order = rows[np.argpartition(part[:, axis], len(rows) // 2)]
            todo += [order[: len(rows) // 2], order[len(rows) // 2 :]]
        self.low, self.high = np.array(low), np.array(high)

    def order(self, point: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        gap = np.maximum(0, np.maximum(self.low - point, point - self.high))
        d = np.square(gap).sum(1)
        order = np.argsort(d, kind="stable")
        return order, d[order]


def search(tree: Leaves, points: np.ndarray, vectors: np.ndarray, ids: np.ndarray, query: np.ndarray, at: np.ndarray, k: int, bound: float, t: float) -> list[tuple[float, int]]:
    """The k best (squared distance, row) of a cell, projected neighbours first.

    ``bound`` is the squared k-th distance known from elsewhere. Leaves come by their projected distance; in
    each only rows the test does not rule out are verified in full.
    """
    best_d, best_i = np.zeros(0), np.zeros(0, np.int64)
    order, near = tree.order(at)
    for leaf, d in zip(order, near):
        if d > t * bound:
            break
        rows = tree.rows[leaf]
        rows = rows[np.square(points[rows] - at).sum(1) <= t * bound]
        if not len(rows):
            continue
        full = np.square(vectors[rows] - query).sum(1)
        best_d, best_i = np.concatenate([best_d, full]), np.concatenate([best_i, rows])
        if len(best_d) > k:
            keep = np.lexsort((ids[best_i], best_d))[:k]
            best_d, best_i = best_d[keep], best_i[keep]
        if len(best_d) == k:
            bound = min(bound, float(best_d.max()))
    return list(zip(best_d.tolist(), best_i.tolist()))


def _fold_copies(rows: DataFrame, k: int, salts: int) -> DataFrame:
    """(vector, ids): distinct vectors, each with its k + 1 smallest ids.

    More copies can never be among anyone's k nearest. Copies are cut by ``salts``, of the order of the root
    of the number of rows, so that neither step puts more than that many of them into one task.
    """
    key, salt = F.xxhash64("vector"), F.pmod(F.xxhash64("id"), F.lit(salts))
    first = Window.partitionBy("vector", "_salt").orderBy("id")
    then = Window.partitionBy("vector").orderBy("id")
    some = rows.withColumn("_salt", salt).withColumn("_n", F.row_number().over(first)).where(F.col("_n") <= k + 1)
    some = some.withColumn("_n", F.row_number().over(then)).where(F.col("_n") <= k + 1)
    return some.groupBy("vector").agg(F.sort_array(F.collect_list("id")).alias("ids")).withColumn("node", key)


def nearest(
    rows: DataFrame, is_query: Column, k: int, vec_id: str = "vec_id", vector: str = "embedding", sure: float = SURE, dims: int = DIMS, cell: int = CELL
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest rows found for each row where ``is_query`` holds.

    Score is the Euclidean distance in double precision on the original vectors; ties go to the smaller id;
    the query's own row is no candidate. Null ids and vectors that are null, empty, zero or hold null or
    non-finite components take no part; rows repeated with the same id count once; with fewer candidates
    all are returned; an empty table gives no rows; other columns are not carried.

    Copies of a vector are one point with its k + 1 smallest ids. Every point lies in a cell of the tree; a
    query first visits its own cell, whose k-th distance then tells by the test which other cells it must
    visit. Cells above ``cell`` rows are cut into blocks, queries come in blocks of 2,048 or so.
    """
    spark = rows.sparkSession
    # -0.0 and 0.0 are one number, and hashes must see it so.
    number = rows.schema[vector].dataType.elementType
    own = F.transform(F.col(vector), lambda x: F.when(x == 0, F.lit(0).cast(number)).otherwise(x))
    base = rows.select(F.col(vec_id).alias("id"), own.alias("vector"), is_query.alias("query")).where(F.col("id").isNotNull() & usable(own))
    base = stored(base.dropDuplicates(["id", "vector"]), "vectors")
    n = base.count()
    d = width(base, "vector")
    plane = np.random.default_rng(SEED).standard_normal((max(1, d), dims))
    t = chi_square_quantile(sure, dims)

    points = _fold_copies(base.select("id", "vector"), k, max(1, math.isqrt(n) // 8))

    def project(batches):
        for batch in batches:
            v = matrix(batch.column(0))
            p = v @ plane if len(v) else np.zeros((0, dims))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(p.tolist(), pa.list_(pa.float64()))], [*batch.schema.names, "at"])

    kind = dict(points.dtypes)
    points = stored(points.mapInArrow(project, f"vector {kind['vector']}, ids {kind['ids']}, node long, at array<double>"), "points")
    distinct = points.count()
    cells = max(1, distinct // cell)
    seen = points.select("node", "at").orderBy(F.xxhash64("node"), "node").limit(min(SAMPLE, 64 * cells)).select("at").toLocalIterator() if cells > 1 else []
    top = spark.sparkContext.broadcast(Top(np.array([r["at"] for r in seen]).reshape(-1, dims), min(cells, SAMPLE // 64)))

    def in_cell(batches):
        for batch in batches:
            at = matrix(batch.column(batch.schema.get_field_index("at"))).reshape(-1, dims)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(top.value.cell(at).astype(np.int32))], [*batch.schema.names, "cell"])

    placed = points.mapInArrow(in_cell, f"vector {kind['vector']}, ids {kind['ids']}, node long, at array<double>, cell int")
    # One row per cell, of which there are at most 1,024.
    sizes = placed.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / cell).alias("blocks"))
    placed = stored(placed.join(F.broadcast(sizes), "cell").withColumn("block", F.pmod(F.xxhash64("node"), "blocks").cast("int")), "cells")
    # Queries with one vector are searched once.
    asked = base.where("query").select("vector").distinct().select(F.xxhash64("vector").alias("node"))
    queries = stored(placed.join(asked, "node", "left_semi").select("node", "vector", "at", "cell"), "queries")
    n_queries = queries.count()
    groups = max(1, -(-n_queries // QUERIES))
    blocks = placed.select("cell", "blocks").distinct()

    def hits(visits: DataFrame) -> DataFrame:
        """(node, d2, id): the best k + 1 of every visit (node, vector, at, cell, bound)."""
        sent = visits.join(F.broadcast(blocks), "cell").withColumn("group", F.pmod(F.xxhash64("node"), F.lit(groups)).cast("int"))
        sent = sent.withColumn("block", F.explode(F.sequence(F.lit(0), (F.col("blocks") - 1).cast("int")))).drop("blocks")
        # A cell is copied only to groups that visit it.
        meets = sent.select(F.col("cell").alias("in_cell"), F.col("group").alias("of_group")).distinct()
        there = placed.select("cell", F.col("block").alias("in_block"), "vector", "ids", "at").join(meets, F.col("cell") == F.col("in_cell")).drop("cell")

        def run(left: pa.Table, right: pa.Table) -> pa.Table:
            found_q, found_d, found_i = [], [], []
            if left.num_rows and right.num_rows:
                vectors, at = matrix(right.column("vector")), matrix(right.column("at"))
                ids = right.column("ids").to_pylist()
                least = np.array([i[0] for i in ids])
                tree = Leaves(at)
                q, qa = matrix(left.column("vector")), matrix(left.column("at"))
                bounds = left.column("bound").to_numpy()
                for row, node in enumerate(left.column("node").to_pylist()):
                    best = search(tree, at, vectors, least, q[row], qa[row], k + 1, float(bounds[row]), t)
                    flat = sorted((d2, i) for d2, r in best for i in ids[r])[: k + 1]
                    found_q += [node] * len(flat)
                    found_d += [x for x, _ in flat]
                    found_i += [i for _, i in flat]
            return pa.table({"node": pa.array(found_q, pa.int64()), "d2": pa.array(found_d, pa.float64()), "id": pa.array(found_i, id_type)})

        id_type = pa.int64() if dict(base.dtypes)["id"] == "bigint" else pa.int32()
        asking = sent.groupBy("cell", "block", "group")
        return asking.cogroup(there.groupBy("in_cell", "in_block", "of_group")).applyInArrow(run, f"node long, d2 double, id {dict(base.dtypes)['id']}")

    def best(found: DataFrame) -> DataFrame:
        order = Window.partitionBy("node").orderBy("d2", "id")
        return found.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= k + 1)

    home = stored(best(hits(queries.withColumn("bound", F.lit(float("inf"))))), "home")
    bounds = home.groupBy("node").agg(F.when(F.count(F.lit(1)) > k, F.max("d2")).otherwise(float("inf")).alias("bound"))

    def elsewhere(batches):
        for batch in batches:
            at = matrix(batch.column(batch.schema.get_field_index("at"))).reshape(-1, dims)
            cell, bound = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("cell", "bound"))
            todo = [np.flatnonzero(top.value.distance(a) <= t * b) for a, b in zip(at, bound)]
            todo = [x[x != c].astype(np.int32) for x, c in zip(todo, cell)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(todo, pa.list_(pa.int32()))], [*batch.schema.names, "more"])

    visits = queries.join(bounds, "node").mapInArrow(
        elsewhere, f"node long, vector {kind['vector']}, at array<double>, cell int, bound double, more array<int>"
    )
    visits = stored(visits.select("node", "vector", "at", F.explode("more").alias("cell"), "bound"), "visits")
    found = best(home.drop("_n").unionByName(hits(visits)))
    asking = base.where("query").select(F.col("id").alias("query_id"), F.xxhash64("vector").alias("node"))
    rank = Window.partitionBy("query_id").orderBy("d2", "id")
    out = asking.join(found.drop("_n"), "node").where(F.col("id") != F.col("query_id"))
    return (
        out.withColumn("rank", F.row_number().over(rank))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", F.col("id").alias("vec_id"), F.sqrt("d2").alias("score"))
    )
