"""Exact nearest neighbours without comparing every pair.

Every sample belongs to the cell of its closest pivot. A query first visits its own cell; the k-th distance found there is a
bound, and the triangle inequality then tells which other cells can hold anything closer: it visits only those. Cells are cut
into blocks of bounded size, and the queries of a cell into batches, so neither a crowded cell nor a popular one is one
task; a sample is sent once per batch of queries that visit its cell, not at all to cells nobody visits.

Where vectors have no structure a bound excludes nothing and every pair is compared. So blocks are large (a vector is sent
once per block it meets) and a pair costs its share of a matrix product in single precision; only pairs that this
product, by a bound of its error, cannot put beyond the k-th distance are measured, in double precision.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window, functions as F

from footfall.session import stored

#: Most pivots that reach the driver; a larger table has larger cells, cut into more blocks.
MOST_PIVOTS = 4096
#: Queries and samples in one matrix product; pairs measured at a time.
QUERIES, SAMPLES, PAIRS = 1024, 2048, 1 << 16


def _distances(x, centres):
    import numpy as np

    return np.sqrt(np.stack([((x - p) ** 2).sum(axis=1) for p in centres], axis=1))


def _closest(samples, ids, points, point_ids, bounds, k: int, skip_same_id: bool):
    """(point, sample, squared distance) by number: the k closest samples of each point, none beyond its bound.

    Samples are in the order that decides ties. Rows with numbers that are not finite take no part.
    """
    import numpy as np

    usable, live = (np.flatnonzero(np.isfinite(rows).all(axis=1)) for rows in (samples, points))
    points, point_ids, limits = points[live], point_ids[live], bounds[live]
    with np.errstate(over="ignore", invalid="ignore"):
        square, own = (samples**2).sum(axis=1), (points**2).sum(axis=1)
    kind = np.float32 if max(square[usable].max(initial=0.0), own.max(initial=0.0)) < 1e30 else np.float64
    asked = np.hstack([-2.0 * points, np.ones((len(points), 1))]).astype(kind)
    found = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]

    def first_k():
        q, s, dist = found
        order = np.lexsort((s, dist, q))
        q, s, dist = q[order], s[order], dist[order]
        place = np.arange(len(q)) - np.searchsorted(q, q)
        last = place == k - 1
        limits[q[last]] = np.minimum(limits[q[last]], dist[last])
        return [x[place < k] for x in (q, s, dist)]

    for lo in range(0, len(usable) if len(points) else 0, SAMPLES):
        tile = usable[lo : lo + SAMPLES]
        rough = asked @ np.hstack([samples[tile], square[tile, None]]).astype(kind).T
        # More than the error of the product and of its terms in this precision.
        error = (points.shape[1] + 16) * float(np.finfo(kind).eps) * (np.sqrt(square[tile].max()) + np.sqrt(own)) ** 2 + 1e-30
        if lo == 0 and len(tile) >= k and np.isposinf(limits).any():
            # The k-th of the first samples is a bound where there is none yet.
            other = np.where(point_ids[:, None] == ids[tile][None, :], np.inf, rough) if skip_same_id else rough
            limits = np.fmin(limits, np.partition(other, k - 1, axis=1)[:, k - 1].astype(np.float64) + own + error)
        with np.errstate(invalid="ignore"):
            reach = (limits * (1 + 1e-9) - own + error).astype(kind)
        # What has no order, of numbers too large, is measured.
        q, s = np.divmod(np.flatnonzero(~(rough > reach[:, None])), len(tile))
        s = tile[s]
        if skip_same_id:
            other = point_ids[q] != ids[s]
            q, s = q[other], s[other]
        with np.errstate(over="ignore"):
            dist = np.concatenate([np.zeros(0), *(((samples[s[at : at + PAIRS]] - points[q[at : at + PAIRS]]) ** 2).sum(axis=1) for at in range(0, len(q), PAIRS))])
        near = np.isfinite(dist)
        found = [np.concatenate([a, b[near]]) for a, b in zip(found, (q, s, dist))]
        if len(found[0]) > 16 * k * len(points):
            found = first_k()
    q, s, dist = first_k()
    return live[q], s, dist


def _rows_to_send(celled: DataFrame, visits: DataFrame, batch: int) -> tuple[DataFrame, DataFrame]:
    """Samples and queries with the ``part`` they meet in: a cell's queries are cut into batches, its samples sent to each."""
    # One row per block that is visited.
    parts = visits.groupBy("cell", "block").agg(F.ceil(F.count(F.lit(1)) / F.lit(batch)).cast("long").alias("_parts"))
    held = celled.join(parts, ["cell", "block"]).withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_parts") - 1))).drop("_parts")
    asked = visits.join(parts, ["cell", "block"]).withColumn("part", F.pmod(F.xxhash64("id"), F.col("_parts"))).drop("_parts")
    return held, asked


def nearest(
    train: DataFrame, test: DataFrame, k: int = 3, id_col: str = "id", label: str = "label", vec: str = "vec",
    pivots: int | None = None, block_rows: int = 32_768, skip_same_id: bool = False,
) -> DataFrame:
    """(test_id, rank, train_id, label, dist): the k nearest samples by squared Euclidean distance.

    ``skip_same_id`` leaves a query out of its own neighbours, for a table matched with itself. ``pivots`` grows with the
    samples unless given: one per block of samples, 16 at least. Blocks and batches of queries have ``block_rows`` rows.
    """
    import numpy as np

    # Single precision is sent as such; distances are taken in double.
    wide = {d.select(vec).schema[0].dataType.simpleString() for d in (train, test)} != {"array<float>"}
    kind_of_vec = "array<double>" if wide else "array<float>"
    train = train.select(F.col(id_col).alias("id"), F.col(label).alias("label"), F.col(vec).cast(kind_of_vec).alias("vec"))
    test = test.select(F.col(id_col).alias("id"), F.col(vec).cast(kind_of_vec).alias("vec"))
    if pivots is None:
        pivots = min(MOST_PIVOTS, max(16, math.ceil(train.count() / block_rows)))
    # ``pivots`` rows at most reach the driver.
    picked = train.orderBy(F.xxhash64("id"), "id").limit(pivots).select("vec").collect()
    kinds = {f.name: f.dataType.simpleString() for f in train.schema.fields}
    if not picked:
        kind_of_test = test.schema["id"].dataType.simpleString()
        return test.sparkSession.createDataFrame(
            [], f"test_id {kind_of_test}, train_id {kinds['id']}, label {kinds['label']}, rank long, dist double"
        )
    centres = np.array([r["vec"] for r in picked], dtype="float64")

    def to_cells(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            if batch.num_rows:
                d = _distances(np.stack(batch.column(2).to_numpy(zero_copy_only=False)).astype("float64"), centres)
                cell = d.argmin(axis=1)
                off = d[np.arange(len(d)), cell]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell, pa.int64()), pa.array(off)], [*batch.schema.names, "cell", "off"])

    celled = stored(train.mapInArrow(to_cells, f"id {kinds['id']}, label {kinds['label']}, vec {kind_of_vec}, cell long, off double"), "cells")
    # One row per pivot.
    stats = celled.groupBy("cell").agg(
        F.count(F.lit(1)).alias("n"), F.max("off").alias("hi"), F.min("off").alias("lo")
    ).orderBy("cell").collect()
    cells, sizes, radius, inner = (np.array([r[c] for r in stats], dtype=t) for c, t in (("cell", "int64"), ("n", "int64"), ("hi", "float64"), ("lo", "float64")))
    blocks = np.maximum(1, np.ceil(sizes / block_rows)).astype("int64")
    block_of = F.element_at(F.create_map(*[F.lit(int(v)) for pair in zip(cells, blocks) for v in pair]), F.col("cell").cast("int"))
    celled = celled.drop("off").withColumn("block", F.pmod(F.xxhash64("id"), block_of.cast("long")))

    def visits(first):
        """Blocks a query has to see, as cell << 32 | block: its own cell's, or those of all others that can hold something within its bound."""

        def run(batches):
            import numpy as np
            import pyarrow as pa

            for batch in batches:
                if not batch.num_rows:
                    continue
                d = _distances(np.stack(batch.column(1).to_numpy(zero_copy_only=False)).astype("float64"), centres[cells])
                home = np.arange(len(cells)) == d.argmin(axis=1)[:, None]
                if first:
                    see = home
                else:
                    bound = batch.column(2).to_numpy(zero_copy_only=False)
                    near = np.maximum(np.maximum(d - radius[None, :], inner[None, :] - d), 0.0)
                    see = ~home & (near <= bound[:, None] * (1 + 1e-9) + 1e-9)
                c = np.nonzero(see)[1]
                starts = np.repeat(np.cumsum(blocks[c]) - blocks[c], blocks[c])
                to = np.repeat(cells[c] << 32, blocks[c]) | (np.arange(len(starts)) - starts)
                ends = np.cumsum(np.where(see, blocks[None, :], 0).sum(axis=1))
                lists = pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()), pa.array(to, pa.int64()))
                yield pa.RecordBatch.from_arrays([*batch.columns, lists], [*batch.schema.names, "to"])

        return run

    def best(left, right):
        import numpy as np
        import pandas as pd

        out = []
        if len(left) and len(right):
            # In id order a stable sort breaks ties by id.
            left = left.sort_values("id", kind="stable")
            # Of equal samples no query takes more than the first k that have another id.
            repeats = int(left["id"].value_counts().max()) if skip_same_id else 0
            spots = left["vec"].map(lambda v: v.tobytes())
            left = left[spots.groupby(spots).cumcount().to_numpy() < k + repeats]
            samples, points = (np.stack(rows["vec"].to_numpy()).astype("float64") for rows in (left, right))
            ids, labels, asked_ids, bounds = left["id"].to_numpy(), left["label"].to_numpy(), right["id"].to_numpy(), right["bound"].to_numpy(dtype="float64")
            for lo in range(0, len(points), QUERIES):
                part = slice(lo, lo + QUERIES)
                q, s, dist = _closest(samples, ids, points[part], asked_ids[part], bounds[part] ** 2, k, skip_same_id)
                out.append(pd.DataFrame({"test_id": asked_ids[part][q], "train_id": ids[s], "label": labels[s], "dist": dist}))
        if not out:
            return pd.DataFrame({"test_id": [], "train_id": [], "label": [], "dist": []})
        return pd.concat(out, ignore_index=True)

    spot = ["cell", "block", "part"]
    rank = Window.partitionBy("test_id").orderBy("dist", "train_id")

    def found(asked, first):
        # Vectors are stored once each, and multiplied only on their way to the blocks.
        asked = stored(asked.mapInArrow(visits(first), f"id {kinds['id']}, vec {kind_of_vec}, bound double, to array<long>"), "visits")
        asked = asked.withColumn("to", F.explode("to")).select(
            "id", "vec", "bound", F.shiftright("to", 32).alias("cell"), F.col("to").bitwiseAND(F.lit((1 << 32) - 1)).alias("block")
        )
        held, asked = _rows_to_send(celled, asked, block_rows)
        met = held.groupBy(*spot).cogroup(asked.groupBy(*spot)).applyInPandas(
            best, f"test_id {kinds['id']}, train_id {kinds['id']}, label {kinds['label']}, dist double"
        )
        return met.withColumn("rank", F.row_number().over(rank).cast("long")).where(F.col("rank") <= k)

    near = stored(found(test.withColumn("bound", F.lit(float("inf"))), True), "home")
    # A query without k samples in its own cell has no bound yet.
    bounds = near.where(F.col("rank") == k).select(F.col("test_id").alias("_of"), F.sqrt("dist").alias("bound"))
    open_ = test.join(bounds, F.col("id") == F.col("_of"), "left").select("id", "vec", F.coalesce("bound", F.lit(float("inf"))).alias("bound"))
    both = near.drop("rank").unionByName(found(open_, False).drop("rank"))
    return both.withColumn("rank", F.row_number().over(rank).cast("long")).where(F.col("rank") <= k)


def knn(
    train: DataFrame, test: DataFrame, k: int = 3, min_votes: int = 2, **options
) -> DataFrame:
    """(test_id, label, votes) for labels with at least ``min_votes`` of the k nearest samples.

    Without such a majority a query has no row.
    """
    votes = nearest(train, test, k, **options).groupBy("test_id", "label").agg(F.count(F.lit(1)).alias("votes"))
    return votes.where(F.col("votes") >= min_votes)
