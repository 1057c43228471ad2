"""Near-duplicate vectors: exact cosine links within a label, tile against tile, on products bounded by leading principal axes."""

from __future__ import annotations

import math
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from footfall.llm.common import discard, forget, stored
from footfall.llm.components import components
from footfall.llm.vectors import matrix, usable, width
from footfall.session import scratch_path

#: Rows and bytes of vectors of a tile; leading coordinates that sort rows; those a tile's box bounds.
TILE, TILE_BYTES, LEADING, BOX = 16_384, 1 << 22, 2, 8
#: Leading coordinates after which a block of products is bounded; rows and columns of a block.
STEPS, BLOCK = (28, 44), (256, 2048)
#: Share of a block's pairs above which the next bound is worth more than measuring them one by one.
CROWDED = 1 / 256
#: Rounding of coordinates; parts of tiles that are the first side of a join; fewest rows worth a part.
SLACK, STRIPE, LEAST = 1e-9, 8, 2048
#: Pairs, or rows found, that are held at a time.
HELD = 1 << 16


def _unit(v: np.ndarray) -> np.ndarray:
    # Scaling by the largest component first keeps squares within range.
    v = v / np.abs(v).max(1, keepdims=True)
    return v / np.sqrt(np.square(v).sum(1, keepdims=True))


def _slack(d: int, turned: bool = False) -> float:
    """Rounding that a product of ``d`` single-precision numbers of unit vectors may carry; of rotated ones as well."""
    return (d + 8) * 2.0**-23 * (1 + 2 * math.sqrt(d) if turned else 1)


def principal_axes(rows: DataFrame, d: int) -> np.ndarray:
    """Axes by falling variance over all unit vectors: sums of d * d products per task, added up by Spark."""

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((d, d))
        for batch in batches:
            if batch.num_rows:
                x = _unit(matrix(batch.column(0)))
                total += x.T @ x
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(d * d)), pa.array(total.reshape(-1))], ["place", "value"])

    summed = rows.select("vector").mapInArrow(moments, "place long, value double").groupBy("place").agg(F.sum("value").alias("value"))
    total = np.zeros(d * d)
    for r in summed.collect():  # d * d numbers
        total[r["place"]] = r["value"]
    return np.ascontiguousarray(np.linalg.eigh(total.reshape(d, d))[1][:, ::-1])


class Tile:
    """Vectors as they are, unit vectors in single precision, and what bounds the products of these."""

    def __init__(self, v: np.ndarray, axes: np.ndarray):
        d = v.shape[1]
        self.v, self.x = v, _unit(v.astype(np.float64)).astype(np.float32)
        turned = self.x @ axes.astype(np.float32)
        # Leading coordinates and the norm of the rest: their product is no less than the whole one.
        self.bounds = [np.hstack([turned[:, :k], np.sqrt(np.einsum("nd,nd->n", turned[:, k:], turned[:, k:]))[:, None]]) for k in STEPS if k < d]

    def __len__(self) -> int:
        return len(self.v)


def _exact(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosines of the vectors as they are, row by row; powers of two keep squares within range and digits the same."""
    p, q = (np.ldexp(v, -np.frexp(np.abs(v).max(1, keepdims=True))[1]) for v in (a.astype(np.float64), b.astype(np.float64)))
    return (p * q).sum(1) / (np.sqrt(np.square(p).sum(1)) * np.sqrt(np.square(q).sum(1)))


def _reach(a: Tile, b: Tile, i: np.ndarray, j: np.ndarray, threshold: float) -> np.ndarray:
    """Whether the cosines of pairs (i, j) reach the threshold, decided on the vectors as they are."""
    ok = np.empty(len(i), bool)
    for lo in range(0, len(i), HELD):
        part = slice(lo, lo + HELD)
        ok[part] = _exact(a.v[i[part]], b.v[j[part]]) >= threshold
    return ok


def _linked(a: Tile, b: Tile, few: list[tuple[np.ndarray, np.ndarray]], threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Those of a few pairs (i, j) that link."""
    slack = _slack(a.x.shape[1])
    i, j = (np.concatenate(x) for x in zip(*few))
    product = np.concatenate([np.zeros(0, np.float32), *(np.einsum("nd,nd->n", a.x[i[lo : lo + HELD]], b.x[j[lo : lo + HELD]]) for lo in range(0, len(i), HELD))])
    ok = product >= threshold + slack
    near = np.flatnonzero(~ok & (product >= threshold - slack))
    ok[near] = _reach(a, b, i[near], j[near], threshold)
    return i[ok], j[ok]


def _places(mask: np.ndarray, lo: int, left: int) -> tuple[np.ndarray, np.ndarray]:
    # Much faster than nonzero of a table.
    i, j = np.divmod(np.flatnonzero(mask), mask.shape[1])
    return i + lo, j + left


def tile_links(a: Tile, b: Tile, threshold: float, same: bool) -> Iterator[tuple[int, int, np.ndarray | None, np.ndarray, np.ndarray]]:
    """Links of two tiles, block by block: (first row, first column, mask, rows, columns).

    In a crowded block links are a mask over its pairs, elsewhere row and column numbers and no mask. Of a tile with
    itself each pair is told once, the smaller row first. Pairs that the product of leading coordinates and the norms
    of the rest keep below the threshold are not measured; close calls are decided on the original numbers.
    """
    d = a.x.shape[1]
    slack = _slack(d)
    rows, columns = BLOCK
    steps = [(x, y, threshold - _slack(d, True)) for x, y in zip(a.bounds, b.bounds)] + [(a.x, b.x, threshold - slack)]
    few: list[tuple[np.ndarray, np.ndarray]] = []
    room = np.empty(rows * columns, np.float32)
    for lo in range(0, len(a), rows):
        hi, level = min(lo + rows, len(a)), 0
        for left in range(lo // columns * columns if same else 0, len(b), columns):
            right = min(left + columns, len(b))
            while True:
                x, y, low = steps[level]
                bound = np.matmul(x[lo:hi], y[left:right].T, out=room[: (hi - lo) * (right - left)].reshape(hi - lo, -1))
                if bound.max() < low:
                    some = crowded = False
                    break
                at = bound >= low
                some, crowded = True, np.count_nonzero(at) > CROWDED * at.size
                if not crowded or level == len(steps) - 1:
                    break
                # So it will be for the neighbours.
                level += 1
            if not crowded:
                if some:
                    i, j = _places(at, lo, left)
                    few.append((i[i < j], j[i < j]) if same else (i, j))
                    if sum(len(x) for x, _ in few) > HELD:
                        yield 0, 0, None, *_linked(a, b, few, threshold)
                        few = []
                continue
            mask = bound >= threshold + slack
            i, j = _places(at > mask, lo, left)
            if len(i):
                mask[i - lo, j - left] = _reach(a, b, i, j, threshold)
            if same:
                mask &= np.arange(lo, hi)[:, None] < np.arange(left, right)
            n = np.count_nonzero(mask)
            if n > CROWDED * mask.size:
                yield lo, left, mask, i[:0], j[:0]
            elif n:
                yield lo, left, None, *_places(mask, lo, left)
    if few:
        yield 0, 0, None, *_linked(a, b, few, threshold)


def _smallest(n: int, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The smallest row each of ``n`` rows reaches over links (x, y)."""
    root = np.arange(n)
    while True:
        new = root.copy()
        low = np.minimum(root[x], root[y])
        np.minimum.at(new, x, low)
        np.minimum.at(new, y, low)
        # Their roots meet as well.
        np.minimum.at(new, root[x], low)
        np.minimum.at(new, root[y], low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def pair_found(a: Tile, b: Tile, ids: np.ndarray, copies: np.ndarray, threshold: float, same: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(id, hits, smallest id reached) of rows with a link between two tiles.

    ``ids`` and ``copies`` are those of a, then those of b unless both are the ``same``.
    """
    n, shift = len(ids), 0 if same else len(a)
    order = np.argsort(ids, kind="stable")
    rank = np.empty(n, np.int64)
    rank[order] = np.arange(n)
    hits, root = np.zeros(n), np.arange(n)
    held: list[tuple[np.ndarray, np.ndarray]] = []
    count = copies.astype(np.float64)
    # Single precision adds up whole numbers exactly as far as this.
    counted = count.astype(np.float32) if count.sum() < 1 << 24 else count

    def meet() -> None:
        nonlocal root
        x, y = (root[rank[np.concatenate(z)]] for z in zip(*held))
        held.clear()
        apart = x != y
        if apart.any():
            root = _smallest(n, x[apart], y[apart])[root]

    for lo, left, mask, i, j in tile_links(a, b, threshold, same):
        if mask is None:
            j = j + shift
            np.add.at(hits, i, count[j])
            np.add.at(hits, j, count[i])
        else:
            up, across = slice(lo, lo + mask.shape[0]), slice(left + shift, left + shift + mask.shape[1])
            many = mask.astype(counted.dtype)
            hits[up] += many @ counted[across]
            hits[across] += counted[up] @ many
            # Of links between what is not joined yet, one for each row and each column, until none is left.
            while True:
                x, y = root[rank[up]], root[rank[across]]
                if min(x.min(), y.min()) == max(x.max(), y.max()):
                    break
                apart = mask & (x[:, None] != y)
                i, j = np.flatnonzero(apart.any(1)), np.flatnonzero(apart.any(0))
                if not len(i):
                    break
                held.append((np.concatenate([i, apart[:, j].argmax(0)]) + up.start, np.concatenate([apart[i].argmax(1), j]) + across.start))
                meet()
            continue
        if len(i):
            held.append((i, j))
            if sum(len(x) for x, _ in held) > HELD:
                meet()
    if held:
        meet()
    used = np.flatnonzero(hits)
    return ids[used], hits[used].astype(np.int64), ids[order[root[rank[used]]]]


def _merged(found: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One row for each id: its hits added up, and the smallest id it reaches over all rows."""
    ids, hits, roots = (np.concatenate(x) for x in zip(*found))
    every, at = np.unique(np.concatenate([ids, roots]), return_inverse=True)
    x, y = at[: len(ids)], at[len(ids) :]
    total = np.bincount(x, hits, len(every)).astype(np.int64)
    used = np.flatnonzero(total)
    return every[used], total[used], every[_smallest(len(every), x, y)[used]]


def _rotate(axes, kind: type, lead: int, step: float, ids: bool):
    """Rows with a digest that stands for label and vector and the cells of its leading coordinates; with their id, or with the vector.

    Numbers of a row depend on that row alone, so equal vectors come out equal wherever they are.
    """

    def rotate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set = set()
        for batch in batches:
            if not batch.num_rows:
                continue
            v = matrix(batch.column(0)) + 0.0  # no negative zeros
            raw = [row.tobytes() for row in v.astype(kind)]
            digest = [blake2b(row + repr(of).encode(), digest_size=16).digest() for row, of in zip(raw, batch.column(1).to_pylist())]
            x = _unit(v)
            cells = [pa.array(np.floor((x * axes.value[:, m]).sum(1) / step).astype(np.int64)) for m in range(lead)]
            names = ["label", "digest", *[f"c{m}" for m in range(lead)]]
            out = pa.RecordBatch.from_arrays([batch.column(1), pa.array(digest, pa.binary()), *cells], names)
            if ids:
                yield out.append_column("id", batch.column(2))
                continue
            # Most copies of a vector go here; the others where their rows meet.
            new = []
            for at, key in enumerate(digest):
                if key not in seen:
                    new.append(at)
                    seen.add(key)
            if len(seen) > HELD:
                seen.clear()
            yield out.append_column("v", pa.array(raw, pa.binary())).take(pa.array(new, pa.int64()))

    return rotate


def _tiles(axes, kind: type, d: int, size: int):
    """Tiles of at most ``size`` vectors of a label, from rows in order: of equal keys the one with node and copies, then those with the vector.

    A tile that may not be its label's only one is an ``edge``: one that is full, comes after one, or is the first or last of its part.
    """

    def tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        part, made = TaskContext.get().partitionId(), 0
        label, have, held, before_it = None, 0, [], True
        out: list[tuple] = []

        def close(after_it: bool) -> None:
            nonlocal have, made, before_it
            if have:
                node, copies, v = (np.concatenate(x) for x in zip(*held))
                x = _unit(v.astype(np.float64)) @ axes.value[:, :BOX]
                low, high = (x.min(0) - SLACK).tolist(), (x.max(0) + SLACK).tolist()
                out.append((label, part, (part << 32) + made, node.tobytes(), copies.tobytes(), v.tobytes(), low, high, before_it or after_it))
                made += 1
            before_it = after_it
            have = 0
            held.clear()

        def rows() -> pa.RecordBatch:
            box = pa.list_(pa.float64())
            kinds = [before.column("label").type, pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), box, box, pa.bool_()]
            batch = pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*out), kinds)], TILE_COLUMNS)
            out.clear()
            return batch

        before = None
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch] if before is None else [before, batch]).combine_chunks()
            first = before is None
            before = batch.slice(batch.num_rows - 1, 1)
            known = table.column("node").is_valid().to_numpy()
            digest = table.column("digest").combine_chunks()
            equal = pc.equal(digest.slice(1), digest.slice(0, len(digest) - 1)).to_numpy(zero_copy_only=False)
            # Every key has one row with its node, then one or more with its vector.
            if (first and not known[0]) or (equal == known[1:]).any():
                raise RuntimeError("rows of the table changed while it was read")
            at = np.flatnonzero(known[:-1])
            if not len(at):
                continue
            of, node, copies = (table.column(c).combine_chunks().take(pa.array(at)) for c in ("label", "node", "copies"))
            node, copies = node.to_numpy(), copies.to_numpy()
            v = np.frombuffer(b"".join(table.column("v").combine_chunks().take(pa.array(at + 1)).to_pylist()), kind).reshape(-1, d)
            cuts = np.flatnonzero(pc.not_equal(of.slice(1), of.slice(0, len(of) - 1)).to_numpy(zero_copy_only=False)) + 1
            for lo, hi in zip([0, *cuts], [*cuts, len(at)]):
                if (mine := of[int(lo)].as_py()) != label:
                    close(label is None)
                    label = mine
                while lo < hi:
                    end = min(hi, lo + size - have)
                    held.append((node[lo:end], copies[lo:end], v[lo:end]))
                    have += end - lo
                    lo = end
                    if have == size:
                        close(True)
            if len(out) >= 1024 or sum(len(x[5]) for x in out) >= TILE_BYTES:
                yield rows()
        if before is not None and before.column("node")[0].is_valid:
            raise RuntimeError("rows of the table changed while it was read")
        close(True)
        if out:
            yield rows()

    return tiles


#: What the table of tiles holds, and what of it travels to the tasks that compare.
TILE_COLUMNS = ["label", "part", "tile", "ids", "copies", "v", "low", "high", "edge"]
BODY = ["tile", "ids", "copies", "v"]


def _gap(a: str, b: str) -> Column:
    """Square of the distance between the boxes of two tiles."""
    one, other = (F.zip_with(f"{x}_low", f"{y}_high", lambda low, high: low - high) for x, y in ((a, b), (b, a)))
    apart = F.zip_with(one, other, lambda x, y: F.greatest(x, y, F.lit(0.0)))
    return F.aggregate(apart, F.lit(0.0), lambda total, x: total + x * x)


def _compare(axes, kind: type, d: int, threshold: float):
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        ready: dict[int, Tile] = {}

        def tile(name: int, blob: pa.Buffer) -> Tile:
            # A task meets the same few tiles again and again.
            if name not in ready:
                while len(ready) >= 4:
                    ready.pop(next(iter(ready)))
                ready[name] = Tile(np.frombuffer(bytes(blob), kind).reshape(-1, d), axes.value)
            return ready[name]

        def rows() -> pa.RecordBatch:
            merged = _merged(found)
            found.clear()
            return pa.RecordBatch.from_arrays([pa.array(x) for x in merged], ["node", "hits", "root"])

        found: list = []
        for batch in batches:
            for row in range(batch.num_rows):
                name_a, name_b = batch.column(0)[row].as_py(), batch.column(4)[row].as_py()
                same = name_b is None
                sides = (0,) if same else (0, 4)
                ids, copies = (np.concatenate([np.frombuffer(batch.column(s + c)[row].as_buffer(), np.int64) for s in sides]) for c in (1, 2))
                if same and len(ids) < 2:
                    continue
                a = tile(name_a, batch.column(3)[row].as_buffer())
                b = a if same else tile(name_b, batch.column(7)[row].as_buffer())
                new = pair_found(a, b, ids, copies, threshold, same)
                if len(new[0]):
                    found.append(new)
                if sum(len(x[0]) for x in found) > 4 * HELD:
                    yield rows()
        if found:
            yield rows()

    return compare


def near_duplicates(rows: DataFrame, threshold: float, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every distinct (vec_id, vector, label) of the table.

    Two vectors link if their labels are equal and not null and their cosine, in double precision, is at least
    ``threshold`` (positive). Vectors that are null, empty, zero or hold null or non-finite components link
    with nothing, and so do null ids; ``component_id`` is the smallest id reachable (null for a null id).
    Repeated rows count once, and an id that carries several vectors is one point of the graph; an empty
    table gives no rows; other columns are not carried. The table is read several times and must not change.

    Equal vectors are one node with the number of its ids. Ids travel with a digest of their vector; vectors
    travel once, sorted by label and by the cells of their leading coordinates, into tiles that are stored once.
    Every tile meets itself and the other tiles of its label whose boxes are close enough: tasks read them where they
    are stored, so pairs of tiles are never shuffled and disk grows with the table, not with its pairs. A tile pair emits
    a count per row and a spanning set of its links, so crowded cells never emit pairs.
    """
    spark = rows.sparkSession
    plain = rows.select(F.col(vec_id).alias("id"), F.col(vector).alias("vector"), F.col(label).alias("label"))
    part = F.col("id").isNotNull() & F.col("label").isNotNull() & usable(F.col("vector"))
    valid = plain.where(part)
    rest = plain.where(~part).distinct().select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    d = width(valid, "vector")
    if d:
        rest = _linked_rows(spark, valid, d, threshold).unionByName(rest)
    return rest.select(
        F.col("id").alias("vec_id"), "n_links", "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept")
    )


def _linked_rows(spark, valid: DataFrame, d: int, threshold: float) -> DataFrame:
    """(id, n_links, component_id) of the rows that take part."""
    types = dict(valid.dtypes)
    kind = np.float32 if types["vector"] == "array<float>" else np.float64
    axes = spark.sparkContext.broadcast(principal_axes(valid, d))
    step = math.sqrt(max(0.0, 2 - 2 * threshold)) * (1 + 1e-9) + SLACK
    lead = min(LEADING, d)
    cells = [f"c{m}" for m in range(lead)]
    key = f"label {types['label']}, digest binary, {', '.join(f'{c} long' for c in cells)}"

    def turned(ids: bool) -> DataFrame:
        out = f"{key}, id {types['id']}" if ids else f"{key}, v binary"
        return valid.select("vector", "label", *(["id"] if ids else [])).mapInArrow(_rotate(axes, kind, lead, step, ids), out)

    ids = stored(turned(True).distinct(), "ids")
    nodes = stored(ids.groupBy("label", "digest", *cells).agg(F.min("id").alias("node"), F.count(F.lit(1)).alias("copies")), "nodes")

    size = max(1, min(TILE, TILE_BYTES // (d * np.dtype(kind).itemsize)))
    n = nodes.count()
    parts = max(math.ceil(n / size), min(spark.sparkContext.defaultParallelism, math.ceil(n / LEAST)))
    both = turned(False).withColumns({"node": F.lit(None).cast("long"), "copies": F.lit(None).cast("long")}).unionByName(
        nodes.select("label", "digest", *cells, F.lit(None).cast("binary").alias("v"), F.col("node").cast("long").alias("node"), "copies")
    )
    order = ["label", *cells, "digest"]
    sorted_rows = both.repartitionByRange(parts, *order).sortWithinPartitions(*order, F.col("node").asc_nulls_last()).select("label", "digest", "node", "copies", "v")
    made = sorted_rows.mapInArrow(
        _tiles(axes, kind, d, size),
        f"label {types['label']}, part int, tile long, ids binary, copies binary, v binary, low array<double>, high array<double>, edge boolean",
    )
    path = scratch_path(spark, "tiles")
    made.write.option("parquet.enable.dictionary", "false").partitionBy("part").parquet(path)
    tiles = spark.read.schema(made.schema).parquet(path)

    # Labels of several tiles, by the parts they lie in: as many as there are parts and full tiles at most.
    several = tiles.where("edge")
    spans = several.groupBy("label").agg(F.min("part").alias("first"), F.max("part").alias("last"), F.count(F.lit(1)).alias("tiles"))
    spans = [(r["first"], r["last"]) for r in spans.where("tiles > 1").select("first", "last").distinct().collect()]
    side = lambda df, s: df.select("label", *[F.col(c).alias(f"{s}_{c}") for c in [*BODY, "low", "high"]])
    pairs = tiles.select(*[F.col(c).alias(f"a_{c}") for c in BODY], *[F.lit(None).cast(dict(tiles.dtypes)[c]).alias(f"b_{c}") for c in BODY])
    stripe = max(STRIPE, math.ceil(parts / 64))
    far = max(0.0, 2 - 2 * threshold) + _slack(d)
    for begin in range(0, max((last for _, last in spans), default=-1) + 1, stripe):
        end = begin + stripe - 1
        reach = [last for first, last in spans if first <= end and last >= begin]
        if reach:
            a = side(several.where(F.col("part").between(begin, end)), "a")
            b = side(several.where(F.col("part").between(begin, max(reach))), "b").withColumnRenamed("label", "label2")
            # A pair of tiles is found where its first tile is.
            near = (F.col("label") == F.col("label2")) & (F.col("a_tile") < F.col("b_tile")) & (_gap("a", "b") <= far)
            met = a.join(b.hint("shuffle_replicate_nl"), near)
            pairs = pairs.unionByName(met.select(*[f"{s}_{c}" for s in "ab" for c in BODY]))
    found = stored(pairs.mapInArrow(_compare(axes, kind, d, threshold), "node long, hits long, root long"), "links")
    discard(tiles)

    hits = found.groupBy("node").agg(F.sum("hits").alias("hits"))
    roots = components(found.select("node", "root").distinct(), "node", "root").withColumnsRenamed({"root": "least"})
    of_node = nodes.join(hits, "node", "left").join(roots, "node", "left").select("label", "digest", "node", "copies", "hits", "least")
    return ids.join(of_node, ["label", "digest"]).select(
        "id", (F.col("copies") - 1 + F.coalesce("hits", F.lit(0))).alias("n_links"), F.coalesce("least", "node").alias("component_id")
    )
