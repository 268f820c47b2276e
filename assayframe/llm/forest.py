"""Embedding near-dedup by a forest of random-projection trees.

Each of ``TREES`` trees cuts the unit vectors again and again at the median of
a random direction; vectors within a band around a cut go to both sides.  Two
vectors are compared, in double precision, where they share a leaf.  A pair is
counted in the smallest leaf that both are in, so no pair has to be sent on to
be counted once: a leaf gives each of its vectors a number of links, and one
link to the smallest vector that it reaches there.  Links are united by the
components of the graph.

Equal vectors are one class and enter once with their number.  The first cuts
come from a bounded sample (``SAMPLE`` vectors of least hash) and go to every
task; leaves that are still too large are cut again, each by a bounded sample of
its own rows, in as many rounds as it takes.  A leaf that no cut makes
smaller is dense.  Of a dense leaf of over ``MOST`` vectors, crowds are taken out
first: all vectors within half the linking angle of a head are linked to each
other, by the triangle inequality, and are counted instead of compared.  What
is left of such a leaf is compared in pairs of chunks of ``MOST`` vectors, each
a task, so no task gets a group of unbounded size.

Defined results: vectors that are null, empty, zero or hold null or non-finite
values link with nothing: no links, their own id as component, kept.  Vectors of
different lengths link with nothing of another length.  Rows that repeat, even
with the same id, are vectors of their own and linked if comparable.  A row
without an id may link; its component is the smallest id reachable, and it is
not kept.  An empty table gives no rows.  Columns other than id and vector
are not looked at, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assayframe.llm.graph import components
from assayframe.llm.permutation_index import unit, usable
from assayframe.llm.shared import stored

TREES = 4
#: Half of the band around a cut, in standard deviations of the projected difference of two vectors that just link.
SPILL = 0.5
#: Rows of a leaf aimed at, and the most that one task compares with as many others.
LEAF, MOST = 256, 1024
#: Vectors that the first cuts are made from; those for the cuts of a large leaf, and for its heads.
SAMPLE, LEAF_SAMPLE = 16_384, 4096
#: Leaves that a tree has after the first cuts, and that a leaf is cut into in a later round, at most.
FIRST_LEAVES, LATER_LEAVES = 1024, 512
#: Rows of both sides of a cut together, against those cut, at most; a head must hold so much of its leaf's sample.
SPILLED, HELD = 1.3, 1 / 64
CELLS = "v long, cell long, final boolean"


class Tree:
    """Cuts of a sample, and where they lead."""

    def __init__(self, sample: np.ndarray, share: float, band: float, leaf: int, most: int, rng: np.random.Generator):
        """``share``: rows that each vector of the sample stands for."""
        self.directions, self.cuts, self.sides, self.band = [], [], [], band
        self.leaves, open_ = 1, [(np.arange(len(sample)), None)]
        while open_:
            own, slot = open_.pop(0)  # breadth first, so the limit on leaves cuts all parts alike
            cut = self._cut(sample[own], rng) if len(own) * share > leaf and len(own) >= 16 and self.leaves < most else None
            if cut is None:
                continue
            at = len(self.cuts)
            if slot:
                self.sides[slot[0]][slot[1]] = at
            self.directions.append(cut[0])
            self.cuts.append(cut[1])
            self.sides.append([None, None])
            self.leaves += 1
            open_ += [(own[cut[2]], (at, 0)), (own[cut[3]], (at, 1))]

    def _cut(self, points: np.ndarray, rng: np.random.Generator):
        for _ in range(4):
            direction = rng.standard_normal(points.shape[1])
            direction /= np.sqrt((direction * direction).sum())
            along = points @ direction
            cut = float(np.median(along))
            low, high = along <= cut + self.band, along >= cut - self.band
            if low.sum() + high.sum() <= SPILLED * len(points):
                return direction, cut, low, high
        return None

    def lead(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the points and the leaves they reach."""
        rows, leaves, number, open_ = [], [], 0, [(np.arange(len(points)), 0 if self.cuts else None)]
        while open_:
            own, node = open_.pop()
            if node is None:
                rows.append(own)
                leaves.append(np.full(len(own), number))
                number += 1
                continue
            along = points[own] @ self.directions[node]
            open_.append((own[along >= self.cuts[node] - self.band], self.sides[node][1]))
            open_.append((own[along <= self.cuts[node] + self.band], self.sides[node][0]))
        return np.concatenate(rows), np.concatenate(leaves)


def _packed(points: np.ndarray) -> pa.Array:
    """The rows of a matrix as binary values."""
    width = points.shape[1] * points.itemsize
    ends = np.arange(len(points) + 1, dtype=np.int32) * width
    return pa.Array.from_buffers(pa.binary(), len(points), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(points))])


def _units(column: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    """Vectors of length one, in double precision, of packed ones in single or double."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    column = column.cast(pa.binary())
    if not len(column):
        return np.zeros((0, dim))
    ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    values = np.frombuffer(column.buffers()[2], np.uint8)[ends[0] : ends[-1]]
    kind = np.float64 if len(values) == 8 * dim * len(column) else np.float32
    return unit(values.view(kind).reshape(-1, dim).astype(np.float64))


def _cells(v: pa.Array, rows: np.ndarray, cells: np.ndarray, final: bool) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([v.take(pa.array(rows)), pa.array(cells, pa.int64()), pa.array(np.full(len(rows), final))], ["v", "cell", "final"])


def leaves_of(classes: DataFrame, dim: int, count: int, link: float, trees: int, leaf: int, sample: int) -> DataFrame:
    """``v, cell, final``: the leaves that hold each class (v, vector), of all trees; leaves of later trees have larger numbers."""
    spark = classes.sparkSession
    band = SPILL * np.sqrt((2 - 2 * link) / dim)
    some = classes.orderBy(F.xxhash64("vector"), "v").limit(sample).select("vector").toArrow()
    points = _units(some.column("vector"), dim)
    forest = [Tree(points, count / max(1, len(points)), band, leaf, FIRST_LEAVES, np.random.default_rng(t)) for t in range(trees)]
    sent = spark.sparkContext.broadcast(forest)

    def lead(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = _units(batch.column("vector"), dim)
            for t, tree in enumerate(sent.value):
                rows, leaves = tree.lead(points)
                yield _cells(batch.column("v"), rows, t * FIRST_LEAVES + leaves, tree.leaves == 1)

    cells = stored(classes.select("v", "vector").mapInArrow(lead, CELLS), "forest-cells")
    while True:
        sizes = cells.groupBy("cell").agg(F.count("*").alias("size"), F.every("final").alias("ended"))
        sizes = stored(sizes.where((F.col("size") > 2 * leaf) & ~F.col("ended")).drop("ended"), "forest-sizes")
        if sizes.isEmpty():
            return cells
        large = cells.join(sizes, "cell").drop("final").join(classes.select("v", "vector"), "v")
        drawn = large.where(F.pmod(F.xxhash64("v", "cell"), F.lit(1 << 20)) * F.col("size") < F.lit(LEAF_SAMPLE << 20))
        cuts = drawn.groupBy("cell").applyInArrow(_planter(dim, band, leaf), "cell long, cuts array<double>, directions binary, sides array<int>")
        cut = large.join(stored(cuts, "forest-cuts"), "cell").mapInArrow(_leader(dim, band), CELLS)
        same = cells.join(sizes, "cell", "left_anti").withColumn("cell", F.col("cell") * LATER_LEAVES).select("v", "cell", "final")
        cells = stored(same.union(cut), "forest-cells")


def _planter(dim: int, band: float, leaf: int) -> Callable[[pa.Table], pa.Table]:
    """What cuts a large leaf by a sample of it."""

    def plant(drawn: pa.Table) -> pa.Table:
        cell, size = drawn.column("cell")[0].as_py(), drawn.column("size")[0].as_py()
        order = np.argsort(drawn.column("v").to_numpy())
        tree = Tree(_units(drawn.column("vector"), dim)[order], size / len(order), band, leaf, LATER_LEAVES, np.random.default_rng([cell, 1]))
        sides = [-1 if x is None else x for pair in tree.sides for x in pair]
        flat = np.concatenate([np.zeros(0), *tree.directions])[None, :]
        return pa.table({"cell": pa.array([cell], pa.int64()), "cuts": pa.array([tree.cuts], pa.list_(pa.float64())), "directions": _packed(flat), "sides": pa.array([sides], pa.list_(pa.int32()))})

    return plant


def _leader(dim: int, band: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """What takes the rows of large leaves to the leaves they are cut into."""

    def lead(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = batch.column("cell").to_numpy()
            for cell in np.unique(cells):
                own = batch.take(pa.array(np.flatnonzero(cells == cell)))
                tree = Tree.__new__(Tree)
                tree.band, tree.cuts = band, own.column("cuts")[0].as_py()
                tree.directions = np.frombuffer(own.column("directions")[0].as_py()).reshape(-1, dim)
                sides = own.column("sides")[0].as_py()
                tree.sides = [[None if x < 0 else x for x in sides[i : i + 2]] for i in range(0, len(sides), 2)]
                rows, leaves = tree.lead(_units(own.column("vector"), dim))
                yield _cells(own.column("v"), rows, cell * LATER_LEAVES + leaves, not tree.cuts)

    return lead


def crowds_of(classes: DataFrame, cells: DataFrame, sizes: DataFrame, dim: int, link: float) -> DataFrame:
    """``v, crowd``: vectors of dense leaves that lie within half the linking angle of a head; each in one crowd."""
    near = float(np.sqrt((1 + link) / 2)) + 1e-9

    def heads(drawn: pa.Table) -> pa.Table:
        points = _units(drawn.column("vector"), dim)
        order = np.argsort(drawn.column("v").to_numpy())
        v, within = drawn.column("v").to_numpy()[order], points[order] @ points[order].T >= near
        free, found = np.ones(len(v), bool), []
        while free.any() and len(found) < 64:
            held = (within & free).sum(axis=1)
            best = int(held.argmax())
            if held[best] < max(2, HELD * len(v)):
                break
            found.append(best)
            free &= ~within[best]
        cell = drawn.column("cell")[0].as_py()
        return pa.table({"cell": pa.array([cell], pa.int64()), "heads": pa.array([v[found]], pa.list_(pa.int64())), "points": _packed(points[order][found].reshape(1, -1))})

    def held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells, points = batch.column("cell").to_numpy(), _units(batch.column("vector"), dim)
            v, crowd = batch.column("v").to_numpy(), np.full(len(cells), -1)
            for cell in np.unique(cells):
                own = np.flatnonzero(cells == cell)
                ids = np.array(batch.column("heads")[int(own[0])].as_py(), np.int64)
                if len(ids):
                    close = points[own] @ np.frombuffer(batch.column("points")[int(own[0])].as_py()).reshape(-1, dim).T
                    crowd[own] = np.where(close.max(axis=1) >= near, ids[close.argmax(axis=1)], -1)
            yield pa.RecordBatch.from_arrays([pa.array(v[crowd >= 0]), pa.array(crowd[crowd >= 0])], ["v", "crowd"])

    dense = cells.join(sizes, "cell").join(classes.select("v", "vector"), "v")
    drawn = dense.where(F.pmod(F.xxhash64("v", "cell", F.lit(1)), F.lit(1 << 20)) * F.col("size") < F.lit(LEAF_SAMPLE // 2 << 20))
    found = stored(drawn.groupBy("cell").applyInArrow(heads, "cell long, heads array<long>, points binary"), "forest-heads")
    return stored(dense.join(found, "cell").mapInArrow(held, "v long, crowd long").groupBy("v").agg(F.min("crowd").alias("crowd")), "forest-crowds")


def _first(i: np.ndarray, j: np.ndarray, early: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pairs that share none of their earlier leaves."""
    for a in range(early.shape[1]):  # close vectors mostly have the same leaves in the same order
        keep = early[i, a] != early[j, a]
        i, j = i[keep], j[keep]
    step = max(1, (1 << 21) // max(1, early.shape[1] ** 2))
    shared = [(early[i[s : s + step], :, None] == early[j[s : s + step], None, :]).any(axis=(1, 2)) for s in range(0, len(i), step)]
    keep = ~np.concatenate([np.zeros(0, bool), *shared])
    return i[keep], j[keep]


def _least(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest of the n nodes that each reaches."""
    label = np.arange(n)
    while True:
        before, low = label, np.minimum(label[i], label[j])
        label = label.copy()
        np.minimum.at(label, i, low)
        np.minimum.at(label, j, low)
        label = label[label]
        if (label == before).all():
            return label


def _comparer(dim: int, link: float) -> Callable[[pa.Table], pa.Table]:
    """What gives the rows of two chunks of a leaf (or of one) their numbers of links, and a smaller vector that they reach."""

    def compare(rows: pa.Table) -> pa.Table:
        rows = rows.take(pa.array(np.argsort(rows.column("v").to_numpy())))
        v, n, crowd, chunk = (rows.column(c).to_numpy() for c in ("v", "n", "crowd", "chunk"))
        points, cell = _units(rows.column("vector"), dim), rows.column("cell")[0].as_py()
        lists = rows.column("cells").combine_chunks()
        ends, ids = lists.offsets.to_numpy(), lists.flatten().to_numpy()
        ends = ends - ends[0]
        own = np.repeat(np.arange(len(v)), np.diff(ends))
        place = np.arange(len(ids)) - np.repeat(ends[:-1], np.diff(ends))
        before = ids < cell
        early = np.repeat(-1 - np.arange(len(v))[:, None], max(1, int(place[before].max(initial=-1)) + 1), axis=1)
        early[own[before], place[before]] = ids[before]
        a, b = rows.column("a")[0].as_py(), rows.column("b")[0].as_py()
        left, right = np.flatnonzero(chunk == a), np.flatnonzero(chunk == b)
        pairs_i, pairs_j = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for s in range(0, len(left), 512):
            some = left[s : s + 512]
            i, j = np.nonzero(points[some] @ points[right].T >= link)
            i, j = some[i], right[j]
            keep = (a != b) | (i < j)
            keep &= (crowd[i] != crowd[j]) | (crowd[i] < 0)
            i, j = _first(i[keep], j[keep], early)
            pairs_i.append(i)
            pairs_j.append(j)
        i, j = np.concatenate(pairs_i), np.concatenate(pairs_j)
        links = np.bincount(i, n[j], len(v)) + np.bincount(j, n[i], len(v))
        some, root = np.flatnonzero(links > 0), _least(len(v), i, j)
        return pa.table({"v": pa.array(v[some]), "links": pa.array(links[some].astype(np.int64)), "root": pa.array(v[root[some]])})

    return compare


def _linked(classes: DataFrame, dim: int, count: int, link: float, trees: int, leaf: int, most: int, sample: int) -> DataFrame:
    """``v, links, root`` several times for each class (v, n, vector) with links: parts of its number of links, and a class it reaches."""
    cells = leaves_of(classes, dim, count, link, trees, leaf, sample)
    sizes = stored(cells.groupBy("cell").agg(F.count("*").alias("size")).where(F.col("size") > most), "forest-dense")
    if sizes.isEmpty():
        crowds = classes.sparkSession.createDataFrame([], "v long, crowd long")
    else:
        crowds = crowds_of(classes, cells, sizes, dim, link)
    known = cells.groupBy("v").agg(F.sort_array(F.collect_list("cell")).alias("cells"))  # as many as trees times what the bands add
    known = known.join(crowds, "v", "left").withColumn("crowd", F.coalesce("crowd", F.lit(-1).cast("long")))
    rows = classes.join(known, "v").withColumn("cell", F.explode("cells"))
    if sizes.isEmpty():
        rows = rows.withColumns({"chunk": F.lit(0), "a": F.lit(0), "b": F.lit(0)})
    else:
        rows = stored(rows, "forest-rows")
        parts = rows.join(sizes, "cell").groupBy("cell", "crowd").agg(F.ceil(F.count("*") / F.lit(most)).cast("int").alias("k"))
        listed = parts.groupBy("cell").agg(F.sort_array(F.collect_list(F.struct("crowd", "k"))).alias("parts"))
        rows = rows.join(listed, "cell", "left")  # at most 64 heads a leaf and those of the leaves it overlaps
        chunks = "flatten(transform(parts, p -> transform(sequence(0, p.k - 1), i -> struct(p.crowd as crowd, i as i))))"
        rows = rows.withColumn("chunks", F.expr(chunks))
        mine = "array_position(chunks, struct(crowd, cast(pmod(xxhash64(v), filter(parts, p -> p.crowd = crowd)[0].k) as int) as i)) - 1"
        rows = rows.withColumn("chunk", F.when(F.col("parts").isNull(), 0).otherwise(F.expr(mine)).cast("int"))
        others = "filter(sequence(0, size(chunks) - 1), c -> chunks[c].crowd <> crowd or crowd < 0)"
        rows = rows.withColumn("other", F.explode(F.when(F.col("parts").isNull(), F.array(F.lit(0))).otherwise(F.expr(others))))
        rows = rows.withColumns({"a": F.least("chunk", "other"), "b": F.greatest("chunk", "other")})
    rows = rows.select("v", "n", "vector", "crowd", "cells", "cell", "chunk", "a", "b")
    found = rows.groupBy("cell", "a", "b").applyInArrow(_comparer(dim, link), "v long, links long, root long")
    if sizes.isEmpty():
        return found
    held = classes.select("v", "n").join(crowds, "v")
    totals = held.groupBy("crowd").agg(F.sum("n").alias("total"), F.min("v").alias("root"))
    return found.union(held.join(totals, "crowd").select("v", F.col("total") - F.col("n"), "root"))


def near_duplicates(
    df: DataFrame,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    link: float = 0.9,
    trees: int = TREES,
    leaf: int = LEAF,
    most: int = MOST,
    sample: int = SAMPLE,
) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row: vectors linked by a cosine of ``link`` or more that share a leaf of some tree."""
    kind = np.float32 if df.schema[vector].dataType == T.ArrayType(T.FloatType()) else np.float64  # single precision is kept as it is
    rows = df.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("raw"))
    rows = stored(rows.withColumn("raw", F.when(usable(F.col("raw")), F.col("raw"))), "forest-vectors")
    classes = rows.where("raw is not null").groupBy("raw").agg(F.count("*").alias("n"), F.min("vec_id").alias("least"))
    classes = stored(classes.withColumns({"v": F.monotonically_increasing_id(), "dim": F.size("raw")}), "forest-classes")
    dims = classes.groupBy("dim").agg(F.count("*").alias("n")).where("n > 1").collect()  # a row a length of vectors
    parts = []
    for dim, count in sorted(map(tuple, dims)):
        units = stored(classes.where(F.col("dim") == dim).select("v", "n", "raw").mapInArrow(_packer(kind), "v long, n long, vector binary"), "forest-packed")
        parts.append(_linked(units, dim, count, link, trees, leaf, most, sample))
    out = classes.select("raw", "n", "least", "v")
    if parts:
        found = parts[0]
        for part in parts[1:]:
            found = found.union(part)
        found = stored(found, "forest-links")
        roots = components(found, "v", "root").select(F.col("node").alias("v"), F.col("root"))
        out = out.join(found.groupBy("v").agg(F.sum("links").alias("links")), "v", "left").join(roots, "v", "left")
        out = out.withColumn("root", F.coalesce("root", "v"))
        lowest = out.groupBy("root").agg(F.min("least").alias("component_id"))
        out = out.join(lowest, "root")
    else:
        out = out.withColumns({"links": F.lit(0), "component_id": F.col("least")})
    out = out.select("raw", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), "component_id")
    linked = rows.where("raw is not null").join(out, "raw").select("vec_id", "n_links", "component_id")
    alone = rows.where("raw is null").select("vec_id", F.lit(0).cast("long"), "vec_id")
    kept = F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False))
    return linked.union(alone).withColumn("kept", kept)


def _packer(kind: type) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """What packs vectors of one length as binary values."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column("raw").flatten().to_numpy(zero_copy_only=False)
            points = values.reshape(batch.num_rows, -1) if batch.num_rows else values.reshape(0, 1)
            yield pa.RecordBatch.from_arrays([batch.column("v"), batch.column("n"), _packed(points.astype(kind))], ["v", "n", "vector"])

    return pack
