"""Boosted trees that tell each variant's cells from the wild type's, for all variants and folds at once.

Features are cut into bins by quantiles that all models share, and a cell's
bins are packed into one binary value.  Cells of one label, fold and bins are the
same to every model, so they are counted once and stand in one row.  A level of a
round's trees is one pass over these rows: a task works out their margins from the trees so
far, sums gradients and curvatures by (model, node, feature, bin), and only
these sums are shuffled.  A wild-type cell adds to the sums of every model that
trains on it where it lies; it is never copied to a variant, and is copied only
in the result, which has a score of it against each variant.

Models are fitted in blocks whose sums in a task, and trees on the driver, are
of bounded size, so a block more is a scan of the cells more.  Both classes weigh
the same in each model.  A missing or non-finite value has a bin of its own
and goes to the side of greater gain; equal gains go to the first feature, then
the lowest cut, then missing values left.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assayframe.functions.columns import finite
from assayframe.operators.areas import BLOCK_ROWS, FEW_ROWS, PACKS, Scored, Scorer, areas, blocks, coded, groups, packs, spread
from assayframe.operators.qc import BARCODE, LABEL, min_cells_per_variant
from assayframe.sources.tables import written

#: Bins of a feature besides that of missing values, shrinkage, ridge on leaves, least gain and least curvature of a side.
BINS, RATE, RIDGE, LEAST_GAIN, LEAST_WEIGHT = 32, 0.3, 1.0, 1e-6, 1.0
#: Sums that a task holds for a block of models, and bins that it unpacks together, about.
BLOCK_BYTES, UNPACKED = 64 << 20, 4 << 20
SUMS = "model int, node int, feature int, bin int, g double, h double"
SPLIT = "model int, node int, feature int, cut int, missing_left boolean, left double, right double, whole double"


def quantile_cuts(cells: DataFrame, features: Sequence[str], bins: int = BINS) -> np.ndarray:
    """Upper bounds of each feature's bins but the last, repeated ones left as empty bins: features x (bins - 1)."""
    shares = [k / bins for k in range(1, bins)]
    found = cells.agg(*(F.percentile_approx(finite(f).cast("double"), shares, 100_000).alias(f"c{i}") for i, f in enumerate(features))).first()
    return np.array([c if c else [0.0] * (bins - 1) for c in found])


def binned(features: Sequence[str], cuts: np.ndarray) -> Column:
    """A cell's bins, a byte a feature: 0 without a finite value, else one more than the number of cuts below it."""

    @F.arrow_udf(T.BinaryType())
    def bins(*values: pa.Array) -> pa.Array:
        out = np.zeros((len(values[0]), len(values)), np.uint8)
        for i, v in enumerate(values):
            x = v.to_numpy(zero_copy_only=False).astype(float)
            out[:, i] = np.where(np.isfinite(x), np.searchsorted(cuts[i], x) + 1, 0)
        ends = np.arange(len(out) + 1, dtype=np.int32) * out.shape[1]
        return pa.Array.from_buffers(pa.binary(), len(out), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(out.tobytes())])

    return bins(*(finite(f).cast("double") for f in features))


class Trees:
    """Trees of a block of models, all of one depth: arrays of [model, round, node]; leaves follow inner nodes."""

    def __init__(self, models: int, rounds: int, depth: int):
        self.depth, self.rounds = depth, 0
        shape = (models, rounds, 2**depth - 1)
        self.feature, self.cut = np.full(shape, -1), np.zeros(shape, np.int64)
        self.missing_left = np.zeros(shape, bool)
        self.value = np.zeros((models, rounds, 2 ** (depth + 1) - 1))

    def node(self, model: int, round_: int, bins: np.ndarray, levels: int) -> np.ndarray:
        """Where rows of bins stand after so many levels; a node that isn't split passes all to the left."""
        at = np.zeros(len(bins), np.int64)
        for _ in range(levels):
            f = self.feature[model, round_, at]
            b = bins[np.arange(len(bins)), np.maximum(f, 0)]
            right = (f >= 0) & np.where(b == 0, ~self.missing_left[model, round_, at], b > self.cut[model, round_, at])
            at = 2 * at + 1 + right
        return at

    def margin(self, model: int, bins: np.ndarray) -> np.ndarray:
        out = np.zeros(len(bins))
        for r in range(self.rounds):
            out += self.value[model, r, self.node(model, r, bins, self.depth)]
        return out


def best_split(g: np.ndarray, h: np.ndarray) -> tuple[int, int, bool, float, float, float]:
    """Feature, cut, side of missing values and the values of both sides and the whole, of sums [feature, bin]; feature -1 if nothing gains."""
    value = lambda a, b: -RATE * a / (b + RIDGE)
    total_g, total_h = g[0].sum(), h[0].sum()
    score = lambda a, b: a * a / (b + RIDGE)
    best = (LEAST_GAIN, -1, 0, True, 0.0, 0.0)
    for f in range(len(g)):
        low_g, low_h = g[f, 1:].cumsum()[:-1], h[f, 1:].cumsum()[:-1]
        for left in (True, False):
            a, b = low_g + left * g[f, 0], low_h + left * h[f, 0]
            gain = score(a, b) + score(total_g - a, total_h - b) - score(total_g, total_h)
            gain = np.round(np.where((b >= LEAST_WEIGHT) & (total_h - b >= LEAST_WEIGHT), gain, -1.0), 8)
            k = int(gain.argmax())
            # a later feature, cut or side has to gain more
            if gain[k] > best[0]:
                best = (gain[k], f, k + 1, left, value(a[k], b[k]), value(total_g - a[k], total_h - b[k]))
    return (*best[1:], value(total_g, total_h))


def _rows_at_once(n_features: int) -> int:
    return max(1, min(BLOCK_ROWS, UNPACKED // n_features))


def _unpacked(bins: pa.ChunkedArray, n_features: int) -> np.ndarray:
    return np.frombuffer(b"".join(bins.to_pylist()), np.uint8).reshape(-1, n_features).astype(np.int64)


def _sums(trees: Trees, models: list[tuple[str, int, float]], n_features: int, bins: int, level: int, round_: int, wildtype: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """What sums gradients and curvatures of the cells of a task for each model, node of a level, feature and bin."""
    by_label: dict[str, list[int]] = {}
    for m, (variant, _, _) in enumerate(models):
        by_label.setdefault(variant, []).append(m)
    first, width = 2**level - 1, n_features * (bins + 1)

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, len(models), 2**level * width))
        for block in blocks(batches, _rows_at_once(n_features)):
            (label, labels), folds, counts = coded(block, "label"), block.column("fold").to_numpy(), block.column("n").to_numpy()
            packed = _unpacked(block.column("bins"), n_features)
            for rows in groups(label):
                name = labels[label[rows[0]]]
                for m in range(len(models)) if name == wildtype else by_label.get(name, ()):
                    own = rows[folds[rows] != models[m][1]]
                    if not len(own):
                        continue
                    x = packed[own]
                    p = 1 / (1 + np.exp(-trees.margin(m, x)))
                    w = (models[m][2] if name == wildtype else 1.0) * counts[own]
                    node = trees.node(m, round_, x, level) - first
                    place = (node[:, None] * width + np.arange(n_features) * (bins + 1) + x).ravel()
                    for k, each in enumerate((w * (p - (name == wildtype)), w * p * (1 - p))):
                        total[k, m] += np.bincount(place, np.repeat(each, n_features), total.shape[2])
        m, place = np.nonzero(total[1])
        node, rest = np.divmod(place, width)
        feature, bin_ = np.divmod(rest, bins + 1)
        columns = [*(pa.array(c.astype(np.int32)) for c in (m, node + first, feature, bin_)), pa.array(total[0][m, place]), pa.array(total[1][m, place])]
        yield pa.RecordBatch.from_arrays(columns, ["model", "node", "feature", "bin", "g", "h"])

    return summed


def _splitter(n_features: int, bins: int) -> Callable[[pa.Table], pa.Table]:
    """What splits a node by its sums, a row a feature and bin."""

    def split(sums: pa.Table) -> pa.Table:
        g, h = np.zeros((2, n_features, bins + 1))
        at = sums.column("feature").to_numpy(), sums.column("bin").to_numpy()
        g[at], h[at] = sums.column("g").to_numpy(), sums.column("h").to_numpy()
        found = best_split(g, h)
        names = [c.split()[0] for c in SPLIT.split(", ")]
        row = dict(zip(names, (sums.column("model")[0].as_py(), sums.column("node")[0].as_py(), *found)))
        kinds = [pa.int32()] * 4 + [pa.bool_()] + [pa.float64()] * 3
        return pa.table({n: pa.array([row[n]], k) for n, k in zip(names, kinds)})

    return split


def fit(rows: DataFrame, models: list[tuple[str, int, float]], n_features: int, rounds: int, depth: int, bins: int = BINS, wildtype: str = "WT") -> Trees:
    """Trees of a block of models (variant, fold left out, weight of a wild-type cell) on ``label, fold, bins`` and ``n``, how many cells have them."""
    trees = Trees(len(models), rounds, depth)
    for r in range(rounds):
        for level in range(depth):
            sums = rows.mapInArrow(_sums(trees, models, n_features, bins, level, r, wildtype), SUMS)
            sums = sums.groupBy("model", "node", "feature", "bin").agg(F.sum("g").alias("g"), F.sum("h").alias("h"))
            for s in sums.groupBy("model", "node").applyInArrow(_splitter(n_features, bins), SPLIT).collect():  # a row a model of the block and node
                at = s.model, r, s.node
                trees.feature[at], trees.cut[at], trees.missing_left[at] = s.feature, s.cut, s.missing_left
                trees.value[s.model, r, [2 * s.node + 1, 2 * s.node + 2]] = (s.left, s.right) if s.feature >= 0 else s.whole
        trees.rounds = r + 1
    return trees


def boosted(cells: DataFrame, features: Sequence[str], k: int, rounds: int = 20, depth: int = 3, bins: int = BINS, wildtype: str = "WT", least: int | None = None) -> DataFrame:
    """One out-of-fold probability of being wild type for each cell of a variant and, against each variant, each wild-type cell.

    ``cells`` carry ``fold``, 0 to ``k`` - 1; the result is as that of ``score.cross_validated``.
    """
    kept = min_cells_per_variant(cells, least, wildtype).where(F.col(LABEL).isNotNull() & F.col("fold").isNotNull())
    names = cells.columns
    rows = written(kept.select(*names, binned(features, quantile_cuts(kept, features, bins)).alias("__bins")), "binned")
    narrow = rows.groupBy(F.col(LABEL).alias("label"), F.col("fold").cast("int").alias("fold"), F.col("__bins").alias("bins")).agg(F.count("*").alias("n"))
    out = None
    for some, trees in _fitted(written(narrow, "counted-bins"), len(features), k, rounds, depth, bins, wildtype):
        scored = rows.mapInArrow(_scorer(trees, some, len(features), names, wildtype), T.StructType([*kept.schema, *SCORED]))
        out = scored if out is None else out.union(scored)
    return out if out is not None else cells.sparkSession.createDataFrame([], T.StructType([*kept.schema, *SCORED]))


def _fitted(narrow: DataFrame, n_features: int, k: int, rounds: int, depth: int, bins: int, wildtype: str) -> Iterator[tuple[list[tuple[str, int, float]], Trees]]:
    """Blocks of models and their trees, on the written rows ``label, fold, bins, n``."""
    found = narrow.groupBy("label", "fold").agg(F.sum("n").alias("n"), F.count("*").alias("rows")).collect()  # a row a variant and fold
    counts = {(r.label, r.fold): r.n for r in found}
    size = lambda label, fold: sum(counts.get((label, f), 0) for f in range(k) if f != fold)
    variants = sorted({label for label, _ in counts} - {wildtype})
    models = [(v, f, size(v, f) / size(wildtype, f)) for v in variants for f in range(k) if size(v, f) and size(wildtype, f)]
    step = max(1, BLOCK_BYTES // (16 * 2 ** (depth - 1) * n_features * (bins + 1)))
    if models and (total := sum(r.rows for r in found)) < FEW_ROWS:
        narrow = written(spread(narrow, total), "spread")
    for i in range(0, len(models), step):
        some = models[i : i + step]
        yield some, fit(narrow, some, n_features, rounds, depth, bins, wildtype)


def _block_scorer(trees: Trees, models: list[tuple[str, int, float]], n_features: int, wildtype: str) -> Scorer:
    """What scores rows ``label, fold, barcode, bins, n`` by the models that left their fold out."""

    def scored(block: pa.Table) -> Iterator[Scored]:
        (label, labels), (fold, folds), (barcode, barcodes) = (coded(block, c) for c in ("label", "fold", "barcode"))
        counts, packed = block.column("n").to_numpy(), _unpacked(block.column("bins"), n_features)
        by_fold: dict[int, list[int]] = {}
        for m, (_, f, _) in enumerate(models):
            by_fold.setdefault(f, []).append(m)
        for own in groups(label, fold):
            name, f = labels[label[own[0]]], folds[fold[own[0]]]
            for m in by_fold.get(f, ()):
                if name != wildtype and name != models[m][0]:
                    continue
                score = 1 / (1 + np.exp(-trees.margin(m, packed[own])))
                for part in groups(barcode[own]):
                    yield models[m][0], f, name == wildtype, barcodes[barcode[own[part[0]]]], score[part], counts[own[part]]

    return scored


def boosted_metrics(cells: DataFrame, features: Sequence[str], k: int, rounds: int = 20, depth: int = 3, bins: int = BINS, wildtype: str = "WT", least: int | None = None) -> DataFrame:
    """The ``score.metrics`` of ``boosted`` without a row a cell and score: cells of one label, fold, barcode and bins are scored once.

    The cells are read twice (quantiles, bins), so an expensive plan is better written first.
    """
    kept = min_cells_per_variant(cells, least, wildtype).where(F.col(LABEL).isNotNull() & F.col("fold").isNotNull())
    barcode = F.when(F.col(LABEL) != wildtype, F.col(BARCODE))
    rows = kept.select(F.col(LABEL).alias("label"), F.col("fold").cast("int").alias("fold"), barcode.alias("barcode"), binned(features, quantile_cuts(kept, features, bins)).alias("bins"))
    rows = written(rows.groupBy("label", "fold", "barcode", "bins").agg(F.count("*").alias("n")), "counted-bins")
    sizes = {r.label: r["count"] for r in rows.groupBy("label").count().collect()}  # a row a variant
    total = sum(sizes.values())
    most, out, bounds = sizes.pop(wildtype, 0) + max([0, *sizes.values()]), None, {}
    for some, trees in _fitted(rows, len(features), k, rounds, depth, bins, wildtype):
        part = packs(rows, _block_scorer(trees, some, len(features), wildtype), {v for v, _, _ in some}, bounds, most, total)
        out = part if out is None else out.union(part)
    return areas(out if out is not None else cells.sparkSession.createDataFrame([], PACKS), LABEL)


SCORED = T.StructType([T.StructField("scored_against", T.StringType()), T.StructField("is_wildtype", T.BooleanType()), T.StructField("score", T.DoubleType())])


def _scorer(trees: Trees, models: list[tuple[str, int, float]], n_features: int, names: list[str], wildtype: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """What scores cells by the models that left their fold out."""

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels, folds = np.array(batch.column(LABEL).to_pylist(), object), batch.column("fold").to_numpy(zero_copy_only=False)
            packed = np.frombuffer(b"".join(batch.column("__bins").to_pylist()), np.uint8).reshape(-1, n_features).astype(np.int64)
            for m, (variant, fold, _) in enumerate(models):
                own = np.flatnonzero((folds == fold) & ((labels == variant) | (labels == wildtype)))
                if len(own):
                    score = 1 / (1 + np.exp(-trees.margin(m, packed[own])))
                    columns = [*batch.select(names).take(pa.array(own)).columns, pa.array([variant] * len(own)), pa.array([x == wildtype for x in labels[own]]), pa.array(score)]
                    yield pa.RecordBatch.from_arrays(columns, [*names, "scored_against", "is_wildtype", "score"])

    return scored
