"""Areas by which the wild type scores above each variant, from packed scores.

Tasks turn scores into distinct values in order with their counts, by variant,
fold, class and (of a variant's cells) barcode, cut into ranges where a variant
has many; those of one variant and range meet in one task, which counts how much
of the wild type scores above each of the variant's cells.  Counts of the ranges
tell what lies beyond.  Ranges only deal scores out: results don't depend on them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from assayframe.operators.orders import starts
from assayframe.sources.tables import written

#: Scores against a variant that a range is made for, about, and sampled rows a range by which its bounds are found.
RANGE_VALUES, SAMPLED = 2_000_000, 400
#: Rows that are scored together, fewest rows that aren't dealt out again, bytes of scores that a task holds and that are sent on together.
BLOCK_ROWS, FEW_ROWS, HELD_BYTES, PIECE_BYTES = 200_000, 4_000_000, 32 << 20, 8 << 20
PACKS = "scored_against string, range int, fold int, barcode string, wild boolean, scores binary, counts binary"
COUNTED = "scored_against string, range int, fold int, barcode string, wild boolean, n long, twice long, twice_fold long"

#: Scores of a block of rows: variant, fold, whether of wild type, barcode, scores and counts (None: 1 each).
Scored = tuple[str, int, bool, str | None, np.ndarray, np.ndarray | None]
Scorer = Callable[[pa.Table], Iterator[Scored]]


def coded(block: pa.Table, name: str) -> tuple[np.ndarray, list]:
    """A column's codes and their values; the last value, of code -1, is null."""
    column = block.column(name).combine_chunks().dictionary_encode()
    return column.indices.fill_null(-1).to_numpy(zero_copy_only=False), [*column.dictionary.to_pylist(), None]


def groups(*keys: np.ndarray) -> list[np.ndarray]:
    """Rows of equal keys, in their order."""
    order = np.lexsort(keys[::-1])
    return np.split(order, starts(*(k[order] for k in keys))[1:]) if len(order) else []


def blocks(batches: Iterator[pa.RecordBatch], most: int = BLOCK_ROWS) -> Iterator[pa.Table]:
    """Batches put together until they hold ``most`` rows."""
    held, rows = [], 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows >= most:
            yield pa.Table.from_batches(held)
            held, rows = [], 0
    if rows:
        yield pa.Table.from_batches(held)


def distinct(values: np.ndarray, counts: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    if counts is None:
        return np.unique(values, return_counts=True)
    order = np.argsort(values, kind="stable")
    values = values[order]
    at = starts(values)
    return values[at], np.add.reduceat(counts[order], at) if len(at) else counts


def _packer(scorer: Scorer, bounds: dict[str, np.ndarray]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """What packs the scores of a task's rows, a row a variant, range, fold, class and barcode."""
    whole, schema = np.zeros(0), pa.schema([("scored_against", pa.string()), ("range", pa.int32()), ("fold", pa.int32()), ("barcode", pa.string()), ("wild", pa.bool_()), ("scores", pa.binary()), ("counts", pa.binary())])

    def packs(held: dict[tuple, list]) -> Iterator[pa.RecordBatch]:
        out, size = [], 0
        for (variant, fold, wild, barcode), parts in held.items():
            counts = None if all(k is None for _, k in parts) else np.concatenate([np.ones(len(v), np.int64) if k is None else k for v, k in parts])
            values, counts = distinct(np.concatenate([v for v, _ in parts]), counts)
            edges = [0, *np.searchsorted(values, bounds.get(variant, whole), "left"), len(values)]
            for i, (a, b) in enumerate(zip(edges, edges[1:])):
                if a < b:
                    many = counts[a:b].max() > 1
                    out.append((variant, i, fold, barcode, wild, values[a:b].tobytes(), counts[a:b].astype(np.int64).tobytes() if many else b""))
                    size += (b - a) * (16 if many else 8) + 100
            if size >= PIECE_BYTES:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), schema.types)], schema=schema)
                out, size = [], 0
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), schema.types)], schema=schema)

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, list] = {}
        size = 0
        for block in blocks(batches):
            for variant, fold, wild, barcode, scores, counts in scorer(block):
                held.setdefault((variant, fold, wild, barcode), []).append((scores, counts))
                size += 16 * len(scores) + 100
                if size >= HELD_BYTES:
                    yield from packs(held)
                    held, size = {}, 0
        yield from packs(held)

    return packed


def _sampler(scorer: Scorer) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            for variant, _, _, _, scores, _ in scorer(block):
                yield pa.RecordBatch.from_arrays([pa.array([variant] * len(scores), pa.string()), pa.array(scores)], ["scored_against", "score"])

    return sampled


def range_bounds(scored: DataFrame, ranges: int) -> dict[str, np.ndarray]:
    """Bounds between the ranges of each variant's scores, by approximate quantiles of ``scored_against, score``."""
    probs = F.array(*(F.lit(i / ranges) for i in range(1, ranges)))
    found = scored.groupBy("scored_against").agg(F.approx_percentile("score", probs, F.lit(max(1000, 4 * ranges))).alias("q")).collect()  # a row a variant of a block
    return {r.scored_against: np.unique(np.array(r.q, float)) for r in found if r.q}


def spread(rows: DataFrame, total: int) -> DataFrame:
    """``rows``, dealt out if there are so few that one task may hold them, though each is scored against many variants."""
    return rows.repartition(rows.sparkSession.sparkContext.defaultParallelism) if total < FEW_ROWS else rows


def packs(rows: DataFrame, scorer: Scorer, variants: Iterable[str], bounds: dict[str, np.ndarray], most: int, total: int) -> DataFrame:
    """Packed scores of ``total`` rows, of which ``most`` are scored against one variant.

    ``bounds`` keeps those of variants met before, so that all scores against a
    variant have the same ranges though they come from several blocks of models.
    """
    rows, ranges = spread(rows, total), -(-most // RANGE_VALUES)
    if ranges > 1 and (new := set(variants) - set(bounds)):
        share = min(1.0, SAMPLED * ranges / most)
        found = range_bounds(rows.sample(share, seed=1).mapInArrow(_sampler(scorer), "scored_against string, score double"), ranges)
        bounds |= {v: found.get(v, np.zeros(0)) for v in new}
    return rows.mapInArrow(_packer(scorer, dict(bounds)), PACKS)


def _scored_rows(block: pa.Table) -> Iterator[Scored]:
    (variant, variants), (fold, folds), (barcode, barcodes) = (coded(block, c) for c in ("scored_against", "fold", "barcode"))
    wild, scores = block.column("wild").to_numpy(), block.column("score").to_numpy()
    for own in groups(variant, fold, wild, barcode):
        i = own[0]
        yield variants[variant[i]], folds[fold[i]], bool(wild[i]), barcodes[barcode[i]], scores[own], None


def packs_of_scores(scores: DataFrame, barcode: str) -> DataFrame:
    """Packed scores of a row each: ``scored_against, fold, is_wildtype``, barcode and ``score``, of which only finite ones count.

    The rows are read twice, so an expensive plan is better written first.
    """
    rows = scores.where("is_wildtype is not null and score is not null and not isnan(score) and abs(score) < double('inf')")
    rows = rows.select("scored_against", F.col("fold").cast("int").alias("fold"), F.when(~F.col("is_wildtype"), F.col(barcode)).alias("barcode"), F.col("is_wildtype").alias("wild"), F.col("score").cast("double").alias("score"))
    probs = [i / 256 for i in range(257)]
    found = rows.groupBy("scored_against").agg(F.count("*").alias("n"), F.approx_percentile("score", F.array(*map(F.lit, probs)), F.lit(1024)).alias("q")).collect()  # a row a variant
    bounds = {}
    for r in found:
        ranges = min(256, -(-r.n // RANGE_VALUES))
        bounds[r.scored_against] = np.unique([r.q[round(i * 256 / ranges)] for i in range(1, ranges)])
    return rows.mapInArrow(_packer(_scored_rows, {k: b for k, b in bounds.items() if len(b)}), PACKS)


def _unpacked(scores: list[bytes], counts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Values and counts of packs, and how many values each has."""
    values = [np.frombuffer(b, np.float64) for b in scores]
    many = [np.frombuffer(k, np.int64) if k else np.ones(len(v), np.int64) for v, k in zip(values, counts)]
    return (np.concatenate(values), np.concatenate(many), np.array([len(v) for v in values])) if values else (np.zeros(0), np.zeros(0, np.int64), np.zeros(0, np.int64))


def _twice_above(wild: np.ndarray, counts: np.ndarray, scores: np.ndarray) -> np.ndarray:
    """Twice how much of the wild type scores above each score, and once how much scores the same."""
    order = np.argsort(wild, kind="stable")
    wild, upto = wild[order], np.concatenate([[0], np.cumsum(counts[order])])
    return 2 * upto[-1] - upto[np.searchsorted(wild, scores, "right")] - upto[np.searchsorted(wild, scores, "left")]


def _count(met: pa.Table) -> pa.Table:
    """Of one variant and range: cells by fold and barcode, and what of the wild type in the range scores above them, in all and in their own fold."""
    variant, part = met.column("scored_against")[0].as_py(), met.column("range")[0].as_py()
    is_wild = met.column("wild").to_numpy()
    (fold, folds), (barcode, barcodes) = coded(met, "fold"), coded(met, "barcode")
    scores, counts = met.column("scores").to_pylist(), met.column("counts").to_pylist()
    sides = []
    for side in (np.flatnonzero(is_wild), np.flatnonzero(~is_wild)):
        values, many, sizes = _unpacked([scores[i] for i in side], [counts[i] for i in side])
        sides.append((values, many, np.repeat(fold[side], sizes), np.repeat(barcode[side], sizes)))
    (w, wk, wf, _), (v, vk, vf, vb) = sides
    above, above_fold = _twice_above(w, wk, v), np.zeros(len(v), np.int64)
    out = []
    for own in groups(wf):
        out.append((folds[wf[own[0]]], None, True, int(wk[own].sum()), 0, 0))
        of = np.flatnonzero(vf == wf[own[0]])
        above_fold[of] = _twice_above(w[own], wk[own], v[of])
    for own in groups(vf, vb):
        k = vk[own]
        out.append((folds[vf[own[0]]], barcodes[vb[own[0]]], False, int(k.sum()), int((k * above[own]).sum()), int((k * above_fold[own]).sum())))
    kinds = [pa.int32(), pa.string(), pa.bool_(), pa.int64(), pa.int64(), pa.int64()]
    columns = [pa.array([variant] * len(out), pa.string()), pa.array([part] * len(out), pa.int32()), *(pa.array(c, t) for c, t in zip(zip(*out), kinds))]
    return pa.Table.from_arrays(columns, [c.split()[0] for c in COUNTED.split(", ")])


def areas(packed: DataFrame, label: str) -> DataFrame:
    """Per variant: pooled area, its median over barcodes (each against all wild type) and over folds, counts."""
    counted = written(packed.groupBy("scored_against", "range").applyInArrow(_count, COUNTED), "counted")  # a row a variant, range, fold and barcode
    wild, variant, fold = F.when(F.col("wild"), F.col("n")).otherwise(0), ["scored_against"], ["scored_against", "fold"]
    beyond = lambda by: F.coalesce(F.sum(wild).over(Window.partitionBy(*by).orderBy(-F.col("range")).rangeBetween(Window.unboundedPreceding, -1)), F.lit(0))
    whole = lambda by: F.sum(wild).over(Window.partitionBy(*by))
    rows = counted.withColumns({"above": beyond(variant), "w": whole(variant), "above_fold": beyond(fold), "w_fold": whole(fold)})
    own, twice = F.when(~F.col("wild"), F.col("n")), F.col("twice") + 2 * F.col("n") * F.col("above")
    area = lambda u, w, n: F.when(w * n > 0, u / 2 / (w * n)).otherwise(float("nan"))
    n = F.coalesce(F.sum(own), F.lit(0))
    pooled = rows.groupBy(*variant).agg(area(F.sum(F.when(~F.col("wild"), twice)), F.max("w"), n).alias("auroc_pooled"), n.alias("meta_n_cells"))
    cells = rows.where("not wild")
    by_barcode = cells.where("w > 0").groupBy(*variant, "barcode").agg(area(F.sum(twice), F.max("w"), F.sum("n")).alias("auc"))
    by_barcode = by_barcode.groupBy(*variant).agg(F.median("auc").alias("auroc_median_barcode"), F.count("*").alias("meta_n_barcodes"))
    by_fold = cells.where("w_fold > 0").groupBy(*fold).agg(area(F.sum(F.col("twice_fold") + 2 * F.col("n") * F.col("above_fold")), F.max("w_fold"), F.sum("n")).alias("auc"))
    by_fold = by_fold.groupBy(*variant).agg(F.transform(F.array_sort(F.collect_list(F.struct("fold", "auc"))), lambda s: s["auc"]).alias("auroc_folds"), F.median("auc").alias("auroc_median_fold"))
    return pooled.join(by_barcode, "scored_against", "left").join(by_fold, "scored_against", "left").withColumnRenamed("scored_against", label)
