"""Scores of each variant's cells against the wild type by cross-validation.

The default learner is naive Bayes with Gaussian features, from sufficient
statistics: counts, sums and squares per (variant, fold) and of the wild type
per fold, in one aggregation.  A fold's training statistics are the totals
without the fold, so all folds cost one pass and one join.  ``grouped`` runs a
learner of one's own once for each (variant, fold) group.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assayframe.functions.columns import finite
from assayframe.operators.areas import Scored, Scorer, areas, coded, groups, packs, packs_of_scores
from assayframe.operators.qc import LABEL, min_cells_per_variant, seeded_ranks
from assayframe.sources.tables import written

BARCODE = "meta_barcode"
#: Models that the wild type meets at a time.
BLOCK_BYTES = 64 << 20
SCORES = f"{LABEL} string, scored_against string, is_wildtype boolean, fold int, score double"


def barcode_groups(cells: DataFrame, k: int | None = None, wildtype: str = "WT") -> DataFrame:
    """``label, barcode, fold_of``: the barcodes of each variant in groups of about equal numbers of cells.

    The largest barcode first, ties by name, each goes to the group of fewest
    cells so far.  Without ``k``, or with as few barcodes, each is a group of its
    own, by name.  Only counts are gathered, a row a barcode.
    """
    if k is not None and k < 2:
        raise ValueError("barcodes are held out in two folds at least")
    sizes = cells.where(F.col(LABEL) != wildtype).groupBy(LABEL, BARCODE).agg((-F.count("*")).alias("n")).where(F.col(BARCODE).isNotNull())
    lists = sizes.groupBy(LABEL).agg(F.sort_array(F.collect_list(F.struct("n", F.col(BARCODE).alias("barcode")))).alias("all"))
    each_own = F.lit(True) if k is None else F.size("all") <= k
    alone = F.transform(F.array_sort(F.transform("all", lambda s: s["barcode"])), lambda name, i: F.struct(name.alias("barcode"), i.alias("fold")))
    start = F.struct(F.array_repeat(F.lit(0).cast("bigint"), k or 1).alias("load"), F.array().cast("array<struct<barcode:string,fold:int>>").alias("done"))

    def put(state: Column, barcode: Column) -> Column:
        to = (F.array_position(state["load"], F.array_min(state["load"])) - 1).cast("int")
        load = F.transform(state["load"], lambda n, i: F.when(i == to, n - barcode["n"]).otherwise(n))
        return F.struct(load.alias("load"), F.concat(state["done"], F.array(F.struct(barcode["barcode"].alias("barcode"), to.alias("fold")))).alias("done"))

    packed = F.aggregate("all", start, put, lambda state: state["done"])
    dealt = lists.select(F.col(LABEL).alias("label"), F.size("all").alias("n"), F.explode(F.when(each_own, alone).otherwise(packed)).alias("g"))
    checked = F.when(F.col("n") < 2, F.raise_error(F.concat(F.lit("barcode holdout needs two barcodes at least: "), "label")).cast("int")).otherwise(F.col("g.fold"))
    return dealt.select("label", F.col("g.barcode").alias("barcode"), checked.alias("fold_of"))


def folds(cells: DataFrame, k: int | None, keys: list[str], seed: int = 0, by_barcode: bool = False, wildtype: str = "WT") -> DataFrame:
    """``fold`` of each cell, dealt evenly within labels; by barcode: all cells of a barcode in its group's fold, the wild type dealt evenly by cells.

    By barcode without ``k`` there is a fold for each barcode of the variant that
    has most; the wild type has a cell for each fold at least.
    """
    if not by_barcode:
        return seeded_ranks(cells, [LABEL], keys, seed).withColumn("fold", ((F.col("__rank") - 1) % k).cast("int")).drop("__rank", "__n")
    groups = barcode_groups(cells, k, wildtype)
    ends = groups.agg(F.max("fold_of")).first()[0]
    blocks = 0 if ends is None else ends + 1
    wild = cells.where(F.col(LABEL) == wildtype)
    if wild.limit(blocks).count() < blocks and wild.limit(1).count():
        raise ValueError(f"fewer wild-type cells than {blocks} folds")
    own = seeded_ranks(wild, [LABEL], keys, seed).withColumn("fold", ((F.col("__rank") - 1) % max(1, blocks)).cast("int")).drop("__rank", "__n")
    rest = cells.where(F.col(LABEL) != wildtype).join(groups, (F.col(LABEL) == F.col("label")) & (F.col(BARCODE) == F.col("barcode")))
    return rest.withColumn("fold", F.col("fold_of")).drop("label", "barcode", "fold_of").unionByName(own)


def _statistics(rows: DataFrame, by: list[str], features: list[str]) -> DataFrame:
    made = []
    for i, f in enumerate(features):
        v = finite(f)
        made += [F.count(v).alias(f"n{i}"), F.coalesce(F.sum(v), F.lit(0.0)).alias(f"s{i}"), F.coalesce(F.sum(v * v), F.lit(0.0)).alias(f"q{i}")]
    return rows.groupBy(*by).agg(*made)


def _without_fold(stats: DataFrame, by: list[str], k: int, features: list[str]) -> DataFrame:
    """Totals of all folds but each one, per group."""
    names = [f"{c}{i}" for i in range(len(features)) for c in "nsq"]
    totals = stats.groupBy(*by).agg(*(F.sum(c).alias(f"t_{c}") for c in names))
    grid = totals.withColumn("fold", F.explode(F.sequence(F.lit(0), F.lit(k - 1))))
    own = stats.select(*(F.col(b).alias(f"__{b}") for b in by), F.col("fold").alias("__fold"), *names)
    on = [F.col(b).eqNullSafe(F.col(f"__{b}")) for b in by] + [F.col("fold") == F.col("__fold")]
    joined = grid.join(own, on, "left")
    return joined.select(*by, "fold", *((F.col(f"t_{c}") - F.coalesce(c, F.lit(0))).alias(c) for c in names))


def _log_density(value: Column, n: Column, s: Column, q: Column) -> Column:
    mean = s / n
    variance = F.greatest(q / n - mean * mean, F.lit(1e-9))
    return -F.log(variance) / 2 - F.pow(value - mean, 2) / (2 * variance)


def _models(rows: DataFrame, features: list[str], k: int, wildtype: str) -> tuple[DataFrame, DataFrame]:
    """Written statistics of each label and fold, and the models: those of a variant without each fold (``scored_against, model_fold``) beside the wild type's (``w_``)."""
    stats = written(_statistics(rows, [LABEL, "fold"], features), "statistics")
    model = _without_fold(stats.where(F.col(LABEL) != wildtype), [LABEL], k, features)
    base = _without_fold(stats.where(F.col(LABEL) == wildtype).withColumn("all", F.lit(1)), ["all"], k, features).drop("all")
    base = base.select(F.col("fold").alias("wt_fold"), *(F.col(c).alias(f"w_{c}") for c in base.columns if c != "fold"))
    both = model.join(F.broadcast(base), F.col("fold") == F.col("wt_fold")).drop("wt_fold").withColumnsRenamed({LABEL: "scored_against", "fold": "model_fold"})
    return stats, written(both, "models")


def _model_blocks(both: DataFrame) -> list[DataFrame]:
    """Models in blocks of BLOCK_BYTES, those of a variant together."""
    blocks = max(1, -(-both.count() * len(both.columns) * 8 // BLOCK_BYTES))  # a row a variant and fold, a column three numbers a feature
    return [both.where(F.pmod(F.xxhash64("scored_against"), F.lit(blocks)) == i) if blocks > 1 else both for i in range(blocks)]


def cross_validated(cells: DataFrame, features: list[str], k: int, wildtype: str = "WT", least: int | None = None) -> DataFrame:
    """One out-of-fold probability of being wild type for each cell of a variant and, against each variant, each wild-type cell.

    ``cells`` carry ``fold``.  Classes weigh the same.  A missing value counts for
    nothing; variants with fewer than two training values of a feature ignore it.
    """
    rows = min_cells_per_variant(cells, least, wildtype).where(F.col(LABEL).isNotNull())
    variants, wild = rows.where(F.col(LABEL) != wildtype), rows.where(F.col(LABEL) == wildtype)
    _, both = _models(rows, features, k, wildtype)
    own = variants.join(both, (F.col(LABEL) == F.col("scored_against")) & (F.col("fold") == F.col("model_fold")))
    against = None
    for some in _model_blocks(both):
        part = wild.join(F.broadcast(some), F.col("fold") == F.col("model_fold"))
        against = part if against is None else against.unionByName(part)
    scored = own.unionByName(against)
    ratio = F.lit(0.0)
    for i, f in enumerate(features):
        usable = finite(f).isNotNull() & (F.col(f"n{i}") >= 2) & (F.col(f"w_n{i}") >= 2)
        part = _log_density(finite(f), *(F.col(f"w_{c}{i}") for c in "nsq")) - _log_density(finite(f), *(F.col(f"{c}{i}") for c in "nsq"))
        ratio = ratio + F.when(usable, part).otherwise(0.0)
    return scored.select(*cells.columns, "scored_against", (F.col(LABEL) == wildtype).alias("is_wildtype"), (1 / (1 + F.exp(-F.greatest(F.lit(-700.0), F.least(F.lit(700.0), ratio))))).alias("score"))


def _bayes(models: dict[tuple[str, int], np.ndarray], n_features: int, wildtype: str) -> Scorer:
    """What scores blocks of ``label, fold, barcode, x0, x1, ...`` by models: of each feature half the variance's logarithm, mean and twice the variance of the wild type, then of the variant."""
    by_fold: dict[int, list[tuple[str, np.ndarray]]] = {}
    for (variant, fold), model in models.items():
        by_fold.setdefault(fold, []).append((variant, model))

    def probability(model: np.ndarray, x: list[np.ndarray]) -> np.ndarray:
        ratio = np.zeros(len(x[0]))
        for v, (w_log, w_mean, w_twice, log, mean, twice) in zip(x, model):
            if not np.isnan(w_log):
                part = (w_log - (v - w_mean) * (v - w_mean) / w_twice) - (log - (v - mean) * (v - mean) / twice)
                ratio += np.where(np.isnan(v), 0.0, part)
        return 1 / (1 + np.exp(-np.clip(ratio, -700.0, 700.0)))

    def scored(block: pa.Table) -> Iterator[Scored]:
        (label, labels), (fold, folds), (barcode, barcodes) = (coded(block, c) for c in ("label", "fold", "barcode"))
        x = [block.column(f"x{i}").to_numpy() for i in range(n_features)]
        for own in groups(label, fold):
            name, f, values = labels[label[own[0]]], folds[fold[own[0]]], [v[own] for v in x]
            if name == wildtype:
                for variant, model in by_fold.get(f, ()):
                    yield variant, f, True, None, probability(model, values), None
            elif (name, f) in models:
                score = probability(models[name, f], values)
                for part in groups(barcode[own]):
                    yield name, f, False, barcodes[barcode[own[part[0]]]], score[part], None

    return scored


def cross_validated_metrics(cells: DataFrame, features: list[str], k: int, wildtype: str = "WT", least: int | None = None) -> DataFrame:
    """The ``metrics`` of ``cross_validated`` without a row a cell and score: tasks score and pack what they read.

    The cells are read three times (statistics, ranges if more than one, scores),
    so an expensive plan is better written first.
    """
    kept = min_cells_per_variant(cells, least, wildtype).where(F.col(LABEL).isNotNull())  # cells without a fold are in all training parts
    rows = kept.where("fold is not null").select(F.col(LABEL).alias("label"), F.col("fold").cast("int").alias("fold"), F.when(F.col(LABEL) != wildtype, F.col(BARCODE)).alias("barcode"), *(finite(f).alias(f"x{i}") for i, f in enumerate(features)))
    counted = kept.select(LABEL, "fold", *features).withColumn("rows", F.lit(1.0))
    stats, both = _models(counted, [*features, "rows"], k, wildtype)
    n = f"n{len(features)}"
    sizes = stats.groupBy((F.col(LABEL) == wildtype).alias("wild"), LABEL).agg(F.sum(n).alias("n")).groupBy("wild").agg(F.max("n").alias("most"), F.sum("n").alias("n")).collect()  # two rows
    sizes = {r.wild: r for r in sizes}
    most, total = (sizes[False].most if False in sizes else 0) + (sizes[True].n if True in sizes else 0), sum(r.n for r in sizes.values())
    numbers = []
    for i in range(len(features)):
        for prefix in ("w_", ""):
            count, mean = F.col(f"{prefix}n{i}"), F.try_divide(f"{prefix}s{i}", f"{prefix}n{i}")
            variance = F.greatest(F.try_divide(f"{prefix}q{i}", f"{prefix}n{i}") - mean * mean, F.lit(1e-9))
            usable = (F.col(f"n{i}") >= 2) & (F.col(f"w_n{i}") >= 2)
            numbers += [F.when(usable & (count > 0), c) for c in (-F.log(variance) / 2, mean, 2 * variance)]
    out, bounds = None, {}
    for some in _model_blocks(both):
        found = some.select("scored_against", "model_fold", F.array(*numbers).alias("m")).collect()  # a block of models
        models = {(r.scored_against, r.model_fold): np.array(r.m, float).reshape(-1, 6) for r in found}
        part = packs(rows, _bayes(models, len(features), wildtype), {v for v, _ in models}, bounds, most, total)
        out = part if out is None else out.union(part)
    return areas(out, LABEL)


def grouped(cells: DataFrame, features: list[str], k: int, learn: Callable[[pd.DataFrame, pd.Series, pd.DataFrame], pd.Series], wildtype: str = "WT", schema: str = SCORES) -> DataFrame:
    """``learn(train, is_wildtype, test)`` once for each (variant, fold); a group is a variant's cells and the wild type's, which must fit a task."""
    labels = cells.where(F.col(LABEL) != wildtype).select(F.col(LABEL).alias("scored_against")).distinct()
    wild = cells.where(F.col(LABEL) == wildtype).join(F.broadcast(labels))
    rows = cells.where(F.col(LABEL) != wildtype).withColumn("scored_against", F.col(LABEL)).unionByName(wild)
    rows = rows.withColumn("test_fold", F.explode(F.sequence(F.lit(0), F.lit(k - 1))))

    def one(group: pd.DataFrame) -> pd.DataFrame:
        test = group["fold"] == group["test_fold"]
        is_wild = group[LABEL] == wildtype
        out = group.loc[test, [LABEL, "scored_against", "fold"]].copy()
        if is_wild[~test].nunique() < 2:
            return out.assign(is_wildtype=is_wild[test], score=float("nan")).iloc[:0]
        out["is_wildtype"], out["score"] = is_wild[test], learn(group.loc[~test, features], is_wild[~test], group.loc[test, features]).to_numpy()
        return out

    return rows.groupBy("scored_against", "test_fold").applyInPandas(one, schema)


def class_weights(rows: DataFrame, by: list[str], truth: str) -> DataFrame:
    """``weight`` n / (2 n_class) within each group."""
    n = F.count("*").over(Window.partitionBy(*by))
    return rows.withColumn("weight", n / (2 * F.count("*").over(Window.partitionBy(*by, truth))))


def inner_split(rows: DataFrame, strata: list[str], keys: list[str], share: float = 0.2, seed: int = 0) -> DataFrame:
    """``inner_test``: that share of each stratum, rounded down, in seeded order; a lone row is never tested."""
    ranked = seeded_ranks(rows, strata, keys, seed)
    return ranked.withColumn("inner_test", (F.col("__n") >= 2) & (F.col("__rank") <= F.floor(F.col("__n") * share))).drop("__rank", "__n")


def platt(scores: DataFrame, by: list[str], score: str = "score", truth: str = "is_wildtype", steps: int = 12) -> DataFrame:
    """``scores`` with ``calibrated``: per group a logistic curve over the score's log odds, by Newton steps.

    A step is one aggregation of gradients; the two numbers of each group are
    joined back by broadcast (a row a group) and written out each time.  Targets
    are smoothed by the groups' class sizes; a small ridge keeps separable groups finite.
    """
    low = F.least(F.greatest(F.col(score), F.lit(1e-12)), F.lit(1 - 1e-12))
    rows = scores.withColumn("__x", F.log(low / (1 - low)))
    sizes = rows.groupBy(*by).agg(F.count_if(F.col(truth)).alias("__n1"), F.count_if(~F.col(truth)).alias("__n0"), F.greatest(F.stddev_pop("__x"), F.lit(1e-6)).alias("__s"))
    state = sizes.withColumn("__a", F.lit(1.0)).withColumn("__b", F.lit(0.0))
    target = F.when(F.col(truth), (F.col("__n1") + 1) / (F.col("__n1") + 2)).otherwise(1 / (F.col("__n0") + 2))
    z = F.col("__x") / F.col("__s")
    p = 1 / (1 + F.exp(-(F.col("__a") * z + F.col("__b"))))
    for _ in range(steps):
        w = p * (1 - p)
        sums = rows.join(F.broadcast(state), by).groupBy(*by, "__n1", "__n0", "__s", "__a", "__b").agg(F.sum((target - p) * z).alias("g1"), F.sum(target - p).alias("g2"), F.sum(w * z * z).alias("h11"), F.sum(w * z).alias("h12"), F.sum(w).alias("h22"))
        ridge = 1e-3
        h11, h22 = F.col("h11") + ridge, F.col("h22") + ridge
        det = h11 * h22 - F.col("h12") * F.col("h12")
        g1, g2 = F.col("g1") - ridge * F.col("__a"), F.col("g2") - ridge * F.col("__b")
        a = F.col("__a") + (h22 * g1 - F.col("h12") * g2) / det
        b = F.col("__b") + (h11 * g2 - F.col("h12") * g1) / det
        state = sums.select(*by, "__n1", "__n0", "__s", a.alias("__a"), b.alias("__b")).transform(written)
    return rows.join(F.broadcast(state), by).select(*scores.columns, p.alias("calibrated"))


def metrics(scores: DataFrame) -> DataFrame:
    """Per variant: pooled AUROC, its median over barcodes (each against all wild type) and over folds, counts.

    The area counts how far the wild type scores above the variant; only finite
    scores count.  Learners that score where the cells lie have their own way to
    the same table, without a row a score.
    """
    return areas(packs_of_scores(scores, BARCODE), LABEL)


RESULTS = f"{LABEL} string, auroc_pooled double, auroc_median_barcode double, auroc_folds array<double>, auroc_median_fold double, meta_n_barcodes long, meta_n_cells long"


def result_tables(scores: DataFrame, found: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """The two tables of a run: ``metrics`` by variant in a fixed schema (``found``, if made already), and a row a scored cell with its metadata.

    Both have their columns even if no variant is left.  A cell's row is told
    apart by ``meta_variant_scored_against``, since the wild type is scored against each.
    """
    found = metrics(scores) if found is None else found
    fields = [f.rsplit(" ", 1) for f in RESULTS.split(", ")]
    results = found.select(*(F.col(n).cast(t).alias(n) for n, t in fields)).orderBy(LABEL)
    meta = [c for c in scores.columns if c.startswith("meta_")]
    return results, scores.select(*meta, F.col("score").cast("double").alias("score"), F.col("scored_against").alias("meta_variant_scored_against"))


def save_results(scores: DataFrame, folder: str, prefix: str = "") -> None:
    """Writes both tables as Parquet."""
    results, by_cell = result_tables(scores)
    results.write.mode("overwrite").parquet(f"{folder}/{prefix}results.parquet")
    by_cell.write.mode("overwrite").parquet(f"{folder}/{prefix}cell_scores.parquet")
