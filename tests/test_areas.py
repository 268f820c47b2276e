"""Areas from packed scores against counts of all pairs of scores."""

import numpy as np
import pytest

from assayframe.operators import areas, score
from assayframe.plans import QUERIES


def made(spark, n=1500):
    rng = np.random.default_rng(11)
    rows = []
    for _ in range(n):
        label = ["WT", "WT", "A1V", "G2D", "K3R", None][rng.choice(6, p=[0.3, 0.2, 0.25, 0.15, 0.05, 0.05])]
        x = float(np.round(rng.normal() + (label == "A1V"), 1))  # ties
        y = [None, float("nan"), float("inf")][rng.integers(3)] if rng.random() < 0.1 else float(rng.normal())
        fold = 0 if label == "K3R" else None if rng.random() < 0.02 else int(rng.integers(3))
        rows.append((label, None if rng.random() < 0.1 else f"b{rng.integers(4)}", fold, x, y))
    return spark.createDataFrame(rows, "meta_aa_changes string, meta_barcode string, fold int, x double, y double").repartition(5)


def brute(scores):
    """Rows by variant from all pairs."""
    out = {}
    above = lambda v, w: [((w > s).sum() + (w == s).sum() / 2) / len(w) for s in v]
    for variant in {r.scored_against for r in scores}:
        of = [r for r in scores if r.scored_against == variant]
        wild, cells = np.array([r.score for r in of if r.is_wildtype]), [r for r in of if not r.is_wildtype]
        each = above(np.array([r.score for r in cells]), wild)
        names = {r.meta_barcode for r in cells}
        by_barcode = [np.mean([a for a, r in zip(each, cells) if r.meta_barcode == b]) for b in names]
        by_fold = []
        for f in sorted({r.fold for r in cells}):
            own = np.array([r.score for r in of if r.is_wildtype and r.fold == f])
            by_fold.append(np.mean(above(np.array([r.score for r in cells if r.fold == f]), own)))
        out[variant] = (np.mean(each), len(cells), np.median(by_barcode), len(names), by_fold, np.median(by_fold))
    return out


@pytest.mark.parametrize("range_values", [areas.RANGE_VALUES, 40])
def test_areas_are_those_of_all_pairs(spark, monkeypatch, range_values):
    monkeypatch.setattr(areas, "RANGE_VALUES", range_values)  # 40: many ranges
    cells = made(spark)
    scores = score.cross_validated(cells, ["x", "y"], 3).cache()
    want = brute(scores.collect())
    for found in (score.cross_validated_metrics(cells, ["x", "y"], 3), score.metrics(scores)):
        got = {r.meta_aa_changes: r for r in found.collect()}
        assert set(got) == set(want) == {"A1V", "G2D", "K3R"}
        for variant, (pooled, n, barcode, n_barcodes, folds, fold) in want.items():
            r = got[variant]
            assert (r.meta_n_cells, r.meta_n_barcodes, len(r.auroc_folds)) == (n, n_barcodes, len(folds))
            assert np.allclose([r.auroc_pooled, r.auroc_median_barcode, r.auroc_median_fold, *r.auroc_folds], [pooled, barcode, fold, *folds], rtol=0, atol=1e-9)
    scores.unpersist()


def test_one_class_alone_and_none(spark):
    cells = made(spark, 300)
    alone = cells.where("meta_aa_changes != 'WT'")
    for some in (cells.limit(0), alone, cells.where("meta_aa_changes = 'WT'")):
        assert score.cross_validated_metrics(some, ["x", "y"], 3).count() == 0
    held = score.cross_validated(cells, ["x", "y"], 3).cache()
    (r,) = score.metrics(held.where("not is_wildtype and scored_against = 'G2D'")).collect()
    assert np.isnan(r.auroc_pooled) and r.meta_n_cells > 0 and r.auroc_folds is None and r.meta_n_barcodes is None
    (r,) = score.metrics(held.where("is_wildtype and scored_against = 'G2D'")).collect()
    assert np.isnan(r.auroc_pooled) and r.meta_n_cells == 0


@pytest.mark.parametrize("name", ["fold_metrics", "run_results"])
def test_no_row_of_a_score_is_shuffled(spark, sf_dir, name):
    """A score of each wild-type cell against each variant is packed where the cell lies."""
    plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert " score#" not in plan
