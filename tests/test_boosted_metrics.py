"""Boosting on counted bins: the areas of scores row by row, and as few rows as there are kinds of cells."""

import numpy as np
from pyspark.sql import functions as F

from assayframe.operators import areas, boost, score
from tests.test_boost import made


def test_metrics_are_those_of_the_scores(spark, monkeypatch):
    monkeypatch.setattr(boost, "BLOCK_BYTES", 16 * 4 * 3 * 33 * 4)  # two blocks of models
    monkeypatch.setattr(areas, "RANGE_VALUES", 100)
    cells, names = made(spark).withColumn("meta_barcode", F.when(F.col("meta_barcode") != "b0", F.col("meta_barcode"))).repartition(5), ["x", "y", "z"]
    want = {r.meta_aa_changes: r for r in score.metrics(boost.boosted(cells, names, 3, rounds=3, depth=3)).collect()}
    got = {r.meta_aa_changes: r for r in boost.boosted_metrics(cells, names, 3, rounds=3, depth=3).collect()}
    assert set(got) == set(want) == {"A1V", "G2D"}
    for variant, w in want.items():
        g = got[variant]
        assert (g.meta_n_cells, g.meta_n_barcodes) == (w.meta_n_cells, w.meta_n_barcodes)
        assert np.allclose([g.auroc_pooled, g.auroc_median_barcode, g.auroc_median_fold, *g.auroc_folds], [w.auroc_pooled, w.auroc_median_barcode, w.auroc_median_fold, *w.auroc_folds], rtol=0, atol=1e-9)


def test_metrics_of_few_cells_and_none(spark):
    cells = made(spark, 40)
    assert boost.boosted_metrics(cells.limit(0), ["x"], 3).count() == 0
    assert boost.boosted_metrics(cells.where("meta_aa_changes = 'WT'"), ["x"], 3).count() == 0
    assert boost.boosted_metrics(cells, ["x"], 3, rounds=1).count() == 2


def test_equal_cells_are_one_row_to_the_trees(spark, monkeypatch):
    seen, fit = [], boost.fit

    def watched(rows, *args):
        seen.append(rows.agg(F.count("*"), F.sum("n") if "n" in rows.columns else F.count("*")).first())
        return fit(rows, *args)

    monkeypatch.setattr(boost, "fit", watched)
    cells = made(spark, 200).where("meta_aa_changes is not null")
    n = cells.count()
    boost.boosted(cells.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(20)))), ["x", "y", "z"], 3, rounds=1, depth=1).count()
    assert all(rows <= n and cells_of == 20 * n for rows, cells_of in seen) and seen
