import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from assayframe.functions import columns
from assayframe.operators import aggregate, annotate, combat, inference, matrix, normalize, pool, positions, qc, reduce, reproduce, score
from assayframe.sources import tables


def student_tail(t, nu):
    """Two-sided tail of Student's distribution by the continued fraction of the incomplete beta function."""
    x, a, b = nu / (nu + t * t), nu / 2, 0.5
    if x > (a + 1) / (a + b + 2):
        return 1 - incomplete_beta(b, a, 1 - x)
    return incomplete_beta(a, b, x)


def incomplete_beta(a, b, x):
    if x <= 0:
        return 0.0
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)) / a
    c, d = 1.0, 1 / (1 - (a + b) * x / (a + 1))
    value = d
    for m in range(1, 400):
        for k in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d, c = 1 / (1 + k * d), 1 + k / c
            value *= d * c
    return front * value


def test_student_tail(spark):
    cases = [(t, nu) for t in (0.0, 0.01, 0.3, 1.0, 1.9, 2.1, 4.0, 12.0) for nu in (1.0, 2.0, 5.5, 30.0, 1000.0, 200000.0)]
    df = spark.createDataFrame(cases, "t double, nu double")
    for r in df.select("t", "nu", inference.student_neg_log10(F.col("t"), F.col("nu")).alias("p")).collect():
        assert r.p == pytest.approx(-math.log10(max(student_tail(r.t, r.nu), 1e-300)), abs=2e-5, rel=2e-5), (r.t, r.nu)
    far = df.limit(1).select(inference.student_neg_log10(F.lit(80.0), F.lit(100000.0)).alias("p"), inference.student_neg_log10(F.lit(-3.0), F.lit(9.0)).alias("q")).first()
    assert far.p == inference.MOST and far.q == pytest.approx(-math.log10(student_tail(3.0, 9.0)), abs=1e-5)


def test_correlation_and_label_tests(spark):
    rng = random.Random(3)
    rows = [(i, rng.gauss(0, 1), i % 3 == 0) for i in range(80)]
    rows = [(i, x, 0.4 * x + rng.gauss(0, 1), g) for i, x, g in rows] + [(90, float("nan"), 1.0, True), (91, None, 2.0, None)]
    df = spark.createDataFrame(rows, "k int, x double, y double, g boolean")
    x, y = np.array([r[1] for r in rows[:80]]), np.array([r[2] for r in rows[:80]])
    ranks = lambda v: np.argsort(np.argsort(v)).astype(float)
    for metric, (a, b) in {"pearson": (x, y), "spearman": (ranks(x), ranks(y))}.items():
        got = inference.correlation_test(df, "x", "y", metric).first()
        r = np.corrcoef(a, b)[0, 1]
        assert got.value == pytest.approx(r) and got.n == 80 and (got.above, got.below) == ((y > x).sum(), (y < x).sum())
        assert got.neg_log_p == pytest.approx(-math.log10(student_tail(r * math.sqrt(78 / (1 - r * r)), 78)), abs=1e-4)
    few = inference.correlation_test(df.limit(2), "x", "y").first()
    assert few.n == 2 and few.value is None and few.neg_log_p is None
    a, b = y[[r[3] for r in rows[:80]]], y[[not r[3] for r in rows[:80]]]
    a = np.append(a, 1.0)
    got = inference.label_tests(df, F.col("g"), ["y"], "welch", "cohens_d").first()
    va, vb = a.var(ddof=1) / len(a), b.var(ddof=1) / len(b)
    t, nu = (a.mean() - b.mean()) / math.sqrt(va + vb), (va + vb) ** 2 / (va**2 / (len(a) - 1) + vb**2 / (len(b) - 1))
    assert (got.n_positive, got.n_negative) == (len(a), len(b)) and got.WelchNegLogP == pytest.approx(-math.log10(student_tail(t, nu)), abs=1e-4)
    assert got.cohens_d == pytest.approx((a.mean() - b.mean()) / math.sqrt(((len(a) - 1) * a.var(ddof=1) + (len(b) - 1) * b.var(ddof=1)) / (len(a) + len(b) - 2)))
    assert inference.label_tests(df, F.col("g"), ["y"], "ks").first().KSnegLogP >= 0
    with pytest.raises(ValueError):
        inference.label_tests(df, F.col("g"), ["y"], "none")


def test_top_points_and_checked_labels(spark):
    df = spark.createDataFrame([("a", 3.0, 1.0), ("b", -5.0, 0.5), ("c", 0.1, 9.0), ("d", None, None)], "f string, e double, p double")
    assert [r.f for r in inference.top_points(df, "e", "p", 2).collect()] == ["c", "a"]
    assert [r.f for r in inference.top_points(df, "e", "p", 2, threshold=0.5, cutoff=1.0, by_effect=True).collect()] == ["b", "a"]
    assert inference.checked_labels(df.union(df), "f").count() == 8
    with pytest.raises(Exception, match="fewer than 2 rows: a, b"):
        inference.checked_labels(df.where("f <> 'c'").union(df.where("f = 'd'")), "f").collect()


def test_mean_ranks(spark):
    values = [3.0, 1.0, 3.0, None, 2.0, 3.0, -1.0]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "k int, v double")
    assert {r.k: r.v for r in aggregate.mean_ranks(df, "v").collect()} == {0: 5.0, 1: 2.0, 2: 5.0, 3: None, 4: 3.0, 5: 5.0, 6: 1.0}


def test_pairs_of_columns_and_components(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(70, 5)) @ rng.normal(size=(5, 5)) + 1000
    x[:, 4] = 7.0
    gaps = x.copy()
    gaps[rng.random(x.shape) < 0.1] = np.nan
    names = list("abcde")
    df = spark.createDataFrame([tuple(map(float, r)) for r in gaps], ", ".join(f"{n} double" for n in names)).repartition(3)
    for metric in ("pearson", "euclidean"):
        got = {(r.a, r.b): (r.value, r.n_shared) for r in reduce.column_pairs(df, names, metric).collect()}
        assert len(got) == 10
        for (a, b), (value, n) in got.items():
            both = gaps[:, [names.index(a), names.index(b)]]
            both = both[np.isfinite(both).all(axis=1)]
            assert n == len(both)
            if metric == "euclidean":
                assert value == pytest.approx(np.sqrt(((both[:, 0] - both[:, 1]) ** 2).sum()))
            elif "e" in (a, b):
                assert value is None
            else:
                assert value == pytest.approx(np.corrcoef(both.T)[0, 1])
    whole = gaps[np.isfinite(gaps).all(axis=1)]
    out, loadings, shares = reduce.components(df, names, whiten=False)
    values, vectors = np.linalg.eigh(np.cov(whole.T))
    assert np.allclose(shares, values[::-1] / values.sum(), atol=1e-9) and np.allclose(abs(loadings[:, :4]), abs(vectors[:, ::-1][:, :4]), atol=1e-6)
    rows = [r for r in out.collect() if r.pc_0 is not None]
    assert len(rows) == len(whole) and np.allclose([[r[f"pc_{i}"] for i in range(5)] for r in rows], (np.array([[r[n] for n in names] for r in rows]) - whole.mean(axis=0)) @ loadings)
    assert np.allclose(np.std([[r[f"pc_{i}"] for i in range(3)] for r in reduce.components(df, names, whiten=True)[0].collect() if r.pc_0 is not None], axis=0, ddof=1), 1)
    assert reduce.components_for(np.array([0.6, 0.3, 0.1]), 0.9) == 2 and reduce.components_for(np.array([0.6, 0.3]), 1.0) == 2
    with pytest.raises(ValueError):
        reduce.components_for(shares, 0)
    empty, _, none = reduce.components(df.limit(0), names)
    assert empty.count() == 0 and not none.any()


def test_impact_scores(spark):
    rows = [("A1A", 1.0, 2.0, 0.0), ("A2A", 3.0, 0.0, 1.0), ("A3V", -2.0, 5.0, float("nan")), ("A4V", None, None, None)]
    df = spark.createDataFrame(rows, "meta_aa_changes string, f double, g double, h double")
    control = F.col("meta_aa_changes").rlike("A$")
    got = {r.meta_aa_changes: r.impact_score for r in reduce.impact_score(df, control, ["f", "g", "h"], metric="euclidean").collect()}
    assert got["A3V"] == pytest.approx(math.hypot(-4, 4)) and got["A4V"] is None
    got = {r.meta_aa_changes: r.impact_score for r in reduce.impact_score(df, control, ["f", "g", "h"], metric="pearson").collect()}
    assert got["A1A"] == pytest.approx((1 - np.corrcoef([1, 2, 0], [2, 1, 0.5])[0, 1]) / 2) and got["A4V"] is None
    assert {r.meta_aa_changes: r.impact_score for r in reduce.impact_score(df, control, ["f", "g", "h"]).collect()}["A4V"] == 0.5
    with pytest.raises(ValueError):
        reduce.impact_scores(df, control, ["f"], ())


def test_loading_cells(spark):
    cells = spark.createDataFrame([(1, None, "A1A", 1.0), (2, "x", "A1A", 3.0), (3, None, "A2V", 8.0), (None, "y", "A2V", 5.0)], "k int, j string, meta_aa_changes string, f double")
    kept = spark.createDataFrame([(1, None, "A1A"), (2, "x", "A1A"), (None, "y", "renamed"), (3, "z", "A2V")], "k int, j string, meta_aa_changes string")
    keys, fitted = reproduce.filter_and_fit(cells, kept, ["k", "j"], F.col("meta_aa_changes") == "A1A", ["f"])
    rows = reproduce.load_cells(cells, keys, fitted, ["k", "j"], ["k"]).collect()
    assert [(r.k, r.meta_aa_changes, r.meta_is_control) for r in rows] == [(None, "renamed", False), (1, "A1A", True), (2, "A1A", True)]
    assert [r.f for r in rows] == pytest.approx([3 / math.sqrt(2), -1 / math.sqrt(2), 1 / math.sqrt(2)])


def test_votes_of_batches(spark):
    df = spark.createDataFrame([("b1", "f", True), ("b2", "f", True), ("b1", "g", True), ("b1", "h", None), ("b2", "h", True)], "meta_batch string, feature string, feature_ok boolean")
    assert reproduce.consensus(df, "meta_batch") == ["f", "g"] and reproduce.consensus(df, "meta_batch", missing="fail") == ["f"] and reproduce.consensus(df, "meta_batch", 1) == ["f", "g", "h"]
    with pytest.raises(ValueError):
        reproduce.vote_table(df, "meta_batch", missing="maybe")


def test_compositions_of_batches(spark):
    rng = np.random.default_rng(2)
    make = lambda shift, extra: spark.createDataFrame([(f"A{i}V", float(i + shift + rng.normal()), float(rng.normal()), 1.0) for i in range(12)] + [(extra, 9.0, 9.0, 1.0)], "meta_aa_changes string, f double, g double, only_%d double" % shift)
    out = combat.combat_features({"b1": make(0, "A90V"), "b2": make(5, "A91V")}, "meta_aa_changes")
    assert out.columns == ["meta_aa_changes", "f", "g", "meta_batch"] and out.count() == 24
    means = {r.meta_batch: r.f for r in out.groupBy("meta_batch").agg(F.avg("f").alias("f")).collect()}
    assert abs(means["b1"] - means["b2"]) < 1
    scores = make(0, "A90V").withColumn("meta_batch", F.lit("b1")).unionByName(make(5, "A91V").withColumn("meta_batch", F.lit("b2")), allowMissingColumns=True)
    got = combat.combat_scores(scores, ["f"], "meta_aa_changes")
    assert got.count() == 26 and got.where("f_corrected is null").count() == 2
    joined = pool.distinguishability(scores.select("meta_aa_changes").distinct(), scores, "meta_aa_changes", "f", control=F.col("meta_aa_changes") != "A90V")
    assert joined.count() == 14 and joined.where("meta_distinguishability_score is null").count() == 0
    plain = pool.distinguishability(scores.select("meta_aa_changes").distinct(), scores.where("meta_batch = 'b1'").drop("meta_batch"), "meta_aa_changes", "f")
    assert plain.where("meta_distinguishability_score is null").count() == 1
    view = pool.viewer_features(scores, "meta_aa_changes", ["f", "only_7"] if "only_7" in scores.columns else ["f", "g"], "meta_batch", F.lit(True))
    assert {"meta_aa_changes", "f"} <= set(view.columns)
    first = pool.first_metadata(scores.select("meta_aa_changes", "meta_batch"), scores.withColumn("meta_note", F.lit("x")).select("meta_aa_changes", "meta_batch", "meta_note"), "meta_aa_changes", "meta_batch")
    assert first.where("meta_note = 'x'").count() == 26


def test_matrix_forms(spark, tmp_path):
    m = spark.createDataFrame([("a", "b", 1.0), ("a", "c", 2.0), ("b", "c", 3.0)], "a string, b string, value double")
    rows = {r.a: (r.c, r.a_, r.b) for r in matrix.wide(m, ["c", "a", "b"], 0.0).withColumnRenamed("b", "b").toDF("a", "c", "a_", "b").collect()}
    assert rows == {"a": (2.0, 0.0, 1.0), "b": (3.0, 1.0, 0.0), "c": (0.0, 2.0, 3.0)}
    assert {(r.a, r.b, r.i, r.j) for r in matrix.align(m, ["c", "a"]).collect()} == {("a", "c", 1, 0)}
    with pytest.raises(Exception, match="no such row: x"):
        matrix.align(m, ["a", "x"]).collect()
    matrix.save(m, str(tmp_path / "m"), metric="cosine", squared=True)
    back, told = matrix.load(spark, str(tmp_path / "m"))
    assert back.collect() == m.collect() and told == {"metric": "cosine", "squared": True}
    noisy = spark.createDataFrame([("g", 0.0, 0.0), ("g", 10.0, 0.1), ("h", 5.0, 0.3), ("h", 9.0, 0.3)], "w string, x double, y double")
    assert matrix.noisy_features(noisy, ["x", "y"], ["w"]) == ["x"]


def test_column_projections(spark):
    df = spark.createDataFrame([("w", "t", "3", "b", "A1V", "1", 0.5, 7)], "meta_well string, meta_tile string, meta_cell_index string, meta_barcode string, meta_aa_changes string, meta_edit_distance string, Cells_Area double, batch_no int")
    out = columns.cell_metadata(df, "T1")
    assert out.columns == list(columns.CELL_METADATA) and out.first().meta_cell_index == 3 and columns.cell_metadata(df, "T1", measures=True).columns[-2:] == ["Cells_Area", "batch_no"]
    chosen = columns.output_columns(df, ["meta_barcode"], ["batch_no"], ["Cells_*"], ["*_Size"])
    assert chosen.columns[0] == "meta_barcode" and chosen.columns[-2:] == ["meta_batch_no", "Cells_Area"]
    names = columns.landmark_columns(["Nuc_x_KS", "Nuc_x_median", "Nuc_x_y_KS", "Cyt_median"], {"Cyt": "Cytoplasm", "Nuc_x": "Nucleus"})
    assert list(names.items()) == [("Cyt_median", "Cytoplasm (median)"), ("Nuc_x_median", "Nucleus (median)"), ("Nuc_x_KS", "Nucleus (KS)")]
    at = spark.createDataFrame([(1, "Synonymous"), (2, "Nonsense")], "position int, variant_type string")
    assert [r.residue for r in columns.with_residue(at, "position", 24, ["Nonsense"]).collect()] == [26]


def test_evidence_constants_and_out_of_bag_points(spark):
    assert annotate.evidence_odds(0.1) in range(330, 380)  # the published value for this prior is about 350
    for prior in (0.02, 0.1, 0.3, 0.6):  # rule by rule: posteriors to three decimals at and below the odds found
        for odds, more in ((annotate.evidence_odds(prior), False), (annotate.evidence_odds(prior) - 1, True)):
            broken = 0
            for kinds, bound, sign in ((annotate.PATHOGENIC_RULES, 0.99, 1), (annotate.LIKELY_PATHOGENIC_RULES, 0.9, 1), (annotate.BENIGN_RULES, 0.01, -1), (annotate.LIKELY_BENIGN_RULES, 0.1, -1)):
                for a, b, c, d in kinds:
                    ratio = float(odds) ** (sign * (a / 8 + b / 4 + c / 2 + d))
                    broken += sign * round(ratio * prior / ((ratio - 1) * prior + 1), 3) < sign * bound
            assert (broken > 0) == more and annotate.broken_rules(np.array([odds]), prior)[0] == broken
    odds = np.arange(300, 400)
    assert annotate.broken_rules(odds, 0.1).min() == annotate.broken_rules(np.array([annotate.evidence_odds(0.1)]), 0.1)[0]
    rows = [(i, float(i % 20), i % 20 >= 10) for i in range(200)]
    df = spark.createDataFrame(rows, "k int, s double, p boolean")
    grid = [0.0, 5.0, 10.0, 15.0, 19.0]
    curves, left = annotate.replicate_curves(df, "s", F.col("p"), grid, 2.0, 60, ["k"])
    assert curves.count() == 60 and abs(left.count() / 12_000 - math.exp(-1)) < 0.02
    got = {r.k: r for r in annotate.out_of_bag_points(curves, left, grid, 4.0, ["k"]).collect()}
    held, by_fit = {}, {r.replicate: r.llrs for r in curves.collect()}
    for r in left.collect():
        held.setdefault(r.k, []).append(by_fit[r.replicate])
    assert len(got) == len(held)
    for k, own in held.items():
        own, at = np.array(own), max(0, sum(g <= k % 20 for g in grid) - 1)
        low = np.quantile(own, 0.05, axis=0)[at:].min()
        high = np.quantile(own, 0.95, axis=0)[: at + 1].max()
        up, down = (min(8, max(0, math.floor(v * 2 + 1e-12))) for v in (low, -high))
        assert got[k].fits == len(own) and got[k].points == (None if len(own) < 10 else up or -down)
    ratios = spark.createDataFrame([(0.2, 1.0), (0.5, 1.0), (0.1, 0.0)], "f double, c double")
    assert annotate.unmixing_prior(ratios, F.col("f"), F.col("c")) == 0.2 and annotate.unmixing_prior(ratios, F.col("f"), F.col("c"), negative=True) == 0.8
    assert annotate.unmixing_prior(ratios.where("c = 0"), F.col("f"), F.col("c")) == 0.1  # no density, no signal
    groups = spark.createDataFrame([("P/LP", float(i)) for i in range(6)] + [("B/LB", float(i + 3)) for i in range(6)], "g string, s double")
    assert annotate.direction(groups, "g", "s") == -1 and annotate.direction(groups.where("s < 2"), "g", "s") == 0


def test_blocked_statistics_and_result_tables(spark, tmp_path):
    rows = [("A1V", False, float(i), float(i % 3)) for i in range(9)] + [("A1A", True, float(i), 1.0) for i in range(6)]
    df = spark.createDataFrame(rows, "meta_aa_changes string, c boolean, f double, g double")
    out = aggregate.aggregate(df, F.col("c"), ["f", "g"], ["mean", "KS"], blocked=["f_mean", "g_KS", "unknown"])
    assert out.columns == ["meta_aa_changes", "g_mean", "f_KS"] and out.first().g_mean == 1.0
    assert aggregate.aggregate(df, F.col("c"), ["f"], ["KS"], blocked=["f_KS"]).columns == ["meta_aa_changes"]
    cells = spark.createDataFrame([("WT", "w", i, i % 2, float(i)) for i in range(20)] + [("A1V", f"b{i % 2}", i, i % 2, float(i)) for i in range(20)], "meta_aa_changes string, meta_barcode string, k int, fold int, f double")
    scores = score.cross_validated(cells, ["f"], 2)
    results, by_cell = score.result_tables(scores)
    assert [f.name for f in results.schema] == [f.split()[0] for f in score.RESULTS.split(", ")] and results.count() == 1 and by_cell.count() == 40
    none, no_cells = score.result_tables(scores.limit(0))
    assert none.count() == 0 == no_cells.count() and none.schema == results.schema and no_cells.schema == by_cell.schema
    score.save_results(scores, str(tmp_path), "run.")
    assert spark.read.parquet(str(tmp_path / "run.results.parquet")).count() == 1


def test_zscore_without_batches_is_the_normalizer(spark):
    df = spark.createDataFrame([("A1A", 1.0, 2.0, 5.0), ("A2A", 3.0, 2.0, float("nan")), ("A3V", 7.0, 9.0, 1.0), ("A4V", float("inf"), None, 1.0)], "meta_aa_changes string, f double, g double, meta_x double")
    control = F.col("meta_aa_changes").rlike("A$")
    one = normalize.zscore(df, control, ["f", "g"]).collect()
    assert one == normalize.Normalizer.fit(df, control, ["f", "g"]).apply(df).collect()
    assert qc.LABEL == aggregate.LABEL


def test_blocks_give_the_same(spark, monkeypatch):
    rng = random.Random(5)
    cells = spark.createDataFrame([(v, "b", i % 2, rng.gauss(0, 1)) for v in ("WT", "A1V", "A2V", "A3V") for i in range(10)], "meta_aa_changes string, meta_barcode string, fold int, f double")
    scored = lambda: sorted(score.cross_validated(cells, ["f"], 2).collect())
    means = cells.groupBy("meta_aa_changes").agg(F.avg("f").alias("f"))
    apart = lambda: sorted(matrix.between_rows(means, "meta_aa_changes", F.array("f")).collect())
    whole, pairs = scored(), apart()
    monkeypatch.setattr(score, "BLOCK_BYTES", 100)
    monkeypatch.setattr(matrix, "BLOCK_BYTES", 100)
    assert scored() == whole and len(whole) == 60 and apart() == pairs and len(pairs) == 6


def test_paired_batches_with_p(spark):
    rows = [(f"l{i}", b, float(x)) for b, xs in (("a", (1, 2, 3, 4, 5)), ("b", (2, 2, 5, 5, 8)), ("c", (2, 3, 4, 5, 6))) for i, x in enumerate(xs)]
    got = {(r.a, r.b): r for r in matrix.batch_anova(spark.createDataFrame(rows, "l string, g string, s double"), "l", "g", "s").collect()}
    d = np.array([-1, 0, -2, -1, -3])
    t = d.mean() / (d.std(ddof=1) / 5**0.5)
    x = abs(t) / 2  # the two-sided tail of Student's distribution with four degrees of freedom has a closed form
    p = 1 - x / (1 + x * x) ** 0.5 * (1 + 0.5 / (1 + x * x))
    assert np.isclose(got["a", "b"].f, t * t) and np.isclose(10 ** -got["a", "b"].neg_log_p, p, rtol=1e-4)
    assert got["a", "c"].f is None and got["a", "c"].neg_log_p is None and got["a", "c"].n == 5


def test_effect_map_of_repeats(spark):
    df = spark.createDataFrame([(1, "A", 3.0, 2), (1, "A", 5.0, 1), (1, "A", 10.0, 3), (2, "V", 1.0, 1)], "position int, mut string, score double, n int")
    value = lambda **how: {(r.position, r.mut): r.score for r in positions.effect_map(df, ["A", "V"], **how).collect()}[1, "A"]
    assert [value(combine=c) for c in ("mean", "median", "min", "max")] == [6.0, 5.0, 3.0, 10.0]
    assert value(combine="first", order="n") == 5.0
    for bad in ({"combine": "first"}, {"combine": "mode"}, {"combine": "mean", "order": "n"}):
        with pytest.raises(ValueError):
            value(**bad)
    with pytest.raises(Exception, match="more than one score"):
        value(combine="error")
    once = positions.effect_map(df.where("n = 1"), ["A", "V"], "error").collect()
    assert {(r.position, r.mut): r.score for r in once} == {(1, "A"): 5.0, (1, "V"): None, (2, "A"): None, (2, "V"): 1.0}


def test_tags_of_labels(spark):
    df = spark.createDataFrame([("b", "A1V:x:y", 0, 1), ("b", "wt:z", 1, 2), ("b", "A2V", 0, 3), (None, None, None, 4)], "bc string, lab string, d int, tag int")
    got = tables.canonical_identity(df, "bc", "lab", "d", "wt", "tag").collect()
    assert [(r.meta_aa_changes, r.tag) for r in got] == [("A1V", "x:y"), ("WT", "z"), ("A2V", None), (None, None)]
    assert [r.meta_aa_changes for r in tables.canonical_identity(df, "bc", "lab", "d").collect()] == ["A1V:x:y", "wt:z", "A2V", None]
