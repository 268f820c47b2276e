import json
import math
import random
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from assayframe.dataset import Dataset
from assayframe.functions import columns, labels
from assayframe.operators import aggregate, annotate, combat, images, matrix, normalize, pool, positions, qc, reproduce, score
from assayframe.sources import tables

LABELS = ["A12V", "A12A", "A12fs", "A12-", "A12-|L13-", "A12-|L20-", "A12*", "A12X", "WT", "A12A:tag", None]


def test_labels(spark):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(LABELS)], "i int, l string")
    wt, place, mut = labels.substitution("l")
    got = df.select("l", labels.variant_type("l").alias("t"), labels.is_control("l").alias("c"), labels.position("l").alias("p"), labels.position("l", True).alias("s"), wt.alias("w"), mut.alias("m"), labels.substitution_key("l").alias("k"), labels.label_tag("l").alias("tag")).collect()
    assert [r.t for r in got] == ["Single Missense", "Synonymous", "Frameshift", "3nt Deletion", "3nt Deletion", "Other", "Nonsense", "Nonsense", "WT", "Synonymous", None]
    assert [r.c for r in got] == [False, True] + [False] * 9
    assert [r.p for r in got] == [12] * 8 + [None, 12, None] and [r.s for r in got][:3] == [12, 12, None]
    assert [r.k for r in got] == ["A12V", "A12A", None, None, None, None, "A12*", "A12*", None, None, None] and got[9].tag == "tag"


def test_other_scalar_functions(spark):
    df = spark.createDataFrame([("p.Arg123Trp", "Pathogenic", "reviewed by expert panel", "ATGTAA"), ("NP_1.2:p.(Gly7=)", "Likely benign", "unknown", "ATGNAA"), ("p.Gln5Ter", "Pathogenic/Likely pathogenic", " ", "ATGA"), ("p.Sec2Ala", "Pathogenic/Pathogenic", "Criteria provided, conflicting interpretations", "A"), ("c.1A>G", "Pathogenic/Benign", "no assertion provided", None), ("x", "benign/Likely benign/Benign", None, None), (None, "Likely Uncertain", None, None)], "h string, c string, r string, s string")
    got = df.select(labels.hgvs_key("h").alias("k"), labels.clinical_class("c").alias("c"), labels.review_stars("r").alias("r"), labels.blank_to_null("r").alias("b"), labels.translate_codons("s").alias("s")).collect()
    assert [tuple(x) for x in got] == [("R123W", "P/LP", 3, "reviewed by expert panel", "M*"), ("G7G", "B/LB", 0, "unknown", None), ("Q5*", "P/LP", 0, None, None), ("U2A", "P/LP", 1, "Criteria provided, conflicting interpretations", None), (None, None, 0, "no assertion provided", None), (None, "B/LB", 0, None, None), (None, None, 0, None, None)]
    x = spark.range(-1, 5).select((F.col("id") + 0.5).alias("x"))
    curve = [0.0, 1.0, 4.0]
    got = [r[0] for r in x.select(labels.on_grid(F.col("x"), 0.0, 1.0, curve)).collect()]
    assert np.allclose(got, np.interp([-0.5, 0.5, 1.5, 2.5, 3.5, 4.5], [0, 1, 2], curve))
    got = [r[0] for r in x.select(labels.points(F.col("x"), [(-1, float("-inf"), 0.5), (2, 1.0, 2.5)])).collect()]
    assert got == [-1, -1, 2, 2, 0, 0]


def cells(spark, rows):
    return spark.createDataFrame(rows, "meta_aa_changes string, meta_is_control boolean, f double, g double")


def samples():
    rng = random.Random(2)
    rows = [(("A1A" if c else f"A{1 + i % 3}V"), c, float(rng.randint(0, 6)), rng.gauss(0, 1)) for c in (True, False) for i in range(60)]
    rows += [("A9V", False, float("nan"), None), ("A9V", False, float("inf"), None), ("A8V", False, 3.0, 1.0)]
    return rows


def test_statistics_against_brute_force(spark):
    rows = samples()
    df, control = cells(spark, rows), F.col("meta_is_control")
    methods = ["mean", "median", "std", "MAD", "KS", "signedKS", "AUROC", "QQ", "KSnegLogP", "AUROCnegLogP"]
    got = {r.meta_aa_changes: r.asDict() for r in aggregate.aggregate(df, control, ["f", "g"], methods).collect()}
    fine = lambda v: v is not None and math.isfinite(v)
    for name in {r[0] for r in rows if not r[1]}:
        for k, f in ((2, "f"), (3, "g")):
            x = np.array([r[k] for r in rows if r[0] == name and not r[1] and fine(r[k])])
            y = np.array([r[k] for r in rows if r[1] and fine(r[k])])
            own = {m: got[name][f"{f}_{m}"] for m in methods}
            if not len(x):
                assert all(v is None for v in own.values())
                continue
            points = np.unique(np.concatenate([x, y]))
            diff = np.array([(x <= p).mean() - (y <= p).mean() for p in points])
            assert np.isclose(own["mean"], x.mean()) and np.isclose(own["median"], np.median(x)) and np.isclose(own["MAD"], np.median(abs(x - np.median(x))))
            assert (own["std"] is None) == (len(x) < 2) and (len(x) < 2 or np.isclose(own["std"], x.std(ddof=1)))
            assert np.isclose(own["KS"], abs(diff).max())
            assert np.isclose(own["signedKS"], diff.max() if max(diff.max(), 0) >= -min(diff.min(), 0) else diff.min())
            u = sum((x[:, None] > y).sum(1) + (x[:, None] == y).sum(1) / 2)
            assert np.isclose(own["AUROC"], u / (len(x) * len(y)))
            n, m = len(x), len(y)
            _, t = np.unique(np.concatenate([x, y]), return_counts=True)
            var = n * m / 12 * (n + m + 1 - (t**3 - t).sum() / ((n + m) * (n + m - 1)))
            p = math.erfc(abs(u - n * m / 2) / math.sqrt(var) / math.sqrt(2))
            assert np.isclose(own["AUROCnegLogP"], max(0, -math.log10(p)), atol=1e-6)
            d, ne = abs(diff).max(), n * m / (n + m)
            tail = 2 * sum((-1) ** (k - 1) * math.exp(-2 * k * k * ne * d * d) for k in range(1, 101))
            assert np.isclose(own["KSnegLogP"], max(0, -math.log10(tail)), atol=1e-6)
            q = np.linspace(0, 1, 100)
            if len(set(x)) > 1:
                assert np.isclose(own["QQ"], np.corrcoef(np.quantile(x, q), np.quantile(y, q))[0, 1])
            else:
                assert own["QQ"] is None


def test_statistics_without_control_or_rows(spark):
    df = cells(spark, [("A1V", False, 1.0, 2.0), ("A1V", False, 2.0, 2.0)])
    [r] = aggregate.aggregate(df, F.col("meta_is_control"), ["f"], ["mean", "KS", "AUROC"]).collect()
    assert r.f_mean == 1.5 and r.f_KS is None and r.f_AUROC is None
    assert aggregate.aggregate(df.limit(0), F.col("meta_is_control"), ["f"], ["mean", "KS"]).count() == 0
    for bad in ([], ["nope"], ["KS", "KS"]):
        with pytest.raises(ValueError):
            aggregate.checked(bad)


def test_quality_control(spark):
    rows = [("bc1", "V1", 0)] * 3 + [("bc2", "V1", 0)] * 3 + [("bc3", "V2", 0)] * 3 + [("bc4", "V2", 0)] + [("bc5", "V2", 2)] * 3 + [("bc6", None, 0)] * 3
    df = spark.createDataFrame(rows, "meta_barcode string, meta_aa_changes string, meta_edit_distance int")
    kept = qc.passing(df, 1, 3, 2)
    assert {(r.meta_barcode, r.meta_aa_changes) for r in kept.collect()} == {("bc1", "V1"), ("bc2", "V1")} and kept.count() == 6
    assert {r.meta_barcode: r.barcode_ok for r in qc.barcode_counts(df, 3).collect()}["bc4"] is None


def test_seeded_operators(spark):
    df = spark.createDataFrame([(i, f"A{i % 4}A" if i % 2 else "WT", f"b{i % 7}") for i in range(200)], "k int, meta_aa_changes string, meta_barcode string")
    half = reproduce.split_halves(df, ["k"], 3, seed=1)
    sizes = half.groupBy("replicate", "meta_aa_changes").agg(F.count_if(F.col("half") == 0).alias("a"), F.count_if(F.col("half") == 1).alias("b")).collect()
    assert all(abs(r.a - r.b) <= 1 for r in sizes)
    again = reproduce.split_halves(df.repartition(7), ["k"], 3, seed=1)
    assert sorted(map(tuple, half.collect())) == sorted(map(tuple, again.collect()))
    kept = qc.downsample_control(df, F.col("meta_aa_changes") != "WT", ["k"], n=13, seed=2)
    assert kept.where("meta_aa_changes <> 'WT'").count() == 13 and kept.where("meta_aa_changes = 'WT'").count() == 100
    assert sorted(r.k for r in kept.collect()) == sorted(r.k for r in qc.downsample_control(df.repartition(5), F.col("meta_aa_changes") != "WT", ["k"], n=13, seed=2).collect())
    folded = score.folds(df, 3, ["k"], by_barcode=True)
    assert folded.where("meta_aa_changes <> 'WT'").groupBy("meta_aa_changes", "meta_barcode").agg(F.count_distinct("fold").alias("n")).where("n > 1").count() == 0
    assert folded.count() == 200
    thin = qc.downsample_wildtype(df, ["k"])
    assert thin.where("meta_aa_changes <> 'WT'").count() == 100
    extra = qc.pseudo_variants(df, 10, ["Synonymous"], ["k"])
    assert extra.where("meta_aa_changes like '%downsample%'").groupBy("meta_aa_changes").count().select("count").distinct().collect()[0][0] == 10


def test_normalizer(spark, tmp_path):
    df = cells(spark, [("A1A", True, 1.0, 5.0), ("A1A", True, 3.0, 5.0), ("A1A", True, float("nan"), 5.0), ("A2V", False, 5.0, float("nan"))])
    n = normalize.Normalizer.fit(df, F.col("meta_is_control"), ["f", "g"])
    n.save(spark, str(tmp_path / "n"))
    assert normalize.Normalizer.load(spark, str(tmp_path / "n")) == n and n.std["g"] is None
    got = n.apply(df).collect()
    assert np.isclose(got[3].f, (5 - 2) / math.sqrt(2)) and got[2].f is None and all(r.g is None for r in got)


def numpy_combat(x, batch, label):
    """The published equations with an explicit design."""
    batches, names = sorted(set(batch)), sorted(set(label))
    design = np.column_stack([[b == c for b in batch] for c in batches] + [[v == c for v in label] for c in names[1:]]).astype(float)
    beta = np.linalg.lstsq(design, x, rcond=None)[0]
    sizes = np.array([batch.count(b) for b in batches])
    grand = sizes @ beta[: len(batches)] / len(x)
    sd = np.sqrt(((x - design @ beta) ** 2).mean(axis=0))
    kept = grand + design[:, len(batches) :] @ beta[len(batches) :]
    z = (x - kept) / sd
    out = np.empty_like(x)
    for b in batches:
        rows = np.array([c == b for c in batch])
        own = z[rows]
        g, d = combat.shrink(own.mean(axis=0), own.var(axis=0, ddof=1), own.sum(axis=0), (own**2).sum(axis=0), len(own), False)
        out[rows] = (own - g) / np.sqrt(d) * sd + kept[rows]
    return out


def test_combat_against_numpy(spark):
    rng = np.random.default_rng(3)
    rows, effect = [], rng.normal(size=(40, 4))
    for b, (shift, scale) in {"x": (0, 1.0), "y": (3, 2.5), "z": (-2, 0.5)}.items():
        for v in range(40):
            if (v + ord(b)) % 5:
                rows.append((f"V{v:02d}", b, *(effect[v] + shift + scale * rng.normal(size=4)).tolist()))
    rows += [("only", "x", 1.0, 1.0, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "meta_aa_changes string, meta_batch string, a double, b double, c double, d double")
    got = combat.combat(df, ["a", "b", "c", "d"], "meta_aa_changes", "meta_batch").orderBy("meta_batch", "meta_aa_changes").collect()
    used = sorted((r for r in rows if r[0] != "only"), key=lambda r: (r[1], r[0]))
    want = numpy_combat(np.array([r[2:] for r in used]), [r[1] for r in used], [r[0] for r in used])
    assert np.allclose([[r.a, r.b, r.c, r.d] for r in got], want, atol=1e-6)
    with pytest.raises(ValueError):
        combat.combat(df.where("meta_batch = 'x'"), ["a"], "meta_aa_changes", "meta_batch")


def test_matrices(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(8, 5))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "k int, v array<double>")
    ranks = lambda v: np.argsort(np.argsort(v))
    want = {"euclidean": lambda a, b: np.linalg.norm(a - b), "cityblock": lambda a, b: abs(a - b).sum(), "cosine": lambda a, b: a @ b / np.linalg.norm(a) / np.linalg.norm(b), "pearson": lambda a, b: np.corrcoef(a, b)[0, 1], "spearman": lambda a, b: np.corrcoef(ranks(a), ranks(b))[0, 1]}
    for metric, f in want.items():
        got = matrix.between_rows(df, "k", F.col("v"), metric).collect()
        assert len(got) == 28 and all(np.isclose(r.value, f(x[r.a], x[r.b])) for r in got)
    wide = spark.createDataFrame([tuple(map(float, v)) for v in x], [f"c{i}" for i in range(5)])
    scores, loadings, shares = matrix.pca(wide, wide.columns)
    values = np.linalg.eigvalsh(np.cov(x.T))[::-1]
    assert np.allclose(shares, values / values.sum()) and matrix.components_for(shares, 1.0) == 5
    got = np.array([[r[f"pc_{i}"] for i in range(5)] for r in scores.collect()])
    assert np.allclose(np.cov(got.T), np.diag(values), atol=1e-8)
    doubled = wide.withColumn("copy", F.col("c0") * 2).withColumn("flat", F.lit(1.0))
    assert matrix.correlated_features(doubled, ["c0", "c1", "copy"]) in (["c0"], ["copy"])
    assert matrix.variance_threshold(doubled, ["c0", "flat"]) == ["flat"]
    assert matrix.kmeans(df, F.col("v"), 2).select("cluster").distinct().count() == 2


def test_permanova_against_matrix_formula(spark):
    rng = np.random.default_rng(5)
    a, b = rng.normal(size=(12, 3)), rng.normal(0.4, 1, size=(12, 3))
    df = spark.createDataFrame([(i, "a", v.tolist()) for i, v in enumerate(a)] + [(i, "b", v.tolist()) for i, v in enumerate(b)], "l int, g string, v array<double>")
    [r] = matrix.permanova(df, "l", "g", F.col("v"), 39).collect()
    both = np.vstack([a, b])
    within = lambda groups: sum(((both[g] - both[g].mean(0)) ** 2).sum() for g in groups)
    total = within([list(range(24))])
    blocks, effect = total - within([[i, i + 12] for i in range(12)]), total - within([list(range(12)), list(range(12, 24))])
    assert np.isclose(r.f, effect / ((total - blocks - effect) / 11)) and 1 / 40 <= r.p <= 1


def test_pooling_and_curves(spark):
    df = spark.createDataFrame([("v", "b1", 3.0, 30), ("v", "b2", 1.0, 10), ("v", "b3", None, 99), ("v", "b4", 2.0, 20), ("w", "b1", None, 5)], "l string, b string, x double, n long")
    got = {r.l: (r.x, r.n) for r in pool.paired_median(df, "l", "x", "n").collect()}
    assert got == {"v": (2.0, 20), "w": (None, None)}
    rng = random.Random(6)
    rows = [(rng.randint(0, 9) / 1.0, rng.random() < 0.4) for _ in range(80)]
    sdf = spark.createDataFrame(rows, "s double, t boolean").withColumn("g", F.lit(1))
    [r] = pool.auc(sdf, "s", F.col("t"), ["g"]).collect()
    pos, neg = [s for s, t in rows if t], [s for s, t in rows if not t]
    assert np.isclose(r.auc, np.mean([(p > q) + (p == q) / 2 for p in pos for q in neg]))
    points = sorted((x.fpr, x.tpr) for x in pool.roc_points(sdf, "s", F.col("t"), ["g"]).collect())
    assert points[-1] == (1.0, 1.0) and np.isclose(np.trapezoid([0, *(p[1] for p in points)], [0, *(p[0] for p in points)]), r.auc)
    with pytest.raises(Exception, match="several values"):
        pool.pivot_unique(df.union(df), "l", "b", "x", ["b1"]).collect()


def test_cross_validated_scores(spark):
    rng = random.Random(7)
    rows = [(i, lab, f"{lab}{i % 4}", rng.gauss({"WT": 0, "A1V": 2, "A2V": 0}[lab], 1)) for lab in ("WT", "A1V", "A2V") for i in range(60)]
    df = spark.createDataFrame(rows, "k int, meta_aa_changes string, meta_barcode string, f double")
    scores = score.cross_validated(score.folds(df, 3, ["k"]), ["f"], 3).cache()
    assert scores.count() == 120 + 2 * 60 and scores.groupBy("scored_against", "is_wildtype", "meta_aa_changes", "k").count().where("count > 1").count() == 0
    got = {r.meta_aa_changes: r for r in score.metrics(scores).collect()}
    assert got["A1V"].auroc_pooled > 0.85 > 0.65 > got["A2V"].auroc_pooled and len(got["A1V"].auroc_folds) == 3
    one = {b: statistics.mean((w > s) + (w == s) / 2 for w in [r.score for r in scores.where("is_wildtype and scored_against = 'A1V'").collect()] for s in v) for b, v in {b: [r.score for r in scores.where(f"meta_barcode = '{b}'").collect()] for b in ("A1V0", "A1V1", "A1V2", "A1V3")}.items()}
    assert np.isclose(got["A1V"].auroc_median_barcode, statistics.median(one.values()))
    learn = lambda x, y, t: t["f"].map(lambda v: 1.0 - v)
    assert score.grouped(score.folds(df, 3, ["k"]), ["f"], 3, learn).count() == 240


def test_barcode_folds(spark):
    sizes = {"a": 9, "b": 7, "c": 6, "d": 5, "e": 4, "f": 4, "g": 1}
    rows = [("A1V", b, i) for b, n in sizes.items() for i in range(n)] + [("A2V", b, i) for b in "yx" for i in range(3)] + [("WT", "w", i) for i in range(11)]
    df = spark.createDataFrame(rows, "meta_aa_changes string, meta_barcode string, k int")
    got = {(r.label, r.barcode): r.fold_of for r in score.barcode_groups(df, 3).collect()}
    load, want = [0, 0, 0], {("A2V", "x"): 0, ("A2V", "y"): 1}
    for b, n in sorted(sizes.items(), key=lambda x: (-x[1], x[0])):
        to = load.index(min(load))
        load[to] += n
        want["A1V", b] = to
    assert got == want
    assert {(r.label, r.barcode): r.fold_of for r in score.barcode_groups(df).where("label = 'A1V'").collect()} == {("A1V", b): i for i, b in enumerate("abcdefg")}
    dealt = score.folds(df, 3, ["k"], by_barcode=True)
    assert dealt.count() == len(rows) and sorted(r["count"] for r in dealt.where("meta_aa_changes = 'WT'").groupBy("fold").count().collect()) == [3, 4, 4]
    with pytest.raises(Exception, match="two barcodes"):
        score.barcode_groups(df.where("meta_barcode in ('a', 'w')"), 3).collect()
    with pytest.raises(ValueError, match="two folds"):
        score.barcode_groups(df, 1)
    with pytest.raises(ValueError, match="fewer wild-type"):
        score.folds(df.where("meta_barcode <> 'w' or k < 2"), 3, ["k"], by_barcode=True)


def test_annotation(spark):
    clin = spark.createDataFrame([("p.Ala12Val", "|Pathogenic||Pathogenic", "|2||1"), ("p.Gly7Ala", "Benign|Pathogenic", "1|1"), ("p.Gly8Ala", "Benign", "0")], "mapped_hgvs_p string, `clinvar.202401.clinical_significance` string, `clinvar.202401.stars` string")
    got = {r.key: r.meta_clinvar_class for r in annotate.clinvar(clin, min_stars=1).collect()}
    assert got == {"A12V": "P/LP"}
    assert {r.key for r in annotate.clinvar(clin).collect()} == {"A12V"} and {r.key for r in annotate.clinvar(clin, min_stars=None).collect()} == {"A12V", "G8A"}
    df = spark.createDataFrame([("A12V", "P/LP", True), ("A1A", None, True), ("A1A:t", "B/LB", True), ("G7A", None, True), ("A1V|L2P", "P/LP", True), (None, "P/LP", True)], "l string, c string, g boolean")
    got = {r.l: (r.group, r.groups) for r in annotate.control_groups(df, "l", "c", "g").collect()}
    assert got == {"A12V": ("P/LP", ["P/LP", "gnomAD"]), "A1A": ("Synonymous", ["Synonymous", "gnomAD"]), "A1A:t": (None, []), "G7A": ("gnomAD", ["gnomAD"]), "A1V|L2P": (None, []), None: (None, [])}
    assert annotate.control_groups(df.withColumnRenamed("c", "meta_gnomad_clinvar_class"), "l", "absent", "g").where("l = 'A12V'").first().group == "P/LP"
    with pytest.raises(ValueError, match="need"):
        annotate.control_groups(df.drop("c"), "l", "c", "g")
    people = [("p.Ala12Val", "PASS", "3", "100", "0.9", "Benign"), ("p.Ala12Val", "AC0", "5", "200", "0.1", "Likely benign"), ("p.Gly7Val", "PASS", "2", "300", "0.9", "Pathogenic"), ("p.Gly7Val", "PASS", "4", "50", "0.1", "Benign"), ("p.Sec9Ala", "PASS", "1", "10", None, None)]
    table = spark.createDataFrame(people, "`Protein Consequence` string, `Filters - joint` string, `Allele Count` string, `Allele Number` string, spliceai_ds_max string, `ClinVar Germline Classification` string")
    got = {r.key: (r.meta_gnomad_pass, r.meta_gnomad_count, r.meta_gnomad_number, r.meta_gnomad_splice, r.meta_gnomad_clinvar_class) for r in annotate.gnomad(table, splice_max=0.2).collect()}
    assert got == {"A12V": (False, 0.0, None, 0.9, "B/LB"), "G7V": (True, 4.0, 50.0, 0.9, None), "U9A": (True, 1.0, 10.0, None, None)}
    ratios = spark.createDataFrame([(9.0,)] * 30 + [(0.1,)] * 70, "r double")
    prior = annotate.label_shift_prior(ratios, F.col("r"))
    assert abs(np.mean([r * prior / ((r - 1) * prior + 1) for r in [9.0] * 30 + [0.1] * 70]) - prior) < 1e-5
    odd = [1.0, 2.0, float("inf"), 0.0, 0.3, float("nan")] * 15 + [None]
    prior, last = 0.5, 1.0
    while abs(prior - last) >= 1e-6:  # an infinite ratio counts as certain, nulls and NaN not at all
        last, prior = prior, np.mean([1.0 if r == float("inf") else r * prior / ((r - 1) * prior + 1) for r in odd if r is not None and r == r])
    assert abs(annotate.label_shift_prior(spark.createDataFrame([(r,) for r in odd], "r double"), F.col("r")) - prior) < 1e-5
    assert annotate.label_shift_prior(ratios.limit(0), F.col("r")) is None
    letters = spark.createDataFrame([(1, "A"), (1, "V"), (1, "V"), (2, "L"), (2, "C"), (3, None), (None, "G")], "p int, w string")
    assert {r.p: r.w for r in positions.common_wildtype(letters, "p", "w").collect()} == {1: "V", 2: "C", 3: None}
    controls = spark.createDataFrame([(float(i % 10), i % 10 > 5) for i in range(60)], "s double, p boolean")
    curve = annotate.ratio_curves(controls, "s", F.col("p"), [0.0, 3.0, 6.0, 9.0], 1.0, 20).orderBy("i").collect()
    assert curve[0].middle < 0 < curve[3].middle and all(r.low <= r.middle <= r.high for r in curve)


def test_sources(spark, tmp_path):
    (tmp_path / "a.csv").write_text("aaChanges,f1,n\nV1,1.5,1\nV2,,2\nV3,inf,3\n")
    spark.createDataFrame([("V4", 2.0)], "aaChanges string, f2 double").write.parquet(str(tmp_path / "b.parquet"))
    a, b = tables.load_and_tag(spark, str(tmp_path / "a.csv")), tables.load_and_tag(spark, str(tmp_path / "b.parquet"))
    assert [(r.origin_row_idx, r.f1) for r in a.orderBy("origin_row_idx").collect()] == [(0, 1.5), (1, None), (2, None)]
    both, lacking = tables.concat([a, b])
    assert both.count() == 4 and lacking == [["f2"], ["f1", "n"]]
    with pytest.raises(ValueError):
        tables.kind_of("x.xlsx")
    assert tables.select_batches(["T10", "T2", "T1"], exclude=["T1"]) == ["T2", "T10"]
    numbered = tables.combine_cells([a.select("aaChanges"), b.select("aaChanges")], "i").collect()
    assert sorted(r.i for r in numbered) == [0, 1, 2, 3] and {r.aaChanges: r.i for r in numbered}["V4"] == 3
    sizes = spark.createDataFrame([("w", i, 40) for i in range(5)] + [("x", 0, 500)], "well string, ord int, bytes long")
    got = {(r.well, r.ord): r.shard for r in tables.shard_ids(sizes, "well", "ord", "bytes", 100).collect()}
    assert got == {("w", 0): 0, ("w", 1): 0, ("w", 2): 0, ("w", 3): 1, ("w", 4): 1, ("x", 0): 0}
    payload = json.dumps({"data": {"gene": {"variants": [{"variant_id": "1", "hgvsp": "p.A1V", "joint": None, "exome": {"ac": 2, "an": 9, "filters": []}, "in_silico_predictors": [{"id": "splice", "value": "0.3"}]}]}}})
    [r] = tables.api_variants(spark.createDataFrame([(payload,)], "j string"), "j", "splice").collect()
    assert (r.ac, r.an, r.filters, r.splice) == (2, 9, "PASS", "0.3")
    names = spark.createDataFrame([('[{"trait_name":"x"},{"trait_name":"not provided"},{"trait_name":"x"}]',)], "j string")
    assert names.select(tables.condition_names(F.col("j"))).first()[0] == ["x"]


def test_columns_and_dataset(spark):
    df = spark.createDataFrame([("A1A", "b", 1.0, float("nan"), 3.0), ("A2V", "b", 2.0, 5.0, float("inf"))], "meta_aa_changes string, meta_batch string, Cell_x double, Cell_y double, Nuc_z double")
    assert columns.features(df) == ["Cell_x", "Cell_y", "Nuc_z"] and columns.drop_non_finite(df).columns[-1] == "Cell_x"
    d = Dataset(df).keep_features("Cell_*").drop_features("*_y").variant_type().domain({"d": (2, 9)})
    assert [(r.meta_variant_type, r.meta_domain) for r in d.sort("meta_aa_changes").df.collect()] == [("Synonymous", None), ("Single Missense", "d")] and d.features == ["Cell_x"]
    t = spark.createDataFrame([("T10",), ("T2",)], "n string")
    assert [r.n for r in t.orderBy(columns.natural_key(F.col("n"))).collect()] == ["T2", "T10"]


def test_images(spark):
    image = np.arange(2 * 6 * 6, dtype=np.float32).reshape(2, 6, 6)
    marks = np.zeros((6, 6), int)
    marks[0:2, 0:2] = 7
    tiles = spark.createDataFrame([("w", "t", image.ravel().tolist(), marks.ravel().tolist(), 2, 6, 6)], "well string, tile string, pixels array<float>, labels array<int>, channels int, height int, width int")
    boxes = spark.createDataFrame([("w", "t", 7, 0.0, 0.0, 2.0, 2.0), ("w", "t", 8, 2.0, 2.0, 4.0, 4.0)], "well string, tile string, cell long, bbox_x1 double, bbox_y1 double, bbox_x2 double, bbox_y2 double")
    got = {r.cell: r for r in images.crops(tiles, boxes, 4).collect()}
    assert np.array(got[8].crop).reshape(2, 4, 4).tolist() == image[:, 1:5, 1:5].tolist() and sum(got[8].mask) == 0
    assert np.array(got[7].crop).reshape(2, 4, 4)[:, 1:, 1:].tolist() == image[:, :3, :3].tolist() and sum(got[7].mask) == 4

    def model():
        return lambda batch: batch.reshape(len(batch), -1).mean(axis=1, keepdims=True).repeat(3, axis=1).astype("float32")

    out = images.embedding_columns(images.embed(images.crops(tiles, boxes, 4), model, [32], 3), F.col("embedding"), 3, ["cell"])
    assert out.columns == ["cell", "emb_0000", "emb_0001", "emb_0002"] and out.count() == 2
    with pytest.raises(Exception, match="one side only"):
        images.join_cells(boxes.select("cell"), boxes.select("cell").where("cell = 7"), ["cell"]).collect()


def test_positions_and_communities(spark):
    from assayframe.operators import positions

    ring = [(a, b) for g in (0, 10) for a in range(g, g + 5) for b in range(a + 1, g + 5)] + [(4, 10)]
    got = {r.node: r.cluster for r in positions.communities(spark.createDataFrame(ring, "a long, b long")).collect()}
    assert len({got[i] for i in range(4)}) == 1 and len({got[i] for i in range(11, 15)}) == 1 and got[0] != got[12]
    runs = spark.createDataFrame([(1, "x"), (2, "x"), (2, "x"), (4, "x"), (3, "y"), (None, "x")], "p long, v string")
    assert sorted(map(tuple, positions.runs(runs, "p", "v").collect())) == [("x", 1, 2), ("x", 4, 4), ("y", 3, 3)]
    states = spark.createDataFrame([(1, "matched")] * 3 + [(2, "mismatched")], "position long, state string")
    assert positions.checked_match(states, 0.5).first().mismatch == 0.25
    with pytest.raises(Exception, match="don't fit"):
        positions.checked_match(states, 0.1).collect()


def test_calibrated_scores_and_splits(spark):
    rng = random.Random(9)
    rows = [("v", i, 1 / (1 + math.exp(-3 * (rng.gauss(0.6 if w else -0.6, 1)))), w) for i in range(200) for w in [i % 2 == 0]]
    df = spark.createDataFrame(rows, "scored_against string, k int, score double, is_wildtype boolean")
    got = score.platt(df, ["scored_against"]).collect()
    x = np.array([math.log(r.score / (1 - r.score)) for r in got])
    y, p = np.array([r.is_wildtype for r in got]), np.array([r.calibrated for r in got])
    assert abs(p.mean() - y.mean()) < 0.01 and np.corrcoef(np.argsort(np.argsort(x)), np.argsort(np.argsort(p)))[0, 1] > 0.999
    t = np.where(y, 101 / 102, 1 / 102)
    assert abs(((t - p) * x / x.std()).sum()) < 0.01
    split = score.inner_split(df.withColumn("s", F.when(F.col("k") == 7, "lone").otherwise("rest")), ["s"], ["k"])
    assert split.where("inner_test").count() == 39 and split.where("s = 'lone' and inner_test").count() == 0


def test_evidence_ranges_and_positions():
    grid = [0.0, 1.0, 2.0, 3.0, 4.0]
    ranges = annotate.evidence_ranges(grid, [-9, -9, 0, 1.1, 2.2], [-2.5, -1.2, 0, 9, 9], 8.0)
    assert sorted(ranges) == [(-2, float("-inf"), 0.0), (-1, 0.0, 1.0), (1, 3.0, 4.0), (2, 4.0, float("inf"))]


def test_zip_by_position(spark):
    a = spark.createDataFrame([("t", 3), ("t", 1), ("u", 2)], "tile string, cell int")
    b = spark.createDataFrame([("t", 1, 0.5), ("t", 0, 0.1), ("u", 0, 0.9)], "tile string, row int, area double")
    got = images.zip_by_position(a, b, ["tile"], ["cell"], ["row"]).collect()
    assert {(r.tile, r.cell, r.area) for r in got} == {("t", 1, 0.1), ("t", 3, 0.5), ("u", 2, 0.9)}
    with pytest.raises(Exception, match="unequal"):
        images.zip_by_position(a, b.where("row = 0"), ["tile"], ["cell"], ["row"]).collect()
