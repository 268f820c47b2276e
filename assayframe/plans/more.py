"""Queries on tests, reductions, compositions, sources and sampled rows, each with its SQL."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from assayframe.functions import columns, labels
from assayframe.operators import aggregate, annotate, combat, inference, matrix, normalize, pool, qc, reduce, reproduce, score
from assayframe.plans.cells import FEATURES, KEYS, WITH_CELLS, cells
from assayframe.plans.core import _ERFC, _KIND, LABEL, control, rounded
from assayframe.plans.pooled import folded, per_batch
from assayframe.sources import tables


def profiles(spark, sf):
    return aggregate.plain(cells(spark, sf), F.lit(False), FEATURES, ["mean"]).withColumnsRenamed({f"{f}_mean": f for f in FEATURES})


#: Means nearer than this share of their feature's largest may differ by the order of their sums alone.
NEAR = 1e-11


def per_batch_in_order(spark, sf):
    """``per_batch``; means that are so near that rounding ranks them are of sums in the table's order, as in its SQL, not in that of a shuffle.

    Only cells of such profiles are put in order, by a window that can spill.
    """
    keys = [LABEL, "meta_batch"]
    rows = tables.written(per_batch(spark, sf), "profiles")
    most = rows.agg(*(F.max(F.abs(f)).alias(f"most_{f}") for f in FEATURES))
    place = lambda f, i: F.floor(F.try_divide(F.col(f), F.col(f"most_{f}") * NEAR)) + i
    each = F.explode(F.array(*(F.struct(F.lit(f).alias("feature"), place(f, i).alias("place")) for f in FEATURES for i in (0, 1))))
    long = rows.join(F.broadcast(most)).select(*keys, each.alias("p")).select(*keys, "p.*")  # a row
    met = long.groupBy("feature", "place").count().where("place is not null and count > 1")
    near = long.join(met, ["feature", "place"], "left_semi").select(*(F.col(k).alias(f"near_{k}") for k in keys)).distinct()
    same = lambda prefix: [F.col(k).eqNullSafe(F.col(f"{prefix}_{k}")) for k in keys]
    upto = Window.partitionBy(*keys).orderBy("meta_file", "meta_row").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    own = cells(spark, sf, placed=True).join(near, same("near"), "left_semi").select(*keys, "meta_file", "meta_row", *(F.avg(f).over(upto).alias(f) for f in FEATURES))
    last = own.groupBy(*keys).agg(*(F.max_by(f, F.struct("meta_file", "meta_row")).alias(f"last_{f}") for f in FEATURES)).withColumnsRenamed({k: f"own_{k}" for k in keys})
    return rows.join(last, same("own"), "left").select(*keys, "meta_n_cells", *(F.coalesce(f"last_{f}", f).alias(f) for f in FEATURES))


def correlation_tests(spark, sf):
    """Both correlations of pairs of features over batches' profiles, their p, and the sides of the identity line."""
    rows, out = tables.written(per_batch_in_order(spark, sf), "in-order"), None
    for x, y in (("quantity", "price"), ("discount", "tax")):
        for metric in ("pearson", "spearman"):
            one = inference.correlation_test(rows, x, y, metric).withColumns({"x": F.lit(x), "metric": F.lit(metric)})
            out = one if out is None else out.unionByName(one)
    return rounded(out, "value", "neg_log_p", digits=4)


def welch_tests(spark, sf):
    rows = inference.label_tests(cells(spark, sf), control(), FEATURES, "welch", "mean")
    return rounded(rows, "mean_diff", "WelchNegLogP", digits=4)


def rank_tests(spark, sf):
    rows = inference.label_tests(cells(spark, sf), control(), FEATURES, "mannwhitney", "median")
    return rounded(rows, "median_diff", "MWUnegLogP", digits=3)


def top_features(spark, sf):
    """The two features that stand out most, of those of some effect."""
    rows = inference.label_tests(cells(spark, sf), F.col(LABEL) == "WT", FEATURES, "welch", "cohens_d")
    return rounded(inference.top_points(rows, "cohens_d", "WelchNegLogP", 2, threshold=0.0, by_effect=True).select("feature", "cohens_d", "n_positive"), "cohens_d", digits=5)


def impact_by_metric(spark, sf):
    """Impact scores of the profiles by four metrics."""
    rows = normalize.zscore(profiles(spark, sf), control(), FEATURES)
    for metric in ("cosine_distance", "euclidean", "cityblock", "pearson"):
        rows = reduce.impact_score(rows, control(), FEATURES, f"by_{metric}", metric)
    names = [c for c in rows.columns if c.startswith("by_")]
    return rounded(rows.select(LABEL, *names), *names, digits=4)


def component_variances(spark, sf):
    """Largest and summed share of the components of standardised features, and what the variances of the scores say."""
    rows = normalize.zscore(per_batch(spark, sf), F.lit(True), FEATURES[:2])
    scores, _, shares = reduce.components(rows, FEATURES[:2])
    out = scores.agg(*(F.var_samp(f"pc_{i}").alias(f"v{i}") for i in range(2)))
    return rounded(out.select(F.col("v0").alias("first"), F.col("v1").alias("second"), F.lit(float(shares[0])).alias("share")), "first", "second", "share", digits=4)


def two_profiles(spark, sf):
    """Standardised profiles of two features: their components lie on the diagonals."""
    return normalize.zscore(profiles(spark, sf).select(LABEL, *FEATURES[:2]), F.lit(True), FEATURES[:2])


def component_impact(spark, sf):
    """Distances to the controls on the components that hold half and all of the variance."""
    out = reduce.impact_scores(two_profiles(spark, sf), control(), FEATURES[:2], (0.5, 1.0), "euclidean", "score_")
    return rounded(out.select(LABEL, F.col("`score_0.5`").alias("half"), F.col("`score_1.0`").alias("whole")), "half", "whole", digits=4)


def reduced_profiles(spark, sf):
    """Leading components of the profiles, but for their signs, and the impact score on them."""
    out = reduce.reduced(two_profiles(spark, sf), LABEL, control(), FEATURES[:2], 1.0)
    return rounded(out.select(LABEL, "meta_is_control", F.abs("meta_pc_1").alias("first"), F.abs("meta_pc_2").alias("second"), "meta_impact_score"), "first", "second", "meta_impact_score", digits=4)


def blocked_statistics(spark, sf):
    """Statistics without the blocked pairs of feature and method."""
    out = aggregate.aggregate(cells(spark, sf), control(), FEATURES, ["mean", "std", "KS"], blocked=["price_mean", "tax_mean", "tax_std", "tax_KS", "quantity_KS"])
    return rounded(out, *[c for c in out.columns if c != LABEL], digits=4, nudge=1e-7)


def distinguishable(spark, sf):
    """Profiles with batch-corrected medians of a score."""
    return rounded(pool.distinguishability(profiles(spark, sf).select(LABEL), per_batch(spark, sf), LABEL, "price", "meta_batch", control()), "meta_distinguishability_score", digits=3)


def corrected_scores(spark, sf):
    """One score corrected for location and scale of batches, all labels being in all batches: ComBat's closed form without priors."""
    out = combat.combat_scores(per_batch(spark, sf).where(F.col("meta_batch").isin("1-URGENT", "2-HIGH")), ["price"], LABEL, mean_only=True)
    return rounded(out.select(LABEL, "meta_batch", "price_corrected"), "price_corrected", digits=3)


def loaded_cells(spark, sf):
    """Cells that passed, made again from their keys and the fitted normaliser; their batch comes from the keys."""
    base = cells(spark, sf)
    kept = qc.passing(base, 1, 1, 2).select(*KEYS[:4], LABEL, F.lower("meta_batch").alias("meta_batch"))
    keys, fitted = reproduce.filter_and_fit(base, kept, KEYS[:4], control(), FEATURES)
    rows = reproduce.load_cells(base, keys, fitted, KEYS[:4])
    return rounded(rows.groupBy(LABEL, "meta_batch", "meta_is_control").agg(F.count("*").alias("n"), *(F.avg(f).alias(f) for f in FEATURES)), *FEATURES, digits=4)


def batch_votes(spark, sf):
    """Votes of batches on features, a batch that doesn't report counting against."""
    lists = per_batch(spark, sf).groupBy("meta_batch").agg(*(F.avg(f).alias(f) for f in FEATURES))
    ok = lambda f: F.pmod(F.floor(F.col(f) * 1000), F.lit(3)) != 0
    told = lambda f: F.pmod(F.floor(F.col(f) * 1000), F.lit(5)) != 0
    long = lists.select("meta_batch", F.explode(F.array(*(F.struct(F.lit(f).alias("feature"), ok(f).alias("feature_ok"), told(f).alias("told")) for f in FEATURES))).alias("p")).select("meta_batch", "p.*").where("told").drop("told")
    return reproduce.vote_table(long, "meta_batch", missing="fail")


def run_results(spark, sf):
    """The table of a scoring run: one row a variant in the fixed schema, lists of folds as their number."""
    rows, features = folded(spark, sf), ["quantity", "price"]
    results, by_cell = score.result_tables(score.cross_validated(rows, features, 3), score.cross_validated_metrics(rows, features, 3))
    told = by_cell.groupBy(F.col("meta_variant_scored_against").alias(LABEL)).agg(F.count("*").alias("n_scores"), F.count_distinct("meta_batch").alias("n_batches"))
    return results.select(LABEL, F.size("auroc_folds").alias("n_folds"), "meta_n_barcodes", "meta_n_cells").join(told, LABEL)


def aligned_matrix(spark, sf):
    """Distances of profiles written, read back, aligned to some names, as a wide table."""
    rows = matrix.between_rows(profiles(spark, sf), LABEL, F.array(*FEATURES), "cityblock")
    path = tables.shared_path(spark, "distances")
    matrix.save(rows, path, metric="cityblock")
    found, told = matrix.load(spark, path)
    names = ["WT", "A14V", "A6A"]
    out = matrix.wide(matrix.align(found, names).select("a", "b", "value"), names, 0.0)
    return rounded(out.withColumn("metric", F.lit(told["metric"])), *names, digits=3)


def clinical_labels(spark, sf):
    """Part records' calls over the classes of labels, and the worst call of each position."""
    call = F.element_at(F.array(*map(F.lit, ("Pathogenic", "Uncertain significance", "Benign", "not provided"))), F.pmod("p_size", F.lit(4)) + 1)
    parts = spark.read.parquet(f"{sf}/part.parquet").select(F.concat(F.lit("A"), F.expr("p_partkey % 40"), F.lit("V")).alias("label"), call.alias("call"))
    return parts.select(annotate.clinical_label("call", labels.variant_type("label")).alias("kind"), F.col("call")).groupBy("kind", "call").agg(F.count("*").alias("n"))


def site_severities(spark, sf):
    call = F.element_at(F.array(*map(F.lit, ("benign", "vus", "pathogenic", "other"))), F.pmod("p_size", F.lit(4)) + 1)
    parts = spark.read.parquet(f"{sf}/part.parquet").select(F.expr("p_partkey % 97").alias("residue"), call.alias("severity"))
    return annotate.site_severity(parts, "residue", "severity")


def residues(spark, sf):
    """Cells of two classes at the residues that their positions stand for."""
    rows = cells(spark, sf).select(labels.position(LABEL).alias("position"), labels.variant_type(LABEL).alias("variant_type"))
    return columns.with_residue(rows, "position", 24, ["Synonymous", "Nonsense"]).groupBy("residue", "variant_type").agg(F.count("*").alias("n"))


def viewer_table(spark, sf):
    return rounded(pool.viewer_scores(per_batch(spark, sf), LABEL, "tax", "meta_batch", control()), "tax", digits=5)


def group_direction(spark, sf):
    """Whether scores of one class are higher, and each class's mean and size."""
    rows = cells(spark, sf).select(F.when(labels.is_control(LABEL), "B/LB").when(F.col(LABEL).contains("X"), "P/LP").alias("group"), "price")
    return rounded(annotate.group_check(rows, "group", "price").withColumn("direction", F.lit(annotate.direction(rows, "group", "price"))), "mean", digits=3)


def shares_of_conditions(spark, sf):
    rows = cells(spark, sf)
    out = pool.cluster_shares(rows, "meta_batch", {"dear": F.col("price") > 50_000, "many": F.col("quantity") >= 40})
    return rounded(out, "share")


QUERIES = {f.__name__: f for f in (correlation_tests, welch_tests, rank_tests, top_features, impact_by_metric, component_variances, component_impact, reduced_profiles, blocked_statistics, distinguishable, corrected_scores, loaded_cells, batch_votes, run_results, aligned_matrix, clinical_labels, site_severities, residues, viewer_table, group_direction, shares_of_conditions)}

_each = lambda text, sep=", ", names=FEATURES: sep.join(text.replace("@", f) for f in names)
_PB = f"{WITH_CELLS}, pb AS (SELECT meta_aa_changes, meta_batch, count(*) AS meta_n_cells, {_each('avg(@) AS @')} FROM cells GROUP BY 1, 2)"
_LONG = "long AS (" + " UNION ALL ".join(f"SELECT meta_aa_changes, control, '{f}' AS feature, {f} AS value FROM marked" for f in FEATURES) + ")"
_PROFILES = f"{WITH_CELLS}, p AS (SELECT meta_aa_changes, meta_aa_changes LIKE 'A%A' AS c, {_each('avg(@) AS @')} FROM cells GROUP BY 1)"


def _student(t: str, nu: str) -> str:
    """-log10 of Student's two-sided tail, as an integral over the angle whose tangent is t / sqrt(nu)."""
    start, width = f"atan(abs({t}) / sqrt({nu}))", f"least(pi() / 2 - atan(abs({t}) / sqrt({nu})), 40 / ({nu} * greatest(abs({t}) / sqrt({nu}), 1 / sqrt({nu}))))"
    value = f"exp(({nu} - 1) * (ln(greatest(cos({start} + {width} * i / 2000), 1e-300)) - ln(cos({start}))))"
    total = f"list_sum(list_transform(range(0, 2001), lambda i: CASE WHEN i = 0 OR i = 2000 THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END * {value}))"
    return f"greatest(0, -(ln(2) + lgamma(({nu} + 1) / 2.0) - lgamma({nu} / 2.0) - ln(pi()) / 2 + ({nu} - 1) * ln(cos({start})) + ln({width} / 6000 * {total})) / ln(10))"


def _test_rows(group: str) -> str:
    return f"""s AS (SELECT feature, count(*) FILTER ({group}) AS n1, count(*) FILTER (NOT {group}) AS n2, avg(value) FILTER ({group}) AS m1, avg(value) FILTER (NOT {group}) AS m2,
        var_samp(value) FILTER ({group}) AS v1, var_samp(value) FILTER (NOT {group}) AS v2, median(value) FILTER ({group}) AS d1, median(value) FILTER (NOT {group}) AS d2 FROM long GROUP BY 1)"""


_RANKED = ", ".join(f"rank() OVER (ORDER BY {f}) + (count(*) OVER (PARTITION BY {f}) - 1) / 2.0 AS {f}" for f in FEATURES)
_TWO = FEATURES[:2]
_DIAGONAL = f"""{_PROFILES}, s AS (SELECT {_each('avg(@) AS m_@, stddev_samp(@) AS s_@', names=_TWO)}, corr({_TWO[0]}, {_TWO[1]}) AS r FROM p), z AS (SELECT meta_aa_changes, c, {_each('(@ - m_@) / s_@ AS @', names=_TWO)}, r FROM p, s),
    d AS (SELECT meta_aa_changes, c, ({_TWO[0]} + sign(r) * {_TWO[1]}) / sqrt(2) AS a, ({_TWO[0]} - sign(r) * {_TWO[1]}) / sqrt(2) AS b FROM z), m AS (SELECT median(a) AS ma, median(b) AS mb FROM d WHERE c)"""
_ZP = f"{_PROFILES}, s AS (SELECT {_each('avg(@) AS m_@, stddev_samp(@) AS s_@')} FROM p WHERE c), z AS (SELECT meta_aa_changes, c, {_each('(@ - m_@) / s_@ AS @')} FROM p, s), m AS (SELECT {_each('median(@) AS c_@')} FROM z WHERE c)"
_MEAN = lambda prefix: "((" + " + ".join(prefix + f for f in FEATURES) + f") / {len(FEATURES)})"
_FIXED = f"""{_PB}, s AS (SELECT meta_batch, {_each('avg(@) AS m_@, stddev_samp(@) AS s_@')} FROM pb WHERE meta_aa_changes LIKE 'A%A' GROUP BY 1), t AS (SELECT {_each('median(m_@) AS mm_@, median(s_@) AS ms_@')} FROM s),
    f AS (SELECT meta_aa_changes, {_each('(@ - m_@) / s_@ * ms_@ + mm_@ AS @')} FROM pb JOIN s USING (meta_batch), t)"""
_ON = " AND ".join(f"k.{c} = x.{c}" for c in KEYS[:4])

ORACLE_SQL = {
    "correlation_tests": f"{_PB}, ranked AS (SELECT {_RANKED} FROM pb), t AS (" + " UNION ALL ".join(
        f"SELECT '{x}' AS x, '{m}' AS metric, count(*) AS n, corr({x}, {y}) AS r FROM {source}" for x, y in (("quantity", "price"), ("discount", "tax")) for m, source in (("pearson", "pb"), ("spearman", "ranked"))
    ) + f"""), u AS (SELECT *, r * sqrt((n - 2) / (1 - r * r)) AS t, CAST(n - 2 AS DOUBLE) AS nu FROM t),
        o AS (SELECT 'quantity' AS x, count(*) FILTER (price > quantity) AS above, count(*) FILTER (price < quantity) AS below FROM pb UNION ALL SELECT 'discount', count(*) FILTER (tax > discount), count(*) FILTER (tax < discount) FROM pb)
        SELECT round(r, 4) AS value, round({_student('t', 'nu')}, 4) AS neg_log_p, n, above, below, u.x, metric FROM u JOIN o ON o.x = u.x""",
    "welch_tests": f"""{WITH_CELLS}, {_LONG}, {_test_rows('control')}, w AS (SELECT *, (m1 - m2) / sqrt(v1 / n1 + v2 / n2) AS t, pow(v1 / n1 + v2 / n2, 2) / (pow(v1 / n1, 2) / (n1 - 1) + pow(v2 / n2, 2) / (n2 - 1)) AS nu FROM s)
        SELECT feature, n1 AS n_positive, n2 AS n_negative, round(m1 - m2, 4) AS mean_diff, round({_student('t', 'nu')}, 4) AS "WelchNegLogP" FROM w""",
    "rank_tests": f"""{WITH_CELLS}, {_LONG}, {_test_rows('control')}, k AS (SELECT feature, value, count(*) FILTER (control) AS c, count(*) FILTER (NOT control) AS r FROM long GROUP BY 1, 2),
        u AS (SELECT *, sum(r) OVER (PARTITION BY feature ORDER BY value) - r AS below FROM k), g AS (SELECT feature, sum(c * (below + r / 2.0)) AS u, sum(pow(CAST(c + r AS DOUBLE), 3) - (c + r)) AS ties FROM u GROUP BY 1),
        x AS (SELECT s.*, abs(u - n1 * n2 / 2.0) / sqrt(n1 * n2 / 12.0 * (n1 + n2 + 1 - ties / (CAST(n1 + n2 AS DOUBLE) * (n1 + n2 - 1)))) / sqrt(2) AS x FROM s JOIN g USING (feature)), y AS (SELECT *, 1 / (1 + x / 2) AS t FROM x)
        SELECT feature, n1 AS n_positive, n2 AS n_negative, round(d1 - d2, 3) AS median_diff, round(greatest(0, -(ln(t) - x * x + {_ERFC}) / ln(10)), 3) AS "MWUnegLogP" FROM y""",
    "top_features": f"""{WITH_CELLS}, {_LONG}, {_test_rows("(meta_aa_changes = 'WT')")}, d AS (SELECT feature, n1, (m1 - m2) / sqrt(((n1 - 1) * v1 + (n2 - 1) * v2) / (n1 + n2 - 2)) AS d FROM s)
        SELECT feature, round(d, 5) AS cohens_d, n1 AS n_positive FROM d ORDER BY abs(d) DESC LIMIT 2""",
    "impact_by_metric": f"""{_ZP}, r AS (SELECT meta_aa_changes, {_each('@ AS x_@, c_@ AS y_@')}, {_MEAN('')} AS mx, {_MEAN('c_')} AS my FROM z, m)
        SELECT meta_aa_changes, round((1 - ({_each('x_@ * y_@', ' + ')}) / sqrt(({_each('x_@ * x_@', ' + ')}) * ({_each('y_@ * y_@', ' + ')}))) / 2, 4) AS by_cosine_distance,
            round(sqrt({_each('pow(x_@ - y_@, 2)', ' + ')}), 4) AS by_euclidean, round({_each('abs(x_@ - y_@)', ' + ')}, 4) AS by_cityblock,
            round((1 - ({_each('(x_@ - mx) * (y_@ - my)', ' + ')}) / sqrt(({_each('pow(x_@ - mx, 2)', ' + ')}) * ({_each('pow(y_@ - my, 2)', ' + ')}))) / 2, 4) AS by_pearson FROM r""",
    "component_variances": f"{_PB}, c AS (SELECT abs(corr({_TWO[0]}, {_TWO[1]})) AS r FROM pb) SELECT round(1 + r, 4) AS first, round(1 - r, 4) AS second, round((1 + r) / 2, 4) AS share FROM c",
    "component_impact": f"{_DIAGONAL} SELECT meta_aa_changes, round(abs(a - ma), 4) AS half, round(sqrt(pow(a - ma, 2) + pow(b - mb, 2)), 4) AS whole FROM d, m",
    "reduced_profiles": f"{_DIAGONAL} SELECT meta_aa_changes, c AS meta_is_control, round(abs(a), 4) AS first, round(abs(b), 4) AS second, round((1 - (a * ma + b * mb) / sqrt((a * a + b * b) * (ma * ma + mb * mb))) / 2, 4) AS meta_impact_score FROM d, m",
    "blocked_statistics": f"""{WITH_CELLS}, {_LONG}, g AS (SELECT meta_aa_changes, feature, value, count(*) AS c FROM long WHERE NOT control AND feature IN ('price', 'discount') GROUP BY ALL), r AS (SELECT feature, value, count(*) AS r FROM long WHERE control GROUP BY ALL),
        pool AS (SELECT meta_aa_changes, feature, value, sum(c) AS c, sum(r) AS r FROM (SELECT meta_aa_changes, feature, value, c, 0 AS r FROM g UNION ALL SELECT meta_aa_changes, feature, value, 0, r FROM (SELECT DISTINCT meta_aa_changes, feature FROM g) AS l JOIN r USING (feature)) GROUP BY ALL),
        cum AS (SELECT *, sum(c) OVER w / CAST(sum(c) OVER a AS DOUBLE) - sum(r) OVER w / CAST(sum(r) OVER a AS DOUBLE) AS d FROM pool WINDOW w AS (PARTITION BY meta_aa_changes, feature ORDER BY value), a AS (PARTITION BY meta_aa_changes, feature)),
        k AS (SELECT meta_aa_changes, max(abs(d)) FILTER (feature = 'price') AS pk, max(abs(d)) FILTER (feature = 'discount') AS dk FROM cum GROUP BY 1)
        SELECT meta_aa_changes, {', '.join(f'round({e} + 1e-7, 4) AS {n}' for n, e in (('quantity_mean', 'avg(quantity)'), ('discount_mean', 'avg(discount)'), ('quantity_std', 'stddev_samp(quantity)'), ('price_std', 'stddev_samp(price)'), ('discount_std', 'stddev_samp(discount)')))},
            round(max(pk) + 1e-7, 4) AS "price_KS", round(max(dk) + 1e-7, 4) AS "discount_KS" FROM marked JOIN k USING (meta_aa_changes) WHERE NOT control GROUP BY 1""",
    "distinguishable": f"{_FIXED} SELECT meta_aa_changes, round(median(price), 3) AS meta_distinguishability_score FROM f GROUP BY 1",
    "corrected_scores": f"""{_PB}, b AS (SELECT *, count(*) OVER (PARTITION BY meta_aa_changes) AS k FROM pb WHERE meta_batch IN ('1-URGENT', '2-HIGH')), m AS (SELECT meta_batch, avg(price) AS m FROM b WHERE k = 2 GROUP BY 1), g AS (SELECT avg(price) AS g FROM b WHERE k = 2)
        SELECT meta_aa_changes, b.meta_batch, CASE WHEN k = 2 THEN round(price - m + g, 3) END AS price_corrected FROM b JOIN m ON m.meta_batch = b.meta_batch, g""",
    "loaded_cells": f"""{WITH_CELLS}, near AS (SELECT * FROM marked WHERE meta_edit_distance <= 1), lab AS (SELECT meta_aa_changes FROM near GROUP BY 1 HAVING count(DISTINCT meta_barcode) >= 2),
        k AS (SELECT {', '.join(KEYS[:4])}, meta_aa_changes, lower(meta_batch) AS meta_batch, control FROM near SEMI JOIN lab USING (meta_aa_changes)),
        j AS (SELECT k.meta_aa_changes, k.meta_batch, k.control, {_each('x.@')} FROM k JOIN cells AS x ON {_ON}), s AS (SELECT {_each('avg(@) AS m_@, stddev_samp(@) AS s_@')} FROM j WHERE control)
        SELECT meta_aa_changes, meta_batch, control AS meta_is_control, count(*) AS n, {_each('round(avg((@ - m_@) / s_@), 4) AS @')} FROM j, s GROUP BY 1, 2, 3""",
    "batch_votes": f"""{_PB}, b AS (SELECT meta_batch, {_each('avg(@) AS @')} FROM pb GROUP BY 1), l AS ({' UNION ALL '.join(f"SELECT meta_batch, '{f}' AS feature, CAST(floor({f} * 1000) AS BIGINT) AS v FROM b" for f in FEATURES)}), t AS (SELECT * FROM l WHERE v % 5 <> 0)
        SELECT feature, count(DISTINCT meta_batch) AS n_batches, count(*) FILTER (v % 3 <> 0) AS n_ok, count(*) FILTER (v % 3 <> 0) >= (SELECT count(DISTINCT meta_batch) FROM t) AS feature_ok FROM t GROUP BY 1""",
    "run_results": f"""{WITH_CELLS}, w AS (SELECT count(*) AS n, count(DISTINCT meta_batch) AS b FROM cells WHERE meta_aa_changes = 'WT')
        SELECT meta_aa_changes, CAST(3 AS INT) AS n_folds, count(DISTINCT meta_barcode) AS meta_n_barcodes, count(*) AS meta_n_cells, count(*) + max(w.n) AS n_scores, max(w.b) AS n_batches FROM cells, w WHERE meta_aa_changes <> 'WT' GROUP BY 1""",
    "aligned_matrix": f"""{_PROFILES}, q AS (SELECT * FROM p WHERE meta_aa_changes IN ('WT', 'A14V', 'A6A')), d AS (SELECT x.meta_aa_changes AS a, y.meta_aa_changes AS b, {_each('abs(x.@ - y.@)', ' + ')} AS v FROM q AS x, q AS y)
        SELECT a, {', '.join(f"round(max(v) FILTER (b = '{n}'), 3) AS \"{n}\"" for n in ('WT', 'A14V', 'A6A'))}, 'cityblock' AS metric FROM d GROUP BY 1""",
    "clinical_labels": """WITH k AS (SELECT CASE p_size % 4 WHEN 0 THEN 'Pathogenic' WHEN 1 THEN 'Uncertain significance' WHEN 2 THEN 'Benign' ELSE 'not provided' END AS call FROM part)
        SELECT CASE WHEN call IN ('Pathogenic', 'Uncertain significance') THEN call ELSE 'Single Missense' END AS kind, call, count(*) AS n FROM k GROUP BY 1, 2""",
    "site_severities": "WITH r AS (SELECT p_partkey % 97 AS residue, min(CASE p_size % 4 WHEN 0 THEN 3 WHEN 1 THEN 2 WHEN 2 THEN 1 END) AS k FROM part GROUP BY 1) SELECT residue, CASE k WHEN 1 THEN 'pathogenic' WHEN 2 THEN 'vus' ELSE 'benign' END AS severity FROM r WHERE k IS NOT NULL",
    "residues": f"""{WITH_CELLS}, k AS (SELECT CAST(regexp_extract(meta_aa_changes, '^.(\\d+)', 1) AS BIGINT) + 24 AS residue, CASE WHEN meta_aa_changes LIKE 'A%A' THEN 'Synonymous' ELSE 'Nonsense' END AS variant_type FROM cells WHERE meta_aa_changes LIKE 'A%A' OR meta_aa_changes = 'A38X')
        SELECT residue, variant_type, count(*) AS n FROM k GROUP BY 1, 2""",
    "viewer_table": f"""{_FIXED}, v AS (SELECT meta_aa_changes, split_part(meta_aa_changes, ':', 1) AS l, median(tax) AS tax FROM f GROUP BY 1)
        SELECT meta_aa_changes, round(tax, 5) AS tax, {_KIND} AS variant_type, CAST(nullif(regexp_extract(l, '^.(\\d+)', 1), '') AS BIGINT) AS position, CASE WHEN regexp_matches(meta_aa_changes, '^[A-Z]\\d+[A-Z]$') THEN l[1] END AS wildtype FROM v""",
    "group_direction": f"""{WITH_CELLS}, g AS (SELECT CASE WHEN control THEN 'B/LB' ELSE 'P/LP' END AS grp, count(*) AS n, avg(price) AS m FROM marked WHERE control OR meta_aa_changes = 'A38X' GROUP BY 1)
        SELECT grp AS "group", n, round(m, 3) AS mean, n >= 10 AS reliable, CAST((SELECT sign(max(m) FILTER (grp = 'P/LP') - max(m) FILTER (grp = 'B/LB')) FROM g) AS INT) AS direction FROM g""",
    "shares_of_conditions": f"""{WITH_CELLS}, k AS (SELECT meta_batch, 'dear' AS level, count(*) FILTER (price > 50000) AS k FROM cells GROUP BY 1 UNION ALL SELECT meta_batch, 'many', count(*) FILTER (quantity >= 40) FROM cells GROUP BY 1)
        SELECT meta_batch, level, k, round(k / CAST(sum(k) OVER (PARTITION BY level) AS DOUBLE), 6) AS share FROM k""",
}
