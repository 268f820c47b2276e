"""Queries on cells: labels, quality control, normalisation and aggregation."""

from __future__ import annotations

from pyspark.sql import functions as F

from assayframe.functions import labels
from assayframe.operators import aggregate, normalize, qc
from assayframe.plans.cells import CELLS_SQL, FEATURES, KEYS, WITH_CELLS, cells


def control():
    """Synonymous labels, the controls of every query here."""
    return labels.is_control("meta_aa_changes")


LABEL = "meta_aa_changes"


def rounded(df, *names, digits=6, nudge=0.0):
    """Sums in another order differ in the last digits; both engines round them away, after a ``nudge`` off the edges that means of decimals lie on."""
    return df.select(*(F.round(F.col(c) + nudge if nudge else c, digits).alias(c) if c in names else F.col(c) for c in df.columns))


def label_annotation(spark, sf):
    rows = cells(spark, sf).groupBy(LABEL).agg(F.count("*").alias("n_cells"))
    wt, place, mut = labels.substitution(LABEL)
    at = labels.position(LABEL)
    return rows.select(
        LABEL, "n_cells", labels.variant_type(LABEL).alias("variant_type"), control().alias("is_control"), labels.label_tag(LABEL).alias("tag"), at.alias("position"),
        wt.alias("wt"), place.alias("site"), mut.alias("mut"), labels.substitution_key(LABEL).alias("key"),
        labels.region(at, {"first": (1, 12), "second": (10, 25)}).alias("region"), labels.tiles(at, [("t1", 5, 20), ("t2", 15, 30)], several=True).alias("tiles"),
    )


def qc_cells(spark, sf):
    kept = qc.passing(cells(spark, sf), max_distance=1, min_cells=120, min_barcodes=3)
    return kept.groupBy(LABEL, "meta_batch").agg(F.count("*").alias("n_cells"), F.count_distinct("meta_barcode").alias("n_barcodes"))


def barcode_report(spark, sf):
    return qc.barcode_counts(cells(spark, sf), 200)


def variant_report(spark, sf):
    return qc.barcodes_per_variant(cells(spark, sf), 8)


def select_top(spark, sf):
    kept = qc.select_variants(cells(spark, sf), 10, ["Single Missense"])
    return kept.groupBy(LABEL).agg(F.count("*").alias("n_cells"))


def min_cells(spark, sf):
    return qc.min_cells_per_variant(cells(spark, sf), 1480).groupBy(LABEL).agg(F.count("*").alias("n_cells"))


def control_sample(spark, sf):
    kept = qc.downsample_control(cells(spark, sf), control(), KEYS, frac=0.25, seed=3)
    return kept.groupBy(control().alias("is_control")).agg(F.count("*").alias("n_cells"))


def pseudo_variants(spark, sf):
    rows = qc.pseudo_variants(cells(spark, sf), 0.5, ["Synonymous"], KEYS, seed=3)
    return rows.groupBy(LABEL).agg(F.count("*").alias("n_cells"))


def wildtype_sample(spark, sf):
    rows = qc.downsample_wildtype(cells(spark, sf), KEYS, seed=3)
    return rows.groupBy(LABEL, "meta_barcode").agg(F.count("*").alias("n_cells"))


def label_metadata(spark, sf):
    rows = qc.label_metadata(cells(spark, sf), ["meta_batch", "meta_barcode"])
    listed = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws("=", s["value"], s["count"].cast("string"))), ",")
    return rows.select(LABEL, "meta_n_cells", "meta_n_batch", "meta_n_barcode", listed("meta_batch_counts").alias("batches"), listed("meta_barcode_counts").alias("barcodes"))


def control_zscore(spark, sf):
    rows = normalize.zscore(cells(spark, sf), control(), FEATURES)
    return rounded(rows.groupBy(LABEL).agg(*(F.avg(f).alias(f) for f in FEATURES)), *FEATURES)


def batch_zscore(spark, sf):
    rows = normalize.zscore(cells(spark, sf), control(), FEATURES, by=["meta_batch"])
    return rounded(rows.groupBy(LABEL, "meta_batch").agg(*(F.avg(f).alias(f) for f in FEATURES)), *FEATURES)


def score_correction(spark, sf):
    per_batch = cells(spark, sf).groupBy(LABEL, "meta_batch").agg(F.avg("price").alias("score"))
    return rounded(normalize.correct_scores(per_batch, ["score"], "meta_batch", control(), rescale=True), "score", "score_corrected", digits=4)


def plain_statistics(spark, sf):
    methods = ["mean", "median", "std", "MAD"]
    names = [f"{f}_{m}" for m in methods for f in FEATURES]
    return rounded(aggregate.aggregate(cells(spark, sf), control(), FEATURES, methods), *names, digits=5, nudge=1e-8)


COMPARED = ["KS", "signedKS", "AUROC", "KSnegLogP", "AUROCnegLogP"]


def distribution_statistics(spark, sf):
    rows = aggregate.against_control(cells(spark, sf), control(), FEATURES, COMPARED)
    return rounded(rows, *COMPARED, digits=4)


def quantile_correlation(spark, sf):
    rows = aggregate.against_control(cells(spark, sf), control(), FEATURES, ["QQ"])
    return rounded(rows, "QQ", digits=5)


def variant_profile(spark, sf):
    """Scan, labels, quality control, z-score, statistics and impact score in one plan."""
    kept = qc.passing(cells(spark, sf), max_distance=1, min_cells=1, min_barcodes=3)
    scored = normalize.zscore(kept, control(), FEATURES)
    # every row counts as a variant here, controls included, so that the impact score has its reference
    profile = aggregate.plain(scored, F.lit(False), FEATURES, ["mean", "median"])
    names = [f"{f}_{m}" for m in ("mean", "median") for f in FEATURES]
    return rounded(aggregate.impact_score(profile, control(), [f"{f}_mean" for f in FEATURES]), *names, "impact_score", digits=5)


QUERIES = {f.__name__: f for f in (label_annotation, qc_cells, barcode_report, variant_report, select_top, min_cells, control_sample, pseudo_variants, wildtype_sample, label_metadata, control_zscore, batch_zscore, score_correction, plain_statistics, distribution_statistics, quantile_correlation, variant_profile)}

_each = lambda text, sep=", ": sep.join(text.replace("@", f) for f in FEATURES)
_KIND = """CASE WHEN l LIKE '%fs%' THEN 'Frameshift' WHEN l LIKE '%-' THEN '3nt Deletion' WHEN l LIKE '%X%' THEN 'Nonsense' WHEN l = 'WT' THEN 'WT'
    WHEN l[1] = l[length(l)] THEN 'Synonymous' ELSE 'Single Missense' END"""
_LONG = "long AS (" + " UNION ALL ".join(f"SELECT meta_aa_changes, control, '{f}' AS feature, {f} AS value FROM marked" for f in FEATURES) + ")"
_QC = """near AS (SELECT * FROM marked WHERE meta_edit_distance <= 1),
    bc AS (SELECT meta_barcode FROM near GROUP BY 1 HAVING count(*) >= @cells), kept AS (SELECT * FROM near SEMI JOIN bc USING (meta_barcode)),
    lab AS (SELECT meta_aa_changes FROM kept GROUP BY 1 HAVING count(DISTINCT meta_barcode) >= 3), ok AS (SELECT * FROM kept SEMI JOIN lab USING (meta_aa_changes))"""
_ERFC = "-1.26551223+t*(1.00002368+t*(0.37409196+t*(0.09678418+t*(-0.18628806+t*(0.27886807+t*(-1.13520398+t*(1.48851587+t*(-0.82215223+t*0.17087277))))))))"

ORACLE_SQL = {
    "label_annotation": f"""WITH c AS ({CELLS_SQL}), g AS (SELECT meta_aa_changes, count(*) AS n_cells FROM c GROUP BY 1),
        p AS (SELECT *, split_part(meta_aa_changes, ':', 1) AS l, meta_aa_changes LIKE '%:%' AS tagged,
            CAST(nullif(regexp_extract(meta_aa_changes, '^.(\\d+)', 1), '') AS BIGINT) AS position,
            regexp_matches(meta_aa_changes, '^[A-Z]\\d+[A-Z]$') AS plain FROM g)
        SELECT meta_aa_changes, n_cells, {_KIND} AS variant_type, ({_KIND}) = 'Synonymous' AND NOT tagged AS is_control,
            CASE WHEN tagged THEN split_part(meta_aa_changes, ':', 2) END AS tag, position,
            CASE WHEN plain THEN meta_aa_changes[1] END AS wt, CASE WHEN plain THEN position END AS site, CASE WHEN plain THEN meta_aa_changes[length(meta_aa_changes)] END AS mut,
            CASE WHEN plain THEN regexp_replace(meta_aa_changes, 'X$', '*') END AS key,
            CASE WHEN position BETWEEN 1 AND 12 THEN 'first' WHEN position BETWEEN 10 AND 25 THEN 'second' END AS region,
            CASE WHEN position BETWEEN 15 AND 20 THEN 't1,t2' WHEN position BETWEEN 5 AND 20 THEN 't1' WHEN position BETWEEN 15 AND 30 THEN 't2' END AS tiles FROM p""",
    "qc_cells": f"{WITH_CELLS}, {_QC.replace('@cells', '120')} SELECT meta_aa_changes, meta_batch, count(*) AS n_cells, count(DISTINCT meta_barcode) AS n_barcodes FROM ok GROUP BY 1, 2",
    "barcode_report": f"{WITH_CELLS} SELECT meta_barcode, count(*) AS n_cells, min(meta_aa_changes) AS meta_aa_changes, CASE WHEN count(*) >= 200 THEN count(*) END AS barcode_ok FROM cells GROUP BY 1",
    "variant_report": f"{WITH_CELLS} SELECT meta_aa_changes, count(DISTINCT meta_barcode) AS n_barcodes, count(DISTINCT meta_barcode) >= 8 AS variant_ok FROM cells GROUP BY 1",
    "select_top": f"""{WITH_CELLS}, n AS (SELECT meta_aa_changes, count(*) AS n_cells FROM cells GROUP BY 1),
        best AS (SELECT meta_aa_changes FROM n WHERE meta_aa_changes LIKE 'A%V%' ORDER BY n_cells DESC, meta_aa_changes LIMIT 10)
        SELECT * FROM n WHERE meta_aa_changes NOT LIKE 'A%V%' OR meta_aa_changes IN (SELECT * FROM best)""",
    "min_cells": f"{WITH_CELLS} SELECT meta_aa_changes, count(*) AS n_cells FROM cells GROUP BY 1 HAVING count(*) >= 1480 OR meta_aa_changes = 'WT'",
    "control_sample": f"{WITH_CELLS} SELECT control AS is_control, CASE WHEN control THEN CAST(floor(count(*) * 0.25) AS BIGINT) ELSE count(*) END AS n_cells FROM marked GROUP BY 1",
    "pseudo_variants": f"""{WITH_CELLS}, n AS (SELECT meta_aa_changes, control, count(*) AS n_cells FROM marked GROUP BY 1, 2)
        SELECT meta_aa_changes, n_cells FROM n UNION ALL SELECT concat(meta_aa_changes, ':downsample-0.5'), CAST(floor(n_cells * 0.5) AS BIGINT) FROM n WHERE control""",
    "wildtype_sample": f"""{WITH_CELLS}, n AS (SELECT meta_aa_changes, meta_barcode, count(*) AS n FROM cells GROUP BY 1, 2), t AS (SELECT meta_aa_changes, sum(n) AS t FROM n GROUP BY 1),
        s AS (SELECT max(t) FILTER (meta_aa_changes <> 'WT') / CAST(max(t) FILTER (meta_aa_changes = 'WT') AS DOUBLE) AS share FROM t)
        SELECT meta_aa_changes, meta_barcode, CASE WHEN meta_aa_changes = 'WT' AND share < 1 THEN CAST(round(n * share) AS BIGINT) ELSE n END AS n_cells FROM n, s""",
    "label_metadata": f"""{WITH_CELLS}, b AS (SELECT meta_aa_changes, meta_batch AS v, count(*) AS n FROM cells GROUP BY 1, 2), c AS (SELECT meta_aa_changes, meta_barcode AS v, count(*) AS n FROM cells GROUP BY 1, 2),
        bl AS (SELECT meta_aa_changes, sum(n) AS t, count(*) AS k, string_agg(concat(v, '=', n), ',' ORDER BY v) AS s FROM b GROUP BY 1), cl AS (SELECT meta_aa_changes, count(*) AS k, string_agg(concat(v, '=', n), ',' ORDER BY v) AS s FROM c GROUP BY 1)
        SELECT bl.meta_aa_changes, CAST(bl.t AS BIGINT) AS meta_n_cells, bl.k AS meta_n_batch, cl.k AS meta_n_barcode, bl.s AS batches, cl.s AS barcodes FROM bl JOIN cl USING (meta_aa_changes)""",
    "control_zscore": f"{WITH_CELLS}, s AS (SELECT {_each('avg(@) AS m_@, stddev_samp(@) AS s_@')} FROM marked WHERE control) SELECT meta_aa_changes, {_each('round(avg((@ - m_@) / s_@), 6) AS @')} FROM marked, s GROUP BY 1",
    "batch_zscore": f"{WITH_CELLS}, s AS (SELECT meta_batch, {_each('avg(@) AS m_@, stddev_samp(@) AS s_@')} FROM marked WHERE control GROUP BY 1) SELECT meta_aa_changes, meta_batch, {_each('round(avg((@ - m_@) / s_@), 6) AS @')} FROM marked JOIN s USING (meta_batch) GROUP BY 1, 2",
    "score_correction": f"""{WITH_CELLS}, b AS (SELECT meta_aa_changes, meta_batch, avg(price) AS score FROM cells GROUP BY 1, 2),
        s AS (SELECT meta_batch, avg(score) AS m, stddev_samp(score) AS s FROM b WHERE meta_aa_changes LIKE 'A%A' GROUP BY 1), t AS (SELECT median(m) AS mm, median(s) AS ms FROM s)
        SELECT meta_aa_changes, meta_batch, round(score, 4) AS score, round((score - m) / s * ms + mm, 4) AS score_corrected FROM b JOIN s USING (meta_batch), t""",
    "plain_statistics": f"""{WITH_CELLS}, m AS (SELECT meta_aa_changes, {_each('median(@) AS m_@')} FROM marked WHERE NOT control GROUP BY 1)
        SELECT meta_aa_changes, {_each('round(avg(@) + 1e-8, 5) AS @_mean')}, {_each('round(median(@) + 1e-8, 5) AS @_median')}, {_each('round(stddev_samp(@) + 1e-8, 5) AS @_std')}, {_each('round(median(abs(@ - m_@)) + 1e-8, 5) AS "@_MAD"')}
        FROM marked JOIN m USING (meta_aa_changes) WHERE NOT control GROUP BY 1""",
    "distribution_statistics": f"""{WITH_CELLS}, {_LONG}, g AS (SELECT meta_aa_changes, feature, value, count(*) AS c FROM long WHERE NOT control GROUP BY ALL),
        r AS (SELECT feature, value, count(*) AS r FROM long WHERE control GROUP BY ALL), labels AS (SELECT DISTINCT meta_aa_changes, feature FROM g),
        pool AS (SELECT meta_aa_changes, feature, value, sum(c) AS c, sum(r) AS r FROM (SELECT meta_aa_changes, feature, value, c, 0 AS r FROM g UNION ALL SELECT meta_aa_changes, feature, value, 0, r FROM labels JOIN r USING (feature)) GROUP BY ALL),
        cum AS (SELECT *, sum(c) OVER w AS cc, sum(r) OVER w AS rr, sum(c) OVER a AS n, sum(r) OVER a AS m FROM pool WINDOW w AS (PARTITION BY meta_aa_changes, feature ORDER BY value), a AS (PARTITION BY meta_aa_changes, feature)),
        s AS (SELECT meta_aa_changes, feature, max(CAST(n AS DOUBLE)) AS n, max(CAST(m AS DOUBLE)) AS m, greatest(0, max(cc / CAST(n AS DOUBLE) - rr / CAST(m AS DOUBLE))) AS up, least(0, min(cc / CAST(n AS DOUBLE) - rr / CAST(m AS DOUBLE))) AS down,
            sum(CAST(c AS DOUBLE) * (rr - r + r / 2.0)) AS u, sum(pow(CAST(c + r AS DOUBLE), 3) - (c + r)) AS ties FROM cum GROUP BY 1, 2),
        d AS (SELECT *, greatest(up, -down) AS ks, -2 * (n * m / (n + m)) * pow(greatest(up, -down), 2) AS e, abs(u - n * m / 2) / sqrt(n * m / 12 * (n + m + 1 - ties / ((n + m) * (n + m - 1)))) / sqrt(2.0) AS x FROM s),
        k AS (SELECT d.*, (SELECT sum(CASE WHEN i % 2 = 1 THEN 1 ELSE -1 END * exp(d.e * (i * i - 1))) FROM range(1, 101) AS q(i)) AS series, 1 / (1 + x / 2) AS t FROM d)
        SELECT meta_aa_changes, feature, round(ks, 4) AS "KS", round(CASE WHEN up >= -down THEN up ELSE down END, 4) AS "signedKS", round(u / (n * m), 4) AS "AUROC",
            round(CASE WHEN ks = 0 THEN 0 ELSE greatest(0, -(log10(2) + e / ln(10) + log10(series))) END, 4) AS "KSnegLogP", round(greatest(0, -(ln(t) - x * x + {_ERFC}) / ln(10)), 4) AS "AUROCnegLogP" FROM k""",
    "quantile_correlation": f"""{WITH_CELLS}, {_LONG}, p AS (SELECT i, i / 99.0 AS q FROM range(0, 100) AS r(i)),
        g AS (SELECT meta_aa_changes, feature, quantile_cont(value, [{', '.join(f'{i}/99.0::DOUBLE' for i in range(100))}]) AS x FROM long WHERE NOT control GROUP BY 1, 2),
        r AS (SELECT feature, quantile_cont(value, [{', '.join(f'{i}/99.0::DOUBLE' for i in range(100))}]) AS y FROM long WHERE control GROUP BY 1),
        e AS (SELECT meta_aa_changes, feature, unnest(x) AS x, unnest(y) AS y FROM g JOIN r USING (feature))
        SELECT meta_aa_changes, feature, round(corr(x, y), 5) AS "QQ" FROM e GROUP BY 1, 2""",
    "variant_profile": f"""{WITH_CELLS}, {_QC.replace('@cells', '1')}, s AS (SELECT {_each('avg(@) AS m_@, stddev_samp(@) AS s_@')} FROM ok WHERE control),
        p AS (SELECT meta_aa_changes, {_each('avg((@ - m_@) / s_@) AS @_mean')}, {_each('median((@ - m_@) / s_@) AS @_median')} FROM ok, s GROUP BY 1),
        c AS (SELECT {_each('median(@_mean) AS c_@')} FROM p WHERE meta_aa_changes LIKE 'A%A')
        SELECT meta_aa_changes, {_each('round(@_mean, 5) AS @_mean')}, {_each('round(@_median, 5) AS @_median')},
            round((1 - ({_each('@_mean * c_@', ' + ')}) / sqrt(({_each('@_mean * @_mean', ' + ')}) * ({_each('c_@ * c_@', ' + ')}))) / 2, 5) AS impact_score FROM p, c""",
}
