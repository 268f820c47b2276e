"""Queries that string several operators together, and those along positions."""

from __future__ import annotations

from pyspark.sql import functions as F

from assayframe.functions import labels
from assayframe.operators import aggregate, annotate, matrix, normalize, pool, positions, qc, reproduce
from assayframe.plans.cells import FEATURES, WITH_CELLS, cells
from assayframe.plans.core import LABEL, control, rounded
from assayframe.plans.pooled import halves, per_batch


def reproducible_profile(spark, sf):
    """Halves, correlations, blocklist and the final table of what is left, in one job."""
    found = reproduce.feature_correlations(reproduce.half_values(halves(spark, sf), FEATURES))
    blocks = reproduce.blocklist(found, 0.0).select(F.concat("feature", F.lit("_mean")).alias("feature"), "median_r")
    base = cells(spark, sf)
    profile = aggregate.plain(base, F.lit(False), FEATURES, ["mean"])
    kept = blocks.where(F.coalesce(F.col("median_r") >= 0.0, F.lit(False))).select("feature")
    long = profile.select(LABEL, F.explode(F.array(*(F.struct(F.lit(f"{f}_mean").alias("feature"), F.col(f"{f}_mean").alias("value")) for f in FEATURES))).alias("p")).select(LABEL, "p.*")
    return rounded(long.join(kept, "feature", "left_semi"), "value", digits=4)


def global_table(spark, sf):
    """Per batch z-scores, pooled by medians, with impact score and class: the cross-experiment table."""
    scored = normalize.zscore(per_batch(spark, sf), control(), FEATURES, by=["meta_batch"])
    pooled = pool.median_across(scored, LABEL, FEATURES, "meta_batch", summed=["meta_n_cells"])
    out = aggregate.impact_score(pooled, control(), FEATURES).withColumn("variant_type", labels.variant_type(LABEL))
    return rounded(out, *FEATURES, "impact_score", digits=4)


def position_runs(spark, sf):
    return positions.runs(cells(spark, sf).select(labels.position(LABEL).alias("position"), labels.variant_type(LABEL).alias("kind")), "position", "kind")


def residue_match(spark, sf):
    wt, place, _ = labels.substitution(LABEL)
    scored = cells(spark, sf).select(place.alias("position"), wt.alias("wt"))
    structure = spark.range(4, 30).select(F.col("id").alias("residue"), F.when(F.col("id") % 10 == 0, "G").otherwise("A").alias("name"))
    return positions.match_residues(scored, structure, "position", "wt", "residue", "name").groupBy("state").agg(F.count("*").alias("n"))


def effect_map(spark, sf):
    found = positions.effect_cells(cells(spark, sf), LABEL, "price")
    return rounded(positions.effect_map(found, ["A", "V"]), "score", digits=4)


def position_means(spark, sf):
    return rounded(positions.position_means(positions.effect_cells(cells(spark, sf), LABEL, "tax")), "score")


def batch_rows(spark, sf):
    """Rows a batch before and after quality control."""
    base = cells(spark, sf)
    kept = qc.passing(base, 1, 100, 2).groupBy("meta_batch").agg(F.count("*").alias("n_kept"))
    return base.groupBy("meta_batch").agg(F.count("*").alias("n")).join(kept, "meta_batch", "left")


CURVE = (-2.0, -0.5, 0.5, 3.0)
RANGES = ((-1, float("-inf"), 20.0), (1, 26.0, 27.0), (2, 27.0, float("inf")))


def calibrated_scores(spark, sf):
    """Likelihood ratio, posterior and points of each variant's score from a saved curve."""
    rows = cells(spark, sf).groupBy(LABEL).agg(F.avg("quantity").alias("score"))
    return rounded(annotate.apply_calibration(rows, "score", 24.0, 1.0, CURVE, 0.1, RANGES), "score", "lr", "posterior")


def clinical_annotation(spark, sf):
    """Labels with the clinical records of a supplied table: part types stand for records, whose lists are split and judged."""
    words = F.element_at(F.array(F.lit("Pathogenic"), F.lit("Benign"), F.lit("Uncertain significance"), F.lit("")), F.pmod("p_size", F.lit(4)) + 1)
    record = spark.read.parquet(f"{sf}/part.parquet").select(F.concat(F.lit("p.Ala"), F.expr("p_partkey % 40"), F.lit("Val")).alias("mapped_hgvs_p"), F.concat_ws("|", words, F.lit("Likely benign")).alias("clinvar.202401.clinical_significance"), F.concat_ws("|", F.expr("CAST(p_partkey % 3 AS STRING)"), F.lit("0")).alias("clinvar.202401.stars"))
    found = annotate.clinvar(record, min_stars=1).select("key", "meta_clinvar_class", "meta_clinvar_stars")
    return cells(spark, sf).groupBy(LABEL).agg(F.count("*").alias("n")).transform(lambda d: annotate.join_annotation(d, found, LABEL))


def label_groups(spark, sf):
    """Control groups by flags that other columns stand for; some labels are of two changes."""
    rows = cells(spark, sf).groupBy(LABEL).agg(F.min("meta_part").alias("k"))
    rows = rows.union(rows.select(F.concat(LABEL, F.lit("|L99P")), "k")).select(LABEL, F.when(F.col("k") % 3 == 0, "P/LP").when(F.col("k") % 3 == 1, "B/LB").alias("clinical"), (F.col("k") % 2 == 0).alias("seen"))
    return annotate.control_groups(rows, LABEL, "clinical", "seen").select(LABEL, F.array_join("groups", ",").alias("groups"), "group")


def unfit_columns(spark, sf):
    """Per feature: share of missing values and whether selection drops it."""
    rows = cells(spark, sf).select(*(F.when(F.col("meta_line") % (i + 2) != 0, F.col(f)).alias(f) for i, f in enumerate(FEATURES)))
    names = matrix.unfit_features(rows, FEATURES, na_share=0.3, outlier=1e9)
    each = rows.agg(*((1 - F.count(f) / F.count("*")).alias(f) for f in FEATURES))
    long = each.select(F.explode(F.array(*(F.struct(F.lit(f).alias("feature"), F.col(f).alias("missing"), F.lit(f in names).alias("dropped")) for f in FEATURES))).alias("p")).select("p.*")
    return rounded(long, "missing")


QUERIES = {f.__name__: f for f in (reproducible_profile, global_table, position_runs, residue_match, effect_map, position_means, batch_rows, calibrated_scores, clinical_annotation, label_groups, unfit_columns)}

_each = lambda text, sep=", ": sep.join(text.replace("@", f) for f in FEATURES)
_PB = f"{WITH_CELLS}, pb AS (SELECT meta_aa_changes, meta_batch, count(*) AS meta_n_cells, {_each('avg(@) AS @')} FROM cells GROUP BY 1, 2)"
_KIND = """CASE WHEN l LIKE '%fs%' THEN 'Frameshift' WHEN l LIKE '%-' THEN '3nt Deletion' WHEN l LIKE '%X%' THEN 'Nonsense' WHEN l = 'WT' THEN 'WT'
    WHEN l[1] = l[length(l)] THEN 'Synonymous' ELSE 'Single Missense' END"""
_PLACE = "CAST(nullif(regexp_extract(meta_aa_changes, '^.(\\d+)', 1), '') AS BIGINT)"
_SINGLE = "SELECT meta_aa_changes[1] AS wt, CAST(regexp_extract(meta_aa_changes, '^[A-Z](\\d+)[A-Z]$', 1) AS BIGINT) AS position, meta_aa_changes[length(meta_aa_changes)] AS mut, price, tax FROM cells WHERE regexp_matches(meta_aa_changes, '^[A-Z]\\d+[A-Z]$')"

ORACLE_SQL = {
    "reproducible_profile": f"""{WITH_CELLS}, r AS (SELECT cells.*, replicate, (meta_order + meta_line * replicate + meta_part) % 2 AS half FROM cells, (SELECT unnest([1, 2, 3]) AS replicate) AS q),
        h AS (SELECT replicate, meta_aa_changes, half, {_each('avg(@) AS @')} FROM r GROUP BY 1, 2, 3), l AS ({' UNION ALL '.join(f"SELECT replicate, meta_aa_changes, half, '{f}' AS feature, {f} AS value FROM h" for f in FEATURES)}),
        c AS (SELECT a.replicate, a.feature, corr(a.value, b.value) AS r FROM l AS a JOIN l AS b ON a.replicate = b.replicate AND a.feature = b.feature AND a.meta_aa_changes = b.meta_aa_changes WHERE a.half = 0 AND b.half = 1 GROUP BY 1, 2),
        ok AS (SELECT feature FROM c GROUP BY 1 HAVING coalesce(median(r) >= 0, false)),
        p AS ({' UNION ALL '.join(f"SELECT meta_aa_changes, '{f}' AS feature, avg({f}) AS value FROM cells GROUP BY 1" for f in FEATURES)})
        SELECT meta_aa_changes, concat(feature, '_mean') AS feature, round(value, 4) AS value FROM p SEMI JOIN ok USING (feature)""",
    "global_table": f"""{_PB}, s AS (SELECT meta_batch, {_each('avg(@) AS m_@, stddev_samp(@) AS s_@')} FROM pb WHERE meta_aa_changes LIKE 'A%A' GROUP BY 1),
        z AS (SELECT meta_aa_changes, meta_batch, meta_n_cells, {_each('(@ - m_@) / s_@ AS @')} FROM pb JOIN s USING (meta_batch)),
        p AS (SELECT meta_aa_changes, split_part(meta_aa_changes, ':', 1) AS l, {_each('median(@) AS @')}, CAST(sum(meta_n_cells) AS BIGINT) AS meta_n_cells, count(DISTINCT meta_batch) AS meta_n_batches FROM z GROUP BY 1),
        c AS (SELECT {_each('median(@) AS c_@')} FROM p WHERE meta_aa_changes LIKE 'A%A')
        SELECT meta_aa_changes, {_each('round(@, 4) AS @')}, meta_n_cells, meta_n_batches, round((1 - ({_each('@ * c_@', ' + ')}) / sqrt(({_each('@ * @', ' + ')}) * ({_each('c_@ * c_@', ' + ')}))) / 2, 4) AS impact_score, {_KIND} AS variant_type FROM p, c""",
    "position_runs": f"""{WITH_CELLS}, k AS (SELECT DISTINCT {_PLACE} AS position, split_part(meta_aa_changes, ':', 1) AS l FROM cells),
        d AS (SELECT DISTINCT position, {_KIND} AS kind FROM k WHERE position IS NOT NULL), g AS (SELECT *, position - row_number() OVER (PARTITION BY kind ORDER BY position) AS run FROM d)
        SELECT kind, min(position) AS first, max(position) AS last FROM g GROUP BY kind, run""",
    "residue_match": f"""{WITH_CELLS}, p AS (SELECT position, wt AS w FROM (SELECT position, wt, row_number() OVER (PARTITION BY position ORDER BY count(*) DESC, wt) AS k FROM ({_SINGLE}) AS q GROUP BY 1, 2) AS c WHERE k = 1), r AS (SELECT i AS r, CASE WHEN i % 10 = 0 THEN 'G' ELSE 'A' END AS s FROM range(4, 30) AS t(i)),
        m AS (SELECT CASE WHEN r IS NULL THEN 'outside' WHEN position IS NULL THEN 'unscored' WHEN w <> s THEN 'mismatched' ELSE 'matched' END AS state FROM p FULL OUTER JOIN r ON position = r) SELECT state, count(*) AS n FROM m GROUP BY 1""",
    "effect_map": f"""{WITH_CELLS}, e AS (SELECT position, mut, avg(price) AS score FROM ({_SINGLE}) AS q GROUP BY wt, position, mut), v AS (SELECT position, mut, avg(score) AS score FROM e GROUP BY 1, 2),
        g AS (SELECT i AS position, m AS mut FROM (SELECT unnest(range(a, b + 1)) AS i FROM (SELECT min(position) AS a, max(position) AS b FROM e) AS s) AS t, (SELECT unnest(['A', 'V']) AS m) AS u)
        SELECT g.position, g.mut, round(score, 4) AS score FROM g LEFT JOIN v ON v.position = g.position AND v.mut = g.mut""",
    "position_means": f"{WITH_CELLS}, e AS (SELECT wt, position, mut, avg(tax) AS score FROM ({_SINGLE}) AS q GROUP BY 1, 2, 3) SELECT position, round(avg(score), 6) AS score, count(*) AS n FROM e WHERE wt <> mut GROUP BY 1",
    "calibrated_scores": f"""{WITH_CELLS}, s AS (SELECT meta_aa_changes, avg(quantity) AS score FROM cells GROUP BY 1), a AS (SELECT *, least(greatest(score - 24.0, 0.0), 3.0) AS x FROM s),
        l AS (SELECT *, CASE WHEN x <= 1 THEN -2.0 + x * 1.5 WHEN x <= 2 THEN -0.5 + (x - 1) * 1.0 ELSE 0.5 + (x - 2) * 2.5 END AS g FROM a)
        SELECT meta_aa_changes, round(score, 6) AS score, round(exp(g), 6) AS lr, round(exp(g) * 0.1 / ((exp(g) - 1) * 0.1 + 1), 6) AS posterior,
            CAST(CASE WHEN score <= 20 THEN -1 WHEN score BETWEEN 26 AND 27 THEN 1 WHEN score >= 27 THEN 2 ELSE 0 END AS TINYINT) AS points FROM l""",
    "clinical_annotation": f"""{WITH_CELLS}, n AS (SELECT meta_aa_changes, count(*) AS n FROM cells GROUP BY 1),
        r AS (SELECT concat('A', p_partkey % 40, 'V') AS key, p_partkey % 3 AS stars, CASE p_size % 4 WHEN 0 THEN 'P/LP' WHEN 1 THEN 'B/LB' END AS class FROM part WHERE p_partkey % 3 >= 1),
        g AS (SELECT key, min(class) AS class, CAST(max(stars) AS INT) AS stars FROM r GROUP BY 1 HAVING min(class) = max(class))
        SELECT meta_aa_changes, n, class AS meta_clinvar_class, stars AS meta_clinvar_stars FROM n LEFT JOIN g ON key = meta_aa_changes""",
    "label_groups": f"""{WITH_CELLS}, s AS (SELECT meta_aa_changes, min(meta_part) AS k FROM cells GROUP BY 1), r AS (SELECT * FROM s UNION ALL SELECT concat(meta_aa_changes, '|L99P'), k FROM s),
        f AS (SELECT *, NOT regexp_matches(meta_aa_changes, '[:|]') AS one, meta_aa_changes NOT LIKE '%:%' AND regexp_matches(meta_aa_changes, '^A\\d+A') AS syn FROM r),
        g AS (SELECT meta_aa_changes, concat_ws(',', CASE WHEN one AND k % 3 = 0 THEN 'P/LP' END, CASE WHEN one AND k % 3 = 1 THEN 'B/LB' END, CASE WHEN syn THEN 'Synonymous' END, CASE WHEN one AND k % 2 = 0 THEN 'gnomAD' END) AS groups FROM f)
        SELECT meta_aa_changes, groups, nullif(split_part(groups, ',', 1), '') AS "group" FROM g""",
    "unfit_columns": f"{WITH_CELLS} " + " UNION ALL ".join(f"SELECT '{f}' AS feature, round(1 - count(*) FILTER (meta_line % {i + 2} <> 0) / CAST(count(*) AS DOUBLE), 6) AS missing, 1 - count(*) FILTER (meta_line % {i + 2} <> 0) / CAST(count(*) AS DOUBLE) > 0.3 AS dropped FROM cells" for i, f in enumerate(FEATURES)),
    "batch_rows": f"""{WITH_CELLS}, near AS (SELECT * FROM cells WHERE meta_edit_distance <= 1), bc AS (SELECT meta_barcode FROM near GROUP BY 1 HAVING count(*) >= 100), k AS (SELECT * FROM near SEMI JOIN bc USING (meta_barcode)),
        lab AS (SELECT meta_aa_changes FROM k GROUP BY 1 HAVING count(DISTINCT meta_barcode) >= 2), ok AS (SELECT meta_batch, count(*) AS n_kept FROM k SEMI JOIN lab USING (meta_aa_changes) GROUP BY 1)
        SELECT meta_batch, n, n_kept FROM (SELECT meta_batch, count(*) AS n FROM cells GROUP BY 1) AS a LEFT JOIN ok USING (meta_batch)""",
}
