"""Queries on reproducibility, pooling, scoring, matrices and annotation."""

from __future__ import annotations

from pyspark.sql import functions as F

from assayframe.functions import columns, labels
from assayframe.operators import aggregate, annotate, boost, combat, matrix, pool, reproduce, score
from assayframe.plans.cells import FEATURES, KEYS, WITH_CELLS, cells
from assayframe.plans.core import LABEL, control, rounded
from assayframe.sources import tables


def per_batch(spark, sf):
    return cells(spark, sf).groupBy(LABEL, "meta_batch").agg(F.count("*").alias("meta_n_cells"), *(F.avg(f).alias(f) for f in FEATURES))


def halves(spark, sf):
    """Halves by a parity that both engines know; the seeded split is tested by its invariants."""
    rows = cells(spark, sf).withColumn("replicate", F.explode(F.sequence(F.lit(1), F.lit(3))))
    return rows.withColumn("half", F.expr("CAST((meta_order + meta_line * replicate + meta_part) % 2 AS INT)"))


def half_correlations(spark, sf):
    return rounded(reproduce.feature_correlations(reproduce.half_values(halves(spark, sf), FEATURES)), "r", "r2", digits=5)


def feature_blocklist(spark, sf):
    found = reproduce.feature_correlations(reproduce.half_values(halves(spark, sf), FEATURES))
    return rounded(reproduce.blocklist(found, 0.1), "median_r", digits=5)


def split_sizes(spark, sf):
    rows = reproduce.split_halves(cells(spark, sf), KEYS, 2, seed=5)
    return rows.groupBy("replicate", LABEL).agg(F.count_if(F.col("half") == 0).alias("n_even"), F.count_if(F.col("half") == 1).alias("n_odd"))


def blocklist_vote(spark, sf):
    lists = per_batch(spark, sf).groupBy("meta_batch").agg(*(F.avg(f).alias(f) for f in FEATURES))
    long = lists.select("meta_batch", F.explode(F.array(*(F.struct(F.lit(f).alias("feature"), (F.pmod(F.floor(F.col(f) * 1000), F.lit(3)) != 0).alias("feature_ok")) for f in FEATURES))).alias("p")).select("p.*")
    return reproduce.vote(long, least=3)


def finalized_profiles(spark, sf):
    base = cells(spark, sf)
    one = aggregate.plain(base, F.lit(False), FEATURES, ["mean"])
    two = aggregate.plain(base, F.lit(False), FEATURES, ["std"])
    blocks = spark.createDataFrame([("tax_std", False), ("price_mean", True)], "feature string, feature_ok boolean")
    meta = base.groupBy(LABEL).agg(F.count("*").alias("meta_n_cells"))
    out = reproduce.finalize([one, two], blocks, meta, control())
    return rounded(out, *[c for c in out.columns if c.endswith(("_mean", "_std", "_score"))], digits=4)


def pooled_medians(spark, sf):
    out = pool.median_across(per_batch(spark, sf), LABEL, FEATURES, "meta_batch", summed=["meta_n_cells"])
    return rounded(out, *FEATURES)


def paired_medians(spark, sf):
    return rounded(pool.paired_median(per_batch(spark, sf), LABEL, "price", "meta_n_cells"), "price", digits=4)


def global_scores(spark, sf):
    return rounded(pool.global_scores(per_batch(spark, sf), LABEL, "meta_batch", "price", control()), "price", digits=4)


def variant_scores(spark, sf):
    return rounded(pool.per_variant(per_batch(spark, sf), LABEL, ["quantity", "tax"], ["meta_n_cells"], "mean"), "quantity", "tax")


def cluster_shares(spark, sf):
    rows = cells(spark, sf).withColumn("cluster", F.col("meta_line").cast("string")).withColumn("kind", labels.variant_type(LABEL))
    return rounded(pool.cluster_summary(rows, "cluster", ["quantity", "price"], "kind"), "share", "quantity", "price")


def position_scores(spark, sf):
    rows = cells(spark, sf).withColumn("position", labels.position(LABEL))
    return rounded(pool.per_position(rows, "position", "price", "mean"), "price", digits=4)


def commonest_barcode(spark, sf):
    return pool.commonest(cells(spark, sf), LABEL, "meta_barcode")


def batch_columns(spark, sf):
    batches = spark.read.parquet(f"{sf}/orders.parquet").select("o_orderpriority").where("o_orderpriority is not null").distinct()
    names = sorted(r[0] for r in batches.collect())  # a column each
    return rounded(pool.pivot_unique(per_batch(spark, sf), LABEL, "meta_batch", "quantity", names), *names)


def hexagon_density(spark, sf):
    rows = pool.hexagons(cells(spark, sf), "quantity", "tax", 5.0)
    return rounded(rows.groupBy("hex_x", "hex_y").agg(F.count("*").alias("n"), F.avg("price").alias("price")), "hex_x", "hex_y", "price", digits=4)


def roc_areas(spark, sf):
    return rounded(pool.auc(cells(spark, sf), "price", F.col("meta_aa_changes") == "WT", ["meta_batch"]), "auc")


def roc_curve(spark, sf):
    return rounded(pool.roc_points(cells(spark, sf), "quantity", F.col("meta_aa_changes") == "WT", ["meta_batch"]), "fpr", "tpr")


def combat_check(spark, sf):
    """Moments of the corrected table; the correction itself is tested against numpy."""
    out = combat.combat(per_batch(spark, sf), FEATURES, LABEL, "meta_batch")
    return rounded(out.groupBy("meta_batch").agg(F.count("*").alias("n"), *(F.avg(f).alias(f) for f in FEATURES)), *FEATURES, digits=4)


def folded(spark, sf):
    """What scoring needs of the cells, and their folds, written, since it is read several times."""
    rows = cells(spark, sf).withColumn("fold", F.expr("CAST((meta_order + meta_line) % 3 AS INT)"))
    return tables.written(rows.select(LABEL, "meta_barcode", "meta_batch", "fold", *FEATURES), "folded")


def fold_scores(spark, sf):
    rows = cells(spark, sf).withColumn("fold", F.expr("CAST((meta_order + meta_line) % 3 AS INT)"))
    scored = score.cross_validated(rows, ["quantity", "price"], 3)
    return rounded(scored.groupBy("scored_against", "is_wildtype").agg(F.count("*").alias("n"), F.avg("score").alias("score")), "score", digits=5)


def fold_metrics(spark, sf):
    out = score.cross_validated_metrics(folded(spark, sf), ["quantity", "price"], 3)
    listed = F.array_join(F.transform("auroc_folds", lambda a: F.format_number(a, 4)), ",")
    return rounded(out.withColumn("auroc_folds", listed), "auroc_pooled", "auroc_median_barcode", "auroc_median_fold", digits=4)


def boosted_metrics(spark, sf):
    """Areas of each variant by boosted trees, of few rounds."""
    out = boost.boosted_metrics(folded(spark, sf), FEATURES, 3, rounds=3, depth=2)
    listed = F.array_join(F.transform("auroc_folds", lambda a: F.format_number(a, 4)), ",")
    return rounded(out.withColumn("auroc_folds", listed), "auroc_pooled", "auroc_median_barcode", "auroc_median_fold", digits=4)


def barcode_folds(spark, sf):
    """The barcodes of each variant's folds, and their cells."""
    rows = score.folds(cells(spark, sf), 3, KEYS, by_barcode=True).where(F.col(LABEL) != "WT")
    return rows.groupBy(LABEL, "fold").agg(F.array_join(F.array_sort(F.collect_set("meta_barcode")), ",").alias("barcodes"), F.count("*").alias("n_cells"))


def wildtype_folds(spark, sf):
    rows = score.folds(cells(spark, sf), 3, KEYS, by_barcode=True).where(F.col(LABEL) == "WT")
    return rows.groupBy("fold").agg(F.count("*").alias("n_cells"))


def class_weights(spark, sf):
    rows = cells(spark, sf).withColumn("is_wildtype", F.col(LABEL) == "WT")
    return rounded(score.class_weights(rows, ["meta_batch"], "is_wildtype").select("meta_batch", "is_wildtype", "weight").distinct(), "weight")


def profile_distances(spark, sf, metric="euclidean"):
    rows = aggregate.plain(cells(spark, sf), F.lit(False), FEATURES, ["mean"])
    return rounded(matrix.between_rows(rows, LABEL, F.array(*(f"{f}_mean" for f in FEATURES)), metric), "value", digits=5)


def profile_correlations(spark, sf):
    return profile_distances(spark, sf, "pearson")


def nearest_profiles(spark, sf):
    rows = aggregate.plain(cells(spark, sf), F.lit(False), FEATURES, ["mean"])
    found = matrix.nearest(matrix.between_rows(rows, LABEL, F.array(*(f"{f}_mean" for f in FEATURES)), "cityblock"), 3)
    return rounded(found, "value", digits=5)


def feature_pairs(spark, sf):
    return rounded(matrix.between_columns(per_batch(spark, sf), FEATURES), "value", digits=5)


def feature_pairs_ranked(spark, sf):
    return rounded(matrix.between_columns(per_batch(spark, sf), FEATURES, "spearman"), "value", digits=5)


def batch_pairs(spark, sf):
    return rounded(matrix.batch_correlations(per_batch(spark, sf), LABEL, "meta_batch", "price"), "value", digits=5)


def batch_anova(spark, sf):
    return rounded(matrix.batch_anova(per_batch(spark, sf), LABEL, "meta_batch", "price").drop("neg_log_p"), "f", digits=4)


def batch_permanova(spark, sf):
    rows = per_batch(spark, sf)
    out = matrix.permanova(rows, LABEL, "meta_batch", F.array("quantity", "tax"), permutations=19)
    return rounded(out.select("a", "b", "f", "n"), "f", digits=4)


def group_tests(spark, sf):
    return rounded(matrix.group_tests(cells(spark, sf), control(), FEATURES), "t", "cohens_d", "median_1", "median_2", digits=4)


def principal_shares(spark, sf):
    from pyspark.sql import Window

    rows, _, shares = matrix.pca(per_batch(spark, sf), FEATURES)
    spread = rows.agg(*(F.var_samp(f"pc_{i}").alias(f"v{i}") for i in range(len(FEATURES))))
    each = spread.select(F.posexplode(F.array(*(f"v{i}" for i in range(len(FEATURES))))).alias("component", "variance"))
    return rounded(each.withColumn("total", F.sum("variance").over(Window.partitionBy())).select("component", "total"), "total", digits=2)


def embedding_distances(spark, sf):
    each = spark.read.parquet(f"{sf}/embeddings.parquet").select("label", F.posexplode("embedding").alias("i", "v"))
    means = each.groupBy("label", "i").agg(F.avg("v").alias("v")).groupBy("label").agg(F.array_sort(F.collect_list(F.struct("i", "v"))).alias("means"))
    return rounded(matrix.between_rows(means, "label", F.col("means.v"), "cosine_distance"), "value", digits=5)


def population_annotation(spark, sf):
    """Labels with a population table that parts stand for: a record a part, some of them without a splice score or of a high one."""
    part = spark.read.parquet(f"{sf}/part.parquet")
    pick = lambda n, *words: F.element_at(F.array(*map(F.lit, words)), F.pmod("p_partkey", F.lit(n)).cast("int") + 1)
    table = part.select(
        F.concat(F.lit("p.Ala"), F.expr("p_partkey % 40"), pick(3, "Val", "Ala", "=")).alias("Protein Consequence"),
        F.when(F.col("p_size") % 4 != 0, "PASS").when(F.col("p_size") % 8 != 0, "AC0").alias("Filters - joint"),
        F.col("p_size").cast("string").alias("Allele Count"),
        F.expr("CAST(100 + p_partkey % 7 AS STRING)").alias("Allele Number"),
        F.when(F.col("p_size") % 5 != 0, F.expr("CAST(p_size / 50.0 AS STRING)")).alias("spliceai_ds_max"),
        pick(11, *["Uncertain significance"] * 6, "Benign", "Likely benign/Benign", "Pathogenic", "", "Likely pathogenic").alias("ClinVar Germline Classification"),
    )
    rows = cells(spark, sf).groupBy(LABEL).agg(F.count("*").alias("n"))
    return rounded(annotate.join_annotation(rows, annotate.gnomad(table, splice_max=0.6), LABEL), "meta_gnomad_frequency")


def props_values(spark, sf):
    """The JSON column of ``events`` as typed rows, counted."""
    rows = spark.read.parquet(f"{sf}/events.parquet").select("event_type", F.from_json("props", "k long")["k"].alias("k"))
    return rows.groupBy("event_type").agg(F.count("k").alias("n"), F.sum("k").alias("total"), F.count_distinct("k").alias("n_distinct"))


def numbered_rows(spark, sf):
    """Rows of a table numbered in order without gathering them."""
    rows = tables.combine_cells([spark.read.parquet(f"{sf}/supplier.parquet").select("s_suppkey"), spark.read.parquet(f"{sf}/customer.parquet").select(F.col("c_custkey").alias("s_suppkey"))], "meta_cell_index")
    return rows.agg(F.count("*").alias("n"), F.count_distinct("meta_cell_index").alias("n_distinct"), F.min("meta_cell_index").alias("first"), F.max("meta_cell_index").alias("last"))


def feature_names(spark, sf):
    names = spark.read.parquet(f"{sf}/part.parquet").select(F.concat_ws("_", F.col("p_brand"), F.lit("Area"), F.element_at(F.array(F.lit("median"), F.lit("KS"), F.lit("size")), F.pmod("p_partkey", F.lit(3)).cast("int") + 1)).alias("name")).distinct()
    p = columns.parse_feature(F.col("name"))
    return names.select("name", p["base"].alias("base"), p["statistic"].alias("statistic"))


QUERIES = {f.__name__: f for f in (half_correlations, feature_blocklist, split_sizes, blocklist_vote, finalized_profiles, pooled_medians, paired_medians, global_scores, variant_scores, cluster_shares, position_scores, commonest_barcode, batch_columns, hexagon_density, roc_areas, roc_curve, combat_check, fold_scores, fold_metrics, boosted_metrics, barcode_folds, wildtype_folds, class_weights, profile_distances, profile_correlations, nearest_profiles, feature_pairs, feature_pairs_ranked, batch_pairs, batch_anova, batch_permanova, group_tests, principal_shares, embedding_distances, population_annotation, props_values, numbered_rows, feature_names)}

_each = lambda text, sep=", ": sep.join(text.replace("@", f) for f in FEATURES)
_long = lambda table, keep: " UNION ALL ".join(f"SELECT {keep}, '{f}' AS feature, {f} AS value FROM {table}" for f in FEATURES)
_PB = f"{WITH_CELLS}, pb AS (SELECT meta_aa_changes, meta_batch, count(*) AS meta_n_cells, {_each('avg(@) AS @')} FROM cells GROUP BY 1, 2)"
_HALF = f"""{WITH_CELLS}, r AS (SELECT cells.*, replicate, (meta_order + meta_line * replicate + meta_part) % 2 AS half FROM cells, (SELECT unnest([1, 2, 3]) AS replicate) AS q),
    h AS (SELECT replicate, meta_aa_changes, half, {_each('avg(@) AS @')} FROM r GROUP BY 1, 2, 3), l AS ({_long('h', 'replicate, meta_aa_changes, half')}),
    p AS (SELECT a.replicate, a.feature, a.value AS x, b.value AS y FROM l AS a JOIN l AS b ON a.replicate = b.replicate AND a.feature = b.feature AND a.meta_aa_changes = b.meta_aa_changes WHERE a.half = 0 AND b.half = 1),
    c AS (SELECT replicate, feature, corr(x, y) AS r FROM p GROUP BY 1, 2)"""
#: The batches of the driver's tables.
BATCHES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
_PROFILE = f"{WITH_CELLS}, p AS (SELECT meta_aa_changes AS l, {_each('avg(@) AS @')} FROM cells GROUP BY 1)"
_MEAN = f"(({_each('@', ' + ')}) / {len(FEATURES)})"
_NB = "SELECT *, (meta_order + meta_line) % 3 AS fold, meta_aa_changes = 'WT' AS wt FROM cells"


def _density(f: str, s: str) -> str:
    var = f"greatest({s}.q_{f} / {s}.n_{f} - pow({s}.s_{f} / {s}.n_{f}, 2), 1e-9)"
    return f"(-ln({var}) / 2 - pow(x.{f} - {s}.s_{f} / {s}.n_{f}, 2) / (2 * {var}))"


_FOLDS = f"""{WITH_CELLS}, n AS ({_NB}), st AS (SELECT meta_aa_changes AS l, fold, {', '.join(f'CAST(count({f}) AS DOUBLE) AS n_{f}, sum({f}) AS s_{f}, sum({f} * {f}) AS q_{f}' for f in ('quantity', 'price'))} FROM n GROUP BY 1, 2),
    tr AS (SELECT g.l, g.f, {', '.join(f'sum(st.{c}_{f}) AS {c}_{f}' for f in ('quantity', 'price') for c in 'nsq')} FROM (SELECT DISTINCT l, f FROM st, (SELECT unnest([0, 1, 2]) AS f) AS q) AS g JOIN st ON st.l = g.l AND st.fold <> g.f GROUP BY 1, 2),
    sc AS (SELECT x.*, v.l AS scored_against, 1 / (1 + exp(-({' + '.join(f'({_density(f, "w")} - {_density(f, "v")})' for f in ('quantity', 'price'))}))) AS score
        FROM n AS x JOIN tr AS v ON v.f = x.fold AND v.l <> 'WT' AND (x.wt OR x.meta_aa_changes = v.l) JOIN tr AS w ON w.l = 'WT' AND w.f = x.fold)"""

ORACLE_SQL = {
    "half_correlations": f"{_HALF} SELECT replicate, feature, round(r, 5) AS r, round(r * r, 5) AS r2 FROM c",
    "feature_blocklist": f"{_HALF} SELECT feature, round(median(r), 5) AS median_r, coalesce(median(r) >= 0.1, false) AS feature_ok FROM c GROUP BY 1",
    "split_sizes": f"{WITH_CELLS} SELECT replicate, meta_aa_changes, count(*) // 2 AS n_even, count(*) - count(*) // 2 AS n_odd FROM cells, (SELECT unnest([1, 2]) AS replicate) AS q GROUP BY 1, 2",
    "blocklist_vote": f"""{_PB}, b AS (SELECT meta_batch, {_each('avg(@) AS @')} FROM pb GROUP BY 1), l AS ({_long('b', 'meta_batch')})
        SELECT feature, count(*) AS n_batches, count(*) FILTER (CAST(floor(value * 1000) AS BIGINT) % 3 <> 0) AS n_ok, count(*) FILTER (CAST(floor(value * 1000) AS BIGINT) % 3 <> 0) >= 3 AS feature_ok FROM l GROUP BY 1""",
    "finalized_profiles": f"""{WITH_CELLS}, p AS (SELECT meta_aa_changes, count(*) AS meta_n_cells, {_each('avg(@) AS @_mean')}, {', '.join(f'stddev_samp({f}) AS {f}_std' for f in FEATURES[:3])} FROM cells GROUP BY 1),
        s AS (SELECT {', '.join(f'avg({c}) AS m_{c}, stddev_samp({c}) AS s_{c}' for c in [f'{f}_mean' for f in FEATURES] + [f'{f}_std' for f in FEATURES[:3]])} FROM p WHERE meta_aa_changes LIKE 'A%A'),
        z AS (SELECT meta_aa_changes, meta_n_cells, {', '.join(f'({c} - m_{c}) / s_{c} AS {c}' for c in [f'{f}_mean' for f in FEATURES] + [f'{f}_std' for f in FEATURES[:3]])} FROM p, s),
        c AS (SELECT {', '.join(f'median({c}) AS c_{c}' for c in [f'{f}_mean' for f in FEATURES] + [f'{f}_std' for f in FEATURES[:3]])} FROM z WHERE meta_aa_changes LIKE 'A%A')
        SELECT meta_aa_changes, {', '.join(f'round({c}, 4) AS {c}' for c in [f'{f}_mean' for f in FEATURES] + [f'{f}_std' for f in FEATURES[:3]])}, meta_n_cells,
            round((1 - ({' + '.join(f'{c} * c_{c}' for c in [f'{f}_mean' for f in FEATURES] + [f'{f}_std' for f in FEATURES[:3]])}) / sqrt(({' + '.join(f'{c} * {c}' for c in [f'{f}_mean' for f in FEATURES] + [f'{f}_std' for f in FEATURES[:3]])}) * ({' + '.join(f'c_{c} * c_{c}' for c in [f'{f}_mean' for f in FEATURES] + [f'{f}_std' for f in FEATURES[:3]])}))) / 2, 4) AS meta_impact_score FROM z, c""",
    "pooled_medians": f"{_PB} SELECT meta_aa_changes, {_each('round(median(@), 6) AS @')}, CAST(sum(meta_n_cells) AS BIGINT) AS meta_n_cells, count(DISTINCT meta_batch) AS meta_n_batches FROM pb GROUP BY 1",
    "paired_medians": f"{_PB}, o AS (SELECT *, row_number() OVER (PARTITION BY meta_aa_changes ORDER BY price, meta_n_cells) AS i, count(*) OVER (PARTITION BY meta_aa_changes) AS n FROM pb) SELECT meta_aa_changes, round(price, 4) AS price, meta_n_cells FROM o WHERE i = (n - 1) // 2 + 1",
    "global_scores": f"{_PB}, s AS (SELECT meta_batch, avg(price) AS m, stddev_samp(price) AS s FROM pb WHERE meta_aa_changes LIKE 'A%A' GROUP BY 1) SELECT meta_aa_changes, round(median((price - m) / s), 4) AS price, count(*) AS n_price FROM pb JOIN s USING (meta_batch) GROUP BY 1",
    "variant_scores": f"{_PB} SELECT meta_aa_changes, round(avg(quantity), 6) AS quantity, round(avg(tax), 6) AS tax, CAST(sum(meta_n_cells) AS BIGINT) AS meta_n_cells, count(quantity) AS n_quantity, count(tax) AS n_tax FROM pb GROUP BY 1",
    "cluster_shares": f"""{WITH_CELLS}, k AS (SELECT *, CAST(meta_line AS VARCHAR) AS cluster, CASE WHEN meta_aa_changes = 'WT' THEN 'WT' WHEN meta_aa_changes = 'A36fs' THEN 'Frameshift' WHEN meta_aa_changes = 'A37-' THEN '3nt Deletion' WHEN meta_aa_changes = 'A38X' THEN 'Nonsense' WHEN meta_aa_changes LIKE 'A%A' THEN 'Synonymous' ELSE 'Single Missense' END AS kind FROM cells),
        m AS (SELECT cluster, count(*) AS n, median(quantity) AS quantity, median(price) AS price FROM k GROUP BY 1), c AS (SELECT cluster, kind, count(*) AS k FROM k GROUP BY 1, 2)
        SELECT m.cluster, n, round(quantity, 6) AS quantity, round(price, 6) AS price, kind, round(k / CAST(sum(k) OVER (PARTITION BY kind) AS DOUBLE), 6) AS share FROM m JOIN c USING (cluster)""",
    "position_scores": f"{WITH_CELLS}, p AS (SELECT CAST(nullif(regexp_extract(meta_aa_changes, '^.(\\d+)', 1), '') AS BIGINT) AS position, price FROM cells) SELECT position, round(avg(price), 4) AS price, count(price) AS n FROM p WHERE position IS NOT NULL GROUP BY 1",
    "commonest_barcode": f"{WITH_CELLS}, c AS (SELECT meta_aa_changes, meta_barcode, count(*) AS n FROM cells GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY meta_aa_changes ORDER BY n DESC, meta_barcode) AS i FROM c) SELECT meta_aa_changes, meta_barcode FROM r WHERE i = 1",
    "batch_columns": f"""{_PB} SELECT meta_aa_changes, {', '.join(f"round(max(quantity) FILTER (meta_batch = '{b}'), 6) AS \"{b}\"" for b in BATCHES)} FROM pb GROUP BY 1""",
    "hexagon_density": f"""{WITH_CELLS}, k AS (SELECT price, quantity AS x, tax AS y, round(quantity / 5.0) * 5.0 AS ax, (floor(quantity / 5.0) + 0.5) * 5.0 AS bx, round(tax / (5.0 * sqrt(3.0))) * (5.0 * sqrt(3.0)) AS ay, (floor(tax / (5.0 * sqrt(3.0))) + 0.5) * (5.0 * sqrt(3.0)) AS by_ FROM cells),
        h AS (SELECT *, pow(x - ax, 2) + pow(y - ay, 2) <= pow(x - bx, 2) + pow(y - by_, 2) AS near FROM k)
        SELECT round(CASE WHEN near THEN ax ELSE bx END, 4) AS hex_x, round(CASE WHEN near THEN ay ELSE by_ END, 4) AS hex_y, count(*) AS n, round(avg(price), 4) AS price FROM h GROUP BY 1, 2""",
    "roc_areas": f"""{WITH_CELLS}, k AS (SELECT meta_batch, price, count(*) FILTER (meta_aa_changes = 'WT') AS p, count(*) FILTER (meta_aa_changes <> 'WT') AS q FROM cells GROUP BY 1, 2), c AS (SELECT *, sum(q) OVER (PARTITION BY meta_batch ORDER BY price) - q AS b FROM k)
        SELECT meta_batch, CAST(sum(p) AS BIGINT) AS n_positive, CAST(sum(q) AS BIGINT) AS n_negative, round(sum(p * (b + q / 2.0)) / (CAST(sum(p) AS DOUBLE) * sum(q)), 6) AS auc FROM c GROUP BY 1""",
    "roc_curve": f"""{WITH_CELLS}, k AS (SELECT meta_batch, quantity AS threshold, count(*) FILTER (meta_aa_changes = 'WT') AS p, count(*) FILTER (meta_aa_changes <> 'WT') AS q FROM cells GROUP BY 1, 2)
        SELECT meta_batch, threshold, round(sum(q) OVER d / CAST(sum(q) OVER w AS DOUBLE), 6) AS fpr, round(sum(p) OVER d / CAST(sum(p) OVER w AS DOUBLE), 6) AS tpr FROM k WINDOW d AS (PARTITION BY meta_batch ORDER BY threshold DESC), w AS (PARTITION BY meta_batch)""",
    "fold_scores": f"{_FOLDS} SELECT scored_against, wt AS is_wildtype, count(*) AS n, round(avg(score), 5) AS score FROM sc GROUP BY 1, 2",
    "barcode_folds": f"""WITH RECURSIVE {WITH_CELLS.removeprefix('WITH ')}, s AS (SELECT meta_aa_changes AS l, meta_barcode AS b, count(*) AS n FROM cells WHERE meta_aa_changes <> 'WT' GROUP BY 1, 2),
        o AS (SELECT *, row_number() OVER (PARTITION BY l ORDER BY n DESC, b) AS i, row_number() OVER (PARTITION BY l ORDER BY b) AS j, count(*) OVER (PARTITION BY l) AS k FROM s),
        d AS (SELECT l, CAST(0 AS BIGINT) AS i, CAST(NULL AS VARCHAR) AS b, CAST(0 AS BIGINT) AS n, CAST(0 AS BIGINT) AS f, CAST([0, 0, 0] AS BIGINT[]) AS load FROM (SELECT DISTINCT l FROM s) AS q
            UNION ALL SELECT d.l, o.i, o.b, o.n, list_position(d.load, list_min(d.load)), list_transform(d.load, lambda x, p: CASE WHEN p = list_position(d.load, list_min(d.load)) THEN x + o.n ELSE x END) FROM d JOIN o ON o.l = d.l AND o.i = d.i + 1),
        p AS (SELECT d.l, d.b, d.n, CASE WHEN o.k <= 3 THEN o.j ELSE d.f END - 1 AS f FROM d JOIN o ON o.l = d.l AND o.b = d.b)
        SELECT l AS meta_aa_changes, CAST(f AS INT) AS fold, string_agg(b, ',' ORDER BY b) AS barcodes, CAST(sum(n) AS BIGINT) AS n_cells FROM p GROUP BY 1, 2""",
    "wildtype_folds": f"{WITH_CELLS}, n AS (SELECT count(*) AS n FROM cells WHERE meta_aa_changes = 'WT') SELECT CAST(f AS INT) AS fold, n // 3 + CASE WHEN f < n % 3 THEN 1 ELSE 0 END AS n_cells FROM n, range(0, 3) AS t(f)",
    "fold_metrics": f"""{_FOLDS}, pc AS (SELECT scored_against AS l, score, count(*) FILTER (wt) AS w, count(*) FILTER (NOT wt) AS v FROM sc GROUP BY 1, 2),
        pu AS (SELECT *, sum(v) OVER (PARTITION BY l ORDER BY score) - v AS b, sum(w) OVER (PARTITION BY l ORDER BY score DESC) - w AS a, sum(w) OVER (PARTITION BY l) AS ws FROM pc),
        pooled AS (SELECT l, CAST(sum(v) AS BIGINT) AS n, sum(w * (b + v / 2.0)) / (CAST(sum(w) AS DOUBLE) * sum(v)) AS auc FROM pu GROUP BY 1),
        fc AS (SELECT scored_against AS l, fold, score, count(*) FILTER (wt) AS w, count(*) FILTER (NOT wt) AS v FROM sc GROUP BY 1, 2, 3), fu AS (SELECT *, sum(v) OVER (PARTITION BY l, fold ORDER BY score) - v AS b FROM fc),
        fa AS (SELECT l, fold, sum(w * (b + v / 2.0)) / nullif(CAST(sum(w) AS DOUBLE) * sum(v), 0) AS auc FROM fu GROUP BY 1, 2),
        ff AS (SELECT l, string_agg(format('{{:.4f}}', auc), ',' ORDER BY fold) AS listed, median(auc) AS auc FROM fa WHERE auc IS NOT NULL GROUP BY 1),
        bc AS (SELECT x.scored_against AS l, x.meta_barcode, avg((a + w / 2.0) / ws) AS auc FROM sc AS x JOIN pu ON pu.l = x.scored_against AND pu.score = x.score WHERE NOT x.wt GROUP BY 1, 2),
        bb AS (SELECT l, median(auc) AS auc, count(*) AS n FROM bc GROUP BY 1)
        SELECT pooled.l AS meta_aa_changes, round(pooled.auc, 4) AS auroc_pooled, pooled.n AS meta_n_cells, round(bb.auc, 4) AS auroc_median_barcode, bb.n AS meta_n_barcodes, listed AS auroc_folds, round(ff.auc, 4) AS auroc_median_fold
        FROM pooled LEFT JOIN bb ON bb.l = pooled.l LEFT JOIN ff ON ff.l = pooled.l""",
    "class_weights": f"{WITH_CELLS}, c AS (SELECT meta_batch, meta_aa_changes = 'WT' AS is_wildtype, count(*) AS n FROM cells GROUP BY 1, 2) SELECT meta_batch, is_wildtype, round(sum(n) OVER (PARTITION BY meta_batch) / (2.0 * n), 6) AS weight FROM c",
    "profile_distances": f"{_PROFILE} SELECT x.l AS a, y.l AS b, round(sqrt({_each('pow(x.@ - y.@, 2)', ' + ')}), 5) AS value FROM p AS x JOIN p AS y ON x.l < y.l",
    "profile_correlations": f"{_PROFILE}, c AS (SELECT l, {', '.join(f'{f} - {_MEAN} AS {f}' for f in FEATURES)} FROM p) SELECT x.l AS a, y.l AS b, round(({_each('x.@ * y.@', ' + ')}) / sqrt(({_each('x.@ * x.@', ' + ')}) * ({_each('y.@ * y.@', ' + ')})), 5) AS value FROM c AS x JOIN c AS y ON x.l < y.l",
    "nearest_profiles": f"{_PROFILE}, d AS (SELECT x.l AS a, y.l AS b, {_each('abs(x.@ - y.@)', ' + ')} AS value FROM p AS x JOIN p AS y ON x.l <> y.l), r AS (SELECT *, CAST(row_number() OVER (PARTITION BY a ORDER BY value, b) AS INT) AS rank FROM d) SELECT a, b, round(value, 5) AS value, rank FROM r WHERE rank <= 3",
    "feature_pairs": f"{_PB} " + " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 5) AS value, count(*) AS n_shared FROM pb" for i, a in enumerate(FEATURES) for b in FEATURES[i + 1 :]),
    "feature_pairs_ranked": f"{_PB}, k AS (SELECT {', '.join(f'rank() OVER (ORDER BY {f}) + (count(*) OVER (PARTITION BY {f}) - 1) / 2.0 AS {f}' for f in FEATURES)} FROM pb) " + " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 5) AS value, count(*) AS n_shared FROM k" for i, a in enumerate(FEATURES) for b in FEATURES[i + 1 :]),
    "batch_pairs": f"{_PB} SELECT x.meta_batch AS a, y.meta_batch AS b, round(corr(x.price, y.price), 5) AS value, count(*) AS n_shared FROM pb AS x JOIN pb AS y USING (meta_aa_changes) WHERE x.meta_batch < y.meta_batch GROUP BY 1, 2",
    "batch_anova": f"{_PB} SELECT x.meta_batch AS a, y.meta_batch AS b, round(count(*) * pow(avg(x.price - y.price), 2) / var_samp(x.price - y.price), 4) AS f, count(*) AS n FROM pb AS x JOIN pb AS y USING (meta_aa_changes) WHERE x.meta_batch < y.meta_batch GROUP BY 1, 2",
    "batch_permanova": f"""{_PB}, d AS (SELECT x.meta_batch AS a, y.meta_batch AS b, x.quantity - y.quantity AS p, x.tax - y.tax AS q FROM pb AS x JOIN pb AS y USING (meta_aa_changes) WHERE x.meta_batch < y.meta_batch),
        s AS (SELECT a, b, count(*) AS n, sum(p * p + q * q) AS d2, count(*) / 2.0 * (pow(avg(p), 2) + pow(avg(q), 2)) AS e FROM d GROUP BY 1, 2) SELECT a, b, round(e * (n - 1) / (d2 / 2 - e), 4) AS f, n FROM s""",
    "group_tests": f"""{WITH_CELLS}, l AS ({_long('marked', 'control AS g')}), s AS (SELECT feature, count(*) FILTER (g) AS n1, count(*) FILTER (NOT g) AS n2, avg(value) FILTER (g) AS m1, avg(value) FILTER (NOT g) AS m2, var_samp(value) FILTER (g) AS v1, var_samp(value) FILTER (NOT g) AS v2, median(value) FILTER (g) AS median_1, median(value) FILTER (NOT g) AS median_2 FROM l GROUP BY 1)
        SELECT feature, n1, n2, round((m1 - m2) / sqrt(v1 / n1 + v2 / n2), 4) AS t, round((m1 - m2) / sqrt(((n1 - 1) * v1 + (n2 - 1) * v2) / (n1 + n2 - 2)), 4) AS cohens_d, round(median_1, 4) AS median_1, round(median_2, 4) AS median_2 FROM s""",
    "principal_shares": f"{_PB}, t AS (SELECT {_each('var_samp(@)', ' + ')} AS total FROM pb) SELECT component, round(total, 2) AS total FROM t, (SELECT CAST(unnest([0, 1, 2, 3]) AS INT) AS component) AS q",
    "embedding_distances": """WITH e AS (SELECT label, unnest(embedding) AS v, generate_subscripts(embedding, 1) AS i FROM embeddings), m AS (SELECT label, i, avg(CAST(v AS DOUBLE)) AS v FROM e GROUP BY 1, 2)
        SELECT x.label AS a, y.label AS b, round(1 - sum(x.v * y.v) / sqrt(sum(x.v * x.v) * sum(y.v * y.v)), 5) AS value FROM m AS x JOIN m AS y ON x.i = y.i AND x.label < y.label GROUP BY 1, 2""",
    "population_annotation": f"""{WITH_CELLS}, n AS (SELECT meta_aa_changes, count(*) AS n FROM cells GROUP BY 1),
        r AS (SELECT concat('A', p_partkey % 40, CASE p_partkey % 3 WHEN 0 THEN 'V' ELSE 'A' END) AS key, p_size, CAST(p_size AS DOUBLE) AS ac, 100.0 + p_partkey % 7 AS an, CASE WHEN p_size % 5 <> 0 THEN p_size / 50.0 END AS sp,
            CASE p_partkey % 11 WHEN 6 THEN 'B/LB' WHEN 7 THEN 'B/LB' WHEN 8 THEN 'P/LP' WHEN 10 THEN 'P/LP' END AS class FROM part),
        q AS (SELECT *, p_size % 4 <> 0 AND coalesce(sp <= 0.6, true) AS ok FROM r),
        g AS (SELECT key, bool_or(ok) AS meta_gnomad_pass, CAST(coalesce(sum(ac) FILTER (ok), 0) AS DOUBLE) AS meta_gnomad_count, CAST(max(an) FILTER (ok) AS DOUBLE) AS meta_gnomad_number, CAST(max(sp) AS DOUBLE) AS meta_gnomad_splice,
            CASE WHEN min(class) = max(class) THEN min(class) END AS meta_gnomad_clinvar_class FROM q GROUP BY 1)
        SELECT meta_aa_changes, n, meta_gnomad_pass, meta_gnomad_count, meta_gnomad_number, meta_gnomad_splice, round(meta_gnomad_count / meta_gnomad_number, 6) AS meta_gnomad_frequency, meta_gnomad_clinvar_class FROM n LEFT JOIN g ON key = meta_aa_changes""",
    "props_values": "WITH k AS (SELECT event_type, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events) SELECT event_type, count(k) AS n, CAST(sum(k) AS BIGINT) AS total, count(DISTINCT k) AS n_distinct FROM k GROUP BY 1",
    "numbered_rows": "WITH n AS (SELECT (SELECT count(*) FROM supplier) + (SELECT count(*) FROM customer) AS n) SELECT n, n AS n_distinct, CAST(0 AS BIGINT) AS first, n - 1 AS last FROM n",
    "feature_names": """WITH n AS (SELECT DISTINCT concat_ws('_', p_brand, 'Area', CASE p_partkey % 3 WHEN 0 THEN 'median' WHEN 1 THEN 'KS' ELSE 'size' END) AS name FROM part)
        SELECT name, CASE WHEN name LIKE '%\\_median' ESCAPE '\\' OR name LIKE '%\\_KS' ESCAPE '\\' THEN concat_ws('_', split_part(name, '_', 1), 'Area') ELSE name END AS base, CASE WHEN name LIKE '%\\_median' ESCAPE '\\' THEN 'median' WHEN name LIKE '%\\_KS' ESCAPE '\\' THEN 'KS' END AS statistic FROM n""",
}
