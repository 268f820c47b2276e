"""Distances and correlations between rows or columns, tests between batches, and neighbours.

Matrices are long frames ``a, b, value``; they are pivoted only for output.
"""

from __future__ import annotations

import json
from itertools import combinations

from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from assayframe.functions.columns import finite
from assayframe.functions.vectors import METRICS, _dot
from assayframe.operators.inference import student_neg_log10
from assayframe.operators.reduce import column_pairs, components, components_for

#: Rows that are compared all with all at most; a matrix of their pairs is the result itself.
MOST_ROWS = 20_000
#: Rows that the others meet at a time.
BLOCK_BYTES = 64 << 20


def between_rows(df: DataFrame, key: str, vector: Column, metric: str = "euclidean", squared: bool = False) -> DataFrame:
    """``a, b, value`` for a < b over rows of finite vectors; of at most MOST_ROWS rows, since all pairs are the result."""
    prepare, combine = METRICS[metric]
    rows = df.select(F.col(key).alias("key"), vector.cast("array<double>").alias("raw")).where(F.forall("raw", lambda v: finite(v).isNotNull()))
    rows = rows.select("key", prepare(F.col("raw")).alias("v"))
    if rows.limit(MOST_ROWS + 1).count() > MOST_ROWS:
        raise ValueError(f"all pairs of more than {MOST_ROWS} rows")
    left, right = rows.select(F.col("key").alias("a"), F.col("v").alias("x")), rows.select(F.col("key").alias("b"), F.col("v").alias("y"))
    value = combine(F.col("x"), F.col("y"))
    size = right.agg(F.sum(F.size("y") * 8 + 64)).first()[0] or 0
    blocks, out = max(1, -(-size // BLOCK_BYTES)), None
    for i in range(blocks):  # one side is sent out in blocks
        some = right.where(F.pmod(F.xxhash64("b"), F.lit(blocks)) == i) if blocks > 1 else right
        part = left.join(F.broadcast(some), F.col("a") < F.col("b")).select("a", "b", (value * value if squared else value).alias("value"))
        out = part if out is None else out.union(part)
    return out


def to_distance(matrix: DataFrame) -> DataFrame:
    return matrix.withColumn("value", 1 - F.col("value"))


def symmetric(matrix: DataFrame, diagonal: float | None = None) -> DataFrame:
    """Both directions of each pair and, if given, the diagonal."""
    out = matrix.union(matrix.select(F.col("b").alias("a"), F.col("a").alias("b"), "value"))
    if diagonal is None:
        return out
    names = out.select("a").distinct()
    return out.union(names.select("a", F.col("a").alias("b"), F.lit(diagonal).alias("value")))


def nearest(matrix: DataFrame, k: int) -> DataFrame:
    """``a, b, value, rank`` of the k nearest others of each row, ties by name."""
    order = Window.partitionBy("a").orderBy("value", "b")
    return symmetric(matrix).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def between_columns(df: DataFrame, columns: list[str], metric: str = "pearson", least: int = 3) -> DataFrame:
    """``a, b, value, n_shared`` over rows in which both columns are finite; fewer than ``least`` give null.

    Pearson and Euclidean moments of all pairs come from packed matrices;
    Spearman ranks within each pair's shared rows.
    """
    pairs = list(combinations(columns, 2))
    if metric == "spearman":
        rows = df.select(F.monotonically_increasing_id().alias("row"), *(finite(c).alias(c) for c in columns))
        each = F.explode(F.array(*(F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(a).alias("x"), F.col(b).alias("y")) for a, b in pairs)))
        long = rows.select("row", each.alias("p")).select("row", "p.*").where("x is not null and y is not null")
        mean_rank = lambda c: F.rank().over(Window.partitionBy("a", "b").orderBy(c)) + (F.count("*").over(Window.partitionBy("a", "b", c)) - 1) / 2.0
        ranked = long.select("a", "b", mean_rank("x").alias("x"), mean_rank("y").alias("y"))
        stats = ranked.groupBy("a", "b").agg(F.count("*").alias("n_shared"), F.try_divide(F.covar_pop("x", "y"), F.stddev_pop("x") * F.stddev_pop("y")).alias("value"))
        return stats.select("a", "b", F.when(F.col("n_shared") >= least, F.col("value")).alias("value"), "n_shared")
    return column_pairs(df, columns, metric, least)


def batch_correlations(df: DataFrame, label: str, batch: str, score: str) -> DataFrame:
    """Pearson's r of a score between all pairs of batches over shared labels, with their number."""
    rows = df.where(finite(score).isNotNull())
    left = rows.select(F.col(label).alias("l"), F.col(batch).alias("a"), finite(score).alias("x"))
    right = rows.select(F.col(label).alias("l"), F.col(batch).alias("b"), finite(score).alias("y"))
    pairs = left.join(right, "l").where(F.col("a") < F.col("b"))  # a label has a row a batch
    return pairs.groupBy("a", "b").agg(F.try_divide(F.covar_pop("x", "y"), F.stddev_pop("x") * F.stddev_pop("y")).alias("value"), F.count("*").alias("n_shared"))


def batch_anova(df: DataFrame, label: str, batch: str, score: str, least: int = 3) -> DataFrame:
    """Paired F (the squared t of the differences on shared labels) of each pair of batches, with -log10 of its p and n; fewer than ``least`` labels, or equal differences, give null."""
    rows = df.where(finite(score).isNotNull())
    left = rows.select(F.col(label).alias("l"), F.col(batch).alias("a"), finite(score).alias("x"))
    right = rows.select(F.col(label).alias("l"), F.col(batch).alias("b"), finite(score).alias("y"))
    d = F.col("x") - F.col("y")
    stats = left.join(right, "l").where(F.col("a") < F.col("b")).groupBy("a", "b").agg(F.count("*").alias("n"), F.avg(d).alias("m"), F.var_samp(d).alias("v"))
    f = F.try_divide(F.col("n") * F.col("m") * F.col("m"), F.col("v"))
    enough = (F.col("n") >= least) & f.isNotNull()
    return stats.select("a", "b", F.when(enough, f).alias("f"), F.when(enough, student_neg_log10(F.sqrt(f), F.col("n") - 1)).alias("neg_log_p"), "n")


def permanova(df: DataFrame, label: str, batch: str, vector: Column, permutations: int = 99, seed: int = 0) -> DataFrame:
    """Pseudo-F of each pair of batches with labels as blocks, Euclidean, and p from swaps within labels.

    With one row a batch and label, the batch sum of squares is n/2 times the
    squared length of the mean signed difference, and what is left after labels
    and batches follows from the total.  Signs come from a seeded hash.
    """
    rows = df.select(F.col(label).alias("l"), F.col(batch).alias("g"), vector.cast("array<double>").alias("v")).where(F.forall("v", lambda x: finite(x).isNotNull()))
    left, right = rows.select("l", F.col("g").alias("a"), F.col("v").alias("x")), rows.select("l", F.col("g").alias("b"), F.col("v").alias("y"))
    diff = left.join(right, "l").where(F.col("a") < F.col("b")).select("a", "b", "l", F.zip_with("x", "y", lambda p, q: p - q).alias("d"))
    swaps = diff.withColumn("turn", F.explode(F.sequence(F.lit(0), F.lit(permutations))))
    sign = F.when((F.col("turn") == 0) | (F.pmod(F.xxhash64(F.lit(seed), "turn", "l"), F.lit(2)) == 0), 1.0).otherwise(-1.0)
    terms = swaps.select("a", "b", "turn", "l", _dot(F.col("d"), F.col("d")).alias("d2"), F.posexplode(F.transform("d", lambda v: v * sign)).alias("i", "s"))
    means = terms.groupBy("a", "b", "turn", "i").agg(F.avg("s").alias("m"), F.count("*").alias("n"), F.sum("d2").alias("d2"))
    stats = means.groupBy("a", "b", "turn").agg(F.sum(F.col("m") * F.col("m")).alias("m2"), F.max("n").alias("n"), F.max("d2").alias("d2"))
    effect = F.col("n") / 2 * F.col("m2")
    f = stats.select("a", "b", "turn", "n", F.try_divide(effect * (F.col("n") - 1), F.col("d2") / 2 - effect).alias("f"))
    first = Window.partitionBy("a", "b")
    observed = F.max(F.when(F.col("turn") == 0, F.col("f"))).over(first)
    tested = f.withColumn("observed", observed)
    return tested.groupBy("a", "b").agg(F.max("observed").alias("f"), (F.count_if((F.col("turn") > 0) & (F.col("f") >= F.col("observed"))) + 1).alias("k"), F.max("n").alias("n")).select("a", "b", "f", (F.col("k") / (permutations + 1)).alias("p"), "n")


def group_tests(df: DataFrame, group: Column, features: list[str]) -> DataFrame:
    """Per feature: Welch's t and Cohen's d of rows where ``group`` holds against the others, and both medians and sizes."""
    each = F.explode(F.array(*(F.struct(F.lit(f).alias("feature"), finite(f).alias("value")) for f in features)))
    long = df.select(F.coalesce(group, F.lit(False)).alias("g"), each.alias("p")).select("g", "p.*").where("value is not null")
    a, b = F.when(F.col("g"), F.col("value")), F.when(~F.col("g"), F.col("value"))
    s = long.groupBy("feature").agg(F.count(a).alias("n1"), F.count(b).alias("n2"), F.avg(a).alias("m1"), F.avg(b).alias("m2"), F.var_samp(a).alias("v1"), F.var_samp(b).alias("v2"), F.median(a).alias("median_1"), F.median(b).alias("median_2"))
    pooled = F.sqrt(((F.col("n1") - 1) * F.col("v1") + (F.col("n2") - 1) * F.col("v2")) / (F.col("n1") + F.col("n2") - 2))
    apart = F.col("m1") - F.col("m2")
    return s.select("feature", "n1", "n2", F.try_divide(apart, F.sqrt(F.col("v1") / F.col("n1") + F.col("v2") / F.col("n2"))).alias("t"), F.try_divide(apart, pooled).alias("cohens_d"), "median_1", "median_2")


pca = components


def kmeans(df: DataFrame, vector: Column, k: int, seed: int = 0) -> DataFrame:
    """``df`` with ``cluster``, a string."""
    from pyspark.ml.clustering import KMeans

    rows = df.withColumn("__v", array_to_vector(vector.cast("array<double>")))
    model = KMeans(k=k, seed=seed, featuresCol="__v", predictionCol="__cluster").fit(rows)
    return model.transform(rows).withColumn("cluster", F.col("__cluster").cast("string")).drop("__v", "__cluster")


def variance_threshold(df: DataFrame, features: list[str], frequency_ratio: float = 0.05, unique_ratio: float = 0.01) -> list[str]:
    """Features of nearly no variance: the second most frequent value is rare against the first, or distinct values are few."""
    each = F.explode(F.array(*(F.struct(F.lit(f).alias("feature"), finite(f).alias("value")) for f in features)))
    counts = df.select(each.alias("p")).select("p.*").where("value is not null").groupBy("feature", "value").agg(F.count("*").alias("c"))
    rank = F.row_number().over(Window.partitionBy("feature").orderBy(F.desc("c"), "value"))
    stats = counts.withColumn("r", rank).groupBy("feature").agg(F.max(F.when(F.col("r") == 1, F.col("c"))).alias("c1"), F.coalesce(F.max(F.when(F.col("r") == 2, F.col("c"))), F.lit(0)).alias("c2"), F.count("*").alias("k"), F.sum("c").alias("n"))
    poor = stats.where((F.col("c2") / F.col("c1") < frequency_ratio) | (F.col("k") / F.col("n") < unique_ratio))
    return sorted(r[0] for r in poor.select("feature").collect())


def correlated_features(df: DataFrame, features: list[str], threshold: float = 0.9) -> list[str]:
    """Features to drop so that no pair above the threshold is left: of each such pair the one of greater summed correlation, ties by name."""
    found = between_columns(df, features).where("value is not null").select("a", "b", F.abs("value").alias("r")).collect()  # features squared
    total = {f: sum(r["r"] for r in found if f in (r["a"], r["b"])) for f in features}
    dropped: set[str] = set()
    for r in sorted((r for r in found if r["r"] > threshold), key=lambda r: (-r["r"], r["a"], r["b"])):
        if not {r["a"], r["b"]} & dropped:
            dropped.add(max(r["a"], r["b"], key=lambda f: (total[f], f)))
    return sorted(dropped)


def unfit_features(df: DataFrame, features: list[str], na_share: float = 0.05, outlier: float = 500.0) -> list[str]:
    """Features with too many missing values, or a value beyond the outlier cut-off, in one pass."""
    s = df.agg(F.count("*").alias("n"), *(F.count(finite(f)).alias(f"k{i}") for i, f in enumerate(features)), *(F.max(F.abs(finite(f))).alias(f"x{i}") for i, f in enumerate(features))).first()
    return [f for i, f in enumerate(features) if s["n"] and (1 - s[f"k{i}"] / s["n"] > na_share or (s[f"x{i}"] or 0) > outlier)]


def noisy_features(df: DataFrame, features: list[str], within: list[str], most: float = 0.8) -> list[str]:
    """Features whose standard deviation within groups, averaged over them, is above ``most``."""
    own = df.groupBy(*within).agg(*(F.stddev_samp(finite(f)).alias(f"s{i}") for i, f in enumerate(features)))
    s = own.agg(*(F.avg(f"s{i}").alias(f"s{i}") for i in range(len(features)))).first()
    return [f for i, f in enumerate(features) if (s[f"s{i}"] or 0) > most]


# The long form as tables and files


def wide(matrix: DataFrame, names: list[str], diagonal: float | None = None, fill: float | None = None) -> DataFrame:
    """A row ``a`` a name and a column a name, both directions filled; what is missing is ``fill``."""
    rows = symmetric(matrix, diagonal).where(F.col("a").cast("string").isin(names))
    out = rows.groupBy("a").pivot("b", names).agg(F.max("value"))
    return out if fill is None else out.fillna(fill, names)


def align(matrix: DataFrame, names: list[str]) -> DataFrame:
    """The pairs of the named rows with their places ``i, j`` in ``names``; a name without any pair is an error when the frame is used."""
    order = matrix.sparkSession.createDataFrame([(n, i) for i, n in enumerate(names)], "name string, place int")  # as many as are named
    place = lambda side, to: order.select(F.col("name").alias(side), F.col("place").alias(to))
    kept = matrix.withColumns({c: F.col(c).cast("string") for c in "ab"}).join(F.broadcast(place("a", "i")), "a").join(F.broadcast(place("b", "j")), "b")
    held = matrix.select(F.col("a").cast("string").alias("name")).union(matrix.select(F.col("b").cast("string"))).distinct()
    missing = order.join(held, "name", "left_anti").agg(F.array_join(F.sort_array(F.collect_list("name")), ", ").alias("names"))
    told = missing.select(F.assert_true(F.col("names") == "", F.concat(F.lit("no such row: "), "names")).alias("__ok"))
    return kept.join(F.broadcast(told), F.col("__ok").isNull()).select("a", "b", "value", "i", "j")


def save(matrix: DataFrame, path: str, **parameters: str | float | bool) -> None:
    """Writes a long matrix or test table sorted, with its parameters as a JSON column."""
    matrix.withColumn("_parameters", F.lit(json.dumps(parameters, sort_keys=True))).orderBy("a", "b").write.mode("overwrite").parquet(path)


def load(spark: SparkSession, path: str) -> tuple[DataFrame, dict]:
    """What ``save`` wrote, and its parameters."""
    rows = spark.read.parquet(path)
    one = rows.select("_parameters").first()
    return rows.drop("_parameters"), json.loads(one[0]) if one else {}
