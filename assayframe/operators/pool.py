"""Pooling of per-variant tables across batches, and summaries of the pooled profiles."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assayframe.functions import labels
from assayframe.functions.columns import common_features, finite
from assayframe.operators import normalize


def stack(batches: Mapping[str, DataFrame], batch: str = "meta_batch") -> DataFrame:
    """Union of the common columns, each row tagged with its batch."""
    shared, _ = common_features(dict(batches))
    meta = [c for c in next(iter(batches.values())).columns if c.startswith("meta_") and all(c in b.columns for b in batches.values())]
    out = None
    for name, df in batches.items():
        part = df.select(*meta, *shared).withColumn(batch, F.lit(name))
        out = part if out is None else out.unionByName(part)
    return out


def median_across(df: DataFrame, label: str, features: list[str], batch: str, summed: list[str] = (), first: list[str] = ()) -> DataFrame:
    """Median of each feature over batches, sums of counts, first other metadata by batch, and the number of batches."""
    return df.groupBy(label).agg(
        *(F.median(finite(f)).alias(f) for f in features),
        *(F.sum(c).alias(c) for c in summed),
        *(F.min_by(c, batch).alias(c) for c in first),
        F.count_distinct(batch).alias("meta_n_batches"),
    )


def paired_median(df: DataFrame, label: str, value: str, companion: str) -> DataFrame:
    """Value and companion of the row that holds the lower middle value; ties by companion, nulls last; without a value both are null."""
    pairs = F.array_sort(F.collect_list(F.when(finite(value).isNotNull(), F.struct(finite(value).alias("v"), F.col(companion).isNull().alias("n"), F.col(companion).alias("c")))))
    middle = F.get("pairs", F.floor((F.size("pairs") - 1) / 2).cast("int"))
    return df.groupBy(label).agg(pairs.alias("pairs")).select(label, middle["v"].alias(value), middle["c"].alias(companion))


def per_variant(df: DataFrame, label: str, scores: list[str], counts: list[str] = (), how: str = "median") -> DataFrame:
    """Median or mean of scores over batches, summed counts, and the number of batches with each score."""
    one = F.median if how == "median" else F.avg
    return df.groupBy(label).agg(*(one(finite(s)).alias(s) for s in scores), *(F.sum(c).alias(c) for c in counts), *(F.count(finite(s)).alias(f"n_{s}") for s in scores))


def global_scores(df: DataFrame, label: str, batch: str, score: str, control: Column) -> DataFrame:
    """Scores z-scored per batch to its controls, then their median and number per variant."""
    z = normalize.zscore(df, control, [score], by=[batch])
    return z.groupBy(label).agg(F.median(score).alias(score), F.count(score).alias(f"n_{score}"))


def cluster_shares(df: DataFrame, cluster: str, shares: Mapping[str, Column]) -> DataFrame:
    """Per cluster and named condition: how many of its rows hold it, and their share of all rows that do."""
    each = df.groupBy(cluster).agg(*(F.count_if(F.coalesce(c, F.lit(False))).alias(f"n{i}") for i, c in enumerate(shares.values())))
    long = each.select(cluster, F.explode(F.array(*(F.struct(F.lit(name).alias("level"), F.col(f"n{i}").alias("k")) for i, name in enumerate(shares)))).alias("p")).select(cluster, "p.*")
    return long.withColumn("share", F.try_divide(F.col("k").cast("double"), F.sum("k").over(Window.partitionBy("level"))))


def cluster_summary(df: DataFrame, cluster: str, features: list[str], level: str) -> DataFrame:
    """Rows and feature medians per cluster, with each level's share of its own rows that the cluster holds (``level, share``)."""
    medians = df.groupBy(cluster).agg(F.count("*").alias("n"), *(F.median(finite(f)).alias(f) for f in features))
    counts = df.groupBy(cluster, level).agg(F.count("*").alias("k"))
    shares = counts.withColumn("share", F.col("k") / F.sum("k").over(Window.partitionBy(level))).select(F.col(cluster).alias("__cluster"), level, "share")
    return medians.join(shares, F.col(cluster).eqNullSafe(F.col("__cluster"))).drop("__cluster")


def per_position(df: DataFrame, position: str, score: str, how: str = "mean", threshold: float | None = None, absolute: bool = False) -> DataFrame:
    """Mean, median, min, max or share above ``threshold`` of the scores at each position, and their number."""
    value = F.abs(finite(score)) if absolute else finite(score)
    made = {"mean": F.avg, "median": F.median, "min": F.min, "max": F.max}.get(how)
    stat = made(value) if made else F.avg((value > threshold).cast("double"))
    return df.where(F.col(position).isNotNull()).groupBy(position).agg(stat.alias(score), F.count(value).alias("n"))


def commonest(df: DataFrame, by: str, value: str) -> DataFrame:
    """The most frequent value of each group, ties by value."""
    counts = df.groupBy(by, value).agg(F.count("*").alias("n"))
    rank = F.row_number().over(Window.partitionBy(by).orderBy(F.desc("n"), value))
    return counts.withColumn("__r", rank).where("__r = 1").select(by, value)


def one_class(df: DataFrame, key: str, value: str) -> DataFrame:
    """Keys of a single value, nulls aside; conflicting keys are left out."""
    return df.groupBy(key).agg(F.min(value).alias(value), F.max(value).alias("__max")).where(F.col(value) == F.col("__max")).drop("__max")


def pivot_unique(df: DataFrame, label: str, column: str, value: str, names: list[str]) -> DataFrame:
    """One column a name, one row a label; two values for one cell are an error."""
    one = F.when(F.count(F.lit(1)) > 1, F.raise_error(F.concat(F.lit("several values for "), F.max(F.col(label).cast("string"))))).otherwise(F.max(value))
    return df.groupBy(label).pivot(column, names).agg(one)


def hexagons(df: DataFrame, x: str, y: str, size: float) -> DataFrame:
    """``df`` with the centre ``hex_x, hex_y`` of the hexagon (of width ``size``) that each point lies in."""
    wide, high = size, size * 3**0.5
    cx, cy = [F.round(F.col(x) / wide) * wide, (F.floor(F.col(x) / wide) + 0.5) * wide], [F.round(F.col(y) / high) * high, (F.floor(F.col(y) / high) + 0.5) * high]
    far = [F.pow(F.col(x) - a, 2) + F.pow(F.col(y) - b, 2) for a, b in zip(cx, cy)]
    nearer = far[0] <= far[1]
    return df.withColumn("hex_x", F.when(nearer, cx[0]).otherwise(cx[1])).withColumn("hex_y", F.when(nearer, cy[0]).otherwise(cy[1]))


def auc(df: DataFrame, score: str, truth: Column, by: list[str] = ()) -> DataFrame:
    """ROC area, ``n_positive`` and ``n_negative`` per group; NaN if one class is missing.

    Scores are counted before any window, so ties and sizes don't matter.
    """
    rows = df.where(finite(score).isNotNull() & truth.isNotNull())
    counts = rows.groupBy(*by, finite(score).alias("s")).agg(F.count_if(truth).alias("p"), F.count_if(~truth).alias("q"))
    below = F.sum("q").over(Window.partitionBy(*by).orderBy("s")) - F.col("q")
    u = counts.withColumn("u", F.col("p") * (below + F.col("q") / 2))
    out = u.groupBy(*by).agg(F.sum("p").alias("n_positive"), F.sum("q").alias("n_negative"), F.sum("u").alias("u"))
    pairs = F.col("n_positive") * F.col("n_negative")
    return out.select(*by, "n_positive", "n_negative", F.when(pairs > 0, F.col("u") / pairs).otherwise(float("nan")).alias("auc"))


def roc_points(df: DataFrame, score: str, truth: Column, by: list[str]) -> DataFrame:
    """``fpr, tpr`` for each distinct score as the threshold."""
    rows = df.where(finite(score).isNotNull() & truth.isNotNull())
    counts = rows.groupBy(*by, finite(score).alias("threshold")).agg(F.count_if(truth).alias("p"), F.count_if(~truth).alias("q"))
    down, whole = Window.partitionBy(*by).orderBy(F.desc("threshold")), Window.partitionBy(*by)
    rate = lambda c: F.try_divide(F.sum(c).over(down), F.sum(c).over(whole))
    return counts.select(*by, "threshold", rate("q").alias("fpr"), rate("p").alias("tpr"))


def distinguishability(profiles: DataFrame, scores: DataFrame, label: str, score: str = "auroc_pooled", batch: str | None = "meta_batch", control: Column | None = None, correct: bool = True, rescale: bool = True, to: str = "meta_distinguishability_score") -> DataFrame:
    """``profiles`` with a score of each variant, null without one.

    Scores of batches are corrected against the control rows (all without
    ``control``) and their medians taken; scores without ``batch`` are joined as they are.
    """
    rows, name = scores, score
    if batch is not None and batch in scores.columns:
        if correct:
            rows, name = normalize.correct_scores(rows, [score], batch, control, rescale), f"{score}_corrected"
        rows = per_variant(rows, label, [name])
    right = rows.select(F.col(label).alias("__label"), F.col(name).alias(to))
    return profiles.drop(to).join(right, F.col(label).eqNullSafe(F.col("__label")), "left").drop("__label")


def first_metadata(df: DataFrame, metadata: DataFrame, label: str, batch: str) -> DataFrame:
    """``df`` with the first row of each label's metadata of its batch; columns that ``df`` has stay."""
    own = [c for c in metadata.columns if c not in df.columns]
    rank = F.row_number().over(Window.partitionBy(label, batch).orderBy(*own))
    right = metadata.withColumn("__r", rank).where("__r = 1").select(F.col(label).alias("__label"), F.col(batch).alias("__batch"), *own)
    return df.join(right, F.col(label).eqNullSafe(F.col("__label")) & F.col(batch).eqNullSafe(F.col("__batch")), "left").select(*df.columns, *own)


def viewer_scores(df: DataFrame, label: str, score: str, batch: str, control: Column, correct: bool = True) -> DataFrame:
    """A score of each variant pooled over batches, corrected against the controls or raw, with type, position and wild type."""
    rows, name = (normalize.correct_scores(df, [score], batch, control, True), f"{score}_corrected") if correct else (df, score)
    out = rows.groupBy(label).agg(F.median(finite(name)).alias(score)).where(F.col(score).isNotNull())
    return out.select(label, score, labels.variant_type(label).alias("variant_type"), labels.position(label).alias("position"), labels.substitution(label)[0].alias("wildtype"))


def viewer_features(df: DataFrame, label: str, features: list[str], batch: str, control: Column) -> DataFrame:
    """Features z-scored per batch and pooled over batches, those without any value dropped."""
    pooled = median_across(normalize.zscore(df, control, features, by=[batch]), label, features, batch)
    held = pooled.agg(*(F.count(finite(f)).alias(f"n{i}") for i, f in enumerate(features))).first()
    return pooled.drop(*(f for i, f in enumerate(features) if not held[f"n{i}"]))
