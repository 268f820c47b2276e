"""Moments of all pairs of columns, principal components, and impact scores on features or components.

Moments are summed as packed matrices: each task multiplies its rows' blocks and
gives a row of each matrix per column, which are added up column by column.  The
plan is of the same size for any number of columns.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayframe.functions.columns import finite
from assayframe.functions.vectors import METRICS
from assayframe.operators import aggregate

#: Rows that are multiplied at a time.
BLOCK = 4096
MOMENTS = ("n", "x", "xx", "xy")


def pair_moments(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``i`` and, for each column j, arrays over rows where both i and j are finite: ``n``, sums ``x`` and ``xx`` of column i and its square, ``xy``.

    Columns are shifted by their means first (``shift``), so that little is lost in the sums.
    """
    k = len(columns)
    means = df.agg(*(F.coalesce(F.avg(finite(c)), F.lit(0.0)).alias(f"m{i}") for i, c in enumerate(columns)))
    vector = F.array(*(finite(c) for c in columns))
    rows = df.select(vector.alias("v")).join(F.broadcast(means.select(F.array(*(f"m{i}" for i in range(k))).alias("shift"))))  # a row
    fields = [("i", pa.int32()), *((m, pa.list_(pa.float64())) for m in MOMENTS), ("shift", pa.float64())]

    def packed(total: Sequence[np.ndarray], shift: np.ndarray, places: Sequence[int]) -> pa.RecordBatch:
        lists = [pa.ListArray.from_arrays(pa.array(np.arange(len(places) + 1) * k, pa.int32()), pa.array(t.ravel())) for t in total]
        return pa.RecordBatch.from_arrays([pa.array(places, pa.int32()), *lists, pa.array(shift)], [n for n, _ in fields])

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, shift = None, np.zeros(k)
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK):
                part = batch.slice(start, BLOCK)
                shift = part.column(1).slice(0, 1).flatten().to_numpy(zero_copy_only=False)
                x = part.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, k) - shift
                there = np.isfinite(x)
                x, there = np.where(there, x, 0.0), there.astype(float)
                own = (there.T @ there, x.T @ there, (x * x).T @ there, x.T @ x)
                total = own if total is None else tuple(t + o for t, o in zip(total, own))
        if total is not None:
            yield packed(total, shift, range(k))

    def added(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        sums = [group.column(m).combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, k).sum(axis=0) for m in MOMENTS]
        return pa.Table.from_batches([packed([s[None] for s in sums], group.column("shift").to_numpy()[:1], [group.column("i")[0].as_py()])])

    schema = "i int, n array<double>, x array<double>, xx array<double>, xy array<double>, shift double"
    return rows.mapInArrow(products, schema).groupBy("i").applyInArrow(added, schema)


def column_pairs(df: DataFrame, columns: Sequence[str], metric: str = "pearson", least: int = 3) -> DataFrame:
    """``a, b, value, n_shared`` of all pairs of columns by Pearson's r or Euclidean distance; fewer than ``least`` shared rows give null."""
    rows = pair_moments(df, columns)
    cells = rows.select("i", "shift", F.posexplode(F.arrays_zip("n", "x", "xx", "xy")).alias("j", "m")).select("i", "j", "shift", "m.*")
    left = cells.where("i < j").withColumnsRenamed({"shift": "s"})
    right = cells.where("i > j").select(F.col("i").alias("k"), F.col("j").alias("l"), F.col("x").alias("y"), F.col("xx").alias("yy"), F.col("shift").alias("u"))
    both = left.join(right, (F.col("i") == F.col("l")) & (F.col("j") == F.col("k")))
    n, x, y, xx, yy, xy = (F.col(c) for c in ("n", "x", "y", "xx", "yy", "xy"))
    if metric == "pearson":
        vx, vy = F.greatest(xx - x * x / n, F.lit(0.0)), F.greatest(yy - y * y / n, F.lit(0.0))
        flat = (vx <= 1e-24 * xx) | (vy <= 1e-24 * yy)
        value = F.when(~flat, (xy - x * y / n) / F.sqrt(vx * vy))
    elif metric == "euclidean":
        apart = F.col("s") - F.col("u")
        value = F.sqrt(F.greatest(xx + yy - 2 * xy + 2 * apart * (x - y) + n * apart * apart, F.lit(0.0)))
    else:
        raise ValueError(f"pairs of columns by {metric}")
    name = lambda c: F.element_at(F.array(*map(F.lit, columns)), F.col(c) + 1)
    return both.select(name("i").alias("a"), name("j").alias("b"), F.when(n >= least, value).alias("value"), n.cast("long").alias("n_shared"))


def components(df: DataFrame, features: Sequence[str], whiten: bool = False, prefix: str = "pc_") -> tuple[DataFrame, np.ndarray, np.ndarray]:
    """All principal components: ``df`` with ``pc_<i>``, loadings and explained shares.

    Only rows of finite values count.  The covariance, of the number of features
    squared, is decomposed on the driver; the largest loading of each component
    is positive.  Other rows get nulls.
    """
    k = len(features)
    whole = F.forall(F.array(*(finite(f) for f in features)), lambda v: v.isNotNull())
    found = {r["i"]: r for r in pair_moments(df.where(whole), features).collect()}
    n = found[0]["n"][0] if found else 0
    x, shift = (np.array([found[i]["x"][i] for i in range(k)]), np.array([found[i]["shift"] for i in range(k)])) if found else (np.zeros(k), np.zeros(k))
    cov = (np.array([found[i]["xy"] for i in range(k)]) - np.outer(x, x) / n) / (n - 1) if n > 1 else np.zeros((k, k))
    values, vectors = np.linalg.eigh(cov)
    values, vectors = np.maximum(values[::-1], 0), vectors[:, ::-1]
    vectors = vectors * np.where(vectors.max(axis=0) >= -vectors.min(axis=0), 1, -1)
    weights = vectors / np.where(values > 0, np.sqrt(values), 1) if whiten else vectors
    centre = shift + (x / n if n else 0)
    dots = F.transform(F.lit(weights.T.tolist()), lambda row: F.aggregate(F.zip_with(row, F.zip_with(F.array(*(finite(f) for f in features)), F.lit(centre.tolist()), lambda v, m: v - m), lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v))
    own = df.withColumn("__pcs", F.when(whole, dots))
    return own.select("*", *(F.get("__pcs", F.lit(i)).alias(f"{prefix}{i}") for i in range(k))).drop("__pcs"), vectors, values / values.sum() if values.sum() else values


def components_for(shares: np.ndarray, variance: float) -> int:
    """Fewest components that reach a share of the variance, or all."""
    if not 0 < variance <= 1:
        raise ValueError("a share of the variance is above 0 and at most 1")
    return min(len(shares), int(np.searchsorted(np.cumsum(shares), variance - 1e-12) + 1))


#: Distances that have a largest value, which an impact score divides by; similarities are turned into 1 - s.
BOUNDS = {"cosine": 2.0, "cosine_distance": 2.0, "pearson": 2.0, "spearman": 2.0}


def impact_score(profiles: DataFrame, control: Column, features: Sequence[str], to: str = "impact_score", metric: str = "cosine_distance") -> DataFrame:
    """Distance of each profile to the median control profile over the features both have, divided by the metric's bound, if it has one.

    Cosines are ``aggregate.impact_score``'s, 0.5 without a usable feature; other
    metrics give null there and where they aren't defined.
    """
    if metric in ("cosine", "cosine_distance"):
        return aggregate.impact_score(profiles, control, list(features), to)
    prepare, combine = METRICS[metric]
    middle = profiles.where(control).agg(F.array(*(F.median(finite(f)) for f in features)).alias("__middle"))
    pairs = F.filter(F.arrays_zip(F.array(*(finite(f) for f in features)).alias("x"), F.col("__middle").alias("y")), lambda p: p["x"].isNotNull() & p["y"].isNotNull())
    rows = profiles.drop(to).join(F.broadcast(middle)).withColumn("__pairs", pairs)  # a row
    value = combine(prepare(F.transform("__pairs", lambda p: p["x"])), prepare(F.transform("__pairs", lambda p: p["y"])))
    value = (1 - value) / BOUNDS[metric] if metric in ("pearson", "spearman") else value
    return rows.withColumn(to, F.when(F.size("__pairs") > 0, value)).drop("__middle", "__pairs")


def impact_scores(profiles: DataFrame, control: Column, features: Sequence[str], variances: Sequence[float] = (0.7, 0.8, 0.9, 1.0), metric: str = "cosine_distance", prefix: str = "meta_impact_score_") -> DataFrame:
    """An impact score on the leading components of each share of the variance; the components are made once."""
    if not variances:
        raise ValueError("no share of the variance")
    out, _, shares = components(profiles, features, prefix="__pc_")
    for v in variances:
        out = impact_score(out, control, [f"__pc_{i}" for i in range(components_for(shares, v))], f"{prefix}{v}", metric)
    return out.drop(*(f"__pc_{i}" for i in range(len(features))))


def reduced(profiles: DataFrame, label: str, control: Column, features: Sequence[str], variance: float) -> DataFrame:
    """``label``, the leading components ``meta_pc_1...`` of a share of the variance, ``meta_is_control`` and ``meta_impact_score`` on them."""
    out, _, shares = components(profiles, features)
    own = [f"pc_{i}" for i in range(components_for(shares, variance))]
    out = aggregate.impact_score(out.withColumn("meta_is_control", F.coalesce(control, F.lit(False))), F.col("meta_is_control"), own, "meta_impact_score")
    return out.select(label, *(F.col(c).alias(f"meta_pc_{i + 1}") for i, c in enumerate(own)), "meta_is_control", "meta_impact_score")
