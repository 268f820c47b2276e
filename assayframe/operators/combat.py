"""Removal of batch effects by empirical Bayes (Johnson, Li and Rabinovic 2007), the variant kept as a covariate.

The design (batches and variants) is never built: variants are projected out
by demeaning within each, which leaves one small system of batches per feature
set, summed up in the cluster and solved on the driver.  All row work is in
DataFrames.  Variances divide by the number of rows, priors use the sample
variance over features, and the fixed point stops when no batch parameter
changes by more than ``TOLERANCE`` of its value.
"""

from __future__ import annotations

from collections.abc import Mapping

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayframe.operators import pool

TOLERANCE, MOST_STEPS = 1e-4, 200


def eligible(df: DataFrame, features: list[str], label: str, batch: str) -> tuple[DataFrame, list[str]]:
    """Rows of labels seen in two batches, and features without nulls there; rows without any value go first."""
    rows = df.where(F.coalesce(*(F.col(f) for f in features)).isNotNull())
    seen = rows.groupBy(F.col(label).alias("__label")).agg(F.count_distinct(batch).alias("k")).where("k >= 2").select("__label")
    rows = rows.join(seen, F.col(label) == F.col("__label"), "left_semi")
    nulls = rows.agg(*(F.count_if(F.col(f).isNull()).alias(f) for f in features)).first()
    return rows, [f for f in features if not nulls[f]]


def combat(df: DataFrame, features: list[str], label: str, batch: str, mean_only: bool = False) -> DataFrame:
    """``df``'s eligible rows with location and scale of each batch removed from the features.

    Two batches of two rows at least are needed.  A single feature is corrected
    without priors, since there is nothing to share.
    """
    rows, own = eligible(df, features, label, batch)
    names = [r[0] for r in rows.groupBy(batch).count().where("count >= 2").orderBy(batch).collect()]  # a row a batch
    if len(names) < 2 or rows.where(~F.col(batch).isin(names)).limit(1).count():
        raise ValueError("two batches at least, and two rows in each, are needed")
    b, p = len(names), len(own)
    marks = {f"__b{i}": (F.col(batch) == n).cast("double") for i, n in enumerate(names)}
    means = rows.groupBy(F.col(label).alias("__label")).agg(*(F.avg(f).alias(f"__m{j}") for j, f in enumerate(own)), *(F.avg(m).alias(f"__mean{k}") for k, m in marks.items()))
    joined = rows.join(means, F.col(label) == F.col("__label"))
    dev = [m - F.col(f"__mean{k}") for k, m in marks.items()]
    value = [F.col(f) - F.col(f"__m{j}") for j, f in enumerate(own)]
    sums = joined.agg(
        *(F.sum(dev[i] * dev[k]).alias(f"x{i}_{k}") for i in range(b) for k in range(i, b)),
        *(F.sum(dev[i] * v).alias(f"y{i}_{j}") for i in range(b) for j, v in enumerate(value)),
        F.count("*").alias("n"),
        *(F.sum(m).alias(f"n{i}") for i, m in enumerate(marks.values())),
    ).first()
    xx = np.array([[sums[f"x{min(i, k)}_{max(i, k)}"] for k in range(b)] for i in range(b)])
    xy = np.array([[sums[f"y{i}_{j}"] for j in range(p)] for i in range(b)])
    n = np.array([sums[f"n{i}"] for i in range(b)])
    effect = np.linalg.lstsq(xx, xy, rcond=None)[0]  # batch effects up to a constant per feature
    effect -= (n[:, None] * effect).sum(axis=0) / n.sum()  # the grand mean weighs batches by their rows

    def of_batch(table: np.ndarray, j: int):
        out = F.lit(None).cast("double")
        for i, name in enumerate(names):
            out = F.when(F.col(batch) == name, float(table[i, j])).otherwise(out)
        return out

    # a row's fit is its label's mean, moved from the label's mix of batches to its own batch
    mix = [sum((F.col(f"__mean__b{i}") * float(effect[i, j]) for i in range(b)), F.lit(0.0)) for j in range(p)]
    kept = [F.col(f"__m{j}") - mix[j] for j in range(p)]  # what the variant and the grand mean explain
    resid = [F.col(f) - kept[j] - of_batch(effect, j) for j, f in enumerate(own)]
    spread = joined.agg(*(F.avg(r * r).alias(f"v{j}") for j, r in enumerate(resid))).first()
    sd = np.sqrt(np.array([spread[f"v{j}"] for j in range(p)]))
    live = [j for j in range(p) if sd[j] > 0]
    if not live:
        return rows
    standard = {j: (F.col(own[j]) - kept[j]) / float(sd[j]) for j in live}
    moments = joined.groupBy(batch).agg(*(F.avg(z).alias(f"g{j}") for j, z in standard.items()), *(F.var_samp(z).alias(f"d{j}") for j, z in standard.items()), *(F.sum(z).alias(f"s{j}") for j, z in standard.items()), *(F.sum(z * z).alias(f"q{j}") for j, z in standard.items()), F.count("*").alias("n")).collect()
    at = {r[batch]: r for r in moments}
    gamma, delta = np.zeros((b, p)), np.ones((b, p))
    for i, name in enumerate(names):
        r = at[name]
        g, d = np.array([r[f"g{j}"] for j in live]), np.array([r[f"d{j}"] for j in live])
        total, square = np.array([r[f"s{j}"] for j in live]), np.array([r[f"q{j}"] for j in live])
        if mean_only:
            d = np.ones_like(d)
        if len(live) > 1:
            g, d = shrink(g, d, total, square, r["n"], mean_only)
        gamma[i, live], delta[i, live] = g, d
    out = dict(zip(own, (F.col(f) for f in own)))
    for j in live:
        out[own[j]] = (standard[j] - of_batch(gamma, j)) / F.sqrt(of_batch(delta, j)) * float(sd[j]) + kept[j]
    return joined.select(*(out[c].alias(c) if c in out else F.col(c) for c in df.columns))


def shrink(g: np.ndarray, d: np.ndarray, total: np.ndarray, square: np.ndarray, n: int, mean_only: bool) -> tuple[np.ndarray, np.ndarray]:
    """Posterior location and scale of a batch under priors over features."""
    middle, spread = g.mean(), g.var(ddof=1)
    if mean_only:
        return (n * spread * g + middle) / (n * spread + 1), d
    m, s2 = d.mean(), d.var(ddof=1)
    shape, rate = ((2 * s2 + m * m) / s2, (m * s2 + m**3) / s2) if s2 > 0 else (np.inf, np.inf)
    own_g, own_d = g.copy(), d.copy()
    for _ in range(MOST_STEPS):
        new_g = (spread * n * g + own_d * middle) / (spread * n + own_d)
        around = square - 2 * new_g * total + n * new_g**2
        new_d = (rate + around / 2) / (n / 2 + shape - 1) if np.isfinite(shape) else np.full_like(d, m)
        change = max(np.abs((new_g - own_g) / np.where(own_g == 0, 1, own_g)).max(), np.abs((new_d - own_d) / np.where(own_d == 0, 1, own_d)).max())
        own_g, own_d = new_g, new_d
        if change <= TOLERANCE:
            break
    return own_g, own_d


def combat_features(batches: Mapping[str, DataFrame], label: str, batch: str = "meta_batch", mean_only: bool = False) -> DataFrame:
    """The common features of several batches' tables, stacked and corrected together."""
    stacked = pool.stack(batches, batch)
    return combat(stacked, [c for c in stacked.columns if not c.startswith("meta_")], label, batch, mean_only)


def combat_scores(df: DataFrame, scores: list[str], label: str, batch: str = "meta_batch", mean_only: bool = False) -> DataFrame:
    """``df`` with ``<score>_corrected``; rows and scores that can't be corrected have nulls."""
    fixed = combat(df.select(label, batch, *scores), scores, label, batch, mean_only)
    names = {s: f"{s}_corrected" for s in scores}
    _, usable = eligible(df, scores, label, batch)
    right = fixed.select(F.col(label).alias("__label"), F.col(batch).alias("__batch"), *((F.col(s) if s in usable else F.lit(None).cast("double")).alias(names[s]) for s in scores))
    return df.drop(*names.values()).join(right, F.col(label).eqNullSafe(F.col("__label")) & F.col(batch).eqNullSafe(F.col("__batch")), "left").drop("__label", "__batch")
