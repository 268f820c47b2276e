"""Tests with p-values as column expressions: correlations, groups of rows, and the points that stand out.

p-values are given as -log10 p, so small ones don't vanish; none is above that
of the smallest positive double.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayframe.functions.columns import finite
from assayframe.operators.aggregate import against_control

#: -log10 of the smallest positive normal double.
MOST = -math.log10(2.2250738585072014e-308)
#: Steps of the integrals below, which are smooth, and the |t| from which the tail is integrated instead of the middle.
STEPS, FAR = 120, 2.0
#: Series of the ratio of gamma functions at z + 1/2 and z, over the root of z, by powers of 1/z.
GAMMA_RATIO = (1.0, -1 / 8, 1 / 128, 5 / 1024, -21 / 32768, -399 / 262144)
SHIFT = 12


def _simpson(f: Callable[[Column], Column], low: Column, high: Column) -> Column:
    """Integral of a smooth function between two columns."""
    step = (high - low) / STEPS
    weight = lambda i: F.when((i == 0) | (i == STEPS), 1.0).when(i % 2 == 1, 4.0).otherwise(2.0)
    return F.aggregate(F.sequence(F.lit(0), F.lit(STEPS)), F.lit(0.0), lambda s, i: s + weight(i) * f(low + step * i)) * step / 3


def log_gamma_ratio(z: Column) -> Column:
    """Logarithm of gamma(z + 1/2) / gamma(z), z > 0: by its series, from SHIFT further on."""
    far = z + SHIFT
    series = sum((c * F.pow(far, -k) for k, c in enumerate(GAMMA_RATIO)), F.lit(0.0))
    back = F.aggregate(F.sequence(F.lit(0), F.lit(SHIFT - 1)), F.lit(0.0), lambda s, k: s + F.log((z + k) / (z + k + 0.5)))
    return F.log(far) / 2 + F.log(series) + back


def student_neg_log10(t: Column, nu: Column) -> Column:
    """-log10 of the two-sided tail of Student's distribution."""
    t, nu = F.abs(t), nu.cast("double")
    ratio = log_gamma_ratio(nu / 2)
    density = lambda u: F.exp(-(nu + 1) / 2 * F.log1p(u * u / nu))
    middle = 1 - 2 * _simpson(density, F.lit(0.0), F.least(t, F.lit(FAR))) * F.exp(ratio) / F.sqrt(nu * math.pi)
    # beyond: with x = nu / (nu + t*t) and a = nu / 2, x**a times an integral over v from 0 whose integrand ends by exp(-v*v)
    a, log_x = nu / 2, -F.log1p(t * t / nu)
    inner = lambda v: 2 * v * F.exp(-v * v) / F.sqrt(-F.expm1(log_x - v * v / a))
    log_tail = a * log_x - F.log(a) + ratio - math.log(math.pi) / 2 + F.log(_simpson(inner, F.lit(0.0), F.lit(6.5)))
    p = F.when(t <= FAR, -F.log10(F.greatest(middle, F.lit(1e-300)))).otherwise(-log_tail / math.log(10))
    return F.least(F.greatest(p, F.lit(0.0)), F.lit(MOST))


def correlation_test(df: DataFrame, x: str, y: str, metric: str = "pearson", squared: bool = False) -> DataFrame:
    """One row: ``value, neg_log_p, n`` over rows where both are finite, and how many lie ``above`` and ``below`` the identity line.

    Fewer than three rows, or a constant side, give null.  Spearman's takes mean ranks.
    """
    rows = df.select(finite(x).alias("x"), finite(y).alias("y")).where("x is not null and y is not null")
    sides = rows.agg(F.count_if(F.col("y") > F.col("x")).alias("above"), F.count_if(F.col("y") < F.col("x")).alias("below"))
    if metric == "spearman":
        from assayframe.operators.aggregate import mean_ranks

        rows = mean_ranks(mean_ranks(rows, "x"), "y")
    r = F.try_divide(F.covar_pop("x", "y"), F.stddev_pop("x") * F.stddev_pop("y"))
    one = rows.agg(F.count("*").alias("n"), r.alias("r"))
    t = F.col("r") * F.sqrt((F.col("n") - 2) / F.greatest(1 - F.col("r") * F.col("r"), F.lit(1e-300)))
    enough = F.col("n") >= 3
    made = one.select(F.when(enough, F.col("r") * F.col("r") if squared else F.col("r")).alias("value"), F.when(enough & F.col("r").isNotNull(), student_neg_log10(t, F.col("n") - 2)).alias("neg_log_p"), "n")
    return made.join(F.broadcast(sides))  # a row each


#: Names of tests and effects, and of their columns.
TESTS = {"ks": "KSnegLogP", "welch": "WelchNegLogP", "mannwhitney": "MWUnegLogP"}
EFFECTS = {"median": "median_diff", "mean": "mean_diff", "cohens_d": "cohens_d"}


def label_tests(df: DataFrame, group: Column, features: list[str], test: str = "ks", effect: str = "median") -> DataFrame:
    """``feature, n_positive, n_negative``, the effect and -log10 p of rows where ``group`` holds against those where it doesn't.

    ``ks`` has the limiting tail, ``mannwhitney`` the normal one with ties and
    without continuity correction, ``welch`` Student's with Welch's degrees of
    freedom.  Values that aren't finite, and rows of a null group, don't count.
    """
    for name, known in ((test, TESTS), (effect, EFFECTS)):
        if name not in known:
            raise ValueError(f"{name} is none of {', '.join(known)}")
    rows = df.where(group.isNotNull()).withColumn("__g", group)
    each = F.explode(F.array(*(F.struct(F.lit(f).alias("feature"), finite(f).alias("value")) for f in features)))
    long = rows.select("__g", each.alias("p")).select("__g", "p.*")
    a, b = F.when(F.col("__g"), F.col("value")), F.when(~F.col("__g"), F.col("value"))
    made = [F.count(a).alias("n_positive"), F.count(b).alias("n_negative"), F.avg(a).alias("m1"), F.avg(b).alias("m2"), F.var_samp(a).alias("v1"), F.var_samp(b).alias("v2")]
    made += [F.median(a).alias("d1"), F.median(b).alias("d2")] if effect == "median" else []
    s = long.groupBy("feature").agg(*made)
    n1, n2, v1, v2 = (F.col(c) for c in ("n_positive", "n_negative", "v1", "v2"))
    pooled = F.sqrt(F.try_divide((n1 - 1) * v1 + (n2 - 1) * v2, n1 + n2 - 2))
    size = {"median": lambda: F.col("d1") - F.col("d2"), "mean": lambda: F.col("m1") - F.col("m2"), "cohens_d": lambda: F.try_divide(F.col("m1") - F.col("m2"), pooled)}[effect]()
    out = s.select("feature", "n_positive", "n_negative", size.alias(EFFECTS[effect]), "m1", "m2", "v1", "v2")
    if test == "welch":
        spread = v1 / n1 + v2 / n2
        nu = F.try_divide(spread * spread, F.pow(v1 / n1, 2) / (n1 - 1) + F.pow(v2 / n2, 2) / (n2 - 1))
        t = F.try_divide(F.col("m1") - F.col("m2"), F.sqrt(spread))
        return out.withColumn(TESTS[test], F.when(t.isNotNull() & (nu > 0), student_neg_log10(t, nu))).drop("m1", "m2", "v1", "v2")
    method = "KSnegLogP" if test == "ks" else "AUROCnegLogP"
    found = against_control(rows.withColumn("__label", F.lit("positive")), ~F.col("__g"), features, [method], "__label")
    found = found.select(F.col("feature").alias("__feature"), F.least(F.col(method), F.lit(MOST)).alias(TESTS[test]))
    return out.drop("m1", "m2", "v1", "v2").join(found, F.col("feature") == F.col("__feature"), "left").drop("__feature")


def top_points(df: DataFrame, effect: str, neg_log_p: str, k: int, threshold: float | None = None, cutoff: float | None = None, by_effect: bool = False) -> DataFrame:
    """The ``k`` rows of the largest -log10 p (or absolute effect) among those of at least ``threshold`` and absolute effect ``cutoff``."""
    rows = df
    if threshold is not None:
        rows = rows.where(F.col(neg_log_p) >= threshold)
    if cutoff is not None:
        rows = rows.where(F.abs(effect) >= cutoff)
    rank = F.abs(effect) if by_effect else F.col(neg_log_p)
    return rows.orderBy(rank.desc_nulls_last(), *(c for c in df.columns if c not in (effect, neg_log_p))).limit(k)


def checked_labels(df: DataFrame, label: str, least: int = 2) -> DataFrame:
    """``df``; labels of fewer than ``least`` rows are an error when it is used."""
    few = df.groupBy(F.col(label).alias("__label")).count().where(F.col("count") < least).orderBy("__label").limit(5)
    named = few.agg(F.array_join(F.collect_list(F.coalesce("__label", F.lit("null"))), ", ").alias("few"))
    told = F.assert_true(F.col("few") == "", F.concat(F.lit(f"labels of fewer than {least} rows: "), "few"))
    return df.join(F.broadcast(named.select(told.alias("__ok"))), F.col("__ok").isNull()).drop("__ok")
