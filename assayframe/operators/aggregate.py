"""Statistics of every feature per variant, plain and against the control rows.

Only finite values count.  Moments are one wide aggregation; medians and the
distribution statistics come from sorted runs of the features (``orders``).  The
control is never copied to each label, and no task holds all values of a feature.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assayframe.functions.columns import finite
from assayframe.operators import orders
from assayframe.sources.tables import written

LABEL = "meta_aa_changes"
QUANTILES = 100
KOLMOGOROV_TERMS = 100
#: Coefficients of the published approximation of log(erfc(x) / t) + x*x by powers of t = 1 / (1 + x/2).
ERFC = (-1.26551223, 1.00002368, 0.37409196, 0.09678418, -0.18628806, 0.27886807, -1.13520398, 1.48851587, -0.82215223, 0.17087277)


@dataclass(frozen=True)
class Method:
    """A statistic: ``make`` gives a column of one feature (plain) or of the shared frame's columns (against the control)."""

    make: Callable[..., Column]
    plain: bool


def _neg_log10_kolmogorov(d: Column, n: Column) -> Column:
    """-log10 of the limiting two-sided tail; terms are taken relative to the first, so none vanishes; at d = 0 it is 0."""
    first = -2 * n * d * d
    terms = F.transform(F.sequence(F.lit(1), F.lit(KOLMOGOROV_TERMS)), lambda k: F.when(k % 2 == 1, 1.0).otherwise(-1.0) * F.exp(first * (k * k - 1)))
    total = F.aggregate(terms, F.lit(0.0), lambda s, t: s + t)
    log10 = F.log10(F.lit(2.0)) + first / F.log(F.lit(10.0)) + F.log10(total)
    return F.when(d == 0, 0.0).otherwise(F.greatest(F.lit(0.0), -log10))


def log_erfc(x: Column) -> Column:
    """Natural logarithm of erfc(x), x >= 0."""
    t = 1 / (1 + x / 2)
    return F.log(t) - x * x + reduce(lambda sum_, c: sum_ * t + c, reversed(ERFC[:-1]), F.lit(ERFC[-1]))


def _neg_log10_normal(z: Column) -> Column:
    """-log10 of the two-sided normal tail."""
    return F.greatest(F.lit(0.0), -log_erfc(F.abs(z) / F.sqrt(F.lit(2.0))) / F.log(F.lit(10.0)))


def _auroc_tail(f: dict[str, Column]) -> Column:
    n, m = f["n"], f["m"]
    both = n + m
    variance = n * m / 12 * ((both + 1) - F.try_divide(f["ties"], both * (both - 1)))
    z = F.try_divide(f["u"] - n * m / 2, F.sqrt(F.when(variance > 0, variance)))
    return _neg_log10_normal(z)


METHODS: dict[str, Method] = {
    "mean": Method(F.avg, True),
    "median": Method(F.median, True),
    "std": Method(F.stddev_samp, True),
    "MAD": Method(lambda c: c, True),  # of ranks, as the median; see plain()
    "KS": Method(lambda f: F.greatest(f["up"], -f["down"]), False),
    "signedKS": Method(lambda f: F.when(f["up"] >= -f["down"], f["up"]).otherwise(f["down"]), False),
    "AUROC": Method(lambda f: f["u"] / (f["n"] * f["m"]), False),
    "KSnegLogP": Method(lambda f: _neg_log10_kolmogorov(F.greatest(f["up"], -f["down"]), f["n"] * f["m"] / (f["n"] + f["m"])), False),
    "AUROCnegLogP": Method(_auroc_tail, False),
    "QQ": Method(lambda f: f["qq"], False),
}


def register(name: str, make: Callable[..., Column], plain: bool) -> None:
    """Adds a statistic of one's own; see ``Method``."""
    if name in METHODS:
        raise ValueError(f"there is a method {name} already")
    METHODS[name] = Method(make, plain)


def checked(methods: Iterable[str]) -> list[str]:
    methods = list(methods)
    if not methods:
        raise ValueError("no method")
    if unknown := [m for m in methods if m not in METHODS]:
        raise ValueError(f"unknown methods: {', '.join(unknown)}")
    if len(set(methods)) < len(methods):
        raise ValueError("a method is named twice")
    return methods


def plain(cells: DataFrame, control: Column, features: list[str], methods: list[str], label: str = LABEL) -> DataFrame:
    """``<feature>_<method>`` for each label of non-control rows: moments in one aggregation, medians by ranks."""
    rows = cells.where(~F.coalesce(control, F.lit(False))).select(label, *(finite(f).alias(f) for f in features))
    direct = [m for m in methods if m not in ("median", "MAD")]
    wanted = [METHODS[m].make(F.col(f)).alias(f"{f}_{m}") for m in direct for f in features]
    out = rows.groupBy(label).agg(*wanted) if wanted else rows.select(label).distinct()
    if len(direct) < len(methods):
        for m, found in zip(("median", "MAD"), orders.medians(rows, features, label, "MAD" in methods)):
            if m in methods:
                found = found.toDF("__label", *(f"{f}_{m}" for f in features))
                out = out.join(found, F.col(label).eqNullSafe(F.col("__label")), "left").drop("__label")
    return out.select(label, *(f"{f}_{m}" for m in methods for f in features))


def against_control(cells: DataFrame, control: Column, features: list[str], methods: list[str], label: str = LABEL) -> DataFrame:
    """``label, feature`` and the methods' values, for every label of non-control rows and every feature; null without control."""
    made = orders.runs(cells, control, features, label)
    stats = quantile_correlation(made) if set(methods) == {"QQ"} else orders.comparisons(made)
    if "QQ" in methods and len(set(methods)) > 1:
        stats = stats.join(quantile_correlation(made), ["feature", "code"], "left")
    columns = {k: F.col(k) for k in stats.columns}
    found = made.named(stats.select("feature", "code", *(METHODS[m].make(columns).alias(m) for m in methods)))
    labels = made.codes.where("not control").select("label")
    grid = labels.select("label", F.explode(F.array(*map(F.lit, features))).alias("feature"))
    return grid.join(found, grid["label"].eqNullSafe(found["label"]) & (grid["feature"] == found["feature"]), "left").select(grid["label"].alias(label), grid["feature"], *methods)


#: Ranges of values that a feature is cut into, so that no task holds all values of one.
RANGES = 64


def value_bounds(df: DataFrame, features: list[str]) -> DataFrame:
    """``feature, bounds``: RANGES - 1 approximate quantiles of each feature, written, so that whoever asks gets the same.

    They only deal values out; no result depends on them.
    """
    cuts = F.array(*(F.lit(i / RANGES) for i in range(1, RANGES)))
    each = [F.struct(F.lit(f).alias("feature"), F.approx_percentile(finite(f), cuts, F.lit(1000)).alias("bounds")) for f in features]
    return written(df.agg(F.array(*each).alias("all")).select(F.explode("all").alias("p")).select("p.*"), "bounds")


def running_totals(df: DataFrame, bounds: DataFrame, by: list[str], count: str, to: str) -> DataFrame:
    """``df`` (with ``feature, value``) with the total of ``count`` up to each row's value within a group, in ``to``, and of the whole group, in ``<count>_all``.

    Each range of values of a group adds up its own; the ranges' totals, RANGES
    at most for each group, are added up apart and joined back.
    """
    held = df.join(F.broadcast(bounds.withColumnRenamed("feature", "__feature")), F.col("feature") == F.col("__feature"))  # a row a feature
    held = held.select(*df.columns, F.size(F.filter("bounds", lambda b: b <= F.col("value"))).alias("__range"))
    sums = held.groupBy(*by, "__range").agg(F.sum(count).alias("__sum"))
    group = Window.partitionBy(*by)
    before = F.coalesce(F.sum("__sum").over(group.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sums = sums.select(*(F.col(b).alias(f"__of_{b}") for b in by), F.col("__range").alias("__of_range"), before.alias("__before"), F.sum("__sum").over(group).alias(f"{count}_all"))
    own = held.withColumn(to, F.sum(count).over(Window.partitionBy(*by, "__range").orderBy("value")))
    on = [F.col(b).eqNullSafe(F.col(f"__of_{b}")) for b in by] + [F.col("__range") == F.col("__of_range")]
    return own.join(sums, on).select(*df.columns, (F.col(to) + F.col("__before")).alias(to), f"{count}_all")


def mean_ranks(df: DataFrame, column: str) -> DataFrame:
    """``df`` with a column's values replaced by their mean ranks, from 1."""
    counts = df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(F.count("*").alias("c")).withColumn("feature", F.lit(column))
    ranks = running_totals(counts, value_bounds(df, [column]), ["feature"], "c", "upto")
    ranks = ranks.select(F.col("value").alias("__value"), (F.col("upto") - (F.col("c") - 1) / 2.0).alias("__rank"))
    return df.join(ranks, F.col(column) == F.col("__value"), "left").withColumn(column, F.col("__rank")).drop("__value", "__rank")


def quantile_correlation(made: orders.Runs, n: int = QUANTILES) -> DataFrame:
    """``feature, code, qq``: Pearson's r of ``n`` linear quantiles of each group and of the control; null if either profile is constant."""
    found = orders.quantiles(made, [i / (n - 1) for i in range(n)])
    reference = found.where("code = 0").select("feature", F.col("q").alias("y"))
    total = lambda a: F.aggregate(a, F.lit(0.0), lambda s, v: s + v)
    centred = lambda a: F.transform(a, lambda v: v - total(a) / n)
    rows = found.where("code != 0").withColumnRenamed("q", "x").join(F.broadcast(reference), "feature")  # n values a feature
    rows = rows.select("feature", "code", "x", "y", centred(F.col("x")).alias("dx"), centred(F.col("y")).alias("dy"))
    dot = lambda a, b: total(F.zip_with(a, b, lambda v, w: v * w))
    varies = (F.array_max("x") > F.array_min("x")) & (F.array_max("y") > F.array_min("y"))
    r = F.try_divide(dot("dx", "dy"), F.sqrt(dot("dx", "dx") * dot("dy", "dy")))
    return rows.select("feature", "code", F.when(varies, r).alias("qq"))


def wide(stats: DataFrame, features: list[str], methods: list[str], label: str = LABEL) -> DataFrame:
    """``<feature>_<method>`` columns from the long frame; the features are known, so no job looks for them."""
    out = stats.groupBy(label).pivot("feature", features).agg(*(F.first(m).alias(m) for m in methods))
    return out.withColumnsRenamed({f: f"{f}_{methods[0]}" for f in features}) if len(methods) == 1 else out


def aggregate(cells: DataFrame, control: Column, features: list[str], methods: Iterable[str], label: str = LABEL, blocked: Iterable[str] = ()) -> DataFrame:
    """One row for each label with ``<feature>_<method>`` columns, sorted by label.

    ``blocked`` columns aren't made: their pairs of feature and method are left
    out before anything is shuffled.
    """
    methods, blocked = checked(methods), set(blocked)
    free = lambda wanted: [f for f in features if any(f"{f}_{m}" not in blocked for m in wanted)]
    made = [f"{f}_{m}" for m in methods for f in features if f"{f}_{m}" not in blocked]
    parts = []
    groups: dict[tuple[str, ...], list[str]] = {}
    if own := [m for m in methods if METHODS[m].plain]:
        for f in free(own):  # features of the same methods in one aggregation
            groups.setdefault(tuple(m for m in own if f"{f}_{m}" not in blocked), []).append(f)
        parts += [plain(cells, control, some, list(kept), label) for kept, some in groups.items()]
    if (compared := [m for m in methods if not METHODS[m].plain]) and (some := free(compared)):
        parts.append(wide(against_control(cells, control, some, compared, label), some, compared, label))
    out = parts[0] if parts else cells.where(~F.coalesce(control, F.lit(False))).select(label).distinct()
    for other in parts[1:]:
        renamed = other.withColumnRenamed(label, "__label")
        out = out.join(renamed, F.col(label).eqNullSafe(F.col("__label"))).drop("__label")
    return out.select(label, *made).orderBy(F.asc_nulls_first(label))


def cosine_distance(x: Column, y: Column) -> Column:
    """1 - cosine over the places where both arrays have values; 1 if a norm is zero."""
    pairs = F.filter(F.arrays_zip(x.alias("a"), y.alias("b")), lambda p: p["a"].isNotNull() & p["b"].isNotNull())
    total = lambda f: F.aggregate(pairs, F.lit(0.0), lambda s, p: s + f(p))
    norm = F.sqrt(total(lambda p: p["a"] * p["a"]) * total(lambda p: p["b"] * p["b"]))
    return F.when(norm == 0, 1.0).otherwise(1 - F.try_divide(total(lambda p: p["a"] * p["b"]), norm))


def impact_score(profiles: DataFrame, control: Column, features: list[str], to: str = "impact_score") -> DataFrame:
    """Half the cosine distance of each profile to the median control profile: 0 the same, 1 opposite."""
    middle = profiles.where(control).agg(F.array(*(F.median(finite(f)) for f in features)).alias("__middle"))
    joined = profiles.join(F.broadcast(middle))  # a row
    return joined.withColumn(to, cosine_distance(F.array(*(finite(f) for f in features)), F.col("__middle")) / 2).drop("__middle")
