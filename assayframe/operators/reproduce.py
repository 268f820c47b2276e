"""Reproducible features: split halves, correlations between them, blocklists and the final table.

Replicates and halves are columns, not files: one job makes all of them.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayframe.operators import aggregate as agg
from assayframe.operators import normalize
from assayframe.operators.qc import LABEL, seeded_ranks


def split_halves(cells: DataFrame, keys: list[str], replicates: int, seed: int = 0, within: tuple[str, ...] = (LABEL,)) -> DataFrame:
    """Each cell once per replicate with ``replicate`` and ``half`` (0 or 1), halves equal in each stratum up to one cell."""
    rows = cells.withColumn("replicate", F.explode(F.sequence(F.lit(1), F.lit(replicates))))
    ranked = seeded_ranks(rows, ["replicate", *within], ["replicate", *keys], seed)
    return ranked.withColumn("half", (F.col("__rank") % 2).cast("int")).drop("__rank", "__n")


def stratum(cells: DataFrame, wildtype: str = "WT", rare: int = 10) -> DataFrame:
    """``stratum``: barcode and whether wild type; strata of fewer than ``rare`` cells are pooled by the latter."""
    kind = F.when(F.col(LABEL) == wildtype, "wt").otherwise("variant")
    rows = cells.withColumn("stratum", F.concat_ws("|", F.coalesce("meta_barcode", F.lit("")), kind))
    few = rows.groupBy("stratum").count().where(F.col("count") < rare).select(F.col("stratum").alias("__few"))
    rows = rows.join(few, F.col("stratum") == F.col("__few"), "left")
    return rows.withColumn("stratum", F.when(F.col("__few").isNotNull(), F.concat(F.lit("rare|"), kind)).otherwise(F.col("stratum"))).drop("__few")


def half_values(halves: DataFrame, features: list[str], method: str = "mean") -> DataFrame:
    """Long ``replicate, feature, label, a, b``: a plain statistic of each half."""
    make = agg.METHODS[method].make
    stats = halves.groupBy("replicate", LABEL, "half").agg(*(make(agg.finite(f)).alias(f) for f in features))
    pairs = F.explode(F.array(*(F.struct(F.lit(f).alias("feature"), F.col(f).alias("value")) for f in features)))
    long = stats.select("replicate", LABEL, "half", pairs.alias("p")).select("replicate", LABEL, "half", "p.feature", "p.value")
    return long.groupBy("replicate", "feature", LABEL).agg(F.max(F.when(F.col("half") == 0, F.col("value"))).alias("a"), F.max(F.when(F.col("half") == 1, F.col("value"))).alias("b"))


def pearson(x: Column, y: Column) -> Column:
    """Aggregate: Pearson's r over rows where both are finite; null if undefined."""
    both = agg.finite(x).isNotNull() & agg.finite(y).isNotNull()
    a, b = F.when(both, agg.finite(x)), F.when(both, agg.finite(y))
    return F.try_divide(F.covar_pop(a, b), F.stddev_pop(a) * F.stddev_pop(b))


def feature_correlations(values: DataFrame) -> DataFrame:
    """``replicate, feature, r, r2`` across labels."""
    return values.groupBy("replicate", "feature").agg(pearson(F.col("a"), F.col("b")).alias("r")).withColumn("r2", F.col("r") * F.col("r"))


def blocklist(correlations: DataFrame, least: float) -> DataFrame:
    """``feature, median_r, feature_ok`` over replicates; an unknown correlation is not ok."""
    medians = correlations.groupBy("feature").agg(F.median("r").alias("median_r"))
    return rethreshold(medians, least)


def rethreshold(medians: DataFrame, least: float) -> DataFrame:
    return medians.withColumn("feature_ok", F.coalesce(F.col("median_r") >= least, F.lit(False)))


def blocked(lists: DataFrame) -> DataFrame:
    """Names whose verdict is not true."""
    return lists.where(~F.coalesce("feature_ok", F.lit(False))).select("feature").distinct()


def drop_blocked(df: DataFrame, lists: DataFrame) -> DataFrame:
    """Drops the blocked columns; unmentioned ones stay.  Column names are few enough for the driver."""
    return df.drop(*(r[0] for r in blocked(lists).collect()))


def vote(lists: DataFrame, least: int | None = None, batches: int | None = None) -> DataFrame:
    """``feature, n_batches, n_ok, feature_ok``: ok in all reporting batches (of all ``batches``, if given), or in ``least``."""
    counts = lists.groupBy("feature").agg(F.count("*").alias("n_batches"), F.count_if(F.coalesce("feature_ok", F.lit(False))).alias("n_ok"))
    need = F.lit(least) if least is not None else F.lit(batches) if batches is not None else F.col("n_batches")
    return counts.withColumn("feature_ok", F.col("n_ok") >= need)


def combine(lists: Iterable[DataFrame]) -> DataFrame:
    """The lists of several methods as one, sorted by feature."""
    lists = list(lists)
    out = lists[0]
    for other in lists[1:]:
        out = out.unionByName(other)
    return out.orderBy("feature")


def finalize(tables: list[DataFrame], blocks: DataFrame, metadata: DataFrame, control: Column, passthrough: DataFrame | None = None) -> DataFrame:
    """Joins statistics by label, drops blocked ones, z-scores to controls, adds impact score and metadata, sorts."""
    out = tables[0]
    for other in tables[1:]:
        out = out.join(other, LABEL)
    out = drop_blocked(out, blocks)
    features = [c for c in out.columns if c != LABEL]
    out = agg.impact_score(normalize.zscore(out, control, features), control, features, "meta_impact_score")
    out = out.join(metadata, LABEL)
    if passthrough is not None:
        if clash := (set(passthrough.columns) & set(out.columns)) - {LABEL}:
            raise ValueError(f"columns on both sides: {', '.join(sorted(clash))}")
        out = out.join(passthrough, LABEL, "left")
    return out.orderBy(F.asc_nulls_first(LABEL))


def by_keys(cells: DataFrame, keys_table: DataFrame | None, keys: list[str]) -> DataFrame:
    """Cells whose keys, nulls included, are in ``keys_table``; all if there is none."""
    if keys_table is None:
        return cells
    wanted = keys_table.select(*(F.col(k).alias(f"__{k}") for k in keys)).distinct()
    return cells.join(wanted, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys], "left_semi")


def fold_ids(cells: DataFrame, folds: int, keys: list[str], within: list[str], seed: int = 0) -> DataFrame:
    """``fold`` from 0: each stratum dealt out evenly in seeded order."""
    return seeded_ranks(cells, within, keys, seed).withColumn("fold", ((F.col("__rank") - 1) % folds).cast("int")).drop("__rank", "__n")


def join_features(meta: DataFrame, cells: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``meta`` with the other columns of ``cells`` of the same keys, nulls being equal; what both have comes from ``meta``."""
    own = [c for c in cells.columns if c not in meta.columns]
    right = cells.select(*(F.col(k).alias(f"__{k}") for k in keys), *own)
    return meta.join(right, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys]).select(*meta.columns, *own)


def load_cells(cells: DataFrame, kept: DataFrame, normalizer: normalize.Normalizer, keys: list[str], sort_by: list[str] = ()) -> DataFrame:
    """The cells that passed, normalised, made again from their keys and the fitted normaliser."""
    rows = normalizer.apply(join_features(kept, cells, keys))
    return rows.orderBy(*(F.asc_nulls_first(c) for c in sort_by)) if sort_by else rows


def filter_and_fit(cells: DataFrame, kept: DataFrame, keys: list[str], control: Column, features: list[str]) -> tuple[DataFrame, normalize.Normalizer]:
    """The kept rows with ``meta_is_control``, and a normaliser fitted on their controls."""
    marked = kept.withColumn("meta_is_control", F.coalesce(control, F.lit(False)))
    return marked, normalize.Normalizer.fit(join_features(marked, cells, keys), F.col("meta_is_control"), features)


def vote_table(lists: DataFrame, batch: str, least: int | None = None, missing: str = "ignore") -> DataFrame:
    """``vote`` of lists of several batches; with ``missing="fail"`` a batch that doesn't report a feature counts against it."""
    if missing not in ("ignore", "fail"):
        raise ValueError(f"missing is {missing}")
    if missing == "ignore" or least is not None:
        return vote(lists, least)
    counts = lists.groupBy("feature").agg(F.count_distinct(batch).alias("n_batches"), F.count_if(F.coalesce("feature_ok", F.lit(False))).alias("n_ok"))
    all_ = lists.agg(F.count_distinct(batch).alias("__all"))
    return counts.join(F.broadcast(all_)).withColumn("feature_ok", F.col("n_ok") >= F.col("__all")).drop("__all")  # a row


def consensus(lists: DataFrame, batch: str, least: int | None = None, missing: str = "ignore") -> list[str]:
    """Names of the features that the vote keeps, sorted."""
    return [r[0] for r in vote_table(lists, batch, least, missing).where("feature_ok").orderBy("feature").select("feature").collect()]
