"""Z-scores against control rows, within batches or over all."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Fixed value: below the smallest step of a 32-bit float at 1, a spread counts as none.
LEAST_SPREAD = 2.0**-23


def _number(column: Column | str) -> Column:
    """NaN becomes null, infinities stay."""
    c = (F.col(column) if isinstance(column, str) else column).cast("double")
    return F.when(~F.isnan(c), c)


def _spread(std: Column) -> Column:
    return F.when(std >= LEAST_SPREAD, std)


@dataclass(frozen=True)
class Normalizer:
    """Means and standard deviations of features over control rows."""

    mean: dict[str, float | None]
    std: dict[str, float | None]

    @classmethod
    def fit(cls, df: DataFrame, control: Column, features: list[str]) -> Normalizer:
        """One pass over the controls for all features."""
        rows = df.where(control)
        stats = rows.agg(*(F.avg(_number(f)).alias(f"m{i}") for i, f in enumerate(features)), *(_spread(F.stddev_samp(_number(f))).alias(f"s{i}") for i, f in enumerate(features))).first()
        return cls({f: stats[f"m{i}"] for i, f in enumerate(features)}, {f: stats[f"s{i}"] for i, f in enumerate(features)})

    def apply(self, df: DataFrame) -> DataFrame:
        """Features become z-scores, null where the spread is unknown; other numbers lose their NaN."""
        out = []
        for field in df.schema:
            c = field.name
            if c in self.mean:
                known = self.mean[c] is not None and self.std[c] is not None
                out.append((((_number(c) - self.mean[c]) / self.std[c]) if known else F.lit(None).cast("double")).alias(c))
            elif field.dataType.typeName() in ("float", "double"):
                out.append(_number(c).alias(c))
            else:
                out.append(F.col(c))
        return df.select(*out)

    def save(self, spark: SparkSession, path: str) -> None:
        names = list(self.mean)
        rows = [("mean", *(self.mean[n] for n in names)), ("std", *(self.std[n] for n in names))]
        spark.createDataFrame(rows, ", ".join(["_stat string", *(f"`{n}` double" for n in names)])).coalesce(1).write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Normalizer:
        rows = {r["_stat"]: r.asDict() for r in spark.read.parquet(path).collect()}
        drop = lambda d: {k: v for k, v in d.items() if k != "_stat"}
        return cls(drop(rows["mean"]), drop(rows["std"]))


def zscore(df: DataFrame, control: Column, features: list[str], by: list[str] = ()) -> DataFrame:
    """Z-scores against the controls of each group of ``by``; groups of fewer than two controls are null.

    Group statistics are aggregated first and joined back, since a group may hold
    any share of the rows.
    """
    if not by:
        stats = df.where(control).agg(*(F.avg(_number(f)).alias(f"__m{i}") for i, f in enumerate(features)), *(_spread(F.stddev_samp(_number(f))).alias(f"__s{i}") for i, f in enumerate(features)))
        z = {f: F.try_divide(_number(f) - F.col(f"__m{i}"), F.col(f"__s{i}")) for i, f in enumerate(features)}
        floats = {f.name for f in df.schema if f.dataType.typeName() in ("float", "double")}
        joined = df.join(F.broadcast(stats))  # a row
        return joined.select(*(z[c].alias(c) if c in z else _number(c).alias(c) if c in floats else F.col(c) for c in df.columns))
    stats = df.where(control).groupBy(*(F.col(b).alias(f"__by{i}") for i, b in enumerate(by))).agg(*(F.avg(_number(f)).alias(f"__m{i}") for i, f in enumerate(features)), *(_spread(F.stddev_samp(_number(f))).alias(f"__s{i}") for i, f in enumerate(features)))
    on = [F.col(b).eqNullSafe(F.col(f"__by{i}")) for i, b in enumerate(by)]
    joined = df.join(stats, on, "left")
    z = {f: F.try_divide(_number(f) - F.col(f"__m{i}"), F.col(f"__s{i}")) for i, f in enumerate(features)}
    return joined.select(*(z[c].alias(c) if c in z else F.col(c) for c in df.columns))


def correct_scores(df: DataFrame, scores: list[str], batch: str, reference: Column | None = None, rescale: bool = False) -> DataFrame:
    """Scores z-scored per batch on the reference rows (all by default) in ``<score>_corrected``.

    ``rescale``: mapped back to the median of the batches' means and deviations.
    Batches of fewer than two reference rows get nulls.
    """
    rows = df.where(reference) if reference is not None else df
    stats = rows.groupBy(F.col(batch).alias("__batch")).agg(*(F.avg(_number(s)).alias(f"__m{i}") for i, s in enumerate(scores)), *(_spread(F.stddev_samp(_number(s))).alias(f"__s{i}") for i, s in enumerate(scores)))
    joined = df.join(F.broadcast(stats), F.col(batch).eqNullSafe(F.col("__batch")), "left")  # a row a batch
    if rescale:
        middle = stats.agg(*(F.median(f"__m{i}").alias(f"__mm{i}") for i in range(len(scores))), *(F.median(f"__s{i}").alias(f"__ms{i}") for i in range(len(scores))))
        joined = joined.join(F.broadcast(middle))  # a row
    out = []
    for i, s in enumerate(scores):
        z = F.try_divide(_number(s) - F.col(f"__m{i}"), F.col(f"__s{i}"))
        out.append((z * F.col(f"__ms{i}") + F.col(f"__mm{i}") if rescale else z).alias(f"{s}_corrected"))
    return joined.select(*df.columns, *out)
