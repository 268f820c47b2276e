"""A chainable view of a table: each method returns a new object and nothing runs before the frame is used."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayframe.functions import columns, labels
from assayframe.operators import aggregate, annotate, combat, normalize, pool


class Dataset:
    """Wraps a frame whose ``label`` column names the variant."""

    def __init__(self, df: DataFrame, label: str = aggregate.LABEL, batch: str = "meta_batch"):
        self.df, self.label, self.batch_column = df, label, batch

    def _new(self, df: DataFrame) -> Dataset:
        return type(self)(df, self.label, self.batch_column)

    # generic verbs

    def pipe(self, f: Callable[[DataFrame], DataFrame]) -> Dataset:
        return self._new(self.df.transform(f))

    def filter(self, condition: Column | str) -> Dataset:
        return self._new(self.df.where(condition))

    def with_columns(self, **made: Column) -> Dataset:
        return self._new(self.df.withColumns(made))

    def select(self, *names: str | Column) -> Dataset:
        return self._new(self.df.select(*names))

    def drop(self, *names: str) -> Dataset:
        return self._new(self.df.drop(*names))

    def rename(self, names: Mapping[str, str]) -> Dataset:
        return self._new(self.df.withColumnsRenamed(dict(names)))

    def sort(self, *by: str | Column) -> Dataset:
        return self._new(self.df.orderBy(*by))

    def join(self, other: DataFrame | Dataset, on: str | Sequence[str] | None = None, how: str = "left") -> Dataset:
        right = other.df if isinstance(other, Dataset) else other
        return self._new(self.df.join(right, on or self.label, how))

    def concat(self, *others: Dataset) -> Dataset:
        out = self.df
        for other in others:
            out = out.unionByName(other.df, allowMissingColumns=True)
        return self._new(out)

    # annotation

    def variant_type(self) -> Dataset:
        return self.with_columns(meta_variant_type=labels.variant_type(self.label))

    def position(self, strict: bool = False) -> Dataset:
        return self.with_columns(meta_position=labels.position(self.label, strict))

    def domain(self, regions: Mapping[str, tuple[int, int]]) -> Dataset:
        return self.with_columns(meta_domain=labels.region(labels.position(self.label), regions))

    def tile(self, tiles: Sequence[tuple[str, int, int]], several: bool = False) -> Dataset:
        return self.with_columns(meta_tile=labels.tiles(labels.position(self.label), tiles, several))

    def annotate(self, table: DataFrame, key: str = "key") -> Dataset:
        return self._new(annotate.join_annotation(self.df, table, self.label, key))

    # features

    @property
    def features(self) -> list[str]:
        return columns.features(self.df)

    def keep_features(self, *patterns: str) -> Dataset:
        return self._new(columns.keep_features(self.df, patterns))

    def drop_features(self, *patterns: str) -> Dataset:
        return self._new(columns.drop_features(self.df, patterns))

    def normalize(self, by: Sequence[str] = ()) -> Dataset:
        return self._new(normalize.zscore(self.df, labels.is_control(self.label), self.features, list(by)))

    def correct(self, mean_only: bool = False) -> Dataset:
        return self._new(combat.combat(self.df, self.features, self.label, self.batch_column, mean_only))

    def aggregate(self, methods: Sequence[str]) -> Dataset:
        return self._new(aggregate.aggregate(self.df, labels.is_control(self.label), self.features, methods, self.label))

    def median_across_batches(self) -> Dataset:
        return self._new(pool.median_across(self.df, self.label, self.features, self.batch_column))

    def impact_score(self) -> Dataset:
        return self._new(aggregate.impact_score(self.df, labels.is_control(self.label), self.features, "meta_impact_score"))

    def blocked(self, names: DataFrame) -> Dataset:
        return self.drop(*(r[0] for r in names.where(~F.coalesce("feature_ok", F.lit(False))).select("feature").collect()))
