"""Metrics of two numeric arrays as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _total(a: Column) -> Column:
    return F.aggregate(a, F.lit(0.0), lambda s, v: s + v)


def _dot(a: Column, b: Column) -> Column:
    return _total(F.zip_with(a, b, lambda x, y: x * y))


def _unit(a: Column) -> Column:
    norm = F.sqrt(_dot(a, a))
    return F.when(norm > 0, F.transform(a, lambda v: v / norm))


def _centred(a: Column) -> Column:
    mean = _total(a) / F.size(a)
    return F.transform(a, lambda v: v - mean)


def _ranks(a: Column) -> Column:
    return F.transform(a, lambda v: _total(F.transform(a, lambda w: F.when(w < v, 1.0).when(w == v, 0.5).otherwise(0.0))) + 0.5)


#: Name: what is done to a vector once, and how two such vectors give the value; similarities end in their self value 1.
METRICS = {
    "euclidean": (lambda a: a, lambda x, y: F.sqrt(_total(F.zip_with(x, y, lambda p, q: (p - q) * (p - q))))),
    "cityblock": (lambda a: a, lambda x, y: _total(F.zip_with(x, y, lambda p, q: F.abs(p - q)))),
    "cosine": (_unit, _dot),
    "cosine_distance": (_unit, lambda x, y: 1 - _dot(x, y)),
    "pearson": (lambda a: _unit(_centred(a)), _dot),
    "spearman": (lambda a: _unit(_centred(_ranks(a))), _dot),
}
