"""Statistics from sorted runs equal plain numpy ones, however values are cut into ranges."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from assayframe.operators import orders


def rows(seed, n, tied):
    rng = random.Random(seed)
    value = lambda: rng.choice([None, float("nan"), float("-inf"), 0.0]) if rng.random() < tied else rng.gauss(0, 1)
    return [(rng.choice(["a", "b", "c", None]), rng.random() < 0.4, value(), float(rng.randint(0, 3))) for _ in range(n)]


def by_name(made, df):
    return {(r.label, r.feature): r for r in made.named(df).collect()}


@pytest.mark.parametrize("range_values", [17, 100, 10**6])
def test_comparisons_and_quantiles(spark, range_values):
    data = rows(range_values, 600, 0.4)
    df = spark.createDataFrame(data, "label string, control boolean, f double, g double").repartition(5)
    made = orders.runs(df, F.col("control"), ["f", "g"], "label", range_values)
    assert made.merged.count() == 2 or range_values < 1000
    probs = [0.0, 0.1, 0.5, 0.77, 1.0]
    found, quantiles = by_name(made, orders.comparisons(made)), by_name(made, orders.quantiles(made, probs))
    for k, name in ((2, "f"), (3, "g")):
        fine = [r for r in data if r[k] is not None and np.isfinite(r[k])]
        y = np.array([r[k] for r in fine if r[1]])
        assert np.allclose([r.q for r in orders.quantiles(made, probs).where("code = 0").orderBy("feature").collect()][k - 2], np.quantile(y, probs))
        for label in ("a", "b", "c", None):
            x = np.array([r[k] for r in fine if r[0] == label and not r[1]])
            got = found[label, name]
            points = np.unique(np.concatenate([x, y]))
            diff = np.array([(x <= p).mean() - (y <= p).mean() for p in points])
            assert (got.n, got.m) == (len(x), len(y))
            assert np.isclose(got.up, max(0, diff.max())) and np.isclose(got.down, min(0, diff.min()))
            assert got.u == ((x[:, None] > y).sum() + (x[:, None] == y).sum() / 2)
            _, t = np.unique(np.concatenate([x, y]), return_counts=True)
            assert got.ties == (t**3 - t).sum()
            assert np.allclose(quantiles[label, name].q, np.quantile(x, probs))


def test_odd_tables(spark):
    kind = "label string, control boolean, f double, g double"
    none = orders.runs(spark.createDataFrame([], kind), F.col("control"), ["f"], "label")
    assert orders.comparisons(none).count() == orders.quantiles(none, [0.5]).count() == 0
    bare = orders.runs(spark.createDataFrame([("a", None, 1.0, None), ("a", False, 2.0, None)], kind), F.col("control"), ["f", "g"], "label")
    assert orders.comparisons(bare).count() == 0
    assert [(r.label, r.feature, r.q) for r in bare.named(orders.quantiles(bare, [0.5])).collect()] == [("a", "f", [1.5])]
    lone = orders.runs(spark.createDataFrame([("a", True, 1.0, 2.0)], kind), F.col("control"), ["f", "g"], "label")
    assert orders.comparisons(lone).count() == 0 and orders.quantiles(lone, [0.5]).count() == 2


@pytest.mark.parametrize("range_values", [40, 10**6])
def test_deviations(spark, range_values):
    data = rows(5, 500, 0.3)
    df = spark.createDataFrame(data, "label string, control boolean, f double, g double").repartition(3)
    made = orders.runs(df, F.lit(False), ["f", "g"], "label", range_values)
    middle = orders.written(orders.quantiles(made, [0.5]))
    off = orders.deviations(made, middle)
    assert off.merged.count() > 4 or range_values > 500
    found = by_name(off, orders.quantiles(off, [0.5]))
    for label in ("a", "b", "c", None):
        for k, name in ((2, "f"), (3, "g")):
            x = np.array([r[k] for r in data if r[0] == label and r[k] is not None and np.isfinite(r[k])])
            assert np.isclose(found[label, name].q[0], np.median(abs(x - np.median(x))))


def test_medians_of_a_label_of_most_rows(spark):
    data = [("most", float(i % 7)) for i in range(900)] + [(f"l{i}", float(i)) for i in range(30)] + [("empty", None)]
    middle, off = orders.medians(spark.createDataFrame(data, "label string, f double").repartition(6), ["f"], "label", True)
    assert {r.label: r.f for r in middle.collect()} == {"most": 3.0} | {f"l{i}": float(i) for i in range(30)}
    assert {r.label: r.f for r in off.collect()} == {"most": 2.0} | {f"l{i}": 0.0 for i in range(30)}
