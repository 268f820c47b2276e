"""Near-duplicate vectors against brute force over all pairs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from assayframe.llm import forest

SCHEMA = "vec_id long, embedding array<double>, V string, cell int"


def brute(rows, link=0.9):
    """Links and component of each row, by all pairs."""
    ok = [i for i, (_, v) in enumerate(rows) if v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    near = {i: set() for i in range(len(rows))}
    for i in ok:
        for j in ok:
            a, b = np.array(rows[i][1]), np.array(rows[j][1])
            if i != j and len(a) == len(b) and (a / abs(a).max()) @ (b / abs(b).max()) >= link * np.linalg.norm(a / abs(a).max()) * np.linalg.norm(b / abs(b).max()):
                near[i].add(j)
    out, seen = [None] * len(rows), set()
    for i in range(len(rows)):
        if i in seen:
            continue
        group, open_ = {i}, [i]
        while open_:
            new = near[open_.pop()] - group
            group |= new
            open_ += new
        seen |= group
        least = min((rows[k][0] for k in group if rows[k][0] is not None), default=None)
        for k in group:
            out[k] = (rows[k][0], len(near[k]), least, rows[k][0] is not None and rows[k][0] == least)
    return sorted(out, key=str)


def told(spark, rows, **kw):
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], SCHEMA)
    return sorted((tuple(r) for r in forest.near_duplicates(df, **kw).collect()), key=str)


def crowded(seed):
    """Vectors with some near copies each, exact copies, a tight crowd and a loose one."""
    rng = np.random.default_rng(seed)
    out = []
    for base in rng.standard_normal((60, 12)):
        out += [base + rng.standard_normal(12) * rng.uniform(0, 0.5) for _ in range(rng.integers(1, 4))]
    out += [out[3]] * 30
    for width, n in ((0.1, 120), (0.3, 60)):
        middle = rng.standard_normal(12)
        out += [middle + rng.standard_normal(12) * width for _ in range(n)]
    return [(i, v.tolist()) for i, v in enumerate(out)]


@pytest.mark.parametrize("kw", [{}, {"leaf": 16, "most": 32, "sample": 64}])
def test_links_and_components_are_those_of_all_pairs(spark, kw):
    """The second has leaves cut in later rounds, crowds with heads, and pairs of chunks."""
    rows = crowded(len(kw))
    assert told(spark, rows, **kw) == brute(rows)


def test_odd_vectors_ids_and_columns(spark):
    inf, nan = float("inf"), float("nan")
    rows = [
        (9, [1.0, 0.0]), (4, [2.0, 0.0]), (4, [2.0, 0.1]), (None, [3.0, 0.2]), (None, [-1.0, 0.0]), (1, [1.0, 0.0, 0.0]), (2, [1.0, 0.0, 0.01]),
        (20, None), (21, []), (22, [0.0, 0.0]), (23, [nan, 1.0]), (24, [inf, 0.0]), (25, [None, 1.0]), (25, [None, 1.0]), (26, [1e300, 1e300]), (27, [1e-300, 1e-300]),
    ]
    assert told(spark, rows) == brute(rows)
    assert told(spark, []) == []
    assert told(spark, rows[7:10]) == brute(rows[7:10])


def test_few_links_are_lost_at_the_threshold(spark):
    """Pairs of cosine just over 0.9, the hardest, in a table cut into many small leaves."""
    rng = np.random.default_rng(5)
    a = rng.standard_normal((1500, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    side = rng.standard_normal(a.shape)
    side -= (side * a).sum(axis=1, keepdims=True) * a
    b = 0.901 * a + np.sqrt(1 - 0.901**2) * side / np.linalg.norm(side, axis=1, keepdims=True)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(np.concatenate([a, b]))], "vec_id long, embedding array<double>")
    found = forest.near_duplicates(df, leaf=32, sample=2048)
    assert found.agg(F.sum("n_links")).first()[0] >= 0.99 * 3000
