"""Importance resampling against a plain computation of scores and one sort of all rows."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from assayframe.llm import importance

SCHEMA = "doc_id long, text string, RANK string, segment int"


def brute(docs, target, n=1, buckets=10_000, seed=2024, least=20, percent=10):
    def features(text):
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
        return len(w), [zlib.crc32(" ".join(w[i : i + m]).encode()) % buckets for m in range(1, n + 1) for i in range(len(w) - m + 1)]

    of_docs = [features(t) for _, t in docs]
    s, t = Counter(p for _, f in of_docs for p in f), Counter(p for x in target for p in features(x)[1])
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = {p: math.floor(1000 * math.log((t[p] + 1) * (all_s + buckets) / ((s[p] + 1) * (all_t + buckets)))) for p in s}
    rows = []
    for (i, _), (words, own) in zip(docs, of_docs):
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[p] for p in own)
        rows.append([i, len(own), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, words >= least])
    wanted = sorted((r for r in rows if r[5]), key=lambda r: (-r[3], r[0] is not None, r[0] or 0))
    for k, r in enumerate(wanted[: percent * len(wanted) // 100]):
        r[4] = k + 1
    return sorted((tuple(r[:5]) for r in rows), key=str)


def told(spark, docs, target, **kw):
    df = spark.createDataFrame([(i, t, "x", 3) for i, t in docs], SCHEMA).repartition(5)
    aim = spark.createDataFrame([(t,) for t in target], "text string")
    return sorted((tuple(r) for r in importance.resampled(df, aim, **kw).collect()), key=str)


@pytest.mark.parametrize("kw", [{}, {"n": 2, "buckets": 97, "least": 3, "percent": 55, "seed": 5}, {"percent": 100, "least": 0}, {"percent": 0}])
def test_against_one_sort(spark, kw):
    rng = np.random.default_rng(3)
    words = ["Alpha", "beta", "ÉCLAIR", "x9", "don't", "naïve", "q", "ZZ", "ß_k", "-", "10"]
    docs = [(int(i), " ".join(rng.choice(words, rng.integers(0, 60)))) for i in rng.permutation(300)]
    docs += [(None, None), (None, "beta " * 40), (7, ""), (8, docs[0][1] or "q"), (8, docs[0][1] or "q"), (900, "long " * 50_000)]
    docs += [(11, "alpha " * 25)] * 120  # a third of the rows are the same
    assert told(spark, docs, ["alpha beta éclair", None, "x9 x9"], **kw) == brute(docs, ["alpha beta éclair", None, "x9 x9"], **kw)


def test_empty_tables(spark):
    assert told(spark, [], ["a"]) == []
    docs = [(1, "a b " * 10), (2, "c " * 30)]
    assert told(spark, docs, [], percent=50) == brute(docs, [], percent=50)


def test_ranks_over_many_segments(spark, monkeypatch):
    """Few samples, more rows than samples, equal scores: ranks stay exact whatever the splitters."""
    monkeypatch.setattr(importance, "SAMPLES", 50)
    monkeypatch.setattr(importance, "SEGMENT", 100)
    rows = spark.range(0, 6000, 1, 7).select((F.col("id") % 3000).alias("k"), (F.col("id") * 7919 % 13).alias("s"), (F.col("id") % 10 > 0).alias("w"))
    n = rows.where("w").count()
    out = importance.ranked(rows, "s", "k", F.col("w"), 4000, n).where("rank is not null").orderBy("rank").collect()
    want = sorted(((-r.s, r.k) for r in rows.collect() if r.w))[:4000]
    assert [r["rank"] for r in out] == list(range(1, 4001)) and [(-r.s, r.k) for r in out] == want


def test_splitters_part_ties():
    keys = np.array([[0, 1, 5, r] for r in range(1000)])
    parts = importance.Splitters(keys[::7], 8).segment(keys)
    assert np.bincount(parts).max() < 200 and (np.diff(parts) >= 0).all()
