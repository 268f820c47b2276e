"""Runs of words against a search through all periods."""

import hashlib
import zlib

import numpy as np
import pytest

from assayframe.llm import periodic
from assayframe.llm.queries import op12_periodic_runs


def brute(w):
    """All runs as (start, length, period) by start and period: every period is tried at every place."""
    found = set()
    for q in range(1, len(w) // 4 + 1):
        same = [w[x] == w[x + q] for x in range(len(w) - q)] + [False]
        start = None
        for x, e in enumerate(same):
            if e and start is None:
                start = x
            if not e and start is not None:
                n = x - start + q
                part = w[start : start + n]
                if n >= max(6, 4 * q) and not any(part[d:] == part[: n - d] for d in range(1, q)):
                    found.add((start, n, q))
                start = None
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapsed(w, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return [x for i, x in enumerate(w) if i not in gone]


def repetitive(rng):
    """A text of few words with stretches that repeat, some cut short."""
    w = rng.integers(0, rng.integers(1, 5), rng.integers(0, 80)).tolist()
    for _ in range(rng.integers(0, 4)):
        base = rng.integers(0, rng.integers(1, 6), rng.integers(1, 25)).tolist()
        at, end = rng.integers(0, len(w) + 1), rng.integers(1, 8 * len(base))
        w[at:at] = (base * 8)[:end]
    return w


@pytest.mark.parametrize("seed", range(4))
def test_runs_are_those_of_all_periods(seed):
    rng = np.random.default_rng(seed)
    for _ in range(60):
        texts = [repetitive(rng) for _ in range(rng.integers(1, 6))]
        out = [[] for _ in texts]
        numbers = np.array([x for w in texts for x in w], np.int64)
        for i, *run in zip(*(c.tolist() for c in periodic.runs(numbers, np.array([len(w) for w in texts])))):
            out[i].append(tuple(run))
        assert out == [brute(w) for w in texts]


def test_words_that_almost_repeat():
    """Fibonacci words, whose runs have fewer than four periods, alone and repeated."""
    a, b = [1], [1, 2]
    while len(b) < 600:
        a, b = b, b + a
    for w in (b, b[:89] * 5, b[:55] * 4 + b[:30], [7] * 500 + b[:100] + [7] * 5):
        got = periodic.runs(np.array(w, np.int64), np.array([len(w)]))
        assert list(zip(*(c.tolist() for c in got[1:]))) == brute(w)


def test_rows(spark):
    long = " ".join(f"w{i % 700}" for i in range(30_000))
    texts = ["a a a a a a b", None, "", " \t\n", "one", "x y " * 4, "x y " * 3, "\x0bé é\x0cé é\ré é", "a a a a a a a", long]
    df = spark.createDataFrame([(i, t, 1, 2) for i, t in enumerate(texts)] + [(None, "z z z z z z", 1, 2), (None, "z z z z z z", 1, 2)], "doc_id long, text string, RUNS int, start int")
    rows = periodic.with_runs(df).collect()
    assert len(rows) == len(texts) + 2 and rows[0].RUNS == 1
    for r in rows:
        words = [w.decode() for w in (r.text or "").encode().split()]
        runs = [tuple(x) for x in r.periodic.runs]
        assert runs == ([(0, 30_000, 700)] if r.text == long else brute(words))
        assert r.periodic.collapsed == " ".join(collapsed(words, runs))
    assert periodic.with_runs(df.limit(0)).count() == 0


def test_query_against_all_periods(spark, sf_dir):
    """The digests of the contract from a search through all periods; texts of up to 1,500 words."""
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = op12_periodic_runs(spark, sf_dir).collect()
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    changed = 0
    for r in rows:
        words = (docs[r.doc_id] or "").encode().split()
        n = len(words)
        if n > 1500:
            continue
        h = zlib.crc32(str(r.doc_id).encode())
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
            changed += 1
        runs = brute(words)
        best = min(runs, key=lambda x: (-x[1], x[0], x[2]), default=None)
        told = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
        text = "".join(f"{s},{m},{q}\n" for s, m, q in runs)
        kept = b" ".join(collapsed(words, runs))
        assert (r.n_runs, r.start, r.length, r.period, r.exponent_milli) == (len(runs), *told)
        assert (r.runs_sha256, r.collapsed_sha256) == (hashlib.sha256(text.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())
    assert changed > 5
