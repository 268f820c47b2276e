"""Every text operator gets its texts as strings from ``slices``, whichever slice of a batch they stand in."""

import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from assayframe.llm import bpe, html_text, importance, periodic, quality, simhash

#: Batches of more than one slice of 2,000,000 bytes (pages: 500,000), with nulls and empty texts at their seams.
LONG = " ".join(f"w{i % 9973} Ünd {i % 7}" for i in range(90_000))
TEXTS = ["one two three four", None, LONG, "", "É " * 30, LONG, None, "", "a b c " * 9, LONG[::-1], "end of it all", None]


@pytest.fixture(scope="module")
def docs(spark):
    assert len(LONG.encode()) * 3 > 2_000_000
    return spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "doc_id long, text string").coalesce(1).cache()


@pytest.mark.parametrize("most", [1, 7, 20, 10**9])
@pytest.mark.parametrize("kind", [pa.string(), pa.large_string()])
def test_slices_are_lists_of_strings(most, kind):
    values = ["abc", None, "", "é" * 9, "x", None, "yz"]
    array = pa.array(["cut off", *values], kind).slice(1)
    parts = list(bpe.slices(array, most))
    assert [x for part in parts for x in part] == values
    assert all(isinstance(part, list) and {type(x) for x in part} <= {str, type(None)} for part in parts)
    assert pa.concat_arrays(bpe.array_slices(array, most)).to_pylist() == values
    assert (len(parts) == 1) == (most == 10**9) and list(bpe.slices(array[:0], most)) == []


def test_fingerprints(docs):
    got = {r.doc_id: r.fp for r in docs.select("doc_id", simhash.fingerprint(F.col("text")).alias("fp")).collect()}
    assert got == {i: int(np.uint64(simhash.shingle_bits(t or "", 3, 42)).astype(np.int64)) for i, t in enumerate(TEXTS)}


def test_marks_and_groups(docs):
    common = simhash.common_tokens(docs, 5)
    rows = docs.select("text", simhash.marks(F.col("text"), common, 5, 0.8).alias("m")).collect()
    assert len(rows) == len(TEXTS)
    for r in rows:
        assert r.m.n == len(simhash.shingle_tokens((r.text or "").lower().encode().split(), 5))
    kept = simhash.first_of_groups(docs.select("doc_id", "text", F.lit("en").alias("lang"), F.lit("x").alias("source"), F.length("text").alias("n_chars")))
    assert sorted(r.doc_id for r in kept.collect()) == [0, 1, 2, 4, 8, 9, 10]


def test_quality(docs):
    lists = docs.select("text", quality.feature_lists(F.col("text")).alias("places")).collect()
    assert len(lists) == len(TEXTS) and all(bytes(r.places) == quality.indicators(r.text or "").tobytes() for r in lists)
    model = quality.Model(np.random.default_rng(1).normal(size=quality.N_FEATURES), 0.1, 2.0, 0.0)
    scores = quality.scored(docs, model).collect()
    assert len(scores) == len(TEXTS) and all(r.score == model.score(r.text or "") for r in scores)


def test_periodic_runs(docs):
    seen = periodic.with_runs(docs, changed=lambda words, key: words + [str(key).encode()] * 8).collect()
    assert len(seen) == len(TEXTS)
    for r in seen:
        lists, kept = periodic._found([(r.text or "").encode().split() + [str(r.doc_id).encode()] * 8])
        assert [x.asDict() for x in r.periodic.runs] == lists[0] and r.periodic.collapsed == kept[0].decode()


def test_gains_and_weights(docs):
    def features(text):
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        return [zlib.crc32(w.encode()) % 100 for w in re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)]

    want = {i: np.array(features(t), int) for i, t in enumerate(TEXTS)}
    assert (importance.counts(docs, "text", 1, 100) == np.bincount(np.concatenate(list(want.values())), minlength=100)).all()
    gain = np.arange(100) - 40
    for r in docs.select("doc_id", importance.weights(F.col("text"), gain, 1).alias("w")).collect():
        assert tuple(r.w) == (len(want[r.doc_id]), len(want[r.doc_id]), int(gain[want[r.doc_id]].sum()))


def test_main_texts(spark):
    body = "".join(f"<p>Paragraph {i} tells of bread, of water and of what bakers do with them, at some length.</p>" for i in range(6000))
    pages = ["<article><p>A first short article of some plain words.</p></article>", None, f"<main>{body}</main>", "", f"<main>{body}</main>", None, "<p>And a last one, that is told in one sentence.</p>"]
    assert len(body) > 500_000
    df = spark.createDataFrame([(i, p) for i, p in enumerate(pages)], "page_id long, html string").coalesce(1)
    rows = html_text.with_text(df).collect()
    model = html_text.fit()
    assert len(rows) == len(pages)
    assert {r.page_id: r.text for r in rows} == {i: html_text.main_texts([p or ""], model)[0] for i, p in enumerate(pages)}
