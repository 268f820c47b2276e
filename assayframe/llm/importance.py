"""Target-distribution importance resampling of documents.

Features are runs of 1 to ``n`` words, counted in ``buckets`` hashed places over
all documents and over a target corpus.  A place's gain is the log ratio of its
two smoothed shares; a document's weight is the sum of its features' gains, and
its score adds Gumbel noise from a hash of seed and key.  The documents of
greatest score are drawn, which samples without replacement in proportion to
the exponential of the weights.

The draw sorts in parallel by regular sampling.  Tasks score rows by one array
of gains and write them as locally sorted runs.  Rows at regular places of the
runs, ``SAMPLES`` in all, give the splitters, keys of score, id and row number, so
equal scores and ids are split like any others.  Runs are exchanged by segment
between splitters, each segment sorted where it arrives, and sums of the
segments' counts give each row its exact rank.  Only segments that hold drawn
rows are exchanged.  The driver sees ``buckets`` counts, the sampled keys and a
count a segment.

Defined results: a null or empty text has no features, weight zero and is not
drawn if ``least`` is positive; rows that repeat are scored and ranked each,
those of equal score and id in any order; null ids come first among equal
scores and have the noise of an empty id.  An empty table gives no rows, an empty
target gains from smoothing alone.  Columns other than id and text are not looked at.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assayframe.llm.bpe import slices
from assayframe.llm.shared import short_batches, stored

#: Rows at regular places of the runs that are sent to the driver, at most and but for one a run; rows of a segment aimed at.
SAMPLES, SEGMENT = 1 << 15, 1 << 20
#: Gains and noise are whole thousandths.
MILLI = 1000

_WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def places(text: bytes, n: int, buckets: int) -> tuple[int, np.ndarray]:
    """Number of a text's words, and the places of its features, repeats included."""
    words = text.translate(_WORD_BYTES).split(b" ")
    words = [w for w in words if w]
    grams = chain(words, *(map(b" ".join, zip(*(words[i:] for i in range(m)))) for m in range(2, n + 1)))
    return len(words), np.fromiter(map(zlib.crc32, grams), np.uint32) % np.uint32(buckets)


def counts(df: DataFrame, text: str, n: int, buckets: int) -> np.ndarray:
    """Features of all texts in each place."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for texts in slices(batch.column(0)):
                for x in texts:
                    total += np.bincount(places((x or "").encode(), n, buckets)[1], minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["place", "c"])

    parts = df.select(F.col(text).alias("text")).mapInArrow(counted, "place long, c long")
    out = np.zeros(buckets, np.int64)
    for place, c in parts.groupBy("place").agg(F.sum("c")).collect():  # a row a bucket
        out[place] = c
    return out


def gains(of_all: np.ndarray, of_target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of the target's share to the documents', each place smoothed by one."""
    s, t = of_all.astype(np.float64), of_target.astype(np.float64)
    ratio = (t + 1) * (s.sum() + len(s)) / ((s + 1) * (t.sum() + len(t)))
    return np.floor(MILLI * np.log(ratio)).astype(np.int64)


def weights(text: Column, gain: np.ndarray, n: int) -> Column:
    """Struct of a text's numbers of words and features, and the sum of the features' gains."""

    @F.arrow_udf("n_words long, n_features long, weight long")
    def weight(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            out = []
            for texts in slices(batch):
                for x in texts:
                    n_words, own = places((x or "").encode(), n, len(gain))
                    out.append((n_words, len(own), int(gain[own].sum())))
            columns = np.array(out, np.int64).reshape(-1, 3).T
            yield pa.StructArray.from_arrays([pa.array(c) for c in columns], ["n_words", "n_features", "weight"])

    return weight(text)


def gumbel(key: Column, seed: int) -> Column:
    """Thousandths of Gumbel noise from the first 32 bits of the SHA-256 of seed and key."""
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(named, 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-float(MILLI)) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


class Splitters:
    """Keys that part all rows into segments, in the order of descending score, ascending id (null first) and row number."""

    def __init__(self, keys: np.ndarray, segments: int):
        """``keys``: sampled rows of (negated score, whether there is an id, id, row)."""
        keys = keys[np.lexsort(keys.T[::-1])] if len(keys) else keys
        at = np.arange(1, segments) * len(keys) // segments
        self.keys = np.unique(keys[at[at < len(keys)]], axis=0) if len(keys) else keys

    def segment(self, keys: np.ndarray) -> np.ndarray:
        """So many splitters are at or below each key."""
        all_keys = np.concatenate([self.keys, keys])
        order = np.lexsort((np.arange(len(all_keys)), *all_keys.T[::-1]))
        below = np.cumsum(order < len(self.keys))
        out = np.empty(len(all_keys), np.int64)
        out[order] = below
        return out[len(self.keys) :]


KEY = ("down", "named", "id", "row")


def _keys(batch: pa.RecordBatch) -> np.ndarray:
    return np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in KEY], axis=1).astype(np.int64)


def ranked(rows: DataFrame, score: str, key: str, wanted: Column, draw: int, count: int) -> DataFrame:
    """``rows`` with ``rank``: 1, 2, 3... of the ``draw`` greatest scores of the ``count`` rows that are ``wanted``, else null.

    ``key`` is a long column.  Rows are written once, as locally sorted runs.
    """
    spark = rows.sparkSession
    runs = rows.withColumns({"wanted": F.coalesce(wanted, F.lit(False)), "down": -F.col(score), "named": F.col(key).isNotNull().cast("int"), "id": F.coalesce(key, F.lit(0)).cast("long")})
    runs = stored(runs.withColumn("row", F.monotonically_increasing_id()).sortWithinPartitions(F.desc("wanted"), *KEY), "score-runs")
    stride = max(1, -(-count // SAMPLES))

    def regular(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left = stride // 2
        for batch in batches:
            at = np.arange(left, batch.num_rows, stride)
            left = left + len(at) * stride - batch.num_rows
            yield batch.take(pa.array(at))

    columns = [F.col(c).cast("long").alias(c) for c in KEY]
    sampled = runs.where("wanted").select(columns).mapInArrow(regular, ", ".join(f"{c} long" for c in KEY)).toArrow()
    keys = np.stack([sampled.column(c).to_numpy() for c in KEY], axis=1)
    segments = max(16 * int(spark.conf.get("spark.sql.shuffle.partitions")), -(-count // SEGMENT))  # a tenth of them drawn still keeps all tasks busy
    sent = spark.sparkContext.broadcast(Splitters(keys, segments))

    @F.arrow_udf(T.LongType())
    def segment(down: pa.Array, named: pa.Array, id_: pa.Array, row: pa.Array) -> pa.Array:
        return pa.array(sent.value.segment(np.stack([c.to_numpy(zero_copy_only=False) for c in (down, named, id_, row)], axis=1)))

    own = runs.withColumn("segment", F.when(F.col("wanted"), segment(*columns)))
    sizes = sorted(map(tuple, own.where("wanted").groupBy("segment").count().collect()))  # a row a segment
    before = np.cumsum([0, *(n for _, n in sizes)])
    offsets = [(s, int(b)) for (s, _), b in zip(sizes, before) if b < draw]
    own = own.join(F.broadcast(spark.createDataFrame(offsets, "segment long, before long")), "segment", "left")
    place = F.row_number().over(Window.partitionBy("segment").orderBy(*KEY))
    drawn = own.where("before is not null").withColumn("rank", F.col("before") + place)
    drawn = drawn.withColumn("rank", F.when(F.col("rank") <= draw, F.col("rank")))
    return drawn.unionByName(own.where("before is null").withColumn("rank", F.lit(None).cast("long"))).select(*rows.columns, "rank")


def resampled(docs: DataFrame, target: DataFrame, key: str = "doc_id", text: str = "text", target_text: str = "text", n: int = 1, buckets: int = 10_000, seed: int = 2024, least: int = 20, percent: int = 10) -> DataFrame:
    """``key, n_features, weight, score, rank`` for every document; of those with ``least`` words or more, ``percent`` of a hundred are drawn."""
    short_batches(docs.sparkSession)
    gain = gains(counts(docs, text, n, buckets), counts(target, target_text, n, buckets))
    rows = docs.select(F.col(key).cast("long").alias("key"), weights(F.col(text), gain, n).alias("own")).select("key", "own.*")
    rows = stored(rows.withColumn("score", F.col("weight") + gumbel(F.col("key"), seed)), "scores")
    wanted = F.col("n_words") >= least
    count = rows.where(wanted).count()
    out = ranked(rows, "score", "key", wanted, percent * count // 100, count)
    return out.select(F.col("key").alias(key), "n_features", "weight", "score", "rank")
