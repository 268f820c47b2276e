"""Approximate nearest neighbours by a permutation index.

Every vector is represented by its nearest pivots in order.  A vector is posted
in the inverted files of its ``PREFIX`` nearest pivots together with the
pivot's rank; a query visits the files of its own nearest pivots and adds up,
for each vector found there, how much smaller the footrule distance of the two
permutations is than that of permutations without a common pivot.  The vectors
of the least footrule distance, ties included, are compared by exact cosine in
double precision.

The index is split by a hash of the vectors and their ids into shards of about
``SHARD``, however the table is partitioned; every vector of the table is in
one.  A task builds the files of a shard and gives its nearest few for each query
of a block, so nothing but the vectors and these few rows is shuffled.  Query
blocks of bounded size are sent to all tasks one after the other.

Up to ``N_PIVOTS`` pivots come from a bounded sample, the ``PIVOT_SAMPLE`` vectors
of least hash: no more than half of them, and none much like a pivot before it,
so a crowd of copies gives one.  Of a shard's n vectors, ``CANDIDATES`` times
n ** ``GROWTH`` are compared exactly, at every size alike.

Defined results: vectors that are null, empty, zero, or hold null or non-finite
values take no part, nor do vectors of another length than the most frequent
one (the greater of two equally frequent).  Rows that repeat both id and vector are one
candidate; a row of the query's own id is none.  Of several query rows of one id
the least vector asks.  Rows without an id may be found, but don't ask.  Ties go to
smaller ids, nulls first.  With fewer candidates than ``k`` all are returned;
an empty table gives no rows.  Columns other than id and vector are not looked at.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assayframe.llm.bpe import spread
from assayframe.llm.shared import stored

N_PIVOTS, PREFIX = 2048, 40
#: Vectors that pivots are chosen from, and the cosine from which two of them are too alike to be both pivots.
PIVOT_SAMPLE, ALIKE = 4096, 0.9
SHARD, QUERY_BLOCK = 32_768, 10_000
#: So many times this power of a shard's vectors are compared exactly.
CANDIDATES, GROWTH = 1.6, 0.75
FOUND = "query_id long, vec_id long, score double"


def usable(vector: Column) -> Column:
    """Whether a vector takes part, whatever its length."""
    values = vector.cast("array<double>")
    finite = F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(values, lambda x: x != 0), F.lit(False))


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length one; scaled by the largest component first, so squares neither overflow nor vanish."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def permutations(vectors: np.ndarray, pivots: np.ndarray, prefix: int) -> np.ndarray:
    """Numbers of the nearest pivots of each unit vector, nearest first, ties to the smaller number."""
    out = [np.argsort(-(vectors[i : i + 2048] @ pivots.T), axis=1, kind="stable")[:, :prefix] for i in range(0, len(vectors), 2048)]
    return np.concatenate([np.zeros((0, prefix), np.int64), *out])


def choose_pivots(sample: np.ndarray, n: int) -> np.ndarray:
    """Up to ``n`` of the unit vectors, in their order, none much like one before it."""
    chosen, held = np.empty((n, sample.shape[1])), 0
    for row in sample:
        if held == n:
            break
        if not held or (chosen[:held] @ row).max() < ALIKE:
            chosen[held] = row
            held += 1
    return chosen[:held]


class Shard:
    """The inverted files of some vectors."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, pivots: np.ndarray, prefix: int):
        self.ids, self.vectors, self.prefix = ids, vectors, prefix
        own = permutations(vectors, pivots, prefix)
        order = np.argsort(own.ravel(), kind="stable")
        self.rows, self.ranks = (order // prefix).astype(np.int32), (order % prefix).astype(np.int32)
        self.starts = np.searchsorted(own.ravel()[order], np.arange(len(pivots) + 1))

    def nearest(self, query_id: int, query: np.ndarray, ranked: np.ndarray, k: int, wanted: int) -> list[tuple[int, int | None, float]]:
        """The ``k`` nearest by cosine among the ``wanted`` vectors of least footrule distance."""
        sizes = self.starts[ranked + 1] - self.starts[ranked]
        at = spread(self.starts[ranked], sizes)  # |r - s| instead of the two ranks' distances from the place after the prefix
        gain = np.bincount(self.rows[at], 2.0 * (self.prefix - np.maximum(np.repeat(np.arange(len(ranked)), sizes), self.ranks[at])), len(self.ids))
        if wanted < len(gain):
            cut = np.partition(gain, len(gain) - wanted)[len(gain) - wanted]
            chosen = np.flatnonzero(gain >= cut)
        else:
            chosen = np.arange(len(gain))
        chosen = chosen[self.ids[chosen] != query_id]
        score = self.vectors[chosen] @ query
        if len(chosen) > k:  # a product rounds by a row's place, so those close to the k-th are scored once more
            chosen = chosen[score >= np.partition(score, len(score) - k)[len(score) - k] - ROUNDING]
        score = row_cosines(self.vectors[chosen], query)
        best = np.lexsort((self.ids[chosen], -score))[:k]
        return [(query_id, None if self.ids[chosen[i]] == NO_ID else int(self.ids[chosen[i]]), float(score[i])) for i in best]


def row_cosines(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Cosines of unit vectors, each row summed by itself in one order, so that equal vectors have equal ones wherever they stand."""
    return np.ascontiguousarray(vectors * query).sum(axis=1)


#: More than products of unit vectors may be off.
ROUNDING = 1e-9


#: Stands for a null id inside a shard.
NO_ID = np.iinfo(np.int64).min


def search(
    df: DataFrame,
    is_query: Column,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    k: int = 5,
    n_pivots: int = N_PIVOTS,
    prefix: int = PREFIX,
    candidates: float = CANDIDATES,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the nearest found of each row for which ``is_query`` holds."""
    spark = df.sparkSession
    none = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    rows = df.where(usable(F.col(vector))).withColumn("__vector", F.col(vector).cast("array<double>"))
    dims = rows.groupBy(F.size("__vector").alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).first()
    if dims is None:
        return none
    dim = dims["dim"]
    rows = rows.where(F.size("__vector") == dim)
    shards = -(-dims["count"] // SHARD)
    index = rows.select(F.col(vec_id).cast("long").alias("vec_id"), F.col("__vector").alias("vector")).distinct()
    index = stored(index.withColumn("hash", F.xxhash64("vec_id", "vector")), "vectors")
    asking = rows.where(is_query & F.col(vec_id).isNotNull()).groupBy(F.col(vec_id).cast("long").alias("vec_id")).agg(F.min("__vector").alias("vector"))
    asking = stored(asking, "queries")
    blocks = -(-asking.count() // QUERY_BLOCK)
    if not blocks:
        return none
    asking = stored(asking.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks))), "query-blocks", "block")
    sample = index.orderBy("hash", "vec_id", "vector").limit(PIVOT_SAMPLE).collect()
    pivots = choose_pivots(unit(np.array([r["vector"] for r in sample])), min(n_pivots, max(1, len(sample) // 2)))
    prefix = min(prefix, len(pivots))
    found = none.drop("rank")
    for block in range(blocks):
        own = asking.where(F.col("block") == block).collect()
        if not own:
            continue
        queries = unit(np.array([r["vector"] for r in own]))
        sent = spark.sparkContext.broadcast(([r["vec_id"] for r in own], queries, permutations(queries, pivots, prefix), pivots))

        found = found.union(index.groupBy(F.pmod("hash", F.lit(shards)).alias("shard")).applyInArrow(_visitor(sent, dim, prefix, candidates, k), FOUND).select("query_id", "vec_id", "score"))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc_nulls_first("vec_id"))
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _visitor(sent: Broadcast, dim: int, prefix: int, candidates: float, k: int) -> Callable[[pa.Table], pa.Table]:
    """What gives the nearest few of a shard for each query sent."""

    def visit(shard: pa.Table) -> pa.Table:
        ids, queries, ranked, pivots = sent.value
        vectors = shard.column("vector").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
        files = Shard(shard.column("vec_id").combine_chunks().fill_null(NO_ID).to_numpy(), unit(vectors), pivots, prefix)
        wanted = int(candidates * len(files.ids) ** GROWTH) + k
        out = [hit for q, v, r in zip(ids, queries, ranked) for hit in files.nearest(q, v, r, k, wanted)]
        columns = list(zip(*out)) or [(), (), ()]
        return pa.table({"query_id": pa.array(columns[0], pa.int64()), "vec_id": pa.array(columns[1], pa.int64()), "score": pa.array(columns[2], pa.float64())})

    return visit
