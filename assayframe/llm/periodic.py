"""Runs of periodic words, found through string synchronising sets.

A run is a stretch of words whose words ``period`` apart are the same, which no
neighbouring word extends, of at least ``EXPONENT`` periods and ``LEAST`` words.
At each scale t = 2, 4, 8, ... a position belongs to the synchronising set if,
of the hashes of the t words from each of the t + 1 positions from it on, the
first or the last is the smallest, highly periodic places (a period of t / 3 or
less) left out.  Whether a position belongs depends on the next 2t words alone,
so in a run of period t <= p < 2t a chosen position and the one a period later
are chosen together, and no other one of the same 2t words lies between: pairs
of neighbours of equal context propose all such periods, a few for each run.
The highly periodic places, found from the next occurrence of each half
context, propose the small periods that they leave out.  Proposals are extended
to both sides by jumps of equal hashes, and the runs found are compared word by
word.

Texts are whole and independent rows: no shuffle, and a task works on texts of
about two megabytes at once, or on one longer text.  Time grows as the words
times the logarithm of the longest text.

Defined results: a null, empty or blank text has no runs and an empty collapsed
text; texts may be of any length; rows that repeat each get their result; a
column of the output's name is replaced, all others pass through.  An empty table
gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayframe.llm.bpe import slices, spread
from assayframe.llm.shared import short_batches

#: A run has so many periods, and so many words, at least.
EXPONENT, LEAST = 4, 6
FOUND = "runs array<struct<start: long, length: long, period: long>>, collapsed string"
LAST = np.uint64(2**64 - 1)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that looks random."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _double(h: np.ndarray, by: int) -> np.ndarray:
    """Hashes of twice as many words."""
    return mixed(h[:-by] * np.uint64(0x9E3779B97F4A7C15) + h[by:] + np.uint64(1)) if len(h) > by else h[:0]


def _reach(levels: list[np.ndarray], a: np.ndarray, b: np.ndarray, back: bool) -> np.ndarray:
    """So many words from a on (or back from before a) are the same as those from b."""
    total = np.zeros(len(a), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        h, step = levels[k], 1 << k
        open_ = np.arange(len(a))
        while len(open_):
            x, y = (c[open_] - total[open_] - step if back else c[open_] + total[open_] for c in (a, b))
            inside = (x >= 0) & (y < len(h))
            open_, x, y = open_[inside], x[inside], y[inside]
            open_ = open_[h[x] == h[y]]
            total[open_] += step
    return total


def _periodic(h: np.ndarray, repeated: np.ndarray, t: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places whose next t words have a period of t / 3 or less, and the period; ``h`` hashes t / 2 words, ``repeated`` holds all places whose t / 2 words occur again.

    Third, the places of ``repeated`` that are there for these t / 2 words indeed.
    """
    order = repeated[np.argsort(h[repeated], kind="stable")]
    same = h[order[1:]] == h[order[:-1]]
    still = np.zeros(len(order), bool)
    still[1:] |= same
    still[:-1] |= same
    at, gap = order[:-1][same], np.diff(order)[same]
    fit = (gap <= t // 3) & (at + t <= len(h) + t // 2 - 1)
    at, gap = at[fit], gap[fit]
    fit = h[at + t // 2 - gap] == h[at + t // 2]
    at, gap = at[fit], gap[fit]
    by_place = np.argsort(at)
    return at[by_place], gap[by_place], np.sort(order[still])


def runs(words: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text, start, length and period of all runs, in this order, of texts of ``sizes`` numbered words, one text after the other."""
    by_size = np.argsort(sizes, kind="stable")  # at larger scales only the longer texts matter, which then are the last
    ends = np.cumsum(sizes[by_size] + 1)
    starts = ends - sizes[by_size] - 1
    first = np.cumsum(sizes) - sizes
    own = np.full(int(ends[-1]) if len(ends) else 0, -1, np.int64)
    own[spread(starts, sizes[by_size])] = words[spread(first[by_size], sizes[by_size])]
    text = np.repeat(np.arange(len(sizes)), sizes[by_size] + 1)
    own = np.where(own < 0, -1 - text, own)  # what ends a text is like nothing else
    h = mixed(own.astype(np.uint64) + mixed(text.astype(np.uint64) + np.uint64(1)))  # so only words of a text are ever alike
    levels, found, repeated, t = [h], [], np.arange(len(h)), 1
    after = _double(h, 1)
    while True:
        t *= 2
        long = np.searchsorted(sizes[by_size], EXPONENT * t if t > 4 else LEAST)  # period one is found at scale 4, all others at a scale of no more than the period
        if long == len(sizes):
            break
        half, h, after = h, after, _double(after, t)  # of t / 2, t and 2t words
        levels.append(h)
        lo = int(starts[long])
        repeated = repeated[np.searchsorted(repeated, lo) :]
        repeated = repeated[: np.searchsorted(repeated, len(half))]
        at, period, repeated = _periodic(half, repeated, t)
        if len(at):
            new = np.ones(len(at), bool)
            new[1:] = (np.diff(at) != 1) | (np.diff(period) != 0)
            found.append((at[new], period[new]))
        chosen = _synchronising(h, after, at, repeated, lo, t)
        order = chosen[np.argsort(after[chosen], kind="stable")]
        gap = np.diff(order)
        pair = (after[order[1:]] == after[order[:-1]]) & (gap >= t) & (gap < 2 * t)
        found.append((order[:-1][pair], gap[pair]))
    at, period = (np.concatenate([np.zeros(0, np.int64), *x]) for x in zip(*found)) if found else (np.zeros(0, np.int64),) * 2
    start = at - _reach(levels, at, at + period, back=True)
    length = at + period + _reach(levels, at, at + period, back=False) - start
    whole = length >= np.maximum(LEAST, EXPONENT * period)
    start, length, period = np.unique(np.stack([start, length, period])[:, whole], axis=1)
    true = [bool((own[s : s + n - p] == own[s + p : s + n]).all()) for s, n, p in zip(start, length, period)]
    start, length, period = start[true], length[true], period[true]
    rank = text[start]
    out = np.stack([by_size[rank], start - starts[rank], length, period])
    return tuple(out[:, np.lexsort((out[3], out[1], out[0]))])


def _synchronising(h: np.ndarray, after: np.ndarray, periodic: np.ndarray, repeated: np.ndarray, lo: int, t: int) -> np.ndarray:
    """Places of the synchronising set of scale t from ``lo`` on whose context of 2t words may occur again; ``h`` hashes t words."""
    key = h[lo:].copy()
    key[periodic[periodic < len(h)] - lo] = LAST
    least, width = key, 1
    while width < t:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    least = np.minimum(least[:-1], least[1:])
    place = repeated[(repeated - lo < len(least)) & (repeated < len(after))] - lo
    small = least[place]
    return lo + place[(small < LAST) & ((key[place] == small) | (key[place + t] == small))]


def cut(texts: list[bytes]) -> list[list[bytes]]:
    """Words of each text: what white space of ASCII parts."""
    return [x.split() for x in texts]


def _found(words: list[list[bytes]]) -> tuple[list[list[dict]], list[bytes]]:
    """The runs of each text, and the text without what repeats."""
    known: dict[bytes, int] = {}
    numbers = np.array([known.setdefault(w, len(known)) for own in words for w in own], np.int64)
    lists: list[list[dict]] = [[] for _ in words]
    dropped: dict[int, np.ndarray] = {}
    for i, start, length, period in zip(*(x.tolist() for x in runs(numbers, np.array([len(x) for x in words], np.int64)))):
        lists[i].append({"start": start, "length": length, "period": period})
        dropped.setdefault(i, np.zeros(len(words[i]), bool))[start + period : start + length] = True
    kept = [[w for w, gone in zip(own, dropped[i].tolist()) if not gone] if i in dropped else own for i, own in enumerate(words)]
    return lists, [b" ".join(x) for x in kept]


def with_runs(df: DataFrame, text: str = "text", key: str = "doc_id", to: str = "periodic", changed: Callable[[list[bytes], int | None], list[bytes]] | None = None) -> DataFrame:
    """``df`` with a struct ``to``: the text's ``runs`` by start and period, and the words that stay, ``collapsed``, joined by one space.

    Of a run all words but those of its first period go.  ``changed`` is given
    the words and the key of each row, and gives the words to look at.
    """
    short_batches(df.sparkSession)

    @F.arrow_udf(FOUND)
    def periodic(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, keys in batches:
            lists, kept, at = [], [], 0
            for some in slices(texts):
                words = cut([(x or "").encode() for x in some])
                if changed:
                    words = [changed(own, k) for own, k in zip(words, keys.slice(at, len(some)).to_pylist())]
                at += len(some)
                more = _found(words)
                lists += more[0]
                kept += more[1]
            kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
            yield pa.StructArray.from_arrays([pa.array(lists, kind), pa.array(kept, pa.binary()).cast(pa.string())], ["runs", "collapsed"])

    return df.withColumn(to, periodic(F.col(text), F.col(key).cast("long")))
