"""Order statistics of every feature within every label, without a row a cell and feature.

Tasks turn blocks of rows into sorted runs of each feature's values, cut into
ranges where there are many cells; the runs of one feature and range are merged
in one task, in packed arrays.  Counts of the ranges tell every range at which
rank of each label it begins, so comparisons with the control and the values at
wanted ranks are found range by range.  Equal values of a label are counted in
a block before anything is shuffled.  Only finite values count.  Ranges only deal
values out: results don't depend on them.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayframe.functions.columns import finite
from assayframe.sources.tables import written

#: Values of a feature that a range is made for, about.
RANGE_VALUES = 2_000_000
#: Most ranges of a feature; features times ranges bounds are sent to the tasks.
MOST_RANGES = 4096
#: Bytes of rows that are turned into runs together, and of runs that are sent on together.
BLOCK_BYTES = 64 << 20
PIECE_BYTES = 16 << 20
#: Bytes of a side that is sent to all tasks at most.
BROADCAST_BYTES = 64 << 20

PIECES = "feature int, range int, values binary, codes binary, counts binary"
MERGED = "feature int, range int, control_values binary, control_counts binary, group_values binary, group_counts binary, codes binary, lengths binary, sums binary, control_sum long, control_ties double"
OFFSETS = "feature int, range int, before binary, totals binary, control_before long, control_total long, all_ties double"
COMPARED = "feature int, code long, n double, m double, up double, down double, u double, own_ties double, control_ties double"
RANKED = "feature int, code long, n long, first int, found array<double>"


@dataclass(frozen=True)
class Runs:
    """``merged`` runs with their ``offsets``; ``codes`` has ``label, control, code`` (0 for all control rows); ``probs`` those of the ranges' bounds."""

    merged: DataFrame
    offsets: DataFrame
    codes: DataFrame
    features: list[str]
    probs: list[float]

    def named(self, df: DataFrame) -> DataFrame:
        """``df`` of ``feature`` numbers and ``code`` with names and labels for these; control rows have none and go."""
        names = F.array(*map(F.lit, self.features))
        labels = within(self.codes.where("not control").select("label", F.col("code").alias("__code")), F.octet_length("label"))
        joined = df.join(labels, F.col("code") == F.col("__code"))
        return joined.select("label", F.element_at(names, F.col("feature") + 1).alias("feature"), *(c for c in df.columns if c not in ("feature", "code")))


def within(df: DataFrame, *sizes: Column) -> DataFrame:
    """A written table, sent to all tasks if the ``sizes`` of its rows are within BROADCAST_BYTES in all, else joined by a shuffle."""
    size = df.agg(F.sum(sum((F.coalesce(s, F.lit(0)) for s in sizes), F.lit(40)))).first()[0] or 0
    return F.broadcast(df) if size <= BROADCAST_BYTES else df


def packed(a: np.ndarray, kind: type) -> bytes:
    return np.ascontiguousarray(a, kind).tobytes()


def floats(b: bytes) -> np.ndarray:
    return np.frombuffer(b, np.float64)


def longs(b: bytes) -> np.ndarray:
    return np.frombuffer(b, np.int64)


def starts(*keys: np.ndarray) -> np.ndarray:
    """Where sorted rows differ from the one before."""
    new = np.ones(len(keys[0]), bool)
    if len(new):
        new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    return np.flatnonzero(new)


def range_probs(n: int, range_values: int) -> list[float]:
    """Probabilities of the bounds between a feature's ranges; none where one range is enough."""
    ranges = min(MOST_RANGES, -(-n // range_values))
    return [i / ranges for i in range(1, ranges)]


def approximate(column: Column, probs: list[float]) -> Column:
    """Approximate quantiles, finer than the ranges."""
    return F.approx_percentile(column, F.array(*map(F.lit, probs)), F.lit(max(1000, 4 * len(probs))))


def bounds_of(quantiles: Iterable[float] | None) -> np.ndarray:
    return np.unique(np.array(quantiles or [], float))


def runs_of(batches: list[pa.RecordBatch], bounds: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """The block's runs: distinct (value, code) pairs of each feature and range in order, with their counts."""
    block = pa.Table.from_batches(batches)
    codes = block.column(0).to_numpy()
    by_code = np.argsort(codes, kind="stable")
    out: list[tuple] = []
    size = 0
    for f, cuts in enumerate(bounds):
        v, c = block.column(f + 1).to_numpy()[by_code], codes[by_code]
        fine = np.isfinite(v)
        v, c = v[fine], c[fine]
        order = np.argsort(v, kind="stable")  # codes stay in order among equal values
        made = pieces_of(f, v[order], c[order], np.ones(len(v), np.int64), cuts)
        out += made
        size += sum(map(len, (b for piece in made for b in piece[2:])))
        if size >= PIECE_BYTES:
            yield as_batch(out)
            out, size = [], 0
    if out:
        yield as_batch(out)


def pieces_of(feature: int, v: np.ndarray, c: np.ndarray, k: np.ndarray, cuts: np.ndarray) -> list[tuple]:
    """A piece for each range met of values ``v`` in order, equal ones by code ``c``, with counts ``k``."""
    at = starts(v, c)
    v, c, k = v[at], c[at], np.add.reduceat(k, at) if len(at) else k
    edges = [0, *np.searchsorted(v, cuts, "left"), len(v)]
    return [(feature, i, packed(v[a:b], np.float64), packed(c[a:b], np.int64), packed(k[a:b], np.int64)) for i, (a, b) in enumerate(zip(edges, edges[1:])) if a < b]


def as_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["feature", "range", "values", "codes", "counts"])


def merge(pieces: pd.DataFrame) -> pd.DataFrame:
    """One row: all runs of a feature and range, the control by value, the groups by code and value."""
    v = np.concatenate([floats(b) for b in pieces["values"]])
    c = np.concatenate([longs(b) for b in pieces["codes"]])
    k = np.concatenate([longs(b) for b in pieces["counts"]])
    order = np.lexsort((v, c))
    v, c, k = v[order], c[order], k[order]
    at = starts(c, v)
    v, c, k = v[at], c[at], np.add.reduceat(k, at)
    split = np.searchsorted(c, 0, "right")
    first = starts(c[split:])
    sums = np.add.reduceat(k[split:], first) if len(first) else k[:0]
    lengths = np.diff(np.append(first, len(c) - split))
    control = k[:split].astype(float)
    row = (pieces["feature"].iloc[0], pieces["range"].iloc[0], packed(v[:split], np.float64), packed(k[:split], np.int64), packed(v[split:], np.float64), packed(k[split:], np.int64), packed(c[split:][first], np.int64), packed(lengths, np.int64), packed(sums, np.int64), int(k[:split].sum()), float((control**3 - control).sum()))
    return pd.DataFrame([row], columns=[p.split()[0] for p in MERGED.split(", ")])


def offsets(sums: pd.DataFrame) -> pd.DataFrame:
    """For each range of a feature: how many values of each of its codes, and of the control, are in lower ranges and in all."""
    sums = sums.sort_values("range", ignore_index=True)
    per = [longs(b) for b in sums["codes"]]
    c, k = np.concatenate(per), np.concatenate([longs(b) for b in sums["sums"]])
    order = np.argsort(c, kind="stable")  # ranges stay in order within a code
    first = starts(c[order])
    sizes = np.diff(np.append(first, len(c)))
    upto = np.cumsum(k[order])
    low = (upto - k[order])[first]
    before, totals = np.empty(len(c), np.int64), np.empty(len(c), np.int64)
    before[order] = upto - k[order] - np.repeat(low, sizes)
    totals[order] = np.repeat(np.add.reduceat(k[order], first) if len(first) else k[:0], sizes)
    ends = np.cumsum([len(p) for p in per])
    control = sums["control_sum"].to_numpy()
    control_before = np.cumsum(control) - control
    rows = [
        (f, r, packed(before[e - len(p) : e], np.int64), packed(totals[e - len(p) : e], np.int64), b, control.sum(), sums["control_ties"].sum())
        for f, r, p, e, b in zip(sums["feature"], sums["range"], per, ends, control_before)
    ]
    return pd.DataFrame(rows, columns=[p.split()[0] for p in OFFSETS.split(", ")])


def runs(cells: DataFrame, control: Column, features: list[str], label: str, range_values: int = RANGE_VALUES) -> Runs:
    """Sorted runs of all features, written, so that whoever asks for statistics shares them.

    ``cells`` is read for its labels, for bounds if there is more than one
    range, and for the runs.  Null labels are a label; null ``control`` is false.
    """
    marked = cells.select(F.col(label).alias("label"), F.coalesce(control, F.lit(False)).alias("control"), *(F.col(f).cast("double").alias(f"f{i}") for i, f in enumerate(features)))
    own = [f"f{i}" for i in range(len(features))]
    kinds = marked.groupBy("label", "control").agg(F.count("*").alias("cells"))
    # any distinct numbers will do: they are written once and read from there
    codes = written(kinds.withColumn("code", F.when(F.col("control"), F.lit(0).cast("long")).otherwise(F.monotonically_increasing_id() + 1)), "codes")
    probs = range_probs(codes.agg(F.sum("cells")).first()[0] or 0, range_values)
    cuts = marked.agg(*(approximate(finite(f), probs) for f in own)).first() if probs else [None] * len(own)
    bounds = [bounds_of(q) for q in cuts]  # at most MOST_RANGES a feature
    known = within(codes.select(F.col("label").alias("__label"), F.col("control").alias("__control"), "code"), F.octet_length("__label"))
    rows = marked.join(known, F.col("label").eqNullSafe(F.col("__label")) & (F.col("control") == F.col("__control"))).select("code", *own)

    def transposed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.nbytes
            if size >= BLOCK_BYTES:
                yield from runs_of(held, bounds)
                held, size = [], 0
        if held:
            yield from runs_of(held, bounds)

    return merged_runs(rows.mapInArrow(transposed, PIECES), codes, features, probs)


def merged_runs(pieces: DataFrame, codes: DataFrame, features: list[str], probs: list[float]) -> Runs:
    """Pieces merged by feature and range, written, with their offsets."""
    merged = written(pieces.groupBy("feature", "range").applyInPandas(merge, MERGED), "runs")
    sums = merged.select("feature", "range", "codes", "sums", "control_sum", "control_ties")
    return Runs(merged, written(sums.groupBy("feature").applyInPandas(offsets, OFFSETS), "offsets"), codes, features, probs)


#: Values of a merged run that tell where the ranges of deviations should be cut.
PICKS = 1000


def deviations(made: Runs, centres: DataFrame) -> Runs:
    """Runs of the groups' distances from their centres (written ``feature, code, q``, the first of q), made from the runs alone, without a join of rows."""
    packed_centres = centres.groupBy("feature").agg(F.array_sort(F.collect_list(F.struct("code", F.get("q", F.lit(0)).alias("q")))).alias("c"))  # a pair a label
    each = made.merged.select("feature", "range").join(packed_centres, "feature")
    each = written(each.select(F.col("feature").alias("__feature"), F.col("range").alias("__range"), F.col("c.code").alias("known"), F.col("c.q").alias("centre")), "centres")
    near = within(each, F.size("known") * 16)
    held = made.merged.select("feature", "range", "group_values", "group_counts", "codes", "lengths").join(near, (F.col("feature") == F.col("__feature")) & (F.col("range") == F.col("__range")))

    def distances(row) -> tuple[np.ndarray, np.ndarray]:
        codes, lengths = longs(row.codes), longs(row.lengths)
        centre = np.asarray(row.centre, float)[np.searchsorted(np.asarray(row.known, np.int64), codes)]
        return np.abs(floats(row.group_values) - np.repeat(centre, lengths)), np.repeat(codes, lengths)

    def picks(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples(index=False):
                d = distances(row)[0] if row.codes else np.empty(0)
                yield pd.DataFrame({"feature": row.feature, "d": d[:: max(1, len(d) // PICKS)]})

    cuts = {}
    if made.probs:
        found = held.mapInPandas(picks, "feature int, d double").groupBy("feature").agg(approximate(F.col("d"), made.probs).alias("cuts"))
        cuts = {r.feature: bounds_of(r.cuts) for r in found.collect()}  # at most MOST_RANGES a feature

    def moved(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples(index=False):
                if row.codes:
                    d, c = distances(row)
                    order = np.lexsort((c, d))
                    made_ = pieces_of(row.feature, d[order], c[order], longs(row.group_counts)[order], cuts.get(row.feature, np.empty(0)))
                    yield pd.DataFrame(made_, columns=[p.split()[0] for p in PIECES.split(", ")])

    return merged_runs(held.mapInPandas(moved, PIECES), made.codes, made.features, made.probs)


def placed(made: Runs) -> DataFrame:
    """Merged runs with their offsets."""
    of = within(made.offsets.withColumnsRenamed({"feature": "__feature", "range": "__range"}), F.octet_length("before"), F.octet_length("totals"))
    return made.merged.join(of, (F.col("feature") == F.col("__feature")) & (F.col("range") == F.col("__range"))).drop("__feature", "__range")


def comparisons(made: Runs) -> DataFrame:
    """``feature, code`` and counts ``n`` and ``m`` of the group and the control, the largest differences of their distribution functions ``up`` and ``down``, pairs won ``u`` and sums of cubes of ``ties``.

    The difference is largest at a group's value or just before one, so the
    control is looked up at these only.  Features without control have no rows.
    """
    wanted = ["feature", "range", "control_values", "control_counts", "group_values", "group_counts", "codes", "lengths", "before", "totals", "control_before", "control_total", "all_ties"]

    def compared(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples(index=False):
                codes, lengths = longs(row.codes), longs(row.lengths)
                if not len(codes):
                    continue
                v, k, m = floats(row.group_values), longs(row.group_counts), float(row.control_total)
                below = np.concatenate([[0], np.cumsum(longs(row.control_counts))]) + row.control_before
                control = floats(row.control_values)
                upto_control, before_control = below[np.searchsorted(control, v, "right")], below[np.searchsorted(control, v, "left")]
                r = upto_control - before_control
                first = np.cumsum(lengths) - lengths
                run = np.cumsum(k)
                upto = run - np.repeat(run[first] - k[first] - longs(row.before), lengths)
                n = np.repeat(longs(row.totals), lengths)
                at, just_before = upto / n - upto_control / m, (upto - k) / n - before_control / m
                both, alone = (k + r).astype(float), r.astype(float)
                yield pd.DataFrame(
                    {
                        "feature": row.feature,
                        "code": codes,
                        "n": longs(row.totals).astype(float),
                        "m": m,
                        "up": np.maximum.reduceat(np.maximum(at, just_before), first),
                        "down": np.minimum.reduceat(np.minimum(at, just_before), first),
                        "u": np.add.reduceat(k * (before_control + r / 2), first),
                        "own_ties": np.add.reduceat((both**3 - both) - (alone**3 - alone), first),
                        "control_ties": row.all_ties,
                    }
                )

    found = placed(made).where("control_total > 0").select(wanted).mapInPandas(compared, COMPARED)
    return found.groupBy("feature", "code").agg(
        F.max("n").alias("n"),
        F.max("m").alias("m"),
        F.greatest(F.max("up"), F.lit(0.0)).alias("up"),
        F.least(F.min("down"), F.lit(0.0)).alias("down"),
        F.sum("u").alias("u"),
        (F.max("control_ties") + F.sum("own_ties")).alias("ties"),
    )


#: Codes whose ranks are looked up at a time.
CODES_AT_ONCE = 4096


def quantiles(made: Runs, probs: list[float]) -> DataFrame:
    """``feature, code, q``: linear quantiles at ascending ``probs`` of each label (code 0: of the control)."""
    p = np.array(probs, float)
    wanted = ["feature", "range", "control_values", "control_counts", "group_values", "group_counts", "codes", "sums", "before", "totals", "control_sum", "control_before", "control_total"]

    def ranks(n: np.ndarray) -> np.ndarray:
        """The lower and the upper rank of each quantile of n values, one after the other: ascending."""
        at = n[:, None] * p[None, :]
        return np.stack([np.floor(at), np.ceil(at)], 2).reshape(len(n), -1).astype(np.int64)

    def looked_up(feature, v, k, codes, sums, before, totals) -> pd.DataFrame:
        run = np.cumsum(k)
        low = np.cumsum(sums) - sums
        rows = []
        for a in range(0, len(codes), CODES_AT_ONCE):
            some = slice(a, a + CODES_AT_ONCE)
            r = ranks(totals[some] - 1)
            local = r - before[some, None]
            inside = (local >= 0) & (local < sums[some, None])
            value = v[np.minimum(np.searchsorted(run, local + low[some, None], "right"), len(v) - 1)]
            for code, n, i, own in zip(codes[some], totals[some], inside, value):
                if i.any():  # the ranks of a range follow each other
                    rows.append((feature, code, n, int(i.argmax()), own[i]))
        return pd.DataFrame(rows, columns=["feature", "code", "n", "first", "found"])

    def found(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples(index=False):
                if row.control_sum:
                    one = [np.array([x], np.int64) for x in (0, row.control_sum, row.control_before, row.control_total)]
                    yield looked_up(row.feature, floats(row.control_values), longs(row.control_counts), *one)
                if row.codes:
                    yield looked_up(row.feature, floats(row.group_values), longs(row.group_counts), longs(row.codes), longs(row.sums), longs(row.before), longs(row.totals))

    parts = placed(made).select(wanted).mapInPandas(found, RANKED).groupBy("feature", "code")
    parts = parts.agg(F.max("n").alias("n"), F.array_sort(F.collect_list(F.struct("first", "found"))).alias("parts"))  # two values a quantile in all
    values = parts.select("feature", "code", "n", F.flatten(F.col("parts.found")).alias("v"))

    def between(prob: Column, i: Column) -> Column:
        low, high, at = F.get("v", 2 * i), F.get("v", 2 * i + 1), prob * (F.col("n") - 1)
        return F.when(low == high, low).otherwise((F.ceil(at) - at) * low + (at - F.floor(at)) * high)

    return values.select("feature", "code", F.transform(F.array(*map(F.lit, probs)), between).alias("q"))


def medians(rows: DataFrame, features: list[str], label: str, deviation: bool = False) -> tuple[DataFrame, DataFrame | None]:
    """``label`` and each feature's median, in columns of the features' names, and the same of the median absolute ``deviation``; labels without any finite value have no row."""
    made = runs(rows, F.lit(False), features, label)
    middle = quantiles(made, [0.5])
    middle = written(middle, "medians") if deviation else middle

    def wide(found: DataFrame) -> DataFrame:
        named = made.named(found).select("label", "feature", F.get("q", F.lit(0)).alias("q"))
        return named.groupBy(F.col("label").alias(label)).pivot("feature", features).agg(F.first("q"))

    return wide(middle), wide(quantiles(deviations(made, middle), [0.5])) if deviation else None
