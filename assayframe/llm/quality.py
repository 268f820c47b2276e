"""Quality classifier: support vectors on naive-Bayes features.

A text's indicators are its word n-grams, word shapes and neighbouring shapes,
hashed to ``N_FEATURES`` places.  Each place is scaled by the log ratio of the
two classes' counts, and a linear hinge-loss model with squared norm is fitted
by dual coordinate descent.  The model is mixed with the plain mean weight, as
its authors propose, and a logistic curve fitted to decision values of folds
turns values into probabilities.

The fit takes a bounded sample: at most ``MOST_LABELLED`` labelled rows, those
of least hash of their id, and of these, in that order, as many as have
``MOST_PLACES`` indicators together.  Only their packed indicators (four bytes
each) are sent to the driver.
Scoring covers every row and whole texts; the weights, of fixed size, go to
each task.

Defined results: a null text is empty, and an empty text has the score of its
bias; a null label takes no part in the fit; if one class is missing every
score is that class's share.  Rows that repeat each get their score; a column
of the output's name is replaced, all others pass through.  An empty table gives
no rows.
"""

from __future__ import annotations

import re
import warnings
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assayframe.llm.bpe import slices
from assayframe.llm.shared import short_batches, stored

N_FEATURES = 1 << 18
#: Documented bounds of the sample that the model is fitted on.
MOST_LABELLED, MOST_PLACES = 4000, 16_000_000
#: Weight of the fitted model against its mean weight, cost of the hinge loss, folds for the curve.
MIX, COST, FOLDS = 0.9, 1.0, 3
#: Descent ends when no projected gradient of a round is larger; past so many rounds a warning says that it didn't.
TOLERANCE, MOST_ROUNDS = 0.1, 300

_other = str.maketrans({c: "w" for c in "abcdefghijklmnopqrstuvwxyz"} | {c: "W" for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"} | {c: "0" for c in "0123456789"})
_runs = re.compile(r"(.)\1+").sub


def shape(word: str) -> str:
    """A word with its letters and digits made alike and runs cut to one: ``Word,`` gives ``Ww,``."""
    if not word.isascii():
        word = "".join(c if c.isascii() else "W" if c.isupper() else "w" if c.isalpha() else c for c in word)
    return _runs(r"\1", word.translate(_other))


class Shapes(dict):
    """Shapes of words, kept while they are few."""

    def __missing__(self, word: str) -> str:
        own = shape(word)
        if len(word) <= 24 and len(self) < 200_000:
            self[word] = own
        return own


_shapes = Shapes()


def indicators(text: str) -> np.ndarray:
    """Places of a text's indicators, ascending and distinct."""
    words = text.split()
    shapes = list(map(_shapes.__getitem__, words))
    grams = set(words)
    grams.update(map("\x01".join, zip(words, words[1:])))
    grams.update(map("\x02".__add__, shapes))
    grams.update(map("\x03".join, zip(shapes, shapes[1:])))
    grams.update(map("\x04".join, zip(shapes, shapes[1:], shapes[2:])))
    same = sum(map(str.__eq__, words, words[1:]))
    n = max(1, len(words))
    grams.add(f"\x05same{min(9, int(20 * same / n))}")
    grams.add(f"\x05new{int(10 * len(set(words)) / n)}")
    grams.add(f"\x05upper{int(10 * sum(map(str.isupper, words)) / n)}")
    plain = sum(map(str.isalpha, words)) / n
    grams.add(f"\x05plain{int(10 * plain)}")
    grams.add(f"\x05size{min(12, len(words)).bit_length()}")
    joined = "\n".join(grams).encode("utf-8", "surrogatepass").split(b"\n")
    return np.unique(np.fromiter(map(zlib.crc32, joined), np.uint32, len(joined)) & (N_FEATURES - 1)).astype(np.int32)


def feature_lists(text: Column) -> Column:
    """``indicators`` of a text column, packed as binary."""

    @F.arrow_udf(T.BinaryType())
    def places(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([indicators(x or "").tobytes() for texts in slices(batch) for x in texts], pa.binary())

    return places(text)


class Model:
    """Weights of the hashed indicators, a bias and the two numbers of a logistic curve."""

    def __init__(self, weights: np.ndarray, bias: float, slope: float, middle: float):
        self.weights, self.bias, self.slope, self.middle = weights, bias, slope, middle

    def value(self, places: np.ndarray) -> float:
        return float(self.weights[places].sum() / np.sqrt(max(1, len(places))) + self.bias)

    def score(self, text: str) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.slope * (self.value(indicators(text)) - self.middle), -30, 30))))


def fit_linear(rows: list[np.ndarray], labels: np.ndarray, seed: int = 7, tolerance: float = TOLERANCE) -> tuple[np.ndarray, float]:
    """Weights of indicators (each divided by the root of its row's number of them) and bias."""
    counts = [np.full(N_FEATURES, 1.0), np.full(N_FEATURES, 1.0)]
    for places, label in zip(rows, labels):
        counts[int(label)][places] += 1
    ratio = np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())
    weights, bias = descend([ratio[places] / np.sqrt(max(1, len(places))) for places in rows], rows, labels, seed, tolerance)
    mean = np.abs(weights).mean()
    return (MIX * weights + (1 - MIX) * mean * np.sign(weights)) * ratio, bias


def costs(labels: np.ndarray) -> np.ndarray:
    """Each row's cost of the hinge loss; the two classes weigh the same."""
    return (COST * len(labels) / (2 * np.maximum(np.bincount(labels, minlength=2), 1)))[labels]


def descend(own: list[np.ndarray], rows: list[np.ndarray], labels: np.ndarray, seed: int, tolerance: float) -> tuple[np.ndarray, float]:
    """Weights and bias (of norm with them) of least hinge loss for rows that have values ``own`` at places ``rows``, by dual coordinate descent."""
    cost, sign = costs(labels), np.where(labels == 1, 1.0, -1.0)
    weights, bias, alpha = np.zeros(N_FEATURES), 0.0, np.zeros(len(rows))
    square = np.array([(x * x).sum() + 1 for x in own])
    order, rng = np.arange(len(rows)), np.random.default_rng(seed)
    for _ in range(MOST_ROUNDS):
        rng.shuffle(order)
        worst = 0.0
        for i in order:
            places, x = rows[i], own[i]
            slope = sign[i] * (weights[places] @ x + bias) - 1
            worst = max(worst, -slope if alpha[i] == 0 else slope if alpha[i] == cost[i] else abs(slope))
            new = min(max(alpha[i] - slope / square[i], 0.0), cost[i])
            step = (new - alpha[i]) * sign[i]
            if step:
                weights[places] += step * x
                bias += step
                alpha[i] = new
        if worst <= tolerance:
            return weights, bias
    warnings.warn(f"after {MOST_ROUNDS} rounds a projected gradient is {worst:.3g}, more than {tolerance}", stacklevel=2)
    return weights, bias


def fit_curve(values: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and middle of the logistic curve of greatest likelihood, by Newton's method with smoothed targets."""
    n1, n0 = labels.sum(), len(labels) - labels.sum()
    target = np.where(labels == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    scale = max(values.std(), 1e-9)
    x = np.column_stack((values / scale, np.ones(len(values))))
    beta = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(hessian, x.T @ (target - p) - 1e-3 * beta)
        beta += step
        if np.abs(step).max() < 1e-8:
            break
    slope = max(beta[0], 1e-6)
    return slope / scale, -beta[1] / slope * scale


def labelled_sample(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", most: int = MOST_LABELLED) -> DataFrame:
    """``text, label`` of at most ``most`` labelled documents, those of least hash of their key.

    Only keys are shuffled to choose them; the bounded choice is broadcast to
    the documents, whose texts stay where they are read.
    """
    rows = labels.where(F.col(label).isin(0, 1) & F.col(key).isNotNull()).select(F.col(key).alias("__key"), F.col(label).cast("int").alias("__label"))
    rows = rows.join(docs.select(F.col(key).alias("__key")), "__key", "left_semi")
    chosen = rows.orderBy(F.xxhash64("__key"), "__key", "__label").limit(most)
    return docs.join(F.broadcast(chosen), F.col(key) == F.col("__key")).select(F.col("__key").alias("key"), F.col("__label").alias("label"), F.coalesce(F.col(text), F.lit("")).alias("text"))


def fit(sample: DataFrame) -> Model:
    """A model of the labels of ``labelled_sample``; its rows' packed indicators, MOST_PLACES at most, are all that comes to the driver."""
    short_batches(sample.sparkSession)
    packed = stored(sample.select(F.xxhash64("key").alias("hash"), "key", "label", feature_lists(F.col("text")).alias("places")).withColumn("size", F.octet_length("places")), "labelled")
    order = ["hash", "key", "label", "size"]
    sizes = sorted(packed.select(*order).collect())  # four numbers of each of at most MOST_LABELLED rows
    total, last = 0, None
    for row in sizes:
        total += row["size"] // 4
        if total > MOST_PLACES:
            last = row
            break
    within = F.lit(True) if last is None else F.struct(*order) < F.struct(*(F.lit(v).cast(packed.schema[n].dataType).alias(n) for n, v in zip(order, last)))
    found = packed.where(within).collect()
    found.sort(key=lambda r: (r["hash"], r["key"], r["label"], bytes(r["places"])))  # the order of rows must not change the model
    places = [np.frombuffer(r["places"], np.int32) for r in found]
    labels = np.array([r["label"] for r in found], int)
    if len(set(labels.tolist())) < 2:
        share = labels.mean() if len(labels) else 0.5
        return Model(np.zeros(N_FEATURES), 0.0, 1.0, -float(np.log((share + 1e-3) / (1 - share + 1e-3))))
    fold = np.arange(len(places)) % FOLDS
    values = np.zeros(len(places))
    for f in range(FOLDS):
        inside = np.flatnonzero(fold != f)
        if len(set(labels[inside].tolist())) < 2:
            continue
        weights, bias = fit_linear([places[i] for i in inside], labels[inside])
        part = Model(weights, bias, 1.0, 0.0)
        values[fold == f] = [part.value(places[i]) for i in np.flatnonzero(fold == f)]
    return Model(*fit_linear(places, labels), *fit_curve(values, labels))


def scored(df: DataFrame, model: Model, text: str = "text", to: str = "score") -> DataFrame:
    """``df`` with the model's score of each text in column ``to``."""
    spark = df.sparkSession
    short_batches(spark)
    sent = spark.sparkContext.broadcast(model)

    @F.arrow_udf(T.DoubleType())
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = sent.value
        for batch in batches:
            yield pa.array([own.score(x or "") for texts in slices(batch) for x in texts], pa.float64())

    return df.withColumn(to, score(F.col(text)))
