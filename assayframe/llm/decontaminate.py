"""Benchmark decontamination by winnowing, in DataFrame operations.

Texts are lower-cased (A-Z) and cut to words.  Every run of ``WINDOW`` words
keeps the least hash of its k-grams of ``GRAM`` words as its fingerprint, so a
span of WINDOW words shared by a document and an item has one fingerprint in
both.  Neighbouring runs mostly keep the same one, which is kept once, with the
first and last run that it stands for.  Documents meet items on fingerprints
alone; only documents that meet one come back with their words, where each hit
is extended over its runs, verified word by word and united with overlapping
ones.  No shared span of WINDOW words or more can be missed, and none that
isn't shared counts.

Items of fewer words than WINDOW are one window each.  They meet documents on
their least k-gram, or on the hash of the whole item if it is shorter than a
k-gram, and are verified in the same way.

Defined results: a null or empty text, or one without words, has no words and
no hits; an item without words can't occur; a null item id is listed as an
empty string, and rows that repeat an item id are one item.  Repeated documents
each get their row.  With an empty table of items nothing is contaminated.
Other columns of the documents pass through; an output column replaces one of
the same name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assayframe.llm.shared import key_marks, lower_ascii, may_hold, stored

WINDOW, GRAM = 10, 5
#: Item windows are broadcast up to so many bytes (their strings and 40 a row), else they are joined by a shuffle.
BROADCAST_BYTES = 8 << 20
#: Characters between words.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BETWEEN_ANY_CASE = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
RESULT = ("n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def words(text: Column) -> Column:
    return F.array_remove(F.split(lower_ascii(F.coalesce(text, F.lit(""))), BETWEEN), "")


def n_words(text: Column) -> Column:
    """Number of words, which does not depend on case."""
    return F.size(F.array_remove(F.split(F.coalesce(text, F.lit("")), BETWEEN_ANY_CASE), "")).cast("long")


def _slide(n: Column, width: int, make) -> Column:
    """``make(i)`` for each start i of a run of ``width`` among ``n``."""
    return F.when(n >= width, F.transform(F.sequence(F.lit(0), n - width), make)).otherwise(F.array().cast("array<bigint>"))


def _grams(hashes: str, n: Column, width: int) -> Column:
    """Hash of each run of ``width`` words."""
    return _slide(n, width, lambda i: F.xxhash64(*(F.get(hashes, i + k) for k in range(width))))


def hashed(df: DataFrame, text: str) -> DataFrame:
    """``df`` with __words, __n, __hash (of each word) and __grams."""
    df = df.withColumn("__words", words(F.col(text))).withColumn("__n", F.size("__words"))
    df = df.withColumn("__hash", F.transform("__words", lambda w: F.xxhash64(w)))
    return df.withColumn("__grams", _grams("__hash", F.col("__n"), GRAM))


def window_prints(df: DataFrame) -> DataFrame:
    """``hashed``'s frame with __prints: the fingerprint of each run of WINDOW words."""
    span = WINDOW - GRAM + 1
    return df.withColumn("__prints", _slide(F.size("__grams"), span, lambda i: F.least(*(F.get("__grams", i + k) for k in range(span)))))


def winnowed(prints: Column) -> Column:
    """Each fingerprint where it is first kept, with the first and last run of words it is kept for."""
    return _let(prints, lambda p: _let(
        F.filter(F.sequence(F.lit(0), F.size(p) - 1), lambda i: (i == 0) | (F.get(p, i) != F.get(p, i - 1))),
        lambda starts: F.transform(starts, lambda s, k: F.struct(F.get(p, s).alias("print"), s.alias("first"), (F.coalesce(F.get(starts, k + 1), F.size(p)) - 1).alias("last"))),
    ))


def _let(value: Column, use) -> Column:
    """``use(value)`` with value made once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def broadcast_if_small(df: DataFrame, text: str) -> DataFrame:
    """A stored table, to be broadcast if it is within BROADCAST_BYTES."""
    size = df.agg(F.sum(F.octet_length(text) + 40)).first()[0] or 0
    return F.broadcast(df) if size <= BROADCAST_BYTES else df


def run_of(start: Column, length: Column) -> Column:
    """The text of a run of a document's words."""
    return F.array_join(F.slice("__words", start + 1, length), " ")


def item_windows(items: DataFrame, item: str, text: str) -> DataFrame:
    """``item_id, window, length, print, at, kind`` for each window of each item.

    kind is WINDOW for full windows, met on their fingerprint; GRAM for shorter
    items, met on the least k-gram, the ``at``-th; and the length below that.
    """
    base = window_prints(hashed(items.select(F.coalesce(F.col(item).cast("string"), F.lit("")).alias("item_id"), F.col(text).alias("__text")), "__text").where("__n > 0"))
    full = base.where(F.col("__n") >= WINDOW).select("item_id", "__words", F.posexplode_outer("__prints").alias("i", "print"))
    full = full.select("item_id", run_of(F.col("i"), F.lit(WINDOW)).alias("window"), F.lit(WINDOW).alias("length"), "print", F.lit(0).alias("at"), F.lit(WINDOW).alias("kind"))
    short = base.where(F.col("__n") < WINDOW)
    least = F.array_min("__grams")
    whole = F.coalesce(*(F.when(F.col("__n") == k, F.xxhash64(*(F.get("__hash", F.lit(i)) for i in range(k)))) for k in range(1, GRAM)))
    has_gram = F.col("__n") >= GRAM
    short = short.select(
        "item_id",
        F.array_join("__words", " ").alias("window"),
        F.col("__n").alias("length"),
        F.when(has_gram, least).otherwise(whole).alias("print"),
        F.when(has_gram, F.array_position("__grams", least).cast("int") - 1).otherwise(F.lit(0)).alias("at"),
        F.when(has_gram, F.lit(GRAM)).otherwise(F.col("__n")).alias("kind"),
    )
    return full.union(short).distinct()


def _met(docs: DataFrame, runs: Column, windows: DataFrame) -> DataFrame:
    """``__id, __text_hash, first, last, length, window``: the runs of words at which documents may hold a window."""
    # outer, so that no filter on the generated arrays' size is inferred, pushed down and makes them again; a null print meets nothing
    found = docs.select("__id", "__text_hash", F.explode_outer(runs).alias("r")).select("__id", "__text_hash", "r.*").join(windows, "print")
    return found.select("__id", "__text_hash", (F.col("first") - F.col("at")).alias("first"), (F.col("last") - F.col("at")).alias("last"), "length", "window")


def hits(docs: DataFrame, windows: DataFrame) -> DataFrame:
    """All verified windows of ``docs`` (columns __id, __text_hash, __text): ``__id, __text_hash, start, length, window``."""
    kinds = {r[0] for r in windows.select("kind").distinct().collect()}  # at most six small numbers
    base = hashed(docs, "__text")
    each = lambda grams: F.transform(grams, lambda g, i: F.struct(g.alias("print"), i.alias("first"), i.alias("last")))
    out = None
    for kind in sorted(kinds):
        if kind == WINDOW:
            own, runs = window_prints(base), F.when(F.size("__prints") > 0, winnowed(F.col("__prints")))
        elif kind == GRAM:
            own, runs = base, each(F.col("__grams"))
        else:
            own, runs = base.withColumn("__short", _grams("__hash", F.col("__n"), kind)), each(F.col("__short"))
        wanted = stored(windows.where(F.col("kind") == kind).select("window", "length", "print", "at").distinct(), "item-prints")
        found = _met(own, runs, broadcast_if_small(wanted, "window"))
        out = out.union(found) if out else found
    if out is None:
        return docs.where("false").select("__id", "__text_hash", F.lit(0).alias("start"), F.lit(0).alias("length"), F.lit("").alias("window"))
    met = stored(out.distinct(), "window-meetings")
    same = ["__id", "__text_hash"]
    # one row a document from here on, so words of a document are never copied to each of its runs; texts that meet nothing are not moved
    run = F.struct("first", "last", "length", "window")
    texts = may_hold(docs, key_marks(met, *same), *same).select(*same, "__text")
    both = texts.unionByName(met.select(*same, run.alias("r")), allowMissingColumns=True).groupBy(*same).agg(F.max("__text").alias("__text"), F.collect_list("r").alias("__runs"))
    held = both.where(F.size("__runs") > 0).select(*same, words(F.col("__text")).alias("__words"), "__runs")

    def verified(run: Column) -> Column:
        holds = lambda s: (s >= 0) & (s + run["length"] <= F.size("__words")) & (run_of(F.greatest(s, F.lit(0)), run["length"]) == run["window"])
        found = F.filter(F.sequence(run["first"], run["last"]), holds)
        return F.transform(found, lambda s: F.struct(s.alias("start"), run["length"].alias("length"), run["window"].alias("window")))

    return held.select(*same, F.explode(F.flatten(F.transform("__runs", verified))).alias("h")).select(*same, "h.*")


def decontaminate(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text") -> DataFrame:
    """``docs`` with n_words, n_hit, n_items, items_sha256 and contaminated.

    Documents are told apart by key and text together, so equal rows share their
    counts and rows of one key with different texts don't mix.
    """
    windows = stored(item_windows(items, item, item_text), "item-windows")
    own = docs.select(F.col(key).alias("__id"), F.xxhash64(text).alias("__text_hash"), F.col(text).alias("__text"))
    found = stored(hits(own, windows).distinct(), "window-hits")

    same = ["__id", "__text_hash"]
    order = Window.partitionBy(*same).orderBy("start", "length")
    end = F.col("start") + F.col("length")
    before = F.coalesce(F.max(end).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    covered = found.select(*same, "start", "length").distinct().withColumn("fresh", F.greatest(F.lit(0), end - F.greatest("start", before)))
    covered = covered.groupBy(*same).agg(F.sum("fresh").alias("n_hit"))

    by_window = broadcast_if_small(stored(windows.select("window", "item_id").distinct(), "items-of-windows"), "window")
    listed = found.select(*same, "window").distinct().join(by_window, "window").select(*same, "item_id").distinct()
    listed = listed.groupBy(*same).agg(F.array_sort(F.collect_list("item_id")).alias("items"))
    listed = listed.select(*same, F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"))
    marks = covered.join(listed, [covered[c].eqNullSafe(listed[c]) for c in same]).select(covered["__id"], covered["__text_hash"], "n_hit", "n_items", "items_sha256")
    marks = stored(marks, "document-marks")

    # only documents that may have marks are joined; the rest, mostly almost all, is never moved
    rows, hit = docs.drop(*RESULT), key_marks(marks, *same)
    own = [F.col(key), F.xxhash64(text)]
    of_document = F.col(key).eqNullSafe(F.col("__id")) & (F.xxhash64(text) == F.col("__text_hash"))
    joined = may_hold(rows, hit, *own).join(marks, of_document, "left").drop(*same)
    rest = may_hold(rows, hit, *own, without=True)
    rows = joined.unionByName(rest, allowMissingColumns=True)
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    return rows.select(
        *docs.drop(*RESULT).columns,
        n_words(F.col(text)).alias("n_words"),
        n_hit.alias("n_hit"),
        F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("items_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )
