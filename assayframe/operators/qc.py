"""Quality control of cells by edit distance and barcode counts, and selection of variants."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assayframe.functions.labels import label_tag, variant_type

BARCODE, LABEL, DISTANCE = "meta_barcode", "meta_aa_changes", "meta_edit_distance"


def within_distance(cells: DataFrame, most: int) -> DataFrame:
    """Cells of at most ``most`` edits; those without a distance go."""
    return cells.where(F.col(DISTANCE) <= most)


def barcode_counts(cells: DataFrame, least: int, order: str | None = None) -> DataFrame:
    """Cells of each barcode, its first label by ``order``, and the count again if it reaches ``least``, else null."""
    first = F.min_by(LABEL, order) if order else F.min(LABEL)
    counts = cells.groupBy(BARCODE).agg(F.count("*").alias("n_cells"), first.alias(LABEL))
    return counts.withColumn("barcode_ok", F.when(F.col("n_cells") >= least, F.col("n_cells")))


def barcodes_per_variant(cells: DataFrame, least: int) -> DataFrame:
    """Distinct barcodes of each label, a null one counting once, and whether they reach ``least``."""
    n = F.count_distinct(BARCODE) + F.max(F.col(BARCODE).isNull().cast("int"))
    return cells.groupBy(LABEL).agg(n.cast("long").alias("n_barcodes")).withColumn("variant_ok", F.col("n_barcodes") >= least)


def passing(cells: DataFrame, max_distance: int, min_cells: int, min_barcodes: int) -> DataFrame:
    """Cells that pass the three filters in turn.

    Counts are aggregated before they meet the cells, so a barcode or label of
    very many cells is never gathered in one task.
    """
    near = within_distance(cells, max_distance)
    barcodes = barcode_counts(near, min_cells).where("barcode_ok is not null").select(F.col(BARCODE).alias("__barcode"))
    kept = near.join(barcodes, near[BARCODE].eqNullSafe(F.col("__barcode")), "left_semi")
    labels = barcodes_per_variant(kept, min_barcodes).where("variant_ok").select(F.col(LABEL).alias("__label"))
    return kept.join(labels, kept[LABEL].eqNullSafe(F.col("__label")), "left_semi")


def min_cells_per_variant(cells: DataFrame, least: int | None, wildtype: str = "WT") -> DataFrame:
    """Drops labels of fewer than ``least`` cells; the wild type always stays."""
    if least is None:
        return cells
    enough = cells.groupBy(LABEL).count().where((F.col("count") >= least) | (F.col(LABEL) == wildtype)).select(F.col(LABEL).alias("__label"))
    return cells.join(enough, F.col(LABEL) == F.col("__label"), "left_semi")


def split_allowed(cells: DataFrame, allowed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Cells whose label is in ``allowed`` and the others."""
    return cells.join(allowed, LABEL, "left_semi"), cells.join(allowed, LABEL, "left_anti")


def select_variants(cells: DataFrame, k: int, classes: list[str], mode: str = "top", seed: int = 0, allowed: DataFrame | None = None) -> DataFrame:
    """Cells of the ``k`` most frequent (ties by label) or seeded-random labels of ``classes``; other classes pass.

    Allowed labels pass uncounted.  Cells without a label go.
    """
    kind = variant_type(LABEL)
    inside, rest = split_allowed(cells, allowed) if allowed is not None else (None, cells)
    eligible = rest.where(kind.isin(classes)).groupBy(LABEL).count()
    order = [F.desc("count"), F.asc(LABEL)] if mode == "top" else [F.xxhash64(LABEL, F.lit(seed)), F.asc(LABEL)]
    best = eligible.orderBy(*order).limit(k).select(LABEL)
    out = rest.where(~kind.isin(classes)).unionByName(rest.join(F.broadcast(best), LABEL, "left_semi").select(rest.columns))
    return out if inside is None else out.unionByName(inside)


def seeded_ranks(df: DataFrame, within: list[str], keys: list[str], seed: int | Column = 0, to: str = "__rank", size: str = "__n") -> DataFrame:
    """``df`` with ``to``: 1, 2, ... in a group, in an order that depends on the seed and the keys alone, and the group's ``size``.

    Each 64th of the hashes' range is ranked apart and counted, so a group of
    any share of the rows is spread over tasks.
    """
    held = df.withColumn("__hash", F.xxhash64(seed if isinstance(seed, Column) else F.lit(seed), *keys)).withColumn("__range", F.shiftright("__hash", 58))
    group = Window.partitionBy(*within)
    before = F.coalesce(F.sum("count").over(group.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sums = held.groupBy(*within, "__range").count()
    sums = sums.select(*(F.col(c).alias(f"__of_{c}") for c in within), F.col("__range").alias("__of_range"), before.alias("__before"), F.sum("count").over(group).alias(size))
    own = held.withColumn(to, F.row_number().over(Window.partitionBy(*within, "__range").orderBy("__hash", *keys)))
    on = [F.col(c).eqNullSafe(F.col(f"__of_{c}")) for c in within] + [F.col("__range") == F.col("__of_range")]
    return own.join(sums, on).select(*df.columns, (F.col(to) + F.col("__before")).alias(to), size)


def pseudo_variants(cells: DataFrame, amount: float | int, classes: list[str], keys: list[str], seed: int = 0) -> DataFrame:
    """Adds downsampled copies of eligible labels, tagged ``downsample-<amount>``.

    A float keeps that share of each label, rounded down; an integer keeps that
    many cells and leaves out labels that have fewer.  Tagged labels aren't eligible.
    """
    rows = cells.where(variant_type(LABEL).isin(classes) & label_tag(LABEL).isNull())
    rows = seeded_ranks(rows, [LABEL], keys, seed)
    keep = F.floor(F.col("__n") * amount) if isinstance(amount, float) else F.when(F.col("__n") >= amount, amount).otherwise(0)
    copies = rows.where(F.col("__rank") <= keep).drop("__rank", "__n").withColumn(LABEL, F.concat(LABEL, F.lit(f":downsample-{amount}")))
    return cells.unionByName(copies)


def downsample_control(cells: DataFrame, control: Column, keys: list[str], frac: float | None = None, n: int | None = None, seed: int = 0) -> DataFrame:
    """Keeps the controls of lowest seeded hash: ``n``, or the share ``frac`` rounded down.

    The cut is the wanted order statistic of the hashes, found without putting
    all controls in one partition; ties at the cut are settled by the keys.
    """
    rows = cells.withColumn("__control", F.coalesce(control, F.lit(False))).withColumn("__hash", F.xxhash64(F.lit(seed), *keys))
    total = rows.where("__control").count()
    keep = min(total, int(total * frac) if frac is not None else n)
    if keep >= total:
        return cells
    buckets = 4096
    bucket = F.shiftright(F.col("__hash"), 52)  # the upper 12 bits, in the hashes' order
    sizes = sorted((r["b"], r["count"]) for r in rows.where("__control").groupBy(bucket.alias("b")).count().collect())  # at most 4,096 rows
    assert len(sizes) <= buckets
    before, cut = 0, None
    for b, size in sizes:
        if before + size > keep:
            cut = b
            break
        before += size
    inside = rows.where(F.col("__control") & (bucket == cut)).withColumn("__rank", F.row_number().over(Window.orderBy("__hash", *keys)))
    kept = inside.where(F.col("__rank") <= keep - before).select(*cells.columns)
    return rows.where(~F.col("__control") | (bucket < cut)).select(*cells.columns).unionByName(kept)


def downsample_wildtype(cells: DataFrame, keys: list[str], wildtype: str = "WT", seed: int = 0) -> DataFrame:
    """Thins the wild type to the size of the largest variant, each barcode in proportion."""
    sizes = cells.groupBy((F.col(LABEL) == wildtype).alias("wt"), LABEL).count().groupBy("wt").agg(F.max("count").alias("n")).collect()
    n = {bool(r["wt"]): r["n"] for r in sizes if r["wt"] is not None}
    if True not in n or False not in n or n[True] <= n[False]:
        return cells
    share = n[False] / n[True]
    rows = seeded_ranks(cells.where(F.col(LABEL) == wildtype), [BARCODE], keys, seed)
    kept = rows.where(F.col("__rank") <= F.round(F.col("__n") * share)).select(cells.columns)
    return cells.where(F.coalesce(F.col(LABEL) != wildtype, F.lit(True))).unionByName(kept)


def label_metadata(cells: DataFrame, columns: list[str]) -> DataFrame:
    """Cells of each label and, for each column, its distinct values and an array of (value, count) sorted by value."""
    out = cells.groupBy(LABEL).agg(F.count("*").alias("meta_n_cells"))
    for c in (c for c in columns if c in cells.columns):
        name = c.removeprefix("meta_")
        counts = cells.groupBy(LABEL, F.col(c).alias("value")).agg(F.count("*").alias("count"))
        lists = counts.groupBy(F.col(LABEL).alias("__label")).agg(F.count("*").alias(f"meta_n_{name}"), F.array_sort(F.collect_list(F.struct("value", "count"))).alias(f"meta_{name}_counts"))
        out = out.join(lists, F.col(LABEL).eqNullSafe(F.col("__label")), "left").drop("__label")
    return out
