"""Positions along a sequence: runs, matching with a structure, and effect maps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assayframe.functions import labels
from assayframe.functions.columns import finite
from assayframe.sources.tables import written


def runs(df: DataFrame, position: str, value: str) -> DataFrame:
    """``value, first, last`` of each run of neighbouring positions of one value; repeated positions count once.

    A run keeps position minus its rank among the value's positions constant.
    """
    rows = df.where(F.col(position).isNotNull() & F.col(value).isNotNull()).select(position, value).distinct()
    rank = F.row_number().over(Window.partitionBy(value).orderBy(position))
    return rows.withColumn("__run", F.col(position) - rank).groupBy(value, "__run").agg(F.min(position).alias("first"), F.max(position).alias("last")).drop("__run")


def common_wildtype(scored: DataFrame, position: str, wildtype: str) -> DataFrame:
    """``position, wildtype``: the most frequent wild type of each position, ties by letter; null where all are."""
    counts = scored.where(F.col(position).isNotNull()).groupBy(position, wildtype).agg(F.count(wildtype).alias("__n"))
    best = F.min(F.struct(-F.col("__n"), F.col(wildtype).alias("letter")))  # a null has no count and comes last
    return counts.groupBy(position).agg(best["letter"].alias(wildtype))


def match_residues(scored: DataFrame, residues: DataFrame, position: str, wildtype: str, residue: str, name: str) -> DataFrame:
    """``position, state``: matched, mismatched, outside (scored, not in the structure) or unscored (the reverse).

    A position's wild type is its most frequent letter.
    """
    left = common_wildtype(scored, position, wildtype).withColumnsRenamed({position: "p", wildtype: "w"})
    right = residues.groupBy(F.col(residue).alias("r")).agg(F.min(name).alias("s"))
    state = F.when(F.col("r").isNull(), "outside").when(F.col("p").isNull(), "unscored").when(F.coalesce(F.col("w") != F.col("s"), F.lit(False)), "mismatched").otherwise("matched")
    return left.join(right, F.col("p") == F.col("r"), "full_outer").select(F.coalesce("p", "r").alias("position"), state.alias("state"))


def checked_match(matched: DataFrame, most: float) -> DataFrame:
    """Counts of states; more than a share ``most`` of mismatches among shared residues is an error."""
    counts = matched.agg(*(F.count_if(F.col("state") == s).alias(s) for s in ("matched", "mismatched", "outside", "unscored")))
    share = F.try_divide("mismatched", F.col("matched") + F.col("mismatched"))
    return counts.withColumn("mismatch", F.when(share > most, F.raise_error(F.lit("the structure's residues don't fit the scored ones"))).otherwise(share))


def effect_cells(df: DataFrame, label: str, score: str, how: str = "mean") -> DataFrame:
    """``wt, position, mut, score`` of single substitutions, repeated ones as their mean, median, min or max."""
    wt, place, mut = labels.substitution(label)
    one = {"mean": F.avg, "median": F.median, "min": F.min, "max": F.max}[how]
    return df.select(wt.alias("wt"), place.alias("position"), mut.alias("mut"), finite(score).alias("score")).where("position is not null").groupBy("wt", "position", "mut").agg(one("score").alias("score"))


#: How the scores of one position and letter become one; ``first`` needs an order, ``error`` takes no second score.
COMBINED = {
    "mean": lambda order: F.avg("score"),
    "median": lambda order: F.median("score"),
    "min": lambda order: F.min("score"),
    "max": lambda order: F.max("score"),
    "first": lambda order: F.min_by("score", order),
    "error": lambda order: F.when(F.count("*") > 1, F.raise_error(F.lit("a position and letter have more than one score"))).otherwise(F.max("score")),
}


def effect_map(cells: DataFrame, letters: list[str], combine: str = "mean", order: str | None = None) -> DataFrame:
    """One row a letter and one a position of the range that cells span, missing ones null (long form of the grid).

    ``first`` takes the score of the row that comes first by the column ``order``
    (rows of null order don't count; equal ones: either).
    """
    if combine not in COMBINED or (combine == "first") != (order is not None):
        raise ValueError(f"combine by one of {', '.join(COMBINED)}, and by an order only for first")
    span = cells.agg(F.min("position").alias("a"), F.max("position").alias("b"))
    grid = span.where("a is not null").select(F.explode(F.sequence("a", "b")).alias("position")).select("position", F.explode(F.array(*map(F.lit, letters))).alias("mut"))
    values = cells.groupBy(F.col("position").alias("p"), F.col("mut").alias("m")).agg(COMBINED[combine](order).alias("score"))
    return grid.join(values, (F.col("position") == F.col("p")) & (F.col("mut") == F.col("m")), "left").select("position", "mut", "score")


def position_means(cells: DataFrame) -> DataFrame:
    """Mean of the cells that change the residue, per position."""
    return cells.where("wt <> mut").groupBy("position").agg(F.avg("score").alias("score"), F.count("*").alias("n"))


def severity(class_: Column) -> Column:
    """Rank of a clinical class, the smallest being the most severe: pathogenic, uncertain, benign."""
    return F.when(class_ == "P/LP", 0).when(class_ == "B/LB", 2).otherwise(1)


def communities(links: DataFrame, rounds: int = 10) -> DataFrame:
    """``node, cluster`` by label propagation over an undirected graph ``a, b``: each node takes the commonest label around it, ties to the smaller.

    Labels start as the nodes' own names; each round is written out,
    so its plan stays short.  Communities may differ from those of other methods.
    """
    both = links.select("a", "b").union(links.select("b", "a")).distinct()
    state = both.select(F.col("a").alias("node"), F.col("a").alias("cluster")).distinct()
    for _ in range(rounds):
        heard = both.join(state, F.col("b") == F.col("node")).groupBy("a", "cluster").agg(F.count("*").alias("n"))
        # a node hears itself too, which keeps two neighbours from swapping labels for ever
        heard = heard.union(state.select(F.col("node").alias("a"), "cluster", F.lit(1).cast("long").alias("n"))).groupBy("a", "cluster").agg(F.sum("n").alias("n"))
        new = heard.groupBy("a").agg(F.min(F.struct((-F.col("n")).alias("n"), "cluster"))["cluster"].alias("cluster")).select(F.col("a").alias("node"), "cluster").transform(written)
        moved = new.join(state.withColumnRenamed("cluster", "old"), "node").where("cluster <> old").limit(1).count()
        state = new
        if not moved:
            break
    return state
