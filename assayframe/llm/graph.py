"""Connected components by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayframe.llm.shared import drop_path, shared_path, written


def _stars(links: DataFrame) -> DataFrame:
    """Each node's smaller neighbours joined to the smallest of them (links go from the larger node u to the smaller v)."""
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    moved = links.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def _wide_stars(links: DataFrame) -> DataFrame:
    """Each node's larger neighbours joined to the smallest of all its neighbours and itself."""
    both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """``node, root`` for every node with a link; root is the smallest node of its component.

    Only minima per node are aggregated, so a node with very many links never
    gathers them in one task.  Every round is written to the shared folder, so
    the plan stays short and a lost executor costs a round's task at most.
    """
    spark = links.sparkSession
    links = links.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    links = links.where("u is not null and v is not null").distinct()
    state, path = None, None
    while True:
        out = shared_path(spark, "links")
        links = written(links, out)
        if path:
            drop_path(spark, path)
        path = out
        now = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state or not now[0]:
            return links.select(F.col("u").alias("node"), F.col("v").alias("root")).union(links.select("v", "v").distinct())
        state = now
        links = _stars(_wide_stars(links))
