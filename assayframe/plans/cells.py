"""The cell view over the driver's tables, in Spark SQL and DuckDB SQL alike."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FEATURES = ["quantity", "price", "discount", "tax"]
KEYS = ["meta_order", "meta_line", "meta_part", "meta_supplier", "price"]

LABEL_SQL = """CASE WHEN l_partkey % 40 < 6 THEN 'WT' WHEN l_partkey % 40 < 14 THEN concat('A', l_partkey % 40, 'A')
    WHEN l_partkey % 40 < 36 THEN concat('A', l_partkey % 40, 'V') WHEN l_partkey % 40 = 36 THEN 'A36fs'
    WHEN l_partkey % 40 = 37 THEN 'A37-' WHEN l_partkey % 40 = 38 THEN 'A38X' ELSE 'A39V:tag' END"""

CELLS_SQL = f"""SELECT l_orderkey AS meta_order, l_linenumber AS meta_line, l_partkey AS meta_part, l_suppkey AS meta_supplier,
    concat('bc', l_partkey % 40, '_', l_suppkey % 8) AS meta_barcode, {LABEL_SQL} AS meta_aa_changes,
    o_orderpriority AS meta_batch, l_linenumber % 3 AS meta_edit_distance,
    l_quantity AS quantity, l_extendedprice AS price, l_discount AS discount, l_tax AS tax
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""

#: SQL that opens an oracle: the cells and whether each is a control.
WITH_CELLS = f"WITH cells AS ({CELLS_SQL}), marked AS (SELECT *, meta_aa_changes LIKE 'A%A' AS control FROM cells)"


def cells(spark: SparkSession, sf_dir: str, placed: bool = False) -> DataFrame:
    """The view; with ``placed`` also the file and row that a cell stands in."""
    line = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    place = [F.col("_metadata.file_path").alias("meta_file"), F.col("_metadata.row_index").alias("meta_row")] if placed else []
    line = line.select("*", *place)
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", "o_orderpriority")
    rows = line.join(orders, line["l_orderkey"] == orders["o_orderkey"])
    return rows.select(
        F.col("l_orderkey").alias("meta_order"),
        F.col("l_linenumber").alias("meta_line"),
        F.col("l_partkey").alias("meta_part"),
        F.col("l_suppkey").alias("meta_supplier"),
        F.expr("concat('bc', l_partkey % 40, '_', l_suppkey % 8)").alias("meta_barcode"),
        F.expr(LABEL_SQL).alias("meta_aa_changes"),
        F.col("o_orderpriority").alias("meta_batch"),
        F.expr("l_linenumber % 3").alias("meta_edit_distance"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_discount").alias("discount"),
        F.col("l_tax").alias("tax"),
        *(["meta_file", "meta_row"] if placed else []),
    )
