"""Ranks of means that differ by rounding alone: those of the SQL, whatever order a join gives the rows."""

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq

from assayframe.plans.more import ORACLE_SQL, QUERIES


def test_equal_means_rank_as_in_the_sql(spark, tmp_path):
    rng = np.random.default_rng(5)
    batches = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
    columns = {c: [] for c in ("l_orderkey", "l_partkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax")}
    for b in range(5):
        values = np.round(rng.integers(1, 99, (40, 2)) / 100, 2)
        for part in (14, 15, 16):  # labels of the same values in another order
            columns["l_orderkey"] += [b + 5 * int(k) for k in rng.permutation(10_000)[:40]]
            columns["l_partkey"] += [part] * 40
            for c, v in zip(("l_discount", "l_tax"), rng.permutation(values).T):
                columns[c] += v.tolist()
            columns["l_quantity"] += rng.integers(1, 51, 40).astype(float).tolist()
            columns["l_extendedprice"] += np.round(rng.random(40) * 1e4, 2).tolist()
    n = len(columns["l_tax"])
    line = pa.table(columns | {"l_suppkey": [1] * n, "l_linenumber": pa.array([1] * n, pa.int32())})
    keys = sorted(set(columns["l_orderkey"]))
    orders = pa.table({"o_orderkey": keys, "o_orderpriority": [batches[k % 5] for k in keys]})
    con = duckdb.connect()
    for name, table in (("lineitem", line), ("orders", orders)):
        pq.write_table(table, tmp_path / f"{name}.parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet'")
    cursor = con.execute(ORACLE_SQL["correlation_tests"])
    names = [c[0] for c in cursor.description]
    want = sorted(map(str, cursor.fetchall()))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # rows in the order of a shuffle
    try:
        got = sorted(str(tuple(r)) for r in QUERIES["correlation_tests"](spark, str(tmp_path)).select(*names).collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert got == want
