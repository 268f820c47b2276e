"""Every registered query with SQL gives the same rows in DuckDB."""

import math
import os

import duckdb
import pytest

import __spark_entry__
from assayframe.plans import ORACLE_SQL, QUERIES
from assayframe.plans.cells import WITH_CELLS

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def oracle(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def text(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return str(v)
    return f"{v:.6g}" if isinstance(v, float) and v else "0" if isinstance(v, float) else str(v)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, oracle, name):
    df = QUERIES[name](spark, sf_dir)
    names = sorted(df.columns)
    got = sorted("|".join(text(r[c]) for c in names) for r in df.collect())
    assert names
    if name in ORACLE_SQL:
        cursor = oracle.execute(ORACLE_SQL[name])
        found = [c[0] for c in cursor.description]
        assert sorted(found) == names
        assert got == sorted("|".join(text(dict(zip(found, r))[c]) for c in names) for r in cursor.fetchall())


def test_entry_and_names(spark):
    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
    assert os.path.exists(__spark_entry__.SMOKE_DIR)


def test_folds_of_all_variants(spark, sf_dir, oracle):
    names = {r[0] for r in oracle.execute(f"{WITH_CELLS} SELECT DISTINCT meta_aa_changes FROM cells WHERE meta_aa_changes <> 'WT'").fetchall()}
    assert {"A14V", "A36fs", "A37-", "A38X", "A39V:tag"} <= names == {r.scored_against for r in QUERIES["fold_scores"](spark, sf_dir).collect()}
