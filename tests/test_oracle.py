"""Every registered query against its independent DuckDB SQL (sf0.001)."""

import duckdb
import pytest

import __spark_entry__ as E
from tools.check_oracle import TABLES, rows
from yoyflow.plans.registry import all_queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


OWN = sorted(q.name for q in all_queries())


def test_every_query_has_an_oracle():
    assert set(OWN) <= set(E.queries()) and set(OWN) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", OWN)
def test_query_matches_oracle(spark, con, name):
    got_cols, got = rows(E.queries()[name](spark, SF).toPandas())
    want_cols, want = rows(con.execute(E.oracle_sql()[name]).df())
    assert got_cols == want_cols
    assert len(got) == len(want)
    assert got == want


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and "SCProof_Mapping" in df.columns
