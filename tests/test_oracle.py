"""Every registered query against its DuckDB oracle on the sf0.001 tables."""

import os

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")

SQL = E.oracle_sql()
ALL = [n for n in SQL if not n.startswith("op")]  # the others are in tests/llm


@pytest.fixture(scope="module")
def duck():
    import duckdb
    from scripts.check_oracle import TABLES
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", ALL)
def test_query_matches_oracle(spark, duck, name):
    from scripts.check_oracle import rows_of
    sdf = E.queries()[name](spark, SF).toPandas()
    odf = duck.execute(SQL[name]).df()
    sc, sr = rows_of(sdf)
    oc, orr = rows_of(odf)
    assert sc == oc
    assert sr == orr


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and "person_id" in df.columns
