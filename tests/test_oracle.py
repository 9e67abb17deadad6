"""Every registered query against its DuckDB oracle on the smallest scale factor (the
round driver runs the same comparison at sf0.01).  Rows-only queries must run."""

import duckdb
import pytest

import __spark_entry__ as E
from tidemark.plans import REGISTRY
from tidemark.sources.tables import TABLES
from tools.oracle_check import digest, frame_rows

SF = "/root/testdata/sf0.001"
NAMES = sorted(REGISTRY)  # the optional queries have tests of their own


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    got = E.queries()[name](spark, SF).toPandas()
    sql = E.oracle_sql().get(name)
    if sql is None:
        assert len(got.columns) > 0
        return
    want = duck.execute(sql).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) == len(want)
    assert digest(frame_rows(got)) == digest(frame_rows(want))


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["address", "date", "balance", "_unique_key"]
    assert df.count() > 0
