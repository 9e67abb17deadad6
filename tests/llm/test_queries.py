"""Every registered query of the operators runs over whole tables; with SQL, it equals DuckDB."""

import duckdb
import pytest

import __spark_entry__ as E
from tidemark.llm import queries
from tidemark.sources.tables import TABLES
from tools.oracle_check import digest, frame_rows

SF = "/root/testdata/sf0.001"


def test_every_operator_is_registered_once():
    names = [n.split("_")[0] for n in queries.QUERIES]
    assert sorted(names, key=lambda n: int(n[2:])) == [f"op{i}" for i in range(1, 14)]
    assert set(queries.QUERIES) | {"pipeline"} <= set(E.queries())
    assert set(queries.ORACLES) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    got, want = queries.QUERIES[name](spark, SF).toPandas(), con.execute(queries.ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert digest(frame_rows(got)) == digest(frame_rows(want))
