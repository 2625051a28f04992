"""Queries of the subpackage that SQL can express, against DuckDB, by value."""

import duckdb
import pytest

import __spark_entry__ as contract
from pairloom.llm import queries

SF = "/root/testdata/sf0.01"


def test_all_operators_and_the_pipeline_are_registered():
    names = {name.split("_")[0] for name in queries.queries()}
    assert names == {f"op{n}" for n in range(1, 14)} | {"pipeline"}
    assert set(queries.queries()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_matches_its_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "labels", "pages", "benchmark"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    want = con.execute(queries.oracle_sql()[name])
    columns = [c[0] for c in want.description]
    got = queries.queries()[name](spark, SF).select(*columns).collect()
    rounded = [[tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in rows] for rows in (got, want.fetchall())]
    assert len(got) > 0 and sorted(rounded[0], key=str) == sorted(rounded[1], key=str)
