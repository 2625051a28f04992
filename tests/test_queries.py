"""Every registered query against its DuckDB SQL, by value."""

import math

import duckdb
import pytest

import __spark_entry__ as contract
from conftest import SF
from pairloom.plans import catalog, oracle

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

TYPES = {"VARCHAR": "string", "BIGINT": "bigint", "DOUBLE": "double"}

QUERIES, SQL = catalog.queries(), oracle.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(contract.queries()) and set(SQL) <= set(contract.oracle_sql())


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def cell(v):
        return round(v, 9) if isinstance(v, float) and math.isfinite(v) else v

    cells = [tuple(cell(r[i]) for i in order) for r in rows]
    return sorted(columns), sorted(cells, key=lambda row: [(v is not None, v) for v in row])


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    got = canonical(df.columns, [tuple(r) for r in df.collect()])
    result = duck.execute(SQL[name])
    want = canonical([c[0] for c in result.description], result.fetchall())
    assert got[0] == want[0]
    assert dict(df.dtypes) == {c[0]: TYPES[str(c[1])] for c in result.description}
    assert len(want[1]) > 0
    assert got[1] == want[1]


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["row_id", "prompt", "chosen", "rejected"]
    assert df.count() == 13
