"""Every registered query against its DuckDB oracle on the sf0.001 tables
(row count, column names, order-insensitive values), as the driver's check does."""

import duckdb
import pytest

import __spark_entry__ as E
from tests.conftest import SF
from tools_compare import TABLES, digest

SQL = E.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF['0.001']}/{t}.parquet')")
    return con


@pytest.mark.parametrize("key", sorted(SQL))
def test_query_matches_oracle(spark, duck, key):
    df = E.queries()[key](spark, SF["0.001"])
    rows = [tuple(r) for r in df.collect()]
    rel = duck.execute(SQL[key])
    cols = [d[0] for d in rel.description]
    orows = rel.fetchall()
    assert sorted(df.columns) == sorted(cols)
    assert len(rows) == len(orows)
    assert digest(df.columns, rows) == digest(cols, orows)


def test_every_core_query_has_an_oracle():
    from trisk.plans.catalog import QUERIES
    assert set(QUERIES) <= set(SQL)
