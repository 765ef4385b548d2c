"""Every registered query at sf0.001, against its DuckDB oracle where one exists
(the driver's check runs the same comparison at sf0.01)."""

import duckdb
import pytest

import __spark_entry__ as E
from wakeline.plans.catalog import QUERIES
from tests.conftest import SF001
from tools.oracle_check import rows_of, type_diffs
from wakeline.sources.tables import TABLES


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    yield c
    c.close()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    sdf = E.queries()[name](spark, SF001)
    s_rows, s_cols = rows_of(sdf.columns, [tuple(r) for r in sdf.collect()])
    sql = E.oracle_sql().get(name)
    if sql is None:
        assert s_cols  # rows-only: runs and has a schema
        return
    con.execute(f"CREATE OR REPLACE VIEW o AS {sql}")
    res = con.execute("SELECT * FROM o")
    assert not type_diffs(sdf, res.description)
    d_rows, d_cols = rows_of([d[0] for d in res.description], res.fetchall())
    assert s_cols == d_cols
    assert sorted(map(repr, s_rows)) == sorted(map(repr, d_rows))
