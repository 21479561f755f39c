"""Every query with SQL gives DuckDB's rows."""

import os

import duckdb
import pytest

from tarnweave.plans import queries as curation

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def tables():
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{f}'")
    return con


def canonical(df):
    cell = lambda x: "null" if x is None or x != x else repr(float(x)) if isinstance(x, int | float) and not isinstance(x, bool) else str(x)
    rows = df[sorted(df.columns)].astype(object).where(df[sorted(df.columns)].notna(), None)
    return sorted(tuple(map(cell, r)) for r in rows.itertuples(index=False))


@pytest.mark.parametrize("name", sorted(curation.oracle_sql()))
def test_same_rows_as_sql(spark, tables, name):
    got = curation.queries()[name](spark, SF).toPandas()
    expected = tables.execute(curation.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(expected.columns)
    assert canonical(got) == canonical(expected)
