"""Every registered query of the engine against its DuckDB SQL, over the smallest tables."""

import os

import duckdb
import pandas as pd
import pytest

from pairforge.queries import QUERIES, SQL

SF = "/root/testdata/sf0.001"


def _rows(df):
    def text(v):
        if v is None or v is pd.NA or (isinstance(v, float) and v != v):
            return "null"
        if type(v).__name__.startswith("float") or isinstance(v, (int, float)) and not isinstance(v, bool):
            return f"{float(v):.8g}"
        return str(v)

    return sorted(tuple(text(v) for v in row) for row in df[sorted(df.columns)].itertuples(index=False, name=None))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for f in os.listdir(SF):
        c.sql(f"CREATE VIEW {f[:-8]} AS SELECT * FROM '{SF}/{f}'")
    return c


def test_sql_belongs_to_queries():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    got = QUERIES[name](spark, SF).toPandas()
    if name in SQL:
        want = con.sql(SQL[name]).df()
        assert sorted(got.columns) == sorted(want.columns)
        assert _rows(got) == _rows(want)
    else:
        assert len(got) > 0
