"""Every query with SQL gives the same rows as DuckDB on the smallest driver tables."""

import glob
import math
import os

import duckdb
import pytest

from factloom.plans import catalogue, depth, extracting, governance, instruments, linking, more, reports, tables  # noqa: F401

DATA = os.environ.get("FACTLOOM_DATA", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no driver tables")


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def plain(x):
        if isinstance(x, bool) or x is None:
            return str(x)
        if isinstance(x, (int, float)) or type(x).__name__ == "Decimal":
            return "nan" if math.isnan(x) else f"{float(x):.6g}"
        return str(x)

    return sorted(tuple(plain(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{DATA}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


@pytest.mark.parametrize("name", sorted(catalogue.SQL))
def test_same_rows_as_sql(spark, duck, name):
    df = catalogue.QUERIES[name](spark, DATA)
    got = duck.execute(catalogue.SQL[name])
    names = [d[0] for d in got.description]
    assert sorted(df.columns) == sorted(names)
    assert rows_of(df.columns, df.collect()) == rows_of(names, got.fetchall())


@pytest.mark.parametrize("name", sorted(set(catalogue.QUERIES) - set(catalogue.SQL)))
def test_queries_without_sql_have_rows(spark, name):
    assert catalogue.QUERIES[name](spark, DATA).limit(1).count() == 1
