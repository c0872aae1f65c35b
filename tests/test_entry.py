"""Driver contract and a sample of Spark-vs-DuckDB checks on the sf0.001 tables."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from lakemart.queries import ORACLE, QUERIES
from tests.conftest import SF001

TABLES = "region nation customer supplier part orders lineitem events".split()


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["category_name", "revenue"] and 0 < len(rows) <= 10
    revenues = [r.revenue for r in rows]
    assert revenues == sorted(revenues, reverse=True)


def test_every_query_has_a_unique_name_and_most_have_sql():
    qs, sqls = E.queries(), E.oracle_sql()
    assert set(sqls) <= set(qs)
    assert len(QUERIES) >= 60 and set(QUERIES) == set(ORACLE) and set(QUERIES) <= set(qs)


def _norm(v):
    if isinstance(v, float):
        return float(f"{v:.9g}") if not math.isnan(v) else "nan"
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    df = E.queries()[name](spark, SF001)
    spark_rows = [tuple(r) for r in df.collect()]
    res = duck.execute(E.oracle_sql()[name])
    cols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(cols)
    assert _rows(df.columns, spark_rows) == _rows(cols, res.fetchall())
