"""Every registered query against the same question in SQL, and its plan."""

from collections import Counter

import duckdb
import pytest

import __spark_entry__ as contract
from martkit.catalog.oracle import ORACLE_SQL
from martkit.catalog.queries import QUERIES
from tests.conftest import plan

SAMPLE = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events"


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for name in TABLES.split():
        con.execute(f"create view {name} as select * from '{SAMPLE}/{name}.parquet'")
    return con


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE_SQL)
    assert set(QUERIES) <= set(contract.queries()) and set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, sql, name):
    df = QUERIES[name](spark, SAMPLE)
    columns = sorted(df.columns)
    got = Counter(tuple(r[c] for c in columns) for r in df.collect())
    cursor = sql.execute(ORACLE_SQL[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    at = [names.index(c) for c in columns]
    expected = Counter(tuple(r[i] for i in at) for r in cursor.fetchall())
    assert got == expected
    text = plan(df)
    for unwanted in ("CartesianProduct", "NestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
        assert unwanted not in text


def test_filters_and_columns_reach_the_files(spark):
    from martkit.catalog import readings as r
    from martkit.functions.temporal import on_day
    from martkit.plans.rfm import _from

    day = plan(on_day(r.table(spark, SAMPLE, "orders"), "o_orderdate", "1997-01-15").select("o_orderkey"))
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThanOrEqual(o_orderdate" in day and "o_totalprice" not in day
    closed = plan(_from(r.orders(spark, SAMPLE), "1997-01-01").filter("status = 'F'").select("cost"))
    assert "EqualTo(o_orderstatus,F)" in closed and "o_orderpriority" not in closed


def test_flagship_query(spark):
    assert contract.entry(spark).count() > 0
