"""Every query with oracle SQL must match DuckDB on the sf0.001 tables
(row count, column names, order-insensitive values)."""

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL

SQL = E.oracle_sql()
QS = E.queries()


def test_every_sql_key_is_a_query():
    assert set(SQL) <= set(QS)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "customer_id" in df.columns


@pytest.mark.parametrize("key", sorted(SQL))
def test_matches_duckdb(spark, duck, key):
    from check_oracle import compare
    r = compare(spark, duck, key, QS[key], SQL[key], SF_SMALL)
    assert r.get("ok") is True, r


@pytest.mark.parametrize("key", sorted(SQL))
def test_plan_has_no_cross_join_or_row_udf(spark, key):
    """No registered query plans a cartesian product, a nested-loop join or
    a row-at-a-time Python UDF (global totals are scalar subqueries)."""
    plan = QS[key](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"):
        assert bad not in plan, (key, bad)
