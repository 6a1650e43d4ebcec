"""Every registered query against its SQL counterpart, and the shape of its plan."""

import pytest

import __spark_entry__ as entry
import duck_sql
from tidemark import registry

duckdb = pytest.importorskip("duckdb")

QUERIES, SQL = registry.queries(), duck_sql.statements()


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for table in ("events", "orders", "lineitem"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def _plain(value):
    return repr(round(value, 6)) if isinstance(value, float) else str(value)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, duck, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    cursor = duck.execute(SQL[name])
    described = [d[0] for d in cursor.description]
    assert sorted(described) == columns
    order = [described.index(c) for c in columns]
    expected = sorted(tuple(_plain(r[i]) for i in order) for r in cursor.fetchall())
    got = sorted(tuple(_plain(r[c]) for c in columns) for r in df.collect())
    assert got and got == expected


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [n for n in QUERIES if not n.startswith("stream_")])
def test_plans_stay_in_the_jvm(spark, sf_dir, name):
    plan = _plan(QUERIES[name](spark, sf_dir))
    for node in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin", "Scan ExistingRDD"):
        assert node not in plan


@pytest.mark.parametrize("name", ["daily_metrics_base", "daily_metrics_full"])
def test_daily_metrics_take_one_exchange(spark, sf_dir, name):
    plan = _plan(QUERIES[name](spark, sf_dir))
    assert plan.count("Exchange hashpartitioning(date") == 1 and "rangepartitioning" not in plan


def test_entry_has_every_query():
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0
