"""Registered training-data queries against their SQL, and the whole pipeline."""

import duckdb
import pytest

import corpus_pipeline
from tidemark.llm.queries import oracle_sql, queries

SQL = oracle_sql()


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for name in ("documents", "pages", "embeddings", "benchmark"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", SQL)
def test_query_equals_sql(spark, duck, sf_dir, name):
    df = queries()[name](spark, sf_dir)
    columns = sorted(df.columns)
    cursor = duck.execute(SQL[name])
    described = [d[0] for d in cursor.description]
    assert sorted(described) == columns
    expected = sorted(tuple(str(r[described.index(c)]) for c in columns) for r in cursor.fetchall())
    assert sorted(tuple(str(r[c]) for c in columns) for r in df.collect()) == expected and expected


def test_mixing_stays_in_the_jvm(spark, sf_dir):
    plan = queries()["op6_poisson_mix"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_pipeline_keeps_columns_and_rows_it_should(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:3]:
        out = stage(spark, docs, sf_dir)
        assert out.columns == corpus_pipeline.COLUMNS and 0 < out.count() < docs.count(), name
    result = corpus_pipeline.run(spark, sf_dir)
    assert {"shard", "doc_id", "text"} <= set(result.columns) and result.count() > 500
