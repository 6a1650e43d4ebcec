"""Writes of dated tables: no sort of whole rows, and tables that do not read each other at once."""

import pytest
from helpers import table
from pyspark.sql import functions as F

from tidemark import contracts as C
from tidemark.plans.pipeline import Config, Pipeline
from tidemark.sources.landing import land

KINDS = {"visitor_events": "visits", "applications": "apps", "accounts": "accounts", "transactions": "txns"}


@pytest.fixture()
def config(spark, tmp_path):
    for entity, kind in KINDS.items():
        land(table(spark, kind, {}, {}).drop("_load_timestamp"), f"{tmp_path}/landing/{entity}", "hist", C.event_time(entity))
    return Config(f"{tmp_path}/landing", f"{tmp_path}/root", "2024-01-30 12:00:00", 60)


def _written(spark, root, since):
    """Plans that wrote bronze, silver or gold_applications below ``root`` (none of them joins)."""
    found = spark._jsparkSession.sharedState().statusStore().executionsList()
    plans = [found.apply(i).physicalPlanDescription() for i in range(since, found.size())]
    return [p for p in plans if "InsertIntoHadoopFsRelationCommand" in p and any(f"{root}/batch/tables/{t}" in p for t in ("bronze_", "silver_", "gold_applications"))]


def test_dated_tables_are_written_without_a_sort(spark, config):
    since = spark._jsparkSession.sharedState().statusStore().executionsList().size()
    pipeline = Pipeline(spark, config)
    pipeline.run_batch()
    plans = _written(spark, config.root, since)
    writes = [p for p in plans if "WriteFiles" in p]
    assert len(writes) >= 9 and not any(") Sort" in p for p in writes)
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "0"
    assert pipeline.table("gold_daily_metrics").count() == 1


def test_streams_that_do_not_read_each_other_run_at_once(spark, config, monkeypatch):
    waited, finish = [], Pipeline._finish
    monkeypatch.setattr(Pipeline, "_finish", lambda self, queries: (waited.append(sorted(queries)), finish(self, queries)))
    pipeline = Pipeline(spark, config)
    pipeline.run_stream()
    entities = sorted(C.ENTITIES)
    assert waited == [
        [f"bronze_{e}" for e in entities], [f"silver_{e}" for e in entities], ["gold_applications", "gold_transaction_features"], ["gold_accounts"],
    ]
    assert pipeline.table("gold_daily_metrics").select("applications_count", "total_transactions").first() == (2, 4)
    assert pipeline.table("gold_accounts").agg(F.count("*")).first()[0] == 4
