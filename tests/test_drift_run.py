"""Columns that land later than others stay in bronze, and their rules act on them."""

from helpers import rows, ts
from pyspark.sql import functions as F

from tidemark import contracts as C
from tidemark.plans.pipeline import Config, Pipeline
from tidemark.sources.landing import land

DAY = ts("2024-01-10 10:00:00")
ROWS = {
    "visitor_events": [[("v", "landing", "CMP1", "mobile", "USA", DAY, 1.0)] * 9],
    "applications": [[("p", "v", 30, 50000.0, "salaried", 5000, DAY, "approved")]],
    "accounts": [[("a", "p", 1000, 9.5, DAY, "active")]],
    "transactions": [[("t1", "a", 800.0, "5411", "USA", "NY", "York", DAY)],
                     [("t2", "a", 20.0, "5411", "USA", "NY", "York", DAY, "success"), ("t3", "a", 30.0, "5411", "USA", "NY", "York", DAY, "lost")]],
}


def _land(spark, landing, entity, nth):
    schema = C.contract(entity)
    if nth:
        schema = schema.add("status", "string")
    land(spark.createDataFrame(ROWS[entity][nth], schema), f"{landing}/{entity}", f"batch{nth}", C.event_time(entity))


def test_a_later_column_is_kept_and_judged(spark, tmp_path):
    config = Config(f"{tmp_path}/landing", f"{tmp_path}/root", "2024-01-10 12:00:00")
    for entity in C.ENTITIES:
        _land(spark, config.landing, entity, 0)
    pipeline = Pipeline(spark, config)
    pipeline.run_stream()
    log = pipeline.table("quality_log").filter("rule = 'tdq_valid_txn_status'")
    assert [r[0] for r in log.select("status").distinct().collect()] == ["skipped"]
    _land(spark, config.landing, "transactions", 1)
    pipeline.run_stream()
    assert rows(pipeline.table("bronze_transactions"), "txn_id", "status") == [("t1", None), ("t2", "success"), ("t3", "lost")]
    assert rows(pipeline.rejected("silver_transactions").select("txn_id", F.explode("_failed_rules"))) == [("t3", "tdq_valid_txn_status")]
    assert rows(pipeline.table("gold_transaction_features"), "txn_id") == [("t1",), ("t2",)]
    assert rows(pipeline.table("gold_txn_ml_anomaly_agg"), "txn_anomalies_count") == [(1,)]
    log = pipeline.table("quality_log").filter("rule = 'tdq_valid_txn_status'")
    assert [r[0] for r in log.select("status").distinct().collect()] == ["checked"]
