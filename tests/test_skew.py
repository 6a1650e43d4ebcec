"""One key with a third of all rows: join plans, salting, and pre-aggregation."""

import pytest
from helpers import ACCOUNTS, TXNS, rows
from pyspark.sql import functions as F

from tidemark.operators.joins import heavy_keys
from tidemark.plans import gold, reports, silver
from tidemark.session import settings, shuffle_settings

HOT = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10000",
    "spark.sql.shuffle.partitions": "8",
}


@pytest.fixture(scope="module")
def skewed(spark, tmp_path_factory):
    """30,000 transactions, a third of them on one account."""
    root = tmp_path_factory.mktemp("skew")
    txns = spark.range(0, 30000, 1, 6).selectExpr(
        "string(id) AS txn_id", "IF(id % 3 = 0, 'hot', string(id % 500)) AS account_id", "double(id % 90 + 1) AS amount",
        "'5411' AS merchant_cat_code", "'UK' AS location", "'NA' AS state", "uuid() AS merchant_city",
        "TIMESTAMP '2024-01-30 10:00:00' AS timestamp", "TIMESTAMP '2024-01-30 11:00:00' AS _load_timestamp")
    accounts = spark.range(500).selectExpr(
        "IF(id = 0, 'hot', string(id)) AS account_id", "'a' AS app_id", "100L AS approved_limit", "20D AS interest_rate",
        "TIMESTAMP '2024-01-30 09:00:00' AS account_open_timestamp", "'active' AS account_status",
        "TIMESTAMP '2024-01-30 11:00:00' AS _load_timestamp")
    txns.write.parquet(f"{root}/txns")
    accounts.write.parquet(f"{root}/accounts")
    return (silver.silver_transactions(spark.read.schema(TXNS).parquet(f"{root}/txns")),
            silver.silver_accounts(spark.read.schema(ACCOUNTS).parquet(f"{root}/accounts")))


def _final_plan(df):
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_aqe_splits_the_hot_account(spark, skewed):
    with settings(spark, HOT):
        joined = gold.gold_transaction_features(*skewed)
        assert "skew=true" in _final_plan(joined)


def test_salting_spreads_the_hot_account_and_keeps_all_rows(spark, skewed):
    txns, accounts = skewed
    assert heavy_keys(txns, "account_id") == ["hot"]
    plain = rows(gold.gold_transaction_features(txns, accounts).groupBy("account_id").agg(F.count("*"), F.sum("amount")))
    with settings(spark, {**HOT, "spark.sql.adaptive.skewJoin.enabled": "false", "spark.sql.adaptive.coalescePartitions.enabled": "false"}):
        for hot in (["hot"], None):
            salted = gold.gold_transaction_features(txns, accounts, salts=8, hot=hot)
            sizes = salted.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
            assert sizes < 10000
            assert rows(salted.groupBy("account_id").agg(F.count("*"), F.sum("amount"))) == plain


def test_one_id_in_a_third_of_the_rows_is_counted_before_the_shuffle(spark):
    apps = spark.range(0, 30000, 1, 6).selectExpr(
        "IF(id % 3 = 0, 'hot', string(id)) AS app_id", "TIMESTAMP '2024-01-30 10:00:00' AS timestamp")
    out = reports.duplicate_app_ids(apps)
    assert rows(out) == [("2024-01-30", 9999)]
    assert _final_plan(out).count("partial_") >= 2


def test_initial_partitions_follow_the_data():
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    assert shuffle_settings(10 << 30)[key] == "200"
    assert shuffle_settings(10 << 40)[key] == str((10 << 40) // (128 << 20))
    assert shuffle_settings(1000 << 40)[key] == "200000"
