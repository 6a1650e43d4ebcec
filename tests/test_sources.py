"""Landing folders, drift, tables, pushdown and pruning."""

import pytest
from helpers import APPS, rows, table, ts
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import contracts as C
from tidemark.operators.rules import apply_rules
from tidemark.plans import reports, silver
from tidemark.sources.drift import SchemaDrift, check_drift, read_merged, widened
from tidemark.sources.landing import bronze, folder_date, land, landed_counts, stamp, with_date
from tidemark.sources.tables import TableStore, materialize

LANDED = ("app_id", "visitor_id", "applicant_age", "annual_income", "employment_status", "req_credit_limit", "timestamp", "application_status")


def _apps(spark, *changes):
    return table(spark, "apps", *changes).select(*LANDED)


def test_landing_layout(spark, tmp_path):
    path = f"{tmp_path}/applications"
    assert land(_apps(spark, {}, {"timestamp": ts("2024-01-29 23:59:59")}), path, "hist", "timestamp")
    assert land(_apps(spark, {"app_id": "live"}), path, "20240130000000_live", "timestamp")
    assert not land(_apps(spark, {}).filter("false"), path, "none", "timestamp")
    assert sorted(p.name for p in (tmp_path / "applications").iterdir()) == ["20240130000000_live", "hist"]
    assert {p.name for p in (tmp_path / "applications/hist").iterdir() if p.is_dir()} == {"date=2024-01-29", "date=2024-01-30"}
    # plain partition discovery refuses two trees below one root
    with pytest.raises(Exception, match="CONFLICTING"):
        spark.read.parquet(path).count()
    assert rows(landed_counts(spark, {"applications": path})) == [("applications", 3)]
    df = bronze(spark, str(tmp_path), "applications", load_ts=F.col("timestamp"))
    assert df.columns == [*LANDED, "_load_timestamp"]
    dated = spark.read.schema(C.contract("applications")).option("recursiveFileLookup", "true").parquet(path)
    assert {(str(r[0]), str(r[1])) for r in dated.select(folder_date(), F.to_date("timestamp")).collect()} == {
        ("2024-01-29", "2024-01-29"), ("2024-01-30", "2024-01-30")}


def test_stamp_and_date(spark):
    df = stamp(_apps(spark, {}))
    assert df.filter("_load_timestamp IS NOT NULL").count() == 1
    assert rows(with_date(df, "timestamp"), "date") == [("2024-01-30",)]


def test_drift(spark, tmp_path):
    contract = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.StringType())])
    df = spark.createDataFrame([(1, "x")], "a int, extra string")
    out = check_drift(df, contract)
    assert out.columns == ["a", "b", "extra"] and out.schema["a"].dataType == T.LongType()
    assert rows(out) == [(1, None, "x")]
    with pytest.raises(SchemaDrift, match="extra"):
        check_drift(df, contract, on_new="fail")
    with pytest.raises(ValueError):
        check_drift(df, contract, on_new="ignore")
    assert widened(contract, df).names == ["a", "b", "extra"]
    df.drop("extra").write.parquet(f"{tmp_path}/m/one")
    df.write.parquet(f"{tmp_path}/m/two")
    assert rows(read_merged(spark, f"{tmp_path}/m"), "a", "extra") == [(1, None), (1, "x")]


def test_store_refreshes_only_given_partitions(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    df = spark.createDataFrame([("2024-01-01", 1), ("2024-01-02", 2)], "date string, n int")
    store.write(df, "t", ("date",))
    store.write(df.filter("n = 2").withColumn("n", F.lit(5)), "t", ("date",), refresh=True)
    assert rows(store.read("t"), "n") == [(1,), (5,)]
    store.write(df.filter("n = 2"), "t", ("date",))
    assert rows(store.read("t"), "n") == [(2,)]


def test_compact_merges_small_files(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    df = spark.range(100).withColumn("date", F.lit("2024-01-01"))
    for _ in range(5):
        df.repartition(3).write.mode("append").partitionBy("date").parquet(store.path("small"))
    out = store.compact("small", "full")
    assert len(spark.read.parquet(store.path("small")).inputFiles()) == 15
    assert len(spark.read.parquet(out).inputFiles()) == 1
    assert store.read("full").count() == 500


def test_materialize_keeps_comment_and_properties(spark):
    spark.sql("DROP TABLE IF EXISTS tm_quality")
    materialize(spark.range(3).toDF("n"), "tm_quality", "three 'rows'", {"quality": "gold"})
    shown = {r[0]: r[1] for r in spark.sql("DESCRIBE TABLE EXTENDED tm_quality").collect()}
    assert shown["Comment"] == "three 'rows'" and "quality=gold" in shown["Table Properties"]
    assert spark.table("tm_quality").count() == 3
    spark.sql("DROP TABLE tm_quality")


def test_rules_reach_the_scan_unless_rejects_are_kept(spark, tmp_path):
    table(spark, "apps", {}).write.parquet(f"{tmp_path}/apps")
    df = spark.read.schema(APPS).parquet(f"{tmp_path}/apps")

    def pushed(result):
        plan = result.clean._jdf.queryExecution().executedPlan().toString()
        return plan.split("PushedFilters: [")[1].split("]")[0]

    lean = pushed(apply_rules(df, silver.APPLICATION_RULES, "apps", collect_rejects=False))
    assert "In(employment_status" in lean and "GreaterThan(annual_income,0.0)" in lean
    visits = spark.read.schema(table(spark, "visits", {}).schema).parquet(f"{tmp_path}/apps")
    plan = silver.silver_visitor_events(visits, "2024-01-30 12:00:00")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(timestamp,2024-01-29" in plan


def test_duplicate_report_reads_two_columns_and_combines_first(spark, tmp_path):
    table(spark, "apps", {}).write.parquet(f"{tmp_path}/apps")
    df = spark.read.schema(APPS).parquet(f"{tmp_path}/apps")
    plan = reports.duplicate_app_ids(df)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<app_id:string,timestamp:timestamp>" in plan
    assert "partial_count" in plan
