"""The whole pipeline: batch equals stream, incremental runs, refresh of recent days."""

import pytest
from helpers import rows
from pyspark.sql import functions as F

from tidemark import contracts as C
from tidemark.plans import reports
from tidemark.plans.pipeline import Config, Pipeline
from tidemark.sources import sample
from tidemark.sources.landing import land
from tidemark.sources.tables import register_table
from tidemark.streaming.sinks import observed_totals

TABLES = ["silver_visitor_events", "silver_applications", "silver_accounts", "silver_transactions", "gold_applications",
          "gold_accounts", "gold_transaction_features", "quality_log", "gold_daily_metrics",
          "gold_app_ml_anomaly_agg", "gold_txn_ml_anomaly_agg"]


def _entities(spark, path):
    """Sample inputs cut to the contracts, one in ten orders to keep the run short."""
    orders = sample.load(spark, path, "orders").filter("o_orderkey % 10 = 0")
    visits = sample.visits_from_events(sample.load(spark, path, "events")).unionByName(sample.visits_from_orders(orders))
    found = {"visitor_events": visits, "applications": sample.applications(orders), "accounts": sample.accounts(orders),
             "transactions": sample.transactions(sample.load(spark, path, "lineitem"))}
    return {e: df.select(*[F.col(f.name).cast(f.dataType) for f in C.contract(e)]) for e, df in found.items()}


@pytest.fixture(scope="module")
def landing(spark, sf_dir, tmp_path_factory):
    small = sf_dir.replace("sf0.01", "sf0.001")
    root = tmp_path_factory.mktemp("landing")
    for entity, df in _entities(spark, small).items():
        moment = C.event_time(entity)
        land(df.filter(f"{moment} < '2024-01-15'"), f"{root}/{entity}", "hist", moment)
    return root, small


def _config(landing, root, **kw):
    return Config(str(landing), str(root), sample.AS_OF, freshness_days=sample.REPLAY_DAYS,
                  load_ts="{event_time} + INTERVAL 1 HOUR", **kw)


def test_stream_in_two_runs_equals_batch(spark, landing, tmp_path):
    folder, small = landing
    stream = Pipeline(spark, _config(folder, tmp_path / "stream"))
    stream.run_stream()
    first = stream.table("gold_daily_metrics").agg(F.max("date")).first()[0]
    assert first.isoformat() == "2024-01-14"
    assert stream.stale_days() == []
    _a_rebuild_on_the_same_root_leaves_the_stream_alone(spark, _config(folder, tmp_path / "stream"))
    for entity, df in _entities(spark, small).items():
        moment = C.event_time(entity)
        land(df.filter(f"{moment} >= '2024-01-15'"), f"{folder}/{entity}", "20240115_live", moment)
    stream = Pipeline(spark, _config(folder, tmp_path / "stream"))
    stream.run_stream()
    assert stream.stale_days() == []
    counted = observed_totals(stream.queries["silver_accounts"], "silver_accounts")

    batch = Pipeline(spark, _config(folder, tmp_path / "batch"))
    assert batch.stale_days() is None
    batch.run_batch()
    assert batch.stale_days() == []
    for name in TABLES:
        columns = sorted(batch.table(name).columns)
        left, right = batch.table(name).select(*columns), stream.table(name).select(*columns)
        if name == "gold_daily_metrics":
            rounded = [F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in left.dtypes]
            left, right = left.select(*rounded), right.select(*rounded)
        assert rows(left) == rows(right), name
        assert left.count() > 0, name
    for name in ("silver_applications", "silver_visitor_events", "gold_applications"):
        assert batch.rejected(name).count() == stream.rejected(name).count() > 0
    for pipeline in (batch, stream):
        flagged = [pipeline.table(f"gold_{k}_ml_anomaly_agg").agg(F.sum(f"{k}_anomalies_count")).first()[0] for k in ("app", "txn")]
        assert pipeline.table("gold_daily_metrics").agg(F.sum("ml_anomalies_count")).first()[0] == sum(flagged)
        assert min(flagged) > 0
    # clean + rejected = bronze
    for entity in C.ENTITIES:
        assert batch.store.read(f"silver_{entity}").count() == batch.store.read(f"bronze_{entity}").count()
    assert counted["checked_rows"] == batch.store.read("bronze_accounts").filter("date >= '2024-01-15'").count()

    # a refresh of recent days changes only those and to the same values
    before = rows(batch.table("gold_daily_metrics"), "date", "total_visits", "detected_tdq_bdq_anomalies_count")
    batch.refresh_metrics(since="2024-01-20")
    assert rows(batch.table("gold_daily_metrics"), "date", "total_visits", "detected_tdq_bdq_anomalies_count") == before
    assert reports.trust_score_today(batch.table("gold_daily_metrics"), sample.AS_OF).count() == 1
    _sql_users_find_their_tables(spark, batch)
    for pipeline in (batch, stream):
        _published_tables_lie_over_the_stored_folders(spark, pipeline, tmp_path)
        # what waits is what an anti join finds, in either mode
        lone = pipeline.table("silver_transactions").join(pipeline.table("silver_accounts"), "account_id", "left_anti")
        assert rows(pipeline.waiting("gold_transaction_features"), "txn_id") == rows(lone, "txn_id") and lone.count() > 0
        lone = pipeline.table("silver_accounts").join(pipeline.table("gold_applications"), "app_id", "left_anti")
        assert rows(pipeline.waiting("gold_accounts"), "account_id") == rows(lone, "account_id") and lone.count() > 0
    landed = {e: batch.store.read(f"bronze_{e}").count() for e in C.ENTITIES}
    assert dict(rows(batch.ledger.counts(), "table", "rows")) == landed
    _one_more_row_makes_one_day_stale(batch, tmp_path / "batch/batch/tables")


def _a_rebuild_on_the_same_root_leaves_the_stream_alone(spark, config):
    """Readers see the run that ended last; one that breaks off changes nothing for them."""
    assert Pipeline(spark, config).store.root.endswith("/stream")
    rebuilt = Pipeline(spark, config)
    rebuilt.run_batch()
    assert rebuilt.store.root.endswith("/batch") and Pipeline(spark, config).store.root == rebuilt.store.root
    broken = Pipeline(spark, config)
    broken._take_in = lambda: 1 / 0
    with pytest.raises(ZeroDivisionError):
        broken.run_stream()
    assert broken.store.root == Pipeline(spark, config).store.root == rebuilt.store.root


def _one_more_row_makes_one_day_stale(batch, tables):
    def files():
        return {p for p in (tables / "gold_daily_metrics").glob("date=*/*.parquet")}

    path = str(tables / "silver_visitor_events")
    batch.spark.read.parquet(path).filter("date = '2024-01-08' AND outcome = 'clean'").limit(1).write.mode("append").partitionBy(
        "outcome", "date").parquet(path)
    before, visits = files(), dict(rows(batch.table("gold_daily_metrics"), "date", "total_visits"))
    stale = batch.stale_days()
    assert [d.isoformat() for d in stale] == ["2024-01-08"]
    batch.refresh_metrics(only=stale)
    assert {p.parent.name for p in before ^ files()} == {"date=2024-01-08"}
    after = dict(rows(batch.table("gold_daily_metrics"), "date", "total_visits"))
    assert after == {**visits, stale[0]: visits[stale[0]] + 1} and batch.stale_days() == []


def _published_tables_lie_over_the_stored_folders(spark, pipeline, root):
    def files():
        return sorted(p for p in root.rglob("*.parquet"))

    before = files()
    for _ in range(2):  # again after a run: replaced
        for view in C.VIEWS:
            pipeline.publish(view)
    for view, (name, tier, _) in C.VIEWS.items():
        shown = {r[0]: r[1] for r in spark.sql(f"DESCRIBE TABLE EXTENDED default.{view}").collect()}
        assert f"quality={tier}" in shown["Table Properties"] and shown["Comment"] and shown["Type"] == "EXTERNAL"
        table = pipeline.table(name)
        assert rows(spark.table(f"default.{view}"), *table.columns) == rows(table), view
        spark.sql(f"DROP TABLE default.{view}")
    assert files() == before
    spark.range(1).write.mode("overwrite").saveAsTable("default.owned")
    with pytest.raises(ValueError, match="drop it first"):
        register_table(spark, "default.owned", str(root), spark.range(1).schema)
    spark.sql("DROP TABLE default.owned")


def _sql_users_find_their_tables(spark, batch):
    """SQL over the registered views gives what the report functions give."""
    batch.register_views()
    metrics, apps = batch.table("gold_daily_metrics"), batch.table("silver_applications")
    conversion = spark.sql(
        "SELECT date_format(date, 'yyyy-MM-dd') AS d, conversion_rate * 100, approval_rate * 100 FROM gold_daily_metrics ORDER BY date")
    assert [tuple(r) for r in conversion.collect()] == [tuple(r) for r in reports.conversion_trend(metrics).collect()]
    lineage = spark.sql(
        """WITH landed AS (
               SELECT to_date(timestamp) AS date FROM bronze_applications UNION ALL
               SELECT to_date(timestamp) FROM bronze_visitor_events UNION ALL
               SELECT to_date(timestamp) FROM bronze_transactions)
           SELECT string(date), n, out, n - out FROM (SELECT date, count(*) AS n FROM landed GROUP BY date)
           JOIN (SELECT date, applications_count + total_visits + total_transactions AS out FROM gold_daily_metrics) USING (date)""")
    raw = [batch.table(f"bronze_{e}") for e in ("applications", "visitor_events", "transactions")]
    assert rows(lineage) == rows(reports.lineage_completeness(*raw, metrics))
    twice = spark.sql("SELECT string(date), sum(n - 1) FROM (SELECT date, app_id, count(*) AS n FROM silver_applications_clean "
                      "GROUP BY date, app_id) WHERE n > 1 GROUP BY date")
    assert rows(twice) == rows(reports.duplicate_app_ids(apps))
    for view in C.VIEWS:
        assert spark.table(view).columns
