"""Every table and report of the pipeline as a query over the sample inputs."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property, reduce, wraps

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from tidemark import contracts as C
from tidemark.operators.anomalies import app_anomalies_daily, change_points, txn_anomalies_daily, volume_outliers
from tidemark.operators.joins import orphans_by_edge
from tidemark.operators.quality import quality_log, rejected_daily, union_logs, violations_by_rule
from tidemark.operators.rules import FAILED, apply_rules
from tidemark.plans import gold, reports, silver
from tidemark.plans.metrics import Bronze, daily_metrics_in_one_pass, gold_daily_metrics
from tidemark.plans.pipeline import Config, Pipeline
from tidemark.session import WRITE_SETTINGS, scratch_dir, settings, stream_settings, together
from tidemark.sources import sample
from tidemark.sources.landing import bronze_stream, land, with_date
from tidemark.sources.ledger import FileLedger
from tidemark.streaming.delta import delta_join
from tidemark.streaming.late import daily_counts, daily_totals, late_rows
from tidemark.streaming.sinks import latest, per_batch, read_batches

Query = Callable[[SparkSession, str], DataFrame]

# A replayed file is in no time order, so the watermark has to wait for the whole of it.
REPLAY_DELAY = f"{sample.REPLAY_DAYS} days"


def comparable(df: DataFrame, places: int | None = None) -> DataFrame:
    """Column types that every engine's client returns alike: text dates, doubles.

    ``places`` rounds doubles: sums of doubles depend on the order of rows, so their last
    digits differ from run to run.
    """
    def shown(name: str, kind: str) -> str:
        if kind == "date":
            return f"date_format(`{name}`, 'yyyy-MM-dd') AS `{name}`"
        if kind == "double" or kind.startswith("decimal"):
            return f"round(double(`{name}`), {places}) AS `{name}`" if places else f"double(`{name}`) AS `{name}`"
        return f"`{name}`"

    return df.selectExpr(*[shown(*column) for column in df.dtypes])


class Views:
    """Pipeline tables over one sample folder, each built when first asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.raw = sample.Funnel(spark, sf_dir)

    def rules(self, entity: str):
        return silver.technical_rules(entity, sample.AS_OF, sample.REPLAY_DAYS)

    @cached_property
    def visits(self) -> DataFrame:
        return silver.silver_visitor_events(self.raw.visits, sample.AS_OF, sample.REPLAY_DAYS)

    @cached_property
    def apps(self) -> DataFrame:
        return silver.silver_applications(self.raw.applications)

    @cached_property
    def accounts(self) -> DataFrame:
        return silver.silver_accounts(self.raw.accounts)

    @cached_property
    def txns(self) -> DataFrame:
        return silver.silver_transactions(self.raw.transactions)

    @cached_property
    def gold_apps(self) -> DataFrame:
        return gold.gold_applications(self.apps)

    @cached_property
    def gold_txns(self) -> DataFrame:
        return gold.gold_transaction_features(self.txns, self.accounts)

    @cached_property
    def log(self) -> DataFrame:
        logs = [quality_log(df, self.rules(e), f"silver_{e}", C.event_time(e)) for e, df in self.raw.items()]
        return union_logs([*logs, quality_log(self.apps, gold.BUSINESS_RULES, "gold_applications")])

    @cached_property
    def metrics_base(self) -> DataFrame:
        return gold_daily_metrics(self.visits, self.gold_apps, self.gold_txns)

    @cached_property
    def metrics(self) -> DataFrame:
        return daily_metrics_in_one_pass(Bronze(**dict(self.raw.items())), self.gold_txns, {e: self.rules(e) for e in C.ENTITIES})


def _rejected_applications(v: Views) -> DataFrame:
    result = apply_rules(v.raw.applications, silver.APPLICATION_RULES, "silver_applications")
    return result.rejected.select("app_id", "timestamp", F.array_join(FAILED, ",").alias("failed_rules"))


def _rows_by_date(v: Views) -> DataFrame:
    """What the landing layout would hold per table and ``date=`` folder."""
    dated = [with_date(df, C.event_time(e)).select(F.lit(e).alias("table"), "date") for e, df in v.raw.items()]
    return reduce(DataFrame.unionAll, dated).groupBy("table", "date").agg(F.count(F.lit(1)).alias("rows"))


_ROWS: dict[str, Callable[[Views], DataFrame]] = {
    "silver_visitor_events": lambda v: silver.silver_visitor_events(v.raw.visits, sample.AS_OF),
    "silver_visitor_events_replay": lambda v: v.visits,
    "silver_applications": lambda v: v.apps,
    "silver_accounts": lambda v: v.accounts,
    "silver_transactions": lambda v: v.txns,
    "silver_transactions_all_columns": lambda v: silver.silver_transactions(v.raw.transactions, keep_all=True),
    "gold_applications": lambda v: v.gold_apps,
    "gold_accounts": lambda v: gold.gold_accounts(v.accounts, v.gold_apps),
    "gold_accounts_all_columns": lambda v: gold.gold_accounts(v.accounts, v.gold_apps, keep_all=True),
    "gold_transaction_features": lambda v: v.gold_txns,
    "gold_transaction_features_salted": lambda v: gold.gold_transaction_features(v.txns, v.accounts, salts=8),
    "gold_transaction_features_bounded": lambda v: gold.gold_transaction_features(v.txns, v.accounts, bound_days=5),
    "gold_transaction_features_strict_cap": lambda v: gold.gold_transaction_features(v.txns, v.accounts, cap=1.1, keep_all=True),
    "rejected_applications": _rejected_applications,
}

_DAILY: dict[str, Callable[[Views], DataFrame]] = {
    "rule_violations_by_rule": lambda v: violations_by_rule(v.log),
    "quality_log": lambda v: v.log,
    "rejected_daily": lambda v: rejected_daily(v.log),
    "landed_counts": lambda v: v.raw.landed(),
    "landed_rows_by_date": _rows_by_date,
    "daily_metrics_base": lambda v: v.metrics_base,
    "daily_metrics_full": lambda v: v.metrics,
    "app_anomalies_daily": lambda v: app_anomalies_daily(v.gold_apps),
    "txn_anomalies_daily": lambda v: txn_anomalies_daily(v.gold_txns),
    "orphans_by_edge": lambda v: orphans_by_edge(v.visits, v.apps, v.accounts, v.txns),
    "volume_outliers": lambda v: volume_outliers(v.metrics_base),
    "change_points": lambda v: change_points(v.metrics),
    "trust_score_today": lambda v: reports.trust_score_today(v.metrics, sample.AS_OF),
    "time_since_last_anomaly": lambda v: reports.time_since_last_anomaly(v.gold_apps, v.gold_txns, sample.AS_OF),
    "freshness_trend": lambda v: reports.freshness_trend(v.metrics),
    "trust_score_trend": lambda v: reports.trust_score_trend(v.metrics),
    "null_rate_trend": lambda v: reports.null_rate_trend(v.metrics),
    "conversion_trend": lambda v: reports.conversion_trend(v.metrics_base),
    "age_mix_trend": lambda v: reports.age_mix_trend(v.apps, v.metrics_base),
    "age_mix_trend_strict": lambda v: reports.age_mix_trend(v.apps, v.metrics_base, strict=True, denominator="silver"),
    "visits_with_anomaly_marker": lambda v: reports.visits_with_anomaly_marker(v.metrics),
    "txn_anomaly_trend": lambda v: reports.txn_anomaly_trend(txn_anomalies_daily(v.gold_txns)),
    "lineage_completeness": lambda v: reports.lineage_completeness(
        v.raw.applications, v.raw.visits, v.raw.transactions, v.metrics_base
    ),
    "duplicate_app_ids": lambda v: reports.duplicate_app_ids(v.apps),
}


def _timed(df: DataFrame) -> DataFrame:
    """Zone-less times as instants, which watermarks ask for."""
    return df.withColumn("timestamp", F.col("timestamp").cast("timestamp"))


def _stream_app_anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = sample.load_stream(spark, sf_dir, "orders")
    apps = gold.gold_applications(silver.silver_applications(_timed(sample.applications(orders))))
    out = scratch_dir(spark, "app-anomalies")
    daily = app_anomalies_daily(apps, delay=REPLAY_DELAY)
    per_batch(daily, f"{out}/table", f"{out}/checkpoint", mode="update").awaitTermination()
    return latest(spark, f"{out}/table", "date")


def _stream_txn_anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, schema = _txn_features(spark, sf_dir)
    features = spark.readStream.schema(schema).parquet(f"{out}/table/*")
    daily = txn_anomalies_daily(_timed(features), delay=REPLAY_DELAY)
    per_batch(daily, f"{out}/daily", f"{out}/daily-checkpoint", mode="update").awaitTermination()
    return latest(spark, f"{out}/daily", "date")


def _txn_features(spark: SparkSession, sf_dir: str) -> tuple[str, T.StructType]:
    """Both inputs as streams, joined by what is new on either side."""
    txns = silver.silver_transactions(sample.transactions(sample.load_stream(spark, sf_dir, "lineitem")))
    accounts = silver.silver_accounts(sample.accounts(sample.load_stream(spark, sf_dir, "orders"))).select("account_id", "approved_limit", "account_open_timestamp")
    txns = txns.select("txn_id", "account_id", "amount", "timestamp", "location")
    out = scratch_dir(spark, "txn-features")
    delta_join(
        txns, accounts, "account_id", gold.gold_transaction_features, f"{out}/table", f"{out}/joined", f"{out}/checkpoint"
    ).awaitTermination()
    return out, gold.gold_transaction_features(txns, accounts).schema


def _stream_txn_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, _ = _txn_features(spark, sf_dir)
    return read_batches(spark, f"{out}/table")


def _stream_gold_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accounts and validated applications as streams; either may come first."""
    accounts = silver.silver_accounts(sample.accounts(sample.load_stream(spark, sf_dir, "orders")))
    apps = gold.gold_applications(silver.silver_applications(sample.applications(sample.load_stream(spark, sf_dir, "orders"))))
    out = scratch_dir(spark, "gold-accounts")
    delta_join(accounts, apps, "app_id", gold.gold_accounts, f"{out}/table", f"{out}/joined", f"{out}/checkpoint").awaitTermination()
    return read_batches(spark, f"{out}/table")


def _late_app_anomalies(spark: SparkSession, sf_dir: str) -> str:
    """Applications landed and streamed in two runs, those of even days first: most odd days come too late."""
    out = scratch_dir(spark, "late")
    applied = sample.applications(sample.load(spark, sf_dir, "orders"))
    for number, part in enumerate(("hist", "live")):
        land(applied.filter(F.day("timestamp") % 2 == number), f"{out}/landing", part, "timestamp")
        apps = gold.gold_applications(silver.silver_applications(bronze_stream(spark, f"{out}/landing", applied.schema, load_ts=F.col("_load_timestamp"))))
        flagged = F.col("req_income_ratio") > C.APP_ANOMALY_RATIO
        daily_counts(apps, flagged, C.WATERMARK_DELAY, f"{out}/daily", f"{out}/checkpoint").awaitTermination()
    return f"{out}/daily"


def _stream_late_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily_totals(spark, _late_app_anomalies(spark, sf_dir), "app_anomalies_count")


def _stream_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return late_rows(spark, _late_app_anomalies(spark, sf_dir)).selectExpr("app_id", "string(timestamp) AS applied", "req_income_ratio")


# --- From landing folders on ---


def _land_sample(spark: SparkSession, sf_dir: str, landing: str, part: str, kept: Callable[[str], Column]) -> None:
    """Land the sample inputs' rows that ``kept`` picks for their entity."""
    def landed(item: tuple[str, DataFrame]) -> None:
        entity, df = item
        typed = df.select(*[F.col(f.name).cast(f.dataType) for f in C.contract(entity)], F.col("_load_timestamp").cast("timestamp"))
        land(typed.filter(kept(entity)), f"{landing}/{entity}", part, C.event_time(entity))

    together(landed, sample.Funnel(spark, sf_dir).items())


def _sample_config(spark: SparkSession) -> Config:
    out = scratch_dir(spark, "landed")
    return Config(f"{out}/landing", f"{out}/root", sample.AS_OF, sample.REPLAY_DAYS, load_ts="_load_timestamp")


def _landed_in_batch(spark: SparkSession, sf_dir: str) -> Pipeline:
    config = _sample_config(spark)
    _land_sample(spark, sf_dir, config.landing, "hist", lambda entity: F.lit(True))
    pipeline = Pipeline(spark, config)
    pipeline.run_batch()
    return pipeline


def _landed_in_stream(spark: SparkSession, sf_dir: str) -> Pipeline:
    """Two runs of the stream. Each table is halved by a hash of its own, so rows land before and after those they refer to."""
    keys = {"visitor_events": "visitor_id", "applications": "app_id", "accounts": "account_id", "transactions": "txn_id"}
    config = _sample_config(spark)
    for number, part in enumerate(("hist", "live")):
        _land_sample(spark, sf_dir, config.landing, part, lambda entity: F.pmod(F.xxhash64(F.lit(entity), keys[entity]), F.lit(2)) == number)
        pipeline = Pipeline(spark, config)
        pipeline.run_stream()
    return pipeline


def _ledger_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per landed table from the ledger; the second update finds no new file."""
    ledger = FileLedger(spark, scratch_dir(spark, "ledger"))
    for _ in range(2):
        for name in ("events", "orders", "lineitem"):
            ledger.update(name, f"{sf_dir}/{name}.parquet")
    return ledger.counts().select("table", "rows")


_LANDED: dict[str, Query] = {
    "landed_daily_metrics": lambda spark, sf_dir: _landed_in_batch(spark, sf_dir).table("gold_daily_metrics"),
    "landed_stream_daily_metrics": lambda spark, sf_dir: _landed_in_stream(spark, sf_dir).table("gold_daily_metrics"),
    "ledger_counts": _ledger_counts,
}

_STREAM: dict[str, Query] = {
    "stream_app_anomalies_daily": _stream_app_anomalies,
    "stream_txn_features": _stream_txn_features,
    "stream_txn_anomalies_daily": _stream_txn_anomalies,
    "stream_gold_accounts": _stream_gold_accounts,
    "stream_app_anomalies_replayed": _stream_late_totals,
    "stream_app_anomalies_late_rows": _stream_late_rows,
}


def _batch_query(build: Callable[[Views], DataFrame], places: int | None = None) -> Query:
    @wraps(build)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return comparable(build(Views(spark, sf_dir)), places)

    return run


def _stream_query(build: Query) -> Query:
    @wraps(build)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        with settings(spark, stream_settings(spark)):
            return comparable(build(spark, sf_dir))

    return run


def _landed_query(build: Query) -> Query:
    @wraps(build)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        with settings(spark, {"spark.sql.session.timeZone": "UTC", **WRITE_SETTINGS}):
            return comparable(build(spark, sf_dir), 6)

    return run


def queries() -> dict[str, Query]:
    return {
        **{name: _batch_query(build) for name, build in _ROWS.items()},
        **{name: _batch_query(build, 6) for name, build in _DAILY.items()},
        **{name: _stream_query(build) for name, build in _STREAM.items()},
        **{name: _landed_query(build) for name, build in _LANDED.items()},
    }
