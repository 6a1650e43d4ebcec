"""The eleven reports. Inputs are pipeline tables; results hold one or a few rows per day.

No join here carries a broadcast hint: the sides are aggregates whose size AQE knows
before it plans the join, so it broadcasts the per-day side by measured size and falls
back to a shuffled join beyond the session's limit.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tidemark import contracts as C
from tidemark.functions import at, elapsed_label, event_day, ratio
from tidemark.functions.scalars import Moment


def _label(column: str | Column = "date") -> Column:
    return F.date_format(column, "yyyy-MM-dd")


def _two_places(value: Column) -> Column:
    """DECIMAL(5,2), NULL where the value does not fit."""
    return value.try_cast("decimal(5,2)")


def _newest_first(df: DataFrame) -> DataFrame:
    return df.orderBy(F.desc("date"))


def trust_score_today(metrics: DataFrame, as_of: Moment, risk_floor: float | None = None) -> DataFrame:
    """Score of the day of ``as_of``: 40% checks passed, 30% freshness, 30% anomaly risk.

    The risk part has no lower bound unless ``risk_floor`` sets one.
    """
    day = metrics.filter((F.col("date") == at(as_of).cast("date")) & (F.col("applications_count") > 0))
    lag = F.col("avg_freshness_lag_hours")
    slope = 100.0 / (C.STALE_HOURS - C.FRESH_HOURS)
    failed = F.least(ratio(F.col("detected_tdq_bdq_anomalies_count"), F.col("applications_count")) * 100, F.lit(100.0))
    fresh = (
        F.when(lag <= C.FRESH_HOURS, 100.0)
        .when(lag > C.STALE_HOURS, 0.0)
        .otherwise(100 - (lag - C.FRESH_HOURS) * slope)
    )
    risk = F.least(100 - F.col("ml_anomalies_count") * C.RISK_PER_ANOMALY, F.lit(100.0))
    if risk_floor is not None:
        risk = F.greatest(risk, F.lit(float(risk_floor)))
    weight = C.TODAY_WEIGHTS
    score = (100 - failed) * weight["checks"] + fresh * weight["freshness"] + risk * weight["risk"]
    return day.select(_label().alias(C.DAY_LABEL), score.alias(C.TODAY_SCORE))


def time_since_last_anomaly(
    gold_apps: DataFrame,
    gold_txn: DataFrame,
    as_of: Moment,
    app_threshold: float = C.APP_ANOMALY_RATIO,
    txn_threshold: float = C.TXN_ANOMALY_RATIO,
) -> DataFrame:
    """Time between ``as_of`` and the latest flagged row of either table.

    The label shows a future row as past; ``signed_seconds`` tells them apart.
    """
    latest = [
        df.filter(F.col(column) > threshold).agg(F.max("timestamp").alias("latest"))
        for df, column, threshold in (
            (gold_apps, "req_income_ratio", app_threshold),
            (gold_txn, "txn_limit_ratio", txn_threshold),
        )
    ]
    last = latest[0].unionAll(latest[1]).agg(F.max("latest").cast("timestamp").alias("last"))
    signed = last.select(F.timestamp_diff("SECOND", F.col("last"), at(as_of)).alias("signed_seconds"))
    elapsed = signed.select(F.abs("signed_seconds").alias("time_elapsed_seconds"), "signed_seconds")
    return elapsed.select(
        "time_elapsed_seconds",
        elapsed_label(F.col("time_elapsed_seconds")).alias("time_since_last_anomaly_label"),
        "signed_seconds",
    )


def freshness_trend(metrics: DataFrame) -> DataFrame:
    return _newest_first(metrics).select(_label().alias(C.DAY_LABEL), "avg_freshness_lag_hours")


def trust_score_trend(metrics: DataFrame) -> DataFrame:
    """Daily score: 40% validity, 30% quality, 20% freshness, 10% completeness."""
    volume = F.col("total_visits") + F.col("applications_count") + F.col("total_transactions")
    anomalies = F.col("detected_tdq_bdq_anomalies_count") + F.col("ml_anomalies_count")
    parts = metrics.select(
        "date",
        volume.alias("total_daily_volume"),
        anomalies.alias("total_anomalies"),
        _two_places(100 * (1 - ratio(anomalies, volume))).alias("quality_score_pct"),
        _two_places(
            100 * F.greatest(F.lit(0.0), 1 - F.col("avg_freshness_lag_hours") / float(C.STALE_HOURS))
        ).alias("freshness_score_pct"),
        _two_places(
            100 * F.least(F.lit(1.0), F.col("total_transactions") / float(C.DAILY_TXN_TARGET))
        ).alias("completeness_score_pct"),
        "schema_compliance_pct",
    )
    weight = C.TREND_WEIGHTS
    score = (
        F.col("schema_compliance_pct") * weight["validity"]
        + F.col("quality_score_pct").cast("double") * weight["quality"]
        + F.col("freshness_score_pct").cast("double") * weight["freshness"]
        + F.col("completeness_score_pct").cast("double") * weight["completeness"]
    )
    return _newest_first(
        parts.withColumn("final_data_trust_score", _two_places(score)).drop("schema_compliance_pct")
    )


def null_rate_trend(metrics: DataFrame) -> DataFrame:
    return _newest_first(metrics).select(_label().alias(C.DAY_LABEL), F.col("campaign_id_null_pct").alias(C.NULL_RATE))


def conversion_trend(metrics: DataFrame) -> DataFrame:
    return metrics.orderBy("date").select(
        _label().alias(C.DAY_LABEL),
        (F.col("conversion_rate") * 100).alias(C.VISITOR_RATE),
        (F.col("approval_rate") * 100).alias(C.APPROVAL_RATE),
    )


def age_group(age: Column, strict: bool = False) -> Column:
    """Age band labels. Ages below 18 fall into the last band unless ``strict``."""
    band = F.when(age.isNull(), C.NO_AGE_BAND)
    if strict:
        band = band.when(age < C.ADULT_AGE, C.MINOR_AGE_BAND)
    for low, high, name in C.AGE_BANDS:
        band = band.when(age.between(low, high), name)
    return band.otherwise(C.LAST_AGE_BAND)


def age_mix_trend(silver_apps: DataFrame, metrics: DataFrame, strict: bool = False, denominator: str = "gold") -> DataFrame:
    """Share of each age band in a day's applications.

    Bands count silver applications while the total counts gold ones, so a day can sum
    to more than 100%; ``denominator="silver"`` takes both from silver.
    """
    bands = silver_apps.groupBy(
        event_day("timestamp").alias("date"), age_group(F.col("applicant_age"), strict).alias("age_group")
    ).agg(F.count("app_id").alias("applications_by_group"))
    if denominator == "gold":
        totals = metrics.select("date", F.col("applications_count").alias("total_daily_applications"))
    else:
        totals = bands.groupBy("date").agg(F.sum("applications_by_group").alias("total_daily_applications"))
    share = F.expr("try_cast(applications_by_group * 100.0 / total_daily_applications AS DECIMAL(5, 2))")
    return (
        bands.join(totals.filter("total_daily_applications > 0"), "date")
        .select("date", "age_group", share.alias("share"))
        .orderBy(F.desc("date"), F.desc("share"))
        .select(
            _label().alias(C.DAY_HEADING),
            F.col("age_group").alias(C.AGE_HEADING),
            F.col("share").alias(C.SHARE_HEADING),
        )
    )


def visits_with_anomaly_marker(metrics: DataFrame) -> DataFrame:
    return metrics.orderBy("date").select(
        _label().alias(C.DAY_LABEL),
        F.col("total_visits").alias(C.VISITS_HEADING),
        F.when(F.col("ml_anomalies_count") > 0, F.col("total_visits")).alias(C.MARKER_HEADING),
    )


def txn_anomaly_trend(txn_anomalies: DataFrame) -> DataFrame:
    return _newest_first(txn_anomalies).select(
        _label().alias(C.DAY_HEADING), F.col("txn_anomalies_count").alias(C.TXN_ANOMALY_HEADING)
    )


def lineage_completeness(bronze_apps: DataFrame, bronze_visits: DataFrame, bronze_txn: DataFrame, metrics: DataFrame) -> DataFrame:
    """Raw rows in, gold rows out and the difference, per day the metrics know.

    Accounts count on neither side. Transactions without an account count as dropped.
    """
    days = [df.select(event_day("timestamp").alias("date")) for df in (bronze_apps, bronze_visits, bronze_txn)]
    raw = reduce(DataFrame.unionAll, days).groupBy("date").agg(F.count(F.lit(1)).alias("total_bronze_input"))
    out = F.col("applications_count") + F.col("total_visits") + F.col("total_transactions")
    return _newest_first(metrics.select("date", out.alias("total_gold_output")).join(raw, "date")).select(
        _label().alias(C.DAY_LABEL),
        "total_bronze_input",
        "total_gold_output",
        (F.col("total_bronze_input") - F.col("total_gold_output")).alias("total_records_dropped"),
    )


def duplicate_app_ids(silver_apps: DataFrame) -> DataFrame:
    """Surplus rows per day of application ids seen more than once on that day.

    Ids are counted within each task before the exchange, so an id that holds a large
    part of a day costs one row per task.
    """
    per_id = silver_apps.groupBy(event_day("timestamp").alias("date"), "app_id").agg(
        F.count(F.lit(1)).alias("app_id_count")
    )
    surplus = per_id.filter("app_id_count > 1").groupBy("date").agg(
        F.sum(F.col("app_id_count") - 1).alias(C.DUPLICATES)
    )
    return _newest_first(surplus).select(_label().alias(C.VIOLATION_DAY), C.DUPLICATES)
