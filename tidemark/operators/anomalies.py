"""Threshold anomalies per day, and days whose volume is out of line with their past."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from tidemark import contracts as C
from tidemark.functions import event_day, ratio

FLAG = "is_ml_anomaly"


def flag_above(df: DataFrame, column: str, threshold: float) -> DataFrame:
    """1 where ``column`` is strictly above ``threshold``, else 0; a NULL ratio is 0."""
    return df.withColumn(FLAG, F.when(F.col(column) > threshold, 1).otherwise(0))


def anomalies_daily(df: DataFrame, column: str, threshold: float, count_as: str, delay: str, event_time: str = "timestamp") -> DataFrame:
    """Flagged rows per event day.

    A stream groups by a one-day window under a watermark, so a finished day leaves the
    state; grouping by a derived date would keep every day for ever. A batch groups by
    the date itself. Both agree in a UTC session.
    """
    day = event_day(event_time)
    if df.isStreaming:
        df = df.withWatermark(event_time, delay)
        day = F.window(event_time, "1 day")
    flagged = flag_above(df, column, threshold).filter(F.col(FLAG) == 1)
    counted = flagged.groupBy(day.alias("day")).agg(F.count(F.lit(1)).alias(count_as))
    date = F.to_date("day.start") if df.isStreaming else F.col("day")
    return counted.select(date.alias("date"), count_as)


def app_anomalies_daily(gold_applications: DataFrame, threshold: float = C.APP_ANOMALY_RATIO, delay: str = C.WATERMARK_DELAY) -> DataFrame:
    return anomalies_daily(gold_applications, "req_income_ratio", threshold, "app_anomalies_count", delay)


def txn_anomalies_daily(gold_transactions: DataFrame, threshold: float = C.TXN_ANOMALY_RATIO, delay: str = C.WATERMARK_DELAY) -> DataFrame:
    return anomalies_daily(gold_transactions, "txn_limit_ratio", threshold, "txn_anomalies_count", delay)


def volume_outliers(metrics: DataFrame, history_days: int = 14, z_limit: float = 3.0, min_history: int = 7) -> DataFrame:
    """z-score of each day's volume against the preceding ``history_days`` calendar days.

    Input is the daily table, one row per day, so each window partition holds one row per
    day and metric however large the source tables are.
    """
    volumes = metrics.unpivot(
        "date", ["total_visits", "applications_count", "total_transactions"], "metric", "volume"
    )
    past = (
        Window.partitionBy("metric")
        .orderBy(F.unix_date("date"))
        .rangeBetween(-history_days, -1)
    )
    scored = volumes.select(
        "date",
        "metric",
        "volume",
        F.count("volume").over(past).alias("history"),
        F.avg("volume").over(past).alias("mean"),
        F.stddev_samp("volume").over(past).alias("spread"),
    )
    z = ratio(F.col("volume") - F.col("mean"), F.col("spread"))
    enough = F.col("history") >= min_history
    return scored.withColumn("z_score", F.when(enough, z)).withColumn(
        "is_outlier", F.coalesce(F.abs("z_score") > z_limit, F.lit(False)).cast("int")
    )


def change_points(
    metrics: DataFrame, columns: Sequence[str] = ("conversion_rate", "campaign_id_null_pct"),
    baseline: int = 7, slack: float = 0.5, limit: float = 5.0, least_spread: float = 0.05,
) -> DataFrame:
    """Slow shifts of a daily rate, by two cumulative sums (CUSUM) of its distance from a baseline.

    The first ``baseline`` days with a value set mean and spread; the spread counts as
    at least ``least_spread`` of the mean. From then on the sums ``rise`` and ``fall`` add up
    each day's standard score less ``slack``, never below zero; above ``limit`` the day is
    flagged. A small lasting shift adds up where a single day's score stays inconspicuous.

    A sum that may not fall below zero is the plain running sum less its lowest value so far,
    so windows express it. Days without a value are left out. A window holds a row per day.
    """
    values = metrics.unpivot("date", [F.col(c).cast("double").alias(c) for c in columns], "metric", "value").filter("value IS NOT NULL")
    days = Window.partitionBy("metric").orderBy("date")
    past, whole = days.rowsBetween(Window.unboundedPreceding, 0), Window.partitionBy("metric")
    first = F.when(F.col("day") <= baseline, F.col("value"))
    scored = values.withColumn("day", F.row_number().over(days)).select(
        "date", "metric", "value", "day", F.avg(first).over(whole).alias("mean"), F.stddev_samp(first).over(whole).alias("deviation")
    )
    spread = F.greatest(F.coalesce("deviation", F.lit(0.0)), F.abs("mean") * least_spread)
    score = F.when(F.col("day") > baseline, F.coalesce(ratio(F.col("value") - F.col("mean"), spread), F.lit(0.0)))
    scored = scored.withColumn("score", score)
    for name, step in (("rise", F.col("score") - slack), ("fall", -F.col("score") - slack)):
        scored = scored.withColumn(f"{name}_sum", F.coalesce(F.sum(step).over(past), F.lit(0.0)))
    for name in ("rise", "fall"):
        scored = scored.withColumn(name, F.col(f"{name}_sum") - F.least(F.lit(0.0), F.min(f"{name}_sum").over(past)))
    change = F.when(F.col("rise") > limit, "rise").when(F.col("fall") > limit, "fall")
    return scored.select("date", "metric", "value", "mean", "rise", "fall", change.alias("change"))
