"""Daily counts of a stream that keep the rows which come too late.

A windowed aggregate in a state store drops rows behind the watermark without a trace. Here each
micro-batch is counted by day as a batch, and its few partial counts are stored in a folder of its
own: no state is held, and a batch run again replaces its folder. A day is closed for a batch once
it ended ``delay`` or more before the latest event time of all batches before. Rows of closed days
are counted apart and kept whole in a side table, so they can be listed, weighed and replayed.

The bound follows the batches before at once; a watermark in a state store lags one batch more.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions import event_day
from tidemark.streaming.sinks import BATCH

LATE = "-late"
IS_LATE = "is_late"
_PARTIALS = f"date date, {IS_LATE} boolean, rows bigint, latest bigint, {BATCH} bigint"


def _partials(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(_PARTIALS).parquet(path)


def _closed(spark: SparkSession, path: str, batch_id: int, delay: str, event_time: str) -> Column:
    """Whether a row's day is closed for a batch. Partial counts of earlier batches tell, a row per batch and day."""
    latest = None
    if batch_id:
        latest = _partials(spark, path).filter(F.col(BATCH) < batch_id).agg(F.max("latest")).first()[0]
    if latest is None:
        return F.lit(False)
    day_end = F.date_add(event_day(event_time), 1).cast("timestamp")
    bound = F.expr(f"timestamp_micros({latest}L) - INTERVAL '{delay}'")
    return F.coalesce(day_end <= bound, F.lit(False))


def daily_counts(
    df: DataFrame, counted: Column, delay: str, path: str, checkpoint: str, event_time: str = "timestamp", name: str | None = None
) -> StreamingQuery:
    """Count the rows of a stream for which ``counted`` holds, per event day; all rows move the bound.

    Partial counts go below ``path``, late rows that count below a folder beside it. A row
    without an event time counts under a NULL date and is never late.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        closed = _closed(spark, path, batch_id, delay, event_time)
        marked = batch.withColumn(IS_LATE, closed)
        moment = F.unix_micros(F.max(F.col(event_time).cast("timestamp")))
        by_day = marked.groupBy(event_day(event_time).alias("date"), IS_LATE)
        partial = by_day.agg(F.count_if(counted).alias("rows"), moment.alias("latest"))
        static = {"partitionOverwriteMode": "static"}
        late = marked.filter(F.col(IS_LATE) & counted).drop(IS_LATE)
        late.write.mode("overwrite").options(**static).parquet(f"{path}{LATE}/{BATCH}={batch_id}")
        # the counts come last: they are what later batches go by
        partial.write.mode("overwrite").options(**static).parquet(f"{path}/{BATCH}={batch_id}")

    writer = df.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    return writer.trigger(availableNow=True).start()


def daily_totals(spark: SparkSession, path: str, count_as: str = "rows", replay: bool = True) -> DataFrame:
    """(date, ``count_as``, ``late_<count_as>``) per day with counted rows.

    ``late_<count_as>`` counts the late ones. With ``replay`` they are part of ``count_as``, which
    then equals a batch over all rows in whatever order they came; else days stay as they were closed.
    """
    late = F.when(F.col(IS_LATE), F.col("rows")).otherwise(0)
    taken = F.col("rows") if replay else F.col("rows") - late
    totals = _partials(spark, path).groupBy("date").agg(F.sum(taken).alias(count_as), F.sum(late).alias(f"late_{count_as}"))
    return totals.filter(F.col(count_as) + F.col(f"late_{count_as}") > 0)


def late_rows(spark: SparkSession, path: str) -> DataFrame:
    """The late rows, whole, with the number of the batch that brought them."""
    return spark.read.option("mergeSchema", "true").parquet(f"{path}{LATE}")
