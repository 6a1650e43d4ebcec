"""Streaming sinks that stay right when a micro-batch is run again."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.rules import Rule, split_applicable

BATCH = "batch_id"
COUNTS = "-counts"


def per_batch(
    df: DataFrame,
    path: str,
    checkpoint: str,
    step: Callable[[DataFrame], DataFrame] | None = None,
    mode: str = "append",
    name: str | None = None,
    rules: Sequence[Rule] = (),
) -> StreamingQuery:
    """Write each micro-batch to its own folder, so running it again replaces it.

    With ``rules`` the rows checked and failed of each batch are counted on the way and kept
    beside it in the same manner, for ``rule_totals``: exact however many batches there were.

    ``step`` turns a micro-batch into the rows to write. It is called for every batch:
    tables it reads are listed anew, unlike the fixed side of a stream-static join.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        seen = Observation() if rules else None
        counted = batch.observe(seen, *rule_counts(batch, rules)) if rules else batch
        rows = step(counted) if step else counted
        rows.write.mode("overwrite").parquet(f"{path}/{BATCH}={batch_id}")
        if rules:
            entries = batch.sparkSession.createDataFrame(list(seen.get.items()), "name string, rows long").coalesce(1)
            entries.write.mode("overwrite").parquet(f"{path}{COUNTS}/{BATCH}={batch_id}")

    writer = df.writeStream.foreachBatch(write).outputMode(mode).option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    return writer.trigger(availableNow=True).start()


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop(BATCH)


def latest(spark: SparkSession, path: str, key: str) -> DataFrame:
    """The newest row per key from the per-batch folders of an update-mode aggregate."""
    changes = spark.read.parquet(path)
    values = [c for c in changes.columns if c not in (key, BATCH)]
    newest = changes.groupBy(key).agg(F.max_by(F.struct(*values), BATCH).alias("row"))
    return newest.select(key, *[F.col(f"row.{c}").alias(c) for c in values])


def count_rules(df: DataFrame, rules: Sequence[Rule], name: str) -> DataFrame:
    """Report rows checked and failed per rule in the progress of the running query.

    The counters ride along with the rows: no second pass and no exchange.
    """
    return df.observe(name, *rule_counts(df, rules))


def rule_counts(df: DataFrame, rules: Sequence[Rule]) -> list[Column]:
    run, _ = split_applicable(df, rules)
    return [F.count(F.lit(1)).alias("checked_rows"), *[F.expr(f"count_if(NOT {r.sql}) AS {r.name}") for r in run]]


def rule_totals(spark: SparkSession, path: str) -> DataFrame:
    """(name, rows): rows checked, and failed per rule, over all batches ``per_batch`` has written below ``path``."""
    return spark.read.parquet(f"{path}{COUNTS}").groupBy("name").agg(F.sum("rows").alias("rows"))


def observed_totals(query: StreamingQuery, name: str) -> dict[str, int]:
    """Counters of ``count_rules`` summed over the query's progress reports.

    Spark keeps only so many of them: once some may be gone this is an error; ``per_batch`` with
    ``rules`` keeps the counts of every batch.
    """
    totals: dict[str, int] = {}
    kept = int(SparkSession.active().conf.get("spark.sql.streaming.numRecentProgressUpdates"))
    if len(query.recentProgress) >= kept:
        raise ValueError(f"{name}: earlier progress reports may be gone; count the stored marks instead")
    for progress in query.recentProgress:
        row = progress.observedMetrics.get(name)
        for key, value in (row.asDict() if row is not None else {}).items():
            totals[key] = totals.get(key, 0) + value
    return totals
