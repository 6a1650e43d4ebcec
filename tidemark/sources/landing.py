"""Landing folders: parquet by entity, batch folders inside, ``date=`` folders inside those."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from tidemark import contracts as C
from tidemark.functions import event_day
from tidemark.sources.drift import read_merged, widened
from tidemark.sources.ledger import FileLedger

# Batch folders hold separate `date=` trees below one root, which partition discovery
# refuses as conflicting; recursive lookup reads the files and ignores the folder names.
_RECURSIVE = {"recursiveFileLookup": "true"}


def stamp(df: DataFrame, load_ts: Column | None = None) -> DataFrame:
    """Add the ingest time; a given column makes a run repeatable."""
    return df.withColumn("_load_timestamp", F.current_timestamp() if load_ts is None else load_ts)


def with_date(df: DataFrame, ts_col: str) -> DataFrame:
    return df.withColumn("date", F.date_format(ts_col, "yyyy-MM-dd"))


def folder_date() -> Column:
    """The ``date=`` folder a row was landed in, which recursive lookup leaves out."""
    text = F.regexp_extract(F.col("_metadata.file_path"), r"/date=(\d{4}-\d{2}-\d{2})/", 1)
    return F.nullif(text, F.lit("")).cast("date")


def land(df: DataFrame, path: str, suffix: str, ts_col: str, balance: bool = True) -> bool:
    """Append ``df`` as parquet by event date; False, and nothing written, where it is empty.

    ``balance`` shuffles rows by date first: a day becomes a few full files instead of one
    sliver per task, and AQE splits a day too large for one task.
    """
    if df.isEmpty():
        return False
    dated = df.withColumn("date", event_day(ts_col))  # a folder is named as the date is written
    if balance:
        dated = dated.hint("rebalance", "date")
    dated.write.mode("append").partitionBy("date").parquet(f"{path.rstrip('/')}/{suffix}")
    return True


def bronze_stream(spark: SparkSession, path: str, schema: T.StructType, max_files: int | None = None, load_ts: Column | None = None) -> DataFrame:
    """Each new landing file once; the query's checkpoint remembers which were read."""
    reader = spark.readStream.schema(schema).options(**_RECURSIVE)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return stamp(reader.parquet(path), load_ts)


def bronze_batch(spark: SparkSession, path: str, schema: T.StructType, load_ts: Column | None = None) -> DataFrame:
    return stamp(spark.read.schema(schema).options(**_RECURSIVE).parquet(path), load_ts)


def bronze(
    spark: SparkSession,
    landing: str,
    entity: str,
    streaming: bool = False,
    max_files: int | None = None,
    load_ts: Column | None = None,
    ledger: FileLedger | None = None,
) -> DataFrame:
    """The bronze table of ``entity`` from ``<landing>/<entity>``: its contract, then whatever else has landed.

    With a ``ledger`` only the footers of files it does not know are read, else those of all
    files. Columns that land while a stream is running join it at its next start.
    """
    path = f"{landing.rstrip('/')}/{entity}"
    if ledger is None:
        schema = widened(C.contract(entity), read_merged(spark, path))
    else:
        ledger.update(entity, path)
        schema = ledger.schema(entity, C.contract(entity))
    if streaming:
        return bronze_stream(spark, path, schema, max_files, load_ts)
    return bronze_batch(spark, path, schema, load_ts)


def landed_counts(spark: SparkSession, paths: Mapping[str, str]) -> DataFrame:
    """Rows landed per table. Counting needs no column, so only parquet footers are read."""
    counts = [
        spark.read.options(**_RECURSIVE).parquet(path).agg(F.count(F.lit(1)).alias("rows")).select(F.lit(table).alias("table"), "rows")
        for table, path in paths.items()
    ]
    return reduce(DataFrame.unionAll, counts)
