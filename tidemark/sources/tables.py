"""Pipeline tables on shared storage, as parquet folders or catalog tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.rules import FAILED

OUTCOME = "outcome"
CLEAN, REJECTED = "clean", "rejected"


def with_outcome(marked: DataFrame) -> DataFrame:
    """Turn marked rows into rows of a checked table: one folder for clean, one for rejected.

    Clean rows, rejected rows and the input of the quality counts then come from a single
    pass over the source, in batch and stream, with no cached copy in between.
    """
    return marked.withColumn(OUTCOME, F.when(F.size(FAILED) == 0, CLEAN).otherwise(REJECTED))


class TableStore:
    """Tables below one root folder; ``merge`` reads files of differing schemas as one table."""

    def __init__(self, spark: SparkSession, root: str, merge: bool = False):
        self.spark, self.root, self.merge = spark, root.rstrip("/"), merge

    def path(self, name: str) -> str:
        return f"{self.root}/tables/{name}"

    def checkpoint(self, name: str) -> str:
        return f"{self.root}/checkpoints/{name}"

    def joined(self, name: str) -> str:
        """Where a join of two streams keeps the rows it has taken in."""
        return f"{self.root}/joined/{name}"

    # --- writing ---

    def write(
        self, df: DataFrame, name: str, partition_by: tuple[str, ...] = (), refresh: bool = False, balance: bool = False
    ) -> None:
        """Replace a table; with ``refresh`` only the partitions ``df`` has rows for.

        ``balance`` shuffles rows by partition first, for input that has every folder's
        rows in every task, as a join leaves it: few full files per folder, and AQE splits
        a folder too large for one task. Input still in the order of dated files needs no
        such shuffle.
        """
        if balance:
            df = df.hint("rebalance", *partition_by)
        writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic" if refresh else "static")
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(self.path(name))

    def start(self, df: DataFrame, name: str, partition_by: tuple[str, ...] = (), mode: str = "append") -> StreamingQuery:
        """Append a stream to a table until its present input is used up; exactly once by the sink's log."""
        writer = (
            df.writeStream.format("parquet")
            .outputMode(mode)
            .queryName(name)
            .option("checkpointLocation", self.checkpoint(name))
            .trigger(availableNow=True)
        )
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        return writer.start(self.path(name))

    # --- reading ---

    def exists(self, name: str) -> bool:
        try:
            self.read(name)
        except AnalysisException:
            return False
        return True

    def read(self, name: str, schema: T.StructType | str | None = None) -> DataFrame:
        reader = self.spark.read.schema(schema) if schema else self.spark.read.option("mergeSchema", self.merge)
        return reader.parquet(self.path(name))

    def read_stream(self, name: str, schema: T.StructType, max_files: int | None = None) -> DataFrame:
        reader = self.spark.readStream.schema(schema)
        if max_files:
            reader = reader.option("maxFilesPerTrigger", max_files)
        return reader.parquet(self.path(name))

    def clean(self, df: DataFrame) -> DataFrame:
        return df.filter(F.col(OUTCOME) == CLEAN).drop(OUTCOME, FAILED)

    def rejected(self, df: DataFrame) -> DataFrame:
        return df.filter(F.col(OUTCOME) == REJECTED).drop(OUTCOME)

    def compact(self, name: str, into: str, partition_by: tuple[str, ...] = ("date",)) -> str:
        """Rewrite a table of many small files as ``into``; the source stays as it is."""
        self.write(self.read(name), into, partition_by, balance=True)
        return self.path(into)

    # --- SQL ---

    def register_views(self, names: list[str], prefix: str = "") -> None:
        for name in names:
            self.read(name).createOrReplaceTempView(f"{prefix}{name}")


def quoted(text: object) -> str:
    return "'" + str(text).replace("\\", "\\\\").replace("'", "\\'") + "'"


def register_table(
    spark: SparkSession,
    name: str,
    path: str,
    schema: T.StructType,
    partition_by: Sequence[str] = (),
    comment: str = "",
    props: Mapping[str, str] | None = None,
) -> None:
    """A catalog table over a stored folder. Only the catalog changes: no data file is written or removed.

    An entry of the same name is replaced, as columns or place may have changed; one that owns
    its files is left alone, since dropping it would remove them.
    """
    if spark.catalog.tableExists(name):
        kind = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}.get("Type")
        if kind != "EXTERNAL":
            raise ValueError(f"{name} is no table over a folder: drop it first")
        spark.sql(f"DROP TABLE {name}")
    last = [f for f in schema if f.name in partition_by]
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in [*(f for f in schema if f not in last), *last])
    dealt = f"PARTITIONED BY ({', '.join(f'`{c}`' for c in partition_by)})" if partition_by else ""
    pairs = ", ".join(f"{quoted(k)} = {quoted(v)}" for k, v in (props or {}).items())
    spark.sql(
        f"CREATE TABLE {name} ({columns}) USING parquet {dealt} LOCATION {quoted(path)} COMMENT {quoted(comment)}"
        + (f" TBLPROPERTIES ({pairs})" if pairs else "")
    )
    # a folder that a stream's file sink wrote has a log of its files, which Spark reads instead
    if any(c.isPartition for c in spark.catalog.listColumns(name)):
        spark.sql(f"MSCK REPAIR TABLE {name} SYNC PARTITIONS")


def materialize(df: DataFrame, name: str, comment: str = "", props: Mapping[str, str] | None = None, mode: str = "overwrite") -> None:
    """Save ``df`` as a catalog table with a comment and properties."""
    df.write.mode(mode).format("parquet").saveAsTable(name)
    spark = df.sparkSession
    if comment:
        spark.sql(f"COMMENT ON TABLE {name} IS {quoted(comment)}")
    if props:
        pairs = ", ".join(f"{quoted(k)} = {quoted(v)}" for k, v in props.items())
        spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ({pairs})")
