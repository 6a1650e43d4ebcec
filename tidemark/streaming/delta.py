"""Inner joins of two growing tables without join state in the stream.

Of two inputs that only grow, a new batch can add three kinds of pairs: new left rows with
new or stored right rows, and stored left rows with new right rows. So the rows taken in so far
are kept as parquet, batch by batch, and each micro-batch is two batch joins. Nothing is held in
a state store, no row waits in memory, no time bound cuts matches off, and either side may come
first. Batch joins also have what stateful ones lack: runtime statistics, skew splitting and
broadcasts by measured size.

Stored rows are cut down, before any shuffle, to those whose key may be among the new keys, by a
bit map of hashed keys whose size is fixed. A map that many keys fill lets more rows through,
never fewer.

A batch run again replaces its folder and reads only the batches before it, so every pair comes
out once whatever became of earlier tries.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.streaming.sinks import BATCH

Join = Callable[[DataFrame, DataFrame], DataFrame]

SIDE, LEFT, RIGHT = "side", "left", "right"
# Cells of 64 bits in a map of keys; a cell is a row of two longs, so a broadcast has 4 MB at most.
MAP_CELLS = 1 << 18


def key_map(df: DataFrame, key: str) -> DataFrame:
    """(cell, bits) with a bit set for each value of ``key``; at most ``MAP_CELLS`` rows."""
    place = F.pmod(F.xxhash64(key), F.lit(MAP_CELLS * 64))
    cells = df.filter(F.col(key).isNotNull()).select(
        F.floor(place / 64).alias("cell"), F.expr(f"shiftleft(1L, int(pmod(xxhash64(`{key}`), 64)))").alias("bit")
    )
    return cells.groupBy("cell").agg(F.bit_or("bit").alias("bits"))


def may_match(df: DataFrame, key: str, keys: DataFrame) -> DataFrame:
    """Rows of ``df`` whose ``key`` may be in a ``key_map``: all that are, and few others."""
    place = F.pmod(F.xxhash64(key), F.lit(MAP_CELLS * 64))
    cells = F.broadcast(keys.select(F.col("cell").alias("_cell"), F.col("bits").alias("_bits")))
    joined = df.withColumn("_cell", F.floor(place / 64)).join(cells, "_cell")
    return joined.filter(f"getbit(_bits, int(pmod(xxhash64(`{key}`), 64))) = 1").select(*df.columns)


class DeltaJoin:
    """Rows of both sides taken in so far, below ``path``, and the join of what is new.

    ``join`` must treat rows apart from each other: an inner equi join on ``key``, filters, projections.
    """

    def __init__(self, spark: SparkSession, path: str, key: str, join: Join, left: T.StructType, right: T.StructType):
        self.spark, self.path, self.key, self.join = spark, path.rstrip("/"), key, join
        self.schema = T.StructType([T.StructField(LEFT, left), T.StructField(RIGHT, right), T.StructField(SIDE, T.StringType())])

    def taken_in(self, side: str, batches: str = "true", batch_id: int | None = None) -> DataFrame:
        """Stored rows of one side; ``batches`` is SQL over the batch number, ``batch_id`` names one folder."""
        folder, schema = f"{self.path}/{BATCH}={batch_id}", self.schema
        if batch_id is None:
            folder, schema = self.path, T.StructType([*schema.fields, T.StructField(BATCH, T.LongType())])
        rows = self.spark.read.schema(schema).parquet(folder).filter(F.col(SIDE) == side)
        return (rows.filter(batches) if batch_id is None else rows).select(f"{side}.*")

    def step(self, batch: DataFrame, batch_id: int) -> DataFrame:
        """Store a micro-batch of tagged rows; the pairs it adds."""
        batch.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(SIDE).parquet(f"{self.path}/{BATCH}={batch_id}")
        new_left, new_right = (self.taken_in(side, batch_id=batch_id) for side in (LEFT, RIGHT))
        until, before = f"{BATCH} <= {batch_id}", f"{BATCH} < {batch_id}"
        stored_right = may_match(self.taken_in(RIGHT, until), self.key, key_map(new_left, self.key))
        pairs = self.join(new_left, stored_right)
        if batch_id == 0:
            return pairs
        stored_left = may_match(self.taken_in(LEFT, before), self.key, key_map(new_right, self.key))
        return pairs.unionByName(self.join(stored_left, new_right))

    def waiting(self) -> DataFrame:
        """Left rows that no right row has matched so far; they are tried again when their key comes in."""
        return self.taken_in(LEFT).join(self.taken_in(RIGHT).select(self.key), self.key, "left_anti")


def delta_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    join: Join,
    path: str,
    state: str,
    checkpoint: str,
    name: str | None = None,
    partition_by: tuple[str, ...] = (),
) -> StreamingQuery:
    """Write the inner ``join`` of two streams below ``path``, a folder per micro-batch; ``state`` holds both sides' rows."""
    spark = left.sparkSession
    work = DeltaJoin(spark, state, key, join, left.schema, right.schema)
    tagged = [df.select(F.struct(*df.columns).alias(side), F.lit(side).alias(SIDE)) for side, df in ((LEFT, left), (RIGHT, right))]
    both = tagged[0].unionByName(tagged[1], allowMissingColumns=True).select(LEFT, RIGHT, SIDE)

    def write(batch: DataFrame, batch_id: int) -> None:
        pairs = work.step(batch, batch_id)
        if partition_by:  # a join leaves every folder's rows in every task
            pairs = pairs.hint("rebalance", *partition_by)
        # the whole folder of the batch is replaced, also where the session replaces single partitions
        pairs.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(*partition_by).parquet(f"{path}/{BATCH}={batch_id}")

    writer = both.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    return writer.trigger(availableNow=True).start()
