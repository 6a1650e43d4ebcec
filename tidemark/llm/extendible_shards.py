"""Sharding by extendible hashing.

The directory is indexed by the leading bits of a hash of ``doc_id``. A bucket within the byte
limit is a shard; an oversized one splits on one more bit, and only it. The directory is
built from byte sums per hash prefix, a few bits beyond what the total calls for at a time;
only rows of buckets that are still too large take part in the next step.

After the 60 bits of the id's hash come 60 bits of a hash of the row, so rows that share an id
(copies, or one very common id) are split as well. A bucket of one row is final even if that row
alone is beyond the limit.

Null ids are hashed as an empty one, null sizes count as 0 bytes. An empty table has no shards.
A shard's name is its hash prefix in bits; the name of a directory with one bucket is empty.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import stored

SHARD_BYTES = 1 << 20
BITS = 60
# Bits looked at beyond those an even directory would need, and in each further step.
MARGIN, STEP = 4, 8


def hash_bits(value: Column) -> Column:
    """60 bits of a hash, as a string of bits."""
    number = F.conv(F.substring(F.md5(F.coalesce(value.cast("string"), F.lit(""))), 1, 15), 16, 10).cast("bigint")
    return F.lpad(F.bin(number), BITS, "0")


def directory(rows: DataFrame, limit: int) -> DataFrame:
    """Shards as (cell, shard, depth, shard_bytes) for a table of (path, size).

    A cell is the part of a row's path that was looked at when its shard was found.
    """
    total = rows.agg(F.sum("size")).first()[0] or 0
    reached, open_rows, found = 0, rows, []
    depth = max(0, math.ceil(math.log2(max(1.0, total / limit)))) + MARGIN
    while True:
        cells = open_rows.groupBy(F.substring("path", 1, depth).alias("cell")).agg(
            F.sum("size").alias("size"), F.count("*").alias("n"), F.min("path").alias("low"), F.max("path").alias("high")
        )
        cells = stored(cells, "shard-cells")
        levels = cells.withColumn("depth", F.explode(F.sequence(F.lit(reached), F.lit(depth)))).withColumn("shard", F.expr("substring(cell, 1, depth)"))
        sums = levels.groupBy("depth", "shard").agg(F.sum("size").alias("shard_bytes"), F.sum("n").alias("n"))
        fits = sums.where(f"shard_bytes <= {limit} OR n = 1 OR depth = {2 * BITS}")
        first = levels.select("cell", "depth", "shard").join(fits, ["depth", "shard"]).groupBy("cell").agg(
            F.min(F.struct("depth", "shard", "shard_bytes")).alias("s")
        )
        first = stored(first.select("cell", "s.shard", "s.depth", "s.shard_bytes"), "shard-directory")
        found.append(first)
        rest = stored(cells.join(first, "cell", "left_anti"), "shard-open")
        todo = rest.agg(F.count("*"), F.max(F.expr("left(low, 60) = left(high, 60)")), F.min(F.expr("left(low, 60) = left(high, 60)"))).first()
        if not todo[0]:
            return reduce(DataFrame.unionByName, found)
        open_rows = open_rows.join(rest.select("cell"), F.substring("path", 1, depth) == F.col("cell"), "left_semi")
        # Buckets of one id only cannot part before the row's own bits.
        reached, depth = depth + 1, min(2 * BITS, max(depth, BITS if todo[2] else 0) + STEP)


def assigned(docs: DataFrame, limit: int = SHARD_BYTES, size: Column | None = None) -> DataFrame:
    """``docs`` with ``shard``, ``depth``, ``n_bytes`` and ``shard_bytes``.

    ``size`` is a row's share of the limit, by default the bytes of its text.
    """
    names = [f"d{i}" for i in range(len(docs.columns))]
    own = F.coalesce((F.octet_length("text") if size is None else size).cast("long"), F.lit(0))
    path = F.concat(hash_bits(F.col("doc_id")), hash_bits(F.monotonically_increasing_id()))
    sized = docs.select(*[F.col(c).alias(n) for n, c in zip(names, docs.columns)], own.alias("size"), path.alias("path"))
    # Stored, so that the row's bits are the same for the directory and for the rows.
    rows = stored(sized, "shard-rows")
    shards = stored(directory(rows.select("path", "size"), limit), "shards")
    depths = [r[0] for r in shards.select(F.length("cell")).distinct().collect()]
    added = {"shard", "depth", "n_bytes", "shard_bytes"}
    parts = []
    for depth in sorted(depths):
        cells = shards.where(F.length("cell") == depth)
        joined = rows.withColumn("cell", F.substring("path", 1, depth)).join(cells, "cell")
        parts.append(joined.select(
            *[F.col(n).alias(c) for n, c in zip(names, docs.columns) if c not in added],
            "shard", "depth", F.col("size").alias("n_bytes"), "shard_bytes",
        ))
    if not parts:
        empty = rows.select(*[F.col(n).alias(c) for n, c in zip(names, docs.columns) if c not in added])
        return empty.selectExpr("*", "'' AS shard", "0 AS depth", "0L AS n_bytes", "0L AS shard_bytes")
    return reduce(DataFrame.unionByName, parts)


def write_shards(shards: DataFrame, path: str) -> None:
    """A folder per shard, each written by one task, which the byte limit bounds."""
    shards.repartition("shard").write.partitionBy("shard").parquet(path)
