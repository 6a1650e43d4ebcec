"""Tables, scratch storage and graph helpers the operators share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.session import scratch_dir

# A side of a join is broadcast only when it was counted and has at most so many ids (8 MB).
BROADCAST_IDS = 1_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a table in the shared scratch folder: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def slices(batches, rows: int = 256):
    """Arrow batches in smaller parts, so that a task turns few texts into Python objects at once."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def small(ids: DataFrame) -> DataFrame:
    """Marks a stored table of ids for broadcast if its count allows; else leaves the choice to Spark."""
    return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids


# A node is a hub when it has more than so many edges and more than this share of all of them,
# so there are at most 1 / HUB_SHARE hubs (3 MB) on either side of an edge.
HUB_EDGES, HUB_SHARE = 1_000, 1e-5


def _with_least(edges: DataFrame, least: DataFrame, limit: float) -> DataFrame:
    """``edges`` with the value ``m`` that ``least`` (a, m, degree) has for each ``a``.

    Hubs, nodes of more than ``limit`` edges, are few: theirs are broadcast, so that their
    edges stay where they are and no task gets all of a hub's.
    """
    hubs = F.broadcast(least.where(F.col("degree") > limit).select("a", "m"))
    rest = edges.join(hubs.select("a"), "a", "left_anti").join(least.where(F.col("degree") <= limit).select("a", "m"), "a")
    return edges.join(hubs, "a").unionByName(rest)


def connected_components(edges: DataFrame, label: str = "components") -> DataFrame:
    """(node, component) for an edge table (a, b) of longs; component is the smallest node reachable.

    Alternates two star steps until nothing changes. The large step hangs all larger
    neighbours of a node on its smallest neighbour, the small step all smaller ones, so the
    depth shrinks geometrically. Minima are combined before each shuffle, no neighbour list
    is ever collected, and the edges of a hub are not brought together. An empty edge table
    gives an empty result.
    """
    now = stored(edges.selectExpr("greatest(a, b) AS a", "least(a, b) AS b").where("a <> b").distinct(), label)
    mark = _fingerprint(now)
    while mark[0]:
        limit = max(HUB_EDGES, 2 * mark[0] * HUB_SHARE)
        both = now.unionByName(now.selectExpr("b AS a", "a AS b"))
        least = stored(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"), F.count("*").alias("degree")), label)
        large = stored(_with_least(both.where("b > a"), least, limit).selectExpr("b AS a", "m AS b"), label)
        low = stored(large.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("degree")), label)
        joined = _with_least(large, low, limit)
        star = joined.where("b <> m").selectExpr("b AS a", "m AS b").unionByName(low.selectExpr("a", "m AS b"))
        new = stored(star.where("a <> b").distinct(), label)
        after = _fingerprint(new)
        if after == mark:
            break
        now, mark = new, after
    return now.selectExpr("a AS node", "b AS component").unionByName(now.selectExpr("b AS node", "b AS component").distinct())


def _fingerprint(edges: DataFrame) -> tuple:
    mixed = F.xxhash64("a", "b")
    return tuple(edges.agg(F.count("*"), F.expr("bit_xor(xxhash64(a, b))"), F.sum(mixed.cast("decimal(38,0)"))).first())
