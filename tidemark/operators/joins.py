"""Equi joins that hold up under hot keys, and reference checks without a join."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

SALT = "_salt"


def heavy_keys(df: DataFrame, key: str, share: float = 0.01) -> list:
    """Keys that hold at least ``share`` of all rows: at most ``1 / share`` values.

    Counts are combined before the exchange, so a hot key costs no more than a cold one.
    This runs a job; use it on a materialized table.
    """
    per_key = df.filter(F.col(key).isNotNull()).groupBy(key).count()
    floor = max(1, math.ceil(df.count() * share))
    return [row[0] for row in per_key.filter(F.col("count") >= floor).select(key).collect()]


def inner_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    salts: int = 1,
    spread_by: str | None = None,
    hot: Sequence | None = None,
) -> DataFrame:
    """Inner equi join on ``key``; with ``salts > 1`` a key's left rows spread over that many tasks.

    AQE already splits an oversized join partition, so ``salts`` mostly stays 1; it is for joins
    whose result must stay dealt by key and for sessions without AQE.
    ``hot`` limits the salting to known keys, so only their right rows are copied. The
    salt is a hash of ``spread_by``, thus the same again when a lost task is re-run.
    """
    if salts <= 1 or (hot is not None and not hot):
        return left.join(right, key, "inner")
    salt: Column = F.pmod(F.xxhash64(spread_by or key), F.lit(salts)).cast("int")
    copies: Column = F.sequence(F.lit(0), F.lit(salts - 1))
    if hot is not None:
        is_hot = F.coalesce(F.col(key).isin(list(hot)), F.lit(False))
        salt = F.when(is_hot, salt).otherwise(F.lit(0))
        copies = F.when(is_hot, copies).otherwise(F.array(F.lit(0)))
    salted = left.withColumn(SALT, salt)
    copied = right.withColumn(SALT, F.explode(copies))
    return salted.join(copied, [key, SALT], "inner").drop(SALT)


def orphans_by_edge(visits: DataFrame, applications: DataFrame, accounts: DataFrame, transactions: DataFrame) -> DataFrame:
    """Rows whose parent is missing, for each edge of the funnel; a NULL key has no parent.

    Child and parent keys meet in one aggregate instead of three anti joins: every key is
    combined within a task first, so neither a hot parent nor a hot child moves as rows.
    """
    edges = (
        ("application -> visit", applications, visits, "visitor_id"),
        ("account -> application", accounts, applications, "app_id"),
        ("transaction -> account", transactions, accounts, "account_id"),
    )
    sides = None
    for edge, child, parent, key in edges:
        for df, is_child in ((child, 1), (parent, 0)):
            side = df.select(
                F.lit(edge).alias("edge"),
                F.col(key).alias("key"),
                F.lit(is_child).cast("bigint").alias("child"),
                F.lit(1 - is_child).alias("parent"),
            )
            if not is_child:
                side = side.filter("key IS NOT NULL")
            sides = side if sides is None else sides.unionAll(side)
    per_key = sides.groupBy("edge", "key").agg(F.sum("child").alias("child"), F.max("parent").alias("parent"))
    return per_key.groupBy("edge").agg(
        F.sum("child").alias("child_rows"),
        F.sum(F.when(F.col("parent") == 0, F.col("child")).otherwise(0)).alias("orphan_rows"),
    )
