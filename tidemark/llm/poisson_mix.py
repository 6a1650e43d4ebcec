"""Mixing sources to target weights by Poisson replication.

Every source has a target weight; the mean repetition rate of its documents is
weight * all documents / its documents. A document's number of copies is the inverse of the
Poisson distribution with that mean at a point given by a hash of seed and ``doc_id``, so a run
can be repeated. Copies are exploded and put in one global random order by a hash.

Rates above ``PIECE`` are summed from Poisson pieces with points of their own, which is the same
distribution and keeps every table of probabilities short. Only DataFrame functions are used.

A null source is a source of its own. Without weights, all sources count alike; a source that
is not among the weights given has weight 0 and leaves no copies; weights need not sum to 1.
Rows with equal ids get equal numbers of copies. A null id is hashed as an empty one. Null and
empty texts are documents like others. An empty table, or weights without any of its sources,
give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

SEED = "mix-1"
# Largest mean of one Poisson draw.
PIECE = 32
# The plan of so many sources, two kilobytes each at most, is broadcast; a larger one is joined by a shuffle.
BROADCAST_SOURCES = 10_000


def point(*parts: Column) -> Column:
    """A number in (0, 1) from 52 bits of a hash."""
    key = F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return (F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("bigint") + 0.5) / float(1 << 52)


def distribution(mean: Column) -> Column:
    """Cumulative Poisson probabilities from 0 on, as far as doubles tell them from 1."""
    last = F.ceil(mean + F.sqrt(mean) * 12 + 20).cast("int")
    start = F.struct(F.exp(-mean).alias("p"), F.array(F.exp(-mean)).alias("sums"))

    def longer(state: Column, k: Column) -> Column:
        p = state["p"] * mean / k
        return F.struct(p.alias("p"), F.concat(state["sums"], F.array(F.element_at(state["sums"], -1) + p)).alias("sums"))

    return F.aggregate(F.sequence(F.lit(1), last), start, longer, lambda state: state["sums"])


def rates(docs: DataFrame, weights: DataFrame | None = None) -> DataFrame:
    """Per source: its documents, weight and mean repetition rate."""
    sizes = docs.groupBy("source").agg(F.count("*").alias("n_docs"))
    total = docs.count()
    if weights is None:
        weighted = sizes.withColumn("weight", F.lit(1.0))
        sum_of_weights = float(sizes.count())
    else:
        given = weights.groupBy("source").agg(F.sum("weight").alias("weight"))
        weighted = sizes.alias("s").join(given.alias("w"), F.expr("s.source <=> w.source")).select("s.*", "w.weight")
        sum_of_weights = float(weighted.agg(F.sum("weight")).first()[0] or 0)
    share = F.col("weight") / F.lit(sum_of_weights or 1.0)
    return weighted.withColumn("rate", share * F.lit(float(total)) / F.col("n_docs")).where("rate > 0")


def mixed(docs: DataFrame, weights: DataFrame | None = None, seed: str = SEED) -> DataFrame:
    """``docs`` with ``copy`` (from 1) and ``shuffle_key``, in the order of the latter."""
    names = [f"d{i}" for i in range(len(docs.columns))]
    rows = docs.toDF(*names)
    source, doc_id = names[docs.columns.index("source")], names[docs.columns.index("doc_id")]
    plan = rates(docs.select("source"), weights).select(
        F.col("source").alias("plan_source"), F.floor(F.col("rate") / PIECE).alias("full"), "rate",
    )
    plan = plan.withColumn("rest_sums", distribution(F.col("rate") - F.col("full") * PIECE))
    plan = plan.withColumn("full_sums", F.when(F.col("full") > 0, distribution(F.lit(float(PIECE)))))
    if plan.count() <= BROADCAST_SOURCES:
        plan = F.broadcast(plan)
    drawn = rows.join(plan, F.expr(f"{source} <=> plan_source")).withColumn("piece", F.explode(F.expr("sequence(0, full)")))
    u = point(F.lit(seed), F.col(doc_id), F.col("piece"))
    sums = F.when(F.col("piece") == F.col("full"), F.col("rest_sums")).otherwise(F.col("full_sums"))
    drawn = drawn.withColumn("u", u).withColumn("times", F.size(F.filter(sums, lambda s: s <= F.col("u"))))
    copies = drawn.where("times > 0").withColumn("nth", F.explode(F.expr("sequence(1, times)")))
    key = F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(F.col(doc_id).cast("string"), F.lit("")), F.col("piece").cast("string"), F.col("nth").cast("string")))
    columns = [F.col(n).alias(c) for n, c in zip(names, docs.columns) if c not in ("copy", "shuffle_key")]
    keyed = copies.select(*columns, (F.col("piece") * 1000 + F.col("nth")).cast("long").alias("copy"), key.alias("shuffle_key"))
    return keyed.orderBy("shuffle_key", "copy")
