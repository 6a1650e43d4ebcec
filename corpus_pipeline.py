"""A training corpus from ``documents``, in five stages that write and reread Parquet.

Toxic documents go, one document of each group of near duplicates stays, documents that hold
benchmark items go, sources are mixed to equal weights, and the rest is dealt to shards.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import extendible_shards, minmax_dedup, poisson_mix, qgram_decontamination, toxicity
from tidemark.llm.common import stored, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text is not told toxic; null and empty texts stay, repeated rows share one fate."""
    return toxicity.without_toxic(docs.select(COLUMNS), table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates; documents without words stay."""
    return minmax_dedup.keep_representatives(docs.select(COLUMNS))


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows without a benchmark item; all, if the benchmark is empty."""
    return qgram_decontamination.decontaminated(docs.select(COLUMNS), table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """As many copies of each document as its source's rate draws, in a global shuffle; null is a source."""
    return poisson_mix.mixed(docs.select(COLUMNS)).select(COLUMNS)


def deal_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows of a shard lie together: each is one task's, which the byte limit bounds."""
    shards = extendible_shards.assigned(docs.select(COLUMNS))
    return shards.select(*COLUMNS, "shard", "depth", "n_bytes", "shard_bytes").repartition("shard")


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_benchmark_leaks),
    ("mixing", mix_sources),
    ("sharding", deal_shards),
]

# A trained classifier and an alignment have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
