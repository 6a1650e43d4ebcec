"""Session settings the pipeline relies on, and its shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark.sql import SparkSession

# UTC keeps `window` (aligned to UTC) and `to_date` (session zone) in agreement.
# AQE re-plans from measured sizes: it merges small shuffle partitions, splits the
# ones a hot key has blown up, and broadcasts a side only after its size is known.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}

# State that outgrows the heap needs RocksDB; changelog checkpoints keep commits small.
STREAM_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


# A task whose rows go to no more folders than this keeps a file open in each and needs no sort of
# whole rows, which spills once they outgrow its memory; beyond that Spark sorts the rest.
WRITE_SETTINGS = {"spark.sql.maxConcurrentOutputFileWriters": "100"}


def stream_settings(spark: SparkSession) -> dict[str, str]:
    """``STREAM_SETTINGS``, and on a single machine no more state partitions than cores.

    Each partition opens stores of its own, and their number is fixed by the first run. On
    a cluster ``spark.sql.shuffle.partitions`` is left as the user sized it.
    """
    context = spark.sparkContext
    if not context.master.startswith("local"):
        return STREAM_SETTINGS
    partitions = min(int(spark.conf.get("spark.sql.shuffle.partitions")), context.defaultParallelism)
    return {**STREAM_SETTINGS, "spark.sql.shuffle.partitions": str(partitions)}


def shuffle_settings(input_bytes: int, target_bytes: int = 128 << 20) -> dict[str, str]:
    """Enough initial shuffle partitions that ``input_bytes`` fit executor memory.

    AQE merges partitions that turn out small but never splits the initial number, and
    200 partitions of a 100 TB join would spill for hours. Streams do not take part: the
    partitions of their state are ``spark.sql.shuffle.partitions`` of their first run.
    """
    partitions = min(max(input_bytes // target_bytes, 200), 200_000)
    return {
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_bytes),
    }


def build_session(app: str = "tidemark", master: str | None = None, input_bytes: int | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    sized = shuffle_settings(input_bytes) if input_bytes else {}
    for key, value in {**SETTINGS, **sized, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]):
    """Apply session settings for a block and put the former ones back."""
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def together(step: Callable, items: Iterable) -> list:
    """``step`` for each item at once: the jobs of one take the cores that the last tasks of another leave idle.

    Session settings hold for all of them, so ``step`` must not change any.
    """
    items = list(items)
    with ThreadPoolExecutor(len(items)) as pool:
        return list(pool.map(step, items))


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder below the cluster's shared checkpoint folder.

    Only a local master may name none: there it is a local folder. On a cluster every
    executor would write to a disk of its own, so that is an error.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared and not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    base = shared or tempfile.mkdtemp(prefix="run-", dir="/tmp")
    return f"{base.rstrip('/')}/tidemark/{label}-{uuid.uuid4().hex}"
