"""Near-duplicate documents by min-max hashing.

Each permutation of the shingle hashes gives two signature values, its minimum and its
maximum, so half the hash evaluations of plain MinHash fill a signature. Both agree between
two documents with probability equal to their Jaccard similarity. Minima and maxima are
banded apart from each other. Rows that agree in a band become candidates, and candidates
are confirmed on their full shingle sets.

1. Every document gets its shingle count, a 128-bit key of its shingle set and band keys.
2. Documents with equal sets are one class from here on; its smallest id stands for it.
3. Per band key the members hang on the smallest one; connected, these stars are *clusters*:
   no two documents that share a band are in different clusters.
4. Clusters are dealt into blocks of bounded shingle volume. Each pair of blocks is one task
   that confirms links and returns a spanning forest of them, never all pairs.
5. The forests' components give the result.

No group is capped: a cluster of any size becomes more block pairs. A task skips pairs that
are already connected, so a large group of near copies costs one pass over its rows.

Nulls and odd input: a null or blank text has an empty set and is linked with nothing; a text
with fewer words than a shingle takes is one shingle. Rows with equal ``doc_id`` count as one
document, linked to whatever any of them is; a blank one among them stays apart. A null ``doc_id`` is linked with nothing, its component is null and it is kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import connected_components, slices, small, stored

PERMUTATIONS = 60
# A block of a cluster holds about so many shingles (8 MB of hashes).
BLOCK_SHINGLES = 1_000_000
CACHED_WORDS = 200_000
FEATURES = "doc_id long, n_shingles long, set_key string, bands array<long>"


class WordHashes(dict):
    """Hash per word, kept up to a bound."""

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(self) < CACHED_WORDS:
            self[word] = value
        return value


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_hashes(text: str | None, size: int, cache: WordHashes) -> np.ndarray:
    """Sorted distinct hashes of all word shingles of the whole text.

    ``bytes.lower`` folds A-Z only, ``bytes.split`` parts at 0x20 and 0x09-0x0D.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(cache.__getitem__, words), np.uint64, len(words))
    size = min(size, len(words))
    total = np.full(len(words) - size + 1, len(words) if len(words) < size else size, np.uint64)
    for i in range(size):
        total = mixed(total * np.uint64(0x9E3779B97F4A7C15) + h[i:len(h) - size + 1 + i])
    return np.unique(total)


def permutations() -> tuple[np.ndarray, np.ndarray]:
    """Multipliers (odd) and offsets of the fixed permutations of 64-bit values."""
    values = mixed(np.arange(1, 2 * PERMUTATIONS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return values[:PERMUTATIONS] | np.uint64(1), values[PERMUTATIONS:]


def band_keys(hashes: np.ndarray, rows: int, multipliers: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One key per band of ``rows`` values; the first half of the bands holds minima, the rest maxima."""
    low = np.full(PERMUTATIONS, np.iinfo(np.uint64).max, np.uint64)
    high = np.zeros(PERMUTATIONS, np.uint64)
    for start in range(0, len(hashes), 4096):
        permuted = hashes[start:start + 4096, None] * multipliers + offsets
        low, high = np.minimum(low, permuted.min(axis=0)), np.maximum(high, permuted.max(axis=0))
    signature = np.concatenate([low, high]).reshape(-1, rows)
    keys = np.arange(len(signature), dtype=np.uint64)
    for i in range(rows):
        keys = mixed(keys * np.uint64(0x9E3779B97F4A7C15) + signature[:, i])
    return keys.view(np.int64)


def document_features(size: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        multipliers, offsets = permutations()
        cache = WordHashes()
        for batch in slices(batches):
            counts, keys, bands = [], [], []
            for text in batch.column("text").to_pylist():
                hashes = shingle_hashes(text, size, cache)
                counts.append(len(hashes))
                keys.append(xxhash.xxh3_128_hexdigest(hashes.tobytes()))
                bands.append(band_keys(hashes, rows, multipliers, offsets) if len(hashes) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(keys, pa.string()), pa.array(bands, pa.list_(pa.int64()))],
                ["doc_id", "n_shingles", "set_key", "bands"],
            )
    return run


def document_sets(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = WordHashes()
        for batch in slices(batches):
            sets = [shingle_hashes(text, size, cache).tobytes() for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sets, pa.binary())], ["doc_id", "shingles"])
    return run


def linked(ids: np.ndarray, sides: np.ndarray, sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Spanning forest of the links between the documents of two blocks.

    Rows of one side are compared only when there is no other side. Documents that are
    already connected are not compared again.
    """
    lengths = np.array([len(s) for s in sets])
    starts = np.concatenate([[0], np.cumsum(lengths)])
    codes = np.unique(np.concatenate(sets), return_inverse=True)[1].astype(np.int32)
    label = np.arange(len(ids))
    across = sides.max() != sides.min()
    edges, member = [], np.zeros(codes.max() + 1, bool)
    owners = np.repeat(np.arange(len(ids), dtype=np.int32), lengths)
    for x in range(len(ids) - 1):
        n = lengths[x]
        wanted = (label != label[x]) & (100 * np.minimum(lengths, n) >= percent * np.maximum(lengths, n))
        wanted[:x + 1] = False
        if across:
            wanted &= sides != sides[x]
        others = np.flatnonzero(wanted)
        if not len(others):
            continue
        member[codes[starts[x]:starts[x + 1]]] = True
        if len(others) * 8 < len(ids):
            shared = np.array([np.count_nonzero(member[codes[starts[y]:starts[y + 1]]]) for y in others])
        else:
            shared = np.bincount(owners[member[codes]], minlength=len(ids))[others]
        member[codes[starts[x]:starts[x + 1]]] = False
        for y in others[100 * shared >= percent * (lengths[others] + n - shared)]:
            if label[y] != label[x]:
                label[label == label[y]] = label[x]
                edges.append((int(ids[x]), int(ids[y])))
    return edges


def block_links(percent: int):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["doc_id", "shingles"])
        sets = [np.frombuffer(s, np.uint64) for s in group["shingles"]]
        found = linked(group["doc_id"].to_numpy(), group["block"].to_numpy(), sets, percent) if len(sets) > 1 else []
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")
    return run


def _confirmed(ids: DataFrame, classes: DataFrame, clusters: DataFrame, size: int, percent: int) -> DataFrame:
    """Links (a, b) that span the true components of each cluster."""
    volumes = classes.groupBy(F.col("class_id").alias("node")).agg(F.sum("volume").alias("volume"))
    sized = clusters.join(volumes, "node")
    blocks = sized.groupBy("component").agg(F.ceil(F.sum("volume") / BLOCK_SHINGLES).alias("blocks"))
    dealt = sized.join(blocks, "component").select(
        F.col("node").alias("doc_id"), "component", "blocks", F.expr("pmod(xxhash64(node), blocks)").alias("block")
    )
    dealt = stored(dealt, "minmax-blocks")
    sets = ids.join(small(dealt.select("doc_id")), "doc_id", "left_semi").mapInArrow(document_sets(size), "doc_id long, shingles binary")
    tasks = dealt.withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)"))).select(
        "doc_id", "component", "block", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j")
    )
    return stored(sets, "minmax-sets").join(tasks, "doc_id").groupBy("component", "i", "j").applyInPandas(
        block_links(percent), "a long, b long"
    )


def _same_document(usable: DataFrame, classes: DataFrame) -> DataFrame:
    """Links (a, b) between the classes that rows of one ``doc_id`` are in."""
    several = usable.groupBy("doc_id").agg(F.min("set_key").alias("low"), F.max("set_key").alias("high")).where("low <> high")
    several = stored(several.select("doc_id"), "minmax-several")
    rows = usable.select("doc_id", "set_key").join(small(several), "doc_id", "left_semi").join(classes.select("set_key", "class_id"), "set_key")
    rows = stored(rows.select("doc_id", "class_id").distinct(), "minmax-rows")
    return rows.join(rows.groupBy("doc_id").agg(F.min("class_id").alias("b")), "doc_id").where("class_id <> b").selectExpr("class_id AS a", "b")


def keep_representatives(docs: DataFrame, size: int = 5, percent: int = 80, rows: int = 4) -> DataFrame:
    """``docs`` without those rows whose group of near duplicates has a smaller ``doc_id``.

    Of several rows with the kept ``doc_id`` one stays. Rows without an id all stay.
    """
    verdicts = stored(near_duplicates(docs, size, percent, rows), "minmax-verdicts")
    gone = stored(verdicts.where("NOT kept").select("doc_id").distinct(), "minmax-gone")
    again = stored(verdicts.where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1").select("doc_id"), "minmax-again")
    kept = docs.join(small(gone), "doc_id", "left_anti").select(docs.columns)
    once = kept.join(small(again), "doc_id", "left_anti")
    repeated = kept.join(small(again), "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return once.unionByName(repeated).select(docs.columns)


def near_duplicates(docs: DataFrame, size: int = 3, percent: int = 85, rows: int = 5) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for every row of ``docs``.

    ``size`` words make a shingle; a link needs 100 * intersection >= ``percent`` * union.
    ``rows`` signature values make a band (120 / rows bands). A pair at the limit is missed
    with probability (1 - s^rows)^(120/rows): 8e-7 at 0.85 and 5 rows, 1.3e-7 at 0.8 and 4.
    """
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    features = stored(ids.mapInArrow(document_features(size, rows), FEATURES), "minmax-features")
    usable = features.where("doc_id IS NOT NULL AND n_shingles > 0")
    classes = stored(
        usable.groupBy("set_key").agg(F.min("doc_id").alias("class_id"), F.first("n_shingles").alias("volume"), F.first("bands").alias("bands")),
        "minmax-classes",
    )
    members = classes.select("class_id", F.explode("bands").alias("key"))
    buckets = members.groupBy("key").agg(F.min("class_id").alias("pivot"), F.count("*").alias("n")).where("n > 1")
    stars = members.join(buckets, "key").where("class_id <> pivot").selectExpr("class_id AS a", "pivot AS b")
    clusters = stored(connected_components(stars, "minmax-clusters"), "minmax-clusters")
    links = stored(_confirmed(ids, classes, clusters, size, percent), "minmax-links")
    links = links.unionByName(_same_document(usable, classes))
    components = connected_components(links, "minmax-components").selectExpr("node AS class_id", "component")
    names = classes.selectExpr("set_key", "class_id").join(components, "class_id", "left")
    whole = features.drop("bands").join(names.withColumnRenamed("set_key", "key"), F.expr("set_key = key AND n_shingles > 0"), "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "class_id", "doc_id"))
    return whole.select("doc_id", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.coalesce(F.expr("doc_id = component_id"), F.lit(True))
    )
