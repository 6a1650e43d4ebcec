"""Near-duplicate documents by 64-bit fingerprints, compared exactly in tiles.

A fingerprint bit is set where more than half of the document's shingle hashes have it set.
Documents link where their fingerprints differ in at most ``radius`` bits. Equal fingerprints
are one class from here on, so a group of copies of any size is one value.

The comparison is exact. Two values differ in at least as many bits as their population
counts differ, and that also holds for the sum over parts of the value. Values are dealt to
tiles by the population counts of their parts. Only tiles within ``radius`` of each other meet,
as one task per pair of blocks; inside a task numpy exclusive-ors and counts bits, and the same
bound, over quarters, skips parts of the blocks. More parts make more and smaller tiles, so
their number follows the largest tile: 1, 2, 4 or 8. A tile too large for a block is dealt to
several blocks, which all meet. That choice changes what is compared with what, never the result.

A task returns a star per connected group of its values, so never all pairs; the components of
all stars give the result.

Nulls and odd input: a null or blank text has fingerprint zero and is linked like any other;
fewer words than a shingle takes are one shingle. Repeated rows stay, each with its result.
Rows without ``doc_id`` take part; a group's ``component_id`` is the smallest id it has, null
where it has none. An empty table gives an empty result. Further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import connected_components, slices, small, stored

SEED = 42
# Values of a tile beyond which it is dealt to several blocks, and blocks a tile may have.
BLOCK = 1 << 16
BLOCK_BITS = 20
PARTS = (1, 2, 4, 8)
# Rows and columns that are compared at once.
ROWS, COLUMNS = 256, 2048
SHINGLES_AT_ONCE = 1 << 16


def fingerprint(text: str | None, size: int) -> int:
    """Fingerprint of the whole text as a signed 64-bit value.

    ``bytes.lower`` folds A-Z only, ``bytes.split`` parts at 0x20 and 0x09-0x0D.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    total = max(len(words) - size + 1, 1)
    shingles = map(b" ".join, zip(*(words[i:] for i in range(size)))) if len(words) > size else iter([b" ".join(words)])
    digest, counts = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    while len(hashes := np.fromiter((digest(s, SEED) for s in islice(shingles, SHINGLES_AT_ONCE)), np.uint64)):
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > total, bitorder="little").view(np.int64)[0])


def document_fingerprints(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            values = [fingerprint(text, size) for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(values, pa.int64())], ["doc_id", "value"])
    return run


# --- tiles ---


def base(parts: int) -> int:
    """Digit base of a tile's number: no step of up to ``64 // parts`` bits reaches another tile's digits."""
    return 4 * (64 // parts)


def tile_number(parts: int) -> str:
    """SQL: the tile of ``value``, its parts' population counts as digits."""
    width = 64 // parts
    if parts == 1:
        return "bigint(bit_count(value))"
    mask = (1 << width) - 1
    return " + ".join(f"bit_count(shiftrightunsigned(value, {i * width}) & {mask}L) * {base(parts) ** i}L" for i in range(parts))


def steps(parts: int, radius: int) -> list[int]:
    """Differences of tile numbers whose population counts are within ``radius``, one of each opposite two."""
    found = [(0, 0)]
    for i in range(parts):
        found = [(code + d * base(parts) ** i, spent + abs(d)) for code, spent in found for d in range(spent - radius, radius - spent + 1)]
    return sorted(code for code, _ in found if code >= 0)


def quarters(values: np.ndarray) -> np.ndarray:
    return np.bitwise_count(values.view(np.uint16).reshape(-1, 4)).astype(np.int16)


def cut(values: np.ndarray, at_once: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Values in the order of their quarters' population counts; starts and bounds of their parts."""
    values = np.ascontiguousarray(values)
    counts = quarters(values)
    order = np.lexsort(counts.T)
    values, counts = values[order], counts[order]
    starts = np.arange(0, len(values), at_once)
    return values, starts, np.minimum.reduceat(counts, starts), np.maximum.reduceat(counts, starts)


def roots(parent: np.ndarray, nodes: np.ndarray) -> np.ndarray:
    found = parent[nodes]
    while True:
        above = parent[found]
        if np.array_equal(above, found):
            return found
        found = above


def connect(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Join the groups of each pair (a, b) under the smaller root."""
    while len(a):
        x, y = roots(parent, a), roots(parent, b)
        apart = x != y
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(parent, np.maximum(x, y), np.minimum(x, y))


def linked(left: np.ndarray, right: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """(value, root) stars of the links between two blocks; without a ``right``, of those within ``left``."""
    within = not len(right)
    a, a_starts, a_low, a_high = cut(left, ROWS)
    b, b_starts, b_low, b_high = cut(left if within else right, COLUMNS)
    names = a if within else np.concatenate([a, b])
    shift = 0 if within else len(a)
    parent = np.arange(len(names))
    for start, low, high in zip(a_starts, a_low, a_high):
        rows = a[start:start + ROWS]
        gaps = np.maximum(np.maximum(low - b_high, b_low - high), 0).sum(axis=1)
        for at in b_starts[gaps <= radius]:
            if within and at + COLUMNS <= start:
                continue  # met from the other side
            near = np.bitwise_count(rows[:, None] ^ b[None, at:at + COLUMNS]) <= radius
            i, j = np.nonzero(near)
            connect(parent, i + start, j + at + shift)
    top = roots(parent, np.arange(len(names)))
    moved = top != np.arange(len(names))
    return names[moved], names[top[moved]]


def block_links(radius: int):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        values, side = group["value"].to_numpy().view(np.uint64), group["side"].to_numpy()
        a, b = linked(values[side == 0], values[side == 1], radius)
        return pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})
    return run


def links(values: DataFrame, radius: int, block: int) -> DataFrame:
    """Links (a, b) that span the connected groups of the distinct ``value``s of a stored table."""
    for parts in PARTS:
        tiled = values.withColumn("tile", F.expr(tile_number(parts)))
        sizes = stored(tiled.groupBy("tile").agg(F.ceil(F.count("*") / block).alias("blocks")), "simhash-tiles")
        if (sizes.agg(F.max("blocks")).first()[0] or 0) <= 1:
            break
    code = F.explode(F.array([F.lit(s).cast("long") for s in steps(parts, radius)]))
    pairs = sizes.select("tile", "blocks", code.alias("step")).withColumn("other", F.expr("tile + step")).join(
        sizes.selectExpr("tile AS other", "blocks AS other_blocks"), "other"
    )
    tasks = stored(
        pairs.withColumn("i", F.explode(F.expr("sequence(0L, blocks - 1)"))).withColumn("j", F.explode(F.expr("sequence(0L, other_blocks - 1)")))
        .where("tile <> other OR i <= j").selectExpr(f"shiftleft(tile, {BLOCK_BITS}) + i AS left", f"shiftleft(other, {BLOCK_BITS}) + j AS right"),
        "simhash-tasks",
    )
    seats = tasks.selectExpr("left AS home", "left", "right", "0 AS side").unionByName(
        tasks.where("left <> right").selectExpr("right AS home", "left", "right", "1 AS side")
    )
    homes = tiled.join(small(sizes), "tile").selectExpr("value", f"shiftleft(tile, {BLOCK_BITS}) + pmod(xxhash64(value), blocks) AS home")
    return homes.join(small(stored(seats, "simhash-seats")), "home").select("left", "right", "value", "side").groupBy("left", "right").applyInPandas(
        block_links(radius), "a long, b long"
    )


def near_duplicates(docs: DataFrame, size: int = 3, radius: int = 3, block: int = BLOCK) -> DataFrame:
    """doc_id, fingerprint (hex) and component_id for every row of ``docs``."""
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    values = stored(ids.mapInArrow(document_fingerprints(size), "doc_id long, value long"), "simhash-values")
    classes = stored(values.groupBy("value").agg(F.min("doc_id").alias("least")), "simhash-classes")
    stars = stored(links(classes.select("value"), radius, block), "simhash-links")
    groups = connected_components(stars, "simhash-components").selectExpr("node AS value", "component")
    named = classes.join(groups, "value", "left").withColumn("component", F.coalesce("component", "value"))
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    labels = stored(named.join(least, "component").select("value", "component_id"), "simhash-labels")
    return values.join(small(labels), "value").select("doc_id", F.expr("lpad(lower(hex(value)), 16, '0')").alias("fingerprint"), "component_id")
