"""Benchmark passages in documents, found by the q-gram lemma and banded alignment.

A benchmark item of n characters that stands in a document with at most k edits shares at
least n + 1 - q - k*q of its q-grams with it, all on diagonals (document position minus item
position) at most k away from the item's start. Per document, shared q-grams are counted in
bands of 2k + 1 diagonals, two neighbouring bands at a time so that the bands overlap; a region
below the bound cannot hold the item. What remains is verified by banded alignment of the whole
item with the region.

Texts are compared in lower case, with every run of other than letters and digits as one space.
k is a tenth of the item's length, less for short items so that the bound stays above zero.
Items shorter than q characters (also null and empty ones) match nothing. Null and empty
documents hold nothing. Equal rows give equal matches. Items with equal ids are judged apart.

The benchmark is taken in blocks of bounded size, so its index never outgrows a task; every
block is held against all documents. Documents are scanned in pieces, whole texts always.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import slices, small, stored

Q = 8
EDIT_SHARE = 0.1
# Characters of benchmark text in one index.
BLOCK_CHARS = 4_000_000
# Characters of documents scanned at once; a longer document is scanned alone.
PIECE_CHARS = 500_000
# Shared q-grams listed at once.
HITS = 2_000_000
FILTER_BITS = 22
MATCHES = "doc_id long, item_id long, start int, end int, edits int"


_TABLES: dict[str, np.ndarray] = {}


def _plain() -> np.ndarray:
    """Whether a code point below 2^16 is a letter or digit; those above all count as letters."""
    if "plain" not in _TABLES:
        _TABLES["plain"] = np.array([chr(c).isalnum() for c in range(1 << 16)])
    return _TABLES["plain"]


def codes(text: str | None) -> np.ndarray:
    """Code points of the compared form."""
    chars = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    plain = _plain()[np.minimum(chars, 0xFFFF)] | (chars > 0xFFFF)
    keep = plain.copy()
    keep[1:] |= plain[:-1]
    out = np.where(plain, chars, np.uint32(32))[keep]
    return out[:-1] if len(out) and out[-1] == 32 else out


def grams(chars: np.ndarray) -> np.ndarray:
    """One 64-bit value per q-gram, a byte per character; verification sees whole characters."""
    if len(chars) < Q:
        return np.empty(0, np.uint64)
    low = ((chars ^ (chars >> np.uint32(8)) ^ (chars >> np.uint32(16))) & np.uint32(255)).astype(np.uint8)
    return np.lib.stride_tricks.sliding_window_view(low, Q).copy().view(np.uint64).ravel()


def slot(values: np.ndarray) -> np.ndarray:
    return ((values * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - FILTER_BITS)).astype(np.intp)


def edit_budget(n: int) -> int:
    return max(0, min(int(n * EDIT_SHARE), (n - Q) // Q))


class Index:
    """q-grams of a block of benchmark items."""

    def __init__(self, items: list[tuple[int, str | None]]):
        kept = [(i, c) for i, c in ((i, codes(t)) for i, t in items) if len(c) >= Q]
        self.ids = [i for i, _ in kept]
        self.chars = [c for _, c in kept]
        lengths = np.array([len(c) for c in self.chars], np.int64)
        self.budgets = np.array([edit_budget(n) for n in lengths], np.int64)
        self.bounds = lengths + 1 - Q - self.budgets * Q
        found = [grams(c) for c in self.chars] or [np.empty(0, np.uint64)]
        values = np.concatenate(found)
        order = np.argsort(values, kind="stable")
        self.values, self.first, self.times = np.unique(values[order], return_index=True, return_counts=True)
        self.items = np.repeat(np.arange(len(found)), [len(g) for g in found])[order]
        self.places = np.concatenate([np.arange(len(g)) for g in found])[order]
        self.table = np.full(1 << FILTER_BITS, -1, np.int32)
        self.table[slot(self.values)] = np.arange(len(self.values), dtype=np.int32)

    def candidates(self, chars: np.ndarray) -> list[tuple[int, int, int]]:
        """(item, first diagonal, last diagonal) of the regions that reach an item's bound."""
        seen = grams(chars)
        nth = self.table[slot(seen)]
        at = np.flatnonzero(nth >= 0)
        nth = nth[at]
        odd = np.flatnonzero(self.values[nth] != seen[at])  # another value has the slot
        nth[odd] = np.minimum(np.searchsorted(self.values, seen[at[odd]]), len(self.values) - 1)
        good = self.values[nth] == seen[at]
        at, nth = at[good], nth[good]
        span = np.int64(len(chars) + self._longest() + 2)
        shared = self._shared(at, nth, span)
        if not len(shared):
            return []
        slots = shared // (2 * span)
        keys = self.items[slots] * (2 * span) + shared % (2 * span)
        key, count = np.unique(keys, return_counts=True)
        after = np.zeros(len(count), np.int64)
        adjacent = np.flatnonzero(key[1:] == key[:-1] + 1)
        after[adjacent] = count[adjacent + 1]
        good = np.flatnonzero(count + after >= self.bounds[key // (2 * span)])
        if not len(good):
            return []
        good = good[self._distinct(key[good], keys, self.places[slots]) >= self.bounds[key[good] // (2 * span)]]
        width = 2 * self.budgets + 1
        found: list[list[int]] = []
        for k in key[good].tolist():
            i, b = k // (2 * span), k % (2 * span) - int(span)
            w = int(width[i])
            if found and found[-1][0] == i and found[-1][2] + 1 >= b * w and b * w - found[-1][1] < 8 * w:
                found[-1][2] = (b + 2) * w - 1
            else:
                found.append([i, b * w, (b + 2) * w - 1])
        return [tuple(x) for x in found]

    def _shared(self, at: np.ndarray, nth: np.ndarray, span: np.int64) -> np.ndarray:
        """Distinct (item position, diagonal band) of all shared q-grams, coded as one number each.

        Repetitive texts share a q-gram many times over, so hits are listed in bounded parts.
        """
        first, times = self.first[nth], self.times[nth]
        ends = np.cumsum(times)
        parts, start = [], 0
        while start < len(at):
            done = ends[start] - times[start]
            stop = max(start + 1, int(np.searchsorted(ends, done + HITS, "right")))
            n = times[start:stop]
            hit = np.arange(int(n.sum())) + np.repeat(first[start:stop] - (ends[start:stop] - n - done), n)
            width = 2 * self.budgets[self.items[hit]] + 1
            band = (np.repeat(at[start:stop], n) - self.places[hit]) // width
            parts.append(np.unique(hit * (2 * span) + band + span))
            start = stop
        return parts[0] if len(parts) == 1 else np.unique(np.concatenate(parts or [np.empty(0, np.int64)]))

    @staticmethod
    def _distinct(wanted: np.ndarray, keys: np.ndarray, places: np.ndarray) -> np.ndarray:
        """Distinct item positions among the hits of each wanted band and the one after it."""
        counts = np.zeros(len(wanted), np.int64)
        for step in (0, 1):
            at = np.clip(np.searchsorted(wanted, keys - step), 0, len(wanted) - 1)
            mine = wanted[at] == keys - step
            pairs = at[mine] * (1 << 32) + places[mine]
            both = pairs if step == 0 else np.concatenate([both, pairs])
        np.add.at(counts, np.unique(both) >> 32, 1)
        return counts

    def _longest(self) -> int:
        return max((len(c) for c in self.chars), default=0)


def aligned(item: np.ndarray, text: np.ndarray, lo: int, hi: int, budget: int) -> tuple[int, int]:
    """(edits, end) of the best alignment of the whole item within the diagonals lo to hi.

    Ends early, with more edits than ``budget``, once no cell is within it.

    Text before and after the aligned part is free. Cells outside the text cannot be reached.
    """
    far = np.int64(1 << 30)
    diagonals = np.arange(lo, hi + 1)
    steps = np.arange(len(diagonals))
    row = np.where((diagonals >= 0) & (diagonals <= len(text)), 0, far)
    for i in range(1, len(item) + 1):
        ends = diagonals + i
        inside = (ends >= 0) & (ends <= len(text))
        letter = text[np.clip(ends - 1, 0, max(len(text) - 1, 0))] if len(text) else np.zeros(len(ends), np.uint32)
        match = np.where(ends >= 1, row + (letter != item[i - 1]), far)
        skipped = np.append(row[1:] + 1, far)
        row = np.where(inside, np.minimum(match, skipped), far)
        row = np.where(inside, np.minimum.accumulate(row - steps) + steps, far)
        if i % 16 == 0 and row.min() > budget:
            break
    best = int(row.argmin())
    return int(min(row[best], far)), int(diagonals[best] + len(item))


def verified(item: np.ndarray, budget: int, text: np.ndarray, lo: int, hi: int) -> tuple[int, int, int] | None:
    """(start, end, edits) of the item in the text, or None beyond the budget."""
    left, right = max(0, lo - budget), min(len(text), hi + len(item) + budget)
    if right <= left:
        return None
    region = text[left:right]
    raw, wanted = region.tobytes(), item.tobytes()
    at = raw.find(wanted)
    while at > 0 and at % 4:
        at = raw.find(wanted, at + 1)
    if at >= 0:
        return left + at // 4, left + at // 4 + len(item), 0
    edits, end = aligned(item, region, lo - budget - left, hi + budget - left, budget)
    if edits > budget:
        return None
    part = region[max(0, end - len(item) - budget):end][::-1]
    _, back = aligned(item[::-1], part, -budget, budget, budget)
    return left + end - back, left + end, edits


def scan(indexes, doc_ids: list, texts: list) -> Iterator[tuple]:
    """Matches of a piece of documents, laid end to end with gaps that no q-gram spans."""
    chars = [codes(t) for t in texts]
    gap = np.zeros(1, np.uint32)
    starts = np.cumsum([0] + [len(c) + 1 for c in chars])
    whole = np.concatenate([x for c in chars for x in (c, gap)]) if chars else gap
    seen = set()
    for item, lo, hi in indexes.candidates(whole):
        n, k = len(indexes.chars[item]), int(indexes.budgets[item])
        first = max(0, int(np.searchsorted(starts, max(lo, 0), "right")) - 1)
        last = min(len(chars) - 1, int(np.searchsorted(starts, min(hi + n + k, len(whole) - 1), "right")) - 1)
        for d in range(first, last + 1):
            found = verified(indexes.chars[item], k, chars[d], lo - int(starts[d]), hi - int(starts[d]))
            if found and (d, item, found[0]) not in seen:
                seen.add((d, item, found[0]))
                yield (doc_ids[d], indexes.ids[item], *found)


def matcher(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(shared.value)
        schema = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("start", pa.int32()), ("end", pa.int32()), ("edits", pa.int32())])
        for batch in slices(batches):
            ids, texts = batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()
            first, volume = 0, 0
            for i, text in enumerate(texts):
                volume += len(text or "")
                if volume >= PIECE_CHARS or i == len(texts) - 1:
                    rows = list(scan(index, ids[first:i + 1], texts[first:i + 1]))
                    if rows:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
                    first, volume = i + 1, 0
    return run


def matches(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, start, end (in the compared form) and edits of every passage found."""
    spark = docs.sparkSession
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text", F.length("text").alias("n")).where("n > 0")
    blocks = max(1, -(-(items.agg(F.sum("n")).first()[0] or 0) // BLOCK_CHARS))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("length(text) > 0")
    found = []
    for block in range(blocks):
        rows = [tuple(r) for r in items.where(F.expr(f"pmod(xxhash64(item_id, text), {blocks}) = {block}")).select("item_id", "text").collect()]
        found.append(texts.mapInArrow(matcher(spark.sparkContext.broadcast(rows)), MATCHES))
    return reduce(DataFrame.unionByName, found)


def decontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the documents that hold a benchmark item. Rows without an id stay."""
    leaks = stored(matches(docs, benchmark).select("doc_id").where("doc_id IS NOT NULL").distinct(), "leaks")
    return docs.join(small(leaks), "doc_id", "left_anti").select(docs.columns)
