"""Frequent word phrases that hold together, per language, by Rabin-Karp fingerprints.

The text is parted into pieces at punctuation and line ends, pieces into words. A prefix
polynomial over the bytes of a run of texts, wrapping at 64 bits, gives the fingerprint of any
word from two of its values, so numpy fingerprints every word at once.

1. Words: tasks combine (fingerprint, count) and the shuffle sums them. Those that reach
   ``least`` occurrences mark a bit map of fixed size.
2. Vocabulary: each task takes the marked words. Words with equal fingerprints are checked against
   the text, character by character; per distinct word an occurrence pointer, the place of one
   occurrence in its text, is turned into text and the shuffle sums counts by text, which is
   exact. The top bits of its fingerprint number a word. Words that share a number, collisions, are
   told apart by their text from here on: the frequent ones get numbers of their own, the others none.
3. Pairs, then longer n-grams: the key of an n-gram is the polynomial of its words' numbers to
   the base 2^32, so wide that different n-grams have different keys. Tasks combine (key, count)
   for n-grams whose two parts, all but the last and all but the first word, are marked, and the
   shuffle sums them, which is exact. A phrase is only as frequent as any part of it, so nothing
   is lost; a bit that two n-grams share lets a few more through.
4. Only the frequent n-grams that are left, once each, are joined with the vocabulary for their text.
5. Cuts, scores and the test for longer phrases are joins of the frequent phrases with themselves.

Text of single words only leaves the tasks, never that of every phrase from every task that holds it.

Nulls and odd input: a null or blank text has no words; a null ``lang`` counts as ``und``; ids are
not used, repeated rows count each. An empty table gives an empty result. A text without any
punctuation is one piece, however long: it is worked on whole. Further columns are ignored.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tidemark.llm.common import slices, stored

# Bits of a map of frequent n-grams (8 MB); so many bytes of text are worked on at once.
MAP_BITS = 26
CHUNK = 1 << 20
HELD_ROWS = 1 << 20
HELD_WORDS = 500_000
# Words are numbered by so many top bits of their fingerprints; collisions get numbers above those.
NUMBER_BITS = 31
LONG_WORD = 64
# Parts of a language whose best phrases are ranked apart from each other first.
PARTS = 32
_BREAKS = b".,;:!?\n\x0b\x0c\r"
_CLASSES = bytes(10 if c in _BREAKS else 32 if c == 9 else c + 32 if 65 <= c < 91 else c for c in range(256))
_MULTIPLIER = 0x9E3779B97F4A7C15 & ~7 | 5
_INVERSE = pow(_MULTIPLIER, -1, 1 << 64)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_VALUES = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


class Powers:
    """Powers of the multiplier and of its inverse, as far as they were asked for."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def reach(self, n: int) -> None:
        if n > len(self.up):
            def powers(factor):
                out = np.full(n, factor, np.uint64)
                out[0] = 1
                return np.multiply.accumulate(out)
            self.up, self.down = powers(_MULTIPLIER), powers(_INVERSE)


class Chunk:
    """Words of a run of texts: their places in ``text`` (single spaces between) and their pieces."""

    def __init__(self, raw: bytes, lang: str, powers: Powers, bits: int):
        classes = np.frombuffer(raw.translate(_CLASSES) + b"\n", np.uint8)
        inside = (classes != 32) & (classes != 10)
        before = np.concatenate([[False], inside[:-1]])
        starts, ends = np.flatnonzero(inside & ~before), np.flatnonzero(before & ~inside)
        self.text = np.where(inside, classes, np.uint8(32))[inside | before]
        self.lengths = ends - starts
        self.starts = np.concatenate([[0], np.cumsum(self.lengths + 1)])[:-1].astype(np.int64)
        self.pieces = np.cumsum(classes == 10)[starts] if len(starts) else starts
        powers.reach(len(self.text) + 1)
        prefix = np.zeros(len(self.text) + 1, np.uint64)
        np.cumsum(_VALUES[self.text] * powers.down[:len(self.text)], out=prefix[1:])
        self.prefix, self.powers, self.lang = prefix, powers, np.uint64(xxhash.xxh64_intdigest(lang.encode()))
        self.mask = np.uint64((1 << 64) - (1 << 64 - bits))

    def grams(self, n: int) -> np.ndarray:
        """First words of all n-grams within a piece."""
        if len(self.starts) < n:
            return np.empty(0, np.int64)
        return np.flatnonzero(self.pieces[n - 1:] == self.pieces[:len(self.pieces) - n + 1])

    def fingerprints(self) -> np.ndarray:
        """Of all words."""
        polynomial = (self.prefix[self.starts + self.lengths] - self.prefix[self.starts]) * self.powers.up[self.starts]
        return mixed((polynomial + np.uint64(1)) ^ self.lang) & self.mask

    def word(self, at: int) -> bytes:
        return self.text[self.starts[at]:self.starts[at] + self.lengths[at]].tobytes()

    def word_ids(self, fingerprints: np.ndarray) -> np.ndarray:
        """For each word the first one of equal text: fingerprints propose, the text decides."""
        _, first, inverse = np.unique(fingerprints, return_index=True, return_inverse=True)
        ids = first[inverse]
        differs = self.lengths != self.lengths[ids]
        left = np.flatnonzero(~differs & (self.lengths <= LONG_WORD))
        for at in range(int(self.lengths[left].max(initial=0))):
            left = left[self.lengths[left] > at]
            differs[left] |= self.text[self.starts[left] + at] != self.text[self.starts[ids[left]] + at]
        for word in np.flatnonzero(~differs & (self.lengths > LONG_WORD)):
            differs[word] = word != ids[word] and self.word(word) != self.word(ids[word])
        seen: dict[bytes, int] = {}
        for word in np.flatnonzero(differs):
            ids[word] = seen.setdefault(self.word(word), word)
        return ids


def _runs(batches: Iterator[pa.RecordBatch], chunk: int) -> Iterator[tuple[str, bytes]]:
    """(lang, texts) of about ``chunk`` bytes; a long text is cut between pieces only."""
    held: dict[str, list[bytes]] = {}
    sizes: Counter = Counter()
    for batch in slices(batches):
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
            if not text:
                continue
            raw, lang = text.encode("utf-8", "surrogatepass"), "und" if lang is None else lang
            held.setdefault(lang, []).append(raw)
            sizes[lang] += len(raw)
            if sizes[lang] >= chunk:
                sizes.pop(lang)
                yield from _cut(lang, b"\n".join(held.pop(lang)), chunk)
        if sum(sizes.values()) >= 4 * chunk:  # many languages
            for name in list(held):
                yield name, b"\n".join(held.pop(name))
            sizes.clear()
    for lang, parts in held.items():
        yield lang, b"\n".join(parts)


def _cut(lang: str, raw: bytes, chunk: int) -> Iterator[tuple[str, bytes]]:
    start = 0
    while len(raw) - start > 2 * chunk:
        rest = raw[start + chunk:start + 2 * chunk].translate(_CLASSES).find(b"\n")
        if rest < 0:
            rest = raw[start + chunk:].translate(_CLASSES).find(b"\n")
        if rest < 0:
            break
        yield lang, raw[start:start + chunk + rest]
        start += chunk + rest
    yield lang, raw[start:]


def _summed(keys: list[np.ndarray], counts: np.ndarray | None = None) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct keys, whose parts are the given columns, and the sums of their counts (1 each, where none are given)."""
    if len(keys) == 1 and counts is None:
        values, counts = np.unique(keys[0], return_counts=True)
        return [values], counts
    counts = np.ones(len(keys[0]), np.int64) if counts is None else counts
    if not len(counts):
        return keys, counts
    order = np.lexsort(keys[::-1])
    keys = [k[order] for k in keys]
    new = np.concatenate([[True], np.logical_or.reduce([k[1:] != k[:-1] for k in keys])])
    return [k[new] for k in keys], np.add.reduceat(counts[order], np.flatnonzero(new))


class Sums:
    """Counts per key, combined within the task up to a bound; of a row's ``width`` key columns those a key lacks are null."""

    def __init__(self, width: int):
        self.width, self.parts, self.rows = width, [], 0

    def add(self, keys: list[np.ndarray]) -> bool:
        self.parts.append(_summed(keys))
        self.rows += len(self.parts[-1][1])
        if self.rows > HELD_ROWS:
            self.parts = [self._merged()]
            self.rows = len(self.parts[0][1])
        return 2 * self.rows > HELD_ROWS

    def _merged(self) -> tuple[list[np.ndarray], np.ndarray]:
        if not self.parts:
            return [np.empty(0, np.uint64)], np.empty(0, np.int64)
        keys, counts = zip(*self.parts)
        return _summed([np.concatenate(k) for k in zip(*keys)], np.concatenate(counts))

    def flush(self) -> pa.RecordBatch:
        keys, counts = self._merged()
        self.__init__(self.width)
        columns = [pa.array(k.view(np.int64), pa.int64()) for k in keys]
        columns += [pa.nulls(len(counts), pa.int64())] * (self.width - len(keys))
        return pa.RecordBatch.from_arrays(
            [pa.nulls(len(counts), pa.string()), *columns, pa.array(counts, pa.int64())], ["lang", *key_columns(2 * self.width), "n"]
        )


def key_columns(n: int) -> list[str]:
    """Columns of an n-gram's key: two words each."""
    return [f"key{i}" for i in range((n + 1) // 2)]


def marked(bitmap: np.ndarray, fingerprints: np.ndarray) -> np.ndarray:
    at = fingerprints >> np.uint64(64 - MAP_BITS)
    return (bitmap[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


def _words(chunk: int, bits: int, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, sums, totals = Powers(), Sums(width), Counter()
        for lang, raw in _runs(batches, chunk):
            part = Chunk(raw, lang, powers, bits)
            totals[lang] += len(part.starts)
            if sums.add([part.fingerprints()]):
                yield sums.flush()
        yield sums.flush()
        none = [pa.nulls(len(totals), pa.int64())] * width
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(totals), pa.string()), *none, pa.array(list(totals.values()), pa.int64())], ["lang", *key_columns(2 * width), "n"]
        )
    return run


def _vocabulary(chunk: int, bits: int, words):
    """Counts by text of the marked words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush() -> pa.RecordBatch:
            rows = [(lang, word, number, n) for lang, found in counts.items() for (word, number), n in found.items()]
            counts.clear()
            kinds = pa.string(), pa.binary(), pa.int64(), pa.int64()
            columns = zip(*rows) if rows else [[]] * 4
            return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns, kinds)], ["lang", "word", "number", "n"])

        powers, counts, bitmap = Powers(), defaultdict(Counter), np.frombuffer(words.value, np.uint8)
        for lang, raw in _runs(batches, chunk):
            part = Chunk(raw, lang, powers, bits)
            keys = part.fingerprints()
            pointers, found = np.unique(part.word_ids(keys)[marked(bitmap, keys)], return_counts=True)
            for pointer, number, n in zip(pointers.tolist(), numbers_of(keys[pointers]).tolist(), found.tolist()):
                counts[lang][part.word(pointer), number] += n
            if sum(map(len, counts.values())) > HELD_WORDS:
                yield flush()
        yield flush()
    return run


def numbers_of(fingerprints: np.ndarray) -> np.ndarray:
    return fingerprints >> np.uint64(64 - NUMBER_BITS)


def _numbered(part: Chunk, lang: str, bitmap: np.ndarray, shared: np.ndarray, renamed: dict) -> tuple[np.ndarray, np.ndarray]:
    """Places of the marked words, and the numbers of all words; of the words that share a number ``renamed`` has the frequent ones."""
    keys = part.fingerprints()
    numbers, known = numbers_of(keys), marked(bitmap, keys)
    if len(shared):
        for at in np.flatnonzero(known & np.isin(numbers, shared)).tolist():
            number = renamed.get((lang, part.word(at)))
            known[at], numbers[at] = number is not None, number or 0
    return np.flatnonzero(known), numbers


def gram_keys(numbers: np.ndarray, first: np.ndarray, n: int) -> list[np.ndarray]:
    """Keys of the n-grams that begin at ``first``: the numbers of two words in each column."""
    shift = np.uint64(32)
    return [numbers[first + i] << shift | (numbers[first + i + 1] if i + 1 < n else np.uint64(0)) for i in range(0, n, 2)]


def spread(keys: list[np.ndarray]) -> np.ndarray:
    """One fingerprint of a key, for its place in a map."""
    out = mixed(keys[0])
    for key in keys[1:]:
        out = mixed(out * np.uint64(_MULTIPLIER) + key)
    return out


def _grown(part: Chunk, first: np.ndarray, n: int) -> np.ndarray:
    """First words of the n-grams whose two parts of ``n - 1`` words are among ``first``."""
    here = np.zeros(len(part.starts) + 1, bool)
    here[first] = True
    grams = part.grams(n)
    return grams[here[grams] & here[grams + 1]]


def _grams(chunk: int, bits: int, width: int, maps, clashes):
    """Counts of the n-grams one word longer than the last of ``maps`` has."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, sums, bitmaps = Powers(), Sums(width), [np.frombuffer(m.value, np.uint8) for m in maps]
        shared, renamed = clashes.value
        for lang, raw in _runs(batches, chunk):
            part = Chunk(raw, lang, powers, bits)
            first, numbers = _numbered(part, lang, bitmaps[0], shared, renamed)
            for n, bitmap in enumerate(bitmaps[1:], 2):
                first = _grown(part, first, n)
                first = first[marked(bitmap, spread(gram_keys(numbers, first, n)))]
            n = len(bitmaps) + 1
            if sums.add(gram_keys(numbers, _grown(part, first, n), n)):
                yield sums.flush()
        yield sums.flush()
    return run


def _places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys = [column.to_numpy().view(np.uint64) for column in batch.columns]
        yield pa.RecordBatch.from_arrays([pa.array(spread(keys).view(np.int64), pa.int64())], ["key"])


def bit_map(keys: DataFrame) -> bytes:
    """A map with the top bits of each ``key`` set. What reaches the driver is bounded by the map's size."""
    at = f"shiftrightunsigned(key, {64 - MAP_BITS})"
    rows = keys.selectExpr(f"{at} div 64 AS cell", f"shiftleft(1L, int({at} % 64)) AS bit").groupBy("cell").agg(F.expr("bit_or(bit)").alias("bits"))
    cells, found = np.zeros(1 << (MAP_BITS - 6), np.int64), rows.toArrow()
    cells[found["cell"].to_numpy()] = found["bits"].to_numpy()
    return cells.tobytes()


def numbered_words(spark: SparkSession, counted: DataFrame, least: int) -> tuple[DataFrame, tuple[np.ndarray, dict]]:
    """(lang, word, number, f) of the frequent words, and the collisions: shared numbers, and the new number by (lang, word).

    ``counted`` has all marked words. About the square of their number over 2^32 share a number; only those
    reach the driver.
    """
    several = counted.groupBy("number").agg(F.count("*").alias("words")).where("words > 1").select("number")
    found = counted.join(several, "number").select("lang", "word", "number", "f").toArrow().to_pylist()
    shared = np.array(sorted({r["number"] for r in found}), np.uint64)
    frequent = sorted((r["lang"], r["word"]) for r in found if r["f"] >= least)
    renamed = {word: (1 << NUMBER_BITS) + i for i, word in enumerate(frequent)}
    vocabulary = counted.where(F.col("f") >= least)
    if renamed:
        new = spark.createDataFrame([(*word, number) for word, number in renamed.items()], "lang string, word binary, own long")
        vocabulary = vocabulary.join(F.broadcast(new), ["lang", "word"], "left").withColumn("number", F.coalesce("own", "number"))
    return vocabulary.select("lang", F.col("word").cast("string").alias("word"), "number", "f"), (shared, renamed)


def _text(counts: DataFrame, n: int, vocabulary: DataFrame) -> DataFrame:
    """(lang, words, phrase, f) of n-grams with counts by key."""
    number = [f"shiftrightunsigned(key{i // 2}, 32)" if i % 2 == 0 else f"key{i // 2} & 4294967295L" for i in range(n)]
    found = counts.selectExpr(*[f"{sql} AS number{i}" for i, sql in enumerate(number)], "n AS f")
    for i in range(n):
        also = ["lang"] if i == 0 else []  # numbers of a language are its own
        found = found.join(vocabulary.selectExpr(f"number AS number{i}", f"word AS word{i}", *also), f"number{i}")
    return found.select("lang", F.lit(n).alias("words"), F.concat_ws(" ", *[f"word{i}" for i in range(n)]).alias("phrase"), "f")


def frequent_phrases(spark: SparkSession, docs: DataFrame, least: int, longest: int, chunk: int = CHUNK, bits: int = 64) -> tuple[DataFrame, DataFrame]:
    """(lang, words, phrase, f) of all phrases, single words too, with at least ``least`` occurrences, and (lang, n) word totals.

    ``bits`` of a fingerprint are used; fewer only make collisions, for tests.
    """
    texts, summed, enough = docs.select("lang", "text"), F.sum("n").alias("n"), F.col("n") >= least
    names = key_columns(longest)
    rows, width = ", ".join(["lang string", *[f"{name} long" for name in names], "n long"]), len(names)
    singles = stored(texts.mapInArrow(_words(chunk, bits, width), rows).groupBy("lang", "key0").agg(summed), "collocations-words")
    maps = [spark.sparkContext.broadcast(bit_map(singles.where("key0 IS NOT NULL").where(enough).selectExpr("key0 AS key")))]
    counted = texts.mapInArrow(_vocabulary(chunk, bits, maps[0]), "lang string, word binary, number long, n long")
    counted = stored(counted.groupBy("lang", "word", "number").agg(F.sum("n").alias("f")), "collocations-vocabulary")
    vocabulary, collisions = numbered_words(spark, counted, least)
    clashes = spark.sparkContext.broadcast(collisions)
    found = vocabulary.select("lang", F.lit(1).alias("words"), F.col("word").alias("phrase"), "f")
    for n in range(2, longest + 1):
        keys = key_columns(n)
        counts = texts.mapInArrow(_grams(chunk, bits, width, list(maps), clashes), rows).groupBy(*keys).agg(summed)
        counts = stored(counts.where(enough), f"collocations-{n}")
        if n < longest:
            maps.append(spark.sparkContext.broadcast(bit_map(counts.select(*keys).mapInArrow(_places, "key long"))))
        found = found.unionByName(_text(counts, n, vocabulary))
    return stored(found, "collocations-phrases"), singles.where("lang IS NOT NULL").select("lang", "n")


def collocations(
    spark: SparkSession, docs: DataFrame, least: int = 30, longest: int = 4, share: int = 80, top: int = 2000, chunk: int = CHUNK, bits: int = 64
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of each language's ``top`` phrases."""
    phrases, totals = frequent_phrases(spark, docs, least, longest, chunk, bits)
    # Spaces part the words of a phrase, so its parts are substrings at its spaces.
    candidates = phrases.where("words > 1").withColumnRenamed("f", "a").withColumn("w", F.split("phrase", " "))
    parts = phrases.select("lang", F.col("phrase").alias("part"), "f")
    cuts = candidates.withColumn("k", F.explode(F.expr("sequence(1, words - 1)"))).selectExpr(
        "lang", "phrase", "a", "k", "array_join(slice(w, 1, k), ' ') AS head", "array_join(slice(w, k + 1, words - k), ' ') AS tail"
    )
    cuts = cuts.join(parts.selectExpr("lang", "part AS head", "f AS l"), ["lang", "head"]).join(parts.selectExpr("lang", "part AS tail", "f AS r"), ["lang", "tail"])
    cuts = cuts.withColumn("score", F.expr("2000000 * CAST(a AS DECIMAL(20, 0)) div (CAST(l AS DECIMAL(20, 0)) + r)"))
    lowest = cuts.groupBy("lang", "phrase", "a").agg(F.expr("min_by(struct(l, r, score), struct(score, k))").alias("cut"))
    lowest = lowest.select("lang", "phrase", "a", "cut.*")
    inner = candidates.where("words > 2").withColumn("size", F.explode(F.expr("sequence(2, words - 1)"))).withColumn(
        "at", F.explode(F.expr("sequence(1, words - size + 1)"))
    ).selectExpr("lang", "array_join(slice(w, at, size), ' ') AS phrase", "a AS longer")
    held = inner.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    kept = lowest.join(held, ["lang", "phrase"], "left").where(f"longer IS NULL OR 100 * CAST(longer AS DECIMAL(20, 0)) < {share} * CAST(a AS DECIMAL(20, 0))")
    # the best of each of PARTS parts first, so that one task never gets more than the best of those
    by_score = F.desc("score"), F.desc("a"), "phrase"
    part = Window.partitionBy("lang", "part").orderBy(*by_score)
    few = kept.withColumn("part", F.expr(f"pmod(xxhash64(phrase), {PARTS})")).withColumn("place", F.row_number().over(part)).where(F.col("place") <= top)
    best = few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*by_score)).cast("long")).where(F.col("rank") <= top)
    return best.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
