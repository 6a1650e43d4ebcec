"""Importance resampling of documents towards a target text, by hashed words and word pairs.

Features of a text are its words and its pairs of consecutive words; a feature's bucket is the
CRC-32 of its bytes modulo ``BUCKETS``. The corpus' and the target's bucket totals give each
bucket a gain, a document's weight is the mean gain of its features, and Gumbel noise hashed
from its id turns "the highest scores" into a draw without replacement.

The vocabulary has a head and a tail. CRC-32 runs over a text from left to right, so the state
after a first word is all a pair needs: the head, broadcast, holds the exact CRC state of
frequent words and the exact bucket of frequent pairs. Whatever the head lacks takes its CRC
directly. Both feed the same totals, so the head decides speed only. It is counted on a sample
by hash of at most about ``HEAD_DOCS`` documents and has at most ``HEAD_WORDS`` words and
``HEAD_PAIRS`` pairs. Totals, weights and ranks cover all documents.

Ranks need no global sort: a score is a whole number within about +-65,000, so the counts per
score, at most 130,000 rows, give the number of better documents, and only documents of equal
score are ordered among themselves. The noise gives no score more than 0.04% of all documents.

Nulls and odd input: a null or blank text has no feature, weight 0, a score, and no rank (it has
too few words). A null ``doc_id`` counts as an empty text in the hash and comes last among ties.
Repeated rows are drawn each for itself; which of rows with equal id and score comes first is
open. An empty table gives an empty result; an empty target gives every bucket t = 0.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tidemark.llm.common import slices, stored

BUCKETS = 10_000
SEED = 7
HEAD_DOCS, HEAD_WORDS, HEAD_PAIRS = 20_000, 50_000, 100_000
HELD_FEATURES = 200_000
# Keeps digits and letters, folds A-Z, leaves bytes of other characters; all else parts words.
_FOLD = bytes(c if 48 <= c < 58 or 97 <= c < 123 or c >= 128 else c + 32 if 65 <= c < 91 else 32 for c in range(256))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_FOLD).split()


def bucket_list(words: list[bytes], states: dict[bytes, int], pairs: dict[bytes, int]) -> list[int]:
    """Bucket of every word, then of every pair."""
    crc = zlib.crc32
    codes = [states[w] if w in states else crc(w) for w in words]
    found = [c % BUCKETS for c in codes]
    for code, pair, second in zip(codes, map(b" ".join, zip(words, words[1:])), words[1:]):
        bucket = pairs.get(pair)
        found.append(crc(b" " + second, code) % BUCKETS if bucket is None else bucket)
    return found


# --- head ---


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of words and pairs, combined within the task; a full table is passed on."""
    def flush() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], ["feature", "n"])

    counts: Counter = Counter()
    for batch in slices(batches):
        for text in batch.column("text").to_pylist():
            words = words_of(text)
            counts.update(words)
            counts.update(map(b" ".join, zip(words, words[1:])))
        if len(counts) > HELD_FEATURES:
            yield flush()
            counts.clear()
    yield flush()


def head(docs: DataFrame, n_docs: int, head_docs: int = HEAD_DOCS) -> tuple[list[bytes], list[bytes]]:
    """The most frequent words and pairs of a sample of documents by hash of their id and text."""
    every = max(1, math.ceil(n_docs / head_docs))
    sample = docs.where(F.expr(f"pmod(xxhash64(doc_id, text), {every}) = 0")).select("text")
    counts = stored(
        sample.mapInArrow(_counted, "feature binary, n long").groupBy("feature").agg(F.sum("n").alias("n"))
        .withColumn("pair", F.expr("position(' ', string(feature)) > 0")).where("n > 1"),
        "resampling-head",
    )

    def most(pair: str, limit: int) -> list[bytes]:
        return [bytes(r[0]) for r in counts.where(pair).orderBy(F.desc("n"), "feature").limit(limit).select("feature").collect()]

    return most("NOT pair", HEAD_WORDS), most("pair", HEAD_PAIRS)


def _lookups(words: list[bytes], pairs: list[bytes]) -> tuple[dict[bytes, int], dict[bytes, int]]:
    return {w: zlib.crc32(w) for w in words}, {p: zlib.crc32(p) % BUCKETS for p in pairs}


# --- totals and weights ---


def _totals(vocabulary):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        states, pairs = vocabulary.value
        counts = np.zeros(BUCKETS, np.int64)
        for batch in slices(batches):
            for text in batch.column("text").to_pylist():
                found = bucket_list(words_of(text), states, pairs)
                if found:
                    counts += np.bincount(found, minlength=BUCKETS)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(counts[used], pa.int64())], ["bucket", "n"])
    return run


def bucket_totals(texts: DataFrame, vocabulary) -> list[int]:
    """Exact occurrences per bucket over all texts: one row per task and bucket is shuffled."""
    rows = texts.select("text").mapInArrow(_totals(vocabulary), "bucket long, n long").groupBy("bucket").agg(F.sum("n")).collect()
    totals = [0] * BUCKETS
    for bucket, n in rows:
        totals[bucket] = n
    return totals


def gains(corpus: list[int], target: list[int]) -> list[int]:
    """floor(1000 * ln of the smoothed share in the target over that in the corpus) per bucket."""
    total_s, total_t = sum(corpus), sum(target)
    return [
        math.floor(1000 * math.log(float(t + 1) * float(total_s + BUCKETS) / (float(s + 1) * float(total_t + BUCKETS))))
        for s, t in zip(corpus, target)
    ]


def _weights(vocabulary, gain):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        states, pairs = vocabulary.value
        per_bucket = np.array(gain.value, np.int64)
        for batch in slices(batches):
            counts, weights = [], []
            for text in batch.column("text").to_pylist():
                found = bucket_list(words_of(text), states, pairs)
                counts.append(len(found))
                weights.append(int(per_bucket[found].sum()) // len(found) if found else 0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(weights, pa.int64())], ["doc_id", "n_features", "weight"]
            )
    return run


def scored(spark: SparkSession, docs: DataFrame, target: DataFrame, seed: int = SEED, head_docs: int = HEAD_DOCS) -> DataFrame:
    """doc_id, n_features, weight and score of every document."""
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    vocabulary = spark.sparkContext.broadcast(_lookups(*head(ids, ids.count(), head_docs)))
    gain = spark.sparkContext.broadcast(gains(bucket_totals(ids, vocabulary), bucket_totals(target, vocabulary)))
    weighed = ids.mapInArrow(_weights(vocabulary, gain), "doc_id long, n_features long, weight long")
    h = f"conv(substr(sha2(concat('{seed}:', coalesce(string(doc_id), '')), 256), 1, 8), 16, 10)"
    noise = f"floor(-1000 * ln(-ln((double({h}) + 0.5D) / 4294967296D)))"
    return weighed.withColumn("score", F.expr(f"weight + {noise}"))


def resampled(
    spark: SparkSession, docs: DataFrame, target: DataFrame, percent: int = 25, min_words: int = 20, seed: int = SEED, head_docs: int = HEAD_DOCS
) -> DataFrame:
    """``scored`` with ``rank``: 1, 2, 3... for the ``percent`` of the long enough documents that are drawn, else null."""
    # n words have n features and n - 1 more of pairs
    rows = stored(scored(spark, docs, target, seed, head_docs).withColumn("fit", F.col("n_features") >= 2 * min_words - 1), "resampling-scores")
    per_score = rows.where("fit").groupBy("score").agg(F.count("*").alias("n"))
    above = Window.orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, -1)
    ranks = stored(per_score.withColumn("better", F.coalesce(F.sum("n").over(above), F.lit(0))), "resampling-ranks")
    wanted = percent * (ranks.agg(F.sum("n")).first()[0] or 0) // 100
    drawn = F.broadcast(ranks.where(F.col("better") < wanted).select("score", "better"))  # at most 130,000 rows
    fit = rows.where("fit").join(drawn, "score")
    place = F.row_number().over(Window.partitionBy("score").orderBy(F.asc_nulls_last("doc_id")))
    ranked = fit.withColumn("rank", F.col("better") + place).withColumn("rank", F.expr(f"CASE WHEN rank <= {wanted} THEN rank END")).drop("better")
    rest = rows.where("fit").join(drawn, "score", "left_anti").unionByName(rows.where("NOT fit")).withColumn("rank", F.lit(None).cast("long"))
    return ranked.unionByName(rest).select("doc_id", "n_features", "weight", "score", "rank")
