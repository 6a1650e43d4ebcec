"""Token counts of whole texts by a two-tier lookup.

A text is cut into pre-tokens, and its count is the sum of theirs. Counts of frequent
pre-tokens come from a compact table that every task gets; the others are encoded once per
task and remembered up to a bound. No pre-token is shuffled.

The table is filled from a bounded sample of documents and changes no result, only how often
the encoder runs. Texts of Latin and Greek characters are cut by a pattern, all
others by the tokenizer itself. Strings of added tokens inside a text are handled
as the tokenizer's default does: each is one token that also ends the text around it.

A null or empty text has no bytes and no tokens. Null and repeated ids stay as they are.
"""

from __future__ import annotations

import json
import re
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import slices

TOKENIZER = "byte_bpe_50k.json"
LIMIT = 512
# Documents and characters sampled for the table, and pre-tokens it holds.
SAMPLE_DOCUMENTS = 2_000
SAMPLE_CHARS = 2_000
TABLE_SIZE = 40_000
# A task starts its cache afresh when it would hold more than so many pre-tokens.
CACHED = 300_000
COUNTS = "doc_id long, n_bytes long, n_tokens long"
# Texts of these characters alone are cut by the standard library's engine, which agrees on
# them with the tokenizer's pattern and is twice as fast as one that knows all of Unicode.
_PLAIN = re.compile("[\t\n\r\x20-\x7e¡-¬®-±´-¸º»¿-ɏΑ-ΡΣ-ω‐-‧‰-⁞€]*")
_PIECES = re.compile(r"'(?:[stmd]|re|ve|ll)| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+")


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Encoder:
    """The tokenizer, and its pre-tokens' lengths as far as they are known."""

    def __init__(self, name: str, known: dict[str, int]):
        from tokenizers import Tokenizer

        path = tokenizer_path(name)
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        if spec["normalizer"] or spec["pre_tokenizer"] != {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}:
            raise ValueError(f"{name}: only byte-level tokenizers without normalizer are supported")
        added = spec["added_tokens"]
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in added):
            raise ValueError(f"{name}: added tokens that take in text around them are not supported")
        self.names = sorted((t["content"] for t in added), key=len, reverse=True)
        self.added = re.compile("|".join(map(re.escape, self.names)))
        self.frequent, self.known = known, dict(known)

    def parts(self, text: str) -> tuple[int, list[str]]:
        """Number of added tokens, and the texts between them."""
        if not any(name in text for name in self.names):
            return 0, [text]
        between = self.added.split(text)
        return len(between) - 1, between

    def pretokens(self, text: str) -> list[str]:
        if _PLAIN.fullmatch(text):
            return _PIECES.findall(text)
        return [text[a:b] for _, (a, b) in self.tokenizer.pre_tokenizer.pre_tokenize_str(text)]

    def lengths(self, wanted: list[str]) -> list[int]:
        return [len(e) for e in self.tokenizer.encode_batch_fast(wanted, add_special_tokens=False)]

    def counts(self, texts: list[str | None]) -> list[int]:
        known, get = self.known, self.known.get
        result, open_pieces = [], []
        for text in texts:
            n, parts = self.parts(text or "")
            unknown = []
            for part in parts:
                pieces = self.pretokens(part)
                sizes = list(map(get, pieces))
                if None in sizes:
                    unknown += [p for p, size in zip(pieces, sizes) if size is None]
                    n += sum(filter(None, sizes))
                else:
                    n += sum(sizes)
            result.append(n)
            open_pieces.append(unknown)
        fresh = list(set(chain.from_iterable(open_pieces)))
        if fresh:
            new = dict(zip(fresh, self.lengths(fresh)))
            result = [n + sum(map(new.__getitem__, unknown)) for n, unknown in zip(result, open_pieces)]
            if len(known) + len(new) > CACHED:
                self.known = dict(self.frequent)
            self.known.update(new)
        return result


def frequent_lengths(docs: DataFrame, name: str) -> dict[str, int]:
    """Lengths of the most frequent pre-tokens of the sample."""
    encoder = Encoder(name, {})
    rows = docs.where("length(text) > 0").select(F.substring("text", 1, SAMPLE_CHARS)).limit(SAMPLE_DOCUMENTS).collect()
    tally = Counter(p for (text,) in rows for p in encoder.pretokens(text))
    found = [p for p, _ in tally.most_common(TABLE_SIZE)]
    return {p: n for p, n in zip(found, encoder.lengths(found)) if encoder.parts(p)[0] == 0} if found else {}


def counter(name: str, shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(name, shared.value)
        for batch in slices(batches):
            sizes = encoder.counts(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_bytes"), pa.array(sizes, pa.int64())], ["doc_id", "n_bytes", "n_tokens"])
    return run


def token_counts(docs: DataFrame, tokenizer: str = TOKENIZER, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit per row of ``docs``."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"))
    shared = docs.sparkSession.sparkContext.broadcast(frequent_lengths(docs, tokenizer))
    return texts.mapInArrow(counter(tokenizer, shared), COUNTS).withColumn("over_limit", F.col("n_tokens") > limit)
