"""Toxic documents by a subsequence string kernel, Nyström landmarks and a linear SVM.

The kernel of two words is the gap-weighted subsequence kernel: both are mapped to all their
subsequences of three characters whose neighbours are at most ``SPAN`` places apart, each
weighted by ``DECAY`` to the length it spans, and the kernel is the cosine of these. A word with
inserted, left out or exchanged characters still shares most subsequences with its original.

Landmarks are words, and beginnings of words, that stand in more of the toxic training documents
than chance explains: by ``LEAST_Z`` standard errors and ``LEAST_RATIO`` times as often. They are
taken by falling significance, none too like one taken before. A document gives two values per
landmark: the largest kernel among its words, so that one insult counts in a text of any length,
and the kernels of all its words, repeats included, held against its length, for insults that are
made of common parts and tell only by their number. Nyström's map (the inverse root of the
landmarks' own kernel matrix) turns both into features of a linear SVM, whose margin a logistic
curve, fitted on the same documents, turns into a score.

Words are cut at white space, lower-cased, stripped of marks at both ends and read with common
character swaps undone; runs of single characters are joined to a word as well. Long words are
read in overlapping parts, so every character of a text takes part.

Training uses at most ``TRAINING_ROWS`` labelled rows, the first by a hash of their id; texts,
never label, language, source or id, are inputs. Scores exist for all rows: a null or empty text
has no word and gets the score of a text without any toxic one. Without usable labels (none at
all, or only one kind) every score is 0. Repeated rows are scored alike; a document labelled
twice is toxic if any label says so.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import slices, stored

TRAINING_ROWS = 20_000
LANDMARKS = 160
# A landmark stands in at least so many toxic documents of the training rows; their number lies so
# many standard errors above what the share of all documents gives, and is so many times that of
# clean ones, relative to the numbers of both. So many candidates are looked at, by significance.
LEAST_TOXIC, LEAST_Z, LEAST_RATIO = 3, 5.0, 3.0
CANDIDATES, ALIKE = 4_000, 0.8
# Beginnings of words that are candidates, by length.
STEMS = (5, 6, 7, 8)
# Kernels count for half of what they can when they sum up to one and this share of the words.
RATE = 0.01
SPAN, DECAY = 2, 0.6
WORD, OVERLAP = 24, 12
SHORT = 10
# Kernel values below this count as none: unrelated words of one language reach it by chance.
FLOOR = 0.5
CACHED_WORDS = 150_000
# So many words are held against all landmarks at once (30 MB).
KERNEL_ROWS = 500
THRESHOLD = 0.3
HELD_OUT = "pmod(crc32(cast(cast(doc_id as string) as binary)), 4) = 2"

# Characters that stand in for letters.
SWAPS = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"})
_SINGLES = re.compile(r"(?<!\S)\S(?:\s+\S){2,}(?!\S)")
_EDGES = "".join(map(chr, [*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127), 0xAB, 0xBB, 0xA1, 0xBF, *range(0x2010, 0x2028)]))
_GAPS = [(a, b) for a in range(1, SPAN + 1) for b in range(1, SPAN + 1)]


def words_of(text: str | None) -> dict[str, int]:
    """Words of a text and its joined runs of single characters, with their numbers."""
    lowered = (text or "").lower()
    found: dict[str, int] = {}
    for word, n in Counter(lowered.split()).items():
        word = word.rstrip(",.;:")
        found[word] = found.get(word, 0) + n
    for run in _SINGLES.findall(lowered):
        word = "".join(run.split())
        found[word] = found.get(word, 0) + 1
    return found


def parts_of(word: str) -> list[str]:
    plain = word if word.isalpha() else word.strip(_EDGES).translate(SWAPS)
    if len(plain) <= WORD:
        return [plain] if len(plain) > 2 else []
    return [plain[i:i + WORD] for i in range(0, len(plain) - OVERLAP, WORD - OVERLAP)]


def characters(parts: list[str], width: int = WORD) -> np.ndarray:
    """One row per part: letters as 1 to 26, other characters spread over 27 to 62, 0 beyond the end."""
    raw = np.frombuffer("".join(p.ljust(width, "\0") for p in parts).encode("utf-32-le", "surrogatepass"), np.uint32)
    letters = (raw >= 97) & (raw <= 122)
    return np.where(letters, raw - 96, np.where(raw == 0, 0, 27 + raw % 36)).astype(np.int32).reshape(len(parts), width)


def subsequences(chars: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(codes, weights) of all subsequences of each row; code 0 where there is none."""
    n = chars.shape[1]
    wide = np.pad(chars, ((0, 0), (0, 2 * SPAN)))
    high, middle = chars * 4096, wide * 64
    codes, weights = [], []
    for a, b in _GAPS:
        third = wide[:, a + b:a + b + n]
        codes.append((high + middle[:, a:a + n] + third) * (third > 0))
        weights.append(np.full(n, DECAY ** (a + b + 1), np.float32))
    return np.concatenate(codes, axis=1), np.concatenate(weights)


def vectors(chars: np.ndarray) -> list[dict[int, float]]:
    codes, weights = subsequences(chars)
    result = []
    for row in codes:
        kept = row > 0
        values, place = np.unique(row[kept], return_inverse=True)
        total = np.bincount(place, weights[kept], len(values))
        result.append(dict(zip(values.tolist(), (total / max(np.linalg.norm(total), 1e-9)).tolist())))
    return result


class Landmarks:
    """Kernel values of words with a fixed list of landmark words."""

    def __init__(self, words: list[str]):
        self.words = words
        found = vectors(characters(words))
        codes = sorted({c for v in found for c in v})
        self.row = np.zeros(64 ** 3, np.int32)
        self.row[codes] = np.arange(1, len(codes) + 1)
        self.matrix = np.zeros((len(codes) + 1, len(words)), np.float32)
        for j, v in enumerate(found):
            for c, value in v.items():
                self.matrix[self.row[c], j] = value

        self.most = np.zeros(64 ** 3, np.float32)
        self.most[codes] = self.matrix[1:].max(axis=1) if codes else 0

    def kernel(self, chars: np.ndarray) -> np.ndarray:
        """Kernel of each row with each landmark; values below the floor are 0.

        Rows are dropped by upper bounds first: by the largest weight any landmark gives
        each subsequence, then by a norm that leaves out repeated subsequences.
        """
        codes, weights = subsequences(chars)
        out = np.zeros((len(chars), len(self.words)), np.float32)
        least = np.sqrt((codes > 0) @ (weights ** 2))
        near = np.flatnonzero(self.most[codes] @ weights >= FLOOR * least)
        for start in range(0, len(near), KERNEL_ROWS):
            at = near[start:start + KERNEL_ROWS]
            at = at[least[at] > 0]
            rows = self.row[codes[at]]
            word, place = np.nonzero(rows)
            if not len(word):
                continue
            cuts = np.flatnonzero(np.diff(word, prepend=-1))
            hit = self.matrix[rows[word, place]] * weights[place][:, None]
            found = np.add.reduceat(hit, cuts, axis=0)
            at = at[word[cuts]]
            close = (found >= FLOOR * least[at][:, None]).any(axis=1)
            at, found = at[close], found[close]
            if len(at):
                found /= self._norms(codes[at], weights)[:, None]
                out[at] = np.where(found >= FLOOR, found, 0)
        return out

    @staticmethod
    def _norms(codes: np.ndarray, weights: np.ndarray) -> np.ndarray:
        order = np.argsort(codes, axis=1)
        sorted_codes = np.take_along_axis(codes, order, axis=1)
        value = np.where(sorted_codes > 0, weights[order], 0).ravel()
        fresh = np.ones(sorted_codes.shape, bool)
        fresh[:, 1:] = sorted_codes[:, 1:] != sorted_codes[:, :-1]
        cuts = np.flatnonzero(fresh.ravel())
        sums = np.add.reduceat(value, cuts) ** 2
        return np.sqrt(np.bincount(cuts // codes.shape[1], sums, len(codes)))


class Reader:
    """Kernel values of whole documents; words met before are remembered up to a bound."""

    def __init__(self, landmarks: Landmarks):
        self.landmarks = landmarks
        self.known: dict[str, int] = {}
        self.rows: list[np.ndarray] = [np.zeros(len(landmarks.words), np.float32)]

    def features(self, texts: list[str | None]) -> np.ndarray:
        documents = [words_of(t) for t in texts]
        fresh = list(set().union(*documents) - self.known.keys()) if documents else []
        if len(self.known) + len(fresh) > CACHED_WORDS:
            fresh = list(set().union(*documents))
            self.known, self.rows = {}, self.rows[:1]
        for start in range(0, len(fresh), 8_000):
            self._learn(fresh[start:start + 8_000])
        size = len(self.landmarks.words)
        result = np.zeros((len(texts), 2 * size), np.float32)
        for i, words in enumerate(documents):
            hits = [(at, n) for at, n in ((self.known[w], n) for w, n in words.items()) if at]
            if hits:
                rows = np.stack([self.rows[at] for at, _ in hits])
                sums = np.array([n for _, n in hits], np.float32) @ rows
                result[i, :size] = rows.max(axis=0)
                result[i, size:] = sums / (sums + 1 + RATE * sum(words.values()))
        return result

    def _learn(self, words: list[str]) -> None:
        parts, owners = [], []
        for i, word in enumerate(words):
            if word.isalpha() and len(word) <= WORD:
                if len(word) > 2:
                    parts.append(word)
                    owners.append(i)
                continue
            for part in parts_of(word):
                parts.append(part)
                owners.append(i)
        self.known.update(dict.fromkeys(words, 0))
        if not parts:
            return
        lengths = np.array([len(p) for p in parts])
        for least, width in ((0, SHORT), (SHORT, WORD)):
            chosen = np.flatnonzero((lengths > least) & (lengths <= width))
            values = self.landmarks.kernel(characters([parts[i] for i in chosen], width)) if len(chosen) else np.zeros((0, 1))
            for i in np.flatnonzero(values.any(axis=1)):
                word = words[owners[chosen[i]]]
                if self.known[word]:
                    self.rows[self.known[word]] = np.maximum(self.rows[self.known[word]], values[i])
                else:
                    self.known[word] = len(self.rows)
                    self.rows.append(values[i])


class Model:
    """Weights per landmark (Nyström's map folded in), and the logistic curve of the margin."""

    def __init__(self, landmarks: Landmarks, features: np.ndarray, toxic: np.ndarray):
        own = landmarks.kernel(characters(landmarks.words)).astype(np.float64)
        values, base = np.linalg.eigh((own + own.T) / 2)
        root = base @ np.diag(1 / np.sqrt(np.maximum(values, 1e-3))) @ base.T
        size = len(landmarks.words)
        mapped = np.hstack([features[:, :size].astype(np.float64) @ root, features[:, size:].astype(np.float64) @ root])
        weights, self.bias = svm(mapped, toxic)
        self.landmarks, self.weights = landmarks, np.concatenate([root @ weights[:size], root @ weights[size:]])
        self.slope, self.shift = logistic(self.margin(features), toxic)

    def plain(self) -> tuple:
        """Values only, as broadcasts are pickled by reference and workers may lack this module."""
        return self.landmarks.words, self.weights, self.bias, self.slope, self.shift

    @classmethod
    def of(cls, plain: tuple) -> Model:
        model = cls.__new__(cls)
        words, model.weights, model.bias, model.slope, model.shift = plain
        model.landmarks = Landmarks(words)
        return model

    def margin(self, features: np.ndarray) -> np.ndarray:
        return features.astype(np.float64) @ self.weights + self.bias

    def scores(self, features: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.margin(features) + self.shift, -30, 30)))


def svm(x: np.ndarray, toxic: np.ndarray, cost: float = 1.0, rounds: int = 50) -> tuple[np.ndarray, float]:
    """Linear SVM with squared hinge loss, both classes weighted alike, by Newton's method."""
    y = np.where(toxic, 1.0, -1.0)
    share = np.where(toxic, 0.5 / max(toxic.sum(), 1), 0.5 / max((~toxic).sum(), 1)) * len(y) * cost
    z = np.hstack([x, np.ones((len(x), 1))])
    ridge = np.ones(z.shape[1])
    ridge[-1] = 1e-6
    w = np.zeros(z.shape[1])
    for _ in range(rounds):
        slack = 1 - y * (z @ w)
        active = slack > 0
        za, sa = z[active], share[active]
        step = np.linalg.solve((za * sa[:, None]).T @ za + np.diag(ridge), ridge * w - za.T @ (sa * y[active] * slack[active]))
        w = w - step
        if np.abs(step).max() < 1e-8:
            break
    return w[:-1], float(w[-1])


def logistic(margin: np.ndarray, toxic: np.ndarray, rounds: int = 50) -> tuple[float, float]:
    """Platt's curve: slope and shift that fit smoothed labels, by damped Newton steps."""
    n1, n0 = toxic.sum(), (~toxic).sum()
    goal = np.where(toxic, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    z = np.stack([margin, np.ones_like(margin)], axis=1)
    w = np.array([1.0, np.log((n1 + 1) / (n0 + 1))])
    loss = lambda v: np.sum(np.logaddexp(0, z @ v) - goal * (z @ v))
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        hessian = (z * (p * (1 - p))[:, None]).T @ z + 1e-6 * np.eye(2)
        step, size = np.linalg.solve(hessian, z.T @ (p - goal)), 1.0
        while size > 1e-4 and loss(w - size * step) > loss(w):
            size /= 2
        w = w - size * step
    return float(w[0]), float(w[1])


def training_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, toxic) of the bounded sample of labelled rows that may be learned from."""
    usable = labels.select(F.col("doc_id").cast("long").alias("doc_id"), "toxic").where(f"doc_id IS NOT NULL AND toxic IS NOT NULL AND NOT ({HELD_OUT})")
    once = usable.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    return once.orderBy(F.xxhash64("doc_id"), "doc_id").limit(TRAINING_ROWS)


def _tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct landmark candidates of each document."""
    for batch in slices(batches):
        for label, text in zip(batch.column("toxic").to_pylist(), batch.column("text").to_pylist()):
            parts = {p for w in words_of(text) for p in parts_of(w)}
            words = sorted(parts | {p[:n] for p in parts for n in STEMS if len(p) > n})
            yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array([label] * len(words), pa.int32())], ["word", "toxic"])


def _featurizer(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(Landmarks(shared.value))
        for batch in slices(batches):
            found = reader.features(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([pa.array([r.tobytes() for r in found], pa.binary()), batch.column("toxic")], ["features", "toxic"])
    return run


def unlike(words: list[str]) -> list[str]:
    """At most ``LANDMARKS`` of ``words``, in order, without those too like one taken before."""
    found, taken = vectors(characters(words)) if words else [], []
    for i, own in enumerate(found):
        if len(taken) == LANDMARKS:
            break
        if own and all(sum(v * found[j].get(c, 0.0) for c, v in own.items()) < ALIKE for j in taken):
            taken.append(i)
    return [words[i] for i in taken]


def train(docs: DataFrame, labels: DataFrame) -> Model | None:
    """Fits the model, or returns None if the labels do not show both kinds."""
    sample = F.broadcast(stored(training_rows(docs, labels), "toxicity-sample"))  # at most TRAINING_ROWS ids
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(sample, "doc_id").select("text", "toxic")
    texts = stored(texts, "toxicity-texts")
    kinds = {r["toxic"]: r["n"] for r in texts.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if not kinds.get(0) or not kinds.get(1):
        return None
    counts = texts.mapInArrow(_tokens, "word string, toxic int").groupBy("word").agg(F.sum("toxic").alias("bad"), F.sum(1 - F.col("toxic")).alias("good"))
    share = F.expr(f"(bad + good) / {float(kinds[0] + kinds[1])}")
    error = F.sqrt(kinds[1] * share * (1 - share) + 1e-9)
    picked = counts.withColumn("z", F.round((F.col("bad") - kinds[1] * share) / error, 6))
    picked = picked.where(f"bad >= {LEAST_TOXIC} AND z >= {LEAST_Z} AND bad * {kinds[0]}D >= {LEAST_RATIO} * good * {kinds[1]}D")
    words = unlike([r["word"] for r in picked.orderBy(F.desc("z"), "word").limit(CANDIDATES).collect()])
    if not words:
        return None
    shared = docs.sparkSession.sparkContext.broadcast(words)
    rows = texts.mapInArrow(_featurizer(shared), "features binary, toxic int").collect()
    features = np.stack([np.frombuffer(r["features"], np.float32) for r in rows])
    return Model(Landmarks(words), features, np.array([r["toxic"] == 1 for r in rows]))


def _scorer(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model.of(shared.value) if shared.value else None
        reader = Reader(model.landmarks) if model else None
        for batch in slices(batches):
            texts = batch.column("text").to_pylist()
            scores = model.scores(reader.features(texts)) if model else np.zeros(len(texts))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())], [*batch.schema.names, "score"])
    return run


def _shared(docs: DataFrame, labels: DataFrame):
    model = train(docs, labels)
    return docs.sparkSession.sparkContext.broadcast(model.plain() if model else None)


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted (1 at ``THRESHOLD`` or more) per row of ``docs``."""
    model = _shared(docs, labels)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = texts.mapInArrow(_scorer(model), "doc_id long, text string, score double")
    return rows.select("doc_id", F.coalesce(F.expr(HELD_OUT), F.lit(False)).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the rows whose text is predicted toxic."""
    model = _shared(docs, labels)
    names = [f"_{i}" if n != "text" else "text" for i, n in enumerate(docs.columns)]
    schema = ", ".join(f"{n} {kind}" for n, (_, kind) in zip(names, docs.dtypes)) + ", score double"
    rows = docs.toDF(*names).mapInArrow(_scorer(model), schema).where(F.col("score") < THRESHOLD)
    return rows.select(*[F.col(n).alias(c) for n, c in zip(names, docs.columns)])
