"""The toxicity kernel and features against plain computations, and accuracy on held-out rows."""

import math
import random
import zlib
from collections import defaultdict
from itertools import combinations

import numpy as np
import pytest

from tidemark.llm import toxicity
from tidemark.llm.common import table

SF = "/root/testdata/sf0.1"


def spans(word):
    """Every subsequence of three characters by its places, weighted by the length it spans."""
    found = defaultdict(float)
    for i, j, k in combinations(range(len(word)), 3):
        if j - i <= toxicity.SPAN and k - j <= toxicity.SPAN:
            found[word[i] + word[j] + word[k]] += toxicity.DECAY ** (k - i + 1)
    return found


def kernel(a, b):
    x, y = spans(a), spans(b)
    norm = math.sqrt(sum(v * v for v in x.values()) * sum(v * v for v in y.values()))
    return sum(v * y.get(s, 0.0) for s, v in x.items()) / norm if norm else 0.0


@pytest.mark.parametrize("seed", range(10))
def test_kernel_against_enumeration(seed):
    rng = random.Random(seed)
    draw = lambda n: ["".join(rng.choice("abcd") for _ in range(rng.randint(3, 12))) for _ in range(n)]
    marks = sorted(set(draw(12)))
    words = draw(60) + marks
    got = toxicity.Landmarks(marks).kernel(toxicity.characters(words))
    for i, word in enumerate(words):
        for j, mark in enumerate(marks):
            value = kernel(word, mark)
            if abs(value - toxicity.FLOOR) > 1e-4:
                assert got[i, j] == pytest.approx(value if value >= toxicity.FLOOR else 0.0, abs=1e-5)


def test_features_hold_the_best_word_and_all_words_against_the_length():
    marks = ["scoundrel", "rascal"]
    texts = ["a scoundrel, a scoundrel and a rascall of the town", "s c o u n d r e l", "", None, "nothing of the kind " * 500, "rascal " + "word " * 5000]
    got = toxicity.Reader(toxicity.Landmarks(marks)).features(texts)
    for row, text in zip(got, texts):
        counts = toxicity.words_of(text)
        for j, mark in enumerate(marks):
            each = [(max((v for v in (kernel(p, mark) for p in toxicity.parts_of(w)) if v >= toxicity.FLOOR), default=0.0), n) for w, n in counts.items()]
            total = sum(v * n for v, n in each)
            assert row[j] == pytest.approx(max((v for v, _ in each), default=0.0), abs=1e-5)
            assert row[len(marks) + j] == pytest.approx(total / (total + 1 + toxicity.RATE * sum(counts.values())), abs=1e-5)


def test_landmarks_are_unlike_each_other():
    got = toxicity.unlike(["scoundrel", "scoundrels", "rascal", "rascal", "ab"])
    assert got == ["scoundrel", "rascal"]
    assert all(kernel(a, b) < toxicity.ALIKE for a, b in combinations(got, 2))
    assert toxicity.unlike([]) == []


def test_held_out_rows(spark):
    """Nine of ten toxic rows are found, and nine of ten found ones are toxic; held-out rows were not learned from."""
    labels = {r.doc_id: r.toxic for r in table(spark, SF, "labels").select("doc_id", "toxic").collect()}
    rows = toxicity.scored(table(spark, SF, "documents"), table(spark, SF, "labels")).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    truth = np.array([labels[r.doc_id] for r in rows if r.held_out and r.doc_id in labels])
    told = np.array([r.predicted for r in rows if r.held_out and r.doc_id in labels])
    both = int((truth & told).sum())
    assert both >= 0.9 * truth.sum() and both >= 0.9 * told.sum()
