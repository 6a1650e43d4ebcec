"""SimHash tiles, importance resampling and collocations against brute force and on odd rows."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

from tidemark.llm import collocations as phrases
from tidemark.llm import importance_resampling as resampling
from tidemark.llm import simhash_tiles as simhash
from tidemark.llm.common import connected_components, stored
from tidemark.llm.queries import queries

DOCS = "doc_id long, text string, lang string, source string, n_chars long, value long, side int, rank long, phrase string, a long"


def documents(spark, *rows):
    """(doc_id, text) or (doc_id, text, lang), with further columns whose names operators use inside."""
    data = [(r[0], r[1], r[2] if len(r) > 2 else "en", "s", 1, 7, 7, 7, "x", 7) for r in rows]
    return spark.createDataFrame(data, DOCS)


def words(seed, n, letters="abcdefgh"):
    rng = random.Random(seed)
    return ["".join(rng.choice(letters) for _ in range(rng.randint(2, 6))) for _ in range(n)]


def components(pairs):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in parent}


# --- connected components ---


def test_components_of_hubs_and_chains(spark):
    pairs = [(5000, i) for i in range(10, 3000)] + [(i, i + 1) for i in range(6000, 6040)] + [(9, 5000), (1, 1), (6040, 10)]
    edges = spark.createDataFrame(pairs, "a long, b long")
    want = components([p for p in pairs if p[0] != p[1]])
    assert dict(map(tuple, connected_components(edges).collect())) == want
    assert connected_components(edges.limit(0)).count() == 0


# --- SimHash ---


def plain_fingerprint(text, size=3):
    found = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(found[i:i + size]) for i in range(len(found) - size + 1)] or ([" ".join(found)] if found else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("text", [None, "", " \t\n", "one", "One TWO", "a b c", "a b c d", "Ä ä É x y z", "x " * 9, " ".join(words(3, 400))])
def test_fingerprint(text):
    assert simhash.fingerprint(text, 3) % (1 << 64) == plain_fingerprint(text)


def test_fingerprint_of_a_very_long_text(monkeypatch):
    text = " ".join(words(4, 5000))
    whole = simhash.fingerprint(text, 3)
    monkeypatch.setattr(simhash, "SHINGLES_AT_ONCE", 100)
    assert simhash.fingerprint(text, 3) == whole


def near_values(n):
    rng = np.random.default_rng(5)
    base = rng.integers(0, 1 << 64, n, dtype=np.uint64)
    close = base[rng.integers(0, n, n)]
    for _ in range(3):
        close = close ^ (np.uint64(1) << rng.integers(0, 64, n).astype(np.uint64))
    return np.unique(np.concatenate([base, close, np.array([0, 7, (1 << 64) - 1], np.uint64)]))


def brute_components(values):
    i, j = np.nonzero(np.bitwise_count(values[:, None] ^ values[None, :]) <= 3)
    signed = values.view(np.int64).tolist()
    return components((signed[a], signed[b]) for a, b in zip(i.tolist(), j.tolist()) if a != b)


def test_tiles_miss_no_link_and_skip_pairs(monkeypatch):
    values = near_values(900)
    monkeypatch.setattr(simhash, "ROWS", 8)
    monkeypatch.setattr(simhash, "COLUMNS", 8)
    a, b = simhash.linked(values, np.empty(0, np.uint64), 3)
    assert components(zip(a.view(np.int64).tolist(), b.view(np.int64).tolist())) == brute_components(values)
    _, starts, low, high = simhash.cut(values, 8)
    gaps = np.maximum(np.maximum(low[:, None] - high, low - high[:, None]), 0).sum(axis=2)
    assert (gaps > 3).mean() > 0.5
    half = simhash.linked(values[::2], values[1::2], 3)
    signed = values.view(np.int64).tolist()
    across = {(x, y) for x, y in zip(*np.nonzero(np.bitwise_count(values[::2, None] ^ values[None, 1::2]) <= 3))}
    assert components(zip(half[0].view(np.int64).tolist(), half[1].view(np.int64).tolist())) == components(
        (signed[2 * x], signed[2 * y + 1]) for x, y in across
    )


@pytest.mark.parametrize("block, parts", [(1 << 16, 1), (60, 4)])
def test_links_for_any_number_of_parts(spark, block, parts, monkeypatch):
    monkeypatch.setattr(simhash, "PARTS", (parts,))
    values = near_values(250)
    df = stored(spark.createDataFrame([(v,) for v in values.view(np.int64).tolist()], "value long"), "test-values")
    assert dict(map(tuple, connected_components(simhash.links(df, 3, block)).collect())) == brute_components(values)


def test_steps_never_reach_another_tile():
    for parts in simhash.PARTS:
        most, base = 64 // parts, simhash.base(parts)
        assert base > most + 3 and base - 3 > most
        assert 0 in simhash.steps(parts, 3) and min(simhash.steps(parts, 3)) == 0
    assert [len(simhash.steps(p, 3)) for p in simhash.PARTS] == [4, 13, 65, 417]


def test_simhash_rows(spark):
    long = " ".join(words(7, 300))
    docs = documents(spark, (5, long), (3, long.upper()), (9, long + " extra"), (4, None), (8, "  "), (7, "a b c"), (None, long), (None, "q r s"), (5, long))
    got = sorted(map(tuple, simhash.near_duplicates(docs).collect()), key=str)
    same, near, short, other = (f"{plain_fingerprint(t):016x}" for t in (long, long + " extra", "a b c", "q r s"))
    joins = bin(int(same, 16) ^ int(near, 16)).count("1") <= 3
    assert got == sorted([
        (5, same, 3), (5, same, 3), (3, same, 3), (None, same, 3), (9, near, 3 if joins else 9), (4, "0" * 16, 4), (8, "0" * 16, 4), (7, short, 7),
        (None, other, None),
    ], key=str)
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


def test_simhash_query_against_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    texts = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    prints = {i: plain_fingerprint(t) for i, t in texts}
    linked = components((a, b) for a in prints for b in prints if bin(prints[a] ^ prints[b]).count("1") <= 3)
    got = {tuple(r) for r in queries()["op11_simhash_dedup"](spark, sf).collect()}
    assert got == {(i, f"{p:016x}", linked[i]) for i, p in prints.items()} and len(got) == len(texts)


# --- importance resampling ---


def test_buckets_with_and_without_a_head():
    text = "The cat sat; the CAT's Ñandú 42 x\x00y"
    found = resampling.words_of(text)
    assert found == [w.encode() for w in ("the", "cat", "sat", "the", "cat", "s", "Ñandú", "42", "x", "y")]
    features = found + [a + b" " + b for a, b in zip(found, found[1:])]
    want = [zlib.crc32(f) % 10_000 for f in features]
    states, pairs = resampling._lookups([b"the", b"cat"], [b"the cat", b"42 x"])
    assert resampling.bucket_list(found, {}, {}) == want == resampling.bucket_list(found, states, pairs)
    assert resampling.words_of(None) == [] == resampling.bucket_list([], states, pairs)


def test_resampling_rows(spark):
    texts = [(i, " ".join(words(i, 30))) for i in range(40)]
    docs = documents(spark, *texts, (50, None), (51, "too short"), (None, " ".join(words(60, 30))), (3, texts[3][1]))
    target = spark.createDataFrame([(1, texts[0][1]), (2, None)], "item_id long, text string")
    got = resampling.resampled(spark, docs, target).collect()
    assert len(got) == 44
    drawn = sorted((r.rank, -r.score) for r in got if r.rank is not None)
    assert [d[0] for d in drawn] == list(range(1, 25 * 42 // 100 + 1)) and [d[1] for d in drawn] == sorted(d[1] for d in drawn)
    assert max(-d[1] for d in drawn) >= max(r.score for r in got if r.rank is None and r.n_features >= 39)
    by_id = {r.doc_id: r for r in got}
    assert (by_id[50].n_features, by_id[50].weight, by_id[50].rank) == (0, 0, None)
    assert (by_id[51].n_features, by_id[51].rank) == (3, None)
    assert by_id[0].weight > max(r.weight for r in got if r.doc_id not in (0, 50))
    other = resampling.resampled(spark, docs, target, head_docs=1).collect()  # another head
    assert sorted(map(str, got)) == sorted(map(str, other))
    assert resampling.resampled(spark, docs.limit(0), target).count() == 0
    assert resampling.resampled(spark, docs, target.limit(0)).count() == 44


def test_ties_go_to_the_smaller_id(spark, monkeypatch):
    monkeypatch.setattr(resampling, "gains", lambda corpus, target: [0] * resampling.BUCKETS)
    text = " ".join(words(1, 30))
    docs = documents(spark, *[(7, text)] * 6, *[(i, text) for i in range(100, 102)])
    got = resampling.resampled(spark, docs, spark.createDataFrame([(text,)], "text string"), percent=100).collect()
    assert sorted(r.rank for r in got) == list(range(1, 9)) and len({r.score for r in got if r.doc_id == 7}) == 1


# --- collocations ---


def brute_collocations(rows, least, longest=4, share=80, top=2000):
    counts, totals = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            found = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(found)
            for n in range(1, longest + 1):
                counts[lang].update(tuple(found[i:i + n]) for i in range(len(found) - n + 1))
    out = []
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        kept = []
        for p, a in candidates.items():
            inside = any(
                len(q) > len(p) and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1)) and 100 * b >= share * a
                for q, b in candidates.items()
            )
            if not inside:
                score, k = min((2000000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
                kept.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(out)


def prose(seed, n):
    rng, vocabulary = random.Random(seed), words(seed, 25, "abcé")
    out = []
    for _ in range(n):
        out.append(rng.choice(["alpha beta", "alpha beta gamma", "New\tYork  City", rng.choice(vocabulary), rng.choice(vocabulary)]))
        out.append(rng.choice([" ", " ", " ", "  ", ". ", ",", "\n", "!?"]))
    return "".join(out)


@pytest.fixture(scope="module")
def mixed_texts():
    odd = [(None, "en"), ("", "en"), ("  \t", None), ("x" * 200 + " " + "x" * 200 + " " + "x" * 199, "de"), ("...", "de"), ("alpha beta", None)]
    return [(prose(i % 4, 120), ["en", "en", "de", None, "und"][i % 5]) for i in range(40)] + odd * 3


@pytest.mark.parametrize("bits, chunk", [(64, 1 << 21), (64, 500), (9, 1 << 21), (3, 2000)])
def test_collocations_against_brute_force(spark, mixed_texts, bits, chunk):
    """Few bits make nearly all fingerprints collide; the text has to tell them apart."""
    docs = documents(spark, *[(1, text, lang) for text, lang in mixed_texts])
    got = phrases.collocations(spark, docs, least=3, top=60, chunk=chunk, bits=bits)
    assert sorted(map(tuple, got.collect())) == brute_collocations(mixed_texts, 3, top=60)


def test_text_leaves_the_tasks_by_word_not_by_phrase(spark, monkeypatch):
    """Every task holds every phrase here; rows with text must not grow with tasks times phrases."""
    vocabulary = [f"w{i}" for i in range(12)]
    rng = random.Random(5)
    rows = [(" ".join(rng.choice(vocabulary) for _ in range(400)), "en") for _ in range(24)]
    docs = documents(spark, *[(1, text, lang) for text, lang in rows]).repartition(12)
    texts, apply = {}, type(docs).mapInArrow

    def recorded(self, func, schema, *rest):
        out = apply(self, func, schema, *rest)
        if "binary" in schema:
            texts[schema] = out.count()
        return out

    monkeypatch.setattr(type(docs), "mapInArrow", recorded)
    found, _ = phrases.frequent_phrases(spark, docs, 3, 4)
    counts = Counter(r.words for r in found.collect())
    assert counts[1] == 12 and counts[2] == 144 and counts[3] > 500
    assert 0 < sum(texts.values()) <= 12 * len(vocabulary)


def test_words_that_share_a_number_get_numbers_of_their_own(spark):
    rows = [("en", b"rare", 7, 2), ("en", b"often", 7, 40), ("de", b"often", 7, 30), ("en", b"alone", 9, 50), ("en", b"seldom", 8, 1)]
    counted = spark.createDataFrame([(lang, bytearray(word), number, f) for lang, word, number, f in rows], "lang string, word binary, number long, f long")
    vocabulary, (shared, renamed) = phrases.numbered_words(spark, counted, 30)
    assert shared.tolist() == [7] and sorted(renamed) == [("de", b"often"), ("en", b"often")]
    got = {(r.lang, r.word): r.number for r in vocabulary.collect()}
    assert got == {("en", "alone"): 9, ("de", "often"): 1 << 31, ("en", "often"): (1 << 31) + 1}


def test_collocations_of_nothing(spark):
    docs = documents(spark, (1, None), (2, "a b"))
    assert phrases.collocations(spark, docs).count() == 0 == phrases.collocations(spark, docs.limit(0)).count()


def test_cutting_a_long_text_keeps_pieces_whole():
    raw = ("abc def. " * 300).encode() + b"z" * 5000 + b". end"
    runs = list(phrases._cut("en", raw, 100))
    assert len(runs) > 5 and [w for _, r in runs for w in r.replace(b".", b" ").split()] == raw.replace(b".", b" ").split()


def test_very_long_words_are_compared_whole():
    part = phrases.Chunk(b" ".join([b"w" * 100 + b"a", b"w" * 100 + b"b", b"w" * 100 + b"a", b"x"]), "en", phrases.Powers(), 64)
    assert part.word_ids(np.zeros(4, np.uint64)).tolist() == [0, 1, 0, 3]


# --- executors without the package ---

_CHILD = """
import json, os, shutil, sys
sys.path.insert(0, sys.argv[1])
from tidemark.llm.queries import queries
from tidemark.session import build_session
spark = build_session("away", "local-cluster[1,2,1024]", **{
    "spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "2", "spark.checkpoint.dir": sys.argv[2], "spark.executor.memory": "1024m",
    "spark.ui.showConsoleProgress": "false"})
spark.sparkContext.setLogLevel("OFF")
away = spark.range(1).mapInArrow(lambda batches: (batches.__class__, __import__("tidemark"))[0:0] or batches, "id long")
try:
    away.count()
    raise SystemExit("the workers find the package, so this shows nothing")
except Exception as error:
    assert "tidemark" in str(error)
found = queries()
print(json.dumps({name: found[name](spark, sys.argv[3]).count() for name in sys.argv[4:]}))
"""


def test_queries_run_where_workers_lack_the_package(tmp_path):
    """Functions travel by value and broadcasts hold plain values, so only the driver needs the package."""
    import json
    import os
    import subprocess
    import sys

    names = ["op8_url_rules", "op10_toxicity", "op11_simhash_dedup", "op12_importance_resampling", "op13_collocations", "op1_html_text", "op9_kdtree_topk"]
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    child = tmp_path / "child.py"
    child.write_text(_CHILD)
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run(
        [sys.executable, str(child), root, f"{tmp_path}/shared", "/root/testdata/sf0.001", *names], capture_output=True, text=True, env=env,
        cwd=tmp_path, timeout=600,
    )
    assert done.returncode == 0, done.stderr[-2000:] + done.stdout[-500:]
    counts = json.loads(done.stdout.strip().splitlines()[-1])
    assert counts["op10_toxicity"] == counts["op11_simhash_dedup"] == counts["op12_importance_resampling"] > 0 and counts["op8_url_rules"] > 0 and counts["op9_kdtree_topk"] > 0


# --- repeated ids ---


def test_rows_of_one_id_are_one_document(spark):
    from tidemark.llm import minmax_dedup

    a, b, c = (" ".join(words(s, 80)) for s in (71, 72, 73))
    docs = documents(spark, (5, a), (5, b), (9, b), (4, a), (5, None), (7, c), (6, c), (7, a + " tail"))
    got = sorted(tuple(r)[::2] for r in minmax_dedup.near_duplicates(docs).collect())
    assert got == sorted([(5, 4), (5, 4), (9, 4), (4, 4), (5, 5), (7, 4), (6, 4), (7, 4)])
