"""Edge rows of every operator against brute force or a defined result."""

import base64
import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import (
    extendible_shards, html_text, kdtree_topk, minmax_dedup, poisson_mix, qgram_decontamination as qgrams, token_counts, toxicity, url_rules, warc,
)

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, size long, shard string"


def documents(spark, *pairs):
    data = [(i, t, "en", s, len(t or ""), 0.5, 7, "x") for i, t, s in pairs]
    return spark.createDataFrame(data, DOCS)


def words(seed, n):
    rng = random.Random(seed)
    return ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(3, 8))) for _ in range(n)]


# --- HTML ---

@pytest.mark.parametrize("page, text", [
    (None, ""), ("", ""), ("<p>a<p>b", "a b"), ("plain &amp; &lt;text&gt;", "plain & <text>"),
    ("<script>if(a<b){}</script><p>x<b>y</b> z<br>w</p>", "xy z w"),
    ("<body><nav><a href=x>menu</a></nav><article><h1>T</h1><p>one  two\n three</p><p>.</p></article><footer>f</footer>", "T one two three ."),
    ("<body><div class='menu'><a href=x>m</a></div><div><h1>T</h1><section><p>one two three four</p></section><section><p>five six seven"
     " eight</p></section><div class=comments><p>bad</p></div></div><div id='site-footer'>foot</div></body>", "T one two three four five six seven eight"),
    ("<!-- no -->yes<!-- open", "yes"), ("<div>" * 5000 + "deep", "deep"),
])
def test_main_text(page, text):
    assert html_text.main_text(page) == text


def test_extracted_rows(spark):
    pages = spark.createDataFrame([(1, None, None, "t"), (None, "u", "<p>a", "t"), (1, None, None, "t")], "page_id long, url string, html string, text string")
    got = sorted(map(tuple, html_text.extracted(pages).collect()), key=str)
    assert got == sorted([(1, None, "", 0), (1, None, "", 0), (None, "u", "a", 1)], key=str)
    assert html_text.extracted(pages.limit(0)).count() == 0


# --- decontamination ---

def edited(text, edits, seed):
    rng, out = random.Random(seed), list(text)
    for _ in range(edits):
        at = rng.randrange(len(out))
        kind = rng.randrange(3)
        if kind == 0:
            out[at] = "z"
        elif kind == 1:
            out.insert(at, "q")
        else:
            del out[at]
    return "".join(out)


def least_edits(item, text):
    """Edits of the best place of an item in a text, by the full table."""
    row = np.zeros(len(text) + 1, int)
    steps = np.arange(len(text) + 1)
    for i, c in enumerate(item, 1):
        match = row[:-1] + np.array([c != t for t in text], int)
        new = np.concatenate([[i], np.minimum(match, row[1:] + 1)])
        row = np.minimum.accumulate(new - steps) + steps
    return int(row.min())


def test_matches_equal_the_full_alignment(spark):
    items = {i: " ".join(words(i, 12 + i)) for i in range(4)}
    docs, expected = [], set()
    for d in range(30):
        item = d % 4
        edits = d % 5 * qgrams.edit_budget(len(items[item])) // 2
        text = " ".join(words(100 + d, 40)) + " " + edited(items[item], edits, d) + " " + " ".join(words(200 + d, 30))
        docs.append((d, text.replace(" a", ",  A"), "s"))
        plain = "".join(map(chr, qgrams.codes(docs[-1][1])))
        expected |= {(d, i) for i, t in items.items() if least_edits(t, plain) <= qgrams.edit_budget(len(t))}
    odd = [(50, None, "s"), (51, "", "s"), (None, items[0], "s"), (52, items[1] * 40, "s"), (53, items[1], "s"), (53, items[1], "s")]
    benchmark = spark.createDataFrame([*items.items(), (9, None), (10, ""), (11, "ab")], "item_id long, text string")
    table = documents(spark, *docs, *odd)
    found = qgrams.matches(table, benchmark).collect()
    got = {(r.doc_id, r.item_id) for r in found}
    assert {g for g in got if g[0] is not None and g[0] < 50} == expected and expected
    assert {(None, 0), (52, 1), (53, 1)} <= got and not {50, 51} & {g[0] for g in got}
    kept = qgrams.decontaminated(table, benchmark)
    assert kept.columns == table.columns
    assert {r.doc_id for r in kept.collect()} == {d for d, _, _ in [*docs, *odd] if d not in {g[0] for g in got if g[0] is not None}}
    assert qgrams.matches(table, benchmark.limit(0)).count() == 0 and qgrams.matches(table.limit(0), benchmark).count() == 0


@pytest.mark.parametrize("hits", [50, 2_000_000])
def test_repetitive_texts_are_matched_in_parts(monkeypatch, hits):
    monkeypatch.setattr(qgrams, "HITS", hits)
    index = qgrams.Index([(1, "ab" * 60), (2, "ab" * 60), (3, "some other passage of a plain kind")])
    texts = ["ab" * 500, "x" * 900, "", None, "zz " + "ab" * 60 + " and some other passage of a plain kind"]
    found = {(d, i) for d, i, *_ in qgrams.scan(index, [1, 2, 3, 4, 5], texts)}
    assert found == {(1, 1), (1, 2), (5, 1), (5, 2), (5, 3)}


# --- WARC ---

def test_warc_round_trip(spark):
    rows = [(1, "http://a/\r\nx", None), (2, None, ""), (3, "u", "a\r\n\r\nb é"), (4, "u", "a\r\n\r\nb é"), (4, "u", "a\r\n\r\nb é"), (None, "u", "z"), (5, "u", "x" * 300_000)]
    got = warc.round_trip(spark.createDataFrame([(*r, "t") for r in rows], "page_id long, url string, html string, digest string")).collect()
    sha1 = lambda t: base64.b32encode(hashlib.sha1(t.encode()).digest()).decode()
    same = "a\r\n\r\nb é"
    expected = [
        (1, 0, sha1(""), "revisit", 2), (2, 0, sha1(""), "response", None), (3, 9, sha1(same), "revisit", 4), (4, 9, sha1(same), "revisit", 4),
        (4, 9, sha1(same), "response", None), (None, 1, sha1("z"), "response", None), (5, 300_000, sha1("x" * 300_000), "response", None),
    ]
    assert sorted(map(tuple, got), key=str) == sorted(expected, key=str)


# --- near duplicates ---

def reached(sets, percent):
    label = {d: d for d in sets}
    changed = True
    while changed:
        changed = False
        for a in sets:
            for b in sets:
                k = len(sets[a] & sets[b])
                if k and 100 * k >= percent * len(sets[a] | sets[b]) and label[a] > label[b]:
                    label[a], changed = label[b], True
    return label


@pytest.mark.parametrize("block", [1_000_000, 200])
def test_near_duplicates_equal_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(minmax_dedup, "BLOCK_SHINGLES", block)
    base, docs = words(1, 60), []
    rng = random.Random(3)
    for d in range(60):
        own = list(base)
        for _ in range(rng.randint(0, 5)):
            own[rng.randrange(60)] = words(1000 + d, 1)[0]
        docs.append((d, " ".join(own).upper() if d % 7 == 0 else "\t".join(own), "s"))
    docs += [(100, "a b", "s"), (101, "A  b", "s"), (102, "", "s"), (103, None, "s"), (104, " \n", "s"), (105, " ".join(words(9, 5000)), "s")]
    sets = {}
    for d, text, _ in docs:
        w = (text or "").encode().lower().split()
        sets[d] = {tuple(w[i:i + 3]) for i in range(max(1, len(w) - 2))} if w else set()
    expected = reached(sets, 85)
    got = {r.doc_id: r for r in minmax_dedup.near_duplicates(documents(spark, *docs)).collect()}
    assert {d: r.component_id for d, r in got.items()} == expected
    assert all(got[d].n_shingles == len(sets[d]) and got[d].kept == (expected[d] == d) for d in sets)


def test_representatives(spark):
    text = " ".join(words(5, 30))
    docs = documents(spark, (5, text, "s"), (3, text, "s"), (3, text, "s"), (7, None, "s"), (8, "", "s"), (None, "x y", "s"), (None, "x y", "s"))
    kept = minmax_dedup.keep_representatives(docs)
    assert kept.columns == docs.columns
    assert sorted([r.doc_id for r in kept.collect()], key=str) == sorted([3, 7, 8, None, None], key=str)
    assert minmax_dedup.keep_representatives(docs.limit(0)).count() == 0


# --- tokens ---

def test_token_counts_equal_the_library(spark):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(token_counts.tokenizer_path(token_counts.TOKENIZER))
    rng = random.Random(0)
    odd = ["", "a<|endoftext|>b", "<|endoftext|>" * 2, "  x   y\n\n z\t", "it's we''ll  ", "日本語 123", "\x1c\x85 a\xa0b", "½ ² don't", "😀😀 ok", "x" * 50_000]
    odd += ["".join(rng.choice("ab'st re<|>\n\t  123.,éñß日😀\x85_²") for _ in range(rng.randrange(60))) for _ in range(300)]
    docs = documents(spark, *[(i, t, "s") for i, t in enumerate(odd)], (None, None, "s"), (1, "again", "s"))
    got = {r.doc_id: r for r in token_counts.token_counts(docs.where("doc_id IS NULL OR text <> 'again'")).collect()}
    for i, text in enumerate(odd):
        n = len(tokenizer.encode(text, add_special_tokens=False).ids)
        assert (got[i].n_bytes, got[i].n_tokens, got[i].over_limit) == (len(text.encode()), n, n > 512)
    assert (got[None].n_bytes, got[None].n_tokens, got[None].over_limit) == (0, 0, False)
    assert token_counts.token_counts(docs.limit(0)).count() == 0


# --- mixing ---

def test_mix_reaches_its_weights(spark):
    docs = documents(spark, *[(i, None if i % 5 else "t", "big" if i % 10 else None) for i in range(4000)])
    weights = spark.createDataFrame([("big", 1.0), (None, 3.0), ("absent", 2.0)], "source string, weight double")
    got = poisson_mix.mixed(docs, weights)
    counts = {r.source: r["count"] for r in got.groupBy("source").count().collect()}
    assert abs(counts["big"] - 1000) < 150 and abs(counts[None] - 3000) < 250
    rows = got.collect()
    assert [r.shuffle_key for r in rows] == sorted(r.shuffle_key for r in rows) and rows == poisson_mix.mixed(docs, weights).collect()
    assert poisson_mix.mixed(docs.limit(0)).count() == 0
    assert poisson_mix.mixed(docs, weights.where("source = 'absent'")).count() == 0


def test_large_rates_are_summed_from_pieces(spark):
    docs = documents(spark, *[(i, "t", "rare" if i < 4 else "big") for i in range(1000)])
    got = poisson_mix.mixed(docs).where("source = 'rare'")
    assert abs(got.count() - 500) < 120 and got.select("doc_id", "copy").distinct().count() == got.count()


# --- shards ---

def test_shards_fit_and_lose_nothing(spark):
    docs = documents(spark, *[(i, "x" * (i % 90), "s") for i in range(500)], *[(7, "y" * 50, "s")] * 100, (None, None, "s"), (900, "z" * 5000, "s"))
    got = extendible_shards.assigned(docs, limit=1000).collect()
    assert len(got) == docs.count()
    sums, rows = {}, {}
    for r in got:
        sums[r.shard] = sums.get(r.shard, 0) + r.n_bytes
        rows[r.shard] = rows.get(r.shard, 0) + 1
        assert len(r.shard) == r.depth
    assert all(r.shard_bytes == sums[r.shard] for r in got)
    assert all(v <= 1000 or rows[s] == 1 for s, v in sums.items())
    assert not any(a != b and b.startswith(a) for a in sums for b in sums)
    parents = {s[:-1] for s in sums if s}
    assert all(sum(v for s, v in sums.items() if s.startswith(p)) > 1000 for p in parents)
    assert extendible_shards.assigned(docs.limit(0)).count() == 0


def test_written_shards(spark, tmp_path):
    docs = documents(spark, *[(i, "x" * 100, "s") for i in range(50)]).drop("shard")
    extendible_shards.write_shards(extendible_shards.assigned(docs, limit=1000), str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 50


# --- urls ---

@pytest.mark.parametrize("url, host, path, rule, verdict", [
    (None, "", "", None, "allow"), ("no-scheme", "", "", None, "allow"), ("http://A.NET/x?y#z", "a.net", "/x", "net/", "block"),
    ("https://m.example.net/en/1", "m.example.net", "/en/1", "example.net/en/", "allow"), ("http://example.net/EN/", "example.net", "/EN/", "net/", "block"),
    ("http://xexample.com/de/1", "xexample.com", "/de/1", None, "allow"), ("http://example.com/de/1", "example.com", "/de/1", "example.com/de/", "block"),
    ("http://a.org/fr/", "a.org", "/fr/", "org/fr/", "allow"), ("http://a.org/frx/", "a.org", "/frx/", None, "allow"),
    ("http://www.cheap-pills.org/x", "www.cheap-pills.org", "/x", None, "block"), ("a://b://c", "b:", "//c", None, "allow"), ("http://a.net", "a.net", "", None, "allow"),
])
def test_urls(spark, url, host, path, rule, verdict):
    got = url_rules.judged(spark.createDataFrame([(1, url, "r")], "page_id long, url string, rule string")).collect()
    assert list(map(tuple, got)) == [(1, host, path, rule, verdict)]


def test_rules_are_filed_under_rare_tokens():
    index = url_rules.Index(tuple(url_rules.host_rule("block", f"site{i}.example.com/") for i in range(100)))
    assert not index.always and all(len(v) == 1 for v in index.by_token.values())


# --- top-k ---

def test_top_k_equals_brute_force(spark, monkeypatch):
    for name, value in (("SHARD_ROWS", 40), ("BLOCK_QUERIES", 4), ("LEAF_ROWS", 8)):
        monkeypatch.setattr(kdtree_topk, name, value)
    rng = np.random.default_rng(1)
    vectors = [[float(v) for v in np.round(rng.normal(size=4), 1)] for _ in range(200)] + [[0.5] * 4] * 60
    data = list(enumerate(vectors)) + [(300, None), (301, [1.0, None, 1.0, 1.0]), (302, [float("nan")] * 4), (303, [float("inf")] * 4), (304, []), (320, [2.0]), (None, [1.0] * 4)]
    table = spark.createDataFrame([(i, v, 1) for i, v in data], "vec_id long, embedding array<float>, score int")
    got = {}
    for r in kdtree_topk.top_k(table, table.where("vec_id % 20 = 0"), k=20).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    x = np.floor(np.array(vectors, np.float32).astype(float) * 64).astype(int)
    for q in range(0, 260, 20):
        scores = x @ x[q]
        best = [int(i) for i in np.lexsort((np.arange(260), -scores)) if i != q][:20]
        assert sorted(got[q]) == [(n + 1, i, int(scores[i])) for n, i in enumerate(best)]
    assert not {300, 320} & got.keys()
    assert kdtree_topk.top_k(table.limit(0), table.limit(0)).count() == 0


# --- toxicity ---

def test_toxicity_learns_and_tolerates_inserted_characters(spark):
    insult = ["grumblax", "snorfwit"]
    rows, labels = [], []
    for d in range(400):
        bad = d % 4 == 0
        text = words(d, 40)
        if bad:
            text[d % 40] = insult[d // 4 % 2]
        rows.append((d, " ".join(text), "s"))
        labels.append((d, int(bad)))
    odd = [(1000, "a grumb-lax here", "s"), (1001, "s n o r f w i t", "s"), (1002, "snorrfwit!", "s"), (1003, None, "s"), (1004, "", "s"), (1005, " ".join(words(7777, 4000)), "s"),
           (1006, " ".join(words(7777, 4000)) + " grumblax", "s"), (None, "grumblax", "s")]
    docs = documents(spark, *rows, *odd)
    table = spark.createDataFrame([*labels, (0, None), (None, 1), (3, 0)], "doc_id long, toxic int")
    got = {r.doc_id: r for r in toxicity.scored(docs, table).collect()}
    assert [got[d].predicted for d in (1000, 1001, 1002, 1003, 1004, 1005, 1006, None)] == [1, 1, 1, 0, 0, 0, 1, 1]
    right = [got[d].predicted == t for d, t in labels if got[d].held_out]
    assert right and np.mean(right) > 0.97 and all(0 <= r.score <= 1 for r in got.values())
    kept = toxicity.without_toxic(docs, table)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {d for d, r in got.items() if not r.predicted}
    assert {r.score for r in toxicity.scored(docs, table.limit(0)).collect()} == {0.0}
    assert toxicity.scored(docs.limit(0), table).count() == 0


def test_held_out_rows_are_not_learned_from(spark):
    labels = spark.createDataFrame([(d, d % 2) for d in range(200)], "doc_id long, toxic int")
    import zlib

    used = {r.doc_id for r in toxicity.training_rows(labels, labels).collect()}
    assert used == {d for d in range(200) if zlib.crc32(str(d).encode()) % 4 != 2}
