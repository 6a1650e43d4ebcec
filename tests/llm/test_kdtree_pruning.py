"""How many pairs the KD-tree search scores, and that pruning loses none, on clustered and hostile vectors."""

import numpy as np
import pytest

from tidemark.llm import kdtree_topk as kd


def walked(x, asked, k=20):
    """The search's steps in one process: the k best per query, and the share of all pairs scored."""
    ids = np.arange(len(x))
    splits = kd.regions_of(x[np.random.default_rng(3).permutation(len(x))[:kd.SAMPLE_ROWS]], -(-len(x) // kd.SHARD_ROWS))
    region = kd.region_at(splits, x)
    trees = {int(r): kd.build(ids[region == r], x[region == r]) for r in np.unique(region)}
    boxes = {r: (t["nodes"][0][2], t["nodes"][0][3]) for r, t in trees.items()}
    reach = kd.reaching(boxes, x[asked])
    home = reach.argmax(axis=1)
    hits, scored = {int(q): [] for q in asked}, 0

    def visit(r, rows, kth):
        nonlocal scored
        for start in range(0, len(rows), kd.BLOCK_QUERIES):
            part = slice(start, start + kd.BLOCK_QUERIES)
            found, n = kd.search(trees[r], asked[rows[part]], x[asked[rows[part]]], kth[part], k)
            scored += n
            for q, i, s in found:
                hits[q].append((-s, i))
    for r in trees:
        rows = np.flatnonzero(home == r)
        visit(r, rows, np.full(len(rows), kd.LEAST))
    kth = np.array([-sorted(hits[int(q)])[k - 1][0] if len(hits[int(q)]) >= k else kd.LEAST for q in asked])
    for r in trees:
        rows = np.flatnonzero((home != r) & (reach[:, r] >= kth))
        visit(r, rows, kth[rows])
    return {q: sorted(h)[:k] for q, h in hits.items()}, scored / (len(asked) * len(x))


def brute(x, asked, k=20):
    scores = (x[asked] @ x.T).astype(np.int64)
    return {int(q): [(-int(s[i]), int(i)) for i in np.lexsort((np.arange(len(x)), -s)) if i != q][:k] for q, s in zip(asked, scores)}


def clustered(rng, rows, dims, clusters, width):
    centres = rng.normal(size=(clusters, dims))
    centres /= np.linalg.norm(centres, axis=1)[:, None]
    return np.floor(64 * (centres[rng.integers(0, clusters, rows)] + rng.normal(size=(rows, dims)) * width))


def test_clustered_vectors_are_pruned():
    x = clustered(np.random.default_rng(5), 20_000, 32, 100, 0.01)
    asked = np.arange(0, len(x), 50)
    got, share = walked(x, asked)
    assert got == brute(x, asked)
    assert share <= 0.2


@pytest.mark.parametrize("kind", ["even", "equal", "one column", "few"])
def test_nothing_is_lost(monkeypatch, kind):
    monkeypatch.setattr(kd, "SHARD_ROWS", 100)
    rng = np.random.default_rng(7)
    x = {
        "even": np.floor(64 * rng.normal(size=(1500, 8))), "equal": np.full((900, 4), 7.0),
        "one column": np.floor(rng.normal(size=(900, 1)) * 3), "few": np.floor(64 * rng.normal(size=(15, 8))),
    }[kind]
    asked = np.arange(0, len(x), 10)
    assert walked(x, asked)[0] == brute(x, asked)


def test_regions_follow_the_splits():
    rng = np.random.default_rng(9)
    x = np.floor(rng.normal(size=(2000, 5)) * 20)
    x[:700] = x[0]
    splits = kd.regions_of(x, 16)
    region = kd.region_at(splits, x)
    assert set(region) == set(range(16)) and len(set(region[:700])) == 1
    assert kd.regions_of(np.zeros((0, 3)), 4) == [[-1, 0, 0, 0]] and kd.regions_of(np.full((500, 3), 2.0), 4) == [[-1, 0, 0, 0]]
