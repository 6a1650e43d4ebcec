"""Exact top-k by inner product over KD-trees, one per shard.

Median splits fitted on ``SAMPLE_ROWS`` vectors, chosen by hash, part the space into regions; every
vector is then dealt to its region by them, and a region's vectors by hash to shards of about
``SHARD_ROWS``. Each shard gets a tree of median splits, whose nodes carry tight bounding boxes. No
point of a box can score more with a query than the sum over its sides of the better corner. A
query first goes to the region whose box promises most, which gives it a k-th score; it then goes
only to regions whose box can reach that score. Queries of a region travel in blocks to its trees
and walk them best box first, until no open box can reach the k-th score known. The sample decides
where the splits lie, never what is found.

Scores are integers: components are floor(scale * x). Ties go to the smaller ``vec_id``. Null
vectors, and those with a null or non-finite component, take no part, nor do rows without
``vec_id``. Vectors of different length cannot be compared: each length is a search of its own.
Rows with equal ids are separate candidates, but never answers to their own id. A score beyond
64 bits is held at the limit.
"""

from __future__ import annotations

import heapq
import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from tidemark.llm.common import small, stored

SHARD_ROWS = 4_096
BLOCK_QUERIES = 512
LEAF_ROWS = 32
SAMPLE_ROWS = 16_384
# A region holds at least so many sampled vectors; boxes of all regions take so many bytes at most.
REGION_SAMPLE, BOX_BYTES = 16, 8_000_000
EXACT = 2.0 ** 52
LEAST = np.iinfo(np.int64).min
ROWS = "vec_id long, dims int, x array<double>, spread long, region int"
ROUTED = "vec_id long, dims int, x array<double>, spread long, kth long, region int"
TREES = "dims int, region int, low array<double>, high array<double>, tree binary"
PACKS = "dims int, region int, block binary"
HITS = "query_id long, vec_id long, score long"


def usable(vectors: DataFrame, column: str, scale: int) -> DataFrame:
    """vec_id, dims and the integer components (as doubles, which hold them exactly)."""
    finite = F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    whole = F.transform(column, lambda x: F.when(F.abs(x) < 1e15, F.floor(x.cast("double") * scale).cast("double")).otherwise(x.cast("double") * scale))
    kept = vectors.where(F.col(column).isNotNull() & F.col("vec_id").isNotNull()).where(F.coalesce(finite, F.lit(False)))
    return kept.select(F.col("vec_id").cast("long").alias("vec_id"), F.size(column).alias("dims"), whole.alias("x"))


def scores_of(queries: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Inner products as integers; whole-number arithmetic where doubles would round."""
    top = np.abs(queries).max(initial=0) * np.abs(points).max(initial=0) * max(queries.shape[1], 1)
    if top < EXACT:
        return (queries @ points.T).astype(np.int64)
    limit = np.iinfo(np.int64)
    to_int = np.vectorize(int, otypes=[object])
    exact = to_int(queries) @ to_int(points).T if queries.size and points.size else np.zeros((len(queries), len(points)), object)
    return np.vectorize(lambda v: min(max(v, limit.min), limit.max), otypes=[np.int64])(exact)


def build(ids: np.ndarray, points: np.ndarray) -> dict:
    """Tree in arrays: rows in leaf order, and per node its range, box and children."""
    order = np.argsort(ids, kind="stable")
    nodes: list[tuple] = []
    todo = [(0, len(ids), -1, 0)]
    while todo:
        lo, hi, parent, side = todo.pop()
        own = points[order[lo:hi]]
        low, high = own.min(axis=0, initial=np.inf), own.max(axis=0, initial=-np.inf)
        nodes.append([lo, hi, low, high, -1, -1])
        if parent >= 0:
            nodes[parent][4 + side] = len(nodes) - 1
        width = high - low
        if hi - lo > LEAF_ROWS and width.max(initial=0) > 0:
            axis = int(width.argmax())
            order[lo:hi] = order[lo:hi][np.argsort(own[:, axis], kind="stable")]
            middle = (lo + hi) // 2
            todo += [(lo, middle, len(nodes) - 1, 0), (middle, hi, len(nodes) - 1, 1)]
    return {"ids": ids[order], "points": points[order], "nodes": nodes}


def narrow(points: np.ndarray) -> np.ndarray:
    """The smallest whole-number type that holds the components, for the way between tasks."""
    top = np.abs(points).max(initial=0)
    for kind in (np.int8, np.int16, np.int32):
        if top <= np.iinfo(kind).max:
            return points.astype(kind)
    return points


def bound(queries: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Largest score any point of the box can have, per query (with room for rounding)."""
    best = np.maximum(np.maximum(queries, 0) @ high + np.minimum(queries, 0) @ low, float(LEAST))
    return best + np.abs(best) * 1e-9 + (1 if np.abs(best).max(initial=0) > EXACT else 0)


def search(tree: dict, query_ids: np.ndarray, queries: np.ndarray, kth: np.ndarray, k: int) -> tuple[list[tuple], int]:
    """(query id, vec_id, score) of the k best per query, without those below ``kth``; and how many pairs were scored."""
    points = tree["points"].astype(np.float64)
    n, scored = len(queries), 0
    best_score = np.full((n, k), LEAST, np.int64)
    best_id = np.full((n, k), np.iinfo(np.int64).max, np.int64)
    filled = np.zeros(n, np.int64)
    floor = kth.astype(np.float64).copy()
    root = bound(queries, tree["nodes"][0][2], tree["nodes"][0][3])
    heap, tick = [(-root.max(initial=-np.inf), 0, 0, root)], 1
    while heap:
        _, _, at, reach = heapq.heappop(heap)
        open_queries = np.flatnonzero(reach >= floor)
        if not len(open_queries):
            continue
        lo, hi, low, high, left, right = tree["nodes"][at]
        if left >= 0:
            for child in (left, right):
                own = np.full(n, -np.inf)
                own[open_queries] = bound(queries[open_queries], tree["nodes"][child][2], tree["nodes"][child][3])
                if (own >= floor).any():
                    heapq.heappush(heap, (-own.max(), tick, child, own))
                    tick += 1
            continue
        for start in range(lo, hi, 1024):
            ids = tree["ids"][start:min(hi, start + 1024)]
            found = scores_of(queries[open_queries], points[start:min(hi, start + 1024)])
            scored += found.size
            good = (found >= floor[open_queries][:, None]) & (ids[None, :] != query_ids[open_queries][:, None])
            some = np.flatnonzero(good.any(axis=1))
            if not len(some):
                continue
            q, good = open_queries[some], good[some]
            score = np.hstack([best_score[q], np.where(good, found[some], LEAST)])
            name = np.hstack([best_id[q], np.where(good, ids[None, :], np.iinfo(np.int64).max)])
            top = np.lexsort((name, ~score), axis=-1)[:, :k]
            best_score[q], best_id[q] = np.take_along_axis(score, top, axis=1), np.take_along_axis(name, top, axis=1)
            filled[q] = np.minimum(k, filled[q] + good.sum(axis=1))
            full = q[filled[q] == k]
            floor[full] = np.maximum(floor[full], best_score[full, -1])
    return [(int(query_ids[q]), int(best_id[q, j]), int(best_score[q, j])) for q in range(n) for j in range(filled[q])], scored


def regions_of(sample: np.ndarray, wanted: int) -> list[list]:
    """Median splits (axis, cut, left, right) of the largest cells first; a leaf is (-1, region, 0, 0)."""
    splits: list[list] = [[-1, 0, 0, 0]]
    heap, found, tick = [(-len(sample), 0, 0, np.arange(len(sample)))], 1, 1
    while heap and found < wanted:
        size, _, at, rows = heapq.heappop(heap)
        width = np.ptp(sample[rows], axis=0) if sample.shape[1] and len(rows) else np.zeros(0)
        if -size < 2 * REGION_SAMPLE or not width.max(initial=0) > 0:
            continue
        axis = int(width.argmax())
        values = sample[rows, axis]
        cut = float(np.sort(values)[(len(rows) - 1) // 2])
        cut = cut if cut < values.max() else float(values[values < cut].max())
        below = values <= cut
        region = splits[at][1]
        splits[at] = [axis, cut, len(splits), len(splits) + 1]
        for own, name in ((rows[below], region), (rows[~below], found)):
            heapq.heappush(heap, (-len(own), tick, len(splits), own))
            splits.append([-1, name, 0, 0])
            tick += 1
        found += 1
    return splits


def region_at(splits: list[list], points: np.ndarray) -> np.ndarray:
    """The region each point lies in."""
    result = np.zeros(len(points), np.int32)
    todo = [(0, np.arange(len(points)))]
    while todo:
        at, rows = todo.pop()
        axis, cut, left, right = splits[at]
        if axis < 0:
            result[rows] = cut
        elif len(rows):
            below = points[rows, axis] <= cut
            todo += [(left, rows[below]), (right, rows[~below])]
    return result


def reaching(boxes: dict[int, tuple], queries: np.ndarray) -> np.ndarray:
    """Per query and region, the largest score the region's box allows; minus infinity for empty ones."""
    result = np.full((len(queries), max(boxes, default=-1) + 1), -np.inf)
    for region, (low, high) in boxes.items():
        result[:, region] = bound(queries, low, high)
    return result


def _matrix(column: pd.Series, dims: int) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(np.float64) if dims else np.zeros((len(column), 0))


def _tree_part(group: pd.DataFrame) -> pd.DataFrame:
    dims = int(group["dims"].iloc[0])
    tree = build(group["vec_id"].to_numpy(), _matrix(group["x"], dims))
    tree["points"] = narrow(tree["points"])
    low, high = tree["nodes"][0][2:4]
    return pd.DataFrame({"dims": [dims], "region": [int(group["region"].iloc[0])], "low": [low], "high": [high], "tree": [pickle.dumps(tree)]})


def _query_part(group: pd.DataFrame) -> pd.DataFrame:
    dims = int(group["dims"].iloc[0])
    kth = [LEAST if v is None or v != v else int(v) for v in group["kth"].astype(object)]
    block = {"ids": group["vec_id"].to_numpy(), "points": narrow(_matrix(group["x"], dims)), "kth": np.array(kth, np.int64)}
    return pd.DataFrame({"dims": [dims], "region": [int(group["region"].iloc[0])], "block": [pickle.dumps(block)]})


def _searcher(k: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                tree, block = pickle.loads(row.tree), pickle.loads(row.block)
                hits, _ = search(tree, block["ids"], block["points"].astype(np.float64), block["kth"], k)
                if hits:
                    yield pd.DataFrame(hits, columns=["query_id", "vec_id", "score"])
    return run


def _dealer(shared):
    """Adds the region of each vector; lengths the sample does not know are one region."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for dims, rows in batch.groupby("dims"):
                splits = shared.value.get(int(dims))
                yield rows.assign(region=region_at(splits, _matrix(rows["x"], int(dims))) if splits else np.int32(0))
    return run


def _router(shared, first: bool):
    """Queries with the regions to visit: at first the most promising one, then all others that can reach the k-th score."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for dims, rows in batch.groupby("dims"):
                boxes = shared.value.get(int(dims))
                if not boxes:
                    if first:
                        yield rows.assign(region=np.int32(0))
                    continue
                reach = reaching(boxes, _matrix(rows["x"], int(dims)))
                home = reach.argmax(axis=1)
                if first:
                    yield rows.assign(region=home.astype(np.int32))
                    continue
                least = np.array([LEAST if v is None or v != v else int(v) for v in rows["kth"].astype(object)], np.int64)
                wanted = reach >= least.astype(np.float64)[:, None]
                wanted[np.arange(len(rows)), home] = False
                for region in np.flatnonzero(wanted.any(axis=0)):
                    yield rows[wanted[:, region]].assign(region=np.int32(region))
    return run


def _spread(rows: DataFrame, size: int) -> DataFrame:
    """Deals the rows of each region by hash to cells of about ``size``, a key of their own: a region's lie in many tasks."""
    parts = small(stored(rows.groupBy("dims", "region").agg(F.ceil(F.count("*") / size).alias("parts")), "knn-parts"))
    return rows.join(parts, ["dims", "region"]).withColumn("cell", F.expr("concat_ws('/', dims, region, pmod(spread, parts))"))


def _hits(routed: DataFrame, trees: DataFrame, k: int, label: str) -> DataFrame:
    """Best scores of routed queries within their regions; tasks grow with the number of query blocks."""
    packs = stored(_spread(routed, BLOCK_QUERIES).groupBy("cell").applyInPandas(_query_part, PACKS), f"knn-{label}-queries")
    pairs = packs.join(trees.select("dims", "region", "tree"), ["dims", "region"]).select("tree", "block")
    number, cores = packs.count(), routed.sparkSession.sparkContext.defaultParallelism
    tasks = max(1, -(-number // 8), min(number, 4 * cores))
    return stored(pairs.repartition(tasks).mapInPandas(_searcher(k), HITS), f"knn-{label}")


def fitted(points: DataFrame) -> dict[int, list[list]]:
    """Splits per vector length, from the sample; regions in proportion to the rows."""
    sample = points.orderBy(F.xxhash64("vec_id")).limit(SAMPLE_ROWS).select("dims", "x").toPandas()
    total = points.count()
    result = {}
    for dims, rows in sample.groupby("dims"):
        matrix = _matrix(rows["x"], int(dims))
        wanted = min(-(-total * len(rows) // (len(sample) * SHARD_ROWS)), BOX_BYTES * len(rows) // (len(sample) * 16 * max(int(dims), 1)))
        result[int(dims)] = regions_of(matrix, max(1, int(wanted)))
    return result


def boxes_of(trees: DataFrame, lengths: list[int]) -> dict[int, dict[int, tuple]]:
    """Box per region of the lengths the sample knows; at most ``BOX_BYTES`` of numbers."""
    sides = trees.where(F.col("dims").isin(lengths)).select("dims", "region", F.posexplode(F.arrays_zip("low", "high")).alias("side", "box"))
    rows = sides.groupBy("dims", "region", "side").agg(F.min("box.low").alias("low"), F.max("box.high").alias("high")).toPandas()
    result: dict[int, dict[int, tuple]] = {}
    for (dims, region), own in rows.groupby(["dims", "region"]):
        own = own.sort_values("side")
        result.setdefault(int(dims), {})[int(region)] = (own["low"].to_numpy(), own["high"].to_numpy())
    return result


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 20, column: str = "embedding", scale: int = 64) -> DataFrame:
    """query_id, rank (from 1), vec_id and score of the ``k`` best other rows per query row.

    ``queries`` are rows of the same form. Repeated rows are candidates of their own; queries with
    equal ids are ranked as one. Without vectors or without queries there are no rows. Further
    columns are left out.
    """
    context = vectors.sparkSession.sparkContext
    spread = F.expr("xxhash64(monotonically_increasing_id())")
    points = stored(usable(vectors, column, scale).withColumn("spread", spread), "knn-points")
    asked = stored(usable(queries, column, scale).withColumn("spread", spread), "knn-asked")
    splits = fitted(points)
    dealt = stored(points.mapInPandas(_dealer(context.broadcast(splits)), ROWS), "knn-dealt")
    trees = stored(_spread(dealt, SHARD_ROWS).groupBy("cell").applyInPandas(_tree_part, TREES), "knn-trees")
    boxes = context.broadcast(boxes_of(trees, [d for d in splits if d]))
    routed = asked.mapInPandas(_router(boxes, True), ROWS).withColumn("kth", F.lit(None).cast("long"))
    first = _hits(routed, trees, k, "first")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    best = first.withColumn("rank", F.row_number().over(order))
    known = best.where(f"rank = {k}").selectExpr("query_id AS vec_id", "score AS kth")
    again = asked.join(known, "vec_id", "left").select("vec_id", "dims", "x", "spread", "kth")
    rest = _hits(again.mapInPandas(_router(boxes, False), ROUTED), trees, k, "rest")
    return first.unionByName(rest).withColumn("rank", F.row_number().over(order)).where(f"rank <= {k}").select("query_id", "rank", "vec_id", "score")
