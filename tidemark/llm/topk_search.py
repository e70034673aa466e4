"""Exact largest inner products by ball-tree branch and bound, one tree a shard, queries in blocks.

Vectors are dealt by hash into shards of bounded size; each shard becomes one ball tree (centre and radius of
every node). A block of queries walks a tree best node first, by the upper bound q.c + |q| r of its inner
products; a node is left out for every query whose current k-th score lies above that bound, and dropped when
that holds for all. Shards are searched in rounds of growing number: after each round the k-th score of every
query, over all shards so far, is the bound that the next round starts from.
"""

from __future__ import annotations

import heapq
import io

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from tidemark.llm.common import only, written

SHARD = 4096  # vectors of a shard, on average
QUERIES = 512  # of a block, on average
LEAF = 64
GROWTH = 4  # shards of a round, times those searched so far
EXACT = 1 << 52  # up to here sums of products are exact in floating point


class BallTree:
    """Nodes as arrays: points ``start`` to ``end`` of the permuted order, centre, radius, children (-1: leaf)."""

    def __init__(self, points: np.ndarray) -> None:
        self.order = np.arange(len(points))
        self.start, self.end, self.child, self.centre, self.radius = [], [], [], [], []
        stack = [(0, len(points), -1, 0)]
        while stack:
            start, end, parent, side = stack.pop()
            me = len(self.start)
            own = points[self.order[start:end]].astype(np.float64)
            centre = own.mean(axis=0)
            away = np.sqrt(((own - centre) ** 2).sum(axis=1))
            self.start.append(start), self.end.append(end), self.child.append([-1, -1])
            self.centre.append(centre), self.radius.append(away.max())
            if parent >= 0:
                self.child[parent][side] = me
            if end - start > LEAF and away.max() > 0:
                one = own[away.argmax()]
                two = own[((own - one) ** 2).sum(axis=1).argmax()]
                middle = (start + end) // 2
                self.order[start:end] = self.order[start:end][np.argsort(own @ (two - one), kind="stable")]
                stack += [(start, middle, me, 0), (middle, end, me, 1)]

    def pack(self, ids: np.ndarray, points: np.ndarray) -> bytes:
        out = io.BytesIO()
        np.savez(out, ids=ids[self.order], points=points[self.order], start=self.start, end=self.end, child=self.child,
                 centre=self.centre, radius=self.radius)
        return out.getvalue()


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer inner products, by floating point where that is exact."""
    largest = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    if largest < EXACT:
        return np.rint(a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a @ b.T


def search(tree, ids: np.ndarray, queries: np.ndarray, bounds: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """(query row, vec_id, score) of all that may belong to the k best, given each query's bound so far."""
    m = len(queries)
    none = np.iinfo(np.int64).min
    scores, found = np.full((m, k), none, dtype=np.int64), np.full((m, k), np.iinfo(np.int64).max, dtype=np.int64)
    kth = bounds.copy()
    real = queries.astype(np.float64)
    norm = np.sqrt((real ** 2).sum(axis=1))
    points, vec, child = tree["points"], tree["ids"], tree["child"]
    # bounds carry rounding errors: never below the exact one
    upper = real @ tree["centre"].T + norm[:, None] * tree["radius"][None, :]
    upper += 1e-9 * (np.abs(upper) + norm[:, None]) + 1e-6
    queue = [(-upper[:, 0].max(initial=-np.inf), 0)]
    while queue:
        _, node = heapq.heappop(queue)
        live = np.flatnonzero(upper[:, node] >= kth)
        if not len(live):
            continue
        if child[node][0] >= 0:
            for c in child[node]:
                heapq.heappush(queue, (-upper[live, c].max(), int(c)))
            continue
        part = slice(tree["start"][node], tree["end"][node])
        new = products(queries[live], points[part])
        new[vec[part][None, :] == ids[live][:, None]] = none
        better = np.flatnonzero((new >= np.maximum(kth[live], none + 1)[:, None]).any(axis=1))
        if not len(better):
            continue
        live, new = live[better], new[better]
        s = np.concatenate([scores[live], new], axis=1)
        v = np.concatenate([found[live], np.broadcast_to(vec[part], new.shape)], axis=1)
        by_id = np.argsort(v, axis=1, kind="stable")
        s, v = np.take_along_axis(s, by_id, 1), np.take_along_axis(v, by_id, 1)
        best = np.argsort(-s.astype(np.float64) if np.abs(s[s > none]).max(initial=0) < EXACT else _descending(s), axis=1, kind="stable")[:, :k]
        scores[live], found[live] = np.take_along_axis(s, best, 1), np.take_along_axis(v, best, 1)
        kth[live] = np.maximum(kth[live], scores[live][:, -1])
    row, at = np.nonzero((scores > none) & (scores >= bounds[:, None]))
    return row, found[row, at], scores[row, at]


def _descending(s: np.ndarray) -> np.ndarray:
    return ~s  # orders integers from large to small without overflow


def top_k(vectors: DataFrame, k: int = 20, every: int = 20, scale: float = 64.0, id_col: str = "vec_id",
          vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k largest inner products for rows whose id is divisible by ``every``.

    Components become floor(scale * x). Equal scores go to the smaller id; a query is not its own neighbour.
    Null ids, null or empty vectors and those with null or non-finite components take no part; vectors of
    different lengths are no neighbours. Rows that repeat an id count once, with their smallest vector.
    """
    spark = vectors.sparkSession
    x = F.col("v")
    rows = only(vectors, id_col, vector_col).select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = rows.where(F.col("vec_id").isNotNull() & x.isNotNull() & (F.size(x) > 0)).where(F.coalesce(finite, F.lit(False)))
    rows = rows.select("vec_id", F.transform(x, lambda c: F.floor(c * scale)).alias("v"))
    rows = written(rows.groupBy("vec_id").agg(F.min("v").alias("v")).withColumn("dim", F.size("v")), "vectors")
    shards = max(1, -(-rows.count() // SHARD))
    blocks = max(1, -(-shards * SHARD // (every * QUERIES)))

    def build(key, group: pd.DataFrame) -> pd.DataFrame:
        points = np.stack(group["v"].to_numpy()).astype(np.int64)
        return pd.DataFrame({"dim": [key[0]], "shard": [key[1]], "tree": [BallTree(points).pack(group["vec_id"].to_numpy(), points)]})

    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("vec_id"), F.lit(shards)))
    trees = written(dealt.groupBy("dim", "shard").applyInPandas(build, "dim int, shard long, tree binary"), "trees")
    asked = rows.where(F.col("vec_id") % every == 0).withColumn("block", F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(blocks)))

    def walk(key, group: pd.DataFrame) -> pd.DataFrame:
        out = []
        for packed, block in zip(group["tree"], group["queries"]):
            ids = np.array([q["vec_id"] for q in block], dtype=np.int64)
            queries = np.stack([np.asarray(q["v"], dtype=np.int64) for q in block])
            low = np.iinfo(np.int64).min
            bounds = np.array([low if q["kth"] is None else q["kth"] for q in block], dtype=np.int64)
            row, vec, score = search(dict(np.load(io.BytesIO(packed))), ids, queries, bounds, k)
            out.append(pd.DataFrame({"query_id": ids[row], "vec_id": vec, "score": score}))
        return pd.concat(out)

    best, done = None, 0
    while done < shards:
        upto = min(shards, max(1, done * GROWTH))
        if best is None:
            known = asked.withColumn("kth", F.lit(None).cast("long"))
        else:
            kth = best.groupBy("query_id").agg(F.count("*").alias("c"), F.min("score").alias("s"))
            kth = kth.select(F.col("query_id").alias("vec_id"), F.when(F.col("c") >= k, F.col("s")).alias("kth"))
            known = asked.join(kth, "vec_id", "left")
        packs = known.groupBy("dim", "block").agg(F.collect_list(F.struct("vec_id", "v", "kth")).alias("queries"))
        packs = packs.withColumn("shard", F.explode(F.sequence(F.lit(done).cast("long"), F.lit(upto - 1).cast("long"))))
        packs = packs.join(trees, ["dim", "shard"])
        new = packs.groupBy("dim", "shard", "block").applyInPandas(walk, "query_id long, vec_id long, score long")
        both = new if best is None else new.unionByName(best.select("query_id", "vec_id", "score"))
        order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        best = written(both.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k), "best")
        done = upto
    return best.select("query_id", "rank", "vec_id", "score")
