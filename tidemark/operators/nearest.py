"""Exact nearest neighbours by cosine, block against block.

Vectors are ordered by (closest pivot, angle to it) and cut into blocks of at most
``block_rows``, so copies of one vector, however many, spread over many blocks. Blocks of items go
to all tasks in pieces of at most ``PIECE`` bytes, ``ROUND`` bytes at a time; a task takes one block of
queries after another past them, closest block first, and keeps ``k`` per query. Nothing but the
queries and their ``k`` best so far is ever written, whatever the number of blocks.
Blocks whose angular bound cannot beat what a query block already has are not visited.
No pair of vectors is ever a row.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Row, SparkSession, functions as F

from tidemark.operators.ordering import top_n
from tidemark.session import cut

PIVOTS, BLOCK_ROWS, PLACES = 32, 1024, 9
PIECE, ROUND = 32 << 20, 192 << 20  # bytes of vectors
SLACK = 1e-6  # scores are rounded; a bound this close is still visited
GATHER = 1 << 16  # pairs scored exactly at a time


def _unit(vectors: pd.Series) -> np.ndarray:
    return _scaled(np.stack([np.asarray(v, dtype=np.float64) for v in vectors]))


def _scaled(m: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(m, axis=1, keepdims=True)
    return m / np.where(norm > 0, norm, 1.0)


def _matrix(raw: bytes, rows: int) -> np.ndarray:
    """The unit vectors of a block."""
    return _scaled(np.frombuffer(raw, dtype=np.float32).reshape(rows, -1).astype(np.float64))


def _located(df: DataFrame, pivots: np.ndarray) -> DataFrame:
    """Each vector's closest pivot and its angle to it."""
    def near(batches):
        for pdf in batches:
            if len(pdf):
                sims = np.clip(_unit(pdf["vector"]) @ pivots.T, -1.0, 1.0)
                best = sims.argmax(axis=1)
                yield pdf.assign(pivot=best.astype("int64"), angle=np.arccos(sims[np.arange(len(pdf)), best]))

    return df.mapInPandas(near, schema=f"id {df.schema['id'].dataType.simpleString()}, vector array<float>, pivot long, angle double")


def _blocks(df: DataFrame, pivots: np.ndarray, block_rows: int) -> DataFrame:
    """(block, pivot, hi, ids, vectors): neighbours in (pivot, angle) together, one pivot a block."""
    order = [F.col("pivot").asc(), F.col("angle").asc(), F.col("id").asc()]
    placed = _located(df, pivots).repartitionByRange(*order).sortWithinPartitions(*order)

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for pdf in batches:
            if len(pdf):
                rest = pdf if rest is None else pd.concat([rest, pdf])
                ended = int((rest["pivot"] != rest["pivot"].iloc[-1]).sum())  # rows of pivots that no later row has
                ended += (len(rest) - ended) // block_rows * block_rows
                yield packed(rest.iloc[:ended])
                rest = rest.iloc[ended:]
        if rest is not None:
            yield packed(rest)

    def packed(pdf: pd.DataFrame) -> pd.DataFrame:
        out = [(pivot, part["angle"].max(), part["id"].tolist(), np.stack([np.asarray(v, dtype=np.float32) for v in part["vector"]]).tobytes())
               for pivot, group in pdf.groupby("pivot", sort=True) for at in range(0, len(group), block_rows) for part in [group.iloc[at:at + block_rows]]]
        return pd.DataFrame(out, columns=["pivot", "hi", "ids", "vectors"])

    kind = df.schema["id"].dataType.simpleString()
    blocks = placed.mapInPandas(pack, f"pivot long, hi double, ids array<{kind}>, vectors binary")
    return cut(blocks.withColumn("block", F.monotonically_increasing_id()))


def broadcast_rounds(spark: SparkSession, blocks: DataFrame, told: Callable[[Row], tuple]) -> Iterator[list]:
    """Lists of broadcast pieces of ``blocks`` (block, vectors, ...), one list a round. Only one piece at a time is held here."""
    spans, total = [], 0
    for r in blocks.select("block", F.length("vectors").alias("n")).orderBy("block").collect():
        if spans and total + r["n"] <= PIECE:
            spans[-1][1], total = r["block"], total + r["n"]
        else:
            spans.append([r["block"], r["block"]])
            total = r["n"]
    together = max(1, ROUND // PIECE)
    piece = lambda first, last: spark.sparkContext.broadcast([told(r) for r in blocks.where(F.col("block").between(first, last)).collect()])
    for at in range(0, len(spans), together):
        yield [piece(*s) for s in spans[at:at + together]]


class BestOf:
    """The k best of each query of one block so far, by falling score and rising id."""

    def __init__(self, queries: int, k: int) -> None:
        self.queries, self.k = queries, k
        self.row, self.item, self.score, self.settled = np.zeros(0, np.int64), None, np.zeros(0), 0
        self.kth = np.full(queries, -np.inf)

    def add(self, row: np.ndarray, item: np.ndarray, score: np.ndarray) -> None:
        self.row, self.score = np.concatenate([self.row, row]), np.concatenate([self.score, score])
        self.item = item if self.item is None else np.concatenate([self.item, item])

    def settle(self) -> None:
        if self.item is None:
            return
        order = np.lexsort((self.item, -self.score, self.row))
        row = self.row[order]
        place = np.arange(len(row)) - np.searchsorted(row, row)
        order = order[place < self.k]
        self.row, self.item, self.score = self.row[order], self.item[order], self.score[order]
        last = place[place < self.k] == self.k - 1
        self.kth[self.row[last]] = self.score[last]
        self.settled = len(order)

    def settle_if_many(self) -> None:
        if len(self.row) - self.settled > self.k * self.queries // 3:
            self.settle()


class _Best(BestOf):
    def __init__(self, ids: np.ndarray, vectors: np.ndarray, k: int, skip_self: bool) -> None:
        super().__init__(len(ids), k)
        self.ids, self.vectors, self.small, self.skip_self = ids, vectors, vectors.astype(np.float32), skip_self
        self.by_id = np.argsort(ids, kind="stable")
        self.known = ids[self.by_id]
        self.error = (vectors.shape[1] + 4) * 6e-8 + 1e-9  # of a product in 32 bits, and of rounding

    def meet(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        rough = self.small @ vectors.astype(np.float32).T
        if self.skip_self:
            low, high = np.searchsorted(self.known, ids, "left"), np.searchsorted(self.known, ids, "right")
            for col in np.flatnonzero(high > low):
                rough[self.by_id[low[col]:high[col]], col] = -np.inf
        wanted = np.maximum(self.kth - self.error, -3.0).astype(np.float32) - np.float32(1e-7)
        if len(ids) > self.k and (np.isneginf(self.kth).any() or np.count_nonzero(rough >= wanted[:, None]) > 8 * self.k * len(self.ids)):
            here = -np.partition(-rough, self.k - 1, axis=1)[:, self.k - 1]  # k of this block are as good
            wanted = np.maximum(wanted, here - np.float32(2 * self.error))
        row, col = np.nonzero(rough >= wanted[:, None])
        score = np.empty(len(row))
        for at in range(0, len(row), GATHER):
            some = slice(at, at + GATHER)
            score[some] = np.einsum("nd,nd->n", self.vectors[row[some]], vectors[col[some]])
        self.add(row, ids[col], np.round(score, PLACES))
        if np.isneginf(self.kth).any():
            self.settle()
        self.settle_if_many()


def nearest(items: DataFrame, k: int, queries: DataFrame | None = None, block_rows: int = BLOCK_ROWS,
            pivots: int = PIVOTS) -> DataFrame:
    """The exact top ``k`` items by cosine for each query, ties to the smaller id.

    ``items`` and ``queries`` hold (id, vector). Without ``queries`` the items look up each other,
    and a vector is not its own neighbour.
    """
    itself, spark = queries is None, items.sparkSession
    only = lambda df: df.select("id", F.col("vector").cast("array<float>").alias("vector"))
    items = cut(only(items))
    id_type = items.schema["id"].dataType.simpleString()
    chosen = items.orderBy(F.xxhash64("id"), "id").limit(pivots).collect()  # a fixed, small number of rows
    centres = _unit(pd.Series([r["vector"] for r in chosen]))
    between = np.arccos(np.clip(centres @ centres.T, -1.0, 1.0))

    item_blocks = _blocks(items, centres, block_rows)
    query_blocks = item_blocks if itself else _blocks(only(queries), centres, block_rows)
    query_type = query_blocks.schema["ids"].dataType.elementType.simpleString()
    asked = query_blocks.count()
    tasks = min(asked, max(64, math.ceil(asked / 8)))
    fields = f"pivot long, hi double, ids array<{query_type}>, vectors binary"
    state = query_blocks.select("pivot", "hi", "ids", "vectors", *[F.lit(None).cast(t).alias(n) for n, t in (
        ("row", "array<int>"), ("item", f"array<{id_type}>"), ("score", "array<double>"))]).repartition(max(1, tasks))

    def visit(pieces: list, block: tuple) -> _Best:
        best = _Best(np.array(block.ids), _matrix(block.vectors, len(block.ids)), k, itself)
        if block.row is not None and len(block.row):
            best.add(np.asarray(block.row, np.int64), np.array(block.item), np.asarray(block.score, np.float64))
            best.settle()
        for piece in pieces:
            apart = [max(0.0, between[block.pivot, pivot] - block.hi - hi) for pivot, hi, _, _ in piece.value]
            for i in np.argsort(apart, kind="stable"):
                if math.cos(min(apart[i], math.pi)) < best.kth.min() - SLACK:
                    break  # and so for all that are farther
                _, _, ids, raw = piece.value[i]
                best.meet(ids, _matrix(raw, len(ids)))
        best.settle()
        return best

    def carried(pieces: list):
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                for block in pdf.itertuples(index=False):
                    best = visit(pieces, block)
                    yield pd.DataFrame({"pivot": [block.pivot], "hi": [block.hi], "ids": [block.ids], "vectors": [block.vectors], "row": [best.row.astype(np.int32)],
                                        "item": [[] if best.item is None else best.item.tolist()], "score": [best.score]})
        return run

    def ended(pieces: list):
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                for block in pdf.itertuples(index=False):
                    best = visit(pieces, block)
                    if best.item is not None:
                        place = np.arange(len(best.row)) - np.searchsorted(best.row, best.row) + 1
                        yield pd.DataFrame({"query_id": np.array(block.ids)[best.row], "item_id": best.item, "score": best.score, "rank": place.astype(np.int32)})
        return run

    rounds = broadcast_rounds(spark, item_blocks, lambda r: (r["pivot"], r["hi"], np.array(r["ids"]), bytes(r["vectors"])))
    pieces = next(rounds, [])
    for following in rounds:
        state = cut(state.mapInPandas(carried(pieces), f"{fields}, row array<int>, item array<{id_type}>, score array<double>"))
        for piece in pieces:
            piece.destroy()
        pieces = following
    found = state.mapInPandas(ended(pieces), f"query_id {query_type}, item_id {id_type}, score double, rank int")
    ids = query_blocks.select(F.explode("ids").alias("id")).groupBy("id").agg(F.count(F.lit(1)).alias("n"))
    if ids.where("n > 1").isEmpty():
        return found
    # rows that repeat an id share its k places
    return top_n(found.drop("rank"), ["query_id"], [F.col("score").desc(), F.col("item_id").asc()], k)
