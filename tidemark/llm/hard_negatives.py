"""Hard negatives of anchor vectors, scored exactly by tables of subset sums.

Every component becomes an integer. A candidate is kept as bit planes: bit b of eight neighbouring components is
one byte, so a vector of d components of b bits is b * d / 8 bytes. For an anchor and a group of eight
dimensions, the sums of all 256 subsets of the anchor's components are computed once; a candidate's byte of a
plane then looks up that group's part of the inner product, and the planes are added by shifting, the sign plane
negatively. No product is ever formed and every score is exact.

Candidates stay where they are: they are packed once, and each task compares its share of them with all anchors,
read in blocks from the written anchor table, so what is shuffled grows with the rows found (at most ``positives``
or ``negatives`` an anchor and task), not with anchors times candidates. No step groups by label or host, so a
label that holds most rows is no group.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow.dataset as arrow_dataset
from pyarrow import fs as files
from pyspark.sql import DataFrame, Window, functions as F

from tidemark.llm.common import only
from tidemark.session import scratch_path

GROUP = 8  # dimensions of a table
ANCHORS = 256  # of a block
CANDIDATES = 2048  # of a block
TASK_ROWS = 1 << 18  # candidates of a task, at most on average
SMALL_TASK = 1 << 12  # no task is cut smaller than this to keep cores busy

PACKED = "vec_id long, label int, dim int, planes binary"


def bit_planes(v: np.ndarray) -> tuple[np.ndarray, int]:
    """Rows of integers as (rows, planes, groups) bytes in two's complement, and the number of planes."""
    groups = -(-v.shape[1] // GROUP)
    planes = 1 + max(int(x).bit_length() for x in (v.max(initial=0), ~v.min(initial=-1)))
    padded = np.zeros((len(v), groups * GROUP), dtype=np.int64)
    padded[:, :v.shape[1]] = v
    out = np.empty((len(v), planes, groups), dtype=np.uint8)
    for b in range(planes):
        out[:, b] = np.packbits((padded >> b & 1).astype(np.uint8), axis=1, bitorder="little")
    return out, planes


def subset_tables(anchors: np.ndarray, dtype) -> np.ndarray:
    """(groups, 256, anchors): for every byte the sum of the anchor's components whose bits it sets."""
    groups = -(-anchors.shape[1] // GROUP)
    padded = np.zeros((len(anchors), groups * GROUP), dtype=dtype)
    padded[:, :anchors.shape[1]] = anchors
    out = np.zeros((groups, 1 << GROUP, len(anchors)), dtype=dtype)
    for g in range(groups):
        for i in range(GROUP):
            out[g, 1 << i:2 << i] = out[g, :1 << i] + padded[:, g * GROUP + i]
    return out


def scores(tables: np.ndarray, planes: np.ndarray) -> np.ndarray:
    """(candidates, anchors) inner products from lookups, shifts and sums."""
    total = part = None
    for b in range(planes.shape[1] - 1, -1, -1):
        if total is not None:
            total <<= 1
        for g in range(planes.shape[2]):
            part = np.take(tables[g], planes[:, b, g], axis=0, out=part, mode="clip")  # bytes are always in range
            if total is None:
                total = -part
            elif b == planes.shape[1] - 1:
                total -= part
            else:
                total += part
    return total


def _wide(anchors: np.ndarray, bits: int):
    """32 bits where no partial sum can leave them."""
    reach = int(np.abs(anchors.astype(np.float64)).sum(axis=1).max(initial=0)) << bits
    return np.int32 if reach < 1 << 30 else np.int64


def _best(slot: np.ndarray, score: np.ndarray, vec: np.ndarray, k: int) -> np.ndarray:
    """Rows that are among the first k of their slot by score (descending) and vec_id."""
    order = np.lexsort((vec, ~score, slot))
    s = slot[order]
    first = np.r_[True, s[1:] != s[:-1]] if len(s) else np.empty(0, dtype=bool)
    rank = np.arange(len(s)) - np.maximum.accumulate(np.where(first, np.arange(len(s)), 0))
    return order[rank < k]


class Kept:
    """The first k rows of every slot so far, and the score a new row must exceed or meet to matter."""

    def __init__(self, slots: int, k: int) -> None:
        self.k, self.limit = k, np.full(slots, np.iinfo(np.int64).min)
        self.slot = self.score = self.vec = np.empty(0, dtype=np.int64)

    def add(self, slot: np.ndarray, score: np.ndarray, vec: np.ndarray) -> None:
        if not len(slot):
            return
        slot, score, vec = (np.concatenate(x) for x in ((self.slot, slot), (self.score, score), (self.vec, vec)))
        keep = _best(slot, score, vec, self.k)
        self.slot, self.score, self.vec = slot[keep], score[keep], vec[keep]
        full = np.bincount(self.slot, minlength=len(self.limit)) == self.k
        lowest = np.full(len(self.limit), np.iinfo(np.int64).max)
        np.minimum.at(lowest, self.slot, self.score)
        self.limit = np.where(full, lowest, self.limit)


def _blocks(path: str, rows: int) -> Iterator[pd.DataFrame]:
    """The written anchors, in frames of at most a block."""
    store, place = files.FileSystem.from_uri(path)
    for batch in arrow_dataset.dataset(place, filesystem=store, format="parquet").to_batches(batch_size=rows):
        if batch.num_rows:
            yield batch.to_pandas()


def _candidates(frames: Iterator[pd.DataFrame], size: int) -> list[tuple]:
    """A task's rows as blocks of one length and number of planes, by ascending id."""
    held = pd.concat([f for f in frames if len(f)] or [pd.DataFrame(columns=["vec_id", "label", "dim", "planes"])])
    out = []
    for (dim, width), part in held.groupby(["dim", held["planes"].str.len()]):
        part = part.sort_values("vec_id")
        groups = -(-int(dim) // GROUP)
        for at in range(0, len(part), size):
            rows = part.iloc[at:at + size]
            planes = np.frombuffer(b"".join(rows["planes"]), dtype=np.uint8).reshape(len(rows), int(width) // groups, groups)
            out.append((int(dim), rows["vec_id"].to_numpy(np.int64), rows["label"].to_numpy(np.int64), planes))
    return out


def _compared(frames: Iterator[pd.DataFrame], path: str, sizes: tuple[int, int]) -> Iterator[tuple]:
    """(anchors of one length, [(ids, labels, score matrix) of every candidate block, lazily])."""
    blocks = _candidates(frames, sizes[1])
    if not blocks:
        return
    for frame in _blocks(path, sizes[0]):
        for dim, anchors in frame.groupby(frame["v"].str.len()):
            v = np.stack(anchors["v"].to_numpy()).astype(np.int64)
            tables = {}

            def each(v=v, dim=dim, tables=tables):
                for d, ids, labels, planes in blocks:
                    if d == dim:
                        kind = _wide(v, planes.shape[1])
                        if kind not in tables:
                            tables[kind] = subset_tables(v, kind)
                        yield ids, labels, scores(tables[kind], planes)

            yield anchors, each()


def _positives(path: str, k: int):
    sizes = ANCHORS, CANDIDATES

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for anchors, compared in _compared(frames, path, sizes):
            ids, labels = anchors["vec_id"].to_numpy(np.int64), anchors["label"].to_numpy(np.int64)
            kept = Kept(len(ids), k)
            for vec, label, score in compared:
                at, a = np.nonzero((score >= kept.limit) & (label[:, None] == labels) & (vec[:, None] != ids))
                kept.add(a, score[at, a].astype(np.int64), vec[at])
            yield pd.DataFrame({"anchor_id": ids[kept.slot], "positive_id": kept.vec, "positive_score": kept.score})
    return run


def _negatives(path: str, k: int, low: int, high: int):
    sizes = ANCHORS, CANDIDATES

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for anchors, compared in _compared(frames, path, sizes):
            ids, labels = anchors["vec_id"].to_numpy(np.int64), anchors["label"].to_numpy(np.int64)
            width = max(len(p) for p in anchors["positives"])
            lowest, highest = np.full((len(ids), width), np.iinfo(np.int64).max), np.full((len(ids), width), np.iinfo(np.int64).min)
            for i, found in enumerate(anchors["positives"]):
                for j, p in enumerate(found):  # at most ``positives`` of an anchor
                    lowest[i, j], highest[i, j] = -(-low * p["score"] // 100), high * p["score"] // 100
            any_low, any_high = lowest.min(axis=1), highest.max(axis=1)
            kept = Kept(len(ids) * width, k)
            for vec, label, score in compared:
                at, a = np.nonzero((score >= any_low) & (score <= any_high) & (label[:, None] != labels))
                s = score[at, a].astype(np.int64)
                for j in range(width):
                    slot = a * width + j
                    fit = np.flatnonzero((s >= lowest[a, j]) & (s <= highest[a, j]) & (s >= kept.limit[slot]))
                    kept.add(slot[fit], s[fit], vec[at[fit]])
            a, j = kept.slot // width, kept.slot % width
            found = [anchors["positives"].iloc[x][y] for x, y in zip(a, j)]
            yield pd.DataFrame({"anchor_id": ids[a], "positive_id": np.array([p["vec_id"] for p in found], dtype=np.int64),
                                "positive_score": np.array([p["score"] for p in found], dtype=np.int64),
                                "negative_id": kept.vec, "negative_score": kept.score})
    return run


def _pack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        for dim, part in frame.groupby(frame["v"].str.len()):
            for at in range(0, len(part), CANDIDATES):
                rows = part.iloc[at:at + CANDIDATES]
                planes, _ = bit_planes(np.stack(rows["v"].to_numpy()).astype(np.int64))
                yield pd.DataFrame({"vec_id": rows["vec_id"], "label": rows["label"], "dim": int(dim), "planes": [p.tobytes() for p in planes]})


def hard_negatives(vectors: DataFrame, positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100, every: int = 100,
                   scale: float = 256.0, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Anchors are the rows whose id is divisible by ``every``; components become floor(scale * x). An anchor's
    positives are its ``positives`` best other rows of the same label; of the rows with another label and
    low * positive_score <= 100 * negative_score <= high * positive_score the ``negatives`` best are returned,
    for each positive. Equal scores go to the smaller id.

    Null ids, null labels, null or empty vectors and those with null or non-finite components take no part;
    vectors of different lengths are never compared. Rows that repeat an id count once, with their smallest
    vector (ties: smallest label). Components saturate and scores wrap at 64 bits.
    """
    spark = vectors.sparkSession
    x = F.col("v")
    rows = only(vectors, id_col, vector_col, label_col).select(
        F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{label_col}`").cast("int").alias("label"),
        F.col(f"`{vector_col}`").cast("array<double>").alias("v"))
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = rows.where("vec_id is not null and label is not null").where(x.isNotNull() & (F.size(x) > 0) & F.coalesce(finite, F.lit(False)))
    rows = rows.select("vec_id", "label", F.transform(x, lambda c: F.floor(c * scale)).alias("v"))
    rows = rows.groupBy("vec_id").agg(F.min(F.struct("v", "label")).alias("r")).select("vec_id", "r.label", "r.v")

    def kept(frame: DataFrame, name: str) -> tuple[DataFrame, str]:
        path = scratch_path(spark, f"llm-{name}")
        frame.write.parquet(path)
        return spark.read.schema(frame.schema).parquet(path), path

    rows, _ = kept(rows, "negatives-rows")
    n = rows.count()
    tasks = max(1, -(-n // TASK_ROWS), min(spark.sparkContext.defaultParallelism, n // SMALL_TASK))
    packed, _ = kept(rows.mapInPandas(_pack, PACKED), "negatives-packed")
    packed = packed.repartition(tasks)
    anchors, path = kept(rows.where(F.col("vec_id") % every == 0), "negatives-anchors")

    found = packed.mapInPandas(_positives(path, positives), "anchor_id long, positive_id long, positive_score long")
    order = Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id")
    found = found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= positives)
    found = found.groupBy("anchor_id").agg(F.collect_list(F.struct(F.col("positive_id").alias("vec_id"), F.col("positive_score").alias("score"))).alias("positives"))
    asked, path = kept(anchors.join(found, F.col("vec_id") == F.col("anchor_id")).select("vec_id", "label", "v", "positives"), "negatives-asked")

    found = packed.mapInPandas(_negatives(path, negatives, low, high),
                               "anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long")
    order = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id")
    found = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
    return found.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
