"""A kept vector index: coarse cells, product-quantised residuals, exact scores for what is left.

Fit. Cell centres and code books come from a sample of at most ``SAMPLE`` vectors, those with the smallest hash of
their id; every vector is indexed. Copies of one vector are indexed once, with their ids beside.

Table. Each vector goes to its closest cell; what remains of it is cut into ``PARTS`` pieces and each piece
becomes the number of its closest code. Cells are kept as blocks of at most ``BLOCK`` vectors (codes and vectors),
so a cell that holds a third of all vectors is many rows.

Search. A query meets the blocks of its ``probes`` closest cells, and no others: tables of piece products give
approximate scores, the best ``pool`` of a block are scored exactly there. Blocks go to the tasks as broadcast pieces, in
rounds of bounded bytes (``nearest.broadcast_rounds``), and a task keeps the best of its queries: no (query, cell) is a row.
``exact`` visits all cells and scores everything. ``tune`` measures recall on held queries against the exact way and
returns the smallest number of probes that reaches a target.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.operators.nearest import BestOf, broadcast_rounds
from tidemark.operators.ordering import top_n
from tidemark.session import cut, scratch_path

SAMPLE, MAX_CELLS, BLOCK, PARTS, CODES, ROUNDS, PLACES = 20_000, 4096, 4096, 8, 256, 12, 9
QUERY_BLOCK = 1024  # queries that meet a block together, at most
POINTS = 4096  # that meet all centres together
TUNED_ON = 64  # queries


def unit(vectors) -> np.ndarray:
    m = np.stack([np.asarray(v, dtype=np.float64) for v in vectors])
    norm = np.linalg.norm(m, axis=1, keepdims=True)
    return m / np.where(norm > 0, norm, 1.0)


def closest_of(points: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each point's closest centre and the squared distance less the point's own square; a few thousand points at a time."""
    of, away, size = np.empty(len(points), dtype=np.int64), np.empty(len(points)), (centres ** 2).sum(axis=1)[None, :]
    for at in range(0, len(points), POINTS):
        some = size - 2 * points[at:at + POINTS] @ centres.T
        of[at:at + POINTS] = some.argmin(axis=1)
        away[at:at + POINTS] = some.min(axis=1)
    return of, away


def k_means(points: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """Centres by Lloyd's rounds over a bounded sample; an empty cell moves to a far point."""
    k = min(k, len(points))
    centres = points[rng.permutation(len(points))[:k]]
    for _ in range(ROUNDS):
        of, away = closest_of(points, centres)
        count = np.bincount(of, minlength=k)
        total = np.zeros_like(centres)
        np.add.at(total, of, points)
        far = np.argsort(-(away + (points ** 2).sum(axis=1)), kind="stable")
        centres = np.where(count[:, None] > 0, total / np.maximum(count, 1)[:, None], centres)
        centres[count == 0] = points[far[:int((count == 0).sum())]]
    return centres


class Quantiser:
    """Centres and one code book a piece."""

    def __init__(self, sample: np.ndarray, cells: int, seed: int = 0) -> None:
        rng = np.random.default_rng(seed)
        self.centres = k_means(sample, cells, rng)
        self.edges = np.linspace(0, sample.shape[1], min(PARTS, sample.shape[1]) + 1).astype(int)
        rest = sample - self.centres[self.closest(sample)]
        self.books = [k_means(rest[:, a:b], CODES, rng) for a, b in zip(self.edges, self.edges[1:])]

    def closest(self, v: np.ndarray) -> np.ndarray:
        return closest_of(v, self.centres)[0]

    def probed(self, v: np.ndarray, probes: int) -> np.ndarray:
        """The ``probes`` cells whose centres are closest, per vector."""
        away = (self.centres ** 2).sum(axis=1)[None, :] - 2 * v @ self.centres.T
        return np.argsort(away, axis=1, kind="stable")[:, :probes]

    def codes(self, v: np.ndarray, cell: np.ndarray) -> np.ndarray:
        rest = v - self.centres[cell]
        return np.stack([((book ** 2).sum(axis=1)[None, :] - 2 * rest[:, a:b] @ book.T).argmin(axis=1)
                         for book, a, b in zip(self.books, self.edges, self.edges[1:])], axis=1).astype(np.uint8)

    def approximate(self, queries: np.ndarray, cell: int, codes: np.ndarray) -> np.ndarray:
        """(queries, vectors): inner products with the vectors that the codes stand for."""
        total = np.repeat((queries @ self.centres[cell])[:, None], len(codes), axis=1)
        for i, (book, a, b) in enumerate(zip(self.books, self.edges, self.edges[1:])):
            total += (queries[:, a:b] @ book.T)[:, codes[:, i]]
        return total


def query_blocks(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        for at in range(0, len(frame), QUERY_BLOCK):
            yield frame.iloc[at:at + QUERY_BLOCK]


class VectorIndex:
    """Vectors of one length below ``root``. Rows are (id, vector) with optional ``board`` and ``day`` to filter by.

    Null ids or vectors, empty vectors and other lengths are refused by ``fit`` and ``add``. Zero vectors score 0.
    """

    def __init__(self, spark: SparkSession, root: str | None = None) -> None:
        self.spark, self.root = spark, (root or scratch_path(spark, "vectors")).rstrip("/")
        self.quantiser, self.size, self.id_type, self._held = None, 0, "long", None

    def fit(self, items: DataFrame, cells: int | None = None, seed: int = 0) -> None:
        self.id_type = items.schema["id"].dataType.simpleString()
        n = items.count()
        chosen = items.select("id", F.col("vector").cast("array<float>").alias("vector")).orderBy(F.xxhash64("id"), "id").limit(SAMPLE).collect()
        if not chosen:
            return
        wanted = cells or int(max(1, min(MAX_CELLS, round(2 * n ** 0.5), len(chosen) // 8)))
        self.quantiser = Quantiser(unit([r["vector"] for r in chosen]), wanted, seed)

    def add(self, items: DataFrame) -> None:
        """Append a batch: its own blocks only. Its ids must be new."""
        if self.quantiser is None:
            self.fit(items)
            if self.quantiser is None:
                return
        for name, kind in (("board", "string"), ("day", "int")):
            if name not in items.columns:
                items = items.withColumn(name, F.lit(None).cast(kind))
        shared, id_type = self.spark.sparkContext.broadcast(self.quantiser), self.id_type
        dims = self.quantiser.centres.shape[1]
        rows = items.select("id", F.col("vector").cast("array<float>").alias("vector"), "board", "day")
        rows = rows.withColumn("vector", F.when(F.col("id").isNotNull() & (F.size("vector") == dims), F.col("vector")).otherwise(
            F.raise_error(F.lit(f"a row has no id or not {dims} components")).cast("array<float>")))
        # copies with the same filter columns are one vector; their ids go to a table of their own
        kept = rows.groupBy("vector", "board", "day").agg(F.min("id").alias("rep"), F.count("*").alias("copies"))
        kept = cut(kept)
        copies = rows.join(kept.where("copies > 1"), (rows["vector"] == kept["vector"]) & rows["board"].eqNullSafe(kept["board"])
                           & rows["day"].eqNullSafe(kept["day"])).select("rep", "id")
        copies.write.mode("append").parquet(f"{self.root}/copies")

        def locate(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for frame in frames:
                if len(frame):
                    v = unit(frame["vector"])
                    cell = shared.value.closest(v)
                    yield pd.DataFrame({"cell": cell, "rep": frame["rep"], "code": [c.tobytes() for c in shared.value.codes(v, cell)],
                                        "vector": frame["vector"], "board": frame["board"], "day": frame["day"]})

        placed = cut(kept.mapInPandas(locate, f"cell int, rep {id_type}, code binary, vector array<float>, board string, day int"))
        sizes = placed.groupBy("cell").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("parts"))  # at most MAX_CELLS rows
        packed = placed.join(F.broadcast(sizes), "cell").withColumn("part", F.pmod(F.xxhash64("rep"), F.col("parts")).cast("int"))
        packed = packed.groupBy("cell", "part").agg(F.sort_array(F.collect_list(F.struct("rep", "code", "vector", "board", "day"))).alias("members"))  # about BLOCK
        packed.withColumn("batch", F.lit(self.size)).write.mode("append").parquet(f"{self.root}/blocks")
        self.size += 1

    def blocks(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/blocks")

    def search(self, queries: DataFrame, k: int, probes: int = 8, pool: int | None = None, itself: bool = False, exact: bool = False) -> DataFrame:
        """(query_id, item_id, score, rank): the k items of the largest cosine, ties to the smaller id.

        ``queries``: (id, vector) with optional ``board``, ``date_from``, ``date_to``. With ``itself`` a query is an item
        and not its own neighbour.
        """
        for name, kind in (("board", "string"), ("date_from", "int"), ("date_to", "int")):
            if name not in queries.columns:
                queries = queries.withColumn(name, F.lit(None).cast(kind))
        query_type = queries.schema["id"].dataType.simpleString()
        if self.quantiser is None:
            return self.spark.createDataFrame([], f"query_id {query_type}, item_id {self.id_type}, score double, rank int")
        shared, wanted, pool = self.spark.sparkContext.broadcast(self.quantiser), k + 1, pool or 4 * (k + 1)
        probes = len(self.quantiser.centres) if exact else min(probes, len(self.quantiser.centres))
        asked = queries.select("id", F.col("vector").cast("array<float>").alias("vector"), "board", F.col("date_from").cast("int").alias("date_from"),
                               F.col("date_to").cast("int").alias("date_to"))
        fields = f"id {query_type}, vector array<float>, board string, date_from int, date_to int"
        asked = cut(asked)
        tasks = min(512, max(1, -(-2 * asked.count() // QUERY_BLOCK)))
        state = asked.select("*", F.lit(None).cast(f"array<{self.id_type}>").alias("reps"), F.lit(None).cast("array<double>").alias("scores")).repartition(tasks)
        copies = self.spark.read.schema(f"rep {self.id_type}, id {self.id_type}").parquet(f"{self.root}/copies")
        # rows that repeat an id share its places; copies take places of their own
        plain = copies.isEmpty() and asked.groupBy("id").agg(F.count("*").alias("n")).where("n > 1").isEmpty()

        def visit(pieces: list, mine: pd.DataFrame) -> BestOf:
            q = unit(mine["vector"])
            best = BestOf(len(mine), wanted)
            for i, (reps, scores) in enumerate(zip(mine["reps"], mine["scores"])):
                if reps is not None and len(reps):
                    best.add(np.full(len(reps), i), np.array(reps), np.asarray(scores, dtype=np.float64))
            best.settle()
            near = np.zeros((len(mine), len(shared.value.centres)), dtype=bool)
            np.put_along_axis(near, shared.value.probed(q, probes), True, 1)
            bounds = [pd.to_numeric(mine[c]).to_numpy(dtype=np.float64, na_value=np.nan) for c in ("date_from", "date_to")]
            filtered = mine["board"].notna().to_numpy() | ~np.isnan(bounds[0]) | ~np.isnan(bounds[1])
            for piece in pieces:
                for cell, ids, codes, raw, boards, days in piece.value:
                    rows = np.flatnonzero(near[:, cell])
                    if len(rows):
                        vectors = unit(np.frombuffer(raw, dtype=np.float32).reshape(len(ids), -1))
                    for at in range(0, len(rows), 256):
                        part = rows[at:at + 256]
                        off = np.zeros((len(part), len(ids)), dtype=bool)
                        for i in np.flatnonzero(filtered[part]):
                            board, low, high = mine["board"].iloc[part[i]], bounds[0][part[i]], bounds[1][part[i]]
                            if board is not None:
                                off[i] |= boards != board
                            if not (np.isnan(low) and np.isnan(high)):
                                off[i] |= ~((days >= (-np.inf if np.isnan(low) else low)) & (days <= (np.inf if np.isnan(high) else high)))
                        if exact or pool >= len(ids):
                            score = np.round(q[part] @ vectors.T, PLACES)
                            score[off] = -np.inf
                            least = best.kth[part]
                            if len(ids) > wanted and np.isneginf(least).any():
                                least = np.maximum(least, -np.partition(-score, wanted - 1, axis=1)[:, wanted - 1])
                            row, col = np.nonzero((score >= least[:, None]) & np.isfinite(score))
                            best.add(part[row], ids[col], score[row, col])
                        else:
                            rough = shared.value.approximate(q[part], cell, codes)
                            rough[off] = -np.inf
                            chosen = np.argpartition(-rough, pool - 1, axis=1)[:, :pool]
                            score = np.round(np.einsum("qd,qpd->qp", q[part], vectors[chosen]), PLACES)
                            score[np.take_along_axis(off, chosen, 1)] = -np.inf
                            row, col = np.nonzero((score >= best.kth[part][:, None]) & np.isfinite(score))
                            best.add(part[row], ids[chosen[row, col]], score[row, col])
                    best.settle_if_many()
            best.settle()
            return best

        def carried(pieces: list):
            def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
                for mine in query_blocks(frames):
                    best = visit(pieces, mine)
                    edges = np.searchsorted(best.row, np.arange(len(mine) + 1))
                    cell = lambda v: [[] if v is None else v[x:y].tolist() for x, y in zip(edges, edges[1:])]
                    yield mine.assign(reps=cell(best.item), scores=cell(best.score))
            return run

        def ended(pieces: list):
            def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
                for mine in query_blocks(frames):
                    best = visit(pieces, mine)
                    if best.item is None:
                        continue
                    row, item, score, asking = best.row, best.item, best.score, mine["id"].to_numpy()
                    if plain and itself:
                        other = item != asking[row]
                        row, item, score = row[other], item[other], score[other]
                    place = np.arange(len(row)) - np.searchsorted(row, row) + 1
                    kept = place <= (k if plain else wanted)
                    yield pd.DataFrame({"query_id": asking[row[kept]], "rep": item[kept], "score": score[kept], "rank": place[kept].astype(np.int32)})
            return run

        rounds = self._rounds()
        pieces = next(rounds, [])
        for following in rounds:
            state = cut(state.mapInPandas(carried(pieces), f"{fields}, reps array<{self.id_type}>, scores array<double>"))
            pieces = following
        found = state.mapInPandas(ended(pieces), f"query_id {query_type}, rep {self.id_type}, score double, rank int")
        if plain:
            return found.withColumnRenamed("rep", "item_id")
        best = top_n(found.drop("rank"), ["query_id"], [F.col("score").desc(), F.col("rep").asc()], wanted, "place").select("query_id", "rep", "score")
        copies = top_n(copies, ["rep"], [F.col("id").asc()], wanted, "nth")
        best = best.join(copies.select("rep", "id"), "rep", "left").select("query_id", F.coalesce("id", "rep").alias("item_id"), "score")
        if itself:
            best = best.where("item_id <> query_id")
        return top_n(best, ["query_id"], [F.col("score").desc(), F.col("item_id").asc()], k)

    def _rounds(self) -> Iterator[list]:
        """Lists of broadcast pieces of blocks, one list a round; an index of one round is kept for the next search."""
        if self._held and self._held[0] == self.size:
            yield self._held[1]
            return
        stored = self.blocks().select("cell", "part", "batch", "members")
        schema = f"cell int, part int, batch int, ids array<{self.id_type}>, codes binary, vectors binary, boards array<string>, days array<int>"

        def pack(batches):
            for batch in batches:
                for i in range(len(batch)):
                    members = batch.column("members").slice(i, 1).flatten()
                    one = lambda name: pc.struct_field(members, name)
                    raw = one("vector").flatten().to_numpy(zero_copy_only=False).astype(np.float32).tobytes()
                    row = [batch.column(c).slice(i, 1) for c in ("cell", "part", "batch")]
                    listed = lambda values: pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)
                    yield pa.RecordBatch.from_arrays([*row, listed(one("rep")), pa.array([b"".join(one("code").to_pylist())], pa.binary()), pa.array([raw], pa.binary()),
                                                      listed(one("board")), listed(one("day"))], ["cell", "part", "batch", "ids", "codes", "vectors", "boards", "days"])

        packed = cut(stored.mapInArrow(pack, schema).withColumn("block", F.monotonically_increasing_id()))

        def told(r) -> tuple:
            ids = np.array(r["ids"])
            return (r["cell"], ids, np.frombuffer(bytes(r["codes"]), dtype=np.uint8).reshape(len(ids), -1), bytes(r["vectors"]),
                    np.array(r["boards"], dtype=object), np.array([np.nan if d is None else d for d in r["days"]], dtype=np.float64))

        count = 0
        for pieces in broadcast_rounds(self.spark, packed, told):
            count, last = count + 1, pieces
            yield pieces
        if count == 1:
            self._held = (self.size, last)

    def recall(self, queries: DataFrame, k: int, truth: DataFrame, **how) -> float:
        """The share of ``truth`` (query_id, item_id) that is found."""
        found = self.search(queries, k, **how).select("query_id", "item_id").withColumn("hit", F.lit(1))
        row = truth.select("query_id", "item_id").join(found, ["query_id", "item_id"], "left").agg(F.count("*").alias("n"), F.count("hit").alias("hits")).first()
        return row["hits"] / row["n"] if row["n"] else 1.0

    def tune(self, queries: DataFrame, k: int, target: float = 0.95, itself: bool = False) -> tuple[int, float]:
        """(probes, recall): the first doubling of probes whose recall on at most TUNED_ON queries reaches the target."""
        if self.quantiser is None:
            return 1, 1.0
        held = cut(queries.orderBy(F.xxhash64("id", F.lit(7)), "id").limit(TUNED_ON))
        truth = cut(self.search(held, k, itself=itself, exact=True))
        probes, cells = 1, len(self.quantiser.centres)
        while True:
            reached = self.recall(held, k, truth, probes=probes, itself=itself)
            if reached >= target or probes >= cells:
                return probes, reached
            probes = min(cells, probes * 2)
