"""A kept inverted index: compressed posting blocks, block-max retrieval, segments that grow and merge.

Layout. The units of a batch are dealt, as the scan's tasks read them, into ranges of at most ``RANGE_UNITS``; a
task builds all posting lists of its ranges, so no posting is shuffled before it is compressed. A list is cut into
blocks of ``BLOCK_POSTINGS`` (variable-byte gaps and counts). A block also keeps its best (count, length) pairs: no
posting of it can score higher than the best of these, whatever the corpus' average length has become. Blocks lie
in folders by the hash of their term, sorted by term, so a query reads its terms' row groups only.

Segments. A batch writes one segment and nothing else; a small table of versions says which segments are live.
``compact`` rewrites small segments as one without reading a text again.

Retrieval. From block bounds alone follows a score that the k-th hit of a query must reach, and which ranges can
still hold a hit; only blocks of those are read. Within a range, block ends cut the units into intervals whose
bound is the sum over the blocks that cover them; intervals are scored in falling order of bound until none can
reach the k-th score any more, and within them rare terms come first, so that a frequent one is only scored for
units that can still get there. The result is that of a full scan.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidemark.functions import text as tx
from tidemark.functions.numeric import exact_round
from tidemark.operators.ordering import ordered_prefix, top_n
from tidemark.operators.scalars import attach
from tidemark.session import cut, scratch_path

RANGE_UNITS, RANGE_WORDS, BLOCK_POSTINGS = 8192, 4_000_000, 128
QUERY_BLOCK = 256  # queries that walk a range together
K1, B = 1.2, 0.75  # fixed values of the score
FIXED, MICRO = 1e12, 1_000_000  # scores are whole numbers of 1e-12, hits are ranked by 1e-6
FIRST_INTERVALS = 16

BLOCK_FIELDS = ("range_id long, term string, block int, postings int, first int, last int, gaps binary, counts binary, "
                "top_count array<int>, top_length array<int>")


# --- compression ------------------------------------------------------------------------

def pack(values: np.ndarray) -> tuple[bytes, np.ndarray]:
    """Variable-byte code of whole numbers (seven bits a byte, the last byte has its top bit set), and each code's size."""
    values = values.astype(np.uint64)
    size = np.ones(len(values), dtype=np.int64)
    for bits in range(7, 63, 7):
        size += values >= np.uint64(1) << np.uint64(bits)
    end = np.cumsum(size)
    out = np.zeros(int(end[-1]) if len(end) else 0, dtype=np.uint8)
    for step in range(int(size.max(initial=0))):
        has = size > step
        out[end[has] - 1 - step] = (values[has] >> np.uint64(7 * step) & np.uint64(127)).astype(np.uint8)
    out[end - 1] |= 128
    return out.tobytes(), size


def unpack(data: bytes) -> np.ndarray:
    raw = np.frombuffer(data, dtype=np.uint8)
    ends = np.flatnonzero(raw & 128)
    starts = np.r_[0, ends[:-1] + 1] if len(ends) else ends
    width, out = ends - starts + 1, np.zeros(len(ends), dtype=np.int64)
    for step in range(int(width.max(initial=0))):
        has = width > step
        out[has] = out[has] << 7 | (raw[starts[has] + step] & 127)
    return out


def posting_blocks(unit: np.ndarray, term: np.ndarray, count: np.ndarray, length: np.ndarray) -> dict[str, list]:
    """Blocks of postings sorted by (term, unit); ``length`` is that of each posting's unit."""
    if not len(unit):
        return {}
    at = np.arange(len(unit))
    new_term = np.r_[True, term[1:] != term[:-1]]
    within = at - np.maximum.accumulate(np.where(new_term, at, 0))
    start = np.flatnonzero(within % BLOCK_POSTINGS == 0)
    block = np.cumsum(within % BLOCK_POSTINGS == 0) - 1
    gap = unit.copy()
    gap[1:] -= unit[:-1]
    gap[start] = 0  # a block's first unit is kept beside it
    gaps, gap_size = pack(gap)
    counts, count_size = pack(count)
    gap_end, count_end = np.cumsum(np.add.reduceat(gap_size, start)), np.cumsum(np.add.reduceat(count_size, start))
    # pairs that no other posting of the block beats in both: by falling count, each new smallest length
    order = np.lexsort((length, -count, block))
    wide = int(length.max()) + 1
    falling = length[order] - block[order] * wide
    best = np.r_[True, falling[1:] < np.minimum.accumulate(falling)[:-1]]
    top = order[best]
    top_of = np.searchsorted(block[top], np.arange(len(start) + 1))
    ends = np.r_[start[1:], len(unit)] - 1
    cutter = lambda data, end: [data[a:b] for a, b in zip(np.r_[0, end[:-1]].tolist(), end.tolist())]
    tops = lambda values: [values[top[a:b]].tolist() for a, b in zip(top_of[:-1].tolist(), top_of[1:].tolist())]
    return {"term": term[start], "block": (within[start] // BLOCK_POSTINGS).tolist(), "postings": (ends - start + 1).tolist(),
            "first": unit[start].tolist(), "last": unit[ends].tolist(), "gaps": cutter(gaps, gap_end), "counts": cutter(counts, count_end),
            "top_count": tops(count), "top_length": tops(length)}


# --- building ---------------------------------------------------------------------------

def _counted(words: pa.Array, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array]:
    """(unit, term number, count) sorted by term and unit, and the terms."""
    coded = words.dictionary_encode()
    key = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64) << 32 | unit
    key, count = np.unique(key, return_counts=True)
    return key & 0xFFFFFFFF, key >> 32, count, coded.dictionary


def _range_rows(range_id: int, units: list, lengths: np.ndarray, kept: dict[str, list], blocks: dict[str, list], schema: pa.Schema) -> pa.RecordBatch:
    """One range's row (its units) and its blocks, as rows of one table."""
    n = len(blocks.get("term", ()))
    columns = {"range_id": [range_id] * (n + 1), "units": [units] + [None] * n, "lengths": [lengths.tolist()] + [None] * n}
    columns.update({name: [values] + [None] * n for name, values in kept.items()})
    columns.update({name: [None] + list(values) for name, values in blocks.items()})
    return pa.RecordBatch.from_arrays([pa.array(columns.get(f.name, [None] * (n + 1)), f.type) for f in schema], schema=schema)


def _builder(segment: int, filters: list[str], schema: pa.Schema, limit: int):
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, chunk = TaskContext.get().partitionId(), 0
        held: list[pa.RecordBatch] = []
        units = words = 0

        def flush() -> pa.RecordBatch:
            nonlocal held, units, words, chunk
            table = pa.Table.from_batches(held).combine_chunks()
            lists = table.column("words").combine_chunks()
            size = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            unit, term, count, names = _counted(lists.flatten(), np.repeat(np.arange(len(size)), size))
            blocks = posting_blocks(unit, term, count, size[unit])
            if blocks:
                blocks["term"] = names.take(pa.array(blocks["term"])).to_pylist()
            range_id = segment << 44 | part << 22 | chunk
            rows = _range_rows(range_id, table.column("unit").to_pylist(), size, {f: table.column(f).to_pylist() for f in filters}, blocks, schema)
            held, units, words, chunk = [], 0, 0, chunk + 1
            return rows

        for batch in batches:
            at = 0
            while at < batch.num_rows:
                piece = batch.slice(at, limit - units)
                held.append(piece)
                units, words, at = units + piece.num_rows, words + len(piece.column("words").flatten()), at + piece.num_rows
                if units >= limit or words >= RANGE_WORDS:
                    yield flush()
        if units:
            yield flush()
    return build


# --- the walk ---------------------------------------------------------------------------

def _weight(idf: float, count: np.ndarray, length: np.ndarray, average: float) -> np.ndarray:
    """A term's part of the score, in units of 1e-12."""
    return np.floor(idf * (count * (K1 + 1) / (count + K1 * (1 - B + B * length / average))) * FIXED + 0.5).astype(np.int64)


def _micro(fixed):
    return (fixed + MICRO // 2) // MICRO


class _Block:
    """A posting block that is decoded when first asked for."""

    def __init__(self, row) -> None:
        self.row, self.first, self.last, self.postings = row, int(row["first"]), int(row["last"]), int(row["postings"])
        self._read = None

    def bound(self, idf: float, average: float) -> int:
        return int(_weight(idf, np.asarray(self.row["top_count"], dtype=np.float64), np.asarray(self.row["top_length"], dtype=np.float64), average).max())

    def read(self) -> tuple[np.ndarray, np.ndarray]:
        if self._read is None:
            self._read = self.first + np.cumsum(unpack(self.row["gaps"])), unpack(self.row["counts"]).astype(np.float64)
        return self._read


def walk(terms: list[tuple[float, list[_Block]]], lengths: np.ndarray, allowed: np.ndarray | None, average: float, k: int, floor: int) -> tuple[np.ndarray, np.ndarray, int]:
    """(unit, score) of all units that may be among the k best, and the postings that were scored.

    ``terms``: the blocks of one query's terms as (idf, blocks). ``floor``: the score in 1e-6 that the k-th hit
    reaches at least. Of the intervals of one step, terms with large bounds are scored first; a posting is left out
    where the unit's score so far and the bounds of the terms to come stay below the floor.
    """
    n, reach = len(lengths), []
    for idf, blocks in terms:
        rise = np.zeros(n + 1, dtype=np.int64)
        for block in blocks:
            bound = block.bound(idf, average)
            rise[block.first] += bound
            rise[block.last + 1] -= bound
        reach.append(np.cumsum(rise[:-1]))
    order = sorted(range(len(terms)), key=lambda i: -int(reach[i].max(initial=0)))
    terms, reach = [terms[i] for i in order], [reach[i] for i in order]
    rest = np.zeros((len(terms) + 1, n), dtype=np.int64)  # bounds of this term and those after it
    for i in range(len(terms) - 1, -1, -1):
        rest[i] = rest[i + 1] + reach[i]
    edges = np.unique([0, n, *(e for _, blocks in terms for b in blocks for e in (b.first, b.last + 1))])
    bounds = _micro(rest[0][edges[:-1]])
    order = np.argsort(-bounds, kind="stable")
    total, seen, scored, done, step = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=bool), 0, 0, FIRST_INTERVALS
    while done < len(order) and bounds[order[done]] >= max(floor, 1):
        now = order[done:done + step]
        now = now[bounds[now] >= max(floor, 1)]
        done, step = done + step, step * 2
        live = np.zeros(n + 1, dtype=np.int64)
        np.add.at(live, edges[now], 1)
        np.add.at(live, edges[now + 1], -1)
        live = np.cumsum(live[:-1]) > 0
        if allowed is not None:
            live &= allowed
        for i, (idf, blocks) in enumerate(terms):
            open_units = live & (_micro(total + rest[i]) >= floor)
            some = np.r_[0, np.cumsum(open_units)]
            for block in blocks:
                if some[block.last + 1] == some[block.first]:
                    continue
                unit, count = block.read()
                pick = open_units[unit]
                unit, count = unit[pick], count[pick]
                total[unit] += _weight(idf, count, lengths[unit], average)
                seen[unit] = True
                scored += len(unit)
            hits = _micro(total[seen])
            if len(hits) >= k:
                floor = max(floor, int(np.partition(hits, len(hits) - k)[len(hits) - k]))
    unit = np.flatnonzero(seen & (_micro(total) >= floor))
    return unit, total[unit], scored


def _walker(k: int, average: float, query_type: str):
    def run(key, frame: pd.DataFrame, ranges: pd.DataFrame) -> pd.DataFrame:
        out, place = [], ranges.iloc[0] if len(ranges) else None
        if place is None or not len(frame):
            return pd.DataFrame({"query_id": [], "unit": [], "score": [], "scored": [], "postings": []})
        units, lengths = list(place["units"]), np.asarray(place["lengths"], dtype=np.float64)
        asked: dict = {}
        for row in frame.to_dict("records"):
            block = _Block(row)
            for q in row["asked"]:
                asked.setdefault(q["query_id"], (q, {}))[1].setdefault(row["term"], (q["idf"], []))[1].append(block)
        for query_id, (q, terms) in asked.items():
            allowed = None
            if q["board"] is not None:
                allowed = np.array([b == q["board"] for b in place["board"]], dtype=bool)
            if q["date_from"] is not None or q["date_to"] is not None:
                day = np.array([np.nan if d is None else d for d in place["day"]], dtype=np.float64)
                fits = (day >= (-np.inf if q["date_from"] is None else q["date_from"])) & (day <= (np.inf if q["date_to"] is None else q["date_to"]))
                allowed = fits if allowed is None else allowed & fits
            unit, score, scored = walk(list(terms.values()), lengths, allowed, average, k, q["floor"] or 0)
            best = sorted(range(len(unit)), key=lambda i: (-_micro(int(score[i])), units[unit[i]]))[:k]
            out.append(pd.DataFrame({"query_id": query_id, "unit": [units[unit[i]] for i in best], "score": score[best] if best else [],
                                     "scored": 0, "postings": 0}))
            out.append(pd.DataFrame({"query_id": [query_id], "unit": [None], "score": [0], "scored": [scored], "postings": [sum(b.postings for _, blocks in terms.values() for b in blocks)]}))
        return pd.concat(out)
    return run


# --- the table --------------------------------------------------------------------------

class PostingIndex:
    """An inverted index below ``root``. One writer at a time; readers keep the version they opened.

    Units are (unit, text) with optional ``board`` and ``day`` (days since 1970) to filter by. Null texts and
    texts without words count as units of length 0. A unit that is indexed already isn't added again.
    """

    def __init__(self, spark: SparkSession, root: str | None = None, buckets: int = 16, range_units: int = RANGE_UNITS) -> None:
        self.spark, self.root, self.buckets, self.range_units = spark, (root or scratch_path(spark, "postings")).rstrip("/"), buckets, range_units
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.root}/live")
        self._live, self._fs = path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def segments(self) -> list[int]:
        """Live segments: a handful of numbers."""
        if not self._fs.exists(self._live):
            return []
        versions = self.spark.read.schema("segment long, version long").parquet(f"{self.root}/live")
        newest = versions.agg(F.max("version")).first()[0]
        return sorted(r["segment"] for r in versions.where(F.col("version") == newest).collect() if r["segment"] is not None)

    def _publish(self, segments: list[int]) -> None:
        versions = self.spark.read.schema("segment long, version long").parquet(f"{self.root}/live") if self._fs.exists(self._live) else None
        version = 0 if versions is None else versions.agg(F.max("version")).first()[0] + 1
        self.spark.createDataFrame([(s,) for s in segments], "segment long").coalesce(1).write.parquet(f"{self.root}/live/version={version}")

    def _schema(self, id_type: str) -> str:
        return f"{BLOCK_FIELDS}, units array<{id_type}>, lengths array<int>, board array<string>, day array<int>"

    def _table(self, segments: list[int] | None = None) -> DataFrame:
        segments = self.segments() if segments is None else segments
        paths = [f"{self.root}/data/segment={s}" for s in segments]
        rows = self.spark.read.option("basePath", f"{self.root}/data").parquet(*paths)
        return rows.withColumns({"segment": F.col("segment").cast("long"), "bucket": F.col("bucket").cast("int")})

    def ranges(self, segments: list[int] | None = None) -> DataFrame:
        return self._table(segments).where("bucket = -1").select("segment", "range_id", "units", "lengths", "board", "day")

    def blocks(self, segments: list[int] | None = None) -> DataFrame:
        names = [f.split()[0] for f in BLOCK_FIELDS.split(", ")]
        return self._table(segments).where("bucket >= 0").select("segment", "bucket", *names)

    def _write(self, rows: DataFrame, segment: int) -> None:
        bucket = F.when(F.col("term").isNull(), F.lit(-1)).otherwise(self._bucket(F.col("term")))
        placed = rows.withColumn("bucket", bucket).hint("rebalance", F.col("bucket")).sortWithinPartitions("bucket", "term", "range_id", "block")
        placed.write.option("parquet.block.size", 4 << 20).partitionBy("bucket").parquet(f"{self.root}/data/segment={segment}")

    def _bucket(self, term):
        return F.pmod(F.xxhash64(term), F.lit(self.buckets)).cast("int")

    def _next(self) -> int:
        return max(self.segments(), default=-1) + 1

    def add(self, units: DataFrame) -> int | None:
        """Index the units that aren't yet, as one new segment; its number, or None if there was nothing to add."""
        live = self.segments()
        for name, kind in (("board", "string"), ("day", "int")):
            if name not in units.columns:
                units = units.withColumn(name, F.lit(None).cast(kind))
        if live:
            known = self.ranges(live).select(F.explode("units").alias("unit"))
            units = units.join(known, "unit", "left_anti")
        words = tx.tokens(F.coalesce(F.col("text"), F.lit("")))
        units = units.select("unit", words.alias("words"), F.col("board").cast("string").alias("board"), F.col("day").cast("int").alias("day"))
        if live:  # a join's rows come in any order: keep the one they came in
            units = cut(units)
        if units.isEmpty():
            return None
        segment, id_type = self._next(), units.schema["unit"].dataType.simpleString()
        schema = T._parse_datatype_string(self._schema(id_type))
        from pyspark.sql.pandas.types import to_arrow_schema
        rows = units.mapInArrow(_builder(segment, ["board", "day"], to_arrow_schema(schema), self.range_units), schema)
        self._write(rows, segment)
        self._publish([*live, segment])
        return segment

    def compact(self, small: int) -> int | None:
        """Merge the live segments of fewer than ``small`` units into one; texts aren't read again."""
        live = self.segments()
        if not live:
            return None
        size = self.ranges(live).groupBy("segment").agg(F.sum(F.size("units")).alias("n")).where(F.col("n") < small)
        old = sorted(r["segment"] for r in size.collect())
        if len(old) < 2:
            return None
        segment, limit = self._next(), self.range_units
        ranges, blocks = self.ranges(old), self.blocks(old)
        placed = ordered_prefix(ranges.select("range_id", F.size("units").cast("long").alias("n")), [F.col("range_id").asc()], running={"upto": "n"})
        target = placed.select("range_id", (F.lit(segment).cast("long") * (1 << 44) + F.expr(f"(upto - 1) div {limit}")).alias("target"))
        target = cut(target)
        id_type = ranges.schema["units"].dataType.elementType.simpleString()

        def merge(key, places: pd.DataFrame, lists: pd.DataFrame) -> pd.DataFrame:
            places = places.sort_values("range_id")
            join = lambda name: [x for row in places[name] for x in row]
            shift = dict(zip(places["range_id"], np.cumsum([0, *(len(u) for u in places["units"])])))
            length = np.array(join("lengths"), dtype=np.int64)
            read = [_Block(row) for row in lists.sort_values(["term", "range_id", "block"]).to_dict("records")]
            unit = np.concatenate([b.read()[0] + shift[b.row["range_id"]] for b in read]) if read else np.empty(0, dtype=np.int64)
            count = np.concatenate([b.read()[1] for b in read]).astype(np.int64) if read else unit
            term = np.repeat(np.array([b.row["term"] for b in read], dtype=object), [b.postings for b in read]) if read else np.empty(0, dtype=object)
            made = posting_blocks(unit, term, count, length[unit])
            batch = _range_rows(int(key[0]), join("units"), length, {"board": join("board"), "day": [None if d is None or d != d else int(d) for d in join("day")]}, made, arrow)
            return batch.to_pandas()

        from pyspark.sql.pandas.types import to_arrow_schema
        schema = T._parse_datatype_string(self._schema(id_type))
        arrow = to_arrow_schema(schema)
        left = ranges.join(target, "range_id").groupBy("target")
        right = blocks.join(target, "range_id").groupBy("target")
        self._write(left.cogroup(right).applyInPandas(merge, schema), segment)
        self._publish([*(s for s in live if s not in old), segment])
        return segment

    def describe(self) -> DataFrame:
        """(segment, units, words, postings, blocks, bytes) of every live segment."""
        units = self.ranges().groupBy("segment").agg(
            F.sum(F.size("units")).alias("units"), F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x)).alias("words"))
        lists = self.blocks().groupBy("segment").agg(F.sum("postings").alias("postings"), F.count("*").alias("blocks"),
                                                     F.sum(F.length("gaps") + F.length("counts")).alias("bytes"))
        return units.join(lists, "segment", "left")

    def search(self, queries: DataFrame, top: int = 40) -> tuple[DataFrame, DataFrame]:
        """((query_id, unit, score, rank), (query_id, postings, read, scored)).

        ``queries``: (query_id, query) with optional ``board``, ``date_from`` and ``date_to`` (days since 1970);
        a filter leaves the statistics of the score alone. The second table holds every query's postings, those of
        the blocks that were read and those that were scored.
        """
        for name, kind in (("board", "string"), ("date_from", "int"), ("date_to", "int")):
            if name not in queries.columns:
                queries = queries.withColumn(name, F.lit(None).cast(kind))
        live = self.segments()
        ranges, blocks = self.ranges(live), self.blocks(live)
        asked = queries.select("query_id", "board", "date_from", "date_to", F.explode(F.array_distinct(tx.tokens(F.col("query")))).alias("term"))
        asked = cut(asked.withColumn("bucket", self._bucket(F.col("term"))))
        stats = ranges.agg(F.sum(F.size("units")).cast("double").alias("_docs"),
                           (F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x)) / F.sum(F.size("units"))).alias("_avg"))
        average = stats.first()["_avg"] or 1.0
        terms = asked.select("bucket", "term").distinct()
        meta = cut(blocks.select("bucket", "term", "range_id", "block", "postings", "top_count", "top_length").join(terms, ["bucket", "term"]))
        df = meta.groupBy("term").agg(F.sum("postings").alias("df"))
        idf = F.log(1 + (F.col("_docs") - F.col("df") + 0.5) / (F.col("df") + 0.5))
        weights = cut(asked.join(df, "term").transform(attach, stats).select(*asked.columns, idf.alias("idf"), "df"))

        pair = lambda c, n: F.col("idf") * (c * (K1 + 1) / (c + K1 * (1 - B + B * n / F.lit(average)))) * FIXED
        bound = F.floor(F.array_max(F.zip_with("top_count", "top_length", pair)) + 0.5)
        bounded = cut(weights.select("query_id", "term", "board", "date_from", "date_to", "idf").join(meta, "term").select(
            "query_id", "term", "board", "date_from", "date_to", "range_id", "block", bound.alias("bound")))
        # every bound is some unit's score for one term: the k-th largest of a term is a score the k-th hit reaches
        free = bounded.where("board is null and date_from is null and date_to is null")
        kth = top_n(free, ["query_id", "term"], [F.col("bound").desc(), F.col("range_id").asc(), F.col("block").asc()], top).where(F.col("rank") == top)
        floors = kth.groupBy("query_id").agg(F.max("bound").alias("floor"))
        reach = bounded.groupBy("query_id", "range_id", "term").agg(F.max("bound").alias("bound")).groupBy("query_id", "range_id").agg(F.sum("bound").alias("reach"))
        in_micro = lambda c: F.expr(f"({c} + {MICRO // 2}) div {MICRO}")
        alive = reach.join(floors, "query_id", "left").where(F.col("floor").isNull() | (in_micro("reach") >= in_micro("floor")))
        alive = alive.select("query_id", "range_id", in_micro("floor").alias("floor"))

        turn = F.pmod(F.xxhash64("query_id"), F.lit(-(-max(1, queries.count()) // QUERY_BLOCK)))
        wanted = weights.join(alive, "query_id").groupBy("bucket", "term", "range_id", turn.alias("turn")).agg(
            F.collect_list(F.struct("query_id", "idf", "board", "date_from", "date_to", "floor")).alias("asked"))  # at most the queries of a turn
        # one column as key: places are joined by range before, and a partitioning by that alone must not be taken for theirs
        place = F.concat_ws("-", "range_id", "turn")
        lists = blocks.join(wanted, ["bucket", "term", "range_id"]).select(
            place.alias("place"), "term", "block", "postings", "first", "last", "gaps", "counts", "top_count", "top_length", "asked")
        places = ranges.join(wanted.select("range_id", "turn").distinct(), "range_id").select(
            place.alias("place"), "units", "lengths", "board", "day")
        query_type, id_type = queries.schema["query_id"].dataType.simpleString(), ranges.schema["units"].dataType.elementType.simpleString()
        found = lists.groupBy("place").cogroup(places.groupBy("place")).applyInPandas(
            _walker(top, average, query_type), f"query_id {query_type}, unit {id_type}, score long, scored long, postings long")
        found = cut(found)
        hits = found.where("unit is not null").select("query_id", "unit", exact_round(F.col("score") / F.lit(FIXED), 6).alias("score"))
        hits = top_n(hits, ["query_id"], [F.col("score").desc(), F.col("unit").asc()], top)
        work = found.groupBy("query_id").agg(F.sum("postings").alias("read"), F.sum("scored").alias("scored"))
        all_postings = weights.groupBy("query_id").agg(F.sum("df").alias("postings"))
        return hits, all_postings.join(work, "query_id", "left").select(
            "query_id", "postings", F.coalesce("read", F.lit(0)).alias("read"), F.coalesce("scored", F.lit(0)).alias("scored"))
