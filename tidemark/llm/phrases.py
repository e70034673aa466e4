"""Phrases whose words keep together, counted by broadcast double-array tries.

Words and pieces. A text (A-Z lower-cased) is cut into pieces at punctuation and line ends, pieces into words at
spaces and tabs. A phrase lies within a piece. Everything is counted for each language by itself.

Candidates. A phrase can only occur ``least`` times if both phrases one word shorter do. So level by level, tasks
take from their texts the phrases both of whose parts are frequent, equal ones as one row with a count, and sums
over all tasks leave the candidates. Which parts are frequent is told by a bitmap of fixed size: a wrong bit
costs a row, never a phrase.

Counts. Candidates of all lengths are dealt by range into shards of bounded size, each a double-array trie.
Shards are broadcast in rounds of bounded bytes. A task starts at every word of its texts and advances all
positions byte by byte at once; accepting states are counted by ``bincount``, and the tasks' vectors are summed in
slices, first some tasks', then these sums.
"""

from __future__ import annotations

import math
import pickle
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from tidemark.llm.common import GOLDEN, mix64, only, utf8, written
from tidemark.llm.double_array import DoubleArray

BLOCK_BYTES = 4 << 20  # of texts that a task takes together
TEXTS = 256  # that are taken out of a batch at once
ROWS = 50_000  # that a task hands over at once
BITS = 26  # of a position in the bitmap of frequent phrases
SHARD_BYTES = 6 << 20  # of the keys of a trie
ROUND_BYTES = 96 << 20  # of tries broadcast together
SLICE = 4096  # keys of a trie whose counts are one row
# Fixed values of the contract: where pieces end, what parts words (bytes)
PIECE_ENDS = b".,;:!?\x0a\x0b\x0c\x0d"
BYTES = bytes(0x0A if b in PIECE_ENDS else 0x20 if b == 0x09 else b + 32 if 65 <= b <= 90 else b for b in range(256))
UNKNOWN = "und"

PHRASES = "lang string, phrase binary, c long"


class Block:
    """Texts of one language as one byte array: words joined by one space, pieces by one line end, one at the end."""

    def __init__(self, texts: list[bytes]) -> None:
        data = b"\n".join(texts).translate(BYTES)
        if b"  " in data:
            data = re.sub(b" {2,}", b" ", data)
        data = re.sub(b" ?\n[ \n]*", b"\n", data).strip(b" \n") + b"\n"
        self.text = np.frombuffer(data, dtype=np.uint8)
        self.end = np.flatnonzero((self.text == 0x20) | (self.text == 0x0A)) if len(data) > 1 else np.empty(0, dtype=np.int64)
        self.start = np.r_[0, self.end[:-1] + 1] if len(self.end) else self.end
        self.last = self.text[self.end] == 0x0A

    def words(self) -> tuple[np.ndarray, list[bytes]]:
        """Number of every word, and the distinct words."""
        kept = np.ones(len(self.text), dtype=bool)
        kept[self.end] = False
        kept[len(self.text) - 1] = False
        return _number(self.text[kept], self.end - self.start)

    def slices(self, at: np.ndarray, words: int) -> pa.Array:
        """The phrases of ``words`` words from the words ``at`` on."""
        start, size = self.start[at], self.end[at + words - 1] - self.start[at]
        offsets = np.concatenate([[0], np.cumsum(size)])
        picked = self.text[np.repeat(start - offsets[:-1], size) + np.arange(offsets[-1])]
        return pa.Array.from_buffers(pa.large_binary(), len(at), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(picked)]).cast(pa.binary())


def _number(data: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
    offsets = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
    words = pa.Array.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))])
    coded = words.dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary.to_pylist()


def blocks(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[tuple[str, Block]]:
    """(language, block) of the batches' texts; a block holds a text longer than it whole."""
    held, size = {}, 0
    for part in (batch.slice(i, TEXTS) for batch in batches for i in range(0, batch.num_rows, TEXTS)):
        for lang, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
            held.setdefault(lang, []).append(text)
            size += len(text)
            if size >= limit:
                yield from ((k, Block(v)) for k, v in held.items())
                held, size = {}, 0
    yield from ((k, Block(v)) for k, v in held.items())


def _seed(lang: str) -> int:
    return xxhash.xxh3_64_intdigest(utf8(lang))


def _hash(words: list[bytes], lang: str) -> np.ndarray:
    seed = _seed(lang)
    return np.fromiter((xxhash.xxh3_64_intdigest(w, seed) for w in words), dtype=np.uint64, count=len(words))


def _join(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix64(left * GOLDEN + right)


def _known(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    at = hashes >> np.uint64(59 - len(bitmap).bit_length())  # the bits it was made with
    return (bitmap[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)


def grams(lang: str, block: Block, words: int, bitmap: np.ndarray | None) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """The block's distinct phrases of ``words`` words whose two parts may be frequent, and their counts, bit by bit."""
    ids, names = block.words()
    if words == 1:
        count = np.bincount(ids, minlength=len(names))
        yield from ((pa.array(names[i:i + ROWS], pa.binary()), count[i:i + ROWS]) for i in range(0, len(names), ROWS))
        return
    hashes = _hash(names, lang)[ids]
    at = np.arange(max(len(ids) - words + 1, 0))
    for i in range(words - 1):
        at = at[~block.last[at + i]]
    # hash of the words - 1 words from every position on; where they leave the piece it isn't read
    part = hashes
    for i in range(1, words - 1):
        part = _join(part[:-1], hashes[i:])
    known = _known(bitmap, part)
    at = at[known[at] & known[at + 1]]
    code = ids[at]
    for i in range(1, words):
        code = np.unique(code, return_inverse=True)[1] if i > 1 else code
        code = code << 32 | ids[at + i]
    _, first, count = np.unique(code, return_index=True, return_counts=True)
    yield from ((block.slices(at[first[i:i + ROWS]], words), count[i:i + ROWS]) for i in range(0, len(first), ROWS))


def _texts(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    rows = only(docs, text_col, lang_col)
    return rows.select(F.coalesce(F.col(f"`{lang_col}`"), F.lit(UNKNOWN)).alias("lang"), F.col(f"`{text_col}`").cast("binary").alias("text")).where("text is not null")


def _level(texts: DataFrame, words: int, bitmap: np.ndarray | None) -> DataFrame:
    """(lang, phrase, c) of one length, summed over all tasks."""
    shared = None if bitmap is None else texts.sparkSession.sparkContext.broadcast(bitmap)
    limit = BLOCK_BYTES

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, block in blocks(batches, limit):
            if len(block.end) >= words:
                for phrases, count in grams(lang, block, words, None if shared is None else shared.value):
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(count), pa.string()), phrases, pa.array(count, pa.int64())],
                                                     names=["lang", "phrase", "c"])

    return texts.mapInArrow(each, PHRASES).groupBy("lang", "phrase").agg(F.sum("c").alias("c"))


def _bitmap(phrases: DataFrame) -> np.ndarray:
    """The bits of all phrases of a table: 2^(BITS - 6) words, whatever the table."""
    drop = np.uint64(64 - BITS)

    def each(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for lang, phrase in zip(frame["lang"], frame["phrase"]):
                h = _hash(phrase.split(b" "), lang)
                total = h[:1]
                for i in range(1, len(h)):
                    total = _join(total, h[i:i + 1])
                out.append(total[0])
            at = np.array(out, dtype=np.uint64) >> drop
            yield pd.DataFrame({"word": (at >> np.uint64(6)).astype(np.int64), "bits": (np.uint64(1) << (at & np.uint64(63))).view(np.int64)})

    found = phrases.select("lang", "phrase").mapInPandas(each, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros(1 << (BITS - 6), dtype=np.uint64)
    out[found.column("word").to_numpy()] = found.column("bits").to_numpy().view(np.uint64)
    return out


def _prefix(lang: str) -> bytes:
    """Start of a language's keys: hexadecimal, so that no language's prefix starts another's keys."""
    return utf8(lang).hex().encode() + b"\t"


class Shard:
    """The trie of a range of (language, phrase), and where each language's positions can start in it."""

    def __init__(self, number: int, langs: list[str], phrases: list[bytes]) -> None:
        self.number = number
        self.trie = DoubleArray([_prefix(lang) + p for lang, p in zip(langs, phrases)])
        self.start = {}
        for lang, phrase in zip(langs, phrases):
            low = int.from_bytes((phrase + b"\n")[:2], "big")
            at = self.start.get(lang)
            self.start[lang] = (self.trie.state(_prefix(lang)), low, low) if at is None else (at[0], min(at[1], low), max(at[2], low))

    def numbers(self, lang: str, block: Block, at: np.ndarray, heads: np.ndarray) -> np.ndarray:
        """Accepted keys; ``at`` are the word starts in the order of their first two bytes, ``heads``."""
        if lang not in self.start:
            return np.empty(0, dtype=np.int32)
        state, low, high = self.start[lang]
        return self.trie.accepted(block.text, at[np.searchsorted(heads, low):np.searchsorted(heads, high, side="right")], state)


def _keyed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Number the rows of a range partition."""
    shard, at = TaskContext.get().partitionId(), 0
    for frame in frames:
        yield frame[["lang", "phrase"]].assign(shard=shard, number=np.arange(at, at + len(frame)))
        at += len(frame)


def _built(key, frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame.sort_values("number")
    shard = Shard(int(key[0]), frame["lang"].tolist(), frame["phrase"].tolist())
    return pd.DataFrame({"shard": [key[0]], "trie": [pickle.dumps(shard)]})


def _sum(frame: pd.DataFrame) -> np.ndarray:
    total = np.zeros(len(frame["counts"].iloc[0]) // 8, dtype=np.int64)
    for counts in frame["counts"]:
        total += np.frombuffer(counts, dtype=np.int64)
    return total


def partial_sums(tasks: int) -> int:
    """How many sums of a slice are taken first: the root of the tasks, so that neither step's groups hold all vectors
    and the first step's hold several each.
    """
    return max(1, math.isqrt(tasks))


def _part(key, frame: pd.DataFrame) -> pd.DataFrame:
    """The sum of some tasks' vectors of one slice."""
    return pd.DataFrame({"shard": [key[0]], "at": [key[1]], "counts": [_sum(frame).tobytes()]})


def _whole(key, frame: pd.DataFrame) -> pd.DataFrame:
    """The sum of these, a row for each key found."""
    total = _sum(frame)
    number = np.flatnonzero(total)
    return pd.DataFrame({"shard": key[0], "number": number + key[1], "f": total[number]})


def count_by_tries(texts: DataFrame, phrases: DataFrame) -> DataFrame:
    """(lang, phrase, f): exact counts of the (lang, phrase) rows of ``phrases``, which are distinct."""
    context, limit = texts.sparkSession.sparkContext, BLOCK_BYTES
    size = phrases.agg(F.sum(F.length("phrase") + F.length("lang") * 2 + 2)).first()[0] or 0
    shards = -(-size // SHARD_BYTES) or 1
    ordered = phrases.select("lang", "phrase", F.hex("lang").alias("key")).repartitionByRange(shards, "key", "phrase").sortWithinPartitions("key", "phrase")
    keyed = written(ordered.mapInPandas(_keyed, "lang string, phrase binary, shard int, number long"), "phrase-keys")
    tries = written(keyed.groupBy("shard").applyInPandas(_built, "shard int, trie binary"), "phrase-tries")
    rounds, used = [[]], 0
    for row in tries.select("shard", F.length("trie").alias("bytes")).orderBy("shard").toLocalIterator():
        if rounds[-1] and used + row["bytes"] > ROUND_BYTES:
            rounds.append([])
            used = 0
        rounds[-1].append(row["shard"])
        used += row["bytes"]

    counts, salts = None, partial_sums(texts.rdd.getNumPartitions())
    for numbers in filter(None, rounds):
        shared = context.broadcast([pickle.loads(r["trie"]) for r in tries.where(F.col("shard").isin(numbers)).collect()])

        def each(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            tries = shared.value
            total = [np.zeros(s.trie.size, dtype=np.int64) for s in tries]
            for lang, block in blocks(batches, limit):
                if not len(block.start):
                    continue
                heads = block.text[block.start].astype(np.int64) << 8 | block.text[block.start + 1]
                order = np.argsort(heads, kind="stable")
                at, heads = block.start[order], heads[order]
                for shard, sums in zip(tries, total):
                    sums += np.bincount(shard.numbers(lang, block, at, heads), minlength=len(sums))
            mine = TaskContext.get().partitionId() % salts
            for shard, sums in zip(tries, total):
                at = [i for i in range(0, len(sums), SLICE) if sums[i:i + SLICE].any()]
                yield pa.RecordBatch.from_arrays([pa.array([shard.number] * len(at), pa.int32()), pa.array(at, pa.int64()), pa.array([mine] * len(at), pa.int32()),
                                                  pa.array([sums[i:i + SLICE].tobytes() for i in at], pa.binary())], names=["shard", "at", "salt", "counts"])

        found = texts.mapInArrow(each, "shard int, at long, salt int, counts binary")
        counts = found if counts is None else counts.unionByName(found)
    if counts is None:
        return keyed.select("lang", "phrase", F.lit(0).cast("long").alias("f"))
    counts = counts.groupBy("shard", "at", "salt").applyInPandas(_part, "shard int, at long, counts binary")
    counts = counts.groupBy("shard", "at").applyInPandas(_whole, "shard int, number long, f long")
    return keyed.join(counts, ["shard", "number"]).select("lang", "phrase", "f")


def phrases(docs: DataFrame, longest: int = 3, least: int = 10, share: int = 50, top: int = 2000, text_col: str = "text",
            lang_col: str = "lang") -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's best phrases of 2 to ``longest`` words.

    ``a`` is the phrase's number of occurrences (at least ``least``, overlaps included), ``n`` that of all words
    of the language. Cut after its first k words, its parts occur l and r times and it scores
    floor(1000000 a a / (l r)); the cut with the lowest score counts, ties go to the smallest k. A phrase inside
    a longer candidate that occurs at least ``share`` in 100 of its times is left out. Order: score, a (both
    descending), phrase by bytes. Null texts are empty, null languages are ``und``; texts without words and
    repeated rows need no care: every row is counted.
    """
    texts = _texts(docs, text_col, lang_col)
    words = written(_level(texts, 1, None), "phrase-words")
    total = words.groupBy("lang").agg(F.sum("c").alias("n"))
    frequent = words.where(F.col("c") >= least)
    levels, parts = [], frequent
    for k in range(2, longest + 1):
        parts = written(_level(texts, k, _bitmap(parts)).where(F.col("c") >= least), f"phrase-{k}")
        levels.append(parts.select("lang", "phrase", F.lit(k).alias("k")))
    candidates = levels[0]
    for level in levels[1:]:
        candidates = candidates.unionByName(level)
    counted = count_by_tries(texts, candidates.select("lang", "phrase"))
    counted = counted.where(F.col("f") >= least).select("lang", F.col("phrase").cast("string").alias("phrase"), "f")
    counted = written(counted.withColumn("w", F.split("phrase", " ", -1)), "phrase-counts")
    known = counted.select("lang", "phrase", "f").unionByName(
        frequent.select("lang", F.col("phrase").cast("string").alias("phrase"), F.col("c").alias("f")))

    cuts = counted.withColumn("k", F.explode(F.sequence(F.lit(1), F.size("w") - 1)))
    cuts = cuts.select("lang", "phrase", F.col("f").alias("a"), "k", F.array_join(F.slice("w", F.lit(1), F.col("k")), " ").alias("left"),
                       F.array_join(F.slice("w", F.col("k") + 1, F.size("w") - F.col("k")), " ").alias("right"))
    cuts = cuts.join(known.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l")), ["lang", "left"])
    cuts = cuts.join(known.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r")), ["lang", "right"])
    exact = F.expr("(1000000BD * cast(a as decimal(15,0)) * cast(a as decimal(15,0))) div (cast(l as decimal(15,0)) * cast(r as decimal(15,0)))")
    lowest = cuts.withColumn("score", exact).groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))

    # every phrase inside a longer candidate, with the most frequent of those
    inner = counted.where(F.size("w") > 2).withColumn("size", F.explode(F.sequence(F.lit(2), F.size("w") - 1)))
    inner = inner.withColumn("at", F.explode(F.sequence(F.lit(1), F.size("w") - F.col("size") + 1)))
    inner = inner.select("lang", F.array_join(F.slice("w", F.col("at"), F.col("size")), " ").alias("phrase"), "f")
    inner = inner.groupBy("lang", "phrase").agg(F.max("f").alias("longer"))
    free = lowest.join(inner, ["lang", "phrase"], "left").where((100 * F.coalesce("longer", F.lit(0)) < share * F.col("a")))

    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    found = free.select("lang", "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), F.col("cut.score").alias("score"))
    found = found.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
    return found.join(total, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
