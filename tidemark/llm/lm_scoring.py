"""Cross-entropy difference: how much better a target's language model predicts a text than the background's.

Both models are interpolated bigram models over one vocabulary: words, A-Z lower-cased, as hashes of 64 bits; a pair
is its two words' hashes (the first of a text's words follows its start). They are matched: the background's counts are
scaled to the target's mass, so that smoothing weighs alike in both. Every document's words are counted, one count for
every pair: the table grows with the corpus and stays distributed. Texts meet it by a join on their own pairs, counted
beforehand; only pairs so frequent that their number is bounded are looked up in the tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import GOLDEN, mix64, only, small_batches, utf8, written

UNIGRAMS = 1 << 18  # words the vocabulary is taken to have at least
PAIR_WEIGHT = 0.7  # of the bigram estimate where its first word has been seen
ADDED = 0.1  # occurrences every word of the vocabulary is taken to have
BATCH = 3_000_000  # words counted before their sums are passed on
HOT = 1 << 18  # a pair of at least this fraction of all words is looked up: there are no more than HOT of them
UNIT = 1 << 30  # losses are summed as whole numbers of 1 / UNIT bits, so that the order of rows doesn't matter
START = np.uint64(0x51A7)


def pairs(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word's predecessor, and of the word; none for a null or blank text."""
    words = utf8(text).lower().split() if isinstance(text, str) else []
    if not words:
        return np.empty(0, dtype=np.uint64), np.empty(0, dtype=np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))
    return np.concatenate([[START], h[:-1]]), h


def key(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix64(a * GOLDEN + b)


def _count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sums by pair (a, b) of what a task holds at a time."""
    held: list[tuple[np.ndarray, np.ndarray, bool]] = []
    words = 0

    def sums() -> pd.DataFrame:
        a, b = (np.concatenate([x[i] for x in held] or [np.empty(0, dtype=np.uint64)]) for i in (0, 1))
        marked = np.concatenate([np.full(len(x[0]), x[2]) for x in held] or [np.empty(0, dtype=bool)])
        _, at, which = np.unique(key(a, b), return_index=True, return_inverse=True)
        return pd.DataFrame({"a": a[at].view(np.int64), "b": b[at].view(np.int64),
                             "target": np.bincount(which[marked], minlength=len(at)), "background": np.bincount(which, minlength=len(at))})

    for frame in frames:
        for text, target in zip(frame["text"], frame["target"]):
            a, b = pairs(text)
            if len(a):
                held.append((a, b, bool(target)))
                words += len(a)
            if words >= BATCH:
                yield sums()
                held.clear()
                words = 0
    yield sums()


def train(docs: DataFrame, target: Column) -> tuple[DataFrame, int]:
    """(a, b, n, loss_target, loss_background) of every pair of words in (text): its occurrences, and minus the log2
    probability of b after a, in units of 1 / UNIT, in the models of the rows that ``target`` marks and of all rows.
    Beside it, the number of words in all rows.
    """
    rows = docs.select(F.col("text"), F.coalesce(target, F.lit(False)).alias("target")).where("text is not null")
    counts = rows.mapInPandas(_count, "a long, b long, target long, background long")
    counts = counts.groupBy("a", "b").agg(F.sum("target").alias("t"), F.sum("background").alias("n"))
    counts = written(counts, "pair-counts")
    # every word occurs once as the second of a pair
    words = written(counts.groupBy("b").agg(F.sum("t").alias("word_t"), F.sum("n").alias("word_n")), "word-counts")
    firsts = written(counts.groupBy("a").agg(F.sum("t").alias("first_t"), F.sum("n").alias("first_n")), "first-counts")
    known, mass, whole = words.agg(F.count("*"), F.coalesce(F.sum("word_t"), F.lit(0)), F.coalesce(F.sum("word_n"), F.lit(0))).first()
    by = mass / whole if mass and whole else 1.0
    added = ADDED * max(UNIGRAMS, known)

    def loss(pair: Column, first: Column, word: Column, scale: float, total: float) -> Column:
        single = (word * scale + ADDED) / (total + added)
        estimate = F.when(first > 0, PAIR_WEIGHT * pair / first + (1 - PAIR_WEIGHT) * single).otherwise(single)
        return F.round(-F.log2(estimate) * UNIT).cast("long")

    full = counts.join(words, "b").join(firsts, "a")
    return full.select("a", "b", "n", loss(F.col("t"), F.col("first_t"), F.col("word_t"), 1.0, mass).alias("loss_target"),
                       loss(F.col("n"), F.col("first_n"), F.col("word_n"), by, by * whole).alias("loss_background")), whole


def score(docs: DataFrame, model: tuple[DataFrame, int], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, loss_target, loss_background, score) per row: mean losses in bits a word, and the
    background's less the target's, higher for texts more like the target. ``model`` has to have the texts' pairs:
    they are among those it was counted from.

    Null and blank texts have no tokens, null losses and score 0. Without target texts both models are flat
    or alike, and nothing is preferred by more than smoothing. Repeated rows get the same score.
    """
    losses, whole = model
    # proven bound: no more than HOT pairs can have a share of 1 / HOT each
    table = losses.where(F.col("n") * HOT >= whole).toArrow()
    a, b = (np.array(table[c].to_numpy(), dtype=np.int64).view(np.uint64) for c in ("a", "b"))
    order = np.argsort(key(a, b))
    hot = (key(a, b)[order], *(np.array(table[c].to_numpy(), dtype=np.int64)[order] for c in ("loss_target", "loss_background")))
    shared = docs.sparkSession.sparkContext.broadcast(hot)

    def each(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """A row for each text (n of 0) with the losses of its frequent pairs, and one for each other pair in it."""
        keys, target, background = shared.value
        for frame in small_batches(frames, 200):
            parts = []
            for row, doc_id, text in zip(frame["row"], frame["doc_id"], frame["text"]):
                a, b = pairs(text)
                k = key(a, b)
                at = np.minimum(np.searchsorted(keys, k), max(len(keys) - 1, 0))
                known = keys[at] == k if len(keys) else np.zeros(len(k), dtype=bool)
                own, first, n = np.unique(k[~known], return_index=True, return_counts=True)
                # the text's own row goes where no other does: its number is its key
                parts.append((np.r_[np.int64(row), a[~known][first].view(np.int64)], np.r_[np.int64(0), b[~known][first].view(np.int64)], np.r_[0, n],
                              row, doc_id, len(a), int(target[at[known]].sum()), int(background[at[known]].sum())))
            size = [len(p[0]) for p in parts]
            first = np.cumsum([0, *size[:-1]])
            out = pd.DataFrame({"row": np.repeat([p[3] for p in parts], size), "a": np.concatenate([p[0] for p in parts]),
                                "b": np.concatenate([p[1] for p in parts]), "n": np.concatenate([p[2] for p in parts])})
            for c, i in (("n_tokens", 5), ("hot_target", 6), ("hot_background", 7)):
                out[c] = 0
                out.loc[first, c] = [p[i] for p in parts]
            out["doc_id"] = None
            out.loc[first, "doc_id"] = [p[4] for p in parts]
            yield out

    source = only(docs, id_col, text_col).select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("string").alias("doc_id"),
                                                 F.col(text_col).alias("text"))
    schema = "row long, a long, b long, n long, n_tokens long, hot_target long, hot_background long, doc_id string"
    met = source.mapInPandas(each, schema).join(losses.drop("n"), ["a", "b"], "left")
    sums = [F.sum(F.col(f"hot_{c}") + F.coalesce(F.col("n") * F.col(f"loss_{c}"), F.lit(0))).alias(c) for c in ("target", "background")]
    out = met.groupBy("row").agg(F.max("doc_id").cast("long").alias("doc_id"), F.sum("n_tokens").alias("n_tokens"), *sums)
    mean = {c: F.when(F.col("n_tokens") > 0, F.col(c) / F.col("n_tokens") / UNIT) for c in ("target", "background")}
    difference = (F.col("background") - F.col("target")) / F.greatest("n_tokens", F.lit(1)) / UNIT
    return out.select("doc_id", "n_tokens", mean["target"].alias("loss_target"), mean["background"].alias("loss_background"), difference.alias("score"))


def difference(docs: DataFrame, targets: DataFrame) -> DataFrame:
    """Scores of all ``docs`` (doc_id, text) against the target texts, those whose doc_id is in ``targets``."""
    marks = targets.select("doc_id").where("doc_id is not null").distinct().withColumn("_t", F.lit(True))
    rows = only(docs, "doc_id", "text").join(marks, "doc_id", "left")
    return score(docs, train(rows, F.col("_t")))
