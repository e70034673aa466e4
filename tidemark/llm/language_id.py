"""Language of a text, word first.

A known word scores by its log frequency in each language. An unknown one backs off to its character n-grams:
the longest ones of which any is known, averaged, with a fixed penalty for each step down. Word and n-gram
counts come from the whole training part. The tables that tasks load hold the most frequent entries only, a
number per language that is a parameter; what is not among them is what backing off is for.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.llm.common import only, small_batches, written

NGRAMS = (5, 4, 3, 2, 1)
WORDS_KEPT = 20_000  # of a language
NGRAMS_KEPT = 20_000  # of a language and length
LANGUAGES = 256  # the most frequent ones
STEP = -1.0  # log weight of each step down to shorter n-grams
REMEMBERED = 300_000  # unknown words a Python worker keeps the scores of
HELD = 500_000  # distinct words or n-grams a task counts before it passes them on

WORD = re.compile(r"[^\W\d_]+")  # letters, and numbers that aren't digits
MARK = regex.compile(r"\p{M}")
MARKED_WORD = regex.compile(r"\p{L}[\p{L}\p{M}]*")  # for texts with combining marks, which ``re`` takes for no part of a word


def _words(text: str) -> list[str]:
    """The words of a text; none if it has no letter."""
    text = text.lower()
    found = (WORD if text.isascii() or not MARK.search(text) else MARKED_WORD).findall(text)
    return found if any(map(str.isalpha, found)) or any(map(str.isalpha, "".join(found))) else []


def ngrams(word: str, n: int) -> list[str]:
    """Windows of n characters, the word's ends marked by spaces; n of 1: its characters."""
    if n == 1:
        return list(word)
    marked = f" {word} "
    return [marked[i:i + n] for i in range(len(marked) - n + 1)]


def _count_words(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    held: defaultdict[str, Counter] = defaultdict(Counter)

    def out() -> Iterator[pd.DataFrame]:
        for lang, counts in held.items():
            if counts:
                yield pd.DataFrame({"lang": [lang] * len(counts), "word": list(counts), "n": list(counts.values())})
        held.clear()

    for frame in frames:
        for lang, text in zip(frame["lang"], frame["text"]):
            held[lang].update(_words(text))
        if sum(map(len, held.values())) >= HELD:
            yield from out()
    yield from out()


def _count_ngrams(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    held: defaultdict[tuple[str, int], dict[str, int]] = defaultdict(dict)

    def out() -> Iterator[pd.DataFrame]:
        for (lang, size), counts in held.items():
            if counts:  # no word may be long enough
                yield pd.DataFrame({"lang": [lang] * len(counts), "length": size, "gram": list(counts), "n": list(counts.values())})
        held.clear()

    for frame in small_batches(frames, 20_000):
        for lang, words in frame.groupby("lang"):
            for size in NGRAMS:
                counts = held[lang, size]
                get = counts.get
                for word, n in zip(words["word"], words["n"]):
                    for gram in ngrams(word, size):
                        counts[gram] = get(gram, 0) + n
        if sum(map(len, held.values())) >= HELD:
            yield from out()
    yield from out()


class Table:
    """Log frequencies by language, a matrix row for each key. Absent from a language: half an occurrence in it."""

    def __init__(self, languages: list[str], rows: list[tuple]) -> None:
        at = {x: i for i, x in enumerate(languages)}
        self.index: dict[str, int] = {}
        totals = np.ones(len(at))
        for lang, key, _, total in rows:
            totals[at[lang]] = total
            self.index.setdefault(key, len(self.index))
        self.values = np.tile(np.log(0.5 / totals), (len(self.index), 1))
        for lang, key, n, total in rows:
            self.values[self.index[key], at[lang]] = math.log(n / total)

    def get(self, key: str) -> np.ndarray | None:
        i = self.index.get(key)
        return None if i is None else self.values[i]


class Model:
    """Log frequencies by language: of words, and of n-grams by length."""

    def __init__(self, languages: list[str], words: list[tuple], grams: list[tuple]) -> None:
        self.languages = languages
        self.words = Table(languages, words)
        self.grams = {n: Table(languages, [(a, b, c, d) for a, size, b, c, d in grams if size == n]) for n in NGRAMS}


class Scorer:
    """Scores texts. Words have a matrix row each: first the model's, then those of unknown words met so far."""

    def __init__(self, model: Model) -> None:
        self.model = model
        self.first = len(model.words.index)
        self.values = np.concatenate([model.words.values, np.zeros((REMEMBERED, len(model.languages)))])
        self.index = dict(model.words.index)

    def row(self, word: str) -> int:
        """The row of a word that has none yet."""
        if len(self.index) >= len(self.values):
            self.index = dict(self.model.words.index)
        i = self.index[word] = len(self.index)
        self.values[i] = self.backed_off(word)
        return i

    def backed_off(self, word: str) -> np.ndarray | float:
        for step, n in enumerate(NGRAMS, 1):
            table = self.model.grams[n]
            hits = [table.index[g] for g in ngrams(word, n) if g in table.index]
            if hits:
                return STEP * step + table.values[hits].sum(axis=0) / len(hits)
        return 0.0

    def predict(self, text: str | None) -> tuple[str, float]:
        words = _words(text) if isinstance(text, str) else []
        if not words or not self.model.languages:
            return "und", 0.0
        counts = Counter(words)
        if len(counts) > REMEMBERED:  # more distinct words than rows: in parts
            keys = list(counts)
            parts = [keys[i:i + REMEMBERED] for i in range(0, len(keys), REMEMBERED)]
        else:
            parts = [counts]
        total = np.zeros(len(self.model.languages))
        for part in parts:
            if len(self.index) + len(part) > len(self.values):
                self.index = dict(self.model.words.index)  # none of this part's rows may be reused within it
            get = self.index.get
            rows = [i if (i := get(w)) is not None else self.row(w) for w in part]
            total += np.array([counts[w] for w in part], dtype=float) @ self.values[rows]
        best = int(total.argmax())  # ties: the first by name
        return self.model.languages[best], float(1 / np.exp(np.maximum(total - total[best], -700)).sum())


def train(docs: DataFrame, words_kept: int = WORDS_KEPT, ngrams_kept: int = NGRAMS_KEPT) -> Model:
    """A model from (text, lang). Rows without text or lang teach nothing; without any, it knows no language."""
    texts = docs.select("text", "lang").where("text is not null and lang is not null")
    words = texts.mapInPandas(_count_words, "lang string, word string, n long")
    words = written(words.groupBy("lang", "word").agg(F.sum("n").alias("n")), "words")
    grams = words.mapInPandas(_count_ngrams, "lang string, length int, gram string, n long")
    grams = written(grams.groupBy("lang", "length", "gram").agg(F.sum("n").alias("n")), "ngrams")
    totals = words.groupBy("lang").agg(F.sum("n").alias("total")).orderBy(F.desc("total"), "lang").limit(LANGUAGES).collect()
    languages = sorted(r["lang"] for r in totals)

    def frequent(counts: DataFrame, by: list[str], key: str, most: int) -> list:
        """The most frequent rows of each group, beside the group's total: at most ``most`` a group."""
        whole = counts.groupBy(*by).agg(F.sum("n").alias("total"))
        rank = F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("n"), key))
        top = counts.withColumn("r", rank).where(F.col("r") <= most).join(whole, by)
        found = top.where(F.col("lang").isin(languages)).select(*by, key, "n", "total").toArrow()
        return list(zip(*[c.to_pylist() for c in found.columns]))

    return Model(languages, frequent(words, ["lang"], "word", words_kept), frequent(grams, ["lang", "length"], "gram", ngrams_kept))


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score) per row: the likeliest language and its posterior among those known.

    A null text, one without a letter, or a model without languages gives ``und`` and 0. Repeated rows give
    repeated results; ties go to the first language by name.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def each(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = Scorer(shared.value)
        for frame in small_batches(frames):
            found = [scorer.predict(t) for t in frame["text"]]
            yield pd.DataFrame({"doc_id": frame["doc_id"], "lang_pred": [x for x, _ in found], "score": [x for _, x in found]})

    source = only(docs, id_col, text_col).select(F.col(id_col).cast("string").alias("doc_id"), F.col(text_col).alias("text"))
    out = source.mapInPandas(each, "doc_id string, lang_pred string, score double")
    return out.withColumn("doc_id", F.col("doc_id").cast("long"))


def train_and_identify(docs: DataFrame, teaches: Column) -> DataFrame:
    """A model from the rows of (doc_id, text, lang) that ``teaches`` marks, applied to all of them."""
    return identify(docs, train(only(docs, "doc_id", "text", "lang").where(teaches)))
