"""Quality rules as weak supervision.

Every rule votes good or bad, or abstains. How often a rule votes what for good and for bad documents is not
known; expectation-maximisation estimates it, with the share of good documents, from the votes of the whole
table. A document's verdict is the posterior probability of being good, given all its votes, instead of
passing every rule.

Votes have few distinct patterns (3 to the number of rules at most), so they are counted in one aggregation,
and the estimation runs over those counts.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import only, small_batches, utf8, written

SYMBOLS = b"#*$%&|<>"
GOOD, ABSTAIN, BAD = 1, 0, -1
KEEP = 0.5  # least posterior of a kept document
ROUNDS, SETTLED = 200, 1e-9
SMOOTHING = 1.0  # votes of each kind that every rule is taken to have cast in each class
START_GOOD, START_BAD = 0.95, 0.1  # posterior to start from, without and with a vote for bad

# (feature, bad from, good up to): in between, and in texts without words, the rule abstains
RULES = (
    ("symbols_per_word", 0.25, 0.02),
    ("dup_line_share", 0.4, 0.05),
    ("repeat_word_share", 0.4, 0.1),
    ("top_word_share", 0.3, 0.15),
    ("upper_share", 0.3, 0.1),
    ("odd_ending_share", 0.2, 0.05),
    ("long_word_share", 0.1, 0.01),
    ("no_letter_share", 0.3, 0.1),
)
LONG_WORD = 40
# What commonly ends a word of prose
ENDINGS = (".", ",", ";", ":", "?", "!", ")", '"', "'")


@dataclass
class Features:
    n_words: int
    word_chars: int
    n_symbols: int
    n_dup_lines: int
    n_repeat_words: int
    shares: dict[str, float | None]


def features(text: str | None) -> Features:
    """The base counts and the rules' features of one whole text; a null text has no words."""
    data = utf8(text) if isinstance(text, str) else b""
    words = data.split()  # of bytes: at the six spaces only
    n = len(words)
    lines = [x for x in data.split(b"\n") if x.strip(b" \t\n\r\x0b\x0c")]
    symbols = sum(data.count(bytes([s])) for s in SYMBOLS)
    # code points: all bytes but continuations; words are what is left without spaces
    chars = sum(map(len, map(bytes.decode, words))) if not data.isascii() else sum(map(len, words))
    seen = Counter(zip(words, words[1:], words[2:]))
    covered = bytearray(n)
    if len(seen) < n - 2:
        for i, window in enumerate(zip(words, words[1:], words[2:])):
            if seen[window] > 1:
                covered[i] = covered[i + 1] = covered[i + 2] = 1
    repeat = sum(covered)
    dup = len(lines) - len(set(lines))
    shares: dict[str, float | None] = dict.fromkeys((r[0] for r in RULES))
    if n:
        plain = text or ""
        tokens = plain.split()
        letters = sum(map(str.isalpha, plain)) if not data.isascii() else len(data) - len(data.translate(None, LETTERS))
        uppers = sum(map(str.isupper, plain)) if not data.isascii() else len(data) - len(data.translate(None, UPPERS))
        shares.update(
            symbols_per_word=symbols / n, dup_line_share=dup / max(1, len(lines)), repeat_word_share=repeat / n,
            top_word_share=Counter(words).most_common(1)[0][1] / n if n >= 20 else None,
            upper_share=uppers / letters if letters >= 20 else None,
            odd_ending_share=sum(not t[-1].isalnum() and not t[-2:-1].isalnum() and len(t) > 1 or t[-1] == "!" for t in tokens) / max(1, len(tokens)),
            long_word_share=sum(len(t) > LONG_WORD for t in tokens) / max(1, len(tokens)),
            no_letter_share=sum(not any(map(str.isalpha, t)) for t in tokens) / max(1, len(tokens)))
    return Features(n, chars, symbols, dup, repeat, shares)


UPPERS = bytes(range(65, 91))
LETTERS = UPPERS + bytes(range(97, 123))


def votes(shares: dict[str, float | None]) -> str:
    """One character a rule: + good, - bad, 0 abstains."""
    out = []
    for name, bad, good in RULES:
        x = shares[name]
        out.append("0" if x is None else "-" if x >= bad else "+" if x <= good else "0")
    return "".join(out)


def estimate(patterns: dict[str, int]) -> tuple[float, np.ndarray]:
    """(share of good documents, probability of each vote: class x rule x kind) from counts of vote patterns.

    Starts from any vote for bad against none, and ends when no posterior changes. Without documents, all
    are taken to be as the start says.
    """
    rules = len(RULES)
    keys = sorted(patterns) or ["0" * rules]
    n = np.array([patterns.get(k, 0) for k in keys], dtype=float)
    kind = np.array([["+0-".index(c) for c in k] for k in keys])
    onehot = np.eye(3)[kind]  # pattern x rule x kind
    good = np.where((kind == 2).any(axis=1), START_BAD, START_GOOD)
    for _ in range(ROUNDS):
        weight = np.stack([n * good, n * (1 - good)])
        table = np.einsum("cp,prk->crk", weight, onehot) + SMOOTHING
        table /= table.sum(axis=2, keepdims=True)
        prior = (weight[0].sum() + 1) / (n.sum() + 2)
        new = posterior(kind, prior, table)
        if np.abs(new - good).max() < SETTLED:
            break
        good = new
    return float(prior), table


def posterior(kind: np.ndarray, prior: float, table: np.ndarray) -> np.ndarray:
    log = np.log(table)
    at = np.arange(kind.shape[1])
    odds = np.log(prior) - np.log1p(-prior) + (log[0][at, kind] - log[1][at, kind]).sum(axis=1)
    return 1 / (1 + np.exp(-np.clip(odds, -700, 700)))


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, votes, posterior).

    A row fails the base with fewer than 50 words, or more than half of them in 3-word windows that repeat;
    it is kept if it passes and its posterior is at least one half. Null and empty texts fail. Repeated rows
    are judged alike.
    """
    def each(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in small_batches(frames, 1000):
            found = [features(t) for t in frame["text"]]
            yield pd.DataFrame({
                "doc_id": frame["doc_id"], "n_words": [f.n_words for f in found], "word_chars": [f.word_chars for f in found],
                "n_symbols": [f.n_symbols for f in found], "n_dup_lines": [f.n_dup_lines for f in found],
                "n_repeat_words": [f.n_repeat_words for f in found], "votes": [votes(f.shares) for f in found]})

    source = only(docs, id_col, text_col).select(F.col(id_col).cast("string").alias("doc_id"), F.col(text_col).alias("text"))
    schema = "doc_id string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, votes string"
    cast = written(source.mapInPandas(each, schema).withColumn("doc_id", F.col("doc_id").cast("long")), "votes")
    patterns = {r["votes"]: r["n"] for r in cast.groupBy("votes").agg(F.count("*").alias("n")).collect()}  # 3 ** len(RULES) at most
    prior, table = estimate(patterns)
    keys = sorted(patterns)
    kinds = np.array([["+0-".index(c) for c in k] for k in keys], dtype=int).reshape(len(keys), len(RULES))
    good = posterior(kinds, prior, table)
    known = docs.sparkSession.createDataFrame([(k, float(p)) for k, p in zip(keys, good)], "votes string, posterior double")
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    out = cast.join(F.broadcast(known), "votes").withColumn("base_failed", failed)
    out = out.withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= KEEP))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "votes", "posterior")
