"""Quality by nearest labelled neighbours in a latent space.

Texts become tf-idf vectors of hashed words and of hashed character-class trigrams (how a text is written, not
what it says), with the shares of repeated words and windows. A singular value decomposition of the labelled
sample gives the latent axes. The sample's latent vectors, their number bounded by ``SAMPLE``, are broadcast;
every document's cosine with all of them is one blocked matrix product, and its nearest neighbours vote, each
weighted by its similarity.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import mix64, only, small_batches, utf8

SAMPLE = 3000  # labelled rows that are learned from, per label
WORD_DIMS, CLASS_DIMS = 512, 512
REPEAT_DIMS = 16
DIMS = WORD_DIMS + CLASS_DIMS + REPEAT_DIMS
AXES = 48
NEIGHBOURS = 15
SHARPNESS = 16  # power of the cosine in a neighbour's weight
GOOD_FROM = 0.7


def _classes() -> bytes:
    """Byte to class, below 64: small and capital letters, digits, spaces, bytes of long characters, each mark."""
    marks = iter(range(5, 64))
    table = bytearray(256)
    for b in range(256):
        c = chr(b)
        if b >= 0x80 or c.islower():
            table[b] = 0
        elif c.isupper():
            table[b] = 1
        elif c.isdigit():
            table[b] = 2
        elif c == "\n":
            table[b] = 4
        elif b <= 0x20 or b == 0x7F:
            table[b] = 3
        else:
            table[b] = next(marks)
    return bytes(table)


CLASS_OF = _classes()


def _hashed(keys: np.ndarray, dims: int) -> np.ndarray:
    found, n = np.unique(keys, return_counts=True)
    out = np.bincount((found % np.uint64(dims)).astype(np.int64), weights=np.log1p(n), minlength=dims)
    return out


def _unit(x: np.ndarray) -> np.ndarray:
    return x / max(float(np.sqrt((x * x).sum())), 1e-12)


def term_vector(text: str | None) -> np.ndarray:
    """Three parts of the vector of a whole text, before idf; a null or empty text is all zero."""
    out = np.zeros(DIMS, dtype=np.float32)
    data = utf8(text) if isinstance(text, str) else b""
    words = data.lower().split()
    if not words:
        return out
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))
    out[:WORD_DIMS] = _hashed(h, WORD_DIMS)
    kinds = np.frombuffer(data.translate(CLASS_OF), dtype=np.uint8).astype(np.int32)
    if len(kinds) >= 3:
        # few distinct trigrams: counted by code, then hashed
        codes, counts = np.unique((kinds[:-2] << 12) | (kinds[1:-1] << 6) | kinds[2:], return_counts=True)
        at = (mix64(codes.astype(np.uint64)) % np.uint64(CLASS_DIMS)).astype(np.int64)
        out[WORD_DIMS:WORD_DIMS + CLASS_DIMS] = np.bincount(at, weights=np.sqrt(counts / counts.sum()), minlength=CLASS_DIMS)
    with np.errstate(over="ignore"):
        windows = mix64(mix64(h[:-2]) + h[1:-1]) + h[2:] if len(h) >= 3 else h
    lines = data.split(b"\n")
    for i, (whole, kept) in enumerate(((len(h), len(np.unique(h))), (len(windows), len(np.unique(windows))), (len(lines), len(set(lines))))):
        share = 1 - kept / whole
        out[DIMS - REPEAT_DIMS + 4 * i + min(3, int(4 * share))] = 0.25 + share
    return out


@dataclass
class Model:
    idf: np.ndarray
    axes: np.ndarray  # DIMS x AXES
    vectors: np.ndarray  # labelled rows x AXES, of length 1
    good: np.ndarray  # weight of a vote for label 1 by each labelled row
    votes: np.ndarray  # weight of any vote by each labelled row
    prior: float  # share of label 1 among all labelled rows


def _weighted(terms: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = terms * idf
    a, b = x[:, :WORD_DIMS], x[:, WORD_DIMS:WORD_DIMS + CLASS_DIMS]
    for part in (a, b):
        part /= np.maximum(np.sqrt((part * part).sum(axis=1, keepdims=True)), 1e-12)
    a *= 0.5  # style over subject
    return x


def latent(terms: np.ndarray, idf: np.ndarray, axes: np.ndarray) -> np.ndarray:
    x = _weighted(terms, idf) @ axes
    return x / np.maximum(np.sqrt((x * x).sum(axis=1, keepdims=True)), 1e-12)


def fit(rows: list[tuple[str | None, int]], share_good: float) -> Model:
    """Axes, idf and labelled vectors from (text, label) rows, at most twice ``SAMPLE``."""
    terms = np.stack([term_vector(t) for t, _ in rows]) if rows else np.zeros((0, DIMS), dtype=np.float32)
    label = np.array([y for _, y in rows], dtype=np.float32)
    idf = (np.log((1 + len(rows)) / (1 + (terms > 0).sum(axis=0))) + 1).astype(np.float32)
    idf[WORD_DIMS:] = 1.0
    x = _weighted(terms, idf)
    _, axes = np.linalg.eigh((x.T @ x).astype(np.float64))
    axes = axes[:, ::-1][:, :AXES].astype(np.float32)
    # both labels vote with their share among all labelled rows, not among the sampled ones
    sampled = float(label.mean()) if len(rows) else 0.5
    weight = np.where(label == 1, share_good / max(sampled, 1e-9), (1 - share_good) / max(1 - sampled, 1e-9)).astype(np.float32)
    return Model(idf, axes, latent(terms, idf, axes).astype(np.float32), weight * label, weight, share_good)


def vote(model: Model, terms: np.ndarray) -> np.ndarray:
    """Share of label 1 in the neighbours' weights; the prior where nothing is similar."""
    if not len(model.vectors) or not len(terms):
        return np.full(len(terms), model.prior)
    cosine = latent(terms, model.idf, model.axes).astype(np.float32) @ model.vectors.T
    k = min(NEIGHBOURS, cosine.shape[1])
    near = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
    weight = np.clip(np.take_along_axis(cosine, near, 1), 0, None) ** SHARPNESS
    total, good = (weight * model.votes[near]).sum(axis=1), (weight * model.good[near]).sum(axis=1)
    faint = 1e-3  # so that a row without neighbours gets the prior
    return np.clip((good + faint * model.prior) / (total + faint), 0, 1)


def train(docs: DataFrame, labels: DataFrame, teaches: Column, sample: int = SAMPLE) -> Model:
    """From at most ``sample`` rows of each label among those that ``teaches`` marks, chosen by hash of their id.

    Labels other than 0 and 1 and rows without text teach nothing; a document labelled twice has its smaller label.
    """
    marks = only(labels, "doc_id", "quality").where("quality in (0, 1) and doc_id is not null").where(teaches)
    marks = marks.groupBy("doc_id").agg(F.min("quality").alias("label"))
    counts = {r["label"]: r["n"] for r in marks.groupBy("label").agg(F.count("*").alias("n")).collect()}
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    chosen = [marks.where(F.col("label") == y).orderBy(*order).limit(sample) for y in (0, 1)]
    chosen = chosen[0].unionByName(chosen[1])
    # proven bound: 2 * sample ids
    texts = only(docs, "doc_id", "text").where("text is not null").join(F.broadcast(chosen), "doc_id")
    rows = sorted((r["doc_id"], r["text"], r["label"]) for r in texts.collect())
    share = counts.get(1, 0) / max(1, sum(counts.values())) if counts else 0.5
    return fit([(t, y) for _, t, y in rows], share)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score, predicted) per row: the weighted share of good neighbours, and whether it is at least 0.7.

    Null and empty texts get the labelled rows' share of label 1. Repeated rows get the same score.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def each(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in small_batches(frames, 500):
            terms = np.stack([term_vector(t) for t in frame["text"]]) if len(frame) else np.zeros((0, DIMS), dtype=np.float32)
            yield pd.DataFrame({"doc_id": frame["doc_id"], "score": vote(shared.value, terms).astype(np.float64)})

    source = only(docs, id_col, text_col).select(F.col(id_col).cast("string").alias("doc_id"), F.col(text_col).alias("text"))
    out = source.mapInPandas(each, "doc_id string, score double").withColumn("doc_id", F.col("doc_id").cast("long"))
    return out.withColumn("predicted", (F.col("score") >= GOOD_FROM).cast("int"))
