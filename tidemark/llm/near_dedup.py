"""Near-duplicate documents by HyperMinHash sketches, banding, and a check on the full shingle sets.

Sketch. The 64-bit hashes of a document's distinct word shingles fall into 256 buckets by their top eight
bits. Of a bucket's smallest hash only the number of leading zeros and the ten bits after the first one are
stored: two bytes a bucket. An empty bucket borrows that of another one, found by a fixed probing order, so
that for short texts too each register agrees with probability J.

Candidates. 42 bands of six registers: documents of similarity 0.85 share none with probability 2e-9, of 0.8
with 3e-6. Exact copies are one class from the start. Classes that share a band are linked to the smallest of
that band (a star, never all pairs); what hangs together so is a cluster.

Confirmation. A cluster's members are dealt into blocks of bounded size, and each pair of blocks is one group:
registers are compared as matrices, the Jaccard estimate is corrected for chance collisions of registers, and
pairs whose estimate is near the threshold are checked on the full sets. A group returns a spanning forest of
confirmed links only. Every pair of a cluster meets in some group, so no link between different texts is lost.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import GOLDEN, components, mix64, only, small_batches, utf8, written

BUCKET_BITS = 8
BUCKETS = 1 << BUCKET_BITS
MANTISSA = 10
BAND, BANDS = 6, 42
BLOCK_DOCS, BLOCK_SHINGLES = 1024, 1_000_000
COLLISION = 0.1699  # share of equal registers of disjoint sets of equal size, times 2^mantissa
SURE_BELOW = 4.5  # standard errors under the threshold beyond which an estimate rules a pair out
SMALL_SET = 128  # sets below this size skip the estimate


def _probes() -> np.ndarray:
    """Which bucket an empty one asks first, second, ...: the same for every document."""
    order = np.arange(BUCKETS * 4 * BUCKETS, dtype=np.uint64).reshape(BUCKETS, -1) + np.uint64(1)
    with np.errstate(over="ignore"):
        return (mix64(order * GOLDEN) % np.uint64(BUCKETS)).astype(np.int64)


PROBES = _probes()


def shingles(words: list[bytes], k: int) -> np.ndarray:
    """Sorted distinct hashes of the k-word windows; of the whole sequence where it is shorter."""
    if not words:
        return np.empty(0, dtype=np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))
    width = min(k, len(h))
    with np.errstate(over="ignore"):
        out = np.full(len(h) - width + 1, width, dtype=np.uint64)
        for i in range(width):
            out = mix64(out * GOLDEN + h[i:len(h) - width + 1 + i])
    return np.unique(out)


def registers(hashes: np.ndarray) -> np.ndarray:
    """The sketch of a non-empty sorted hash array: leading zeros and mantissa of each bucket's minimum."""
    starts = np.searchsorted(hashes, np.arange(BUCKETS, dtype=np.uint64) << np.uint64(64 - BUCKET_BITS))
    ends = np.append(starts[1:], len(hashes))
    full = starts < ends
    rest = hashes[np.minimum(starts, len(hashes) - 1)] << np.uint64(BUCKET_BITS)
    top = (rest >> np.uint64(11)).astype(np.float64)  # 53 bits, so exact
    zeros = np.minimum(53 - np.frexp(top)[1], 53).astype(np.uint64)
    zeros[top == 0] = 53
    mantissa = (rest << (zeros + np.uint64(1))) >> np.uint64(64 - MANTISSA)
    out = ((zeros << np.uint64(MANTISSA)) | mantissa).astype(np.uint16)
    lender, empty, t = np.arange(BUCKETS), np.flatnonzero(~full), 0
    while len(empty) and t < PROBES.shape[1]:
        lender[empty] = PROBES[empty, t]
        empty = empty[~full[lender[empty]]]
        t += 1
    lender[empty] = np.flatnonzero(full)[0]
    return out[lender]


def estimate(equal: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Jaccard similarity from the share of equal registers, less those equal by chance."""
    chance = COLLISION / (1 << MANTISSA) * 4 * n * m / (n + m) ** 2
    return (equal - chance) / (1 - chance)


def _words(text: str) -> list[bytes]:
    return utf8(text).lower().split()  # bytes: only A-Z change, only the six spaces split


def sketches(docs: DataFrame, k: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, digest, sketch) per row; digest and sketch are null for an empty set."""
    def each(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in small_batches(frames):
            rows = []
            for doc, text in zip(frame["doc_id"], frame["text"]):
                words = _words(text) if isinstance(text, str) else []
                if words:
                    s = shingles(words, k)
                    rows.append((doc, len(s), hashlib.sha256(b" ".join(words)).digest(), registers(s).tobytes()))
                else:
                    rows.append((doc, 0, None, None))
            yield pd.DataFrame(rows, columns=["doc_id", "n_shingles", "digest", "sketch"])

    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).where("doc_id is not null")
    return source.mapInPandas(each, "doc_id long, n_shingles long, digest binary, sketch binary")


def _bands(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    salt = np.arange(1, BANDS + 1, dtype=np.uint64)
    for frame in small_batches(frames):
        if not len(frame):
            continue
        r = np.stack([np.frombuffer(x, dtype=np.uint16) for x in frame["sketch"]]).astype(np.uint64)[:, :BAND * BANDS]
        r = r.reshape(len(frame), BANDS, BAND)
        with np.errstate(over="ignore"):
            key = np.broadcast_to(salt, r.shape[:2])
            for i in range(BAND):
                key = mix64(key * GOLDEN + r[:, :, i])
        yield pd.DataFrame({"band": key.view(np.int64).ravel(), "rep": np.repeat(frame["rep"].to_numpy(), BANDS)})


def _find(parent: np.ndarray, x: int) -> int:
    while parent[x] != x:
        parent[x] = parent[parent[x]]
        x = parent[x]
    return x


def confirmed(ids, sets, sketch, left: np.ndarray, right: np.ndarray, same: bool, num: int, den: int) -> list[tuple]:
    """A spanning forest of the links between two blocks (or within one), each checked on its full sets."""
    limit, links = num / den, []
    margin = SURE_BELOW * math.sqrt(limit * (1 - limit) / BUCKETS)
    size = np.array([len(s) for s in sets], dtype=np.int64)
    parent, pairs = np.arange(len(ids)), []
    for at, i in enumerate(left):
        js = right[right > i] if same else right
        js = js[(np.minimum(size[js], size[i]) * den >= num * np.maximum(size[js], size[i]))]
        if not len(js):
            continue
        near = estimate((sketch[js] == sketch[i]).mean(axis=1), size[i], size[js])
        ok = (near >= limit - margin) | (np.minimum(size[js], size[i]) < SMALL_SET)
        pairs.append(np.stack([np.full(ok.sum(), i), js[ok], near[ok]], axis=1))
    if not pairs:
        return []
    found = np.concatenate(pairs)
    for i, j, _ in found[np.argsort(-found[:, 2], kind="stable")]:
        i, j = int(i), int(j)
        a, b = _find(parent, i), _find(parent, j)
        if a == b:
            continue
        both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
        if den * both >= num * (len(sets[i]) + len(sets[j]) - both):
            parent[max(a, b)] = min(a, b)
            links.append((ids[i], ids[j]))
    return links


def near_duplicates(docs: DataFrame, k: int = 5, similar: tuple[int, int] = (4, 5), id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) per row whose id isn't null.

    Documents are linked where their sets of ``k``-word shingles (A-Z lower-cased; a shorter text is one
    shingle) have a Jaccard similarity of at least ``similar`` (numerator, denominator). A null, empty or
    blank text has an empty set and is its own component. Rows that repeat an id are one document: they
    share its component, and all are kept if it is.
    """
    num, den = similar
    docs = only(docs, id_col, text_col)
    table = written(sketches(docs, k, id_col, text_col), "sketches")
    reps = table.where("digest is not null").groupBy("digest").agg(F.min(F.struct("doc_id", "n_shingles", "sketch")).alias("r"))
    reps = written(reps.select("digest", F.col("r.doc_id").alias("rep"), F.col("r.n_shingles").alias("n"), F.col("r.sketch").alias("sketch")), "classes")
    bands = written(reps.mapInPandas(_bands, "band long, rep long"), "bands")
    heads = bands.groupBy("band").agg(F.min("rep").alias("head"), F.count("*").alias("c")).where("c > 1").select("band", "head")
    stars = bands.join(heads, "band").where("rep > head").select(F.col("head").alias("a"), F.col("rep").alias("b")).distinct()
    clusters = components(stars).select(F.col("id").alias("rep"), F.col("component").alias("cluster"))

    members = written(reps.join(clusters, "rep").select("rep", "cluster", "n", "digest"), "members")
    blocks = members.groupBy("cluster").agg(F.greatest(F.ceil(F.count("*") / BLOCK_DOCS), F.ceil(F.sum("n") / BLOCK_SHINGLES)).alias("blocks"))
    placed = members.join(blocks, "cluster").withColumn("mine", F.pmod(F.xxhash64("rep"), F.col("blocks")))
    texts = docs.select(F.col(id_col).alias("rep"), F.col(text_col).alias("text")).where("rep is not null and text is not null")
    placed = placed.join(texts, "rep")

    def full(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in small_batches(frames, 500):
            sets = []
            for text, digest in zip(frame["text"], frame["digest"]):
                words = _words(text)
                # a repeated id may bring other texts than the class's own: they are other classes
                sets.append(shingles(words, k).tobytes() if hashlib.sha256(b" ".join(words)).digest() == bytes(digest) else None)
            out = frame[["rep", "cluster", "blocks", "mine"]].assign(shingles=sets)
            yield out[out["shingles"].notna()]

    sets = placed.select("rep", "cluster", "blocks", "mine", "text", "digest").mapInPandas(
        full, "rep long, cluster long, blocks long, mine long, shingles binary")
    met = sets.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    met = met.select("cluster", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), "mine", "rep", "shingles")

    def check(group: pd.DataFrame) -> pd.DataFrame:
        i, j = group["i"].iloc[0], group["j"].iloc[0]
        own = [np.frombuffer(x, dtype=np.uint64) for x in group["shingles"]]
        mine = group["mine"].to_numpy()
        links = confirmed(group["rep"].to_numpy(), own, np.stack([registers(s) for s in own]), np.flatnonzero(mine == i),
                          np.flatnonzero(mine == j), i == j, num, den)
        return pd.DataFrame(links, columns=["a", "b"], dtype="int64")

    links = met.groupBy("cluster", "i", "j").applyInPandas(check, "a long, b long")
    joined = components(links)
    classes = reps.select("digest", "rep").join(joined, F.col("rep") == F.col("id"), "left")
    classes = classes.select("digest", F.coalesce("component", "rep").alias("component_id"))
    out = table.select("doc_id", "n_shingles", "digest").join(classes, "digest", "left")
    out = out.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
    return out.withColumn("kept", F.col("doc_id") == F.col("component_id"))
