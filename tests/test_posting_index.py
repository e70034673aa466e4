"""The kept posting index against the full scan and a brute-force score."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from tidemark.operators import posting_index as px
from tidemark.operators.posting_index import PostingIndex, pack, posting_blocks, unpack
from tidemark.plans import search


def corpus(n=300, seed=1):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(n):
        text = " ".join(words[min(int(rng.expovariate(0.12)), 59)] for _ in range(rng.randrange(1, 60)))
        rows.append((i, text, rng.choice(["a", "b", None]), rng.choice([None, *range(100, 110)])))
    rows += [(n + i, "w1 w2 w3 copy", "a", 105) for i in range(60)]  # equal scores
    return rows + [(n + 100, "", "a", 101), (n + 101, None, "b", 101), (n + 102, "... !", None, None)]


QUERIES = [(1, "W1 w2 rare", None, None, None), (2, "copy w3", None, None, None), (3, "w1 w2 w3 w4", "a", None, None), (4, "w5 w5 w40", None, 102, 106),
           (5, "w1", "b", 105, None), (6, "unknown", None, None, None), (7, "", None, None, None), (8, "w0 w7", "nowhere", None, None)]


def brute(rows, top):
    units = {u: re.findall("[a-z0-9]+", (t or "").lower()) for u, t, _, _ in rows}
    tf = {u: Counter(w) for u, w in units.items()}
    df = Counter(w for c in tf.values() for w in c)
    average = sum(map(len, units.values())) / len(units)
    out = []
    for q, text, board, low, high in QUERIES:
        scores = []
        for u, _, b, day in rows:
            if (board is not None and b != board) or ((low, high) != (None, None) and (day is None or day < (low or 0) or day > (high or 10**6))):
                continue
            total, hit = 0, False
            for w in sorted(set(text.lower().split())):
                if tf[u][w]:
                    hit, idf = True, math.log(1 + (len(units) - df[w] + 0.5) / (df[w] + 0.5))
                    total += math.floor(idf * (tf[u][w] * 2.2 / (tf[u][w] + 1.2 * (1 - 0.75 + 0.75 * len(units[u]) / average))) * 1e12 + 0.5)
            if hit:
                scores.append((-((total + 500_000) // 1_000_000), u))
        out += [(q, u, -s / 1e6, r) for r, (s, u) in enumerate(sorted(scores)[:top], 1)]
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame(rows, "unit long, text string, board string, day int")


def asked(spark):
    return spark.createDataFrame(QUERIES, "query_id long, query string, board string, date_from int, date_to int")


def found(hits):
    return sorted((r["query_id"], r["unit"], float(r["score"]), r["rank"]) for r in hits.collect())


@pytest.fixture(params=[(16, 40), (200, 5)])
def small_blocks(request, monkeypatch):
    monkeypatch.setattr(px, "QUERY_BLOCK", 3)
    return request.param


def test_batches_and_merges_equal_the_full_scan(spark, small_blocks):
    range_units, top = small_blocks
    rows = corpus()
    index = PostingIndex(spark, buckets=4, range_units=range_units)
    assert index.segments() == [] and index.compact(10) is None
    assert index.add(frame(spark, rows[:200])) == 0
    first = [r.asDict() for r in index.blocks([0]).drop("gaps", "counts").orderBy("term", "range_id", "block").collect()]
    assert index.add(frame(spark, rows[150:])) == 1  # fifty units come again
    assert index.add(frame(spark, rows)) is None
    sizes = {r["segment"]: r["units"] for r in index.describe().collect()}
    assert sizes == {0: 200, 1: len(rows) - 200}
    assert [r.asDict() for r in index.blocks([0]).drop("gaps", "counts").orderBy("term", "range_id", "block").collect()] == first
    hits, work = index.search(asked(spark), top)
    want = brute(rows, top)
    assert found(hits) == want
    for r in work.collect():
        assert 0 <= r["scored"] <= r["read"] <= r["postings"]

    index.add(frame(spark, [(5000, "w1 late", "a", 100)]))
    assert index.compact(150) is None  # only one segment is as small
    merged = index.compact(10**6)
    assert index.segments() == [merged] and index.ranges().count() <= -(-(len(rows) + 1) // range_units) + 1
    rows = [*rows, (5000, "w1 late", "a", 100)]
    hits, _ = index.search(asked(spark), top)
    assert found(hits) == brute(rows, top)


def test_a_common_word_is_not_scored_in_full(spark):
    rows = [(i, "common " * (1 + i % 3) + ("filler " * 40 if i % 50 else "rare "), None, None) for i in range(3000)]
    index = PostingIndex(spark, buckets=2, range_units=500)
    index.add(frame(spark, rows))
    query = spark.createDataFrame([(1, "common rare")], "query_id long, query string")
    hits, work = index.search(query, 5)
    full = search.lexical(frame(spark, rows).select("unit", "text"), query, "unit", "text", 5)
    assert found(hits) == found(full)
    r = work.first()
    assert r["postings"] == 3060 and r["scored"] < 300


def test_postings_survive_compression():
    rng = np.random.default_rng(3)
    values = np.concatenate([rng.integers(0, 1 << b, 50) for b in range(1, 50, 3)] + [np.array([0, 127, 128, 1 << 14])])
    packed, size = pack(values)
    assert (unpack(packed) == values).all() and size.sum() == len(packed)
    assert len(unpack(b"")) == 0
    unit, term = np.arange(1000) % 500, np.repeat([0, 1], 500)
    count, length = rng.integers(1, 9, 1000), rng.integers(1, 50, 1000)
    made = posting_blocks(unit, term, count, length)
    assert sum(made["postings"]) == 1000 and max(made["postings"]) <= px.BLOCK_POSTINGS
    at = 0
    for i, n in enumerate(made["postings"]):
        own = list(zip(count[at:at + n].tolist(), length[at:at + n].tolist()))
        best = set(zip(made["top_count"][i], made["top_length"][i]))
        assert best <= set(own) and all(any(c2 >= c and n2 <= n1 for c2, n2 in best) for c, n1 in own)
        at += n
