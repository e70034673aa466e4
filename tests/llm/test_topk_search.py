import math

import numpy as np
import pytest

from tidemark.llm import topk_search
from tidemark.llm.topk_search import top_k

SCHEMA = "vec_id long, embedding array<float>, rank string, score string"


def brute(rows, k, every):
    good = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v):
            v = [math.floor(64 * float(np.float32(x))) for x in v]
            good[i] = min(good.get(i, v), v)
    out = []
    for q, v in good.items():
        if q % every == 0:
            near = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in good.items() if i != q and len(w) == len(v))
            out += [(q, r, i, -s) for r, (s, i) in enumerate(near[:k], 1)]
    return sorted(out)


def run(spark, rows, **kw):
    frame = spark.createDataFrame([(i, v, "x", "y") for i, v in rows], SCHEMA)
    return sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in top_k(frame, **kw).collect())


def test_exact_with_ties_bad_and_repeated_vectors(spark, monkeypatch):
    monkeypatch.setattr(topk_search, "SHARD", 60)
    monkeypatch.setattr(topk_search, "QUERIES", 8)
    monkeypatch.setattr(topk_search, "LEAF", 8)
    rng = np.random.default_rng(0)
    rows = [(i, rng.normal(size=8).round(1).tolist()) for i in range(400)]  # rounded: many equal scores
    rows += [(i, [0.5] * 8) for i in range(400, 500)] + [(0, rows[0][1]), (20, [9.0] * 8), (-40, [1.0] * 8)]
    rows += [(600, None), (601, []), (602, [None] + [1.0] * 7), (603, [float("nan")] * 8), (604, [float("inf")] * 8), (None, [1.0] * 8),
             (620, [1.0, 2.0]), (621, [1.0, 3.0]), (640, [1.0])]
    assert run(spark, rows, k=5, every=20) == brute(rows, 5, 20)


def test_fewer_candidates_than_k_and_no_rows(spark):
    rows = [(20, [1.0, 0.0]), (40, [0.5, 0.5]), (41, [-1.0, 0.0])]
    assert run(spark, rows, k=20) == brute(rows, 20, 20)
    assert run(spark, []) == []


@pytest.mark.parametrize("scale", [1, 10**7])
def test_products_are_exact(scale):
    a = np.random.default_rng(1).integers(-scale, scale, size=(20, 16))
    assert (topk_search.products(a, a) == a @ a.T).all()
