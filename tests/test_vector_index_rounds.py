"""A search of the kept vector index in several rounds, and without rows of (query, cell)."""

import numpy as np
import pytest

from tidemark.operators import nearest as nn, vector_index as vx
from tidemark.operators.vector_index import VectorIndex


def built(spark, copies):
    rng = np.random.default_rng(4)
    vectors = rng.normal(size=(260, 8)).astype(np.float32)
    vectors[200:200 + copies] = vectors[0]
    items = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "id long, vector array<float>")
    index = VectorIndex(spark)
    index.fit(items, cells=6)
    index.add(items.where("id % 3 = 0"))
    index.add(items.where("id % 3 <> 0"))
    return index, items


def rows(df):
    return sorted((r["query_id"], r["rank"], r["item_id"], r["score"]) for r in df.collect())


@pytest.mark.parametrize("copies", [0, 40])
def test_rounds_do_not_change_a_search(spark, monkeypatch, copies):
    index, items = built(spark, copies)
    exact = rows(index.search(items, 5, itself=True, exact=True))
    assert exact == rows(nn.nearest(items, 5))
    probed = rows(index.search(items, 5, probes=2, itself=True, pool=9))
    monkeypatch.setattr(nn, "PIECE", 1024)
    monkeypatch.setattr(nn, "ROUND", 2048)
    monkeypatch.setattr(vx, "QUERY_BLOCK", 50)
    index._held = None
    assert rows(index.search(items, 5, itself=True, exact=True)) == exact
    assert rows(index.search(items, 5, probes=2, itself=True, pool=9)) == probed


def test_a_query_is_one_row(spark):
    index, items = built(spark, 0)
    plan = index.search(items, 5, itself=True, exact=True)._jdf.queryExecution().executedPlan().toString()
    assert "CoGroup" not in plan and "Join" not in plan and "Window" not in plan
