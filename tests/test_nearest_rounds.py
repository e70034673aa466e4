"""Block search in one and in several rounds, with copies, repeated ids and zero vectors."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import nearest as nn


def expected(ids, vectors, k, asked=None):
    v = nn._scaled(np.asarray(vectors, dtype=np.float32).astype(np.float64))
    found = []
    for i in asked if asked is not None else range(len(ids)):
        score = np.round(v @ v[i], nn.PLACES)
        found += [(ids[i], -s, j) for s, j in sorted((-s, j) for s, j in zip(score, ids) if asked is not None or j != ids[i])]
    out = []
    for q in sorted({f[0] for f in found}):
        mine = sorted((-s, j) for a, s, j in found if a == q)[:k]
        out += [(q, r, j, round(-s, 9)) for r, (s, j) in enumerate(mine, 1)]
    return out


def rows(df):
    return sorted((r["query_id"], r["rank"], r["item_id"], round(r["score"], 9)) for r in df.collect())


@pytest.mark.parametrize("limits", [(nn.PIECE, nn.ROUND), (4096, 4096), (2048, 8192)])
def test_rounds_equal_all_products(spark, monkeypatch, limits):
    monkeypatch.setattr(nn, "PIECE", limits[0])
    monkeypatch.setattr(nn, "ROUND", limits[1])
    rng = np.random.default_rng(3)
    vectors = [*rng.integers(-2, 3, size=(150, 12)), *[np.ones(12)] * 70, np.zeros(12), np.zeros(12)]
    ids = [*range(len(vectors) - 4), 5, 5, 6, 300]  # two ids come again
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in zip(ids, vectors)], "id long, vector array<double>").repartition(4)
    # integer vectors: many equal scores, so ties are decided by id; scores of equal angle differ in the last bits at most
    assert rows(nn.nearest(df, 7, block_rows=16, pivots=5)) == expected(ids, vectors, 7)
    asked = df.where("id in (3, 5, 200)")
    picked = [n for n, i in enumerate(ids) if i in (3, 5, 200)]
    assert rows(nn.nearest(df, 4, asked, block_rows=16, pivots=5)) == expected(ids, vectors, 4, picked)


def test_no_pair_of_blocks_is_shuffled(spark):
    df = spark.range(400).select("id", F.array(*[F.sin(F.col("id") * (i + 1)) for i in range(6)]).alias("vector"))
    plan = nn.nearest(df, 3, block_rows=16)._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapGroups" not in plan and "Join" not in plan and "Window" not in plan
