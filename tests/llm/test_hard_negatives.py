import math

import numpy as np
import pytest

from tidemark.llm import hard_negatives as hn

SCHEMA = "vec_id long, embedding array<float>, label int, rank string, planes string"


def brute(rows, every, positives=5, negatives=5):
    good = {}
    for i, v, label in rows:
        if i is not None and label is not None and v and all(x is not None and math.isfinite(x) for x in v):
            one = ([math.floor(256 * float(np.float32(x))) for x in v], label)
            good[i] = min(good.get(i, one), one)
    out = []
    for a, (v, label) in good.items():
        if a % every:
            continue
        near = sorted((-sum(x * y for x, y in zip(v, w)), i, other) for i, (w, other) in good.items() if i != a and len(w) == len(v))
        for p, pid, _ in [x for x in near if x[2] == label][:positives]:
            fit = [x for x in near if x[2] != label and 80 * -p <= 100 * -x[0] <= 100 * -p][:negatives]
            out += [(a, pid, r, i, -p, -s) for r, (s, i, _) in enumerate(fit, 1)]
    return sorted(out)


def run(spark, rows, **kw):
    frame = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)
    names = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r[n] for n in names) for r in hn.hard_negatives(frame, **kw).collect())


def test_equals_brute_force_with_ties_bad_and_repeated_rows(spark, monkeypatch):
    monkeypatch.setattr(hn, "ANCHORS", 7)
    monkeypatch.setattr(hn, "CANDIDATES", 50)
    monkeypatch.setattr(hn, "SMALL_TASK", 60)
    rng = np.random.default_rng(0)
    rows = [(i, (rng.normal(size=11) + 0.7).round(1).tolist(), int(rng.integers(3))) for i in range(500)]  # rounded: equal scores
    rows += [(i, [0.5] * 11, 1) for i in range(500, 560)] + [(0, rows[0][1], 2), (20, [900.0] * 11, 0), (-40, [1.0] * 11, 1)]
    rows += [(600, None, 1), (601, [], 1), (602, [None] + [1.0] * 10, 1), (603, [float("nan")] * 11, 0), (604, [float("inf")] * 11, 0),
             (None, [1.0] * 11, 1), (605, [1.0] * 11, None), (620, [1.0, 2.0], 0), (621, [1.0, 3.0], 0), (622, [0.9, 3.0], 1), (640, [1.0], 0)]
    want = brute(rows, 20)
    assert len(want) > 300
    assert run(spark, rows, every=20) == want


def test_few_or_no_rows(spark):
    rows = [(100, [1.0, 0.5], 1), (101, [1.0, 0.5], 1), (102, [0.9, 0.5], 2), (200, [0.0, 0.0], 5)]
    assert run(spark, rows) == brute(rows, 100) == [(100, 101, 1, 102, 81920, 75264)]
    assert run(spark, rows[1:3]) == []
    assert run(spark, []) == []


@pytest.mark.parametrize("scale", [1, 300, 10**8])
@pytest.mark.parametrize("dim", [1, 8, 13, 64])
def test_lookups_are_exact(scale, dim):
    rng = np.random.default_rng(dim)
    a, c = rng.integers(-scale, scale, size=(9, dim)), rng.integers(-scale, scale, size=(40, dim))
    planes, bits = hn.bit_planes(c)
    assert (hn.scores(hn.subset_tables(a, hn._wide(a, bits)), planes) == c @ a.T).all()


@pytest.mark.parametrize("value", [0, -1, 1, 127, -128])
def test_planes_of_constant_vectors(value):
    c = np.full((3, 4), value)
    planes, bits = hn.bit_planes(c)
    assert (hn.scores(hn.subset_tables(np.ones((2, 4), dtype=np.int64), np.int64), planes) == 4 * value).all() and bits <= 8
