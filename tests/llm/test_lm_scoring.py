import math

import numpy as np
import pytest

from tests.llm.helpers import docs_frame, prose
from tidemark.llm import lm_scoring as lm


def brute(texts, target):
    """Losses by dictionaries: no buckets, the vocabulary's size as in the operator."""
    def model(chosen):
        words, pairs, firsts = {}, {}, {}
        for t in chosen:
            before = ("start",)
            for w in (t or "").encode().lower().split():
                words[w] = words.get(w, 0) + 1
                pairs[before, w] = pairs.get((before, w), 0) + 1
                firsts[before] = firsts.get(before, 0) + 1
                before = w
        return words, pairs, firsts

    marked = [t for t, x in zip(texts, target) if x]
    a, b = model(marked), model(texts)
    scale = sum(a[0].values()) / max(1, sum(b[0].values()))

    def loss(m, text, by):
        words, pairs, firsts = m
        total, mass, before, n = 0.0, by * sum(words.values()), ("start",), 0
        for w in text.encode().lower().split():
            single = (by * words.get(w, 0) + lm.ADDED) / (mass + lm.ADDED * lm.UNIGRAMS)
            weight = lm.PAIR_WEIGHT if firsts.get(before) else 0.0
            paired = pairs.get((before, w), 0) / firsts.get(before, 1)
            total, before, n = total - math.log2(weight * paired + (1 - weight) * single), w, n + 1
        return total / n

    return [(loss(a, t, 1), loss(b, t, scale)) if t and t.split() else None for t in texts]


def test_losses_as_brute_force(spark):
    texts = [prose(i, 30 + i, 60) for i in range(20)] + ["Only WORDS seen once", "one", None, "", " \n", prose(99, 20_000, 60)]
    target = [i % 3 == 0 for i in range(len(texts))]
    docs = docs_frame(spark, list(enumerate(texts)) + [(None, "without id")], ["target", "score", "_t"][:2])
    marks = spark.createDataFrame([(i,) for i, t in enumerate(target) if t] + [(0,), (None,)], "doc_id long")
    got = {r["doc_id"]: r for r in lm.difference(docs, marks).collect()}
    want = brute(texts + ["without id"], [*target, False])
    for i, w in zip([*range(len(texts)), None], want):
        if w is None:
            assert (got[i]["n_tokens"], got[i]["loss_target"], got[i]["score"]) == (0, None, 0.0)
        else:
            assert (got[i]["loss_target"], got[i]["loss_background"]) == pytest.approx(w, rel=0.02)
            assert got[i]["score"] == pytest.approx(got[i]["loss_background"] - got[i]["loss_target"], abs=1e-4)


def test_target_like_texts_score_higher(spark):
    texts = [prose(i, 60, 80) for i in range(40)] + [" ".join("v" + w[1:] for w in prose(100 + i, 60, 80).split()) for i in range(40)]
    docs = docs_frame(spark, list(enumerate(texts)))
    marks = spark.createDataFrame([(i,) for i in range(0, 40, 2)], "doc_id long")
    got = {r["doc_id"]: r["score"] for r in lm.difference(docs, marks).collect()}
    assert min(got[i] for i in range(1, 40, 2)) > max(got[i] for i in range(40, 80))


def test_without_rows_or_targets(spark):
    none = spark.createDataFrame([], "doc_id long")
    assert lm.difference(docs_frame(spark, []), none).collect() == []
    got = lm.difference(docs_frame(spark, [(1, "a b"), (1, "a b")]), none).collect()
    assert len(got) == 2 and all(np.isfinite(r["score"]) for r in got)


def test_large_vocabulary_as_brute_force(spark, monkeypatch):
    """More distinct pairs than the 2^20 there once were buckets for, few of them frequent enough to be looked up."""
    monkeypatch.setattr(lm, "HOT", 64, raising=False)
    rng = np.random.default_rng(3)
    texts = [" ".join(f"w{x}" for x in rng.integers(0, 200_000, 20_000)) for _ in range(60)] + ["w1 w2 w3", "a b a b a b"] * 2 + [None]
    target = [i % 3 == 0 for i in range(len(texts))]
    marks = spark.createDataFrame([(i,) for i, t in enumerate(target) if t], "doc_id long")
    got = {r["doc_id"]: r for r in lm.difference(docs_frame(spark, list(enumerate(texts))), marks).collect()}
    for i, w in enumerate(brute(texts, target)):
        if w is not None:
            assert (got[i]["loss_target"], got[i]["loss_background"]) == pytest.approx(w, rel=1e-6)
            assert got[i]["score"] == pytest.approx(w[1] - w[0], abs=1e-6)
