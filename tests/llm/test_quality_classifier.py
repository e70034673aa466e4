import numpy as np

from tests.conftest import DATA
from tests.llm.helpers import docs_frame
from tidemark.llm import quality_classifier as qc
from tidemark.llm.common import fold


def test_votes_as_brute_force():
    rng = np.random.default_rng(0)
    rows = [(" ".join(rng.choice(["alpha", "beta", "gamma!!", "DELTA", "eps|"], size=30)), int(i % 4 > 0)) for i in range(60)]
    m = qc.fit(rows, 0.75)
    terms = np.stack([qc.term_vector(t) for t, _ in rows[:9]])
    own = qc.latent(terms, m.idf, m.axes)
    for got, v in zip(qc.vote(m, terms), own):
        near = sorted(range(len(rows)), key=lambda i: -float(v @ m.vectors[i]))[:qc.NEIGHBOURS]
        w = np.array([max(float(v @ m.vectors[i]), 0) ** qc.SHARPNESS for i in near])
        want = (sum(w * m.good[near]) + 1e-3 * 0.75) / (sum(w * m.votes[near]) + 1e-3)
        assert abs(got - want) < 1e-3


def test_rows_and_missing_labels(spark):
    labels = spark.createDataFrame([(1, 1, "x"), (2, None, "x"), (None, 0, "x"), (2, 0, "x"), (3, 7, "x"), (4, 0, "x")], "doc_id long, quality int, label string")
    rows = [(1, "fine words here"), (1, "fine words here"), (2, "### $$$ %%%"), (3, None), (None, ""), (4, "### %%% ### ***"), (5, "z" * 200_000)]
    docs = docs_frame(spark, rows, ["label", "score", "predicted"])
    got = qc.score(docs, qc.train(docs, labels, fold("doc_id", 4) >= 0)).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in got)
    by = {r["doc_id"]: r["score"] for r in got}
    assert by[1] > by[2] and by[3] == by[None]
    none = qc.train(docs, labels.limit(0), fold("doc_id", 4) >= 0)
    assert {r["score"] for r in qc.score(docs, none).collect()} == {0.5}
    assert qc.score(docs_frame(spark, []), none).collect() == []


def test_held_out_documents(spark):
    docs, labels = (spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("documents", "labels"))
    found = qc.score(docs, qc.train(docs, labels, fold("doc_id", 4) != 2)).join(labels, "doc_id").where(fold("doc_id", 4) == 2).collect()
    good, bad = ([r["score"] for r in found if r["quality"] == q] for q in (1, 0))
    assert good and bad
    assert np.mean([[g > b for b in bad] for g in good]) >= 0.97  # area under the curve
