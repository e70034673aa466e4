"""Scores where a unit is read: against joins of the counted index, with rows that repeat a unit."""

import pytest
from pyspark.sql import functions as F

from tidemark.operators.ordering import first_per, top_n
from tidemark.plans import search


@pytest.fixture(scope="module")
def corpus(spark):
    words = "alpha beta gamma delta epsilon zeta eta theta iota kappa".split()
    rows = [(d, " ".join(words[(d * j + j * j) % (3 + d % 8)] for j in range(20 + d % 300))) for d in range(120)]
    rows += [(7, rows[7][1]), (8, "alpha kappa of another length")] + [(500 + i, "beta beta gamma gamma") for i in range(60)]
    texts = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    asked = spark.createDataFrame([(1, "alpha Beta, gamma"), (2, "theta"), (3, "none of these"), (4, "iota kappa zeta"), (4, "iota")],
                                  "query_id long, query string")
    return texts, asked


def rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture(params=[search.SLAB, 150], ids=["one slab", "many slabs"])
def slab(request, monkeypatch):
    monkeypatch.setattr(search, "SLAB", request.param)


def test_first_units_and_all_units_equal_joins(corpus, slab, monkeypatch):
    texts, asked = corpus
    few = rows(search.lexical(texts, asked, "doc_id", "text", 5)), rows(search.lexical(texts, asked, "doc_id", "text", None))
    monkeypatch.setattr(search, "FEW_TERMS", -1)
    assert few == (rows(search.lexical(texts, asked, "doc_id", "text", 5)), rows(search.lexical(texts, asked, "doc_id", "text", None)))


def test_units_of_the_first_documents_give_the_same_best_chunks(corpus, slab):
    texts, asked = corpus
    pieces = texts.withColumn("n", F.explode(F.sequence(F.lit(0), F.lit(12)))).select(
        F.concat_ws("#", F.col("doc_id").cast("string"), F.col("n").cast("string")).alias("chunk_id"), F.expr("substring(text, n * 60 + 1, 90)").alias("content"))
    pieces = pieces.where("length(content) > 0")
    every, kept = search.lexical(pieces, asked, top=None), search.lexical(pieces, asked, top=None, documents=4)
    assert set(rows(kept)) <= set(rows(every)) and kept.count() < every.count()
    best = first_per(every.withColumn("doc_id", F.substring_index("unit", "#", 1).cast("long")), ["query_id", "doc_id"],
                     [F.col("score").desc(), F.col("unit").asc()])
    want = top_n(best.select("query_id", "doc_id", F.col("unit").alias("chunk_id"), "score"), ["query_id"], [F.col("score").desc(), F.col("doc_id").asc()], 4)
    assert rows(search.best_chunk(kept, 4)) == rows(want)


def test_no_rows_of_units_and_terms_are_shuffled(corpus):
    texts, asked = corpus
    plan = search.lexical(texts, asked, "doc_id", "text", None)._jdf.queryExecution().toString()
    assert "Exchange" not in plan and "Join" not in plan
