"""Queries: nearest vectors by the kept index of cells and codes, with filters and measured recall."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.catalog.kept_index import FIRST_DAY
from tidemark.operators.nearest import nearest
from tidemark.operators.vector_index import VectorIndex
from tidemark.plans import reco, search
from tidemark.registry import query, view
from tidemark.session import cut
from tidemark.sources.tables import Tables

view("kv_items", f"SELECT vec_id, embedding::double[] AS v, label::varchar AS board, {FIRST_DAY} + vec_id % 365 AS day FROM embeddings")
view("kv_asked", f"""
  SELECT b.item_id AS query_id, e.embedding::double[] AS v, CASE WHEN b.item_id % 2 = 0 THEN (b.item_id % 10)::varchar END AS board,
         CASE WHEN b.item_id % 3 = 0 THEN {FIRST_DAY} + 90 END AS date_from, CASE WHEN b.item_id % 4 < 2 THEN {FIRST_DAY} + 250 END AS date_to
  FROM benchmark b JOIN embeddings e ON e.vec_id = b.item_id""")


def items(t: Tables) -> DataFrame:
    return t.embeddings.select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"), F.col("label").cast("string").alias("board"),
                               (F.lit(FIRST_DAY) + F.col("vec_id") % 365).cast("int").alias("day"))


def kept(t: Tables) -> VectorIndex:
    """Fitted on a sample of all items, filled by two batches."""
    index, rows = VectorIndex(t.spark), cut(items(t))
    index.fit(rows)
    index.add(rows.where("id % 3 = 0"))
    index.add(rows.where("id % 3 <> 0"))
    return index


@query("vector_search_filtered", """
  SELECT query_id, doc_id, score, rank FROM (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM (
      SELECT query_id, i.vec_id AS doc_id, round(list_cosine_similarity(q.v, i.v), 9) AS score FROM kv_asked q JOIN kv_items i
      ON (q.board IS NULL OR i.board = q.board) AND (date_from IS NULL OR day >= date_from) AND (date_to IS NULL OR day <= date_to))) WHERE rank <= 40""")
def vector_search_filtered(t: Tables):
    """The vector arm with filters by board and date, all cells visited."""
    n = F.col("item_id")
    asked = t.benchmark.select("item_id").join(t.embeddings.select(F.col("vec_id").alias("item_id"), F.col("embedding").alias("vector")), "item_id")
    asked = asked.select(n.alias("id"), "vector", F.when(n % 2 == 0, (n % 10).cast("string")).alias("board"),
                         F.when(n % 3 == 0, FIRST_DAY + 90).alias("date_from"), F.when(n % 4 < 2, FIRST_DAY + 250).alias("date_to"))
    found = kept(t).search(asked, search.ARM, exact=True)
    return found.select("query_id", F.col("item_id").alias("doc_id"), "score", "rank")


@query("knn_indexed")
def knn_indexed(t: Tables):
    """Neighbours of every item from probed cells only, as many as held queries need for a recall of 0.95."""
    index, asked = kept(t), items(t).select("id", "vector")
    probes, _ = index.tune(asked, reco.NEIGHBOURS, itself=True)
    return index.search(asked, reco.NEIGHBOURS, probes=probes, itself=True)


@query("knn_indexed_recall", f"SELECT count(*) AS queries, {reco.NEIGHBOURS}::bigint AS neighbours, true AS holds FROM embeddings")
def knn_indexed_recall(t: Tables):
    """All neighbours of all items against the exact block search: at least 0.95 of them are found."""
    asked = items(t).select("id", "vector")
    exact, found = nearest(asked, reco.NEIGHBOURS), knn_indexed(t).select("query_id", "item_id").withColumn("hit", F.lit(1))
    both = exact.join(found, ["query_id", "item_id"], "left")
    return both.agg(F.countDistinct("query_id").alias("queries"), F.lit(reco.NEIGHBOURS).alias("neighbours"),
                    (F.count("hit") >= 0.95 * F.count("*")).alias("holds"))
