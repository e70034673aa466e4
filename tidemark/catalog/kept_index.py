"""Queries: lexical retrieval over a kept index that grows by batches, with filters by board and date."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.catalog.search import _TOK, queries
from tidemark.operators.posting_index import PostingIndex
from tidemark.plans import search
from tidemark.registry import query, view
from tidemark.session import cut
from tidemark.sources.tables import Tables

FIRST_DAY = 19_723  # 2024-01-01 in days since 1970

view("kx_units", f"SELECT doc_id, text, source AS board, {FIRST_DAY} + doc_id % 365 AS day, doc_id IN (SELECT doc_id FROM labels) AS early FROM sx_corpus")
view("kx_asked", f"""
  SELECT item_id AS query_id, text, CASE WHEN item_id % 3 = 0 THEN (SELECT min(source) FROM documents) END AS board,
         CASE WHEN item_id % 2 = 0 THEN {FIRST_DAY} + 60 END AS date_from, CASE WHEN item_id % 4 < 2 THEN {FIRST_DAY} + 300 END AS date_to FROM benchmark""")


def units(t: Tables) -> DataFrame:
    return search.corpus(t.documents).select(F.col("doc_id").alias("unit"), "text", F.col("source").alias("board"),
                                             (F.lit(FIRST_DAY) + F.col("doc_id") % 365).cast("int").alias("day"))


def kept(t: Tables) -> PostingIndex:
    """Labelled documents are the first batch; the second one offers all documents and adds the others."""
    index, rows = PostingIndex(t.spark), units(t)
    index.add(rows.join(t.labels.select(F.col("doc_id").alias("unit")).distinct(), "unit", "left_semi").transform(cut))
    index.add(rows)
    return index


@query("index_search", "SELECT query_id, unit, score, rank FROM sx_lex_docs WHERE rank <= 40")
def index_search(t: Tables):
    return kept(t).search(queries(t), search.ARM)[0]


@query("index_search_merged", "SELECT query_id, unit, score, rank FROM sx_lex_docs WHERE rank <= 40")
def index_search_merged(t: Tables):
    index = kept(t)
    index.compact(1 << 20)
    return index.search(queries(t), search.ARM)[0]


@query("index_search_filtered", """
  SELECT query_id, unit, score, rank FROM (
    SELECT query_id, unit, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, unit) AS rank
    FROM sx_lex_docs l JOIN kx_asked q USING (query_id) JOIN kx_units u ON u.doc_id = l.unit
    WHERE (q.board IS NULL OR u.board = q.board) AND (date_from IS NULL OR u.day >= date_from) AND (date_to IS NULL OR u.day <= date_to)) WHERE rank <= 40""")
def index_search_filtered(t: Tables):
    asked = queries(t).join(t.documents.agg(F.min("source").alias("first_board")), F.lit(True))  # one row
    n = F.col("query_id")
    asked = asked.select("query_id", "query", F.when(n % 3 == 0, F.col("first_board")).alias("board"),
                         F.when(n % 2 == 0, FIRST_DAY + 60).alias("date_from"), F.when(n % 4 < 2, FIRST_DAY + 300).alias("date_to"))
    return kept(t).search(asked, search.ARM)[0]


def _sizes(segment: int, rows: str) -> str:
    return f"""SELECT {segment}::bigint AS segment, count(*) AS units, sum(len(ws))::bigint AS words, sum(len(list_distinct(ws)))::bigint AS postings
      FROM (SELECT early, {_TOK('text')} AS ws FROM kx_units) WHERE {rows} HAVING count(*) > 0"""


@query("index_segments", f"""
  SELECT 'added' AS state, * FROM ({_sizes(0, 'early')} UNION ALL {_sizes(1, 'NOT early')})
  UNION ALL SELECT 'merged', * FROM ({_sizes(2, 'true')})""")
def index_segments(t: Tables):
    """What each batch wrote, and the one segment that both become."""
    index = kept(t)
    added = cut(index.describe().withColumn("state", F.lit("added")))
    index.compact(1 << 20)
    merged = index.describe().withColumn("state", F.lit("merged"))
    return added.unionByName(merged).select("state", "segment", "units", "words", "postings")


@query("index_rows_scored", f"""
  SELECT query_id, count(*) AS postings, true AS read_less, true AS scored_less
  FROM (SELECT DISTINCT item_id AS query_id, term FROM (SELECT item_id, unnest({_TOK('text')}) AS term FROM benchmark)) q
  JOIN (SELECT DISTINCT doc_id, term FROM (SELECT doc_id, unnest({_TOK('text')}) AS term FROM kx_units)) d USING (term) GROUP BY 1""")
def index_rows_scored(t: Tables):
    """Postings of every query's terms; fewer are read, and of these fewer are scored."""
    work = kept(t).search(queries(t), search.ARM)[1]
    return work.select("query_id", "postings", (F.col("read") <= F.col("postings")).alias("read_less"), (F.col("scored") <= F.col("read")).alias("scored_less"))
