"""Queries: search corpus, retrieval, evaluation, text checks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from tidemark.catalog.reco import _metric_sql
from tidemark.catalog.snapshots import daily
from tidemark.functions import text as tx
from tidemark.plans import marts, ranking, search
from tidemark.registry import query, view
from tidemark.session import cut
from tidemark.sources.tables import Tables

_TOK = lambda c: f"regexp_extract_all(lower({c}), '[\\p{{L}}\\p{{N}}]+')"

view("sx_corpus", r"SELECT * FROM documents WHERE length(regexp_replace(text, '[ \t\n\r]', '', 'g')) >= 20")
view("sx_chunks", """
  SELECT doc_id || '#' || chunk_no AS chunk_id, doc_id, chunk_no, substring(text, chunk_no * 700 + 1, 800) AS content
  FROM (SELECT doc_id, text, unnest(generate_series(0::bigint, CASE WHEN length(text) <= 800 THEN 0 ELSE ceil((length(text) - 800) / 700.0::double)::bigint END)) AS chunk_no FROM sx_corpus)""")


def _bm25(units: str, ident: str, text: str) -> str:
    return f"""WITH tok AS MATERIALIZED (SELECT {ident} AS unit, {_TOK(text)} AS ws FROM {units}),
      q AS MATERIALIZED (SELECT DISTINCT item_id AS query_id, term FROM (SELECT item_id, unnest({_TOK('text')}) AS term FROM benchmark)),
      w AS (SELECT unit, len(ws) AS unit_len, unnest(ws) AS term FROM tok),
      p AS MATERIALIZED (SELECT unit, unit_len, term, count(*) AS tf FROM w WHERE term IN (SELECT term FROM q) GROUP BY ALL),
      st AS MATERIALIZED (SELECT count(*)::double AS docs, avg(len(ws)) AS avg_len FROM tok),
      df AS MATERIALIZED (SELECT term, count(*) AS df FROM p GROUP BY 1),
      s AS (SELECT query_id, unit, round(sum((ln(1 + (docs - df + 0.5::double) / (df + 0.5::double)) * (tf * 2.2::double / (tf + 1.2::double * (0.25::double + 0.75::double * unit_len / avg_len))))::decimal(20,12))::decimal(38,12), 6) AS score
            FROM q JOIN df USING (term) JOIN p USING (term), st GROUP BY 1, 2)
      SELECT query_id, unit, score::double AS score, rank FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, unit) AS rank FROM s)"""


view("sx_lex_docs", _bm25("sx_corpus", "doc_id", "text"))
view("sx_lex_chunks", _bm25("sx_chunks", "chunk_id", "content"))
view("sx_lex", """
  SELECT query_id, doc_id, chunk_id, score, rank FROM (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM (
      SELECT query_id, split_part(unit, '#', 1)::bigint AS doc_id, unit AS chunk_id, score,
             row_number() OVER (PARTITION BY query_id, split_part(unit, '#', 1) ORDER BY score DESC, unit) AS best
      FROM sx_lex_chunks) WHERE best = 1) WHERE rank <= 40""")
view("sx_vec", """
  SELECT query_id, doc_id, score, rank FROM (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM (
      SELECT b.item_id AS query_id, e.vec_id AS doc_id, round(list_cosine_similarity(q.embedding::double[], e.embedding::double[]), 9) AS score
      FROM benchmark b JOIN embeddings q ON q.vec_id = b.item_id CROSS JOIN embeddings e)) WHERE rank <= 40""")
view("sx_hybrid", """
  SELECT query_id, doc_id, lex_rank, vec_rank, rrf, rank FROM (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY rrf DESC, doc_id) AS rank FROM (
      SELECT query_id, doc_id, l.rank AS lex_rank, v.rank AS vec_rank,
             coalesce((1.0::double / (60 + l.rank))::decimal(20,16), 0) + coalesce((1.0::double / (60 + v.rank))::decimal(20,16), 0) AS rrf
      FROM sx_lex l FULL JOIN sx_vec v USING (query_id, doc_id))) WHERE rank <= 40""")
view("sx_ranked", """
  SELECT 'lexical' AS variant, query_id, doc_id AS item_id, rank FROM sx_lex UNION ALL SELECT 'vector', query_id, doc_id, rank FROM sx_vec
  UNION ALL SELECT 'hybrid', query_id, doc_id, rank FROM sx_hybrid""")
view("sx_pool", "SELECT DISTINCT query_id, item_id AS doc_id FROM sx_ranked WHERE rank <= 20")
view("sx_judged", f"""
  SELECT query_id, doc_id, CASE WHEN contains(text, query) THEN 3 WHEN share >= 0.8 THEN 2 WHEN share >= 0.5 THEN 1 ELSE 0 END AS grade
  FROM (SELECT p.query_id, p.doc_id, d.text, b.text AS query,
               len(list_intersect(list_distinct({_TOK('b.text')}), list_distinct({_TOK('d.text')}))) / len(list_distinct({_TOK('b.text')}))::double AS share
        FROM sx_pool p JOIN documents d USING (doc_id) JOIN benchmark b ON b.item_id = p.query_id)""")


def queries(t: Tables) -> DataFrame:
    return t.benchmark.select(F.col("item_id").alias("query_id"), F.col("text").alias("query"))


@query("chunks", "SELECT chunk_id, doc_id, chunk_no, length(content) AS chars, md5(content) AS digest FROM sx_chunks")
def chunks(t: Tables):
    return search.chunks(search.corpus(t.documents)).select(
        "chunk_id", "doc_id", "chunk_no", F.length("content").alias("chars"), F.md5("content").alias("digest"))


@query("tokens", f"SELECT doc_id, len({_TOK('text')}) AS words, len(list_distinct({_TOK('text')})) AS distinct_words, md5(array_to_string({_TOK('text')}, ' ')) AS digest FROM documents")
def tokens(t: Tables):
    words = t.documents.select("doc_id", tx.tokens(F.col("text")).alias("w"))
    return words.select("doc_id", F.size("w").alias("words"), F.size(F.array_distinct("w")).alias("distinct_words"),
                        F.md5(F.array_join("w", " ")).alias("digest"))


@query("lexical_search", "SELECT query_id, unit, score, rank FROM sx_lex_docs WHERE rank <= 40")
def lexical_search(t: Tables):
    return search.lexical(search.corpus(t.documents), queries(t), "doc_id", "text")


def arms(t: Tables) -> dict[str, DataFrame]:
    asked = queries(t)
    hits = search.lexical(search.chunks(search.corpus(t.documents)), asked, top=None, documents=search.ARM)
    lex = cut(search.best_chunk(hits))
    vectors = t.embeddings.select(F.col("vec_id").alias("doc_id"), F.col("embedding").alias("vector"))
    asked_vectors = asked.join(vectors.withColumnRenamed("doc_id", "query_id"), "query_id").select("query_id", "vector")
    vec = cut(search.vector_arm(vectors, asked_vectors))
    return {"lexical": lex, "vector": vec, "hybrid": cut(search.hybrid(lex, vec))}


@query("best_chunk", "SELECT query_id, doc_id, chunk_id, score, rank FROM sx_lex")
def best_chunk(t: Tables):
    return arms(t)["lexical"]


@query("vector_search", "SELECT * FROM sx_vec")
def vector_search(t: Tables):
    return arms(t)["vector"]


@query("hybrid_rrf", "SELECT query_id, doc_id, lex_rank, vec_rank, round(rrf::decimal(38,12), 9)::double AS rrf, rank FROM sx_hybrid")
def hybrid_rrf(t: Tables):
    return arms(t)["hybrid"].withColumn("rrf", F.round(F.col("rrf").cast("decimal(38,12)"), 9))


@query("pool", "SELECT * FROM sx_pool")
def pool(t: Tables):
    return search.pooled(arms(t))


def evaluated(t: Tables) -> DataFrame:
    found = arms(t)
    judged = search.judge(search.pooled(found), t.documents, queries(t)).where("grade > 0")
    ranked = reduce(DataFrame.unionByName, [
        df.select(F.lit(name).alias("variant"), "query_id", F.col("doc_id").alias("item_id"), "rank") for name, df in found.items()])
    return ranking.rank_metrics(cut(ranked), cut(judged.withColumnRenamed("doc_id", "item_id")), ["query_id"], 10, relevant_from=2)


def _search_metrics() -> str:
    sql = _metric_sql("SELECT * FROM sx_ranked", "SELECT query_id, doc_id AS item_id, grade FROM sx_judged WHERE grade > 0", "query_id")
    return (sql.replace("count(*) AS relevant", "count(*) FILTER (grade >= 2) AS relevant")
            .replace("count(*) AS hits", "count(*) FILTER (grade >= 2) AS hits")
            .replace("sum(seen / rank::double) AS precisions, min(rank) AS first", "coalesce(sum(seen / rank::double) FILTER (grade >= 2), 0) AS precisions, min(rank) FILTER (grade >= 2) AS first")
            .replace("row_number() OVER (PARTITION BY variant, query_id ORDER BY rank) AS seen", "sum((grade >= 2)::int) OVER (PARTITION BY variant, query_id ORDER BY rank) AS seen")
            .replace("hits / relevant::double", "coalesce(hits / nullif(relevant, 0)::double, 0)")
            .replace("precisions / least(relevant, 10)", "coalesce(precisions / nullif(least(relevant, 10), 0), 0)"))


view("sx_metrics", _search_metrics())


@query("search_metrics", "SELECT * FROM sx_metrics")
def search_metrics(t: Tables):
    return evaluated(t)


@query("search_gates", """
  SELECT *, hybrid >= greatest(lexical, vector) - 0.02 AS fusion_holds FROM (
    SELECT max(value) FILTER (variant = 'lexical') AS lexical, max(value) FILTER (variant = 'vector') AS vector, max(value) FILTER (variant = 'hybrid') AS hybrid
    FROM sx_metrics WHERE metric = 'ndcg')""")
def search_gates(t: Tables):
    return search.sanity(evaluated(t))


@query("corpus_stats", """
  SELECT 'length_from' AS kind, (CASE WHEN n >= 25600 THEN 25600 WHEN n >= 12800 THEN 12800 WHEN n >= 6400 THEN 6400 WHEN n >= 3200 THEN 3200
         WHEN n >= 1600 THEN 1600 WHEN n >= 800 THEN 800 WHEN n >= 400 THEN 400 WHEN n >= 100 THEN 100 ELSE 0 END)::varchar AS name, count(*) AS amount
  FROM (SELECT length(text) AS n FROM sx_corpus) GROUP BY 2
  UNION ALL SELECT 'source', source, count(*) FROM sx_corpus GROUP BY 2
  UNION ALL SELECT 'total', 'documents', count(*) FROM sx_corpus
  UNION ALL SELECT 'total', 'chunks', count(*) FROM sx_chunks
  UNION ALL SELECT 'total', 'filtered_out', (SELECT count(*) FROM documents) - count(*) FROM sx_corpus""")
def corpus_stats(t: Tables):
    return search.corpus_stats(t.documents)


@query("index_incremental", "SELECT doc_id, lang, n_chars FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def index_incremental(t: Tables):
    """Labelled documents stand for the ones already indexed."""
    return search.not_indexed(t.documents.select("doc_id", "lang", "n_chars"), t.labels)


def _screen_sql() -> str:
    sq = lambda p: p.replace("'", "''")
    hits = ", ".join(f"CASE WHEN regexp_matches(text, '(?i){sq(p)}') THEN '{i + 1}' END" for i, p in enumerate(tx.INJECTION))
    masked, counts = "text", []
    for p in tx.PERSONAL.values():
        counts.append(f"len(regexp_extract_all({masked}, '{p}'))")
        masked = f"regexp_replace({masked}, '{p}', '***', 'g')"
    return f"""SELECT origin, ident, concat_ws(',', {hits}) AS injection_patterns, 0::bigint AS hidden_characters,
      {' + '.join(counts)} AS personal_count, md5({masked}) AS digest FROM sx_texts"""


view("sx_texts", """
  SELECT 'document' AS origin, doc_id::varchar AS ident, text FROM documents
  UNION ALL SELECT 'turn', conv_id || '-' || turn, text FROM conversations""")


@query("text_screen", _screen_sql())
def text_screen(t: Tables):
    texts = t.documents.select(F.lit("document").alias("origin"), F.col("doc_id").cast("string").alias("ident"), "text").unionByName(
        t.conversations.select(F.lit("turn").alias("origin"), F.concat_ws("-", "conv_id", "turn").alias("ident"), "text"))
    return search.screen(texts).select("origin", "ident", "injection_patterns", "hidden_characters", "personal_count", F.md5("masked").alias("digest"))


@query("number_check", r"""
  WITH a AS (SELECT region, trending_date, 'In ' || region || ' ' || total_videos || ' videos had ' || format('{:,}', total_views) || ' views, a like share of '
        || printf('%.1f', round((avg_like_ratio * 100)::decimal(38,12), 1)::double) || '%, 3 notes, year 2024, and ' || (total_likes + CASE WHEN day(trending_date) % 4 = 0 THEN 5000 ELSE 0 END) || ' likes.' AS answer
      FROM gold_trending),
  tok AS (SELECT DISTINCT region, trending_date, unnest(regexp_extract_all(answer, '[0-9]+(?:,[0-9]{3})*(?:\.[0-9]+)?%?')) AS token FROM a),
  n AS (SELECT *, replace(replace(token, ',', ''), '%', '')::double AS number FROM tok),
  c AS (SELECT * FROM n WHERE NOT (NOT contains(token, '%') AND NOT contains(token, '.') AND (number <= 10 OR number BETWEEN 2000 AND 2100))),
  f AS (SELECT region, trending_date, unnest([v, round(v, 0), round(v, 1), round(v, 2), v * 100, v / 100]) AS form
        FROM (SELECT region, trending_date, unnest([total_videos::double, total_views::double, total_likes::double, avg_like_ratio]) AS v FROM gold_trending))
  SELECT region, trending_date::varchar AS trending_date, token, number FROM c
  WHERE NOT EXISTS (SELECT 1 FROM f WHERE f.region = c.region AND f.trending_date = c.trending_date AND abs(number - form) <= greatest(0.005, 0.005 * abs(form)))""")
def number_check(t: Tables):
    """Sentences written from the daily mart, every fourth day with a wrong like count."""
    mart = cut(marts.trending_daily(daily(t)))
    wrong = F.when(F.dayofmonth("trending_date") % 4 == 0, 5000).otherwise(0)
    sentence = F.concat(
        F.lit("In "), "region", F.lit(" "), F.col("total_videos").cast("string"), F.lit(" videos had "), F.format_number("total_views", 0),
        F.lit(" views, a like share of "), F.format_string("%.1f", F.round(F.col("avg_like_ratio") * 100, 1).cast("double")),
        F.lit("%, 3 notes, year 2024, and "), (F.col("total_likes") + wrong).cast("string"), F.lit(" likes."))
    facts = mart.select("region", "trending_date", F.explode(F.array(*[
        F.col(c).cast("double") for c in ("total_videos", "total_views", "total_likes", "avg_like_ratio")])).alias("fact"))
    return search.unverified_numbers(mart.select("region", "trending_date", sentence.alias("answer")), facts, ["region", "trending_date"])
