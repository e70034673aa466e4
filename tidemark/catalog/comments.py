"""Queries: comments, forum, text cleaning and healing."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.catalog.snapshots import stg
from tidemark.functions import text as tx
from tidemark.operators.ordering import ordered_prefix
from tidemark.plans import comments
from tidemark.registry import query, view
from tidemark.session import cut
from tidemark.sources import adapters
from tidemark.sources.tables import Tables

SALT = "0f1e2d3c4b5a69788796a5b4c3d2e1f0"
_CONTROL = r"[\x00-\x08\x0B-\x1F\x7F-\x9F]"
_CLEAN = lambda c: rf"regexp_replace(nfc_normalize(regexp_replace({c}, '{_CONTROL}', '', 'g')), '^[ \t\n]+|[ \t\n]+$', '', 'g')"
_COUNT = lambda c, p: f"length(regexp_replace({c}, '[^{p}]', '', 'g'))"
_LANG = lambda c: rf"""CASE WHEN {_COUNT(c, r'\p{Han}\p{Hiragana}\p{Katakana}\p{Hangul}')} / nullif({_COUNT(c, r'\p{L}')}, 0)::double >= 0.3 THEN 'zh'
    WHEN {_COUNT(c, r'\p{Latin}')} / nullif({_COUNT(c, r'\p{L}')}, 0)::double >= 0.7 THEN 'en' ELSE 'other' END"""

view("cm_base", f"""
  SELECT *, make_timestamp(1704067200000000 + (doc_id % 10007) * 1730 * 1000000) AS published_at,
         substr(sha256('{SALT}' || coalesce(CASE WHEN doc_id % 11 <> 0 THEN source END, 'dn:' || lang || (doc_id % 50))), 1, 16) AS author_hash
  FROM documents""")
view("cm", f"""
  SELECT 'cm' || doc_id AS comment_id, 'v' || (doc_id % 100) AS video_id, {_CLEAN('text')} AS text,
         coalesce(CASE WHEN doc_id % 13 <> 0 THEN n_chars % 97 END, 0) AS like_count,
         coalesce(CASE WHEN doc_id % 5 <> 0 THEN doc_id % 7 END, 0) AS total_reply_count, published_at,
         published_at + INTERVAL 1 HOUR AS updated_at, author_hash, false AS is_reply, published_at::date AS ingest_date,
         published_at + INTERVAL 2 HOUR AS ingested_at, 'v' || (doc_id % 100) || '_' || strftime(published_at, '%Y%m%d') AS ingestion_id
  FROM cm_base""")


def comment_rows(t: Tables):
    return comments.to_comments(adapters.threads(t), SALT)


@query("pick_videos", """
  SELECT video_id, max(comment_count) AS comment_count, count(*) AS regions FROM (
    SELECT *, row_number() OVER (PARTITION BY region ORDER BY comment_count DESC, video_id) AS rk FROM latest_day
    WHERE trending_date = (SELECT max(trending_date) FROM stg)) WHERE rk <= 25 GROUP BY 1""")
def pick_videos(t: Tables):
    return comments.pick_videos(stg(t), newest_day(t))


def newest_day(t: Tables):
    """The newest day as a literal, so that the day filter reaches the scan."""
    return F.lit(t.events.agg(F.max(F.to_date("ts")).alias("d")).first()["d"])


@query("comments_silver", f"SELECT * REPLACE (ingest_date::varchar AS ingest_date), {_LANG('text')} AS lang_bucket FROM cm")
def comments_silver(t: Tables):
    return comment_rows(t)


@query("author_hash", "SELECT author_hash, count(*) AS comments FROM cm_base GROUP BY 1")
def author_hash(t: Tables):
    return comment_rows(t).groupBy("author_hash").agg(F.count(F.lit(1)).alias("comments"))


@query("clean_text", f"SELECT doc_id, md5({_CLEAN('text')}) AS digest, length({_CLEAN('text')}) AS chars FROM documents")
def clean_text(t: Tables):
    cleaned = t.documents.select("doc_id", tx.clean_text(F.col("text")).alias("c"))
    return cleaned.select("doc_id", F.md5("c").alias("digest"), F.length("c").alias("chars"))


@query("lang_bucket", f"SELECT doc_id, {_LANG('text')} AS lang_bucket FROM documents")
def lang_bucket(t: Tables):
    return t.documents.select("doc_id", tx.lang_bucket(F.col("text")).alias("lang_bucket"))


@query("comments_merge", """
  SELECT comment_id, video_id, md5(text) AS digest, CASE WHEN published_at >= timestamp '2024-01-10' THEN like_count + 5 ELSE like_count END AS like_count,
         published_at FROM cm""")
def comments_merge(t: Tables):
    """Two overlapping batches; the later one also carries every comment twice."""
    rows = comment_rows(t)
    again = rows.where("published_at >= timestamp'2024-01-10'").withColumn("like_count", F.col("like_count") + 5)
    base = rows.where("published_at < timestamp'2024-01-15'")
    older = again.withColumns({"like_count": F.lit(-1).cast("long"), "ingested_at": F.col("ingested_at") - F.expr("INTERVAL 1 DAY")})
    return comments.merge_comments(base, again.unionByName(older)).select(
        "comment_id", "video_id", F.md5("text").alias("digest"), "like_count", "published_at")


@query("progress_carryover", """
  WITH sel AS (SELECT video_id, max(comment_count) AS comment_count FROM (
      SELECT *, row_number() OVER (PARTITION BY region ORDER BY comment_count DESC, video_id) AS rk FROM latest_day
      WHERE trending_date = (SELECT max(trending_date) FROM stg)) WHERE rk <= 25 GROUP BY 1),
  old AS (SELECT video_id, ['pending', 'in_progress', 'done', 'budget_stopped', 'comments_disabled', 'not_found'][(count(*) % 6 + 1)::int] AS status,
                 max(published_at) AS watermark_published_at FROM cm GROUP BY 1),
  j AS (SELECT video_id, comment_count, watermark_published_at, coalesce(status IN ('budget_stopped', 'pending', 'in_progress'), false) AS carried_over,
               CASE WHEN status IN ('budget_stopped', 'pending', 'in_progress', 'comments_disabled', 'not_found') THEN status ELSE 'pending' END AS status,
               row_number() OVER (ORDER BY coalesce(status IN ('budget_stopped', 'pending', 'in_progress'), false) DESC, comment_count DESC NULLS LAST, video_id) AS priority
        FROM sel FULL JOIN old USING (video_id) WHERE comment_count IS NOT NULL OR status IN ('budget_stopped', 'pending', 'in_progress'))
  SELECT * FROM j""")
def progress_carryover(t: Tables):
    states = F.array(*[F.lit(s) for s in ("pending", "in_progress", "done", "budget_stopped", "comments_disabled", "not_found")])
    old = comment_rows(t).groupBy("video_id").agg(F.count(F.lit(1)).alias("n"), F.max("published_at").alias("watermark_published_at"))
    old = old.withColumn("status", F.element_at(states, (F.col("n") % 6 + 1).cast("int"))).drop("n")
    return comments.progress(comments.pick_videos(stg(t), newest_day(t)).drop("regions"), old)


@query("incremental_watermark", """
  SELECT c.comment_id, c.video_id, c.published_at FROM cm c
  LEFT JOIN (SELECT video_id, max(published_at) AS mark FROM cm WHERE published_at < timestamp '2024-01-12' GROUP BY 1) m USING (video_id)
  WHERE mark IS NULL OR c.published_at > mark""")
def incremental_watermark(t: Tables):
    rows = comment_rows(t).select("comment_id", "video_id", "published_at")
    return comments.newer_than_seen(rows, rows.where("published_at < timestamp'2024-01-12'"))


view("heal_in", """
  SELECT doc_id, lang, source, CASE WHEN doc_id % 29 = 0 THEN NULL WHEN doc_id % 31 = 0 THEN n_chars::varchar WHEN doc_id % 37 = 0 THEN '  ' || chr(10)
         WHEN doc_id % 41 = 0 THEN '!!! ~~ ' || chr(7) WHEN doc_id % 43 = 0 THEN chr(8203) || chr(1) ELSE text END AS text,
         CASE WHEN doc_id % 29 = 0 THEN 'null' WHEN doc_id % 31 = 0 THEN 'number' ELSE 'string' END AS json_type FROM documents""")
view("healed", rf"""
  SELECT *, coalesce(heal_action <> 'quarantined', false) AS was_healed,
         CASE heal_action WHEN 'truncated' THEN substr(text, 1, 5000) || '…' WHEN 'stripped_control_chars' THEN stripped WHEN 'quarantined' THEN NULL ELSE text END AS healed_text
  FROM (SELECT *, CASE WHEN error_type IN ('missing_text', 'empty_text') THEN 'quarantined' WHEN error_type = 'wrong_type' THEN 'type_conversion'
                 WHEN error_type = 'special_characters_only' THEN CASE WHEN regexp_replace(stripped, '[ \t\n\r]', '', 'g') = '' THEN 'quarantined' ELSE 'stripped_control_chars' END
                 WHEN error_type = 'too_long' THEN 'truncated' END AS heal_action
        FROM (SELECT *, CASE WHEN text IS NULL OR json_type NOT IN ('string', 'number') THEN 'missing_text' WHEN json_type = 'number' THEN 'wrong_type'
                       WHEN regexp_replace(text, '[ \t\n\r]', '', 'g') = '' THEN 'empty_text' WHEN NOT regexp_matches(stripped, '[\p{{L}}\p{{N}}]') THEN 'special_characters_only'
                       WHEN length(text) > 5000 THEN 'too_long' END AS error_type
              FROM (SELECT *, regexp_replace(regexp_replace(text, '{_CONTROL}', '', 'g'), '[\x{{200b}}-\x{{200f}}\x{{202a}}-\x{{202e}}\x{{2066}}-\x{{2069}}]', '', 'g') AS stripped FROM heal_in)))""")


def heal_input(t: Tables):
    d = F.col("doc_id")
    odd = (F.when(d % 29 == 0, F.lit(None).cast("string")).when(d % 31 == 0, F.col("n_chars").cast("string")).when(d % 37 == 0, "  \n")
           .when(d % 41 == 0, "!!! ~~ \x07").when(d % 43 == 0, "\u200b\x01").otherwise(F.col("text")))
    kind = F.when(d % 29 == 0, "null").when(d % 31 == 0, "number").otherwise("string")
    return t.documents.select("doc_id", "lang", "source", odd.alias("text"), kind.alias("json_type"))


@query("heal_text", "SELECT doc_id, error_type, heal_action, was_healed, md5(healed_text) AS digest, length(healed_text) AS chars FROM healed")
def heal_text(t: Tables):
    return comments.heal(heal_input(t)).select("doc_id", "error_type", "heal_action", "was_healed",
                                               F.md5("healed_text").alias("digest"), F.length("healed_text").alias("chars"))


view("heal_log", """
  SELECT lang, source, count(*) AS total_rows, count(*) FILTER (was_healed) AS healed_rows,
         count(*) FILTER (heal_action = 'quarantined') AS quarantined_rows,
         CASE WHEN count(*) FILTER (heal_action = 'quarantined') / count(*)::double > 0.10 THEN 'CRITICAL'
              WHEN count(*) FILTER (heal_action = 'quarantined') > 0 THEN 'DEGRADED'
              WHEN count(*) FILTER (was_healed) / count(*)::double > 0.10 THEN 'WARNING' ELSE 'HEALTHY' END AS health_status
  FROM healed GROUP BY 1, 2""")


@query("health_level", "SELECT * FROM heal_log")
def health_level(t: Tables):
    return comments.health_log(comments.heal(heal_input(t)), ["lang", "source"])


@query("health_latest", """
  SELECT lang AS pipeline, source, CASE health_status WHEN 'HEALTHY' THEN 0 WHEN 'WARNING' THEN 1 WHEN 'DEGRADED' THEN 2 ELSE 3 END::bigint AS status
  FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY source DESC, health_status) AS rn FROM heal_log) WHERE rn = 1""")
def health_latest(t: Tables):
    """Each language is a pipeline and each source a run, the greatest name the newest."""
    return comments.health_latest(comments.health_log(comments.heal(heal_input(t)), ["lang", "source"]), "lang", "source")


@query("parse_pages")
def parse_pages(t: Tables):
    parsed = comments.parse_pages(t.pages, F.lit("2024-01-01").cast("timestamp"))
    return comments.require_parsed(parsed)


@query("page_titles", r"""
  SELECT page_id, trim(replace(replace(replace(regexp_extract(html, '<title>([^<]*)</title>', 1), '&lt;', '<'), '&gt;', '>'), '&amp;', '&')) AS title FROM pages""")
def page_titles(t: Tables):
    return comments.parse_pages(t.pages, F.lit("2024-01-01").cast("timestamp")).select("page_id", "title")


@query("infer_year", """
  SELECT o_orderpriority AS board, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderdate DESC, o_orderkey) AS pos,
         strftime(o_orderdate, '%m/%d') AS month_day, strftime(o_orderdate, '%Y-%m-%d') AS post_date FROM orders""")
def infer_year(t: Tables):
    """Orders as listings without a year: the inferred date must be the order date."""
    rows = t.orders.select(F.col("o_orderpriority").alias("board"), "o_orderdate", "o_orderkey", F.date_format("o_orderdate", "MM/dd").alias("month_day"))
    placed = ordered_prefix(rows, [F.col("o_orderdate").desc(), F.col("o_orderkey").asc()], ["board"], row_number="pos")
    newest = t.orders.groupBy(F.col("o_orderpriority").alias("board")).agg(F.max(F.year("o_orderdate")).alias("_year"))
    listing = cut(placed.select("board", "pos", "month_day").join(newest, "board"))
    return comments.infer_year(listing, "board", "pos", "month_day", F.col("_year")).drop("_year")


view("art", """
  SELECT *, comments_push - comments_boo AS comments_score FROM (
    SELECT source AS board, doc_id AS aid, (date '2024-01-01' + (doc_id % 9)::int)::date AS post_date,
           CASE WHEN doc_id % 17 <> 0 THEN 'cat' || (n_chars % 4) END AS category, 'a' || (n_chars % 60) AS author_id,
           n_chars % 120 AS comments_total, (n_chars % 120) // 2 AS comments_push, (n_chars % 120) // 5 AS comments_boo FROM documents)""")
view("boards", """
  SELECT a.board, a.post_date, count(*) AS articles_count, count(DISTINCT author_id) AS distinct_authors, sum(comments_total)::bigint AS comments_total,
         sum(comments_push)::bigint AS push_total, sum(comments_boo)::bigint AS boo_total, count(*) FILTER (comments_total >= 50) AS hot_articles_count,
         any_value(t.category) AS top_category, round((sum(comments_total) / count(*)::double)::decimal(38,12), 1)::double AS avg_comments_per_article,
         round((sum(comments_score) / count(*)::double)::decimal(38,12), 2)::double AS avg_comment_score
  FROM art a LEFT JOIN (SELECT board, post_date, category FROM (
      SELECT board, post_date, category, row_number() OVER (PARTITION BY board, post_date ORDER BY count(*) DESC, category) AS rn
      FROM art WHERE category IS NOT NULL GROUP BY 1, 2, 3) WHERE rn = 1) t USING (board, post_date) GROUP BY 1, 2""")


@query("board_daily", "SELECT * REPLACE (post_date::varchar AS post_date) FROM boards")
def board_daily(t: Tables):
    return comments.board_daily(adapters.articles(t))


@query("dq_text_invariants", """
  SELECT 'plain_author' AS check_name, count(*) FILTER (NOT regexp_matches(author_hash, '^[0-9a-f]{16}$')) AS offending_rows FROM cm
  UNION ALL SELECT 'negative_counts', count(*) FILTER (like_count < 0 OR total_reply_count < 0) FROM cm
  UNION ALL SELECT 'replies', count(*) FILTER (is_reply) FROM cm
  UNION ALL SELECT 'push_boo_bounded', count(*) FILTER (push_total + boo_total > comments_total) FROM boards""")
def dq_text_invariants(t: Tables):
    return comments.text_invariants(comment_rows(t), comments.board_daily(adapters.articles(t)))


@query("duration_seconds", """
  SELECT event_id, (event_id % 5) * 86400 * (event_id % 7 = 0)::int + (event_id % 4) * 3600 + (event_id % 60) * 60 + user_id % 60 AS seconds FROM events""")
def duration_seconds(t: Tables):
    """Durations written as text and read back."""
    part = lambda v, unit: F.when(v > 0, F.concat(v.cast("string"), F.lit(unit))).otherwise("")
    e, u = F.col("event_id"), F.col("user_id")
    days = part(F.when(e % 7 == 0, e % 5).otherwise(0), "D")
    text = F.concat(F.lit("P"), days, F.lit("T"), part(e % 4, "H"), part(e % 60, "M"), part(u % 60, "S"))
    return t.events.select("event_id", tx.duration_seconds(text).alias("seconds"))


@query("dlq_split", """
  SELECT event_id, CASE WHEN event_type <> 'error' THEN 'done' WHEN event_id % 6 >= 3 THEN 'replayed' ELSE 'retry' END AS route,
         CASE WHEN event_type <> 'error' THEN event_id % 6 WHEN event_id % 6 >= 3 THEN 0 ELSE event_id % 6 END AS attempts,
         CASE WHEN event_type = 'error' AND event_id % 6 < 3 THEN 'http 5xx' END AS error FROM events""")
def dlq_split(t: Tables):
    work = t.events.select("event_id", (F.col("event_id") % 6).alias("attempts"),
                           F.when(F.col("event_type") == "error", "http 5xx").alias("error"))
    routed = comments.route_failures(work)
    return routed.where("route <> 'dead_letter'").unionByName(
        comments.replay_dead(routed).withColumn("route", F.lit("replayed"))).select("event_id", "route", "attempts", "error")


view("sent", """
  SELECT 'cm' || doc_id AS comment_id, 'v' || (doc_id % 100) AS video_id, CASE WHEN toxic = 1 THEN 'negative' WHEN quality = 1 THEN 'positive' ELSE 'neutral' END AS label,
         coalesce(CASE WHEN doc_id % 13 <> 0 THEN n_chars % 97 END, 0) AS like_count, make_timestamp(1704067200000000 + (doc_id % 10007) * 1730 * 1000000) AS published_at,
         make_timestamp(1704067200000000 + (doc_id % 10007) * 1730 * 1000000) + INTERVAL 30 HOUR AS scored_at
  FROM labels JOIN documents USING (doc_id)""")


def sentiment(t: Tables):
    label = F.when(F.col("toxic") == 1, "negative").when(F.col("quality") == 1, "positive").otherwise("neutral")
    scored = t.labels.select(F.concat(F.lit("cm"), F.col("doc_id").cast("string")).alias("comment_id"), label.alias("label"))
    rows = scored.join(comment_rows(t).select("comment_id", "video_id", "like_count", "published_at"), "comment_id")
    return rows.withColumn("scored_at", F.col("published_at") + F.expr("INTERVAL 30 HOURS"))


@query("video_sentiment", """
  SELECT video_id, count(*) AS scored_comments, round((count(*) FILTER (label = 'positive') / count(*)::double)::decimal(38,12), 4)::double AS pos_ratio,
         round((count(*) FILTER (label = 'neutral') / count(*)::double)::decimal(38,12), 4)::double AS neu_ratio,
         round((count(*) FILTER (label = 'negative') / count(*)::double)::decimal(38,12), 4)::double AS neg_ratio,
         round(((count(*) FILTER (label = 'positive') - count(*) FILTER (label = 'negative')) / count(*)::double)::decimal(38,12), 4)::double AS sentiment_score,
         arg_max(comment_id, (like_count, comment_id)) FILTER (label = 'negative') AS top_liked_negative_comment_id
  FROM sent GROUP BY 1""")
def video_sentiment(t: Tables):
    return comments.video_sentiment(sentiment(t))


@query("stratified_sample", """
  SELECT doc_id, lang, source, sample_no FROM (
    SELECT *, row_number() OVER (PARTITION BY lang, source ORDER BY md5(doc_id || '|42'), doc_id) AS sample_no FROM documents) WHERE sample_no <= 5""")
def stratified_sample(t: Tables):
    return comments.stratified_sample(t.documents.select("doc_id", "lang", "source"), ["lang", "source"], "doc_id", 5, 42)


@query("cohen_kappa", """
  WITH c AS (SELECT quality AS a, 1 - toxic AS b, count(*)::double AS n FROM labels GROUP BY 1, 2),
  s AS (SELECT sum(n) AS t, sum(n) FILTER (a = b) AS o FROM c),
  e AS (SELECT sum(na * nb) AS e FROM (SELECT a, sum(n) AS na FROM c GROUP BY 1) l JOIN (SELECT b, sum(n) AS nb FROM c GROUP BY 1) r ON a = b)
  SELECT t::bigint AS items, round((o / t)::decimal(38,12), 6)::double AS observed, round((e / (t * t))::decimal(38,12), 6)::double AS expected,
         round(((o / t - e / (t * t)) / (1 - e / (t * t)))::decimal(38,12), 6)::double AS kappa FROM s, e""")
def cohen_kappa(t: Tables):
    return comments.cohen_kappa(t.labels.withColumn("calm", 1 - F.col("toxic")), "quality", "calm")
