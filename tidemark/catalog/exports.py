"""Queries: the datasets the presentation layer reads."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.catalog.comments import sentiment
from tidemark.catalog.snapshots import daily, stg
from tidemark.plans import comments, exports, marts, prediction
from tidemark.registry import query, view
from tidemark.session import cut, scratch_path
from tidemark.sources import adapters
from tidemark.sources.tables import Tables

view("ex_top_videos", """
  SELECT * EXCLUDE (rk) FROM (SELECT *, row_number() OVER (PARTITION BY region ORDER BY latest_views DESC, video_id) AS rk FROM lifecycle) WHERE rk <= 100""")


def lifecycle(t: Tables):
    return marts.video_lifecycle(stg(t), adapters.categories(t))


@query("export_trending_daily", """
  SELECT * REPLACE (trending_date::varchar AS trending_date) FROM gold_trending
  WHERE trending_date > (SELECT max(trending_date) FROM gold_trending) - 90""")
def export_trending_daily(t: Tables):
    return exports.trending_daily(cut(marts.trending_daily(daily(t))))


@query("export_category_daily", """
  SELECT * REPLACE (trending_date::varchar AS trending_date) FROM gold_category
  WHERE trending_date > (SELECT max(trending_date) FROM gold_category) - 60""")
def export_category_daily(t: Tables):
    return exports.category_daily(cut(marts.category_daily(daily(t), adapters.categories(t))))


@query("export_channels", "SELECT * FROM gold_channel WHERE rank_in_region <= 50")
def export_channels(t: Tables):
    return exports.channels(marts.channel_performance(stg(t)))


def predictions(t: Tables):
    label = prediction.doubled_in_24h(stg(t))
    return label.select("video_id", "region", (F.col("label") == 1).alias("predicted_label"),
                        F.round((F.col("v24") / F.greatest(F.col("v0"), F.lit(1))).cast("decimal(38,12)"), 4).alias("growth_24h"))


@query("export_videos", """
  SELECT v.*, p.label = 1 AS predicted_label, round((p.v24 / greatest(p.v0, 1)::double)::decimal(38,12), 4)::double AS growth_24h
  FROM ex_top_videos v LEFT JOIN (SELECT *, (v24 >= 2 * v0)::bigint AS label FROM pd_label) p USING (video_id, region)""")
def export_videos(t: Tables):
    return exports.videos(lifecycle(t), predictions(t))


view("ex_points", """
  SELECT * FROM (SELECT v.*, row_number() OVER (PARTITION BY video_id, region ORDER BY captured_at) AS pt FROM velocity v
    JOIN (SELECT video_id, region FROM (SELECT *, row_number() OVER (PARTITION BY region ORDER BY peak_delta_views_per_hour DESC NULLS LAST, video_id) AS rk FROM lifecycle) WHERE rk <= 10) USING (video_id, region)) WHERE pt <= 72""")


@query("export_velocity_series", """
  SELECT region, video_id, max(title) AS title, max(channel_title) AS channel_title, count(*) AS points,
         string_agg(strftime(captured_at, '%Y%m%d%H') || ':' || views || ':' || velocity_rank, ' ' ORDER BY captured_at) AS series FROM ex_points GROUP BY 1, 2""")
def export_velocity_series(t: Tables):
    nested = exports.velocity_series(lifecycle(t), marts.velocity_hourly(stg(t)))
    text = F.transform("series", lambda p: F.concat_ws(":", F.date_format(p["captured_at"], "yyyyMMddHH"), p["views"].cast("string"), p["velocity_rank"].cast("string")))
    return nested.select("region", "video_id", "title", "channel_title", F.size("series").alias("points"), F.array_join(text, " ").alias("series"))


view("ex_sentiment", """
  SELECT video_id, count(*) AS scored_comments, count(*) FILTER (label = 'negative') AS negatives FROM sent GROUP BY 1""")


@query("export_sentiment_videos", """
  SELECT video_id, region, scored_comments, title, channel_title FROM (
    SELECT s.video_id, l.region, s.scored_comments, l.title, l.channel_title,
           row_number() OVER (PARTITION BY l.region ORDER BY s.scored_comments DESC, s.video_id) AS rk
    FROM ex_sentiment s JOIN lifecycle l USING (video_id)) WHERE rk <= 100""")
def export_sentiment_videos(t: Tables):
    return exports.sentiment_videos(comments.video_sentiment(sentiment(t)), lifecycle(t)).select(
        "video_id", "region", "scored_comments", "title", "channel_title")


@query("export_sentiment_daily", """
  SELECT region, scored_at::date::varchar AS date, count(*) FILTER (label = 'positive') AS positive, count(*) FILTER (label = 'neutral') AS neutral,
         count(*) FILTER (label = 'negative') AS negative
  FROM sent JOIN (SELECT DISTINCT video_id, region FROM lifecycle) USING (video_id) GROUP BY 1, 2""")
def export_sentiment_daily(t: Tables):
    return exports.sentiment_daily(sentiment(t), lifecycle(t))


@query("export_board_daily", """
  SELECT * REPLACE (post_date::varchar AS post_date) FROM boards WHERE post_date > (SELECT max(post_date) FROM boards) - 90""")
def export_board_daily(t: Tables):
    return exports.board_daily(cut(comments.board_daily(adapters.articles(t))))


def datasets(t: Tables) -> list[exports.Dataset]:
    rows = cut(stg(t))
    latest, cats = marts.latest_per_day(rows), adapters.categories(t)
    life = cut(marts.video_lifecycle(rows, cats))
    scored = cut(sentiment(t))
    d = exports.Dataset
    return [
        d("trending_daily", ("gold_trending_daily",), exports.trending_daily(cut(marts.trending_daily(latest)))),
        d("category_daily", ("gold_category_daily",), exports.category_daily(cut(marts.category_daily(latest, cats)))),
        d("channels", ("gold_channel_performance",), exports.channels(marts.channel_performance(rows))),
        d("videos", ("gold_video_lifecycle", "ml_video_predictions"), exports.videos(life, predictions(t))),
        d("velocity_top", ("gold_video_velocity_hourly",), exports.velocity_series(life, marts.velocity_hourly(rows))),
        d("sentiment_videos", ("gold_video_sentiment",), exports.sentiment_videos(comments.video_sentiment(scored), life)),
        d("sentiment_daily", ("ml_comment_sentiment",), exports.sentiment_daily(scored, life)),
        d("rag_showcase", ("ml_rag_showcase",), exports.table_or_absent(t.spark, "ml_rag_showcase")),
        d("title_examples", ("ml_title_examples",), exports.table_or_absent(t.spark, "ml_title_examples")),
        d("board_daily", ("gold_board_daily",), exports.board_daily(cut(comments.board_daily(adapters.articles(t))))),
    ]


@query("export_envelope")
def export_envelope(t: Tables):
    """Ten files written, read back, and checked against the limits."""
    wanted, folder = datasets(t), scratch_path(t.spark, "exports")
    found = exports.write_all(t.spark, wanted, folder, "2024-02-01T00:00:00Z")
    problems = exports.validate(found, [d.name for d in wanted])
    return found.withColumn("problems", F.lit(",".join(problems)))
