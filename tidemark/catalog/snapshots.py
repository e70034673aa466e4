"""Queries over snapshots: landing, silver, store, staging, marts."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.plans import marts, silver as silver_plan
from tidemark.registry import query, view
from tidemark.schemas import CATEGORY_ENVELOPE, CATEGORY_KEY, ENVELOPE, SILVER_COLUMNS, SILVER_KEY
from tidemark.session import scratch_path
from tidemark.sources import adapters, landing, store
from tidemark.sources.tables import Tables

view("snap_base", """
  SELECT (json_extract(props, '$.k'))::bigint AS k, event_id, user_id, event_type, value, ts,
         ['TW','JP','KR','HK','US','GB','SG','AU'][(user_id % 8 + 1)::int] AS region,
         date_trunc('hour', ts)::timestamp AS captured_at,
         CASE WHEN event_type = 'error' THEN 0
              ELSE round(value * 100)::bigint + (epoch_us(ts) - 1704067200000000) // 60000000 * 2 END AS views
  FROM events""")
view("snap_raw", """
  SELECT 'v' || k AS video_id, region, captured_at, 'Video ' || k AS title,
         CASE WHEN k % 9 <> 0 THEN 'seen by ' || event_type END AS description,
         't' || (k % 7) || ',t' || (k % 3) AS tags,
         CASE WHEN k <> 98 THEN 'c' || (k % 25) END AS channel_id,
         CASE WHEN k <> 98 THEN 'Channel ' || (k % 25) END AS channel_title,
         CASE WHEN k <> 97 THEN (k % 10)::varchar END AS category_id,
         make_timestamp(1704067200000000 - (k + 24) * 3600000000) AS published_at,
         views, views // (3 + k % 5) AS likes, views // 50 + event_id % 10 AS comment_count,
         CASE WHEN views > 0 THEN (views // (3 + k % 5))::double / views ELSE 0.0::double END AS like_ratio,
         CASE WHEN views > 0 THEN (views // (3 + k % 5) + views // 50 + event_id % 10)::double / views
              ELSE 0.0::double END AS engagement_rate,
         'https://img.example.com/hq.jpg' AS thumbnail_url,
         region || '_' || strftime(captured_at, '%Y%m%d%H') AS ingestion_id, ts AS ingested_at
  FROM snap_base""")
view("silver", """
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY video_id, region, captured_at ORDER BY ingested_at DESC,
             ingestion_id DESC, views DESC, likes DESC, comment_count DESC, title DESC,
             description DESC NULLS LAST) AS rn
    FROM snap_raw) WHERE rn = 1""")
view("categories", """
  SELECT (k % 10)::varchar AS category_id, region, 'Category ' || (k % 10) AS category_name,
         max(ts) AS updated_at
  FROM snap_base WHERE k % 10 < 8 GROUP BY 1, 2, 3""")
view("stg", "SELECT *, captured_at::date AS trending_date FROM silver WHERE video_id IS NOT NULL")
view("latest_day", """
  SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (
      PARTITION BY video_id, region, trending_date ORDER BY captured_at DESC) AS rn FROM stg) WHERE rn = 1""")
view("gold_trending", """
  SELECT region, trending_date, count(DISTINCT video_id) AS total_videos, sum(views)::bigint AS total_views,
         sum(likes)::bigint AS total_likes,
         round((sum(views)::decimal(38,12) / count(*))::decimal(38,12), 0)::double AS avg_views_per_video,
         round(avg(like_ratio)::decimal(38,12), 4)::double AS avg_like_ratio,
         round(avg(engagement_rate)::decimal(38,12), 4)::double AS avg_engagement_rate,
         count(DISTINCT channel_id) AS unique_channels, count(DISTINCT category_id) AS unique_categories
  FROM latest_day GROUP BY region, trending_date""")
view("gold_channel", """
  SELECT a.channel_id, a.channel_title, a.region, a.videos_trended, a.total_views, a.avg_engagement_rate,
         d.days_on_chart, rank() OVER (PARTITION BY a.region ORDER BY a.total_views DESC) AS rank_in_region,
         a.categories
  FROM (SELECT channel_id, region, max(channel_title) AS channel_title,
               count(DISTINCT video_id) AS videos_trended, sum(views)::bigint AS total_views,
               round(avg(engagement_rate)::decimal(38,12), 4)::double AS avg_engagement_rate,
               string_agg(DISTINCT category_id, ',' ORDER BY category_id) AS categories
        FROM (SELECT *, row_number() OVER (PARTITION BY video_id, region ORDER BY captured_at DESC) AS rn
              FROM stg) WHERE rn = 1 GROUP BY channel_id, region) a
  JOIN (SELECT channel_id, region, count(DISTINCT trending_date) AS days_on_chart FROM stg
        GROUP BY channel_id, region) d USING (channel_id, region)""")
view("gold_category", """
  SELECT a.category_id, coalesce(c.category_name, a.category_id) AS category_name, a.region, a.trending_date,
         a.video_count, a.total_views, a.avg_engagement_rate,
         round((a.total_views * 100::decimal(20,0) / nullif(sum(a.total_views) OVER (
             PARTITION BY a.region, a.trending_date), 0))::decimal(38,12), 2)::double AS view_share_pct
  FROM (SELECT category_id, region, trending_date, count(DISTINCT video_id) AS video_count,
               sum(views)::bigint AS total_views,
               round(avg(engagement_rate)::decimal(38,12), 4)::double AS avg_engagement_rate
        FROM latest_day GROUP BY category_id, region, trending_date) a
  LEFT JOIN categories c ON a.category_id = c.category_id AND a.region = c.region""")
view("snap_deltas", """
  SELECT video_id, title, channel_title, region, captured_at, views, likes, comment_count,
         lag(views) OVER w AS prev_views, lag(likes) OVER w AS prev_likes,
         lag(comment_count) OVER w AS prev_comments,
         round(((epoch_us(captured_at) - epoch_us(lag(captured_at) OVER w)) / 3.6e9)::decimal(38,12), 2)
             AS hours_since_prev
  FROM stg WINDOW w AS (PARTITION BY video_id, region ORDER BY captured_at)""")
view("velocity", """
  SELECT video_id, title, channel_title, region, captured_at, views, delta_views, delta_likes, delta_comments,
         hours_since_prev::double AS hours_since_prev,
         round(rate::decimal(38,12), 2)::double AS delta_views_per_hour,
         CASE WHEN prev_views <> 0 THEN
             round((delta_views * 100.0::double / prev_views)::decimal(38,12), 2)::double END AS delta_views_pct,
         rank() OVER (PARTITION BY region, captured_at ORDER BY rate DESC NULLS LAST) AS velocity_rank
  FROM (SELECT *, views - prev_views AS delta_views, likes - prev_likes AS delta_likes,
               comment_count - prev_comments AS delta_comments,
               (views - prev_views)::double / nullif(hours_since_prev::double, 0) AS rate
        FROM snap_deltas WHERE prev_views IS NOT NULL)""")
view("lifecycle", """
  SELECT b.video_id, b.region, l.title, l.description, l.tags, l.channel_id, l.channel_title, l.category_id,
         coalesce(c.category_name, l.category_id) AS category_name, l.published_at, b.first_seen_at,
         b.last_seen_at, b.snapshots_count, b.hours_on_chart, f.views AS first_views, l.views AS latest_views,
         l.views - f.views AS total_views_gained, p.peak AS peak_delta_views_per_hour, b.avg_engagement_rate
  FROM (SELECT video_id, region, min(captured_at) AS first_seen_at, max(captured_at) AS last_seen_at,
               count(*) AS snapshots_count,
               round(((epoch_us(max(captured_at)) - epoch_us(min(captured_at))) / 3.6e9)::decimal(38,12), 2)::double
                   AS hours_on_chart,
               round(avg(engagement_rate)::decimal(38,12), 4)::double AS avg_engagement_rate
        FROM stg GROUP BY video_id, region) b
  JOIN stg l ON l.video_id = b.video_id AND l.region = b.region AND l.captured_at = b.last_seen_at
  JOIN stg f ON f.video_id = b.video_id AND f.region = b.region AND f.captured_at = b.first_seen_at
  LEFT JOIN (SELECT video_id, region, max(delta_views_per_hour) AS peak FROM velocity GROUP BY video_id, region) p
       ON p.video_id = b.video_id AND p.region = b.region
  LEFT JOIN categories c ON l.category_id = c.category_id AND b.region = c.region""")

COLS = ", ".join(SILVER_COLUMNS)


def stg(t: Tables):
    return marts.stg_video_snapshots(adapters.silver(t))


def daily(t: Tables):
    return marts.latest_per_day(stg(t))


# --- landing -----------------------------------------------------------------------------

@query("hour_range", """
  SELECT unnest(generate_series(date_trunc('hour', lo), date_trunc('hour', hi), INTERVAL 1 HOUR)) AS logical_hour
  FROM (SELECT min(ts) AS lo, max(ts) AS hi FROM events)""")
def hour_range(t: Tables):
    bounds = t.events.agg(F.min("ts").alias("lo"), F.max("ts").alias("hi"))
    return bounds.select(F.explode(F.sequence(
        F.date_trunc("hour", "lo"), F.date_trunc("hour", "hi"), F.expr("INTERVAL 1 HOUR"))).alias("logical_hour"))


@query("bronze_envelope", """
  SELECT region, strftime(captured_at, '%Y-%m-%dT%H:%M:%S+00:00') AS logical_hour,
         region || '_' || strftime(captured_at, '%Y%m%d%H') AS ingestion_id,
         strftime(seen, '%Y-%m-%dT%H:%M:%S.%f+00:00') AS ingested_at, 'youtube_data_api_v3' AS source,
         count(*) AS items, sum(views)::bigint AS item_views
  FROM (SELECT *, make_timestamp(epoch_us(ts) // 600000000 * 600000000) AS seen, event_id // 400 AS page
        FROM snap_base)
  GROUP BY region, captured_at, seen, page""")
def bronze_envelope(t: Tables):
    views = F.aggregate(F.col("response.items"), F.lit(0).cast("long"),
                        lambda acc, x: acc + x["statistics"]["viewCount"].cast("long"))
    return adapters.envelopes(t).select(
        "_metadata.*", F.size("response.items").alias("items"), views.alias("item_views"))


@query("bronze_keys", """
  SELECT DISTINCT 'youtube_trending/region=' || region || '/date=' || strftime(captured_at, '%Y-%m-%d')
           || '/hour=' || strftime(captured_at, '%H') || '/snapshot.json' AS snapshot_key,
         'youtube_trending/region=' || region || '/date=' || strftime(captured_at, '%Y-%m-%d')
           || '/categories.json' AS category_key
  FROM snap_base""")
def bronze_keys(t: Tables):
    hours = adapters.raw_snapshots(t).select("region", "captured_at").distinct()
    prefix = F.lit("youtube_trending")
    return hours.select(
        landing.landing_key(prefix, F.col("region"), F.col("captured_at"), "snapshot.json").alias("snapshot_key"),
        landing.landing_key(prefix, F.col("region"), F.col("captured_at"), "categories.json", False).alias("category_key"),
    ).distinct()


def _landed(t: Tables, envelopes, name: str, schema):
    """Write documents as date-partitioned JSON and scan them back with the explicit schema."""
    path = scratch_path(t.spark, name)
    docs = envelopes.select(
        F.substring("_metadata.logical_hour", 1, 10).alias("date"),
        F.to_json(F.struct("_metadata", "response")).alias("value"))
    landing.write_documents(docs.hint("rebalance", F.col("date")), path, ["date"])
    return landing.read_documents(t.spark, f"{path}/date=*", base=path, whole_file=False, schema=schema)


@query("bronze_scan", """
  SELECT strftime(captured_at, '%Y-%m-%d') AS date, count(*) AS items,
         count(DISTINCT (region, captured_at, epoch_us(ts) // 600000000, event_id // 400)) AS documents,
         sum(views)::bigint AS item_views
  FROM snap_base GROUP BY 1""")
def bronze_scan(t: Tables):
    docs = _landed(t, adapters.envelopes(t), "bronze", ENVELOPE).withColumn("_doc", F.monotonically_increasing_id())
    items = docs.select(F.date_format("date", "yyyy-MM-dd").alias("date"), "_doc",
                        F.size("response.items").alias("n"),
                        F.aggregate("response.items", F.lit(0).cast("long"),
                                    lambda a, x: a + x["statistics"]["viewCount"].cast("long")).alias("v"))
    return items.groupBy("date").agg(F.sum("n").alias("items"), F.count("_doc").alias("documents"),
                                     F.sum("v").alias("item_views"))


view("bronze_silver", """
  SELECT * EXCLUDE (rn) FROM (
    SELECT * REPLACE (make_timestamp(epoch_us(ingested_at) // 600000000 * 600000000) AS ingested_at),
           row_number() OVER (PARTITION BY video_id, region, captured_at
             ORDER BY epoch_us(ingested_at) // 600000000 DESC, views DESC, likes DESC, comment_count DESC,
                      title DESC, description DESC NULLS LAST) AS rn
    FROM snap_raw) WHERE rn = 1""")


@query("silver_transform", f"SELECT {COLS} FROM bronze_silver")
def silver_transform(t: Tables):
    return silver_plan.to_silver(_landed(t, adapters.envelopes(t), "bronze", ENVELOPE))


@query("silver_dedupe", f"SELECT {COLS} FROM silver")
def silver_dedupe(t: Tables):
    return adapters.silver(t)


@query("silver_rejects", "SELECT region, 0::bigint AS views, 0::bigint AS likes, 0::bigint AS comment_count FROM snap_base GROUP BY 1")
def silver_rejects(t: Tables):
    return silver_plan.rejected_counts(adapters.envelopes(t))


# --- store -------------------------------------------------------------------------------

@query("silver_idempotent_overwrite", """
  SELECT strftime(captured_at, '%Y-%m-%d') AS day, count(*) AS row_count, sum(views)::bigint AS views
  FROM silver GROUP BY 1""")
def silver_idempotent_overwrite(t: Tables):
    """Write every day, then write the later half again: nothing grows, nothing is lost."""
    path = scratch_path(t.spark, "silver")
    rows = adapters.silver(t).withColumn("day", F.date_format("captured_at", "yyyy-MM-dd"))
    store.overwrite_partitions(rows, path, ["day"])
    store.overwrite_partitions(rows.where("captured_at >= timestamp'2024-01-16'"), path, ["day"])
    return (store.read_table(t.spark, path).groupBy(F.date_format("day", "yyyy-MM-dd").alias("day"))
            .agg(F.count(F.lit(1)).alias("row_count"), F.sum("views").alias("views")))


@query("silver_range_scan", f"""
  SELECT {COLS} FROM silver
  WHERE captured_at BETWEEN timestamp '2024-01-05 06:00' AND timestamp '2024-01-20 18:00'""")
def silver_range_scan(t: Tables):
    hours = t.within("events", "ts", "2024-01-05 06:00:00", "2024-01-20 19:00:00")  # whole hours: dedupe sees all of each
    return store.range_scan(adapters.silver(hours), F.lit("2024-01-05 06:00").cast("timestamp"),
                            F.lit("2024-01-20 18:00").cast("timestamp"), SILVER_COLUMNS, strict=True)


@query("upsert_snapshots", f"""
  SELECT * REPLACE (CASE WHEN captured_at >= timestamp '2024-01-16' THEN views + 7 ELSE views END AS views,
                    CASE WHEN captured_at >= timestamp '2024-01-16' THEN 'again' ELSE ingestion_id END AS ingestion_id)
  FROM (SELECT {COLS} FROM silver)""")
def upsert_snapshots(t: Tables):
    rows = adapters.silver(t)
    base = rows.where("captured_at < timestamp'2024-01-21'")
    batch = rows.where("captured_at >= timestamp'2024-01-16'").withColumns(
        {"views": F.col("views") + 7, "ingestion_id": F.lit("again")})
    return store.upsert(base, batch, SILVER_KEY)


@query("category_rows", """
  SELECT category_id, region, category_name, updated_at FROM categories""")
def category_rows(t: Tables):
    dim = adapters.categories(t)
    docs = dim.groupBy("region", "updated_at").agg(F.collect_list(F.struct(
        F.col("category_id").alias("id"), F.struct(F.col("category_name").alias("title")).alias("snippet"))).alias("items"))
    docs = docs.select(landing.metadata(F.col("region"), F.col("updated_at"), F.col("updated_at")).alias("_metadata"),
                       F.struct("items").alias("response"))
    parsed = docs.select(F.from_json(F.to_json(F.struct("*")), CATEGORY_ENVELOPE).alias("d")).select("d.*")
    return landing.category_rows(parsed, F.to_timestamp("_metadata.ingested_at"))


@query("upsert_categories", """
  SELECT category_id, region, category_name || CASE WHEN category_id IN ('1','3','5','7') THEN ' (new)' ELSE '' END
           AS category_name, updated_at
  FROM categories""")
def upsert_categories(t: Tables):
    dim = adapters.categories(t)
    renamed = dim.where(F.col("category_id").isin("1", "3", "5", "7")).withColumn(
        "category_name", F.concat("category_name", F.lit(" (new)")))
    return store.upsert(dim, renamed, CATEGORY_KEY)


@query("reprocess_range", """
  SELECT region, trending_date::varchar AS trending_date, total_videos, total_views FROM gold_trending
  WHERE trending_date BETWEEN date '2024-01-10' AND date '2024-01-12'""")
def reprocess_range(t: Tables):
    """Snapshots of an hour range again through the table and the daily mart, nothing fetched anew."""
    from tidemark.plans.pipeline import reprocess
    hours = landing.hour_list(start_hour="2024-01-10T00", end_hour="2024-01-12T23")
    table = store.daily_snapshot_table(t.spark, "serving")
    source = adapters.silver(t)
    reprocess(source, table, hours)
    stg_rows = marts.stg_video_snapshots(reprocess(source, table, hours))
    return marts.trending_daily(marts.latest_per_day(stg_rows)).select(
        "region", "trending_date", "total_videos", "total_views")


@query("empty_guard", """
  SELECT count(*) AS row_count, count(*) = 0 AS strict_refused FROM silver
  WHERE captured_at BETWEEN timestamp '1999-01-01' AND timestamp '1999-01-02'""")
def empty_guard(t: Tables):
    """The hourly load refuses an empty scan, the range load takes it."""
    rows = adapters.silver(t)
    before = [F.lit("1999-01-01").cast("timestamp"), F.lit("1999-01-02").cast("timestamp")]
    try:
        store.range_scan(rows, *before, SILVER_COLUMNS, strict=True)
        refused = False
    except store.EmptyScan:
        refused = True
    return (store.range_scan(rows, *before, SILVER_COLUMNS)
            .agg(F.count(F.lit(1)).alias("row_count")).withColumn("strict_refused", F.lit(refused)))


# --- staging and marts -------------------------------------------------------------------

@query("stg_video_snapshots", f"SELECT {COLS}, trending_date::varchar AS trending_date FROM stg")
def stg_video_snapshots(t: Tables):
    return stg(t)


@query("stg_categories", "SELECT category_id, region, category_name, updated_at FROM categories")
def stg_categories(t: Tables):
    return marts.stg_categories(adapters.categories(t))


@query("gold_trending_daily", "SELECT * REPLACE (trending_date::varchar AS trending_date) FROM gold_trending")
def gold_trending_daily(t: Tables):
    return marts.trending_daily(daily(t))


@query("gold_channel_performance", "SELECT * FROM gold_channel")
def gold_channel_performance(t: Tables):
    return marts.channel_performance(stg(t))


@query("gold_category_daily", "SELECT * REPLACE (trending_date::varchar AS trending_date) FROM gold_category")
def gold_category_daily(t: Tables):
    return marts.category_daily(daily(t), adapters.categories(t))


@query("gold_video_velocity_hourly", "SELECT * FROM velocity")
def gold_video_velocity_hourly(t: Tables):
    return marts.velocity_hourly(stg(t))


@query("gold_video_lifecycle", "SELECT * FROM lifecycle")
def gold_video_lifecycle(t: Tables):
    return marts.video_lifecycle(stg(t), adapters.categories(t))
