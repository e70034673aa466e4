"""Landing envelopes to typed snapshots, one row per (video, region, hour)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.operators.ordering import first_per
from tidemark.schemas import SILVER_COLUMNS, SILVER_KEY

_COUNTS = {"views": "viewCount", "likes": "likeCount", "comment_count": "commentCount"}


def _count(text: Column, strict: bool) -> Column:
    """Missing counts are 0. Garbage fails the job, or in lenient mode reads as missing."""
    return F.coalesce(text.cast("long") if strict else text.try_cast("long"), F.lit(0))


def explode_items(envelopes: DataFrame) -> DataFrame:
    """One row per item; envelopes without items give none."""
    meta = F.col("_metadata")
    return envelopes.select(
        meta["region"].alias("region"), meta["ingestion_id"].alias("ingestion_id"),
        F.to_timestamp(meta["ingested_at"]).alias("ingested_at"),
        # the logical hour, not the wall clock: a late run must stay in its own hour
        F.date_trunc("hour", F.to_timestamp(meta["logical_hour"])).alias("captured_at"),
        F.explode("response.items").alias("item"),
    )


def ratios(df: DataFrame) -> DataFrame:
    def guarded(top: Column) -> Column:
        return F.when(F.col("views") > 0, top / F.col("views")).otherwise(F.lit(0.0))

    return df.withColumns({
        "like_ratio": guarded(F.col("likes")),
        "engagement_rate": guarded(F.col("likes") + F.col("comment_count")),
    })


def dedupe(df: DataFrame) -> DataFrame:
    """Keep the latest ingest of each key; full tiebreak so a rerun keeps the same row."""
    latest = [F.col(c).desc_nulls_last() for c in
              ("ingested_at", "ingestion_id", "views", "likes", "comment_count", "title", "description")]
    return first_per(df, SILVER_KEY, latest)


def to_silver(envelopes: DataFrame, strict: bool = True) -> DataFrame:
    item, snippet = F.col("item"), F.col("item.snippet")
    rows = explode_items(envelopes).where(item["id"].isNotNull()).select(
        item["id"].alias("video_id"), "region", "captured_at", "ingestion_id", "ingested_at",
        snippet["title"].alias("title"), snippet["description"].alias("description"),
        F.array_join(snippet["tags"], ",").alias("tags"),
        snippet["channelId"].alias("channel_id"), snippet["channelTitle"].alias("channel_title"),
        snippet["categoryId"].alias("category_id"),
        F.to_timestamp(snippet["publishedAt"]).alias("published_at"),
        snippet["thumbnails"]["high"]["url"].alias("thumbnail_url"),
        *[_count(item["statistics"][raw], strict).alias(name) for name, raw in _COUNTS.items()],
    )
    return dedupe(ratios(rows)).select(*SILVER_COLUMNS)


def rejected_counts(envelopes: DataFrame) -> DataFrame:
    """How many counts are present but not numeric, per region (lenient mode's reject count)."""
    stats = F.col("item.statistics")
    bad = [F.count_if(stats[raw].isNotNull() & stats[raw].try_cast("long").isNull()).alias(name)
           for name, raw in _COUNTS.items()]
    return explode_items(envelopes).groupBy("region").agg(*bad)
