"""Staging views and the five marts."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Window, functions as F

from tidemark.functions.numeric import exact_round, hours_between
from tidemark.operators.ordering import first_per, ranked
from tidemark.schemas import SILVER_COLUMNS

_MEASURES = ["views", "likes", "comment_count", "like_ratio", "engagement_rate"]

LAYERS = {  # staging stays a view, marts are written as tables
    "stg_video_snapshots": "view", "stg_categories": "view",
    "gold_trending_daily": "table", "gold_channel_performance": "table",
    "gold_category_daily": "table", "gold_video_velocity_hourly": "table",
    "gold_video_lifecycle": "table",
}


def materialise(name: str, df: DataFrame, schema: str | None = None, clustered_by: Sequence[str] = (), buckets: int = 32,
                sorted_by: Sequence[str] = ()) -> None:
    """Keep a model as its layer says. A table can be clustered: jobs on its key then need no exchange of it."""
    if LAYERS.get(name, "table") == "view":
        df.createOrReplaceTempView(name)
        return
    writer = df.write.mode("overwrite")
    if clustered_by:
        # by the table's own hash, so that each bucket is written by one task and is one file
        writer = df.repartition(buckets, *clustered_by).write.mode("overwrite").bucketBy(buckets, *clustered_by).sortBy(*(sorted_by or clustered_by))
    writer.saveAsTable(f"{schema}.{name}" if schema else name)


def stg_video_snapshots(silver: DataFrame) -> DataFrame:
    columns = []
    for c in SILVER_COLUMNS:
        columns.append(F.coalesce(F.col(c), F.lit(0)).alias(c) if c in _MEASURES else F.col(c))
        if c == "captured_at":
            columns.append(F.to_date(c).alias("trending_date"))
    return silver.where("video_id is not null").select(*columns)


def stg_categories(categories: DataFrame) -> DataFrame:
    return categories.select("category_id", "region", "category_name", "updated_at")


def latest_per_day(stg: DataFrame) -> DataFrame:
    """Last snapshot of each (video, region, day); feeds the two daily marts."""
    return first_per(stg, ["video_id", "region", "trending_date"], [F.col("captured_at").desc()])


def trending_daily(latest: DataFrame) -> DataFrame:
    # one row per video and day in the input, so counting rows counts videos
    return latest.groupBy("region", "trending_date").agg(
        F.count("video_id").alias("total_videos"),
        F.sum("views").alias("total_views"),
        F.sum("likes").alias("total_likes"),
        exact_round(F.avg(F.col("views").cast("decimal(20,0)")), 0).alias("avg_views_per_video"),
        exact_round(F.avg("like_ratio"), 4).alias("avg_like_ratio"),
        exact_round(F.avg("engagement_rate"), 4).alias("avg_engagement_rate"),
        F.countDistinct("channel_id").alias("unique_channels"),
        F.countDistinct("category_id").alias("unique_categories"),
    )


def channel_performance(stg: DataFrame) -> DataFrame:
    latest = first_per(stg, ["video_id", "region"], [F.col("captured_at").desc()])
    agg = latest.groupBy("channel_id", "region").agg(
        F.max("channel_title").alias("channel_title"),
        F.count("video_id").alias("videos_trended"),
        F.sum("views").alias("total_views"),
        exact_round(F.avg("engagement_rate"), 4).alias("avg_engagement_rate"),
        F.array_join(F.sort_array(F.collect_set("category_id")), ",").alias("_categories"),
    )
    days = (stg.where("channel_id is not null").groupBy("channel_id", "region")
            .agg(F.countDistinct("trending_date").alias("days_on_chart")))
    out = ranked(agg.join(days, ["channel_id", "region"]), ["region"], [("total_views", "desc")], "rank_in_region")
    return out.select("channel_id", "channel_title", "region", "videos_trended", "total_views",
                      "avg_engagement_rate", "days_on_chart", "rank_in_region",
                      F.when(F.col("_categories") != "", F.col("_categories")).alias("categories"))


def category_daily(latest: DataFrame, categories: DataFrame) -> DataFrame:
    agg = latest.groupBy("category_id", "region", "trending_date").agg(
        F.count("video_id").alias("video_count"),
        F.sum("views").alias("total_views"),
        exact_round(F.avg("engagement_rate"), 4).alias("avg_engagement_rate"),
    )
    market = F.sum("total_views").over(Window.partitionBy("region", "trending_date"))
    names = categories.select("category_id", "region", "category_name")
    return (agg.withColumn("_market", market).join(names, ["category_id", "region"], "left")
            .select("category_id", F.coalesce("category_name", "category_id").alias("category_name"),
                    "region", "trending_date", "video_count", "total_views", "avg_engagement_rate",
                    F.round(F.col("total_views").cast("decimal(20,0)") * 100
                            / F.nullif(F.col("_market").cast("decimal(20,0)"), F.lit(0).cast("decimal(20,0)")), 2)
                    .alias("view_share_pct")))


def _deltas(stg: DataFrame) -> DataFrame:
    """Each snapshot beside the one before it. A group holds one row per hour of one video."""
    w = Window.partitionBy("video_id", "region").orderBy("captured_at")
    previous = {f"_prev_{c}": F.lag(c).over(w) for c in ("views", "likes", "comment_count", "captured_at")}
    return (stg.withColumns(previous)
            .withColumn("hours_since_prev",
                        exact_round(hours_between(F.col("captured_at"), F.col("_prev_captured_at")), 2))
            .withColumn("delta_views", F.col("views") - F.col("_prev_views"))
            .withColumn("_rate", F.col("delta_views").cast("double")
                        / F.nullif(F.col("hours_since_prev").cast("double"), F.lit(0.0))))


def velocity_unranked(stg: DataFrame) -> DataFrame:
    deltas = _deltas(stg.select("video_id", "title", "channel_title", "region", "captured_at",
                                "views", "likes", "comment_count")).where("_prev_views is not null")
    return deltas.select(
        "video_id", "title", "channel_title", "region", "captured_at", "views", "delta_views",
        (F.col("likes") - F.col("_prev_likes")).alias("delta_likes"),
        (F.col("comment_count") - F.col("_prev_comment_count")).alias("delta_comments"),
        "hours_since_prev", "_rate",
        exact_round(F.col("_rate"), 2).alias("delta_views_per_hour"),
        F.when(F.col("_prev_views") != 0,
               F.round(F.col("delta_views").cast("decimal(20,0)") * 100
                       / F.col("_prev_views").cast("decimal(20,0)"), 2)).alias("delta_views_pct"),
    )


def velocity_hourly(stg: DataFrame) -> DataFrame:
    # ranked on the unrounded rate
    return ranked(velocity_unranked(stg), ["region", "captured_at"], [("_rate", "desc")],
                  "velocity_rank").drop("_rate")


def video_lifecycle(stg: DataFrame, categories: DataFrame) -> DataFrame:
    """One pass: the lag window and the aggregate share the (video, region) partitioning."""
    facts = ["title", "description", "tags", "channel_id", "channel_title", "category_id", "published_at"]
    cols = ["video_id", "region", "captured_at", "views", "likes", "comment_count", "engagement_rate", *facts]
    bounds = _deltas(stg.select(*cols)).groupBy("video_id", "region").agg(
        F.min("captured_at").alias("first_seen_at"), F.max("captured_at").alias("last_seen_at"),
        F.count(F.lit(1)).alias("snapshots_count"),
        exact_round(F.avg("engagement_rate"), 4).alias("avg_engagement_rate"),
        F.min_by("views", "captured_at").alias("first_views"),
        F.max_by(F.struct(F.col("views").alias("latest_views"), *facts), "captured_at").alias("_last"),
        F.max(exact_round(F.col("_rate"), 2)).alias("peak_delta_views_per_hour"),
    ).select("*", "_last.*").drop("_last")
    names = categories.select("category_id", "region", "category_name")
    return bounds.join(names, ["category_id", "region"], "left").select(
        "video_id", "region", "title", "description", "tags", "channel_id", "channel_title", "category_id",
        F.coalesce("category_name", "category_id").alias("category_name"), "published_at",
        "first_seen_at", "last_seen_at", "snapshots_count",
        exact_round(hours_between(F.col("last_seen_at"), F.col("first_seen_at")), 2).alias("hours_on_chart"),
        "first_views", "latest_views",
        (F.col("latest_views") - F.col("first_views")).alias("total_views_gained"),
        "peak_delta_views_per_hour", "avg_engagement_rate",
    )


def build(silver: DataFrame, categories: DataFrame, names: Sequence[str] = tuple(LAYERS)) -> dict[str, DataFrame]:
    """The asked models. Ranked marts place their rows when they are built, so only ask for what is needed."""
    stg, cats = stg_video_snapshots(silver), stg_categories(categories)
    makers: dict[str, Callable[[], DataFrame]] = {
        "stg_video_snapshots": lambda: stg, "stg_categories": lambda: cats,
        "gold_trending_daily": lambda: trending_daily(latest_per_day(stg)),
        "gold_channel_performance": lambda: channel_performance(stg),
        "gold_category_daily": lambda: category_daily(latest_per_day(stg), cats),
        "gold_video_velocity_hourly": lambda: velocity_hourly(stg),
        "gold_video_lifecycle": lambda: video_lifecycle(stg, cats),
    }
    return {name: makers[name]() for name in names}
