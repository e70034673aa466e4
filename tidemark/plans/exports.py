"""Capped datasets for presentation, each in one envelope file.

Every dataset is bounded by what it is: a number of days, or a rank per group. The caps are the
feature; a dataset that is larger than its limit fails validation instead of being cut.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.operators.ordering import top_n
from tidemark.session import cut

# Windows in days, ranks kept, series length, size limits, oldest data that may be exported.
TREND_DAYS, CATEGORY_DAYS, BOARD_DAYS = 90, 60, 90
TOP_CHANNELS, TOP_VIDEOS, TOP_SERIES, SERIES_POINTS = 50, 100, 10, 72
MAX_FILE, MAX_TOTAL, MAX_AGE_HOURS = 3 * 1024 * 1024, 15 * 1024 * 1024, 26


def last_days(df: DataFrame, column: str, days: int) -> DataFrame:
    """Rows of the newest ``days`` days, counted back from the newest date of the data."""
    newest = df.agg(F.max(column).alias("_newest"))
    return df.join(F.broadcast(newest), F.col(column) > F.date_sub("_newest", days)).drop("_newest")


def trending_daily(mart: DataFrame) -> DataFrame:
    return last_days(mart, "trending_date", TREND_DAYS)


def category_daily(mart: DataFrame) -> DataFrame:
    return last_days(mart, "trending_date", CATEGORY_DAYS)


def board_daily(mart: DataFrame) -> DataFrame:
    return last_days(mart, "post_date", BOARD_DAYS)


def channels(mart: DataFrame) -> DataFrame:
    return mart.where(F.col("rank_in_region") <= TOP_CHANNELS)


def videos(lifecycle: DataFrame, predictions: DataFrame) -> DataFrame:
    """The most-viewed videos of each region with their prediction where there is one."""
    top = top_n(lifecycle, ["region"], [F.col("latest_views").desc(), F.col("video_id").asc()], TOP_VIDEOS, "_rank").drop("_rank")
    return top.join(predictions, ["video_id", "region"], "left")


def velocity_series(lifecycle: DataFrame, velocity: DataFrame) -> DataFrame:
    """The steepest videos of each region with their first points, nested in time order."""
    top = top_n(lifecycle, ["region"], [F.col("peak_delta_views_per_hour").desc_nulls_last(), F.col("video_id").asc()],
                TOP_SERIES, "_rank").select("video_id", "region")
    points = top_n(velocity.join(top, ["video_id", "region"]), ["video_id", "region"], [F.col("captured_at").asc()], SERIES_POINTS, "_point")
    return points.groupBy("region", "video_id").agg(
        F.max("title").alias("title"), F.max("channel_title").alias("channel_title"),
        F.sort_array(F.collect_list(F.struct("captured_at", "views", "delta_views_per_hour", "velocity_rank"))).alias("series"))  # at most SERIES_POINTS


def sentiment_videos(sentiment: DataFrame, lifecycle: DataFrame) -> DataFrame:
    rows = sentiment.join(lifecycle.select("video_id", "region", "title", "channel_title"), "video_id")
    return top_n(rows, ["region"], [F.col("scored_comments").desc(), F.col("video_id").asc()], TOP_VIDEOS, "_rank").drop("_rank")


def sentiment_daily(scored: DataFrame, lifecycle: DataFrame) -> DataFrame:
    """Label counts per region and day of scoring; single comments never leave the platform."""
    per_video = scored.groupBy("video_id", F.to_date("scored_at").alias("date"), "label").agg(F.count(F.lit(1)).alias("n"))
    rows = per_video.join(lifecycle.select("video_id", "region").distinct(), "video_id")
    return rows.groupBy("region", "date").pivot("label", ["positive", "neutral", "negative"]).agg(F.sum("n")).na.fill(0)


# --- envelopes --------------------------------------------------------------------------

@dataclass(frozen=True)
class Dataset:
    name: str
    source_tables: tuple[str, ...]
    rows: DataFrame | None  # None: the table it needs does not exist (yet)


class ExportTooLarge(ValueError):
    pass


class StaleSource(ValueError):
    pass


def require_fresh(df: DataFrame, loaded_at: str, as_of: datetime, hours: int = MAX_AGE_HOURS) -> None:
    newest = df.agg(F.max(loaded_at).alias("m")).first()["m"]
    if newest is None or (as_of - newest).total_seconds() > hours * 3600:
        raise StaleSource(f"newest {loaded_at} is {newest}")


def table_or_absent(spark: SparkSession, name: str) -> DataFrame | None:
    return spark.table(name) if spark.catalog.tableExists(name) else None


def write_envelope(spark: SparkSession, data: Dataset, folder: str, generated_at: str) -> None:
    """One JSON document: what it is, where from, its state, and its rows."""
    if data.rows is None:
        body = spark.range(1).select(F.lit(0).cast("long").alias("row_count"), F.lit("[]").alias("rows"))
        status = "absent"
    else:
        rows = cut(data.rows.select(F.to_json(F.struct(*data.rows.columns)).alias("row")))
        size = rows.agg(F.sum(F.octet_length("row") + 1)).first()[0] or 0
        if size > MAX_FILE:  # before anything is packed into one row
            raise ExportTooLarge(f"{data.name} has {size} bytes of rows")
        ordered = F.array_sort(F.collect_list("row"))
        body = rows.agg(F.count(F.lit(1)).alias("row_count"), F.concat(F.lit("["), F.array_join(ordered, ","), F.lit("]")).alias("rows"))
        status = "ok"
    head = F.to_json(F.struct(F.lit(data.name).alias("dataset"), F.lit(generated_at).alias("generated_at"),
                              F.array(*[F.lit(s) for s in data.source_tables]).alias("source_tables"),
                              F.lit(status).alias("status"), "row_count"))
    text = F.concat(F.expr("substring({0}, 1, length({0}) - 1)".format("_head")), F.lit(',"rows":'), F.col("rows"), F.lit("}"))
    body.withColumn("_head", head).select(text.alias("value")).coalesce(1).write.mode("overwrite").text(f"{folder}/{data.name}")


def write_all(spark: SparkSession, datasets: Sequence[Dataset], folder: str, generated_at: str) -> DataFrame:
    for data in datasets:
        write_envelope(spark, data, folder, generated_at)
    return read_back(spark, folder)


def read_back(spark: SparkSession, folder: str) -> DataFrame:
    """The written files as they are: dataset, status, row count, rows found and bytes."""
    head = "dataset string, generated_at string, source_tables array<string>, status string, row_count long, rows array<string>"
    files = spark.read.text(f"{folder}/*", wholetext=True).where(F.length("value") > 0)
    parsed = files.select(F.from_json("value", head).alias("e"), F.octet_length("value").alias("bytes"))
    return parsed.select("e.dataset", "e.status", "e.row_count", F.size("e.rows").alias("rows_found"), "bytes")


def validate(found: DataFrame, expected: Mapping[str, Dataset] | Sequence[str]) -> list[str]:
    """What is wrong with an export; nothing means it may be published."""
    rows = {r["dataset"]: r for r in found.collect()}  # one row per dataset
    wrong = [f"missing:{name}" for name in expected if name not in rows]
    for name, r in rows.items():
        if r["status"] != "absent" and not r["row_count"]:
            wrong.append(f"empty:{name}")
        if r["row_count"] != r["rows_found"]:
            wrong.append(f"row_count:{name}")
        if r["bytes"] > MAX_FILE:
            wrong.append(f"too_large:{name}")
    if sum(r["bytes"] for r in rows.values()) > MAX_TOTAL:
        wrong.append("total_too_large")
    return sorted(wrong)
