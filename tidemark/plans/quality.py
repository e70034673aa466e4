"""Data-quality checks. A check returns the offending rows; no rows means it passed."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.schemas import REGIONS


@dataclass(frozen=True)
class Check:
    name: str
    offending: DataFrame
    severity: str = "error"


@dataclass(frozen=True)
class Source:
    """A loaded table with the column that says when, and its freshness limits in hours."""
    name: str
    loaded_at: str
    warn_hours: int
    error_hours: int


SOURCES = {
    "video_snapshots": Source("video_snapshots", "ingested_at", 2, 4),
    "youtube_categories": Source("youtube_categories", "updated_at", 26, 50),
}

NOT_NULL = {
    "stg_video_snapshots": ["video_id", "region", "captured_at", "views"],
    "stg_categories": ["category_id", "region"],
    "gold_trending_daily": ["region", "trending_date", "total_views"],
    "gold_video_velocity_hourly": ["video_id", "captured_at", "delta_views"],
    "gold_video_lifecycle": ["video_id", "first_seen_at"],
}

GRAINS = {
    "gold_trending_daily": ["region", "trending_date"],
    "gold_video_lifecycle": ["video_id", "region"],
    "gold_video_velocity_hourly": ["video_id", "region", "captured_at"],
}


class GateFailed(AssertionError):
    def __init__(self, failures: Sequence[str]) -> None:
        super().__init__("failed checks: " + ", ".join(failures))
        self.failures = list(failures)


def null_counts(model: str, df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Null counters of all asked columns in one pass, one row per column."""
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    pairs = ", ".join(f"'{c}', `{c}`" for c in columns)
    return (counted.select(F.expr(f"stack({len(columns)}, {pairs}) AS (column_name, null_rows)"))
            .select(F.lit(model).alias("model"), "column_name", "null_rows"))


def not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.where(reduce(Column.__or__, [F.col(c).isNull() for c in columns]))


def accepted_values(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """Values outside the list; NULL passes."""
    return df.where(~F.col(column).isin(*values))


def missing_parents(df: DataFrame, column: str, parent: DataFrame, parent_column: str | None = None) -> DataFrame:
    keys = parent.select(F.col(parent_column or column).alias(column)).distinct()
    return df.where(F.col(column).isNotNull()).join(keys, column, "left_anti")


def duplicates(df: DataFrame, grain: Sequence[str]) -> DataFrame:
    return df.groupBy(*grain).agg(F.count(F.lit(1)).alias("rows_in_grain")).where("rows_in_grain > 1")


def negative_counts(df: DataFrame, columns: Sequence[str] = ("views", "likes", "comment_count")) -> DataFrame:
    return df.where(reduce(Column.__or__, [F.col(c) < 0 for c in columns]))


def stale(df: DataFrame, loaded_at: str, as_of: Column, hours: int) -> DataFrame:
    """One row when the newest load is older than ``hours``."""
    return (df.agg(F.max(loaded_at).alias("last_loaded_at"))
            .where(as_of - F.expr(f"INTERVAL {hours} HOURS") > F.col("last_loaded_at")))


def freshness(df: DataFrame, source: Source, as_of: Column) -> DataFrame:
    seconds = ((F.unix_micros(as_of) - F.unix_micros(F.col("last_loaded_at"))) / F.lit(1e6))
    return df.agg(F.max(source.loaded_at).alias("last_loaded_at")).select(
        F.lit(source.name).alias("source"), "last_loaded_at", seconds.alias("age_seconds"),
        F.when(seconds > source.error_hours * 3600, "error")
        .when(seconds > source.warn_hours * 3600, "warn").otherwise("pass").alias("status"))


def standard_checks(models: dict[str, DataFrame]) -> list[Check]:
    """The checks every hourly run must pass; the category reference only warns."""
    checks = [Check(f"not_null:{m}", not_null(models[m], cols)) for m, cols in NOT_NULL.items()]
    checks += [Check(f"unique:{m}", duplicates(models[m], grain)) for m, grain in GRAINS.items()]
    checks += [
        Check("accepted_values:region", accepted_values(models["stg_video_snapshots"], "region", REGIONS)),
        Check("non_negative:counts", negative_counts(models["stg_video_snapshots"])),
        Check("positive:hours_since_prev", models["gold_video_velocity_hourly"].where("hours_since_prev <= 0")),
        Check("relationships:category_id",
              missing_parents(models["gold_category_daily"], "category_id", models["stg_categories"]), "warn"),
    ]
    return checks


def gate(checks: Sequence[Check], as_of: datetime | None = None, fresh: DataFrame | None = None) -> list[str]:
    """Raise on any failed error-level check; return the names of failed warnings."""
    failed = [c for c in checks if not c.offending.isEmpty()]
    errors = [c.name for c in failed if c.severity == "error"]
    if fresh is not None:
        errors += [f"freshness:{r['source']}" for r in fresh.where("status = 'error'").select("source").collect()]
    if errors:
        raise GateFailed(errors)
    return [c.name for c in failed]
