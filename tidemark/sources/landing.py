"""Raw landing documents: JSON envelopes in folders named by region, date and hour."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.schemas import CATEGORY_ENVELOPE, ENVELOPE, SOURCE_NAME

# The layout of keys and of the envelope's times
HOURLY, DAILY = "%s/region=%s/date=%s/hour=%s/%s", "%s/region=%s/date=%s/%s"
LOGICAL, STAMP, INGESTED = "yyyy-MM-dd'T'HH:mm:ssxxx", "yyyyMMddHH", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx"


def hour_list(date: str | None = None, hour: str | None = None,
              start_hour: str | None = None, end_hour: str | None = None) -> list[datetime]:
    """The UTC hours a job is asked for, by a day and an hour or by the first and the last one."""
    bounds = (start_hour, end_hour) if date is None or hour is None else (f"{date}T{hour}",) * 2
    hours = pd.date_range(*[pd.to_datetime(b, format="%Y-%m-%dT%H", utc=True) for b in bounds], freq="h")
    if hours.empty:
        raise ValueError(f"no hour from {bounds[0]} to {bounds[1]}")
    return [h.to_pydatetime() for h in hours]


def landing_paths(root: str, hours: Sequence[datetime]) -> list[str]:
    """One pattern an hour, over all regions, so that no other hour is listed."""
    folders = pd.DatetimeIndex(hours).strftime("date=%Y-%m-%d/hour=%H")
    return [f"{root}/region=*/{folder}/*.json" for folder in folders]


def landing_key(prefix: Column, region: Column, hour: Column, filename: str, with_hour: bool = True) -> Column:
    """Where a document lands. Nothing but its region and logical hour matter, so a rerun replaces it."""
    day, clock, name = F.to_date(hour).cast("string"), F.lpad(F.hour(hour).cast("string"), 2, "0"), F.lit(filename)
    return F.format_string(HOURLY, prefix, region, day, clock, name) if with_hour else F.format_string(DAILY, prefix, region, day, name)


def metadata(region: Column, logical_hour: Column, ingested_at: Column) -> Column:
    """The envelope's head."""
    ident = F.format_string("%s_%s", region, F.date_format(logical_hour, STAMP))
    fields = {"region": region, "logical_hour": F.date_format(logical_hour, LOGICAL), "ingestion_id": ident,
              "ingested_at": F.date_format(ingested_at, INGESTED), "source": F.lit(SOURCE_NAME)}
    return F.struct(*[value.alias(name) for name, value in fields.items()])


def write_documents(df: DataFrame, path: str, partitions: Sequence[str] = ("region", "date", "hour")) -> None:
    """Write a ``value`` column of JSON documents; partitions in the batch are replaced whole."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partitions).text(path))


def read_documents(spark: SparkSession, paths: str | Sequence[str], base: str | None = None,
                   whole_file: bool = True, schema=ENVELOPE) -> DataFrame:
    """Parse documents with the explicit schema. A path without any file raises."""
    reader = spark.read.schema(schema).option("multiLine", str(whole_file).lower())
    if base:
        reader = reader.option("basePath", base)
    return reader.json(list(paths) if not isinstance(paths, str) else paths)


def category_rows(envelopes: DataFrame, updated_at: Column) -> DataFrame:
    """Category documents to (category_id, region, category_name, updated_at)."""
    return envelopes.select(
        F.col("_metadata.region").alias("region"), F.explode("response.items").alias("item"),
        updated_at.alias("updated_at"),
    ).select(F.col("item.id").alias("category_id"), "region",
             F.col("item.snippet.title").alias("category_name"), "updated_at")


__all__ = ["CATEGORY_ENVELOPE", "ENVELOPE", "category_rows", "hour_list", "landing_key",
           "landing_paths", "metadata", "read_documents", "write_documents"]
