"""The hourly and range pipelines as plain functions over one Spark session."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from tidemark.plans import marts, quality
from tidemark.schemas import SILVER_COLUMNS, SILVER_KEY
from tidemark.session import cut
from tidemark.sources.store import PartitionedTable, range_scan


def _bounds(hours: Sequence[datetime]):
    return [F.lit(h.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp") for h in (hours[0], hours[-1])]


def reprocess(silver: DataFrame, serving: PartitionedTable, hours: Sequence[datetime],
              strict: bool = False) -> DataFrame:
    """Load an hour range of Silver into the serving copy; running it twice changes nothing."""
    serving.merge(range_scan(silver, *_bounds(hours), SILVER_COLUMNS, strict=strict), SILVER_KEY)
    return serving.read()


def hourly(silver: DataFrame, categories: DataFrame, serving: PartitionedTable,
           hour: datetime, as_of: datetime) -> dict[str, DataFrame]:
    """One hour: strict load, marts, then the gate."""
    models = {name: cut(df) for name, df in marts.build(reprocess(silver, serving, [hour], strict=True), categories).items()}
    quality.gate(quality.standard_checks(models), as_of)
    return models
