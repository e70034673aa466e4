"""One-row facts beside every row."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F


def attach(df: DataFrame, *facts: DataFrame) -> DataFrame:
    """Add the columns of one-row tables to every row.

    A fact is a global aggregate (``df.agg(...)`` without groups), so it has exactly one row:
    the join is a broadcast of that row and moves none of ``df``.
    """
    return reduce(lambda out, fact: out.crossJoin(F.broadcast(fact)), facts, df)
