"""Named queries with the SQL that states the same result."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidemark.session import configure
from tidemark.sources.tables import Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
VIEWS: dict[str, str] = {}


def plain_types(df: DataFrame) -> DataFrame:
    """Types both engines print alike: long, double, string, boolean, timestamp without zone."""
    columns = []
    for field in df.schema.fields:
        c, t = F.col(f"`{field.name}`"), field.dataType
        if isinstance(t, (T.ByteType, T.ShortType, T.IntegerType)):
            c = c.cast("long")
        elif isinstance(t, (T.DecimalType, T.FloatType)):
            c = c.cast("double")
        elif isinstance(t, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(t, T.TimestampType):
            c = c.cast("timestamp_ntz")
        columns.append(c.alias(field.name))
    return df.select(*columns)


def view(name: str, sql: str) -> None:
    """A named SQL building block that oracle texts may read."""
    VIEWS[name] = sql.strip()


def with_views(body: str) -> str:
    needed: list[str] = []
    seen: set[str] = set()

    def visit(text: str) -> None:
        for name in VIEWS:
            if name not in seen and re.search(rf"\b{name}\b", text):
                seen.add(name)
                visit(VIEWS[name])
                needed.append(name)

    visit(body)
    if not needed:
        return body.strip()
    parts = ",\n".join(f"{n} AS ({VIEWS[n]})" for n in needed)
    body = body.strip()
    if body.lower().startswith("with "):
        return f"WITH {parts},\n{body[5:]}"
    return f"WITH {parts}\n{body}"


def query(name: str, sql: str | None = None):
    def register(fn: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            configure(spark)
            return plain_types(fn(Tables(spark, sf_dir)))

        run.__name__, run.__doc__ = name, fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def oracle_texts() -> dict[str, str]:
    return {name: with_views(sql) for name, sql in ORACLES.items()}
