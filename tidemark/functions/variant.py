"""Values of unknown shape as VARIANT: parsed once, read by path and type; what doesn't fit is NULL."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession, functions as F

# The first entry named ``wanted`` of [{"key": ..., "string_value": ..., "int_value": ...}, ...]
LOOKUP = """
  CREATE OR REPLACE TEMPORARY FUNCTION {name}(params VARIANT, wanted STRING) RETURNS VARIANT
  RETURN get(filter(try_cast(params AS ARRAY<VARIANT>), p -> try_variant_get(p, '$.key', 'string') = wanted), 0)"""


def register(spark: SparkSession, name: str = "event_param") -> None:
    """The lookup as a SQL function: ``event_param(params, 'key')``."""
    spark.sql(LOOKUP.format(name=name))


def variant(text: Column) -> Column:
    """JSON text as VARIANT; NULL if it is none."""
    return F.try_parse_json(text)


def at(value: Column, path: str, kind: str) -> Column:
    """What lies at a path such as ``$.a[0].b``, as ``kind``; NULL if there is nothing or it can't be one."""
    return F.try_variant_get(value, path, kind)


def entry(params: Column, key: str, kind: str) -> Column:
    """The first parameter named ``key``; ``kind`` is string_value, int_value or double_value."""
    types = {"string_value": "string", "int_value": "long", "double_value": "double"}
    named = F.filter(params.try_cast("array<variant>"), lambda p: F.try_variant_get(p, "$.key", "string") == key)
    return F.try_variant_get(F.get(named, F.lit(0)), f"$.{kind}", types[kind])
