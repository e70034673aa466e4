"""Pipeline health as table jobs: freshness, row counts, alerts, request metrics."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.functions.numeric import exact_round

# Alert thresholds in seconds, and how long a condition must hold.
STALE_WARNING, STALE_CRITICAL, HOLD_SECONDS = 10800, 21600, 600
# Upper bounds of the latency histogram.
LATENCY_BOUNDS = [1.0, 5.0, 10.0, 25.0, 50.0, 100.0, 250.0, 500.0]


def seconds_between(later: Column, earlier: Column) -> Column:
    return (F.unix_micros(later) - F.unix_micros(earlier)) / F.lit(1e6)


def age(df: DataFrame, loaded_at: str, as_of: Column, keys: Sequence[str] = ()) -> DataFrame:
    """Seconds since the newest load per key; ``as_of`` is an aggregate or a literal."""
    return (df.groupBy(*keys).agg(F.max(loaded_at).alias("_last"), as_of.alias("_as_of"))
            .select(*keys, seconds_between(F.col("_as_of"), F.col("_last")).alias("seconds")))


def rows_last_24h(silver: DataFrame, as_of: Column) -> DataFrame:
    return (silver.where(F.col("captured_at") > as_of - F.expr("INTERVAL 24 HOURS"))
            .groupBy("region").agg(F.count(F.lit(1)).alias("rows_24h")))


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    counted = [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("mart"), "rows")
               for name, df in tables.items()]
    return reduce(DataFrame.unionByName, counted)


def staleness_alert(seconds: Column) -> Column:
    """The alert level, once its condition has held for the hold time.

    Age only grows while nothing arrives, so "held for ten minutes" is ten minutes of extra age.
    """
    return (F.when(seconds > STALE_CRITICAL + HOLD_SECONDS, "critical")
            .when(seconds > STALE_WARNING + HOLD_SECONDS, "warning"))


def ticks(df: DataFrame, ts: str, minutes: int, **counters: Column) -> DataFrame:
    """Counters per tick over the full calendar of the data, quiet ticks included."""
    step = f"{minutes} minutes"
    counted = df.groupBy(F.window(ts, step)["start"].alias("tick")).agg(
        *[c.alias(n) for n, c in counters.items()])
    span = counted.agg(F.min("tick").alias("a"), F.max("tick").alias("b"))
    calendar = span.select(F.explode(F.sequence("a", "b", F.expr(f"INTERVAL {minutes} MINUTES"))).alias("tick"))
    return calendar.join(counted, "tick", "left").na.fill(0, list(counters))


def failures_in_last_hour(events: DataFrame, failed: Column) -> DataFrame:
    """Every five-minute tick whose trailing hour holds a failure. One row per tick before the window."""
    per_tick = ticks(events, "ts", 5, failures=F.count_if(failed))
    hour = Window.orderBy("tick").rowsBetween(-11, 0)
    return (per_tick.withColumn("failures_1h", F.sum("failures").over(hour))
            .where("failures_1h > 0").select("tick", "failures_1h"))


def request_rate(events: DataFrame, excluded: Column) -> DataFrame:
    return (events.where(~excluded).groupBy(F.window("ts", "5 minutes")["start"].alias("window_start"))
            .agg(exact_round(F.count(F.lit(1)) / F.lit(300.0), 6).alias("rate_per_second")))


def histogram_quantile(events: DataFrame, value: str, q: float,
                       bounds: Sequence[float] = tuple(LATENCY_BOUNDS)) -> DataFrame:
    """A quantile per five-minute window from fixed buckets, interpolated inside the bucket.

    Only bucket counts are shuffled; a window with any number of rows is one small row.
    """
    edges = [0.0, *bounds]
    counts = [F.count_if(F.col(value) <= b).alias(f"_le{i}") for i, b in enumerate(bounds)]
    out = events.groupBy(F.window("ts", "5 minutes")["start"].alias("window_start")).agg(
        F.count(F.lit(1)).alias("_all"), *counts)
    rank = F.lit(q) * F.col("_all")
    answer = F.lit(float(bounds[-1]))
    for i in reversed(range(len(bounds))):
        upto, below = F.col(f"_le{i}"), F.col(f"_le{i - 1}") if i else F.lit(0)
        inside = F.lit(edges[i]) + F.lit(edges[i + 1] - edges[i]) * (rank - below) / (upto - below)
        answer = F.when(upto >= rank, inside).otherwise(answer)
    return out.select("window_start", exact_round(answer, 6).alias("p95"))


def error_ratio(events: DataFrame, failed: Column) -> DataFrame:
    return events.groupBy(F.window("ts", "5 minutes")["start"].alias("window_start")).agg(
        exact_round(F.count_if(failed) / F.count(F.lit(1)), 6).alias("error_ratio"))


def heartbeat_gaps(events: DataFrame, source: str, minutes: int = 5) -> DataFrame:
    """Silences longer than ``minutes`` per source.

    A silence longer than the bin width always spans a bin edge, so it is enough to compare
    the last beat of one bin with the first beat of the next non-empty bin.
    """
    bins = events.groupBy(source, F.window("ts", f"{minutes} minutes")["start"].alias("_bin")).agg(
        F.min("ts").alias("_first"), F.max("ts").alias("silent_from"))
    w = Window.partitionBy(source).orderBy("_bin")
    gaps = bins.withColumn("silent_until", F.lead("_first").over(w))
    length = seconds_between(F.col("silent_until"), F.col("silent_from"))
    return gaps.where(length > minutes * 60).select(
        source, "silent_from", "silent_until", length.alias("silent_seconds"))
