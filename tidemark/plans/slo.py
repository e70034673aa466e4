"""Service levels, burn rates, log patterns, incidents: small tables from event counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.functions import text as tx
from tidemark.functions.numeric import exact_round
from tidemark.operators.ordering import first_per
from tidemark.plans.health import ticks

# Windows in five-minute ticks, burn limits (long, short, factor), limit between two episodes.
WINDOWS = {"5m": 1, "30m": 6, "1h": 12, "6h": 72, "30d": 8640}
FAST, SLOW = ("1h", "5m", 14.4), ("6h", "30m", 3.0)
QUIET_MINUTES, TOP_PATTERNS = 60, 5


def service_levels(events: DataFrame, good: Column, target: float = 0.99) -> DataFrame:
    """Good share over five trailing windows at every tick, and the error budget left over thirty days.

    Events become one row per five minutes before any window; the windows run over that calendar.
    """
    per_tick = ticks(events, "ts", 5, good=F.count_if(good), total=F.count(F.lit(1)))
    out = per_tick
    for name, n in WINDOWS.items():
        w = Window.orderBy("tick").rowsBetween(-(n - 1), 0)
        out = out.withColumn(f"sli_{name}", F.sum("good").over(w) / F.nullif(F.sum("total").over(w).cast("double"), F.lit(0.0)))
    return out.withColumn("budget_left", 1 - (1 - F.col("sli_30d")) / F.lit(1 - target))


def burn_alerts(levels: DataFrame, target: float = 0.99) -> DataFrame:
    burn = lambda window: (1 - F.col(f"sli_{window}")) / F.lit(1 - target)
    both = lambda rule: F.coalesce((burn(rule[0]) > rule[2]) & (burn(rule[1]) > rule[2]), F.lit(False))
    out = levels.select("tick", *[exact_round(burn(w), 4).alias(f"burn_{w}") for w in ("5m", "30m", "1h", "6h")],
                        both(FAST).alias("fast_burn"), both(SLOW).alias("slow_burn"))
    return out.where("fast_burn or slow_burn")


def log_patterns(lines: DataFrame, line: str = "line", top: int = TOP_PATTERNS) -> DataFrame:
    return (lines.groupBy(tx.log_pattern(F.col(line)).alias("pattern")).agg(F.count(F.lit(1)).alias("lines"))
            .orderBy(F.col("lines").desc(), "pattern").limit(top))


def metric_summary(samples: DataFrame, name: str, value: str, at: Column, since: Column) -> DataFrame:
    amount = F.col(value).cast("decimal(18,4)")
    return samples.where(at).groupBy(name).agg(
        F.max_by(value, since).alias("latest"), F.min(value).alias("min_value"), F.max(value).alias("max_value"),
        exact_round(F.sum(amount).cast("double") / F.count(value), 6).alias("avg_value"), F.count(value).alias("samples"))


def incident_episodes(alerts: DataFrame) -> DataFrame:
    """One row per (fingerprint, start); per alert name only a start an hour after the last is narrated.

    Starts are reduced to distinct times per name before the window.
    """
    episodes = first_per(alerts, ["fingerprint", "starts_at"], [F.col("ts").asc(), F.col("alert_id").asc()])
    starts = episodes.groupBy("alertname", "starts_at").agg(F.min("fingerprint").alias("_first"))
    before = F.lag("starts_at").over(Window.partitionBy("alertname").orderBy("starts_at"))
    gap = (F.unix_seconds("starts_at") - F.unix_seconds("_before")) >= QUIET_MINUTES * 60
    starts = starts.withColumn("_before", before).withColumn("_open", F.col("_before").isNull() | gap)
    return (episodes.join(starts, ["alertname", "starts_at"])
            .withColumn("narrated", F.col("_open") & (F.col("fingerprint") == F.col("_first")))
            .select("alertname", "fingerprint", "starts_at", "alert_id", "narrated"))


