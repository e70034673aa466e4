"""Queries: data-quality checks, pipeline health, dashboards."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from tidemark.catalog.snapshots import daily, stg
from tidemark.operators.scalars import attach
from tidemark.plans import health, marts, quality
from tidemark.plans.silver import dedupe
from tidemark.registry import query, view
from tidemark.schemas import REGIONS, SILVER_COLUMNS, SILVER_KEY
from tidemark.session import cut
from tidemark.sources import adapters, store
from tidemark.sources.tables import Tables

view("clock", "SELECT max(ts) + INTERVAL 3 HOUR AS as_of FROM events")


def with_as_of(t: Tables, df: DataFrame) -> DataFrame:
    """The evaluation time is three hours after the newest event, as a one-row join."""
    return df.transform(attach, t.events.agg((F.max("ts") + F.expr("INTERVAL 3 HOURS")).alias("as_of")))


def _models(t: Tables, *names: str) -> dict[str, DataFrame]:
    return marts.build(adapters.silver(t), adapters.categories(t), names or tuple(marts.LAYERS))


def _report(checks: list[quality.Check]) -> DataFrame:
    rows = [c.offending.agg(F.count(F.lit(1)).alias("offending_rows")).select(
        F.lit(c.name).alias("check_name"), F.lit(c.severity).alias("severity"), "offending_rows")
        for c in checks]
    return reduce(DataFrame.unionByName, rows)


_NULLS = " UNION ALL ".join(
    f"SELECT '{m}' AS model, '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS null_rows FROM {src}"
    for m, src in [("stg_video_snapshots", "stg"), ("stg_categories", "categories"),
                   ("gold_trending_daily", "gold_trending"), ("gold_video_velocity_hourly", "velocity"),
                   ("gold_video_lifecycle", "lifecycle")] for c in quality.NOT_NULL[m])


@query("dq_not_null", _NULLS)
def dq_not_null(t: Tables):
    models = _models(t, *quality.NOT_NULL)
    return reduce(DataFrame.unionByName, [
        quality.null_counts(m, models[m], cols) for m, cols in quality.NOT_NULL.items()])


@query("dq_accepted_values", """
  SELECT 'accepted_values:region' AS check_name, 'error' AS severity,
         count(*) FILTER (region NOT IN ('TW','JP','KR','HK','US','GB','SG','AU')) AS offending_rows FROM stg""")
def dq_accepted_values(t: Tables):
    return _report([quality.Check("accepted_values:region", quality.accepted_values(stg(t), "region", REGIONS))])


@query("dq_relationships", """
  SELECT category_id, count(*) AS orphan_rows FROM gold_category
  WHERE category_id IS NOT NULL AND category_id NOT IN (SELECT category_id FROM categories) GROUP BY 1""")
def dq_relationships(t: Tables):
    cats = adapters.categories(t)
    return (quality.missing_parents(marts.category_daily(daily(t), cats), "category_id", cats)
            .groupBy("category_id").agg(F.count(F.lit(1)).alias("orphan_rows")))


@query("dq_unique_snapshots", """
  SELECT video_id, region, captured_at, count(*) AS rows_in_grain FROM snap_raw
  GROUP BY ALL HAVING count(*) > 1""")
def dq_unique_snapshots(t: Tables):
    return quality.duplicates(adapters.raw_snapshots(t), SILVER_KEY)


def _unique(name: str, source: str):
    keys = ", ".join(quality.GRAINS[name])

    @query(f"dq_unique_{source}", f"""
      SELECT 'unique:{name}' AS check_name, 'error' AS severity, count(*) AS offending_rows
      FROM (SELECT {keys} FROM {source} GROUP BY ALL HAVING count(*) > 1)""")
    def check(t: Tables):
        return _report([quality.Check(f"unique:{name}", quality.duplicates(_models(t, name)[name], quality.GRAINS[name]))])


for _name, _source in [("gold_trending_daily", "gold_trending"), ("gold_video_lifecycle", "lifecycle"),
                       ("gold_video_velocity_hourly", "velocity")]:
    _unique(_name, _source)


@query("dq_non_negative", """
  SELECT 'non_negative:counts' AS check_name, 'error' AS severity,
         count(*) FILTER (views < 0 OR likes < 0 OR comment_count < 0) AS offending_rows FROM stg""")
def dq_non_negative(t: Tables):
    return _report([quality.Check("non_negative:counts", quality.negative_counts(stg(t)))])


@query("dq_velocity_hours", """
  SELECT 'positive:hours_since_prev' AS check_name, 'error' AS severity,
         count(*) FILTER (hours_since_prev <= 0) AS offending_rows FROM velocity""")
def dq_velocity_hours(t: Tables):
    return _report([quality.Check("positive:hours_since_prev",
                                  marts.velocity_unranked(stg(t)).where("hours_since_prev <= 0"))])


@query("dq_negative_delta", """
  SELECT video_id, region, captured_at, delta_views FROM velocity WHERE delta_views < 0""")
def dq_negative_delta(t: Tables):
    """Snapshots whose counter went down: the same probe with rows to show."""
    return marts.velocity_unranked(stg(t)).where("delta_views < 0").select(
        "video_id", "region", "captured_at", "delta_views")


@query("dq_freshness_guard", """
  SELECT max(ingested_at) AS last_loaded_at FROM silver, clock
  GROUP BY as_of HAVING as_of - max(ingested_at) > INTERVAL 2 HOUR""")
def dq_freshness_guard(t: Tables):
    last = with_as_of(t, adapters.silver(t)).groupBy("as_of").agg(F.max("ingested_at").alias("last_loaded_at"))
    return last.where("as_of - INTERVAL 2 HOURS > last_loaded_at").select("last_loaded_at")


@query("dq_source_freshness", """
  SELECT 'video_snapshots' AS source, last_loaded_at, age AS age_seconds,
         CASE WHEN age > 4 * 3600 THEN 'error' WHEN age > 2 * 3600 THEN 'warn' ELSE 'pass' END AS status
  FROM (SELECT max(ingested_at) AS last_loaded_at, (epoch_us(any_value(as_of)) - epoch_us(max(ingested_at))) / 1e6 AS age
        FROM silver, clock)
  UNION ALL
  SELECT 'youtube_categories', last_loaded_at, age,
         CASE WHEN age > 50 * 3600 THEN 'error' WHEN age > 26 * 3600 THEN 'warn' ELSE 'pass' END
  FROM (SELECT max(updated_at) AS last_loaded_at, (epoch_us(any_value(as_of)) - epoch_us(max(updated_at))) / 1e6 AS age
        FROM categories, clock)""")
def dq_source_freshness(t: Tables):
    tables = {"video_snapshots": adapters.silver(t), "youtube_categories": adapters.categories(t)}
    parts = []
    for name, df in tables.items():
        src = quality.SOURCES[name]
        newest = with_as_of(t, df.agg(F.max(src.loaded_at).alias(src.loaded_at)))
        parts.append(newest.groupBy("as_of").agg(F.max(src.loaded_at).alias(src.loaded_at)).select(
            F.lit(name).alias("source"), F.col(src.loaded_at).alias("last_loaded_at"),
            health.seconds_between(F.col("as_of"), F.col(src.loaded_at)).alias("age_seconds"))
            .withColumn("status", F.when(F.col("age_seconds") > src.error_hours * 3600, "error")
                        .when(F.col("age_seconds") > src.warn_hours * 3600, "warn").otherwise("pass")))
    return reduce(DataFrame.unionByName, parts)


@query("dq_gate")
def dq_gate(t: Tables):
    """The whole gate: every check's result, then raise or pass with the names of warnings."""
    checks = quality.standard_checks({k: cut(v) for k, v in _models(t).items()})
    warned = quality.gate(checks)
    return _report(checks).withColumn("warned", F.col("check_name").isin(*warned) if warned else F.lit(False))


# --- health ------------------------------------------------------------------------------

@query("metric_freshness", """
  SELECT (epoch_us(any_value(as_of)) - epoch_us(max(ingested_at))) / 1e6 AS seconds FROM silver, clock""")
def metric_freshness(t: Tables):
    newest = with_as_of(t, adapters.silver(t).agg(F.max("ingested_at").alias("last")))
    return newest.select(health.seconds_between(F.col("as_of"), F.col("last")).alias("seconds"))


@query("metric_rows_24h", """
  SELECT region, count(*) AS rows_24h FROM silver, clock
  WHERE captured_at > as_of - INTERVAL 24 HOUR GROUP BY region""")
def metric_rows_24h(t: Tables):
    return health.rows_last_24h(with_as_of(t, adapters.silver(t)), F.col("as_of"))


@query("metric_mart_rows", " UNION ALL ".join(
    f"SELECT '{m}' AS mart, count(*) AS rows FROM {v}" for m, v in [
        ("video_snapshots", "silver"), ("gold_trending_daily", "gold_trending"),
        ("gold_channel_performance", "gold_channel"), ("gold_category_daily", "gold_category"),
        ("gold_video_velocity_hourly", "velocity"), ("gold_video_lifecycle", "lifecycle")]))
def metric_mart_rows(t: Tables):
    models = _models(t, *[m for m in marts.LAYERS if m.startswith("gold_")])
    return health.row_counts({"video_snapshots": adapters.silver(t),
                              **models})


@query("alert_staleness", """
  SELECT video_id, region, seconds,
         CASE WHEN seconds > 22200 THEN 'critical' WHEN seconds > 11400 THEN 'warning' END AS alert
  FROM (SELECT video_id, region, (epoch_us(as_of) - epoch_us(max(ingested_at))) / 1e6 AS seconds
        FROM silver, clock GROUP BY video_id, region, as_of)""")
def alert_staleness(t: Tables):
    rows = with_as_of(t, adapters.silver(t))
    aged = health.age(rows, "ingested_at", F.max("as_of"), ["video_id", "region"])
    return aged.withColumn("alert", health.staleness_alert(F.col("seconds")))


@query("alert_failures", """
  WITH bins AS (SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS tick, count(*) FILTER (event_type = 'error') AS n
                FROM events GROUP BY 1),
  cal AS (SELECT unnest(generate_series(min(tick), max(tick), INTERVAL 5 MINUTE)) AS tick FROM bins)
  SELECT tick, failures_1h::bigint AS failures_1h FROM (
    SELECT tick, sum(coalesce(n, 0)) OVER (ORDER BY tick ROWS BETWEEN 11 PRECEDING AND CURRENT ROW) AS failures_1h
    FROM cal LEFT JOIN bins USING (tick)) WHERE failures_1h > 0""")
def alert_failures(t: Tables):
    return health.failures_in_last_hour(t.events, F.col("event_type") == "error")


@query("idempotence_check", """
  SELECT (SELECT count(*) FROM silver) AS silver_before, (SELECT count(*) FROM silver) AS silver_after,
         (SELECT count(*) FROM gold_trending) AS daily_before, (SELECT count(*) FROM gold_trending) AS daily_after""")
def idempotence_check(t: Tables):
    """Load everything twice through the keyed upsert; neither table may grow."""
    table, rows = store.daily_snapshot_table(t.spark, "idempotence"), adapters.silver(t)
    counts = []
    for when in ("before", "after"):
        table.merge(rows, SILVER_KEY)
        stored = table.read()
        models = marts.trending_daily(marts.latest_per_day(marts.stg_video_snapshots(stored)))
        # counted now: the next load replaces the files behind this table
        counts += [cut(stored.agg(F.count(F.lit(1)).alias(f"silver_{when}"))),
                   cut(models.agg(F.count(F.lit(1)).alias(f"daily_{when}")))]
    return attach(*counts)


@query("rate_5m", """
  SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS window_start,
         round((count(*) / 300.0::double)::decimal(38,12), 6)::double AS rate_per_second
  FROM events WHERE event_type NOT IN ('signup') GROUP BY 1""")
def rate_5m(t: Tables):
    return health.request_rate(t.events, F.col("event_type").isin("signup"))


def _p95_sql() -> str:
    bounds = health.LATENCY_BOUNDS
    les = ", ".join(f"count(*) FILTER (value <= {b})::double AS le{i}" for i, b in enumerate(bounds))
    cases = " ".join(
        f"WHEN le{i} >= rank THEN {([0.0] + bounds)[i]}::double + {bounds[i] - ([0.0] + bounds)[i]}::double * "
        f"(rank - {f'le{i - 1}' if i else '0'}) / (le{i} - {f'le{i - 1}' if i else '0'})"
        for i in range(len(bounds)))
    return f"""SELECT window_start, round((CASE {cases} ELSE {bounds[-1]}::double END)::decimal(38,12), 6)::double AS p95
      FROM (SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS window_start, 0.95::double * count(*) AS rank, {les}
            FROM events GROUP BY 1)"""


@query("p95_5m", _p95_sql())
def p95_5m(t: Tables):
    return health.histogram_quantile(t.events, "value", 0.95)


@query("error_ratio_5m", """
  SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS window_start,
         round((count(*) FILTER (event_type = 'error') / count(*)::double)::decimal(38,12), 6)::double AS error_ratio
  FROM events GROUP BY 1""")
def error_ratio_5m(t: Tables):
    return health.error_ratio(t.events, F.col("event_type") == "error")


@query("heartbeat_gaps", """
  SELECT event_type, ts AS silent_from, nxt AS silent_until, (epoch_us(nxt) - epoch_us(ts)) / 1e6 AS silent_seconds
  FROM (SELECT event_type, ts, lead(ts) OVER (PARTITION BY event_type ORDER BY ts) AS nxt FROM events)
  WHERE nxt - ts > INTERVAL 5 MINUTE""")
def heartbeat_gaps(t: Tables):
    return health.heartbeat_gaps(t.events, "event_type")


# --- dashboards --------------------------------------------------------------------------

@query("dash_top_velocity", """
  SELECT video_id, title, channel_title, region, captured_at, views, delta_views_per_hour FROM velocity
  ORDER BY delta_views_per_hour DESC NULLS LAST, video_id, region, captured_at LIMIT 20""")
def dash_top_velocity(t: Tables):
    cols = ["video_id", "title", "channel_title", "region", "captured_at", "views", "delta_views_per_hour"]
    rows = marts.velocity_unranked(stg(t))
    return rows.select(*cols).orderBy(F.col("delta_views_per_hour").desc_nulls_last(),
                                      "video_id", "region", "captured_at").limit(20)


@query("dash_channel_ranking", """
  SELECT channel_title, region, videos_trended, total_views, days_on_chart, rank_in_region
  FROM gold_channel WHERE rank_in_region <= 10""")
def dash_channel_ranking(t: Tables):
    return (marts.channel_performance(stg(t)).where("rank_in_region <= 10")
            .select("channel_title", "region", "videos_trended", "total_views", "days_on_chart", "rank_in_region")
            .orderBy("region", "rank_in_region", "channel_title"))


@query("dash_category_share", """
  SELECT trending_date::varchar AS time, category_name AS metric,
         round(avg(view_share_pct)::decimal(38,12), 6)::double AS value FROM gold_category GROUP BY 1, 2""")
def dash_category_share(t: Tables):
    mart = marts.category_daily(daily(t), adapters.categories(t))
    return (mart.groupBy(F.col("trending_date").alias("time"), F.col("category_name").alias("metric"))
            .agg(F.round(F.avg(F.col("view_share_pct").cast("decimal(20,8)")).cast("decimal(38,12)"), 6).alias("value"))
            .orderBy("time"))


@query("dash_daily_overview", """
  SELECT sum(total_views)::bigint AS total_views, sum(total_videos)::bigint AS total_videos FROM gold_trending
  WHERE trending_date = (SELECT max(trending_date) FROM gold_trending)""")
def dash_daily_overview(t: Tables):
    """Only the newest day is deduped and rolled up: the day filter reaches the scan."""
    newest = t.events.agg(F.max("ts").alias("ts")).select(  # one row, from the files' statistics where they have them
        *[F.date_format(F.date_add(F.to_date("ts"), n), "yyyy-MM-dd 00:00:00") for n in (0, 1)]).first()
    day = t.within("events", "ts", *newest) if newest[0] else t
    last_day = marts.stg_video_snapshots(dedupe(adapters.raw_snapshots(day).select(*SILVER_COLUMNS)))
    return marts.trending_daily(marts.latest_per_day(last_day)).agg(
        F.sum("total_views").alias("total_views"), F.sum("total_videos").alias("total_videos"))
