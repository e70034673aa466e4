"""Queries: prediction, drift, service levels, incidents."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.catalog.snapshots import stg
from tidemark.operators.scalars import attach
from tidemark.plans import prediction, slo
from tidemark.registry import query, view
from tidemark.session import cut
from tidemark.sources.tables import Tables

view("pd_first", """
  SELECT *, min(captured_at) OVER (PARTITION BY video_id, region) AS t0,
         arg_min(views, captured_at) OVER (PARTITION BY video_id, region) AS v0 FROM stg""")
view("pd_label", """
  SELECT video_id, region, t0, v0, arg_min(views, (abs((epoch_us(captured_at) - epoch_us(t0)) / 3.6e9 - 24), captured_at)) AS v24
  FROM pd_first WHERE (epoch_us(captured_at) - epoch_us(t0)) / 3.6e9 > 20 AND (epoch_us(captured_at) - epoch_us(t0)) / 3.6e9 <= 30 GROUP BY ALL""")
view("pd_features", r"""
  WITH k AS (SELECT p.*, v.delta_views_per_hour AS r FROM pd_first p LEFT JOIN velocity v USING (video_id, region, captured_at)
             WHERE (epoch_us(p.captured_at) - epoch_us(t0)) / 3.6e9 <= 3),
  a AS (SELECT video_id, region, t0, v0, arg_min(title, captured_at) AS title, first(description ORDER BY captured_at) AS description, arg_min(tags, captured_at) AS tags,
               arg_min(published_at, captured_at) AS published_at, first(category_id ORDER BY captured_at) AS category_id, arg_min(engagement_rate, captured_at) AS er, avg(r) AS rate, count(r) AS n
        FROM k GROUP BY ALL),
  l AS (SELECT *, published_at + to_hours(CASE region WHEN 'TW' THEN 8 WHEN 'JP' THEN 9 WHEN 'KR' THEN 9 WHEN 'HK' THEN 8 WHEN 'US' THEN -5 WHEN 'GB' THEN 0 WHEN 'SG' THEN 8 ELSE 11 END) AS local FROM a)
  SELECT video_id, region, t0, length(title) AS title_len_chars, len(regexp_extract_all(title, '[^ ]+')) AS title_word_count,
         len(regexp_extract_all(title, '[\x{1F300}-\x{1FAFF}\x{2600}-\x{27BF}]')) AS title_emoji_count, len(regexp_extract_all(title, '[!?！？]')) AS title_punct_count,
         coalesce(length(description), 0) AS desc_len_chars, len(string_split(tags, ',')) AS tag_count, hour(local) AS publish_hour_local,
         isodow(local) - 1 AS publish_dow, (hour(local) BETWEEN 19 AND 23)::bigint AS is_prime_time,
         round(((epoch_us(t0) - epoch_us(published_at)) / 3.6e9)::decimal(38,12), 2)::double AS video_age_hours_at_entry,
         round(ln(1 + v0)::decimal(38,12), 6)::double AS log1p_first_views, round(ln(1 + greatest(coalesce(rate, 0), 0))::decimal(38,12), 6)::double AS log1p_early_velocity_3h,
         (n > 0)::bigint AS has_early_velocity, round(er::decimal(38,12), 6)::double AS early_engagement_rate, category_id FROM l""")


@query("label_doubled_24h", "SELECT *, (v24 >= 2 * v0)::bigint AS label FROM pd_label")
def label_doubled_24h(t: Tables):
    return prediction.doubled_in_24h(stg(t))


@query("features_v1", "SELECT * FROM pd_features")
def features_v1(t: Tables):
    return prediction.features(stg(t))


@query("temporal_split", """
  SELECT video_id, region, t0, CASE WHEN row_number() OVER (ORDER BY t0, video_id, region) <= floor(count(*) OVER () * 0.8) THEN 'train' ELSE 'test' END AS split
  FROM pd_label""")
def temporal_split(t: Tables):
    return prediction.temporal_split(prediction.doubled_in_24h(stg(t))).select("video_id", "region", "t0", "split")


NUMERIC = ["title_len_chars", "title_word_count", "desc_len_chars", "tag_count", "publish_hour_local", "publish_dow",
           "is_prime_time", "video_age_hours_at_entry", "log1p_first_views", "log1p_early_velocity_3h", "has_early_velocity",
           "early_engagement_rate"]


@query("video_model")
def video_model(t: Tables):
    rows = cut(stg(t))
    data = prediction.features(rows).join(prediction.doubled_in_24h(rows).select("video_id", "region", "label"), ["video_id", "region"])
    return prediction.fit_models(cut(prediction.temporal_split(data)), NUMERIC)


@query("score_incremental", """
  SELECT video_id, region, CASE WHEN t0 < timestamp '2024-01-01 06:00' THEN 0.0::double ELSE log1p_first_views END AS score FROM pd_features""")
def score_incremental(t: Tables):
    """Rows scored before keep their score of 0; the others get one."""
    rows = cut(prediction.features(stg(t)))
    done = rows.where("t0 < timestamp'2024-01-01 06:00:00'").select("video_id", "region", F.lit(0.0).alias("score"))
    return prediction.score_new(rows, done, F.col("log1p_first_views").cast("double"))


view("dr_rows", """
  SELECT ts, ts < timestamp '2024-01-16' AS ref, value, (json_extract(props, '$.k'))::double AS k, hour(ts)::double AS hour_of_day, value * (1 + day(ts) / 10.0::double) AS drifting FROM events""")


def drift_rows(t: Tables):
    return t.events.select("ts", "event_type", "value", F.get_json_object("props", "$.k").cast("double").alias("k"), F.hour("ts").cast("double").alias("hour_of_day"),
                           (F.col("value") * (1 + F.dayofmonth("ts") / F.lit(10.0))).alias("drifting"))


def reference():
    return F.col("ts") < F.lit("2024-01-16").cast("timestamp")


@query("psi", """
  WITH f AS (SELECT ref, unnest(['value', 'k', 'hour_of_day', 'drifting']) AS feature, unnest([value, k, hour_of_day, drifting]) AS x FROM dr_rows),
  e AS (SELECT feature, min(x) AS lo, max(x) AS hi FROM f WHERE ref GROUP BY 1),
  b AS (SELECT feature, ref, greatest(0, least(9, coalesce(floor((x - lo) / nullif(hi - lo, 0) * 10), 0))) AS bin FROM f JOIN e USING (feature)),
  c AS (SELECT feature, bin, count(*) FILTER (ref) AS r, count(*) FILTER (NOT ref) AS c FROM b GROUP BY 1, 2),
  s AS (SELECT feature, greatest(c / sum(c) OVER w::double, 1e-4) AS a, greatest(r / sum(r) OVER w::double, 1e-4) AS b FROM c WINDOW w AS (PARTITION BY feature))
  SELECT feature, round(sum((a - b) * ln(a / b))::decimal(38,12), 6)::double AS psi FROM s GROUP BY 1""")
def psi(t: Tables):
    return prediction.psi(drift_rows(t), ["value", "k", "hour_of_day", "drifting"], reference())


@query("ks_stat", """
  WITH c AS (SELECT drifting AS x, count(*) FILTER (ref) AS r, count(*) FILTER (NOT ref) AS c FROM dr_rows GROUP BY 1)
  SELECT round(max(abs(fr / nr - fc / nc))::decimal(38,12), 6)::double AS ks FROM (
    SELECT sum(r) OVER o::double AS fr, sum(c) OVER o::double AS fc, sum(r) OVER ()::double AS nr, sum(c) OVER ()::double AS nc FROM c WINDOW o AS (ORDER BY x))""")
def ks_stat(t: Tables):
    return prediction.ks_statistic(drift_rows(t), "drifting", reference())


view("dr_auc", """
  WITH s AS (SELECT ts::date AS d, floor(value / 5) AS s, (event_type = 'purchase')::int AS y FROM events),
  w AS (SELECT a.d AS as_of, s.s, s.y FROM (SELECT DISTINCT d FROM s) a JOIN s ON s.d BETWEEN a.d - 6 AND a.d),
  g AS (SELECT as_of, s, sum(y) AS p, sum(1 - y) AS q FROM w GROUP BY 1, 2)
  SELECT as_of, round((sum(p * (qs - q / 2.0::double)) / nullif(sum(p) * sum(q), 0)::double)::decimal(38,12), 6)::double AS auc
  FROM (SELECT *, sum(q) OVER (PARTITION BY as_of ORDER BY s) AS qs FROM g) GROUP BY 1""")


def auc_rows(t: Tables):
    rows = t.events.select(F.to_date("ts").alias("day"), F.floor(F.col("value") / 5).alias("score"),
                           (F.col("event_type") == "purchase").cast("int").alias("label"))
    return prediction.rolling_auc(rows, "day", "score", "label")


@query("rolling_auc", "SELECT as_of::varchar AS as_of, auc FROM dr_auc")
def rolling_auc(t: Tables):
    return auc_rows(t)


@query("drift_trigger", """
  WITH f AS (SELECT ref, unnest(['value', 'k', 'hour_of_day', 'drifting']) AS feature, unnest([value, k, hour_of_day, drifting]) AS x FROM dr_rows),
  e AS (SELECT feature, min(x) AS lo, max(x) AS hi FROM f WHERE ref GROUP BY 1),
  b AS (SELECT feature, ref, greatest(0, least(9, coalesce(floor((x - lo) / nullif(hi - lo, 0) * 10), 0))) AS bin FROM f JOIN e USING (feature)),
  c AS (SELECT feature, bin, count(*) FILTER (ref) AS r, count(*) FILTER (NOT ref) AS c FROM b GROUP BY 1, 2),
  s AS (SELECT feature, greatest(c / sum(c) OVER w::double, 1e-4) AS a, greatest(r / sum(r) OVER w::double, 1e-4) AS b FROM c WINDOW w AS (PARTITION BY feature)),
  m AS (SELECT count(*) FILTER (psi > 0.2) AS features_moved FROM (SELECT feature, sum((a - b) * ln(a / b)) AS psi FROM s GROUP BY 1))
  SELECT features_moved, auc, features_moved >= 2 OR coalesce(auc < 0.60, false) AS retrain FROM m, (SELECT arg_max(auc, as_of) AS auc FROM dr_auc)""")
def drift_trigger(t: Tables):
    return prediction.drift_trigger(psi(t), auc_rows(t))


view("slo_ticks", """
  WITH b AS (SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS tick, count(*) FILTER (event_type <> 'error') AS good, count(*) AS total FROM events GROUP BY 1),
  cal AS (SELECT unnest(generate_series(min(tick), max(tick), INTERVAL 5 MINUTE)) AS tick FROM b)
  SELECT tick, coalesce(good, 0) AS good, coalesce(total, 0) AS total FROM cal LEFT JOIN b USING (tick)""")
view("slo_levels", "SELECT tick, good, total, " + ", ".join(
    f"sum(good) OVER (ORDER BY tick ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW) / nullif(sum(total) OVER (ORDER BY tick ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW), 0)::double AS sli_{name}"
    for name, n in slo.WINDOWS.items()) + " FROM slo_ticks")


def levels(t: Tables):
    return slo.service_levels(t.events, F.col("event_type") != "error")


_SLI = ", ".join(f"round(sli_{w}::decimal(38,12), 6)::double AS sli_{w}" for w in slo.WINDOWS)


@query("slo_budget", f"SELECT tick, {_SLI}, round((1 - (1 - sli_30d) / (1 - 0.99::double))::decimal(38,12), 4)::double AS budget_left FROM slo_levels")
def slo_budget(t: Tables):
    from tidemark.functions.numeric import exact_round
    rounded = [exact_round(F.col(f"sli_{w}"), 6).alias(f"sli_{w}") for w in slo.WINDOWS]
    return levels(t).select("tick", *rounded, exact_round(F.col("budget_left"), 4).alias("budget_left"))


_BURN = lambda w: f"((1 - sli_{w}) / (1 - 0.99::double))"


@query("slo_burn_rate", f"""
  SELECT * FROM (SELECT tick, {', '.join(f'round({_BURN(w)}::decimal(38,12), 4)::double AS burn_{w}' for w in ('5m', '30m', '1h', '6h'))},
    coalesce({_BURN('1h')} > 14.4 AND {_BURN('5m')} > 14.4, false) AS fast_burn, coalesce({_BURN('6h')} > 3 AND {_BURN('30m')} > 3, false) AS slow_burn
  FROM slo_levels) WHERE fast_burn OR slow_burn""")
def slo_burn_rate(t: Tables):
    return slo.burn_alerts(levels(t))


_LINE = "event_type || ' failed for user ' || user_id || ' at 0x' || md5(event_id::varchar)[1:8] || ' request ' || md5(user_id::varchar) || ' after ' || (event_id % 90) || '.5 s'"


@query("log_patterns", rf"""
  SELECT regexp_replace(regexp_replace(regexp_replace(regexp_replace(line, '[0-9a-f]{{8}}-[0-9a-f]{{4}}-[0-9a-f]{{4}}-[0-9a-f]{{4}}-[0-9a-f]{{12}}', '#', 'g'), '0x[0-9a-f]+', '#', 'g'),
           '[0-9a-f]{{16,}}', '#', 'g'), '[0-9]+(\.[0-9]+)?', '#', 'g') AS pattern, count(*) AS lines
  FROM (SELECT {_LINE} AS line FROM events) GROUP BY 1 ORDER BY lines DESC, pattern LIMIT 5""")
def log_patterns(t: Tables):
    s = lambda c: F.col(c).cast("string")
    line = F.concat(F.col("event_type"), F.lit(" failed for user "), s("user_id"), F.lit(" at 0x"), F.substring(F.md5(s("event_id")), 1, 8),
                    F.lit(" request "), F.md5(s("user_id")), F.lit(" after "), (F.col("event_id") % 90).cast("string"), F.lit(".5 s"))
    return slo.log_patterns(t.events.select(line.alias("line")))


@query("metric_summary", """
  SELECT event_type, arg_max(value, (ts, event_id)) AS latest, min(value) AS min_value, max(value) AS max_value,
         round((sum(value::decimal(18,4))::double / count(value))::decimal(38,12), 6)::double AS avg_value, count(value) AS samples
  FROM events WHERE ts > (SELECT max(ts) FROM events) - INTERVAL 24 HOUR GROUP BY 1""")
def metric_summary(t: Tables):
    newest = t.events.agg(F.max("ts").alias("_now"))
    rows = t.events.transform(attach, newest)
    return slo.metric_summary(rows, "event_type", "value", F.col("ts") > F.col("_now") - F.expr("INTERVAL 24 HOURS"), F.struct("ts", "event_id"))


@query("incident_dedupe", """
  WITH a AS (SELECT event_type AS alertname, md5(event_type || '|' || (user_id % 20)) AS fingerprint, time_bucket(INTERVAL 20 MINUTE, ts) AS starts_at, event_id AS alert_id, ts FROM events),
  e AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY fingerprint, starts_at ORDER BY ts, alert_id) AS rn FROM a) WHERE rn = 1),
  s AS (SELECT *, lag(starts_at) OVER (PARTITION BY alertname ORDER BY starts_at) AS before FROM (SELECT alertname, starts_at, min(fingerprint) AS ff FROM e GROUP BY 1, 2))
  SELECT e.alertname, e.fingerprint, e.starts_at, e.alert_id, (before IS NULL OR e.starts_at - before >= INTERVAL 60 MINUTE) AND e.fingerprint = ff AS narrated
  FROM e JOIN s USING (alertname, starts_at)""")
def incident_dedupe(t: Tables):
    alerts = t.events.select(
        F.col("event_type").alias("alertname"), F.md5(F.concat_ws("|", "event_type", (F.col("user_id") % 20).cast("string"))).alias("fingerprint"),
        F.window("ts", "20 minutes")["start"].alias("starts_at"), F.col("event_id").alias("alert_id"), "ts")
    return slo.incident_episodes(alerts)
