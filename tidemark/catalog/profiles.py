"""Queries: audience profiles, selection, clusters."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.catalog.commerce import ga
from tidemark.plans import audience, clusters, commerce, profiles
from tidemark.registry import query, view
from tidemark.session import cut, scratch_path
from tidemark.sources import store
from tidemark.sources.tables import Tables

_CASES = lambda rules: "CASE " + " ".join(f"WHEN {r} THEN '{n}'" for n, r in rules) + " END"

view("pf_scores", f"""
  SELECT *, {_CASES(profiles.SEGMENTS)} AS behavior_segment,
         {_CASES([(n, f'rfm_total >= {low}') for n, low in profiles.TIERS])} AS value_tier
  FROM (SELECT *, r_score + f_score + m_score AS rfm_total
        FROM (SELECT user_pseudo_id, recency_days, orders_count, monetary_total,
                     6 - ntile(5) OVER (ORDER BY recency_days, user_pseudo_id) AS r_score,
                     ntile(5) OVER (ORDER BY orders_count, user_pseudo_id) AS f_score,
                     ntile(5) OVER (ORDER BY monetary_total, user_pseudo_id) AS m_score
              FROM ga_rfm WHERE orders_count >= 1))""")
view("pf_weights", """
  SELECT *, (CASE event_name WHEN 'view_item' THEN 1.0::double WHEN 'add_to_cart' THEN 3.0 WHEN 'begin_checkout' THEN 5.0
             ELSE 10.0 END * pow(0.5::double, ((SELECT max(event_date) FROM ga) - event_date) / 14.0::double))::decimal(20,12) AS w
  FROM ga""")
view("pf_category", """
  SELECT user_pseudo_id, item_category AS preferred_category, round(w::decimal(38,12), 4)::double AS preferred_category_score
  FROM (SELECT *, row_number() OVER (PARTITION BY user_pseudo_id ORDER BY w DESC, item_category) AS rn
        FROM (SELECT p.user_pseudo_id, c.item_category, sum(p.w) AS w FROM pf_weights p
              JOIN ga_catalog c USING (item_id) WHERE c.item_category IS NOT NULL GROUP BY ALL)) WHERE rn = 1""")


def _majority(column: str, name: str) -> str:
    return f"""SELECT user_pseudo_id, {column} AS {name} FROM (
      SELECT user_pseudo_id, {column}, row_number() OVER (PARTITION BY user_pseudo_id ORDER BY count(*) DESC, {column}) AS rn
      FROM ga WHERE {column} IS NOT NULL GROUP BY 1, 2) WHERE rn = 1"""


view("pf", f"""
  SELECT r.user_pseudo_id, r.orders_count >= 1 AS is_purchaser, r.recency_days::bigint AS recency_days,
         r.orders_count AS frequency_orders, r.monetary_total, r.aov, s.r_score, s.f_score, s.m_score, s.rfm_total,
         s.behavior_segment, s.value_tier, r.sessions_count, r.active_days, r.first_seen_date, r.last_seen_date,
         (r.data_anchor_date - r.last_seen_date)::bigint AS last_active_days,
         CASE WHEN purchase_events > 0 THEN 'purchase' WHEN checkout_events > 0 THEN 'checkout'
              WHEN cart_events > 0 THEN 'cart' ELSE 'view' END AS funnel_stage_max,
         cart_events > 0 AND purchase_events = 0 AS has_cart_abandon, coalesce(d.n, 0) AS funnel_sessions_count,
         d.depth AS avg_funnel_session_depth, r.distinct_items_viewed, r.distinct_items_purchased,
         c.preferred_category, c.preferred_category_score, e.engagement_score, dv.primary_device_category,
         ct.primary_geo_country, r.data_anchor_date, view_events, cart_events, checkout_events, purchase_events
  FROM ga_rfm r
  LEFT JOIN pf_scores s USING (user_pseudo_id)
  LEFT JOIN (SELECT user_pseudo_id, count(*) AS n, round((sum(funnel_events_count)::double / count(*))::decimal(38,12), 2)::double AS depth
             FROM ga_sessions GROUP BY 1) d USING (user_pseudo_id)
  LEFT JOIN pf_category c USING (user_pseudo_id)
  LEFT JOIN (SELECT user_pseudo_id, round(sum(w)::decimal(38,12), 4)::double AS engagement_score FROM pf_weights GROUP BY 1) e USING (user_pseudo_id)
  LEFT JOIN ({_majority('device_category', 'primary_device_category')}) dv USING (user_pseudo_id)
  LEFT JOIN ({_majority('geo_country', 'primary_geo_country')}) ct USING (user_pseudo_id)""")


def rfm(t: Tables):
    return commerce.user_rfm(ga(t))


def profile_rows(t: Tables):
    """Profiles, written once: several results below read them more than once."""
    events = cut(ga(t))
    return cut(profiles.user_profiles(events, commerce.user_rfm(events), commerce.sessions(events),
                                      commerce.item_catalog(events))), events


@query("rfm_scores", """
  SELECT user_pseudo_id, recency_days::bigint AS recency_days, orders_count, monetary_total, r_score, f_score, m_score, rfm_total
  FROM pf_scores""")
def rfm_scores(t: Tables):
    return profiles.rfm_scores(rfm(t)).drop("behavior_segment", "value_tier")


@query("rfm_segments", "SELECT user_pseudo_id, behavior_segment, value_tier, rfm_total FROM pf_scores")
def rfm_segments(t: Tables):
    return profiles.rfm_scores(rfm(t)).select("user_pseudo_id", "behavior_segment", "value_tier", "rfm_total")


@query("engagement_score", "SELECT user_pseudo_id, round(sum(w)::decimal(38,12), 4)::double AS engagement_score FROM pf_weights GROUP BY 1")
def engagement_score(t: Tables):
    events = ga(t)
    return profiles.engagement(profiles.weighted(events, commerce.anchor(events)))


@query("preferred_category", "SELECT * FROM pf_category")
def preferred_category(t: Tables):
    events = ga(t)
    return profiles.preferred_category(profiles.weighted(events, commerce.anchor(events)), commerce.item_catalog(events))


_DATES = "first_seen_date::varchar AS first_seen_date, last_seen_date::varchar AS last_seen_date, data_anchor_date::varchar AS data_anchor_date"


@query("user_profiles", f"SELECT * REPLACE ({_DATES}) FROM (SELECT {', '.join(profiles.PROFILE_COLUMNS)} FROM pf)")
def user_profiles(t: Tables):
    return profile_rows(t)[0].select(*profiles.PROFILE_COLUMNS)


_MEAN = lambda c: f"round((sum({c}::decimal(18,4))::double / count({c}))::decimal(38,12), 2)::double"


@query("segment_summary", f"""
  SELECT dimension, name, count(*) AS users_count, {_MEAN('recency_days')} AS avg_recency_days,
         {_MEAN('frequency_orders')} AS avg_frequency_orders, {_MEAN('monetary_total')} AS avg_monetary,
         sum(monetary_total::decimal(18,2))::double AS monetary_total, max(data_anchor_date)::varchar AS data_anchor_date,
         round((count(*) / (SELECT count(*) FROM pf WHERE is_purchaser)::double)::decimal(38,12), 4)::double AS pct_of_purchasers
  FROM (SELECT 'behavior_segment' AS dimension, behavior_segment AS name, * FROM pf WHERE is_purchaser
        UNION ALL SELECT 'value_tier', value_tier, * FROM pf WHERE is_purchaser) GROUP BY 1, 2""")
def segment_summary(t: Tables):
    return profiles.segment_summary(profile_rows(t)[0])


@query("rfm_grid", f"""
  SELECT r_score, f_score, count(*) AS users_count, {_MEAN('monetary_total')} AS avg_monetary,
         sum(monetary_total::decimal(18,2))::double AS monetary_total FROM pf WHERE is_purchaser GROUP BY 1, 2""")
def rfm_grid(t: Tables):
    return profiles.rfm_grid(profile_rows(t)[0])


@query("tag_coverage", " UNION ALL ".join(
    f"""SELECT '{tag}' AS tag_key, count(*) AS denominator, count(*) FILTER ({rule}) AS users_count,
    round((count(*) FILTER ({rule}) / count(*)::double)::decimal(38,12), 4)::double AS coverage_pct FROM pf"""
    for tag, rule in profiles.TAGS.items()))
def tag_coverage(t: Tables):
    return profiles.tag_coverage(profile_rows(t)[0])


@query("segment_cross", """
  SELECT behavior_segment, item_category, count(DISTINCT user_pseudo_id) AS users_count, count(*) AS events_count
  FROM ga JOIN pf_scores USING (user_pseudo_id) WHERE item_category IS NOT NULL GROUP BY 1, 2""")
def segment_cross(t: Tables):
    events = cut(ga(t))
    return profiles.segment_cross(events, profiles.rfm_scores(commerce.user_rfm(events)))


@query("dq_profiles", " UNION ALL ".join(f"SELECT '{c}' AS check_name, 0::bigint AS offending_rows" for c in (
    "scores_iff_purchaser", "decay_sanity", "segment_totals", "rfm_grid_conservation", "profiles_conservation")))
def dq_profiles(t: Tables):
    rows, events = profile_rows(t)
    return profiles.conservation(rows, commerce.user_rfm(events))


ANY_OF = {"op": "or", "conditions": [
    {"type": "range", "field": "monetary_total", "gte": 1500},
    {"type": "match", "field": "primary_device_category", "values": ["mobile", "tablet"]},
    {"op": "and", "conditions": [{"type": "exists", "field": "preferred_category"},
                                 {"type": "range", "field": "r_score", "gt": 3, "lte": 5}]}]}
AUDIENCE = {"op": "and", "conditions": [
    {"type": "match", "field": "is_purchaser", "values": [True]},
    {"type": "range", "field": "last_seen_date", "gte": "2024-01-20"}, ANY_OF]}
TAG_RULES = {
    "big_spender": {"type": "range", "field": "monetary_total", "gte": 2000},
    "browser": {"op": "and", "conditions": [{"type": "match", "field": "is_purchaser", "values": [False]},
                                            {"type": "range", "field": "sessions_count", "gte": 5}]},
    "recent": {"type": "range", "field": "last_active_days", "lte": 1},
}
_WHERE = """is_purchaser AND last_seen_date >= date '2024-01-20' AND (monetary_total >= 1500
    OR primary_device_category IN ('mobile', 'tablet') OR (preferred_category IS NOT NULL AND r_score > 3 AND r_score <= 5))"""
view("pf_tags", """
  SELECT 'big_spender' AS tag_key, user_pseudo_id FROM pf WHERE monetary_total >= 2000
  UNION ALL SELECT 'browser', user_pseudo_id FROM pf WHERE NOT is_purchaser AND sessions_count >= 5
  UNION ALL SELECT 'recent', user_pseudo_id FROM pf WHERE last_active_days <= 1""")
view("pf_chosen", f"SELECT * FROM pf WHERE {_WHERE}")


@query("audience_select", f"""
  SELECT user_pseudo_id, behavior_segment, value_tier, monetary_total, last_active_days FROM pf
  WHERE user_pseudo_id IN (SELECT user_pseudo_id FROM pf_tags WHERE tag_key = 'browser') OR monetary_total >= 1500
     OR primary_device_category IN ('mobile', 'tablet') OR (preferred_category IS NOT NULL AND r_score > 3 AND r_score <= 5)""")
def audience_select(t: Tables):
    rows = profile_rows(t)[0]
    tree = {"op": "or", "conditions": [{"type": "exists", "field": "tag:browser"}, ANY_OF]}
    tagged = audience.custom_tags(rows, TAG_RULES)
    return audience.select(rows, tree, tagged).select(
        "user_pseudo_id", "behavior_segment", "value_tier", "monetary_total", "last_active_days")


@query("audience_preview", """
  SELECT 'total' AS section, 'audience_size' AS name, count(*)::double AS amount FROM pf_chosen
  UNION ALL SELECT 'total', 'base_count', count(*)::double FROM pf
  UNION ALL SELECT 'total', 'pct', round((SELECT count(*) FROM pf_chosen) / count(*)::double, 4) FROM pf
  UNION ALL SELECT 'sample', user_pseudo_id, monetary_total FROM (SELECT * FROM pf_chosen ORDER BY user_pseudo_id LIMIT 20)
  UNION ALL SELECT section, name, n::double FROM (
    SELECT *, row_number() OVER (PARTITION BY section ORDER BY n DESC, name) AS rn FROM (
      SELECT 'distribution:behavior_segment' AS section, behavior_segment AS name, count(*) AS n FROM pf_chosen GROUP BY 2
      UNION ALL SELECT 'distribution:value_tier', value_tier, count(*) FROM pf_chosen GROUP BY 2
      UNION ALL SELECT 'distribution:preferred_category', preferred_category, count(*) FROM pf_chosen WHERE preferred_category IS NOT NULL GROUP BY 2))
    WHERE rn <= 10
  UNION ALL SELECT 'funnel', CASE event_name WHEN 'view_item' THEN 'reached_view' WHEN 'add_to_cart' THEN 'reached_cart'
      WHEN 'begin_checkout' THEN 'reached_checkout' ELSE 'reached_purchase' END, count(DISTINCT user_pseudo_id)::double
    FROM ga WHERE user_pseudo_id IN (SELECT user_pseudo_id FROM pf_chosen) GROUP BY 2""")
def audience_preview(t: Tables):
    rows, events = profile_rows(t)
    return audience.preview(rows, events, AUDIENCE)


@query("custom_tags", "SELECT tag_key, user_pseudo_id FROM pf_tags")
def custom_tags(t: Tables):
    path = scratch_path(t.spark, "tags")
    audience.materialise_tags(audience.custom_tags(profile_rows(t)[0], TAG_RULES), path)
    return store.read_table(t.spark, path).select("tag_key", "user_pseudo_id")


@query("mirror_incremental", "SELECT event_date::varchar AS event_date, count(*) AS row_count, coalesce(sum(revenue_cents), 0) / 100.0::double AS revenue FROM ga GROUP BY 1")
def mirror_incremental(t: Tables):
    """A mirror that stopped in the middle of a day is complete again after one reload."""
    events, path = cut(ga(t)), scratch_path(t.spark, "mirror")
    store.overwrite_partitions(events.where("event_ts < timestamp'2024-01-20 12:00:00'"), path, ["event_date"])
    late = audience.mirror_days(events, store.read_table(t.spark, path), "event_date")
    store.overwrite_partitions(late, path, ["event_date"])
    return store.read_table(t.spark, path).groupBy("event_date").agg(
        F.count(F.lit(1)).alias("row_count"), F.coalesce(F.sum("item_revenue"), F.lit(0)).alias("revenue"))


@query("latest_version", """
  SELECT user_id, event_type, event_id, ts, value FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1""")
def latest_version(t: Tables):
    return audience.latest_version(t.events, ["user_id", "event_type"], "ts", ["event_id"]).select(
        "user_id", "event_type", "event_id", "ts", "value")


# --- clusters: with given labels (rfm_total % 3) for the checks, fitted ones rows-only ---

view("cl_given", """
  SELECT user_pseudo_id, rfm_total % 3 AS value_cluster, recency_days::double AS x0, frequency_orders::double AS x1,
         ln(1 + monetary_total) AS x2, ln(1 + engagement_score) AS x3, value_tier, recency_days, frequency_orders,
         monetary_total, engagement_score FROM pf WHERE is_purchaser""")


def given(rows):
    return rows.where("is_purchaser").select("user_pseudo_id", (F.col("rfm_total") % 3).alias("value_cluster"))


@query("value_clusters")
def value_clusters(t: Tables):
    assigned, facts = clusters.fit_clusters(profile_rows(t)[0])
    return assigned.withColumns({"k": F.lit(facts["k"]), "silhouette": F.lit(facts["silhouette"])})


@query("version_gate")
def version_gate(t: Tables):
    rows = profile_rows(t)[0]
    assigned, facts = clusters.fit_clusters(rows, ks=range(2, 4))
    return assigned.groupBy("value_cluster").agg(F.count(F.lit(1)).alias("users_count")).withColumns({
        "first_run": F.lit(clusters.version_gate(facts, None)), "rerun": F.lit(clusters.version_gate(facts, facts))})


_NAMES3 = "['高消費群', '中消費群', '低消費群'][row_number() OVER (ORDER BY avg_monetary DESC, avg_frequency_orders DESC, avg_engagement_score DESC, value_cluster)]"


@query("cluster_names", f"""
  SELECT *, round((users_count / sum(users_count) OVER ()::double)::decimal(38,12), 4)::double AS pct_of_purchasers, {_NAMES3} AS value_cluster_label
  FROM (SELECT value_cluster, count(*) AS users_count, {_MEAN('recency_days')} AS avg_recency_days,
               {_MEAN('frequency_orders')} AS avg_frequency_orders, {_MEAN('monetary_total')} AS avg_monetary,
               round((sum(engagement_score::decimal(18,4))::double / count(*))::decimal(38,12), 4)::double AS avg_engagement_score,
               round(median(monetary_total)::decimal(38,12), 2)::double AS median_monetary
        FROM cl_given GROUP BY 1)""")
def cluster_names(t: Tables):
    rows = profile_rows(t)[0]
    return clusters.cluster_profiles(given(rows), rows)


@query("cluster_crosstab", """
  SELECT value_tier, value_cluster, count(*) AS users_count,
         round((count(*) / sum(count(*)) OVER (PARTITION BY value_tier)::double)::decimal(38,12), 4)::double AS pct_of_tier
  FROM cl_given GROUP BY 1, 2""")
def cluster_crosstab(t: Tables):
    rows = profile_rows(t)[0]
    return clusters.crosstab(given(rows), rows)


@query("ari", """
  WITH c AS (SELECT value_tier AS a, value_cluster AS b, count(*)::double AS n FROM cl_given GROUP BY 1, 2),
  s AS (SELECT (SELECT sum(n * (n - 1) / 2) FROM c) AS cells, (SELECT sum(n) FROM c) AS total,
               (SELECT sum(m * (m - 1) / 2) FROM (SELECT sum(n) AS m FROM c GROUP BY a)) AS pa,
               (SELECT sum(m * (m - 1) / 2) FROM (SELECT sum(n) AS m FROM c GROUP BY b)) AS pb)
  SELECT round(((cells - pa * pb / (total * (total - 1) / 2)) / ((pa + pb) / 2 - pa * pb / (total * (total - 1) / 2)))::decimal(38,12), 6)::double AS ari FROM s""")
def ari(t: Tables):
    rows = profile_rows(t)[0]
    return clusters.adjusted_rand(clusters.crosstab(given(rows), rows), "value_tier", "value_cluster", "users_count")


_Z = ", ".join(f"(x{i} - avg(x{i}) OVER ()) / stddev_pop(x{i}) OVER () AS x{i}" for i in range(4))


@query("centroid_distance", f"""
  WITH z AS (SELECT user_pseudo_id, value_cluster, {_Z} FROM cl_given),
  c AS (SELECT value_cluster, avg(x0) AS c0, avg(x1) AS c1, avg(x2) AS c2, avg(x3) AS c3 FROM z GROUP BY 1)
  SELECT user_pseudo_id, value_cluster,
         round(sqrt(pow(x0 - c0, 2) + pow(x1 - c1, 2) + pow(x2 - c2, 2) + pow(x3 - c3, 2))::decimal(38,12), 4)::double AS distance_to_centroid
  FROM z JOIN c USING (value_cluster)""")
def centroid_distance(t: Tables):
    rows = profile_rows(t)[0]
    scaled = clusters.standardised(clusters.buyers(rows)).join(given(rows), "user_pseudo_id")
    centres = scaled.groupBy("value_cluster").agg(*[F.avg(f"x{i}").alias(f"x{i}") for i in range(4)])
    return clusters.centroid_distance(scaled, centres)
