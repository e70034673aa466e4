"""Audience profiles: scores, segments, decayed engagement, one wide row per user."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.numeric import exact_round, ratio
from tidemark.operators.ordering import first_per
from tidemark.operators.scalars import attach
from tidemark.operators.selection import tiles
from tidemark.plans.commerce import money

USER = "user_pseudo_id"

# Event weights, half-life in days, segment and tier names with their bounds.
EVENT_WEIGHTS = {"view_item": 1, "add_to_cart": 3, "begin_checkout": 5, "purchase": 10}
HALF_LIFE_DAYS = 14
TIERS = [("白金級", 13), ("黃金級", 10), ("白銀級", 7), ("銅級", 3)]
SEGMENTS = [
    ("VIP 客戶", "r_score >= 4 AND f_score >= 4 AND m_score >= 4"),
    ("忠誠客戶", "r_score >= 3 AND f_score >= 4"),
    ("大額客戶", "m_score >= 4 AND f_score >= 3"),
    ("新客戶", "r_score >= 4 AND f_score = 1"),
    ("潛力客戶", "r_score >= 3 AND m_score >= 3"),
    ("需要挽回", "r_score <= 2 AND f_score >= 3"),
    ("即將流失", "r_score <= 2 AND f_score <= 2"),
    ("休眠客戶", "true"),
]
TAGS = {
    "purchaser": "is_purchaser", "cart_abandoner": "has_cart_abandon",
    "multi_session": "funnel_sessions_count >= 2", "deep_browser": "avg_funnel_session_depth >= 5",
    "has_preferred_category": "preferred_category is not null",
    "reached_view": "view_events > 0", "reached_cart": "cart_events > 0",
    "reached_checkout": "checkout_events > 0", "reached_purchase": "purchase_events > 0",
}


def _ladder(rules: list[tuple[str, str]]) -> Column:
    """The first rule that holds names the row."""
    chain = F
    for name, rule in rules:
        chain = chain.when(F.expr(rule), name)
    return chain


def rfm_scores(rfm: DataFrame) -> DataFrame:
    """Quintiles over purchasers only, ties broken by user; segments and tiers on top."""
    out = rfm.where("orders_count >= 1").select(USER, "recency_days", "orders_count", "monetary_total")
    cents = (money("monetary_total") * 100).cast("long")
    out = tiles(out, 5, {"_r": F.col("recency_days"), "f_score": F.col("orders_count"), "m_score": cents}, USER)
    out = out.withColumn("r_score", F.lit(6) - F.col("_r")).drop("_r")
    out = out.withColumn("rfm_total", F.expr("r_score + f_score + m_score"))
    return out.withColumns({
        "behavior_segment": _ladder(SEGMENTS),
        "value_tier": _ladder([(name, f"rfm_total >= {low}") for name, low in TIERS])})


def decay_weight(event: Column, age_days: Column, half_life: int = HALF_LIFE_DAYS) -> Column:
    """Event weight halved every ``half_life`` days before the anchor; exact when summed."""
    base = F
    for name, weight in EVENT_WEIGHTS.items():
        base = base.when(event == name, float(weight))
    return (base * F.pow(F.lit(0.5), age_days / F.lit(float(half_life)))).cast("decimal(20,12)")


def weighted(events: DataFrame, anchor: DataFrame) -> DataFrame:
    """Events with their decayed weight; the anchor is the newest day, a one-row table."""
    return events.transform(attach, anchor).withColumn(
        "w", decay_weight(F.col("event_name"), F.datediff("data_anchor_date", "event_date")))


def engagement(w_events: DataFrame) -> DataFrame:
    return w_events.groupBy(USER).agg(exact_round(F.sum("w"), 4).alias("engagement_score"))


def preferred_category(w_events: DataFrame, catalog: DataFrame) -> DataFrame:
    """The category with the most decayed weight, by the catalogue's name for each item."""
    canonical = catalog.select("item_id", "item_category").where("item_category is not null")
    per_item = w_events.groupBy(USER, "item_id").agg(F.sum("w").alias("w"))
    by_category = (per_item.join(canonical, "item_id")
                   .groupBy(USER, "item_category").agg(F.sum("w").alias("w")))
    best = first_per(by_category, [USER], [F.col("w").desc(), F.col("item_category").asc()])
    return best.select(USER, F.col("item_category").alias("preferred_category"),
                       exact_round(F.col("w"), 4).alias("preferred_category_score"))


def majority(events: DataFrame, column: str, name: str) -> DataFrame:
    counted = events.where(F.col(column).isNotNull()).groupBy(USER, column).agg(F.count(F.lit(1)).alias("_n"))
    return first_per(counted, [USER], [F.col("_n").desc(), F.col(column).asc()]).select(USER, F.col(column).alias(name))


def user_profiles(events: DataFrame, rfm: DataFrame, sessions: DataFrame, catalog: DataFrame) -> DataFrame:
    """Every user of the RFM table, buyers and browsers, with scores only for buyers."""
    anchor = rfm.agg(F.max("data_anchor_date").alias("data_anchor_date"))
    w_events = weighted(events, anchor)
    depth = sessions.groupBy(USER).agg(
        F.count(F.lit(1)).alias("funnel_sessions_count"),
        exact_round(F.sum("funnel_events_count").cast("double") / F.count(F.lit(1)), 2).alias("avg_funnel_session_depth"))
    scores = rfm_scores(rfm).drop("recency_days", "orders_count", "monetary_total")
    parts = [scores, depth, preferred_category(w_events, catalog), engagement(w_events),
             majority(events, "device_category", "primary_device_category"),
             majority(events, "geo_country", "primary_geo_country")]
    wide = reduce(lambda left, right: left.join(right, USER, "left"), parts, rfm)
    stage = (F.when(F.col("purchase_events") > 0, "purchase").when(F.col("checkout_events") > 0, "checkout")
             .when(F.col("cart_events") > 0, "cart").otherwise("view"))
    return wide.select(
        USER, (F.col("orders_count") >= 1).alias("is_purchaser"), "recency_days",
        F.col("orders_count").alias("frequency_orders"), "monetary_total", "aov",
        "r_score", "f_score", "m_score", "rfm_total", "behavior_segment", "value_tier",
        "sessions_count", "active_days", "first_seen_date", "last_seen_date",
        F.datediff("data_anchor_date", "last_seen_date").alias("last_active_days"),
        stage.alias("funnel_stage_max"),
        ((F.col("cart_events") > 0) & (F.col("purchase_events") == 0)).alias("has_cart_abandon"),
        F.coalesce("funnel_sessions_count", F.lit(0)).alias("funnel_sessions_count"), "avg_funnel_session_depth",
        "distinct_items_viewed", "distinct_items_purchased", "preferred_category", "preferred_category_score",
        "engagement_score", "primary_device_category", "primary_geo_country", "data_anchor_date",
        "view_events", "cart_events", "checkout_events", "purchase_events")


PROFILE_COLUMNS = [
    USER, "is_purchaser", "recency_days", "frequency_orders", "monetary_total", "aov", "r_score", "f_score",
    "m_score", "rfm_total", "behavior_segment", "value_tier", "sessions_count", "active_days", "first_seen_date",
    "last_seen_date", "last_active_days", "funnel_stage_max", "has_cart_abandon", "funnel_sessions_count",
    "avg_funnel_session_depth", "distinct_items_viewed", "distinct_items_purchased", "preferred_category",
    "preferred_category_score", "engagement_score", "primary_device_category", "primary_geo_country",
    "data_anchor_date"]


def _mean(c: str, places: int = 2) -> Column:
    return exact_round(F.sum(F.col(c).cast("decimal(18,4)")).cast("double") / F.count(c), places)


def segment_summary(profiles: DataFrame, dimensions=("behavior_segment", "value_tier")) -> DataFrame:
    """One pass for all dimensions; shares are of all purchasers."""
    buyers = profiles.where("is_purchaser")
    total = buyers.agg(F.count(F.lit(1)).alias("_total"))
    named = F.explode(F.array(*[F.struct(F.lit(d).alias("dimension"), F.col(d).alias("name")) for d in dimensions]))
    rows = buyers.withColumn("_d", named).groupBy("_d.dimension", "_d.name").agg(
        F.count(F.lit(1)).alias("users_count"), _mean("recency_days").alias("avg_recency_days"),
        _mean("frequency_orders").alias("avg_frequency_orders"), _mean("monetary_total").alias("avg_monetary"),
        F.sum(money("monetary_total")).alias("monetary_total"), F.max("data_anchor_date").alias("data_anchor_date"))
    return (rows.transform(attach, total)
            .withColumn("pct_of_purchasers", ratio(F.col("users_count"), F.col("_total"), 4)).drop("_total"))


def rfm_grid(profiles: DataFrame) -> DataFrame:
    return profiles.where("is_purchaser").groupBy("r_score", "f_score").agg(
        F.count(F.lit(1)).alias("users_count"), _mean("monetary_total").alias("avg_monetary"),
        F.sum(money("monetary_total")).alias("monetary_total"))


def tag_coverage(profiles: DataFrame) -> DataFrame:
    counted = profiles.agg(F.count(F.lit(1)).alias("denominator"),
                           *[F.count_if(F.expr(rule)).alias(tag) for tag, rule in TAGS.items()])
    pairs = ", ".join(f"'{tag}', {tag}" for tag in TAGS)
    return counted.select("denominator", F.expr(f"stack({len(TAGS)}, {pairs}) AS (tag_key, users_count)")).withColumn(
        "coverage_pct", ratio(F.col("users_count"), F.col("denominator"), 4))


def segment_cross(events: DataFrame, profiles: DataFrame) -> DataFrame:
    """Segment by item category: users and events."""
    segments = profiles.where("behavior_segment is not null").select(USER, "behavior_segment")
    per_user = events.where("item_category is not null").groupBy(USER, "item_category").agg(F.count(F.lit(1)).alias("n"))
    return per_user.join(segments, USER).groupBy("behavior_segment", "item_category").agg(
        F.count(F.lit(1)).alias("users_count"), F.sum("n").alias("events_count"))


def conservation(profiles: DataFrame, rfm: DataFrame) -> DataFrame:
    """Five checks that no user is lost or counted twice; one row each, zero means it holds."""
    per_row = profiles.agg(
        F.count_if(F.col("is_purchaser") != F.col("r_score").isNotNull()).alias("scores_iff_purchaser"),
        F.count_if((F.col("engagement_score") <= 0) | (F.col("preferred_category_score") < 0)).alias("decay_sanity"),
        F.count_if("is_purchaser").alias("_buyers"), F.count(F.lit(1)).alias("_users"))
    parts = per_row.transform(attach, segment_summary(profiles).groupBy().agg(
        F.sum(F.when(F.col("dimension") == "behavior_segment", F.col("users_count"))).alias("_s1"),
        F.sum(F.when(F.col("dimension") == "value_tier", F.col("users_count"))).alias("_s2")))
    parts = parts.transform(attach, rfm_grid(profiles).agg(F.sum("users_count").alias("_grid"), F.count(F.lit(1)).alias("_cells")))
    parts = parts.transform(attach, rfm.agg(F.count(F.lit(1)).alias("_rfm")))
    return parts.select(F.expr("""stack(5, 'scores_iff_purchaser', scores_iff_purchaser, 'decay_sanity', decay_sanity,
        'segment_totals', abs(_s1 - _buyers) + abs(_s2 - _buyers),
        'rfm_grid_conservation', abs(_grid - _buyers) + greatest(_cells - 25, 0L),
        'profiles_conservation', abs(_users - _rfm)) AS (check_name, offending_rows)"""))
