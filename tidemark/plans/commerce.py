"""Commerce events: nested export rows to the event-item table and its four marts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions import variant as vt
from tidemark.functions.numeric import exact_round, ratio
from tidemark.operators.scalars import attach

# The funnel events kept, in funnel order.
FUNNEL = ["view_item", "add_to_cart", "begin_checkout", "purchase"]
EVENT_GRAIN = ["event_date", "event_ts_micros", "event_name", "user_pseudo_id", "item_id"]
EVENT_KEY = ["user_pseudo_id", "event_ts_micros", "event_name", "item_id"]

_ATTRIBUTES = ["ga_session_id", "transaction_id", "device_category", "geo_country",
               "first_touch_source", "first_touch_medium", "item_name", "item_category", "price"]


def param(key: str, kind: str) -> Column:
    """The first event parameter named ``key``; ``kind`` is string_value or int_value."""
    return F.get(F.filter("event_params", lambda p: p["key"] == key), F.lit(0))[kind]


def variant_param(key: str, kind: str) -> Column:
    return vt.entry(F.col("event_params"), key, kind)


def money(c: str | Column) -> Column:
    """Amounts are summed as DECIMAL so that the order of rows cannot change a total."""
    return (F.col(c) if isinstance(c, str) else c).cast("decimal(18,2)")


def _is(event: str) -> Column:
    return F.col("event_name") == event


def funnel_extract(raw: DataFrame, param: Callable[[str, str], Column] = param) -> DataFrame:
    """Funnel events exploded to items; equal grain rows are merged by max and sum.

    ``param`` reads a parameter by key and kind: from typed entries, or with ``variant_param`` from VARIANT.
    """
    item = F.col("item")
    rows = (raw.where(F.col("event_name").isin(*FUNNEL))
            .select("event_date", "event_ts_micros", "event_name", "user_pseudo_id",
                    param("ga_session_id", "int_value").alias("ga_session_id"),
                    param("transaction_id", "string_value").alias("transaction_id"),
                    "device_category", "geo_country", "first_touch_source", "first_touch_medium",
                    F.explode("items").alias("item"))
            .where(item["item_id"].isNotNull())
            .select("*", "item.*").drop("item"))
    return rows.groupBy(*EVENT_GRAIN).agg(
        *[F.max(c).alias(c) for c in _ATTRIBUTES],
        F.sum("quantity").alias("quantity"),
        F.sum(money("item_revenue")).cast("decimal(18,2)").alias("item_revenue"),
    ).withColumns({
        "event_ts": F.timestamp_micros("event_ts_micros"),
        "ingestion_id": F.concat(F.lit("ga4_"), F.date_format("event_date", "yyyyMMdd")),
    })


def single_day(raw: DataFrame, day: str) -> DataFrame:
    """One day partition; an empty day gives an empty table."""
    return funnel_extract(raw.where(F.col("event_date") == F.lit(day).cast("date")))


def interactions(events: DataFrame) -> DataFrame:
    return events.groupBy("user_pseudo_id", "item_id", "event_name", "event_date").agg(
        F.count(F.lit(1)).alias("interaction_count"),
        F.countDistinct("ga_session_id").alias("sessions_count"),
        F.sum(F.coalesce("quantity", F.lit(0))).alias("total_quantity"),
        F.sum(F.coalesce(money("item_revenue"), F.lit(0))).alias("total_revenue"),
        F.min("event_ts").alias("first_event_ts"), F.max("event_ts").alias("last_event_ts"),
    )


def item_catalog(events: DataFrame) -> DataFrame:
    """Two steps, (item, user) then item: distinct users become sums of flags."""
    when = F.struct("event_ts_micros", "event_name", "user_pseudo_id")
    latest = lambda c: F.max(F.when(F.col(c).isNotNull(), F.struct(when.alias("at"), F.col(c).alias("v"))))
    bought = _is("purchase")
    per_user = events.groupBy("item_id", "user_pseudo_id").agg(
        *[F.count_if(_is(e)).alias(e) for e in FUNNEL],
        latest("item_name").alias("_name"), latest("item_category").alias("_category"),
        latest("price").alias("_price"),
        F.min(money("price")).alias("price_min"), F.max(money("price")).alias("price_max"),
        F.min("event_date").alias("first_seen_date"), F.max("event_date").alias("last_seen_date"),
        F.sum(F.when(bought, F.coalesce("quantity", F.lit(0))).otherwise(0)).alias("units_sold"),
        F.sum(F.when(bought, F.coalesce(money("item_revenue"), F.lit(0))).otherwise(0)).alias("revenue_total"),
    )
    users = dict(zip(FUNNEL, ["users_viewed", "users_carted", "users_checked_out", "users_purchased"]))
    counts = dict(zip(FUNNEL, ["view_events", "cart_events", "checkout_events", "purchase_events"]))
    out = per_user.groupBy("item_id").agg(
        F.max("_name")["v"].alias("item_name"), F.max("_category")["v"].alias("item_category"),
        F.min("price_min").alias("price_min"), F.max("price_max").alias("price_max"),
        F.max("_price")["v"].alias("price_latest"),
        F.min("first_seen_date").alias("first_seen_date"), F.max("last_seen_date").alias("last_seen_date"),
        *[F.count_if(F.col(e) > 0).alias(n) for e, n in users.items()],
        *[F.sum(e).alias(n) for e, n in counts.items()],
        F.sum("units_sold").alias("units_sold"), F.sum("revenue_total").alias("revenue_total"),
    )
    viewed, carted, purchased = F.col("users_viewed"), F.col("users_carted"), F.col("users_purchased")
    return out.withColumns({
        "view_to_cart_user_rate": ratio(carted, viewed, 4),
        "cart_to_purchase_user_rate": ratio(purchased, carted, 4),
        "view_to_purchase_user_rate": ratio(purchased, viewed, 4),
    })


def sessions(events: DataFrame) -> DataFrame:
    """Funnel-active sessions, again in two steps so distinct items are sums of flags."""
    per_item = events.where("ga_session_id is not null").groupBy("user_pseudo_id", "ga_session_id", "item_id").agg(
        *[F.count_if(_is(e)).alias(e) for e in FUNNEL],
        F.min("event_date").alias("session_date"),
        F.min("event_ts").alias("session_start_ts"), F.max("event_ts").alias("session_end_ts"),
        F.count(F.lit(1)).alias("n"),
        F.sum(F.when(_is("purchase"), F.coalesce(money("item_revenue"), F.lit(0))).otherwise(0)).alias("revenue"),
        F.max("device_category").alias("device_category"), F.max("geo_country").alias("geo_country"),
    )
    any_of = lambda e: F.bool_or(F.col(e) > 0)
    return per_item.groupBy("user_pseudo_id", "ga_session_id").agg(
        F.min("session_date").alias("session_date"),
        F.min("session_start_ts").alias("session_start_ts"), F.max("session_end_ts").alias("session_end_ts"),
        F.sum("n").alias("funnel_events_count"),
        F.count_if(F.col("view_item") > 0).alias("items_viewed"),
        F.count_if(F.col("add_to_cart") > 0).alias("items_carted"),
        F.count_if(F.col("purchase") > 0).alias("items_purchased"),
        any_of("view_item").alias("did_view"), any_of("add_to_cart").alias("did_cart"),
        any_of("begin_checkout").alias("did_checkout"), any_of("purchase").alias("did_purchase"),
        F.sum("revenue").alias("session_revenue"),
        F.max("device_category").alias("device_category"), F.max("geo_country").alias("geo_country"),
    )


def anchor(events: DataFrame) -> DataFrame:
    """The newest day of the data, one row."""
    return events.agg(F.max("event_date").alias("data_anchor_date"))


def user_rfm(events: DataFrame) -> DataFrame:
    bought = _is("purchase")
    out = events.groupBy("user_pseudo_id").agg(
        F.min("event_date").alias("first_seen_date"), F.max("event_date").alias("last_seen_date"),
        F.countDistinct("event_date").alias("active_days"),
        F.countDistinct("ga_session_id").alias("sessions_count"),
        F.count_if(_is("view_item")).alias("view_events"), F.count_if(_is("add_to_cart")).alias("cart_events"),
        F.count_if(_is("begin_checkout")).alias("checkout_events"), F.count_if(bought).alias("purchase_events"),
        F.countDistinct(F.when(_is("view_item"), F.col("item_id"))).alias("distinct_items_viewed"),
        F.countDistinct(F.when(bought, F.col("item_id"))).alias("distinct_items_purchased"),
        F.countDistinct(F.when(bought, F.col("transaction_id"))).alias("orders_count"),
        F.sum(F.when(bought, F.coalesce("quantity", F.lit(0))).otherwise(0)).alias("units_purchased"),
        F.sum(F.when(bought, F.coalesce(money("item_revenue"), F.lit(0))).otherwise(0)).alias("monetary_total"),
        F.max(F.when(bought, F.col("event_date"))).alias("last_purchase_date"),
    )
    return out.transform(attach, anchor(events)).withColumns({
        "recency_days": F.datediff("data_anchor_date", "last_purchase_date"),
        "aov": exact_round(F.col("monetary_total").cast("double")
                           / F.nullif(F.col("orders_count").cast("double"), F.lit(0.0)), 2),
    })


def violations(events: DataFrame, sess: DataFrame, first_day: str, last_day: str) -> DataFrame:
    """Every event check in two passes: one over the events, one over the sessions."""
    grain = events.groupBy(*EVENT_KEY).agg(F.count(F.lit(1)).alias("_n"))
    count = lambda df, name, cond: df.agg(F.count_if(cond).alias("offending_rows")).select(
        F.lit(name).alias("check_name"), "offending_rows")
    sums = events.agg(
        F.count_if((F.col("price") < 0) | (F.col("quantity") < 0) | (F.col("item_revenue") < 0)).alias("amounts_non_negative"),
        F.count_if(~F.col("event_date").between(F.lit(first_day).cast("date"), F.lit(last_day).cast("date"))).alias("event_date_in_window"),
        F.when(F.count_if(_is("purchase") & F.col("item_revenue").isNull())
               > 0.9 * F.count_if(_is("purchase")), 1).otherwise(0).cast("long").alias("purchase_revenue_coverage"),
    ).select(F.expr("""stack(3, 'amounts_non_negative', amounts_non_negative,
        'event_date_in_window', event_date_in_window,
        'purchase_revenue_coverage', purchase_revenue_coverage) AS (check_name, offending_rows)"""))
    grain_of_sessions = sess.groupBy("user_pseudo_id", "ga_session_id").agg(F.count(F.lit(1)).alias("_n"))
    return (sums.unionByName(count(grain, "unique_events", F.col("_n") > 1))
            .unionByName(count(grain_of_sessions, "unique_sessions", F.col("_n") > 1))
            .unionByName(count(sess, "session_flag_consistency",
                               F.col("did_purchase") != (F.col("items_purchased") > 0))))


def touch_shards(raw: DataFrame) -> DataFrame:
    """Per (day, user, session): span, counts and the first known source, medium and campaign."""
    at = F.struct("event_ts_micros", "event_id")
    first = lambda key: F.min(F.when(param(key, "string_value").isNotNull(), F.struct(
        at.alias("at"), param(key, "string_value").alias("v"))))["v"]
    rows = raw.withColumn("ga_session_id", param("ga_session_id", "int_value"))
    return rows.groupBy("event_date", "user_pseudo_id", "ga_session_id").agg(
        F.min("event_ts_micros").alias("first_event_ts_micros"),
        F.max("event_ts_micros").alias("last_event_ts_micros"),
        F.count(F.lit(1)).alias("events_count"),
        F.count_if(_is("page_view")).alias("pageviews_count"),
        F.bool_or(_is("session_start")).alias("had_session_start"),
        first("source").alias("first_source"), first("medium").alias("first_medium"),
        first("campaign").alias("first_campaign"),
        F.max("device_category").alias("device_category"), F.max("geo_country").alias("geo_country"),
    )


def session_touches(shards: DataFrame) -> DataFrame:
    """Shards split at midnight merged back into sessions; the first shard gives the source."""
    first = F.min_by(F.struct("first_source", "first_medium", "first_campaign", "device_category"),
                     F.struct("first_event_ts_micros", "event_date"))
    merged = shards.where("ga_session_id is not null").groupBy("user_pseudo_id", "ga_session_id").agg(
        F.min("event_date").alias("session_date"),
        F.min("first_event_ts_micros").alias("session_start_micros"),
        F.max("last_event_ts_micros").alias("session_end_micros"),
        F.sum("events_count").alias("events_count"), F.sum("pageviews_count").alias("pageviews_count"),
        F.bool_or("had_session_start").alias("had_session_start"), first.alias("_first"),
    )
    return merged.select(
        "*", F.coalesce("_first.first_source", F.lit("(direct)")).alias("session_source"),
        F.coalesce("_first.first_medium", F.lit("(none)")).alias("session_medium"),
        F.col("_first.first_campaign").alias("session_campaign"),
        F.col("_first.device_category").alias("device_category"),
    ).drop("_first")
