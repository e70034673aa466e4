"""Queries: commerce events and their marts."""

from __future__ import annotations


from tidemark.plans import commerce
from tidemark.registry import query, view
from tidemark.sources import adapters
from tidemark.sources.tables import Tables

view("ga_raw", """
  SELECT event_id, ts::date AS event_date, epoch_us(ts) AS event_ts_micros, ts AS event_ts,
         CASE event_type WHEN 'view' THEN 'view_item' WHEN 'click' THEN 'add_to_cart'
              WHEN 'signup' THEN 'begin_checkout'
              WHEN 'purchase' THEN CASE WHEN user_id % 5 = 0 THEN 'view_item' ELSE 'purchase' END
              ELSE CASE WHEN event_id % 2 = 0 THEN 'page_view' ELSE 'session_start' END END AS event_name,
         'u' || user_id AS user_pseudo_id,
         CASE WHEN event_id % 50 <> 7 THEN epoch_us(ts) // 1000000 // 172800 END AS ga_session_id,
         CASE WHEN event_type = 'purchase' AND user_id % 5 <> 0 THEN 't' || event_id END AS transaction_id,
         CASE WHEN event_id % 5 <> 0 THEN 'src_' || (event_id % 12) END AS source,
         CASE WHEN event_id % 7 <> 0 THEN ['organic','cpc','email'][(event_id % 3 + 1)::int] END AS medium,
         CASE WHEN event_id % 4 = 0 THEN 'camp_' || (event_id % 6) END AS campaign,
         ['desktop','mobile','tablet'][((user_id + CASE WHEN event_id % 4 = 0 THEN 1 ELSE 0 END) % 3 + 1)::int] AS device_category,
         ['TW','US','JP','DE'][((user_id + CASE WHEN event_id % 6 = 0 THEN 1 ELSE 0 END) % 4 + 1)::int] AS geo_country,
         's' || (user_id % 12) AS first_touch_source,
         ['organic','cpc','referral'][(user_id % 3 + 1)::int] AS first_touch_medium,
         (json_extract(props, '$.k'))::bigint AS k,
         CASE WHEN event_type = 'purchase' AND user_id % 5 <> 0 THEN event_id % 3 + 1 END AS qty
  FROM events""")
view("ga_items", """
  SELECT *, 'item_' || ik AS item_id, 'Item ' || ik AS item_name,
         CASE WHEN ik <> 55 THEN 'cat_' || (ik % 10) END AS item_category,
         ik * 137 + 500 + event_id % 5 * 10 AS cents
  FROM (SELECT *, k AS ik FROM ga_raw WHERE event_id % 37 <> 0
        UNION ALL SELECT *, (k + 7) % 100 AS ik FROM ga_raw WHERE event_id % 3 = 0
        UNION ALL SELECT *, k AS ik FROM ga_raw WHERE event_id % 11 = 0 AND event_id % 37 <> 0)
  WHERE event_name IN ('view_item', 'add_to_cart', 'begin_checkout', 'purchase')""")
view("ga", """
  SELECT event_date, event_ts_micros, event_name, user_pseudo_id, item_id, max(event_ts) AS event_ts,
         max(ga_session_id) AS ga_session_id, max(transaction_id) AS transaction_id,
         max(device_category) AS device_category, max(geo_country) AS geo_country,
         max(first_touch_source) AS first_touch_source, max(first_touch_medium) AS first_touch_medium,
         max(item_name) AS item_name, max(item_category) AS item_category, max(cents) / 100.0::double AS price,
         sum(qty)::bigint AS quantity, sum(cents * qty)::bigint AS revenue_cents
  FROM ga_items GROUP BY ALL""")
view("ga_catalog", """
  SELECT item_id, max(item_name) AS item_name, max(item_category) AS item_category,
         min(price) AS price_min, max(price) AS price_max,
         arg_max(price, (event_ts_micros, event_name, user_pseudo_id)) AS price_latest,
         min(event_date) AS first_seen_date, max(event_date) AS last_seen_date,
         count(DISTINCT user_pseudo_id) FILTER (event_name = 'view_item') AS users_viewed,
         count(DISTINCT user_pseudo_id) FILTER (event_name = 'add_to_cart') AS users_carted,
         count(DISTINCT user_pseudo_id) FILTER (event_name = 'begin_checkout') AS users_checked_out,
         count(DISTINCT user_pseudo_id) FILTER (event_name = 'purchase') AS users_purchased,
         count(*) FILTER (event_name = 'view_item') AS view_events,
         count(*) FILTER (event_name = 'add_to_cart') AS cart_events,
         count(*) FILTER (event_name = 'begin_checkout') AS checkout_events,
         count(*) FILTER (event_name = 'purchase') AS purchase_events,
         coalesce(sum(quantity) FILTER (event_name = 'purchase'), 0)::bigint AS units_sold,
         coalesce(sum(revenue_cents) FILTER (event_name = 'purchase'), 0) / 100.0::double AS revenue_total
  FROM ga GROUP BY item_id""")
view("ga_sessions", """
  SELECT user_pseudo_id, ga_session_id, min(event_date) AS session_date, min(event_ts) AS session_start_ts,
         max(event_ts) AS session_end_ts, count(*) AS funnel_events_count,
         count(DISTINCT item_id) FILTER (event_name = 'view_item') AS items_viewed,
         count(DISTINCT item_id) FILTER (event_name = 'add_to_cart') AS items_carted,
         count(DISTINCT item_id) FILTER (event_name = 'purchase') AS items_purchased,
         bool_or(event_name = 'view_item') AS did_view, bool_or(event_name = 'add_to_cart') AS did_cart,
         bool_or(event_name = 'begin_checkout') AS did_checkout, bool_or(event_name = 'purchase') AS did_purchase,
         coalesce(sum(revenue_cents) FILTER (event_name = 'purchase'), 0) / 100.0::double AS session_revenue,
         max(device_category) AS device_category, max(geo_country) AS geo_country
  FROM ga WHERE ga_session_id IS NOT NULL GROUP BY ALL""")
view("ga_rfm", """
  SELECT *, data_anchor_date - last_purchase_date AS recency_days,
         round((monetary_total / nullif(orders_count, 0)::double)::decimal(38,12), 2)::double AS aov
  FROM (SELECT user_pseudo_id, min(event_date) AS first_seen_date, max(event_date) AS last_seen_date,
               count(DISTINCT event_date) AS active_days, count(DISTINCT ga_session_id) AS sessions_count,
               count(*) FILTER (event_name = 'view_item') AS view_events,
               count(*) FILTER (event_name = 'add_to_cart') AS cart_events,
               count(*) FILTER (event_name = 'begin_checkout') AS checkout_events,
               count(*) FILTER (event_name = 'purchase') AS purchase_events,
               count(DISTINCT item_id) FILTER (event_name = 'view_item') AS distinct_items_viewed,
               count(DISTINCT item_id) FILTER (event_name = 'purchase') AS distinct_items_purchased,
               count(DISTINCT transaction_id) FILTER (event_name = 'purchase') AS orders_count,
               coalesce(sum(quantity) FILTER (event_name = 'purchase'), 0)::bigint AS units_purchased,
               coalesce(sum(revenue_cents) FILTER (event_name = 'purchase'), 0) / 100.0::double AS monetary_total,
               max(event_date) FILTER (event_name = 'purchase') AS last_purchase_date,
               (SELECT max(event_date) FROM ga) AS data_anchor_date
        FROM ga GROUP BY user_pseudo_id)""")
view("ga_shards", """
  SELECT event_date, user_pseudo_id, ga_session_id, min(event_ts_micros) AS first_event_ts_micros,
         max(event_ts_micros) AS last_event_ts_micros, count(*) AS events_count,
         count(*) FILTER (event_name = 'page_view') AS pageviews_count,
         bool_or(event_name = 'session_start') AS had_session_start,
         arg_min(source, (event_ts_micros, event_id)) FILTER (source IS NOT NULL) AS first_source,
         arg_min(medium, (event_ts_micros, event_id)) FILTER (medium IS NOT NULL) AS first_medium,
         arg_min(campaign, (event_ts_micros, event_id)) FILTER (campaign IS NOT NULL) AS first_campaign,
         max(device_category) AS device_category, max(geo_country) AS geo_country
  FROM ga_raw GROUP BY ALL""")
view("ga_touches", """
  SELECT s.user_pseudo_id, s.ga_session_id, s.session_date, s.session_start_micros, s.session_end_micros,
         s.events_count, s.pageviews_count, s.had_session_start,
         coalesce(f.first_source, '(direct)') AS session_source, coalesce(f.first_medium, '(none)') AS session_medium,
         f.first_campaign AS session_campaign, f.device_category
  FROM (SELECT user_pseudo_id, ga_session_id, min(event_date) AS session_date,
               min(first_event_ts_micros) AS session_start_micros, max(last_event_ts_micros) AS session_end_micros,
               sum(events_count)::bigint AS events_count, sum(pageviews_count)::bigint AS pageviews_count,
               bool_or(had_session_start) AS had_session_start
        FROM ga_shards WHERE ga_session_id IS NOT NULL GROUP BY ALL) s
  JOIN ga_shards f ON f.user_pseudo_id = s.user_pseudo_id AND f.ga_session_id = s.ga_session_id
       AND f.event_date = s.session_date""")


def ga(t: Tables):
    return commerce.funnel_extract(adapters.commerce_raw(t))


def touches(t: Tables):
    return commerce.session_touches(commerce.touch_shards(adapters.commerce_raw(t)))


_GA = """SELECT event_date::varchar AS event_date, event_ts_micros, event_ts, event_name, user_pseudo_id, item_id,
    ga_session_id, transaction_id, device_category, geo_country, first_touch_source, first_touch_medium, item_name,
    item_category, price, quantity, revenue_cents / 100.0::double AS item_revenue,
    'ga4_' || strftime(event_date, '%Y%m%d') AS ingestion_id FROM ga"""


@query("funnel_extract", _GA)
def funnel_extract(t: Tables):
    return ga(t)


@query("single_day_extract", _GA + " WHERE event_date = date '2024-01-15'")
def single_day_extract(t: Tables):
    day = t.within("events", "ts", "2024-01-15 00:00:00", "2024-01-16 00:00:00")  # a filter on the derived date wouldn't reach the scan
    return commerce.single_day(adapters.commerce_raw(day), "2024-01-15")


@query("user_item_interactions", """
  SELECT user_pseudo_id, item_id, event_name, event_date::varchar AS event_date, count(*) AS interaction_count,
         count(DISTINCT ga_session_id) AS sessions_count, coalesce(sum(quantity), 0)::bigint AS total_quantity,
         coalesce(sum(revenue_cents), 0) / 100.0::double AS total_revenue,
         min(event_ts) AS first_event_ts, max(event_ts) AS last_event_ts
  FROM ga GROUP BY ALL""")
def user_item_interactions(t: Tables):
    return commerce.interactions(ga(t))


@query("item_catalog", """
  SELECT * REPLACE (first_seen_date::varchar AS first_seen_date, last_seen_date::varchar AS last_seen_date),
         round((users_carted / nullif(users_viewed, 0)::double)::decimal(38,12), 4)::double AS view_to_cart_user_rate,
         round((users_purchased / nullif(users_carted, 0)::double)::decimal(38,12), 4)::double AS cart_to_purchase_user_rate,
         round((users_purchased / nullif(users_viewed, 0)::double)::decimal(38,12), 4)::double AS view_to_purchase_user_rate
  FROM ga_catalog""")
def item_catalog(t: Tables):
    return commerce.item_catalog(ga(t))


@query("ga_sessions", "SELECT * REPLACE (session_date::varchar AS session_date) FROM ga_sessions")
def ga_sessions(t: Tables):
    return commerce.sessions(ga(t))


@query("user_rfm", """
  SELECT * REPLACE (first_seen_date::varchar AS first_seen_date, last_seen_date::varchar AS last_seen_date,
                    last_purchase_date::varchar AS last_purchase_date, data_anchor_date::varchar AS data_anchor_date)
  FROM ga_rfm""")
def user_rfm(t: Tables):
    return commerce.user_rfm(ga(t))


@query("dq_events", """
  SELECT 'amounts_non_negative' AS check_name, count(*) FILTER (price < 0 OR quantity < 0 OR revenue_cents < 0) AS offending_rows FROM ga
  UNION ALL SELECT 'event_date_in_window', count(*) FILTER (event_date NOT BETWEEN date '2024-01-02' AND date '2024-01-29') FROM ga
  UNION ALL SELECT 'purchase_revenue_coverage', CASE WHEN count(*) FILTER (event_name = 'purchase' AND revenue_cents IS NULL)
      > 0.9 * count(*) FILTER (event_name = 'purchase') THEN 1 ELSE 0 END::bigint FROM ga
  UNION ALL SELECT 'unique_events', count(*) FROM (SELECT 1 FROM ga GROUP BY user_pseudo_id, event_ts_micros, event_name, item_id HAVING count(*) > 1)
  UNION ALL SELECT 'unique_sessions', count(*) FROM (SELECT 1 FROM ga_sessions GROUP BY user_pseudo_id, ga_session_id HAVING count(*) > 1)
  UNION ALL SELECT 'session_flag_consistency', count(*) FILTER (did_purchase <> (items_purchased > 0)) FROM ga_sessions""")
def dq_events(t: Tables):
    """The date window is narrower than the data, so that check has something to count."""
    events = ga(t)
    return commerce.violations(events, commerce.sessions(events), "2024-01-02", "2024-01-29")


@query("session_touch_shards", "SELECT * REPLACE (event_date::varchar AS event_date) FROM ga_shards")
def session_touch_shards(t: Tables):
    return commerce.touch_shards(adapters.commerce_raw(t))


@query("session_touches", "SELECT * REPLACE (session_date::varchar AS session_date) FROM ga_touches")
def session_touches(t: Tables):
    return touches(t)
