"""Queries: funnel, growth, attribution, baskets, churn, retention."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.catalog.commerce import ga, touches
from tidemark.plans import commerce, growth
from tidemark.registry import query, view
from tidemark.sources.tables import Tables

view("fn_facts", """
  SELECT t.*, coalesce(s.did_view, false) AS did_view, coalesce(s.did_cart, false) AS did_cart,
         coalesce(s.did_checkout, false) AS did_checkout, coalesce(s.did_purchase, false) AS did_purchase
  FROM ga_touches t LEFT JOIN ga_sessions s USING (user_pseudo_id, ga_session_id)""")
view("fn_top", """
  SELECT session_source FROM ga_touches GROUP BY 1 ORDER BY count(*) DESC, session_source LIMIT 8""")
view("fn_seg", """
  SELECT f.*, 'all' AS segment_type, 'all' AS segment_value FROM fn_facts f
  UNION ALL SELECT f.*, 'device', f.device_category FROM fn_facts f
  UNION ALL SELECT f.*, 'source', CASE WHEN f.session_source IN (SELECT session_source FROM fn_top)
                   THEN f.session_source ELSE '(other)' END FROM fn_facts f""")
view("fn_base", """
  SELECT 'session' AS basis, * FROM fn_seg
  UNION ALL
  SELECT 'user', * FROM (SELECT * EXCLUDE (uv, uc, uk, up, rn)
      REPLACE (uv AS did_view, uc AS did_cart, uk AS did_checkout, up AS did_purchase) FROM (
        SELECT *, bool_or(did_view) OVER u AS uv, bool_or(did_cart) OVER u AS uc, bool_or(did_checkout) OVER u AS uk,
               bool_or(did_purchase) OVER u AS up,
               row_number() OVER (PARTITION BY segment_type, segment_value, user_pseudo_id ORDER BY ga_session_id) AS rn
        FROM fn_seg WINDOW u AS (PARTITION BY segment_type, segment_value, user_pseudo_id)) WHERE rn = 1)""")
view("fn_steps", """
  SELECT basis, segment_type, segment_value, step_order, step_name, count(*) FILTER (hit) AS reached_count
  FROM (SELECT basis, segment_type, segment_value, unnest([0, 1, 2, 3, 4]) AS step_order,
               unnest(['sessions', 'view_item', 'add_to_cart', 'begin_checkout', 'purchase']) AS step_name,
               unnest([true, did_view, did_cart, did_checkout, did_purchase]) AS hit FROM fn_base)
  GROUP BY ALL""")


def facts(t: Tables):
    events = ga(t)
    return growth.session_facts(touches(t), commerce.sessions(events)), events


@query("funnel", """
  SELECT basis, segment_type, segment_value, step_order::bigint AS step_order, step_name, reached_count, prev_count,
         step_conversion_rate::double AS step_conversion_rate, drop_off_rate::double AS drop_off_rate, users_lost,
         overall_share, is_bottleneck,
         CASE WHEN is_bottleneck THEN rank() OVER (PARTITION BY basis, segment_type, segment_value, is_bottleneck
              ORDER BY users_lost DESC) END AS bottleneck_rank
  FROM (SELECT *, round((reached_count / nullif(prev_count, 0)::double)::decimal(38,12), 4)::double AS step_conversion_rate,
               round((1.0 - reached_count / nullif(prev_count, 0)::double)::decimal(38,12), 4)::double AS drop_off_rate,
               prev_count - reached_count AS users_lost,
               round((reached_count / nullif(entry, 0)::double)::decimal(38,12), 4)::double AS overall_share,
               coalesce(round((1.0 - reached_count / nullif(prev_count, 0)::double)::decimal(38,12), 4) >= 0.40, false) AS is_bottleneck
        FROM (SELECT *, lag(reached_count) OVER w AS prev_count, first(reached_count) OVER w AS entry
              FROM fn_steps WINDOW w AS (PARTITION BY basis, segment_type, segment_value ORDER BY step_order)))""")
def funnel(t: Tables):
    return growth.funnel(facts(t)[0])


@query("funnel_daily", """
  SELECT event_date::varchar AS event_date, step_order::bigint AS step_order, reached_count,
         round((reached_count / nullif(prev_count, 0)::double)::decimal(38,12), 4)::double AS step_conversion_rate,
         round((1.0 - reached_count / nullif(prev_count, 0)::double)::decimal(38,12), 4)::double AS drop_off_rate,
         CASE WHEN step_order = 4 THEN round((reached_count / nullif(entry, 0)::double)::decimal(38,12), 4)::double END AS overall_cvr
  FROM (SELECT *, lag(reached_count) OVER w AS prev_count, first(reached_count) OVER w AS entry
        FROM (SELECT event_date, step_order, count(*) FILTER (hit) AS reached_count
              FROM (SELECT session_date AS event_date, unnest([0, 1, 2, 3, 4]) AS step_order,
                           unnest([true, did_view, did_cart, did_checkout, did_purchase]) AS hit FROM fn_facts)
              GROUP BY ALL) WINDOW w AS (PARTITION BY event_date ORDER BY step_order))""")
def funnel_daily(t: Tables):
    return growth.funnel_daily(facts(t)[0])


view("kpi_base", """
  SELECT v.event_date, sessions_count, users_count, buying_sessions, coalesce(buyers_count, 0) AS buyers_count,
         coalesce(orders_count, 0) AS orders_count, coalesce(cents, 0) / 100.0::double AS revenue,
         round((cents / 100.0::double / nullif(orders_count, 0))::decimal(38,12), 2)::double AS aov,
         round((buying_sessions / sessions_count::double)::decimal(38,12), 4)::double AS cvr
  FROM (SELECT session_date AS event_date, count(*) AS sessions_count, count(DISTINCT user_pseudo_id) AS users_count,
               count(*) FILTER (did_purchase) AS buying_sessions FROM fn_facts GROUP BY 1) v
  LEFT JOIN (SELECT event_date, count(DISTINCT user_pseudo_id) AS buyers_count, count(DISTINCT transaction_id) AS orders_count,
                    sum(revenue_cents)::bigint AS cents FROM ga WHERE event_name = 'purchase' GROUP BY 1) s USING (event_date)""")


def _rolling(metric: str) -> str:
    short = metric.removesuffix("_count")
    m, s = f"avg({metric}) OVER w", f"stddev_samp({metric}::double) OVER w"
    r = lambda e: f"round(({e})::decimal(38,12), 4)::double"
    z = r(f"({metric} - {m}) / nullif(round({s}, 9), 0)")
    return (f"{r(m)} AS {short}_rolling_mean_7d, {r(s)} AS {short}_rolling_std_7d, {z} AS {short}_z_score, "
            f"coalesce(abs({z}) > 2, false) AS {short}_is_anomaly, {r(f'{m} + 2 * {s}')} AS {short}_upper_bound, "
            f"{r(f'{m} - 2 * {s}')} AS {short}_lower_bound")


@query("kpi_daily_anomaly", f"""
  SELECT * REPLACE (event_date::varchar AS event_date), {_rolling('revenue')}, {_rolling('orders_count')}, {_rolling('cvr')}
  FROM kpi_base WINDOW w AS (ORDER BY event_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""")
def kpi_daily_anomaly(t: Tables):
    return growth.kpi_daily(*facts(t))


@query("period_compare", """
  WITH p AS (SELECT strftime(event_date, '%Y-%m') || '-' || ((day(event_date) - 1) // 10) AS cp,
                    sum(sessions_count)::double AS s1, sum(orders_count)::double AS o1,
                    sum(revenue::decimal(18,2))::double AS r1 FROM kpi_base GROUP BY 1),
  q AS (SELECT *, lag(cp) OVER w AS bp, lag(s1) OVER w AS s0, lag(o1) OVER w AS o0, lag(r1) OVER w AS r0
        FROM p WINDOW w AS (ORDER BY cp)),
  x AS (SELECT *, o0 / s0 AS c0, o1 / s1 AS c1, r0 / o0 AS a0, r1 / o1 AS a1 FROM q WHERE bp IS NOT NULL)
  SELECT cp AS current_period, bp AS compare_period, s0 AS sessions_0, s1 AS sessions_1,
         round(c0::decimal(38,12), 6)::double AS cvr_0, round(c1::decimal(38,12), 6)::double AS cvr_1,
         round(a0::decimal(38,12), 2)::double AS aov_0, round(a1::decimal(38,12), 2)::double AS aov_1,
         round(r0::decimal(38,12), 2)::double AS revenue_0, round(r1::decimal(38,12), 2)::double AS revenue_1,
         round((r1 - r0)::decimal(38,12), 2)::double AS revenue_diff,
         round(((s1 - s0) * c0 * a0)::decimal(38,12), 2)::double AS effect_traffic,
         round((s1 * (c1 - c0) * a0)::decimal(38,12), 2)::double AS effect_conversion,
         round((s1 * c1 * (a1 - a0))::decimal(38,12), 2)::double AS effect_aov, true AS conserved
  FROM x""")
def period_compare(t: Tables):
    """Ten-day periods: the tables hold a single month."""
    period = F.concat(F.date_format("event_date", "yyyy-MM"), F.lit("-"),
                      F.floor((F.dayofmonth("event_date") - 1) / 10).cast("string"))
    return growth.period_compare(growth.kpi_daily(*facts(t)), period)


@query("cart_abandonment", """
  SELECT segment_type, segment_value, count(*) AS carted_sessions,
         count(*) FILTER (did_purchase) AS purchased_after_cart_sessions,
         count(*) FILTER (NOT did_purchase) AS abandoned_sessions, count(*) FILTER (did_checkout) AS checkout_reached_sessions,
         sum(cart) FILTER (NOT did_purchase)::double AS abandoned_value_estimate,
         round((count(*) FILTER (NOT did_purchase) / count(*)::double)::decimal(38,12), 4)::double AS abandonment_rate
  FROM (SELECT s.*, c.cart FROM fn_seg s LEFT JOIN (
          SELECT user_pseudo_id, ga_session_id, sum(price::decimal(18,2) * coalesce(quantity, 1)) AS cart FROM ga
          WHERE event_name = 'add_to_cart' AND ga_session_id IS NOT NULL GROUP BY ALL) c USING (user_pseudo_id, ga_session_id)
        WHERE did_cart) GROUP BY ALL""")
def cart_abandonment(t: Tables):
    return growth.cart_abandonment(*facts(t))


view("life_months", """
  SELECT DISTINCT o_custkey AS buyer, (year(o_orderdate) * 12 + month(o_orderdate) - 1)::bigint AS m FROM orders""")
view("life_grid", """
  SELECT g.buyer, g.month, CASE WHEN g.month = f.first_m THEN 'New' WHEN g.month = last_m THEN 'Active'
         ELSE 'Sleeping-' || least(g.month - last_m, 3) END AS stage
  FROM (SELECT b.buyer, c.month, max(p.m) AS last_m
        FROM (SELECT DISTINCT buyer FROM life_months) b
        CROSS JOIN (SELECT unnest(generate_series(min(m), max(m))) AS month FROM life_months) c
        JOIN life_months p ON p.buyer = b.buyer AND p.m <= c.month GROUP BY ALL) g
  JOIN (SELECT buyer, min(m) AS first_m FROM life_months GROUP BY 1) f USING (buyer)""")


@query("lifecycle", """
  SELECT printf('%04d-%02d', month // 12, month % 12 + 1) AS month_key, stage, count(*) AS users_count
  FROM life_grid GROUP BY ALL""")
def lifecycle(t: Tables):
    return growth.lifecycle(t.orders, "o_custkey", "o_orderdate")


@query("lifecycle_transitions", """
  SELECT printf('%04d-%02d', a.month // 12, a.month % 12 + 1) AS from_month, a.stage AS from_stage,
         b.stage AS to_stage, count(*) AS users_count
  FROM life_grid a JOIN life_grid b ON a.buyer = b.buyer AND b.month = a.month + 1 GROUP BY ALL""")
def lifecycle_transitions(t: Tables):
    return growth.lifecycle_transitions(t.orders, "o_custkey", "o_orderdate")


@query("ltv_deciles", """
  SELECT decile, users_count, monetary_sum::double AS monetary_sum, avg_aov, avg_orders,
         round((monetary_sum / sum(monetary_sum) OVER ()::double)::decimal(38,12), 4)::double AS monetary_share,
         round((sum(monetary_sum) OVER (ORDER BY decile) / sum(monetary_sum) OVER ()::double)::decimal(38,12), 4)::double AS cum_share
  FROM (SELECT decile, count(*) AS users_count, sum(monetary_total::decimal(18,2)) AS monetary_sum,
               round((sum(aov::decimal(18,2))::double / count(aov))::decimal(38,12), 2)::double AS avg_aov,
               round((sum(orders_count)::double / count(*))::decimal(38,12), 2)::double AS avg_orders
        FROM (SELECT *, ntile(10) OVER (ORDER BY monetary_total DESC, user_pseudo_id) AS decile FROM ga_rfm
              WHERE orders_count >= 1) GROUP BY 1)""")
def ltv_deciles(t: Tables):
    return growth.ltv_deciles(commerce.user_rfm(ga(t)))


@query("product_pareto", """
  SELECT *, cum_revenue_share <= 0.8 AS in_top80 FROM (
    SELECT item_id, item_name, item_category, revenue_total, users_viewed,
           round((users_purchased / nullif(users_viewed, 0)::double)::decimal(38,12), 4)::double AS view_to_purchase_user_rate,
           rank() OVER (ORDER BY revenue_total DESC) AS revenue_rank,
           round((revenue_total / sum(revenue_total::decimal(18,2)) OVER ()::double)::decimal(38,12), 6)::double AS revenue_share,
           round((sum(revenue_total::decimal(18,2)) OVER (ORDER BY revenue_total DESC, item_id)::double
                  / sum(revenue_total::decimal(18,2)) OVER ()::double)::decimal(38,12), 6)::double AS cum_revenue_share
    FROM ga_catalog)""")
def product_pareto(t: Tables):
    return growth.product_pareto(commerce.item_catalog(ga(t)))


view("at_buys", """
  SELECT user_pseudo_id, transaction_id, max(event_ts_micros) AS p, sum(revenue_cents) / 100.0::double AS revenue
  FROM ga WHERE event_name = 'purchase' AND transaction_id IS NOT NULL GROUP BY ALL""")
view("at_touch", """
  SELECT user_pseudo_id, session_start_micros AS s, ga_session_id, session_source || ' / ' || session_medium AS channel
  FROM ga_touches""")


def _pairs(days: int) -> str:
    return f"""(SELECT b.*, t.s, t.channel, count(t.s) OVER j AS n,
        row_number() OVER (PARTITION BY b.user_pseudo_id, b.transaction_id ORDER BY t.s) AS i,
        pow(2.0, -(b.p - t.s) / {7 * growth.MICROS_PER_DAY}.0::double) AS w,
        sum(pow(2.0, -(b.p - t.s) / {7 * growth.MICROS_PER_DAY}.0::double)) OVER j AS ws
      FROM at_buys b LEFT JOIN at_touch t ON t.user_pseudo_id = b.user_pseudo_id AND t.s <= b.p
           AND t.s >= b.p - {days * growth.MICROS_PER_DAY}
      WINDOW j AS (PARTITION BY b.user_pseudo_id, b.transaction_id))"""


@query("journeys", f"""
  SELECT user_pseudo_id, transaction_id, any_value(revenue) AS revenue, max(n)::bigint AS touches,
         max(channel) FILTER (i = 1) AS first_channel, max(channel) FILTER (i = n) AS last_channel
  FROM {_pairs(10)} GROUP BY 1, 2""")
def journeys(t: Tables):
    """Ten days of lookback, so that the lower edge cuts journeys in a month of data."""
    return growth.journeys(growth.touch_list(touches(t)), growth.conversions(ga(t)), 10)


view("at_models", f"""
  SELECT model, source_medium, round(r::decimal(38,12), 4)::double AS attributed_revenue,
         round(c::decimal(38,12), 4)::double AS attributed_conversions,
         round((r / sum(r) OVER (PARTITION BY model))::decimal(38,12), 4)::double AS revenue_share
  FROM (SELECT m.model, coalesce(channel, '(direct) / (none)') AS source_medium, sum(revenue * weight) AS r, sum(weight) AS c
        FROM (SELECT j.*, unnest(['first_touch', 'last_touch', 'linear', 'time_decay']) AS model,
                     unnest(CASE WHEN n = 0 THEN [1.0::double, 1.0, 1.0, 1.0] ELSE
                       [CASE WHEN i = 1 THEN 1.0::double ELSE 0 END, CASE WHEN i = n THEN 1.0::double ELSE 0 END,
                        1.0::double / n, w / ws] END) AS weight FROM {_pairs(30)} j) m
        WHERE weight > 0 GROUP BY ALL)""")


@query("attribution", "SELECT * FROM at_models")
def attribution(t: Tables):
    return growth.attribution(growth.touch_list(touches(t)), growth.conversions(ga(t)))


@query("attribution_rank_shift", """
  SELECT source_medium, max(rk) FILTER (model = 'first_touch') AS first_touch, max(rk) FILTER (model = 'last_touch') AS last_touch,
         max(rk) FILTER (model = 'linear') AS linear, max(rk) FILTER (model = 'time_decay') AS time_decay,
         max(rk) FILTER (model = 'last_touch') - max(rk) FILTER (model = 'first_touch') AS first_touch_shift,
         max(rk) FILTER (model = 'last_touch') - max(rk) FILTER (model = 'linear') AS linear_shift,
         max(rk) FILTER (model = 'last_touch') - max(rk) FILTER (model = 'time_decay') AS time_decay_shift
  FROM (SELECT *, row_number() OVER (PARTITION BY model ORDER BY attributed_revenue DESC, source_medium) AS rk
        FROM at_models WHERE attributed_revenue > 0) GROUP BY 1""")
def attribution_rank_shift(t: Tables):
    return growth.rank_shift(attribution(t))


view("baskets", "SELECT DISTINCT l_orderkey AS basket, p_brand AS item FROM lineitem JOIN part ON l_partkey = p_partkey")
view("basket_dir", """
  SELECT antecedent, consequent, co AS co_count, co / total AS support, co / na::double AS confidence,
         co * total / (na * nc)::double AS lift
  FROM (SELECT a.item AS antecedent, b.item AS consequent, count(*) AS co FROM baskets a
        JOIN baskets b ON a.basket = b.basket AND a.item <> b.item GROUP BY ALL)
  JOIN (SELECT item AS antecedent, count(*) AS na FROM baskets GROUP BY 1) USING (antecedent)
  JOIN (SELECT item AS consequent, count(*) AS nc FROM baskets GROUP BY 1) USING (consequent)
  CROSS JOIN (SELECT count(DISTINCT basket)::double AS total FROM baskets)""")


def baskets(t: Tables):
    lines = t.lineitem.select("l_orderkey", "l_partkey")
    return (lines.join(t.part.select("p_partkey", "p_brand"), F.col("l_partkey") == F.col("p_partkey"))
            .select(F.col("l_orderkey").alias("basket"), F.col("p_brand").alias("item")).distinct())


_R6 = """antecedent, consequent, co_count, round(support::decimal(38,12), 6)::double AS support,
    round(confidence::decimal(38,12), 6)::double AS confidence, round(lift::decimal(38,12), 6)::double AS lift"""


def _rounded(df):
    from tidemark.functions.numeric import exact_round
    return df.withColumns({c: exact_round(F.col(c), 6) for c in ("support", "confidence", "lift")})


@query("basket_rules", f"""
  SELECT {_R6} FROM (SELECT * FROM basket_dir WHERE support >= 0.01 AND confidence >= 0.15
    ORDER BY lift DESC, antecedent, consequent LIMIT 100)""")
def basket_rules(t: Tables):
    """The default confidence of 0.3 leaves no rule in these baskets, so 0.15 is asked for."""
    return _rounded(growth.basket_rules(baskets(t), min_confidence=0.15))


@query("fbt_rules", f"""
  SELECT {_R6}, rule_rank FROM (
    SELECT *, row_number() OVER (PARTITION BY antecedent ORDER BY lift DESC, co_count DESC, consequent) AS rule_rank
    FROM basket_dir WHERE co_count >= 5 AND confidence >= 0.05 AND lift > 1) WHERE rule_rank <= 20""")
def fbt_rules(t: Tables):
    return _rounded(growth.bought_together(baskets(t)))


view("churn_data", """
  SELECT user_pseudo_id, (date '2024-01-28' - last_buy) AS recency_obs, frequency_obs, monetary_obs, active_days_obs,
         cart_events_obs, view_events_obs, round((monetary_obs / frequency_obs)::decimal(38,12), 2)::double AS aov_obs,
         CASE WHEN later = 0 THEN 1 ELSE 0 END::bigint AS churned
  FROM (SELECT user_pseudo_id, max(event_date) FILTER (b AND o) AS last_buy,
               count(DISTINCT transaction_id) FILTER (b AND o) AS frequency_obs,
               coalesce(sum(revenue_cents) FILTER (b AND o), 0) / 100.0::double AS monetary_obs,
               count(DISTINCT event_date) FILTER (o) AS active_days_obs,
               count(*) FILTER (o AND event_name = 'add_to_cart') AS cart_events_obs,
               count(*) FILTER (o AND event_name = 'view_item') AS view_events_obs, count(*) FILTER (b AND NOT o) AS later
        FROM (SELECT *, event_name = 'purchase' AS b, event_date <= date '2024-01-28' AS o FROM ga
              WHERE event_date <= date '2024-01-30') GROUP BY 1) WHERE frequency_obs > 0""")


def churn_data(t: Tables):
    return growth.churn_dataset(ga(t), "2024-01-28", 2)


@query("churn_dataset", "SELECT * REPLACE (recency_obs::bigint AS recency_obs) FROM churn_data")
def churn_dataset(t: Tables):
    return churn_data(t)


@query("churn_scores")
def churn_scores(t: Tables):
    return growth.churn_scores(churn_data(t))


@query("decile_lift", """
  SELECT decile, users_count, positives::bigint AS positives,
         round((positives / users_count::double)::decimal(38,12), 4)::double AS rate,
         round((positives / users_count::double / (sum(positives) OVER () / sum(users_count) OVER ()::double))::decimal(38,12), 4)::double AS lift
  FROM (SELECT decile, count(*) AS users_count, sum(churned) AS positives
        FROM (SELECT *, ntile(10) OVER (ORDER BY recency_obs DESC, user_pseudo_id) AS decile FROM churn_data) GROUP BY 1)""")
def decile_lift(t: Tables):
    return growth.decile_lift(churn_data(t), "recency_obs", "churned", "user_pseudo_id")


@query("retention", """
  SELECT cohort_week::varchar AS cohort_week, ((week - cohort_week) // 7)::bigint AS week_offset, count(*) AS users_count
  FROM (SELECT *, min(week) OVER (PARTITION BY user_pseudo_id) AS cohort_week
        FROM (SELECT DISTINCT user_pseudo_id, date_trunc('week', event_date)::date AS week FROM ga)) GROUP BY ALL""")
def retention(t: Tables):
    return growth.retention(ga(t))
