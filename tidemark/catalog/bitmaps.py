"""Queries: distinct users, retention and step funnels from stored daily bitmaps."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.catalog.commerce import ga
from tidemark.operators.user_bitmaps import UserBitmaps
from tidemark.plans.commerce import FUNNEL
from tidemark.registry import query
from tidemark.session import cut
from tidemark.sources.tables import Tables

HALF = "2024-01-16"


def kept(t: Tables) -> UserBitmaps:
    """Two batches of days; the second one brings users that the first has numbered and new ones."""
    rows = cut(ga(t).select(F.col("user_pseudo_id").alias("user"), F.col("event_date").alias("day"), F.col("event_name").alias("event")).distinct())
    bitmaps = UserBitmaps(t.spark)
    bitmaps.add(rows.where(F.col("day") < F.lit(HALF).cast("date")))
    bitmaps.add(rows.where(F.col("day") >= F.lit(HALF).cast("date")))
    return bitmaps


@query("retention_bitmaps", """
  SELECT cohort_week::varchar AS cohort_week, ((week - cohort_week) // 7)::bigint AS week_offset, count(*) AS users_count
  FROM (SELECT *, min(week) OVER (PARTITION BY user_pseudo_id) AS cohort_week
        FROM (SELECT DISTINCT user_pseudo_id, date_trunc('week', event_date)::date AS week FROM ga)) GROUP BY ALL""")
def retention_bitmaps(t: Tables):
    return kept(t).retention()


@query("rolling_users", """
  SELECT strftime(d.day, '%Y-%m-%d') AS day, event_name AS event, count(DISTINCT user_pseudo_id) AS users_count
  FROM (SELECT DISTINCT event_date AS day FROM ga) d JOIN ga ON event_date BETWEEN d.day - 6 AND d.day GROUP BY 1, 2""")
def rolling_users(t: Tables):
    """Distinct users of each event in the seven days up to every day."""
    return kept(t).rolling(7)


@query("user_steps", f"""
  SELECT s.step_order::bigint AS step_order, s.step, count(u.user_pseudo_id) FILTER (u.n >= s.step_order) AS users_count
  FROM (SELECT unnest([1, 2, 3, 4]) AS step_order, unnest({FUNNEL}) AS step) s,
       (SELECT user_pseudo_id, CASE WHEN NOT v THEN 0 WHEN NOT c THEN 1 WHEN NOT k THEN 2 WHEN NOT p THEN 3 ELSE 4 END AS n FROM (
          SELECT user_pseudo_id, bool_or(event_name = 'view_item') AS v, bool_or(event_name = 'add_to_cart') AS c,
                 bool_or(event_name = 'begin_checkout') AS k, bool_or(event_name = 'purchase') AS p FROM ga GROUP BY 1)) u GROUP BY 1, 2""")
def user_steps(t: Tables):
    """Users with a step's event and those of all steps before it."""
    return kept(t).all_of(FUNNEL)
