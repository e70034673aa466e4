"""Queries: event-time features from a replayed stream, checked against batch recomputation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from tidemark.catalog.commerce import ga
from tidemark.operators.scalars import attach
from tidemark.operators.sessions import overlaps, sessionize
from tidemark.plans import commerce
from tidemark.registry import query, view
from tidemark.session import cut
from tidemark.sources.store import keyed_table
from tidemark.sources.tables import Tables
from tidemark.streaming import events as ev

HALF = "2024-01-16 00:00:00"
STATE_PARTITIONS = 8  # of the replays here, which hold one month of a sample; a parameter of each replay

view("st_user_cat", """
  SELECT user_pseudo_id, item_category, w AS window_end, count(*) AS view_count_5m
  FROM (SELECT *, unnest([date_trunc('minute', event_ts) + to_minutes(i) FOR i IN [1, 2, 3, 4, 5]]) AS w FROM ga
        WHERE event_name = 'view_item' AND item_category IS NOT NULL) GROUP BY ALL""")
view("st_item", """
  SELECT item_id, w AS window_end, count(*) AS pop_15m, count(*) FILTER (event_name = 'purchase') AS purchase_15m
  FROM (SELECT *, unnest([date_trunc('minute', event_ts) + to_minutes(i) FOR i IN generate_series(1, 15)]) AS w FROM ga)
  GROUP BY ALL""")
view("st_marked", """
  SELECT *, sum(is_start) OVER (PARTITION BY user_pseudo_id ORDER BY event_ts_micros RANGE UNBOUNDED PRECEDING) AS sid
  FROM (SELECT *, CASE WHEN event_ts_micros - lag(event_ts_micros) OVER (PARTITION BY user_pseudo_id
               ORDER BY event_ts_micros, event_name, item_id) <= 1800000000 THEN 0 ELSE 1 END AS is_start FROM ga)""")
view("st_sessions", """
  SELECT user_pseudo_id, min(event_ts) AS session_start_ts, max(event_ts) AS session_end_ts, count(*) AS events_count,
         count(DISTINCT item_id) FILTER (event_name = 'add_to_cart') AS items_carted,
         count(DISTINCT item_id) FILTER (event_name = 'purchase') AS items_purchased,
         coalesce(sum(revenue_cents) FILTER (event_name = 'purchase'), 0) / 100.0::double AS session_revenue,
         len(list_filter(coalesce(list(DISTINCT item_id) FILTER (event_name = 'add_to_cart'), []),
             lambda x: NOT list_contains(coalesce(list(DISTINCT item_id) FILTER (event_name = 'purchase'), []), x))) AS cart_pending_final
  FROM st_marked GROUP BY user_pseudo_id, sid""")


def _messages(t: Tables) -> tuple[DataFrame, DataFrame]:
    events = cut(ga(t))
    return events, ev.messages(events)


def _replayed(t: Tables, name: str, features, cuts=(HALF,)) -> DataFrame:
    return ev.Replay(t.spark, name, state_partitions=STATE_PARTITIONS).replay(_messages(t)[1], lambda raw: features(ev.real(ev.clean(raw))), cuts)


@query("stream_source")
def stream_source(t: Tables):
    """Good, bad and repeated messages as the source counts them."""
    _, rows = _messages(t)
    broken = rows.where(F.crc32("value") % 100 == 0).withColumn("value", F.substring("value", 1, 40))
    replay = ev.Replay(t.spark, "source", state_partitions=STATE_PARTITIONS)
    replay.send(rows.unionByName(broken), "chunk-0000")
    out = ev.parse(t.spark.read.text(f"{replay.inbox}/*"))
    bad = t.spark.read.text(f"{replay.inbox}/*").where(F.from_json("value", ev.MESSAGE)["event_ts_micros"].isNull())
    return out.agg(F.count(F.lit(1)).alias("good"), F.count_if("_replay.duplicate").alias("copies")).transform(attach, bad.agg(F.count(F.lit(1)).alias("bad")))


@query("stream_dedup", """
  SELECT user_pseudo_id, event_ts_micros, event_name, item_id FROM ga""")
def stream_dedup(t: Tables):
    return _replayed(t, "dedup", lambda e: e.select(*ev.KEY))


@query("stream_watermark", """
  SELECT time_bucket(INTERVAL 1 HOUR, event_ts) AS hour_start, event_name, count(*) AS events FROM ga GROUP BY ALL""")
def stream_watermark(t: Tables):
    """Tumbling hours under a thirty-second watermark; every closed hour is emitted once."""
    return _replayed(t, "watermark", lambda e: e.groupBy(F.window("event_ts", "1 hour").alias("w"), "event_name")
                     .agg(F.count(F.lit(1)).alias("events")).select(F.col("w.start").alias("hour_start"), "event_name", "events"))


@query("stream_late", """
  SELECT count(*) FILTER (event_ts >= timestamp '2024-01-16') AS kept, count(*) FILTER (event_ts < timestamp '2024-01-16') AS late FROM ga""")
def stream_late(t: Tables):
    """The later half first: the earlier half is then late, counted, and kept out of the result."""
    events, _ = _messages(t)
    rows = ev.messages(events, duplicate_percent=0)
    replay, features = ev.Replay(t.spark, "late", state_partitions=STATE_PARTITIONS), lambda raw: ev.real(ev.clean(raw)).select(*ev.KEY)
    at = F.timestamp_micros("event_ts_micros")
    replay.send(rows.where(at >= F.lit(HALF).cast("timestamp")), "chunk-0000")
    replay.run(features)
    replay.send(rows.where(at < F.lit(HALF).cast("timestamp")), "chunk-0001")
    schema = replay.run(features)
    kept = t.spark.read.schema(schema).parquet(replay.out)
    return kept.agg(F.count(F.lit(1)).alias("kept")).withColumn("late", F.lit(replay.late_rows()).cast("long"))


@query("sliding_user_category", "SELECT * FROM st_user_cat")
def sliding_user_category(t: Tables):
    return _replayed(t, "user-category", ev.views_by_user_category)


@query("sliding_item", "SELECT * FROM st_item")
def sliding_item(t: Tables):
    """Sliding counts from the panes that the stream keeps."""
    return ev.heat_of_panes(_replayed(t, "item", ev.item_panes))


@query("session_agg", "SELECT * FROM st_sessions")
def session_agg(t: Tables):
    return _replayed(t, "session", ev.session_windows)


@query("live_session", f"""
  WITH step AS (
    SELECT *, CASE WHEN event_name = 'add_to_cart' AND coalesce(before, '') <> 'add_to_cart' THEN 1
                   WHEN event_name = 'purchase' AND before = 'add_to_cart' THEN -1 ELSE 0 END AS delta
    FROM (SELECT *, CASE WHEN event_name IN ('add_to_cart', 'purchase') THEN lag(event_name) OVER (
              PARTITION BY user_pseudo_id, sid, item_id, event_name IN ('add_to_cart', 'purchase')
              ORDER BY event_ts_micros, event_name) END AS before FROM st_marked))
  SELECT user_pseudo_id, event_ts_micros, event_name, item_id, row_number() OVER s AS session_events,
         (sum(delta) OVER (s ROWS UNBOUNDED PRECEDING))::bigint AS session_cart_pending,
         min(event_ts_micros) OVER (PARTITION BY user_pseudo_id, sid) AS session_started_micros
  FROM step WINDOW s AS (PARTITION BY user_pseudo_id, sid ORDER BY event_ts_micros, event_name, item_id)
  UNION ALL
  SELECT user_pseudo_id, max(event_ts_micros), '{ev.CLEARED}', NULL, 0, 0, min(event_ts_micros)
  FROM st_marked GROUP BY user_pseudo_id, sid""")
def live_session(t: Tables):
    return _replayed(t, "live", ev.live_sessions)


@query("rt_user_features", """
  WITH w AS (SELECT *, unnest([time_bucket(INTERVAL 10 MINUTE, event_ts) + to_minutes(10 * i) FOR i IN generate_series(1, 6)]) AS window_end FROM ga),
  c AS (SELECT user_pseudo_id, window_end, item_category, count(*) AS n FROM w
        WHERE event_name = 'view_item' AND item_category IS NOT NULL GROUP BY ALL),
  top AS (SELECT user_pseudo_id, window_end, arg_min(item_category, (-n, item_category)) AS top_cat_1h, max(n) AS n FROM c GROUP BY ALL)
  SELECT user_pseudo_id, window_end, count(*) FILTER (event_name = 'view_item') AS views_1h,
         count(*) FILTER (event_name = 'add_to_cart') AS carts_1h,
         count(*) FILTER (event_ts >= window_end - INTERVAL 30 MINUTE) AS events_30m,
         any_value(top_cat_1h) AS top_cat_1h, coalesce(any_value(n), 0) AS top_cat_views_1h,
         arg_max(item_id, (event_ts_micros, event_name, item_id)) AS last_item_id,
         arg_max(event_name, (event_ts_micros, event_name, item_id)) AS last_event_name,
         max(event_ts_micros) // 1000 AS last_event_ts_ms, max(event_ts_micros) // 1000 AS rt_updated_at_ms
  FROM w LEFT JOIN top USING (user_pseudo_id, window_end) GROUP BY ALL""")
def rt_user_features(t: Tables):
    return _replayed(t, "features", ev.user_features)


@query("stream_sink_idempotent", """
  SELECT user_pseudo_id, arg_max(item_id, (event_ts_micros, event_name, item_id)) AS last_item_id,
         max(event_ts_micros) AS last_event_ts_micros FROM ga GROUP BY 1""")
def stream_sink_idempotent(t: Tables):
    """Newest values per user through the keyed sink; the whole stream is written twice."""
    _, rows = _messages(t)
    table = keyed_table(t.spark, "latest", "user_pseudo_id", buckets=4)
    order = F.struct("event_ts_micros", "event_name", "item_id")
    write = ev.keyed_sink(table, ["user_pseudo_id"], "at")

    def newest(batch: DataFrame, batch_id: int) -> None:
        write(batch.select("user_pseudo_id", order.alias("at")), batch_id)

    for name in ("first", "again"):
        ev.Replay(t.spark, name, state_partitions=STATE_PARTITIONS).replay(rows, lambda raw: ev.real(ev.clean(raw)), (HALF,), newest)
    return table.read().select("user_pseudo_id", F.col("at.item_id").alias("last_item_id"),
                               F.col("at.event_ts_micros").alias("last_event_ts_micros"))


def _mismatch(stream: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """Full outer comparison on all columns: rows that agree, differ, or are on one side only."""
    values = [c for c in batch.columns if c not in keys]
    side = lambda df, n: df.select(*keys, F.struct(*[F.col(v).cast("string") for v in values]).alias(n))
    both = side(stream, "s").join(side(batch, "b"), keys, "full_outer")
    return both.agg(
        F.count_if(F.col("s").eqNullSafe(F.col("b"))).alias("equal_rows"),
        F.count_if(F.col("s").isNotNull() & F.col("b").isNotNull() & ~F.col("s").eqNullSafe(F.col("b"))).alias("different_rows"),
        F.count_if(F.col("b").isNull()).alias("stream_only"), F.count_if(F.col("s").isNull()).alias("batch_only"))


@query("verify_windows", """
  SELECT 'sliding_item' AS check_name, count(*) AS equal_rows, 0::bigint AS different_rows, 0::bigint AS stream_only, 0::bigint AS batch_only FROM st_item
  UNION ALL SELECT 'sliding_user_category', count(*), 0, 0, 0 FROM st_user_cat""")
def verify_windows(t: Tables):
    """Streamed windows against the same windows recomputed in batch. Windows are [start, end) on both sides."""
    events, rows = _messages(t)
    parts = []
    for name, features, keys in (("sliding_item", ev.item_heat, ["item_id", "window_end"]),
                                 ("sliding_user_category", ev.views_by_user_category, ["user_pseudo_id", "item_category", "window_end"])):
        streamed = ev.Replay(t.spark, name, state_partitions=STATE_PARTITIONS).replay(rows, lambda raw: features(ev.real(ev.clean(raw))), (HALF,))
        parts.append(_mismatch(streamed, features(events), keys).withColumn("check_name", F.lit(name)))
    return reduce(DataFrame.unionByName, parts)


def batch_sessions(events: DataFrame) -> DataFrame:
    """Gaps and islands over the stored events, the second way to the same sessions."""
    rows = sessionize(events, ["user_pseudo_id"], "event_ts", 1800, "session_start_ts")
    only = lambda e: F.collect_set(F.when(F.col("event_name") == e, F.col("item_id")))
    revenue = F.when(F.col("event_name") == "purchase", F.coalesce("item_revenue", F.lit(0))).otherwise(0)
    return rows.groupBy("user_pseudo_id", "session_start_ts").agg(
        F.max("event_ts").alias("session_end_ts"), F.count(F.lit(1)).alias("events_count"),
        F.size(only("add_to_cart")).alias("items_carted"), F.size(only("purchase")).alias("items_purchased"),
        F.size(F.array_except(only("add_to_cart"), only("purchase"))).alias("cart_pending_final"),
        F.sum(revenue).cast("decimal(28,2)").alias("session_revenue"))


@query("verify_sessions", """
  SELECT count(*) AS equal_rows, 0::bigint AS different_rows, 0::bigint AS stream_only, 0::bigint AS batch_only FROM st_sessions""")
def verify_sessions(t: Tables):
    events, rows = _messages(t)
    streamed = ev.Replay(t.spark, "sessions", state_partitions=STATE_PARTITIONS).replay(rows, lambda raw: ev.session_windows(ev.real(ev.clean(raw))), (HALF,))
    columns = ["user_pseudo_id", "session_start_ts", "session_end_ts", "events_count", "items_carted",
               "items_purchased", "cart_pending_final", "session_revenue"]
    return _mismatch(streamed.select(*columns), batch_sessions(events).select(*columns), columns[:2])


@query("session_pairing", """
  WITH p AS (SELECT s.user_pseudo_id, s.session_start_ts AS a, g.ga_session_id AS b FROM st_sessions s
             JOIN ga_sessions g ON g.user_pseudo_id = s.user_pseudo_id AND s.session_start_ts <= g.session_end_ts
                  AND g.session_start_ts <= s.session_end_ts),
  k AS (SELECT *, count(*) OVER (PARTITION BY user_pseudo_id, a) AS na, count(*) OVER (PARTITION BY user_pseudo_id, b) AS nb FROM p)
  SELECT CASE WHEN na = 1 AND nb = 1 THEN 'one_to_one' WHEN nb > 1 AND na = 1 THEN 'split' WHEN na > 1 AND nb = 1 THEN 'merge' ELSE 'mixed' END AS pairing,
         count(*) AS pairs FROM k GROUP BY 1""")
def session_pairing(t: Tables):
    """How rule-made sessions overlap the source's own sessions."""
    events = cut(ga(t))
    mine = batch_sessions(events).withColumn("id", F.unix_micros("session_start_ts").cast("string"))
    theirs = commerce.sessions(events).withColumn("id", F.col("ga_session_id").cast("string"))
    pairs = overlaps(mine, theirs, "user_pseudo_id", "session_start_ts", "session_end_ts", "id", "id")
    per = lambda side, n: pairs.groupBy("user_pseudo_id", f"{side}_id").agg(F.count(F.lit(1)).alias(n))
    counted = (pairs.join(per("left", "na"), ["user_pseudo_id", "left_id"]).join(per("right", "nb"), ["user_pseudo_id", "right_id"]))
    kind = (F.when((F.col("na") == 1) & (F.col("nb") == 1), "one_to_one").when(F.col("na") == 1, "split")
            .when(F.col("nb") == 1, "merge").otherwise("mixed"))
    return counted.groupBy(kind.alias("pairing")).agg(F.count(F.lit(1)).alias("pairs"))


@query("backfill_invariance", "SELECT count(*) AS equal_rows, 0::bigint AS different_rows, 0::bigint AS stream_only, 0::bigint AS batch_only FROM st_item")
def backfill_invariance(t: Tables):
    """The same messages in one chunk and in three give the same table."""
    _, rows = _messages(t)
    run = lambda name, cuts: ev.Replay(t.spark, name, state_partitions=STATE_PARTITIONS).replay(rows, lambda raw: ev.item_heat(ev.real(ev.clean(raw))), cuts)
    return _mismatch(run("whole", ()), run("cut", ("2024-01-08 09:30:00", "2024-01-21 17:45:30")), ["item_id", "window_end"])
