"""Queries: the given events as a keyed log, streamed by the log's own reader, restarted, drained and counted."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.catalog.commerce import ga
from tidemark.registry import query, view
from tidemark.session import cut, scratch_path
from tidemark.sources.tables import Tables
from tidemark.streaming import events as ev
from tidemark.streaming.log_source import EventLog, drain_to, lag

HALF = "2024-01-16 00:00:00"
BATCHES = 4  # that each half of the log takes at least: the limit of a batch is a parameter of the reader

view("lg_sent", """
  SELECT *, ('0x' || substr(md5(user_pseudo_id), 1, 8))::bigint % 3 AS part, event_ts_micros % 97 = 0 AS broken FROM ga""")


def _messages(t: Tables) -> DataFrame:
    """Every message once; those of some microseconds break off in the middle."""
    rows = ev.messages(cut(ga(t)), duplicate_percent=0)
    value = F.when(F.col("event_ts_micros") % 97 == 0, F.substring("value", 1, 40)).otherwise(F.col("value"))
    return cut(rows.withColumn("value", value))


def drained(t: Tables) -> tuple[DataFrame, DataFrame, DataFrame, list[int]]:
    """Good rows, rejected rows, the lag after each of two looks, and the rows of every batch.

    The log gets its second half after the first one is drained; the query stops in between and goes on
    from its checkpoint.
    """
    root = scratch_path(t.spark, "log")
    good, bad, checkpoint = f"{root}-good", f"{root}-rejects", f"{root}-checkpoint"
    log, rows, half = EventLog(t.spark, root), _messages(t), F.unix_micros(F.lit(HALF).cast("timestamp"))
    order = [F.col(k).asc() for k in ("event_ts_micros", "user_pseudo_id", "event_name", "item_id")]
    parsed = lambda df: df.withColumn("m", F.from_json("value", ev.MESSAGE))
    bad_row = F.col("m").isNull() | F.col("m.event_ts_micros").isNull() | F.col("m.user_pseudo_id").isNull()
    sizes, looks = [], []
    for part in (F.col("event_ts_micros") < half, F.col("event_ts_micros") >= half):
        mine = rows.where(part)
        log.append(mine, "user_pseudo_id", order)
        run = (log.stream(checkpoint, max(1, mine.count() // BATCHES)).writeStream.foreachBatch(drain_to(good, bad, parsed, bad_row))
               .option("checkpointLocation", checkpoint).start())
        try:
            run.processAllAvailable()
            sizes += [p["numInputRows"] for p in run.recentProgress if p["numInputRows"]]
        finally:
            run.stop()
        looks.append(lag(t.spark, root, checkpoint))
    looks.append(lag(t.spark, root, checkpoint))
    both = looks[1].withColumnRenamed("lag", "first_look").join(looks[2].select("partition", F.col("lag").alias("second_look")), "partition")
    schema = t.spark.read.parquet(good).schema
    return t.spark.read.schema(schema).parquet(good), t.spark.read.parquet(bad), both, sizes


@query("log_stream", """
  SELECT part AS partition, count(*) AS end_offset, count(*) AS committed_offset, 0::bigint AS first_look, 0::bigint AS second_look,
         count(*) FILTER (NOT broken) AS good, count(*) FILTER (broken) AS rejected, count(DISTINCT user_pseudo_id) FILTER (NOT broken) AS users
  FROM lg_sent GROUP BY 1""")
def log_stream(t: Tables):
    """Per partition of the log: what was read, rejected and committed after a restart; no lag is left, twice."""
    good, bad, looks, _ = drained(t)
    kept = good.groupBy("partition").agg(F.count(F.lit(1)).alias("good"), F.countDistinct("m.user_pseudo_id").alias("users"))
    lost = bad.groupBy("partition").agg(F.count(F.lit(1)).alias("rejected"))
    out = looks.join(kept, "partition", "left").join(lost, "partition", "left")
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return out.select("partition", "end_offset", "committed_offset", "first_look", "second_look", zero("good"), zero("rejected"), zero("users"))


@query("log_stream_rows", """
  SELECT * FROM (SELECT part AS partition, row_number() OVER (PARTITION BY part, half ORDER BY event_ts_micros, user_pseudo_id, event_name, item_id) - 1 + before AS "offset",
         user_pseudo_id, event_ts_micros, event_name, item_id, broken
  FROM (SELECT *, event_ts >= TIMESTAMP '2024-01-16 00:00:00' AS half,
          CASE WHEN event_ts >= TIMESTAMP '2024-01-16 00:00:00' THEN count(*) FILTER (event_ts < TIMESTAMP '2024-01-16 00:00:00') OVER (PARTITION BY part) ELSE 0 END AS before
        FROM lg_sent)) WHERE NOT broken""")
def log_stream_rows(t: Tables):
    """Every good message once, with its place in the log: none is lost or doubled by limits and the restart."""
    good, _, _, _ = drained(t)
    return good.select("partition", "offset", "m.user_pseudo_id", "m.event_ts_micros", "m.event_name", "m.item_id", F.lit(False).alias("broken"))
