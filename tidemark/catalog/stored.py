"""Queries: catalogue tables (typed, by layer, clustered) and parameters of any shape."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from tidemark.catalog.commerce import _GA
from tidemark.functions import variant as vt
from tidemark.plans import commerce, marts
from tidemark.registry import query, view
from tidemark.schemas import SILVER_COLUMNS
from tidemark.session import cut
from tidemark.sources import adapters, store
from tidemark.sources.tables import Tables

BUCKETS = 8  # of the sample's table; a parameter of ``materialise``
CLUSTER = ["video_id", "region"]


# --- catalogue tables --------------------------------------------------------------------

@query("snapshot_table", """
  SELECT region, strftime(captured_at, '%Y%m%d') AS captured_day, count(*) AS row_count, sum(views)::bigint AS views FROM silver GROUP BY 1, 2""")
def snapshot_table(t: Tables):
    """The typed table by region and day: written whole, then its later half again."""
    name = f"{store.snapshot_schema(t.spark, 'silver')}.video_snapshots"
    store.create_snapshot_table(t.spark, name, by=store.DAY_PARTITION)
    rows = cut(adapters.silver(t))
    store.overwrite_snapshot_table(rows, name)
    store.overwrite_snapshot_table(rows.where("captured_at >= timestamp'2024-01-16'"), name)
    return t.spark.table(name).groupBy("region", store.DAY_PARTITION).agg(F.count(F.lit(1)).alias("row_count"), F.sum("views").alias("views"))


@query("layers", """
  SELECT 'stg_video_snapshots' AS model, 'view' AS layer, count(*) AS row_count FROM stg
  UNION ALL SELECT 'stg_categories', 'view', count(*) FROM categories
  UNION ALL SELECT 'gold_trending_daily', 'table', count(*) FROM gold_trending
  UNION ALL SELECT 'gold_channel_performance', 'table', count(*) FROM gold_channel
  UNION ALL SELECT 'gold_category_daily', 'table', count(*) FROM gold_category
  UNION ALL SELECT 'gold_video_velocity_hourly', 'table', count(*) FROM velocity
  UNION ALL SELECT 'gold_video_lifecycle', 'table', count(*) FROM lifecycle""")
def layers(t: Tables):
    """Every model kept as its layer says, and what the catalogue then holds."""
    schema = store.snapshot_schema(t.spark, "gold")
    made = marts.build(cut(adapters.silver(t)), adapters.categories(t))
    out = []
    for name, df in made.items():  # the seven models
        marts.materialise(name, df, schema)
        kept = name if marts.LAYERS[name] == "view" else f"{schema}.{name}"
        kind = "view" if t.spark.catalog.getTable(kept).tableType == "TEMPORARY" else "table"
        out.append(t.spark.table(kept).agg(F.lit(name).alias("model"), F.lit(kind).alias("layer"), F.count(F.lit(1)).alias("row_count")))
    return cut(reduce(DataFrame.unionByName, out))


def clustered(t: Tables) -> DataFrame:
    """Snapshots in a table clustered by video and region."""
    schema = store.snapshot_schema(t.spark, "clustered")
    marts.materialise("snapshots_by_video", adapters.silver(t), schema, CLUSTER, BUCKETS, [*CLUSTER, "captured_at"])
    return marts.stg_video_snapshots(t.spark.table(f"{schema}.snapshots_by_video").select(*SILVER_COLUMNS))


@query("lifecycle_clustered", "SELECT * FROM lifecycle")
def lifecycle_clustered(t: Tables):
    """The lifecycle mart from the clustered table: lag windows and aggregate without an exchange of snapshots."""
    return marts.video_lifecycle(clustered(t), adapters.categories(t))


@query("velocity_clustered", "SELECT * FROM velocity")
def velocity_clustered(t: Tables):
    return marts.velocity_hourly(clustered(t))


# --- parameters --------------------------------------------------------------------------

view("vr_props", """
  SELECT event_id, CASE WHEN event_id % 13 = 0 THEN left(props, 4) WHEN event_id % 17 <> 0 THEN props END AS props, (json_extract(props, '$.k'))::bigint AS k FROM events""")


@query("variant_props", """
  SELECT event_id, k, k::varchar AS k_text, NULL::bigint AS missing, NULL::varchar AS broken_path
  FROM vr_props WHERE event_id % 13 <> 0 AND event_id % 17 <> 0
  UNION ALL SELECT event_id, NULL, NULL, NULL, NULL FROM vr_props WHERE event_id % 13 = 0 OR event_id % 17 = 0""")
def variant_props(t: Tables):
    """Properties by path and type; texts that break off, missing ones and wrong paths give NULL."""
    text = F.when(F.col("event_id") % 13 == 0, F.substring("props", 1, 4)).when(F.col("event_id") % 17 != 0, F.col("props"))
    rows = t.events.select("event_id", vt.variant(text).alias("v"))
    return rows.select("event_id", vt.at(F.col("v"), "$.k", "long").alias("k"), vt.at(F.col("v"), "$.k", "string").alias("k_text"),
                       vt.at(F.col("v"), "$.none", "long").alias("missing"), vt.at(F.col("v"), "$.k.deeper[3]", "string").alias("broken_path"))


def _params(t: Tables) -> DataFrame:
    raw = adapters.commerce_raw(t)
    return raw.withColumn("event_params", vt.variant(F.to_json("event_params")))


@query("funnel_extract_variant", _GA)
def funnel_extract_variant(t: Tables):
    """The event-item table with its parameters looked up in VARIANT."""
    return commerce.funnel_extract(_params(t), commerce.variant_param)


@query("param_lookup", """
  SELECT event_name, count(*) AS events, count(ga_session_id) AS with_session, count(transaction_id) AS with_transaction, 0::bigint AS with_other,
         count(DISTINCT ga_session_id) AS sessions FROM ga_raw GROUP BY 1""")
def param_lookup(t: Tables):
    """The first parameter of a name, looked up by a SQL function of any key."""
    vt.register(t.spark)
    _params(t).select("event_name", "event_params").createOrReplaceTempView("events_with_params")
    return t.spark.sql("""
      SELECT event_name, count(*) AS events, count(session) AS with_session, count(transaction) AS with_transaction, count(other) AS with_other,
             count(DISTINCT session) AS sessions
      FROM (SELECT event_name, try_variant_get(event_param(event_params, 'ga_session_id'), '$.int_value', 'long') AS session,
                   try_variant_get(event_param(event_params, 'transaction_id'), '$.string_value', 'string') AS transaction,
                   try_variant_get(event_param(event_params, 'no such key'), '$.int_value', 'long') AS other
            FROM events_with_params) GROUP BY event_name""")
