"""The given tables reshaped into the domain's inputs, one row in, one row out.

No adapter shuffles: every derived column depends on its own row, so a hot user or video
costs nothing extra here and filters still reach the Parquet scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.plans.silver import dedupe, ratios
from tidemark.schemas import REGIONS, SILVER_COLUMNS
from tidemark.sources.landing import metadata
from tidemark.sources.tables import Tables

_MICROS_2024 = 1704067200000000  # 2024-01-01 00:00 UTC
ITEMS_PER_PAGE = 400


def _k() -> Column:
    return F.get_json_object("props", "$.k").cast("long")


def raw_snapshots(t: Tables) -> DataFrame:
    """Events as snapshots before dedupe, with null channels and categories among them."""
    k = F.col("_k")
    minutes = F.expr(f"(unix_micros(ts) - {_MICROS_2024}) div 60000000")
    views = F.when(F.col("event_type") == "error", F.lit(0)).otherwise(
        F.round(F.col("value") * 100).cast("long") + minutes * 2)
    base = t.events.withColumn("_k", _k()).select(
        F.concat(F.lit("v"), k.cast("string")).alias("video_id"),
        F.element_at(F.array(*[F.lit(r) for r in REGIONS]), (F.col("user_id") % 8 + 1).cast("int")).alias("region"),
        F.date_trunc("hour", "ts").alias("captured_at"),
        F.concat(F.lit("Video "), k.cast("string")).alias("title"),
        F.when(k % 9 != 0, F.concat(F.lit("seen by "), F.col("event_type"))).alias("description"),
        F.concat(F.lit("t"), (k % 7).cast("string"), F.lit(",t"), (k % 3).cast("string")).alias("tags"),
        F.when(k != 98, F.concat(F.lit("c"), (k % 25).cast("string"))).alias("channel_id"),
        F.when(k != 98, F.concat(F.lit("Channel "), (k % 25).cast("string"))).alias("channel_title"),
        F.when(k != 97, (k % 10).cast("string")).alias("category_id"),
        F.timestamp_micros(F.lit(_MICROS_2024) - (k + 24) * 3600000000).alias("published_at"),
        views.alias("views"),
        F.lit("https://img.example.com/hq.jpg").alias("thumbnail_url"),
        F.col("ts").alias("ingested_at"), F.col("_k"), "event_id", "event_type", "user_id", "value",
    )
    base = base.withColumns({
        "likes": F.expr("views div (3 + _k % 5)"),
        "comment_count": F.expr("views div 50 + event_id % 10"),
        "ingestion_id": F.concat_ws("_", "region", F.date_format("captured_at", "yyyyMMddHH")),
    })
    return ratios(base)


def silver(t: Tables) -> DataFrame:
    return dedupe(raw_snapshots(t).select(*SILVER_COLUMNS))


def categories(t: Tables) -> DataFrame:
    """Eight of the ten category ids per region; two stay without a name on purpose."""
    k = _k()
    seen = t.events.where(k % 10 < 8).select(
        (k % 10).cast("string").alias("category_id"),
        F.element_at(F.array(*[F.lit(r) for r in REGIONS]), (F.col("user_id") % 8 + 1).cast("int")).alias("region"),
        "ts")
    return (seen.groupBy("category_id", "region").agg(F.max("ts").alias("updated_at"))
            .select("category_id", "region", F.concat(F.lit("Category "), "category_id").alias("category_name"),
                    "updated_at"))


def envelopes(t: Tables) -> DataFrame:
    """Snapshot items packed into documents of a region-hour, a bounded page at a time."""
    raw = raw_snapshots(t)
    text = lambda c: F.col(c).cast("string")
    item = F.struct(
        F.col("video_id").alias("id"),
        F.struct(F.date_format("published_at", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("publishedAt"),
                 F.col("channel_id").alias("channelId"), "title", "description",
                 F.struct(F.struct(F.col("thumbnail_url").alias("url")).alias("high")).alias("thumbnails"),
                 F.col("channel_title").alias("channelTitle"), F.split("tags", ",").alias("tags"),
                 F.col("category_id").alias("categoryId")).alias("snippet"),
        F.struct(text("views").alias("viewCount"), text("likes").alias("likeCount"),
                 text("comment_count").alias("commentCount")).alias("statistics"),
    )
    # a page spans a fixed run of event ids, so no document can outgrow it
    pages = raw.withColumns({
        "item": item, "page": F.expr(f"event_id div {ITEMS_PER_PAGE}"),
        "ingested_at": F.timestamp_micros(F.expr("unix_micros(ingested_at) div 600000000 * 600000000"))})
    docs = pages.groupBy("region", "captured_at", "ingested_at", "page").agg(
        F.sort_array(F.collect_list("item")).alias("items"))
    return docs.select(
        metadata(F.col("region"), F.col("captured_at"), F.col("ingested_at")).alias("_metadata"),
        F.struct("items").alias("response"))


def commerce_raw(t: Tables) -> DataFrame:
    """Events in the nested shape of an analytics export: items array and key-value params."""
    k, eid, uid = F.col("_k"), F.col("event_id"), F.col("user_id")
    # every fifth user only browses, so tables have non-buyers in them
    is_purchase = (F.col("event_type") == "purchase") & (uid % 5 != 0)
    pick = lambda values, i: F.element_at(F.array(*[F.lit(v) for v in values]), (i + 1).cast("int"))
    quantity = F.when(is_purchase, eid % 3 + 1)

    def item(key: Column, known: Column) -> Column:
        cents = key * 137 + 500 + (eid % 5) * 10
        return F.struct(
            F.when(known, F.concat(F.lit("item_"), key.cast("string"))).alias("item_id"),
            F.concat(F.lit("Item "), key.cast("string")).alias("item_name"),
            F.when(key != 55, F.concat(F.lit("cat_"), (key % 10).cast("string"))).alias("item_category"),
            (cents / 100).alias("price"), quantity.alias("quantity"),
            (cents * quantity / 100).alias("item_revenue"))

    first, second = item(k, eid % 37 != 0), item((k + 7) % 100, F.lit(True))
    items = F.concat(F.array(first), F.when(eid % 3 == 0, F.array(second)).otherwise(F.array().cast(
        "array<struct<item_id:string,item_name:string,item_category:string,price:double,quantity:bigint,item_revenue:double>>")),
        F.when(eid % 11 == 0, F.array(first)).otherwise(F.array().cast(
            "array<struct<item_id:string,item_name:string,item_category:string,price:double,quantity:bigint,item_revenue:double>>")))
    text = lambda key, v: F.struct(F.lit(key).alias("key"), v.alias("string_value"), F.lit(None).cast("long").alias("int_value"))
    number = lambda key, v: F.struct(F.lit(key).alias("key"), F.lit(None).cast("string").alias("string_value"), v.alias("int_value"))
    session = F.when(eid % 50 != 7, F.expr("unix_micros(ts) div 1000000 div 172800"))
    names = F.create_map(*[F.lit(x) for x in (
        "view", "view_item", "click", "add_to_cart", "signup", "begin_checkout", "purchase", "purchase")])
    return t.events.withColumn("_k", _k()).select(
        "event_id", F.to_date("ts").alias("event_date"), F.unix_micros("ts").alias("event_ts_micros"),
        F.when((F.col("event_type") == "purchase") & ~is_purchase, "view_item").otherwise(
            F.coalesce(F.try_element_at(names, F.col("event_type")),
                       F.when(eid % 2 == 0, "page_view").otherwise("session_start"))).alias("event_name"),
        F.concat(F.lit("u"), uid.cast("string")).alias("user_pseudo_id"),
        F.array(number("ga_session_id", session),
                text("transaction_id", F.when(is_purchase, F.concat(F.lit("t"), eid.cast("string")))),
                text("source", F.when(eid % 5 != 0, F.concat(F.lit("src_"), (eid % 12).cast("string")))),
                text("medium", F.when(eid % 7 != 0, pick(["organic", "cpc", "email"], eid % 3))),
                text("campaign", F.when(eid % 4 == 0, F.concat(F.lit("camp_"), (eid % 6).cast("string"))))).alias("event_params"),
        pick(["desktop", "mobile", "tablet"], (uid + F.when(eid % 4 == 0, 1).otherwise(0)) % 3).alias("device_category"),
        pick(["TW", "US", "JP", "DE"], (uid + F.when(eid % 6 == 0, 1).otherwise(0)) % 4).alias("geo_country"),
        F.concat(F.lit("s"), (uid % 12).cast("string")).alias("first_touch_source"),
        pick(["organic", "cpc", "referral"], uid % 3).alias("first_touch_medium"),
        items.alias("items"))


def threads(t: Tables) -> DataFrame:
    """Documents as comment threads, one page of one thread per row."""
    d = F.col("doc_id")
    published = F.timestamp_micros(F.lit(_MICROS_2024) + (d % 10007) * 1730 * 1000000)
    iso = lambda c: F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    snippet = F.struct(
        F.col("text").alias("textDisplay"), F.when(d % 13 != 0, F.col("n_chars") % 97).alias("likeCount"),
        iso(published).alias("publishedAt"), iso(published + F.expr("INTERVAL 1 HOUR")).alias("updatedAt"),
        F.struct(F.when(d % 11 != 0, F.col("source")).alias("value")).alias("authorChannelId"),
        F.concat(F.col("lang"), (d % 50).cast("string")).alias("authorDisplayName"))
    item = F.struct(F.struct(F.concat(F.lit("v"), (d % 100).cast("string")).alias("videoId"),
                             F.when(d % 5 != 0, d % 7).alias("totalReplyCount"),
                             F.struct(F.concat(F.lit("cm"), d.cast("string")).alias("id"), snippet.alias("snippet")).alias("topLevelComment")).alias("snippet"))
    return t.documents.select(F.to_date(published).alias("ingest_date"), (published + F.expr("INTERVAL 2 HOURS")).alias("ingested_at"),
                              F.array(item).alias("items"))


def articles(t: Tables) -> DataFrame:
    """Documents as forum articles with comment counts."""
    d, n = F.col("doc_id"), F.col("n_chars")
    rows = t.documents.select(
        F.col("source").alias("board"), d.alias("aid"), F.date_add(F.lit("2024-01-01").cast("date"), (d % 9).cast("int")).alias("post_date"),
        F.when(d % 17 != 0, F.concat(F.lit("cat"), (n % 4).cast("string"))).alias("category"),
        F.concat(F.lit("a"), (n % 60).cast("string")).alias("author_id"), (n % 120).alias("comments_total"))
    rows = rows.withColumn("comments_push", F.expr("comments_total div 2")).withColumn("comments_boo", F.expr("comments_total div 5"))
    return rows.withColumn("comments_score", F.col("comments_push") - F.col("comments_boo"))
