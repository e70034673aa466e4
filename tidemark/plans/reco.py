"""Recommendation tables: sequences, popularity, neighbours, fused candidates, features, samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.functions.numeric import exact_round
from tidemark.operators.ordering import top_n
from tidemark.operators.scalars import attach
from tidemark.operators.sessions import numbered, trailing

USER = "user_pseudo_id"

# Interaction weights, ranking grades, fusion constant, pool and history sizes.
WEIGHTS = {"view_item": 1, "add_to_cart": 3, "begin_checkout": 4, "purchase": 5}
GRADES = {"view_item": 1, "add_to_cart": 2, "begin_checkout": 3, "purchase": 4}
DECAY_DAYS, RRF_K, POOL, SEEDS, NEIGHBOURS, POPULAR, MAX_HISTORY = 14, 60, 200, 10, 50, 100, 20
SENTENCE = 1000


def by_event(values: dict[str, int]) -> Column:
    chain = F
    for name, v in values.items():
        chain = chain.when(F.col("event_name") == name, v)
    return chain.otherwise(0)


# --- sequences --------------------------------------------------------------------------

def session_sequences(events: DataFrame) -> DataFrame:
    """Items of each session in order, repeats in a row collapsed, sessions of two and more.

    One row per position. Rows without a session fall back to the user's day.
    """
    keyed = events.select(
        USER, F.coalesce(F.col("ga_session_id").cast("string"), F.date_format("event_date", "yyyy-MM-dd")).alias("session_key"),
        "event_ts", "event_name", "item_id", "event_date")
    order = [F.col("event_name"), F.col("item_id")]
    return numbered(keyed, [USER, "session_key"], "event_ts", order, changed="item_id").where("n >= 2")


def sentences(sequences: DataFrame) -> DataFrame:
    """Sequences as arrays for the embedding model, cut at its own sentence length."""
    part = F.expr(f"(pos - 1) div {SENTENCE}")
    return (sequences.groupBy(USER, "session_key", part.alias("part"))
            .agg(F.sort_array(F.collect_list(F.struct("pos", "item_id"))).alias("s"))
            .select(F.col("s.item_id").alias("items")))


def item_vectors(sequences: DataFrame, size: int = 64, seed: int = 42) -> DataFrame:
    from pyspark.ml.feature import Word2Vec
    from pyspark.ml.functions import vector_to_array

    model = Word2Vec(vectorSize=size, windowSize=5, minCount=3, maxIter=3, seed=seed, numPartitions=4,
                     inputCol="items", outputCol="v", maxSentenceLength=SENTENCE).fit(sentences(sequences))
    return model.getVectors().select(F.col("word").alias("item_id"),
                                     vector_to_array("vector").cast("array<float>").alias("vector"))


def leave_one_out(sequences: DataFrame, eval_end: str, test_start: str) -> DataFrame:
    """The last item as target, up to twenty items before it as history; windows by the last event's day."""
    last = sequences.where("pos > n - 21")
    rows = last.groupBy(USER, "session_key").agg(
        F.sort_array(F.collect_list(F.struct("pos", "item_id"))).alias("s"),  # at most 21
        F.max("event_date").alias("last_date"), F.max("n").alias("n"))
    target = F.element_at("s.item_id", -1)
    window = (F.when(F.col("last_date") <= F.lit(eval_end).cast("date"), "eval")
              .when(F.col("last_date") >= F.lit(test_start).cast("date"), "test").otherwise("label"))
    held = F.crc32(F.concat_ws(":", USER, "session_key")) % 10 == 0
    return rows.select(USER, "session_key", F.concat_ws(" ", F.slice("s.item_id", 1, F.size("s") - 1)).alias("history"),
                       F.element_at("s.item_id", F.greatest(F.size("s") - 1, F.lit(1))).alias("last_item"),
                       target.alias("target"), "last_date", window.alias("split"),
                       ((window == "eval") & held).alias("validation"))


# --- recall -----------------------------------------------------------------------------

def popularity(events: DataFrame, catalog: DataFrame, top: int = POPULAR) -> DataFrame:
    """Weighted popularity: the first ``top`` items overall and per category."""
    scored = events.groupBy("item_id").agg(F.sum(by_event(WEIGHTS)).cast("long").alias("score"))
    named = scored.join(catalog.select("item_id", "item_category"), "item_id", "left")
    scopes = named.select("item_id", "score", F.explode(F.array(
        F.lit("global"), F.concat(F.lit("category:"), F.col("item_category")))).alias("scope")).where("scope is not null")
    return top_n(scopes, ["scope"], [F.col("score").desc(), F.col("item_id").asc()], top)


def decayed(events: DataFrame, anchor: DataFrame) -> DataFrame:
    """Per (user, item): decayed weight, exact when summed."""
    age = F.datediff("data_anchor_date", "event_date")
    w = (by_event(WEIGHTS) * F.exp(-age / F.lit(float(DECAY_DAYS)))).cast("decimal(20,12)")
    return events.transform(attach, anchor).groupBy(USER, "item_id").agg(F.sum(w).alias("w"))


def user_vectors(interest: DataFrame, vectors: DataFrame) -> DataFrame:
    """Weighted sum of item vectors per user, normalised; one row per dimension."""
    spread = interest.join(vectors, "item_id").select(USER, "w", F.posexplode("vector").alias("dim", "x"))
    summed = spread.groupBy(USER, "dim").agg(F.sum((F.col("w").cast("double") * F.col("x")).cast("decimal(28,16)")).cast("double").alias("x"))
    norm = F.sqrt(F.sum(F.col("x") * F.col("x")).over(Window.partitionBy(USER)))  # one row per dimension
    return summed.select(USER, "dim", exact_round(F.col("x") / F.nullif(norm, F.lit(0.0)), 6).alias("value"))


def user_item_cosine(pool: DataFrame, user_dims: DataFrame, vectors: DataFrame) -> DataFrame:
    """Cosine of every candidate with its user's vector; missing on either side gives 0."""
    arrays = user_dims.groupBy(USER).agg(F.array_sort(F.collect_list(F.struct("dim", "value"))).alias("_u"))  # one entry per dimension
    rows = pool.select(USER, "item_id").join(arrays, USER, "left").join(vectors.select("item_id", "vector"), "item_id", "left")
    dot = F.aggregate(F.zip_with("_u", "vector", lambda u, v: u["value"].cast("double") * v), F.lit(0.0), lambda a, x: a + x)
    size = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda a, x: a + x.cast("double") * x))
    return rows.select(USER, "item_id", exact_round(F.coalesce(dot / F.nullif(size, F.lit(0.0)), F.lit(0.0)), 5).alias("i2v_cos_user_item"))


def seeds(interest: DataFrame, n: int = SEEDS) -> DataFrame:
    return top_n(interest, [USER], [F.col("w").desc(), F.col("item_id").asc()], n, "seed_rank").select(
        USER, F.col("item_id").alias("seed_item"))


def candidate_lists(seed_items: DataFrame, neighbours: DataFrame, popular: DataFrame | None = None,
                    rules: DataFrame | None = None) -> DataFrame:
    """Ranked lists per user (user, source, list): neighbours of every seed, rules of every seed, the popular list.

    A list stays one row until its user's rows are together (``unpacked``).
    """
    listed = lambda df, key: df.groupBy(F.col(key).alias("seed_item")).agg(F.collect_list(F.struct("item_id", F.col("rank").cast("int").alias("rank"))).alias("list"))
    out = seed_items.join(listed(neighbours, "query_id"), "seed_item").select(USER, F.lit("i2v").alias("source"), "list")
    if rules is not None:
        out = out.unionByName(seed_items.join(listed(rules, "seed_item"), "seed_item").select(USER, F.lit("fbt").alias("source"), "list"))
    if popular is not None:
        users = seed_items.select(USER).distinct()
        short = popular.where("scope = 'global'").agg(F.collect_list(F.struct("item_id", F.col("rank").cast("int").alias("rank"))).alias("list"))  # at most POPULAR
        out = out.unionByName(users.transform(attach, short).select(USER, F.lit("pop").alias("source"), "list"))
    return out


def unpacked(lists: DataFrame, keys: Sequence[str] = (USER,)) -> DataFrame:
    """One row per entry of ``lists``, all of a user in one partition: what groups them by item shuffles no entry."""
    return lists.repartition(*keys).select(*keys, "source", F.explode("list").alias("p")).select(*keys, "p.item_id", "p.rank", "source")


def fuse(lists: DataFrame, bought: DataFrame, keys: Sequence[str] = (USER,), pool: int = POOL, k: int = RRF_K) -> DataFrame:
    """Reciprocal rank fusion, bought items removed, the best ``pool`` per user."""
    score = F.sum((F.lit(1.0) / (k + F.col("rank"))).cast("decimal(20,16)"))
    # a bought item is an entry without a rank, so that no join moves the entries
    gone = bought.select(*keys, "item_id").dropna().distinct().select(
        *keys, F.lit("bought").alias("source"), F.array(F.struct("item_id", F.lit(None).cast("int").alias("rank"))).alias("list"))
    rows = unpacked(lists.select(*keys, "source", "list").unionByName(gone), keys)
    fused = rows.groupBy(*keys, "item_id").agg(score.alias("rrf"), F.count_if(F.col("source") == "bought").alias("_bought"))
    fresh = fused.where("_bought = 0").drop("_bought")
    return top_n(fresh, list(keys), [F.col("rrf").desc(), F.col("item_id").asc()], pool)


def bought_items(events: DataFrame) -> DataFrame:
    return events.where("event_name = 'purchase'").select(USER, "item_id").distinct()


# --- features and samples ---------------------------------------------------------------

def point_in_time(events: DataFrame) -> DataFrame:
    """What was known at each event: views and carts of the last hour, events of the last half hour."""
    ident = F.concat_ws("|", USER, "event_ts_micros", "event_name", "item_id")
    is_ = lambda e: (F.col("event_name") == e).cast("int")
    return trailing(events.withColumn("event_key", ident), [USER], "event_ts", "event_key", {
        "views_1h": (3600, is_("view_item")), "carts_1h": (3600, is_("add_to_cart")), "events_30m": (1800, F.lit(1))})


def rank_features(pool: DataFrame, events: DataFrame, rfm: DataFrame, catalog: DataFrame, interest: DataFrame,
                  cosines: DataFrame, lists: DataFrame, window_days: int) -> DataFrame:
    """The ranking features of every (user, candidate), missing values as their sentinels.

    A candidate stays whether or not its item is in the catalogue or its user in the profiles: what is
    missing then is 0, the days since the last visit the whole window.
    """
    newest = events.groupBy(USER).agg(F.max_by(F.concat_ws("|", USER, "event_ts_micros", "event_name", "item_id"),
                                               F.struct("event_ts_micros", "event_name", "item_id")).alias("event_key"))
    rt = point_in_time(events).join(newest.select("event_key"), "event_key", "left_semi").select(
        USER, F.col("views_1h").alias("rt_views_1h"), F.col("carts_1h").alias("rt_carts_1h"), F.col("events_30m").alias("rt_events_30m"))
    recent = events.join(events.groupBy(USER).agg(F.max("event_ts").alias("_end")), USER)
    last_hour = recent.where("event_name = 'view_item' and item_category is not null and event_ts > _end - interval 1 hour")
    top_cat = top_n(last_hour.groupBy(USER, "item_category").agg(F.count(F.lit(1)).alias("_n")), [USER],
                    [F.col("_n").desc(), F.col("item_category")], 1, "_r").select(USER, F.col("item_category").alias("_rt_cat"))
    cats = catalog.select("item_id", "item_category")
    favourite = top_n(interest.join(cats, "item_id").where("item_category is not null").groupBy(USER, "item_category").agg(F.sum("w").alias("_w")),
                      [USER], [F.col("_w").desc(), F.col("item_category")], 1, "_r").select(USER, F.col("item_category").alias("_cat"))
    hist = events.groupBy(USER, "item_id").agg(F.sum(by_event(WEIGHTS)).cast("long").alias("weighted_hist_interaction"))
    code = F.when(F.col("source") == "i2v", 0).when(F.col("source") == "sem", 1).otherwise(2)
    src = unpacked(lists).groupBy(USER, "item_id").agg(F.min(code).alias("recall_src"))
    users = rfm.select(
        USER, "recency_days", "orders_count", "sessions_count", "active_days",
        exact_round(F.log1p(F.col("monetary_total").cast("double")), 6).alias("log1p_monetary"), "distinct_items_viewed", "data_anchor_date")
    items = catalog.select(
        "item_id", "item_category", exact_round(F.log1p("users_viewed"), 6).alias("log1p_users_viewed"),
        exact_round(F.log1p("users_purchased"), 6).alias("log1p_users_purchased"),
        F.coalesce("view_to_cart_user_rate", F.lit(0)).alias("view_to_cart_user_rate"),
        F.coalesce("view_to_purchase_user_rate", F.lit(0)).alias("view_to_purchase_user_rate"),
        exact_round(F.log1p(F.col("price_latest").cast("double")), 6).alias("log1p_price_latest"), "first_seen_date", "last_seen_date")
    out = (pool.select(USER, "item_id").join(users, USER, "left").join(items, "item_id", "left")
           .join(cosines, [USER, "item_id"], "left").join(hist, [USER, "item_id"], "left").join(src, [USER, "item_id"], "left")
           .join(favourite, USER, "left").join(top_cat, USER, "left").join(rt, USER, "left"))
    same = lambda c: F.coalesce((F.col("item_category") == F.col(c)).cast("long"), F.lit(0))
    out = out.withColumns({
        "recency_days": F.coalesce("recency_days", F.lit(window_days)),
        "days_since_first_seen": F.datediff("data_anchor_date", "first_seen_date"),
        "days_since_last_seen": F.datediff("data_anchor_date", "last_seen_date"),
        "seed_same_category": same("_cat"), "rt_item_matches_top_cat": same("_rt_cat"),
        "has_rt": F.when(F.col("rt_events_30m").isNotNull(), 1).otherwise(0)})
    return out.drop("data_anchor_date", "first_seen_date", "last_seen_date", "_cat", "_rt_cat", "item_category").na.fill(0)


def graded(events: DataFrame) -> DataFrame:
    """The deepest stage each user reached on each item, as a grade."""
    return events.groupBy(USER, "item_id").agg(F.max(by_event(GRADES)).alias("grade"))


def ltr_dataset(pool: DataFrame, labels: DataFrame) -> DataFrame:
    """Pool rows with grades; users whose whole pool is a miss are dropped; ``dropped_groups`` counts them."""
    rows = pool.join(graded(labels), [USER, "item_id"], "left").na.fill(0, ["grade"])
    hit = rows.where("grade > 0").select(USER).distinct()
    return rows.join(hit, USER, "left_semi")


def dropped_groups(pool: DataFrame, labels: DataFrame) -> DataFrame:
    """One row: users with a pool, those dropped from the dataset because all of it is a miss, and their share."""
    grades = graded(labels).select(USER, "item_id", F.lit(1).alias("_hit"))
    per_user = pool.join(grades, [USER, "item_id"], "left").groupBy(USER).agg(F.count("_hit").alias("hits"))
    return per_user.agg(F.count(F.lit(1)).alias("users"), F.count_if(F.col("hits") == 0).alias("dropped")).withColumn(
        "dropped_rate", exact_round(F.col("dropped") / F.nullif(F.col("users"), F.lit(0)), 6))


def pointwise_ranker(past: DataFrame, past_grades: DataFrame, features: DataFrame, feature_names: Sequence[str], seed: int = 42) -> DataFrame:
    """Boosted trees on the grade, fitted on an earlier window; the rank within a user of the later one is by predicted grade."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import GBTRegressor

    rows = past.join(past_grades, [USER, "item_id"], "left").na.fill(0, ["grade"]).withColumn("label", F.col("grade").cast("double"))
    model = Pipeline(stages=[VectorAssembler(inputCols=list(feature_names), outputCol="x"),
                             GBTRegressor(featuresCol="x", maxIter=10, maxDepth=4, seed=seed)]).fit(rows)
    scored = model.transform(features).select(USER, "item_id", F.col("prediction").alias("score"))
    return top_n(scored, [USER], [F.col("score").desc(), F.col("item_id")], POOL)


# --- replay -----------------------------------------------------------------------------

def ab_arm(user: Column) -> Column:
    return F.when(F.crc32(user) % 100 < 50, "A").otherwise("B")


def ab_replay(events: DataFrame, personal: DataFrame, popular: DataFrame, k: int = 10) -> DataFrame:
    """Per session: was any later item of the session among what the user's arm recommends?

    The first event asks for recommendations, the rest of the session judges them.
    """
    asked = (numbered(events.where("ga_session_id is not null"), [USER, "ga_session_id"], "event_ts",
                      [F.col("event_name"), F.col("item_id")]).withColumn("arm", ab_arm(F.col(USER))))
    top = popular.where((F.col("scope") == "global") & (F.col("rank") <= k)).agg(F.collect_set("item_id").alias("_pop"))  # k items
    mine = personal.where(F.col("rank") <= k).select(USER, "item_id", F.lit(True).alias("_mine"))
    rest = asked.where("pos > 1").join(mine, [USER, "item_id"], "left").transform(attach, top)
    hit = F.when(F.col("arm") == "A", F.coalesce("_mine", F.lit(False))).otherwise(F.array_contains("_pop", F.col("item_id")))
    judged = rest.withColumn("_hit", hit).groupBy(USER, "ga_session_id").agg(
        F.bool_or("_hit").alias("hit_any"), F.bool_or(F.col("_hit") & (F.col("event_name") == "purchase")).alias("hit_purchase"))
    return (asked.where("pos = 1").select(USER, "ga_session_id", "arm").join(judged, [USER, "ga_session_id"], "left")
            .na.fill(False, ["hit_any", "hit_purchase"]).withColumn("traffic_type", F.lit("labeled_event_replay")))


def ab_summary(replayed: DataFrame) -> DataFrame:
    rate = lambda c: exact_round(F.count_if(c) / F.count(F.lit(1)), 6)
    return replayed.groupBy("arm", "traffic_type").agg(
        F.count(F.lit(1)).alias("sessions"), F.count_if("hit_any").alias("hits"), F.count_if("hit_purchase").alias("purchase_hits"),
        rate("hit_any").alias("hit_rate"), rate("hit_purchase").alias("purchase_hit_rate"))


def display_segments(rfm: DataFrame) -> DataFrame:
    return rfm.select(USER, F.when(F.col("orders_count") >= 2, "buyer_repeat").when(F.col("orders_count") == 1, "buyer_once")
                      .when(F.col("active_days") >= 3, "browser_active").otherwise("cold").alias("segment"))
