"""Funnel, growth and customer analytics over sessions, events and baskets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.functions.numeric import exact_round, ratio
from tidemark.operators.ordering import ntile, ordered_prefix, ranked, top_n
from tidemark.operators.pairs import frequent_pairs, rules
from tidemark.operators.scalars import attach
from tidemark.operators.selection import tiles
from tidemark.plans.commerce import money
from tidemark.session import cut

# Step names, bottleneck share, sources shown by name.
STEPS = ["sessions", "view_item", "add_to_cart", "begin_checkout", "purchase"]
FLAGS = ["did_view", "did_cart", "did_checkout", "did_purchase"]
BOTTLENECK, TOP_SOURCES = 0.40, 8
MICROS_PER_DAY = 86_400_000_000


def session_facts(touches: DataFrame, sessions: DataFrame) -> DataFrame:
    """Every session with its source, device and stage flags; sessions without funnel events count too."""
    flags = sessions.select("user_pseudo_id", "ga_session_id", *FLAGS, "session_revenue")
    return (touches.join(flags, ["user_pseudo_id", "ga_session_id"], "left")
            .na.fill(False, FLAGS).na.fill(0, ["session_revenue"]))


def with_source_slice(facts: DataFrame, top: int = TOP_SOURCES) -> DataFrame:
    """The ``top`` sources by sessions keep their names, the rest become (other)."""
    shown = (facts.groupBy("session_source").agg(F.count(F.lit(1)).alias("_n"))
             .orderBy(F.col("_n").desc(), "session_source").limit(top)
             .select("session_source", F.col("session_source").alias("_shown")))
    return (facts.join(F.broadcast(shown), "session_source", "left")
            .withColumn("source_slice", F.coalesce("_shown", F.lit("(other)"))).drop("_shown"))


def segmented(facts: DataFrame) -> DataFrame:
    """One copy of each session per slicing: all, device, source."""
    pairs = [("all", F.lit("all")), ("device", F.col("device_category")), ("source", F.col("source_slice"))]
    slices = F.array(*[F.struct(F.lit(k).alias("segment_type"), v.alias("segment_value")) for k, v in pairs])
    return facts.withColumn("_s", F.explode(slices)).select("*", "_s.*").drop("_s")


def _reached(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Stage counts per key, unpivoted to one row per step."""
    wide = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("r0"),
                                 *[F.count_if(f).alias(f"r{i + 1}") for i, f in enumerate(FLAGS)])
    names = ", ".join(f"{i}, '{s}', r{i}" for i, s in enumerate(STEPS))
    return wide.select(*keys, F.expr(f"stack(5, {names}) AS (step_order, step_name, reached_count)"))


def _rates(steps: DataFrame, keys: Sequence[str]) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy("step_order")  # five rows a group
    entry = F.first("reached_count").over(w)
    return (steps.withColumn("prev_count", F.lag("reached_count").over(w))
            .withColumn("_entry", entry)
            .withColumn("step_conversion_rate", ratio(F.col("reached_count"), F.col("prev_count"), 4))
            .withColumn("drop_off_rate", exact_round(F.lit(1.0) - F.col("reached_count") / F.nullif(F.col("prev_count").cast("double"), F.lit(0.0)), 4))
            .withColumn("users_lost", F.col("prev_count") - F.col("reached_count"))
            .withColumn("overall_share", ratio(F.col("reached_count"), F.col("_entry"), 4)).drop("_entry"))


def funnel(facts: DataFrame, theta: float = BOTTLENECK) -> DataFrame:
    keys = ["basis", "segment_type", "segment_value"]
    rows = segmented(with_source_slice(cut(facts)))  # read by the source list and by both bases
    users = rows.groupBy("segment_type", "segment_value", "user_pseudo_id").agg(
        *[F.bool_or(f).alias(f) for f in FLAGS])
    both = (_reached(rows.withColumn("basis", F.lit("session")), keys)
            .unionByName(_reached(users.withColumn("basis", F.lit("user")), keys)))
    out = _rates(both, keys).withColumn("is_bottleneck", F.coalesce(F.col("drop_off_rate") >= theta, F.lit(False)))
    worst = Window.partitionBy(*keys, "is_bottleneck").orderBy(F.col("users_lost").desc())
    return out.withColumn("bottleneck_rank", F.when(F.col("is_bottleneck"), F.rank().over(worst)))


def funnel_daily(facts: DataFrame) -> DataFrame:
    steps = _rates(_reached(facts.withColumnRenamed("session_date", "event_date"), ["event_date"]), ["event_date"])
    return steps.select("event_date", "step_order", "reached_count", "step_conversion_rate", "drop_off_rate",
                        F.when(F.col("step_order") == 4, F.col("overall_share")).alias("overall_cvr"))


def kpi_daily(facts: DataFrame, events: DataFrame) -> DataFrame:
    """One row a day. Rolling statistics run over days, so their window is calendar-sized."""
    visits = facts.groupBy(F.col("session_date").alias("event_date")).agg(
        F.count(F.lit(1)).alias("sessions_count"), F.countDistinct("user_pseudo_id").alias("users_count"),
        F.count_if("did_purchase").alias("buying_sessions"))
    sales = events.where("event_name = 'purchase'").groupBy("event_date").agg(
        F.countDistinct("user_pseudo_id").alias("buyers_count"), F.countDistinct("transaction_id").alias("orders_count"),
        F.sum(money("item_revenue")).alias("revenue"))
    out = visits.join(sales, "event_date", "left").na.fill(0, ["buyers_count", "orders_count", "revenue"])
    out = out.withColumns({
        "revenue": F.col("revenue").cast("double"),
        "aov": exact_round(F.col("revenue").cast("double") / F.nullif(F.col("orders_count").cast("double"), F.lit(0.0)), 2),
        "cvr": ratio(F.col("buying_sessions"), F.col("sessions_count"), 4).cast("double")})
    week = Window.orderBy("event_date").rowsBetween(-6, 0)
    for metric in ("revenue", "orders_count", "cvr"):
        short = metric.removesuffix("_count")
        mean, std = F.avg(metric).over(week), F.stddev_samp(F.col(metric).cast("double")).over(week)
        z = (F.col(metric) - mean) / F.nullif(F.round(std, 9), F.lit(0.0))
        out = out.withColumns({
            f"{short}_rolling_mean_7d": exact_round(mean, 4), f"{short}_rolling_std_7d": exact_round(std, 4),
            f"{short}_z_score": exact_round(z, 4),
            f"{short}_is_anomaly": F.coalesce(F.abs(exact_round(z, 4)) > 2, F.lit(False)),
            f"{short}_upper_bound": exact_round(mean + 2 * std, 4),
            f"{short}_lower_bound": exact_round(mean - 2 * std, 4)})
    return out


def period_compare(kpi: DataFrame, period: Column) -> DataFrame:
    """Revenue change split into traffic, conversion and order value by chained substitution."""
    totals = kpi.groupBy(period.alias("current_period")).agg(
        F.sum("sessions_count").cast("double").alias("sessions_1"), F.sum("orders_count").cast("double").alias("orders_1"),
        F.sum(money("revenue")).cast("double").alias("revenue_1"))
    w = Window.orderBy("current_period")
    back = lambda c: F.lag(c).over(w)
    rows = totals.select("*", back("current_period").alias("compare_period"), back("sessions_1").alias("sessions_0"),
                         back("orders_1").alias("orders_0"), back("revenue_1").alias("revenue_0")).where("compare_period is not null")
    rows = rows.selectExpr("*", "orders_0 / sessions_0 AS c0", "orders_1 / sessions_1 AS c1",
                           "revenue_0 / orders_0 AS a0", "revenue_1 / orders_1 AS a1", "revenue_1 - revenue_0 AS d")
    rows = rows.selectExpr("*", "(sessions_1 - sessions_0) * c0 * a0 AS e1",
                           "sessions_1 * (c1 - c0) * a0 AS e2", "sessions_1 * c1 * (a1 - a0) AS e3")
    r2 = lambda e, n: exact_round(F.expr(e), 2).alias(n)
    return rows.select(
        "current_period", "compare_period", "sessions_0", "sessions_1",
        exact_round(F.col("c0"), 6).alias("cvr_0"), exact_round(F.col("c1"), 6).alias("cvr_1"),
        r2("a0", "aov_0"), r2("a1", "aov_1"), r2("revenue_0", "revenue_0"), r2("revenue_1", "revenue_1"),
        r2("d", "revenue_diff"), r2("e1", "effect_traffic"), r2("e2", "effect_conversion"), r2("e3", "effect_aov"),
        F.abs(F.expr("d - e1 - e2 - e3")).__lt__(0.01).alias("conserved"))


def cart_abandonment(facts: DataFrame, events: DataFrame) -> DataFrame:
    in_cart = events.where("event_name = 'add_to_cart' and ga_session_id is not null").groupBy(
        "user_pseudo_id", "ga_session_id").agg(
        F.sum(money(F.col("price")) * F.coalesce("quantity", F.lit(1))).alias("_cart"))
    # the shown sources are chosen over all sessions, before the cart filter
    rows = with_source_slice(cut(facts)).where("did_cart").join(in_cart, ["user_pseudo_id", "ga_session_id"], "left")
    out = segmented(rows).groupBy("segment_type", "segment_value").agg(
        F.count(F.lit(1)).alias("carted_sessions"),
        F.count_if("did_purchase").alias("purchased_after_cart_sessions"),
        F.count_if(~F.col("did_purchase")).alias("abandoned_sessions"),
        F.count_if("did_checkout").alias("checkout_reached_sessions"),
        F.sum(F.when(~F.col("did_purchase"), F.coalesce("_cart", F.lit(0)))).alias("abandoned_value_estimate"))
    return out.withColumn("abandonment_rate", ratio(F.col("abandoned_sessions"), F.col("carted_sessions"), 4))


# --- customer life ----------------------------------------------------------------------

def _purchase_spells(orders: DataFrame, user: str, at: str) -> DataFrame:
    """Distinct purchase months per buyer with the next one. A buyer has one row per month at most."""
    months = orders.select(F.col(user).alias("buyer"),
                           (F.year(at) * 12 + F.month(at) - 1).alias("m")).distinct()
    horizon = months.agg(F.max("m").alias("last_m"))
    w = Window.partitionBy("buyer").orderBy("m")
    return (months.withColumn("next_m", F.lead("m").over(w)).withColumn("is_first", F.lag("m").over(w).isNull())
            .transform(attach, horizon)
            .withColumn("until_m", F.least(F.coalesce(F.col("next_m") - 1, F.col("last_m")), F.col("last_m"))))


def _stage(spell_month: Column, month: Column, first: Column) -> Column:
    quiet = F.least(month - spell_month, F.lit(3))
    return (F.when(quiet == 0, F.when(first, "New").otherwise("Active"))
            .otherwise(F.concat(F.lit("Sleeping-"), quiet.cast("string"))))


def month_key(m: Column) -> Column:
    return F.format_string("%04d-%02d", F.floor(m / 12).cast("int"), (m % 12 + 1).cast("int"))


def lifecycle(orders: DataFrame, user: str, at: str) -> DataFrame:
    """Buyers per month and stage. Spells expand to months in the map task and are summed there."""
    rows = _purchase_spells(orders, user, at).withColumn("month", F.explode(F.sequence("m", "until_m")))
    return (rows.groupBy("month", _stage(F.col("m"), F.col("month"), F.col("is_first")).alias("stage"))
            .agg(F.count(F.lit(1)).alias("users_count"))
            .select(month_key(F.col("month")).alias("month_key"), "stage", "users_count"))


def lifecycle_transitions(orders: DataFrame, user: str, at: str) -> DataFrame:
    rows = _purchase_spells(orders, user, at).where("m < last_m").withColumn(
        "month", F.explode(F.sequence(F.col("m"), F.least(F.col("until_m"), F.col("last_m") - 1))))
    m, month = F.col("m"), F.col("month")
    to_stage = F.when(month + 1 == F.col("next_m"), "Active").otherwise(_stage(m, month + 1, F.lit(False)))
    return (rows.groupBy("month", _stage(m, month, F.col("is_first")).alias("from_stage"), to_stage.alias("to_stage"))
            .agg(F.count(F.lit(1)).alias("users_count"))
            .select(month_key(F.col("month")).alias("from_month"), "from_stage", "to_stage", "users_count"))


def ltv_deciles(rfm: DataFrame) -> DataFrame:
    buyers = rfm.where("orders_count >= 1")
    tiled = tiles(buyers, 10, {"decile": -(money("monetary_total") * 100).cast("long")}, "user_pseudo_id")
    by_decile = tiled.groupBy("decile").agg(
        F.count(F.lit(1)).alias("users_count"), F.sum(money("monetary_total")).alias("monetary_sum"),
        exact_round(F.avg(F.col("aov").cast("decimal(18,2)")), 2).alias("avg_aov"),
        exact_round(F.avg(F.col("orders_count").cast("decimal(18,0)")), 2).alias("avg_orders"))
    total = F.sum("monetary_sum").over(Window.partitionBy())  # ten rows
    upto = F.sum("monetary_sum").over(Window.orderBy("decile"))
    return by_decile.withColumns({"monetary_share": ratio(F.col("monetary_sum"), total, 4),
                                  "cum_share": ratio(upto, total, 4)})


def product_pareto(catalog: DataFrame) -> DataFrame:
    """Revenue rank and running share over the whole catalogue, range-partitioned by revenue."""
    cols = ["item_id", "item_name", "item_category", "revenue_total", "users_viewed", "view_to_purchase_user_rate"]
    rows = ranked(catalog.select(*cols), [], [("revenue_total", "desc")], "revenue_rank")
    rows = ordered_prefix(rows, [F.col("revenue_total").desc(), F.col("item_id").asc()],
                          running={"_upto": "revenue_total"})
    total = catalog.agg(F.sum("revenue_total").alias("_total"))
    return (rows.transform(attach, total)
            .withColumn("revenue_share", ratio(F.col("revenue_total"), F.col("_total"), 6))
            .withColumn("cum_revenue_share", ratio(F.col("_upto"), F.col("_total"), 6))
            .withColumn("in_top80", F.col("cum_revenue_share") <= 0.8)
            .drop("_upto", "_total", "row_number"))


# --- attribution ------------------------------------------------------------------------

def conversions(events: DataFrame) -> DataFrame:
    return events.where("event_name = 'purchase' and transaction_id is not null").groupBy(
        "user_pseudo_id", "transaction_id").agg(
        F.max("event_ts_micros").alias("at"), F.sum(money("item_revenue")).cast("double").alias("revenue"))


def touch_list(touches: DataFrame) -> DataFrame:
    return touches.select("user_pseudo_id", F.col("session_start_micros").alias("at"),
                          F.col("ga_session_id").alias("touch_id"),
                          F.concat_ws(" / ", "session_source", "session_medium").alias("channel"))


def _journey_bounds(touches: DataFrame, buys: DataFrame, lookback_days: int, half_life_days: float):
    """Number each user's touches by time and find, per conversion, which run of them it saw.

    A conversion at p sees the touches with p - lookback <= at <= p. Both edges become marker
    rows in the same ordering, so the run is (count at lower edge, count at p]: no touch is ever
    paired with a conversion, and a hot user spreads over many tasks.
    """
    touches, buys = cut(touches), cut(buys)  # both are read twice below
    span = lookback_days * MICROS_PER_DAY
    newest = touches.agg(F.max("at").alias("_newest"))
    weight = F.pow(F.lit(2.0), (F.col("at") - F.col("_newest")) / F.lit(float(half_life_days * MICROS_PER_DAY)))
    points = touches.transform(attach, newest).select(
        "user_pseudo_id", "at", F.lit(1).alias("kind"), F.col("touch_id").cast("string").alias("id"),
        "channel", F.lit(None).cast("double").alias("revenue"), F.lit(1).alias("is_touch"), weight.alias("weight"))
    edge = lambda kind, at: buys.select(
        "user_pseudo_id", at.alias("at"), F.lit(kind).alias("kind"), F.col("transaction_id").alias("id"),
        F.lit(None).cast("string").alias("channel"), "revenue", F.lit(0).alias("is_touch"), F.lit(0.0).alias("weight"))
    rows = points.unionByName(edge(0, F.col("at") - span)).unionByName(edge(2, F.col("at")))
    placed = ordered_prefix(rows, [F.col("at").asc(), F.col("kind").asc(), F.col("id").asc()],
                            ["user_pseudo_id"], {"seen": "is_touch", "seen_weight": "weight"})
    numbered = placed.where("kind = 1").select("user_pseudo_id", F.col("seen").alias("idx"), "channel", "weight", "at")
    at_edge = lambda c, kind: F.max(F.when(F.col("kind") == kind, F.col(c)))
    journeys = placed.where("kind <> 1").groupBy("user_pseudo_id", F.col("id").alias("transaction_id")).agg(
        F.max("revenue").alias("revenue"), at_edge("at", 2).alias("at"),
        at_edge("seen", 0).alias("before"), at_edge("seen", 2).alias("upto"),
        (at_edge("seen_weight", 2) - at_edge("seen_weight", 0)).alias("weights"))
    return numbered, journeys.withColumn("touches", F.col("upto") - F.col("before"))


def journeys(touches: DataFrame, buys: DataFrame, lookback_days: int = 30) -> DataFrame:
    """Per conversion: how many touches it saw, and the first and last channel."""
    numbered, found = _journey_bounds(touches, buys, lookback_days, 7)
    pick = lambda name: numbered.select("user_pseudo_id", F.col("idx").alias(f"_{name}"),
                                        F.col("channel").alias(f"{name}_channel"))
    ends = found.withColumn("_first", F.when(F.col("touches") > 0, F.col("before") + 1)).withColumn(
        "_last", F.when(F.col("touches") > 0, F.col("upto")))
    return (ends.join(pick("first"), ["user_pseudo_id", "_first"], "left")
            .join(pick("last"), ["user_pseudo_id", "_last"], "left")
            .select("user_pseudo_id", "transaction_id", "revenue", "touches", "first_channel", "last_channel"))


def attribution(touches: DataFrame, buys: DataFrame, lookback_days: int = 30, half_life_days: float = 7) -> DataFrame:
    """Revenue per channel under four models; every model conserves total revenue.

    Shared credit is a running sum over the touch numbers: a conversion adds its unit credit at
    its last touch and takes it back just before its first, reading from the newest touch down.
    """
    numbered, found = _journey_bounds(touches, buys, lookback_days, half_life_days)
    seen = found.where("touches > 0")
    step = lambda idx, sign: seen.select("user_pseudo_id", F.col(idx).alias("idx"), *[
        (F.lit(sign) * e).alias(n) for n, e in (
            ("lin_r", F.col("revenue") / F.col("touches")), ("lin_c", F.lit(1.0) / F.col("touches")),
            ("dec_r", F.col("revenue") / F.col("weights")), ("dec_c", F.lit(1.0) / F.col("weights")), ("cover", F.lit(1.0)))])
    sums = ["lin_r", "lin_c", "dec_r", "dec_c", "cover"]
    steps = (step("upto", 1.0).unionByName(step("before", -1.0)).where("idx > 0")
             .groupBy("user_pseudo_id", "idx").agg(*[F.sum(c).alias(c) for c in sums]))
    rows = (numbered.join(steps, ["user_pseudo_id", "idx"], "left").na.fill(0.0, sums))
    shared = ordered_prefix(rows, [F.col("idx").desc()], ["user_pseudo_id"], {f"u_{c}": c for c in sums})
    shared = shared.where("u_cover > 0")  # touches no conversion saw get no credit row
    credit = lambda model, r, c: F.struct(F.lit(model).alias("model"), r.alias("r"), c.alias("c"))
    w = F.col("weight")
    spread = shared.select("channel", F.explode(F.array(
        credit("linear", F.col("u_lin_r"), F.col("u_lin_c")),
        credit("time_decay", w * F.col("u_dec_r"), w * F.col("u_dec_c")))).alias("x")).select("channel", "x.*")
    ends = (seen.select("user_pseudo_id", "revenue", F.explode(F.array(
                F.struct(F.lit("first_touch").alias("model"), (F.col("before") + 1).alias("idx")),
                F.struct(F.lit("last_touch").alias("model"), F.col("upto").alias("idx")))).alias("e"))
            .groupBy("user_pseudo_id", "e.idx", "e.model").agg(F.sum("revenue").alias("r"), F.count(F.lit(1)).cast("double").alias("c"))
            .join(numbered.select("user_pseudo_id", "idx", "channel"), ["user_pseudo_id", "idx"])
            .select("channel", "model", "r", "c"))
    models = F.array(*[F.lit(m) for m in ("first_touch", "last_touch", "linear", "time_decay")])
    unseen = found.where("touches = 0").select(F.lit("(direct) / (none)").alias("channel"), F.explode(models).alias("model"),
                                               F.col("revenue").alias("r"), F.lit(1.0).alias("c"))
    out = spread.unionByName(ends).unionByName(unseen).groupBy("model", F.col("channel").alias("source_medium")).agg(
        F.sum("r").alias("_r"), F.sum("c").alias("_c"))
    share = F.col("_r") / F.sum("_r").over(Window.partitionBy("model"))  # one row per channel
    return out.select("model", "source_medium", exact_round(F.col("_r"), 4).alias("attributed_revenue"),
                      exact_round(F.col("_c"), 4).alias("attributed_conversions"), exact_round(share, 4).alias("revenue_share"))


def rank_shift(attributed: DataFrame, base: str = "last_touch") -> DataFrame:
    """How far each channel's revenue rank moves from the base model. One row per channel and model."""
    by_revenue = Window.partitionBy("model").orderBy(F.col("attributed_revenue").desc(), "source_medium")
    rows = attributed.where("attributed_revenue > 0").withColumn("revenue_rank", F.row_number().over(by_revenue))
    wide = rows.groupBy("source_medium").pivot("model", ["first_touch", "last_touch", "linear", "time_decay"]).agg(F.max("revenue_rank"))
    shifts = {f"{m}_shift": F.col(base) - F.col(m) for m in ("first_touch", "linear", "time_decay")}
    return wide.withColumns(shifts)


# --- baskets ----------------------------------------------------------------------------

def basket_rules(baskets: DataFrame, min_support: float = 0.01, min_confidence: float = 0.3, top: int = 100) -> DataFrame:
    total = baskets.agg(F.countDistinct("basket").alias("n")).first()["n"]
    least = max(1, -(-int(round(min_support * total * 1_000_000)) // 1_000_000))
    found = rules(baskets, frequent_pairs(baskets, least), total)
    return found.where(F.col("confidence") >= min_confidence).orderBy(
        F.col("lift").desc(), "antecedent", "consequent").limit(top)


def bought_together(baskets: DataFrame, min_cooccur: int = 5, min_confidence: float = 0.05, top: int = 20) -> DataFrame:
    total = baskets.agg(F.countDistinct("basket").alias("n")).first()["n"]
    found = rules(baskets, frequent_pairs(baskets, min_cooccur), total)
    kept = found.where((F.col("confidence") >= min_confidence) & (F.col("lift") > 1))
    return top_n(kept, ["antecedent"], [F.col("lift").desc(), F.col("co_count").desc(), F.col("consequent")], top, "rule_rank")


# --- churn and retention ----------------------------------------------------------------

def churn_dataset(events: DataFrame, feature_end: str, label_days: int) -> DataFrame:
    """Features up to ``feature_end`` and the label from the days after it, in one pass per user."""
    end = F.lit(feature_end).cast("date")
    day, bought = F.col("event_date"), F.col("event_name") == "purchase"
    obs, lab = day <= end, (day > end) & (day <= F.date_add(end, label_days))
    agg = events.groupBy("user_pseudo_id").agg(
        F.max(F.when(obs & bought, day)).alias("_last"),
        F.countDistinct(F.when(obs & bought, F.col("transaction_id"))).alias("frequency_obs"),
        F.sum(F.when(obs & bought, money("item_revenue")).otherwise(0)).cast("double").alias("monetary_obs"),
        F.countDistinct(F.when(obs, day)).alias("active_days_obs"),
        F.count_if(obs & (F.col("event_name") == "add_to_cart")).alias("cart_events_obs"),
        F.count_if(obs & (F.col("event_name") == "view_item")).alias("view_events_obs"),
        F.count_if(lab & bought).alias("_later"))
    return agg.where("frequency_obs > 0").select(
        "user_pseudo_id", F.datediff(end, "_last").alias("recency_obs"), "frequency_obs", "monetary_obs",
        "active_days_obs", "cart_events_obs", "view_events_obs",
        exact_round(F.col("monetary_obs") / F.col("frequency_obs"), 2).cast("double").alias("aov_obs"),
        (F.col("_later") == 0).cast("long").alias("churned"))


CHURN_FEATURES = ["recency_obs", "frequency_obs", "monetary_obs", "active_days_obs",
                  "cart_events_obs", "view_events_obs", "aov_obs"]


def churn_scores(data: DataFrame, seed: int = 42, min_gain: float = 0.05) -> DataFrame:
    """Logistic regression against boosted trees against the recency rule, gated on PR-AUC."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import GBTClassifier, LogisticRegression
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    from pyspark.ml.feature import StandardScaler, VectorAssembler
    from pyspark.ml.functions import vector_to_array

    data = data.withColumn("label", F.col("churned").cast("double")).withColumn(
        "_test", F.pmod(F.xxhash64("user_pseudo_id", F.lit(seed)), F.lit(10)) < 3)
    prep = [VectorAssembler(inputCols=CHURN_FEATURES, outputCol="raw"),
            StandardScaler(inputCol="raw", outputCol="features", withMean=True)]
    judge = BinaryClassificationEvaluator(rawPredictionCol="score", metricName="areaUnderPR")
    train, test = data.where("not _test"), data.where("_test")
    best = (judge.evaluate(test.withColumn("score", F.col("recency_obs").cast("double"))), "recency_rule", None)
    floor = best[0] * (1 + min_gain)
    for name, learner in (("logistic", LogisticRegression(maxIter=50)),
                          ("boosted_trees", GBTClassifier(maxIter=10, maxDepth=3, seed=seed))):
        model = Pipeline(stages=[*prep, learner]).fit(train)
        score = model.transform(test).withColumn("score", vector_to_array("probability")[1])
        found = judge.evaluate(score)
        if found >= floor and found > best[0]:
            best = (found, name, model)
    pr_auc, name, model = best
    if model is None:  # the rule wins: publish its scores, scaled to 0..1
        top = data.agg(F.max("recency_obs").alias("_top"))
        scored = data.transform(attach, top).withColumn("churn_probability", F.col("recency_obs") / F.greatest("_top", F.lit(1)))
    else:
        scored = model.transform(data).withColumn("churn_probability", vector_to_array("probability")[1])
    p = F.col("churn_probability")
    return scored.select("user_pseudo_id", p, F.when(p >= 0.7, "high").when(p >= 0.4, "mid").otherwise("low").alias("risk_band"),
                         F.lit(name).alias("model_name"), F.lit(float(pr_auc)).alias("pr_auc"), *CHURN_FEATURES, "churned")


def decile_lift(scored: DataFrame, score: str, label: str, key: str) -> DataFrame:
    tiled = ntile(scored, 10, [F.col(score).desc(), F.col(key).asc()], "decile")
    rates = tiled.groupBy("decile").agg(F.count(F.lit(1)).alias("users_count"), F.sum(label).alias("positives"))
    overall = F.sum("positives").over(Window.partitionBy()) / F.sum("users_count").over(Window.partitionBy())
    rate = F.col("positives") / F.col("users_count")
    return rates.select("decile", "users_count", "positives", exact_round(rate, 4).alias("rate"),
                        exact_round(rate / F.nullif(overall, F.lit(0.0)), 4).alias("lift"))


def retention(events: DataFrame) -> DataFrame:
    """Week-by-week retention. Users are reduced to their active weeks before any window."""
    weeks = events.select("user_pseudo_id", F.date_trunc("week", "event_date").cast("date").alias("week")).distinct()
    first = F.min("week").over(Window.partitionBy("user_pseudo_id"))
    return (weeks.withColumn("cohort_week", first)
            .groupBy("cohort_week", F.expr("datediff(week, cohort_week) div 7").alias("week_offset"))
            .agg(F.count(F.lit(1)).alias("users_count")))
