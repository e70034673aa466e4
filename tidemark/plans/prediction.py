"""Early-signal prediction: labels, features known at the time, split, models, drift."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.functions import text as tx
from tidemark.functions.numeric import exact_round, hours_between
from tidemark.operators.ordering import ordered_prefix
from tidemark.operators.scalars import attach
from tidemark.plans.marts import velocity_unranked
from tidemark.sources.store import upsert

KEY = ["video_id", "region"]
# Time zone of each region, bins and limits of the drift rules.
ZONES = {"TW": "Asia/Taipei", "JP": "Asia/Tokyo", "KR": "Asia/Seoul", "HK": "Asia/Hong_Kong", "US": "America/New_York",
         "GB": "Europe/London", "SG": "Asia/Singapore", "AU": "Australia/Sydney"}
BINS, PSI_LIMIT, PSI_FEATURES, AUC_FLOOR, EMPTY_SHARE = 10, 0.2, 2, 0.60, 1e-4


def _since_first(stg: DataFrame) -> DataFrame:
    """Snapshots with the video's first time and views; one video has one row per hour."""
    w = Window.partitionBy(*KEY).orderBy("captured_at")
    return stg.withColumns({"t0": F.first("captured_at").over(w), "v0": F.first("views").over(w)})


def doubled_in_24h(stg: DataFrame) -> DataFrame:
    """1 when the snapshot nearest to t0 + 24 h, within (20 h, 30 h], has at least twice the first views."""
    rows = _since_first(stg.select(*KEY, "captured_at", "views"))
    age = hours_between(F.col("captured_at"), F.col("t0"))
    window = rows.where((age > 20) & (age <= 30))
    nearest = F.min_by("views", F.struct(F.abs(age - 24), F.col("captured_at")))
    return window.groupBy(*KEY, "t0", "v0").agg(nearest.alias("v24")).withColumn(
        "label", (F.col("v24") >= 2 * F.col("v0")).cast("long"))


def features(stg: DataFrame) -> DataFrame:
    """Only what is known three hours after the first snapshot."""
    rates = velocity_unranked(stg).select(*KEY, "captured_at", "delta_views_per_hour")
    rows = _since_first(stg)
    early = hours_between(F.col("captured_at"), F.col("t0")) <= 3
    known = rows.where(early).join(rates, [*KEY, "captured_at"], "left")
    first = F.min_by(F.struct("title", "description", "tags", "published_at", "category_id", "engagement_rate"), "captured_at")
    agg = known.groupBy(*KEY, "t0", "v0").agg(
        first.alias("f"), F.avg(F.col("delta_views_per_hour").cast("double")).alias("_rate"), F.count("delta_views_per_hour").alias("_n"))
    zone = F.create_map(*[F.lit(x) for pair in ZONES.items() for x in pair])[F.col("region")]
    local = F.from_utc_timestamp("f.published_at", zone)
    hour = F.hour(local)
    size = lambda c: F.coalesce(F.length(c), F.lit(0))
    return agg.select(
        *KEY, "t0", size("f.title").alias("title_len_chars"),
        tx.count_of(F.col("f.title"), r"[^ ]+").alias("title_word_count"),
        tx.count_of(F.col("f.title"), r"[\x{1F300}-\x{1FAFF}\x{2600}-\x{27BF}]").alias("title_emoji_count"),
        tx.count_of(F.col("f.title"), r"[!?！？]").alias("title_punct_count"),
        size("f.description").alias("desc_len_chars"),
        F.when(size("f.tags") == 0, 0).otherwise(F.size(F.split("f.tags", ","))).alias("tag_count"),
        hour.alias("publish_hour_local"), F.weekday(local).alias("publish_dow"),
        hour.between(19, 23).cast("long").alias("is_prime_time"),
        exact_round(hours_between(F.col("t0"), F.col("f.published_at")), 2).alias("video_age_hours_at_entry"),
        exact_round(F.log1p("v0"), 6).alias("log1p_first_views"),
        exact_round(F.log1p(F.greatest(F.coalesce("_rate", F.lit(0.0)), F.lit(0.0))), 6).alias("log1p_early_velocity_3h"),
        (F.col("_n") > 0).cast("long").alias("has_early_velocity"),
        exact_round(F.col("f.engagement_rate"), 6).alias("early_engagement_rate"), F.col("f.category_id").alias("category_id"))


def temporal_split(rows: DataFrame, train_share: float = 0.8) -> DataFrame:
    """The first share of rows by time trains; ties in time are broken by key."""
    placed = ordered_prefix(rows, [F.col("t0").asc(), *[F.col(c).asc() for c in KEY]], group_rows="_n")
    part = F.when(F.col("row_number") <= F.floor(F.col("_n") * F.lit(train_share)), "train").otherwise("test")
    return placed.withColumn("split", part).drop("row_number", "_n")


def fit_models(data: DataFrame, numeric: Sequence[str], seed: int = 42) -> DataFrame:
    """Forest against logistic regression against the prior, judged on the later rows."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
    from pyspark.ml.functions import vector_to_array

    spark = data.sparkSession
    data = data.withColumn("label", F.col("label").cast("double")).na.fill("none", ["category_id"]).na.fill(0)
    train, test = data.where("split = 'train'"), data.where("split = 'test'")
    prep = [StringIndexer(inputCols=["region", "category_id"], outputCols=["_r", "_c"], handleInvalid="keep"),
            OneHotEncoder(inputCols=["_r", "_c"], outputCols=["_rv", "_cv"]),
            VectorAssembler(inputCols=list(numeric), outputCol="_num"), StandardScaler(inputCol="_num", outputCol="_std", withMean=True),
            VectorAssembler(inputCols=["_std", "_rv", "_cv"], outputCol="x")]
    prior = train.agg(F.avg("label")).first()[0] or 0.0
    scored = {"prior": test.withColumn("score", F.lit(float(prior)))}
    for name, learner in (("logistic", LogisticRegression(featuresCol="x", maxIter=50)),
                          ("forest", RandomForestClassifier(featuresCol="x", numTrees=50, maxDepth=6, minInstancesPerNode=5, seed=seed))):
        scored[name] = Pipeline(stages=[*prep, learner]).fit(train).transform(test).withColumn("score", vector_to_array("probability")[1])
    rows = []
    for name, df in scored.items():
        df = df.select("label", F.col("score").cast("double").alias("score")).persist()
        auc = {m: BinaryClassificationEvaluator(rawPredictionCol="score", metricName=m).evaluate(df) for m in ("areaUnderROC", "areaUnderPR")}
        hit = F.col("score") >= 0.5
        s = df.agg(F.avg((F.col("score") - F.col("label")) ** 2).alias("brier"), F.count_if(hit & (F.col("label") == 1)).alias("tp"),
                   F.count_if(hit & (F.col("label") == 0)).alias("fp"), F.count_if(~hit & (F.col("label") == 1)).alias("fn"),
                   F.count_if(~hit & (F.col("label") == 0)).alias("tn")).first()
        f1 = 2 * s["tp"] / max(1, 2 * s["tp"] + s["fp"] + s["fn"])
        rows.append((name, auc["areaUnderROC"], auc["areaUnderPR"], s["brier"], f1, s["tp"], s["fp"], s["fn"], s["tn"]))
        df.unpersist()
    return spark.createDataFrame(rows, "model string, roc_auc double, pr_auc double, brier double, f1 double, tp long, fp long, fn long, tn long")


def score_new(rows: DataFrame, scored: DataFrame, score: Column) -> DataFrame:
    """Score rows that have none yet and add them to the scored table."""
    fresh = rows.join(scored.select(*KEY), KEY, "left_anti").select(*KEY, score.alias("score"))
    return upsert(scored.select(*KEY, "score"), fresh, KEY, check_keys=False)


# --- drift ------------------------------------------------------------------------------

def psi(rows: DataFrame, feature_columns: Sequence[str], is_reference: Column) -> DataFrame:
    """Population stability per feature over ten equal bins frozen from the reference rows.

    Bin edges are one small row; only bin counts are shuffled.
    """
    named = F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("x")) for c in feature_columns]))
    flat = rows.select(is_reference.alias("ref"), named.alias("f")).select("ref", "f.*").where("x is not null")
    edges = flat.where("ref").groupBy("feature").agg(F.min("x").alias("lo"), F.max("x").alias("hi"))
    place = F.floor((F.col("x") - F.col("lo")) / F.nullif(F.col("hi") - F.col("lo"), F.lit(0.0)) * BINS)
    binned = flat.join(F.broadcast(edges), "feature").withColumn(
        "bin", F.greatest(F.lit(0), F.least(F.lit(BINS - 1), F.coalesce(place, F.lit(0)))))
    counts = binned.groupBy("feature", "bin").agg(F.count_if("ref").alias("r"), F.count_if(~F.col("ref")).alias("c"))
    every = Window.partitionBy("feature")  # ten bins
    share = lambda c: F.greatest(F.col(c) / F.sum(c).over(every), F.lit(EMPTY_SHARE))
    shares = counts.select("feature", share("c").alias("a"), share("r").alias("b"))
    return shares.groupBy("feature").agg(exact_round(F.sum((F.col("a") - F.col("b")) * F.log(F.col("a") / F.col("b"))), 6).alias("psi"))


def ks_statistic(rows: DataFrame, column: str, is_reference: Column) -> DataFrame:
    """The largest distance of two empirical distributions, from counts per distinct value."""
    counts = rows.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("x")).agg(
        F.count_if(is_reference).alias("r"), F.count_if(~is_reference).alias("c"))
    totals = counts.agg(F.sum("r").cast("double").alias("nr"), F.sum("c").cast("double").alias("nc"))
    upto = ordered_prefix(counts, [F.col("x").asc()], running={"fr": "r", "fc": "c"})
    gap = F.abs(F.col("fr") / F.col("nr") - F.col("fc") / F.col("nc"))
    return upto.transform(attach, totals).agg(exact_round(F.max(gap), 6).alias("ks"))


def rolling_auc(scored: DataFrame, day: str, score: str, label: str, days: int = 7) -> DataFrame:
    """ROC-AUC over the trailing days, for every day, by rank sums over distinct scores.

    Each row counts in at most ``days`` windows and is summed per score in the map task.
    """
    last = scored.agg(F.max(day).alias("_last"))
    per_day = scored.groupBy(F.col(day).alias("_d"), F.col(score).alias("s")).agg(
        F.sum(F.col(label).cast("long")).alias("p"), F.sum(1 - F.col(label).cast("long")).alias("q"))
    spread = per_day.transform(attach, last).withColumn(
        "as_of", F.explode(F.sequence("_d", F.least(F.date_add("_d", days - 1), F.col("_last")))))
    per_score = spread.groupBy("as_of", "s").agg(F.sum("p").alias("p"), F.sum("q").alias("q"))
    below = ordered_prefix(per_score, [F.col("s").asc()], ["as_of"], {"qs": "q"})
    wins = F.col("p").cast("double") * (F.col("qs") - F.col("q") / 2)
    out = below.groupBy("as_of").agg(F.sum(wins).alias("w"), F.sum("p").cast("double").alias("np"), F.sum("q").cast("double").alias("nq"))
    return out.select("as_of", exact_round(F.col("w") / F.nullif(F.col("np") * F.col("nq"), F.lit(0.0)), 6).alias("auc"))


def drift_trigger(psis: DataFrame, aucs: DataFrame) -> DataFrame:
    newest = aucs.agg(F.max_by("auc", "as_of").cast("double").alias("auc"))
    moved = psis.agg(F.count_if(F.col("psi") > PSI_LIMIT).alias("features_moved"))
    return moved.transform(attach, newest).withColumn(
        "retrain", (F.col("features_moved") >= PSI_FEATURES) | F.coalesce(F.col("auc") < AUC_FLOOR, F.lit(False)))
