"""Value clusters beside the rule tiers: features, model choice, naming, agreement."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.functions.numeric import exact_round, ratio
from tidemark.operators.ordering import ordered_prefix
from tidemark.operators.scalars import attach

# Vector order with the columns that are log-compressed, and names by rank of spend.
FEATURES = [("recency_days", False), ("frequency_orders", False), ("monetary_total", True), ("engagement_score", True)]
CLUSTER_NAMES = {
    2: ["高消費群", "低消費群"],
    3: ["高消費群", "中消費群", "低消費群"],
    4: ["高消費群", "中高消費群", "中低消費群", "低消費群"],
    5: ["高消費群", "中高消費群", "中消費群", "中低消費群", "低消費群"],
    6: ["高消費群", "中高消費群", "中消費群", "中低消費群", "低消費群", "極低消費群"],
}
SILHOUETTE_FLOOR, SILHOUETTE_SLACK = 0.15, 0.02


def feature(name: str, log: bool) -> Column:
    c = F.col(name).cast("double")
    return F.log1p(c) if log else c


def buyers(profiles: DataFrame) -> DataFrame:
    return profiles.where("is_purchaser").select(
        "user_pseudo_id", *[feature(n, log).alias(f"x{i}") for i, (n, log) in enumerate(FEATURES)])


def standardised(rows: DataFrame) -> DataFrame:
    """Zero mean, unit population deviation, by one-row statistics."""
    cols = [f"x{i}" for i in range(len(FEATURES))]
    stats = rows.agg(*[F.avg(c).alias(f"m{c}") for c in cols], *[F.stddev_pop(c).alias(f"s{c}") for c in cols])
    scaled = {c: (F.col(c) - F.col(f"m{c}")) / F.when(F.col(f"s{c}") > 0, F.col(f"s{c}")).otherwise(1.0) for c in cols}
    return rows.transform(attach, stats).withColumns(scaled).select("user_pseudo_id", *cols)


def fit_clusters(profiles: DataFrame, ks: Sequence[int] = range(2, 7), seed: int = 42):
    """Scan k by silhouette, ties to the smaller k. Returns (assignments, model facts)."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.evaluation import ClusteringEvaluator
    from pyspark.ml.feature import VectorAssembler

    cols = [f"x{i}" for i in range(len(FEATURES))]
    vectors = VectorAssembler(inputCols=cols, outputCol="features").transform(standardised(buyers(profiles))).persist()
    scan = []
    for k in ks:
        model = KMeans(k=k, seed=seed, initSteps=5, maxIter=50).fit(vectors)
        if len(model.clusterCenters()) < 2:
            continue
        silhouette = ClusteringEvaluator().evaluate(model.transform(vectors))
        scan.append((round(silhouette, 4), -k, model))
    silhouette, neg_k, model = max(scan, key=lambda s: s[:2])
    assigned = model.transform(vectors).select("user_pseudo_id", F.col("prediction").alias("value_cluster"), *cols)
    facts = {"k": -neg_k, "silhouette": silhouette, "inertia": model.summary.trainingCost,
             "centres": [[round(float(v), 6) for v in c] for c in model.clusterCenters()]}
    return assigned, facts


def centroid_distance(scaled: DataFrame, centres: DataFrame) -> DataFrame:
    """Euclidean distance to the centre of the assigned cluster; at most six centres."""
    cols = [f"x{i}" for i in range(len(FEATURES))]
    near = F.broadcast(centres.select("value_cluster", *[F.col(c).alias(f"c_{c}") for c in cols]))
    squares = sum((F.pow(F.col(c) - F.col(f"c_{c}"), F.lit(2.0)) for c in cols), F.lit(0.0))
    return scaled.join(near, "value_cluster").select(
        "user_pseudo_id", "value_cluster", exact_round(F.sqrt(squares), 4).alias("distance_to_centroid"))


def medians(df: DataFrame, group: str, column: str, tiebreak: str) -> DataFrame:
    """Exact median per group by row number, so no group is collected."""
    placed = ordered_prefix(df, [F.col(column).asc(), F.col(tiebreak).asc()], [group], group_rows="_n")
    middle = placed.where(F.col("row_number").isin(F.expr("(_n + 1) div 2"), F.expr("(_n + 2) div 2")))
    return middle.groupBy(group).agg(exact_round(F.avg(F.col(column).cast("double")), 2).alias("median_monetary"))


def cluster_profiles(assigned: DataFrame, profiles: DataFrame) -> DataFrame:
    """Size and means per cluster; the rank of mean spend picks the name. At most six rows a window."""
    rows = assigned.select("user_pseudo_id", "value_cluster").join(profiles, "user_pseudo_id")
    mean = lambda c: F.sum(F.col(c).cast("decimal(18,4)")).cast("double") / F.count(F.lit(1))
    out = rows.groupBy("value_cluster").agg(
        F.count(F.lit(1)).alias("users_count"), exact_round(mean("recency_days"), 2).alias("avg_recency_days"),
        exact_round(mean("frequency_orders"), 2).alias("avg_frequency_orders"),
        exact_round(mean("monetary_total"), 2).alias("avg_monetary"),
        exact_round(mean("engagement_score"), 4).alias("avg_engagement_score"))
    everyone = Window.partitionBy()
    by_spend = Window.orderBy(F.col("avg_monetary").desc(), F.col("avg_frequency_orders").desc(),
                              F.col("avg_engagement_score").desc(), F.col("value_cluster").asc())
    names = F.create_map(*[x for k, labels in CLUSTER_NAMES.items()
                           for x in (F.lit(k), F.array(*[F.lit(n) for n in labels]))])
    out = (out.withColumn("_k", F.count(F.lit(1)).over(everyone)).withColumn("_rank", F.row_number().over(by_spend))
           .withColumn("value_cluster_label", F.element_at(names[F.col("_k").cast("int")], F.col("_rank")))
           .withColumn("pct_of_purchasers", ratio(F.col("users_count"), F.sum("users_count").over(everyone), 4)))
    return out.join(medians(rows, "value_cluster", "monetary_total", "user_pseudo_id"), "value_cluster").drop("_k", "_rank")


def crosstab(assigned: DataFrame, profiles: DataFrame) -> DataFrame:
    rows = (assigned.select("user_pseudo_id", "value_cluster").join(profiles.select("user_pseudo_id", "value_tier"), "user_pseudo_id")
            .groupBy("value_tier", "value_cluster").agg(F.count(F.lit(1)).alias("users_count")))
    tier = F.sum("users_count").over(Window.partitionBy("value_tier"))
    return rows.withColumn("pct_of_tier", ratio(F.col("users_count"), tier, 4))


def adjusted_rand(counts: DataFrame, a: str, b: str, n: str) -> DataFrame:
    """Agreement of two labelings from their contingency counts."""
    pairs = lambda c: F.sum(c.cast("double") * (c - 1) / 2)
    cells = counts.agg(pairs(F.col(n)).alias("cells"), F.sum(n).cast("double").alias("total"))
    side = lambda key, name: counts.groupBy(key).agg(F.sum(n).alias("m")).agg(pairs(F.col("m")).alias(name))
    out = cells.transform(attach, side(a, "pa")).transform(attach, side(b, "pb"))
    expected = F.col("pa") * F.col("pb") / (F.col("total") * (F.col("total") - 1) / 2)
    most = (F.col("pa") + F.col("pb")) / 2
    return out.select(exact_round((F.col("cells") - expected) / F.nullif(most - expected, F.lit(0.0)), 6).alias("ari"))


def version_gate(candidate: dict, active: dict | None) -> str:
    """keep (same fingerprint), activate (passes the floor and does not regress) or reject."""
    if active and (active["k"], active["centres"]) == (candidate["k"], candidate["centres"]):
        return "keep"
    floor = max(SILHOUETTE_FLOOR, active["silhouette"] - SILHOUETTE_SLACK) if active else SILHOUETTE_FLOOR
    return "activate" if candidate["silhouette"] >= floor else "reject"
