"""Offline ranking metrics, gates and the two-proportion test."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.functions.numeric import exact_round
from tidemark.operators.ordering import top_n
from tidemark.operators.scalars import attach


def rank_metrics(ranked: DataFrame, judged: DataFrame, keys: Sequence[str], k: int = 10,
                 relevant_from: int = 1) -> DataFrame:
    """hit, recall, nDCG, MAP and MRR at ``k`` per variant, averaged over all judged queries.

    ``ranked`` holds (variant, *keys, item_id, rank); ``judged`` holds (*keys, item_id, grade > 0).
    hit, recall, MAP and MRR count grades from ``relevant_from``; nDCG uses every grade.
    A query a variant found nothing for counts as zero. Only the first ``k`` ranks are windowed.
    """
    top = ranked.where(F.col("rank") <= k).join(judged, [*keys, "item_id"])
    rel = F.col("grade") >= relevant_from
    seen = F.count_if(rel).over(Window.partitionBy("variant", *keys).orderBy("rank"))  # at most k rows
    discount = F.log2(F.col("rank") + 1)
    gain = F.pow(F.lit(2.0), F.col("grade")) - 1
    got = (top.withColumn("_seen", seen).groupBy("variant", *keys).agg(
        F.count_if(rel).alias("hits"), F.sum(gain / discount).alias("dcg"),
        F.sum(F.when(rel, F.col("_seen") / F.col("rank")).otherwise(0.0)).alias("precisions"),
        F.min(F.when(rel, F.col("rank"))).alias("first")))
    best = top_n(judged, keys, [F.col("grade").desc(), F.col("item_id").asc()], k, "_i")
    best = best.groupBy(*keys).agg(F.sum(gain / F.log2(F.col("_i") + 1)).alias("idcg"))
    ideal = judged.groupBy(*keys).agg(F.count_if(rel).alias("relevant")).join(best, list(keys))
    variants = F.array_sort(F.collect_set("variant"))
    every = ideal.transform(attach, ranked.agg(variants.alias("_v"))).withColumn("variant", F.explode("_v")).drop("_v")
    rows = every.join(got, ["variant", *keys], "left").na.fill(0)
    per_query = {
        "hit": (F.col("hits") > 0).cast("double"),
        "recall": F.coalesce(F.col("hits") / F.nullif(F.col("relevant").cast("double"), F.lit(0.0)), F.lit(0.0)),
        "ndcg": F.coalesce(F.col("dcg") / F.nullif(F.col("idcg"), F.lit(0.0)), F.lit(0.0)),
        "map": F.coalesce(F.col("precisions") / F.nullif(F.least("relevant", F.lit(k)).cast("double"), F.lit(0.0)), F.lit(0.0)),
        "mrr": F.when(F.col("first") > 0, 1.0 / F.col("first")).otherwise(0.0)}
    out = rows.groupBy("variant").agg(F.count(F.lit(1)).alias("queries"),
                                      *[F.avg(e).alias(n) for n, e in per_query.items()])
    pairs = ", ".join(f"'{n}', {n}" for n in per_query)
    return out.select("variant", "queries", F.expr(f"stack({len(per_query)}, {pairs}) AS (metric, value)")).withColumn(
        "value", exact_round(F.col("value"), 6)).withColumn("k", F.lit(k))


def promotion_gate(metrics: DataFrame, candidate: str, baseline: str, production: str | None = None,
                   floor: float = 0.15, slack: float = 0.02) -> DataFrame:
    """Absolute floor, better than the baseline, and no worse than production less the slack."""
    ndcg = metrics.where("metric = 'ndcg'")
    of = lambda name: F.max(F.when(F.col("variant") == name, F.col("value")).cast("double"))
    row = ndcg.agg(of(candidate).alias("candidate"), of(baseline).alias("baseline"),
                   (of(production) if production else F.lit(None).cast("double")).alias("production"))
    rules = {"passes_floor": F.col("candidate") >= floor, "beats_baseline": F.col("candidate") > F.col("baseline"),
             "holds_production": F.col("production").isNull() | (F.col("candidate") >= F.col("production") - slack)}
    row = row.withColumns(rules)
    return row.withColumn("promoted", F.col("passes_floor") & F.col("beats_baseline") & F.col("holds_production"))


def normal_cdf(z: Column) -> Column:
    """Upper-tail polynomial approximation of the normal distribution, error below 7.5e-8."""
    x = F.abs(z)
    t = 1.0 / (1.0 + 0.2316419 * x)
    poly = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    tail = F.exp(-x * x / 2) * 0.3989422804014327 * poly
    return F.when(z >= 0, 1.0 - tail).otherwise(tail)


def two_proportions(summary: DataFrame, arm: str, n: str, hits: str, a: str = "A", b: str = "B") -> DataFrame:
    """z, two-sided p and the 95 % interval of the difference, from one row per arm."""
    of = lambda c, name: F.max(F.when(F.col(arm) == name, F.col(c))).cast("double")
    row = summary.agg(of(n, a).alias("na"), of(n, b).alias("nb"), of(hits, a).alias("ha"), of(hits, b).alias("hb"))
    row = row.selectExpr("*", "ha / na AS pa", "hb / nb AS pb", "(ha + hb) / (na + nb) AS p")
    row = row.selectExpr("*", "pa - pb AS diff", "sqrt(p * (1 - p) * (1 / na + 1 / nb)) AS se",
                         "sqrt(pa * (1 - pa) / na + pb * (1 - pb) / nb) AS se_diff")
    z = F.col("diff") / F.nullif(F.col("se"), F.lit(0.0))
    return row.select(
        exact_round(F.col("pa"), 6).alias("rate_a"), exact_round(F.col("pb"), 6).alias("rate_b"),
        exact_round(z, 6).alias("z"), exact_round(2 * (1 - normal_cdf(F.abs(z))), 6).alias("p_value"),
        exact_round(F.col("diff") - 1.959964 * F.col("se_diff"), 6).alias("ci_low"),
        exact_round(F.col("diff") + 1.959964 * F.col("se_diff"), 6).alias("ci_high"))
