"""Mixing sources to target token counts by entropy balancing, in DataFrame functions alone.

Each document gets a rate between 0 and 2 that stays as near to 1 as the targets allow: the bounded entropy
w ln w + (2 - w) ln(2 - w) is least where the odds w / (2 - w) are exponentially tilted, exp(l * c), with c the
document's size over its source's mean and one dual variable l a source. The dual is convex; its derivative is
the source's expected tokens less its target. Newton steps, kept inside a shrinking bracket, solve it: each is
one aggregation over counts by (source, size), never over texts.

Rates become whole copies by rounding their running sum in order of size, so a source's error is at most half
the spread of its sizes; what is left is corrected by single copies of its smallest documents. Running sums are
taken over range-partitioned slices, so no source is one task; all sums are decimals, so reruns agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import cut, only, word_count, written
from tidemark.operators.ordering import ordered_prefix
from tidemark.operators.scalars import attach

MOST = 2  # copies of one document
EXACT = "decimal(38,12)"
STEPS = 60
CLOSE = 1e-7  # of its target, within which a source has converged


def targets(sizes: DataFrame, weights: tuple[int, ...], share: float) -> DataFrame:
    """(source, source_size, target) from (source, size): ``share`` of all sizes by weight.

    Sources in code-point order, null last, take ``weights`` in turn. A target stops at MOST times its
    source's size; what exceeds it is shared again by weight among the others until none is above.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    per = ordered_prefix(per.withColumn("_null", F.col("source").isNull().cast("int")), [F.col("_null"), F.col("source")], row_number="_n")
    turn = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.pmod(F.col("_n") - 1, F.lit(len(weights))) + 1).cast("int"))
    per = cut(per.select("source", "source_size", turn.alias("weight"), (MOST * F.col("source_size")).alias("top"), F.lit(False).alias("full")))
    while True:
        free = per.agg((F.sum("source_size") * share - F.sum(F.when(F.col("full"), F.col("top")).otherwise(0))).alias("left"),
                       F.sum(F.when(F.col("full"), 0).otherwise(F.col("weight"))).alias("weights"))
        fair = attach(per, free).withColumn("fair", F.col("weight") * F.col("left") / F.greatest(F.col("weights"), F.lit(1)))
        fair = cut(fair.withColumn("over", ~F.col("full") & (F.col("fair") > F.col("top"))))
        if not fair.where("over").limit(1).count():
            target = F.when(F.col("full"), F.col("top").cast("double")).otherwise(F.col("fair").cast("double"))
            return fair.select("source", "source_size", target.alias("target"))
        per = fair.select("source", "source_size", "weight", "top", (F.col("full") | F.col("over")).alias("full"))


def _rate(tilt: Column) -> Column:
    return F.lit(float(MOST)) / (1 + F.exp(-F.greatest(F.least(tilt, F.lit(700.0)), F.lit(-700.0))))


def tilts(counts: DataFrame, wanted: DataFrame) -> DataFrame:
    """(source, mean, tilt): the dual variable of each source; null where every rate is MOST."""
    mean = counts.groupBy("source").agg(F.sum("n").alias("docs"))
    at = wanted.join(mean, wanted["source"].eqNullSafe(mean["source"])).drop(mean["source"])
    at = at.withColumn("mean", F.greatest(F.col("source_size") / F.col("docs"), F.lit(1e-9)))
    solvable = (F.col("source_size") > 0) & (F.col("target") < MOST * F.col("source_size"))
    fixed = at.where(~solvable).select("source", "mean", F.lit(None).cast("double").alias("tilt"))
    at = cut(at.where(solvable).select("source", "mean", "target", F.lit(0.0).alias("tilt"), F.lit(-1e7).alias("low"), F.lit(1e7).alias("high")))
    for _ in range(STEPS):
        keyed = at.withColumnRenamed("source", "_s")
        c = F.col("size") / F.col("mean")
        rate = _rate(F.col("tilt") * c)
        tokens = F.col("n") * F.col("size") * rate
        got = counts.join(keyed, counts["source"].eqNullSafe(keyed["_s"])).groupBy("_s").agg(
            F.sum(tokens.cast(EXACT)).alias("tokens"), F.sum((tokens * (1 - rate / MOST) * c).cast(EXACT)).alias("slope"))
        got = got.select(F.col("_s").alias("_g"), F.col("tokens").cast("double").alias("tokens"), F.col("slope").cast("double").alias("slope"))
        at = keyed.join(got, keyed["_s"].eqNullSafe(got["_g"])).withColumnRenamed("_s", "source")
        excess = F.col("tokens") - F.col("target")
        at = at.withColumns({"off": F.abs(excess) / F.greatest(F.col("target"), F.lit(1.0)),
                             "low": F.when(excess < 0, F.col("tilt")).otherwise(F.col("low")),
                             "high": F.when(excess > 0, F.col("tilt")).otherwise(F.col("high"))})
        step = F.when(F.col("slope") > 0, F.col("tilt") - excess / F.col("slope"))
        inside = (step > F.col("low")) & (step < F.col("high"))
        # between bounds of one sign the geometric middle, else the plain one
        middle = F.when(F.col("low") * F.col("high") > 0, F.signum("low") * F.sqrt(F.col("low") * F.col("high"))).otherwise(
            (F.col("low") + F.col("high")) / 2)
        following = F.when(F.col("off") <= CLOSE, F.col("tilt")).when(inside, step).otherwise(middle)
        at = cut(at.select("source", "mean", "target", following.alias("tilt"), "low", "high", "off"))
        if (at.agg(F.max("off")).first()[0] or 0) <= CLOSE:
            break
        at = at.drop("off")
    return at.select("source", "mean", "tilt").unionByName(fixed)


def mix(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, id_col: str = "doc_id",
        text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(doc_id, source, size, source_size, target, rate, copies) per row.

    A null or blank text has size 0 and one copy. Null sources are one source, the last. Rows that repeat an
    id count each for themselves; a null id is an id like others. An empty table gives no rows.
    """
    sizes = only(docs, id_col, text_col, source_col).select(
        F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"))
    sizes = written(sizes, "sizes")
    counts = written(sizes.groupBy("source", "size").agg(F.count("*").alias("n")), "size-counts")
    wanted = written(targets(counts.select("source", (F.col("size") * F.col("n")).alias("size")), weights, share), "targets")
    solved = written(tilts(counts, wanted), "tilts")

    facts = wanted.join(solved.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    facts = facts.withColumnRenamed("source", "_f")
    rated = sizes.join(facts, sizes["source"].eqNullSafe(facts["_f"])).drop("_f")
    rate = F.when(F.col("size") == 0, F.lit(1.0)).when(F.col("tilt").isNull(), F.lit(float(MOST))).otherwise(
        _rate(F.col("tilt") * F.col("size") / F.col("mean")))
    rated = rated.select("doc_id", "source", "size", "source_size", "target", rate.cast("decimal(18,12)").alias("rate"))

    shuffled = F.xxhash64("doc_id")
    order = [F.col("size").desc(), F.col("_h"), F.col("doc_id")]
    placed = ordered_prefix(rated.withColumn("_h", shuffled), order, ["source"], {"upto": "rate"}, "_r")
    copies = F.round("upto").cast("long") - F.round(F.col("upto") - F.col("rate")).cast("long")
    placed = placed.select("doc_id", "source", "size", "source_size", "target", "rate", "_h", copies.alias("copies"))
    placed = written(placed, "rounded")

    left = placed.groupBy("source").agg((F.max("target") - F.sum(F.col("copies") * F.col("size"))).alias("left"))
    left = left.withColumnRenamed("source", "_l")
    open_ = placed.join(left, placed["source"].eqNullSafe(left["_l"])).drop("_l")
    room = F.when(F.col("left") > 0, F.col("copies") < MOST).otherwise(F.col("copies") > 0)
    open_ = open_.withColumn("_room", (room & (F.col("size") > 0) & (F.col("size") <= F.abs("left"))).cast("int"))
    open_ = open_.withColumn("_step", F.col("_room") * F.col("size"))
    # the smallest documents first; no more of them than fit into what is left
    open_ = ordered_prefix(open_, [F.col("size"), F.col("_h"), F.col("doc_id")], ["source"], {"_used": "_step"}, "_r")
    change = F.when((F.col("_room") == 1) & (F.col("_used") <= F.abs("left")), F.signum("left")).otherwise(0).cast("long")
    return open_.select("doc_id", "source", "size", "source_size", "target", F.col("rate").cast("double").alias("rate"),
                        (F.col("copies") + change).alias("copies"))
