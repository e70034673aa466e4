"""Co-occurring item pairs without expanding the biggest baskets."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tidemark.session import cut


def frequent_pairs(baskets: DataFrame, min_count: int, basket: str = "basket", item: str = "item") -> DataFrame:
    """Every pair (a < b) that shares at least ``min_count`` baskets, with its exact count.

    Two facts keep the work bounded. A frequent pair has two frequent items, so rare items go
    first. And a pair found in ``min_count`` baskets is found in at least one basket outside the
    ``min_count - 1`` largest: those are never expanded, only asked about the candidate pairs.
    """
    rows = baskets.select(F.col(basket).alias("basket"), F.col(item).alias("item")).distinct()
    counted = rows.groupBy("item").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count)
    rows = rows.join(counted.select("item"), "item", "left_semi")
    sizes = rows.groupBy("basket").agg(F.count(F.lit(1)).alias("size"))
    rows = cut(rows.join(sizes, "basket"))

    # baskets per size is a short histogram, largest sizes first
    by_size = rows.groupBy("size").agg((F.count(F.lit(1)) / F.col("size")).cast("long").alias("baskets"))
    running = F.sum("baskets").over(Window.orderBy(F.col("size").desc()))
    set_aside = by_size.withColumn("upto", running).where(F.col("upto") <= min_count - 1).agg(
        F.min("size").alias("from_size"), F.max("upto").alias("heavy_baskets"))
    bound = set_aside.first()
    from_size, heavy_baskets = bound["from_size"], bound["heavy_baskets"] or 0
    light = rows if from_size is None else rows.where(F.col("size") < from_size)

    other = light.select("basket", F.col("item").alias("b"))
    found = (light.select("basket", F.col("item").alias("a")).join(other, "basket").where("a < b")
             .groupBy("a", "b").agg(F.count(F.lit(1)).alias("co_count")))
    if not heavy_baskets:
        return found.where(F.col("co_count") >= min_count)
    heavy = rows.where(F.col("size") >= from_size)
    candidates = found.where(F.col("co_count") + heavy_baskets >= min_count)
    extra = (candidates.select("a", "b")
             .join(heavy.select("basket", F.col("item").alias("a")), "a")
             .join(heavy.select("basket", F.col("item").alias("b")), ["basket", "b"])
             .groupBy("a", "b").agg(F.count(F.lit(1)).alias("extra")))
    total = F.col("co_count") + F.coalesce("extra", F.lit(0))
    return (candidates.join(extra, ["a", "b"], "left")
            .select("a", "b", total.alias("co_count")).where(F.col("co_count") >= min_count))


def rules(baskets: DataFrame, pairs: DataFrame, baskets_total: int,
          basket: str = "basket", item: str = "item") -> DataFrame:
    """Both directions of every pair with support, confidence and lift."""
    items = (baskets.select(F.col(basket).alias("basket"), F.col(item).alias("item")).distinct()
             .groupBy("item").agg(F.count(F.lit(1)).alias("n")))
    sides = pairs.select(F.explode(F.array(F.struct(F.col("a").alias("antecedent"), F.col("b").alias("consequent")),
                                           F.struct(F.col("b").alias("antecedent"), F.col("a").alias("consequent")))).alias("r"),
                         "co_count").select("r.*", "co_count")
    out = (sides.join(items.select(F.col("item").alias("antecedent"), F.col("n").alias("_na")), "antecedent")
           .join(items.select(F.col("item").alias("consequent"), F.col("n").alias("_nc")), "consequent"))
    total, co = F.lit(float(baskets_total)), F.col("co_count").cast("double")
    return out.select("antecedent", "consequent", "co_count", (co / total).alias("support"),
                      (co / F.col("_na")).alias("confidence"),
                      (co * total / (F.col("_na").cast("double") * F.col("_nc"))).alias("lift"))
