from collections import Counter
from itertools import combinations

from pyspark.sql import functions as F

from tidemark.operators.item_bitmaps import bitmap_pairs
from tidemark.operators.pairs import frequent_pairs


def expected(rows, least):
    held = {}
    for basket, item in rows:
        if basket is not None and item is not None:
            held.setdefault(basket, set()).add(item)
    found = Counter(p for items in held.values() for p in combinations(sorted(items), 2))
    return {p: n for p, n in found.items() if n >= least}


def pairs(df):
    rows = df.collect()
    assert len({(r["a"], r["b"]) for r in rows}) == len(rows)
    return {(r["a"], r["b"]): r["co_count"] for r in rows}


def test_equal_to_brute_force_with_a_giant_basket(spark):
    rows = [(f"o{i}", f"p{(i * j) % 41}") for i in range(60) for j in range(1, 5)] + [("giant", f"p{i}") for i in range(150)]
    rows += [(None, "p1"), ("o1", None), (None, None), ("o1", "p1"), ("o1", "p1"), ("alone", "only")]
    df = spark.createDataFrame(rows, "order_id string, part string").withColumn("baskets", F.lit("x")).withColumn("block", F.lit(1))
    assert pairs(bitmap_pairs(df, 1, "order_id", "part", block_items=16)) == expected(rows, 1)
    assert pairs(bitmap_pairs(df, 3, "order_id", "part")) == expected(rows, 3)


def test_several_buckets_and_a_hot_item(spark):
    """70,000 baskets, one item in all of them."""
    ids = spark.range(70_000)
    items = F.explode(F.array(F.lit(0).cast("long"), F.col("id") % 7 + 1, F.col("id") % 5 + 10)).alias("item")
    df = ids.select(F.col("id").alias("basket"), items)
    got = pairs(bitmap_pairs(df, block_items=4))
    assert got == pairs(frequent_pairs(df, 1)) and got[0, 1] == 10_000 and len(got) == 7 + 5 + 35


def test_empty_table_and_single_items(spark):
    empty = spark.createDataFrame([], "basket long, item long")
    assert pairs(bitmap_pairs(empty)) == {} == pairs(bitmap_pairs(spark.createDataFrame([(1, 1), (2, 2)], "basket long, item long")))
