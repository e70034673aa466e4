"""Tiles by refined histograms against sorted ones."""

import random

import pytest
from pyspark.sql import Window, functions as F

from tidemark.operators.selection import place, tiles


def frame(spark, n, seed):
    rng = random.Random(seed)
    value = lambda: rng.choice([0, 0, 0, 1, -1, 7, rng.randrange(-10**6, 10**6), rng.randrange(-2**62, 2**62)])
    rows = [(f"u{i}" if i % 3 else f"é{i * 7}", value(), value()) for i in range(n)]
    return spark.createDataFrame(rows, "user string, a long, b long")


@pytest.mark.parametrize("n,count", [(0, 5), (1, 5), (3, 5), (7, 3), (500, 10), (1003, 4)])
def test_tiles_equal_a_sort(spark, n, count):
    df = frame(spark, n, n)
    got = tiles(df, count, {"ta": F.col("a"), "tb": -F.col("b")}, "user")
    want = df.withColumns({"ta": F.ntile(count).over(Window.orderBy("a", "user")), "tb": F.ntile(count).over(Window.orderBy((-F.col("b")).asc(), "user"))})
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_all_values_equal_and_a_hot_value(spark):
    df = spark.range(300).select(F.concat(F.lit("user-with-a-long-common-name-"), "id").alias("user"), F.when(F.col("id") % 3 == 0, 5).otherwise(F.lit(5)).cast("long").alias("a"))
    got = tiles(df, 7, {"t": F.col("a")}, "user")
    want = df.withColumn("t", F.ntile(7).over(Window.orderBy("a", "user")))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_no_sort_and_no_exchange_of_rows(spark):
    plan = tiles(frame(spark, 100, 1), 5, {"t": F.col("a")}, "user")._jdf.queryExecution().executedPlan().toString()
    assert "Sort" not in plan and "Exchange" not in plan


def test_places_sort_as_values(spark):
    rows = [(v, t) for v in (-2**63, -5, -1, 0, 1, 255, 256, 2**63 - 1) for t in ("", "a", "ab", "b", "é")]
    df = spark.createDataFrame(rows, "v long, t string").withColumn("p", place(F.col("v"), F.col("t")))
    got = sorted((bytes(r["p"]), r["v"], r["t"]) for r in df.collect())
    assert [(v, t) for _, v, t in got] == sorted(rows, key=lambda r: (r[0], r[1].encode()))
