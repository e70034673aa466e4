"""Skew-proof operators against brute force, with one key holding a third of all rows."""

import itertools
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators.nearest import nearest
from tidemark.operators.ordering import ntile, ordered_prefix, ranked, top_n
from tidemark.operators.pairs import frequent_pairs, rules
from tidemark.operators.sessions import numbered, overlaps, sessionize, trailing


@pytest.fixture(scope="module")
def skewed(spark):
    rnd = random.Random(1)
    rows = [(i, "hot" if i % 3 == 0 else f"g{rnd.randrange(5)}", 7 if i % 2 else rnd.randrange(40), rnd.randrange(100)) for i in range(1500)]
    return rows, spark.createDataFrame(rows, "id long, g string, v long, x long").repartition(7)


def test_prefix_and_tiles(skewed):
    rows, df = skewed
    got = {r["id"]: r for r in ordered_prefix(df, [F.col("v").asc(), F.col("id").asc()], ["g"], {"run": "x"}, group_rows="n").collect()}
    for g in {r[1] for r in rows}:
        members = sorted((r for r in rows if r[1] == g), key=lambda r: (r[2], r[0]))
        total = 0
        for i, r in enumerate(members, 1):
            total += r[3]
            assert (got[r[0]]["row_number"], got[r[0]]["run"], got[r[0]]["n"]) == (i, total, len(members))
    tiles = {r["id"]: r["t"] for r in ntile(df, 7, [F.col("v").asc(), F.col("id").asc()], "t").collect()}
    order = sorted(rows, key=lambda r: (r[2], r[0]))
    size, extra = divmod(len(order), 7)
    expect = [t for t in range(1, 8) for _ in range(size + (t <= extra))]
    assert [tiles[r[0]] for r in order] == expect


def test_rank_with_long_ties(skewed):
    rows, df = skewed
    got = {r["id"]: r["rk"] for r in ranked(df, ["g"], [("v", "desc")], "rk").collect()}
    assert all(got[r[0]] == 1 + sum(o[1] == r[1] and o[2] > r[2] for o in rows) for r in rows)
    whole = {r["id"]: r["rk"] for r in ranked(df, [], [("v", "desc")], "rk").collect()}
    assert all(whole[r[0]] == 1 + sum(o[2] > r[2] for o in rows) for r in rows)


def test_top_n_limits_groups_before_the_shuffle(skewed):
    _, df = skewed
    plan = top_n(df, ["g"], [F.col("v").desc(), F.col("id").asc()], 3)._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_sessions_split_only_past_the_gap(spark):
    rows = [("u", 0), ("u", 1800), ("u", 3601), ("w", 5)] + [("hot", t * 600) for t in range(300)] + [("hot", 300 * 600 + 1802)]
    df = spark.createDataFrame(rows, "k string, s long").select("k", F.timestamp_seconds("s").alias("ts"), "s")
    got = {(r["k"], r["s"]): r["start"] for r in sessionize(df, ["k"], "ts", 1800, "start", bin_seconds=3600).select(
        "k", "s", F.unix_seconds("start").alias("start")).collect()}
    assert [got["u", 0], got["u", 1800], got["u", 3601]] == [0, 0, 3601]
    assert {got["hot", t * 600] for t in range(300)} == {0} and got["hot", 181802] == 181802


def test_trailing_counts(spark):
    rnd = random.Random(2)
    rows = [(i, "hot" if i % 3 == 0 else f"k{i % 4}", rnd.randrange(9000), rnd.randrange(2)) for i in range(500)]
    df = spark.createDataFrame(rows, "id long, k string, s long, c int").select("id", "k", F.timestamp_seconds("s").alias("ts"), "c")
    got = {r["id"]: r for r in trailing(df, ["k"], "ts", "id", {"long": (600, F.lit(1)), "short": (60, F.col("c"))}).collect()}
    for i, k, s, _ in rows:
        assert got[i]["long"] == sum(o[1] == k and s - 600 < o[2] <= s for o in rows)
        assert got[i]["short"] == sum(o[3] for o in rows if o[1] == k and s - 60 < o[2] <= s)


def test_numbered_collapses_repeats_over_bins(spark):
    seq = [(t * 700, "ab"[(t // 3) % 2]) for t in range(40)]
    df = spark.createDataFrame([("u", s, v) for s, v in seq], "k string, s long, v string").select("k", F.timestamp_seconds("s").alias("ts"), "s", "v")
    got = sorted((r["s"], r["pos"], r["n"]) for r in numbered(df, ["k"], "ts", [F.col("v")], changed="v", bin_seconds=3600).collect())
    kept = [s for i, (s, v) in enumerate(seq) if i == 0 or seq[i - 1][1] != v]
    assert got == [(s, i + 1, len(kept)) for i, s in enumerate(kept)]


def test_overlaps_meet_once(spark):
    rnd = random.Random(3)
    make = lambda n: [(f"i{i}", "u" if i % 3 else "w", s := rnd.randrange(400000), s + rnd.randrange(200000)) for i in range(n)]
    left, right = make(30), make(30)
    to_df = lambda rows: spark.createDataFrame(rows, "id string, k string, a long, b long").select(
        "id", "k", F.timestamp_seconds("a").alias("a"), F.timestamp_seconds("b").alias("b"))
    got = Counter((r["left_id"], r["right_id"]) for r in overlaps(to_df(left), to_df(right), "k", "a", "b", "id", "id").collect())
    want = {(l[0], r[0]) for l in left for r in right if l[1] == r[1] and l[2] <= r[3] and r[2] <= l[3]}
    assert set(got) == want and set(got.values()) <= {1}


@pytest.mark.parametrize("least", [1, 2, 4])
def test_pairs_with_giant_baskets(spark, least):
    rnd = random.Random(4)
    baskets = {f"b{i}": set(rnd.sample(range(30), rnd.randrange(1, 5))) for i in range(60)}
    baskets |= {"giant1": set(range(30)), "giant2": set(range(0, 30, 2)) | {1, 3}}
    rows = [(b, f"i{x:02d}") for b, items in baskets.items() for x in items]
    df = spark.createDataFrame(rows, "basket string, item string")
    counts = Counter(p for items in baskets.values() for p in itertools.combinations(sorted(f"i{x:02d}" for x in items), 2))
    want = {p: n for p, n in counts.items() if n >= least}
    found = frequent_pairs(df, least)
    assert {(r["a"], r["b"]): r["co_count"] for r in found.collect()} == want
    assert rules(df, found, len(baskets)).count() == 2 * len(want)


def test_nearest_is_exact_with_many_copies(spark):
    rng = np.random.default_rng(5)
    vectors = rng.normal(size=(90, 8)).astype("float32")
    vectors[::3] = vectors[0]  # a third of all rows is one vector
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(vectors)], "id long, vector array<float>")
    unit = vectors.astype("float64") / np.linalg.norm(vectors.astype("float64"), axis=1, keepdims=True)
    sims = np.round(unit @ unit.T, 9)
    want = {(q, x): r for q in range(90) for r, x in enumerate(sorted((x for x in range(90) if x != q), key=lambda x: (-sims[q, x], x))[:5], 1)}
    got = {(r["query_id"], r["item_id"]): r["rank"] for r in nearest(df, 5, block_rows=16, pivots=4).collect()}
    assert got == want
    asked = df.where("id < 7")
    other = {(r["query_id"], r["item_id"]) for r in nearest(df, 3, asked, block_rows=16, pivots=4).collect()}
    assert other == {(q, x) for q in range(7) for x in sorted(range(90), key=lambda x: (-sims[q, x], x))[:3]}
