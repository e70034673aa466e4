"""Fused lists whose entries are shuffled with their user, not one by one."""

from collections import defaultdict

from tidemark.plans import reco


def lists(spark):
    seeds = spark.createDataFrame([("u1", "a"), ("u1", "b"), ("u2", "a"), ("u3", "zz"), (None, "a")], f"{reco.USER} string, seed_item string")
    near = [(s, f"i{(ord(s) * 3 + r) % 7}", r) for s in "abc" for r in range(1, 6)]
    popular = [("global", f"i{r}", r) for r in range(1, 5)] + [("category:x", "i9", 1)]
    bought = [("u1", "i2"), ("u1", "i2"), ("u2", "never listed"), (None, "i3"), ("u2", None)]
    frame = lambda rows, schema: spark.createDataFrame(rows, schema)
    made = reco.candidate_lists(seeds, frame(near, "query_id string, item_id string, rank int"), frame(popular, "scope string, item_id string, rank int"))
    return made, frame(bought, f"{reco.USER} string, item_id string"), near, popular, bought


def test_fused_lists_equal_sums_by_hand(spark):
    made, bought, near, popular, gone = lists(spark)
    want = defaultdict(float)
    for user, seeds in (("u1", "ab"), ("u2", "a"), ("u3", ""), (None, "a")):
        for s, item, rank in near:
            want[user, item] += (s in seeds) / (60 + rank)
        for scope, item, rank in popular:
            want[user, item] += (scope == "global") / (60 + rank)
    want = {k: v for k, v in want.items() if v and (k not in gone or k[0] is None)}  # as in SQL, a null user matches no purchase
    got = reco.fuse(made, bought).collect()
    assert {(r[reco.USER], r["item_id"]): round(float(r["rrf"]), 9) for r in got} == {k: round(v, 9) for k, v in want.items()}
    assert len(got) == len(want)
    for user in ("u1", "u2", "u3", None):
        mine = sorted((r for r in got if r[reco.USER] == user), key=lambda r: r["rank"])
        assert [r["item_id"] for r in mine] == [i for _, i in sorted((-round(v, 15), i) for (u, i), v in want.items() if u == user)]


def test_entries_are_not_shuffled_by_item(spark):
    made, bought, *_ = lists(spark)
    plan = reco.fuse(made, bought)._jdf.queryExecution().executedPlan().toString()
    above = plan[:plan.index("Union")]  # from the joined lists on
    assert above.count("Exchange") == 1 and "Join" not in above
