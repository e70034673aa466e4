"""Distinct users from stored bitmaps against sets."""

import datetime as dt
import os
import random

from tidemark.operators.user_bitmaps import UserBitmaps


def test_bitmaps_equal_sets(spark):
    rng, day0 = random.Random(4), dt.date(2024, 1, 1)
    rows = [(f"u{min(int(rng.expovariate(0.03)), 400)}", day0 + dt.timedelta(days=rng.randrange(28)), rng.choice("abc")) for _ in range(2500)]
    rows += [("hot", day0 + dt.timedelta(days=d), e) for d in range(28) for e in "abc"] + [(None, day0, "a"), ("u1", None, "a")]
    frame = lambda part: spark.createDataFrame(part, "user string, day date, event string")
    good = [r for r in rows if r[0] and r[1]]
    kept = UserBitmaps(spark)
    kept.add(frame([r for r in rows if r[1] is None or r[1] < day0 + dt.timedelta(days=14)]))
    first = {r["user"]: r["number"] for r in kept.users().collect()}
    for d in range(14, 28):
        if d in (14, 20, 27):  # one by one, the rest together
            kept.add(frame([r for r in rows if r[1] == day0 + dt.timedelta(days=d)]))
    kept.add(frame([r for r in rows if r[1] and r[1] >= day0 + dt.timedelta(days=14)]))  # whole days come again
    numbers = {r["user"]: r["number"] for r in kept.users().collect()}
    assert sorted(numbers.values()) == list(range(1, len({r[0] for r in good}) + 1)) and first.items() <= numbers.items()

    got = {(r["day"], r["event"]): r["users_count"] for r in kept.rolling(7).collect()}
    for d in {r[1] for r in good}:
        for e in "abc":
            assert got[str(d), e] == len({u for u, day, x in good if x == e and d - dt.timedelta(days=6) <= day <= d})
    weeks = {}
    for u, d, _ in good:
        weeks.setdefault(u, set()).add(d - dt.timedelta(days=d.weekday()))
    want = {}
    for active in weeks.values():
        for w in active:
            key = (min(active), (w - min(active)).days // 7)
            want[key] = want.get(key, 0) + 1
    assert {(r["cohort_week"], r["week_offset"]): r["users_count"] for r in kept.retention().collect()} == want
    of = {e: {u for u, _, x in good if x == e} for e in "abc"}
    assert [r["users_count"] for r in kept.all_of(["a", "b", "c", "none"]).orderBy("step_order").collect()] == [
        len(of["a"]), len(of["a"] & of["b"]), len(of["a"] & of["b"] & of["c"]), 0]


def test_a_new_day_touches_one_partition(spark):
    kept, day = UserBitmaps(spark), lambda d: dt.date(2024, 1, d)
    kept.add(spark.createDataFrame([("a", day(1), "x"), ("b", day(2), "x")], "user string, day date, event string"))
    files = lambda: {os.path.join(r, f): os.path.getmtime(os.path.join(r, f)) for r, _, fs in os.walk(kept.root.removeprefix("file:") + "/days") for f in fs if f.endswith(".parquet")}
    before = files()
    assert len(before) == 2
    kept.add(spark.createDataFrame([("a", day(3), "x"), ("c", day(3), "x")], "user string, day date, event string"))
    after = files()
    assert before.items() <= after.items() and len(after) == 3
    assert {(r["day"], r["users_count"]) for r in kept.rolling(3).collect()} == {("2024-01-01", 1), ("2024-01-02", 2), ("2024-01-03", 3)}


def test_no_rows(spark):
    kept = UserBitmaps(spark)
    kept.add(spark.createDataFrame([], "user string, day date, event string"))
    assert kept.retention().collect() == [] == kept.rolling(7).collect()
