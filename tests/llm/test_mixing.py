import pytest

from tests.llm.helpers import docs_frame, prose
from tidemark.llm.mixing import mix


def wanted(sizes, weights, share):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    full = set()
    while True:
        left = share * sum(sizes.values()) - sum(2 * sizes[s] for s in full)
        total = sum(weight[s] for s in names if s not in full)
        target = {s: 2 * sizes[s] if s in full else weight[s] * left / total for s in names}
        over = {s for s in names if s not in full and target[s] > 2 * sizes[s]}
        if not over:
            return target
        full |= over


def rows_of(seed=0):
    rows, at = [], 0
    for source, n, longest in (("b", 300, 60), ("a", 40, 20), ("Z", 80, 200), ("é", 60, 50), (None, 50, 30), ("c", 1, 900), ("d", 30, 25)):
        for i in range(n):
            rows.append((at, prose(seed + at, 1 + (at * 7) % longest), "en", source))
            at += 1
    rows += [(at, None, "en", "b"), (at + 1, "", "en", "empty"), (at + 2, " \n\t", "en", "empty")]
    return rows


@pytest.mark.parametrize("share", [1.5, 0.6])
def test_targets_and_what_is_taken(spark, share):
    rows = rows_of()
    got = mix(docs_frame(spark, rows, ["size", "target", "copies", "n"]), share=share).collect()
    assert sorted(r["doc_id"] for r in got) == [r[0] for r in rows]
    sizes, taken, longest = {}, {}, {}
    for r, (_, text, _, source) in zip(sorted(got, key=lambda r: r["doc_id"]), rows):
        assert r["source"] == source and r["size"] == len((text or "").split()) and 0 <= r["copies"] <= 2
        sizes[source] = sizes.get(source, 0) + r["size"]
        taken[source] = taken.get(source, 0) + r["size"] * r["copies"]
        longest[source] = max(longest.get(source, 0), r["size"])
    want = wanted(sizes, (5, 2, 1), share)
    for r in got:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(want[r["source"]])
    for s in sizes:
        assert abs(taken[s] - want[s]) <= max(0.03 * want[s], 0 if len([r for r in rows if r[3] == s]) > 1 else longest[s])


def test_rates_solve_the_constraint_and_reruns_agree(spark):
    rows = rows_of(5)
    frame = docs_frame(spark, rows)
    one = sorted((r["doc_id"], r["copies"], r["rate"]) for r in mix(frame).collect())
    two = sorted((r["doc_id"], r["copies"], r["rate"]) for r in mix(frame.repartition(7)).collect())
    assert one == two
    tokens, target = {}, {}
    for r in mix(frame).collect():
        tokens[r["source"]] = tokens.get(r["source"], 0) + r["rate"] * r["size"]
        target[r["source"]] = r["target"]
    assert all(tokens[s] == pytest.approx(target[s], rel=1e-5) for s in target)


def test_hot_source_of_equal_sizes_repeated_rows_and_no_rows(spark):
    rows = [(i, "a b c", "en", "hot") for i in range(500)] + [(7, "x y", "en", "cold"), (7, "x y", "en", "cold"), (None, "x", "en", "cold")]
    got = mix(docs_frame(spark, rows)).collect()
    assert len(got) == len(rows)
    for s in ("hot", "cold"):
        of = [r for r in got if r["source"] == s]
        assert abs(sum(r["size"] * r["copies"] for r in of) - of[0]["target"]) <= 3
    assert mix(docs_frame(spark, [])).collect() == []
    assert [r["copies"] for r in mix(docs_frame(spark, [(1, None, "en", None)])).collect()] == [1]
