import numpy as np
import pytest

from tests.llm.helpers import classes, docs_frame, edited, prose
from tidemark.llm import near_dedup as nd


def sets(rows, k):
    out = {}
    for i, text in rows:
        words = (text or "").encode().lower().split()
        width = min(k, len(words))
        out[i] = {tuple(words[a:a + width]) for a in range(len(words) - width + 1)} if words else set()
    return out


def expected(rows, k, num, den):
    s = sets(rows, k)
    return s, classes(list(s), lambda a, b: bool(s[a]) and den * len(s[a] & s[b]) >= num * len(s[a] | s[b]))


@pytest.mark.parametrize("k,similar", [(3, (85, 100)), (5, (4, 5))])
def test_same_components_as_brute_force(spark, k, similar):
    base = prose(1, 200)
    rows = [(i, edited(base, i, (i % 9) / 100)) for i in range(60)]  # a family whose members differ pairwise
    rows += [(100 + i, prose(100 + i // 3, 30 + i)) for i in range(45)]
    rows += [(200, "one two"), (201, "ONE  two"), (202, "one two three"), (203, None), (204, ""), (205, " \t\n"), (206, "Ärger ärger x"),
             (207, "ärger ärger x"), (208, "a b c d e f g h"), (209, "a b c d e f g h i"), (210, prose(7, 20_000)), (211, prose(7, 20_000) + " end")]
    s, want = expected(rows, k, *similar)
    got = {r["doc_id"]: r for r in nd.near_duplicates(docs_frame(spark, rows, ["digest", "rep", "cluster", "kept"]), k, similar).collect()}
    assert {i: r["component_id"] for i, r in got.items()} == want
    assert {i: r["n_shingles"] for i, r in got.items()} == {i: len(x) for i, x in s.items()}
    assert all(r["kept"] == (i == want[i]) for i, r in got.items())


def test_blocks_of_a_cluster_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(nd, "BLOCK_DOCS", 7)
    base = prose(3, 120)
    rows = [(i, edited(base, i, (i % 12) / 100)) for i in range(50)]
    _, want = expected(rows, 3, 85, 100)
    got = nd.near_duplicates(docs_frame(spark, rows), 3, (85, 100)).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == want


def test_repeated_rows_null_ids_and_empty_table(spark):
    rows = [(5, "a b c d e f"), (5, "a b c d e f"), (2, "a b c d e f"), (None, "a b c d e f"), (9, None)]
    got = sorted(tuple(r) for r in nd.near_duplicates(docs_frame(spark, rows), 3).collect())
    assert got == [(2, 4, 2, True), (5, 4, 2, False), (5, 4, 2, False), (9, 0, 9, True)]
    assert nd.near_duplicates(docs_frame(spark, []), 3).collect() == []


def test_registers_agree_with_probability_of_the_similarity():
    rng = np.random.default_rng(5)
    for size, shared in ((40, 34), (600, 540), (5000, 4000)):
        near = []
        for _ in range(30):
            x = np.unique(rng.integers(0, 2**64, size=2 * size - shared, dtype=np.uint64))
            x = rng.permutation(x)
            a, b = np.sort(x[:size]), np.sort(x[size - shared:])
            near.append(float(nd.estimate((nd.registers(a) == nd.registers(b)).mean(), len(a), len(b))))
        assert abs(np.mean(near) - shared / (2 * size - shared)) < 0.03
    disjoint = [nd.registers(np.unique(rng.integers(0, 2**64, size=5000, dtype=np.uint64))) for _ in range(40)]
    assert abs(np.mean([nd.estimate((a == b).mean(), 5000, 5000) for a in disjoint for b in disjoint if a is not b])) < 0.002
