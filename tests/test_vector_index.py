"""The kept vector index against exact products."""

import numpy as np
import pytest

from tidemark.operators import vector_index as vx
from tidemark.operators.nearest import nearest
from tidemark.operators.vector_index import Quantiser, VectorIndex, k_means, unit


def clustered(n, seed=0, dims=24, groups=12):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(groups, dims))
    return (centres[rng.integers(groups, size=n)] + 0.35 * rng.normal(size=(n, dims))).astype(np.float32)


def frame(spark, vectors, first=0):
    rows = [(first + i, v.tolist(), "ab"[i % 2], 100 + i % 10) for i, v in enumerate(vectors)]
    return spark.createDataFrame(rows, "id long, vector array<float>, board string, day int")


def rows(df):
    return sorted((r["query_id"], r["rank"], r["item_id"], r["score"]) for r in df.collect())


@pytest.fixture(scope="module")
def built(spark):
    before, vx.BLOCK = vx.BLOCK, 64
    vectors = np.concatenate([clustered(900), np.repeat(clustered(1, 5), 100, axis=0)])  # a tenth are copies
    items = frame(spark, vectors)
    index = VectorIndex(spark)
    index.fit(items)
    index.add(items.where("id < 600"))
    index.add(items.where("id >= 600"))
    index.asked = items.select("id", "vector")  # without their columns, which would filter
    yield index, items
    vx.BLOCK = before


def test_exact_search_equals_all_products(spark, built):
    index, items = built
    assert rows(index.search(index.asked, 20, itself=True, exact=True)) == rows(nearest(items.select("id", "vector"), 20))


def test_recall_of_probed_cells(spark, built):
    index, items = built
    probes, reached = index.tune(index.asked, 20, 0.95, itself=True)
    assert reached >= 0.95 and probes < len(index.quantiser.centres)
    truth = nearest(items.select("id", "vector"), 20)
    assert index.recall(index.asked, 20, truth, probes=probes, itself=True) >= 0.93
    assert index.recall(index.asked, 20, truth, probes=probes, itself=True, pool=24) > 0.8  # few are scored exactly


def test_filters(spark, built):
    index, items = built
    asked = spark.createDataFrame([(1, "a", None, None), (2, None, 103, 105), (3, "b", 103, None), (4, "none", None, None)],
                                  "id long, board string, date_from int, date_to int")
    vector = clustered(1, 9)[0].tolist()
    asked = asked.selectExpr("*", f"array({', '.join(map(str, vector))}) AS vector")
    data = {r["id"]: (r["vector"], r["board"], r["day"]) for r in items.collect()}
    want = []
    for q, board, low, high in ((1, "a", 0, 999), (2, None, 103, 105), (3, "b", 103, 999)):
        fit = [i for i, (_, b, d) in data.items() if board in (None, b) and low <= d <= high]
        score = np.round(unit([data[i][0] for i in fit]) @ unit([np.float32(vector)])[0], 9)
        want += [(q, r, i, s) for r, (s, i) in enumerate(sorted(zip(-score, fit))[:5], 1) for s in [-s]]
    assert rows(index.search(asked, 5, exact=True)) == sorted(want)


def test_blocks_are_bounded_and_rows_are_checked(spark, built):
    index, items = built
    sizes = [len(r["members"]) for r in index.blocks().collect()]
    assert max(sizes) <= 2 * 64 and sum(sizes) == 900 + 10  # copies differ in their day only
    with pytest.raises(Exception, match="components"):
        index.add(spark.createDataFrame([(5000, [1.0, 2.0])], "id long, vector array<float>"))


def test_no_items(spark):
    index, none = VectorIndex(spark), spark.createDataFrame([], "id long, vector array<float>")
    index.add(none)
    assert index.search(none, 3).collect() == [] and index.tune(none, 3) == (1, 1.0)


def test_quantiser_keeps_most_of_a_product():
    v = unit(clustered(3000, 2))
    made = Quantiser(v, 32)
    cell = made.closest(v)
    codes = made.codes(v, cell)
    one = np.flatnonzero(cell == cell[0])
    rough = made.approximate(v[:50], int(cell[0]), codes[one])
    assert np.abs(rough - v[:50] @ v[one].T).max() < 0.25
    assert len(k_means(v[:3], 9, np.random.default_rng(0))) == 3
