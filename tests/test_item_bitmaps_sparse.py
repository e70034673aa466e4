"""Many small baskets of many items, and the ways two blocks are multiplied."""

import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.test_item_bitmaps import expected, pairs
from tidemark.operators import item_bitmaps as ib
from tidemark.operators.pairs import frequent_pairs


@pytest.mark.parametrize("dense, many, slab", [(0, 1, 3), (0, 4000, 10), (10 ** 9, 50, 9), (3, 40, 4096)])
def test_matrices_bits_and_blocks_agree(spark, monkeypatch, dense, many, slab):
    for name, value in (("DENSE", dense), ("PAIRS", many), ("SLICE", slab), ("BLOCK_ITEMS", 8), ("FEW_BITS", 4)):
        monkeypatch.setattr(ib, name, value)
    rng = np.random.default_rng(1)
    rows = [(int(b), int(i)) for b, i in zip(rng.integers(60, size=500), rng.integers(45, size=500))] + [(99, i) for i in range(70)]
    df = spark.createDataFrame(rows, "basket long, item long")
    assert pairs(ib.bitmap_pairs(df, block_items=7)) == expected(rows, 1)
    assert pairs(ib.bitmap_pairs(df, 4, block_items=7)) == expected(rows, 4)


def test_many_small_baskets_of_many_items(spark):
    """100,000 rows, 20,000 items: some two minutes of one core for each range when all blocks of items met."""
    df = spark.range(100_000).select((F.col("id") % 25_000).alias("basket"), F.pmod(F.xxhash64("id"), F.lit(20_000)).alias("item"))
    began = time.time()
    got = pairs(ib.bitmap_pairs(df))
    assert time.time() - began < 60
    assert got == pairs(frequent_pairs(df, 1))


@pytest.mark.parametrize("dense, many, slab, items", [(0, 50, 3, 8), (10 ** 9, 50, 9, 8), (2, 10, 5, 6), (1000, 10 ** 6, 4096, 1024)])
@pytest.mark.parametrize("within", [True, False])
def test_products_of_two_blocks(monkeypatch, dense, many, slab, items, within):
    for name, value in (("DENSE", dense), ("PAIRS", many), ("SLICE", slab), ("BLOCK_ITEMS", items)):
        monkeypatch.setattr(ib, name, value)
    rng = np.random.default_rng(2)
    bits = [(rng.random((n, 40)) < 0.3) | (np.arange(40) == 7) for n in (20, 27)]
    bitmap = lambda row: np.packbits(np.pad(row, (0, ib.BUCKET - 40)), bitorder="little").tobytes()
    block = lambda m: ib._positions([{"item": i, "baskets": bitmap(row) if i % 2 else None, "bits": np.flatnonzero(row).tolist()} for i, row in enumerate(m)])
    one, two = block(bits[0]), block(bits[0 if within else 1])
    got = np.zeros((len(one[0]), len(two[0])), dtype=np.int64)
    for x, y, n in ib._shared_bits(one, two, within):
        np.add.at(got, (x, y), n)
    want = bits[0].astype(int) @ bits[0 if within else 1].astype(int).T
    assert (got == (np.triu(want, 1) if within else want)).all()
