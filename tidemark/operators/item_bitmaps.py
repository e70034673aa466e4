"""Co-occurring pairs from vertical bitmaps: an item's baskets are bits, a pair's count is the bits two items share.

Baskets get dense numbers; a bitmap covers 32,768 of them, and is kept as a list of its bits where these take less room.
A basket is never expanded into its pairs outside a task: one of a million items is one bit in each item's bitmap. The
items of a range of baskets are dealt to as many blocks as the range's pairs ask for, at most to blocks of bounded size, and
a task multiplies two blocks at a time, over the baskets only that occur in both: baskets of many items as matrices, the
others bit by bit.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from tidemark.operators.ordering import ordered_prefix
from tidemark.session import cut, stored

BUCKET = 32_768  # baskets of a bitmap
BLOCK_ITEMS = 1024  # of a block on average, where its range has many pairs; a bitmap takes 4 KB
FEW_BITS = 2048  # of a bitmap that is kept as a list
SLICE = 4096  # baskets that are multiplied as matrices at a time: 16 MB a block
PAIRS = 4_000_000  # pairs of bits that a task makes at a time, and of a range up to which its items are one block
DENSE = 1000  # pairs of a basket's bits beyond which two matrices of 1024 items are cheaper


def item_bitmaps(baskets: DataFrame, min_count: int = 1, basket: str = "basket", item: str = "item") -> tuple[DataFrame, DataFrame]:
    """(bucket, item, baskets, bits), (bucket, pairs): for every item of at least ``min_count`` baskets its bitmap of each bucket of basket
    numbers, as ``baskets`` or, if few are set, as ``bits``; and of each bucket the sum of its baskets' squared sizes.

    Rows without a basket or an item are left out, repeated ones count once.
    """
    rows = baskets.select(F.col(basket).alias("basket"), F.col(item).alias("item")).where("basket is not null and item is not null").distinct()
    if min_count > 1:  # both items of a frequent pair are frequent
        counted = rows.groupBy("item").agg(F.count("*").alias("n")).where(F.col("n") >= min_count)
        rows = rows.join(counted.select("item"), "item", "left_semi")
    rows = stored(rows, "basket-items")
    # a basket of one item has no pair
    shared = rows.groupBy("basket").agg(F.count("*").alias("n")).where("n > 1")
    numbers = cut(ordered_prefix(shared, [F.col("basket").asc()]).select("basket", "n", F.col("row_number").cast("long").alias("number")))
    placed = rows.join(numbers, "basket").select("item", F.bitmap_bucket_number("number").alias("bucket"), F.bitmap_bit_position("number").alias("at"))
    placed = stored(placed, "bits")
    counts = placed.groupBy("bucket", "item").agg(F.count("*").alias("n"))
    many = counts.where(F.col("n") > FEW_BITS).select("bucket", "item")  # one in FEW_BITS rows at most
    dense = placed.join(many, ["bucket", "item"], "left_semi").groupBy("bucket", "item").agg(F.bitmap_construct_agg("at").alias("baskets"))
    sparse = placed.join(many, ["bucket", "item"], "left_anti").groupBy("bucket", "item").agg(F.collect_list(F.col("at").cast("int")).alias("bits"))
    pairs = numbers.groupBy(F.bitmap_bucket_number("number").alias("bucket")).agg(F.sum(F.col("n").cast("double") * F.col("n")).alias("pairs"))
    return dense.withColumn("bits", F.lit(None).cast("array<int>")).unionByName(sparse.withColumn("baskets", F.lit(None).cast("binary"))), pairs


def _positions(cells: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(items, row, bit) of a block, a row and a bit for each that is set, by bit."""
    lists = [np.flatnonzero(np.unpackbits(np.frombuffer(c["baskets"], dtype=np.uint8), bitorder="little")) if c["baskets"] is not None
             else np.asarray(c["bits"], dtype=np.int64) for c in cells]
    row, bit = np.repeat(np.arange(len(cells)), [len(x) for x in lists]), np.concatenate(lists)
    order = np.argsort(bit, kind="stable")
    return np.array([c["item"] for c in cells]), row[order], bit[order]


def _shared_bits(one: tuple, two: tuple, within: bool) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Parts of (row of one, row of two, shared bits); a pair may be in several parts. Within a block, the first row is the smaller."""
    (u, u_row, u_bit), (v, v_row, v_bit) = one, two
    n_u, n_v = np.bincount(u_bit, minlength=BUCKET), np.bincount(v_bit, minlength=BUCKET)
    made, out = n_u * n_v, []
    products = -(-len(u) // BLOCK_ITEMS) * -(-len(v) // BLOCK_ITEMS)
    wide = np.flatnonzero(made > DENSE * products)
    thin = np.flatnonzero((made > 0) & (made <= DENSE * products))
    first_u, first_v = np.cumsum(n_u) - n_u, np.cumsum(n_v) - n_v
    part = (np.cumsum(made[thin]) - made[thin]) // PAIRS
    for p in range(int(part[-1]) + 1 if len(part) else 0):
        bits = thin[part == p]
        n = made[bits]
        nth = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        of_v = np.repeat(n_v[bits], n)
        x = u_row[np.repeat(first_u[bits], n) + nth // of_v]
        y = v_row[np.repeat(first_v[bits], n) + nth % of_v]
        if within:
            x, y = x[x < y], y[x < y]
        key, count = np.unique(x * len(v) + y, return_counts=True)
        out.append((key // len(v), key % len(v), count))
    if len(wide):
        column = np.full(BUCKET, -1)
        column[wide] = np.arange(len(wide))
        for a in range(0, len(u), BLOCK_ITEMS):
            for b in range(a if within else 0, len(v), BLOCK_ITEMS):
                counts = np.zeros((len(u[a:a + BLOCK_ITEMS]), len(v[b:b + BLOCK_ITEMS])), dtype=np.float32)  # up to 32,768: exact in 32 bits
                for at in range(0, len(wide), SLICE):
                    sides = []
                    for row, bit, low, size in ((u_row, u_bit, a, counts.shape[0]), (v_row, v_bit, b, counts.shape[1])):
                        matrix = np.zeros((size, len(wide[at:at + SLICE])), dtype=np.float32)
                        here = (row >= low) & (row < low + size) & (column[bit] >= at) & (column[bit] < at + SLICE)
                        matrix[row[here] - low, column[bit[here]] - at] = 1
                        sides.append(matrix)
                    counts += sides[0] @ sides[1].T
                if within and a == b:
                    counts = np.triu(counts, 1)
                x, y = np.nonzero(counts)
                out.append((x + a, y + b, counts[x, y].astype(np.int64)))
    return out


def bitmap_pairs(baskets: DataFrame, min_count: int = 1, basket: str = "basket", item: str = "item",
                 block_items: int = BLOCK_ITEMS) -> DataFrame:
    """Every pair (a < b) that shares at least ``min_count`` baskets, with its exact count (a, b, co_count).

    A range of baskets with few pairs is one block; blocks of a range with many meet by the square of their number.
    """
    bitmaps, pairs = item_bitmaps(baskets, min_count, basket, item)
    bitmaps = stored(bitmaps, "bitmaps")
    blocks = bitmaps.groupBy("bucket").agg(F.ceil(F.count("*") / block_items).cast("int").alias("most")).join(pairs, "bucket")
    blocks = blocks.select("bucket", F.least("most", F.ceil(F.sqrt(F.col("pairs") / PAIRS)).cast("int")).alias("blocks"))
    dealt = bitmaps.join(blocks, "bucket").withColumn("block", F.pmod(F.xxhash64("item"), F.col("blocks")).cast("int"))
    packed = dealt.groupBy("bucket", "blocks", "block").agg(F.collect_list(F.struct("item", "baskets", "bits")).alias("cells"))
    # every block meets every block of its bucket once, itself included
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    met = packed.select("bucket", "block", other, "cells")
    met = met.select("bucket", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "cells")

    def multiply(group: pd.DataFrame) -> pd.DataFrame:
        within = group["i"].iloc[0] == group["j"].iloc[0]
        sides = [_positions(cells) for cells in group.sort_values("block")["cells"]]
        if not within and len(sides) < 2:  # the other block is empty
            return pd.DataFrame({"x": [], "y": [], "n": []})
        one, two = sides[0], sides[-1]
        parts = [pd.DataFrame({"x": one[0][x], "y": two[0][y], "n": n}) for x, y, n in _shared_bits(one, two, within)]
        return pd.concat(parts) if parts else pd.DataFrame({"x": [], "y": [], "n": []})

    kind = baskets.select(F.col(item).alias("item")).schema["item"].dataType.simpleString()
    parts = met.groupBy("bucket", "i", "j").applyInPandas(multiply, f"x {kind}, y {kind}, n long")
    total = parts.groupBy(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).agg(F.sum("n").alias("co_count"))
    return total.where(F.col("co_count") >= min_count)
