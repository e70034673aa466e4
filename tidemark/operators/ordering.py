"""Ranks, row numbers, tiles and running sums over groups that may be far too big for one task.

A plain window puts a whole group into one task. That is right where the grain bounds the
group (hours of one video, days of one report). For whole-table or per-region orderings the
rows are range-partitioned on (group, order), so a hot group spreads over many tasks, and
each slice only needs the small per-slice totals of the slices before it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.session import cut

_SLICE_BITS = 33  # monotonically_increasing_id keeps the partition above bit 33


def _placed(df: DataFrame, group: Sequence[str], order: Sequence[Column]) -> DataFrame:
    keys = [F.col(g).asc_nulls_first() for g in group] + list(order)
    ordered = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    ordered = cut(ordered.withColumn("_pos", F.monotonically_increasing_id()))
    return ordered.withColumn("_slice", F.shiftright("_pos", _SLICE_BITS))


def _attach(placed: DataFrame, per_slice: DataFrame, group: Sequence[str]) -> DataFrame:
    keys = [*group, "_slice"]
    renamed = per_slice.select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)],
        *[c for c in per_slice.columns if c not in keys],
    )
    match = F.lit(True)
    for i, k in enumerate(keys):
        match = match & placed[k].eqNullSafe(renamed[f"_k{i}"])
    return placed.join(renamed, match).drop(*[f"_k{i}" for i in range(len(keys))])


def ordered_prefix(
    df: DataFrame,
    order: Sequence[Column],
    group: Sequence[str] = (),
    running: Mapping[str, str] | None = None,
    row_number: str = "row_number",
    group_rows: str | None = None,
) -> DataFrame:
    """Add the row number in ``group`` by ``order`` and inclusive running sums.

    ``order`` must be unique inside a group for a repeatable answer. ``running`` maps a new
    column to the column it accumulates. ``group_rows`` names a column for the group's size.
    """
    running = running or {}
    placed = _placed(df, group, order)
    per_slice = placed.groupBy(*group, "_slice").agg(
        F.count(F.lit(1)).alias("_n"),
        F.min("_pos").alias("_first"),
        *[F.sum(src).alias(f"_t_{new}") for new, src in running.items()],
    )
    whole = Window.partitionBy(*group)
    earlier = whole.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    per_slice = per_slice.select(
        *group, "_slice", "_first",
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"),
        F.sum("_n").over(whole).alias("_rows"),
        *[F.coalesce(F.sum(f"_t_{new}").over(earlier), F.lit(0)).alias(f"_b_{new}") for new in running],
    )
    out = _attach(placed, per_slice, group)
    out = out.withColumn(row_number, F.col("_before") + F.col("_pos") - F.col("_first") + 1)
    inside = (Window.partitionBy(*group, "_slice").orderBy("_pos")
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    for new, src in running.items():
        out = out.withColumn(new, F.col(f"_b_{new}") + F.coalesce(F.sum(src).over(inside), F.lit(0)))
    if group_rows:
        out = out.withColumn(group_rows, F.col("_rows"))
    return out.drop("_pos", "_slice", "_first", "_before", "_rows", *[f"_b_{n}" for n in running])


def tile(row_number: str, rows: str, tiles: int) -> Column:
    """The tile a 1-based row number falls into, with the larger tiles first."""
    i, n = F.col(row_number) - 1, F.col(rows)
    size = F.expr(f"`{rows}` div {tiles}")
    extra = n % tiles
    head = extra * (size + 1)
    return (F.when(i < head, F.floor(i / (size + 1)) + 1)
            .otherwise(extra + F.floor((i - head) / F.greatest(size, F.lit(1))) + 1)).cast("long")


def ntile(df: DataFrame, tiles: int, order: Sequence[Column], name: str,
          group: Sequence[str] = ()) -> DataFrame:
    numbered = ordered_prefix(df, order, group, row_number="_rn", group_rows="_gr")
    return numbered.withColumn(name, tile("_rn", "_gr", tiles)).drop("_rn", "_gr")


def ranked(df: DataFrame, group: Sequence[str], order: Sequence[tuple[str, str]], name: str) -> DataFrame:
    """``rank()`` with ties, for groups of any size.

    ``order`` lists (column, "asc" | "desc"); NULLs come last. A run of equal values may
    start in an earlier slice, so the rank of the run is carried through the slice totals.
    """
    keys = [F.col(c).desc_nulls_last() if way == "desc" else F.col(c).asc_nulls_last()
            for c, way in order]
    # the hash lets equal values, which a range split keeps together, spread over slices
    placed = _placed(df, group, [*keys, F.xxhash64(*df.columns)])
    value = F.struct(*[F.col(c) for c, _ in order])
    placed = placed.withColumn("_lr", F.rank().over(Window.partitionBy(*group, "_slice").orderBy(*keys)))
    per_slice = placed.groupBy(*group, "_slice").agg(
        F.count(F.lit(1)).alias("_n"),
        F.min_by(value, "_pos").alias("_head"),
        F.max_by(value, "_pos").alias("_tail"),
        F.max("_lr").alias("_tail_lr"),
    )
    by_slice = Window.partitionBy(*group).orderBy("_slice")
    earlier = by_slice.rowsBetween(Window.unboundedPreceding, -1)
    per_slice = (
        per_slice
        .withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
        .withColumn("_joined", (F.lag(F.lit(1)).over(by_slice).isNotNull())
                    & F.col("_head").eqNullSafe(F.lag("_tail").over(by_slice)))
        .withColumn("_tail_start", F.when(~F.col("_joined") | (F.col("_tail_lr") > 1),
                                          F.col("_before") + F.col("_tail_lr")))
        .withColumn("_carried", F.last("_tail_start", ignorenulls=True).over(earlier))
        .select(*group, "_slice", "_before", "_joined", "_carried")
    )
    out = _attach(placed, per_slice, group)
    rank = F.when(F.col("_joined") & (F.col("_lr") == 1), F.col("_carried")).otherwise(
        F.col("_before") + F.col("_lr"))
    return out.withColumn(name, rank.cast("long")).drop(
        "_pos", "_slice", "_lr", "_before", "_joined", "_carried")


def top_n(df: DataFrame, group: Sequence[str], order: Sequence[Column], n: int,
          name: str = "rank") -> DataFrame:
    """The first ``n`` rows of each group.

    Spark keeps at most ``n`` rows per group in every map task before the shuffle
    (window group limit), so a hot group never reaches one task whole.
    """
    window = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(name, F.row_number().over(window)).where(F.col(name) <= n)


def first_per(df: DataFrame, group: Sequence[str], order: Sequence[Column]) -> DataFrame:
    return top_n(df, group, order, 1, "_rn").drop("_rn")
