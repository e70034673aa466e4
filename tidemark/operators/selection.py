"""Exact tiles and order statistics without sorting: ranks are found by refining histograms.

A row's place is a byte string: the value with its sign bit turned, then the tiebreak. A few aggregations count rows
by the next two bytes, for all columns and ranks at once, each only among rows that share the bytes already known
of some rank. No row is moved; what comes back is at most 65,536 counts for each open prefix.
"""

from __future__ import annotations

import os
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.session import cut

DIGIT = 2  # bytes that a pass settles


def place(value: Column, tiebreak: Column) -> Column:
    """Bytes that sort as (value, tiebreak); ``value`` is a whole number."""
    head = F.unhex(F.lpad(F.hex(value.cast("long").bitwiseXOR(F.lit(-(1 << 63)))), 16, "0"))
    return F.concat(head, F.encode(tiebreak.cast("string"), "UTF-8"))


def select_ranks(df: DataFrame, ranks: Mapping[str, list[int]], low: Mapping[str, bytes], high: Mapping[str, bytes]) -> dict[str, list[tuple[bytes, bool]]]:
    """For each column of places and each of its ranks (from 1) bytes that only that row begins with, or, marked true,
    that are the whole of its place.

    ``low`` and ``high`` are the columns' smallest and largest places. Rows of equal place share their whole bytes.
    """
    start = {c: os.path.commonprefix([bytes(low[c]), bytes(high[c])]) for c in ranks}
    open_ranks = [(c, i, rank, start[c]) for c, wanted in ranks.items() for i, rank in enumerate(wanted)]
    found: dict[tuple[str, int], tuple[bytes, bool]] = {}
    while open_ranks:
        slots = sorted({(c, prefix) for c, _, _, prefix in open_ranks})
        number = {slot: i for i, slot in enumerate(slots)}
        tests = [F.when(F.substring(c, 1, len(p)) == F.lit(p), F.struct(F.lit(i).alias("slot"), F.substring(c, len(p) + 1, DIGIT).alias("digit")))
                 for (c, p), i in number.items()]
        seen = df.select(F.explode(F.filter(F.array(*tests), lambda t: t.isNotNull())).alias("t")).groupBy("t.slot", "t.digit").count().collect()
        counts: dict[int, list[tuple[bytes, int]]] = {}
        for r in seen:  # at most 65,536 a slot
            counts.setdefault(r["slot"], []).append((bytes(r["digit"]), r["count"]))
        ordered, left = {slot: sorted(rows) for slot, rows in counts.items()}, []
        for c, i, rank, prefix in open_ranks:
            for digit, n in ordered[number[c, prefix]]:
                if rank <= n:
                    if n == 1 or len(digit) < DIGIT:
                        found[c, i] = prefix + digit, len(digit) < DIGIT
                    else:
                        left.append((c, i, rank, prefix + digit))
                    break
                rank -= n
        open_ranks = left
    return {c: [found[c, i] for i in range(len(wanted))] for c, wanted in ranks.items()}


def tiles(df: DataFrame, count: int, values: Mapping[str, Column], tiebreak: str) -> DataFrame:
    """``df`` with ``ntile(count)`` over (value, tiebreak) for every named value, all in the same few passes.

    Values are whole numbers and not null; negate one for falling order. With a tiebreak that is unique the
    tiles are those of a sort; rows of equal place share a tile.
    """
    keys = {name: f"_place_{i}" for i, name in enumerate(values)}
    rows = cut(df.withColumns({keys[name]: place(v, F.col(tiebreak)) for name, v in values.items()}))
    bounds = rows.agg(F.count(F.lit(1)).alias("n"), *[f(k).alias(f"{f.__name__}{k}") for k in keys.values() for f in (F.min, F.max)]).first()
    if not bounds["n"]:
        return rows.drop(*keys.values()).withColumns({name: F.lit(1) for name in values})
    size, more = divmod(bounds["n"], count)
    ends = [size * j + min(j, more) for j in range(1, count)]
    cuts = select_ranks(rows, {k: [e for e in ends if e] for k in keys.values()}, {k: bounds[f"min{k}"] for k in keys.values()},
                        {k: bounds[f"max{k}"] for k in keys.values()})
    tile = {}
    for name, k in keys.items():
        over = F.lit(1)
        for end, whole in cuts[k]:  # count - 1 comparisons
            over = over + F.when((F.col(k) if whole else F.substring(k, 1, len(end))) > F.lit(end), 1).otherwise(0)
        tile[name] = over
    return rows.withColumns(tile).drop(*keys.values())
