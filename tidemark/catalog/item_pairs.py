"""Queries: pairs of items and their rules from vertical bitmaps, with no least count."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.catalog.growth import _R6, _rounded, baskets
from tidemark.operators.item_bitmaps import bitmap_pairs
from tidemark.operators.pairs import rules
from tidemark.registry import query
from tidemark.session import cut
from tidemark.sources.tables import Tables


@query("part_pairs_bitmaps", """
  SELECT x.l_partkey AS a, y.l_partkey AS b, count(DISTINCT x.l_orderkey) AS co_count
  FROM lineitem x JOIN lineitem y ON x.l_orderkey = y.l_orderkey AND x.l_partkey < y.l_partkey GROUP BY ALL""")
def part_pairs_bitmaps(t: Tables):
    """Every two parts that any order holds, with the number of such orders."""
    return bitmap_pairs(t.lineitem, 1, "l_orderkey", "l_partkey")


@query("brand_rules_bitmaps", f"SELECT {_R6} FROM basket_dir")
def brand_rules_bitmaps(t: Tables):
    """Both directions of every pair of brands, down to a single shared basket."""
    rows = cut(baskets(t))
    total = rows.agg(F.countDistinct("basket").alias("n")).first()["n"]
    return _rounded(rules(rows, bitmap_pairs(rows), total))
