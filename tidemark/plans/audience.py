"""Audience selection: a small JSON condition tree becomes one Column."""

from __future__ import annotations

import re
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.operators.ordering import top_n
from tidemark.operators.scalars import attach
from tidemark.sources.store import overwrite_partitions

MAX_DEPTH, MAX_CONDITIONS, MAX_VALUES, MAX_TAGS = 3, 20, 100, 200
_TEXT, _FLAG, _SCORE, _NUMBER, _DATE = "text", "flag", "score", "number", "date"
_ALLOWED = {_TEXT: {"match", "exists"}, _FLAG: {"match"}, _SCORE: {"match", "range", "exists"},
            _NUMBER: {"range", "exists"}, _DATE: {"range"}}

# The fields a condition may name.
FIELDS: dict[str, str] = {
    **dict.fromkeys(["behavior_segment", "value_tier", "funnel_stage_max", "preferred_category",
                     "primary_device_category", "primary_geo_country", "value_cluster_label"], _TEXT),
    **dict.fromkeys(["is_purchaser", "has_cart_abandon"], _FLAG),
    **dict.fromkeys(["r_score", "f_score", "m_score", "rfm_total", "value_cluster"], _SCORE),
    **dict.fromkeys(["recency_days", "frequency_orders", "monetary_total", "aov", "sessions_count", "active_days",
                     "last_active_days", "funnel_sessions_count", "avg_funnel_session_depth",
                     "distinct_items_viewed", "distinct_items_purchased", "engagement_score"], _NUMBER),
    **dict.fromkeys(["first_seen_date", "last_seen_date"], _DATE),
}
_BOUNDS = {"gte": Column.__ge__, "gt": Column.__gt__, "lte": Column.__le__, "lt": Column.__lt__}


class BadCondition(ValueError):
    pass


def _require(ok: bool, message: str) -> None:
    if not ok:
        raise BadCondition(message)


def _leaf(node: Mapping, tags: set[str]) -> Column:
    kind, field = node.get("type"), node.get("field", "")
    if field.startswith("tag:"):
        _require(kind == "exists" and re.fullmatch(r"tag:[a-z0-9_]{1,64}", field) is not None, f"bad tag condition {field}")
        tags.add(field[4:])
        return F.col(f"_{field[4:]}")
    _require(field in FIELDS, f"unknown field {field}")
    _require(kind in _ALLOWED[FIELDS[field]], f"{kind} is not allowed on {field}")
    column = F.col(field)
    if kind == "exists":
        return column.isNotNull()
    if kind == "match":
        values = node.get("values", [])
        _require(1 <= len(values) <= MAX_VALUES, "match needs 1 to 100 values")
        return F.coalesce(column.isin(*values), F.lit(False))
    bounds = {k: node[k] for k in _BOUNDS if k in node}
    _require(bool(bounds), "range needs a bound")
    if FIELDS[field] == _DATE:
        _require(all(re.fullmatch(r"\d{4}-\d{2}-\d{2}", str(v)) for v in bounds.values()), "dates are YYYY-MM-DD")
        bounds = {k: F.lit(v).cast("date") for k, v in bounds.items()}
    return F.coalesce(reduce(Column.__and__, [_BOUNDS[k](column, v) for k, v in bounds.items()]), F.lit(False))


def compile_tree(node: Mapping, depth: int = 1, tags: set[str] | None = None) -> tuple[Column, set[str]]:
    """The predicate and the custom tags it asks about. Raises BadCondition on anything off the list."""
    tags = set() if tags is None else tags
    if "op" not in node:
        return _leaf(node, tags), tags
    _require(node["op"] in ("and", "or"), f"unknown op {node['op']}")
    _require(depth <= MAX_DEPTH, "groups nest at most three deep")
    children = node.get("conditions", [])
    _require(1 <= len(children) <= MAX_CONDITIONS, "a group holds 1 to 20 conditions")
    parts = [compile_tree(c, depth + 1, tags)[0] for c in children]
    return reduce(Column.__and__ if node["op"] == "and" else Column.__or__, parts), tags


def select(profiles: DataFrame, tree: Mapping, memberships: DataFrame | None = None) -> DataFrame:
    """Profiles that satisfy the tree; tag membership joins in as flags."""
    predicate, tags = compile_tree(tree)
    out = profiles
    for tag in sorted(tags):
        members = memberships.where(F.col("tag_key") == tag).select("user_pseudo_id").distinct()
        out = out.join(members.withColumn(f"_{tag}", F.lit(True)), "user_pseudo_id", "left").na.fill(False, [f"_{tag}"])
    return out.where(predicate).select(*profiles.columns)


def preview(profiles: DataFrame, events: DataFrame, tree: Mapping, memberships: DataFrame | None = None) -> DataFrame:
    """Size, base, share, 20 sample users, three top-10 distributions and the stage funnel, as rows."""
    chosen = select(profiles, tree, memberships)
    row = lambda df, section, name, amount: df.select(F.lit(section).alias("section"), name.alias("name"),
                                                      amount.cast("double").alias("amount"))
    size = profiles.agg(F.count(F.lit(1)).alias("base")).transform(attach, chosen.agg(F.count(F.lit(1)).alias("size")))
    totals = size.select(F.expr("""stack(3, 'audience_size', cast(size as double), 'base_count', cast(base as double),
        'pct', round(size / base, 4)) AS (name, amount)""")).select(F.lit("total").alias("section"), "name", "amount")
    sample = row(chosen.orderBy("user_pseudo_id").limit(20), "sample", F.col("user_pseudo_id"), F.col("monetary_total"))
    named = F.explode(F.array(*[F.struct(F.lit(f"distribution:{d}").alias("section"), F.col(d).alias("name"))
                                for d in ("behavior_segment", "value_tier", "preferred_category")]))
    counts = (chosen.select(named.alias("d")).select("d.*").where("name is not null")
              .groupBy("section", "name").agg(F.count(F.lit(1)).alias("amount")))
    top = top_n(counts, ["section"], [F.col("amount").desc(), F.col("name")], 10).select(
        "section", "name", F.col("amount").cast("double").alias("amount"))
    stages = F.create_map(*[F.lit(x) for x in ("view_item", "reached_view", "add_to_cart", "reached_cart",
                                               "begin_checkout", "reached_checkout", "purchase", "reached_purchase")])
    reached = (events.select("user_pseudo_id", "event_name").distinct()
               .join(chosen.select("user_pseudo_id"), "user_pseudo_id", "left_semi")
               .groupBy("event_name").agg(F.count(F.lit(1)).alias("n")))
    funnel = row(reached, "funnel", stages[F.col("event_name")], F.col("n"))
    return totals.unionByName(sample).unionByName(top).unionByName(funnel)


def custom_tags(profiles: DataFrame, definitions: Mapping[str, Mapping]) -> DataFrame:
    """(tag_key, user) for every active definition, in one scan of the profiles."""
    _require(len(definitions) <= MAX_TAGS, "at most 200 active tags")
    marks = []
    for key, tree in definitions.items():
        _require(re.fullmatch(r"[a-z0-9_]{1,64}", key) is not None, f"bad tag key {key}")
        predicate, tags = compile_tree(tree)
        _require(not tags, "a tag definition may not use other tags")
        marks.append(F.when(predicate, F.lit(key)))
    return (profiles.select("user_pseudo_id", F.explode(F.array(*marks)).alias("tag_key"))
            .where("tag_key is not null").select("tag_key", "user_pseudo_id"))


def materialise_tags(members: DataFrame, path: str) -> None:
    """Replace the members of the tags present; other tags stay."""
    overwrite_partitions(members, path, ["tag_key"])


def latest_version(df: DataFrame, keys: list[str], version: str, tiebreak: list[str]) -> DataFrame:
    """The newest version of each key, as a replacing-merge table reads."""
    return top_n(df, keys, [F.col(version).desc(), *[F.col(c).desc() for c in tiebreak]], 1, "_rn").drop("_rn")


def mirror_days(source: DataFrame, mirror: DataFrame, day: str) -> DataFrame:
    """The rows to load again: every day from the mirror's newest on, that day included."""
    mark = mirror.agg(F.max(day).alias("_mark"))
    return source.transform(attach, mark).where(F.col("_mark").isNull() | (F.col(day) >= F.col("_mark"))).drop("_mark")
