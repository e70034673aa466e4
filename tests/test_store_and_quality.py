"""Tables, upserts, marts and the checks that must bite."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidemark.plans import marts, pipeline, quality
from tidemark.schemas import CATEGORIES, REGIONS, SILVER, SILVER_KEY
from tidemark.sources import store
from tidemark.sources.landing import hour_list


def snapshot(vid="a", region="TW", hour=0, views=100, day=8, **over):
    at = datetime(2026, 7, day, hour)
    row = dict(video_id=vid, region=region, captured_at=at, title="t", description=None, tags="x", channel_id="c", channel_title="C",
               category_id="1", published_at=at, views=views, likes=1, comment_count=1, like_ratio=0.1, engagement_rate=0.2,
               thumbnail_url="u", ingestion_id="i", ingested_at=at)
    return {**row, **over}


def silver(spark, *rows):
    return spark.createDataFrame([tuple(r[c] for c in SILVER.fieldNames()) for r in rows], SILVER)


def categories(spark, *pairs):
    return spark.createDataFrame([(c, r, f"N{c}", datetime(2026, 7, 8)) for c, r in pairs], CATEGORIES)


def test_velocity_uses_real_hours_and_drops_the_first(spark):
    rows = silver(spark, snapshot(hour=0, views=100), snapshot(hour=3, views=400), snapshot(hour=4, views=0), snapshot(hour=5, views=10))
    got = {r["captured_at"].hour: r for r in marts.velocity_hourly(marts.stg_video_snapshots(rows)).collect()}
    assert set(got) == {3, 4, 5}
    assert (float(got[3]["hours_since_prev"]), float(got[3]["delta_views_per_hour"]), float(got[3]["delta_views_pct"])) == (3.0, 100.0, 300.0)
    assert got[5]["delta_views_pct"] is None


def test_equal_rates_share_a_rank(spark):
    rows = [snapshot(v, hour=h, views=100 * h * k) for v, k in (("a", 1), ("b", 2), ("c", 2), ("d", 3)) for h in (0, 1)]
    got = {r["video_id"]: r["velocity_rank"] for r in marts.velocity_hourly(marts.stg_video_snapshots(silver(spark, *rows))).collect()}
    assert got == {"d": 1, "b": 2, "c": 2, "a": 4}


def test_single_snapshot_has_life_but_no_peak(spark):
    life = marts.video_lifecycle(marts.stg_video_snapshots(silver(spark, snapshot())), categories(spark, ("1", "TW"))).first()
    assert life["peak_delta_views_per_hour"] is None and life["snapshots_count"] == 1 and life["category_name"] == "N1"


def test_null_keys_drop_from_inner_and_stay_in_left_joins(spark):
    stg = marts.stg_video_snapshots(silver(spark, snapshot(), snapshot("n", channel_id=None, category_id=None), snapshot("u", category_id="9")))
    assert {r["channel_id"] for r in marts.channel_performance(stg).collect()} == {"c"}
    names = {r["category_id"]: r["category_name"] for r in
             marts.category_daily(marts.latest_per_day(stg), categories(spark, ("1", "TW"))).collect()}
    assert names == {"1": "N1", None: None, "9": "9"}


def test_upsert_twice_changes_nothing_and_refuses_double_keys(spark):
    base = silver(spark, snapshot("a"), snapshot("b"))
    batch = silver(spark, snapshot("b", views=7), snapshot("c"))
    once = store.upsert(base, batch, SILVER_KEY)
    twice = store.upsert(once, batch, SILVER_KEY)
    expect = {"a": 100, "b": 7, "c": 100}
    assert {r["video_id"]: r["views"] for r in once.collect()} == {r["video_id"]: r["views"] for r in twice.collect()} == expect
    with pytest.raises(store.DuplicateKeys):
        store.upsert(base, batch.unionAll(batch), SILVER_KEY)


def test_partitioned_merge_touches_only_its_partitions(spark, tmp_path):
    table = store.PartitionedTable(spark, str(tmp_path / "t"), {"region": F.col("region"), "_hour": F.date_format("captured_at", "yyyyMMddHH")})
    table.merge(silver(spark, snapshot("a"), snapshot("b", "JP"), snapshot("c", hour=1)), SILVER_KEY)
    before = {f for f in table.read().inputFiles() if "region=JP" in f}
    table.merge(silver(spark, snapshot("a", views=5), snapshot("d")), SILVER_KEY)
    rows = {(r["video_id"], r["region"]): r["views"] for r in table.read().collect()}
    assert rows == {("a", "TW"): 5, ("b", "JP"): 100, ("c", "TW"): 100, ("d", "TW"): 100}
    assert before == {f for f in table.read().inputFiles() if "region=JP" in f}
    assert set(table.read().columns) == set(SILVER.fieldNames())


def test_dynamic_overwrite_leaves_other_regions(spark, tmp_path):
    path = str(tmp_path / "o")
    store.overwrite_partitions(store.with_hour(silver(spark, snapshot("a"), snapshot("b", "JP"))), path, ["region", store.HOUR_PARTITION])
    store.overwrite_partitions(store.with_hour(silver(spark, snapshot("z"))), path, ["region", store.HOUR_PARTITION])
    assert {r["video_id"] for r in store.read_table(spark, path).collect()} == {"z", "b"}


def test_range_scan_prunes_and_guards(spark, tmp_path):
    path = str(tmp_path / "r")
    store.overwrite_partitions(store.with_hour(silver(spark, *[snapshot(hour=h) for h in range(6)])), path, ["region", store.HOUR_PARTITION])
    at = lambda h: F.lit(f"2026-07-08 {h:02d}:00:00").cast("timestamp")
    df = store.range_scan(spark.read.schema(store.read_table(spark, path).schema).parquet(path), at(1), at(3), SILVER.fieldNames())
    assert sorted(r["captured_at"].hour for r in df.collect()) == [1, 2, 3]
    assert "PartitionFilters: [isnotnull(captured_hour" in df._jdf.queryExecution().toString()
    with pytest.raises(store.EmptyScan):
        store.range_scan(store.read_table(spark, path), at(9), at(9), SILVER.fieldNames(), strict=True)


def test_keyed_table_keeps_the_newest_row_whatever_comes_again(spark):
    table = store.keyed_table(spark, "keyed", "k", buckets=3)
    rows = lambda *r: spark.createDataFrame(list(r), "k int, at int, v string")
    assert not table.exists()
    table.merge(rows((1, 5, "a"), (1, 4, "old"), (2, 1, "b")), ["k"], "at")
    for _ in range(2):
        table.merge(rows((1, 3, "late"), (3, 9, "c"), (2, 2, "d")), ["k"], "at")
    assert sorted(map(tuple, table.read().collect())) == [(1, 5, "a"), (2, 2, "d"), (3, 9, "c")]


def good(spark):
    stg = silver(spark, *[snapshot("a", hour=h, views=10 * (h + 1)) for h in range(3)])
    return marts.build(stg, categories(spark, ("1", "TW")))


def fails(models, name):
    with pytest.raises(quality.GateFailed) as failure:
        quality.gate(quality.standard_checks(models))
    return name in failure.value.failures


def test_gate_passes_clean_models(spark):
    assert quality.gate(quality.standard_checks(good(spark))) == []


def test_every_check_bites_by_name(spark):
    models = good(spark)
    with_ = lambda m, df: {**models, m: df}
    stg, velocity = models["stg_video_snapshots"], models["gold_video_velocity_hourly"]
    assert fails(with_("stg_video_snapshots", stg.withColumn("views", F.lit(None).cast("long"))), "not_null:stg_video_snapshots")
    assert fails(with_("stg_video_snapshots", stg.withColumn("region", F.lit("XX"))), "accepted_values:region")
    assert fails(with_("stg_video_snapshots", stg.withColumn("likes", F.lit(-1).cast("long"))), "non_negative:counts")
    assert fails(with_("gold_video_velocity_hourly", velocity.withColumn("hours_since_prev", F.lit(0))), "positive:hours_since_prev")
    for m in quality.GRAINS:
        assert fails(with_(m, models[m].unionAll(models[m])), f"unique:{m}")
    for m in ("stg_categories", "gold_trending_daily", "gold_video_lifecycle"):
        column = quality.NOT_NULL[m][0]
        assert fails(with_(m, models[m].withColumn(column, F.lit(None).cast(models[m].schema[column].dataType))), f"not_null:{m}")


def test_missing_category_only_warns(spark):
    models = good(spark)
    models["stg_categories"] = categories(spark, ("2", "TW"))
    assert quality.gate(quality.standard_checks(models)) == ["relationships:category_id"]


def test_freshness_levels(spark):
    df = silver(spark, snapshot(hour=0))
    level = lambda h: quality.freshness(df, quality.SOURCES["video_snapshots"], F.lit(f"2026-07-08 {h}:30:00").cast("timestamp")).first()["status"]
    assert [level("01"), level("03"), level("05")] == ["pass", "warn", "error"]
    fresh = quality.freshness(df, quality.SOURCES["video_snapshots"], F.lit("2026-07-08 05:30:00").cast("timestamp"))
    with pytest.raises(quality.GateFailed, match="freshness:video_snapshots"):
        quality.gate([], fresh=fresh)
    assert quality.stale(df, "ingested_at", F.lit("2026-07-08 05:30:00").cast("timestamp"), 4).count() == 1


def test_hourly_pipeline(spark, tmp_path):
    table = store.PartitionedTable(spark, str(tmp_path / "p"), {"region": F.col("region"), "_hour": F.date_format("captured_at", "yyyyMMddHH")})
    rows, cats = silver(spark, *[snapshot(hour=h, views=h + 1) for h in range(3)]), categories(spark, *[("1", r) for r in REGIONS])
    for h in (0, 1, 1):
        models = pipeline.hourly(rows, cats, table, hour_list("2026-07-08", f"{h:02d}")[0], datetime(2026, 7, 8, 2))
    assert models["gold_video_velocity_hourly"].count() == 1 and table.read().count() == 2
    with pytest.raises(store.EmptyScan):
        pipeline.hourly(rows, cats, table, hour_list("2026-07-08", "20")[0], datetime(2026, 7, 8, 21))
