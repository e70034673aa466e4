"""Clustered tables without exchanges of snapshots, and parameters of any shape."""

from pyspark.sql import functions as F

from tests.conftest import DATA
from tidemark.catalog import stored
from tidemark.functions import variant as vt
from tidemark.plans import marts
from tidemark.session import configure
from tidemark.sources import adapters
from tidemark.sources.tables import Tables


def exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]


def test_lifecycle_has_no_exchange_of_snapshots(spark):
    configure(spark)
    t = Tables(spark, DATA)
    plain = marts.video_lifecycle(marts.stg_video_snapshots(adapters.silver(t)), adapters.categories(t))
    assert any("hashpartitioning(video_id" in line for line in exchanges(plain))
    kept = marts.video_lifecycle(stored.clustered(t), adapters.categories(t))
    assert not any("hashpartitioning(video_id" in line for line in exchanges(kept))
    assert "SelectedBucketsCount: 8 out of 8" in kept._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(str, kept.collect())) == sorted(map(str, plain.collect()))


def test_deltas_share_the_clustering(spark):
    configure(spark)
    unranked = marts.velocity_unranked(stored.clustered(Tables(spark, DATA)))
    assert exchanges(unranked) == []


ENTRIES = [
    (1, '[{"key":"a","int_value":1},{"key":"a","int_value":2},{"key":"b","string_value":"x"}]'),
    (2, '[{"key":"a","int_value":"7"},{"other":1},5,null]'), (3, '[{"key":"a","int_value":"seven"}]'), (4, '{"key":"a","int_value":1}'),
    (5, "[{"), (6, ""), (7, None), (8, "[]"), (9, '[{"key":"b","double_value":2.5,"string_value":null}]')]


def test_first_entry_of_a_name(spark):
    rows = spark.createDataFrame(ENTRIES, "id int, params string").withColumn("v", vt.variant(F.col("params")))
    found = {r["id"]: (r["a"], r["b"], r["d"]) for r in rows.select(
        "id", vt.entry(F.col("v"), "a", "int_value").alias("a"), vt.entry(F.col("v"), "b", "string_value").alias("b"),
        vt.entry(F.col("v"), "b", "double_value").alias("d")).collect()}
    assert found == {1: (1, "x", None), 2: (7, None, None), 9: (None, None, 2.5), **{i: (None, None, None) for i in (3, 4, 5, 6, 7, 8)}}
    vt.register(spark, "first_entry")
    rows.createOrReplaceTempView("entries")
    sql = "SELECT id, try_variant_get(first_entry(v, key), '$.int_value', 'long') AS a FROM entries CROSS JOIN VALUES ('a'), ('none') AS k(key) WHERE id <= 4"
    assert sorted((r["id"], r["a"]) for r in spark.sql(sql).collect() if r["a"] is not None) == [(1, 1), (2, 7)]


def test_typed_table_by_hour(spark):
    from tidemark.sources import store

    rows = adapters.silver(Tables(spark, DATA)).where("captured_at < timestamp'2024-01-01 06:00:00'")
    name = f"{store.snapshot_schema(spark, 'typed')}.snapshots"
    store.create_snapshot_table(spark, name)
    store.overwrite_snapshot_table(rows, name)
    store.overwrite_snapshot_table(rows.where("captured_at >= timestamp'2024-01-01 03:00:00'"), name)
    kept = spark.table(name)
    assert kept.columns[-2:] == ["region", store.HOUR_PARTITION]
    assert kept.count() == rows.count() > 0
    assert kept.where("captured_hour = '2024010104'").count() == rows.where("hour(captured_at) = 4").count()
