"""Merges and scans read the partitions and row groups they need, and no more."""

from pyspark.sql import functions as F

from tests.conftest import DATA
from tidemark.sources.store import PartitionedTable
from tidemark.sources.tables import Tables


def scanned(df):
    """Partitions read by the file scans of an executed plan."""
    plan, seen = df._jdf.queryExecution().executedPlan(), []

    def walk(node):
        name = node.nodeName()
        if name.startswith("AdaptiveSparkPlan"):
            return walk(node.executedPlan())
        if "QueryStage" in name:
            return walk(node.plan())
        if name.startswith("Scan"):
            metrics = node.metrics()
            if metrics.contains("numPartitions"):
                seen.append(metrics.apply("numPartitions").value())
        children = node.children()
        for i in range(children.size()):
            walk(children.apply(i))

    df.collect()
    walk(plan)
    return seen


def test_merge_of_one_day_reads_one_of_thirty_partitions(spark, tmp_path, monkeypatch):
    from tidemark.sources import store

    rows = spark.range(3000).select((F.col("id") % 100).alias("key"), F.lit(0).alias("value"),
                                    F.format_string("d%02d", F.col("id") % 30).alias("day")).dropDuplicates(["key", "day"])
    table = PartitionedTable(spark, str(tmp_path / "t"), {"day": F.col("day")})
    table.merge(rows, ["key", "day"])
    plans, real = [], store.cut
    monkeypatch.setattr(store, "cut", lambda df: plans.append(df) or real(df))
    before = table.read().count()
    batch = rows.where("day = 'd07'").withColumn("value", F.lit(9))
    table.merge(batch, ["key", "day"])
    assert [n for n in scanned(plans[-1])] == [1]
    assert table.read().count() == before
    assert table.read().where("value = 9").select("day").distinct().collect()[0]["day"] == "d07"


def test_bounds_reach_the_scan(spark):
    day = Tables(spark, DATA).within("events", "ts", "2024-01-05 00:00:00", "2024-01-06 00:00:00").events
    text = day._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts," in text and "LessThan(ts," in text
    whole = Tables(spark, DATA).events
    assert day.count() == whole.where("ts >= timestamp'2024-01-05' and ts < timestamp'2024-01-06'").count() > 0


def test_single_day_extract_bounds_its_scan(spark):
    from tidemark.catalog.commerce import single_day_extract
    from tidemark.session import configure

    configure(spark)
    day = single_day_extract(Tables(spark, DATA))
    text = day._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts," in text and "LessThan(ts," in text
    assert {r["event_date"].isoformat() for r in day.select("event_date").distinct().collect()} == {"2024-01-15"}
