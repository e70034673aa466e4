"""The message log, its stream reader, restarts, limits and lag."""

import pytest
from pyspark.sql import functions as F

from tidemark.session import scratch_path
from tidemark.streaming.log_source import EventLog, EventLogReader, admitted, drain_to, ends, key_partition, lag, planned


def send(spark, log, users, first=0):
    rows = spark.createDataFrame([(u, first + i, f"{first + i}" if (first + i) % 10 else "bad") for i, u in enumerate(users)], "user string, at long, value string")
    log.append(rows, "user", [F.col("at").asc()])


def start(log, root, limit, rows_per_task=7):
    parsed = lambda df: df.withColumn("number", F.expr("try_cast(value AS long)"))
    write = drain_to(f"{root}-good", f"{root}-bad", parsed, F.col("number").isNull())
    return log.stream(f"{root}-checkpoint", limit, rows_per_task).writeStream.foreachBatch(write).option("checkpointLocation", f"{root}-checkpoint").start()


def drain(log, root, limit):
    run = start(log, root, limit)
    try:
        run.processAllAvailable()
        return [p["numInputRows"] for p in run.recentProgress if p["numInputRows"]]
    finally:
        run.stop()


def test_restarts_limits_and_lag(spark):
    root = scratch_path(spark, "log-test")
    log = EventLog(spark, root)
    users = ["hot"] * 100 + [f"u{i}" for i in range(200)]  # one user sends a third
    send(spark, log, users)
    before = {r["partition"]: r["lag"] for r in lag(spark, root, f"{root}-checkpoint").collect()}
    assert sum(before.values()) == 300 and planned(f"{root}-checkpoint") is None
    sizes = drain(log, root, 80)
    assert sum(sizes) == 300 and max(sizes) <= 80 and len(sizes) == 4
    assert [r["lag"] for r in lag(spark, root, f"{root}-checkpoint").collect()] == [0, 0, 0]

    send(spark, log, users, 300)
    assert sum(r["lag"] for r in lag(spark, root, f"{root}-checkpoint").collect()) == 300
    assert sum(drain(log, root, 1000)) == 300  # only what is new after the restart
    for _ in range(2):
        assert {r["lag"] for r in lag(spark, root, f"{root}-checkpoint").collect()} == {0}

    good, bad = spark.read.parquet(f"{root}-good"), spark.read.parquet(f"{root}-bad")
    assert sorted(r["number"] for r in good.collect()) == [i for i in range(600) if i % 10]
    assert bad.count() == 60 and {r["value"] for r in bad.collect()} == {"bad"}
    places = good.select("partition", "offset").unionByName(bad.select("partition", "offset"))
    assert places.distinct().count() == 600
    for p, end in ends(root, 3).items():
        assert sorted(r["offset"] for r in places.where(F.col("partition") == int(p)).collect()) == list(range(end))
    inside = good.join(spark.createDataFrame([(u, i) for i, u in enumerate(users * 2)], "user string, number long"), "number")
    assert inside.where(F.col("partition") != key_partition(F.col("user"), 3)).count() == 0
    behind = [r["number"] for r in good.where(F.col("partition") == 0).orderBy("offset").collect()]
    assert behind == sorted(behind)  # in order within a partition


def test_slices_split_a_hot_partition(spark):
    root = scratch_path(spark, "log-slices")
    log = EventLog(spark, root)
    send(spark, log, ["one"] * 50)
    send(spark, log, ["one"] * 20, 50)
    reader = EventLogReader({"path": root, "rowsPerTask": "15"})
    parts = reader.partitions(reader.initialOffset(), ends(root, 3))
    assert [(p.first, p.end) for p in parts] == [(0, 15), (15, 30), (30, 45), (45, 60), (60, 70)]
    assert parts[3].batches == [0, 1] and parts[0].batches == [0]
    numbers = [n for p in parts for rows in reader.read(p) for n in rows.column("offset").to_pylist()]
    assert numbers == list(range(70))
    assert reader.partitions(ends(root, 3), ends(root, 3)) == []


def test_an_append_without_its_table_is_never_read(spark):
    root = scratch_path(spark, "log-failed")
    log = EventLog(spark, root)
    send(spark, log, ["a", "b", "c"])
    spark.range(5).selectExpr("0 AS partition", "id + 3 AS offset", "'lost' AS value").write.partitionBy("partition").parquet(f"{root}/data/batch=1-attempt")
    assert sum(ends(root, 3).values()) == 3
    assert sum(drain(log, root, 10)) == 3


@pytest.mark.parametrize("limit", [1, 2, 7, 100, 10**6])
def test_admission_is_fair_and_bounded(limit):
    at, end = {"0": 5, "1": 0, "2": 9}, {"0": 1005, "1": 10, "2": 9}
    steps = 0
    while at != end:
        on = admitted(at, end, limit)
        gain = sum(on.values()) - sum(at.values())
        assert 1 <= gain <= limit and all(at[p] <= on[p] <= end[p] for p in at)
        at, steps = on, steps + 1
    assert steps == -(-1010 // limit)
    assert admitted(end, end, limit) == end
