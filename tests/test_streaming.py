"""Streams against batch recomputation, restarts, late and broken messages."""

from pyspark.sql import functions as F

from tests.conftest import DATA
from tidemark.catalog.commerce import ga
from tidemark.sources.tables import Tables
from tidemark.streaming import events as ev


def test_restarted_replay_equals_batch(spark):
    events = ga(Tables(spark, DATA)).persist()
    rows = ev.messages(events, duplicate_percent=20)
    assert rows.count() > events.count()
    replay = ev.Replay(spark, "test")
    out = replay.replay(rows, lambda raw: ev.item_heat(ev.real(ev.clean(raw))), ("2024-01-09", "2024-01-20 03:00:00"))
    batch = ev.item_heat(events)
    assert out.exceptAll(batch).isEmpty() and batch.exceptAll(out).isEmpty() and not out.isEmpty()
    assert replay.late_rows() == 0
    events.unpersist()


def test_windows_of_panes_equal_sliding_windows(spark):
    events = ga(Tables(spark, DATA))
    want, got = ev.item_heat(events), ev.heat_of_panes(ev.item_panes(events))
    assert want.exceptAll(got).isEmpty() and got.exceptAll(want).isEmpty() and not got.isEmpty()


def test_late_rows_are_counted_in_every_batch(spark):
    events = ga(Tables(spark, DATA))
    rows, at = ev.messages(events, duplicate_percent=0), F.timestamp_micros("event_ts_micros")
    replay, keys = ev.Replay(spark, "late-test", state_partitions=2), lambda raw: ev.clean(raw).select(*ev.KEY)
    replay.send(rows.where(at >= "2024-01-20"), "a")
    replay.run(keys)
    replay.send(rows.where(at < "2024-01-10"), "b")
    replay.run(keys, max_files=1)  # several batches, each with late rows
    assert replay.late_rows() == events.where("event_ts < timestamp'2024-01-10'").count() > 0


def test_broken_messages_are_left_out(spark):
    good = ev.messages(ga(Tables(spark, DATA)).limit(3), duplicate_percent=0).select("value")
    bad = spark.createDataFrame([("{not json",), ("{}",)], "value string")
    assert ev.parse(good.unionAll(bad)).count() == 3


def test_drained():
    p = lambda n: {"sources": [{"numInputRows": n}]}
    assert not ev.drained([p(0)]) and not ev.drained([p(0), p(4)]) and ev.drained([p(4), p(0), p(0)])
