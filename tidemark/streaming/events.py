"""Event-time features over a stream of commerce event messages."""

from __future__ import annotations

import threading
from collections import Counter
from collections.abc import Callable, Iterator, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming.listener import StreamingQueryListener

from tidemark.session import cut, scratch_path
from tidemark.sources.store import PartitionedTable

KEY = ["user_pseudo_id", "event_ts_micros", "event_name", "item_id"]
LATENESS = "30 seconds"
SESSION_GAP = "30 minutes"
SENTINEL_USER = "_sentinel"

MESSAGE = T.StructType([
    T.StructField("schema_version", T.IntegerType()), T.StructField("event_date", T.DateType()),
    T.StructField("event_ts_micros", T.LongType()), T.StructField("event_name", T.StringType()),
    T.StructField("user_pseudo_id", T.StringType()), T.StructField("ga_session_id", T.LongType()),
    T.StructField("item_id", T.StringType()), T.StructField("item_name", T.StringType()),
    T.StructField("item_category", T.StringType()), T.StructField("price", T.DoubleType()),
    T.StructField("quantity", T.LongType()), T.StructField("item_revenue", T.DoubleType()),
    T.StructField("transaction_id", T.StringType()), T.StructField("device_category", T.StringType()),
    T.StructField("geo_country", T.StringType()),
    T.StructField("_replay", T.StructType([
        T.StructField("duplicate", T.BooleanType()), T.StructField("sentinel", T.BooleanType())])),
])


# --- messages and source ----------------------------------------------------------------

def messages(events: DataFrame, seed: int = 1, duplicate_percent: int = 2) -> DataFrame:
    """Events as JSON messages; a seeded hash of the key decides which are sent twice."""
    fields = [f.name for f in MESSAGE.fields if f.name not in ("schema_version", "_replay")]
    rows = events.select(F.lit(1).alias("schema_version"), *[F.col(c).cast(MESSAGE[c].dataType).alias(c) for c in fields])
    twice = F.crc32(F.concat_ws("|", *KEY, F.lit(str(seed)))) % 100 < duplicate_percent
    copies = F.when(twice, F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))
    rows = rows.withColumn("_copy", F.explode(copies))
    rows = rows.withColumn("_replay", F.struct(F.col("_copy").alias("duplicate"), F.lit(False).alias("sentinel"))).drop("_copy")
    return rows.select("event_ts_micros", *KEY[:1], *KEY[2:], F.to_json(F.struct(*MESSAGE.fieldNames())).alias("value"))


def file_source(spark: SparkSession, folder: str, max_files: int | None = None) -> DataFrame:
    reader = spark.readStream
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.text(f"{folder}/*")


def kafka_source(spark: SparkSession, servers: str, topic: str) -> DataFrame:
    """The same messages from a broker, where the connector is on the classpath."""
    return (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
            .option("subscribe", topic).option("startingOffsets", "earliest").load()
            .select(F.col("value").cast("string").alias("value")))


def parse(raw: DataFrame) -> DataFrame:
    """Messages to columns. A bad message is counted by the observation and left out, never fatal."""
    parsed = raw.select(F.from_json("value", MESSAGE).alias("m"))
    bad = F.col("m").isNull() | F.col("m.event_ts_micros").isNull() | F.col("m.user_pseudo_id").isNull()
    seen = parsed.observe("messages", F.count(F.lit(1)).alias("read"), F.count_if(bad).alias("bad"))
    return seen.where(~bad).select("m.*").withColumn("event_ts", F.timestamp_micros("event_ts_micros"))


def clean(raw: DataFrame) -> DataFrame:
    """Parsed, watermarked on event time, without copies.

    The event time is part of the key, so a copy that comes after its state is gone is older
    than the watermark and dropped as late: exact, with bounded state.
    """
    return (parse(raw).withWatermark("event_ts", LATENESS)
            .dropDuplicates([*KEY, "event_ts"]))


def real(events: DataFrame) -> DataFrame:
    return events.where(F.col("user_pseudo_id") != SENTINEL_USER)


# --- features ---------------------------------------------------------------------------

def views_by_user_category(events: DataFrame, size: str = "5 minutes", slide: str = "1 minute") -> DataFrame:
    rows = events.where("event_name = 'view_item' and item_category is not null")
    return (rows.groupBy(F.window("event_ts", size, slide).alias("w"), "user_pseudo_id", "item_category")
            .agg(F.count(F.lit(1)).alias("view_count_5m"))
            .select("user_pseudo_id", "item_category", F.col("w.end").alias("window_end"), "view_count_5m"))


def item_heat(events: DataFrame, size: str = "15 minutes", slide: str = "1 minute") -> DataFrame:
    return (events.groupBy(F.window("event_ts", size, slide).alias("w"), "item_id")
            .agg(F.count(F.lit(1)).alias("pop_15m"), F.count_if(F.col("event_name") == "purchase").alias("purchase_15m"))
            .select("item_id", F.col("w.end").alias("window_end"), "pop_15m", "purchase_15m"))


def item_panes(events: DataFrame, size: str = "1 minute") -> DataFrame:
    """Counts of the panes that sliding windows are made of: one state row an item and minute."""
    return (events.groupBy(F.window("event_ts", size).alias("w"), "item_id")
            .agg(F.count(F.lit(1)).alias("events"), F.count_if(F.col("event_name") == "purchase").alias("purchases"))
            .select("item_id", F.col("w.end").alias("pane_end"), "events", "purchases"))


def heat_of_panes(panes: DataFrame, minutes: int = 15) -> DataFrame:
    """The windows of ``item_heat`` from one-minute panes: each pane counts in ``minutes`` windows."""
    ends = F.sequence(F.col("pane_end"), F.col("pane_end") + F.make_interval(mins=F.lit(minutes - 1)), F.expr("INTERVAL 1 MINUTE"))
    return (panes.withColumn("window_end", F.explode(ends)).groupBy("item_id", "window_end")
            .agg(F.sum("events").alias("pop_15m"), F.sum("purchases").alias("purchase_15m")))


def session_windows(events: DataFrame, gap: str = SESSION_GAP) -> DataFrame:
    only = lambda e: F.collect_set(F.when(F.col("event_name") == e, F.col("item_id")))
    out = events.groupBy("user_pseudo_id", F.session_window("event_ts", gap).alias("s")).agg(
        F.count(F.lit(1)).alias("events_count"), F.max("event_ts").alias("session_end_ts"),
        only("add_to_cart").alias("_in"), only("purchase").alias("_out"),
        F.sum(F.when(F.col("event_name") == "purchase", F.coalesce("item_revenue", F.lit(0.0))).otherwise(0.0)
              .cast("decimal(18,2)")).alias("session_revenue"))
    return out.select("user_pseudo_id", F.col("s.start").alias("session_start_ts"), "session_end_ts", "events_count",
                      F.size("_in").alias("items_carted"), F.size("_out").alias("items_purchased"),
                      F.size(F.array_except("_in", "_out")).alias("cart_pending_final"), "session_revenue")


def user_features(events: DataFrame, slide: str = "10 minutes") -> DataFrame:
    """The nine serving features per user and window end, over sixty and thirty minutes."""
    rows = events.withColumn("w", F.window("event_ts", "60 minutes", slide))
    is_ = lambda e: F.col("event_name") == e
    recent = F.col("event_ts") >= F.col("w.end") - F.expr("INTERVAL 30 MINUTES")
    newest = F.max(F.struct("event_ts_micros", "event_name", "item_id"))
    per_category = rows.groupBy("user_pseudo_id", "w", "item_category").agg(
        F.count_if(is_("view_item")).alias("views"), F.count_if(is_("add_to_cart")).alias("carts"),
        F.count_if(recent).alias("recent"), newest.alias("last"))
    views = F.when((F.col("views") > 0) & F.col("item_category").isNotNull(),
                   F.struct((-F.col("views")).alias("n"), F.col("item_category").alias("c")))
    out = per_category.groupBy("user_pseudo_id", "w").agg(
        F.sum("views").alias("views_1h"), F.sum("carts").alias("carts_1h"), F.sum("recent").alias("events_30m"),
        F.min(views).alias("top"), F.max("last").alias("last"))
    ms = F.expr("last.event_ts_micros div 1000")
    return out.select("user_pseudo_id", F.col("w.end").alias("window_end"), "views_1h", "carts_1h", "events_30m",
                      F.col("top.c").alias("top_cat_1h"), F.coalesce(-F.col("top.n"), F.lit(0)).alias("top_cat_views_1h"),
                      F.col("last.item_id").alias("last_item_id"), F.col("last.event_name").alias("last_event_name"),
                      ms.alias("last_event_ts_ms"), ms.alias("rt_updated_at_ms"))


LIVE_SCHEMA = ("user_pseudo_id string, event_ts_micros bigint, event_name string, item_id string, "
               "session_events bigint, session_cart_pending bigint, session_started_micros bigint")
CLEARED = "session_cleared"


def live_sessions(events: DataFrame, gap_seconds: int = 1800) -> DataFrame:
    """The current session of every user: a cart that grows and shrinks, cleared after the idle gap.

    State is one fact row and the pending items per user. Each event gives one absolute update;
    a session's end gives one clearing update, by timer or by the next event, whichever is seen
    first, so the updates do not depend on how the stream is cut into batches. One batch of one
    user is sorted in memory: size batches by the source's rate limit.
    """
    from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

    gap = gap_seconds * 1_000_000
    columns = [c.split()[0] for c in LIVE_SCHEMA.split(", ")]

    class LiveSession(StatefulProcessor):
        def init(self, handle: StatefulProcessorHandle) -> None:
            self.handle = handle
            self.facts = handle.getValueState("facts", "events bigint, started bigint, last bigint")
            self.cart = handle.getMapState("cart", "item_id string", "micros bigint")

        def handleInputRows(self, key, rows, timerValues) -> Iterator:
            import pandas as pd

            batch = pd.concat(list(rows)).sort_values(["event_ts_micros", "event_name", "item_id"])
            count, started, last = self.facts.get() if self.facts.exists() else (0, None, None)
            pending = {k[0] for k in self.cart.keys()}
            out = []
            for micros, event, item in batch[["event_ts_micros", "event_name", "item_id"]].itertuples(index=False):
                micros = int(micros)
                if count and micros - last > gap:
                    out.append((key[0], last, CLEARED, None, 0, 0, started))
                    count, pending = 0, set()
                if not count:
                    started = micros
                count, last = count + 1, micros if last is None else max(last, micros)
                if event == "add_to_cart":
                    pending.add(item)
                elif event == "purchase":
                    pending.discard(item)
                out.append((key[0], micros, event, item, count, len(pending), started))
            self.cart.clear()
            for item in pending:
                self.cart.updateValue((item,), (last,))
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            self.handle.registerTimer((last + gap) // 1000 + 1)
            self.facts.update((count, started, last))
            yield pd.DataFrame(out, columns=columns)

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator:
            import pandas as pd

            _, started, last = self.facts.get()
            self.facts.clear()
            self.cart.clear()
            yield pd.DataFrame([(key[0], last, CLEARED, None, 0, 0, started)], columns=columns)

        def close(self) -> None:
            pass

    cols = events.select("user_pseudo_id", "event_ts", "event_ts_micros", "event_name", "item_id")
    return cols.groupBy("user_pseudo_id").transformWithStateInPandas(
        LiveSession(), outputStructType=LIVE_SCHEMA, outputMode="Append", timeMode="EventTime")


# --- running ----------------------------------------------------------------------------

class LateRows(StreamingQueryListener):
    """Rows that the watermark kept out of any stateful step, over all batches of each query."""

    def __init__(self) -> None:
        self.dropped: Counter = Counter()
        self.ended: dict[str, threading.Event] = {}

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        late = sum(o.numRowsDroppedByWatermark for o in event.progress.stateOperators)
        self.dropped[str(event.progress.runId)] += late

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.ended.setdefault(str(event.runId), threading.Event()).set()

    def of(self, run: str, seconds: int = 60) -> int:
        """The count of a run that has ended, once its last report is in."""
        if not self.ended.setdefault(run, threading.Event()).wait(seconds):
            raise TimeoutError(f"no end reported for run {run}")
        return self.dropped[run]


class Replay:
    """An ordered backfill: chunks of messages in event-time order, then one closing message.

    Every chunk is one folder under ``inbox`` and one run of the query from its checkpoint, so
    each replay also restarts the query as often as it has chunks. ``state_partitions`` is the number
    of partitions of all state; the checkpoint keeps it from the first run on, so choose it for the
    largest state to come. Without it the session's number of shuffle partitions holds.
    """

    def __init__(self, spark: SparkSession, name: str, close_after: str = "91 minutes", state_partitions: int | None = None) -> None:
        self.spark, self.close_after, self.state_partitions = spark, close_after, state_partitions
        self.late = 0
        self.base = scratch_path(spark, f"replay-{name}")
        self.inbox, self.out, self.state = f"{self.base}/in", f"{self.base}/out", f"{self.base}/state"
        self.progress: list[dict] = []

    def send(self, rows: DataFrame, chunk: str) -> None:
        order = ["event_ts_micros", "user_pseudo_id", "event_name", "item_id"]
        rows.repartitionByRange(*order).sortWithinPartitions(*order).select("value").write.text(f"{self.inbox}/{chunk}")

    def close(self, rows: DataFrame) -> None:
        """One message far enough past the newest event to push the watermark over every window."""
        newest = rows.agg(F.max("event_ts_micros").alias("m"))
        pushed = F.unix_micros(F.timestamp_micros("m") + F.expr(f"INTERVAL {self.close_after}") + F.expr("INTERVAL 31 SECONDS"))
        body = newest.select(F.to_json(F.struct(
            F.lit(1).alias("schema_version"), pushed.alias("event_ts_micros"), F.lit("sentinel").alias("event_name"),
            F.lit(SENTINEL_USER).alias("user_pseudo_id"), F.lit("_").alias("item_id"),
            F.struct(F.lit(False).alias("duplicate"), F.lit(True).alias("sentinel")).alias("_replay"))).alias("value"))
        body.write.text(f"{self.inbox}/zz-close")

    def run(self, features: Callable[[DataFrame], DataFrame], sink: Callable[[DataFrame, int], None] | None = None,
            max_files: int | None = None) -> T.StructType:
        stream = features(file_source(self.spark, self.inbox, max_files))
        writer = stream.writeStream.outputMode("append").option("checkpointLocation", self.state).trigger(availableNow=True)
        writer = writer.foreachBatch(sink) if sink else writer.format("parquet").option("path", self.out)
        listener = LateRows()
        self.spark.streams.addListener(listener)
        try:
            query = self._start(writer)
            query.awaitTermination()
            self.late += listener.of(str(query.runId))
        finally:
            self.spark.streams.removeListener(listener)
        self.progress += [p.asDict() if hasattr(p, "asDict") else p for p in query.recentProgress]
        return stream.schema

    def _start(self, writer):
        conf, name = self.spark.conf, "spark.sql.shuffle.partitions"
        if self.state_partitions is None:
            return writer.start()
        asked = conf.get(name)
        conf.set(name, str(self.state_partitions))
        try:
            return writer.start()
        finally:
            conf.set(name, asked)

    def replay(self, rows: DataFrame, features: Callable[[DataFrame], DataFrame],
               cuts: Sequence[str] = (), sink: Callable[[DataFrame, int], None] | None = None) -> DataFrame | None:
        """Send the rows in chunks split at ``cuts`` (timestamps), close, and read the result table."""
        at = F.timestamp_micros("event_ts_micros")
        edges: list[Column | None] = [None, *[F.lit(c).cast("timestamp") for c in cuts], None]
        for i, (low, high) in enumerate(zip(edges, edges[1:])):
            part = rows if low is None else rows.where(at >= low)
            part = part if high is None else part.where(at < high)
            self.send(part, f"chunk-{i:04d}")
            self.run(features, sink)
        self.close(rows)
        schema = self.run(features, sink)
        return None if sink else self.spark.read.schema(schema).parquet(self.out)

    def late_rows(self) -> int:
        """Rows the watermark kept out of stateful steps, over all batches of all runs."""
        return self.late


def keyed_sink(table: PartitionedTable, keys: Sequence[str], newest_by: str) -> Callable[[DataFrame, int], None]:
    """Absolute values by key, so a batch written twice, or after a newer one, leaves the same table."""
    def write(batch: DataFrame, _batch_id: int) -> None:
        batch = cut(batch)  # the micro-batch is planned once
        if not batch.isEmpty():
            table.merge(batch, keys, newest_by)
    return write


def drained(progress: Sequence, needed: int = 2) -> bool:
    """Whether the last ``needed`` progress reports saw the source read to its end."""
    def caught_up(p) -> bool:
        sources = p["sources"] if isinstance(p, dict) else p.sources
        rows = lambda s: s["numInputRows"] if isinstance(s, dict) else s.numInputRows
        return all(rows(s) == 0 for s in sources)
    return len(progress) >= needed and all(caught_up(p) for p in list(progress)[-needed:])


__all__ = ["CLEARED", "KEY", "MESSAGE", "Replay", "clean", "drained", "heat_of_panes", "item_heat", "item_panes", "kafka_source", "keyed_sink", "live_sessions",
           "messages", "parse", "real", "session_windows", "user_features", "views_by_user_category"]
