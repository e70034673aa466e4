"""A keyed, partitioned message log and a stream reader over it.

The log. ``EventLog.append`` deals messages by the hash of their key into partitions and numbers them there in
order; numbers go on where the last append ended. An append is one folder a partition, and a small table tells
which numbers each folder holds, written last: what a failed append left is in no table, never read, and replaced
by the next one.

The reader. Offsets are the next number of every partition. A batch takes at most ``maxRowsPerBatch`` messages,
dealt over the partitions by what waits in them, and every task reads at most ``rowsPerTask`` numbers of one
partition, so a key that sends most messages is still many tasks. After a restart the reader goes on from the
checkpoint's offset log.

Lag is the end of the log less what the query has committed, for each partition.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.dataset as arrow_dataset
from pyarrow import fs as files
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from tidemark.operators.ordering import ordered_prefix
from tidemark.session import cut

FORMAT = "event_log"
FIELDS = "partition int, offset long, value string"


def key_partition(key: Column, partitions: int) -> Column:
    """The partition of a key: the first 32 bits of its digest, so that any producer finds the same one."""
    return (F.conv(F.substring(F.md5(key.cast("binary")), 1, 8), 16, 10).cast("long") % partitions).cast("int")


def _table(path: str) -> list[dict]:
    """The rows of a small Parquet folder; none if there is no such folder."""
    store, place = files.FileSystem.from_uri(path)
    if store.get_file_info(place).type != files.FileType.Directory:
        return []
    return arrow_dataset.dataset(place, filesystem=store, format="parquet", partitioning="hive").to_table().to_pylist()


def folders(root: str) -> list[dict]:
    """(batch, partition, first, end) of every finished append: one row a partition and append."""
    return _table(f"{root}/folders")


def ends(root: str, partitions: int) -> dict[str, int]:
    out = {str(p): 0 for p in range(partitions)}
    for row in folders(root):
        out[str(row["partition"])] = max(out[str(row["partition"])], row["end"])
    return out


class EventLog:
    """Writes the log below ``root``; one writer at a time."""

    def __init__(self, spark: SparkSession, root: str, partitions: int = 3) -> None:
        self.spark, self.root, self.partitions = spark, root.rstrip("/"), partitions

    def append(self, messages: DataFrame, key: str, order: Sequence[Column]) -> None:
        """Add (key, value, ...) messages. ``order`` is unique within a partition, so that a rerun numbers alike."""
        known = folders(self.root)
        batch, before = max((r["batch"] for r in known), default=-1) + 1, ends(self.root, self.partitions)
        start = F.lit(0)
        for p, end in before.items():  # one branch a partition of the log
            start = F.when(F.col("partition") == int(p), end).otherwise(start)
        rows = messages.withColumn("partition", key_partition(F.col(key), self.partitions))
        rows = ordered_prefix(rows, order, ["partition"]).select("partition", (F.col("row_number") - 1 + start).cast("long").alias("offset"), "value")
        rows = cut(rows)
        (rows.repartitionByRange("partition", "offset").sortWithinPartitions("partition", "offset")
         .write.mode("overwrite").partitionBy("partition").parquet(f"{self.root}/data/batch={batch}"))
        held = rows.groupBy("partition").agg(F.min("offset").alias("first"), (F.max("offset") + 1).alias("end"))
        held.coalesce(1).write.mode("overwrite").parquet(f"{self.root}/folders/batch={batch}")

    def stream(self, checkpoint: str, limit: int, rows_per_task: int = 100_000) -> DataFrame:
        self.spark.dataSource.register(EventLogSource)
        return (self.spark.readStream.format(FORMAT).option("path", self.root).option("partitions", self.partitions)
                .option("maxRowsPerBatch", limit).option("rowsPerTask", rows_per_task).option("checkpointLocation", checkpoint).load())


class Slice(InputPartition):
    def __init__(self, partition: int, first: int, end: int, batches: list[int]) -> None:
        self.partition, self.first, self.end, self.batches = partition, first, end, batches


class EventLogSource(DataSource):
    """``format("event_log")`` with path, partitions, maxRowsPerBatch, rowsPerTask and checkpointLocation."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return FIELDS

    def streamReader(self, schema) -> EventLogReader:
        return EventLogReader(self.options)


class EventLogReader(DataSourceStreamReader):
    def __init__(self, options) -> None:
        self.root, self.count = options["path"].rstrip("/"), int(options.get("partitions", 3))
        self.limit, self.task_rows = int(options.get("maxRowsPerBatch", 1_000_000)), int(options.get("rowsPerTask", 100_000))
        self.checkpoint, self.at = options.get("checkpointLocation"), None

    def initialOffset(self) -> dict:
        return {str(p): 0 for p in range(self.count)}

    def latestOffset(self) -> dict:
        if self.at is None:
            self.at = (planned(self.checkpoint) if self.checkpoint else None) or self.initialOffset()
        return admitted(self.at, ends(self.root, self.count), self.limit)

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        self.at, out, known = end, [], folders(self.root)
        for p in start:
            for first in range(start[p], end[p], self.task_rows):
                last = min(end[p], first + self.task_rows)
                held = [r["batch"] for r in known if str(r["partition"]) == p and r["first"] < last and r["end"] > first]
                out.append(Slice(int(p), first, last, sorted(held)))
        return out

    def read(self, part: Slice) -> Iterator[pa.RecordBatch]:
        for batch in part.batches:
            store, place = files.FileSystem.from_uri(f"{self.root}/data/batch={batch}/partition={part.partition}")
            inside = (pc.field("offset") >= part.first) & (pc.field("offset") < part.end)  # skips row groups
            for rows in arrow_dataset.dataset(place, filesystem=store, format="parquet").to_batches(columns=["offset", "value"], filter=inside, batch_size=10_000):
                if rows.num_rows:
                    number = pa.array([part.partition] * rows.num_rows, pa.int32())
                    yield pa.RecordBatch.from_arrays([number, rows.column("offset"), rows.column("value")], names=["partition", "offset", "value"])

    def commit(self, end: dict) -> None:
        """Nothing to do: the checkpoint keeps what is committed."""


def admitted(at: dict[str, int], end: dict[str, int], limit: int) -> dict[str, int]:
    """The next offsets: at most ``limit`` messages, by what waits in each partition; at least one goes on."""
    waiting = {p: max(0, end[p] - at[p]) for p in at}
    total = sum(waiting.values())
    if total <= limit:
        return {p: at[p] + waiting[p] for p in at}
    share = {p: limit * waiting[p] // total for p in at}
    for p in sorted(at, key=lambda p: -waiting[p]):  # what rounding left
        share[p] += min(waiting[p] - share[p], limit - sum(share.values()))
    return {p: at[p] + share[p] for p in at}


def _offsets(checkpoint: str, batch: int) -> dict[str, int] | None:
    """The log's offsets of one planned batch, from the checkpoint's offset log (one line a source)."""
    store, place = files.FileSystem.from_uri(checkpoint)
    with store.open_input_stream(f"{place}/offsets/{batch}") as source:
        lines = source.read().decode().splitlines()
    for line in lines[2:]:
        found = json.loads(line) if line.startswith("{") else None
        if isinstance(found, dict) and found and all(k.isdigit() for k in found):
            return {k: int(v) for k, v in found.items()}
    return None


def _newest(checkpoint: str, folder: str) -> int | None:
    store, place = files.FileSystem.from_uri(checkpoint)
    found = store.get_file_info(files.FileSelector(f"{place}/{folder}", allow_not_found=True))
    return max((int(f.base_name) for f in found if f.base_name.isdigit()), default=None)


def planned(checkpoint: str) -> dict[str, int] | None:
    batch = _newest(checkpoint, "offsets")
    return None if batch is None else _offsets(checkpoint, batch)


def lag(spark: SparkSession, root: str, checkpoint: str, partitions: int = 3) -> DataFrame:
    """(partition, end_offset, committed_offset, lag) as they are now: one row a partition."""
    batch = _newest(checkpoint, "commits")
    done = (None if batch is None else _offsets(checkpoint, batch)) or {}
    rows = [(int(p), e, done.get(p, 0), e - done.get(p, 0)) for p, e in ends(root, partitions).items()]
    return spark.createDataFrame(rows, "partition int, end_offset long, committed_offset long, lag long")


def drain_to(good: str, rejects: str, parsed: Callable[[DataFrame], DataFrame], bad: Column) -> Callable[[DataFrame, int], None]:
    """A batch writer: rows that parse and, beside them, those that don't, with their place in the log.

    Each batch writes folders of its own, so a batch that comes again replaces them.
    """
    def write(batch: DataFrame, number: int) -> None:
        rows = parsed(batch).persist()
        try:
            rows.where(bad).select("partition", "offset", "value").write.mode("overwrite").parquet(f"{rejects}/batch={number}")
            rows.where(~bad).drop("value").write.mode("overwrite").parquet(f"{good}/batch={number}")
        finally:
            rows.unpersist()
    return write
