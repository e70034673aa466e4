"""Partitioned Parquet tables: overwrite by partition, keyed upsert, range scan.

Partitions are derived columns, so the table keeps its column contract.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tidemark.operators.ordering import first_per
from tidemark.session import cut, scratch_path

HOUR_PARTITION, DAY_PARTITION = "captured_hour", "captured_day"


class DuplicateKeys(ValueError):
    pass


class EmptyScan(ValueError):
    pass


def create_snapshot_table(spark: SparkSession, name: str, using: str = "parquet", by: str = HOUR_PARTITION) -> None:
    """Typed snapshot table; ``using`` may be a format with hidden hour partitions.

    ``by`` is ``HOUR_PARTITION``, or ``DAY_PARTITION`` where an hour of a region holds too little for a file.
    """
    columns = """video_id string, region string, captured_at timestamp, title string,
        description string, tags string, channel_id string, channel_title string,
        category_id string, published_at timestamp, views bigint, likes bigint,
        comment_count bigint, like_ratio double, engagement_rate double,
        thumbnail_url string, ingestion_id string, ingested_at timestamp"""
    if using == "iceberg":
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING iceberg "
                  "PARTITIONED BY (region, hours(captured_at))")
    else:
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}, {by} string) USING {using} PARTITIONED BY (region, {by})")


def snapshot_schema(spark: SparkSession, name: str) -> str:
    """A catalogue schema of its own whose tables lie in the shared folder."""
    schema = f"{name}_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {schema} LOCATION '{scratch_path(spark, schema)}'")
    return schema


def overwrite_snapshot_table(df: DataFrame, name: str) -> None:
    """Replace the partitions that ``df`` holds in a table of ``create_snapshot_table``."""
    columns = df.sparkSession.table(name).columns
    rows = with_hour(df).withColumn(DAY_PARTITION, F.date_format("captured_at", "yyyyMMdd")).select(*columns)
    (rows.hint("rebalance", F.col("region"), F.col(columns[-1])).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").insertInto(name))


def with_hour(df: DataFrame) -> DataFrame:
    return df.withColumn(HOUR_PARTITION, F.date_format("captured_at", "yyyyMMddHH"))


def overwrite_partitions(df: DataFrame, path: str, partitions: Sequence[str]) -> None:
    """Replace the partitions present in ``df``; leave every other partition as it is.

    Rows are clustered by partition value first, so each partition gets few files; AQE
    splits a hot partition into several writers.
    """
    (df.hint("rebalance", *[F.col(p) for p in partitions])
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partitions).parquet(path))


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read.option("basePath", path)
    return (reader.schema(schema) if schema else reader).parquet(path)


def range_scan(df: DataFrame, start: Column, end: Column, columns: Sequence[str],
               strict: bool = False) -> DataFrame:
    """Rows with ``start <= captured_at <= end``; pruned by hour folders where there are any."""
    if HOUR_PARTITION in df.columns:
        df = df.where(F.col(HOUR_PARTITION).between(
            F.date_format(start, "yyyyMMddHH"), F.date_format(end, "yyyyMMddHH")))
    out = df.where(F.col("captured_at").between(start, end)).select(*columns)
    if strict and out.isEmpty():
        raise EmptyScan("no rows in the asked range")
    return out


def refuse_duplicates(batch: DataFrame, keys: Sequence[str]) -> None:
    if not batch.groupBy(*keys).count().where("count > 1").isEmpty():
        raise DuplicateKeys(f"batch has more than one row for a key of {list(keys)}")


def merge_into(target: str, batch: DataFrame, keys: Sequence[str]) -> None:
    """The same upsert as one statement, for table formats that support it."""
    (batch.alias("batch").mergeInto(target, F.expr(" and ".join(f"{target}.{k} = batch.{k}" for k in keys)))
     .whenMatched().updateAll().whenNotMatched().insertAll().merge())


def upsert(base: DataFrame, batch: DataFrame, keys: Sequence[str], check_keys: bool = True) -> DataFrame:
    """``batch`` rows replace ``base`` rows with equal keys; all others stay.

    A batch with two rows for one key is refused, as a keyed upsert statement refuses it.
    """
    if check_keys:
        refuse_duplicates(batch, keys)
    batch = batch.select(*base.columns)
    return base.join(batch.select(*keys), list(keys), "left_anti").select(*base.columns).unionByName(batch)


class PartitionedTable:
    """A partitioned folder with keyed merges that read and rewrite only the partitions a batch touches.

    Partition columns are never null.
    """

    def __init__(self, spark: SparkSession, root: str, partitions: Mapping[str, Column]) -> None:
        self.spark, self.root, self.partitions = spark, root.rstrip("/"), dict(partitions)
        jvm = spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.root)
        self._path, self._fs = path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def exists(self) -> bool:
        return self._fs.exists(self._path)

    def read(self) -> DataFrame:
        kept = self.spark.read.schema(self._schema()).parquet(self.root)
        return kept.drop(*[p for p in self.partitions if p.startswith("_")])

    @staticmethod
    def _newest(rows: DataFrame, keys: Sequence[str], newest_by: str) -> DataFrame:
        others = [F.col(c).desc_nulls_last() for c in rows.columns if c not in (newest_by, *keys)]
        return first_per(rows, keys, [F.col(newest_by).desc(), *others])

    def _schema(self) -> T.StructType:
        found = self.spark.read.parquet(self.root).schema
        return T.StructType([T.StructField(f.name, T.StringType()) if f.name in self.partitions else f for f in found])

    def merge(self, batch: DataFrame, keys: Sequence[str], newest_by: str | None = None) -> None:
        """Replace rows with equal keys, add the others. The key must fix the partition.

        With ``newest_by`` the row with the largest value there stays, stored or new, so a batch that comes
        again or late changes nothing; a batch may then hold a key more than once.

        The batch is evaluated once; the values of its partitions, one row each, prune the stored table
        before any file is listed. The merged partitions are cut off from the table before they replace
        it, so a lost executor cannot read half-written data.
        """
        batch = cut(batch.withColumns({n: c for n, c in self.partitions.items() if n not in batch.columns}))
        if self.exists():
            touched = batch.select(*self.partitions).distinct().collect()
            stored = self.spark.read.schema(self._schema()).parquet(self.root)
            for name in self.partitions:
                stored = stored.where(F.col(name).isin(sorted({r[name] for r in touched})))
            if len(self.partitions) > 1:
                pairs = F.array(*[F.struct(*[F.lit(r[n]).alias(n) for n in self.partitions]) for r in touched])
                stored = stored.where(F.array_contains(pairs, F.struct(*self.partitions)))
            batch = cut(self._newest(stored.unionByName(batch.select(*stored.columns)), keys, newest_by) if newest_by else upsert(stored, batch, keys))
        elif newest_by:
            batch = self._newest(batch, keys, newest_by)
        else:
            refuse_duplicates(batch, keys)
        overwrite_partitions(batch, self.root, list(self.partitions))


def keyed_table(spark: SparkSession, name: str, key: str, buckets: int = 16) -> PartitionedTable:
    """Rows by the hash of their key: a batch rewrites the buckets of its keys. Choose ``buckets`` for the table to come."""
    return PartitionedTable(spark, scratch_path(spark, name), {"_bucket": F.pmod(F.xxhash64(key), F.lit(buckets)).cast("string")})


def snapshot_table(spark: SparkSession, name: str) -> PartitionedTable:
    """Snapshots by region and hour, the layout of the typed table."""
    return PartitionedTable(spark, scratch_path(spark, name), {
        "region": F.col("region"), "_hour": F.date_format("captured_at", "yyyyMMddHH")})


def daily_snapshot_table(spark: SparkSession, name: str) -> PartitionedTable:
    """The same by day, where an hour holds too little for a file of its own."""
    return PartitionedTable(spark, scratch_path(spark, name), {"_day": F.date_format("captured_at", "yyyyMMdd")})
