"""Helpers the operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.session import scratch_path, shared_folder

GOLDEN = np.uint64(0x9E3779B97F4A7C15)
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def released(spark: SparkSession):
    """While it holds, shuffle files go with the write or checkpoint that made them, not with a later collection of
    garbage: loops of many small steps don't fill the executors' disks. What needs them again makes them again.
    """
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder, read back: cuts lineage, keeps column pruning."""
    path = scratch_path(df.sparkSession, f"llm-{name}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cut(df: DataFrame) -> DataFrame:
    """A reliable checkpoint in the shared folder; Spark's cleaner removes it with the last reference."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def only(df: DataFrame, *names: str) -> DataFrame:
    """The columns an operator reads, so that extra ones can't clash with its own."""
    return df.select(*[F.col(f"`{n}`") for n in names])


def fold(id_col: str | Column, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; null ids have none."""
    return F.crc32((F.col(id_col) if isinstance(id_col, str) else id_col).cast("string").cast("binary")) % parts


def word_count(text: Column) -> Column:
    """Words between spaces and the five control characters; null counts 0."""
    return F.coalesce(F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("long")


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words whose every output bit depends on every input bit."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def utf8(text: str) -> bytes:
    return text.encode("utf-8", "surrogatepass")


def small_batches(batches: Iterator, rows: int = 2000) -> Iterator:
    """The same rows in frames of at most ``rows``."""
    for frame in batches:
        for at in range(0, len(frame), rows):
            yield frame.iloc[at:at + rows]


def components(edges: DataFrame) -> DataFrame:
    """(id, component) for every end of ``edges`` (a, b): the smallest id that can be reached.

    Union-find as alternating stars: each round hangs every node under the smallest id it has seen, first
    its larger, then its smaller neighbours. A hub's rows are pre-aggregated and its join can be split, so
    no node's neighbours are gathered. Rounds end when the links stay as they are.
    """
    def link(u: Column, v: Column) -> list[Column]:
        return [u.alias("u"), v.alias("v")]

    def mark(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.min("u"), F.max("v")).first())

    a, b = F.col("a"), F.col("b")
    e = cut(edges.where(a != b).select(*link(F.greatest(a, b), F.least(a, b))).distinct())
    seen = mark(e)
    while seen[0]:
        both = e.unionByName(e.select(*link(F.col("v"), F.col("u"))))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        e = both.join(low, "u").where("v > u").select(*link(F.col("v"), F.col("m")))
        low = e.groupBy("u").agg(F.min("v").alias("m"))
        e = e.join(low, "u").select("u", "v", "m")
        e = cut(e.where("v > m").select(*link(F.col("v"), F.col("m"))).unionByName(e.select(*link(F.col("u"), F.col("m")))).distinct())
        now = mark(e)
        if now == seen:
            break
        seen = now
    roots = e.select("v").distinct().select(F.col("v").alias("id"), F.col("v").alias("component"))
    return e.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(roots)
