"""The corpus pipeline: each stage reads what its predecessor kept and returns documents.

Rows without doc_id can't be told apart by the stages that decide by id: they stay as they are, once each.
Rows that repeat a doc_id are one document and share its fate. Empty tables pass through.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm.bpe import encode_decode
from tidemark.llm.common import written
from tidemark.llm.line_dedup import without_repeats
from tidemark.llm.mixing import mix
from tidemark.llm.near_dedup import near_duplicates
from tidemark.llm.quality_rules import judge


def _without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose id is not among those of ``gone``."""
    ids = gone.where("doc_id is not null").select(F.col("doc_id").alias("_gone")).distinct()
    return docs.join(ids, docs["doc_id"] == ids["_gone"], "left_anti")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base or are likely bad go."""
    return _without(docs, judge(docs).where("not kept"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every class of near-duplicate lines only the first stays in its text; every document stays."""
    return without_repeats(docs, fold_case=True)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group (5-word shingles, 0.8) stays: the one with the smallest id."""
    return _without(docs, near_duplicates(docs).where("not kept"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix of its source takes it: not at all, once or twice."""
    copies = mix(docs).where("doc_id is not null").groupBy(F.col("doc_id").alias("_id")).agg(F.max("copies").alias("_copies"))
    taken = docs.join(copies, docs["doc_id"] == copies["_id"], "left").withColumn("_copies", F.coalesce("_copies", F.lit(1)))
    repeated = taken.where("_copies > 0").withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies").cast("long"))))
    return repeated.select(*[docs[c] for c in docs.columns])


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, with their number and the text they decode to."""
    coded = encode_decode(docs, public_tokenizers.path("word_bpe_49k.json"))
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", "decoded")


STAGES = [("quality_rules", quality_rules), ("line_dedup", line_dedup), ("near_dedup", near_dedup), ("mixing", mixing), ("bpe", bpe)]

# Estimated accuracies, Newton steps and merges are beyond SQL: tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order over documents, each written before the next reads it."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
