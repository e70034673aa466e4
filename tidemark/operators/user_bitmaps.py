"""Distinct users that add up: a stored bitmap of users for each day, event and bucket of user numbers.

Users get dense numbers once and keep them; a bitmap covers 32,768 numbers. A day's bitmaps are one partition, so a
new day writes that partition and the rows of users never seen before. Distinct users of any range, rolling or not, are
the union of its days' bitmaps, counted; nothing of the events is read again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tidemark.operators.ordering import ordered_prefix
from tidemark.session import cut, scratch_path
from tidemark.sources.store import overwrite_partitions


class UserBitmaps:
    """Bitmaps below ``root``; one writer at a time. A batch holds whole days: a day that comes again is replaced."""

    def __init__(self, spark: SparkSession, root: str | None = None) -> None:
        self.spark, self.root, self.batches = spark, (root or scratch_path(spark, "user-bitmaps")).rstrip("/"), 0

    def users(self) -> DataFrame:
        return self.spark.read.schema("user string, number long").parquet(f"{self.root}/users")

    def days(self) -> DataFrame:
        """(day, event, bucket, users): one bitmap a row."""
        return self.spark.read.schema("event string, bucket long, users binary, day string").parquet(f"{self.root}/days")

    def add(self, events: DataFrame) -> None:
        """``events``: (user, day, event); rows without a user or day are left out."""
        rows = events.where("user is not null and day is not null").select("user", F.date_format("day", "yyyy-MM-dd").alias("day"), "event").distinct()
        rows = cut(rows)
        new, last = rows.select("user").distinct(), 0
        if self.batches:
            known = self.users()
            last = known.agg(F.max("number")).first()[0] or 0
            new = new.join(known, "user", "left_anti")
        numbered = ordered_prefix(new, [F.col("user").asc()]).select("user", (F.col("row_number") + last).cast("long").alias("number"))
        numbered.write.mode("append").parquet(f"{self.root}/users")
        self.batches += 1
        placed = rows.join(self.users(), "user").select("day", "event", F.bitmap_bucket_number("number").alias("bucket"), F.bitmap_bit_position("number").alias("at"))
        made = placed.groupBy("day", "event", "bucket").agg(F.bitmap_construct_agg("at").alias("users"))
        overwrite_partitions(made.select("event", "bucket", "users", "day"), f"{self.root}/days", ["day"])

    @staticmethod
    def counted(bitmaps: DataFrame, by: Sequence[str]) -> DataFrame:
        """Distinct users of each group of bitmap rows: (by..., users_count)."""
        united = bitmaps.groupBy(*by, "bucket").agg(F.bitmap_or_agg("users").alias("users"))
        return united.groupBy(*by).agg(F.sum(F.bitmap_count("users")).alias("users_count"))

    def rolling(self, span: int, by: Sequence[str] = ("event",)) -> DataFrame:
        """(day, by..., users_count): distinct users of the ``span`` days that end with each stored day."""
        rows, have = self.days(), self.days().select("day").distinct()
        ends = F.sequence(F.col("day").cast("date"), F.date_add(F.col("day").cast("date"), span - 1))
        spread = rows.withColumn("day", F.explode(ends)).withColumn("day", F.date_format("day", "yyyy-MM-dd"))
        return self.counted(spread.join(have, "day", "left_semi"), ["day", *by])

    def all_of(self, steps: Sequence[str], within: Column | None = None) -> DataFrame:
        """(step_order, step, users_count): users that have this event and all before it, over the days asked for."""
        rows = self.days() if within is None else self.days().where(within)
        mine = rows.where(F.col("event").isin(*steps)).groupBy("event", "bucket").agg(F.bitmap_or_agg("users").alias("users"))
        order = F.array_position(F.array(*[F.lit(s) for s in steps]), F.col("event")).cast("int")
        spread = mine.withColumn("step_order", F.explode(F.sequence(order, F.lit(len(steps)))))
        both = spread.groupBy("step_order", "bucket").agg(F.bitmap_and_agg("users").alias("users"), F.count(F.lit(1)).alias("n"))
        reached = both.where(F.col("n") == F.col("step_order")).groupBy("step_order").agg(F.sum(F.bitmap_count("users")).alias("users_count"))
        names = self.spark.createDataFrame([(i, s) for i, s in enumerate(steps, 1)], "step_order int, step string")
        return names.join(reached, "step_order", "left").select("step_order", "step", F.coalesce("users_count", F.lit(0)).alias("users_count"))

    def retention(self) -> DataFrame:
        """(cohort_week, week_offset, users_count) as of first activity.

        A cohort is the union of all weeks up to its own less that up to the week before; so its overlap with a
        later week is the difference of two overlaps, and only unions and overlaps are taken.
        """
        week = F.date_trunc("week", F.col("day").cast("date")).cast("date")
        weeks = cut(self.days().groupBy(week.alias("week"), "bucket").agg(F.bitmap_or_agg("users").alias("users")))
        known = F.array(*[F.lit(r["week"]) for r in weeks.select("week").distinct().orderBy("week").collect()] or [F.lit(None).cast("date")])  # a calendar's weeks
        later, earlier = F.filter(known, lambda w: w >= F.col("week")), F.filter(known, lambda w: w <= F.col("week"))
        upto = weeks.withColumn("cohort", F.explode(later)).groupBy("cohort", "bucket").agg(F.bitmap_or_agg("users").alias("users"))
        upto = upto.withColumn("week", F.explode(F.filter(known, lambda w: w >= F.col("cohort")))).select("cohort", "week", "bucket", "users")
        here = weeks.withColumn("cohort", F.explode(earlier)).select("cohort", "week", "bucket", "users")
        both = upto.unionByName(here).groupBy("cohort", "week", "bucket").agg(F.bitmap_and_agg("users").alias("users"), F.count(F.lit(1)).alias("n"))
        overlap = both.where("n = 2").groupBy("cohort", "week").agg(F.sum(F.bitmap_count("users")).alias("seen"))
        before = F.lag("seen", 1, 0).over(Window.partitionBy("week").orderBy("cohort"))  # a calendar's weeks
        return overlap.select(F.col("cohort").alias("cohort_week"), F.expr("datediff(week, cohort) div 7").alias("week_offset"),
                              (F.col("seen") - before).alias("users_count")).where("users_count > 0")
