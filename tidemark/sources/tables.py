"""The given Parquet tables, read once each with only timestamps adjusted."""

from __future__ import annotations


from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

class Tables:
    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = spark
        self.folder = folder.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}.parquet"

    def within(self, name: str, column: str, low: str, high: str) -> Tables:
        """The same tables, but of ``name`` only rows with ``low <= column < high``, filtered as stored.

        Later steps cast or truncate the column, which keeps their filters from reaching the scan.
        """
        other, stored = Tables(self.spark, self.folder), self.spark.read.parquet(self.path(name))
        bound = lambda text: F.lit(text).cast(stored.schema[column].dataType)
        other.__dict__[name] = self._typed(stored.where((F.col(column) >= bound(low)) & (F.col(column) < bound(high))))
        return other

    def _read(self, name: str) -> DataFrame:
        return self._typed(self.spark.read.parquet(self.path(name)))

    @staticmethod
    def _typed(df: DataFrame) -> DataFrame:
        zoned = [f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampNTZType)]
        return df.withColumns({c: F.col(c).cast("timestamp") for c in zoned}) if zoned else df

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        df = self._read(name)
        self.__dict__[name] = df
        return df
