"""Keyed tables that are written and read by buckets of their key.

A table is a folder of Parquet files, one subfolder for every bucket of the key's hash.  An upsert or a
deletion rewrites only the buckets that its rows fall into, so what it writes follows the change and not the table; a
lookup reads one bucket.  One writer at a time."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hushwire.operators import state
from hushwire.sources import io


@dataclass(frozen=True)
class Store:
    """place: the folder; schema: DDL of the rows; keys: what a row is replaced by; order: which of several new
    rows is the last; near: the part of the key that is hashed, so that its rows share a bucket."""

    place: str
    schema: str
    keys: tuple[str, ...]
    order: tuple[str, ...]
    near: tuple[str, ...]
    buckets: int = 64

    def bucket(self, *values: Column) -> Column:
        return F.pmod(F.xxhash64(*values), F.lit(self.buckets)).cast("int")

    def _path(self, spark: SparkSession, name: str = ""):
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{self.place}/{name}" if name else self.place)
        return path.getFileSystem(spark._jsc.hadoopConfiguration()), path

    def read(self, spark: SparkSession) -> DataFrame:
        """All rows, with their bucket; an empty table where there is none yet."""
        fs, path = self._path(spark)
        if not fs.exists(path):
            return spark.createDataFrame([], f"{self.schema}, bucket int")
        return spark.read.schema(f"{self.schema}, bucket int").parquet(self.place)

    def lookup(self, spark: SparkSession, **key) -> DataFrame:
        """Rows of one value of `near` (any other columns named narrow them): one bucket is read."""
        kinds = {f.name: f.dataType for f in self.read(spark).schema}
        rows = self.read(spark).where(F.col("bucket") == self.bucket(*(F.lit(key[c]).cast(kinds[c]) for c in self.near)))
        for c, v in key.items():
            rows = rows.where(F.col(c) == F.lit(v))
        return rows.drop("bucket")

    def upsert(self, new: DataFrame) -> list[int]:
        """Write new rows in place of those with their keys; the buckets that were rewritten."""
        spark = new.sparkSession
        named = self.read(spark).drop("bucket").columns
        dealt = new.select(*named).withColumn("bucket", self.bucket(*self.near))
        return self._rewrite(spark, dealt, lambda old, fresh: state.upsert(old, fresh, list(self.keys), list(self.order)))

    def delete(self, gone: DataFrame) -> list[int]:
        """Delete all rows whose `near` is among gone's; the buckets that were rewritten."""
        spark = gone.sparkSession
        dealt = gone.select(*self.near).distinct().withColumn("bucket", self.bucket(*self.near))
        return self._rewrite(spark, dealt, lambda old, these: old.join(these.select(*self.near), list(self.near), "left_anti"))

    def _rewrite(self, spark: SparkSession, change: DataFrame, combine) -> list[int]:
        made = io.Scratch(spark)
        try:
            change = made.keep(change)
            # a table has few buckets, whatever its rows
            touched = sorted(r[0] for r in change.select("bucket").distinct().collect())
            if not touched:
                return []
            rows = combine(self.read(spark).where(F.col("bucket").isin(touched)), change)
            # cut, as the buckets that are read are those that are written
            rows = made.keep(rows.repartition("bucket"))
            rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(self.place)
            left = {r[0] for r in rows.select("bucket").distinct().collect()}
            for b in set(touched) - left:  # a bucket without rows is not overwritten
                fs, path = self._path(spark, f"bucket={b}")
                fs.delete(path, True)
            return touched
        finally:
            made.clear()


def result_store(place: str, buckets: int = 64) -> Store:
    """Recognisers' results, one for each file, engine and channel."""
    return Store(place, state.RESULT_SCHEMA, tuple(state.CACHE_KEYS), ("updated_at",), ("input_path",), buckets)


def status_store(place: str, buckets: int = 64) -> Store:
    """The last status of every file."""
    return Store(place, state.STATUS_SCHEMA, ("input_path",), ("updated_at",), ("input_path",), buckets)
