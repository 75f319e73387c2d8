"""Run state: keyed upserts, completeness and what is left to do."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

STATUS_SCHEMA = (
    "input_path string, output_path string, sidecar_path string, status string, error string, duration_sec double, elapsed_sec double, num_words long, "
    "num_entities long, num_spans long, valid boolean, started_at double, updated_at double"
)
RESULT_SCHEMA = "input_path string, engine string, channel int, transcript string, words array<struct<word:string,start:double,end:double>>, language string, error string, updated_at double"
CACHE_KEYS = ["input_path", "engine", "channel"]


def create_if_absent(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The table at path; an empty one of this schema is written where there is none."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place):
        spark.createDataFrame([], schema).write.parquet(path)
    return spark.read.schema(schema).parquet(path)


def upsert_asr_cache(old: DataFrame, new: DataFrame) -> DataFrame:
    """Cached recogniser results, one for each file, engine and channel: the last one written."""
    return upsert(old, new, CACHE_KEYS, ["updated_at"])


def cached_results(cache: DataFrame, engines: list[str], path: str | None = None) -> DataFrame:
    """Cached rows, of one file if named, in order of file, channel and the engines as listed; other engines
    come last, by name."""
    rank = F.array_position(F.array(*map(F.lit, engines)), F.col("engine"))
    rows = cache.where(F.col("input_path") == path) if path is not None else cache
    return rows.withColumn("_k", F.when(rank == 0, len(engines) + 1).otherwise(rank)).orderBy("input_path", "channel", "_k", "engine").drop("_k")


def without_files(cache: DataFrame, gone: DataFrame) -> DataFrame:
    """The cache without the rows of finished files."""
    return cache.join(gone.select("input_path").distinct(), "input_path", "left_anti")


def upsert(old: DataFrame, new: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Last writer wins by key; rows of `new` beat those of `old`, later ones (by order) earlier ones."""
    both = old.withColumn("_g", F.lit(0)).unionByName(new.withColumn("_g", F.lit(1)), allowMissingColumns=True)
    last = Window.partitionBy(*keys).orderBy(F.desc("_g"), *(F.desc(c) for c in order))
    return both.withColumn("_n", F.row_number().over(last)).where("_n = 1").drop("_n", "_g")


def complete_files(results: DataFrame, engines: list[str], channels: int, with_errors: bool = True) -> DataFrame:
    """Files that have a result for every engine and channel (relational division by counting)."""
    r = results.where(F.col("engine").isin(engines) & (F.col("channel") < channels))
    r = r if with_errors else r.where("error IS NULL")
    return r.groupBy("file_id").agg(F.count_distinct("engine", "channel").alias("n")).where(F.col("n") == len(engines) * channels).select("file_id")


def missing_work(files: DataFrame, engines: DataFrame, results: DataFrame) -> DataFrame:
    """Expected (file, engine, channel) without a result free of errors.  Engines are a short list."""
    grid = files.select("file_id", F.explode("channel_list").alias("channel")).join(F.broadcast(engines))
    return grid.join(results.where("error IS NULL").select("file_id", "engine", "channel"), ["file_id", "engine", "channel"], "left_anti")


def pending(files: DataFrame, status: DataFrame) -> DataFrame:
    """Files without a successful, valid result."""
    done = status.where(F.col("status").startswith("success") & F.col("valid")).select("file_id")
    return files.join(done, "file_id", "left_anti")
