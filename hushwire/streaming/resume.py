"""Micro-batches of call rows with exactly-once status in an append-only log."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

LOG = "file_id long, status string, valid boolean, updated_at long, batch int"


def _exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def status_log(spark: SparkSession, state: str, before: int | None = None) -> DataFrame:
    """All rows of the log, or those of earlier batches than `before`."""
    if not _exists(spark, f"{state}/log"):
        return spark.createDataFrame([], LOG)
    rows = spark.read.schema(LOG).parquet(f"{state}/log")
    return rows if before is None else rows.where(F.col("batch") < before)


def current(spark: SparkSession, state: str) -> DataFrame:
    """The last status of every file: by batch, then by time.  Skipped files keep the status that they have."""
    last = Window.partitionBy("file_id").orderBy(F.desc("batch"), F.desc("updated_at"))
    rows = status_log(spark, state).where("status <> 'skipped_existing'")
    return rows.withColumn("_n", F.row_number().over(last)).where("_n = 1").drop("_n")


def statuses(done: DataFrame, batch: DataFrame, process: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Status rows of one batch: files in `done` are skipped, the others are processed."""
    finished = done.where(F.col("status").startswith("success") & F.coalesce("valid", F.lit(True))).select("file_id").distinct()
    now = F.unix_micros(F.current_timestamp())
    skipped = batch.join(finished, "file_id", "left_semi").select("file_id", F.lit("skipped_existing").alias("status"), F.lit(True).alias("valid"), now.alias("updated_at"))
    rows = process(batch.join(finished, "file_id", "left_anti"))
    rows = rows if "valid" in rows.columns else rows.withColumn("valid", F.lit(True))
    return rows.select("file_id", "status", "valid", F.col("updated_at").cast("long").alias("updated_at")).unionByName(skipped)


def resume(spark: SparkSession, source: str, schema: str, state: str, process: Callable[[DataFrame], DataFrame], files_per_batch: int = 100) -> StreamingQuery:
    """Read the JSON call rows that came since the last run, process those without a valid success, and
    append the batch's status rows to the log (state/log/batch=N): a batch tried again writes the same
    folder, and what is written grows with the batch and not with the table."""
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).json(source)

    def step(batch: DataFrame, number: int) -> None:
        statuses(status_log(batch.sparkSession, state, number), batch, process).write.mode("overwrite").parquet(f"{state}/log/batch={number}")

    return stream.writeStream.foreachBatch(step).option("checkpointLocation", f"{state}/checkpoint").trigger(availableNow=True).start()


def folded(spark: SparkSession, place: str, number: int) -> None:
    """Take batch `number` of the log into the states, as the batch of that number of their stream: the last
    status of every file, one row a file, in the stream's state store (place/checkpoint)."""
    kept = ", ".join(LOG.split(", ")[:-1])
    # a pattern that one folder meets: a plain path would be the base of earlier batches' files, too
    rows = spark.readStream.schema(kept).parquet(f"{place}/log/batch={{{number}}}").where("NOT status <=> 'skipped_existing'")
    last = rows.groupBy("file_id").agg(F.max(F.struct(F.lit(number).alias("batch"), "updated_at", "status", "valid")).alias("last"))
    last.writeStream.outputMode("update").format("noop").option("checkpointLocation", f"{place}/checkpoint").trigger(availableNow=True).start().awaitTermination()


def states(spark: SparkSession, place: str, number: int) -> DataFrame:
    """Status, validity and time of every file as they were after batch `number`, from the state store."""
    kept = spark.read.format("statestore").option("batchId", number).load(f"{place}/checkpoint")
    return kept.select("key.file_id", F.col("value.max").alias("last")).select("file_id", "last.status", "last.valid", "last.updated_at")


def handled(calls: DataFrame, known: DataFrame, handle: Callable[[dict], tuple[str, bool]]) -> DataFrame:
    """Status rows of one batch of calls: the calls of a file meet in one task, one after another, beside the
    file's state before the batch."""
    before = known.select(F.col("file_id").alias("_file"), F.struct("status", "valid", "updated_at").alias("_before"))
    told = calls.select("file_id", F.struct("*").alias("_call")).join(before, F.col("file_id").eqNullSafe(F.col("_file")), "left")

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, settled, at = (), False, 0  # no file yet
        for batch in batches:
            statuses, valids, times = (x.to_pylist() for x in batch.column("_before").flatten())
            done = [_settled(s, v) for s, v in zip(statuses, valids, strict=True)]
            # rows of files that were settled before are not made
            asked = (call.as_py() for call in batch.column("_call").filter(pa.array([not d for d in done], pa.bool_())))
            out = ([], [], [])
            for file, was, known_at in zip(batch.column("file_id").to_pylist(), done, times, strict=True):
                if last != (file,):
                    last, settled, at = (file,), was, known_at or 0
                now = max(time.time_ns() // 1000, at + 1)
                row = None if was else next(asked)
                status, valid = "skipped_existing", True
                if not settled:
                    try:
                        status, valid = handle(row)
                    except Exception:  # any failure of a call is that call's row
                        status, valid = "failed", False
                    settled, at = _settled(status, valid), now
                for column, value in zip(out, (status, valid, now), strict=True):
                    column.append(value)
            yield pa.RecordBatch.from_arrays([batch.column("file_id"), pa.array(out[0], pa.string()), pa.array(out[1], pa.bool_()), pa.array(out[2], pa.int64())], names=["file_id", "status", "valid", "updated_at"])

    kept = ", ".join(LOG.split(", ")[:-1])
    return told.select("file_id", "_call", "_before").repartition("file_id").sortWithinPartitions("file_id").mapInArrow(step, kept)


def _settled(status: str | None, valid: bool | None) -> bool:
    return status is not None and status.startswith("success") and bool(valid)


def resume_by_state(spark: SparkSession, source: str, schema: str, place: str, handle: Callable[[dict], tuple[str, bool]], files_per_batch: int = 100) -> StreamingQuery:
    """As resume(), for work that is done a call at a time: handle takes a row (its file_id among others, as plain
    values) and gives its status and whether that is valid.  What is known of a file is its state in the state
    store of a stream over the log, which takes in every batch of the log once; the store has one row a file, and
    a batch reads the store and no log.  A file whose last status is a valid success is skipped_existing.  A batch
    that is broken off is done again as a whole, from the states before it, and writes the same folder of the log,
    unless that folder is whole: then only the states have to take it in.  Rows without a file_id are one file."""
    if _exists(spark, f"{place}/log") and not _exists(spark, f"{place}/calls"):
        raise RuntimeError(f"{place} has a log but not the checkpoint of its calls: begin in a new place")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).json(source)
    kept = ", ".join(LOG.split(", ")[:-1])

    def step(batch: DataFrame, number: int) -> None:
        s = batch.sparkSession
        if not _exists(s, f"{place}/log/batch={number}/_SUCCESS"):
            known = states(s, place, number - 1) if number else s.createDataFrame([], kept)
            handled(batch, known, handle).write.mode("overwrite").parquet(f"{place}/log/batch={number}")
        folded(s, place, number)

    return stream.writeStream.foreachBatch(step).option("checkpointLocation", f"{place}/calls").trigger(availableNow=True).start()
