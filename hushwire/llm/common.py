"""Shared plumbing of the training-data operators: table access, Arrow mapping, durable cuts."""

from __future__ import annotations

import itertools
import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once for each Spark context."""
    sc = spark.sparkContext
    if getattr(sc, "_hushwire_shipped", False):
        return
    root = Path(__file__).resolve().parents[1]
    place = Path(tempfile.mkdtemp(prefix="hushwire-")) / "hushwire.zip"
    with zipfile.ZipFile(place, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    sc.addPyFile(str(place))
    sc._hushwire_shipped = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


#: Bytes of text that one call of a batch function sees, unless a single text is longer.
BATCH_BYTES = 4 << 20


def slices(batch: pa.RecordBatch, column: str, most: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that its texts, or lists, stay under `most` bytes a part (one row at least)."""
    c = batch.column(column)
    if pa.types.is_list(c.type):
        held = c.flatten()
        size = pc.list_value_length(c).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64) * held.nbytes // max(1, len(held))
    else:
        size = pc.binary_length(c).fill_null(0).to_numpy(zero_copy_only=False)
    part = np.cumsum(size) // most
    edges = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    for a, b in itertools.pairwise(edges):
        if b > a:
            yield batch.slice(a, b - a)


def map_arrow(df: DataFrame, make: Callable[[], Callable[[dict], dict]], schema: str | StructType, text: str | None = None, most: int = BATCH_BYTES) -> DataFrame:
    """Map Arrow batches.  make() runs once a task and returns the batch function, which takes and
    returns a dict of columns (lists or Arrow arrays); an empty dict yields no rows.  With `text`,
    batches are cut by the bytes of that column (at most `most`), so memory follows bytes and not rows."""
    kind = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    arrow = to_arrow_schema(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for whole in batches:
            for batch in slices(whole, text, most) if text else [whole]:
                out = work({n: batch.column(i) for i, n in enumerate(batch.schema.names)})
                if out:
                    yield as_batch(out, arrow)

    return df.mapInArrow(run, kind)


def as_batch(columns: dict, schema: pa.Schema) -> pa.RecordBatch:
    arrays = []
    for field in schema:
        c = columns[field.name]
        arrays.append(c.cast(field.type) if isinstance(c, pa.Array) else pa.array(c, field.type))
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def free_name(df: DataFrame, name: str) -> str:
    """A column name that df does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def text_fold(column: str, mod: int):
    """crc32 of a key as text, modulo mod: the fixed folds of the learned operators."""
    return F.pmod(F.crc32(F.col(column).cast("string").cast("binary")), F.lit(mod))


def share(column: str, seed: int, fraction: float):
    """A reproducible pseudo-random share of the rows, chosen by key and not by position."""
    scale = 1 << 30
    return F.pmod(F.xxhash64(F.col(column), F.lit(seed)), F.lit(scale)) < F.lit(int(scale * min(1.0, fraction)))


_local_dir: list[str] = []
_serial = itertools.count()


def shared_dir(spark: SparkSession) -> str:
    """The folder that all machines share: spark.checkpoint.dir.  Only where it is unset (tests in
    local mode) is a folder made for this process; a cluster without it is an error."""
    place = spark.conf.get("spark.checkpoint.dir", "")
    if place:
        return place
    set_dir = spark.sparkContext._jsc.sc().getCheckpointDir()
    if set_dir.isDefined():
        return set_dir.get()
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
    if not _local_dir:
        _local_dir.append(tempfile.mkdtemp(prefix="hushwire-"))
    return f"file://{_local_dir[0]}"


#: Whether Spark deletes the shuffle files of a query when it ends, and not when the driver next collects garbage.
FILE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def keep(df: DataFrame, name: str = "cut") -> DataFrame:
    """Write df as a Parquet table in the shared folder and read it back: cuts the lineage, survives
    lost executors, and is computed once however often it is used.  The shuffle files of the write go with it."""
    spark = df.sparkSession
    place = f"{shared_dir(spark)}/{name}-{os.getpid()}-{next(_serial)}-{uuid.uuid4().hex[:8]}"
    before = spark.conf.get(FILE_CLEANUP, "false")
    spark.conf.set(FILE_CLEANUP, "true")
    try:
        df.write.parquet(place)
    finally:
        spark.conf.set(FILE_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(place)


def hot_keys(counts: DataFrame, key: str, total: int) -> DataFrame:
    """Of counts (key, n), which add up to total: the keys that hold more than their share of the rows, with
    the number of parts that each is to be cut into.  A share is an eighth of a task's, so there are at
    most 8 * partitions such keys, whatever the size of the tables: small enough to broadcast."""
    part = max(1, total // (8 * partitions(counts.sparkSession)))
    return counts.where(F.col("n") > part).select(key, F.ceil(F.col("n") / part).cast("int").alias("_parts"))


def join_hot(left: DataFrame, right: DataFrame, key: str, hot: DataFrame, spread: list[str], how: str = "inner") -> DataFrame:
    """Join (inner or left) of left, where a key may hold any number of rows, with right, which has a key once (or a
    few times).  Rows of hot keys (see hot_keys) are dealt over that many parts by the columns `spread`,
    and what right has for such a key is repeated for each part.  Null keys join nothing."""
    salt = F.when(F.col("_parts").isNull(), 0).otherwise(F.expr(f"pmod(xxhash64({', '.join(spread)}), _parts)")).cast("int")
    dealt = left.join(F.broadcast(hot), key, "left").withColumn("_salt", salt).drop("_parts")
    parts = F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_parts") - 1, F.lit(0))))
    repeated = right.join(F.broadcast(hot), key, "left").withColumn("_salt", parts).drop("_parts")
    return dealt.join(repeated, [key, "_salt"], how).drop("_salt")


def kept_path(df: DataFrame) -> str:
    return df.inputFiles()[0].rpartition("/")[0] if df.inputFiles() else ""


def drop_kept(spark: SparkSession, df: DataFrame) -> None:
    """Delete the table made by keep() that df is (or, of the first one that it reads), once nothing reads it."""
    place = kept_path(df)
    if place and shared_dir(spark).rpartition("://")[2].rstrip("/") in place:
        path = spark._jvm.org.apache.hadoop.fs.Path(place)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
