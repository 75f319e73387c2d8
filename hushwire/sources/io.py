"""Sources and sinks: JSON lines, CSV with a sorted header, manifests and report tails."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from hushwire.operators.reports import union_all


def read_json(spark: SparkSession, path: str, schema: str, multiline: bool = False) -> DataFrame:
    """Blank lines are skipped."""
    return spark.read.schema(schema).json(path, multiLine=multiline)


def append_jsonl(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)


def write_csv(frames: list[DataFrame], path: str) -> None:
    """Header: the sorted union of all columns; what is missing is empty."""
    union_all(frames).write.mode("overwrite").option("header", True).csv(path)


def write_manifest(files: DataFrame, path: str) -> None:
    files.write.mode("overwrite").json(f"{path}/json")
    write_csv([files], f"{path}/csv")


_made: list[str] = []


def scratch(spark: SparkSession) -> str:
    """A new folder below the one that all machines share (spark.checkpoint.dir); where that is unset, in
    local mode only, below a temporary folder of this process."""
    place = spark.conf.get("spark.checkpoint.dir", "")
    if not place:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
        if not _made:
            _made.append(tempfile.mkdtemp(prefix="hushwire-"))
        place = f"file://{_made[0]}"
    return f"{place}/{uuid.uuid4().hex}"


class Scratch:
    """Tables that a run needs between its steps: written once below scratch(), deleted together."""

    def __init__(self, spark: SparkSession):
        self.spark, self.places = spark, []

    def keep(self, df: DataFrame) -> DataFrame:
        place = scratch(self.spark)
        self.places.append(place)
        df.write.parquet(place)
        return self.spark.read.schema(df.schema).parquet(place)

    def clear(self, but: DataFrame | None = None) -> None:
        """Delete all tables, but for the one that `but` is read from."""
        spared = {f.rpartition("/")[0].rpartition("/")[2] for f in but.inputFiles()} if but is not None else set()
        gone = [p for p in self.places if p.rpartition("/")[2] not in spared]
        for p in gone:
            place = self.spark._jvm.org.apache.hadoop.fs.Path(p)
            place.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(place, True)
        self.places = [p for p in self.places if p not in gone]
