"""File discovery, routing and guards, on a table of paths or probed files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def discover(spark: SparkSession, root: str, glob: str = "*") -> DataFrame:
    """All files below root whose name matches, by path; contents are not read.  Empty files are not listed,
    for this source leaves them out."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(root)
    return files.select("path", "length", "modificationTime").orderBy("path")


def glob_regex(glob: str) -> str:
    """An anchored regex of a glob whose * also crosses slashes."""
    out = {"*": ".*", "?": "."}
    return "^" + "".join(out.get(c, "\\" + c if c in r"\.^$+{}()|[]" else c) for c in glob) + "$"


def exclude(files: DataFrame, dirs: list[str], globs: list[str], root: str) -> DataFrame:
    """Without files below the given directories, and without those whose absolute path or path below
    root matches a glob."""
    gone = F.lit(False)
    for d in dirs:
        gone |= F.col("path").startswith(d.rstrip("/") + "/")
    for g in map(glob_regex, globs):
        gone |= F.col("path").rlike(g) | F.expr("substring(path, length('{}') + 1)".format(root.rstrip("/") + "/")).rlike(g)
    return files.where(~gone)


#: Slices that numbered() cuts a table into, and values sampled for each cut.
SLICES, PER_CUT = 64, 40


def numbered(files: DataFrame, by: str = "path") -> DataFrame:
    """Position in the order of `by`, from 0, without one task sorting it all: rows are cut into slices by
    values of a small sample, ranked within their slice, and shifted by the slices' sizes.  The cuts are
    constants of the plan, so every use of it sees the same slices; a table of equal values is one slice."""
    scale = 1 << 30
    rate = min(1.0, SLICES * PER_CUT / max(1, files.count()))
    some = sorted(r[0] for r in files.where(F.col(by).isNotNull() & (F.pmod(F.xxhash64(by), F.lit(scale)) < int(rate * scale))).select(by).distinct().limit(4 * SLICES * PER_CUT).collect())
    cuts = some[:: max(1, len(some) // SLICES)][1:]
    slice_ = F.aggregate(F.array(*map(F.lit, cuts)), F.lit(0), lambda a, c: a + (c <= F.col(by)).cast("int")) if cuts else F.lit(0)
    sliced = files.withColumn("_s", F.coalesce(slice_, F.lit(-1)))
    sizes = sliced.groupBy("_s").agg(F.count("*").alias("_c"))
    base = sizes.select("_s", F.coalesce(F.sum("_c").over(Window.orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_b"))
    local = sliced.withColumn("_r", F.row_number().over(Window.partitionBy("_s").orderBy(by)))
    return local.join(F.broadcast(base), "_s").withColumn("idx", F.col("_r") - 1 + F.col("_b")).drop("_s", "_r", "_b")


def shard(files: DataFrame, count: int, index: int, limit: int | None = None, by: str = "path") -> DataFrame:
    """Every count-th file in the order of `by`; the limit is for each shard."""
    own = numbered(files, by).where(F.col("idx") % count == index)
    return own.orderBy(by).limit(limit) if limit else own


def micro_batches(files: DataFrame, size: int, by: str = "path") -> DataFrame:
    return numbered(files, by).withColumn("batch", F.floor(F.col("idx") / size))


def expected_channels(channels: Column, mono_mix: bool = False) -> Column:
    if mono_mix:
        return F.array(F.lit(-1))
    n = F.least(F.lit(2), F.greatest(F.lit(1), F.coalesce(F.nullif(channels, F.lit(0)), F.lit(1))))
    return F.sequence(F.lit(0), n.cast("int") - 1)


def required_format(codec: Column, rate: Column, channels: Column, want_rate: int = 48000, want_channels: int = 2) -> Column:
    return (F.lower(F.coalesce(codec, F.lit(""))) == "opus") & (F.coalesce(rate, F.lit(0)) == want_rate) & (F.coalesce(channels, F.lit(0)) == want_channels)


def strategy(duration: Column, most: float | None = None, single_up_to: float = 1800.0) -> Column:
    """too_long (a failed row, never an exception), temp_wav for long files, else single_decode."""
    route = F.when(duration > single_up_to, "temp_wav").otherwise("single_decode")
    return F.when(duration > most, "too_long").otherwise(route) if most else route


def output_path(path: Column, root: str, out: str, suffix: str | None = ".opus", relative: bool = True) -> Column:
    """Below the output root as below the input root (else by name alone), with another suffix.  Null where
    that would be the input itself, which is never written over."""
    base = root.rstrip("/") + "/"
    name = F.element_at(F.split(path, "/"), -1)
    below = F.when(path.startswith(base), F.substring(path, len(base) + 1, 1 << 30)).otherwise(name) if relative else name
    to = F.concat(F.lit(out.rstrip("/") + "/"), F.regexp_replace(below, r"\.[^./]+$", "") if suffix else below, F.lit(suffix or ""))
    return F.when(to != path, to)


def sidecar_path(out_path: Column, suffix: str = ".json") -> Column:
    return F.concat(out_path, F.lit(suffix))


def decoded_gb(files: DataFrame, keys: list[str], rate: int = 48000, channels: int = 2) -> DataFrame:
    """Estimated size decoded, as 32-bit samples; null where a duration is unknown."""
    size = F.sum("duration") * rate * channels * 4 / float(1 << 30)
    return files.groupBy(*keys).agg(F.when(F.count("*") == F.count("duration"), size).alias("gb"))


def shrunk(size: Column, free: Column, least_free: float, floor: int) -> Column:
    return F.when((free < least_free) & (size > floor), F.greatest(F.lit(floor), F.floor(size / 2))).otherwise(size)


def recovered(size: Column, configured: Column, free: Column, least_free: float) -> Column:
    return F.when(free >= least_free, F.least(configured, F.greatest(size + 1, 2 * size))).otherwise(size)


def short_error(error: Column) -> Column:
    return F.coalesce(F.nullif(F.substring(F.element_at(F.split(error, ":"), 1), 1, 120), F.lit("")), F.lit("Error"))


PROBE = "streams array<struct<codec_name:string,sample_rate:string,channels:string,duration:string,bit_rate:string>>, format struct<duration:string,bit_rate:string,format_name:string>"


def probed(df: DataFrame, column: str) -> DataFrame:
    """Typed probe metadata from a probe's JSON: the first stream, then the format; what is no number is
    null, and a stream's zero counts as missing."""
    p = F.from_json(column, PROBE)
    s, f = F.try_element_at(p["streams"], F.lit(1)), p["format"]
    whole = lambda c: F.when(c.rlike(r"^\s*[+-]?[0-9]+\s*$"), F.trim(c).try_cast("long"))
    first = lambda a, b: F.when(a.isNotNull() & (a != 0), a).otherwise(b)
    return df.withColumns(
        {
            "codec": s["codec_name"], "sample_rate": whole(s["sample_rate"]), "channels": whole(s["channels"]),
            "duration": first(s["duration"].try_cast("double"), f["duration"].try_cast("double")), "bit_rate": first(whole(s["bit_rate"]), whole(f["bit_rate"])), "format_name": f["format_name"],
        }
    )


CHECKS = ("output_exists", "codec_ok", "rate_ok", "channels_ok", "duration_ok")


def validated(df: DataFrame, delta: float = 0.2, rate: int = 48000, channels: int = 2) -> DataFrame:
    """Checks of an output against its input; valid if all hold.  An output exists if its size (out_bytes) is
    known; unknown durations are let pass."""
    checks = {
        "output_exists": F.col("out_bytes").isNotNull(),
        "codec_ok": F.lower(F.coalesce("out_codec", F.lit(""))) == "opus",
        "rate_ok": F.coalesce("out_rate", F.lit(0)) == rate,
        "channels_ok": F.coalesce("out_channels", F.lit(0)) == channels,
        "duration_ok": F.coalesce(F.abs(F.col("out_duration") - F.col("duration")) <= delta, F.lit(True)),
    }
    out = df.withColumns(checks)
    return out.withColumn("valid", F.forall(F.array(*checks), lambda c: c))


def checked_outputs(files: DataFrame, outputs: DataFrame, delta: float = 0.2, rate: int = 48000, channels: int = 2) -> DataFrame:
    """files (file_id, duration, any others) with what was found at their outputs (file_id, out_bytes, side_there,
    out_probe: a probe's JSON), the five checks, valid, and failed_checks, the names of those that do not
    hold.  An output that cannot be probed has neither codec nor rate, so it is not valid."""
    seen = probed(outputs, "out_probe").select("file_id", "out_bytes", "side_there", F.col("codec").alias("out_codec"), F.col("sample_rate").alias("out_rate"), F.col("channels").alias("out_channels"), F.col("duration").alias("out_duration"))
    out = validated(files.join(seen, "file_id", "left"), delta, rate, channels)
    broken = F.array_compact(F.array(*(F.when(~F.col(c), F.lit(c)) for c in CHECKS)))
    return out.withColumns({"side_there": F.coalesce("side_there", F.lit(False)), "failed_checks": F.array_join(broken, ",")})


def reusable(checked: DataFrame, must_hold: bool = True) -> DataFrame:
    """file_id of files whose output and sidecar are there already; with must_hold only valid outputs count, so
    one that was damaged is made anew."""
    there = F.col("side_there") & (F.col("valid") if must_hold else F.col("output_exists"))
    return checked.where(there).select("file_id")


def settled(written: DataFrame, checked: DataFrame) -> DataFrame:
    """Status rows (file_id, status, error, valid) decided from both passes: what the writer says (file_id, status,
    error) and what its output was checked for.  A success whose output does not hold has failed."""
    j = written.join(checked.select("file_id", F.col("valid").alias("_ok"), "failed_checks"), "file_id", "left")
    made = F.col("status").startswith("success")
    broken = made & ~F.coalesce("_ok", F.lit(False))
    return j.select(
        "file_id", F.when(broken, "failed").otherwise(F.col("status")).alias("status"),
        F.when(broken, F.concat(F.lit("invalid output: "), F.coalesce("failed_checks", F.lit("not probed")))).otherwise(F.col("error")).alias("error"), (made & ~broken).alias("valid"),
    )
