"""Reports and metrics."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def run_counters(results: DataFrame, keys: list[str]) -> DataFrame:
    s = F.col("status")
    return results.groupBy(*keys).agg(
        F.count("*").alias("processed"), F.count_if(s.startswith("success") | (s == "skipped_existing")).alias("success"),
        F.count_if(s == "failed").alias("failed"), F.count_if(s == "skipped_existing").alias("skipped"), F.count_if(s == "success_unmapped_fallback").alias("failsafe"),
    )


def last_rows(results: DataFrame, n: int, by: str) -> DataFrame:
    """The last n rows by order: a top-n, which every partition bounds."""
    return results.orderBy(F.desc(by)).limit(n).orderBy(by)


def union_all(frames: list[DataFrame]) -> DataFrame:
    """Rows of all frames under the sorted union of their columns."""
    both = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return both.select(sorted(both.columns))


def bench_summary(rows: DataFrame, keys: list[str]) -> DataFrame:
    """rows: status, duration_sec, elapsed_sec (of the run), free (array of samples)."""
    elapsed = F.max("elapsed_sec")
    ok = F.count_if(F.col("status").startswith("success"))
    hours = F.sum("duration_sec") / 3600
    return rows.groupBy(*keys).agg(
        ok.alias("success"), F.count_if(F.col("status") == "failed").alias("failed"), hours.alias("audio_hours"),
        F.when(elapsed > 0, F.count("*") / elapsed * 3600).otherwise(0.0).alias("files_per_hour"), F.when(elapsed > 0, hours / elapsed * 3600).otherwise(0.0).alias("audio_hours_per_hour"),
        F.min(F.array_min("free")).alias("min_free"), F.max(F.array_max("free")).alias("max_free"),
    )


def stage_timing(events: DataFrame, keys: list[str]) -> DataFrame:
    """Seconds by stage (columns stage, seconds) as one map a key."""
    per = events.groupBy(*keys, "stage").agg(F.sum("seconds").alias("s"))
    return per.groupBy(*keys).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("stage", "s")))).alias("stages"))


def detection_items(bundles: DataFrame) -> DataFrame:
    """bundles: file_id, channel, final, engines (array of engine, text, error).  The final text and every
    engine's, without blank or failed ones, once for each source and lower-cased text."""
    items = bundles.select("file_id", "channel", F.posexplode(F.concat(F.array(F.struct(F.lit("final_consensus").alias("source"), F.col("final").alias("text"), F.lit(None).cast("string").alias("error"))), F.transform("engines", lambda e: F.struct(F.concat(F.lit("engine:"), e["engine"]).alias("source"), e["text"].alias("text"), e["error"].alias("error"))))).alias("ord", "i"))
    items = items.select("file_id", "channel", "ord", "i.source", F.trim("i.text").alias("text"), "i.error").where("error IS NULL AND text <> ''")
    by = Window.partitionBy("file_id", "channel", "source", F.lower("text")).orderBy("ord")
    return items.withColumn("_n", F.row_number().over(by)).where("_n = 1").select("file_id", "channel", "source", "text")


def validation(skipped: bool = False) -> Column:
    """What a sidecar says of the checks (columns of files.checked_outputs); the difference of durations is to 6 places."""
    if skipped:
        return F.struct(F.lit(True).alias("valid"), F.lit(True).alias("validation_skipped"))
    return F.struct(
        F.col("valid"), F.struct("output_exists", "codec_ok", "rate_ok", "channels_ok", "duration_ok").alias("checks"), F.round(F.abs(F.col("out_duration") - F.col("duration")), 6).alias("duration_delta_sec"),
        F.struct(F.col("out_codec").alias("codec"), F.col("out_rate").alias("sample_rate"), F.col("out_channels").alias("channels"), F.col("out_duration").alias("duration")).alias("output"),
    )


def any_transcript(transcripts: DataFrame) -> DataFrame:
    """Files of which some transcript (column text), of the consensus or of an engine, is not blank."""
    return transcripts.where(F.trim(F.coalesce("text", F.lit(""))) != "").select("file_id").distinct()


def final_status(files: DataFrame, transcripts: DataFrame, entities: DataFrame, fail_unmapped: bool = False, copy_clean: bool = True) -> DataFrame:
    """files (file_id, duration, matches: has the output's format) with a status.  transcripts: file_id, text;
    entities: file_id, mapped (has a span).  No transcript is no proof of no entity: such a file is masked
    as a whole, or failed where its duration is unknown.  So is one with any entity that has no span; it
    fails by policy too.  Files without entities are copied if they match and may be, else transcoded."""
    per = entities.groupBy("file_id").agg(F.count_if(F.col("mapped")).alias("_mapped"), F.count_if(~F.coalesce("mapped", F.lit(False))).alias("_unmapped"))
    spoken = any_transcript(transcripts).withColumn("_spoken", F.lit(True))
    j = files.join(spoken, "file_id", "left").join(per, "file_id", "left")
    silent, unmapped = F.col("_spoken").isNull(), F.coalesce("_unmapped", F.lit(0)) > 0
    clean = F.when(F.col("matches"), "success_no_pii_fast_copy").otherwise("success_no_pii_transcoded") if copy_clean else F.lit("success")
    status = (
        F.when((silent | unmapped) & F.col("duration").isNull(), "failed").when(unmapped & ~silent & F.lit(fail_unmapped), "failed").when(silent | unmapped, "success_unmapped_fallback")
        .when(F.coalesce("_mapped", F.lit(0)) > 0, "success").otherwise(clean)
    )
    return j.withColumn("status", status).drop("_spoken", "_mapped", "_unmapped")


def result_rows(transcripts: DataFrame, entities: DataFrame, spans: DataFrame) -> DataFrame:
    """One row a file: words over all its transcripts (word_count), its entities and its merged spans."""
    each = [
        transcripts.select("file_id", F.col("word_count").cast("long").alias("w"), F.lit(0).alias("e"), F.lit(0).alias("s")),
        entities.select("file_id", F.lit(0).cast("long").alias("w"), F.lit(1).alias("e"), F.lit(0).alias("s")),
        spans.select("file_id", F.lit(0).cast("long").alias("w"), F.lit(0).alias("e"), F.lit(1).alias("s")),
    ]
    # one shuffle for the three tables, each counted before it
    return reduce(DataFrame.unionByName, each).groupBy("file_id").agg(F.sum("w").alias("num_words"), F.sum("e").alias("num_entities"), F.sum("s").alias("num_spans"))


def merged_metrics(parts: DataFrame, keys: list[str], shared: bool = False) -> DataFrame:
    """parts: keys, ord, stages (map of seconds), engines (map of seconds), samples (array).  Seconds add up
    name by name and samples are appended in order.  With `shared`, stage seconds are those of a whole
    micro-batch and are kept as batch_stages, not to be summed over its files."""

    def summed(column: str) -> DataFrame:
        one = parts.select(*keys, F.explode(column).alias("name", "sec")).groupBy(*keys, "name").agg(F.sum("sec").alias("sec"))
        return one.groupBy(*keys).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("name", "sec")))).alias(column))

    rows = parts.groupBy(*keys).agg(F.flatten(F.array_sort(F.collect_list(F.struct("ord", F.coalesce("samples", F.array()).alias("x"))))["x"]).alias("samples"))
    out = rows.join(summed("stages"), keys, "left").join(summed("engines"), keys, "left")
    return out.withColumnRenamed("stages", "batch_stages") if shared else out


def report_tail(spark: SparkSession, path: str, skip: int, schema: str) -> DataFrame:
    """The records of a JSON-lines report after its first `skip` physical lines, blank lines counted but not
    read: line (from 0) and the record.  Lines are numbered within the blocks that tasks read, and blocks
    shifted by the sizes of those before, files in order of their paths; one row a block is all that is
    ordered in one place."""
    block = F.struct(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("at")).alias("_block")
    lines = spark.read.text(path).select("value", block, F.monotonically_increasing_id().alias("_i"))
    local = lines.withColumn("_r", F.row_number().over(Window.partitionBy("_block").orderBy("_i")))
    sizes = lines.groupBy("_block").agg(F.count("*").alias("_n"))
    base = sizes.select("_block", F.coalesce(F.sum("_n").over(Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_base"))
    placed = local.join(base, "_block").withColumn("line", F.col("_base") + F.col("_r") - 1)
    return placed.where((F.col("line") >= skip) & (F.trim("value") != "")).select("line", F.from_json("value", schema).alias("record"))


def transcript_rows(bundles: DataFrame) -> DataFrame:
    """bundles (see words.bundles) as rows: the consensus, then each engine's result."""
    row = lambda kind, engine, text, n, error: F.struct(F.lit(kind).alias("kind"), engine.alias("engine"), F.coalesce(text, F.lit("")).alias("transcript"), n.cast("int").alias("word_count"), error.alias("error"))
    none = F.lit(None).cast("string")
    engines = F.transform("engine_results", lambda r: row("engine", r["engine"], r["transcript"], F.coalesce(F.size(r["words"]), F.lit(0)), r["error"]))
    first = F.array(row("consensus", F.lit("consensus"), F.col("final_transcript"), F.size(F.filter(F.split("final_transcript", " "), lambda w: w != "")), none))
    return bundles.select("file_id", "channel", F.inline(F.concat(first, engines)))


def enriched(found: DataFrame) -> DataFrame:
    """Entities by text (file_id, channel, source, entities) as one list of rows with where they come
    from; an engine's text names that engine."""
    engine = F.when(F.col("source").startswith("engine:"), F.substring("source", 8, 1_000_000))
    # not the bare column, for which Spark would infer a filter, and search every text for it once more before it is dealt out
    held = F.coalesce("entities", F.array().cast(found.schema["entities"].dataType))
    return found.select("file_id", "channel", F.col("source").alias("transcript_source"), engine.alias("asr_engine"), F.inline(held))


def sidecar(files: DataFrame) -> DataFrame:
    """files: file_id, path, out_path, status, entities (array), raw_spans, spans (arrays), and where they are
    there elapsed_sec, duration, codec, sample_rate, channels, transcripts, valid, validation, settings, stages:
    one JSON document a file, with what was found, what was done and what the output was checked for."""
    have = lambda *names: [c for c in names if c in files.columns]
    body = F.struct(
        F.struct(F.col("path").alias("input_path"), F.col("out_path").alias("output_path")).alias("files"), "status", *have("elapsed_sec", "valid"),
        *([F.struct(*have("duration", "codec", "sample_rate", "channels")).alias("input")] if have("duration", "codec", "sample_rate", "channels") else []),
        *have("transcripts"), F.size("entities").alias("num_entities"), F.size("spans").alias("num_spans"), "entities", *have("raw_spans"), "spans",
        F.struct((F.col("status") == "success_no_pii_fast_copy").alias("fast_copy"), (F.col("status") == "success_unmapped_fallback").alias("unmapped_fallback")).alias("decisions"), *have("validation", "settings", "stages"),
    )
    return files.select("file_id", F.to_json(body).alias("document"))
