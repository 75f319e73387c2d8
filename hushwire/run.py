"""A run from recordings to masked ones, and the command line of its stages.

Stages are tables: a manifest of probed files, the recognisers' results, entities with their time spans, a
status and masks for every file.  Recordings are decoded, masked and encoded in the tasks, one at a time.
What was written is then probed in a second pass, and the status is decided from both; a later run leaves
out what still holds."""

from __future__ import annotations

import argparse
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace
from functools import partial
from pathlib import Path

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hushwire import config as cfg
from hushwire import ports
from hushwire.operators import audio, blocks, consensus, entities, files, reports, spans, state, words
from hushwire.sources import io, media, store

#: Texts of one channel have numbers of their own: the consensus, then the engines.
ITEMS = 64
SPAN = "struct<start:double,end:double,channel:int>"


def manifest(spark: SparkSession, c: cfg.Config, port: Callable[[str], str] = media.probe_command) -> DataFrame:
    """The shard's files with a number of their own and what the probe says: status ok or probe_failed."""
    root = str(Path(c.paths.input_root).resolve())
    found = files.discover(spark, root, c.paths.input_glob).select(F.regexp_replace("path", "^file:/+", "/").alias("path"))
    found = files.exclude(found, [str(Path(p).resolve()) for p in (c.paths.output_root, c.paths.work_dir)], list(c.paths.exclude_globs), root)
    own = files.shard(found, c.runtime.shard_count, c.runtime.shard_index, c.runtime.limit).select("path", F.col("idx").cast("long").alias("file_id"))
    probed = files.probed(media.probe(own, port), "probe")
    return own.join(probed.drop("probe"), "path")


def with_places(c: cfg.Config, work: DataFrame) -> DataFrame:
    """work with out_path and sidecar_path (null where an output would be its own input)."""
    out = files.output_path(F.col("path"), str(Path(c.paths.input_root).resolve()), str(Path(c.paths.output_root).resolve()), c.paths.suffix)
    return work.withColumn("out_path", out).withColumn("sidecar_path", files.sidecar_path(F.col("out_path"), c.paths.sidecar_suffix))


def checked(c: cfg.Config, placed: DataFrame, port: Callable[[str], str]) -> DataFrame:
    """placed (with_places) with what its outputs are like and whether they are valid."""
    found = media.probe_outputs(placed.where("out_path IS NOT NULL"), port)
    return files.checked_outputs(placed, found, c.runtime.longest_delta_sec, c.masking.rate, c.masking.channels)


RESULTS = "results"


def recognised_by_model(c: cfg.Config, inputs: DataFrame, recognise: Callable, made: io.Scratch) -> DataFrame:
    """Model-major: every engine in turn over all inputs, through the keyed store of results.  Only inputs
    without a result free of errors are given to an engine, so a run that was broken off goes on."""
    spark, kept = inputs.sparkSession, store.result_store(f"{Path(c.paths.work_dir).resolve()}/{RESULTS}")
    names = cfg.enabled(c)
    for n in names:
        had = kept.read(spark).where((F.col("engine") == n) & F.col("error").isNull()).select(F.col("input_path").alias("path"), "channel")
        missing = inputs.join(had, ["path", "channel"], "left_anti")
        new = with_words(recognise(missing, [n])).join(inputs.select("file_id", "path").distinct(), "file_id")
        row = new.select(F.col("path").alias("input_path"), "engine", F.col("channel").cast("int").alias("channel"), "transcript", F.col("words").cast(f"array<{WORD}>").alias("words"), F.lit(None).cast("string").alias("language"), "error", F.unix_timestamp().cast("double").alias("updated_at"))
        kept.upsert(made.keep(row))
    at = F.array_position(F.array(*map(F.lit, names)), F.col("engine"))
    own = kept.read(spark).where(F.col("engine").isin(names)).select(F.col("input_path").alias("path"), "channel", "engine", (at - 1).cast("int").alias("engine_ord"), "transcript", "words", "error")
    return inputs.select("path", "channel", "file_id").join(own, ["path", "channel"]).drop("path")


WORD = "struct<word:string,start:double,end:double>"


def with_words(results: DataFrame) -> DataFrame:
    return results if "words" in results.columns else results.withColumn("words", F.lit(None).cast(f"array<{WORD}>"))


@dataclass(frozen=True)
class Plan:
    """What is to be done with every file (files: a row a file, with its masks) and why."""

    files: DataFrame
    results: DataFrame
    found: DataFrame


def items(results: DataFrame, final: DataFrame, scope: str) -> DataFrame:
    """The texts to be searched: item (a number), file_id, channel, source, text."""
    per = results.groupBy("file_id", "channel").agg(F.array_sort(F.collect_list(F.struct("engine_ord", "engine", F.col("transcript").alias("text"), "error"))).alias("engines"))
    texts = reports.detection_items(per.join(final.select("file_id", "channel", F.col("final_transcript").alias("final")), ["file_id", "channel"], "left"))
    if scope != "final_and_all_engines":
        texts = texts.where((F.col("source") == "final_consensus") == F.lit(scope == "final_only"))
    order = results.select(F.concat(F.lit("engine:"), "engine").alias("source"), (F.col("engine_ord") + 1).alias("nth")).distinct()
    # as many rows as there are engines
    return texts.join(F.broadcast(order), "source", "left").select(((F.col("file_id") * 4 + F.col("channel") + 1) * ITEMS + F.coalesce("nth", F.lit(0))).alias("item"), "file_id", "channel", "source", "text")


def timed(texts: DataFrame, results: DataFrame, work: DataFrame, anchor: str) -> DataFrame:
    """Words of every text with the times of the anchor engine's words that they correspond to."""
    own = results.where((F.col("engine") == anchor) & F.col("error").isNull()).select("file_id", "channel", F.posexplode("words").alias("ord", "w")).select("file_id", "channel", "ord", "w.*")
    own = words.clamped(own.join(work.select("file_id", "duration"), "file_id"))
    anchors = texts.select("item", "file_id", "channel").join(own, ["file_id", "channel"]).select(F.col("item").alias("file_id"), "channel", "ord", "word", "start", "end")
    said = texts.select(F.col("item").alias("file_id"), "channel", F.col("text").alias("transcript"))
    got = words.align(said, anchors).select(F.col("file_id").alias("item"), F.col("start").alias("w_start"), F.col("end").alias("w_end"), "start_char", "end_char")
    return got.join(texts.join(work, "file_id").select("item", "duration"), "item")


def transcripts(results: DataFrame, final: DataFrame) -> DataFrame:
    """file_id, transcripts: what was heard, by channel, for the sidecar."""
    heard = F.struct("engine_ord", "engine", "transcript", F.coalesce(F.size("words"), F.lit(0)).alias("num_words"), "error")
    per = results.groupBy("file_id", "channel").agg(F.transform(F.array_sort(F.collect_list(heard)), lambda e: e.dropFields("engine_ord")).alias("engines"))
    row = F.struct("channel", "final_transcript", "method", "selected_engine", "agreement_count", "engines")
    return per.join(final, ["file_id", "channel"], "left").groupBy("file_id").agg(F.array_sort(F.collect_list(row)).alias("transcripts"))


def mask_rows(c: cfg.Config, work: DataFrame, said: DataFrame, found: DataFrame) -> DataFrame:
    """The spans to be masked, before they are merged: those of entities with times; the whole channel of
    entities without, theirs alone; all channels of files in which nothing was heard."""
    common = ["file_id", F.col("channel").cast("int").alias("channel"), F.col("start_sec").alias("start"), F.col("end_sec").alias("end"), "type"]
    lost = spans.unmapped_spans(found.where("NOT mapped").join(work.select("file_id", "duration"), "file_id"), ["file_id", "channel"])
    lost = lost.where("end_sec IS NOT NULL").withColumns({"type": F.lit("UNMAPPED_PII_FALLBACK"), "source": F.lit("unmapped_entity_policy"), "ord": F.lit(0)})
    silent = work.join(reports.any_transcript(said), "file_id", "left_anti").where("duration IS NOT NULL")
    whole = spans.failsafe_spans(silent, c.masking.channels).withColumns({"text": F.lit(""), "source": F.lit("empty_transcript_failsafe"), "ord": F.lit(0)})
    rows = found.where("mapped").select(*common, "text", "source", "ord")
    return rows.unionByName(lost.select(*common, "text", "source", "ord")).unionByName(whole.select(*common, "text", "source", "ord"))


def plan(c: cfg.Config, work: DataFrame, recognise: Callable[[DataFrame, list[str]], DataFrame] = ports.transcribe, made: io.Scratch | None = None) -> Plan:
    """work: rows of the manifest whose probe is ok.  The recognisers take file_id, path, channel and duration, and
    give what ports.transcribe gives; engines that time their words add `words` (array of word, start, end)."""
    if len(cfg.enabled(c)) >= ITEMS:
        raise ValueError(f"texts are numbered for fewer than {ITEMS} engines")
    r, m, made = c.recognisers, c.masking, made or io.Scratch(work.sparkSession)
    inputs = made.keep(work.select("file_id", "path", "duration", F.explode(files.expected_channels(F.col("channels"), r.mode == "mono_mix")).alias("channel")))
    results = recognised_by_model(c, inputs, recognise, made) if c.runtime.schedule == "model_major" else with_words(recognise(inputs, cfg.enabled(c)))
    results = made.keep(results)
    final = made.keep(consensus.consensus(results, r.prefer, list(r.fallback), r.min_agreement, r.soft_threshold))
    texts = made.keep(items(results, final, r.scope))
    d = c.detection
    rules = {} if d.rules else {"detectors": ()}
    found = entities.detect(texts, "item", spoken=d.spoken, taggers=ports.taggers(d.taggers), chunk_chars=d.chunk_chars, chunk_overlap=d.chunk_overlap, **rules).withColumn("ord", F.col("start"))
    placed = spans.entity_spans(found, timed(texts, results, work, r.anchor), ["item"], m.pad_sec, m.least_span_sec).drop("duration")
    found = made.keep(placed.join(texts.select("item", "file_id", "channel", F.col("source").alias("transcript_source")), "item").withColumn("mapped", F.col("start_sec").isNotNull()))

    matches = files.required_format(F.col("codec"), F.col("sample_rate"), F.col("channels"), m.rate, m.channels)
    said = final.select("file_id", F.col("final_transcript").alias("text")).unionByName(results.where("error IS NULL").select("file_id", F.col("transcript").alias("text")))
    decided = reports.final_status(work.withColumn("matches", matches), said, found, m.unmapped_policy == "fail")
    masks = mask_rows(c, work, said, found)
    merged = spans.merge_spans(masks.withColumn("duration", F.col("end") - F.col("start")), gap=m.merge_gap_sec, both=m.target_channels == "both")
    per_file = merged.groupBy("file_id").agg(F.array_sort(F.collect_list(F.struct("start", "end", "channel"))).cast(f"array<{SPAN}>").alias("spans"))
    raw = masks.groupBy("file_id").agg(F.array_sort(F.collect_list(F.struct("channel", "start", "end", "type", "text", "source"))).alias("raw_spans"))
    listing = ["channel", "transcript_source", "start", "end", "type", "text", "score", "source", "start_sec", "end_sec"]
    silent = masks.where("source = 'empty_transcript_failsafe'").select("file_id").distinct()
    none = {"channel": -1, "transcript_source": "none", "start": 0, "end": 0, "type": "EMPTY_TRANSCRIPT_FAILSAFE", "text": "", "score": 1.0, "source": "pipeline", "start_sec": None, "end_sec": None}
    silent = silent.select("file_id", *(F.lit(none[n]).cast(found.schema[n].dataType).alias(n) for n in listing))
    listed = found.select("file_id", *listing).unionByName(silent).groupBy("file_id").agg(F.array_sort(F.collect_list(F.struct(*listing))).alias("entities"))
    counted = results.groupBy("file_id").agg(F.sum(F.size(F.coalesce("words", F.array().cast(results.schema["words"].dataType)))).alias("num_words"))
    full = with_places(c, decided)
    for part in (per_file, raw, listed, counted, transcripts(results, final)):
        full = full.join(part, "file_id", "left")
    for frame, name in ((per_file, "spans"), (raw, "raw_spans"), (listed, "entities")):
        full = full.withColumn(name, F.coalesce(name, F.array().cast(frame.schema[name].dataType)))
    full = full.withColumn("status", F.when(F.col("out_path").isNull(), "failed").otherwise(F.col("status")))
    return Plan(full.withColumn("kbps", audio.output_bitrate(F.col("bit_rate"), F.lit(64), m.least_kbps).cast("int")), results, found)


def decoded(path: str, rate: int, channels: int) -> list[np.ndarray]:
    return media.split_frames(media.decode_command(path, rate, channels), channels)


DONE = "file_id long, status string, error string, began double, elapsed_sec double"


def written(c: cfg.Config, planned: DataFrame, decode: Callable = decoded, encode: Callable = media.encode_command) -> DataFrame:
    """Carry the plan out: one row a file with its status, what went wrong and how long it took.  A file that fails
    leaves no output and no sidecar; files are put in place at once, so a task that runs again does no harm."""
    m, method = c.masking, c.runtime.copy_method
    rows = planned.select("file_id", "path", "out_path", "sidecar_path", "status", "spans", "kbps").repartition("file_id")
    gain = audio.GAIN[m.mode]

    def one(row) -> tuple:
        if row.status == "failed":
            return "failed", "no mask can be made"
        try:
            if row.status == "success_no_pii_fast_copy":
                media.pass_through(row.path, row.out_path, method)
            else:
                x = audio.masked(decode(row.path, m.rate, m.channels), row.spans, m.rate, m.mode, m.target_channels == "both", 1000.0, gain, 8.0, 42)
                encode(x, row.out_path, m.rate, row.kbps)
            return row.status, None
        except Exception as e:  # any failure of a file is that file's row
            media.delete_partial([row.out_path, row.sidecar_path])
            return "failed", repr(e)[: media.TAIL]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for r in b.itertuples(index=False):
                began = time.time()
                out.append((r.file_id, *one(r), began, time.time() - began))
            yield pd.DataFrame(out, columns=["file_id", "status", "error", "began", "elapsed_sec"])

    return rows.mapInPandas(run, DONE)


#: Samples a channel in a block of a long recording (2 MB for two channels).
BLOCK_SAMPLES = 1 << 18


def is_long(c: cfg.Config):
    """Whether a recording that is to be masked is larger, decoded, than one task may hold."""
    size = F.col("duration") * (c.masking.rate * c.masking.channels * 4) / float(1 << 30)
    masked = ~F.col("status").isin("failed", "success_no_pii_fast_copy")
    return F.coalesce((size > c.runtime.decoded_gb) & masked, F.lit(False))


def written_long(c: cfg.Config, planned: DataFrame, made: io.Scratch, decode: Callable = media.decode_stream, encode: Callable = media.encode_stream, size: int = BLOCK_SAMPLES) -> DataFrame:
    """`written` by blocks: no task holds a recording.  The time of a file is that of joining its blocks."""
    m = c.masking
    rows = planned.select(F.col("file_id").alias("id"), "path", "out_path", "sidecar_path", "status", "spans", "kbps")
    found = made.keep(media.decoded_blocks(rows.repartition("id"), size, m.rate, m.channels, decode))
    spans_ = rows.select("id", F.posexplode("spans").alias("ord", "s")).select("id", "ord", "s.*")
    good = blocks.mask(found.where("error IS NULL").select("id", "block", "channels"), spans_, size, m.rate, m.mode, m.target_channels == "both")
    all_ = good.withColumn("error", F.lit(None).cast("string")).unionByName(found.where("error IS NOT NULL"))
    done = media.written_blocks(all_, rows, m.rate, encode)
    return rows.join(done, "id").select(F.col("id").alias("file_id"), F.when(F.col("error").isNull(), F.col("status")).otherwise("failed").alias("status"), "error", "began", "elapsed_sec")


def settings(c: cfg.Config):
    """What a sidecar says of the configuration that its file was made with."""
    r, m = c.recognisers, c.masking
    text = {
        "recogniser_mode": r.mode, "input": r.input, "anchor": r.anchor, "detection_scope": r.scope, "residency": r.residency, "schedule": c.runtime.schedule,
        "mask_mode": m.mode, "target_channels": m.target_channels, "unmapped_policy": m.unmapped_policy,
    }
    return F.struct(F.array(*map(F.lit, cfg.enabled(c))).alias("engines"), *(F.lit(v).alias(k) for k, v in text.items()))


def documented(documents: DataFrame) -> DataFrame:
    """Write every file's sidecar (sidecar_path, document): file_id and what went wrong."""

    def one(path: str, text: str) -> str | None:
        try:
            return media.in_place(path, lambda part: Path(part).write_text(text, encoding="utf-8") and None)
        except Exception as e:
            return repr(e)[: media.TAIL]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"file_id": b["file_id"], "side_error": [one(p, t) for p, t in zip(b["sidecar_path"], b["document"], strict=True)]})

    return documents.select("file_id", "sidecar_path", "document").mapInPandas(run, "file_id long, side_error string")


def process(spark: SparkSession, c: cfg.Config, probed: DataFrame, recognise: Callable = ports.transcribe, decode: Callable = decoded, encode: Callable = media.encode_command, port: Callable[[str], str] = media.probe_command, decode_blocks: Callable = media.decode_stream, encode_blocks: Callable = media.encode_stream, block: int = BLOCK_SAMPLES) -> DataFrame:
    """All files of the manifest: their status rows, which are appended to the status log too.  With resume,
    files whose output and sidecar are there and hold are skipped_existing and not done again.  Every
    output is probed once it is written; one that does not hold makes its file failed, and is made anew by
    the next run.  Recordings of more than decoded_gb are worked on by blocks."""
    log = f"{Path(c.paths.work_dir).resolve()}/status"
    state.create_if_absent(spark, log, state.STATUS_SCHEMA)
    made, t = io.Scratch(spark), c.runtime
    try:
        ok = made.keep(with_places(c, probed.where("status = 'ok'").drop("status", "error")))
        skipped = files.reusable(checked(c, ok, port), t.validate and t.validate_existing) if t.resume else ok.limit(0).select("file_id")
        skipped = made.keep(skipped)
        todo = made.keep(ok.join(skipped, "file_id", "left_anti").drop("out_path", "sidecar_path"))
        planned = made.keep(plan(c, todo, recognise, made).files)
        done = made.keep(written(c, planned.where(~is_long(c)), decode, encode))
        long = planned.where(is_long(c))
        if not long.isEmpty():
            done = done.unionByName(made.keep(written_long(c, long, made, decode_blocks, encode_blocks, block)))
        found = made.keep(checked(c, planned.select("file_id", "duration", "out_path", "sidecar_path"), port)) if t.validate else None
        end = files.settled(done, found) if t.validate else done.select("file_id", "status", "error", F.col("status").startswith("success").alias("valid"))
        rows = planned.drop("status").join(end, "file_id").join(done.select("file_id", "began", "elapsed_sec"), "file_id")
        if t.validate:
            rows = rows.join(found.select("file_id", *files.CHECKS, "out_codec", "out_rate", "out_channels", "out_duration"), "file_id", "left")
        rows = made.keep(rows.withColumns({"validation": reports.validation(not t.validate), "settings": settings(c)}))
        # a file that could not be written has no sidecar; one that does not hold says so in its own
        told = rows.where("status <> 'failed' OR error LIKE 'invalid output%'")
        lost = made.keep(documented(told.join(reports.sidecar(told), "file_id"))).where("side_error IS NOT NULL")
        rows = rows.join(lost, "file_id", "left")
        now = F.unix_timestamp().cast("double")
        new = rows.select(
            F.col("path").alias("input_path"), F.col("out_path").alias("output_path"), "sidecar_path", F.when(F.col("side_error").isNull(), F.col("status")).otherwise("failed").alias("status"), F.coalesce("error", "side_error").alias("error"),
            F.col("duration").alias("duration_sec"), "elapsed_sec", F.col("num_words").cast("long").alias("num_words"), F.size("entities").cast("long").alias("num_entities"), F.size("spans").cast("long").alias("num_spans"),
            (F.col("valid") & F.col("side_error").isNull()).alias("valid"), F.col("began").alias("started_at"), (F.col("began") + F.col("elapsed_sec")).alias("updated_at"),
        )
        old = ok.join(skipped, "file_id").select(F.col("path").alias("input_path"), F.col("out_path").alias("output_path"), "sidecar_path", F.lit("skipped_existing").alias("status"), F.col("duration").alias("duration_sec"), F.lit(True).alias("valid"), now.alias("started_at"), now.alias("updated_at"))
        bad = probed.where("status <> 'ok'").select(F.col("path").alias("input_path"), "status", "error", F.lit(False).alias("valid"), now.alias("started_at"), now.alias("updated_at"))
        out = new.unionByName(old, allowMissingColumns=True).unionByName(bad, allowMissingColumns=True)
        out = made.keep(out.select(*(f.split()[0] for f in state.STATUS_SCHEMA.split(", "))))
        out.write.mode("append").parquet(log)
        if t.delete_results and t.schedule == "model_major":
            store.result_store(f"{Path(c.paths.work_dir).resolve()}/{RESULTS}").delete(out.where("valid").select("input_path"))
        made.clear(but=out)
        return out
    except BaseException:
        made.clear()
        raise


def options(argv: list[str] | None = None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="hushwire", description="Mask personal data in recorded speech.")
    p.add_argument("--config", required=True)
    p.add_argument("--stage", default="all", choices=["all", "manifest", "process", "write-default-config"])
    p.add_argument("--profile", choices=cfg.PROFILES)
    p.add_argument("--input-root")
    p.add_argument("--output-root")
    p.add_argument("--no-resume", action="store_true")
    p.add_argument("--no-validate", action="store_true")
    p.add_argument("--delete-results-after", action="store_true", help="delete kept recogniser results of files that are done")
    p.add_argument("--schedule", choices=["file_major", "model_major"])
    p.add_argument("--input-strategy", choices=["single_decode", "temp_wav"])
    p.add_argument("--residency", choices=["keep_loaded", "unload_after_file"])
    for name in ("limit", "shard-index", "shard-count", "file-batch"):
        p.add_argument(f"--{name}", type=int)
    p.add_argument("--decoded-gb", type=float)
    p.add_argument("--enable-engines", type=partial(str.split, sep=","))
    p.add_argument("--disable-engines", type=partial(str.split, sep=","))
    return p.parse_args(argv)


def configured(o: argparse.Namespace) -> cfg.Config:
    """The file's values, then the profile's (one named here stands for the file's), then what is named here."""
    values = {} if o.stage == "write-default-config" else cfg.read(o.config)
    c = cfg.load(cfg.merged(values, {"runtime": {"profile": o.profile}} if o.profile else {}))
    given = lambda **names: {k: v for k, v in names.items() if v is not None}
    c = replace(
        c, paths=replace(c.paths, **given(input_root=o.input_root, output_root=o.output_root)), recognisers=replace(c.recognisers, **given(input=o.input_strategy, residency=o.residency)),
        runtime=replace(c.runtime, **given(limit=o.limit, shard_index=o.shard_index, shard_count=o.shard_count, file_batch=o.file_batch, decoded_gb=o.decoded_gb, schedule=o.schedule, resume=False if o.no_resume else None, validate=False if o.no_validate else None, delete_results=True if o.delete_results_after else None)),
    )
    return cfg.with_engines(c, o.enable_engines, o.disable_engines)


def main(argv: list[str] | None = None, spark: SparkSession | None = None, port: Callable = media.probe_command, **edges: Callable) -> DataFrame | None:
    """Run the stages asked for; edges: recognise, decode and encode in place of the defaults."""
    o = options(argv)
    c = configured(o)
    Path(c.paths.work_dir).mkdir(parents=True, exist_ok=True)
    cfg.dump(c, f"{c.paths.work_dir}/effective_config.json")
    if o.stage == "write-default-config":
        cfg.dump(c, o.config)
        return None
    spark = spark or SparkSession.builder.appName("hushwire").getOrCreate()
    place = f"{Path(c.paths.work_dir).resolve()}/manifest"
    if o.stage in ("all", "manifest"):
        manifest(spark, c, port).write.mode("overwrite").parquet(f"{place}/table")
        found = spark.read.parquet(f"{place}/table")
        io.write_manifest(found, place)
    if o.stage == "manifest":
        return found
    return process(spark, c, spark.read.parquet(f"{place}/table"), port=port, **edges)


if __name__ == "__main__":
    main()
