"""From entities to masked time spans."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


#: Characters of a block of a text: entities and words meet in the blocks that they reach into.
BLOCK = 64


def _in_blocks(df: DataFrame, start: str, end: str) -> DataFrame:
    """df with a row for every block (_block) that start..end reaches into, and one at least."""
    first = F.coalesce(F.floor(F.col(start) / BLOCK), F.lit(0))
    return df.withColumn("_block", F.explode(F.sequence(first, F.greatest(first, F.floor((F.col(end) - 1) / BLOCK)))))


def entity_spans(entities: DataFrame, words: DataFrame, keys: list[str], pad: float = 0.12, least: float = 0.3, tasks: int | None = None) -> DataFrame:
    """Time span of every entity from the words it overlaps: padded, clamped to the duration, then widened to
    the least length.  start_sec and end_sec are null for entities that overlap no word.  Entities and words are
    joined by key and block of the text, so a long text is spread over tasks and no row meets all its words.
    tasks: over how many, where the caller knows the number of rows; what a task sorts then does not grow with them."""
    deal = lambda df, *c: df.repartition(tasks, *c) if tasks else df
    names = entities.columns
    held = entities.select(*keys, F.struct(*names).alias("_row"), F.monotonically_increasing_id().alias("_eid"), F.col("start").alias("_a"), F.col("end").alias("_b"))
    near = _in_blocks(words.select(*keys, "w_start", "w_end", "start_char", "end_char").where("start_char IS NOT NULL AND end_char IS NOT NULL"), "start_char", "end_char")
    near = near.withColumnsRenamed({k: f"_w_{k}" for k in (*keys, "_block")})
    hit = (F.col("end_char") > F.col("_a")) & (F.col("start_char") < F.col("_b"))
    # only words that are hit leave the join: each brings its entity's row into the sort of the aggregation
    same = [F.col(k) == F.col(f"_w_{k}") for k in (*keys, "_block")]
    asked = deal(_in_blocks(held, "_a", "_b"), *keys, "_block")
    j = asked.join(deal(near, *(f"_w_{k}" for k in (*keys, "_block"))), [*same, hit], "left")
    j = deal(j.select(*keys, "_eid", "_row", "w_start", "w_end", "start_char"), *keys)
    j = j.groupBy(*keys, "_eid").agg(F.first("_row").alias("_row"), F.min("w_start").alias("_from"), F.max("w_end").alias("_to"), F.max(F.col("start_char").isNotNull().cast("int")).alias("_hit"))
    lasting = deal(words.groupBy(*keys).agg(F.max("duration").alias("duration")), *keys)
    j = j.select(*(F.col(f"_row.`{n}`") for n in names), "_from", "_to", "_hit").join(lasting, keys, "left")
    met = F.col("_hit") == 1
    j = j.withColumn("lo", F.when(met, F.greatest(F.lit(0.0), F.col("_from") - pad))).withColumn("hi", F.when(met, F.least(F.col("duration"), F.col("_to") + pad)))
    short, mid = (F.col("hi") - F.col("lo")) < least, (F.col("lo") + F.col("hi")) / 2
    lo = F.when(short, F.greatest(F.lit(0.0), mid - least / 2)).otherwise(F.col("lo"))
    j = j.withColumn("start_sec", lo)
    return j.withColumn("end_sec", F.when(short, F.least(F.col("duration"), F.col("start_sec") + least)).otherwise(F.col("hi"))).drop("_from", "_to", "_hit", "lo", "hi")


def unmapped_spans(entities: DataFrame, keys: list[str]) -> DataFrame:
    """Where no entity of a file has a span: the whole channel, with the entities' texts joined."""
    texts = F.array_sort(F.collect_list(F.struct("ord", "text")))
    joined = F.array_join(F.filter(F.transform(texts, lambda t: t["text"]), lambda t: t != ""), " | ")
    return entities.groupBy(*keys).agg(F.max("duration").alias("end_sec"), F.substring(joined, 1, 500).alias("text")).withColumn("start_sec", F.lit(0.0))


def failsafe_spans(files: DataFrame, output_channels: int = 2) -> DataFrame:
    """The whole of every channel of files without a transcript."""
    n = F.greatest(F.lit(1), F.least(F.coalesce(F.nullif(F.col("channels"), F.lit(0)), F.lit(2)), F.lit(output_channels)))
    return files.select(
        "file_id", F.explode(F.sequence(F.lit(0), n - 1)).alias("channel"), F.lit(0.0).alias("start_sec"), F.greatest(F.lit(0.0), F.col("duration")).alias("end_sec"), F.lit("EMPTY_TRANSCRIPT_FAILSAFE").alias("type")
    )


def merge_spans(spans: DataFrame, file: str = "file_id", gap: float = 0.05, both: bool = False) -> DataFrame:
    """Gaps and islands: in order of channel, start and end, a span that begins more than `gap` after the
    furthest end so far begins a new one.  A merged span keeps its first row's type and text and lists
    all types, sources and non-empty texts.  both: all channels as one (-1)."""
    s = spans.withColumn("channel", F.lit(-1)) if both else spans
    by = Window.partitionBy(file, "channel").orderBy("start", "end", "ord")
    far = F.max("end").over(by.rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.when(far.isNull() | (F.col("start") > far + gap), 1).otherwise(0)
    s = s.withColumn("fresh", fresh).withColumn("island", F.sum("fresh").over(by)).withColumn("pos", F.row_number().over(by))
    texts = F.array_sort(F.collect_list(F.struct("pos", "text")))
    g = s.groupBy(file, "channel", "island").agg(
        F.min_by("start", "pos").alias("start"), F.max("end").alias("end"), F.count("*").alias("n"), F.min_by("type", "pos").alias("type"),
        F.array_join(F.array_sort(F.collect_set("type")), ",").alias("types"), F.array_join(F.array_sort(F.collect_set("source")), ",").alias("sources"),
        texts.alias("ts"), F.min_by("duration", "pos").alias("first_duration"),
    )
    kept = F.filter("ts", lambda t: (t["pos"] == F.col("ts")[0]["pos"]) | (t["text"] != ""))
    return g.withColumn("texts", F.array_join(F.transform(kept, lambda t: t["text"]), "|")).withColumn("duration", F.when(F.col("n") > 1, F.col("end") - F.col("start")).otherwise(F.col("first_duration"))).drop("ts", "first_duration")
