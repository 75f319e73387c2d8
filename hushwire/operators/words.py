"""Timed words: repair, canonical transcripts, alignment, chunks, and the bundles of a channel.

Words are rows with file_id, channel and ord (their order in the channel) unless said otherwise."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from hushwire.functions.batches import parts
from hushwire.functions.runs import common_runs
from hushwire.functions.text import normalize_token, tokens

KEYS = ["file_id", "channel"]


# ---- times


def clamped(words: DataFrame, drift: float = 1.0, ordered: bool = True) -> DataFrame:
    """words with start and end brought into 0..duration and end not before start; `suspicious` marks an
    end before its start (if ordered), or a time further out than drift.  A null duration bounds nothing."""
    raw_start = F.coalesce("start", F.lit(0.0))
    raw_end = F.coalesce("end", raw_start)
    most = F.greatest(F.lit(0.0), F.col("duration"))
    held = F.greatest(raw_end, raw_start)
    start = F.when(F.col("duration").isNull(), raw_start).otherwise(F.least(F.greatest(F.lit(0.0), raw_start), most))
    end = F.when(F.col("duration").isNull(), held).otherwise(F.least(F.greatest(start, held), most))
    far = F.coalesce((raw_start < -drift) | (F.coalesce("end", raw_start) > F.col("duration") + drift), F.lit(False))
    odd = (raw_end < raw_start) | far | F.coalesce(held > F.col("duration") + drift, F.lit(False)) if ordered else far
    return words.withColumns({"start": start, "end": end, "suspicious": odd})


def interpolated(segments: DataFrame, drift: float = 1.0) -> DataFrame:
    """Words of segments (file_id, channel, segment_id, start, end, text, duration) without word times:
    the segment's time, at least 0.01 s, is dealt evenly to its words."""
    held = clamped(segments, drift, ordered=False)
    parts = F.filter(F.split(F.trim("text"), r"\s+"), lambda w: w != "")
    n = F.size("_words")
    span = F.greatest(F.lit(0.01), F.col("end") - F.col("start"))
    dealt = held.withColumn("_words", parts).withColumn("_span", span).withColumn("_n", n)
    dealt = dealt.select(*KEYS, "segment_id", F.col("start").alias("_from"), "_span", "_n", "suspicious", F.posexplode("_words").alias("i", "word"))
    at = lambda k: F.col("_from") + F.col("_span") * k / F.col("_n")
    return dealt.select(*KEYS, "segment_id", "i", "word", at(F.col("i")).alias("start"), at(F.col("i") + 1).alias("end"), "suspicious")


# ---- canonical transcripts


def canonical_words(words: DataFrame) -> DataFrame:
    """Trimmed words without blank ones, with their places (start_char, end_char) in the transcript that
    joins them by single spaces."""
    before = Window.partitionBy(*KEYS).orderBy("ord").rowsBetween(Window.unboundedPreceding, -1)
    kept = words.withColumn("word", F.trim("word")).where("word <> ''")
    start = F.coalesce(F.sum(F.length("word") + 1).over(before), F.lit(0)).cast("int")
    return kept.withColumn("start_char", start).withColumn("end_char", F.col("start_char") + F.length("word"))


def canonical_transcript(words: DataFrame) -> DataFrame:
    """One row a channel: its transcript and number of words."""
    kept = words.withColumn("word", F.trim("word")).where("word <> ''")
    said = F.array_sort(F.collect_list(F.struct("ord", "word")))
    return kept.groupBy(*KEYS).agg(F.array_join(said["word"], " ").alias("transcript"), F.count("*").alias("word_count"))


# ---- alignment


def alike(a: str, b: str) -> bool:
    """Whether one token may stand for another: equal, or either all digits.  Two different tokens share no
    word, and what their characters add to the similarity (0.35 at most) never reaches the 0.55 asked."""
    return a == b or a.isdigit() or b.isdigit()


def matched(said: list[str], timed: list[str]) -> list[tuple[int, int]]:
    """Pairs of positions of two token lists that correspond: equal runs, and replaced runs of one length
    where the tokens are alike.  What was put in or left out has no partner."""
    pairs, i0, j0 = [], 0, 0
    for i, j, k in [*common_runs(said, timed), (len(said), len(timed), 0)]:
        if i - i0 == j - j0:
            pairs += [(x, y) for x, y in zip(range(i0, i), range(j0, j), strict=True) if alike(said[x], timed[y])]
        pairs += zip(range(i, i + k), range(j, j + k), strict=True)
        i0, j0 = i + k, j + k
    return pairs


ALIGNED = "file_id long, channel int, word string, start_char int, end_char int, start double, end double, anchor_word string"


def align(transcripts: DataFrame, anchors: DataFrame) -> DataFrame:
    """Times for transcripts (file_id, channel, transcript) from the anchor's words (with start, end):
    one row for every token that an anchor word corresponds to.  Channels are dealt to tasks by key; one
    channel's words are compared at a time."""
    said = transcripts.select(*KEYS, F.transform(tokens("transcript"), lambda t: F.struct(t["token"].alias("word"), t["norm"].alias("norm"), t["start"].alias("a"), t["stop"].alias("b"))).alias("said"))
    timed = anchors.withColumn("norm", normalize_token(F.trim("word"))).where("norm <> ''")
    start = F.coalesce("start", F.lit(0.0))
    timed = timed.withColumn("start", start).withColumn("end", F.greatest("start", F.coalesce("end", "start")))
    timed = timed.groupBy(*KEYS).agg(F.array_sort(F.collect_list(F.struct("ord", "word", "norm", "start", "end"))).alias("timed"))

    arrow = to_arrow_schema(StructType.fromDDL(ALIGNED))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in parts(whole, 1 << 20)):
            rows = []
            for file_id, channel, own, other in batch.to_pandas().itertuples(index=False):
                own, other = list(own), list(other)
                for i, j in matched([t["norm"] for t in own], [t["norm"] for t in other]):
                    t, w = own[i], other[j]
                    rows.append((file_id, channel, t["word"], t["a"], t["b"], w["start"], w["end"], w["word"]))
            columns = zip(*rows, strict=True) if rows else [[] for _ in arrow]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)

    both = said.join(timed, KEYS).select(F.col("file_id").cast("long"), F.col("channel").cast("int"), "said", "timed")
    return both.mapInArrow(run, ALIGNED)


# ---- chunks


def chunk_bounds(text: str, most: int = 1800, overlap: int = 240) -> list[tuple[int, int]]:
    """Spans of at most `most` (256 or more) characters that cover text.  A span ends after the last
    space, full stop, comma or semicolon of its second half, if there is one; the next begins `overlap`
    characters (half of `most` at most) before that end, later where that would split a word."""
    most, n = max(256, most), len(text)
    overlap = min(max(0, overlap), most // 2)
    spans, at = [], 0
    while n - at > most:
        stops = (text.rfind(c, at + most // 2, at + most) for c in " .,;")
        last = max(stops)
        end = at + most if last < 0 else last + 1
        spans.append((at, end))
        back = end - overlap
        at = back if back > at else end
        while at < n and text[at - 1].isalnum() and text[at].isalnum():
            at += 1
    return [*spans, (at, n)] if at < n or not spans else spans


def text_chunks(df: DataFrame, key: str, text: str = "text", most: int = 1800, overlap: int = 240) -> DataFrame:
    """key, start (code points), chunk for every span of a text that is not blank; a text that fits is
    one chunk, an empty or null one too."""
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in parts(whole)):
            rows, starts, chunks = [], [], []
            for i, t in enumerate(batch.column(1).to_pylist()):
                spans = chunk_bounds(t or "", most, overlap)
                for a, b in spans:
                    if len(spans) == 1 or t[a:b].strip():
                        rows.append(i)
                        starts.append(a)
                        chunks.append(t[a:b] if t else "")
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows, pa.int64())), pa.array(starts, pa.int32()), pa.array(chunks, pa.string())], names=["key", "start", "chunk"])

    return df.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(run, f"key {kind}, start int, chunk string").withColumnRenamed("key", key)


# ---- bundles


def has_words(c: str = "words") -> Column:
    return F.coalesce(F.size(c), F.lit(0)) > 0


def bundles(inputs: DataFrame, results: DataFrame, chosen: DataFrame, anchor: str) -> DataFrame:
    """One row for every (file_id, channel) of the inputs or of the results (engine, engine_ord, transcript,
    words, error): the results in order; the anchor engine, which is the named one if it has words, else the
    first that has; and where the final text's word times come from: `selected` if the chosen engine
    has words for that very text, else `anchor` if its text is the same, else `aligned`, else `none`.
    chosen: file_id, channel, selected_engine, final_transcript."""
    timed = F.when(has_words(), F.struct((F.col("engine") != anchor).alias("other"), "engine_ord", "engine", F.trim("transcript").alias("text")))
    per = results.groupBy(*KEYS).agg(
        F.array_sort(F.collect_list(F.struct("engine_ord", "engine", "transcript", "words", "error"))).alias("engine_results"),
        F.min(timed).alias("_anchor"),
    )
    every = inputs.select(*KEYS).distinct().join(per, KEYS, "full_outer").join(chosen, KEYS, "left")
    final = F.trim(F.coalesce("final_transcript", F.lit("")))
    own = F.exists("engine_results", lambda r: (r["engine"] == F.col("selected_engine")) & (F.coalesce(F.size(r["words"]), F.lit(0)) > 0) & (F.trim(r["transcript"]) == final))
    source = F.when(own, "selected").when(F.col("_anchor.text") == final, "anchor").when(F.col("_anchor").isNotNull() & (final != ""), "aligned").otherwise("none")
    return every.select(
        *KEYS, final.alias("final_transcript"), "selected_engine", F.col("_anchor.engine").alias("anchor_engine"), source.alias("words_from"), F.coalesce("engine_results", F.array()).alias("engine_results"),
    )


def anchored_files(results: DataFrame, anchor: str) -> DataFrame:
    """Files of which every channel has a result of the anchor engine with words and without an error."""
    good = (F.col("engine") == anchor) & has_words() & (F.coalesce("error", F.lit("")) == "")
    channels = results.groupBy(*KEYS).agg(F.bool_or(F.coalesce(good, F.lit(False))).alias("ok"))
    return channels.groupBy("file_id").agg(F.bool_and("ok").alias("ok")).where("ok").select("file_id")
