"""Replaceable edges: recognisers and taggers, by name.  What stands here are deterministic stubs; real ones
are engines and taggers of hushwire.workers, whose loaders make the model once for each worker process, or
functions over tables that take and return the same columns.  Codecs and probes are in
hushwire.sources.media."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hushwire.functions.patterns import ENTITY_LABELS, lookup
from hushwire.functions.text import normalize_tag, normalize_type
from hushwire.operators.files import short_error
from hushwire.workers import Engine, Tagger, recognised

RECOGNISERS: dict[str, Callable[[DataFrame], DataFrame]] = {}
TAGGERS: dict[str, Callable[[DataFrame], DataFrame]] = {}
#: Engines and taggers that hold a model in the workers.
ENGINES: dict[str, Engine] = {}
MODELS: dict[str, Tagger] = {}
#: What a tagger gives for a chunk: places within it, its label and score.
RAW = "key, start, chunk, label, from, to, score"


def recogniser(name: str):
    def add(f):
        RECOGNISERS[name] = f
        return f

    return add


def tagger(name: str):
    def add(f):
        TAGGERS[name] = f
        return f

    return add


@recogniser("stub")
def stub_recogniser(audio: DataFrame) -> DataFrame:
    """Gives back the `script` column as the transcript; an error row where there is none."""
    return audio.select("file_id", "channel", F.lit("stub").alias("engine"), "script", F.when(F.col("script").isNull(), "Error").alias("error")).withColumnRenamed("script", "transcript")


def failed(audio: DataFrame, name: str, error: str) -> DataFrame:
    """An error row of one engine for every file and channel."""
    return audio.select("file_id", "channel", F.lit(name).alias("engine"), F.lit(None).cast("string").alias("transcript"), short_error(F.lit(error)).alias("error"))


def transcribe(audio: DataFrame, engines: list[str]) -> DataFrame:
    """All engines' rows, each engine in one pass of its own; one that is not there gives error rows and no exception."""

    def of(n: str) -> DataFrame:
        if n in ENGINES:
            return recognised(audio, ENGINES[n]).drop("retried")
        return (RECOGNISERS[n](audio) if n in RECOGNISERS else failed(audio, n, "NotInstalled"))

    rows = [of(n).withColumn("engine_ord", F.lit(i)) for i, n in enumerate(engines)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), rows)


def taggers(names: tuple[str, ...]) -> tuple[Tagger, ...]:
    """The taggers of these names; one that is not there is an error, for its entities would be missed."""
    missing = [n for n in names if n not in MODELS]
    if missing:
        raise ValueError(f"unknown taggers: {', '.join(missing)}")
    return tuple(MODELS[n] for n in names)


@tagger("stub_zero_shot")
def stub_zero_shot(chunks: DataFrame) -> DataFrame:
    """Marks every capitalised word that follows "mr" or "mrs" as a person name."""
    found = chunks.withColumn("m", F.explode(F.expr(r"regexp_extract_all(chunk, '(?i:\\bmrs?\\.? )([A-Z][a-z]+)', 1)")))
    at = F.expr("instr(chunk, m) - 1")
    return found.select("key", "start", "chunk", F.lit("person name").alias("label"), at.alias("from"), (at + F.length("m")).alias("to"), F.lit(0.9).alias("score"))


def kept_tags(raw: DataFrame, texts: DataFrame, kind: str, least: float = 0.5) -> DataFrame:
    """Entities (key, text, type, start, end, score, source) from a tagger's raw rows (see RAW) on chunks of
    texts (key, text).  Of kind zero_shot labels are normalised and scores taken as they are; of kind token
    scores under `least` and unknown labels go; of kind ner labels outside the short list go and the score
    is 0.6.  Places are moved by the chunk's, ends are held to the text, empty places go."""
    types = {"zero_shot": normalize_type(F.col("label")), "token": normalize_tag(F.col("label")), "ner": lookup(ENTITY_LABELS, F.col("label"))}
    missing = 0 if kind == "zero_shot" else -1
    j = raw.join(texts.select("key", F.col("text").alias("whole")), "key").withColumns({"type": types[kind], "a": F.coalesce("from", F.lit(missing)), "b": F.coalesce("to", F.lit(missing))})
    j = j.withColumn("a", F.col("start") + F.col("a")).withColumn("b", F.least(F.col("start") + F.col("b"), F.length("whole")))
    j = j.where((F.col("a") >= 0) & (F.col("b") > F.col("a")) & F.col("type").isNotNull())
    if kind == "token":
        j = j.where(F.coalesce("score", F.lit(0.0)) >= least)
    score = F.lit(0.6) if kind == "ner" else F.coalesce("score", F.lit(0.0))
    return j.select("key", F.expr("substring(whole, a + 1, b - a)").alias("text"), "type", F.col("a").cast("int").alias("start"), F.col("b").cast("int").alias("end"), score.alias("score"), F.lit(kind).alias("source"))


def tagged(texts: DataFrame, chunks: DataFrame, taggers: dict[str, str]) -> DataFrame | None:
    """Entities of all taggers (name to kind) over the chunks of texts; one that is not there adds nothing;
    None where none is."""
    found = [kept_tags(TAGGERS[name](chunks), texts, kind) for name, kind in taggers.items() if name in TAGGERS]
    return reduce(DataFrame.unionByName, found) if found else None
