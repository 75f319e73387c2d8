"""Models within tasks: loaded once a worker process, fed with whole batches, and never the end of a job.

An engine turns recordings into transcripts, a tagger finds labels in chunks of text.  Both are given as a
loader; what it returns is called with a list of inputs and returns a list as long.  Batches are filled across Arrow
batches, a batch that fails is tried input by input, and an input that fails is a row with its error (a
tagger's: no labels)."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import udtf
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from hushwire.functions.patterns import ENTITY_LABELS, lookup
from hushwire.functions.text import normalize_tag, normalize_type
from hushwire.operators.words import chunk_bounds

#: Characters of an error that are kept.
TAIL = 4000
#: Models of this process, by name.
_held: dict[str, object] = {}

WORD = "struct<word:string,start:double,end:double>"
RESULT = f"file_id long, channel int, engine string, transcript string, words array<{WORD}>, error string, retried boolean"
TAG = "label string, `from` int, `to` int, score double"


@dataclass(frozen=True)
class Engine:
    """A recogniser.  load() gives a model: list of dicts (path, channel, duration and what else the input has) ->
    list of (transcript, words), words being dicts of word, start and end, or none.  again, if given, loads the
    plain model that rows with suspicious word times are sent through in the same pass."""

    name: str
    load: Callable[[], Callable[[list[dict]], list[tuple]]]
    batch: int = 8
    again: Callable[[], Callable[[list[dict]], list[tuple]]] | None = None
    drift: float = 1.0


@dataclass(frozen=True)
class Tagger:
    """A tagger of one kind (zero_shot, token or ner).  load() gives a model: list of chunks -> list of lists of
    dicts (label, start, end, score)."""

    name: str
    kind: str
    load: Callable[[], Callable[[list[str]], list[list[dict]]]]
    batch: int = 16
    least: float = 0.5


def held(name: str, load: Callable[[], object]) -> object:
    """The process's model of that name, loaded when first asked for."""
    if name not in _held:
        _held[name] = load()
    return _held[name]


def answers(model: Callable[[list], list], inputs: list) -> list[tuple[object, str | None]]:
    """(answer, error) for every input: of the whole batch, or, where that fails or answers are missing, one by one."""
    try:
        out = list(model(inputs))
        if len(out) != len(inputs):
            raise RuntimeError(f"{len(out)} answers for {len(inputs)} inputs")
        return [(a, None) for a in out]
    except Exception:  # a batch that fails says nothing of its inputs
        each = []
        for x in inputs:
            try:
                (a,) = model([x])
                each.append((a, None))
            except Exception as e:  # any failure of an input is that input's row
                each.append((None, repr(e)[:TAIL]))
        return each


def suspicious(words: list[dict] | None, duration: float | None, drift: float) -> bool:
    """Whether some word ends before it starts, or lies outside the recording by more than drift."""
    for w in words or ():
        start = w.get("start") or 0.0
        end = start if w.get("end") is None else w["end"]
        if end < start or start < -drift or (duration is not None and max(start, end) > duration + drift):
            return True
    return False


def _filled(batches: Iterator[pd.DataFrame], size: int) -> Iterator[list[dict]]:
    """Lists of exactly `size` rows (the last may be shorter), whatever Arrow's batches are."""
    waiting: list[dict] = []
    for b in batches:
        for row in b.to_dict("records"):
            waiting.append(row)
            if len(waiting) == size:
                yield waiting
                waiting = []
    if waiting:
        yield waiting


def recognised(inputs: DataFrame, engine: Engine) -> DataFrame:
    """One row (see RESULT) for every row of inputs (file_id, channel, and what the model reads), in their order.
    A model that cannot be loaded gives error rows.  retried: the row is the plain model's."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in _filled(batches, max(1, engine.batch)):
            try:
                found = answers(held(engine.name, engine.load), rows)
            except Exception as e:
                found = [(None, repr(e)[:TAIL])] * len(rows)
            odd = [i for i, (a, _) in enumerate(found) if engine.again and a and suspicious(a[1], _number(rows[i].get("duration")), engine.drift)]
            retried = set()
            for i in odd:
                try:
                    (again,) = answers(held(f"{engine.name}, plain", engine.again), [rows[i]])
                except Exception as e:
                    again = (None, repr(e)[:TAIL])
                found[i] = again
                retried.add(i)
            out = [(r["file_id"], r["channel"], engine.name, a[0] if a else None, _timed(a[1]) if a else None, error, i in retried) for i, (r, (a, error)) in enumerate(zip(rows, found, strict=True))]
            yield pd.DataFrame(out, columns=["file_id", "channel", "engine", "transcript", "words", "error", "retried"])

    return inputs.withColumns({"file_id": F.col("file_id").cast("long"), "channel": F.col("channel").cast("int")}).mapInPandas(run, RESULT)


def _number(v: object) -> float | None:
    return None if v is None or v != v else float(v)


def _timed(words: list[dict] | None) -> list[dict] | None:
    return None if words is None else [{"word": w["word"], "start": _number(w.get("start")), "end": _number(w.get("end"))} for w in words]


@udtf(returnType=StructType([StructField("start", IntegerType()), StructField("chunk", StringType())]))
class Chunks:
    """text -> its chunks with their places (code points); a blank text has none."""

    def eval(self, text: str, most: int, overlap: int):
        if text and text.strip():
            for a, b in chunk_bounds(text, most, overlap):
                if text[a:b].strip():
                    yield a, text[a:b]


def chunked(texts: DataFrame, text: str = "text", most: int = 1800, overlap: int = 240) -> DataFrame:
    """texts without their text, a row for every chunk (start, chunk) of it: the table function is called
    laterally, so a text's chunks stay on its task and nothing is shuffled."""
    kept = [c for c in texts.columns if c != text]
    return texts.lateralJoin(Chunks(F.col(text).outer(), F.lit(most), F.lit(overlap))).select(*kept, "start", "chunk")


def labelled(chunks: DataFrame, tagger: Tagger) -> DataFrame:
    """chunks (any columns, chunk) with every label (see TAG) that the tagger gives for them."""
    kind = f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in chunks.schema)}, {TAG}"
    names = [*chunks.columns, "label", "from", "to", "score"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in _filled(batches, max(1, tagger.batch)):
            try:
                found = answers(held(tagger.name, tagger.load), [r["chunk"] for r in rows])
            except Exception:  # a tagger that cannot be loaded adds nothing
                found = [(None, "")] * len(rows)
            out = [(*r.values(), t.get("label"), t.get("start"), t.get("end"), t.get("score")) for r, (tags, _) in zip(rows, found, strict=True) for t in tags or ()]
            yield pd.DataFrame(out, columns=names).astype({"from": "Int32", "to": "Int32"})

    return chunks.mapInPandas(run, kind)


def placed(tags: DataFrame, kind: str, least: float) -> DataFrame:
    """tags (start, chunk, label, from, to, score and others) as entities of the whole text (the others, then
    text, type, start, end, score, source).  Labels are normalised by kind and unknown ones dropped, weak tokens
    too, a ner tagger's score is 0.6; places are moved by the chunk's and held to the chunk, empty ones go.
    What overlapping chunks both report is one entity, with the better score."""
    others = [c for c in tags.columns if c not in ("start", "chunk", "label", "from", "to", "score")]
    types = {"zero_shot": normalize_type(F.col("label")), "token": normalize_tag(F.col("label")), "ner": lookup(ENTITY_LABELS, F.col("label"))}
    missing = F.lit(0 if kind == "zero_shot" else -1)
    t = tags.withColumns({"type": types[kind], "a": F.coalesce("from", missing), "b": F.least(F.coalesce("to", missing), F.length("chunk")), "score": F.coalesce("score", F.lit(0.0))})
    t = t.where("a >= 0 AND b > a AND type IS NOT NULL" + (f" AND score >= {least}" if kind == "token" else ""))
    score = F.lit(0.6) if kind == "ner" else F.col("score")
    t = t.select(*others, F.expr("substring(chunk, a + 1, b - a)").alias("text"), "type", (F.col("start") + F.col("a")).alias("start"), (F.col("start") + F.col("b")).alias("end"), score.alias("score"))
    return t.groupBy(*others, "text", "type", "start", "end").agg(F.max("score").alias("score")).withColumn("source", F.lit(kind))


def tagged(texts: DataFrame, taggers: tuple[Tagger, ...], text: str = "text", most: int = 1800, overlap: int = 240) -> DataFrame | None:
    """Entities that the taggers find in texts, under all its other columns; None without taggers."""
    out = None
    for t in taggers:
        found = placed(labelled(chunked(texts, text, most, overlap), t), t.kind, t.least)
        out = found if out is None else out.unionByName(found)
    return out
