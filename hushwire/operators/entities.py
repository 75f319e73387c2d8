"""Rule detection, de-duplication and overlap resolution of entities."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from hushwire.functions import patterns as P
from hushwire.functions import scan
from hushwire.functions.batches import parts
from hushwire.functions.offsets import let, located
from hushwire.functions.text import normalize_type, priority
from hushwire.workers import Tagger, tagged


def rule_entities(text: str, name: str) -> Column:
    """One of the thirteen pattern detectors, with its value checks."""
    n, pattern, group, kind, score, source = next(d for d in P.DETECTORS if d[0] == name)
    found = P.entities(text, pattern, group, kind, score, source)
    if n == "card":
        found = F.filter(found, lambda e: F.length(F.regexp_replace(e["text"], r"\D", "")).between(13, 19))
    if n == "id":
        norm = lambda e: F.regexp_replace(e["text"], "[^A-Za-z0-9]", "")
        found = F.filter(found, lambda e: (F.length(norm(e)) >= 4) & norm(e).rlike("[0-9]"))
    return found


def likely_name(name: Column) -> Column:
    """At most three words of two letters or more, none of them on the list of common words."""
    w = F.split(F.trim(F.lower(name)), r"\s+")
    return (F.size(w) <= 3) & F.forall(w, lambda x: F.length(x) >= 2) & ~F.arrays_overlap(w, F.array(*map(F.lit, P.NAME_BLACKLIST)))


def name_entities(text: str) -> Column:
    """Spoken names; the text of an entity has single spaces, its span is as found."""
    found = F.concat(*(P.entities(text, P.name_pattern(*n), 1, "PERSON_NAME", 0.99, "rule_name") for n in P.NAMES))
    found = F.transform(found, lambda e: e.withField("text", F.regexp_replace(F.trim(e["text"]), r"\s+", " ")))
    return F.filter(found, lambda e: likely_name(e["text"]))


def saved_entities(text: str, saved: str) -> Column:
    """Entities saved as a JSON object with a list `entities` (text, type, category): each PII or PHI text,
    trimmed, is searched for literally, in any case.  What is no such object gives none."""
    listed = "from_json({0}, 'entities array<struct<text:string,type:string,category:string>>').entities".format(saved)
    wanted = f"filter({listed}, e -> upper(e.category) IN ('PII', 'PHI') AND trim(e.text) <> '')"
    # within \Q..\E nothing is special but \E itself
    literal = r"concat('(?iu)\\Q', replace(trim(e.text), '\\E', '\\E\\\\E\\Q'), '\\E')"
    kind = "translate(upper(trim(coalesce(nullif(e.type, ''), 'PII'))), ' -', '__')"
    each = f"named_struct('text', m, 'type', {kind}, 'start', s, 'end', s + length(m), 'score', 1.0D, 'source', 'saved_pii_json')"
    found = F.expr(f"flatten(transform(coalesce({wanted}, CAST(array() AS array<struct<text:string,type:string,category:string>>)), e -> {located(text, literal, each)}))")
    return F.transform(found, lambda e: e.withField("type", normalize_type(e["type"])))


def spoken_entities(text: str) -> Column:
    """Runs of spoken digits: islands of tokens that are separators, digits, number words or repeaters of
    what follows.  Seven digits or more are an entity; under ten they need a hint word nearby.  A fold
    within the row: a text is never dealt out, nor mixed with another of the same key."""
    listed = lambda values: ", ".join(map(P.quoted, values))
    words = "map(" + ", ".join(f"{P.quoted(w)}, {P.quoted(d)}" for w, d in P.NUMBER_WORDS.items()) + ")"
    times = "CASE get(k, i - 1).norm " + " ".join(f"WHEN {P.quoted(w)} THEN {n}" for w, n in P.NUMBER_REPEATERS.items()) + " ELSE 1 END"
    single = lambda c: f"({c} IN ({listed(P.NUMBER_WORDS)}) OR rlike({c}, '^[0-9]$'))"
    digits = "coalesce(try_element_at(w, t.norm), CASE WHEN rlike(t.norm, '^[0-9]+$') THEN t.norm END)"
    ok = f"(t.norm IN ({listed(P.NUMBER_SEPARATORS)}) OR (t.norm IN ({listed(P.NUMBER_REPEATERS)}) AND coalesce({single('get(k, i + 1).norm')}, false)) OR {digits} IS NOT NULL)"
    n = f"coalesce(length({digits}) * CASE WHEN {single('t.norm')} THEN {times} ELSE 1 END, 0)"
    flags = f"transform(k, (t, i) -> named_struct('ok', {ok}, 'n', {n}, 'a', t.start, 'b', t.stop))"
    closed = "CASE WHEN r.n >= 7 THEN concat(r.out, array(named_struct('a', r.a, 'b', r.b, 'n', r.n))) ELSE r.out END"
    runs = f"""aggregate({flags}, named_struct('a', -1, 'b', -1, 'n', 0, 'out', CAST(array() AS array<struct<a:int,b:int,n:int>>)),
        (r, f) -> CASE WHEN f.ok THEN named_struct('a', CASE WHEN r.a < 0 THEN f.a ELSE r.a END, 'b', f.b, 'n', r.n + f.n, 'out', r.out)
          ELSE named_struct('a', -1, 'b', -1, 'n', 0, 'out', {closed}) END, r -> {closed})"""
    left = "greatest(0, r.a - 100)"
    near = f"lower(substring({text}, {left} + 1, r.b + 100 - {left}))"
    each = f"named_struct('text', substring({text}, r.a + 1, r.b - r.a), 'type', CASE WHEN r.n >= 10 THEN 'PHONE' ELSE 'ID_NUMBER' END, 'start', r.a, 'end', r.b, 'score', 0.92D, 'source', 'spoken_number_rule')"
    tokens = located(text, P.quoted(P.TOKEN), TOKEN_OF)
    body = let(words, "w", let(tokens, "k", f"transform(filter({runs}, r -> r.n >= 10 OR rlike({near}, {P.quoted(P.NUMBER_HINTS)})), r -> {each})"))
    return F.expr(f"CASE WHEN rlike({text}, {P.quoted(SPOKEN)}) THEN {body} ELSE CAST(array() AS {P.ENTITY}) END")


#: Without a digit or a number word no number is spoken.
SPOKEN = r"[0-9]|(?i)\b(" + "|".join(P.NUMBER_WORDS) + r")\b"
TOKEN_OF = "named_struct('norm', regexp_replace(lower(m), '[^a-z0-9]+', ''), 'start', s, 'stop', s + length(m))"


def scanned(df: DataFrame, text: str, rules: tuple[str, ...], names: bool = False, spoken: bool = False) -> DataFrame:
    """Entities of a text column by rules, then spoken names, then spoken numbers: the other columns of df with rule, ord
    (the order of detection in a text), text, type, start, end, score and source.  Texts are searched in tasks as they
    come, by parts of bounded bytes; what a value must fulfil is checked on what is found."""
    others = [c for c in df.columns if c != text]
    some = F.col(text).rlike(SPOKEN) if spoken else F.lit(False)
    rows = df.select(*others, F.col(text).alias("_t"), F.coalesce(some, F.lit(False)).alias("_spoken"))
    out = StructType([*df.select(*others).schema.fields, *StructType.fromDDL(SCANNED).fields])
    arrow = to_arrow_schema(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (part for whole in batches for part in parts(whole)):
            rows, held = [], []
            for r, (t, spoken) in enumerate(zip(b.column(len(others)).to_pylist(), b.column(len(others) + 1).to_pylist(), strict=True)):
                if t:
                    own = [*scan.rule_matches(t, rules, names), *(scan.spoken_matches(t) if spoken else ())]
                    held += [(m[0], i, *m[1:]) for i, m in enumerate(own)]
                    rows += [r] * len(own)
            if rows:
                found = [pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), list(arrow)[len(others) :], strict=True)]
                kept = b.take(pa.array(rows, pa.int32()))
                yield pa.RecordBatch.from_arrays([*(c.cast(f.type) for c, f in zip(kept.columns[: len(others)], arrow, strict=False)), *found], schema=arrow)

    found = rows.mapInArrow(run, out)
    found = found.withColumn("text", F.when(F.col("rule") == "name", F.regexp_replace(F.trim("text"), r"\s+", " ")).otherwise(F.col("text")))
    norm = F.regexp_replace("text", "[^A-Za-z0-9]", "")
    good = F.when(F.col("rule") == "card", F.length(F.regexp_replace("text", r"\D", "")).between(13, 19))
    good = good.when(F.col("rule") == "id", (F.length(norm) >= 4) & norm.rlike("[0-9]")).when(F.col("rule") == "name", likely_name(F.col("text")))
    return found.where(good.otherwise(True))


SCANNED = "rule string, ord int, text string, type string, start int, end int, score double, source string"


def spoken_numbers(df: DataFrame, key: str, text: str) -> DataFrame:
    """The spoken numbers of every row, under its key."""
    return scanned(df.select(F.col(key), F.col(text).alias("_text")), "_text", (), spoken=True).drop("rule", "ord")


def dedupe(df: DataFrame, key: list[str]) -> DataFrame:
    """Of entities (rows with ord, the order of detection) with one span and text the best by type
    priority, then score, then order; empty spans go."""
    by = Window.partitionBy(*key, "start", "end", F.lower(F.trim("text"))).orderBy(priority(F.col("type")), F.desc("score"), "ord")
    return df.where("end > start").withColumn("_n", F.row_number().over(by)).where("_n = 1").drop("_n")


def swept(start: list, end: list, rank: list, first: int, last: int) -> list[int]:
    """Places of the entities first..last (in order of their start) that are kept.  Starts only grow, so a kept
    entity that has ended is never met again, and the first that is still open is the first that overlaps."""
    kept, low = [], 0
    for i in range(first, last):
        while low < len(kept) and end[kept[low]] <= start[i]:
            low += 1
        if low == len(kept):
            kept.append(i)
        elif rank[i] < rank[kept[low]]:
            kept[low] = i
    return kept


def resolve(df: DataFrame, key: list[str]) -> DataFrame:
    """Greedy resolution of overlaps, a sweep over the entities of one text by start, length and priority:
    an entity that overlaps kept ones takes the place of the first of them, if it ranks better, else it goes.
    A text's entities are one row, and the work on it is linear in them."""
    e = F.struct("start", (F.col("start") - F.col("end")).alias("neg_len"), priority(F.col("type")).alias("p"), (-F.col("score")).alias("neg_score"), "end", "ord", "type", "text", "score", "source")
    packed = df.groupBy(*key).agg(F.array_sort(F.collect_list(e)).alias("es"))
    out = packed.select(*key, F.inline("es")).select(*key, "text", "type", "start", "end", "score", "source").schema
    arrow = to_arrow_schema(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column(b.num_columns - 1)
            at, held = lists.offsets.to_pylist(), lists.values
            start, end, *parts = (held.field(n).to_pylist() for n in ("start", "end", "p", "neg_score", "neg_len"))
            rank = [(p, s is not None, s or 0.0, n) for p, s, n in zip(*parts, strict=True)]
            kept = [swept(start, end, rank, at[r], at[r + 1]) for r in range(b.num_rows)]
            places, rows = pa.array([i for own in kept for i in own], pa.int64()), pa.array([r for r, own in enumerate(kept) for _ in own], pa.int64())
            columns = [b.column(i).take(rows) for i in range(len(key))] + [held.field(n).take(places) for n in arrow.names[len(key) :]]
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)

    return packed.mapInArrow(run, out)


def detect(
    df: DataFrame, key: str, text: str = "text", saved: str | None = None, detectors: tuple[str, ...] = tuple(d[0] for d in P.DETECTORS), spoken: bool = True,
    taggers: tuple[Tagger, ...] = (), chunk_chars: int = 1800, chunk_overlap: int = 240,
) -> DataFrame:
    """Entities of every text by the chosen rules, spoken numbers, saved annotations (a JSON column) and taggers
    (on chunks), resolved: (key, text, type, start, end, score, source).  Texts that share a key are kept apart."""
    rows = df.select(key, F.col(text).alias("_t"), *([F.col(saved).alias("_s")] if saved else []), F.xxhash64(text).alias("_h"))
    # each text's entities meet once, in the two steps after
    found = scanned(rows.select(key, "_h", "_t"), "_t", detectors, names=True, spoken=spoken).drop("rule")
    if saved:
        # after all rules, as they are listed
        listed = rows.select(key, "_h", F.posexplode(F.coalesce(saved_entities("_t", "_s"), F.array().cast(P.ENTITY))).alias("ord", "e"))
        found = found.unionByName(listed.select(key, "_h", (F.lit(1 << 29) + F.col("ord")).alias("ord"), "e.*"))
    more = tagged(rows.select(key, "_h", "_t").distinct(), taggers, "_t", chunk_chars, chunk_overlap)
    if more is not None:
        # after all rules, in an order of their own
        found = found.unionByName(more.withColumn("ord", F.lit(1 << 30) + F.col("start")))
    return resolve(dedupe(found.repartition(key, "_h"), [key, "_h"]), [key, "_h"]).drop("_h")
