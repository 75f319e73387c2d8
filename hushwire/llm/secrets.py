"""Secret scans in DataFrame functions alone.

Fixed patterns give the base spans.  Besides, candidate strings, or what base spans leave of them, are slid
over by a window in which the Shannon entropy of the characters is kept incrementally: the entering and the
leaving character each change the sum of c * log2(c) over the window's counts c.  A candidate whose largest
window entropy reaches its character class's threshold is a span, unless an allow-list covers it.
"""

from __future__ import annotations

from math import log2

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hushwire.llm.common import table

#: Kinds in their order, with pattern, and the group and least length that a match must have.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
#: Candidates of the entropy scan: long runs.  The look-behind spares attempts within a run.
CANDIDATE = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}"
WINDOW = 20
#: Least window entropy in bits by character class: the first class that a candidate is of decides.  Without
#: digits a candidate must hold both cases and hardly repeat a character, for words are of this class too.
CLASSES = (
    ("rlike(z.s, '^[0-9a-fA-F]+$')", 3.0),
    ("NOT rlike(z.s, '[0-9]') AND NOT (rlike(z.s, '[a-z]') AND rlike(z.s, '[A-Z]'))", 99.0),
    ("NOT rlike(z.s, '[0-9]')", 4.1),
    ("rlike(z.s, '^([0-9a-z]+|[0-9A-Z]+)$')", 3.8),
    ("true", 3.9),
)
#: Whole candidates that are no secrets: UUIDs, decimal numbers, rulers; and marks of placeholders.
ALLOWED = r"^([0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}|[0-9_/+=-]+|[=_+/-]*)$|(?i:example|sample|placeholder|dummy|xxxx|0123456789|abcdefgh|lorem|test)"

SPAN = "array<struct<start:int,rank:int,kind:string,stop:int,s:string>>"


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"


#: Matches whose lengths are summed one by one; longer lists go by sums of so many.
BLOCK = 256


def _let(value: str, name: str, body: str) -> str:
    """body with name bound to value once."""
    return f"transform(array({value}), {name} -> {body})[0]"


def matches(text: str, pattern: str, kind: str, rank: int, group: int = 0, least: int = 0) -> Column:
    """Spans of leftmost non-overlapping matches in column `text`, in code points.  Pieces between the
    matches and the matches themselves add up to the offsets, by blocks, so that work stays near linear in
    the number of matches; matches whose group is too short are stepped over.  The pattern runs once
    where it never matches."""
    p = _quoted(pattern)
    found = f"named_struct('m', regexp_extract_all({text}, {p}, 0), 'p', split({text}, {p}, -1), 'g', regexp_extract_all({text}, {p}, {group}))"
    lengths = "zip_with(slice(x.p, 1, size(x.m)), x.m, (c, d) -> length(c) + length(d))"
    blocks = f"""aggregate(sequence(0, size(l) DIV {BLOCK}), named_struct('at', 0, 'out', CAST(array() AS array<int>)),
        (a, k) -> named_struct('at', a.at + aggregate(slice(l, CAST(k * {BLOCK} + 1 AS int), {BLOCK}), 0, (c, d) -> c + d), 'out', concat(a.out, array(a.at))), a -> a.out)"""
    start = f"b[CAST(i DIV {BLOCK} AS int)] + aggregate(slice(l, CAST(i DIV {BLOCK} * {BLOCK} + 1 AS int), i % {BLOCK}), 0, (c, d) -> c + d) + length(x.p[i])"
    span = _let(start, "s", f"named_struct('start', s, 'rank', {rank}, 'kind', '{kind}', 'stop', s + length(m), 's', m)")
    spans = f"filter(transform(x.m, (m, i) -> {span}), (z, i) -> length(x.g[i]) >= {least})"
    return F.expr(f"CASE WHEN rlike({text}, {p}) THEN {_let(found, 'x', _let(lengths, 'l', _let(blocks, 'b', spans)))} ELSE CAST(array() AS {SPAN}) END")


def uncovered(found: str, base: str) -> Column:
    """What base spans (in order) leave of the candidates, in parts as long as the window at least."""
    part = "named_struct('start', {0}, 'rank', z.rank, 'kind', z.kind, 'stop', {1}, 's', substring(z.s, {0} - z.start + 1, {1} - {0}))".format
    add = f"CASE WHEN {{1}} - {{0}} >= {WINDOW} THEN concat(a.out, array({part('{0}', '{1}')})) ELSE a.out END".format
    cut = f"""aggregate(filter({base}, b -> b.start < z.stop AND z.start < b.stop), named_struct('at', z.start, 'out', CAST(array() AS {SPAN})),
        (a, b) -> named_struct('at', greatest(a.at, b.stop), 'out', {add('a.at', 'b.start')}), a -> {add('a.at', 'z.stop')})"""
    return F.expr(f"flatten(transform({found}, z -> CASE WHEN exists({base}, b -> b.start < z.stop AND z.start < b.stop) THEN {cut} ELSE array(z) END))")


def entropy_spans(found: str) -> Column:
    """The candidates (a column of spans) whose sliding window's entropy reaches the threshold."""
    # one more of a character that the window holds n times adds gain[n] to the sum of c * log2(c)
    gain = "array(" + ", ".join(f"{(n + 1) * log2(n + 1) - (n * log2(n) if n else 0)}D" for n in range(WINDOW + 1)) + ")"
    times = "length(a.w) - length(replace(a.w, {0}, ''))".format
    full = f"length(a.w) >= {WINDOW}"
    # the window w gains the character c and loses its first; nothing changes where they are the same
    step = f"CASE WHEN {full} AND startswith(a.w, c) THEN 0D ELSE g[{times('c')}] - CASE WHEN {full} THEN g[{times('left(a.w, 1)')} - 1] ELSE 0D END END"
    best = f"CASE WHEN {full} THEN greatest(a.best, log2({WINDOW}D) - a.t / {WINDOW}) ELSE a.best END"
    widest = f"""aggregate(split(z.s, ''), named_struct('w', '', 't', 0D, 'best', 0D),
        (a, c) -> named_struct('w', concat(CASE WHEN {full} THEN substring(a.w, 2) ELSE a.w END, c), 't', a.t + {step}, 'best', {best}), a -> {best})"""
    limit = "CASE " + " ".join(f"WHEN {test} THEN {bits}D" for test, bits in CLASSES) + " END"
    return F.expr(_let(gain, "g", f"filter({found}, z -> NOT rlike(z.s, {_quoted(ALLOWED)}) AND {limit} < 99 AND {widest} >= {limit})"))


def _listed(column: str) -> Column:
    return F.array_join(F.transform(column, lambda z: F.concat_ws(":", z["kind"], z["start"].cast("string"), z["stop"].cast("string"))), ",")


def secret_spans(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with `_base` and `_all`, arrays of spans (start, rank, kind, stop, s) in order.  A null text
    counts as empty and has no spans.  Rows are independent: repeated rows, ties and extra columns need
    no care, but for columns whose names begin with an underscore, which are reserved; an empty table gives
    an empty result.  A very long text is scanned whole, in time near linear in its length."""
    t = docs.withColumn("_text", F.coalesce(F.col(text).cast("string"), F.lit("")))
    t = t.withColumns(
        {
            "_assign": matches("_text", ASSIGN, "assign", 0, 2, 8),
            "_access": matches("_text", ACCESS, "access", 1),
            "_hex": matches("_text", HEX, "hex", 2),
            "_found": matches("_text", CANDIDATE, "entropy", 3),
        }
    )
    t = t.withColumn("_base", F.array_sort(F.concat("_assign", "_access", "_hex")))
    t = t.withColumn("_found", F.when(F.size("_base") > 0, uncovered("_found", "_base")).otherwise(F.col("_found")))
    t = t.withColumn("_more", F.when(F.size("_found") > 0, entropy_spans("_found")).otherwise(F.col("_found")))
    return t.withColumn("_all", F.when(F.size("_more") > 0, F.array_sort(F.concat("_base", "_more"))).otherwise(F.col("_base")))


def scan(docs: DataFrame) -> DataFrame:
    """Counts, digest and list of the secrets of every row.  A null text counts as empty; repeated rows each
    give a row; an empty table gives an empty result; extra columns are ignored; long texts are scanned whole."""
    t = secret_spans(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    return t.select(
        "doc_id",
        *(F.size(c).cast("long").alias(f"n{c}") for c in ("_assign", "_access", "_hex")),
        F.sha2(_listed("_base"), 256).alias("base_sha256"),
        _listed("_all").alias("spans"),
    )


def masked(docs: DataFrame, mark: str = "<SECRET>") -> DataFrame:
    """docs with every secret span of `text` replaced by a mark and n_chars brought in line; texts
    without secrets, null ones too, stay as they are; repeated rows each stay; an empty table gives an empty
    result.  Extra columns pass through, whatever their names."""
    t = secret_spans(docs.select(F.struct("*").alias("row"), "text"))
    cover = f"""aggregate(_all, named_struct('at', 0, 'out', ''),
        (a, z) -> CASE WHEN z.stop <= a.at THEN a
          WHEN z.start < a.at THEN named_struct('at', z.stop, 'out', a.out)
          ELSE named_struct('at', z.stop, 'out', concat(a.out, substring(_text, a.at + 1, z.start - a.at), '{mark}')) END,
        a -> concat(a.out, substring(_text, a.at + 1, length(_text))))"""
    hit = F.size("_all") > 0
    t = t.withColumn("_new", F.when(hit, F.expr(cover)).otherwise(F.col("text")))
    out = []
    for c in docs.columns:
        if c == "text":
            out.append(F.col("_new").alias("text"))
        elif c == "n_chars":
            out.append(F.when(hit, F.length("_new")).otherwise(F.col("row.n_chars")).cast("long").alias("n_chars"))
        else:
            out.append(F.col(f"row.`{c}`"))
    return t.select(out)


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of all documents; see scan for nulls, ties, repeats and empty tables."""
    return scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
