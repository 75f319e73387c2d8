"""Text normalisers, rates of agreement and small scalar functions; edit distances are hushwire.functions.distance's."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from hushwire.functions.distance import distances, rate
from hushwire.functions.offsets import located
from hushwire.functions.patterns import TAGGER_LABELS, TOKEN, TYPE_ALIASES, TYPE_PRIORITY, lookup, quoted


def normalize_token(c: Column) -> Column:
    return F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), "[^a-z0-9]+", "")


def normalize_for_consensus(c: Column) -> Column:
    """Lower case, curly and grave quotes as ', all between letters, digits and quotes a single space."""
    t = F.translate(F.lower(F.coalesce(c, F.lit(""))), "’`", "''")
    return F.trim(F.regexp_replace(t, "[^a-z0-9']+", " "))


def collapse_space(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)\s+", " ")


def digits_only(c: Column) -> Column:
    return F.regexp_replace(c, r"\D", "")


def words(c: Column) -> Column:
    return F.filter(F.split(F.trim(c), r"\s+"), lambda w: w != "")


def jaccard(a: Column, b: Column) -> Column:
    x, y = words(a), words(b)
    both = F.size(F.array_union(x, y))
    return F.when(both == 0, 1.0).otherwise(F.size(F.array_intersect(x, y)) / both)


def cer(ref: Column, hyp: Column) -> Column:
    return rate(distances(ref, hyp)["chars"], F.length(ref))


def wer(ref: str, hyp: str) -> Column:
    """Word error rate of two columns, whatever the number of different words."""
    return rate(distances(F.col(ref), F.col(hyp))["words"], F.size(words(F.col(ref))))


def similarity(ref: str | Column, hyp: str | Column, edits: Column | None = None) -> Column:
    """0.45 of word agreement, 0.35 of character agreement and 0.2 of word overlap; not symmetric.  edits:
    the texts' distances(), where they are known already."""
    a, b = (F.col(c) if isinstance(c, str) else c for c in (ref, hyp))
    d = distances(a, b) if edits is None else edits
    mix = 0.45 * (1 - rate(d["words"], F.size(words(a)))) + 0.35 * (1 - rate(d["chars"], F.length(a))) + 0.2 * jaccard(a, b)
    empty_a, empty_b = a == "", b == ""
    return F.when(empty_a & empty_b, 1.0).when(empty_a | empty_b, 0.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), mix)))


def tokens(text: str, keep_empty: bool = False) -> Column:
    """Tokens with code-point spans: array of (token, norm, start, stop)."""
    each = "named_struct('token', m, 'norm', regexp_replace(lower(m), '[^a-z0-9]+', ''), 'start', s, 'stop', s + length(m))"
    out = F.expr(located(text, quoted(TOKEN), each))
    return out if keep_empty else F.filter(out, lambda t: t["norm"] != "")


def normalize_type(label: Column) -> Column:
    t = F.translate(F.upper(F.trim(F.coalesce(F.nullif(label, F.lit("")), F.lit("PII")))), " -", "__")
    return lookup(TYPE_ALIASES, t, t)


def normalize_tag(label: Column) -> Column:
    """Canonical type of a tagger's label without its position prefix; null for unknown labels."""
    return lookup(TAGGER_LABELS, F.regexp_replace(F.trim(F.upper(label)), "^[BIES]-", ""))


def priority(kind: Column) -> Column:
    return lookup(TYPE_PRIORITY, kind, F.lit(999))


def bitrate_kbps(value: Column) -> Column:
    """"64k", "64000" or "64" as kilobits; 64 for what is no number; at least 1; halves to even."""
    s = F.lower(F.trim(value))
    k = s.endswith("k")
    n = F.when(k, F.substring(s, 1, F.length(s) - 1)).otherwise(s).try_cast("double")
    n = F.when(~k & (n >= 1000), n / 1000).otherwise(n)
    return F.when(n.isNull(), 64).otherwise(F.greatest(F.lit(1), F.bround(n, 0).cast("int")))
