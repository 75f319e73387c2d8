"""Offsets of pattern matches, as SQL text: linear in the text but for sums within blocks."""

from __future__ import annotations

#: Lengths that are summed one by one; longer lists go by sums of so many.
BLOCK = 256


def let(value: str, name: str, body: str) -> str:
    """body with name bound to value once."""
    return f"transform(array({value}), {name} -> {body})[0]"


def located(text: str, pattern: str, each: str, group: int = 0) -> str:
    """An array with `each` for every leftmost non-overlapping match of a pattern (an SQL expression) in the
    expression text; `each` may use s (start in code points), m (the match) and g (its group)."""
    found = f"named_struct('m', regexp_extract_all(t.t, t.p, 0), 'p', split(t.t, t.p, -1), 'g', regexp_extract_all(t.t, t.p, {group}))"
    lengths = "zip_with(slice(x.p, 1, size(x.m)), x.m, (c, d) -> length(c) + length(d))"
    blocks = f"""aggregate(sequence(0, size(l) DIV {BLOCK}), named_struct('at', 0, 'out', CAST(array() AS array<int>)),
        (a, k) -> named_struct('at', a.at + aggregate(slice(l, CAST(k * {BLOCK} + 1 AS int), {BLOCK}), 0, (c, d) -> c + d), 'out', concat(a.out, array(a.at))), a -> a.out)"""
    start = f"b[CAST(i DIV {BLOCK} AS int)] + aggregate(slice(l, CAST(i DIV {BLOCK} * {BLOCK} + 1 AS int), i % {BLOCK}), 0, (c, d) -> c + d) + length(x.p[i])"
    body = let(start, "s", let("x.g[i]", "g", each))
    return let(f"named_struct('t', {text}, 'p', {pattern})", "t", let(found, "x", let(lengths, "l", let(blocks, "b", f"transform(x.m, (m, i) -> {body})"))))
