"""The patterns, spoken names and spoken numbers of a text in one go, for tasks that hold texts as Arrow batches.

What is found is what the SQL forms (patterns.entities, entities.spoken_entities) find, by test.  They search a text
four times a pattern and bind names by lambdas, which costs ten times as much."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

from hushwire.functions import patterns as P

#: What a pattern can't match without: one of some strings of the lower-cased text, and whether also a digit.
MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")
NEEDS = {
    "email": (("@",), False), "url": (("://", "www."), False), "ipv4": ((".",), True), "phone": ((), True), "ssn": (("-",), True), "dob": (("/", "-"), True), "month_dob": (MONTHS, False), "aadhaar": ((), True),
    "cvv": (("cvv", "cvc", "security code"), True), "routing": (("routing", "aba"), True), "card": ((), True), "zip": ((), True), "id": (tuple(P.ID_WORDS.split("|")), True),
}
#: Letters that are others' in any case: texts with them are searched in any event.
FOLDED = re.compile("[İıſK]")
DIGIT = re.compile(r"\d")
#: A phone number lies within one of these.
PHONE_RUN = re.compile(r"[\d(+][\d()+.\-\s]{5,}\d")
CONTROLS = re.compile("[\x1c-\x1f]")
# `$` of the SQL form also stands before a last line's end of any kind
NAMES = tuple((lead, re.compile(P.name_pattern(lead, stops).replace("|$)", "|(?:\r\n|[\n\r\x85\u2028\u2029])?\\Z)"))) for lead, stops in P.NAMES)
RULES = {d[0]: (re.compile(d[1]), *d[2:], *NEEDS[d[0]]) for d in P.DETECTORS}
TOKEN, NOT_NORM, HINTS = re.compile(P.TOKEN), re.compile("[^a-z0-9]+"), re.compile(P.NUMBER_HINTS)

#: Name of the rule, text, type, start, end, score, source.
Found = tuple[str, str, str, int, int, float, str]


def stands_for(c: str) -> str:
    """c, or a character of the class (word, digit, space or none) that c has in SQL, where Python has it in another."""
    kind = unicodedata.category(c)
    circled = kind == "So" and ("Ⓐ" <= c <= "ⓩ" or "\U0001f130" <= c <= "\U0001f149" or "\U0001f150" <= c <= "\U0001f169" or "\U0001f170" <= c <= "\U0001f189")
    word = kind[0] == "L" or kind in ("Mn", "Me", "Mc", "Nd", "Nl", "Pc") or c in "\u200c\u200d" or circled
    space = c.isspace() and not "\x1c" <= c <= "\x1f"
    if (word, space, kind == "Nd") == (c.isalnum() or c == "_", c.isspace(), c.isdecimal()):
        return c
    return "٣" if kind == "Nd" else "é" if word else " " if space else "§"


_known: set[str] = set(map(chr, range(0x1C))) | set(map(chr, range(0x20, 0x80)))
_other: dict[int, str] = {}


def searchable(text: str) -> str:
    """text, place by place, with classes of characters as SQL has them."""
    if text.isascii():
        return CONTROLS.sub("§", text) if CONTROLS.search(text) else text
    used = set(text)
    for c in used - _known:
        if stands_for(c) != c:
            _other[ord(c)] = stands_for(c)
    _known.update(used)
    return text.translate(_other) if any(ord(c) in _other for c in used) else text


def rule_matches(text: str, rules: tuple[str, ...], names: bool) -> Iterator[Found]:
    """Matches of the rules in their order, then of spoken names, before any check of their values."""
    t = searchable(text)
    low, always, digit = t.lower(), FOLDED.search(t) is not None, DIGIT.search(t) is not None
    for name in rules:
        pattern, group, kind, score, source, needs, numeric = RULES[name]
        if (numeric and not digit) or not (always or not needs or any(n in low for n in needs)):
            continue
        if name == "month_dob" and not (digit or always or "nineteen" in low or "twenty" in low):
            continue
        runs = [(r.start(), r.end()) for r in PHONE_RUN.finditer(t)] if name == "phone" else [(0, len(t))]
        for a, b in runs:
            for m in pattern.finditer(t, a, b):
                start, end = m.span(group)
                yield name, text[start:end], kind, start, end, score, source
    for lead, pattern in NAMES if names else ():
        if always or lead in low:
            for m in pattern.finditer(t):
                yield "name", text[m.start(1) : m.end(1)], "PERSON_NAME", m.start(1), m.end(1), 0.99, "rule_name"


def spoken_matches(text: str) -> Iterator[Found]:
    """Runs of spoken digits, as entities.spoken_entities has them."""
    said = [(NOT_NORM.sub("", m.group().lower()), m.start(), m.end()) for m in TOKEN.finditer(text)]
    single = [w in P.NUMBER_WORDS or (len(w) == 1 and w.isdigit()) for w, _, _ in said] + [False]
    runs, a, b, n = [], -1, -1, 0
    for i, (w, start, end) in enumerate(said):
        digits = 1 if w in P.NUMBER_WORDS else len(w) if w.isdigit() else 0
        if digits or w in P.NUMBER_SEPARATORS or (w in P.NUMBER_REPEATERS and single[i + 1]):
            a, b = start if a < 0 else a, end
            n += digits * (P.NUMBER_REPEATERS.get(said[i - 1][0], 1) if single[i] and i else 1)
        else:
            runs.append((a, b, n))
            a, b, n = -1, -1, 0
    for a, b, n in (*runs, (a, b, n)):
        if n >= 10 or (n >= 7 and HINTS.search(text[max(0, a - 100) : b + 100].lower())):
            yield "spoken", text[a:b], "PHONE" if n >= 10 else "ID_NUMBER", a, b, 0.92, "spoken_number_rule"
