"""Personal data by candidate gradient boosting.

High-recall generators propose overlapping spans: the fixed base patterns, whose matches always stay, and
looser ones (spelled-out addresses, telephone numbers without a plus, digits in groups, national numbers,
long network addresses).  Boosted regression trees over format and context features score the loose
candidates; per kind the lowest threshold that keeps the wanted precision on held-out examples selects.
The trees are trained here on examples drawn from templates with a fixed seed.  Both truths share their
forms and, for a part of the examples, their context, so that scores of the two overlap and the thresholds
have something to weigh.  Every scanner takes time in proportion to the text.
"""

from __future__ import annotations

import hashlib
import random
import re
import string
from bisect import bisect_left
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hushwire.llm.common import map_arrow, table

#: What may stand before an @, and the @ with its domain.
LOCAL = string.ascii_letters + string.digits + "._%+-"
DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
#: No digit precedes: within a run of digits what follows the run decides for all its starts alike.  (Patterns
#: begin with what they look for and look back from there, which lets the search step over all else.)
IP = re.compile(r"[0-9](?<![0-9][0-9])[0-9]*+(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
BASE = ("email", "ip", "card", "phone")
DIGIT = re.compile(r"[0-9]")

#: What follows the local part of a spelled-out address, but for a space.
SPELLED = re.compile(r"[ (\[{][Aa][Tt](?:(?<= ..) |(?<=\(..)\)|(?<=\[..)\]|(?<=\{..)\}) ?(?:[A-Za-z0-9-]++ ?(?i:\(dot\)|\[dot\]|\{dot\}| dot |\.) ?)+[A-Za-z]{2,}+\b")
#: Other loose generators: kind, pattern.  Lengths in them are those of the format; runs have no upper bound.
LOOSE = (
    ("local_phone", re.compile(r"[(0-9](?<![0-9+.-].)(?:(?<=\()[0-9]{3}|(?<!\()[0-9]{2})\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9])")),
    ("national_id", re.compile(r"[0-9](?<![0-9-].)[0-9]{2}-[0-9]{2}-[0-9]{4}(?![0-9-])")),
    ("digits", re.compile(r"[0-9](?<![0-9.].)(?:[ -]?[0-9]){8,}+")),
    ("grouped", re.compile(r"[0-9](?<![0-9].)[0-9]{3}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{1,7}(?![0-9])")),
    ("ip6", re.compile(r"(?<![0-9A-Fa-f:])[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){5,7}(?![0-9A-Fa-f:])")),
)
KINDS = ("spelled_email", *(k for k, _ in LOOSE))
HINTS = ("mail", "contact", "call", "phone", "tel", "mobile", "fax", "card", "visa", "ssn", "social", "account", "host", "address", "server", "order", "version", "invoice", "isbn", "total", "year", "page")
#: Endings of addresses that speak for a spelled-out one.
ENDINGS = frozenset("com org net edu gov io info de fr uk us eu es it nl ch jp cn in br ru".split())
#: Precision wanted of the selected loose spans on held-out examples.
PRECISION = 0.97


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c)
        if i % 2:
            d = 2 * d - 9 * (d > 4)
        total += d
    return total % 10 == 0


def only_digits(s: str) -> str:
    return "".join(DIGIT.findall(s))


def small(digits: str) -> bool:
    """At most 255, whatever the number of digits."""
    d = digits.lstrip("0")
    return len(d) <= 3 and int(d or 0) <= 255


def emails(text: str) -> list[tuple[int, int]]:
    """Start and end of every address: an @ with its domain, and all before it that may be a local part."""
    out, past = [], 0
    for m in DOMAIN.finditer(text):
        start = past + len(text[past : m.start()].rstrip(LOCAL))
        if start < m.start():
            out.append((start, m.end()))
        past = m.end() if start < m.start() else m.start() + 1
    return out


def base_spans(text: str) -> list[tuple[int, int, str, int]]:
    """(start, rank, kind, end) of the base patterns, in order; failing matches are stepped over."""
    out = [(a, 0, "email", b) for a, b in emails(text)]
    if DIGIT.search(text):
        out += [(m.start(), 1, "ip", m.end()) for m in IP.finditer(text) if all(small(x) for x in m[0].split("."))]
        for m in CARD.finditer(text):
            if 14 <= m.end() - m.start() <= 37:  # 19 digits with separators at most
                d = only_digits(m[0])
                if 14 <= len(d) <= 19 and luhn(d):
                    out.append((m.start(), 2, "card", m.end()))
        out += [(m.start(), 3, "phone", m.end()) for m in PHONE.finditer(text) if 10 <= len(only_digits(m[0])) <= 15]
    return sorted(out)


def spelled(text: str) -> list[tuple[int, int]]:
    """Start and end of every spelled-out address, its local part as long as it goes."""
    out, past = [], 0
    for m in SPELLED.finditer(text):
        before = text[past : m.start()].removesuffix(" ")
        start = past + len(before.rstrip(LOCAL))
        if start < past + len(before):
            out.append((start, m.end()))
        past = m.end()
    return out


def candidates(text: str) -> list[tuple[int, int, str, int]]:
    """(start, rank, kind, end) of all loose generators; those of different kinds may overlap."""
    out = [(a, 4, "spelled_email", b) for a, b in spelled(text)]
    holds = {"ip6": text.count(":") >= 5}  # what every match holds; a digit in the other kinds
    digit = DIGIT.search(text) is not None
    for rank, (kind, pattern) in enumerate(LOOSE, 5):
        if holds.get(kind, digit):
            out += [(m.start(), rank, kind, m.end()) for m in pattern.finditer(text)]
    return out


def apart(spans: list, taken: list) -> list:
    """Those of spans that overlap none of taken (sorted by start)."""
    starts, furthest, most = [t[0] for t in taken], [-1], -1
    for t in taken:
        most = max(most, t[3])
        furthest.append(most)
    return [c for c in spans if furthest[bisect_left(starts, c[3])] <= c[0]]


def best_apart(scored: list[tuple[float, tuple]]) -> list:
    """Spans by falling score, each kept unless it overlaps one kept before.  Spans that reach into one
    another form a run; runs are settled one by one."""
    out, run, end = [], [], -1
    for item in [*sorted(scored, key=lambda x: x[1]), (0.0, None)]:
        if item[1] is None or item[1][0] >= end:
            kept: list = []
            for _, c in sorted(run, key=lambda x: (-x[0], x[1])):
                if not any(k[0] < c[3] and c[0] < k[3] for k in kept):
                    kept.append(c)
            out.extend(kept)
            run = []
        if item[1] is not None:
            run.append(item)
            end = max(end, item[1][3])
    return out


def span_features(text: str, start: int, end: int, kind: str) -> list[float]:
    s, before, after = text[start:end], text[max(0, start - 40) : start].lower(), text[end : end + 20].lower()
    digits, low = only_digits(s), s.lower()
    seps = [s.count(c) for c in " -.():"]
    ending = low.rstrip(string.ascii_lowercase)
    return [
        KINDS.index(kind), len(s), len(digits), len(digits) / max(1, len(s)), *seps,
        float(bool(digits) and luhn(digits)), float(digits[:1] in ("0", "1")), float(len(set(digits))), float(before[-1:].isalnum()),
        float(after[:1].isalnum()), float(before.rstrip()[-1:] in ":#="), float("(at)" in low or "[at]" in low or "{at}" in low),
        float(ending.endswith((". ", " .", " . "))), float(low[len(ending) :] in ENDINGS), float(ending.endswith("dot ")), *(float(h in before) for h in HINTS),
    ]


class Trees:
    """Gradient-boosted regression trees of depth 3 for logistic loss, with splits at feature quantiles."""

    def __init__(self, x: np.ndarray, y: np.ndarray, rounds: int = 60, rate: float = 0.2, depth: int = 3):
        self.rate, self.start, self.trees = rate, float(np.log(y.mean() / (1 - y.mean()))), []
        self.cuts = [np.unique(np.quantile(x[:, k], np.linspace(0.02, 0.98, 25))) for k in range(x.shape[1])]
        z = np.full(len(y), self.start)
        for _ in range(rounds):
            p = 1 / (1 + np.exp(-z))
            tree = self._grow(x, y - p, p * (1 - p), np.arange(len(y)), depth)
            self.trees.append(tree)
            z += rate * self._run(tree, x)

    def _grow(self, x, g, h, rows, depth):
        total_g, total_h = g[rows].sum(), h[rows].sum()
        leaf = float(total_g / (total_h + 1.0))
        if depth == 0 or len(rows) < 20:
            return leaf
        best, where = 1e-6, None
        for k, cuts in enumerate(self.cuts):
            v = np.searchsorted(cuts, x[rows, k], side="left")
            gs, hs = np.bincount(v, g[rows], len(cuts) + 1).cumsum()[:-1], np.bincount(v, h[rows], len(cuts) + 1).cumsum()[:-1]
            gain = gs**2 / (hs + 1) + (total_g - gs) ** 2 / (total_h - hs + 1) - total_g**2 / (total_h + 1)
            if len(gain) and gain.max() > best:
                best, where = gain.max(), (k, cuts[int(gain.argmax())])
        if where is None:
            return leaf
        left = x[rows, where[0]] <= where[1]
        if left.all() or not left.any():
            return leaf
        return (*where, self._grow(x, g, h, rows[left], depth - 1), self._grow(x, g, h, rows[~left], depth - 1))

    def _run(self, tree, x):
        if isinstance(tree, float):
            return np.full(len(x), tree)
        k, cut, low, high = tree
        return np.where(x[:, k] <= cut, self._run(low, x), self._run(high, x))

    def score(self, x: np.ndarray) -> np.ndarray:
        z = self.start + self.rate * sum(self._run(t, x) for t in self.trees)
        return 1 / (1 + np.exp(-z))


#: Words before a span that speak for it and against it, by kind; a part of the examples has neither.
FOR = {
    "spelled_email": ("mail ", "contact: ", "write to ", "e-mail "), "local_phone": ("call ", "phone: ", "tel ", "mobile ", "fax: ", "contact "), "national_id": ("ssn ", "social security ", "ssn: "),
    "digits": ("card ", "visa ", "account ", "card: "), "grouped": ("card ", "visa ", "account ", "card: "), "ip6": ("host ", "server ", "address "),
}
AGAINST = ("order ", "invoice ", "version ", "total ", "page ", "isbn ", "year ")
#: Share of examples, of either truth, whose context says nothing.
NEUTRAL = 0.2
#: The same for spelled-out addresses, whose like stands in any prose.
PROSE = 0.6


def example(r: random.Random, kind: str, truth: bool) -> tuple[str, int, int]:
    """A sentence with one span of a kind, and where that is."""
    digits = lambda k: "".join(r.choice("0123456789") for _ in range(k))
    word = lambda: "".join(r.choice("aeioubcdfglmnprst") for _ in range(r.randint(2, 9)))
    fours = lambda d, c: c.join(d[i : i + 4] for i in range(0, len(d), 4))

    def card(k: int) -> str:
        d = r.choice("3456") + digits(k - 2)
        return next(d + c for c in "0123456789" if luhn(d + c))

    if kind == "spelled_email" and truth:
        mark = r.choice([" (at) ", " [at] ", "{at}", "(at)", " (AT) ", " at ", " at "])
        span = word() + r.choice(["", "." + word(), digits(2)]) + mark + word() + r.choice([" (dot) ", "[dot]", ".", " dot ", "."]) + r.choice([*sorted(ENDINGS), "com", "org", word()])
    elif kind == "spelled_email":
        end = r.choice([word(), word(), r.choice(sorted(ENDINGS))])  # many endings are words too
        span = f"{word()} at {word()}" + r.choice([f". {end.title()}", f". {end.title()}", f". {end}", f". {end}", f".{word()}", f" dot {word()}"])
    elif kind == "local_phone":
        span = (f"({digits(3)}) " if truth and r.random() < 0.5 else digits(3) + r.choice(" .-")) + digits(3) + r.choice(" .-") + digits(4)
    elif kind == "national_id":
        span = f"{digits(3)}-{digits(2)}-{digits(4)}"
    elif kind == "digits":
        span = card(r.choice([13, 15, 16, 16, 16])) if truth else digits(r.choice([16, 16, r.randint(9, 40)]))
    elif kind == "grouped":
        span = fours(card(16) if truth else digits(16), r.choice(" -"))
    else:
        span = ":".join("".join(r.choice("0123456789abcdef") for _ in range(4)) for _ in range(8)) if truth else ":".join(digits(2) if r.random() < 0.5 else f"{r.randrange(256):02x}" for _ in range(r.choice([6, 6, 8])))
    plain = PROSE if kind == "spelled_email" else NEUTRAL
    lead = "" if r.random() < plain else r.choice(FOR[kind] if truth else AGAINST)
    before = f"{word()} {word()} {lead}"
    return f"{before}{span} {word()}.", len(before), len(before) + len(span)


def examples(n: int, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features, truth and kind of n or a few more candidates in sentences drawn from templates."""
    r = random.Random(seed)
    x, y, kind = [], [], []
    while len(x) < n:
        truth = r.random() < 0.5
        text, start, end = example(r, r.choice(KINDS), truth)
        for a, rank, k, b in candidates(text):
            x.append(span_features(text, a, b, k))
            y.append(float(truth and (a, b) == (start, end)))
            kind.append(rank - 4)
    return np.array(x), np.array(y), np.array(kind)


def lowest(scores: np.ndarray, truth: np.ndarray, wanted: float = PRECISION) -> float:
    """The least score from which on the precision is as wanted; above 1 where there is none."""
    order = np.argsort(-scores, kind="stable")
    s, y = scores[order], truth[order]
    last = np.append(s[1:] < s[:-1], True)  # equal scores are selected together
    ok = np.flatnonzero(last & (np.cumsum(y) / np.arange(1, len(y) + 1) >= wanted))
    return float(s[ok[-1]]) if len(ok) else 1.01


@lru_cache(1)
def model() -> tuple[Trees, np.ndarray]:
    """The trees and each kind's threshold, taken on examples that the trees have not seen."""
    x, y, _ = examples(6000, 7)
    trees = Trees(x, y)
    x, y, kind = examples(6000, 8)
    s = trees.score(x)
    return trees, np.array([lowest(s[kind == k], y[kind == k]) for k in range(len(KINDS))])


def find(text: str, trees: Trees, limits: np.ndarray) -> tuple[list, list]:
    """Base spans, and all spans: of overlapping loose candidates the one with the best score stays."""
    base = base_spans(text)
    loose = apart(candidates(text), base)
    if loose:
        s = trees.score(np.array([span_features(text, c[0], c[3], c[2]) for c in loose]))
        return base, sorted(base + best_apart([(v, c) for v, c in zip(s.tolist(), loose, strict=True) if v >= limits[c[1] - 4]]))
    return base, base


def listed(spans: list) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, _, k, b in spans)


SCHEMA = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"


def scan(docs: DataFrame) -> DataFrame:
    """Personal data of every whole text.  A null text counts as empty; repeated rows are each scanned;
    an empty table gives an empty result; extra columns are ignored.  Very long texts are scanned whole, in
    time in proportion to their length.  Spans of one start are told apart by kind; of loose candidates
    with equal scores the one that starts first stays, then the kind listed first."""
    trees, limits = model()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")

    def make():
        def run(c):
            out: dict[str, list] = {k: [] for k in ("n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans")}
            for text in c["text"].to_pylist():
                base, spans = find(text or "", trees, limits)
                kinds = [b[2] for b in base]
                for k in BASE:
                    out[f"n_{k}"].append(kinds.count(k))
                out["base_sha256"].append(hashlib.sha256(listed(base).encode()).hexdigest())
                out["spans"].append(listed(spans))
            return out | {"doc_id": c["doc_id"]}

        return run

    return map_arrow(rows, make, SCHEMA, "text")


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's personal data, one row a document; odd input as in `scan`."""
    return scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
