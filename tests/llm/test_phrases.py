"""Collocations against counting everything, and on odd input."""

import random
import re
from collections import Counter

import numpy as np

from hushwire.llm import phrases

SCHEMA = "text string, lang string, gram string, n int"
LOWER = {c: c + 32 for c in range(65, 91)}


def plain(rows, least, first=2000):
    f: Counter = Counter()
    for text, lang in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            for k in range(1, 6):
                f.update((lang or "und", tuple(words[i : i + k])) for i in range(len(words) - k + 1))
    total: Counter = Counter()
    for (lang, g), n in f.items():
        total[lang] += n if len(g) == 1 else 0
    out = []
    candidates = {key: n for key, n in f.items() if len(key[1]) > 1 and n >= least}
    for (lang, g), a in candidates.items():
        if any(x == lang and len(h) > len(g) and n >= a and any(h[i : i + len(g)] == g for i in range(len(h))) for (x, h), n in candidates.items()):
            continue
        score, cut = min((1000 * a * total[lang] // (f[lang, g[:k]] * f[lang, g[k:]]), k) for k in range(1, len(g)))
        out.append((lang, -score, -a, " ".join(g).encode(), f[lang, g[:cut]], f[lang, g[cut:]], total[lang]))
    ranked, rank = [], Counter()
    for lang, score, a, g, left, right, n in sorted(out):
        rank[lang] += 1
        if rank[lang] <= first:
            ranked.append((lang, rank[lang], g.decode(), -a, left, right, n, -score))
    return sorted(ranked)


def mined(spark, rows, least, **how):
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA).repartition(3)
    return sorted(tuple(r) for r in phrases.collocations(docs, least=least, **how).collect())


def made(n, seed):
    r = random.Random(seed)
    words = [f"w{i}" for i in range(12)] + ["É", "ñu", "a\x00b", "THE"]
    joins = [" ", "  ", "\t", ", ", ".\n", "\x0b", " . "]
    return [("".join(r.choice(words) + r.choices(joins, [20, 2, 2, 2, 2, 1, 1])[0] for _ in range(r.randrange(40))), r.choice(["en", "fr", None, "und"])) for _ in range(n)]


def test_against_counting(spark):
    rows = [*made(300, 1), (None, "en"), ("", None), (" \t ", "fr"), *[("the the the the the the the", "en")] * 4, *[("alpha beta gamma delta epsilon zeta", None)] * 9]
    for least in (5, 40):
        assert mined(spark, rows, least) == plain(rows, least)
    assert mined(spark, rows, 5, first=7) == plain(rows, 5, 7)


def test_least_beyond_a_byte(spark):
    rows = made(200, 2) + [("so it goes", "en")] * 400
    assert mined(spark, rows, 300) == plain(rows, 300) != []


def test_crowded_bitmaps(spark, monkeypatch):
    """With hardly any bits everything passes the filters, and counts stay exact."""
    monkeypatch.setattr(phrases, "LEAST_BITS", 8)
    monkeypatch.setattr(phrases, "MOST_BITS", 8)
    rows = made(150, 3)
    assert mined(spark, rows, 6) == plain(rows, 6)


def test_empty_and_long(spark):
    assert mined(spark, [], 1) == [] and mined(spark, [(None, None)], 1) == [] and mined(spark, [("one", "en")], 1) == []
    rows = [("to be or not " * 30_000, "en"), ("x" * 300_000 + " y", "en")]
    assert mined(spark, rows, 100) == plain(rows, 100)


def test_filters_and_trims(spark):
    """The bitmap of two-word buckets rejects nearly all rare pairs, and trimmed texts are much shorter."""
    r = random.Random(4)
    rows = [(" ".join(["in the end", *(f"r{r.randrange(10**6)}" for _ in range(30)), "in the end of it all"]), "en") for _ in range(200)]
    docs = spark.createDataFrame(rows, "text string, lang string").select("lang", "text")
    size = 1 << 16
    first = phrases.one_pass(docs, 1, 100, size, None, None, False).cache()
    own = first.where("gram IS NOT NULL").groupBy("lang", "gram").sum("n").where("`sum(n)` >= 100")
    sc = spark.sparkContext
    parts, buckets = sc.broadcast(phrases._frequent_bits(own, 1, size)), sc.broadcast(phrases._bitmap(first.where("slice IS NOT NULL"), size, 100))
    assert np.unpackbits(np.frombuffer(buckets.value, np.uint8)).sum() <= 10
    second = phrases.one_pass(docs, 2, 100, size, parts, buckets, False)
    grams = {x["gram"] for x in second.where("gram IS NOT NULL").collect()}
    assert grams == {"in the", "the end", "end of", "of it", "it all"}
    rest = [x["rest"] for x in second.where("rest IS NOT NULL").collect()]
    assert len(rest) == 200 and all(set(t.split()) == {"in", "the", "end", "of", "it", "all"} for t in rest)
    first.unpersist()
