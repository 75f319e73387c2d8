"""Sweeps in place of folds over all: the same rows, and long texts in linear time."""

import random
import time

from pyspark.sql import functions as F

from hushwire.functions.patterns import TYPE_PRIORITY
from hushwire.operators import entities, spans

ENTITY = "key long, text string, type string, start int, end int, score double, source string, ord int"
TYPES = ["SSN", "PHONE", "ZIP", "OTHER", "PERSON_NAME"]


def plain(rows):
    """The whole kept list is asked for every entity; the first that overlaps may be replaced."""
    rank = lambda e: (TYPE_PRIORITY.get(e[2], 999), -e[5], e[3] - e[4])
    kept = []
    for e in sorted(rows, key=lambda e: (e[3], e[3] - e[4], TYPE_PRIORITY.get(e[2], 999), -e[5], e[4], e[7])):
        at = next((i for i, k in enumerate(kept) if k[3] < e[4] and e[3] < k[4]), None)
        if at is None:
            kept.append(e)
        elif rank(e) < rank(kept[at]):
            kept[at] = e
    return kept


def test_resolve_equals_plain_fold(spark):
    r = random.Random(9)
    rows = []
    for key in range(10_000):
        wide = r.choice((3, 10, 40))
        for i in range(r.randrange(1, 25 if key % 50 else 120)):
            a = r.randrange(60)
            rows.append((key, f"t{i}", r.choice(TYPES), a, a + r.randrange(1, wide), r.choice((0.5, 0.9)), "x", i))
    df = spark.createDataFrame(rows, ENTITY)
    by: dict = {}
    for row in rows:
        by.setdefault(row[0], []).append(row)
    want = sorted(e[:7] for own in by.values() for e in plain(own))
    assert sorted(tuple(x) for x in entities.resolve(df, ["key"]).collect()) == want


def test_fifty_thousand_entities(spark):
    n = 50_000
    df = spark.range(n).selectExpr("7L AS key", "'e' || id AS text", "'PHONE' AS type", "CAST(id * 6 AS int) AS start", "CAST(id * 6 + 4 + id % 5 AS int) AS end", "0.9D AS score", "'x' AS source", "CAST(id AS int) AS ord")
    began = time.time()
    got = entities.resolve(df, ["key"]).agg(F.count("*"), F.sum("start")).first()
    assert time.time() - began < 30 and n * 0.5 < got[0] < n
    words = spark.range(2 * n).selectExpr("7L AS key", "id * 0.1D AS w_start", "id * 0.1D + 0.05D AS w_end", "CAST(id * 3 AS int) AS start_char", "CAST(id * 3 + 2 AS int) AS end_char", "1e9D AS duration")
    began = time.time()
    assert spans.entity_spans(df, words, ["key"]).where("start_sec IS NOT NULL").count() == n
    assert time.time() - began < 30


def test_spans_of_odd_entities(spark):
    e = spark.createDataFrame([(1, "a", 0, 5), (1, "a", 0, 5), (1, "none", 500, 510), (1, "all", 0, 1000), (2, "gone", 0, 9), (None, "k", 0, 9), (1, "at", 70, 70), (1, None, None, 3)], "key long, text string, start int, end int")
    w = spark.createDataFrame([(1, 1.0, 1.5, 2, 8, 9.0), (1, 3.0, 3.4, 60, 200, 9.0), (1, None, None, 201, 203, 9.0), (None, 1.0, 2.0, 0, 4, 9.0)], "key long, w_start double, w_end double, start_char int, end_char int, duration double")
    got = sorted(((r["text"], r["start_sec"] and round(r["start_sec"], 3), r["end_sec"] and round(r["end_sec"], 3)) for r in spans.entity_spans(e, w, ["key"]).collect()), key=str)
    assert got == sorted([("a", 0.88, 1.62), ("a", 0.88, 1.62), ("none", None, None), ("all", 0.88, 3.52), ("gone", None, None), ("k", None, None), ("at", 2.88, 3.52), (None, None, None)], key=str)
