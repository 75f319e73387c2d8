"""Edit distances against the plain table, and their place in rates and similarities."""

import random

import pytest
from pyspark.sql import functions as F

from hushwire.functions import distance
from hushwire.functions import text as T


def plain(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_against_table():
    r = random.Random(3)
    for _ in range(600):
        a, b = ("".join(r.choices("abcdé😀"[: r.randrange(1, 7)], k=r.randrange(90))) for _ in range(2))
        assert distance.edit_distance(a, b) == plain(a, b) == distance.edit_distance(list(b), list(a))
    a, b = ([r.choice(("so", "it", "goes", "on")) for _ in range(n)] for n in (400, 310))
    assert distance.edit_distance(a, b) == plain(a, b)


def test_columns(spark):
    rows = [("a b c", "a x c"), ("", ""), ("", "a"), ("a b", ""), ("one two", "one two"), (None, "a")]
    got = spark.createDataFrame(rows, "x string, y string").select("x", "y", distance.distances(F.col("x"), F.col("y")).alias("d"), F.round(T.wer("x", "y"), 4).alias("wer"), F.round(T.similarity("x", "y"), 4).alias("s")).collect()
    assert [r["d"] and tuple(r["d"]) for r in got] == [(1, 1), (0, 0), (1, 1), (3, 2), (0, 0), (None, None)]
    assert [r["wer"] for r in got] == [0.3333, 0.0, 1.0, 1.0, 0.0, None]
    assert [r["s"] for r in got][:5] == [pytest.approx(0.45 * 2 / 3 + 0.35 * 0.8 + 0.2 * 0.5, abs=1e-4), 1.0, 0.0, 0.0, 1.0]


def test_any_vocabulary():
    """More different words than there are code points in a plane."""
    x = [f"w{i}" for i in range(70_000)]
    assert distance.edit_distance(x, [*x[:5], "v5", *x[6:], "end"]) == 2
