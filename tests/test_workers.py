"""Models in workers: batches, failures, retries, loads; taggers over chunks; keyed stores."""

import os
import re
import sys
from pathlib import Path

import pytest
from pyspark import cloudpickle

from hushwire import ports, workers
from hushwire.operators import entities
from hushwire.sources import store

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def engine(log, **how):
    """Says the input's number; fails on whole batches that hold a multiple of 10, and on the multiples themselves.
    Words of odd numbers end before they start; the plain model says so."""

    def load():
        with open(f"{log}/loads", "a") as f:
            f.write(f"{os.getpid()}\n")

        def model(rows):
            with open(f"{log}/sizes", "a") as f:
                f.write(f"{len(rows)}\n")
            if any(r["file_id"] % 10 == 0 for r in rows):
                raise ValueError("no tens")
            return [(f"n{r['file_id']}", [{"word": "n", "start": 2.0, "end": 1.0 if r["file_id"] % 2 else 3.0}]) for r in rows]

        return model

    plain = lambda: lambda rows: [(f"plain{r['file_id']}", None) for r in rows]
    return workers.Engine("counter", load, again=plain, **how)


def test_engine_rows(spark, tmp_path):
    rows = spark.range(0, 500, 1, 2).selectExpr("id AS file_id", "0 AS channel", "10.0D AS duration")
    # the held model outlives a test, so its name is this test's
    e = engine(str(tmp_path), batch=7)
    got = workers.recognised(rows, e).collect()
    assert [r["file_id"] for r in got] == list(range(500))
    for r in got:
        i = r["file_id"]
        if i % 10 == 0:
            assert r["transcript"] is None and r["error"] == "ValueError('no tens')" and not r["retried"]
        elif i % 2:
            assert (r["transcript"], r["words"], r["error"], r["retried"]) == (f"plain{i}", None, None, True)
        else:
            assert (r["transcript"], r["error"], r["retried"]) == (f"n{i}", None, False) and r["words"][0]["end"] == 3.0
    loads = Path(tmp_path / "loads").read_text().split()
    assert len(loads) == len(set(loads)) <= 4
    sizes = [int(n) for n in Path(tmp_path / "sizes").read_text().split()]
    # 250 rows a task are 35 batches of 7 and one of 5; singles are those of failed batches
    assert sizes.count(7) == 70 and sizes.count(5) == 2 and set(sizes) == {1, 5, 7}


def test_engine_edges(spark):
    rows = spark.range(5).selectExpr("id AS file_id", "0 AS channel")
    short = workers.Engine("short", lambda: lambda rows: [] if len(rows) > 1 else [("one", None)], batch=3)
    assert {r["transcript"] for r in workers.recognised(rows, short).collect()} == {"one"}
    absent = workers.Engine("absent", lambda: 1 / 0)
    assert {r["error"] for r in workers.recognised(rows, absent).collect()} == {"ZeroDivisionError('division by zero')"}
    assert workers.recognised(rows.limit(0), short).count() == 0
    ports.ENGINES["short"] = short
    try:
        both = ports.transcribe(rows, ["short", "none"]).collect()
    finally:
        del ports.ENGINES["short"]
    assert {(r["engine"], r["engine_ord"], r["transcript"], r["error"]) for r in both} == {("short", 0, "one", None), ("none", 1, None, "NotInstalled")}


def names(**how):
    def load():
        find = re.compile(r"(?<=mr )[A-Z][a-z]+( [A-Z][a-z]+)?")
        return lambda chunks: [[{"label": "person name", "start": m.start(), "end": m.end(), "score": 0.9} for m in find.finditer(c)] for c in chunks]

    return workers.Tagger("names", "zero_shot", load, **how)


def test_taggers_in_detection(spark):
    filler = "so it went on and on, " * 20
    long = "".join(f"mr Smith{chr(97 + i % 26)} {filler}" for i in range(60)) + "mr End Here"
    texts = [(1, "call mr Jones Senior at 10.0.0.1"), (2, None), (3, ""), (4, long), (1, "mr Other")]
    df = spark.createDataFrame(texts, "id long, text string")
    whole = entities.detect(df, "id", taggers=(names(),), chunk_chars=1 << 30)
    by = lambda rows: sorted((r["id"], r["start"], r["end"], r["text"], r["type"], r["source"]) for r in rows.collect())
    want = by(whole)
    assert (1, 8, 20, "Jones Senior", "PERSON_NAME", "zero_shot") in want and (1, 3, 8, "Other", "PERSON_NAME", "zero_shot") in want and len(want) == 64
    for most, overlap in ((300, 60), (1800, 240)):
        assert by(entities.detect(df, "id", taggers=(names(batch=3),), chunk_chars=most, chunk_overlap=overlap)) == want


def test_tagger_rules(spark):
    chunks = spark.createDataFrame([(1, 5, "ann bob")], "id long, start int, chunk string")

    def tags(kind, *found, least=0.5):
        t = workers.Tagger(f"{kind}{found}", kind, lambda: lambda chunks: [list(found) for _ in chunks], least=least)
        return sorted((r["text"], r["type"], r["start"], r["end"], r["score"]) for r in workers.placed(workers.labelled(chunks, t), kind, least).collect())

    tag = lambda label, a, b, score: {"label": label, "start": a, "end": b, "score": score}
    assert tags("token", tag("B-SURNAME", 0, 3, 0.9), tag("I-SURNAME", 0, 3, 0.7), tag("CITY", 4, 7, 0.4), tag("O", 4, 7, 1.0), tag("CITY", None, 3, 0.9)) == [("ann", "PERSON_NAME", 5, 8, 0.9)]
    assert tags("ner", tag("PERSON", 4, 99, 0.1), tag("NORP", 0, 3, 0.9)) == [("bob", "PERSON_NAME", 9, 12, 0.6)]
    assert tags("zero_shot", tag("phone-number", 3, 3, 0.9), tag("date of birth", 4, 7, None)) == [("bob", "DOB", 9, 12, 0.0)]
    broken = workers.Tagger("broken", "ner", lambda: 1 / 0)
    assert workers.labelled(chunks, broken).count() == 0
    with pytest.raises(ValueError, match="unknown taggers"):
        ports.taggers(("nobody",))


def test_store(spark, tmp_path):
    s = store.Store(str(tmp_path / "t"), "k string, e string, v long, updated_at double", ("k", "e"), ("updated_at",), ("k",), 16)
    rows = lambda *r: spark.createDataFrame(list(r), s.schema)
    assert s.read(spark).count() == 0 and s.lookup(spark, k="1").count() == 0 and s.delete(rows()) == [] and s.upsert(rows()) == []
    s.upsert(rows(*((f"{i}", e, i, 1.0) for i in range(300) for e in "xy"), (None, "x", 5, 1.0)))
    stamp = lambda: {f: os.path.getmtime(f) for f in map(str, (tmp_path / "t").rglob("*.parquet"))}
    before = stamp()
    touched = s.upsert(rows(("7", "x", 70, 2.0), ("7", "x", 71, 3.0), ("7", "z", 72, 1.0), ("7", "y", 73, 0.5)))
    after = stamp()
    # one bucket is written anew, all others are the same files
    assert len(touched) == 1 and {f.split("bucket=")[1].split("/")[0] for f in before.keys() ^ after.keys()} == {str(touched[0])}
    assert sorted((r["e"], r["v"]) for r in s.lookup(spark, k="7").collect()) == [("x", 71), ("y", 73), ("z", 72)]
    assert s.read(spark).count() == 602 and s.lookup(spark, k="8", e="x").collect()[0]["v"] == 8
    plan = s.lookup(spark, k="7")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan and f"= {touched[0]})]" in plan
    s.delete(rows(("7", None, None, None), ("none such", None, None, None)))
    assert s.lookup(spark, k="7").count() == 0 and s.read(spark).count() == 599
    # a bucket that loses its last row is gone
    s.delete(s.read(spark).select("k"))
    assert s.read(spark).where("k IS NOT NULL").count() == 0
