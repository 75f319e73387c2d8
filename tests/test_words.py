"""Timed words, chunks, samples and reports that SQL does not check."""

import json

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from hushwire.operators import audio, reports, words


@settings(max_examples=300, deadline=None)
@given(st.text("ab .,;é", max_size=1500), st.integers(0, 300))
def test_chunks(text, overlap):
    spans = words.chunk_bounds(text, 256, overlap)
    at, cover = 0, 0
    for k, (a, b) in enumerate(spans):
        assert a <= cover and b - a <= 256 and (b > a or not text)
        if b < len(text):
            stops = [i for i in range(a + 128, a + 256) if text[i] in " .,;"]
            assert b == (stops[-1] + 1 if stops else a + 256)
            n = max(b - min(overlap, 128), 0)
            n = n if n > a else b
            while n < len(text) and text[n - 1].isalnum() and text[n].isalnum():
                n += 1
            assert n == len(text) or spans[k + 1][0] == n
        at, cover = a, b
    assert cover == len(text) or text[at:].isalnum()


def test_chunk_rows(spark):
    df = spark.createDataFrame([(1, "word " * 1000), (2, ""), (3, None)], "id long, text string")
    got = words.text_chunks(df, "id", most=500, overlap=100).collect()
    first = [r for r in got if r["id"] == 1]
    assert len(first) > 1 and first[0]["start"] == 0 and all(r["chunk"] == ("word " * 1000)[r["start"] : r["start"] + len(r["chunk"])] for r in first)
    assert [(r["start"], r["chunk"]) for r in got if r["id"] > 1] == [(0, ""), (0, "")]


def test_align(spark):
    timed = [(1, 0, i, w, s, s + 0.2) for i, (w, s) in enumerate([("hello", 0.0), ("john", 0.3), ("smith", 0.6), ("at", 0.9), ("five", 1.2), ("?", 1.5)])]
    anchors = spark.createDataFrame(timed, "file_id long, channel int, ord int, word string, start double, end double")
    said = spark.createDataFrame([(1, 0, "Hello John Smith"), (2, 0, "nothing"), (1, 1, None)], "file_id long, channel int, transcript string")
    got = words.align(said, anchors).orderBy("start_char").collect()
    assert [(r["word"], r["start"], r["start_char"], r["end_char"]) for r in got] == [("Hello", 0.0, 0, 5), ("John", 0.3, 6, 10), ("Smith", 0.6, 11, 16)]
    assert words.matched(["a", "5", "c"], ["a", "five", "c"]) == [(0, 0), (1, 1), (2, 2)]
    assert words.matched(["a", "jon", "c"], ["a", "john", "c"]) == [(0, 0), (2, 2)]


def test_resample():
    t = np.arange(4800) / 48000
    got = audio.resampled(np.sin(2 * np.pi * 440 * t), 48000, 16000)
    want = np.sin(2 * np.pi * 440 * np.arange(1600) / 16000)
    assert len(got) == 1600 and np.abs(got - want)[50:-50].max() < 2e-3
    up = audio.resampled(want, 16000, 24000)
    assert len(up) == 2400 and np.abs(up - np.sin(2 * np.pi * 440 * np.arange(2400) / 24000))[80:-80].max() < 2e-3
    # against the plain definition: zeros between samples, one long filter
    x = np.random.default_rng(1).normal(size=97).astype(np.float32)
    for source, target in ((3, 2), (2, 3), (5, 1), (1, 4)):
        wide = np.zeros(len(x) * target)
        wide[::target] = x
        taps = audio.low_pass(target, source)
        plain = np.convolve(wide, taps)[len(taps) // 2 :][: len(wide)][::source]
        assert np.allclose(audio.resampled(x, source, target), plain, atol=1e-5)


def test_noise(spark):
    rows = [(1, [0.5] * 100, [(0.01, 0.05), (0.06, 0.06)]), (2, None, None), (3, [], None)]
    df = spark.createDataFrame(rows, "id long, samples array<double>, spans array<struct<start:double,end:double>>")
    got = {r["id"]: r["samples"] for r in audio.noise(df, 1000).collect()}
    again = {r["id"]: r["samples"] for r in audio.noise(df, 1000).collect()}
    assert got == again and got[2] is None and got[3] == []
    x = np.array(got[1])
    assert (x[:10] == 0.5).all() and (x[50:] == 0.5).all() and x[10] == 0 and 0 < np.abs(x[10:50]).max() < 0.1


def test_report_tail(spark, tmp_path):
    lines = ["" if i % 5 == 3 else json.dumps({"n": i}) for i in range(2000)]
    (tmp_path / "r.jsonl").write_text("\n".join(lines) + "\n")
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4000")
    try:
        got = sorted((r["line"], r["record"]["n"]) for r in reports.report_tail(spark, str(tmp_path / "r.jsonl"), 700, "n int").collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    assert got == [(i, i) for i in range(700, 2000) if i % 5 != 3]


def test_resample_rows_together(spark):
    r = np.random.default_rng(4)
    rows = [None, [], *([float(v) for v in r.normal(size=n)] for n in (1, 2, 48, 61, 500, 3))]
    table = spark.createDataFrame(list(enumerate(rows)), "id long, samples array<double>").coalesce(1)
    for source, target in ((48000, 16000), (16000, 24000), (44100, 16000), (8000, 8000)):
        got = {x["id"]: x["samples"] for x in audio.resample(table, source, target).collect()}
        assert got[0] is None and got[1] == []
        for i, x in enumerate(rows[2:], 2):
            want = audio.resampled(np.array(x, np.float32), source, target)
            assert len(got[i]) == len(want) and np.allclose(got[i], want, atol=1e-5)


def test_filters_are_made_once_a_batch(spark, monkeypatch):
    made = []
    plain = audio.low_pass
    monkeypatch.setattr(audio, "low_pass", lambda *a: made.append(a) or plain(*a))
    audio.resampled_rows(np.ones(480), np.full(10, 48), 48000, 16000)
    assert len(made) == 1
