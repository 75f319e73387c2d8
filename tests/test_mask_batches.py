"""Masks by blocks: spans of many blocks are replaced together, and no block goes through an exchange."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from hushwire.operators import audio, blocks
from hushwire.plans import catalogue

DATA, RATE = "/root/testdata/sf0.001", 1000


@pytest.fixture
def large(spark):
    """Tables too large to broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_only_keys_and_sums_are_shuffled(large):
    plan = catalogue.mask_beep_blocks(large, DATA)._jdf.queryExecution().executedPlan().toString()
    moved = [line for line in plan.splitlines() if "Exchange" in line]
    assert len([m for m in moved if "o_orderkey" in m and "REPARTITION_BY_NUM" in m]) == 3
    assert len(moved) == 4 and "SortMergeJoin" in plan  # the fourth is that of the sums
    # frames are made once for the peaks and once for the masks: no filter makes them again
    assert not [line for line in plan.splitlines() if "Filter" in line and "% 64" in line]


def test_spans_are_replaced_together(spark, monkeypatch):
    """One call a turn of a batch, not one a span of a block."""
    calls = []
    monkeypatch.setattr(audio, "replacement", lambda *a: calls.append(a))
    a, b = np.array([0, 3, 10]), np.array([50, 5, 90])
    audio.replacements("beep", a, b, a, b, RATE, np.ones(3), 1000.0, 0.35, 8, 42)
    assert not calls


@pytest.mark.parametrize("mode", audio.MODES)
def test_replacements_as_one_by_one(mode):
    r = np.random.default_rng(3)
    a = r.integers(0, 500, 200)
    b = a + r.integers(1, 90, 200)
    lo = a + r.integers(0, 90, 200) % (b - a)
    hi = lo + 1 + r.integers(0, 90, 200) % (b - lo)
    top = r.random(200) * 3
    got = audio.replacements(mode, a, b, lo, hi, 8000, top, 1000.0, audio.GAIN[mode], 32, 42)
    want = [audio.replacement(mode, *map(int, s), 8000, float(t), 1000.0, audio.GAIN[mode], 32, 42) for *s, t in zip(a, b, lo, hi, top, strict=True)]
    assert got.dtype == np.float32 and np.array_equal(got, np.concatenate(want))
    none = np.zeros(0, np.int64)
    assert not len(audio.replacements(mode, none, none, none, none, 8000, np.zeros(0), 1000.0, 0.1, 32, 42))


@pytest.mark.parametrize("grouped", [False, True])
@pytest.mark.parametrize("both", [False, True])
@pytest.mark.parametrize("size", [5, 64])
def test_many_spans_as_whole(large, size, both, grouped):
    """Recordings of one to three channels, some without spans, with many that lie over each other."""
    r = np.random.default_rng(5)
    rows = [(i, [[float(v) for v in r.normal(size=n)] for _ in range(i % 3 + 1)]) for i, n in enumerate(r.integers(1, 300, 30).tolist())]
    spans = [(i, o, float(a), float(a + w), None if c > 3 else int(c)) for i in range(25) for o, (a, w, c) in enumerate(zip(r.random(i) * 0.3, r.random(i) * 0.1, r.integers(-1, 5, i), strict=True))]
    t = large.createDataFrame(rows, "id long, channels array<array<float>>")
    s = large.createDataFrame(spans, "id long, ord int, start double, end double, channel int")
    per = s.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("ord", "start", "end", "channel"))).alias("spans"))
    want = {x["id"]: np.array(x["channels"], np.float32) for x in audio.mask(t.join(per, "id", "left"), RATE, "beep", both).collect()}
    got: dict = {}
    for x in sorted(blocks.mask(blocks.cut(t, size), per if grouped else s, size, RATE, "beep", both).collect(), key=lambda x: (x["id"], x["block"])):
        got.setdefault(x["id"], []).append(np.array(x["channels"], np.float32))
    assert set(got) == set(want)
    for k, x in got.items():
        assert np.array_equal(np.concatenate(x, axis=1), want[k]), k
