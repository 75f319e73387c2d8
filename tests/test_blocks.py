import numpy as np
import pytest
from pyspark.sql import functions as F

from hushwire.operators import audio, blocks

RATE = 1000


@pytest.fixture(scope="module")
def recordings(spark):
    r = np.random.default_rng(1)
    rows = [(i, [[float(v) for v in r.normal(size=n)] for _ in range(k)]) for i, (n, k) in enumerate([(1000, 2), (997, 1), (1, 2), (512, 2), (0, 2)])]
    return spark.createDataFrame([*rows, (5, None), (6, [[0.0] * 300, [0.0] * 300])], "id long, channels array<array<float>>").cache()


#: Over a block's edge, over the end, one within another, beyond the end, empty, and on no channel that is there.
SPANS = [(0.1, 0.4, 0), (0.25, 0.3, 1), (0.2, 0.2, 0), (0.9, 1.7, -1), (5.0, 6.0, 0), (0.05, 0.06, 7), (-1.0, 0.01, None)]


@pytest.fixture(scope="module")
def spans(spark):
    return spark.createDataFrame([(i, o, a, b, c) for i in range(7) for o, (a, b, c) in enumerate(SPANS)], "id long, ord int, start double, end double, channel int").cache()


def joined(rows) -> dict:
    out: dict = {}
    for r in sorted(rows, key=lambda r: (r["id"], r["block"])):
        out.setdefault(r["id"], []).append(np.array(r["channels"], np.float32))
    return {k: np.concatenate(v, axis=1) for k, v in out.items()}


@pytest.mark.parametrize("mode", audio.MODES)
@pytest.mark.parametrize("size", [7, 256, 5000])
def test_mask_as_whole(spark, recordings, spans, mode, size):
    per = spans.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("ord", "start", "end", "channel"))).alias("spans"))
    want = {r["id"]: r["channels"] for r in audio.mask(recordings.join(per, "id"), RATE, mode).collect()}
    got = joined(blocks.mask(blocks.cut(recordings, size), spans, size, RATE, mode).collect())
    assert set(got) == {0, 1, 2, 3, 6}
    for k, x in got.items():
        assert np.allclose(x, np.array(want[k], np.float32), atol=1e-6), (k, mode)


@pytest.mark.parametrize("source, target", [(48000, 16000), (16000, 24000), (44100, 16000), (8000, 8000)])
def test_resample_as_whole(spark, recordings, source, target):
    size = 40
    got = joined(blocks.resample(blocks.cut(recordings, size), size, source, target).collect())
    for r in recordings.where("id IN (0, 1, 2, 3)").collect():
        want = np.array([audio.resampled(np.array(c, np.float32), source, target) for c in r["channels"]])
        assert got[r["id"]].shape == want.shape and np.allclose(got[r["id"]], want, atol=1e-6)


def test_short_blocks_are_refused(recordings):
    with pytest.raises(ValueError):
        blocks.resample(blocks.cut(recordings, 8), 8, 48000, 16000)


def test_noise_by_place():
    whole = audio.noise_at(0, 100_001, 42)
    assert abs(whole.mean()) < 0.02 and abs(whole.std() - 1) < 0.02 and not np.allclose(whole, audio.noise_at(0, 100_001, 43))
    for lo, hi in ((0, 1), (1, 2), (1, 1), (777, 12_345), (99_998, 100_001)):
        assert np.array_equal(whole[lo:hi], audio.noise_at(lo, hi, 42))
