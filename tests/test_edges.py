import numpy as np
import pytest

from hushwire import config, ports
from hushwire.operators import audio
from hushwire.operators import words as timed
from hushwire.sources import media
from hushwire.streaming.resume import current, resume


def test_config():
    assert config.load({"masking": {"mode": "beep", "other": 1}}).masking.mode == "beep"
    bad = [
        {"runtime": {"shard_index": 3}}, {"runtime": {"profile": "x"}}, {"recognisers": {"anchor": "beta"}}, {"recognisers": {"engines": {"alpha": {"enabled": False}}}},
        {"masking": {"rate": 44100}}, {"masking": {"unmapped_policy": "copy_original"}}, {"detection": {"chunk_chars": 100}}, {"paths": {"output_root": "calls"}}, {"runtime": {"copy_method": "symlink"}},
    ]
    for over in bad:
        with pytest.raises(ValueError):
            config.load(over)
    large = config.load({"runtime": {"profile": "large"}, "recognisers": {"engines": {"beta": {"enabled": False}}}})
    assert large.runtime.file_batch == 4 and large.recognisers.engines["gamma"]["batch"] == 4 and config.enabled(large) == ["alpha", "gamma", "delta"]
    assert config.enabled(config.with_engines(large, without=["delta"])) == ["alpha", "gamma"]
    assert config.positive_ints("1, 2,8") == [1, 2, 8]
    with pytest.raises(ValueError):
        config.positive_ints("0,1")


def test_config_files(tmp_path):
    c = config.load({"masking": {"mode": "noise"}})
    config.dump(c, str(tmp_path / "a/c.json"))
    assert config.load(str(tmp_path / "a/c.json")) == c and [p.name for p in (tmp_path / "a").iterdir()] == ["c.json"]


def test_media(spark, tmp_path):
    import wave

    with wave.open(str(tmp_path / "a.wav"), "wb") as w:
        w.setnchannels(2), w.setsampwidth(2), w.setframerate(8000)
        w.writeframes(np.array([[100, 300], [-200, 0]], "<i2").tobytes())
    (tmp_path / "b.wav").write_bytes(b"no")
    got = {r["path"].rpartition("/")[2]: r for r in media.wav_samples(spark.read.format("binaryFile").load(str(tmp_path))).collect()}
    assert got["a.wav"]["rate"] == 8000 and np.allclose(got["a.wav"]["samples"], np.array([200, -100]) / 32768) and got["b.wav"]["error"]
    rows = {r["path"]: r["status"] for r in media.probe(spark.createDataFrame([("x.opus",), ("y",)], "path string"), lambda p: {"x.opus": "{}"}[p]).collect()}
    assert rows == {"x.opus": "ok", "y": "probe_failed"}
    raw = np.arange(5, dtype="<f4").tobytes() + b"zz"
    assert media.pcm_channels(spark.createDataFrame([(1, bytearray(raw)), (2, None)], "id long, raw binary")).orderBy("id").first()["channels"] == [[0.0, 2.0], [1.0, 3.0]]
    media.pass_through(str(tmp_path / "a.wav"), str(tmp_path / "out/a.wav"))
    assert (tmp_path / "out/a.wav").read_bytes() == (tmp_path / "a.wav").read_bytes() and not (tmp_path / "out/a.wav").is_symlink()
    with pytest.raises(ValueError):
        media.pass_through(str(tmp_path / "a.wav"), str(tmp_path / "a.wav"))
    with pytest.raises(RuntimeError, match="ended with 3: ooo"):
        media.run_command(["sh", "-c", "echo ooo >&2; exit 3"])


def test_masks(spark):
    x, y = np.sin(np.arange(800) / 9).astype(np.float32) / 2, np.cos(np.arange(800) / 7).astype(np.float32)
    spans = [{"start": 0.02, "end": 0.03, "channel": 0}, {"start": 0.05, "end": 0.06, "channel": None}, {"start": 0.07, "end": 0.5, "channel": 7}]
    schema = "id long, channels array<array<float>>, spans array<struct<start:double,end:double,channel:int>>"
    df = spark.createDataFrame([(1, [x.tolist(), y.tolist()], spans), (2, [x.tolist()], [spans[0]]), (3, None, spans), (4, [y.tolist()], None)], schema)
    for mode in audio.MODES:
        got = {r["id"]: r["channels"] for r in audio.mask(df, 8000, mode).collect()}
        a, b = (np.array(c, np.float32) for c in got[1])
        same = lambda p, q, i, j: np.array_equal(p[i:j], q[i:j])
        assert same(b, y, 0, 400) and same(a, x, 0, 160) and same(a, x, 240, 400) and same(a, x, 480, 560) and same(b, y, 480, 560)
        assert same(a, b, 400, 480) and same(a, b, 560, 800) and not same(a, x, 160, 240) and not same(b, y, 400, 480)
        assert (np.abs(a[160:240]).max() == 0) == (mode == "silence") and np.abs(a[160:240]).max() <= 0.36
        assert len(got[2]) == 2 and np.array_equal(np.array(got[2][1], np.float32), x) and got[3] is None and np.array_equal(np.array(got[4][0], np.float32), y)


def test_taggers(spark):
    texts = spark.createDataFrame([(1, "so mr Smith spoke to Mrs. Jones"), (2, "nobody")], "key long, text string")
    chunks = timed.text_chunks(texts, "key")
    got = {(r["key"], r["text"], r["type"]) for r in ports.tagged(texts, chunks, {"stub_zero_shot": "zero_shot", "absent": "ner"}).collect()}
    assert got == {(1, "Smith", "PERSON_NAME"), (1, "Jones", "PERSON_NAME")} and ports.tagged(texts, chunks, {"absent": "ner"}) is None


def test_ports(spark):
    rows = spark.createDataFrame([(1, 0, "hello"), (2, 0, None)], "file_id int, channel int, script string")
    got = {(r["file_id"], r["engine"]): (r["transcript"], r["error"]) for r in ports.transcribe(rows, ["stub", "none"]).collect()}
    assert got[1, "stub"] == ("hello", None) and got[2, "stub"][1] == "Error" and got[1, "none"][1] == "NotInstalled"


def test_resume(spark, tmp_path):
    schema = "file_id long, ok boolean"
    process = lambda b: b.selectExpr("file_id", "if(ok, 'success', 'failed') AS status", "unix_micros(current_timestamp()) AS updated_at")
    for n, rows in enumerate([[(1, True), (2, False)], [(2, True), (1, False)]]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").json(str(tmp_path / "in"))
        resume(spark, str(tmp_path / "in"), schema, str(tmp_path / "state"), process).awaitTermination()
        got = {r["file_id"]: r["status"] for r in current(spark, str(tmp_path / "state")).collect()}
        assert got == ({1: "success", 2: "failed"} if n == 0 else {1: "success", 2: "success"})
    last = spark.read.parquet(str(tmp_path / "state/log/batch=1")).collect()
    assert sorted((r["file_id"], r["status"]) for r in last) == [(1, "skipped_existing"), (2, "success")]
