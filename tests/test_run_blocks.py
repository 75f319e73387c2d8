"""Recordings too large for a task go through the run by blocks, with the same outputs."""

import json
import sys
from pathlib import Path

import numpy as np
import pytest
from pyspark import cloudpickle
from test_run import calls, decode, encode, probe, recognise, status_of  # noqa: F401

from hushwire import config, run
from hushwire.sources import media

# workers cannot import a test module
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def decode_blocks(path, size, rate, channels):
    """Four and a half blocks of the same samples; the folder c cannot be read to its end, d has none."""
    name = Path(path).parent.name
    n = 10 * rate
    for at in range(0, n if name != "e" else 0, size):
        if name == "c" and at:
            raise RuntimeError("lost")
        yield [np.ones(min(size, n - at), np.float32)] * channels


def encode_blocks(parts, path, rate, kbps):
    encode(list(np.concatenate([np.stack(p) for p in parts], 1)), path, rate, kbps)


def test_same_as_whole(spark, calls):  # noqa: F811
    c = json.loads((calls / "c.json").read_text())
    args = ["--config", str(calls / "c.json"), "--no-resume"]
    run.main(args, spark, probe, recognise=recognise, decode=decode, encode=encode).collect()
    whole = {n: np.load(calls / "out" / n / "audio.opus").tolist() for n in "ad"}
    assert (calls / "out" / "c" / "audio.opus").exists()
    (calls / "c.json").write_text(json.dumps(c | {"runtime": {"decoded_gb": 1e-6}}))
    never = lambda *_: 1 / 0
    rows = run.main(args, spark, probe, recognise=recognise, decode=never, encode=never, decode_blocks=decode_blocks, encode_blocks=encode_blocks, block=110_000).collect()
    assert status_of(rows) == {
        "a/audio.opus": "success", "a/broken.opus": "probe_failed", "b/audio.opus": "success_no_pii_fast_copy", "c/audio.opus": "failed", "d/audio.opus": "success_unmapped_fallback",
    }
    assert {n: np.load(calls / "out" / n / "audio.opus").tolist() for n in "ad"} == whole
    # what failed on its way leaves neither its parts nor what was there before
    assert [p.name for p in (calls / "out" / "c").iterdir()] == [] and "lost" in next(r["error"] for r in rows if "/c/" in r["input_path"])


def test_blocks_of_files(spark):
    files = spark.createDataFrame([(1, "/x/c/f"), (2, "/x/e/f"), (3, "/x/a/f")], "id long, path string")
    got = media.decoded_blocks(files, 40_000, 16_000, 2, decode_blocks).selectExpr("id", "block", "size(channels[0]) AS n", "error").collect()
    assert sorted((r["id"], r["block"], r["n"]) for r in got if r["error"] is None) == [(1, 0, 40_000), *((3, k, 40_000) for k in range(4))]
    assert sorted((r["id"], r["block"], "lost" in r["error"] or r["error"]) for r in got if r["error"]) == [(1, 1, True), (2, 0, "no samples")]


def tool(path: Path, body: str) -> str:
    path.write_text(f"#!{sys.executable}\nimport sys\n{body}\n")
    path.chmod(0o755)
    return str(path)


def test_streams_of_commands(tmp_path):
    good = tool(tmp_path / "good", "sys.stdout.buffer.write(b'\\0\\0\\x80?' * 2 * 10 + b'\\0')")
    assert [len(x[0]) for x in media.decode_stream("f", 4, channels=2, tool=good)] == [4, 4, 2]
    bad = tool(tmp_path / "bad", "sys.stderr.write('no such stream'); sys.exit(3)")
    with pytest.raises(RuntimeError, match="ended with 3: no such stream"):
        list(media.decode_stream("f", 4, tool=bad))
    with pytest.raises(RuntimeError, match="no such stream"):
        media.encode_stream(iter([[np.ones(1 << 20, np.float32)]] * 4), "f", tool=bad)
    copy = tool(tmp_path / "copy", "open(sys.argv[-1], 'wb').write(sys.stdin.buffer.read())")
    media.encode_stream(iter([[np.array([0.5, 2.0], np.float32)], [np.array([-3.0], np.float32)]]), str(tmp_path / "out"), tool=copy)
    assert np.frombuffer((tmp_path / "out").read_bytes(), "<f4").tolist() == [0.5, 0.5, 1.0, 1.0, -1.0, -1.0]


def test_engines_have_numbers_of_their_own(monkeypatch):
    monkeypatch.setattr(run, "ITEMS", len(config.enabled(config.load())))
    with pytest.raises(ValueError, match="engines"):
        run.plan(config.load(), None, None, object())
