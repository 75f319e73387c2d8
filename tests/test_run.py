"""A whole run over small files, with stubs for codecs, probe and recognisers."""

import json
import sys
from pathlib import Path

import numpy as np
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from hushwire import config, run
from hushwire.sources import io, store

# workers cannot import a test module
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SAID = {"a": "my ssn is 123-45-6789 thank you", "b": "good morning to you", "c": "", "d": "my ssn is 123-45-6789 thank you"}


def probe(path):
    """Files that begin with "bad" cannot be probed, those that begin with "cut" have lost their end."""
    head = Path(path).read_bytes()[:3]
    if Path(path).name == "broken.opus" or head == b"bad":
        raise RuntimeError("no audio")
    if head == b"cut":
        return json.dumps({"streams": [{"codec_name": "opus", "sample_rate": "48000", "channels": 2, "duration": "4.0"}]})
    return json.dumps({"streams": [{"codec_name": "opus", "sample_rate": "48000", "channels": 2, "duration": "10.0"}], "format": {"bit_rate": "64000"}})


def recognise(inputs, engines):
    """Every engine says what the folder's name stands for, on the first channel (in d on both); the first times
    the words of the first channel."""
    said = F.create_map(*[F.lit(x) for kv in SAID.items() for x in kv])
    name = F.element_at(F.split("path", "/"), -2)
    base = inputs.withColumn("transcript", F.when((F.col("channel") == 0) | (name == "d"), said[name]).otherwise(""))
    rows = base.select("file_id", "channel", F.posexplode(F.array(*map(F.lit, engines))).alias("engine_ord", "engine"), "transcript", F.lit(None).cast("string").alias("error"))
    timed = F.expr("transform(filter(split(transcript, ' '), w -> w <> ''), (w, i) -> named_struct('word', w, 'start', CAST(i AS double), 'end', i + 0.8D))")
    return rows.withColumn("words", F.when((F.col("engine_ord") == 0) & (F.col("channel") == 0), timed))


def decode(path, rate, channels):
    return [np.ones(10 * rate, np.float32)] * channels


def encode(channels, path, rate, kbps):
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    with open(path, "wb") as f:
        np.save(f, np.stack(channels)[:, :: rate // 10])


@pytest.fixture
def calls(tmp_path):
    for name in SAID:
        (tmp_path / "in" / name).mkdir(parents=True)
        (tmp_path / "in" / name / "audio.opus").write_bytes(name.encode())
    (tmp_path / "in" / "a" / "broken.opus").write_bytes(b"x")
    c = tmp_path / "c.json"
    c.write_text(json.dumps({"paths": {"input_root": str(tmp_path / "in"), "input_glob": "*.opus", "output_root": str(tmp_path / "out"), "work_dir": str(tmp_path / "work")}}))
    return tmp_path


def cutting(channels, path, rate, kbps):
    encode(channels, path, rate, kbps)
    if Path(path).parent.name == "a":
        Path(path).write_bytes(b"cut")


def status_of(rows):
    return {r["input_path"].split("/in/")[1]: r["status"] for r in rows}


def test_run(spark, calls):
    args, edges = ["--config", str(calls / "c.json")], {"recognise": recognise, "decode": decode}
    out = lambda name: calls / "out" / name / "audio.opus"
    left_over = len(list(Path(io.scratch(spark).removeprefix("file://")).parent.iterdir()))
    rows = run.main(args, spark, probe, **edges, encode=cutting).collect()
    assert status_of(rows) == {
        "a/audio.opus": "failed", "a/broken.opus": "probe_failed", "b/audio.opus": "success_no_pii_fast_copy", "c/audio.opus": "success_unmapped_fallback", "d/audio.opus": "success_unmapped_fallback",
    }
    got = {r["input_path"].split("/in/")[1]: r for r in rows}
    assert got["a/audio.opus"]["error"] == "invalid output: duration_ok" and not got["a/audio.opus"]["valid"]
    assert all(r["elapsed_sec"] >= 0 and r["updated_at"] >= r["started_at"] for r in rows if r["status"] != "probe_failed")
    number = [0.0 if 2.88 <= t / 10 < 3.92 else 1.0 for t in range(100)]
    c, d = np.load(out("c")), np.load(out("d"))
    assert not c.any() and out("b").read_bytes() == b"b"
    # the number on the second channel has no times: that channel alone is silent as a whole
    assert d[0].tolist() == number and not d[1].any()
    side = json.loads(Path(f"{out('d')}.json").read_text())
    assert {(s["channel"], s["type"], s["text"].split(" | ")[0]) for s in side["raw_spans"]} == {(0, "SSN", "123-45-6789"), (1, "UNMAPPED_PII_FALLBACK", "123-45-6789")}
    side = json.loads(Path(f"{out('c')}.json").read_text())
    assert [e["type"] for e in side["entities"]] == ["EMPTY_TRANSCRIPT_FAILSAFE"] and got["c/audio.opus"]["num_entities"] == 1
    side = json.loads(Path(f"{out('a')}.json").read_text())
    assert side["status"] == "failed" and not side["validation"]["valid"] and side["validation"]["duration_delta_sec"] == 6.0

    # what holds is skipped, what was cut short or damaged since is made anew, now model by model
    out("c").write_bytes(b"bad")
    major = [*args, "--schedule", "model_major"]
    rows = run.main(major, spark, probe, **edges, encode=encode).collect()
    assert status_of(rows) == {
        "a/audio.opus": "success", "a/broken.opus": "probe_failed", "b/audio.opus": "skipped_existing", "c/audio.opus": "success_unmapped_fallback", "d/audio.opus": "skipped_existing",
    }
    a = np.load(out("a"))
    # the number is the fourth word, from 3.0 to 3.8 s, padded by 0.12 s, on the first channel alone
    assert a[0].tolist() == number and a[1].all() and not np.load(out("c")).any()
    side = json.loads(Path(f"{out('a')}.json").read_text())
    assert side["status"] == "success" and {e["type"] for e in side["entities"]} == {"SSN"} and side["validation"]["valid"]
    assert side["settings"]["schedule"] == "model_major" and len(side["transcripts"][0]["engines"]) == 4
    results = store.result_store(str(calls / "work" / run.RESULTS))
    assert results.read(spark).groupBy("input_path").count().select("count").collect() == [(8,), (8,)]

    # kept results are not asked for again, and the whole is as file by file
    asked = lambda inputs, engines: recognise(inputs.where("path NOT LIKE '%/a/%'"), engines)
    before = a.tobytes(), d.tobytes()
    rows = run.main([*major, "--no-resume", "--stage", "process", "--delete-results-after"], spark, probe, recognise=asked, decode=decode, encode=encode).collect()
    assert len(rows) == 5 and {r["status"] for r in rows if r["input_path"].endswith("/a/audio.opus")} == {"success"}
    assert (np.load(out("a")).tobytes(), np.load(out("d")).tobytes()) == before
    assert results.read(spark).count() == 0
    # of the tables between the steps only the three runs' results are left
    assert len(list(Path(io.scratch(spark).removeprefix("file://")).parent.iterdir())) - left_over <= 3


def test_options(calls):
    c = run.configured(run.options(["--config", str(calls / "c.json"), "--profile", "large", "--file-batch", "7", "--disable-engines", "delta", "--shard-count", "3", "--shard-index", "2", "--limit", "5"]))
    assert (c.runtime.file_batch, c.runtime.decoded_gb, c.runtime.limit, c.runtime.shard_index) == (7, 4.0, 5, 2)
    assert config.enabled(c) == ["alpha", "beta", "gamma"]
    with pytest.raises(ValueError, match="unknown engines"):
        run.configured(run.options(["--config", str(calls / "c.json"), "--enable-engines", "alpha,omega"]))
    made = calls / "default.json"
    assert run.main(["--config", str(made), "--stage", "write-default-config"]) is None
    assert config.load(str(made)) == config.load()
