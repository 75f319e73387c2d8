"""A stream that knows its files by state, broken off in mid-batch and begun again."""

import itertools
import shutil
from collections import Counter
from pathlib import Path

import pytest

from hushwire.streaming import resume


def test_restart_and_states(spark, tmp_path):
    place = str(tmp_path)
    spark.createDataFrame([(i % 20,) for i in range(60)], "file_id long").repartition(3).write.json(f"{place}/in")

    def handle(row):
        with open(f"{place}/asked", "a") as f:
            f.write(f"{int(row['file_id'])}\n")
        if row["file_id"] == 7 and not Path(f"{place}/again").exists():
            import os

            Path(f"{place}/again").touch()
            os._exit(1)  # the worker is lost; its task runs again
        if row["file_id"] == 11:
            raise ValueError("bad call")
        return ("success", True) if row["file_id"] % 3 else ("failed", False)

    run = lambda: resume.resume_by_state(spark, f"{place}/in", "file_id long", f"{place}/s", handle, 1).awaitTermination()
    try:
        run()
    except Exception:
        run()  # local mode gives a task one attempt; the query goes on from its checkpoint
    log = Counter((r["file_id"], r["status"]) for r in resume.status_log(spark, f"{place}/s").collect())
    for i in range(20):
        if i % 3 and i != 11:
            assert log[i, "success"] == 1 and log[i, "skipped_existing"] == 2
        else:
            assert log[i, "failed"] == 3
    assert sum(log.values()) == 60
    assert {(r["file_id"], r["status"]) for r in resume.current(spark, f"{place}/s").collect()} == {(i, "success" if i % 3 and i != 11 else "failed") for i in range(20)}
    # later rows: only files without a valid success are handled
    before = len(Path(f"{place}/asked").read_text().split())
    spark.createDataFrame([(1,), (3,), (99,)], "file_id long").coalesce(1).write.mode("append").json(f"{place}/in")
    run()
    assert sorted(map(int, Path(f"{place}/asked").read_text().split()[before:])) == [3, 99]
    # one state a file
    states = spark.read.format("statestore").load(f"{place}/s/checkpoint")
    assert states.count() == 21


def test_many_files_are_not_a_frame_each(spark, tmp_path):
    """Between two calls of a task lies little more than the calls: the times of the log tell."""
    place = str(tmp_path)
    spark.range(8000).selectExpr("id AS file_id").coalesce(1).write.json(f"{place}/in")
    resume.resume_by_state(spark, f"{place}/in", "file_id long", f"{place}/s", lambda row: ("failed", False), 1).awaitTermination()
    log = resume.status_log(spark, f"{place}/s").selectExpr("input_file_name() AS task", "updated_at").collect()
    assert len(log) == 8000
    tasks = {}
    for r in log:
        tasks.setdefault(r["task"], []).append(r["updated_at"])
    gaps = sorted(b - a for t in tasks.values() for a, b in itertools.pairwise(sorted(t)))
    assert gaps[len(gaps) // 2] < 150  # microseconds; a frame a file took 1,000 and more


@pytest.mark.parametrize("lost", [["calls/commits/1"], ["calls/commits/1", "checkpoint/commits/1"], ["calls/commits/1", "checkpoint/commits/1", "checkpoint/offsets/1"], ["calls/commits/1", "log/batch=1/_SUCCESS", "checkpoint/commits/1", "checkpoint/offsets/1", "checkpoint/sources/0/1"]])
def test_broken_off_between_log_and_states(spark, tmp_path, lost):
    place = str(tmp_path)

    def handle(row):
        with open(f"{place}/asked", "a") as f:
            f.write(f"{row['file_id']}\n")
        return ("success", True) if row["n"] != 1 else ("failed", False)

    def call(*rows):
        spark.createDataFrame(rows, "file_id long, n long").coalesce(1).write.mode("append").json(f"{place}/in")
        run()

    def run():
        resume.resume_by_state(spark, f"{place}/in", "file_id long, n long", f"{place}/s", handle, 1).awaitTermination()

    def seen():
        return sorted((r["batch"], r["file_id"] or 0, r["status"]) for r in resume.status_log(spark, f"{place}/s").collect())

    call((1, 0), (2, 1), (None, 1), (2**53 + 1, None))
    call((1, 0), (2, 0), (None, 0), (2**53 + 1, 0))
    first = seen()
    assert first == [(0, 0, "failed"), (0, 1, "success"), (0, 2, "failed"), (0, 2**53 + 1, "success"), (1, 0, "success"), (1, 1, "skipped_existing"), (1, 2, "success"), (1, 2**53 + 1, "skipped_existing")]
    asked = Path(f"{place}/asked").read_text().split()
    assert sorted(asked) == sorted(["1", "2", "2", "None", "None", str(2**53 + 1)])
    for path in lost:
        folder, name = f"{place}/s/{path}".rsplit("/", 1)
        for p in (Path(folder, name), Path(folder, f".{name}.crc")):
            p.unlink(missing_ok=True)
    run()
    assert seen() == first
    # a log that is whole is kept, one that is not is written again from the states before
    again = Path(f"{place}/asked").read_text().split()[len(asked) :]
    assert sorted(again) == (["2", "None"] if "log/batch=1/_SUCCESS" in lost else [])
    call((1, 0), (2, 0), (3, 1), (None, 0))
    assert [x[1:] for x in seen() if x[0] == 2] == [(0, "skipped_existing"), (1, "skipped_existing"), (2, "skipped_existing"), (3, "failed")]
    assert spark.read.format("statestore").load(f"{place}/s/checkpoint").count() == 5


def test_empty_batches_and_lost_checkpoints(spark, tmp_path):
    place = str(tmp_path)
    run = lambda: resume.resume_by_state(spark, f"{place}/in", "file_id long", f"{place}/s", lambda row: ("success", True), 1).awaitTermination()
    Path(f"{place}/in").mkdir()
    for name, text in (("a", ""), ("b", '{"file_id": 1}\n'), ("c", "\n"), ("d", '{"file_id": 1}\n{"file_id": 2}\n')):
        Path(f"{place}/in/{name}.json").write_text(text)
        run()
    log = sorted((r["file_id"], r["status"]) for r in resume.status_log(spark, f"{place}/s").collect())
    assert log == [(1, "skipped_existing"), (1, "success"), (2, "success")]
    shutil.rmtree(f"{place}/s/calls")
    with pytest.raises(RuntimeError, match="begin in a new place"):
        run()
