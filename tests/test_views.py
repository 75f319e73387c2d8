"""The recognisers' view holds whole turns."""

from hushwire.plans import catalogue


def test_whole_turns(spark, tmp_path):
    head = "a turn of many words " * 20
    rows = [(1, 1, "user", f"{head}red"), (1, 2, "user", f"{head}blue")]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    got = {(r["file_id"], r["engine"]): r["transcript"] for r in catalogue.asr(spark, str(tmp_path)).collect()}
    assert got[1001, "alpha"] == f"{head}red" and got[1002, "alpha"] == f"{head}blue"
    assert got[1001, "gamma"] == f"{head}red" and got[1002, "delta"] == f"{head}blue."
    items = {r["text"] for r in catalogue.detection_items(spark, str(tmp_path)).collect()}
    assert f"{head}red" in items and f"{head}blue." in items
