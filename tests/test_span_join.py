"""Entities meet words: what leaves the join is sorted again, with the entity's row, so only hits may."""

from hushwire.operators import spans
from hushwire.plans import catalogue


def test_only_hits_leave_the_join(spark):
    words = [(1, 0.5 * i, 0.5 * i + 0.4, i * 5, i * 5 + 4, 60.0) for i in range(12)] + [(2, 1.0, 2.0, None, None, 9.0)]
    w = spark.createDataFrame(words, "file_id long, w_start double, w_end double, start_char int, end_char int, duration double")
    e = spark.createDataFrame([(1, 6, 12, "two", 0), (1, 4, 5, "gap", 1), (1, 50, 70, "over", 2), (2, 0, 5, "none", 3), (3, 0, 5, "no file", 4), (1, None, None, "null", 5)], "file_id long, start int, end int, text string, ord int")
    out = spans.entity_spans(e, w, ["file_id"])
    got = {r["text"]: (r["start_sec"] is not None and round(r["start_sec"], 2), r["end_sec"] is not None and round(r["end_sec"], 2), r["duration"]) for r in out.collect()}
    assert got == {"two": (0.38, 1.52, 60.0), "gap": (False, False, 60.0), "over": (4.88, 6.02, 60.0), "none": (False, False, 9.0), "no file": (False, False, None), "null": (False, False, 60.0)}
    join = [x for x in out._jdf.queryExecution().optimizedPlan().toString().split("\n") if "Join LeftOuter" in x and "_block" in x]
    assert len(join) == 1 and "start_char" in join[0] and "end_char" in join[0]
    many = spans.entity_spans(e, w, ["file_id"], tasks=3)
    assert sorted(map(str, many.collect())) == sorted(map(str, out.collect())) and many.rdd.getNumPartitions() == 3


def test_tasks_grow_with_the_orders(spark, monkeypatch):
    monkeypatch.setattr(catalogue, "ORDER_ROWS", 100)
    assert catalogue.QUERIES["entity_word_overlap"](spark, "/root/testdata/sf0.001").rdd.getNumPartitions() == 15
