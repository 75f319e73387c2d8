"""Batches are cut by the bytes of a column, of lists too, so a task's memory does not follow its rows."""

import pyarrow as pa

from hushwire.llm import common, passages


def test_lists_are_cut_by_bytes():
    hit = pa.struct([("f", pa.int32()), ("b", pa.int64()), ("a", pa.int64())])
    lists = [[{"f": 0, "b": k, "a": k}] * n for k, n in enumerate([3, 100, 0, 1, 400, 2, 2])] + [None]
    batch = pa.RecordBatch.from_arrays([pa.array(range(8)), pa.array(lists, pa.list_(hit))], names=["doc_id", "hits"])
    parts = list(common.slices(batch, "hits", 2048))
    assert [x for p in parts for x in p.column(0).to_pylist()] == list(range(8)) and len(parts) > 2
    assert [x for p in parts for x in p.column(1).to_pylist()] == lists
    assert all(sum(map(len, filter(None, p.column(1).to_pylist()[1:]))) * 20 <= 2048 for p in parts)


def test_passages_cut_every_batch(spark, monkeypatch):
    bounds = []
    monkeypatch.setattr(passages, "map_arrow", lambda df, make, schema, text=None, most=1 << 60, f=common.map_arrow: bounds.append((text, most)) or f(df, make, schema, text, most))
    words = [f"w{i}" for i in range(120)]
    docs = spark.createDataFrame([(i, " ".join(words if i % 2 else words[:60] + [f"u{i}x{k}" for k in range(60)])) for i in range(6)], "doc_id long, text string")
    got = passages.repeated_passages(docs).select("doc_id", "start_word", "end_word").distinct().collect()
    assert {(1, 0, 60), (2, 0, 60), (3, 0, 120), (4, 0, 60), (5, 0, 120)} <= {tuple(r) for r in got}
    assert {t for t, _ in bounds} == {"text", "hits", "words"} and max(m for _, m in bounds) <= 1 << 20
