"""Batches cut by bytes: what a worker holds follows bytes and not rows."""

import pyarrow as pa

from hushwire.functions.batches import parts


def test_parts():
    rows = ["x" * 1000] * 100 + [None, ""] + ["y" * 50_000]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(rows))), pa.array(rows)], names=["k", "t"])
    cut = list(parts(batch, 20_000))
    assert [r for p in cut for r in p.column(1).to_pylist()] == rows
    assert all(p.num_rows == 1 or sum(len(r or "") for r in p.column(1).to_pylist()) <= 20_000 for p in cut) and len(cut) > 5
    lists = pa.RecordBatch.from_arrays([pa.array([[1] * 500] * 20 + [None, []], pa.list_(pa.int64()))], names=["v"])
    assert [r for p in parts(lists, 10_000) for r in p.column(0).to_pylist()] == lists.column(0).to_pylist() and len(list(parts(lists, 10_000))) > 5
