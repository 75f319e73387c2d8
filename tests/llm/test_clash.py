"""Extra columns keep their values, whatever their names."""

import random

from hushwire.llm import passages, secrets

NAMES = ("_key", "_spans", "_text", "_all", "_new", "gone", "_gone", "row", "key")


def test_extra_columns(spark):
    import corpus_pipeline

    r = random.Random(4)
    words = [f"w{i}" for i in range(400)]
    shared = " ".join(r.choices(words, k=70))
    own = [" ".join(r.choices(words, k=60)) for _ in range(3)]
    texts = [f"{own[0]} {shared}", f"{own[1]} {shared}", own[2], own[2], "", None, f"{own[0][:50]} token = abcdEFGH12345678"]
    kind = ", ".join(["doc_id long", "text string", *(f"`{n}` string" for n in NAMES), "n_chars long"])
    docs = spark.createDataFrame([(i, t, *(f"{n}{i}" for n in NAMES), len(t or "")) for i, t in enumerate(texts)], kind)

    cut = {x["doc_id"]: x for x in passages.without_passages(docs).collect()}
    assert shared in cut[0]["text"] and cut[1]["text"].strip() == own[1] and cut[1]["n_chars"] == len(cut[1]["text"])
    assert 3 not in cut and cut[4]["text"] == "" and cut[5]["text"] is None
    mask = {x["doc_id"]: x for x in secrets.masked(docs).collect()}
    assert "<SECRET>" in mask[6]["text"] and mask[6]["n_chars"] == len(mask[6]["text"]) and mask[5]["text"] is None
    near = {x["doc_id"]: x for x in corpus_pipeline.simhash_stage(spark, docs, "").collect()}
    assert set(near) == {0, 1, 2, 4, 6}
    for out in (cut, mask, near):
        for i, x in out.items():
            assert list(x.asDict()) == docs.columns and [x[n] for n in NAMES] == [f"{n}{i}" for n in NAMES]

