"""The whole pipeline on a small folder of tables, stage by stage against plain forms."""

import random
import zlib

import corpus_pipeline
from hushwire.llm import quality


def test_run(spark, tmp_path):
    r = random.Random(12)
    text = lambda n: " ".join("".join(r.choice("abcdefghij") for _ in range(r.randint(2, 8))) for _ in range(n))
    shared, key = text(60), "wJalrXUtnFEMIbK7MDENGbPxRfiCYzEXqMpLeKqY"
    rows = [(i, f"{text(80).capitalize()}. {text(40)}.") for i in range(60)]
    rows += [(60, f"{text(70)} {shared}."), (61, f"{text(70)} {shared}."), (62, rows[5][1]), (63, f"{text(90)} {key} {text(9)}"), (63, f"{text(85)}."), (64, None), (65, ""), (None, text(99))]
    rows += [(100 + i, "$$ ## || 0 0 0 0 1 1 1 1 " * 30 + str(i)) for i in range(20)]
    docs = spark.createDataFrame([(i, t, "en", "web", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, int(i < 100), 0) for i, _ in rows if i is not None], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    model = quality.learn(docs, spark.read.parquet(f"{tmp_path}/labels.parquet"))
    good = {(x["doc_id"], x["text"]) for x in quality.accepted(docs, model).collect()}
    assert sum(i is not None and i < 60 for i, _ in good) >= 58 and sum(i is not None and i >= 100 for i, _ in good) <= 2
    first = corpus_pipeline.simhash_stage(spark, quality.accepted(docs, model), str(tmp_path))
    cut = corpus_pipeline.secrets_stage(spark, corpus_pipeline.passages_stage(spark, first, str(tmp_path)), str(tmp_path))
    assert cut.columns == docs.columns
    left = {(x["doc_id"], x["text"]) for x in cut.collect()}
    texts = [t or "" for _, t in left]
    assert not {62} & {i for i, _ in left} and sum(shared in t for t in texts) == 1 and not any(key in t for t in texts)
    assert sum(i == 63 for i, _ in left) == 2 and all(x in left for x in good if x[0] is not None and x[0] < 60)
    pieces = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {x["doc_id"] for x in pieces} == {i for i, _ in left} and sum(x["start"] == 0 for x in pieces) == len(left)
    filled: dict = {}
    for x in sorted(pieces, key=lambda x: (x["sequence_id"], x["offset"])):
        assert x["offset"] == filled.get(x["sequence_id"], 0)
        filled[x["sequence_id"]] = x["offset"] + x["length"]
    assert max(filled.values()) <= 1024 and zlib.crc32(b"") == 0
