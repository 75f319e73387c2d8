"""The consensus takes a channel's engines as one row."""

from hushwire.functions import text as T
from hushwire.functions.distance import distances
from hushwire.operators import consensus
from pyspark.sql import functions as F

KIND = "file_id int, channel int, engine string, engine_ord int, transcript string, error string"


def test_soft_pick_and_one_exchange(spark):
    said = [("a", "the quick brown fox jumps"), ("b", "The quick brown fox jumped"), ("c", "the quick, brown fox jump"), ("d", "nothing alike at all")]
    rows = [(1, c, e, i, t, None) for c in (0, 1) for i, (e, t) in enumerate(said)] + [(2, 0, "d", 3, "¿?", None), (3, 0, "a", 0, None, None), (4, 0, "z", 0, "late", None)]
    out = consensus.consensus(spark.createDataFrame(rows, KIND), "a", ["a", "b"], soft=0.6)
    got = {(r["file_id"], r["channel"]): r for r in out.collect()}
    for c in (0, 1):
        assert (got[1, c]["method"], got[1, c]["agreement_count"]) == ("soft_similarity", 3)
        assert got[1, c]["final_transcript"] == dict(said)[got[1, c]["selected_engine"]]
    assert (got[2, 0]["method"], got[2, 0]["final_transcript"]) == ("fallback_first_available", "¿?")
    assert got[3, 0]["method"] == "all_empty" and got[4, 0]["selected_engine"] == "z"
    plan = out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan


def test_pairs_are_placed(spark):
    """Pairs of the array's texts in order: the similarity of each is that of the two columns."""
    texts = ["one two three", "one two tree", "four"]
    own = spark.createDataFrame([(texts,)], "t array<string>").select(F.transform("t", lambda x: F.struct(x.alias("norm"))).alias("own"), consensus.pair_distances(F.col("t")).alias("edits"))
    for i, x in enumerate(texts):
        for j, y in enumerate(texts):
            if i != j:
                got = own.select(consensus._likeness(F.col("own"), F.lit(i), F.lit(j), F.col("edits"))).first()[0]
                two = spark.createDataFrame([(x, y)], "x string, y string")
                assert got == two.select(F.round(T.similarity("x", "y", distances(F.col("x"), F.col("y"))), 9)).first()[0], (x, y)
