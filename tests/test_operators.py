import random

from pyspark.sql import functions as F

from hushwire.functions import text as T
from hushwire.functions.patterns import TYPE_PRIORITY
from hushwire.operators import consensus, entities, files


def test_sentence(spark):
    t = "My name is John Smith. Call me at four one five five five five one two three four or email john@example.com."
    got = entities.detect(spark.createDataFrame([(1, t)], "id long, text string"), "id").collect()
    assert {r["type"] for r in got} == {"PERSON_NAME", "PHONE", "EMAIL"}
    for r in got:
        assert t[r["start"] : r["end"]] == r["text"]


def edit(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(new[-1] + 1, row[j] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_word_error_rate(spark):
    r = random.Random(3)
    pairs = [(" ".join(r.choices("ab cd e fgh", k=r.randint(0, 6))), " ".join(r.choices(["ab", "cd", "x"], k=r.randint(0, 6)))) for _ in range(60)]
    df = spark.createDataFrame(pairs, "x string, y string").select("x", "y", T.wer("x", "y").alias("w"))
    for row in df.collect():
        a, b = row["x"].split(), row["y"].split()
        assert abs(row["w"] - edit(a, b) / max(1, len(a))) < 1e-9


def test_resolve_against_fold(spark):
    r = random.Random(5)
    rows = []
    for g in range(40):
        for o in range(r.randint(1, 7)):
            s = r.randint(0, 20)
            rows.append((g, s, s + r.randint(1, 8), r.choice(["SSN", "PHONE", "ZIP", "NEW"]), "t", r.choice([0.5, 1.0]), "x", o))
    df = spark.createDataFrame(rows, "g int, start int, end int, type string, text string, score double, source string, ord int")
    got = sorted((x["g"], x["start"], x["end"], x["type"]) for x in entities.resolve(df, ["g"]).collect())
    want = []
    for g in range(40):
        p = lambda e: TYPE_PRIORITY.get(e[3], 999)
        kept = []
        for e in sorted((x for x in rows if x[0] == g), key=lambda e: (e[1], e[1] - e[2], p(e), -e[5], e[2], e[7])):
            at = next((i for i, k in enumerate(kept) if k[1] < e[2] and e[1] < k[2]), None)
            if at is None:
                kept.append(e)
            elif (p(e), -e[5], e[1] - e[2]) < (p(kept[at]), -kept[at][5], kept[at][1] - kept[at][2]):
                kept[at] = e
        want += [(g, e[1], e[2], e[3]) for e in kept]
    assert got == sorted(want)


def test_consensus_methods(spark):
    rows = [(1, 0, e, i, t, None) for i, (e, t) in enumerate([("a", "Hello, John Smith"), ("b", "hello john smith"), ("c", "hello john smith."), ("d", "no")])]
    rows += [(2, 0, "a", 0, "", None), (2, 0, "b", 1, None, "x")]
    df = spark.createDataFrame(rows, "file_id int, channel int, engine string, engine_ord int, transcript string, error string")
    got = {r["file_id"]: r for r in consensus.consensus(df, "a", ["a", "b"]).collect()}
    assert got[1]["method"] == "strict_majority" and got[1]["selected_engine"] == "a" and got[1]["agreement_count"] == 3
    assert got[2]["method"] == "all_empty"


def test_sizes_and_names(spark):
    one = spark.range(1).select(files.shrunk(F.lit(8), F.lit(4.0), 8.0, 2).alias("a"), files.recovered(F.lit(2), F.lit(8), F.lit(12.0), 8.0).alias("b"), entities.likely_name(F.lit("nurse kelly")).alias("c")).first()
    assert (one["a"], one["b"], one["c"]) == (4, 4, False)
