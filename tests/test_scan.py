"""Texts searched in tasks against the SQL forms of the same rules."""

import random

from pyspark.sql import functions as F

from hushwire.functions import patterns as P
from hushwire.functions import scan
from hushwire.operators import entities

PIECES = [
    "my name is ", "MY NAME IS", "this iſ Kim ", "this is jo é kim", "patient name is ", "bob", "bob\r", "bob\r\n", "bob ", "ann lee and", ".", "\n", " ", "\xa0", "\x1c", "\x1f", "‍", "²", "ⅷ", "ⓐ", "़", "٣", "é", "字", "😀",
    "a.b@c.de", "@x.org", "www.a.b/ſ", "HTTPS://q", "10.2.3.4", "256.1.1.1", "415-555-1234", "(415) 555 1234", "+1 415.555.1234", "555\xa01234", "123-45-6789", "1/2/1999", "12-31-99", "born march 3, 1980", "ſep\xa0third nineteen eighty", "may twenty first twenty one",
    "MAY 5 ", "1234 5678 9012", "cvv is 123", "security code: 9999", "aba no. 123456789", "4111 1111 1111 1111", "4111-1111-1111-111", "12345-6789", "12345", "member id ABC123", "account member 12345", "polıcy # A-1-2-3", "Kase", "claim x", "İd 1",
    "double five one two three four", "triple six", "four one five five five five one two one two", "phone", "o'ne", "o.n.e", "minus 7", "seven seven seven seven seven seven seven", "oh", "_", "-", "12", "7",
]


def texts():
    r = random.Random(5)
    return [(i, r.choice(["", " ", " ", "\t"]).join(r.choices(PIECES, k=r.randint(1, 14)))) for i in range(1500)] + [(2000, None), (2001, "")]


def as_sql(df, *columns):
    all_ = F.concat(*(F.coalesce(c, F.array().cast(P.ENTITY)) for c in columns))
    return sorted(map(tuple, df.select("id", F.inline(all_)).select("id", "text", "type", "start", "end", "score", "source").collect()))


def test_scanned_is_what_sql_finds(spark):
    df = spark.createDataFrame(texts(), "id long, t string").repartition(4).cache()
    rules = tuple(d[0] for d in P.DETECTORS)
    got = entities.scanned(df, "t", rules, names=True, spoken=True)
    want = as_sql(df, *(entities.rule_entities("t", n) for n in rules), entities.name_entities("t"), entities.spoken_entities("t"))
    rows = sorted(map(tuple, got.select("id", "text", "type", "start", "end", "score", "source").collect()))
    assert rows == want and len(rows) > 2000
    assert {r["rule"] for r in got.select("rule").distinct().collect()} == {*rules, "name", "spoken"}


def test_classes_of_all_characters(spark):
    """Every character stands for one that Python puts where SQL puts it, those apart that the JVM's Unicode does not know yet."""
    points = spark.range(0, 0x110000).where("id NOT BETWEEN 55296 AND 57343").selectExpr("id", "decode(unhex(lpad(hex(id), 8, '0')), 'utf-32') c").where(r"NOT rlike(c, '\\p{Cn}')")
    sql = {r["id"]: (r["w"], r["s"], r["d"]) for r in points.selectExpr("id", r"rlike(c, '(?U)\\w') w", r"rlike(c, '(?U)\\s') s", r"rlike(c, '(?U)\\d') d").collect()}
    odd = []
    for i, want in sql.items():
        c = scan.stands_for(chr(i))
        if (c.isalnum() or c == "_", c.isspace(), c.isdecimal()) != want:
            odd.append(i)
    assert odd == []


def test_detection_searches_once_in_tasks(spark):
    plan = entities.detect(spark.createDataFrame([(1, "a")], "id long, text string"), "id")._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_extract_all" not in plan and plan.count("MapInArrow") == 2
