"""Passages that share much of their wording with unlike ones."""

import random

import numpy as np

from hushwire.llm import passages


def variants(head: int, changed: bool) -> list[tuple[int, str]]:
    """Three copies of each of 100 variants of a 60-word passage with a common head, shuffled."""
    r = random.Random(11)
    text = lambda n: ["".join(r.choice("abcdefghij") for _ in range(5)) for _ in range(n)]
    common, rows = text(head), []
    for v in range(100):
        own = common + text(60 - head)
        for k in range(3):
            copy = list(own)
            if changed and k:
                copy[r.randrange(60)] = "new"
            rows.append((v, " ".join(text(50) + copy + text(50))))
    r.shuffle(rows)
    return rows


def expected(rows: list[tuple[int, str]]) -> set[int]:
    """Rows that have a passage of any earlier row of their variant, each pair of rows tried."""
    words = [passages.word_hashes(t) for _, t in rows]
    return {i for i, (v, _) in enumerate(rows) if any(passages.passages(words[i], words[j]) for j in range(i) if rows[j][0] == v)}


def found(spark, rows) -> set[int]:
    docs = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(rows)], "doc_id long, text string")
    return {g["doc_id"] for g in passages.repeated_passages(docs).collect()}


def test_exact_variants(spark):
    rows = variants(45, False)
    assert len(want := expected(rows)) == 200 and found(spark, rows) == want


def test_near_variants(spark):
    rows = variants(30, True)
    want = expected(rows)
    assert len(want) > 150 and len(want - found(spark, rows)) <= len(want) // 100


def test_spanned():
    x = np.random.default_rng(5).integers(1, 9, 200).astype(np.uint64)
    for width in (1, 6, 12, 46):
        h, at = passages.spanned(x, width), {}
        assert len(h) == 201 - width
        for i, k in enumerate(h.tolist()):
            assert at.setdefault(k, x[i : i + width].tolist()) == x[i : i + width].tolist()


def jaccard(a, b):
    grams = [{tuple(x[k : k + 5]) for k in range(len(x) - 4)} for x in (a, b)]
    return len(grams[0] & grams[1]) / len(grams[0] | grams[1])


def test_insertions():
    """Every passage of 50 to 130 words with words put in, left out or changed, as long as 0.8 is kept."""
    r = random.Random(4)
    text = lambda n: ["".join(r.choice("abcdefghij") for _ in range(6)) for _ in range(n)]
    seen = 0
    for _ in range(400):
        own = text(r.randint(50, 130))
        copy = list(own)
        for _ in range(r.randint(0, 3)):
            k = r.randrange(5, len(copy) - 5)
            copy[k : k + r.choice([0, 1, 1, r.randint(0, 8)])] = text(r.choice([0, 1, r.randint(0, 12)]))
        if min(len(own), len(copy)) < 50 or jaccard(own, copy) < 0.8:
            continue
        seen += 1
        sides = [passages.word_hashes(" ".join(text(40) + x + text(40))) for x in (copy, own)]
        got = passages.passages(*sides)
        assert got and all(j - i >= 50 and like >= 0.8 for i, j, _, _, like in got), (len(own), len(copy))
        assert sum(j - i for i, j, *_ in got) >= 0.6 * len(copy)
    assert seen > 100
    own = text(80)
    assert passages.passages(*[passages.word_hashes(" ".join(x)) for x in (own[:40] + text(7) + own[40:], own)])
    assert passages.passages(*[passages.word_hashes(" ".join(text(20) + x + text(20))) for x in (own[25:] + own[:25], own)])


def test_agreement_is_an_interval_join():
    """Windows agree exactly if some subsequence of the least width lies in both and holds both centres."""
    r = np.random.default_rng(2)
    w = passages.WIDTH
    for _ in range(200):
        n = int(r.integers(2, 7))
        c, left, right = r.integers(50, 140, (2, n)), r.integers(0, w, (2, n)), r.integers(0, w, (2, n))
        many, f, of = r.random(n) < 0.2, r.integers(0, 3, n), r.integers(0, 2, n)
        b, a = (c[k] * passages.PLACE + left[k] * 128 + right[k] * 2 + (many if k else 0) for k in (0, 1))
        fits = lambda k, x, y: any(max(c[k, x] - left[k, x], c[k, y] - left[k, y]) <= i <= min(c[k, x], c[k, y]) and max(c[k, x], c[k, y]) < i + w <= min(c[k, x] + right[k, x], c[k, y] + right[k, y]) + 1 for i in range(240))
        want = [any(f[x] != f[y] and of[x] == of[y] and fits(0, x, y) and (many[x] or many[y] or fits(1, x, y)) for y in range(n)) for x in range(n)]
        assert passages.agreeing(of, f, b, a).tolist() == want


def test_against_all_pairs(spark):
    """The smallest documents: every text that has a passage of some earlier text, all pairs tried."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    rows = [(x["doc_id"], passages.word_hashes(x["text"])) for x in docs.where("text IS NOT NULL").orderBy("doc_id").collect()]
    want = {d for k, (d, w) in enumerate(rows) if any(passages.passages(w, v) for _, v in rows[:k])}
    got = {x["doc_id"] for x in passages.repeated_passages(docs).collect()}
    assert want and got <= want and len(want - got) <= len(want) // 50


def test_one_id_for_several_texts(spark):
    r = random.Random(9)
    text = lambda n: " ".join("".join(r.choice("abcdefghij") for _ in range(6)) for _ in range(n))
    p, q = text(60), text(55)
    rows = [(1, f"{text(30)} {p}"), (1, q), (2, "a b"), (2, f"{text(90)} {p} {text(9)}"), (2, ""), (2, f"{q} {text(70)}"), (3, p), (3, p), (None, q), (4, None), (5, f"{text(3000)} {q} {text(3000)}")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = [(x["doc_id"], x["text"]) for x in passages.without_passages(docs).collect()]
    assert sorted(map(str, got)) == sorted(map(str, [(d, None if t is None else t.replace(p, "").replace(q, "") if d in (2, 5) else t) for d, t in rows if d != 3]))
    assert passages.without_passages(docs.where("false")).count() == 0
    assert passages.cut("a b", [(10, 60)]) == "a b" and passages.cut("", [(0, 50)]) == "" and passages.cut("a b c", [(1, 9)]) == "a "
