"""Components against union-find, with a node that holds most links."""

import random

from hushwire.llm.graph import components


def test_components(spark):
    r = random.Random(3)
    links = [(5, i) for i in range(10_000, 20_000)] + [(i, i + 1) for i in range(100, 160)] + [(r.randrange(200, 900), r.randrange(200, 900)) for _ in range(400)] + [(7, 7), (15_000, 99)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        if a != b:
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    got = {x["node"]: x["root"] for x in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {x: find(x) for x in root}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
