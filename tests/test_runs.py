import random
import time
from difflib import SequenceMatcher

import pytest

from hushwire.functions import runs
from hushwire.operators import words


def plain(left, right):
    return [tuple(m) for m in SequenceMatcher(None, left, right, autojunk=False).get_matching_blocks() if m.size]


@pytest.mark.parametrize("direct", [0, 12, runs.DIRECT])
def test_same_runs_as_plain(monkeypatch, direct):
    monkeypatch.setattr(runs, "DIRECT", direct)
    r = random.Random(3)
    for _ in range(600):
        kinds, n = r.choice([1, 2, 3, 8, 40]), r.randrange(60)
        left = [str(r.randrange(kinds)) for _ in range(n)]
        right = [t for t in left if r.random() < 0.8] if r.random() < 0.5 else [str(r.randrange(kinds)) for _ in range(r.randrange(60))]
        assert runs.common_runs(left, right) == plain(left, right)


def test_matched_equals_opcodes():
    r = random.Random(4)
    for _ in range(200):
        said = [r.choice("a b c 1 22 d e".split()) for _ in range(r.randrange(40))]
        timed = [r.choice("a b c 1 22 d e".split()) if r.random() < 0.3 else t for t in said if r.random() < 0.9]
        want = []
        for kind, a, b, c, d in SequenceMatcher(None, said, timed, autojunk=False).get_opcodes():
            if kind in ("equal", "replace") and b - a == d - c:
                want += [(i, j) for i, j in zip(range(a, b), range(c, d), strict=True) if kind == "equal" or words.alike(said[i], timed[j])]
        assert words.matched(said, timed) == want
    assert words.matched([], []) == [] and words.matched(["a"], []) == []


def test_long_call():
    """20,000 words of few kinds, a tenth of them changed; every second word changed; the same ten words over."""
    r = random.Random(5)
    common = [f"w{int(r.paretovariate(0.7))}" for _ in range(20_000)]
    changed = [w if r.random() < 0.9 else "x" for w in common]
    second = [w if i % 2 else f"y{i}" for i, w in enumerate(common)]
    over = [f"v{i % 10}" for i in range(20_000)]
    for left, right, least in ((common, changed, 0.3), (common, second, 0), (over, [*over[7:], "z"], 0.9)):
        began = time.time()
        got = runs.common_runs(left, right)
        assert time.time() - began < 10
        assert all(left[i : i + k] == right[j : j + k] for i, j, k in got) and all(p[0] + p[2] <= q[0] and p[1] + p[2] <= q[1] for p, q in zip(got, got[1:], strict=False))
        assert sum(k for *_, k in got) >= least * len(left)
    # short runs of frequent words are taken from the left on, as the plain form does
    assert runs.common_runs(common[:2000], second[:2000]) == plain(common[:2000], second[:2000])
