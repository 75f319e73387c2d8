"""Pieces are looked up for whole arrays of words at once, and as a plain table would find them."""

import cProfile
import pstats
import random

import numpy as np

from hushwire.llm import language


def made(n, letters, most, seed):
    r = random.Random(seed)
    return ["".join(r.choice(letters) for _ in range(r.randint(1, most))) for _ in range(n)]


def test_steps_are_those_of_a_plain_table():
    pieces = list(dict.fromkeys(made(3000, "abcé漢😀\ud800", 6, 1)))
    trie, at = language.Trie(pieces), {p: i for i, p in enumerate(pieces)}
    begins = {p[:n] for p in pieces for n in range(1, len(p) + 1)}
    for w in [*pieces[:500], *made(1500, "abcé漢😀\ud800z", 8, 2)]:
        node = np.zeros(1, np.int64)
        for n, c in enumerate(w, 1):
            node = trie.step(node, np.array([ord(c)]))
            assert (node[0] >= 0) == (w[:n] in begins)
            if node[0] < 0:
                break
            assert trie.piece[node[0]] == at.get(w[:n], -1)


def test_sums_take_no_call_a_character():
    pieces = [language.MARK, *dict.fromkeys(made(200, "abcdé", 5, 3))]
    p = np.random.default_rng(1).random((len(pieces) + 1, 3)) / len(pieces)
    forward, words = language.Forward(pieces, p), list(dict.fromkeys(made(20_000, "abcdéx", 12, 4)))
    seen = cProfile.Profile()
    got = seen.runcall(forward.words, words)
    assert pstats.Stats(seen).total_calls < sum(map(len, words))
    at = {x: i for i, x in enumerate(pieces)}
    for w, logs in list(zip(words, got, strict=True))[:300]:
        t, sums = language.MARK + w, [np.ones(3)]
        for i in range(1, len(t) + 1):
            sums.append(sum(p[at.get(t[j:i], -1)] * sums[j] for j in range(i) if t[j:i] in at or j == i - 1))
        assert np.allclose(logs, np.log(sums[-1]), rtol=0, atol=1e-9)
