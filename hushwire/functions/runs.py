"""Longest common runs of two token lists, with equality of windows decided by numbers and not by comparison."""

from __future__ import annotations

from difflib import SequenceMatcher

import numpy as np

#: Ranges with at most this many pairs of tokens are compared directly.
DIRECT = 4096


class Windows:
    """Windows of two lists side by side, by number: two windows of one length have equal numbers just if
    they hold the same tokens.  Numbers of lengths 1, 2, 4, ... are kept; any other length is two of those that
    overlap."""

    def __init__(self, left: list[str], right: list[str]):
        names: dict[str, int] = {}
        self.left, self.right, self.n = left, right, len(left)
        self.numbers = [np.array([names.setdefault(t, len(names)) for part in (left, right) for t in part], np.int64)]
        self.base = len(self.numbers[0]) + 1

    def keys(self, start: int, stop: int, size: int) -> np.ndarray:
        """Numbers of the windows of `size` tokens that lie within start..stop."""
        p = size.bit_length() - 1
        while len(self.numbers) <= p:
            last, half = self.numbers[-1], 1 << (len(self.numbers) - 1)
            self.numbers.append(np.unique(last[:-half] * self.base + last[half:], return_inverse=True)[1])
        own, rest = self.numbers[p], size - (1 << p)
        return own[start : stop - size + 1] * self.base + own[start + rest : stop - size + 1 + rest]

    def common(self, a: int, b: int, c: int, d: int, size: int) -> bool:
        return bool(np.isin(self.keys(a, b, size), self.keys(self.n + c, self.n + d, size)).any())

    def longest(self, a: int, b: int, c: int, d: int, most: int) -> int:
        """Tokens of the longest common run of left[a:b] and right[c:d]; every run holds all shorter ones."""
        most = min(b - a, d - c, most)
        size = 1
        if most < 1 or not self.common(a, b, c, d, 1):
            return 0
        while 2 * size <= most and self.common(a, b, c, d, 2 * size):
            size *= 2
        least, size = size, min(most, 2 * size - 1)
        while least < size:
            half = (least + size + 1) // 2
            least, size = (half, size) if self.common(a, b, c, d, half) else (least, half - 1)
        return least

    def picked(self, a: int, b: int, c: int, d: int, size: int) -> list[tuple[int, int]]:
        """Common runs of `size`, the longest there is: the first on the left, its first place on the right,
        then the same beyond both."""
        own, other = self.keys(a, b, size), self.keys(self.n + c, self.n + d, size)
        order = np.argsort(other, kind="stable")
        ranked, out, i_free, j_free = other[order], [], 0, 0
        hits = np.flatnonzero(np.isin(own, other))
        first, last = np.searchsorted(ranked, own[hits], "left"), np.searchsorted(ranked, own[hits], "right")
        for i, x, y in zip(hits.tolist(), first.tolist(), last.tolist(), strict=True):
            if i >= i_free:
                x += int(np.searchsorted(order[x:y], j_free))
                if x < y:
                    j = int(order[x])
                    out.append((a + i, c + j))
                    i_free, j_free = i + size, j + size
        return out


def common_runs(left: list[str], right: list[str]) -> list[tuple[int, int, int]]:
    """(place on the left, place on the right, length) of the common runs found by taking the longest first
    (of equal ones the first on the left, then on the right) and going on before and behind it; runs that
    touch on both sides are one.  Runs of one length are taken in one pass, so regular texts cost no more
    than others."""
    w, found = Windows(left, right), []
    todo = [(0, len(left), 0, len(right), len(left))]
    while todo:
        a, b, c, d, most = todo.pop()
        if (b - a) * (d - c) <= DIRECT:
            found += [(a + i, c + j, k) for i, j, k in SequenceMatcher(None, left[a:b], right[c:d], autojunk=False).get_matching_blocks() if k]
            continue
        size = w.longest(a, b, c, d, most)
        if size:
            i0, j0 = a, c
            for i, j in [*w.picked(a, b, c, d, size), (b, d)]:
                todo.append((i0, i, j0, j, size))
                if i < b:
                    found.append((i, j, size))
                i0, j0 = i + size, j + size
    out: list[tuple[int, int, int]] = []
    for i, j, k in sorted(found):
        if out and out[-1][0] + out[-1][2] == i and out[-1][1] + out[-1][2] == j:
            i, j, k = *out[-1][:2], out.pop()[2] + k
        out.append((i, j, k))
    return out
