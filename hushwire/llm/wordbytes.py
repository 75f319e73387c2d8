"""Words of a batch of texts, found on its bytes: no object is made for a word."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

WORD, BLANK, BREAK = 0, 1, 2


def classes(blank: bytes = b"", stop: bytes = b"") -> np.ndarray:
    """The class of every byte: blank ones part words, stops part pieces too, all others are of words."""
    kind = np.zeros(256, np.uint8)
    kind[list(blank)] = BLANK
    kind[list(stop)] = BREAK
    return kind


#: Only A-Z are lower-cased; bytes of longer characters are beyond 127 and stay.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


@dataclass(frozen=True)
class Words:
    """words: their bytes, in order; row: the text that each is of; piece: a number that words of a piece share."""

    words: pa.Array
    row: np.ndarray
    piece: np.ndarray


def bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts and where each begins and ends in them; a null text has none."""
    c = texts.fill_null("").cast(pa.large_binary())
    offsets = np.frombuffer(c.buffers()[1], np.int64)[c.offset : c.offset + len(c) + 1]
    data = np.frombuffer(c.buffers()[2], np.uint8)[offsets[0] : offsets[-1]] if offsets[-1] > offsets[0] else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def cut(texts: pa.Array, kind: np.ndarray) -> Words:
    """The lower-cased words of texts, by the classes of their bytes."""
    data, offsets = bytes_of(texts)
    data = LOWER[data]
    sort = kind[data]
    inner = np.zeros(len(data) + 2, bool)
    inner[1:-1] = sort == WORD
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    starts = np.flatnonzero(inner[1:] & (~inner[:-1] | edge))
    ends = np.flatnonzero(inner[:-1] & (~inner[1:] | edge))
    places = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(ends - starts, out=places[1:])
    held = data[sort == WORD]
    words = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(places), pa.py_buffer(held)])
    row = np.searchsorted(offsets, starts, "right") - 1
    stops = np.flatnonzero(sort == BREAK)
    piece = np.searchsorted(stops, starts) + row
    return Words(words, row, piece)
