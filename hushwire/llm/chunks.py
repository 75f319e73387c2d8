"""Ids of whole texts by way of a bounded table of chunks.

The public split pattern never joins two chunks that a single space or line feed separates: a lone space
goes with the chunk after it, a lone line feed stands for itself.  So a text whose white space is single
spaces and line feeds only is encoded chunk by chunk; every other text is encoded whole.
"""

from __future__ import annotations

from collections.abc import Callable


def split_chunk(text: str, split: Callable[[str], list[str]]) -> list[str]:
    """The split pattern's matches.  A word of letters, with or without one space before and full stops
    or commas after it, needs no pattern."""
    word = text.rstrip(".,")
    if word[word[:1] == " " :].isalpha():
        return [word, text[len(word) :]] if len(word) < len(text) else [word]
    return split(text)


class Table(dict):
    """chunk -> bytes of its ids; computes what it lacks and keeps it while there is room."""

    def __init__(self, encode: Callable[[str], bytes], lead: str, room: int):
        super().__init__()
        self.encode, self.lead, self.room = encode, lead, room

    def __missing__(self, chunk: str) -> bytes:
        ids = self.encode(self.lead + chunk)
        if len(self) < self.room:
            self[chunk] = ids
        return ids


class ChunkEncoder:
    def __init__(self, encode: Callable[[str], bytes], room: int = 400_000):
        """encode: any text to the little-endian unsigned 32-bit bytes of its ids."""
        self.encode = encode
        self.bare, self.spaced = Table(encode, "", room // 4), Table(encode, " ", room)
        self.feed = encode("\n")

    def ids(self, text: str) -> bytes:
        words = text.split()
        breaks = text.count(" ") + text.count("\n")
        if len(words) != breaks + 1 or sum(map(len, words)) + breaks != len(text):
            return self.encode(text)
        out: list[bytes] = []
        for line in text.split("\n"):
            first, *rest = line.split(" ")
            out.append(self.feed)
            out.append(self.bare[first])
            out.extend(map(self.spaced.__getitem__, rest))
        return b"".join(out[1:])
