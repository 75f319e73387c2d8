"""Byte-level BPE as a lazily determinised finite-state transducer, and streaming decoding.

BPE with merge ranks has the prefix property: the encoding of a prefix of a piece, cut at a token's end,
is a prefix of that encoding.  So the encoding of the first i bytes ends in the one token t for which the
encoding before t may be followed by t: the two tokens, joined and merged anew, stay themselves.  A state
of the transducer holds what the future can depend on: the longest suffix read that some token begins
with, and for every position in it the token that ends there.  Reading a byte adds the token that ends
after it; tokens common to the paths of all positions of the suffix are final and are emitted, so the
lookahead is bounded.  States and arcs are made when first needed and are kept up to a bound.

A piece that is itself a token is that token, as in the public library.
"""

from __future__ import annotations

import base64
import gc
import hashlib
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hushwire.llm.chunks import ChunkEncoder, Table, split_chunk
from hushwire.llm.common import map_arrow, table

#: White space as Unicode's White_Space property has it, for the split pattern's \s and \S.
SPACE = r"\t-\r \x85\xa0  -     　"
#: States kept before the transducer starts anew.
STATES = 200_000
#: Chunks and split pieces whose ids a task keeps.
CHUNKS, PIECES = 250_000, 250_000
#: Bytes after which the ids of a piece are handed on as far as they are final.
WINDOW = 256


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def pattern_with_space(pattern: str) -> str:
    """The split pattern with \\s and \\S written out, also within negated classes."""
    return pattern.replace(r"[^\s", f"[^{SPACE}").replace(r"\S", f"[^{SPACE}]").replace(r"\s", f"[{SPACE}]")


def merge(ranks: dict[bytes, int], piece: bytes) -> list[int]:
    """Plain BPE of one piece by ranks: the definition that the transducer compiles."""
    parts = [piece[i : i + 1] for i in range(len(piece))]
    while len(parts) > 1:
        best, at = min((ranks.get(parts[i] + parts[i + 1], 1 << 60), i) for i in range(len(parts) - 1))
        if best == 1 << 60:
            break
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return [ranks[p] for p in parts]


class Place:
    """A suffix that begins some token, with what reading a byte does whatever the tokens before: which
    tokens may end there, what suffix is left, and which positions some token begins at."""

    __slots__ = ("live", "shapes", "states", "suffix")

    def __init__(self, suffix: bytes, begins: set[bytes]):
        self.suffix = suffix
        self.live = [i for i in range(len(suffix)) if suffix[i:] in begins] + [len(suffix)]
        self.shapes: dict[int, tuple[list[tuple[int, int]], list[int], Place]] = {}
        self.states: dict[tuple[int, ...], State] = {}


class State(dict):
    """Byte -> the state after it, made when first asked for.  place: the longest suffix read that begins
    some token; lasts: for the positions in it that some token begins at, and for its end, the token that
    ends there (-1: the beginning of the piece).  The last of them is the state's own token."""

    __slots__ = ("lasts", "machine", "packed", "place", "size", "token")

    def __init__(self, machine: Transducer, place: Place, lasts: tuple[int, ...]):
        self.machine, self.place, self.lasts, self.token = machine, place, lasts, lasts[-1]
        self.size, self.packed = len(machine.tokens.get(self.token, b"")), machine.packed.get(self.token)

    def __missing__(self, byte: int) -> State:
        found = self[byte] = self.machine.arc(self, byte)
        return found


class Transducer:
    def __init__(self, ranks: dict[bytes, int], most: int = STATES):
        self.ranks, self.most = ranks, most
        self.tokens = {i: b for b, i in ranks.items()}
        self.packed = {i: i.to_bytes(4, "little") for i in ranks.values()}
        self.begins = {b[:n] for b in ranks for n in range(1, len(b) + 1)}
        self.edges: dict[int, tuple[tuple[int, ...], tuple[int, ...]] | None] = {}
        self.pairs: dict[tuple[int, int], bool] = {}
        self.reset()

    def reset(self) -> None:
        for place in getattr(self, "places", {}).values():  # states lead to each other: untied, they go at once
            for state in place.states.values():
                state.clear()
            place.states.clear()
            place.shapes.clear()
        self.places: dict[bytes, Place] = {}
        self.made = 0
        self.start = self.state(self.place(b""), (-1,))

    def place(self, suffix: bytes) -> Place:
        found = self.places.get(suffix)
        if found is None:
            found = self.places[suffix] = Place(suffix, self.begins)
        return found

    def state(self, place: Place, lasts: tuple[int, ...]) -> State:
        found = place.states.get(lasts)
        if found is None:
            found = place.states[lasts] = State(self, place, lasts)
            self.made += 1
        return found

    def edge(self, token: int) -> tuple[tuple[int, ...], tuple[int, ...]] | None:
        """The tokens that stand, one after the other, at the left and at the right end while a token is
        merged from its bytes; None for a token that merging never makes."""
        if token in self.edges:
            return self.edges[token]
        parts = [self.tokens[token][i : i + 1] for i in range(len(self.tokens[token]))]
        left, right = [self.ranks[parts[0]]], [self.ranks[parts[-1]]]
        while len(parts) > 1:
            best, at = min((self.ranks.get(parts[i] + parts[i + 1], 1 << 60), i) for i in range(len(parts) - 1))
            if best == 1 << 60:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            if at == 0:
                left.append(best)
            if at == len(parts) - 1:
                right.append(best)
        found = self.edges[token] = (tuple(left), tuple(right)) if len(parts) == 1 else None
        return found

    def follows(self, a: int, b: int) -> bool:
        """Whether token b may come next after token a (-1: the beginning): replay, in order of rank, the
        merges at both sides of the boundary; a merge across it that comes first forbids the pair."""
        ours = self.edge(b)
        if ours is None or a < 0:
            return ours is not None
        found = self.pairs.get((a, b))
        if found is not None:
            return found
        right, left = self.edge(a)[1], ours[0]
        i = j = 0
        ok = True
        while True:
            across = self.ranks.get(self.tokens[right[i]] + self.tokens[left[j]], 1 << 60)
            on_left = right[i + 1] if i + 1 < len(right) else 1 << 60
            on_right = left[j + 1] if j + 1 < len(left) else 1 << 60
            if across < on_left and across <= on_right and across < 1 << 60:
                ok = False
                break
            if on_left == on_right == 1 << 60:
                break
            if on_left <= on_right:
                i += 1
            else:
                j += 1
        if len(self.pairs) > 400_000:
            self.pairs.clear()
        self.pairs[a, b] = ok
        return ok

    def shape(self, place: Place, byte: int) -> tuple[list[tuple[int, int]], list[int], Place]:
        """The tokens that may end after one more byte, longest first, each with where the token before it is
        in a state's lasts; which of the lasts stay; and the place after it."""
        read, live, k = place.suffix + bytes((byte,)), place.live, 0
        ends = [(n, self.ranks[read[i:]]) for n, i in enumerate(live) if read[i:] in self.ranks]
        while read[k:] not in self.begins:
            k += 1
        # where no token begins with what follows a position, its last token cannot matter
        stay = [n for n, i in enumerate(live) if i >= k and read[i:] in self.begins]
        found = place.shapes[byte] = ends, stay, self.place(read[k:])
        return found

    def arc(self, state: State, byte: int) -> State:
        """The state after one more byte."""
        ends, stay, to = state.place.shapes.get(byte) or self.shape(state.place, byte)
        lasts, pairs = state.lasts, self.pairs
        for n, token in ends:
            ok = pairs.get((lasts[n], token))
            if ok or ok is None and self.follows(lasts[n], token):
                break
        return self.state(to, (*[lasts[n] for n in stay], token))

    def encode(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        return [i for part in self.stream(piece) for i in part]

    def encode_packed(self, piece: bytes) -> bytes:
        """The ids as little-endian unsigned 32-bit bytes; short pieces need no stream."""
        packed = self.packed
        whole = self.ranks.get(piece)
        if whole is not None:
            return packed[whole]
        if len(piece) >= WINDOW:
            return np.array([i for part in self.stream(piece) for i in part], "<u4").tobytes()
        if self.made > self.most:
            self.reset()
        state, path = self.start, []
        for byte in piece:
            state = state[byte]
            path.append(state)
        at, out = len(path), []
        while at > 0:
            state = path[at - 1]
            out.append(state.packed)
            at -= state.size
        return b"".join(out[::-1])

    def stream(self, piece: bytes, window: int = WINDOW):
        """Yield tokens as soon as every continuation shares them; looks at most `window` bytes, or the
        longest token if that is more, beyond what was yielded."""
        if self.made > self.most:
            self.reset()
        state, ends = self.start, []  # ends[i]: the token that ends after byte i of those not yielded
        for byte in piece:
            state = state[byte]
            ends.append(state.token)
            if len(ends) >= window and len(ends) % window == 0:
                live = {len(ends) - k for k in range(len(state.place.suffix) + 1)}
                while len(live) > 1:  # back to where all pending paths meet
                    top = max(live)
                    live.remove(top)
                    live.add(top - len(self.tokens[ends[top - 1]]))
                meet = live.pop()
                if meet > 0:
                    yield self.path(ends[:meet])
                    ends = ends[meet:]
        yield self.path(ends)

    def path(self, ends: list[int]) -> list[int]:
        out, at = [], len(ends)
        while at > 0:
            out.append(ends[at - 1])
            at -= len(self.tokens[ends[at - 1]])
        return out[::-1]


#: States of the UTF-8 machine: 0 between characters, then what continuation bytes are awaited, then the
#: sink for malformed input.  Ranges are those of the Unicode standard's table of well-formed sequences.
DONE, ONE, TWO, THREE, E0, ED, F0, F4, BAD = range(9)


def utf8_step(state: int, byte: int) -> int:
    if state == DONE:
        if byte < 0x80:
            return DONE
        if 0xC2 <= byte <= 0xDF:
            return ONE
        if 0xE0 <= byte <= 0xEF:
            return {0xE0: E0, 0xED: ED}.get(byte, TWO)
        if 0xF0 <= byte <= 0xF4:
            return {0xF0: F0, 0xF4: F4}.get(byte, THREE)
        return BAD
    low, high, to = {ONE: (0x80, 0xBF, DONE), TWO: (0x80, 0xBF, ONE), THREE: (0x80, 0xBF, TWO), E0: (0xA0, 0xBF, ONE), ED: (0x80, 0x9F, ONE), F0: (0x90, 0xBF, TWO), F4: (0x80, 0x8F, TWO)}.get(state, (1, 0, BAD))
    return to if low <= byte <= high else BAD


class Gather:
    """Concatenates table entries by index, whole arrays at a time."""

    def __init__(self, entries: list[bytes]):
        self.length = np.array([len(t) for t in entries], np.int64)
        self.begin = np.concatenate([[0], np.cumsum(self.length)])[:-1]
        self.bytes = np.frombuffer(b"".join(entries), np.uint8)

    def join(self, ids: np.ndarray) -> bytes:
        n = self.length[ids]
        ends = np.cumsum(n)
        if not len(ends):
            return b""
        at = np.arange(ends[-1]) + np.repeat(self.begin[ids] - (ends - n), n)
        return self.bytes[at].tobytes()


class Decoder:
    """Ids back to bytes; the UTF-8 machine runs over whole tokens by a table of state x token."""

    def __init__(self, ranks: dict[bytes, int]):
        size = max(ranks.values()) + 1
        tokens = [b""] * size
        for b, i in ranks.items():
            tokens[i] = b
        self.gather = Gather(tokens)
        self.tokens = tokens
        self.step = np.zeros((9, size), np.uint8)
        table_ = [[utf8_step(s, b) for b in range(256)] for s in range(9)]
        for i, t in enumerate(tokens):
            for s in range(9):
                to = s
                for b in t:
                    to = table_[to][b]
                self.step[s, i] = to
        self.odd = (self.step[DONE] != DONE) & (self.gather.length > 0)

    def decode(self, ids: np.ndarray, part: int = 1 << 16) -> tuple[bytes, int]:
        """Bytes of the ids, and the state of the UTF-8 machine after them: DONE if they end a well-formed
        text.  Ids are decoded by parts; each part is handed on up to the last whole character, and the
        bytes of an unfinished one are held until the next part completes it, as in a stream."""
        out, held, state = [], b"", DONE
        for a in range(0, len(ids), part):
            some = ids[a : a + part]
            raw = held + self.gather.join(some)
            state = self.run(some, state)
            cut = len(raw)
            if state not in (DONE, BAD):  # back to where the unfinished character begins
                cut -= 1
                while raw[cut] & 0xC0 == 0x80:
                    cut -= 1
            out.append(raw[:cut])
            held = raw[cut:]
        return b"".join(out) + held, state

    def run(self, ids: np.ndarray, state: int = DONE) -> int:
        """State of the machine after these tokens; BAD holds.  Only tokens that leave the machine within a
        character are stepped one by one."""
        at = 0
        while at < len(ids) and state != BAD:
            if state == DONE:
                some = self.odd[ids[at : at + 4096]]
                odd = int(some.argmax())
                if not some[odd]:
                    at += len(some)
                    continue
                at += odd
            state = int(self.step[state, ids[at]])
            at += 1
        return state

    def stream(self, ids, state: int = DONE, held: bytes = b""):
        """Yield text as soon as whole characters are there; keeps bytes of an unfinished one back."""
        for i in ids:
            held += self.tokens[i]
            state = int(self.step[state, i])
            if state == BAD:
                yield held.decode("utf-8", "replace")
                state, held = DONE, b""
            elif state == DONE:
                yield held.decode("utf-8")
                held = b""
            else:
                cut = len(held) - 1
                while cut and held[cut] & 0xC0 == 0x80:
                    cut -= 1
                if cut:
                    yield held[:cut].decode("utf-8")
                    held = held[cut:]
        if held:
            yield held.decode("utf-8", "replace")


@lru_cache(2)
def tools(ranks_path: str, spaced: str):
    """What a worker process keeps from task to task: tables of bounded size and the machines."""
    import regex

    ranks = load_ranks(ranks_path)
    machine = Transducer(ranks)
    split = regex.compile(spaced).findall
    pieces = Table(lambda p: machine.encode_packed(p.encode("utf-8", "surrogatepass")), "", PIECES)
    chunks = ChunkEncoder(lambda text: b"".join([pieces[p] for p in split_chunk(text, split)]), CHUNKS)
    return chunks, Decoder(ranks), Gather([b"%d," % i for i in range(max(ranks.values()) + 1)])


SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, well_formed boolean"


def encode_decode(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """Ids of every whole text (null counts as empty) and their decoding, as digests; well_formed says
    that the decoded bytes end a well-formed UTF-8 text.  Repeated rows are each encoded, an empty table
    gives an empty result, extra columns are ignored; long texts are encoded and decoded whole."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    spaced = pattern_with_space(pattern)

    def make():
        chunks, decoder, names = tools(ranks_path, spaced)

        def run(c):
            gc.disable()  # it would walk the machine's states again and again; a batch leaves no cycles
            try:
                return digests(c)
            finally:
                gc.enable()

        def digests(c):
            out: dict[str, list] = {"n_tokens": [], "ids_sha256": [], "decoded_sha256": [], "well_formed": []}
            for text in c["text"].to_pylist():
                raw = chunks.ids(text or "")
                ids = np.frombuffer(raw, "<u4")
                out["n_tokens"].append(len(ids))
                out["ids_sha256"].append(hashlib.sha256(names.join(ids)[:-1]).hexdigest())
                raw, state = decoder.decode(ids)
                out["decoded_sha256"].append(hashlib.sha256(raw).hexdigest())
                out["well_formed"].append(state == DONE)
            return out | {"doc_id": c["doc_id"]}

        return run

    return map_arrow(rows, make, SCHEMA, "text")


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and decoding of all documents; see encode_decode for nulls, repeats and empty tables."""
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return encode_decode(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
