"""Substring near-deduplication by compact windows.

The tokens of a text are its five-word shingles (words lower-cased in A-Z, between white space).  Under
each of HASHES hash functions, a Cartesian tree over the tokens' hashes splits a text's subsequences into
compact windows (l, c, r): every subsequence within l..r that holds c has its least hash at c.  Windows as
wide as the shortest passage are kept, about two for each such width.  Windows of one least hash group the
subsequences that share it.  Later texts are joined with the first text of a group and with the one before,
so a passage in thousands of texts gives as many pairs and not their square.  The colliding windows
of a pair are joined as intervals: windows of enough functions must hold one subsequence as long as the
shortest passage, in both texts.  Such pairs are aligned and verified on all their words.

Where the first text of a group has another passage, what is left over is looked up anew: by exact
stretches as long as the shortest passage where windows of all functions hold one, and by short runs where
windows of enough functions do.  Either leads to the first text that has the stretch or the run.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from hushwire.llm.common import as_batch, drop_kept, free_name, hot_keys, join_hot, keep, map_arrow, partitions, slices, table

SHINGLE, SIMILARITY = 5, 0.8
#: Shortest passage in words, hash functions, and functions that must agree for a pair of texts.
LEAST_WORDS, HASHES, ENOUGH = 50, 5, 2
#: What an unmatched token costs where a matched one earns 1: a sum of 0 is a similarity of 0.8.
COST = 4
#: Unmatched tokens between stretches that are compared as sets, when they are in another order.
GAP = 2 * SHINGLE
#: Tokens of the runs by which near passages left over are looked up, and the runs side by side of which
#: the least by hash is taken: any ten equal tokens give both texts one of them.
RUN, SPARSE = 6, 5
#: Bytes of texts, words or collisions that a task works on at once; its arrays take many times that.
PART_BYTES = 1 << 20
#: One text of so many is looked at to tell which keys are crowded.
SAMPLED = 64

WORD = re.compile("[^\\x20\\x09-\\x0D]+")
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
WIDTH = LEAST_WORDS - SHINGLE + 1


def mixed(x: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit finaliser; with different seeds, different hash functions."""
    x = (x ^ np.uint64(seed * 0xD1342543DE82EF95 & (1 << 64) - 1)) * MULTIPLIER
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def word_hashes(text: str | None) -> np.ndarray:
    from xxhash import xxh64_intdigest as h

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    return np.array([h(w) for w in words], np.uint64)


def shingles(w: np.ndarray) -> np.ndarray:
    n = len(w) - SHINGLE + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for j in range(SHINGLE):
        out = out * MULTIPLIER + w[j : j + n]
    return out


def sliding(x: np.ndarray, width: int, op) -> np.ndarray:
    """op (minimum or maximum) over every window of `width`, in log(width) passes."""
    n, w, cur = len(x), 1, x
    while 2 * w <= width:
        cur = op(cur[:-w], cur[w:])
        w *= 2
    return op(cur[: n - width + 1], cur[width - w : n - w + 1])


def compact_windows(h: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """l, c, r of all compact windows at least `width` wide.  h may be several texts with a 0 between,
    before and after them; other hashes are not 0.  Of equal hashes the first counts as the least.

    Only positions that are the least of some `width` positions can have such a window, and the nearest
    smaller neighbours of such a position are of the same kind, so the tree is built over these alone."""
    if len(h) < width:
        return (np.zeros(0, np.int64),) * 3
    m = sliding(h, width, np.minimum)
    pad = np.zeros(width - 1, np.uint64)
    top = sliding(np.concatenate([pad, m, pad]), width, np.maximum)
    at = np.flatnonzero((top == h) | (h == 0))
    values = h[at].tolist()
    left, right, stack = [0] * len(values), [len(values)] * len(values), []
    for i, v in enumerate(values):
        while stack and values[stack[-1]] > v:
            right[stack.pop()] = i
        left[i] = stack[-1] if stack else -1
        stack.append(i)
    edge = np.append(at, [len(h), -1])
    lo, hi = edge[np.array(left)] + 1, edge[np.array(right)] - 1
    ok = (hi - lo + 1 >= width) & (h[at] != 0)
    return lo[ok], at[ok], hi[ok]


#: A place packs a window: its centre, how far it reaches to the left and to the right of it (as far as a
#: shortest passage can), and whether its text has the key elsewhere too.
REACH, PLACE = WIDTH - 1, 1 << 15


def unpacked(place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """l, c, r and whether the key is elsewhere too."""
    c = place >> 15
    return c - (place >> 7 & 63), c, c + (place >> 1 & 63), (place & 1).astype(bool)


SKETCH = "doc_id long, text_hash long, n int, words binary, keys array<long>, places array<long>"


def sketches(docs: DataFrame) -> DataFrame:
    """Every text's words, four bytes of the hash of each, and its compact windows: their least hash, with the function's number in its low bits, and place.
    All that follows is done on these."""
    rows = docs.where(F.col("doc_id").isNotNull() & F.col("text").isNotNull())
    rows = rows.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")

    def make():
        def run(c):
            hashes = [word_hashes(t) for t in c["text"].to_pylist()]
            tokens = [shingles(w) for w in hashes]
            used = [k for k, s in enumerate(tokens) if len(s) >= WIDTH]
            keys, places = [np.zeros(0, np.int64)] * len(tokens), [np.zeros(0, np.int64)] * len(tokens)
            if used:
                flat, real, start = laid([tokens[k] for k in used])
                found = [np.concatenate(x) for x in zip(*keyed(flat, real, start), strict=True)]
                order = np.argsort(found[1], kind="stable")
                key, of, place = (x[order] for x in found)
                edges = np.searchsorted(of, np.arange(len(used) + 1))
                for n, k in enumerate(used):
                    keys[k], places[k] = key[edges[n] : edges[n + 1]], place[edges[n] : edges[n + 1]]
            return {
                "doc_id": c["doc_id"], "text_hash": c["text_hash"], "n": [len(w) for w in hashes],
                "words": [(w & np.uint64(0xFFFFFFFF)).astype("<u4").tobytes() for w in hashes], "keys": keys, "places": places,
            }

        return run

    return map_arrow(rows, make, SKETCH, "text", PART_BYTES)


def laid(tokens: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tokens of several texts with a 0 between, before and after them; where they are real; and where
    each text starts."""
    zero = np.zeros(1, bool)
    real = np.concatenate([zero, *(x for s in tokens for x in (np.ones(len(s), bool), zero))])
    start = np.cumsum([1, *(len(s) + 1 for s in tokens)])
    flat = np.zeros(len(real), np.uint64)
    flat[real] = np.concatenate(tokens)
    return flat, real, start


def keyed(flat: np.ndarray, real: np.ndarray, start: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each function: the keys of all compact windows, their texts and their places."""
    edge = np.zeros(REACH, np.uint64)
    near = spanned(np.concatenate([edge, flat, edge]), 2 * REACH + 1)
    for f in range(HASHES):
        h = (mixed(flat, f + 1) & np.uint64((1 << 64) - 8)) | np.uint64(f)
        h[h < 8] += np.uint64(8)
        h[~real] = 0
        lo, at, hi = compact_windows(h, WIDTH)
        of = np.searchsorted(start, at, side="right") - 1
        mark = mixed(h[at] + of.astype(np.uint64) * MULTIPLIER, 7)
        _, same, times = np.unique(mark, return_inverse=True, return_counts=True)
        left, right = np.minimum(at - lo, REACH), np.minimum(hi - at, REACH)
        # of places of one key with the same tokens around, as in a line repeated, the first stands for all
        around = mark * MULTIPLIER + near[at] + (left * 128 + right).astype(np.uint64)
        first = np.sort(np.unique(around, return_index=True)[1])
        place = (at - start[of]) * PLACE + left * 128 + right * 2 + (times[same] > 1)
        yield h[at][first].view(np.int64), of[first], place[first]


def windows(sketch: DataFrame) -> DataFrame:
    return sketch.select("doc_id", F.inline(F.arrays_zip("keys", "places"))).select(F.col("keys").alias("key"), "doc_id", F.col("places").alias("place"))


def crowded(sketch: DataFrame) -> DataFrame:
    """Keys that hold more than their share of the windows (see hot_keys), as a share of the texts has them.
    This decides how rows are dealt out and nothing else."""
    some = windows(sketch.where(F.pmod(F.xxhash64("doc_id", F.lit(9)), F.lit(SAMPLED)) == 0))
    counts = keep(some.groupBy("key").agg(F.count("*").alias("n")), "sampled")
    hot = keep(hot_keys(counts, "key", counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]), "crowded")
    drop_kept(sketch.sparkSession, counts)
    return hot


def followers(found: DataFrame, hot: DataFrame) -> DataFrame:
    """Windows whose key others have too: with the first one of the key, the one before and the number so
    far.  A crowded key is cut into parts; the one before is then that of the part, the first is the
    first of all parts."""
    salt = F.when(F.col("_parts").isNull(), 0).otherwise(F.expr("pmod(xxhash64(doc_id), _parts)")).cast("int")
    dealt = found.join(F.broadcast(hot), "key", "left").withColumn("salt", salt)
    order = Window.partitionBy("key", "salt").orderBy("doc_id", "place")
    here = F.struct("doc_id", "place")
    led = dealt.withColumns({"lead": F.first(here).over(order), "prev": F.lag(here).over(order), "nth": F.row_number().over(order), "later": F.lead("place").over(order)})
    led = led.where("prev IS NOT NULL OR later IS NOT NULL OR _parts IS NOT NULL")
    led = keep(led.select("key", "doc_id", "place", "lead", "prev", F.expr("IF(_parts IS NULL, nth, nth + 3)").alias("nth"), F.col("_parts").isNotNull().alias("hot")), "followers")
    # at most as many rows as there are crowded keys
    first = led.where("hot").groupBy("key").agg(F.min("lead").alias("first"))
    return led.join(F.broadcast(first), "key", "left").withColumn("lead", F.coalesce("first", "lead")).drop("first", "hot")


def agreeing(of: np.ndarray, f: np.ndarray, b: np.ndarray, a: np.ndarray) -> np.ndarray:
    """Which collisions (of pair `of` and function f, of window b with window a) agree with one of another
    function: in both texts their windows hold one subsequence of WIDTH tokens.  Where the source has a key
    elsewhere too, its place there is open.  An interval join by sorted centres: windows further apart
    than REACH hold nothing in common."""
    order = np.lexsort((b, of))
    of, f = of[order], f[order]
    sides = [unpacked(b[order]), unpacked(a[order])]
    centre, loose = sides[0][1], sides[1][3]
    good = np.zeros(len(of), bool)
    for k in range(1, len(of)):
        x, y = slice(None, -k), slice(k, None)
        ok = (of[x] == of[y]) & (centre[y] - centre[x] <= REACH)
        if not ok.any():
            break
        ok &= f[x] != f[y]
        for n, (lo, c, hi, _) in enumerate(sides):
            left, right = np.maximum(lo[x], lo[y]), np.minimum(hi[x], hi[y])
            held = (left <= np.minimum(c[x], c[y])) & (np.maximum(c[x], c[y]) <= right) & (right - left >= WIDTH - 1)
            ok &= held | (loose[x] | loose[y]) if n else held
        good[x] |= ok
        good[y] |= ok
    out = np.zeros(len(of), bool)
    out[order] = good
    return out


#: A pair of texts with the places in the source around which it is compared; `whole` where they are open.
PAIRS = "doc_id long, source_id long, at array<int>, whole boolean"


def pairs(led: DataFrame) -> DataFrame:
    """Pairs of a text with the first text of one of its keys, and with the one before it (whose passage may
    differ from the first's), where windows of enough functions agree."""
    rows = led.select("doc_id", F.expr("CAST(key & 7 AS int)").alias("f"), "place", F.explode(F.array_distinct(F.array("lead", "prev"))).alias("s")).where("s.doc_id <> doc_id")
    both = rows.groupBy("doc_id", F.col("s.doc_id").alias("source_id")).agg(F.collect_list(F.struct("f", F.col("place").alias("b"), F.col("s.place").alias("a"))).alias("hits"))
    both = both.where(F.size(F.array_distinct("hits.f")) >= ENOUGH)

    def make():
        def run(c):
            flat = c["hits"].flatten()
            of = np.repeat(np.arange(len(c["doc_id"])), pc.list_value_length(c["hits"]).to_numpy())
            f, b, a = (flat.field(i).to_numpy() for i in range(3))
            ok = np.flatnonzero(agreeing(of, f, b, a))
            if not len(ok):
                return {}
            of, (_, at, _, loose) = of[ok], unpacked(a[ok])
            used, edge = np.unique(of, return_index=True)
            edge = np.append(edge, len(of))
            return {
                "doc_id": c["doc_id"].take(pa.array(used)), "source_id": c["source_id"].take(pa.array(used)),
                "at": [at[edge[n] : edge[n + 1]] for n in range(len(used))], "whole": [bool(loose[edge[n] : edge[n + 1]].any()) for n in range(len(used))],
            }

        return run

    return map_arrow(both, make, PAIRS, "hits", PART_BYTES)


def spanned(x: np.ndarray, width: int) -> np.ndarray:
    """A hash of every `width` tokens side by side, in log(width) passes."""
    n = len(x) - width + 1
    out, done, cur, w, m = np.zeros(n, np.uint64), 0, x, 1, int(MULTIPLIER)
    while w <= width:
        if width & w:
            out = out * np.uint64(m) + cur[done : done + n]
            done += w
        cur, m, w = cur[:-w] * np.uint64(m) + cur[w:], m * m & (1 << 64) - 1, 2 * w
    return mixed(out, 6)


def counted(n: int, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """For each of n positions, how many of the intervals first..last hold it."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, first, 1)
    np.add.at(change, last + 1, -1)
    return np.cumsum(change)[:n]


def as_words(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, "<u4").astype(np.uint64) + np.uint64(1)


def rest(sketch: DataFrame, led: DataFrame, hot: DataFrame, found: DataFrame, tried: DataFrame) -> DataFrame:
    """The pairs of texts that the first and previous texts of the keys (the pairs tried) leave out.  A key is open where a
    text, the fourth or a later one to have it, has a window of it that no found passage covers.  Where
    windows of all functions, one of an open key, hold a stretch as wide as the shortest passage, the stretch
    is looked up exactly, so that an exact passage leads to the first text that has it, whatever else its
    keys occur in.  Where windows of enough functions hold a stretch, its runs are looked up for near
    passages.  Rows grow with the texts, whatever the size of a key's group."""
    spans = found.groupBy("doc_id").agg(F.collect_set(F.struct(F.col("start_word").alias("i"), (F.col("end_word") - SHINGLE + 1).alias("j"))).alias("spans"))
    late = led.where("nth > 3").select("key", "doc_id", "place").join(spans.hint("merge"), "doc_id", "left")
    covered = f"place % 2 = 0 AND exists(spans, s -> s.i <= place DIV {PLACE} - place DIV 128 % 64 AND place DIV {PLACE} + place DIV 2 % 64 < s.j)"
    opened = late.where(F.coalesce(~F.expr(covered), F.lit(True))).select("key").distinct().withColumn("open", F.lit(True))
    met = join_hot(led.select("key", "doc_id", "place"), opened, "key", hot, ["doc_id"], "left")
    met = met.groupBy("doc_id").agg(F.collect_list(F.struct(F.expr("CAST(key & 7 AS int)").alias("f"), "place", F.coalesce("open", F.lit(False)).alias("open"))).alias("met")).where("exists(met, m -> m.open)")
    met = keep(met, "met")
    rows = among(sketch.select("doc_id", "words"), met, "doc_id").join(met.hint("merge"), "doc_id").join(spans.hint("merge"), "doc_id", "left")

    def make():
        def run(c):
            tokens = [shingles(as_words(w)) for w in c["words"].to_pylist()]
            used = [k for k, s in enumerate(tokens) if len(s) >= WIDTH]
            if not used:
                return {}
            flat, _, start = laid([tokens[k] for k in used])
            doc, size = c["doc_id"].to_numpy()[used], np.array([len(tokens[k]) for k in used])
            lists, own = c["met"].take(pa.array(used)), c["spans"].to_pylist()
            of = np.repeat(np.arange(len(used)), pc.list_value_length(lists).to_numpy())
            f, place, is_open = (lists.flatten().field(i).to_numpy(zero_copy_only=False) for i in range(3))
            lo, at, hi, _ = unpacked(place)
            # texts that share a doc_id have each other's windows: what goes beyond a text counts for nothing
            first, last = np.maximum(lo, at - REACH), np.minimum(at, hi - REACH)
            ok = (first <= last) & (last + WIDTH <= size[of]) & (first >= 0)
            f, is_open, first, last = f[ok], is_open[ok], start[of[ok]] + first[ok], start[of[ok]] + last[ok]
            agree = sum((counted(len(flat), first[f == g], last[f == g]) > 0).astype(int) for g in range(HASHES))
            opened_ = counted(len(flat), first[is_open], last[is_open]) > 0
            # how far the found passages that start at or before a token reach
            reach = np.zeros(len(flat), np.int64)
            for n, k in enumerate(used):
                for s in own[k] or ():
                    if s["j"] <= size[n]:
                        i = start[n] + s["i"]
                        reach[i] = max(reach[i], start[n] + s["j"])
            reach = np.maximum.accumulate(reach)
            runs_ = spanned(flat, RUN)
            picked = np.zeros(len(flat), bool)
            if len(runs_) >= SPARSE:
                least = sliding(runs_, SPARSE, np.minimum)
                top = sliding(np.concatenate([np.zeros(SPARSE - 1, np.uint64), least, np.zeros(SPARSE - 1, np.uint64)]), SPARSE, np.maximum)
                picked[: len(runs_)] = top == runs_
            near = np.flatnonzero(opened_ & (agree >= ENOUGH))
            within = counted(len(flat), near, near + WIDTH - RUN) > 0 if len(near) else np.zeros(len(flat), bool)
            out: dict[str, list] = {"key": [], "doc_id": [], "place": []}
            for kind, (at, width) in enumerate(((np.flatnonzero(opened_ & (agree == HASHES)), WIDTH), (np.flatnonzero(within & picked), RUN))):
                whose = np.searchsorted(start, at, side="right") - 1
                key = ((spanned(flat, width)[at] & np.uint64((1 << 64) - 2)) | np.uint64(kind)).view(np.int64)
                done = reach[at] >= at + width
                # of equal stretches one that no found passage covers stands for all
                order = np.lexsort((at, done, key, whose))
                fresh = np.ones(len(at), bool)
                fresh[1:] = (key[order][1:] != key[order][:-1]) | (whose[order][1:] != whose[order][:-1])
                at, whose, key, done = (x[order[fresh]] for x in (at, whose, key, done))
                out["key"].append(key)
                out["doc_id"].append(doc[whose])
                out["place"].append((at - start[whose]) * 2 + done)
            return {k: np.concatenate(v) for k, v in out.items()}

        return run

    looked = keep(map_arrow(rows, make, "key long, doc_id long, place long", "words", PART_BYTES), "looked")
    leads = looked.groupBy("key").agg(F.min(F.struct("doc_id", "place")).alias("lead"), F.count("*").alias("n")).where("n > 1")
    new = join_hot(looked.where("place % 2 = 0"), leads.select("key", "lead"), "key", hot_keys(leads, "key", looked.count()), ["doc_id"]).where("lead.doc_id <> doc_id")
    new = new.groupBy("doc_id", F.col("lead.doc_id").alias("source_id")).agg(F.collect_set(F.expr("CAST(lead.place DIV 2 AS int)")).alias("at")).withColumn("whole", F.lit(False))
    out = keep(new.join(tried.select("doc_id", "source_id").hint("merge"), ["doc_id", "source_id"], "left_anti"), "rest")
    for done in (met, looked):
        drop_kept(sketch.sparkSession, done)
    return out


# ---- verification


def common(sb: np.ndarray, i: int, sa: np.ndarray, a: int) -> int:
    """Length of the equal stretch that starts at i and a."""
    n, size, most = 0, 32, min(len(sb) - i, len(sa) - a)
    while n < most:
        m = min(size, most - n)
        same = sb[i + n : i + n + m] == sa[a + n : a + n + m]
        if not same.all():
            return n + int(same.argmin())
        n, size = n + m, 2 * size
    return n


def aligned(sb: np.ndarray, sa: np.ndarray) -> list[tuple[int, int, int]]:
    """Equal runs (place, place in the source, length) in order of the text; of several places in the
    source the next one is taken, or else the first."""
    order = np.argsort(sa, kind="stable")
    ranked = sa[order]
    lo, hi = np.searchsorted(ranked, sb, side="left"), np.searchsorted(ranked, sb, side="right")
    matched = np.flatnonzero(hi > lo)
    if len(matched) < SIMILARITY * WIDTH:
        return []
    runs, k, end = [], 0, 0
    while k < len(matched):
        i = int(matched[k])
        places = order[lo[i] : hi[i]]
        q = int(np.searchsorted(places, end)) if len(places) > 1 else 0
        a = int(places[q]) if q < len(places) else int(places[0])
        n = common(sb, i, sa, a)
        runs.append((i, a, n))
        end = a + n
        k = int(np.searchsorted(matched, i + n)) if n > 1 else k + 1
    return runs


def joined(runs: list[tuple[int, int, int]]) -> list[list[tuple[int, int, int, int, int]]]:
    """Chains (runs in order in both texts) of segments (i, j, p, q, matched): neighbours are joined where
    the gap between them costs no more than either earns."""
    chains: list[list[tuple[int, int, int, int, int]]] = []
    for i, a, n in runs:
        if not chains or a < chains[-1][-1][3]:
            chains.append([])
        chain, new = chains[-1], (i, i + n, a, a + n, n)
        while chain:
            old = chain[-1]
            cost = COST * (new[0] - old[1] + new[2] - old[3])
            if cost > min(score(old), score(new)):
                break
            chain.pop()
            new = (old[0], new[1], old[2], new[3], old[4] + new[4])
        chain.append(new)
    return chains


def close(chain: list[tuple[int, int, int, int, int]]) -> list[list[tuple[int, int, int, int, int]]]:
    """The chain's segments in parts: a gap no wider than what matches on either side is within a part."""
    parts: list[list[tuple[int, int, int, int, int]]] = []
    before = 0
    for s in chain:
        if parts and s[0] - parts[-1][-1][1] + s[2] - parts[-1][-1][3] <= min(before, s[4]):
            parts[-1].append(s)
            before += s[4]
        else:
            parts.append([s])
            before = s[4]
    return parts


def score(s: tuple[int, int, int, int, int]) -> int:
    """At least 0 where matched tokens are 0.8 of all tokens of the two stretches together."""
    i, j, p, q, m = s
    return m - COST * (j - i - m + q - p - m)


def longest(part: list[tuple[int, int, int, int, int]]) -> list[tuple[int, int, int, int, int]]:
    """Of neighbouring segments: the longest stretch of a similarity of 0.8, if it is long enough, and what
    there is to its left and right."""
    if len(part) == 1:
        return part if part[0][1] - part[0][0] >= WIDTH and score(part[0]) >= 0 else []
    out, todo = [], [part]
    while todo:
        part = todo.pop()
        if sum(s[4] for s in part) < SIMILARITY * WIDTH:
            continue
        x = np.array(part, np.int64)
        own = x[:, 4] - COST * (x[:, 1] - x[:, 0] + x[:, 3] - x[:, 2] - 2 * x[:, 4])
        gap = np.append(0, -COST * (x[1:, 0] - x[:-1, 1] + x[1:, 2] - x[:-1, 3]))
        before = np.cumsum(gap + np.append(0, own[:-1]))
        best = np.maximum.accumulate((before + own)[::-1])[::-1]
        last = np.searchsorted(-best, -before, side="right") - 1
        length = x[last, 1] - x[:, 0]
        length[last < np.arange(len(x))] = 0
        k = int(length.argmax())
        if length[k] < WIDTH:
            continue
        m = int(last[k])
        out.append((int(x[k, 0]), int(x[m, 1]), int(x[k, 2]), int(x[m, 3]), int(x[k : m + 1, 4].sum())))
        todo += [part[:k], part[m + 1 :]]
    return out


def stretches(matched: np.ndarray, gap: int) -> list[tuple[int, int]]:
    """Stretches of matched positions with at most `gap` unmatched ones between."""
    at = np.flatnonzero(matched)
    if not len(at):
        return []
    cut = np.flatnonzero(np.diff(at) > gap + 1)
    return list(zip(at[np.append(0, cut + 1)].tolist(), (at[np.append(cut, len(at) - 1)] + 1).tolist(), strict=True))


def passages(wb: np.ndarray, wa: np.ndarray) -> list[tuple[int, int, int, int, float]]:
    """Passages of at least LEAST_WORDS words of the text wb (words as numbers) that wa has with a similarity
    of 0.8: start and end word in both, and the similarity, the matched share of both stretches' tokens.
    Runs in the same order are aligned; what is in another order is compared as sets."""
    sb, sa = shingles(wb), shingles(wa)
    runs = aligned(sb, sa)
    found = []
    for chain in joined(runs):
        done = [x for part in close(chain) for x in longest(part)]
        # what is left may be a passage across a gap that is wider than one of its sides
        part = []
        for s in chain:
            if any(i <= s[0] < j for i, j, *_ in done):
                found += longest(part)
                part = []
            else:
                part.append(s)
        found += done + longest(part)
    out = [(i, j + SHINGLE - 1, p, q + SHINGLE - 1, m / (j - i + q - p - m)) for i, j, p, q, m in found]
    left, place = np.zeros(len(sb), bool), np.zeros(len(sb), np.int64)
    for i, a, n in runs:
        left[i : i + n], place[i : i + n] = True, np.arange(a, a + n)
    for i, j, *_ in found:
        left[i:j] = False
    for i, j in stretches(left, GAP):
        if j - i >= WIDTH:
            at = place[i:j][left[i:j]]
            shift = int(np.median(at - i - np.flatnonzero(left[i:j])))
            at = at[np.abs(at - i - shift) <= (j - i) + GAP]
            if len(at):
                p, q = int(at.min()), int(at.max()) + 1
                x, y = set(sb[i:j].tolist()), set(sa[p:q].tolist())
                if len(x & y) >= SIMILARITY * len(x | y):
                    out.append((i, j + SHINGLE - 1, p, q + SHINGLE - 1, len(x & y) / len(x | y)))
    return sorted(out)


FOUND = "doc_id long, text_hash long, start_word long, end_word long, source_id long, source_start long, source_end long, similarity double"


#: Classes of ids that a set of asked ids is marked by: 4 MB of bits, whatever the number of ids.
CLASSES = 1 << 25


def among(texts: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """The rows of texts whose doc_id is in a class that some id of ids (column key) is in: all that are asked
    for and a few others, so that the others' words are not dealt out."""
    place = F.pmod(F.xxhash64(key), F.lit(CLASSES)) + 1  # these functions count from 1
    marks = ids.select(F.bitmap_bucket_number(place).alias("bucket"), F.bitmap_bit_position(place).alias("bit")).groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("bits"))
    bits = bytearray(CLASSES // 8)
    for row in marks.collect():  # at most CLASSES / 32768 rows of 4 KB
        at = (row["bucket"] - 1) * 4096
        bits[at : at + 4096] = row["bits"]
    shared = texts.sparkSession.sparkContext.broadcast(bytes(bits))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marked = np.frombuffer(shared.value, np.uint8)
        for batch in batches:
            at = batch.column(batch.num_columns - 1).to_numpy()
            kept = np.flatnonzero(marked[at >> 3] >> (at & 7).astype(np.uint8) & 1)
            if len(kept):
                yield pa.RecordBatch.from_arrays([c.take(pa.array(kept)) for c in batch.columns[:-1]], names=batch.schema.names[:-1])

    classes = F.pmod(F.xxhash64("doc_id"), F.lit(CLASSES)).alias("_class")
    return texts.select("*", classes).mapInArrow(run, texts.schema)


def beside(texts: DataFrame, rows: DataFrame, key: str, spread: str, work, schema: str) -> DataFrame:
    """Rows in the presence of their text, which is held once for all its rows: both are dealt out by key,
    the texts come first.  Rows of a key that has many are dealt over several tasks, and so is its text.
    work(texts, row) yields output rows; texts are (text_hash, words), several where texts share a doc_id."""
    total = rows.count()
    hot = hot_keys(rows.groupBy(key).agg(F.count("*").alias("n")), key, total)
    kinds = [f for f in rows.schema if f.name != key]
    empty = [F.lit(None).cast(f.dataType).alias(f.name) for f in kinds]
    parts = F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_parts") - 1, F.lit(0))))
    own = among(texts, rows, key).select(F.col("doc_id").alias(key), F.col("text_hash").alias("_hash"), F.col("words").alias("_words"))
    own = own.join(F.broadcast(hot), key, "left").withColumn("_part", parts).select(key, "_part", F.lit(0).alias("_kind"), "_hash", "_words", *empty)
    salt = F.when(F.col("_parts").isNull(), 0).otherwise(F.expr(f"pmod(xxhash64({spread}), _parts)")).cast("int")
    asked = rows.join(F.broadcast(hot), key, "left").withColumn("_part", salt)
    asked = asked.select(key, "_part", F.lit(1).alias("_kind"), F.lit(None).cast("long").alias("_hash"), F.lit(None).cast("binary").alias("_words"), *[f.name for f in kinds])
    dealt = own.unionByName(asked).repartition(partitions(rows.sparkSession), key, "_part").sortWithinPartitions(key, "_part", "_kind")
    names = [f.name for f in StructType.fromDDL(schema)]
    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, []
        for batch in (part for whole in batches for part in slices(whole, "_words")):
            out: list[tuple] = []
            for row in batch.to_pylist():
                if (row[key], row["_part"]) != at:
                    at, held = (row[key], row["_part"]), []
                if row["_kind"] == 0:
                    if all(h != row["_hash"] for h, _ in held):
                        held.append((row["_hash"], row["_words"]))
                else:
                    out += work(held, row)
            yield as_batch({n: [r[k] for r in out] for k, n in enumerate(names)}, arrow)

    return dealt.mapInArrow(run, schema)


SLICES = "doc_id long, source_id long, first long, source_words binary"


def verified(sketch: DataFrame, met: DataFrame) -> DataFrame:
    """The passages of pairs of texts.  Of a source only what a passage of the text can reach from the places
    given is sent to the text, so what is sent grows with the texts and not with their sources."""
    lengths = sketch.groupBy("doc_id").agg(F.max("n").alias("n"))
    asked = keep(met.join(lengths, "doc_id"), "asked")
    texts = sketch.select("doc_id", "text_hash", "words")

    def cut_out(held, row):
        margin = row["n"] + row["n"] // COST + WIDTH
        for _, words in held:
            if row["whole"]:
                yield row["doc_id"], row["source_id"], 0, words
                continue
            first = last = None
            for a in sorted(row["at"]):
                if first is not None and a - last > 2 * margin:
                    yield row["doc_id"], row["source_id"], first, words[4 * first : 4 * (last + margin)]
                    first = None
                first = max(0, a - margin) if first is None else first
                last = a
            yield row["doc_id"], row["source_id"], first, words[4 * first : 4 * (last + margin)]

    def check(held, row):
        wa = as_words(row["source_words"])
        for text, words in held:
            for i, j, p, q, like in passages(as_words(words), wa):
                yield row["doc_id"], text, i, j, row["source_id"], p + row["first"], q + row["first"], like

    cuts = keep(beside(texts, asked, "source_id", "doc_id", cut_out, SLICES), "slices")
    drop_kept(sketch.sparkSession, asked)
    found = keep(beside(texts, cuts, "doc_id", "source_id, first", check, FOUND), "passages")
    drop_kept(sketch.sparkSession, cuts)
    return found


def repeated_passages(docs: DataFrame) -> DataFrame:
    """One row for every passage of at least 50 words of a document that an earlier document (by doc_id)
    has too, exactly or with a similarity of 0.8 on five-word shingles: its word span, the earlier document
    and the span there.  text_hash (XXH64 of the text) tells texts of one doc_id apart; each is compared
    with other ids alone, and repeated rows give their passages once.  Null and short texts have none; rows
    without doc_id take no part; an empty table gives an empty result; extra columns are ignored.  A very
    long text is sketched in one task and compared with others by the parts that they can share."""
    spark = docs.sparkSession
    sketch = keep(sketches(docs), "sketches")
    hot = crowded(sketch)
    led = followers(windows(sketch), hot)
    met = keep(pairs(led), "pairs")
    found = verified(sketch, met)
    more = rest(sketch, led, hot, found, met)
    for done in (hot, led, met):
        drop_kept(spark, done)
    out = found.unionByName(verified(sketch, more))
    for done in (sketch, more):
        drop_kept(spark, done)
    return out


def without_passages(docs: DataFrame) -> DataFrame:
    """docs without the passages that earlier documents have; n_chars is brought in line.  Documents of
    which no word is left go; all others stay, null and empty texts and rows without doc_id too.  Of texts
    that share a doc_id each loses its own passages; repeated rows lose the same.  Extra columns pass
    through, whatever their names; an empty table gives an empty result."""
    key, mark, mine = free_name(docs, "_key"), free_name(docs, "_mark"), free_name(docs, "_spans")
    spans = repeated_passages(docs).groupBy(F.col("doc_id").alias(key), F.col("text_hash").alias(mark)).agg(F.collect_set(F.struct("start_word", "end_word")).alias(mine))
    # one join, always by shuffle: texts are dealt out once at any size, and spans need no bound
    joined_ = docs.withColumn(key, F.col("doc_id").cast("long")).withColumn(mark, F.xxhash64("text")).join(spans.hint("merge"), [key, mark], "left").drop(key, mark)

    def make():
        def run(c):
            kept, texts, changed = [], [], []
            for k, (text, spans_) in enumerate(zip(c["text"].to_pylist(), c[mine].to_pylist(), strict=True)):
                new = text if spans_ is None else cut(text or "", [(s["start_word"], s["end_word"]) for s in spans_])
                if spans_ is None or WORD.search(new):
                    kept.append(k)
                    texts.append(new)
                    changed.append(spans_ is not None)
            out = {k: v.take(kept) for k, v in c.items() if k != mine}
            if any(changed):
                out["text"] = texts
                if "n_chars" in out:
                    out["n_chars"] = [len(t) if x else n for t, x, n in zip(texts, changed, out["n_chars"].to_pylist(), strict=True)]
            return out

        return run

    return map_arrow(joined_, make, docs.schema, "text")


def cut(text: str, spans: list[tuple[int, int]]) -> str:
    """text without the characters from the first to the last word of each span; words beyond its last
    count for nothing."""
    words = [m.span() for m in WORD.finditer(text)]
    out, at = [], 0
    for i, j in sorted(spans):
        if i >= min(j, len(words)):
            continue
        a, b = words[i][0], words[min(j, len(words)) - 1][1]
        if b > at:
            out.append(text[at : max(a, at)])
            at = b
    out.append(text[at:])
    return "".join(out)


def op5_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The repeated passages of all documents; see repeated_passages for nulls, ties, repeats and empty tables."""
    return repeated_passages(table(spark, sf_dir, "documents").select("doc_id", "text"))
