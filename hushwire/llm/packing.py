"""Packing by cutting-stock column generation.

Documents become ids plus an end id, cut into whole sequences and one remainder each.  The histogram of
remainders (in units of UNIT tokens) is the demand of a cutting-stock problem.  A linear program over
patterns is solved by column generation: the restricted master by the revised simplex method, new
columns priced by knapsack dynamic programming over the duals.  The basic solution is rounded down, what
is left is filled first-fit by decreasing size, and the patterns' slots are dealt to the documents by
their rank within their length class.  The program's size depends on the histogram alone.
"""

from __future__ import annotations

import json
import zlib
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hushwire.llm.chunks import ChunkEncoder
from hushwire.llm.common import keep, map_arrow, partitions, table

LENGTH, UNIT = 1024, 8
END = 0
#: Pivots after which the linear program is taken as it stands; its patterns are feasible at any time.
PIVOTS = 4000


@lru_cache(2)
def byte_level_encoder(path: str, room: int = 500_000) -> ChunkEncoder:
    """Encoder for a byte-level BPE file of the tokenizers library.  The file's vocabulary is read as
    merge ranks (its ids are in order of merging), which gives the library's ids at several times the
    speed.  As in the library, texts are split at the file's added tokens first, which keep their own ids."""
    import public_tokenizers
    import tiktoken

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    if any(" " in t or "\n" in t for t in special) or any(t[k] for t in spec["added_tokens"] for k in ("lstrip", "rstrip", "single_word", "normalized")):
        raise ValueError("added tokens with white space or conditions are not supported")
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    back = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}
    ranks = {bytes(back[c] for c in t): i for t, i in spec["model"]["vocab"].items() if t not in special}
    coder = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)
    return ChunkEncoder(lambda t: np.array(coder.encode(t, allowed_special="all", disallowed_special=()), "<u4").tobytes(), room)


PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def pieces(docs: DataFrame, path: str) -> DataFrame:
    """The pieces of every document: whole sequences, then the remainder.  Null texts count as empty."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    end = np.array([END], "<u4").tobytes()

    def make():
        coder = byte_level_encoder(path)

        def run(c):
            out: dict[str, list] = {k: [] for k in ("doc_id", "start", "length", "ids_crc32", "doc_tokens")}
            for doc, text in zip(c["doc_id"].to_pylist(), c["text"].to_pylist(), strict=True):
                raw = memoryview(coder.ids(text or "") + end)
                n = len(raw) // 4
                for a in range(0, n, LENGTH):
                    b = min(n, a + LENGTH)
                    for k, v in zip(out, (doc, a, b - a, zlib.crc32(raw[4 * a : 4 * b]), n), strict=True):
                        out[k].append(v)
            return out

        return run

    return map_arrow(rows, make, PIECES, "text")


def knapsack(values: np.ndarray, sizes: np.ndarray, capacity: int) -> np.ndarray:
    """Counts of an unbounded knapsack of greatest value, by dynamic programming over the capacity."""
    best, choice = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    for c in range(1, capacity + 1):
        n = int(np.searchsorted(sizes, c, side="right"))
        best[c] = best[c - 1]
        if n:
            v = values[:n] + best[c - sizes[:n]]
            k = int(v.argmax())
            if v[k] > best[c] + 1e-12:
                best[c], choice[c] = v[k], k
    out, c = np.zeros(len(sizes), np.int64), capacity
    while c > 0:
        if choice[c] < 0:
            c -= 1
        else:
            out[choice[c]] += 1
            c -= int(sizes[choice[c]])
    return out


def inverted(a: np.ndarray) -> np.ndarray:
    """Gauss-Jordan inverse; small enough to need no threaded library."""
    m = len(a)
    w = np.concatenate([a.astype(float), np.eye(m)], 1)
    for k in range(m):
        r = k + int(np.abs(w[k:, k]).argmax())
        w[[k, r]] = w[[r, k]]
        w[k] /= w[k, k]
        rest = np.flatnonzero(w[:, k])
        rest = rest[rest != k]
        w[rest] -= w[rest, k][:, None] * w[k]
    return w[:, m:]


def patterns(sizes: np.ndarray, demand: np.ndarray, capacity: int) -> list[tuple[np.ndarray, int]]:
    """Patterns with their uses that cover the demand exactly or with a few slots to spare.  sizes
    ascend; demand is positive."""
    m = len(sizes)
    columns = np.diag(capacity // sizes).astype(float)  # the basis, a column each
    inverse = np.diag(1.0 / (capacity // sizes))
    x = inverse @ demand
    for pivot in range(PIVOTS):
        duals = inverse.sum(0)
        new = knapsack(duals, sizes, capacity)
        if duals @ new <= 1 + 1e-7:
            break
        d = inverse @ new
        rows = np.flatnonzero(d > 1e-10)
        ratio = x[rows] / d[rows]
        least = ratio.min()
        tied = rows[ratio <= least + 1e-12]
        r = int(tied[d[tied].argmax()])
        x -= least * d
        x[r] = least
        columns[:, r] = new
        row = inverse[r] / d[r]
        inverse -= np.outer(d, row)
        inverse[r] = row
        if pivot % 200 == 199:
            inverse = inverted(columns)
            x = np.maximum(inverse @ demand, 0)
    left = demand.astype(np.int64).copy()
    found: list[tuple[np.ndarray, int]] = []
    for k in np.argsort(-x):
        a = columns[:, k].round().astype(np.int64)
        used = a > 0
        uses = min(int(np.floor(x[k] + 1e-6)), int((left[used] // a[used]).min()))
        if uses > 0:
            found.append((a, uses))
            left -= a * uses
    for a in first_fit(sizes, left, capacity):
        found.append((a, 1))
    assert (sum(a * u for a, u in found) == demand).all()
    return found


def first_fit(sizes: np.ndarray, left: np.ndarray, capacity: int) -> list[np.ndarray]:
    """First fit by decreasing size.  What rounding leaves is less than one use of each pattern, so this
    list depends on the number of classes and not on the number of documents."""
    bins: list[tuple[int, np.ndarray]] = []
    for k in range(len(sizes) - 1, -1, -1):
        for _ in range(int(left[k])):
            for i, (room, a) in enumerate(bins):
                if sizes[k] <= room:
                    a[k] += 1
                    bins[i] = (room - int(sizes[k]), a)
                    break
            else:
                a = np.zeros(len(sizes), np.int64)
                a[k] = 1
                bins.append((capacity - int(sizes[k]), a))
    return [a for _, a in bins]


def slots(found: list[tuple[np.ndarray, int]], m: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each class: the first rank, the copies a use and the first sequence of each of its slots."""
    first = np.cumsum([0, *(u for _, u in found)])
    out = []
    for k in range(m):
        own = [(int(a[k]), u, int(f)) for (a, u), f in zip(found, first, strict=False) if a[k]]
        ranks = np.cumsum([0, *(a * u for a, u, _ in own)])[:-1]
        out.append((ranks, np.array([a for a, _, _ in own]), np.array([f for _, _, f in own])))
    return out


def pack(docs: DataFrame, path: str) -> DataFrame:
    """Every piece with its sequence and its offset there.  Null and empty texts are documents of one id.
    Rows of one doc_id, repeated ones and those without doc_id too, are documents of their own; an empty
    table gives an empty result; extra columns are ignored; a very long text is cut into many pieces."""
    spark = docs.sparkSession
    cut = keep(pieces(docs, path), "pieces")
    top = LENGTH // UNIT
    cut = cut.withColumn("class", F.when(F.col("length") == LENGTH, top + 1).otherwise(F.ceil(F.col("length") / UNIT)).cast("int"))
    parts = F.pmod(F.xxhash64("doc_id", "start"), F.lit(4 * partitions(spark))).cast("int")
    cut = cut.withColumn("slice", parts)
    counts = cut.groupBy("class", "slice").agg(F.count("*").alias("n"))
    histogram = {r["class"]: r["n"] for r in counts.groupBy("class").agg(F.sum("n").alias("n")).collect()}
    sizes = np.array(sorted(k for k in histogram if k <= top), np.int64)
    found = patterns(sizes, np.array([histogram[int(k)] for k in sizes]), top) if len(sizes) else []
    used = sum(u for _, u in found)
    by_class = dict(zip(sizes.tolist(), slots(found, len(sizes)), strict=True))
    by_class[top + 1] = (np.array([0]), np.array([1]), np.array([used]))

    earlier = Window.partitionBy("class").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("class", "slice", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    in_slice = Window.partitionBy("class", "slice").orderBy("doc_id", "start", "length", "ids_crc32", "doc_tokens")
    ranked = cut.withColumn("rank", F.row_number().over(in_slice)).join(bases, ["class", "slice"])
    ranked = ranked.withColumn("rank", F.col("rank") - 1 + F.col("base"))

    @F.pandas_udf("long")
    def sequence(kind, rank):
        out = np.empty(len(kind), np.int64)
        kind, rank = kind.to_numpy(), rank.to_numpy()
        for k in np.unique(kind):
            own = np.flatnonzero(kind == k)
            ranks, copies, first = by_class[int(k)]
            at = np.searchsorted(ranks, rank[own], side="right") - 1
            out[own] = first[at] + (rank[own] - ranks[at]) // copies[at]
        import pandas as pd

        return pd.Series(out)

    placed = ranked.withColumn("sequence_id", sequence("class", "rank"))
    before = Window.partitionBy("sequence_id").orderBy(F.desc("length"), "class", "rank").rowsBetween(Window.unboundedPreceding, -1)
    return placed.select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", F.coalesce(F.sum("length").over(before), F.lit(0)).alias("offset")
    )


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed; see pack for nulls, repeats and empty tables."""
    import public_tokenizers

    return pack(table(spark, sf_dir, "documents").select("doc_id", "text"), public_tokenizers.path("byte_bpe_50k.json"))
