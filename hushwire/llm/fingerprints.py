"""Document fingerprints from prefix polynomial hashes.

A text is read as code points c[0..n).  Its modular prefix array P holds P[i] = sum(c[j] * B**j, j < i)
for two primes, so that any span's hash is a difference of two entries, equality of spans anywhere is a
comparison after aligning powers, the array of a concatenation follows from the parts' arrays, and the
longest common extension of two positions is a binary search over span equality.

A fingerprint is `n.hash.step.grid`: length, both whole hashes, the log2 of the grid's step, and prefix
hashes at the multiples of the step (at most 32), all in hex.  Equal texts have equal fingerprints.
likeness() compares two fingerprints alone: the share of aligned grid spans that are equal, found by
binary search for the common prefix and then span by span, against the longer text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from hushwire.llm.common import as_batch, partitions, table

PRIMES = (2147483647, 2147483629)
BASES = (1000003019 % 2147483647, 916191383)
GRID = 32
LEAST = -(1 << 63)

_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> list[np.ndarray]:
    """B**j mod p for j < n at least, grown by doubling."""
    while len(_powers[0]) < n:
        for k in (0, 1):
            w = _powers[k]
            step = np.uint64(pow(BASES[k], len(w), PRIMES[k]))
            _powers[k] = np.concatenate([w, w * step % np.uint64(PRIMES[k])])
    return _powers


def trim_powers(most: int = 1 << 20) -> None:
    """Give back the memory that one very long text took."""
    for k in (0, 1):
        if len(_powers[k]) > most:
            _powers[k] = _powers[k][:most].copy()


class Prefixes:
    """The prefix arrays of one text."""

    def __init__(self, text: str = "", arrays: list[np.ndarray] | None = None):
        if arrays is None:
            codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
            w = powers(len(codes))
            arrays = []
            for k in (0, 1):
                p = np.uint64(PRIMES[k])
                # the code point plus one, so that leading NULs count
                terms = (codes + np.uint64(1)) * w[k][: len(codes)] % p
                a = np.empty(len(codes) + 1, np.uint64)
                a[0] = 0
                np.cumsum(terms, out=a[1:])
                a %= p
                arrays.append(a)
        self.arrays, self.n = arrays, len(arrays[0]) - 1

    def replaced_tail(self, cut: int, head: Prefixes, m: int) -> Prefixes:
        """The arrays of text[:cut] + other[:m], from both texts' arrays alone."""
        out = []
        for k in (0, 1):
            p = np.uint64(PRIMES[k])
            shift = np.uint64(pow(BASES[k], cut, PRIMES[k]))
            tail = (head.arrays[k][1 : m + 1] * shift + self.arrays[k][cut]) % p
            out.append(np.concatenate([self.arrays[k][: cut + 1], tail]))
        return Prefixes(arrays=out)

    def same(self, i: int, other: Prefixes, j: int, length: int) -> bool:
        """Whether self[i:i+length] == other[j:j+length] (with hash certainty)."""
        if i + length > self.n or j + length > other.n:
            return False
        for k, p in enumerate(PRIMES):
            a = (int(self.arrays[k][i + length]) - int(self.arrays[k][i])) * pow(BASES[k], j, p)
            b = (int(other.arrays[k][j + length]) - int(other.arrays[k][j])) * pow(BASES[k], i, p)
            if (a - b) % p:
                return False
        return True

    def common_extension(self, i: int, other: Prefixes, j: int) -> int:
        """Length of the longest common extension to the right of positions i and j."""
        low, high = 0, min(self.n - i, other.n - j)
        while low < high:
            mid = (low + high + 1) // 2
            low, high = (mid, high) if self.same(i, other, j, mid) else (low, mid - 1)
        return low

    def fingerprint(self) -> str:
        shift = max(0, (self.n - 1).bit_length() - (GRID.bit_length() - 1)) if self.n else 0
        grid = self.arrays[0][1 << shift : self.n + 1 : 1 << shift]
        whole = "".join(f"{int(a[self.n]):08x}" for a in self.arrays)
        return f"{self.n:x}.{whole}.{shift:x}." + grid.astype(">u4").tobytes().hex()


def likeness(a: str, b: str) -> float:
    """Of two fingerprints, 0 to 1; 1 exactly when length and whole hash agree (two empty texts too)."""
    (na, wa, sa, ga), (nb, wb, sb, gb) = a.split("."), b.split(".")
    if na == nb and wa == wb:
        return 1.0
    n, sa, sb = max(int(na, 16), int(nb, 16)), int(sa, 16), int(sb, 16)
    s = max(sa, sb)
    pa_ = np.frombuffer(bytes.fromhex(ga), ">u4").astype(np.int64)[(1 << s - sa) - 1 :: 1 << s - sa]
    pb_ = np.frombuffer(bytes.fromhex(gb), ">u4").astype(np.int64)[(1 << s - sb) - 1 :: 1 << s - sb]
    m = min(len(pa_), len(pb_))
    pa_, pb_ = pa_[:m], pb_[:m]
    low, high = 0, m  # common prefix by binary search over prefix equality
    while low < high:
        mid = (low + high + 1) // 2
        low, high = (mid, high) if pa_[mid - 1] == pb_[mid - 1] else (low, mid - 1)
    p = PRIMES[0]
    da, db = np.diff(pa_[max(low - 1, 0) :]) % p, np.diff(pb_[max(low - 1, 0) :]) % p
    equal = low + int((da == db).sum())
    return min(1.0, equal * (1 << s) / n) * (1 - 1e-9)


SCHEMA = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def _in_order(docs: DataFrame) -> DataFrame:
    """Deal the rows into buckets of neighbouring doc_ids, each ending with a copy of the row that
    follows it.  Columns: bucket, copy, key, doc_id, text; sorted within partitions.  One shuffle of
    the texts; the driver sees one number for each bucket."""
    spark = docs.sparkSession
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(LEAST)).alias("key"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    n = 4 * partitions(spark)
    points = [i / n for i in range(1, n)]
    cuts = rows.agg(F.percentile_approx("key", points, max(10_000, 10 * n)).alias("cuts")).first()["cuts"]
    cuts = np.array(sorted(set(cuts or [])), np.int64)

    @F.pandas_udf("int")
    def bucket_of(key):
        import pandas as pd

        return pd.Series(np.searchsorted(cuts, key.to_numpy(np.int64), side="right").astype(np.int32))

    rows = rows.withColumn("bucket", bucket_of("key"))
    heads = rows.groupBy("bucket").agg(F.min("key").alias("key")).collect()  # at most one for each cut
    heads = sorted((r["bucket"], r["key"]) for r in heads)
    if not heads:
        return rows.select(F.col("bucket"), F.lit(0).alias("copy"), "key", "doc_id", "text")
    links = [(key, heads[i - 1][0]) for i, (_, key) in enumerate(heads)]
    follow = spark.createDataFrame(links, "key long, to int")
    copies = (
        rows.select("key", "text")
        .join(F.broadcast(follow), "key")
        .groupBy("to", "key")
        .agg(F.min("text").alias("text"))
        .select(F.col("to").alias("bucket"), F.lit(1).alias("copy"), "key", F.lit(None).cast("long").alias("doc_id"), "text")
    )
    both = rows.select("bucket", F.lit(0).alias("copy"), "key", "doc_id", "text").unionByName(copies)
    return both.repartition(partitions(spark), "bucket").sortWithinPartitions("bucket", "copy", "key", "text")


def fingerprint_chain(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text, of its edited text (the last quarter replaced by the beginning of
    the next document in order of doc_id; the last document is followed by the first), and their
    likeness.  Null texts count as empty.  A null doc_id sorts first; rows of one doc_id are ordered by
    text; repeated rows each give a row.  An empty table gives an empty result.  Extra columns are
    ignored."""
    arrow = to_arrow_schema(StructType.fromDDL(SCHEMA))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # bucket, doc_id, text, prefixes, fingerprint
        for batch in batches:
            out: dict[str, list] = {f.name: [] for f in arrow}
            buckets, ids, texts = (batch.column(i).to_pylist() for i in (0, 3, 4))
            for i, text in enumerate(texts):
                own = Prefixes(text)
                mark = own.fingerprint()
                if last is not None and last[0] == buckets[i]:
                    _, doc, prev, arrays, prev_mark = last
                    k = arrays.n // 4
                    m = min(k, own.n)
                    cut = arrays.n - k
                    edited = arrays.replaced_tail(cut, own, m).fingerprint() if k else prev_mark
                    out["doc_id"].append(doc)
                    out["n_chars"].append(arrays.n)
                    out["edited_sha256"].append(hashlib.sha256((prev[:cut] + text[:m]).encode("utf-8", "surrogatepass")).hexdigest())
                    out["fingerprint"].append(prev_mark)
                    out["edited_fingerprint"].append(edited)
                    out["near_edited"].append(likeness(prev_mark, edited))
                    out["near_next"].append(likeness(prev_mark, mark))
                last = (buckets[i], ids[i], text, own, mark)
            trim_powers()
            yield as_batch(out, arrow)

    return _in_order(docs).mapInArrow(run, SCHEMA)


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_chain(table(spark, sf_dir, "documents").select("doc_id", "text"))
