"""SimHash near-duplicates by Golay-code fuzzy hashing.

A fingerprint of 64 bits is cut into three segments of at most 23 bits.  Two fingerprints that differ in
at most two bits agree in one segment and differ in at most one bit of another.  The perfect binary
Golay code (23, 12, 7) maps a segment to the index of the one codeword within distance 3; a segment at
distance 3 gets, besides, the indices that its neighbours at distance 1 decode to.  Then of two segments
one bit apart, the first's own index is among the second's indices.  A key is the agreeing segment's
value with an index of the other; every ordered choice of segments gives keys.  Equal keys are joined
and verified by the number of differing bits.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from hushwire.llm.common import as_batch, drop_kept, hot_keys, join_hot, keep, map_arrow, partitions, table
from hushwire.llm.graph import components

SEED = 42
WORDS = 3
DISTANCE = 2
#: Low bit and width of the segments.
SEGMENTS = ((0, 22), (22, 21), (43, 21))
#: Generator polynomial of the binary Golay code.
GENERATOR = 0b101011100011
#: Members of a key up to which pairs are compared directly; what larger keys hold is keyed anew by its bits.
PAIRWISE = 48


def fingerprint(text: str | None) -> int:
    """SimHash of the word shingles of a whole text."""
    from xxhash import xxh64_intdigest as h

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) < WORDS:
        grams = [b" ".join(words)]
    else:
        grams = [b"%b %b %b" % g for g in zip(words, words[1:], words[2:], strict=False)]
    total = np.zeros(64, np.int64)
    for a in range(0, len(grams), 1 << 16):
        x = np.array([h(g, SEED) for g in grams[a : a + (1 << 16)]], ">u8")
        total += np.unpackbits(x.view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * total > len(grams)).tobytes(), "big")


def golay_tables() -> tuple[np.ndarray, np.ndarray]:
    """syndrome -> error pattern (23 bits) and its weight; the 2048 patterns of weight <= 3 have
    different syndromes because the code is perfect."""
    from itertools import combinations

    error, weight = np.zeros(2048, np.uint32), np.zeros(2048, np.uint8)
    for w in range(4):
        for at in combinations(range(23), w):
            e = sum(1 << i for i in at)
            s = int(syndrome(np.array([e], np.uint32))[0])
            error[s], weight[s] = e, w
    return error, weight


def syndrome(x: np.ndarray) -> np.ndarray:
    """Remainder of the 23-bit words modulo the generator polynomial."""
    x = x.astype(np.uint32).copy()
    for i in range(22, 10, -1):
        x ^= ((x >> np.uint32(i)) & np.uint32(1)) * np.uint32(GENERATOR << (i - 11))
    return x


_golay: list = []


def indices(x: np.ndarray) -> np.ndarray:
    """Rows of 24 codeword indices: the word's own first, then those of its 23 neighbours."""
    if not _golay:
        _golay.extend(golay_tables())
    error, _ = _golay
    flips = np.concatenate([[0], 1 << np.arange(23)]).astype(np.uint32)
    words = x.astype(np.uint32)[:, None] ^ flips
    code = words ^ error[syndrome(words.ravel())].reshape(words.shape)
    return code >> np.uint32(11)  # the code is systematic in its high 12 bits


def keys(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(position, key) of all keys of 64-bit fingerprints, without repeats."""
    at, out = [], []
    segs = [((prints >> np.uint64(lo)) & np.uint64((1 << n) - 1)) for lo, n in SEGMENTS]
    decoded = [np.sort(indices(s), axis=1) for s in segs]
    for i in range(3):
        for j in range(3):
            if i == j:
                continue
            d = decoded[j]
            fresh = np.ones(d.shape, bool)
            fresh[:, 1:] = d[:, 1:] != d[:, :-1]
            row, col = np.nonzero(fresh)
            key = (np.uint64(3 * i + j) << np.uint64(34)) | (segs[i][row] << np.uint64(12)) | d[row, col].astype(np.uint64)
            at.append(row)
            out.append(key)
    return np.concatenate(at), np.concatenate(out)


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash (XXH64 of the text, by which rows of one doc_id are told apart) and print of every row."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")

    def make():
        def run(c):
            p = np.array([fingerprint(t) for t in c["text"].to_pylist()], np.uint64)
            return {"doc_id": c["doc_id"], "text_hash": c["text_hash"], "print": p.view(np.int64)}

        return run

    return map_arrow(rows, make, "doc_id long, text_hash long, print long", "text")


def near_links(prints: DataFrame) -> DataFrame:
    """Links a, b between different fingerprints (column print, distinct) within DISTANCE, enough to connect
    all that are.  Of a key with few members all pairs are compared.  What a key with many holds is keyed
    anew: two words differ in at most two bits exactly if one word is within one bit of both, so every
    member is entered under itself and its 64 neighbours and linked to the least member there.  All such
    links are within DISTANCE, no word has more than 65 members, and no key is held whole in a task."""
    spark = prints.sparkSession

    def make():
        def run(c):
            p = c["print"].to_numpy().view(np.uint64)
            out_at, out_key = keys(p)
            return {"key": out_key.view(np.int64), "print": p[out_at].view(np.int64)}

        return run

    keyed = map_arrow(prints, make, "key long, print long")
    keyed = keyed.repartition(partitions(spark), "key").sortWithinPartitions("key", "print")
    arrow = to_arrow_schema(StructType.fromDDL("a long, b long"))

    def verify(batches):
        """Links of keys with few members; of all others each member, with a null in place of a partner."""
        held_key, held = np.zeros(0, np.int64), np.zeros(0, np.int64)
        large = None  # a key with many members that may go on
        for batch in batches:
            k = np.concatenate([held_key, batch.column(0).to_numpy()])
            p = np.concatenate([held, batch.column(1).to_numpy()])
            if large is not None:
                same = int(np.searchsorted(k, large, side="right"))
                yield many(p[:same])
                k, p = k[same:], p[same:]
            if not len(k):
                continue
            cut = int(np.searchsorted(k, k[-1]))
            yield from links_of(k[:cut], p[:cut])
            held_key, held, large = k[cut:], p[cut:], None
            if len(held) > PAIRWISE:
                yield many(held)
                held_key, held, large = held_key[:0], held[:0], int(k[-1])
        yield from links_of(held_key, held)

    def many(p):
        return as_batch({"a": pa.array(p), "b": pa.nulls(len(p), pa.int64())}, arrow)

    def links_of(k, p):
        if not len(k):
            return
        edge = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1], [True]]))
        size = np.diff(edge)
        out = []
        two = edge[:-1][size == 2]  # most keys that are shared at all are shared by two
        ok = np.bitwise_count(p[two].view(np.uint64) ^ p[two + 1].view(np.uint64)) <= DISTANCE
        out.append((p[two][ok], p[two + 1][ok]))
        for a, n in zip(edge[:-1][size > 2], size[size > 2], strict=True):
            q = p[a : a + n]
            if n > PAIRWISE:
                yield many(q)
                continue
            i, j = np.triu_indices(n, 1)
            ok = np.bitwise_count((q[i] ^ q[j]).view(np.uint64)) <= DISTANCE
            out.append((q[i[ok]], q[j[ok]]))
        a, b = np.concatenate([x for x, _ in out]), np.concatenate([y for _, y in out])
        if len(a):
            pairs = np.unique(np.stack([a, b], 1), axis=0)
            yield as_batch({"a": pa.array(pairs[:, 0]), "b": pa.array(pairs[:, 1])}, arrow)

    met = keep(keyed.mapInArrow(verify, "a long, b long"), "met")
    crowded = met.where("b IS NULL").select(F.col("a").alias("print")).distinct()
    flips = F.array(F.lit(0).cast("long"), *(F.lit(-(1 << 63) if i == 63 else 1 << i).cast("long") for i in range(64)))
    near = crowded.select("print", F.explode(F.transform(flips, lambda f: F.col("print").bitwiseXOR(f))).alias("word"))
    # at most 65 members a word
    leads = near.groupBy("word").agg(F.min("print").alias("a"), F.collect_list("print").alias("all")).select("a", F.explode("all").alias("b"))
    return met.where("b IS NOT NULL").unionByName(leads.where("a <> b").distinct())


def members(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, print of every row, and `first`, the least (no doc_id, doc_id, text_hash) among the
    rows whose fingerprints are reachable from its own."""
    spark = docs.sparkSession
    own = keep(fingerprints(docs), "prints")
    rank = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
    nodes = keep(own.groupBy("print").agg(F.min(rank).alias("first"), F.count("*").alias("n")), "nodes")
    reach = components(near_links(nodes.select("print")))
    rooted = keep(nodes.join(reach.select(F.col("node").alias("print"), "root"), "print", "left").withColumn("root", F.coalesce("root", "print")), "rooted")
    least = rooted.groupBy("root").agg(F.min("first").alias("first"), F.count("*").alias("n"))
    total, rows = rooted.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    # a component may hold most fingerprints, and a fingerprint most rows
    named = join_hot(rooted.select("print", "root"), least.select("root", "first"), "root", hot_keys(least, "root", total), ["print"])
    out = keep(join_hot(own, named.select("print", "first"), "print", hot_keys(rooted.select("print", "n"), "print", rows), ["doc_id", "text_hash"]), "members")
    for done in (own, nodes, rooted):
        drop_kept(spark, done)
    return out


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of every row.  Texts without words (null and
    empty ones too) have fingerprint zero and are linked like any others.  Rows of one fingerprint are
    one node; rows without a doc_id keep their fingerprint and take part, but name no component (null
    only where no member has a doc_id).  Repeated rows and rows of one doc_id each give a row; an empty
    table gives an empty result; a very long text is hashed in parts; extra columns are ignored."""
    return members(docs).select("doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), F.col("first.doc_id").alias("component_id"))


def thinned(docs: DataFrame) -> DataFrame:
    """One row of every component of near copies, with all its columns: the first by doc_id, of several
    texts under that doc_id the first by hash; rows without doc_id come last.  Of rows that agree in doc_id
    and text one stays.  Null and empty texts are copies of each other.  An empty table gives an empty
    result; extra columns keep their names and values."""
    found = members(docs)
    mine = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
    gone = found.where(mine != F.col("first")).select(F.col("doc_id").alias("gone_id"), F.col("text_hash").alias("gone_hash")).distinct()
    twice = found.where(mine == F.col("first")).groupBy("doc_id", "text_hash").agg(F.count("*").alias("n")).where("n > 1").select(F.col("doc_id").alias("gone_id"), F.col("text_hash").alias("gone_hash"))
    # packed rows clash with no name
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("id"), F.xxhash64("text").alias("hash"))
    same = F.col("id").eqNullSafe(F.col("gone_id")) & (F.col("hash") == F.col("gone_hash"))
    once = rows.join(gone.unionByName(twice), same, "left_anti")
    # of rows that agree in all that decides, whichever comes first: partial aggregation keeps one a task
    again = rows.join(twice, same, "left_semi").groupBy("id", "hash").agg(F.first("row").alias("row"))
    return once.select("row.*").unionByName(again.select("row.*"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The SimHash components of all documents; see near_duplicates for nulls, ties, repeats and empty tables."""
    return near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
