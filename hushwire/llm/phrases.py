"""Phrases that occur more often than their parts let expect, by hashed counting in passes.

Pass k counts phrases of k words exactly, but only those that can be frequent: the pass before has counted
phrases of k words by hash bucket, and a phrase whose bucket stayed under the least count is none; and both
of its parts of k - 1 words must be frequent (a phrase is never more frequent than its parts).  Both are
asked of bitmaps, whose sizes are bounded, so whatever the corpus they can be sent to all tasks; what a bitmap
lets through by chance is counted and found rare.  A pass also trims the texts: words that are in no phrase
that passed twice in a row cannot be in a longer one and are not read again.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from hushwire.llm import wordbytes
from hushwire.llm.common import drop_kept, hot_keys, join_hot, keep, partitions, slices, table

#: Bits of a bitmap: one for some WORDS_A_BIT words of the corpus (SPARE for each frequent phrase), within these
#: bounds.  The largest has 8 MB.  Beyond some 10^10 words buckets fill up and let more through; results stay.
LEAST_BITS, MOST_BITS = 1 << 16, 1 << 26
WORDS_A_BIT, SPARE = 32, 16
#: Buckets whose counts are sent together, and bytes of text that are worked on at once.
SLICE, TEXT_BYTES = 1 << 16, 6 << 20
#: Parts in which the phrases of a language are ranked before all.
RANKED = 256
_kind = wordbytes.classes(b" \t", b".,;:!?\n\x0b\x0c\r")

#: Rows of a pass: counts of phrases (lang, gram, n), counts by bucket (slice, held), trimmed texts (lang, rest).
PASS = "lang string, gram string, n long, slice int, held binary, rest string"
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _MIX
    return h ^ (h >> np.uint64(29))


def _word_hashes(words: list[bytes], seeds: np.ndarray) -> np.ndarray:
    h = np.fromiter((xxhash.xxh64_intdigest(w) for w in words), np.uint64, len(words))
    return _mixed(h ^ seeds)


def _lang_seeds(langs: list[str]) -> np.ndarray:
    return np.fromiter((xxhash.xxh64_intdigest(v.encode(), 11) for v in langs), np.uint64, len(langs))


def _longer(h: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hash of a phrase from that of the phrase without its last word and that of the word."""
    return _mixed(h * np.uint64(0xC2B2AE3D27D4EB4F) + word)


def _set(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Which hashes' bits are set; bits: a power of two of them, packed."""
    at = h & np.uint64(8 * len(bits) - 1)
    return bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & 1 == 1


class Batch:
    """Words of a batch of texts: which language's word each is, and with which the next ones share a piece."""

    def __init__(self, lang: pa.Array, text: pa.Array):
        w = wordbytes.cut(text, _kind)
        self.rows, self.row, self.words, piece = len(text), w.row, w.words, w.piece
        coded, langs = w.words.dictionary_encode(), lang.dictionary_encode()
        kinds = langs.indices.to_numpy()[w.row].astype(np.int64)
        self.vocabulary, self.langs = coded.dictionary, langs.dictionary.to_pylist()
        own, self.ids = np.unique(kinds * max(1, len(self.vocabulary)) + coded.indices.to_numpy(), return_inverse=True)
        self.lang_of, self.word_of = np.divmod(own, max(1, len(self.vocabulary)))
        self.joined = piece[1:] == piece[:-1]
        seeds = _lang_seeds(self.langs)
        plain = np.fromiter((xxhash.xxh64_intdigest(v) for v in self.vocabulary.to_pylist()), np.uint64, len(self.vocabulary))
        self.hashes = _mixed(plain[self.word_of] ^ seeds[self.lang_of])[self.ids] if len(own) else np.zeros(0, np.uint64)

    def within(self, k: int) -> np.ndarray:
        """For every place whether k words from there on are in one piece."""
        out = np.zeros(len(self.ids), bool)
        if len(out) >= k:
            ok = np.ones(len(out) - k + 1, bool)
            for i in range(k - 1):
                ok &= self.joined[i : i + len(ok)]
            out[: len(ok)] = ok
        return out

    def hashed(self, k: int) -> list[np.ndarray]:
        """The hashes of phrases of 1 to k words from every place (those that reach beyond the end are void)."""
        out = [self.hashes]
        for i in range(1, k):
            h = out[-1].copy()
            h[: len(h) - i] = _longer(h[: len(h) - i], self.hashes[i:])
            out.append(h)
        return out

    def counted(self, at: np.ndarray, k: int) -> tuple[pa.Array, pa.Array, np.ndarray]:
        """Language, phrase and count of the phrases of k words that begin at the places `at`."""
        code = self.ids[at]
        for i in range(1, k):
            _, code = np.unique(code * len(self.word_of) + self.ids[at + i], return_inverse=True)
        _, first, n = np.unique(code, return_index=True, return_counts=True)
        ids = [self.ids[at[first] + i] for i in range(k)]
        parts = [self.vocabulary.take(pa.array(self.word_of[i])) for i in ids]
        gram = pc.binary_join_element_wise(*parts, pa.scalar(b" ", pa.large_binary())) if k > 1 else parts[0]
        lang = pa.array(self.langs, pa.string()).take(pa.array(self.lang_of[ids[0]])) if len(ids[0]) else pa.array([], pa.string())
        return lang, gram.cast(pa.large_string()).cast(pa.string()), n

    def trimmed(self, starts: np.ndarray, k: int) -> tuple[pa.Array, pa.Array]:
        """Language and what is left of each text: the words of phrases of k + 1 words from the places `starts`,
        pieces apart by a line feed."""
        kept = np.zeros(len(self.ids), bool)
        for i in range(k + 1):
            kept[np.flatnonzero(starts) + i] = True
        at = np.flatnonzero(kept)
        end = np.ones(len(at), bool)
        end[:-1] = (np.diff(at) > 1) | ~self.joined[at[:-1]]
        spaced = pc.binary_join_element_wise(self.words.take(pa.array(at)), pa.array(np.where(end, b"\n", b" "), pa.large_binary()), pa.scalar(b"", pa.large_binary()))
        offsets = np.frombuffer(spaced.buffers()[1], np.int64)[: len(at) + 1] if len(at) else np.zeros(1, np.int64)
        edges = np.searchsorted(self.row[at], np.arange(self.rows + 1))
        some = np.flatnonzero(np.diff(edges))
        bounds = np.concatenate([offsets[edges[some]], offsets[-1:]])
        text = pa.Array.from_buffers(pa.large_binary(), len(some), [None, pa.py_buffer(bounds), spaced.buffers()[2]])
        first = self.lang_of[self.ids[at[edges[some]]]] if len(some) else np.zeros(0, np.int64)
        return pa.array(self.langs, pa.string()).take(pa.array(first)), text.cast(pa.large_string()).cast(pa.string())


def _rows(arrow: pa.Schema, length: int, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(length, f.type) for f in arrow], schema=arrow)


def one_pass(texts: DataFrame, k: int, least: int, size: int, parts: Broadcast | None, buckets: Broadcast | None, last: bool) -> DataFrame:
    """A pass over texts (lang, text): see PASS.  parts: bits of frequent phrases of k - 1 words, buckets: bits of
    frequent buckets of k words; size: the number of buckets for k + 1 words."""
    kind = StructType.fromDDL(PASS)
    arrow = to_arrow_schema(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # counts beyond `least` need not be told apart: sums of what tasks saw reach it then, too
        seen = np.zeros(0 if last else size, np.uint8)
        top = min(255, least)
        for whole in batches:
            for cut in slices(whole, "text", TEXT_BYTES):
                b = Batch(cut.column(0), cut.column(1))
                h = b.hashed(k if last else k + 1)
                ok = b.within(k)
                if parts is not None and len(ok):
                    frequent = _set(np.frombuffer(parts.value, np.uint8), h[k - 2])
                    ok[:-1] &= frequent[:-1] & frequent[1:]
                    ok &= _set(np.frombuffer(buckets.value, np.uint8), h[k - 1])
                lang, gram, n = b.counted(np.flatnonzero(ok), k)
                yield _rows(arrow, len(n), lang=lang, gram=gram, n=n)
                if last or len(ok) < 2:
                    continue
                starts = b.within(k + 1)
                starts[:-1] &= ok[:-1] & ok[1:]
                at, times = np.unique((h[k][starts] & np.uint64(size - 1)).astype(np.int64), return_counts=True)
                seen[at] = np.minimum(seen[at] + np.minimum(times, top), top)
                if k > 1:
                    lang, rest = b.trimmed(starts, k)
                    yield _rows(arrow, len(rest), lang=lang, rest=rest)
        if not last:
            sliced = seen.reshape(-1, min(SLICE, size))
            some = np.flatnonzero(sliced.any(1))
            yield _rows(arrow, len(some), slice=some, held=[sliced[i].tobytes() for i in some])

    return texts.mapInArrow(run, kind)


def _bitmap(counts: DataFrame, size: int, least: int) -> bytes:
    """counts (slice, held: a byte for each bucket, at most `least`, 255 if that is more): the packed bits of buckets that reach
    `least` together.  Tasks add up slices as they come; what the driver gets is size / 8 bytes."""
    top, held = min(255, least), min(SLICE, size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            for s, raw in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                add = np.frombuffer(raw.as_buffer(), np.uint8)
                sums[s] = np.minimum(sums[s].astype(np.uint16) + add, top).astype(np.uint8) if s in sums else add.copy()
        out = [(s, np.packbits(v >= top, bitorder="little").tobytes()) for s, v in sums.items()]
        yield pa.RecordBatch.from_arrays([pa.array([s for s, _ in out], pa.int32()), pa.array([v for _, v in out], pa.binary())], names=["slice", "bits"])

    n = max(1, min(size // held, partitions(counts.sparkSession)))
    bits = bytearray(size // 8)
    for s, v in counts.select("slice", "held").repartition(n, "slice").mapInArrow(run, "slice int, bits binary").collect():
        bits[s * held // 8 : s * held // 8 + len(v)] = v
    return bytes(bits)


def _frequent_bits(grams: DataFrame, k: int, size: int) -> bytes:
    """Bits of the hashes of all rows of grams (lang, gram), phrases of k words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(size, np.uint8)
        for b in batches:
            langs = b.column(0).dictionary_encode()
            seeds = _lang_seeds(langs.dictionary.to_pylist())[langs.indices.to_numpy()] if b.num_rows else np.zeros(0, np.uint64)
            words = [g.encode().split(b" ") for g in b.column(1).to_pylist()]
            h = _word_hashes([w[0] for w in words], seeds)
            for i in range(1, k):
                h = _longer(h, _word_hashes([w[i] for w in words], seeds))
            seen[h & np.uint64(size - 1)] = 1
        sliced = seen.reshape(-1, min(SLICE, size))
        some = np.flatnonzero(sliced.any(1))
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array([sliced[i].tobytes() for i in some], pa.binary())], names=["slice", "held"])

    return _bitmap(grams.select("lang", "gram").mapInArrow(run, "slice int, held binary"), size, 1)


def _bits(n: float) -> int:
    return min(MOST_BITS, max(LEAST_BITS, 1 << max(0, int(n) - 1).bit_length()))


def frequent(docs: DataFrame, most: int = 5, least: int = 100, text: str = "text", lang: str = "lang") -> tuple[DataFrame, DataFrame]:
    """Phrases of 1 to `most` words that occur `least` times or more in their language (lang, gram, k, n), and the words of
    every language (lang, total).  A null language is und."""
    spark = docs.sparkSession
    texts = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.col(text).cast("string").alias("text")).where("text <> ''")
    # a bit for so many words; a word and its blank have some six bytes
    size = _bits((texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0) / 6 / WORDS_A_BIT)
    found, totals, parts, buckets, raw = [], None, None, None, None
    for k in range(1, most + 1):
        source = texts if k <= 2 else raw.where("rest IS NOT NULL").select("lang", F.col("rest").alias("text"))
        now = keep(one_pass(source, k, least, size, parts, buckets, k == most), "phrases")
        counts = now.where("gram IS NOT NULL").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
        if k == 1:
            counts = keep(counts, "words")
            totals = keep(counts.groupBy("lang").agg(F.sum("n").alias("total")), "totals")
        own = keep(counts.where(F.col("n") >= least).withColumn("k", F.lit(k)), "frequent")
        if k == 1:
            drop_kept(spark, counts)
        found.append(own)
        if raw is not None:
            drop_kept(spark, raw)
        raw = now
        n = own.count()
        if not n or k == most:
            break
        for b in (parts, buckets):
            if b is not None:
                b.destroy()
        parts = spark.sparkContext.broadcast(_frequent_bits(own, k, _bits(SPARE * n)))
        buckets = spark.sparkContext.broadcast(_bitmap(now.where("slice IS NOT NULL"), size, least))
    drop_kept(spark, raw)
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return out, totals


def _joined(left: DataFrame, freq: DataFrame, key: str, value: str) -> DataFrame:
    """left with the count of its phrase `key`, which is always frequent; a word that very many phrases begin
    or end with is dealt out."""
    counts = left.groupBy(key).agg(F.count("*").alias("n"))
    total = left.count()
    return join_hot(left, freq.select(F.col("name").alias(key), F.col("n").alias(value)), key, hot_keys(counts, key, total), ["name", "cut"])


def collocations(docs: DataFrame, most: int = 5, least: int = 100, first: int = 2000, text: str = "text", lang: str = "lang") -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the `first` phrases of each language by score (see the SQL below), then by
    count, then by their bytes.

    Null and empty texts have no words, a null language is und; repeated rows count each; an empty table gives
    an empty result; extra columns are not read; texts are read whole; a piece is worked on with all of its
    text, so memory follows the longest text.  Phrases that lie in a longer one of the same count go."""
    found, totals = frequent(docs, most, least, text, lang)
    # a line feed is in no word, so the last one parts language and phrase
    freq = keep(found.withColumn("name", F.concat("lang", F.lit("\n"), "gram")), "freq")
    longer = freq.where("k > 2").select("lang", "n", F.explode(F.expr("array(substring_index(gram, ' ', k - 1), substring_index(gram, ' ', 1 - k))")).alias("gram"))
    covered = longer.groupBy("lang", "gram").agg(F.max("n").alias("_n"))
    own = freq.where("k > 1").join(covered, ["lang", "gram"], "left").where("_n IS NULL OR _n < n").select("lang", "name", "gram", "k", F.col("n").alias("a"))
    own = keep(own, "candidates")
    cuts = own.withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("k") - 1)))
    head, tail = "concat(lang, '\\n', substring_index(gram, ' ', cut))", "concat(lang, '\\n', substring_index(gram, ' ', cut - k))"
    cuts = keep(cuts.withColumns({"head": F.expr(head), "tail": F.expr(tail)}), "cuts")
    scored = _joined(keep(_joined(cuts, freq, "head", "l"), "heads"), freq, "tail", "r").join(F.broadcast(totals), "lang")
    # products stay within 38 digits up to 10^15 words
    score = "(1000BD * CAST(a AS decimal(16,0)) * CAST(total AS decimal(16,0))) DIV (CAST(l AS decimal(18,0)) * CAST(r AS decimal(18,0)))"
    scored = scored.withColumn("score", F.expr(score))
    best = scored.groupBy("lang", "gram").agg(F.min(F.struct("score", "cut", "a", "l", "r", F.col("total").alias("n"))).alias("b")).select("lang", F.col("gram").alias("phrase"), "b.*")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    part = best.withColumn("_part", F.pmod(F.xxhash64("phrase"), F.lit(RANKED))).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "_part").orderBy(*order))).where(F.col("rank") <= first)
    ranked = part.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= first)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Collocations of all documents; see collocations for nulls, ties, repeated rows, empty tables, extra columns
    and long texts."""
    return collocations(table(spark, sf_dir, "documents").select("text", "lang"))


SQL = r"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
 w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
 s AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM w),
 g AS (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS gram FROM s, (SELECT unnest(range(1, 6)) AS k) ks WHERE i + k - 1 <= len(w)),
 f AS (SELECT lang, k, gram, count(*) AS n FROM g GROUP BY ALL),
 t AS (SELECT lang, CAST(sum(n) AS BIGINT) AS total FROM f WHERE k = 1 GROUP BY lang),
 c AS (SELECT lang, k, gram, n AS a, string_split(gram, ' ') AS w FROM f WHERE k > 1 AND n >= 100),
 inside AS (SELECT DISTINCT x.lang, x.gram FROM c x JOIN (SELECT lang, a, k, w, unnest(range(2, k)) AS m FROM c) z ON z.lang = x.lang AND z.m = x.k AND z.a >= x.a AND contains(' ' || array_to_string(z.w, ' ') || ' ', ' ' || x.gram || ' ')),
 o AS (SELECT * FROM c ANTI JOIN inside USING (lang, gram)),
 u AS (SELECT lang, gram, k, a, w, unnest(range(1, k)) AS cut FROM o),
 v AS (SELECT u.lang, u.gram, u.a, cut, l.n AS l, r.n AS r, t.total AS n, CAST((1000::HUGEINT * u.a * t.total) // (l.n::HUGEINT * r.n) AS BIGINT) AS score
  FROM u JOIN f l ON l.lang = u.lang AND l.gram = array_to_string(u.w[1:cut], ' ') JOIN f r ON r.lang = u.lang AND r.gram = array_to_string(u.w[cut + 1:u.k], ' ') JOIN t ON t.lang = u.lang),
 b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, gram ORDER BY score, cut) AS nth FROM v) x WHERE nth = 1),
 z AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(gram)) AS rank FROM b)
SELECT lang, rank, gram AS phrase, a, l, r, n, score FROM z WHERE rank <= 2000"""
