"""Shards by a k-d tree over metadata, in DataFrame functions alone.

A node of the tree holds rows and is to become a number of shards.  It is split along the metadata dimension
in which it is widest, at the weighted median of its bytes (for an odd number of shards: at the quantile that
gives each side its part).  Medians are found for all nodes of a level at once, without sorting or moving
rows: bytes are summed by bins of the dimension's range, the bin that holds the median is cut into bins
again, and the few rows of the last bin are walked exactly.  Rows are told apart by dimension, hash, id and
number, in this order, so a value that holds most bytes (one source, one text) is split within itself.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, DataType, DateType, DecimalType, DoubleType, FloatType, IntegerType, LongType, ShortType

from hushwire.llm.common import keep, table

#: Bins of one histogram; rows of a node's last bin that are walked in order; levels between written tables.
BINS, WALKED, LEVELS = 1024, 20_000, 6
#: Rows that are numbered together within a shard.
NUMBERED = 100_000
LEAST, MOST = -(1 << 63), (1 << 63) - 1
KEYS = 4


@dataclass(frozen=True)
class Search:
    """Where a node's cut lies: rows whose first keys are `fixed` and whose next one is in low..high, `need`
    bytes into them.  dim: the dimension that is the first key; left: shards of the left side."""

    node: int
    dim: int
    left: int
    need: int
    rows: int
    low: int
    high: int
    fixed: tuple[int, ...] = field(default=())


def place(c: Column, kind: DataType) -> Column:
    """A column as a whole number: numbers and dates by value (fractions in millionths), all else by hash,
    which keeps equal values together.  Null counts as 0."""
    if isinstance(kind, (ByteType, ShortType, IntegerType, LongType)):
        out = c.cast("long")
    elif isinstance(kind, DateType):
        out = F.unix_date(c).cast("long")
    elif isinstance(kind, (FloatType, DoubleType, DecimalType)):
        out = F.round(c.cast("double") * 1e6).try_cast("long")
    else:
        out = F.xxhash64(c.cast("string"))
    return F.coalesce(out, F.lit(0).cast("long"))


def _rows(searches: list[Search]) -> str:
    """The searches as rows of SQL: as many as the level has nodes, fewer than shards."""
    whole = lambda v: f"CAST({v} AS BIGINT)" if v > LEAST else f"({LEAST + 1}L - 1L)"
    listed = []
    for s in searches:
        fixed = [*s.fixed, *[0] * (KEYS - len(s.fixed))]
        # distances within a range beyond 63 bits are taken in twos
        shift = int(s.high - s.low > MOST)
        listed.append(f"({s.node}, {s.dim}, {len(s.fixed)}, {shift}, {whole(s.low)}, {whole(s.high)}, {whole(s.need)}, {', '.join(map(whole, fixed))})")
    return f"SELECT * FROM VALUES {', '.join(listed)} AS t(_node, _dim, _stage, _shift, _low, _high, _need, _f0, _f1, _f2, _f3)"


def _within(rows: DataFrame, searches: list[Search], dims: int) -> DataFrame:
    """The rows among which the cuts of the searches lie, with their keys _k0 to _k3 and _v, the open one."""
    spark = rows.sparkSession
    j = rows.join(F.broadcast(spark.sql(_rows(searches))), "_node")
    j = j.withColumns({"_k0": F.element_at(F.array(*(f"_x{i}" for i in range(dims))), F.col("_dim") + 1), "_k1": F.col("_h"), "_k2": F.col("_id"), "_k3": F.col("_u")})
    j = j.withColumn("_v", F.expr("CASE _stage WHEN 0 THEN _k0 WHEN 1 THEN _k1 WHEN 2 THEN _k2 ELSE _k3 END"))
    same = F.expr(" AND ".join(f"(_stage <= {i} OR _k{i} = _f{i})" for i in range(KEYS - 1)))
    return j.where(same & F.col("_v").between(F.col("_low"), F.col("_high")))


def _narrowed(rows: DataFrame, searches: list[Search], dims: int) -> list[Search]:
    """The searches, each brought down to the bin that its cut lies in.  Bins are summed before they are
    dealt out, and there are at most BINS for a node."""
    far = "CAST(shiftright({}, _shift) - shiftright(_low, _shift) AS double)".format
    bin_ = F.expr(f"floor({far('_v')} / ({far('_high')} + 1D) * {BINS})")
    bins = _within(rows, searches, dims).groupBy("_node", bin_.alias("_bin"), "_need").agg(F.sum("_size").alias("_b"), F.count("*").alias("_n"), F.min("_v").alias("_a"), F.max("_v").alias("_z"))
    before = F.coalesce(F.sum("_b").over(Window.partitionBy("_node").orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    hit = bins.withColumn("_before", before).where("_before <= _need AND _need < _before + _b")
    by_node = {s.node: s for s in searches}
    out = []
    for r in hit.select("_node", "_before", "_n", "_a", "_z").collect():
        s = by_node[r[0]]
        s = replace(s, need=s.need - r[1], rows=r[2], low=r[3], high=r[4])
        if s.low == s.high and len(s.fixed) < KEYS - 1:
            s = replace(s, fixed=(*s.fixed, s.low), low=LEAST, high=MOST)
        out.append(s)
    return out


def _cuts(rows: DataFrame, searches: list[Search], dims: int) -> list[tuple[Search, tuple[int, ...], bool]]:
    """The row at which each node is cut, and whether it belongs to the left side: the nearer of both."""
    j = _within(rows, searches, dims)
    sum_ = F.sum("_size").over(Window.partitionBy("_node").orderBy("_k0", "_k1", "_k2", "_k3").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    hit = j.withColumn("_sum", sum_).where("_need < _sum AND _sum - _size <= _need")
    at = hit.select("_node", "_k0", "_k1", "_k2", "_k3", F.expr("2 * (_need - (_sum - _size)) >= _size").alias("_own")).collect()
    by_node = {s.node: s for s in searches}
    return [(by_node[r[0]], tuple(r[1:5]), r[5]) for r in at]


def _descended(rows: DataFrame, cuts: list[tuple[Search, tuple[int, ...], bool]], dims: int) -> DataFrame:
    """Rows with the node that they are of one level further down."""
    whole = lambda v: f"CAST({v} AS BIGINT)" if v > LEAST else f"({LEAST + 1}L - 1L)"
    listed = ", ".join(f"({s.node}, {s.dim}, {s.left}, {', '.join(map(whole, key))}, {str(own).lower()})" for s, key, own in cuts)
    tree = rows.sparkSession.sql(f"SELECT * FROM VALUES {listed} AS t(_node, _dim, _left, _c0, _c1, _c2, _c3, _own)")
    j = rows.join(F.broadcast(tree), "_node", "left")
    x = "element_at(array(" + ", ".join(f"_x{i}" for i in range(dims)) + "), _dim + 1)"
    key, at = f"named_struct('a', {x}, 'b', _h, 'c', _id, 'd', _u)", "named_struct('a', _c0, 'b', _c1, 'c', _c2, 'd', _c3)"
    right = F.expr(f"CASE WHEN _left IS NULL THEN false WHEN _own THEN {key} > {at} ELSE {key} >= {at} END")
    return j.withColumn("_node", F.when(right, F.col("_node") + F.col("_left")).otherwise(F.col("_node"))).drop("_dim", "_left", "_c0", "_c1", "_c2", "_c3", "_own")


def kd_shards(docs: DataFrame, size: Column, dims: tuple[str, ...] = ("source", "lang", "doc_id"), ident: str = "doc_id", tie: str = "text_crc32", shards: int | None = None, target_bytes: int | None = None) -> DataFrame:
    """docs as a struct `row`, with shard (from 0) and slot (its number within the shard, gapless from 0).
    size: bytes of a row, 1 at least.  Give either the number of shards or the bytes that one is to have.
    tie, a column, and then ident tell rows of equal dimensions apart, so equal texts of one place in the
    metadata stay neighbours.  Bytes of shards differ by a few rows' sizes at most (half a row for each level).

    Null metadata count as 0 (numbers) or as a value of their own (all else); repeated rows are rows of their
    own and may part; an empty table gives an empty result; extra columns pass through within `row`, whatever
    their names; with fewer rows than shards some shards stay empty.  Long texts matter by their size alone."""
    spark = docs.sparkSession
    kinds = {f.name: f.dataType for f in docs.schema}
    coords = {f"_x{i}": place(F.col(f"row.`{d}`"), kinds[d]) for i, d in enumerate(dims)}
    rows = docs.select(F.struct("*").alias("row"), size.cast("long").alias("_size")).select(
        "row", "_size", *(c.alias(n) for n, c in coords.items()), F.xxhash64(F.col(f"row.`{tie}`").cast("string")).alias("_h"), place(F.col(f"row.`{ident}`"), kinds[ident]).alias("_id"), F.monotonically_increasing_id().alias("_u"), F.lit(0).alias("_node"),
    )
    # written once: the passes below read small columns, and the rows' numbers are fixed
    rows = keep(rows, "kd")
    ends = [f(f"_x{i}").alias(f"{n}{i}") for i in range(len(dims)) for n, f in (("a", F.min), ("z", F.max))]
    whole = rows.agg(F.sum("_size").alias("bytes"), F.count("*").alias("rows"), *ends).first()
    total = whole["bytes"] or 0
    shards = shards or max(1, -(-total // max(1, target_bytes or 1)))
    width = [max(1, (whole[f"z{i}"] or 0) - (whole[f"a{i}"] or 0)) for i in range(len(dims))]
    parts, level = {0: shards}, 0
    while any(k > 1 for k in parts.values()) and total:
        stats = rows.groupBy("_node").agg(F.sum("_size").alias("bytes"), F.count("*").alias("rows"), *ends)
        searches = []
        for r in stats.collect():
            k = parts[r["_node"]]
            if k > 1:
                dim = max(range(len(dims)), key=lambda i: ((r[f"z{i}"] - r[f"a{i}"]) / width[i], -i))
                searches.append(Search(r["_node"], dim, k // 2, r["bytes"] * (k // 2) // k, r["rows"], r[f"a{dim}"], r[f"z{dim}"]))
        ready = []
        while searches:
            ready += [s for s in searches if s.rows <= WALKED]
            searches = [s for s in searches if s.rows > WALKED]
            searches = _narrowed(rows, searches, len(dims)) if searches else []
        rows = _descended(rows, _cuts(rows, ready, len(dims)), len(dims)) if ready else rows
        parts = {n: k for node, k0 in parts.items() for n, k in (((node, k0 // 2), (node + k0 // 2, k0 - k0 // 2)) if k0 > 1 else ((node, k0),))}
        level += 1
        if level % LEVELS == 0:
            rows = keep(rows, "kd-level")
    return numbered(rows.withColumnRenamed("_node", "shard"), max(1, (whole["rows"] or 0) // (shards * NUMBERED) + 1)).select("row", "shard", "slot")


def numbered(rows: DataFrame, parts: int) -> DataFrame:
    """Slots within shards: rows are numbered in parts of some NUMBERED rows, and the parts laid end to end."""
    dealt = rows.withColumn("_part", F.pmod(F.xxhash64("_u"), F.lit(parts)).cast("int"))
    sizes = dealt.groupBy("shard", "_part").agg(F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.partitionBy("shard").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    own = F.row_number().over(Window.partitionBy("shard", "_part").orderBy("_id", "_h", "_u"))
    return dealt.withColumn("_own", own).join(sizes.select("shard", "_part", before.alias("_before")), ["shard", "_part"]).withColumn("slot", (F.col("_before") + F.col("_own") - 1).cast("long"))


def with_sizes(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with size (UTF-8 bytes of the text, null: none, and 8) and text_crc32."""
    t = F.coalesce(F.col(text).cast("string"), F.lit(""))
    return docs.withColumns({"size": F.octet_length(t).cast("long") + 8, "text_crc32": F.crc32(t.cast("binary"))})


def write_shards(docs: DataFrame, path: str, target_bytes: int, dims: tuple[str, ...] = ("source", "lang", "doc_id")) -> None:
    """Write docs as Parquet in one folder a shard (shard=N), each of about target_bytes of text."""
    t = F.coalesce(F.col("text").cast("string"), F.lit(""))
    held = docs.select(F.struct("*").alias("doc"), *(F.col(d).alias(f"_d{i}") for i, d in enumerate(dims)), F.col("doc_id").alias("_doc"), F.crc32(t.cast("binary")).alias("_crc"), (F.octet_length(t) + 8).alias("_bytes"))
    out = kd_shards(held, F.col("_bytes"), tuple(f"_d{i}" for i in range(len(dims))), "_doc", "_crc", target_bytes=target_bytes)
    names = [c for c in docs.columns if c.lower() != "shard"]
    out.select(*(F.col(f"row.doc.`{c}`") for c in names), "shard").repartition("shard").write.mode("overwrite").partitionBy("shard").parquet(path)


def op13_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 24 shards of nearly equal bytes.  A null text has no bytes; repeated rows each have a
    slot; rows of one size, source and language are ordered by text and id; an empty table gives an empty
    result; other columns of documents are not read."""
    docs = with_sizes(table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang")).drop("text")
    out = kd_shards(docs, F.col("size"), shards=24)
    return out.select("row.doc_id", "row.size", "row.text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int").alias("shard"), "slot", F.lit(None).cast("int").alias("grown_shard"))
