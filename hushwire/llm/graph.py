"""Connected components of a link table by alternating stars, in shuffles alone."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hushwire.llm.common import as_batch, drop_kept, hot_keys, join_hot, keep

#: Links that a task holds while it contracts its own.
HELD = 2_000_000


def forest(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The stars (node, least node of its component) that connect what the links u - v connect."""
    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = at[: len(u)], at[len(u) :]
    parent = np.arange(len(nodes))
    while len(a):
        low = np.minimum(parent[a], parent[b])
        np.minimum.at(parent, parent[a], low)
        np.minimum.at(parent, parent[b], low)
        while (parent[parent] != parent).any():
            parent = parent[parent]
        apart = parent[a] != parent[b]
        a, b = a[apart], b[apart]
    far = np.flatnonzero(parent != np.arange(len(nodes)))
    return nodes[far], nodes[parent[far]]


def contracted(edges: DataFrame) -> DataFrame:
    """edges (u > v, longs) with the links of each task replaced by stars: fewer links and shorter paths."""
    arrow = pa.schema([("u", pa.int64()), ("v", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        u = v = np.zeros(0, np.int64)
        for b in batches:
            u, v = forest(np.concatenate([u, b.column(0).to_numpy()]), np.concatenate([v, b.column(1).to_numpy()]))
            if len(u) > HELD:
                yield as_batch({"u": pa.array(u), "v": pa.array(v)}, arrow)
                u = v = np.zeros(0, np.int64)
        yield as_batch({"u": pa.array(u), "v": pa.array(v)}, arrow)

    return edges.mapInArrow(run, "u long, v long")


def with_least(rows: DataFrame, total: int) -> DataFrame:
    """rows (u, v) with m, the least v of each u.  Minima are taken by aggregation, which shrinks a node's
    links before they are dealt out, and joined back with the links of large nodes dealt over many tasks."""
    least = rows.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
    return join_hot(rows, least.select("u", "m"), "u", hot_keys(least, "u", total), ["u", "v"])


def components(links: DataFrame) -> DataFrame:
    """links: columns a, b of type long.  Returns node, root (the smallest node reachable) for every node
    that has a link to another; links with a null and links of a node to itself count for nothing, and an
    empty table gives an empty one.  Tasks first contract their own links.  Then each round makes a large
    star and a small star at every node, which shortens paths at least by a constant factor; rounds end
    when nothing changes.  The links of a round are written to the shared folder, and no node's neighbours
    are gathered."""
    spark = links.sparkSession
    state = (F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")))
    edges = keep(contracted(links.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()).distinct(), "links")
    before = edges.agg(*state).first()
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        near = with_least(both, 2 * before[0]).withColumn("m", F.least("u", "m"))
        large = keep(near.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct(), "stars")
        small = with_least(large, before[0])
        small = small.select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        new = keep(small.select("e.u", "e.v").where("u != v").distinct(), "links")
        # links and the checksum of them all: equal twice in a row means that stars are final
        now = new.agg(*state).first()
        drop_kept(spark, edges)
        drop_kept(spark, large)
        edges = new
        if now == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        before = now
