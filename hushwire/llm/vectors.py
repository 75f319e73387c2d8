"""Embedding near-duplicates by hierarchical navigable small-world graphs.

Vectors of one label are dealt into shards of a bounded size by a hash of their id.  Every shard gets a
graph; every vector queries every shard of its label, but of two shards one is asked by the other, so a pair
is met once.  A search descends the layers to the query's neighbourhood and collects the nearest by a beam.
Where half the beam or more is within the wanted cosine the neighbourhood may go on beyond it, and the
query is compared with the whole shard.  In each task a fixed number of queries, drawn at random, are
compared with the whole shard; while the searches find too few of their nearest, or of their links, the beam is
widened.  Links are verified in double precision.  A task returns, for each vector, the number of its links and one link towards the task's
smallest vector that it reaches: pairs within a group are counted, never listed.  Components join these.
"""

from __future__ import annotations

import heapq
import pickle

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hushwire.llm.common import drop_kept, hot_keys, join_hot, keep, table
from hushwire.llm.graph import components

COSINE = 0.98
#: Vectors to a shard, on average.
SHARD = 8192
#: Neighbours kept (twice as many in the lowest layer), beam of building and of searching.
M, BUILD_BEAM, BEAM = 12, 40, 24
#: Queries of a task that are audited, the shares of their links and of their NEAREST nearest that they must find on
#: average, and the widest beam tried; beyond it all of the task's queries meet the whole shard.
AUDIT, RECALL, NEAR_RECALL, NEAREST, WIDEST = 48, 0.995, 0.9, 10, 1536
#: Queries compared with a whole shard at once.
AT_ONCE = 128



class Graph:
    """HNSW over unit vectors."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, copies: np.ndarray | None = None):
        """x: rows of unit length, in double precision; ids ascend; copies: vectors that each stands for."""
        self.ids, self.x, self.copies = ids, x, np.ones(len(ids), np.int64) if copies is None else copies
        self.near = x.astype(np.float32)
        self.compared = 0
        rng = np.random.default_rng(5)
        self.level = np.minimum((-np.log(1 - rng.random(len(ids))) / np.log(M)).astype(int), 8)
        self.links: list[dict[int, list[int]]] = [{} for _ in range(int(self.level.max(initial=0)) + 1)]
        self.entry, self.top = -1, -1
        for i in range(len(ids)):
            self._insert(i)

    def _search(self, q, entries, beam, layer, links):
        """(similarity, node) of the nearest `beam` found, unordered."""
        seen = set(entries)
        s = self.near[entries] @ q
        todo = [(-v, i) for v, i in zip(s.tolist(), entries, strict=True)]
        best = [(v, i) for v, i in zip(s.tolist(), entries, strict=True)]
        heapq.heapify(todo)
        heapq.heapify(best)
        while todo:
            v, i = heapq.heappop(todo)
            if len(best) >= beam and -v < best[0][0]:
                break
            new = [j for j in links[i] if j not in seen]
            if not new:
                continue
            seen.update(new)
            for w, j in zip((self.near[new] @ q).tolist(), new, strict=True):
                if len(best) < beam:
                    heapq.heappush(best, (w, j))
                    heapq.heappush(todo, (-w, j))
                elif w > best[0][0]:
                    heapq.heapreplace(best, (w, j))
                    heapq.heappush(todo, (-w, j))
        return best

    def _choose(self, i: int, found: list[tuple[float, int]], most: int) -> list[int]:
        """Neighbours in different directions first: one that is nearer to a chosen neighbour than to i
        is taken only if there is room left."""
        found = sorted(found, reverse=True)[: 3 * most]
        nodes = [j for _, j in found]
        among = self.near[nodes] @ self.near[nodes].T
        chosen, rest = [], []
        for a, (s, _) in enumerate(found):
            if len(chosen) == most:
                break
            if all(among[a, b] <= s for b in chosen):
                chosen.append(a)
            else:
                rest.append(a)
        return [nodes[a] for a in (chosen + rest)[:most]]

    def _insert(self, i: int) -> None:
        q, own = self.near[i], int(self.level[i])
        at = [self.entry]
        for layer in range(self.top, own, -1):
            at = [max(self._search(q, at, 1, layer, self.links[layer]))[1]]
        for layer in range(min(own, self.top), -1, -1):
            found = self._search(q, at, BUILD_BEAM, layer, self.links[layer])
            most = 2 * M if layer == 0 else M
            self.links[layer][i] = self._choose(i, found, M)
            for j in self.links[layer][i]:
                theirs = self.links[layer][j]
                theirs.append(i)
                if len(theirs) > most + 6:  # shrunk now and then, not at every link
                    s = (self.near[theirs] @ self.near[j]).tolist()
                    self.links[layer][j] = self._choose(j, list(zip(s, theirs, strict=True)), most)
            at = [j for _, j in found]
        for layer in range(self.top + 1, own + 1):
            self.links[layer][i] = []
        if own > self.top:
            self.entry, self.top = i, own

    def met(self, q: np.ndarray, beam: int) -> list[tuple[float, int]]:
        """(similarity, node) of what the search with this beam meets."""
        q32 = q.astype(np.float32)
        at = [self.entry]
        for layer in range(self.top, 0, -1):
            at = [max(self._search(q32, at, 1, layer, self.links[layer]))[1]]
        return self._search(q32, at, beam, 0, self.links[0])

    def within(self, q: np.ndarray, beam: int, least: float) -> np.ndarray | None:
        """Nodes of similarity `least` or more that the search with this beam meets; None where there may
        be more than the beam holds."""
        hits = [j for s, j in self.met(q, beam) if s >= least - 1e-4]
        return None if len(hits) >= beam // 2 and len(self.ids) > beam else np.array(hits, np.int64)

    def compare(self, qs: np.ndarray) -> np.ndarray:
        """The queries' cosines with all nodes."""
        self.compared += len(qs)
        return qs @ self.x.T


class Links:
    """Numbers of links by place, and stars that connect them."""

    def __init__(self, n: int):
        self.count, self.root = np.zeros(n, np.int64), np.arange(n)

    def add(self, one: int, others: np.ndarray, weights: np.ndarray) -> None:
        """Links of one place with others; weights: vectors that a place stands for."""
        self.count[one] += weights[others].sum()
        self.count[others] += weights[one]
        roots = np.unique(self.root[np.append(others, one)])
        if len(roots) > 1:
            self.root[np.isin(self.root, roots[1:])] = roots[0]


def audit(graph: Graph, x: np.ndarray, place: np.ndarray | None, least: float) -> tuple[int, float | None, float | None, int]:
    """(queries audited, share of their links found, share of their nearest found, beam) for queries x against a
    graph; place: the queries' own nodes in it, which count for nothing.  Shares are null where there was nothing
    to find.  Beyond the widest beam all is compared, and shares are 1."""
    chosen = np.random.default_rng(7).permutation(len(x))[:AUDIT]
    rows = graph.compare(x[chosen])
    if place is not None:
        rows[np.arange(len(chosen)), place[chosen]] = -2.0
    wanted = []
    for row in rows:
        top = np.argsort(-row, kind="stable")[:NEAREST]
        wanted.append((np.flatnonzero(row >= least), top[row[top] > -2.0]))
    mean = lambda got: float(np.mean(got)) if got else None
    beam = BEAM
    while beam <= WIDEST:
        links, near = [], []
        for k, (hits, top) in zip(chosen.tolist(), wanted, strict=True):
            found = {j for _, j in graph.met(x[k], beam)}
            if len(top):
                near.append(np.mean([j in found for j in top.tolist()]))
            if len(hits):
                some = graph.within(x[k], beam, least)
                links.append(1.0 if some is None else np.isin(hits, some).mean())
        recall, close = mean(links), mean(near)
        if (recall is None or recall >= RECALL) and (close is None or close >= NEAR_RECALL):
            return len(near), recall, close, beam
        beam *= 2
    return len(chosen), 1.0, 1.0, beam


def linked(graph: Graph, ids: np.ndarray, x: np.ndarray, copies: np.ndarray, own: bool, least: float):
    """(ids, numbers of links, stars' centres) of all vectors with links between queries (ids, x) and a
    graph, and the audit().  own: the queries are of the graph's own shard; each pair then counts once, and
    nothing links with itself."""
    n = len(graph.ids)
    every = np.concatenate([graph.ids, np.zeros(0, np.int64) if own else ids])
    weights = np.concatenate([graph.copies, np.zeros(0, np.int64) if own else copies])
    place = np.searchsorted(graph.ids, ids) if own else n + np.arange(len(ids))
    seen = audit(graph, x, place if own else None, least)
    beam = seen[3]
    links, whole = Links(len(every)), []
    for k in range(len(ids)):
        found = graph.within(x[k], beam, least) if beam <= WIDEST else None
        if found is None:
            whole.append(k)
            continue
        found = found[graph.x[found] @ x[k] >= least]
        # within a shard a pair is counted from its smaller place alone
        found = found[found > place[k]] if own else found
        if len(found):
            links.add(int(place[k]), found, weights)
    for a in range(0, len(whole), AT_ONCE):
        ks = np.array(whole[a : a + AT_ONCE])
        for k, row in zip(ks.tolist(), graph.compare(x[ks]) >= least, strict=True):
            found = np.flatnonzero(row)
            found = found[found > place[k]] if own else found
            if len(found):
                links.add(int(place[k]), found, weights)
    at = np.flatnonzero(links.count)
    return every[at], links.count[at], every[links.root[at]], seen


def _unit(v) -> np.ndarray:
    x = np.stack([np.asarray(e, np.float64) for e in v])
    x = x / np.abs(x).max(1, keepdims=True)  # so that squares neither overflow nor vanish
    return x / np.sqrt((x * x).sum(1, keepdims=True))


#: What tasks return: a vector's links in one shard and the centre of their star; or, with no node, an audit.
MET = "grp string, shard int, other int, node long, links long, root long, audited long, recall double, near double, beam int"
FINE = (
    "vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND size(embedding) > 0 "
    "AND forall(embedding, v -> v IS NOT NULL AND NOT isnan(v) AND abs(v) < CAST('Infinity' AS DOUBLE)) AND exists(embedding, v -> v <> 0)"
)


def searched(vectors: DataFrame, least: float, size: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Vectors with the hashes that name their node; the nodes (equal vectors of one label) with their copies
    and an id; and what the searches met (see MET)."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding", F.col("label").cast("string").alias("label"))
    hashed = rows.where(FINE).select(
        "vec_id", "embedding", F.concat_ws(":", F.size("embedding"), "label").alias("grp"), F.xxhash64("embedding").alias("h1"), F.xxhash64(F.lit(1), "embedding", F.lit(2)).alias("h2")
    )
    # two hashes stand for a vector; a vec_id may hold several vectors, so a node goes by its own hash
    node = F.xxhash64("grp", "h1", "h2").alias("node")
    nodes = hashed.groupBy("grp", "h1", "h2").agg(F.min("vec_id").alias("least"), F.count("*").alias("copies"), F.first("embedding").alias("embedding"))
    nodes = keep(nodes.select("grp", "h1", "h2", node, "least", "copies", "embedding"), "nodes")
    sizes = nodes.groupBy("grp").agg(F.ceil(F.count("*") / size).cast("int").alias("shards"))
    dealt = nodes.join(sizes, "grp").select("grp", F.expr("CAST(pmod(xxhash64(node), shards) AS int)").alias("shard"), "shards", "node", "copies", "embedding")
    dealt = keep(dealt, "dealt")

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("node")
        g = Graph(pdf["node"].to_numpy(), _unit(pdf["embedding"]), pdf["copies"].to_numpy())
        return pd.DataFrame({"grp": [pdf["grp"].iloc[0]], "shard": [pdf["shard"].iloc[0]], "graph": [pickle.dumps(g)]})

    graphs = keep(dealt.groupBy("grp", "shard").applyInPandas(build, "grp string, shard int, graph binary"), "graphs")
    queries = dealt.select("grp", "shard", F.explode(F.expr("sequence(shard, shards - 1)")).alias("other"), "node", "copies", "embedding")
    asked = graphs.select("grp", F.explode(F.expr("sequence(0, shard)")).alias("shard"), F.col("shard").alias("other"), "graph")

    def query(key, q: pd.DataFrame, g: pd.DataFrame) -> pd.DataFrame:
        if not len(q) or not len(g):
            return pd.DataFrame({n: [] for n in ("grp", "shard", "other", "node", "links", "root", "audited", "recall", "near", "beam")})
        q = q.sort_values("node")
        ids, links, roots, audited = linked(pickle.loads(g["graph"].iloc[0]), q["node"].to_numpy(), _unit(q["embedding"]), q["copies"].to_numpy(), key[1] == key[2], least)
        found = pd.DataFrame({"node": pd.array(ids, "Int64"), "links": pd.array(links, "Int64"), "root": pd.array(roots, "Int64")})
        last = pd.DataFrame({"audited": pd.array([audited[0]], "Int64"), "recall": pd.array([audited[1]], "Float64"), "near": pd.array([audited[2]], "Float64"), "beam": pd.array([audited[3]], "Int32")})
        out = pd.concat([found, last])
        return out.assign(grp=key[0], shard=key[1], other=key[2])[["grp", "shard", "other", "node", "links", "root", "audited", "recall", "near", "beam"]]

    by = ["grp", "shard", "other"]
    met = keep(queries.groupBy(*by).cogroup(asked.groupBy(*by)).applyInPandas(query, MET), "met")
    for done in (dealt, graphs):
        drop_kept(vectors.sparkSession, done)
    return hashed, nodes, met


def shard_recall(vectors: DataFrame, least: float = COSINE, size: int = SHARD) -> DataFrame:
    """For each pair of shards of a label: how many random queries were audited against the whole shard (selves
    excluded), the mean shares of their links (recall; null: they have none) and of their nearest (near) that the
    search found, and the beam that it took.  An empty table gives an empty result."""
    return searched(vectors, least, size)[2].where("node IS NULL").select("grp", "shard", "other", "audited", "recall", "near", "beam")


def near_vectors(vectors: DataFrame, least: float = COSINE, size: int = SHARD) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row.  Vectors that are null, empty, zero or hold null
    or non-finite components, and rows without label, link with nothing; vectors of different lengths
    neither.  Equal vectors of one label are one node and link with each other.  Each row of a vec_id
    counts as a vector of its own, whatever its vector and label.  Rows without vec_id take no part and have
    no component.  An empty table gives an empty result; extra columns are ignored; vectors of any length
    will do as long as a shard of them fits in a task."""
    hashed, nodes, met = searched(vectors, least, size)
    stars = met.where("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b"))
    reach = components(stars)
    degree = met.where("node IS NOT NULL").groupBy("node").agg(F.sum("links").alias("others"))
    rooted = keep(
        nodes.select("grp", "h1", "h2", "node", "least", "copies").join(degree, "node", "left").join(reach, "node", "left").withColumn("root", F.coalesce("root", "node")), "rooted"
    )
    for done in (nodes, met):
        drop_kept(vectors.sparkSession, done)
    first = rooted.groupBy("root").agg(F.min("least").alias("component_id"), F.count("*").alias("n"))
    total, vectors_ = rooted.agg(F.count("*"), F.coalesce(F.sum("copies"), F.lit(0))).first()
    # a component may hold most nodes, and a node most vectors
    named = join_hot(rooted, first.select("root", "component_id"), "root", hot_keys(first, "root", total), ["node"])
    named = named.select("node", (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id")
    hot = hot_keys(rooted.select("node", F.col("copies").alias("n")), "node", vectors_)
    found = join_hot(hashed.select("vec_id", F.xxhash64("grp", "h1", "h2").alias("node")), named, "node", hot, ["vec_id"]).select("vec_id", "n_links", "component_id")
    rest = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding", "label").where(f"NOT coalesce({FINE}, false)")
    rest = rest.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return found.unionByName(rest).withColumn("kept", F.col("vec_id") == F.col("component_id"))


def op10_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all embeddings; see near_vectors for nulls, ties, repeats and empty tables."""
    return near_vectors(table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"))
