"""The audit of a graph: a fixed number of comparisons, whatever there is to find."""

import numpy as np

from hushwire.llm import vectors


def made(n, seed, dim=24):
    return vectors._unit(list(np.random.default_rng(seed).normal(size=(n, dim))))


def test_no_brute_force_without_links():
    """Two shards without a link between them: only the audited queries meet the whole shard."""
    x, y = made(1500, 1), made(1500, 2)
    graph = vectors.Graph(np.arange(1500), x)
    nodes, links, _, (audited, recall, near, beam) = vectors.linked(graph, np.arange(1500, 3000), y, np.ones(1500, np.int64), False, 0.98)
    assert graph.compared == audited == vectors.AUDIT and recall is None and near >= vectors.NEAR_RECALL and beam <= vectors.WIDEST
    assert len(nodes) == len(links) == 0


def test_rare_links_are_found():
    """One vector in thirty has a near copy in the other shard: nearly all are met, most of them by the search alone."""
    x, y = made(1500, 3), made(1500, 4)
    y[::30] = vectors._unit(list(x[::30] + np.random.default_rng(5).normal(size=(50, 24)) * 0.01))
    graph = vectors.Graph(np.arange(1500), x)
    want = int(((y @ x.T) >= 0.98).sum())
    nodes, links, _, audit = vectors.linked(graph, np.arange(1500, 3000), y, np.ones(1500, np.int64), False, 0.98)
    assert graph.compared < 150 and links.sum() / 2 >= 0.98 * want >= 40


def test_nothing_to_audit():
    graph = vectors.Graph(np.array([5]), made(1, 1))
    assert vectors.linked(graph, np.array([5]), made(1, 1), np.ones(1, np.int64), True, 0.98)[3] == (0, None, None, vectors.BEAM)
