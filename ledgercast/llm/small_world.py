"""A hierarchical navigable small-world graph of one shard, built and searched for many vectors at once.

Every search runs a block of queries in step: each takes its best candidate that is not expanded yet, and
all their neighbours are measured together. Vectors are unit vectors; nearness is the inner product.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

DEGREE = 16  # links of a node on the upper levels; twice as many on the ground
BUILD_BEAM = 48
BLOCK = 256


@dataclass
class Graph:
    """Unit vectors, and for every level the links of its nodes; -1 is no link or not on the level."""

    vectors: np.ndarray
    links: list[np.ndarray]
    entry: int


def levels_of(count: int, seed: int = 1) -> np.ndarray:
    """Level of each node: one in ``DEGREE`` of a level's nodes is on the next."""
    drawn = np.random.Generator(np.random.PCG64(seed)).random(count)
    return np.floor(-np.log(1 - drawn) / np.log(DEGREE)).astype(np.int64)


def beam(vectors: np.ndarray, links: np.ndarray, queries: np.ndarray, starts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``width`` nearest nodes that each query's walk meets and their nearness; -1 where it meets fewer.

    ``starts`` holds one or more first nodes for each query, -1 for none.
    """
    count, rows = len(queries), np.arange(len(queries))
    seen = np.zeros((count, len(vectors) + 1), dtype=bool)
    seen[:, -1] = True  # where -1 points to
    ids = np.full((count, width), -1, dtype=np.int64)
    near = np.full((count, width), -np.inf, dtype=np.float32)
    done = np.ones((count, width), dtype=bool)

    def take(who: np.ndarray, nodes: np.ndarray) -> None:
        fresh = ~seen[who[:, None], nodes]
        seen[who[:, None], nodes] = True
        found = np.full(nodes.shape, -np.inf, dtype=np.float32)
        at, place = np.nonzero(fresh)
        found[at, place] = np.einsum("ij,ij->i", vectors[nodes[at, place]], queries[who[at]])
        all_near = np.concatenate([near[who], found], axis=1)
        best = np.argpartition(-all_near, width - 1, axis=1)[:, :width]
        step = np.arange(len(who))[:, None]
        near[who] = all_near[step, best]
        ids[who] = np.concatenate([ids[who], np.where(fresh, nodes, -1)], axis=1)[step, best]
        done[who] = np.concatenate([done[who], ~fresh], axis=1)[step, best]

    take(rows, starts)
    while True:
        waiting = np.where(done, -np.inf, near)
        best = waiting.argmax(axis=1)
        active = np.flatnonzero(~done[rows, best])
        if not len(active):
            return ids, near
        expanded = ids[active, best[active]]
        done[active, best[active]] = True
        take(active, links[expanded])


def descend(graph_vectors: np.ndarray, links: list[np.ndarray], entry: int, queries: np.ndarray, to: int) -> np.ndarray:
    """The node nearest to each query on the way down from the top to above level ``to``."""
    nodes = np.full(len(queries), entry, dtype=np.int64)
    for level in range(len(links) - 1, to, -1):
        nodes = beam(graph_vectors, links[level], queries, nodes[:, None], 1)[0][:, 0]
    return nodes


def diverse(vectors: np.ndarray, of: np.ndarray, ids: np.ndarray, near: np.ndarray, most: int) -> np.ndarray:
    """Of each row's candidates the nearest that are nearer to the row's vector than to any chosen before;
    free places go to the nearest of the others. -1 where there are too few."""
    order = np.argsort(-near, axis=1, kind="stable")
    ids, near = np.take_along_axis(ids, order, 1), np.take_along_axis(near, order, 1)
    rows = np.arange(len(of))
    chosen = np.full((len(of), most), -1, dtype=np.int64)
    filled = np.zeros(len(of), dtype=np.int64)
    taken = np.zeros(ids.shape, dtype=bool)
    for rank in range(ids.shape[1]):
        node = ids[:, rank]
        able = np.flatnonzero((node >= 0) & (filled < most))
        if not len(able):
            continue
        others = np.einsum("ijk,ik->ij", vectors[chosen[able]], vectors[node[able]])
        crowded = ((others > near[able, rank][:, None]) & (chosen[able] >= 0)).any(axis=1)
        able = able[~crowded]
        chosen[able, filled[able]] = node[able]
        filled[able] += 1
        taken[able, rank] = True
    for rank in range(ids.shape[1]):
        able = rows[(ids[:, rank] >= 0) & ~taken[:, rank] & (filled < most)]
        chosen[able, filled[able]] = ids[able, rank]
        filled[able] += 1
    return chosen


def _link_back(vectors: np.ndarray, links: np.ndarray, nodes: np.ndarray, chosen: np.ndarray) -> None:
    """Let the chosen neighbours know of the new nodes; full lists keep a diverse choice."""
    most = links.shape[1]
    at, place = np.nonzero(chosen >= 0)
    to, new = chosen[at, place], nodes[at]
    near = np.einsum("ij,ij->i", vectors[to], vectors[new])
    order = np.lexsort((new, -near, to))
    to, new = to[order], new[order]
    rank = np.arange(len(to)) - np.searchsorted(to, to)
    # The nearest of many newcomers are weighed; the others still hold their own link to the node.
    some = rank < DEGREE
    owners, row = np.unique(to[some], return_inverse=True)
    offered = np.full((len(owners), DEGREE), -1, dtype=np.int64)
    offered[row, rank[some]] = new[some]
    ids = np.concatenate([links[owners], offered], axis=1)
    near = np.einsum("ijk,ik->ij", vectors[ids], vectors[owners])
    near[ids < 0] = -np.inf
    ids = np.where(np.isinf(near), -1, ids)
    links[owners] = diverse(vectors, owners, ids, near, most)


def build(vectors: np.ndarray) -> Graph:
    """Insert the vectors in blocks that grow with the graph; members of a block see one another too."""
    count = len(vectors)
    vectors = np.ascontiguousarray(vectors, dtype=np.float32)
    level = levels_of(count)
    order = np.argsort(-level, kind="stable")  # the top first, so that every node finds its levels filled
    links = [np.full((count, DEGREE * (2 if k == 0 else 1)), -1, dtype=np.int64) for k in range(int(level.max(initial=0)) + 1)]
    entry = int(order[0]) if count else -1
    inserted = 1
    while inserted < count:
        block = order[inserted : inserted + min(BLOCK, inserted)]
        starts = np.full((len(block), 1), entry, dtype=np.int64)
        among = vectors[block] @ vectors[block].T
        np.fill_diagonal(among, -np.inf)
        for k in range(len(links) - 1, -1, -1):
            on = level[block] >= k
            ids, near = beam(vectors, links[k], vectors[block], starts, BUILD_BEAM if on.any() else 1)
            starts = ids if on.any() else ids[:, :1]
            if not on.any():
                continue
            nodes = block[on]
            peers = among[np.ix_(on, on)]
            closest = np.argsort(-peers, axis=1)[:, :DEGREE]
            peer_near = np.take_along_axis(peers, closest, 1)
            peer_ids = np.where(np.isinf(peer_near), -1, nodes[closest])
            ids, near = np.concatenate([ids[on], peer_ids], axis=1), np.concatenate([near[on], peer_near], axis=1)
            chosen = diverse(vectors, nodes, ids, near, DEGREE)
            links[k][nodes, :DEGREE] = chosen
            _link_back(vectors, links[k], nodes, chosen)
        inserted += len(block)
    return Graph(vectors, links, entry)


def nearest(graph: Graph, queries: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """About the ``width`` nearest nodes of each query and their nearness."""
    queries = np.ascontiguousarray(queries, dtype=np.float32)
    starts = descend(graph.vectors, graph.links, graph.entry, queries, 0)
    return beam(graph.vectors, graph.links[0], queries, starts[:, None], min(width, len(graph.vectors)))
