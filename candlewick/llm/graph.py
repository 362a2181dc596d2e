"""Robust-pruned directed graph over one shard of vectors (numpy).

``build`` inserts points in batches of growing size: a greedy beam search on
the graph so far proposes neighbours, relaxed distance pruning keeps diverse
edges (a candidate goes if a kept neighbour is ``alpha`` times closer to it
than the point is), and reverse edges are added and pruned where they are
too many.  Distances are squared Euclidean; all searches of a batch step
together.
"""

from __future__ import annotations

import numpy as np

DEGREE, BUILD_BEAM, SEARCH_BEAM = 24, 48, 80
ALPHA = 1.2
BATCH, SEED = 256, 5


def beam_search(x: np.ndarray, sq: np.ndarray, edges: np.ndarray, start: int, queries: np.ndarray,
                beam: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids and distances (less the query's own square) of the ``beam`` best
    found for each query, nearest first and -1 for none; and the nodes
    expanded on the way."""
    n = len(queries)
    ids, far = np.full((n, beam), -1), np.full((n, beam), np.inf, np.float32)
    ids[:, 0] = start
    far[:, 0] = sq[start] - 2 * (queries @ x[start])
    todo = np.zeros((n, beam), bool)
    todo[:, 0] = True
    trail = []
    rows = np.arange(n)
    while len(rows):
        at = todo[rows].argmax(1)
        now = ids[rows, at]
        todo[rows, at] = False
        seen = np.full(n, -1)
        seen[rows] = now
        trail.append(seen)
        near = edges[now]
        dead = (near < 0) | (near[:, :, None] == ids[rows][:, None, :]).any(2)
        d = sq[near] - 2 * np.einsum("nd,nwd->nw", queries[rows], x[near])
        d[dead] = np.inf
        all_ids = np.concatenate([ids[rows], np.where(dead, -1, near)], 1)
        all_far = np.concatenate([far[rows], d], 1)
        all_todo = np.concatenate([todo[rows], ~dead], 1)
        best = np.argsort(all_far, 1, kind="stable")[:, :beam]
        ids[rows] = np.take_along_axis(all_ids, best, 1)
        far[rows] = np.take_along_axis(all_far, best, 1)
        todo[rows] = np.take_along_axis(all_todo, best, 1)
        rows = rows[todo[rows].any(1)]
    return ids, far, np.array(trail).T if trail else np.full((n, 0), -1)


def robust_prune(x: np.ndarray, points: np.ndarray, cand: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """Up to ``degree`` diverse neighbours of each point from its candidates
    (-1: none), nearest first, padded with -1."""
    cand = np.sort(np.where(cand == points[:, None], -1, cand), 1)
    cand[:, 1:][cand[:, 1:] == cand[:, :-1]] = -1
    v = x[cand]
    d = ((v - x[points][:, None]) ** 2).sum(2)
    d[cand < 0] = np.inf
    order = np.argsort(d, 1, kind="stable")[:, :4 * degree]
    cand, d = np.take_along_axis(cand, order, 1), np.take_along_axis(d, order, 1)
    v = np.take_along_axis(v, order[:, :, None], 1)
    s = (v ** 2).sum(2)
    between = s[:, :, None] + s[:, None, :] - 2 * (v @ v.transpose(0, 2, 1))
    alive = cand >= 0
    kept = np.zeros_like(alive)
    for j in range(cand.shape[1]):
        take = alive[:, j] & (kept.sum(1) < degree)
        kept[:, j] = take
        alive &= ~(take[:, None] & (alpha * alpha * between[:, j] <= d))
    out = np.where(kept, cand, -1)
    first = np.argsort(~kept, 1, kind="stable")[:, :degree]
    out = np.take_along_axis(out, first, 1)
    return np.pad(out, ((0, 0), (0, degree - out.shape[1])), constant_values=-1)


def build(x: np.ndarray, degree: int = DEGREE, beam: int = BUILD_BEAM, alpha: float = ALPHA) -> tuple[np.ndarray, int]:
    """Edges (n x 2*degree, -1: none) and the start node, the one nearest the mean."""
    n, width = len(x), 2 * degree
    sq = (x ** 2).sum(1)
    edges = np.full((n, width), -1)
    start = int(((x - x.mean(0)) ** 2).sum(1).argmin())
    order = np.random.default_rng(SEED).permutation(n)
    order = order[order != start]
    done = 0
    while done < len(order):
        new = order[done:done + min(BATCH, max(1, done))]
        ids, _, trail = beam_search(x, sq, edges, start, x[new], beam)
        out = robust_prune(x, new, np.concatenate([ids, trail], 1), degree, alpha)
        edges[new, :degree] = out
        edges[new, degree:] = -1
        _add_reverse(x, edges, np.repeat(new, degree), out.reshape(-1), degree, alpha)
        done += len(new)
    return edges, start


def _add_reverse(x, edges, source, target, degree, alpha) -> None:
    live = target >= 0
    source, target = source[live], target[live]
    order = np.argsort(target, kind="stable")
    source, target = source[order], target[order]
    nodes, first, count = np.unique(target, return_index=True, return_counts=True)
    width = edges.shape[1]
    held = (edges[nodes] >= 0).sum(1)
    for a in range(0, len(nodes), BATCH):
        own, f, c, h = nodes[a:a + BATCH], first[a:a + BATCH], count[a:a + BATCH], held[a:a + BATCH]
        wide = np.full((len(own), width + int(c.max())), -1)
        wide[:, :width] = np.sort(edges[own], 1)[:, ::-1]     # live edges first
        row = np.repeat(np.arange(len(own)), c)
        nth = np.arange(len(row)) - np.repeat(np.cumsum(c) - c, c)
        wide[row, h[row] + nth] = source[np.repeat(f, c) + nth]
        full = h + c > width
        edges[own[~full]] = wide[~full, :width]
        if full.any():
            edges[own[full], degree:] = -1
            edges[own[full], :degree] = robust_prune(x, own[full], wide[full], degree, alpha)


def search(x: np.ndarray, edges: np.ndarray, start: int, queries: np.ndarray, beam: int = SEARCH_BEAM) -> np.ndarray:
    """The nodes found for each query, nearest first, -1 for none."""
    if len(x) <= beam:
        return np.broadcast_to(np.arange(len(x)), (len(queries), len(x)))
    sq = (x ** 2).sum(1)
    return np.concatenate([beam_search(x, sq, edges, start, queries[a:a + BATCH], beam)[0]
                           for a in range(0, len(queries), BATCH)]) if len(queries) else np.zeros((0, beam), int)
