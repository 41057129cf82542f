"""A directed neighbour graph with robust pruning, searched by beams.

The graph of one shard: every point has at most ``degree`` out-edges. A point
searches the graph for its own neighbours, keeps the nearest, drops every
candidate that a kept one is nearer to by the factor ``alpha``, and so on:
with ``alpha`` above 1 some longer edges survive, which lets a beam cross
between clusters. All searches and prunings run for a block of points at
once on arrays.
"""

from __future__ import annotations

import numpy as np

_FAR = np.inf


def lifted(vectors: np.ndarray) -> np.ndarray:
    """One more dimension that gives all vectors the same length: the nearest
    point to a query (lifted by 0) then has the largest inner product."""
    norms = np.einsum("ij,ij->i", vectors, vectors)
    return np.column_stack([vectors, np.sqrt(np.maximum(norms.max(initial=0.0) - norms, 0.0))])


def _distances(points: np.ndarray, norms: np.ndarray, targets: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Squared distances of each target to its row of points (up to the target's own norm)."""
    return norms[ids] - 2 * np.matmul(points[ids], targets[:, :, None])[:, :, 0]


def beam_search(
    points: np.ndarray, norms: np.ndarray, edges: np.ndarray, entry: int, targets: np.ndarray, beam: int, step: int = 4
) -> tuple[np.ndarray, np.ndarray]:
    """Per target the ``beam`` nearest points found (index, distance), nearest
    first; -1 where fewer were found. ``edges`` is padded with -1."""
    n, q = len(points), len(targets)
    if n <= beam:  # the beam holds the whole shard
        every = np.tile(np.arange(n), (q, 1))
        near = _distances(points, norms, targets, every)
        order = np.argsort(near, axis=1, kind="stable")
        return np.take_along_axis(every, order, axis=1), np.take_along_axis(near, order, axis=1)
    ids = np.full((q, beam), -1)
    dist = np.full((q, beam), _FAR)
    ids[:, 0] = entry
    dist[:, 0] = _distances(points, norms, targets, ids[:, :1])[:, 0]
    done = np.ones((q, beam), dtype=bool)
    done[:, 0] = False
    seen = np.zeros((q, n + 1), dtype=bool)  # the last column takes the padding
    seen[:, entry] = seen[:, n] = True
    live = np.arange(q)
    while len(live):
        # the nearest points of the beam that were not expanded yet
        waiting = np.where(done[live], _FAR, dist[live])
        pick = np.argsort(waiting, axis=1, kind="stable")[:, :step]
        at = np.arange(len(live))[:, None]
        usable = np.isfinite(waiting[at, pick])
        done[live[:, None], pick] = True
        grown = np.where(usable[:, :, None], edges[np.where(usable, ids[live[:, None], pick], 0)], -1).reshape(len(live), -1)
        grown = np.where(grown < 0, n, grown)
        grown.sort(axis=1)
        fresh = ~seen[live[:, None], grown]
        fresh[:, 1:] &= grown[:, 1:] != grown[:, :-1]
        seen[live[:, None], grown] = True
        safe = np.where(fresh, grown, 0)
        near = np.where(fresh, _distances(points, norms, targets[live], safe), _FAR)
        all_ids = np.concatenate([ids[live], np.where(fresh, grown, -1)], axis=1)
        all_dist = np.concatenate([dist[live], near], axis=1)
        all_done = np.concatenate([done[live], ~fresh], axis=1)
        keep = np.argsort(all_dist, axis=1, kind="stable")[:, :beam]
        ids[live], dist[live], done[live] = all_ids[at, keep], all_dist[at, keep], all_done[at, keep]
        live = live[(~done[live] & np.isfinite(dist[live])).any(axis=1)]
    return ids, dist


def robust_prune(points: np.ndarray, own: np.ndarray, candidates: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """Out-edges of the points ``own`` (padded with -1) among their candidates
    (padded with -1; repeats and the point itself allowed)."""
    candidates = np.sort(np.where(candidates == own[:, None], -1, candidates), axis=1)
    repeat = np.zeros_like(candidates, dtype=bool)
    repeat[:, 1:] = candidates[:, 1:] == candidates[:, :-1]
    gone = repeat | (candidates < 0)
    spots = points[np.where(gone, 0, candidates)]
    offset = spots - points[own][:, None, :]
    to_own = np.where(gone, _FAR, np.einsum("qcd,qcd->qc", offset, offset))
    norms = np.einsum("qcd,qcd->qc", spots, spots)
    edges = np.full((len(own), degree), -1)
    rows = np.arange(len(own))
    factor = alpha * alpha  # distances are squared
    for k in range(degree):
        best = to_own.argmin(axis=1)
        open_rows = np.isfinite(to_own[rows, best])
        if not open_rows.any():
            break
        edges[:, k] = np.where(open_rows, candidates[rows, best], -1)
        kept = spots[rows, best]
        between = norms + norms[rows, best][:, None] - 2 * np.matmul(spots, kept[:, :, None])[:, :, 0]
        to_own[factor * np.maximum(between, 0.0) <= to_own] = _FAR
        to_own[rows, best] = _FAR
    return edges


def _add_reverse(points: np.ndarray, edges: np.ndarray, own: np.ndarray, alpha: float) -> None:
    """An edge back from every out-neighbour of ``own``; full lists are pruned."""
    degree = edges.shape[1]
    to = edges[own].reshape(-1)
    back = np.repeat(own, degree)[to >= 0]
    to = to[to >= 0]
    order = np.argsort(to, kind="stable")
    to, back = to[order], back[order]
    heads, first, held = np.unique(to, return_index=True, return_counts=True)
    extra = np.full((len(heads), held.max(initial=0)), -1)
    extra[np.repeat(np.arange(len(heads)), held), np.arange(len(to)) - np.repeat(first, held)] = back
    for a in range(0, len(heads), 512):
        part = slice(a, a + 512)
        # all candidates stay where they fit; the rest go by distance
        edges[heads[part]] = _fit(points, heads[part], np.concatenate([edges[heads[part]], extra[part]], axis=1), degree, alpha)


def _fit(points: np.ndarray, own: np.ndarray, candidates: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    ordered = -np.sort(-candidates, axis=1)
    ordered[:, 1:][ordered[:, 1:] == ordered[:, :-1]] = -1
    ordered = -np.sort(-ordered, axis=1)
    out = ordered[:, :degree].copy()
    if ordered.shape[1] < degree:
        out = np.pad(out, ((0, 0), (0, degree - ordered.shape[1])), constant_values=-1)
    full = (ordered >= 0).sum(axis=1) > degree
    if full.any():
        out[full] = robust_prune(points, own[full], ordered[full], degree, alpha)
    return out


def build_graph(points: np.ndarray, degree: int, beam: int, alpha: float, seed: int, block: int = 256) -> tuple[np.ndarray, int]:
    """Edges (points x degree, padded with -1) and the entry point."""
    n = len(points)
    rng = np.random.default_rng(seed)
    centre = points.mean(axis=0)
    entry = int(np.einsum("ij,ij->i", points - centre, points - centre).argmin())
    if n <= degree + 1:
        every = np.tile(np.arange(n), (n, 1))
        others = every[~np.eye(n, dtype=bool)].reshape(n, n - 1)
        return np.pad(others, ((0, 0), (0, degree - n + 1)), constant_values=-1), entry
    norms = np.einsum("ij,ij->i", points, points)
    edges = rng.integers(0, n, size=(n, degree))
    for relax in (1.0, alpha):
        order = rng.permutation(n)
        for a in range(0, n, block):
            own = order[a : a + block]
            found, _ = beam_search(points, norms, edges, entry, points[own], beam)
            edges[own] = robust_prune(points, own, np.concatenate([found, edges[own]], axis=1), degree, relax)
            _add_reverse(points, edges, own, relax)
    return edges, entry
