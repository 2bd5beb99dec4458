"""Approximate nearest neighbours on a robustly pruned directed graph per shard.

Points are inserted in rounds. A beam search from the point nearest to the mean proposes
neighbours for each new point; robust pruning keeps the nearest, drops those that are
nearer to it than to the new point by the factor RELAXED, and goes on with the rest, so the
kept edges are short and diverse. Edges get their reverse, and a point with too many is
pruned again. The same beam search answers queries; many of them step at once.

Inner products become distances by one more component that gives all points of a shard
equal length. Equal vectors are one point of the graph, with a list of ids. What the search
finds is scored exactly on the original vectors.

A query goes to the cells of the pivots with the highest inner products, to as many as hold
nearly all neighbours of sampled vectors.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from collarlake.llm.tables import Saved
from collarlake.llm.vectors import best, first_cells, questions, results, routed, searched, sharded, usable

PER_SHARD = 4096
DEGREE = 32
SLOTS = 48  # edges that a point may gather before it is pruned to DEGREE
BUILD_BEAM = 64
SEARCH_BEAM = 96
RELAXED = 1.2
STEP = 4  # points of a beam that are expanded at once
ROUND = 256


def beam_search(points, edges, start, asked, width) -> tuple[np.ndarray, np.ndarray]:
    """Per row of ``asked`` the places and squared distances of the ``width`` nearest points
    met on a walk that always expands the nearest points not expanded yet; -1 for none."""
    n = len(asked)
    own = (asked**2).sum(axis=1)
    norms = (points**2).sum(axis=1)
    place = np.full((n, width), -1, np.int64)
    far = np.full((n, width), np.inf, points.dtype)
    done = np.zeros((n, width), bool)
    seen = np.zeros((n, len(points)), bool)
    place[:, 0], seen[:, start] = start, True
    far[:, 0] = norms[start] - 2 * (asked @ points[start]) + own
    live = np.arange(n)
    while len(live):
        open_far = np.where(done[live], np.inf, far[live])
        pick = np.argsort(open_far, axis=1)[:, :STEP]
        fresh = np.isfinite(np.take_along_axis(open_far, pick, axis=1))
        more = fresh[:, 0]
        live, pick, fresh = live[more], pick[more], fresh[more]
        if not len(live):
            break
        done[live[:, None], pick] = True
        next_ = edges[np.where(fresh, place[live[:, None], pick], 0)]
        next_ = np.where(fresh[:, :, None], next_, -1).reshape(len(live), -1)
        # Points that several of the expanded ones lead to count once.
        next_.sort(axis=1)
        next_[:, 1:][next_[:, 1:] == next_[:, :-1]] = -1
        new = (next_ >= 0) & ~seen[live[:, None], np.maximum(next_, 0)]
        row, column = np.nonzero(new)
        met = next_[row, column]
        seen[live[row], met] = True
        value = np.full(next_.shape, np.inf, points.dtype)
        value[row, column] = (
            norms[met] - 2 * np.einsum("ij,ij->i", points[met], asked[live[row]]) + own[live[row]]
        )
        all_far = np.concatenate([far[live], value], axis=1)
        all_place = np.concatenate([place[live], np.where(new, next_, -1)], axis=1)
        all_done = np.concatenate([done[live], np.zeros(next_.shape, bool)], axis=1)
        order = np.argpartition(all_far, width - 1, axis=1)[:, :width]
        far[live] = np.take_along_axis(all_far, order, axis=1)
        place[live] = np.take_along_axis(all_place, order, axis=1)
        done[live] = np.take_along_axis(all_done, order, axis=1)
    order = np.argsort(far, axis=1, kind="stable")
    return np.take_along_axis(place, order, axis=1), np.take_along_axis(far, order, axis=1)


def pruned(points: np.ndarray, at: int, near: np.ndarray) -> np.ndarray:
    """Of the places ``near``, the diverse neighbours of the point at ``at``."""
    near = np.unique(near[(near >= 0) & (near != at)])
    own = points[near]
    away = ((own - points[at]) ** 2).sum(axis=1)
    order = np.argsort(away, kind="stable")
    near, own, away = near[order], own[order], away[order]
    norms = (own**2).sum(axis=1)
    between = norms[:, None] + norms[None, :] - 2 * (own @ own.T)
    hidden = RELAXED**2 * between <= away[None, :]
    alive = np.ones(len(near), bool)
    kept = []
    for i in range(len(near)):
        if alive[i]:
            kept.append(i)
            if len(kept) == DEGREE:
                break
            alive &= ~hidden[i]
    return near[kept]


class Graph:
    def __init__(self, ids: np.ndarray, x: np.ndarray) -> None:
        self.x, first, which = np.unique(x, axis=0, return_index=True, return_inverse=True)
        del first
        order = np.argsort(which.ravel(), kind="stable")  # ids come sorted
        self.ids = ids[order]
        self.bounds = np.searchsorted(which.ravel()[order], np.arange(len(self.x) + 1))
        lengths = (self.x**2).sum(axis=1)
        rest = np.sqrt(np.maximum(lengths.max() - lengths, 0))
        scale = 1.0 / np.sqrt(lengths.max())
        self.points = np.column_stack([self.x, rest]).astype(np.float64) * scale
        self.points = self.points.astype(np.float32)
        center = self.points.mean(axis=0)
        self.start = int(((self.points - center) ** 2).sum(axis=1).argmin())
        self._build()

    def _build(self) -> None:
        points, n = self.points, len(self.points)
        self.edges = np.full((n, SLOTS), -1, np.int32)
        used = np.zeros(n, np.int64)
        # A fixed shuffle: the given order may follow the data's clusters.
        todo = np.random.default_rng(8).permutation(n)
        todo = todo[todo != self.start]
        inside = 1
        while len(todo):
            batch, todo = np.split(todo, [min(len(todo), max(1, inside // 4), ROUND)])
            near, _ = beam_search(points, self.edges, self.start, points[batch], BUILD_BEAM)
            for at, found in zip(batch.tolist(), near, strict=True):
                # New points of this round are proposed to each other as well.
                kept = pruned(points, at, np.concatenate([found, batch]) if inside < 4 * ROUND else found)
                self.edges[at, : len(kept)] = kept
                used[at] = len(kept)
            for at in batch.tolist():
                for to in self.edges[at, : used[at]].tolist():
                    if at in self.edges[to, : used[to]]:
                        continue
                    if used[to] == SLOTS:
                        kept = pruned(points, to, np.append(self.edges[to], at))
                        self.edges[to] = -1
                        self.edges[to, : len(kept)] = kept
                        used[to] = len(kept)
                    else:
                        self.edges[to, used[to]] = at
                        used[to] += 1
            inside += len(batch)

    def search(self, x: np.ndarray, width: int) -> np.ndarray:
        length = np.sqrt((x**2).sum(axis=1, keepdims=True))
        asked = np.column_stack([x / length, np.zeros(len(x))]).astype(np.float32)
        return beam_search(self.points, self.edges, self.start, asked, min(width, len(self.x)))[0]


def _search(k: int, beam: int):
    def run(graph: Graph, ids: np.ndarray, x: np.ndarray, floors: list) -> tuple:
        found, scores = [], []
        for begin in range(0, len(ids), ROUND):
            part = slice(begin, begin + ROUND)
            near = graph.search(x[part], max(beam, k + 1))
            for own, q, places in zip(ids[part].tolist(), x[part], near, strict=True):
                places = places[places >= 0]
                value = (graph.x[places] * q).sum(axis=1)
                order = np.argsort(-value, kind="stable")[: k + 1]
                names, values = [], []
                for place, score in zip(places[order], value[order], strict=True):
                    # Ids of equal vectors are sorted; k and the query's own are enough.
                    first = graph.bounds[place]
                    same = graph.ids[first : min(graph.bounds[place + 1], first + k + 1)]
                    names.append(same[same != own])
                    values.append(np.full(len(names[-1]), score))
                name, value = np.concatenate(names), np.concatenate(values)
                order = np.lexsort((name, -value))[:k]
                found.append(name[order].tolist())
                scores.append(value[order].tolist())
        return found, scores

    return run


def nearest(
    vectors: DataFrame, queries: DataFrame, k: int, beam: int = SEARCH_BEAM
) -> DataFrame:
    """(query_id, rank, vec_id, score): about the k highest inner products per query with the
    rows of ``vectors`` of another id; all that are found, if fewer.

    Both have (vec_id, embedding). Rows without an id, or whose vector is null, empty, zero,
    or has a component that is null or not finite, take no part. Vectors of different
    lengths do not meet. A repeated row counts as often as it comes, up to k + 1 times in a
    shard, which is more than can be among the results; queries that share an id are one.
    Scores are exact; a wider beam finds more of the true neighbours.
    """
    saved = Saved(vectors.sparkSession, "graph")
    shards, cells, spaces = sharded(usable(vectors, nonzero=True), PER_SHARD, k, Graph, saved)
    asked = routed(
        questions(usable(queries, nonzero=True)), first_cells(lambda space: space.probes), spaces
    )
    found = searched(asked, shards, cells, _search(k, beam), "double", saved)
    return best(results(found), k)
