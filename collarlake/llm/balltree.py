"""Exact top-k by inner product with a ball tree per shard.

A node of the tree holds a ball around its points; no point in it has an inner product with
q above q . center + |q| radius. A query visits nodes in order of that bound and stops when
the bound falls below its k-th score so far. Each query first searches one shard of the cell
whose pivot suits it best; the k-th score found there goes along to the other shards of
those cells whose own balls can still reach it, and prunes there from the start.

Scores are integers and exact: they are computed in doubles where those hold all sums, and
in unbounded integers otherwise. Bounds are rounded up.
"""

from __future__ import annotations

import heapq

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from collarlake.llm.tables import Saved
from collarlake.llm.vectors import (
    best,
    first_cells,
    questions,
    reaching_cells,
    results,
    routed,
    searched,
    sharded,
    usable,
)

PER_SHARD = 16_384
LEAF = 128
EXACT = 2.0**53
SLACK = 1e-9


class BallTree:
    """Balls over integer points: children halve a ball across its widest direction."""

    def __init__(self, ids: np.ndarray, points: np.ndarray) -> None:
        order = np.arange(len(points))
        self.center, self.radius, self.children, self.span = [], [], [], []
        self._grow(points, order, 0, len(order))
        self.ids, self.points = ids[order], points[order]
        self.center, self.radius = np.array(self.center), np.array(self.radius)
        self.largest = float(np.abs(points).max())

    def _grow(self, points: np.ndarray, order: np.ndarray, begin: int, end: int) -> int:
        own = points[order[begin:end]]
        center = own.mean(axis=0)
        away = np.sqrt(((own - center) ** 2).sum(axis=1))
        node = len(self.span)
        self.center.append(center)
        self.radius.append(float(away.max()) * (1 + SLACK) + SLACK)
        self.span.append((begin, end))
        self.children.append(())
        if end - begin > LEAF and away.max() > 0:
            one = own[away.argmax()]
            two = own[((own - one) ** 2).sum(axis=1).argmax()]
            along = own @ (two - one)
            half = (end - begin) // 2
            order[begin:end] = order[begin:end][np.argpartition(along, half)]
            self.children[node] = (
                self._grow(points, order, begin, begin + half),
                self._grow(points, order, begin + half, end),
            )
        return node

    def search(self, q: np.ndarray, own: int, k: int, floor: float) -> tuple:
        """Ids and scores of the k best but ``own``, of those that reach ``floor``; ties to
        smaller ids."""
        exact = self.largest * float(np.abs(q).max()) * len(q) < EXACT
        bounds = self.center @ q + float(np.sqrt(q @ q)) * self.radius
        bounds += SLACK * (1 + np.abs(bounds)) + (0 if exact else np.abs(bounds) * 1e-6)
        ids, scores = np.zeros(0, np.int64), np.zeros(0, np.float64 if exact else object)
        least = floor
        waiting = [(-bounds[0], 0)]
        while waiting:
            bound, node = heapq.heappop(waiting)
            if -bound < least:
                break
            if self.children[node]:
                for child in self.children[node]:
                    if bounds[child] >= least:
                        heapq.heappush(waiting, (-bounds[child], child))
                continue
            begin, end = self.span[node]
            if exact:
                value = self.points[begin:end] @ q
            else:
                whole = self.points[begin:end].astype(object)
                value = np.array([sum(int(a) * int(b) for a, b in zip(p, q, strict=True)) for p in whole], object)
            near = (value >= least) & (self.ids[begin:end] != own)
            if near.any():
                ids = np.concatenate([ids, self.ids[begin:end][near]])
                scores = np.concatenate([scores, value[near]])
                order = np.lexsort((ids, -scores))[:k]
                ids, scores = ids[order], scores[order]
                if len(ids) == k:
                    least = max(least, scores[-1])
        return ids, scores


def _whole(x: np.ndarray) -> np.ndarray:
    return np.floor(256.0 * x)


def _search(k: int):
    def run(tree: BallTree, ids: np.ndarray, x: np.ndarray, floors: list) -> tuple:
        found, scores = [], []
        for own, q, floor in zip(ids.tolist(), x, floors, strict=True):
            near, value = tree.search(q, own, k, -np.inf if floor is None else floor)
            found.append(near.tolist())
            scores.append([int(v) for v in value])
        return found, scores

    return run


def top_k(vectors: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """(query_id, rank, vec_id, score): for each query its k highest inner products with the
    rows of ``vectors`` of another id; all, if fewer.

    Both have (vec_id, embedding). Components x count as floor(256 x). Rows without an id,
    or whose vector is null, empty, or has a component that is null or not finite, take no
    part. Vectors of different lengths do not meet. Repeated rows count as often as they
    come; queries that share an id are one. Scores must fit 64 bits. Ties go to the smaller
    id.
    """
    saved = Saved(vectors.sparkSession, "ball-tree")
    shards, cells, spaces = sharded(usable(vectors), PER_SHARD, k, BallTree, saved, _whole)
    search = _search(k)
    asked = routed(questions(usable(queries)), first_cells(lambda space: 1), spaces, _whole)
    first = saved.write(searched(asked, shards, cells, search, "long", saved, home=True), "first")
    floor = F.when(F.size("score") == k, F.array_min("score")).alias("floor")
    asked = routed(
        first.select("dim", "query_id", "x", "home", floor), reaching_cells(cells, spaces), spaces
    )
    rest = searched(asked, shards, cells, search, "long", saved, home=False)
    return best(results(first).unionByName(results(rest)), k)
