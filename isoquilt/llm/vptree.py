"""Approximate nearest neighbours by a vantage-point tree in each shard.

A node splits its points at the median distance from a vantage point and keeps the smallest and
largest distance on either side.  By the triangle inequality a side whose distances lie
outside ``d - r .. d + r`` holds nothing nearer than ``r``; a side is left out when ``factor``
times the least possible distance exceeds the k-th distance found so far.  A factor of
one is exact, a larger one leaves out more.  Queries walk a tree together, each
its nearer side first.

Defined results: vectors that are null, zero, or hold null or non-finite components take no
part; nor do rows without an id, nor vectors without components, which count as zero; equal distances go to the smaller
id; rows equal in id and vector are one, rows that share only the id are all candidates and, where the id asks, all
queries; vectors of different length do not meet; an empty table gives an empty result; only vec_id
and embedding are read, so other columns cannot clash.
"""

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isoquilt.llm.vectors import QUERY_ROWS, first_of_equal, search

K = 10
LEAF = 64
#: Recall at this factor is measured in the tests and listed in the README.
FACTOR = 2.0


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances of every row of ``a`` to every row of ``b`` in double precision."""
    out = np.empty((len(a), len(b)))
    for i in range(0, len(a), 64):
        out[i : i + 64] = ((a[i : i + 64, None, :] - b[None, :, :]) ** 2).sum(axis=2)
    return np.sqrt(out)


class Tree:
    def __init__(self, points: np.ndarray, ids: np.ndarray, names: np.ndarray, leaf: int = LEAF):
        self.points, self.ids, self.names, self.leaf = points, ids, names, leaf
        self.root = self._node(np.arange(len(points)))

    def _node(self, rows: np.ndarray):
        if len(rows) <= self.leaf:
            return rows
        # the point farthest from the middle: the first of them, so that a retry builds the same tree
        middle = self.points[rows].mean(axis=0)
        vantage = self.points[rows[np.argmax(((self.points[rows] - middle) ** 2).sum(axis=1))]]
        far = _distances(vantage[None], self.points[rows])[0]
        order = np.argsort(far, kind="stable")
        half = len(rows) // 2
        sides = []
        for part in (order[:half], order[half:]):
            sides.append((far[part[0]], far[part[-1]], self._node(rows[part])))
        return vantage, sides

    def nearest(
        self, queries: np.ndarray, own: np.ndarray, own_names: np.ndarray, k: int, factor: float
    ) -> tuple[np.ndarray, np.ndarray]:
        """(distances, ids) of the k nearest found of each query; a missing one is at infinity."""
        self.best = np.full((len(queries), k), np.inf)
        self.found = np.full((len(queries), k), np.iinfo(np.int64).max)
        self.factor, self.own, self.own_names = factor, own, own_names
        self._visit(self.root, queries, np.arange(len(queries)))
        return self.best, self.found

    def _visit(self, node, queries: np.ndarray, who: np.ndarray) -> None:
        if not len(who):
            return
        if not isinstance(node, tuple):
            self._look(node, queries, who)
            return
        vantage, sides = node
        far = _distances(queries[who], vantage[None])[:, 0]
        least = [np.maximum(0.0, np.maximum(low - far, far - high)) for low, high, _ in sides]
        inner_first = least[0] <= least[1]
        for turn in (True, False):
            for side in (0, 1):
                mine = inner_first == (side == 0) if turn else inner_first == (side == 1)
                mine &= self.factor * least[side] <= self.best[who, -1]
                self._visit(sides[side][2], queries, who[mine])

    def _look(self, rows: np.ndarray, queries: np.ndarray, who: np.ndarray) -> None:
        far = _distances(queries[who], self.points[rows])
        mine = self.own[who][:, None] == self.ids[rows][None, :]
        far[mine & (self.own_names[who][:, None] == self.names[rows][None, :])] = np.inf
        better = (far <= self.best[who, -1:]).any(axis=1)
        who, far = who[better], far[better]
        far = np.hstack([self.best[who], far])
        ids = np.hstack([self.found[who], np.broadcast_to(self.ids[rows], (len(who), len(rows)))])
        ids = np.where(np.isinf(far), np.iinfo(np.int64).max, ids)
        order = np.lexsort((ids, far), axis=1)[:, : self.best.shape[1]]
        self.best[who] = np.take_along_axis(far, order, axis=1)
        self.found[who] = np.take_along_axis(ids, order, axis=1)


def nearest(
    vectors: DataFrame,
    every: int = 100,
    k: int = K,
    factor: float = FACTOR,
    leaf: int = LEAF,
    shard_rows: int | None = None,
    query_rows: int = QUERY_ROWS,
) -> DataFrame:
    """(query_id, rank, vec_id, score): queries are the rows whose id is divisible by ``every``."""

    def index(points, ids, names):
        kept = first_of_equal(points, ids, k + 1)
        tree = Tree(points[kept], ids[kept], names[kept], leaf)

        def find(queries, own, own_names):
            far, found = tree.nearest(queries, own, own_names, k, factor)
            real = ~np.isinf(far)
            return np.nonzero(real)[0], found[real], far[real]

        return find

    asked = F.col("vec_id") % every == 0
    return search(vectors, asked, k, "double", F.col("score").asc(), index, False, shard_rows, query_rows)
