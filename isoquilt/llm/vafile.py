"""Exact top-k by inner product with vector-approximation files.

Each component of a vector is turned into the integer ``floor(1024 x)``.  A shard keeps for each
vector the cell of every component, ``CELLS`` equal cells between the component's smallest
and largest value.  From a query and the cells' borders follows the largest score the vector can
have.  Exact vectors are read in the order of these bounds, and reading stops when the k-th
score found is above the next bound: no vector that was not read can be among the k best.

Defined results: vectors that are null or hold null or non-finite components take no part, nor
do rows without an id; equal scores go to the smaller id; rows equal in id and vector are one, rows that share
only the id are all candidates and, where the id asks, all queries; vectors of different length do not meet; a vector
without components meets others like it, at score 0; an empty table gives an empty result; only vec_id and embedding are
read, so other columns cannot clash.
"""

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isoquilt.llm.vectors import QUERY_ROWS, first_of_equal, search

K = 10
SCALE = 1024.0
CELLS = 16
#: Exact vectors read at a time.
READ = 64
#: Up to this magnitude products are summed in 64 bits without overflow.
SAFE = 1 << 26


class Approximation:
    """Cells of a shard's integer vectors."""

    def __init__(self, values: np.ndarray, cells: int = CELLS):
        low, high = values.min(axis=0), values.max(axis=0)
        width = np.maximum(1.0, np.ceil((high - low + 1) / cells))
        self.low, self.width = low, width
        self.code = ((values - low) // width).astype(np.uint8)

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """Largest score that any vector of a cell can have with each query."""
        floor = self.low + self.code * self.width
        ceiling = floor + self.width - 1
        bound = np.maximum(queries, 0) @ ceiling.T + np.minimum(queries, 0) @ floor.T
        # a sum of doubles may be off by a few last digits of the terms' magnitudes for each of its terms
        terms = np.abs(queries) @ np.maximum(np.abs(ceiling), np.abs(floor)).T
        return bound + terms * (queries.shape[1] + 4) * 2.0**-52


def _best(values, ids, bound, query, mine, k):
    """Best scores and ids; ``mine`` marks the query's own row."""
    order = np.argsort(-bound, kind="stable")
    scores, found = np.empty(0, dtype=values.dtype), np.empty(0, dtype=np.int64)
    for at in range(0, len(order), READ):
        if len(scores) == k and scores[-1] > bound[order[at]]:
            break
        rows = order[at : at + READ]
        rows = rows[~mine[rows]]
        scores = np.concatenate([scores, (values[rows] * query).sum(axis=1)])
        found = np.concatenate([found, ids[rows]])
        keep = sorted(range(len(found)), key=lambda i: (-scores[i], found[i]))[:k]
        scores, found = scores[keep], found[keep]
    return scores, found


def best(
    vectors: DataFrame,
    every: int = 100,
    k: int = K,
    cells: int = CELLS,
    shard_rows: int | None = None,
    query_rows: int = QUERY_ROWS,
) -> DataFrame:
    """(query_id, rank, vec_id, score): queries are the rows whose id is divisible by ``every``."""

    def index(points, ids, names):
        points = np.floor(SCALE * points)
        kept = first_of_equal(points, ids, k + 1)
        points, ids, names = points[kept], ids[kept], names[kept]
        cells_of = Approximation(points, cells) if points.shape[1] else None
        most = np.abs(points).max(initial=0)

        def find(queries, own, own_names):
            asked = np.floor(SCALE * queries)
            bounds = cells_of.bounds(asked) if cells_of else np.zeros((len(asked), len(ids)))
            large = max(most, np.abs(asked).max(initial=0)) >= SAFE
            exact = (lambda x: np.vectorize(int, otypes=[object])(x)) if large else (lambda x: x.astype(np.int64))
            values, asked = exact(points), exact(asked)
            query, found, score = [], [], []
            for i in range(len(asked)):
                mine = (ids == own[i]) & (names == own_names[i])
                scores, near = _best(values, ids, bounds[i], asked[i], mine, k)
                query += [i] * len(near)
                found += near.tolist()
                score += scores.tolist()
            return query, found, score

        return find

    asked = F.col("vec_id") % every == 0
    return search(vectors, asked, k, "long", F.col("score").desc(), index, True, shard_rows, query_rows)
