"""Search of every query vector in every shard of candidates, each shard's index built once.

Candidates are dealt into shards of bounded bytes by a hash of their id and vector; a query goes to every shard.
Rows are sorted so that a shard's candidates come before its queries: a task builds the index of a shard, then
streams the queries through it a batch at a time, so its memory does not grow with the table.  A window takes the best of
what the shards give.  Shuffled rows are the candidates once, and each query once a shard.
"""

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

#: Bytes of one shard's vectors as doubles.
SHARD_BYTES = 8 << 20
#: Queries that are searched together.
QUERY_ROWS = 2048


def usable(vectors: DataFrame, allow_zero: bool) -> DataFrame:
    """(vec_id, v, name): vectors whose components are all finite numbers; ``name`` is a hash of the vector.

    Rows that are equal in id and vector are one; rows that share an id only are all kept.  Rows without an id
    take no part.
    """
    v = F.col("embedding").cast("array<double>")
    finite = F.forall("v", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    kept = vectors.select("vec_id", v.alias("v")).where(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & finite)
    if not allow_zero:
        kept = kept.where(F.exists("v", lambda x: x != 0.0))
    return kept.distinct().withColumn("name", F.xxhash64("v"))


def first_of_equal(vectors: np.ndarray, ids: np.ndarray, most: int) -> np.ndarray:
    """The rows, by id, that have less than ``most`` equal vectors of smaller ids before them.

    The others could never be among the nearest ``most - 1``, as ties go to the smaller id.
    """
    order = np.argsort(ids, kind="stable")
    group = np.zeros(len(ids), dtype=np.int64)
    if vectors.shape[1]:
        whole = np.ascontiguousarray(vectors[order] + 0.0).view([("", vectors.dtype)] * vectors.shape[1]).ravel()
        group = np.unique(whole, return_inverse=True)[1]
    by_group = np.argsort(group, kind="stable")
    begins = np.concatenate(([0], np.cumsum(np.bincount(group))[:-1]))
    rank = np.empty(len(ids), dtype=np.int64)
    rank[by_group] = np.arange(len(ids)) - begins[group[by_group]]
    return order[rank < most]


def _matrix(rows: pd.DataFrame) -> np.ndarray:
    return np.array(rows["v"].tolist(), dtype=np.float64).reshape(len(rows), -1)


def search(
    vectors: DataFrame,
    is_query: Column,
    k: int,
    score_type: str,
    best_first: Column,
    index: Callable,
    allow_zero: bool,
    shard_rows: int | None = None,
    query_rows: int = QUERY_ROWS,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the best ``k`` candidates of each query.

    ``index(points, ids, names)`` makes a shard's index, a function of (queries, ids, names) that gives arrays of query
    number, candidate id and score with the best ``k`` of the shard.  Vectors meet only those of as many components.
    """
    seen = vectors.agg(F.count("*").alias("n"), F.max(F.size("embedding")).alias("d")).first()
    rows = shard_rows or max(1, SHARD_BYTES // (8 * max(1, seen["d"] or 0)))
    shards = max(1, -(-seen["n"] // rows))
    clean = usable(vectors, allow_zero)
    own = F.pmod(F.xxhash64("vec_id", "name"), F.lit(shards))
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long")))
    candidates = clean.select(F.size("v").alias("d"), own.alias("shard"), F.lit(0).alias("asks"), "vec_id", "name", "v")
    asked = clean.where(is_query).select(F.size("v").alias("d"), every.alias("shard"), F.lit(1).alias("asks"), "vec_id", "name", "v")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shard, held, find = None, [], None
        for frame in frames:
            change = np.flatnonzero((frame[["d", "shard", "asks"]].diff() != 0).any(axis=1).to_numpy())
            for begin, end in zip(change, [*change[1:], len(frame)]):
                part = frame.iloc[begin:end]
                if (here := (part["d"].iloc[0], part["shard"].iloc[0])) != shard:
                    shard, held, find = here, [], None
                if not part["asks"].iloc[0]:
                    held.append(part)
                    continue
                if held and find is None:
                    points = pd.concat(held)
                    find, held = index(_matrix(points), points["vec_id"].to_numpy(), points["name"].to_numpy()), []
                for at in range(0, len(part) if find else 0, query_rows):
                    some = part.iloc[at : at + query_rows]
                    ids, names = some["vec_id"].to_numpy(), some["name"].to_numpy()
                    number, found, score = find(_matrix(some), ids, names)
                    number = np.asarray(number, dtype=np.int64)
                    yield pd.DataFrame({"query_id": ids[number], "name": names[number], "vec_id": found, "score": score})

    keys = ["d", "shard"]
    dealt = candidates.unionByName(asked).repartition(*keys).sortWithinPartitions(*keys, "asks")
    found = dealt.mapInPandas(run, f"query_id long, name long, vec_id long, score {score_type}")
    rank = F.row_number().over(W.partitionBy("query_id", "name").orderBy(best_first, "vec_id"))
    return found.select("query_id", rank.alias("rank"), "vec_id", "score").where(F.col("rank") <= k)
