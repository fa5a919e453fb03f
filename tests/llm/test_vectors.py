"""Both vector searches against brute force."""

import math

import numpy as np
import pytest

from isoquilt.llm import vafile, vptree
from isoquilt.llm.vectors import first_of_equal

NAN, INF = math.nan, math.inf


def _table(spark, n=700, dim=8, hot=200):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=dim).tolist()) for i in range(n)]
    # a very common vector, zero vectors, and vectors that take no part
    rows += [(i, [0.5] * dim) for i in range(n, n + hot)]
    rows += [(n + hot + 50, [0.0] * dim), (n + hot + 51, [1.0] * (dim - 1) + [NAN]), (n + hot + 52, [INF] + [0.0] * (dim - 1))]
    rows += [(n + hot + 53, None), (n + hot + 54, [None] + [1.0] * (dim - 1)), (None, [1.0] * dim), (n + hot + 55, [1.0] * 3)]
    # rows that repeat an id: equal ones are one, others count each
    rows += [(7, rows[7][1]), (7, rows[7][1]), (7, rows[8][1]), (100, rows[9][1]), (100, [0.5] * dim)]
    rows += [(n + hot + 60, []), (n + hot + 61, []), (n + hot + 100, [])]
    rows = [(i, v, 0, 0) for i, v in rows]
    return rows, spark.createDataFrame(rows, "vec_id long, embedding array<float>, shard int, score int")


def _usable(rows, allow_zero):
    out = []
    for i, v, *_ in rows:
        if i is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        v = np.array(v, dtype=np.float32).astype(np.float64)
        if allow_zero or v.any():
            out.append((i, tuple(v.tolist())))
    return sorted(set(out))


def _brute(rows, every, k, allow_zero, score, sign):
    """(query id, rank) -> (id, score) of each query row, those of one id side by side."""
    vectors, out = _usable(rows, allow_zero), {}
    for q, v in vectors:
        if q % every == 0:
            found = [(sign * score(np.array(v), np.array(c)), i) for i, c in vectors if (i, c) != (q, v) and len(c) == len(v)]
            for rank, (s, i) in enumerate(sorted(found)[:k]):
                out.setdefault(q, []).append((rank + 1, i, sign * s))
    return {q: sorted(x) for q, x in out.items()}


def _as_lists(table):
    out = {}
    for r in table.collect():
        out.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    return {q: sorted(x) for q, x in out.items()}


def _distance(a, b):
    return float(np.sqrt(((a - b) ** 2).sum()))


@pytest.mark.parametrize("shard_rows, query_rows", [(4096, 2048), (100, 3)])
def test_factor_one_is_exact(spark, shard_rows, query_rows):
    rows, table = _table(spark)
    got = _as_lists(vptree.nearest(table, factor=1.0, leaf=8, shard_rows=shard_rows, query_rows=query_rows))
    want = _brute(rows, 100, 10, False, _distance, 1)
    assert got.keys() == want.keys()
    for q in want:
        assert [x[:2] for x in got[q]] == [x[:2] for x in want[q]]
        assert [x[2] for x in got[q]] == pytest.approx([x[2] for x in want[q]])


def test_recall_of_the_production_factor(spark):
    """Recall on vectors without any clusters, the hardest case; and on the given table."""
    rng = np.random.default_rng(0)
    points = rng.normal(size=(4096, 64))
    own = np.arange(0, 4096, 100)
    _, found = vptree.Tree(points, np.arange(4096), np.zeros(4096)).nearest(points[own], own, np.zeros(len(own)), 10, vptree.FACTOR)
    far = vptree._distances(points[own], points)
    far[np.arange(len(own)), own] = np.inf
    best = np.argsort(far, axis=1)[:, :10]
    assert sum(len({*a} & {*b}) for a, b in zip(best, found)) / best.size >= 0.9
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    exact, quick = (_as_lists(vptree.nearest(table, factor=f)) for f in (1.0, vptree.FACTOR))
    hits = sum(len({i for _, i, _ in exact[q]} & {i for _, i, _ in quick[q]}) for q in exact)
    assert hits / sum(map(len, exact.values())) >= 0.9


@pytest.mark.parametrize("shard_rows, query_rows", [(4096, 2048), (100, 3)])
def test_top_k_is_exact(spark, shard_rows, query_rows):
    rows, table = _table(spark)

    def score(a, b):
        return sum(math.floor(1024 * x) * math.floor(1024 * y) for x, y in zip(a.tolist(), b.tolist()))

    got = _as_lists(vafile.best(table, shard_rows=shard_rows, query_rows=query_rows))
    assert got == _brute(rows, 100, 10, True, score, -1)


def test_large_components(spark):
    rows = [(i, [1e8 * (i + 1), -3e7 * i]) for i in range(0, 300, 50)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    want = {}
    exact = {i: [math.floor(1024 * x) for x in np.array(v, dtype=np.float32).astype(float).tolist()] for i, v in rows}
    with pytest.raises(Exception):  # noqa: B017  scores beyond 64 bits are an error, not a wrong number
        vafile.best(table).collect()
    small = spark.createDataFrame([(i, [x / 1e5 for x in v]) for i, v in rows], "vec_id long, embedding array<double>")
    exact = {i: [math.floor(1024 * (x / 1e5)) for x in v] for i, v in rows}
    for q in exact:
        if q % 100 == 0:
            found = sorted((-sum(a * b for a, b in zip(exact[q], exact[c])), c) for c in exact if c != q)
            want[q] = [(k + 1, c, -s) for k, (s, c) in enumerate(found[:10])]
    assert _as_lists(vafile.best(small)) == want


def test_empty_and_equal(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert vptree.nearest(empty).count() == 0 and vafile.best(empty).count() == 0
    ids = np.arange(50)[::-1]
    for width in (2, 0):
        assert ids[first_of_equal(np.ones((50, width)), ids, 11)].tolist() == list(range(11))


def test_every_row_of_an_id_is_searched(spark):
    rows = [(0, [1.0, 0.0]), (1, [0.0, 1.0]), (1, [1.0, 0.0]), (2, [0.5, 0.5])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert _as_lists(vptree.nearest(table))[0][0] == (1, 1, 0.0)
    assert _as_lists(vafile.best(table))[0] == [(1, 1, 1048576), (2, 2, 524288), (3, 1, 0)]
    nothing = spark.createDataFrame([(0, []), (1, []), (200, [1.0])], "vec_id long, embedding array<float>")
    assert _as_lists(vafile.best(nothing)) == {0: [(1, 1, 0)]} and vptree.nearest(nothing).count() == 0


def test_bounds_hold_for_terms_that_cancel():
    draw = np.random.default_rng(5)
    values = np.floor(draw.normal(size=(400, 16)) * 2.0**24)
    values[:, 8:] = -values[:, :8] + np.floor(draw.normal(size=(400, 8)))
    queries = np.concatenate([values[:20, :8], values[:20, :8]], axis=1)
    bounds = vafile.Approximation(values, 200).bounds(queries)
    for q, b in zip(queries.tolist(), bounds):
        for v, top in zip(values.tolist(), b.tolist()):
            assert sum(int(x) * int(y) for x, y in zip(q, v)) <= top
