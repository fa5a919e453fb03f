"""The conversation trie against nodes built from every prefix of every conversation."""

import hashlib
import math
import zlib

import pytest

from isoquilt.llm import trie

SCHEMA = "conv_id long, turn long, role string, text string"


def by_hand(rows):
    found = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()[:32]
            found.setdefault(conv, []).append((turn is not None, turn or 0, digest, role, text))
    found = {c: [(x[3], x[4]) for x in sorted(s)] for c, s in found.items()}
    built = {}
    for c, s in found.items():
        h = zlib.crc32(str(c).encode()) % 9
        built[c] = tuple(found.get(c - int(math.fmod(c, 5)), [])[:h] + s[h:])
    members, children = {}, {}
    for c, s in built.items():
        for d in range(len(s) + 1):
            members.setdefault(s[:d], []).append(c)
    for p in members:
        if p:
            children.setdefault(p[:-1], []).append(p)
    below, out = {}, []
    for p in sorted(members, key=len, reverse=True):
        own = (len(members[p]) - 1) * len(p[-1][1].encode()) if p else 0
        mine = children.get(p, [])
        below[p] = (sum(below[q][0] for q in mine) or 1, own + sum(below[q][1] for q in mine))
    for p, m in members.items():
        ends = ",".join(map(str, sorted(c for c in m if len(built[c]) == len(p))))
        above = min(members[p[:-1]]) if p else None
        out.append((min(m), len(p), above, len(m), len(children.get(p, [])), *below[p], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def rows_of(df):
    return sorted([tuple(r) for r in df.collect()], key=repr)


ODD = [
    (0, None, None, None), (0, 0, "a", "x"), (0, 0, "a", "x"), (1, 0, "a", "é"), (1, 1, None, "x"), (2, 0, "a", "x"),
    (-3, 0, "u", "v"), (None, 0, "a", "x"), (7, 0, "", ""), (7, 1, "u", "long " * 20000),
]
# many equal conversations, many that only share their first turns
MANY = [(c, t, "u", str(t * (c % 3))) for c in range(100, 360) for t in range(c % 7)]
COPIES = [(c, t, "u", f"same {t}") for c in range(1000, 1900) for t in range(3)]


@pytest.mark.parametrize("slices", [1, 23])
def test_nodes_equal_brute_force(spark, slices):
    rows = ODD + MANY + COPIES
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", slices)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        assert rows_of(trie.trie(spark.createDataFrame(rows, SCHEMA))) == by_hand(rows)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_empty_and_clashing_columns(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert trie.trie(empty).count() == 0
    rows = spark.createDataFrame([(1, 0, "a", "b")], SCHEMA)
    clashing = rows.selectExpr("*", "1 AS key", "'x' AS node", "2 AS slice", "3 AS depth", "4 AS `a.b`")
    assert rows_of(trie.trie(clashing)) == by_hand([(1, 0, "a", "b")])


def test_only_turnless_members(spark):
    # conversation 1 takes its first turns from 0, which is absent, and has none left of its own
    rows = [(1, 0, "a", "b")]
    assert zlib.crc32(b"1") % 9 > 0
    assert [r[:2] for r in rows_of(trie.trie(spark.createDataFrame(rows, SCHEMA)))] == [(1, 0)]
    assert by_hand(rows)[0][5] == 1


def test_searches_are_range_minima():
    import numpy as np

    draw = np.random.default_rng(3)
    for n in (1, 2, 7, 40):
        values = draw.integers(0, 4, n)
        table = trie.RangeMinimum(values)
        for at in range(n):
            for least in range(5):
                right = at
                while right + 1 < n and values[right + 1] >= least:
                    right += 1
                left = at
                while left >= 1 and values[left] >= least:
                    left -= 1
                one = np.array([at]), np.array([least])
                assert (table.left(*one)[0], table.right(*one)[0]) == (left, right)
