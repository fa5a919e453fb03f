"""Repeated passages against a dictionary of every window."""

import hashlib
import random
import re

import numpy as np
import pytest

from isoquilt.llm import passages
from tests.llm.helpers import documents, odd_rows


def by_hand(rows, window=20):
    """rows: (doc_id, text), each different one a document."""
    rows = sorted(rows, key=repr)
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    earliest = {}
    for (d, t), w in zip(rows, words):
        for i in range(len(w) - window + 1):
            at = (d is None, d or 0, i)
            key = tuple(w[i : i + window])
            earliest[key] = min(earliest.get(key, at), at)
    out = []
    for (d, t), w in zip(rows, words):
        gone = set()
        for i in range(len(w) - window + 1):
            if (d is None, d or 0, i) > earliest[tuple(w[i : i + window])]:
                gone |= set(range(i, i + window))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((d, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


def corpus(seed, n=120):
    rng = random.Random(seed)
    pool = ["x%d" % i for i in range(12)]
    shared = [[rng.choice(pool) for _ in range(rng.randint(5, 90))] for _ in range(8)]
    rows = []
    for d in range(n):
        words = []
        for _ in range(rng.randint(0, 6)):
            words += rng.choice(shared) if rng.random() < 0.5 else [rng.choice(pool) for _ in range(rng.randint(1, 40))]
            if rng.random() < 0.2:
                words += ["ha"] * rng.randint(1, 60)
        rows.append((d, rng.choice([" ", "\n", "\t "]).join(words)))
    copies = [(n + k, rows[3][1] + " end" * (k % 2)) for k in range(60)]
    return rows + copies


def result(df, **options):
    return sorted((tuple(r) for r in passages.without_repeats(df, **options).collect()), key=repr)


@pytest.mark.parametrize("options", [{}, {"block_words": 50, "block_bytes": 64}, {"gram": 2}, {"gram": 20}])
def test_equal_brute_force(spark, options):
    rows = corpus(4)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    assert result(df, **options) == by_hand(rows)


def test_short_windows(spark):
    rows = corpus(9, 60)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert result(df, window=5, gram=2) == by_hand(rows, 5)


def test_odd_rows(spark):
    rows = odd_rows()
    df = documents(spark, rows)
    distinct = {(d, t) for d, t, _, _ in rows}
    by_id = {r[0]: r for r in by_hand(distinct)}
    assert result(df) == sorted((by_id[d] for d, _, _, _ in rows), key=repr)
    assert passages.without_repeats(df.limit(0)).count() == 0


def test_rows_of_one_id_are_told_apart(spark):
    text = " ".join(f"w{i}" for i in range(30))
    rows = [(1, "lead " + text), (1, text + " tail"), (None, text), (None, "lead " + text), (None, None)]
    got = result(spark.createDataFrame(rows, "doc_id long, text string"))
    # the window at word 0 is earlier than that at word 1 of the same id
    assert sorted(((r[0], r[1], r[2]) for r in got), key=repr) == sorted([(1, 31, 30), (1, 31, 0), (None, 30, 30), (None, 31, 31), (None, 0, 0)], key=repr)


def test_span_hashes_depend_on_the_words_alone():
    draw = np.random.default_rng(2)
    words = draw.integers(0, 1 << 63, 50, dtype=np.uint64)
    both = np.concatenate([words, words[:7], words])
    begin, size = np.array([0, 57, 50, 0, 3]), np.array([20, 20, 7, 7, 20])
    h = passages.span_hashes(both, begin, size)
    assert h[0] == h[1] and h[2] == h[3] and len(set(h.tolist())) == 3
