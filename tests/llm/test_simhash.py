"""Fingerprints and components against brute force."""

import collections
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from isoquilt.llm import simhash
from .helpers import documents, odd_rows, words


def _fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    found = re.findall(r"[^\x20\x09-\x0D]+", low)
    shingles = [" ".join(found[i : i + 3]) for i in range(len(found) - 2)] or ([" ".join(found)] if found else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def _components(prints, radius):
    parent = list(range(len(prints)))

    def root(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i][1] ^ prints[j][1]).bit_count() <= radius:
                parent[root(i)] = root(j)
    groups = collections.defaultdict(list)
    for i, (doc_id, _) in enumerate(prints):
        groups[root(i)].append(doc_id)
    named = {g: min((d for d in ids if d is not None), default=None) for g, ids in groups.items()}
    return {doc_id: named[root(i)] for i, (doc_id, _) in enumerate(prints)}


@pytest.mark.parametrize("dense", [simhash.DENSE, 2])
def test_against_brute_force(spark, dense):
    rng = random.Random(4)
    rows = odd_rows()
    for k in range(8):
        base = words(50 + k, 120).split()
        for i in range(12):
            copy = list(base)
            copy[rng.randrange(len(copy))] = "changed"
            rows.append((100 + 20 * k + i, " ".join(copy), "en", "s"))
    got = simhash.near_duplicates(documents(spark, rows), dense=dense).collect()
    prints = [(d, _fingerprint(t)) for d, t, *_ in rows]
    assert sorted((str(r.doc_id), r.fingerprint) for r in got) == sorted((str(d), f"{f:016x}") for d, f in prints)
    want = _components(prints, 3)
    assert {r.doc_id: r.component_id for r in got} == want
    assert len(set(want.values())) < len(want)


def test_no_pair_within_the_radius_is_missed():
    rng = np.random.default_rng(1)
    masks = np.array(simhash.covering_masks(list(range(64)), 3), dtype=np.int64).view(np.uint64)
    for _ in range(2000):
        change = sum(1 << int(b) for b in rng.choice(64, 3, replace=False))
        assert any(int(m) & change == 0 for m in masks)
    assert len(masks) == 15 and all(int(m).bit_count() > 25 for m in masks)


def test_empty_table_and_kept_rows(spark):
    empty = documents(spark, []) if False else spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(empty).count() == 0
    docs = documents(spark, odd_rows())
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    ids = sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect())
    # of 1, 2, 2 one stays, of the texts without words one stays
    assert (False, 1) in ids and (False, 2) not in ids and (False, 3) in ids and (False, 4) not in ids
    assert (True, 0) in ids


def test_spark_has_the_same_hash(spark):
    text = "the quick brown fox jumps over the lazy dog"
    made = spark.range(1).select(F.xxhash64(F.lit(text)).alias("h")).first()["h"]
    assert made % (1 << 64) == xxhash.xxh64_intdigest(text.encode(), seed=42)
