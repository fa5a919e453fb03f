"""The pipeline's near copies against brute force."""

import random

import numpy as np
from pyspark.sql import functions as F

from isoquilt.llm import near_copies, simhash
from .helpers import documents, words


def _set(text):
    found = (text or "").split()
    return {tuple(found[i : i + 5]) for i in range(max(1, len(found) - 4))} if found else set()


def _kept(rows):
    """The first row of each component, by id and null last; ids and texts differ here."""
    sets, group = [_set(r[1]) for r in rows], list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            union = len(sets[i] | sets[j])
            if not union or len(sets[i] & sets[j]) >= 0.8 * union:
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    first = {}
    for g, r in sorted(zip(group, rows), key=lambda x: (x[1][0] is None, x[1][0] or 0)):
        first.setdefault(g, r)
    return sorted(map(str, ((r[0], r[1]) for r in first.values())))


def _changed(rng, base, places):
    copy = base.split()
    for at in rng.sample(range(len(copy)), places):
        copy[at] = f"changed{rng.randrange(10**9)}"
    return " ".join(copy)


def test_against_brute_force(spark):
    rng = random.Random(6)
    rows, at = [(1, None, "en", "s"), (2, " ", "en", "s"), (3, "One", "en", "s"), (4, "one", "en", "s")], 100
    rows[3:] = [(4, "Two", "en", "s")]
    for k in range(12):
        base = words(50 + k, 200)
        for places in (0, 1, 2, 3, 4, 5, 8, 20):
            rows.append((at := at + 1, _changed(rng, base, places), "en", "s"))
    got = simhash.one_of_each(documents(spark, rows)).collect()
    assert sorted(map(str, ((r.doc_id, r.text) for r in got))) == _kept(rows)


def test_rows_that_share_an_id_or_have_none(spark):
    """What decides is the row: each text of its own stays, copies without an id go."""
    own = [words(200 + i, 60) for i in range(6)]
    rows = [(7, own[0], "en", "a"), (7, own[1], "en", "a"), (7, own[1], "en", "a"), (8, own[1], "en", "a"), (9, own[2], "en", "a")]
    rows += [(None, own[2], "en", "a"), (None, own[3], "en", "a"), (None, own[3], "en", "a"), (None, own[4], "en", "a")]
    got = simhash.one_of_each(documents(spark, rows)).collect()
    want = [(7, own[0]), (7, own[1]), (9, own[2]), (None, own[3]), (None, own[4])]
    assert sorted(map(str, ((r.doc_id, r.text) for r in got))) == sorted(map(str, want))


def test_candidates_hold_similar_pairs():
    rng = random.Random(8)
    met = total = 0
    for k in range(300):
        base = words(1000 + k, 200)
        a, b = (near_copies.shingle_set(t) for t in (base, _changed(rng, base, rng.randint(1, 4))))
        if len(np.intersect1d(a, b)) >= 0.8 * len(np.union1d(a, b)):
            total, met = total + 1, met + bool((near_copies.band_keys(a) == near_copies.band_keys(b)).any())
    assert total > 200 and met >= 0.99 * total, (met, total)
    print(met, total)


def test_bits_never_rule_out_similar_sets(spark):
    """What the bits rule out is below the similarity."""
    rng = random.Random(12)
    rows = []
    for k in range(200):
        base = words(3000 + k % 20, 60 + 10 * (k % 7))
        a, b = (near_copies.shingle_set(t) for t in (base, _changed(rng, base, rng.randint(0, 9))))
        alike = len(np.intersect1d(a, b)) >= 0.8 * len(np.union1d(a, b))
        sides = [(len(x), near_copies.parity_bits(x).tolist()) for x in (a, b)]
        rows.append((*sides, alike))
    side = "struct<n: int, bits: array<long>>"
    df = spark.createDataFrame(rows, f"a {side}, b {side}, alike boolean")
    told = df.select(near_copies._may_be_alike("a", "b", 0.8).alias("may"), "alike").collect()
    assert all(r.may for r in told if r.alike) and sum(not r.may for r in told) > 20


def test_bucket_of_thousands_of_sets(spark):
    """One large group of short near copies, many of them below the similarity: all links, few rows."""
    rng = random.Random(31)
    base = words(77, 40)
    rows = [(k, _changed(rng, base, rng.choice([1, 1, 1, 2, 3])), "en", "s") for k in range(5000)]
    got = near_copies.groups(spark.createDataFrame([(d, t) for d, t, _, _ in rows], "doc_id long, text string"))
    named = {r.doc_id: r.component for r in got.collect()}
    sets = [_set(r[1]) for r in rows]
    # brute force over pairs that share half of their shingles or more, by an inverted index
    group = list(range(len(rows)))

    def find(x):
        while group[x] != x:
            group[x] = group[group[x]]
            x = group[x]
        return x

    numbers = {}
    coded = [np.array(sorted(numbers.setdefault(x, len(numbers)) for x in s)) for s in sets]
    wide = np.zeros((len(rows), 36), dtype=bool)
    shared = {numbers[x]: k for k, x in enumerate(_set(base)) if x in numbers}
    for i, s in enumerate(coded):
        wide[i, [shared[x] for x in s.tolist() if x in shared]] = True
    sizes = np.array([len(s) for s in coded])
    counts = wide.astype(np.int16) @ wide.T.astype(np.int16)
    for i in range(len(rows)):
        for j in np.flatnonzero(counts[i, :i] >= 0.8 * (sizes[i] + sizes[:i] - counts[i, :i])).tolist():
            group[find(i)] = find(j)
    of = {}
    for d in range(len(rows)):
        of.setdefault(find(d), set()).add(named[d])
    # a pair at the similarity is a candidate with probability 0.9999; here every component is found
    assert len(of) == len(set(named.values())) and all(len(x) == 1 for x in of.values())


def test_fingerprints_of_the_stage(spark):
    """The stage takes fingerprints of five words, and all within three bits are joined, equal ones too."""
    rng = random.Random(41)
    texts = [None, " ", "One two", *[words(5000 + k, 120) for k in range(5)]]
    rows = near_copies._sketches(near_copies._named(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")), 5)
    got = {r.doc_id: r.fp for r in rows.select("doc_id", "fp").collect()}
    assert all(got[k] % (1 << 64) == simhash.simhash(t, 5) for k, t in enumerate(texts))

    prints = []
    for _ in range(40):
        base = rng.randrange(1 << 64)
        prints += [base, base] + [base ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 5))) for _ in range(4)]
    sets = [(k, int(np.uint64(p).astype(np.int64))) for k, p in enumerate(prints)]
    pairs = near_copies.print_pairs(spark.createDataFrame(sets, "s long, fp long")).collect()
    groups = []
    for near in ([(x, y) for x, _ in sets for y in range(x) if (prints[x] ^ prints[y]).bit_count() <= 3], [tuple(p) for p in pairs]):
        group = list(range(len(sets)))
        for x, y in near:
            group = [group[x] if g == group[y] else g for g in group]
        groups.append({frozenset(k for k in range(len(sets)) if group[k] == g) for g in group})
    assert groups[0] == groups[1] and all(p.x < p.y for p in pairs)


def test_links_by_fingerprints_alone(spark, monkeypatch):
    """Near copies that share no key are joined by their fingerprints."""
    plain = near_copies._sketches
    monkeypatch.setattr(near_copies, "_sketches", lambda *a: plain(*a).withColumn("keys", F.array(F.col("s"))))
    base = words(91, 2000)
    texts = [(1, base), (2, base + " more"), (3, words(92, 2000))]
    made = [simhash.simhash(t, 5) for _, t in texts]
    assert (made[0] ^ made[1]).bit_count() <= 3
    got = near_copies.one_of_each(spark.createDataFrame(texts, "doc_id long, text string")).collect()
    assert sorted(r.doc_id for r in got) == [1, 3]
