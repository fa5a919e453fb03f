"""Targets, quotas and what is taken."""

import collections
import random
import re

import pytest
from pyspark.sql import functions as F

from isoquilt.llm import mixing
from isoquilt.llm.common import word_count
from .helpers import documents, odd_rows, words


def _targets(sizes, share=1.5):
    names = sorted(sizes, key=lambda n: (n is None, n))
    weight = {n: (5, 2, 1)[i % 3] for i, n in enumerate(names)}
    total, capped = share * sum(sizes.values()), set()
    while True:
        left = total - sum(2 * sizes[n] for n in capped)
        weights = sum(weight[n] for n in names if n not in capped)
        open_ = {n: left * weight[n] / weights for n in names if n not in capped}
        over = {n for n in open_ if open_[n] > 2 * sizes[n]}
        if not over:
            return {**{n: 2.0 * sizes[n] for n in capped}, **open_}
        capped |= over


def test_seats_go_to_the_highest_quotients(spark):
    rng = random.Random(0)
    rows = []
    for g in range(25):
        seats = rng.randint(0, 60)
        rows += [(g, i, rng.choice([0.0, rng.random() ** 4 * 100]), seats) for i in range(rng.randint(1, 12))]
    made = mixing.apportion(spark.createDataFrame(rows, "g int, i int, w double, s int"), "g", "i", "w", "s", "q").collect()
    got = {(r.g, r.i): r.q for r in made}
    for g in range(25):
        own = [r for r in rows if r[0] == g]
        quotients = sorted((-w / (2 * k + 1), i) for _, i, w, s in own for k in range(s) if w > 0)[: own[0][3]]
        won = collections.Counter(i for _, i in quotients)
        assert all(got[(g, i)] == won[i] for _, i, _, _ in own)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    sources = ["a"] * 60 + ["b"] * 20 + ["c"] * 10 + ["é"] * 5 + [None] * 5
    made = [(100 + i, words(i, rng.randint(1, 400)), "en", rng.choice(sources)) for i in range(300)]
    return odd_rows() + made


@pytest.mark.parametrize("shard_words", [mixing.SHARD_WORDS, 3000])
def test_report(spark, rows, shard_words):
    docs = documents(spark, rows)
    sized = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"))
    got = mixing.mix(sized, shard_words=shard_words).collect()
    again = mixing.mix(sized.repartition(5), shard_words=shard_words).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    counts = collections.Counter((d, len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))) for d, t, *_ in rows)
    assert collections.Counter((r["doc_id"], r["size"]) for r in got) == counts
    sizes = collections.Counter()
    for _, text, _, source in rows:
        sizes[source] += len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    want = _targets(sizes)
    taken = collections.Counter()
    for r in got:
        assert 0 <= r["taken"] <= 2 * r["size"] and r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(want[r["source"]])
        taken[r["source"]] += r["taken"]
    for source, target in want.items():
        shards = -(-sizes[source] // shard_words)
        assert abs(taken[source] - target) <= mixing.BLOCK_WORDS * (1 + shards)


def test_mixed_rows_hold_what_was_taken(spark, rows):
    docs = documents(spark, rows)
    made = mixing.mixed(docs)
    assert made.columns == docs.columns
    got = collections.Counter()
    for r in made.collect():
        assert r["n_chars"] == len(r["text"])
        got[r["doc_id"]] += len(r["text"].split())
    want = collections.Counter()
    for r in mixing.mix_report(docs).collect():
        want[r["doc_id"]] += r["taken"]
    # the odd row with a no-break space is one word here
    assert {d: n for d, n in got.items() if d != 9} == {d: n for d, n in want.items() if n and d != 9}


def test_empty_tables(spark):
    empty = documents(spark, odd_rows()).limit(0)
    assert mixing.mix_report(empty).count() == 0 and mixing.mixed(empty).count() == 0
    blank = spark.createDataFrame([(1, None, "a"), (2, " ", "b")], "doc_id long, text string, source string")
    assert [r["taken"] for r in mixing.mix_report(blank).collect()] == [0, 0]


def test_rows_without_an_id_spread_over_shards(spark):
    rows = [(None, words(i, 40), "en", "a") for i in range(300)]
    made = mixing.mixed(documents(spark, rows)).collect()
    texts = {t for _, t, _, _ in rows}
    assert sum(len(r["text"].split()) for r in made) == pytest.approx(1.5 * 300 * 40, abs=mixing.BLOCK_WORDS)
    assert all(any(t.find(r["text"]) >= 0 for t in texts) for r in made[:20])
    sized = documents(spark, rows).select("doc_id", "source", F.lit(40).alias("size"), F.xxhash64("text").alias("text_hash"))
    plans = mixing.mix(sized, shard_words=400).select("taken").collect()
    # every shard's run cuts a text at both ends; a single shard would cut two
    assert len(plans) == 300 and sum(r["taken"] % 40 > 0 for r in plans) > 10
    assert sum(r["taken"] for r in plans) == pytest.approx(18000, abs=16 * 31)
