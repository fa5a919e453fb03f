"""Streams with keyed state against the same work done in sequence, over restarts."""

import random

import pandas as pd
from pyspark.sql import functions as F

from isoquilt.config import BarcodeConfig
from isoquilt.functions.kmer_numbers import Index
from isoquilt.operators import barcode
from isoquilt.streaming import adaptive

CFG = BarcodeConfig(batch=10)


def _bars(rng, n=12):
    return ["".join(rng.choice("ACGT") for _ in range(16)) for _ in range(n)]


def _reads(rng, bars, first, n):
    out = []
    for k in range(first, first + n):
        lead = "".join(rng.choice("ACGT") for _ in range(rng.randint(14, 26)))
        out.append((f"r{k:05d}", lead + rng.choice(bars) + "ACGTACGTACTTTCTTATATGG"))
    return out


def _sequential(batches, bars, lanes):
    """The matcher as one loop over a lane's texts, with the state carried in variables."""
    import numpy as np

    index, names = Index(bars, CFG.k), np.array(bars, dtype=object)
    state, out = {k: (0, 0.0, 0.0) for k in range(lanes)}, []
    for batch in batches:
        for lane in range(lanes):
            texts = pd.DataFrame(sorted((r, s) for r, s, x in batch if x == lane), columns=["read_name", "seq"])
            for at in range(0, len(texts), CFG.batch):
                n, s, q = state[lane]
                mu, sigma = adaptive.prior(n, s, q, CFG)
                found = adaptive.match_texts(texts.iloc[at : at + CFG.batch].reset_index(drop=True), index, names, mu, sigma, CFG)
                out += [(lane, r.read_name, r.barcode, r.start, r.edit, n, mu, sigma) for r in found.itertuples()]
                state[lane] = (n + len(found), s + found["start"].sum(), q + (found["start"] ** 2).sum())
    return sorted(out)


def test_restarted_stream_equals_one_sequence(spark, tmp_path):
    rng = random.Random(2)
    bars, lanes, src, batches = sorted(_bars(rng)), 3, str(tmp_path / "in"), []
    whitelist = spark.createDataFrame([(b,) for b in bars], "barcode string")
    for part in range(4):
        rows = spark.createDataFrame(_reads(rng, bars, 100 * part, 70), "read_name string, seq string").coalesce(1)
        rows.write.mode("append").parquet(src)
        lane = F.pmod(F.xxhash64("read_name"), F.lit(lanes)).cast("int")
        batches.append([tuple(r) for r in rows.select("read_name", "seq", lane).collect()])
        if part % 2:
            # each run goes on from the state that the one before has committed
            stream = spark.readStream.schema("read_name string, seq string").option("maxFilesPerTrigger", 1).parquet(src)
            adaptive.match_stream(stream, whitelist, str(tmp_path / "out"), str(tmp_path / "ck"), CFG, lanes).awaitTermination(300)
    got = sorted(tuple(r) for r in spark.read.parquet(str(tmp_path / "out/matches")).collect())
    want = _sequential(batches, bars, lanes)
    assert [g[:6] for g in got] == [w[:6] for w in want] and len(got) > 250
    assert max(abs(g[k] - w[k]) for g, w in zip(got, want) for k in (6, 7)) < 1e-9
    assert {g[5] for g in got if g[0] == 0} != {0}


def test_matches_in_tasks_equal_the_batch_matcher(spark):
    rng = random.Random(5)
    bars = sorted(_bars(rng, 30))
    reads = _reads(rng, bars, 0, 80) + [("short", "ACGT"), ("twice", "AC" * 30), ("r00001", "TTTT" * 15)]
    df = spark.createDataFrame(reads, "read_name string, seq string")
    want = barcode.best_match(df, spark.createDataFrame([(b,) for b in bars], "barcode string"), 20.0, 4.0, CFG)
    found = adaptive.match_texts(pd.DataFrame(reads, columns=["read_name", "seq"]), Index(bars, CFG.k), pd.Series(bars).to_numpy(), 20.0, 4.0, CFG)
    assert sorted(map(tuple, found.itertuples(index=False))) == sorted(tuple(r) for r in want.collect())


def test_stream_priors_equal_the_batch_ones(spark, tmp_path):
    rng = random.Random(9)
    src = str(tmp_path / "values")
    rows = [(lane, k, rng.gauss(20, 3)) for k in range(230) for lane in (0, 1)]
    schema = "lane int, place long, value double"
    for part in range(3):
        mine = [r for r in rows if r[1] // 80 == part]
        spark.createDataFrame(mine, schema).coalesce(1).write.mode("append").parquet(src)
        stream = spark.readStream.schema(schema).parquet(src)
        adaptive.prior_stream(stream, str(tmp_path / "priors"), str(tmp_path / "ck"), CFG).awaitTermination(300)
    got = {(r.lane, r.n): (r.mu, r.sigma) for r in spark.read.parquet(str(tmp_path / "priors")).collect()}
    for lane in (0, 1):
        values = spark.createDataFrame([r for r in rows if r[0] == lane], schema)
        for r in adaptive.learnt_priors(values, ["place"], "value", CFG).collect():
            mu, sigma = got[lane, r.n]
            assert abs(mu - r.mu) < 1e-9 and abs(sigma - r.sigma) < 1e-6
    assert len(got) == 46


def test_letters_mean_the_same_on_both_routes(spark):
    """R, - and lower case are letters of their own, whatever the whitelist's size."""
    bars = ["ACGTRCGTACGTACGT", "ACGTNCGTACGTACGT", "acgtacgtACGTACGT", "AC-TACGTTTGGACCA", "ACGTACGTACGTACGT"]
    reads = [(f"r{k}", "TT" + b + "GG") for k, b in enumerate(bars)] + [("x", "ACGTYCGTACGTACGTAC"), ("z", "--------RRRRRRRRRR")]
    df = spark.createDataFrame(reads, "read_name string, seq string")
    names = spark.createDataFrame([(b,) for b in bars], "barcode string")
    found = [
        sorted((r.read_name, r.barcode, round(r.cos, 9)) for r in barcode.cosine_pairs(df, names, CFG, limit).collect())
        for limit in (50_000, 2)
    ]
    assert found[0] == found[1] and len(found[0]) > 5
