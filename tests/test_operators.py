"""Operator tests: both routes of size-checked operators agree; brute force on small data."""

import math
import random
from dataclasses import replace

import numpy as np
import pytest
import pyarrow as pa
from pyspark.sql import functions as F

from isoquilt.config import UmiConfig
from isoquilt.functions import communities, stats
from isoquilt.operators import barcode, graph, legacy, psi, sizes, umi
from isoquilt.session import codes, ordinal, running_totals


def _noisy_nodes(spark, molecules=60, cells=2):
    rng = random.Random(2)
    rows = []
    for c in range(cells):
        for _ in range(molecules):
            text = "".join(rng.choice("ACGT") for _ in range(12))
            for _ in range(rng.randint(1, 4)):
                s = list(text)
                for _ in range(rng.randint(0, 3)):
                    s[rng.randrange(12)] = rng.choice("ACGT")
                iso = rng.choice(["1000,1200|1400,1500", "1003,1200|1400,1500", "1000,1200|1600,1800"])
                rows.append(("g", f"c{c}", iso, "".join(s), rng.randint(1, 3), 0))
    df = spark.createDataFrame(rows, "gene string, cell string, isoform string, umi string, n bigint, n_polya bigint")
    df = df.groupBy("gene", "cell", "isoform", "umi").agg(F.sum("n").alias("n"), F.sum("n_polya").alias("n_polya"))
    return df.withColumn("id", F.xxhash64("gene", "cell", "isoform", "umi"))


def test_large_groups_find_the_same_edges(spark):
    nodes = _noisy_nodes(spark).cache()
    small = umi.similar_edges(nodes, UmiConfig(pair_bound=10_000))
    large = umi.similar_edges(nodes, UmiConfig(pair_bound=0))
    cols = ["gene", "cell", "a", "b", "score", "capacity", "ns"]
    a, b = (sorted(map(tuple, e.select(*cols).collect())) for e in (small, large))
    assert a == b and len(a) > 50


def test_groups_are_solved_alike_in_tasks_and_by_joins(spark):
    nodes = _noisy_nodes(spark).cache()
    edges = umi.similar_edges(nodes, texts=True).cache()
    share = {(r.a, r.b): r.share for r in graph.shared_neighbours(edges, umi.KEYS).collect()}
    named = {(r.a, r.b): (r.umi_a, r.iso_a, r.umi_b, r.iso_b, r.ns) for r in edges.collect()}
    component = {r.id: r.component for r in graph.connected_components(edges, umi.KEYS).collect()}
    cluster = {r.id: r.cluster for r in graph.cluster_graphs(edges, umi.KEYS, 3, 7, 20_000).collect()}
    assert max(share.values()) > 1 and len(set(component.values())) > 4
    # one group is larger than the second bound
    sizes = sorted(r["count"] for r in nodes.groupBy(*umi.KEYS).count().collect())
    for bound in (10_000, sizes[-1] - 1):
        cfg = UmiConfig(pair_bound=bound)
        found = umi.shared_edges(nodes, cfg, itself=True).collect()
        assert {(r.a, r.b): r.share for r in found if r.a != r.b} == share
        assert {(r.a, r.b): (r.umi_a, r.iso_a, r.umi_b, r.iso_b, r.ns) for r in found} == named
        assert all(r.share is None for r in found if r.a == r.b)
        assert {r.id: r.component for r in umi.node_components(nodes, cfg).collect()} == component
        assert {r.id: r.cluster for r in umi.cluster(nodes, cfg).collect() if r.id in cluster} == cluster


def test_groups_of_several_batches_stay_whole():
    tables = [pa.table({"k": k, "v": list(range(len(k)))}) for k in (["a"], ["a", "a", "b"], [], ["b"], ["b", "c", "d"], ["d"])]
    whole = [(t.column("k").to_pylist(), b.tolist()) for t, b in graph.whole_groups(tables[:2] + tables[3:], ["k"])]
    assert whole == [(["a"] * 3, [0, 3]), (["b"] * 3 + ["c"], [0, 3, 4]), (["d"] * 2, [0, 2])]


def test_components_of_both_routes(spark):
    chain = [("g", i, i + 1) for i in range(60)] + [("g", 100, 101), ("h", 5, 6)]
    edges = spark.createDataFrame(chain, "k string, a bigint, b bigint")
    for c in ("na", "nb", "ns", "capacity"):
        edges = edges.withColumn(c, F.lit(1).cast("bigint"))
    far = {(r.k, r.id): r.component for r in graph.connected_components(edges, ["k"]).collect()}
    near = {(r.k, r.id): r.cluster for r in graph.cluster_graphs(edges, ["k"], 1 << 60, 0, 10_000).collect()}
    forced = {(r.k, r.id): r.cluster for r in graph.cluster_graphs(edges, ["k"], 1 << 60, 0, 5).collect()}
    assert far == near == forced
    assert far[("g", 60)] == 0 and far[("h", 6)] == 5


def _random_graphs(rng, graphs=2):
    """Graphs with dense blocks and a few edges between them, as (k, a, b, na, nb, ns, capacity)."""
    rows = []
    for g in range(graphs):
        n = rng.randint(9, 16)
        ids = rng.sample(range(-500, 500), n)
        reads, block = {v: rng.randint(1, 4) for v in ids}, {v: rng.randint(0, 2) for v in ids}
        for i, a in enumerate(ids):
            if reads[a] > 1 and rng.random() < 0.5:
                pairs = reads[a] * (reads[a] - 1) // 2
                rows.append((f"g{g}", a, a, reads[a], reads[a], 12 * pairs, pairs))
            for b in ids[i + 1 :]:
                if rng.random() < (0.8 if block[a] == block[b] else 0.1):
                    lo, hi = min(a, b), max(a, b)
                    pairs = reads[lo] * reads[hi]
                    rows.append((f"g{g}", lo, hi, reads[lo], reads[hi], rng.randint(5, 12) * pairs, pairs))
    return rows


def test_every_graph_size_follows_one_rule(spark):
    """Solved in tasks, by joins, or partly both: the labels are the same."""
    def clique(lo, n):
        return [("c", i, j, 1, 1, 10, 1) for i in range(lo, lo + n) for j in range(i + 1, lo + n)]

    rows = _random_graphs(random.Random(12)) + clique(0, 7) + clique(20, 7) + [("c", 0, 20, 1, 1, 5, 1)]
    edges = spark.createDataFrame(rows, "k string, a bigint, b bigint, na bigint, nb bigint, ns bigint, capacity bigint").cache()
    found = [
        {(r.k, r.id): r.cluster for r in graph.cluster_graphs(edges, ["k"], 3, 10, bound).collect()} for bound in (1 << 40, 50, 5)
    ]
    assert found[0] == found[1] == found[2]
    assert {c for (k, _), c in found[0].items() if k == "c"} == {0, 20}
    assert len({c for (k, _), c in found[0].items() if k != "c"}) > 3


def test_ties_follow_sparks_hash(spark):
    pairs = [(v, c) for v in (0, 5, -7, 2**62, -(2**63)) for c in (1, -3, 2**61)]
    made = spark.createDataFrame(pairs, "v bigint, c bigint").select("v", "c", F.xxhash64("v", "c").alias("h")).collect()
    assert all(communities.tie(r.v, r.c) == r.h for r in made)


def test_a_long_whitelist_goes_in_parts_without_a_join(spark):
    """No row is made for a posting: reads meet the parts of the list where they are."""
    rng = random.Random(4)
    bars = sorted({"".join(rng.choice("ACGT") for _ in range(16)) for _ in range(400)} | {"ACGTRCGTACGTACGT", "ACGT"})
    reads = [(f"r{i}", "".join(rng.choice("ACGT") for _ in range(20)) + rng.choice(bars)) for i in range(200)]
    wl = spark.createDataFrame([(b,) for b in bars], "barcode string")
    texts = spark.createDataFrame(reads, "read_name string, seq string")
    pairs = barcode.cosine_pairs(texts, wl, broadcast_limit=100)
    assert "Join" not in pairs._jdf.queryExecution().executedPlan().toString()
    got = {(r.read_name, r.barcode): r.cos for r in pairs.collect()}
    whole = {(r.read_name, r.barcode): r.cos for r in barcode.cosine_pairs(texts, wl).collect()}
    joined = {(r.read_name, r.barcode): r.cos for r in barcode._pairs_by_join(texts, wl, barcode.BarcodeConfig()).collect()}
    assert got == whole and len(got) >= 200
    assert got.keys() == joined.keys() and all(abs(got[k] - joined[k]) < 1e-9 for k in got)


def test_barcode_join_matches_full_scan(spark):
    rng = random.Random(9)
    bars = ["".join(rng.choice("ACGT") for _ in range(16)) for _ in range(60)]
    reads = []
    for i in range(80):
        b = list(rng.choice(bars))
        b[rng.randrange(16)] = rng.choice("ACGT")
        reads.append((f"r{i}", "".join(rng.choice("ACGT") for _ in range(20)) + "".join(b) + "ACGTACGTAC"))
    # every read holds the same adapter; two barcodes hold a part of it
    adapter = "CTACACGACGCTCTTCCGATCT"
    bars += [adapter[2:18], adapter[4:20]]
    reads = [(n, adapter + t) for n, t in reads] + [("short", "ACGTAC"), ("odd", "NNNN" + bars[0] + "XACGT"), ("r0", adapter + reads[0][1])]
    wl = spark.createDataFrame([(b,) for b in bars], "barcode string")
    texts = spark.createDataFrame(reads, "read_name string, seq string")
    got, joined = (
        {(r.read_name, r.barcode): r.cos for r in barcode.cosine_pairs(texts, wl, broadcast_limit=limit).collect()}
        for limit in (barcode.BROADCAST_BARCODES, 0)
    )
    assert got == joined

    def grams(s):
        return {s[i : i + 8] for i in range(len(s) - 7)}

    known = set().union(*map(grams, bars))
    want = {}
    for name, text in reads:
        a = grams(text) & known
        for b in bars:
            g = grams(b)
            if a and len(a & g) / (math.sqrt(len(a)) * math.sqrt(len(g))) >= 0.25:
                want[(name, b)] = len(a & g) / (math.sqrt(len(a)) * math.sqrt(len(g)))
    assert got.keys() == want.keys()
    for key, value in want.items():
        assert got[key] == pytest.approx(value)


def _votes_brute(size, ratio, alpha):
    """The filter as a walk over every single molecule."""
    size = np.array(size, dtype=float)
    if len(size) == 1 or size.max() == 1:
        return np.zeros(len(size))
    up = np.sort(size)
    for i in range(len(up)):
        part = up[i:]
        n, m = len(part), part.mean()
        v = stats.mean2var(m)
        if n == 1 or v <= 0:
            break
        df = stats.variance_df(m, v, n)
        if not np.isfinite(df) or df <= 0 or part.var(ddof=1) <= stats.chi2_quantile(1 - alpha / 2, np.array([df]))[0] * v / df:
            break
    kept = np.sort(part)[::-1]
    lefts = []
    found = None
    for k in range(1, int((kept > 1).sum()) + 1):
        left = kept[:k].sum() * ratio / (1 - ratio)
        lefts.append(left)
        if found is None and left >= kept[k:].sum():
            found = k
    vote = np.zeros(len(size))
    if found is None:
        if (size == 1).any():
            vote[size == 1] = max(lefts) / (size == 1).sum()
        return vote
    bar = np.sort(size)[::-1][found - 1]
    vote[size < bar] = 1
    vote[size == bar] = ((size >= bar).sum() - found) / (size == bar).sum()
    return vote


def test_noise_votes_match_brute_force(spark):
    rng = np.random.default_rng(4)
    groups = {f"g{i}": np.maximum(1, rng.geometric(rng.uniform(0.1, 0.9), rng.integers(1, 25))) for i in range(20)}
    groups["big"] = np.concatenate([np.ones(60, dtype=int), rng.integers(5, 60, 12)])
    rows = [(g, int(s)) for g, sizes_ in groups.items() for s in sizes_]
    df = spark.createDataFrame(rows, "g string, size bigint")
    for ratio in (0.05, 0.3):
        got = {(r.g, r.size): r.vote for r in sizes.noise_votes(df, ["g"], ratio, 0.05).collect()}
        for g, s in groups.items():
            for value, vote in zip(s, _votes_brute(s, ratio, 0.05)):
                assert got[(g, int(value))] == pytest.approx(vote), (g, value, ratio)


def test_error_count_fixture(spark):
    df = spark.createDataFrame([("g", s) for s in (10, 8, 1, 1)], "g string, size bigint")
    left = [10 * 0.2 / 0.8, 18 * 0.2 / 0.8]
    want = 1 if left[0] >= 10 else 2 if left[1] >= 2 else None
    assert sizes.count_by_error(df, ["g"], 0.2).first()["molecules"] == want == 2


def test_psi_fixture(spark):
    rows = [("g", "c1", "1|3", 2.0, 1.0), ("g", "c2", "2", 1.0, 0.0)]
    df = spark.createDataFrame(rows, "gene string, cell string, exons string, count double, polyA double")
    table = {(r.exons, r.exon): r.state for r in psi.exon_table(df).collect()}
    assert [table[("1|3", e)] for e in (1, 2, 3)] == [1, 0, 1]
    assert [table[("2", e)] for e in (1, 2, 3)] == [None, 1, None]
    counts = spark.createDataFrame([("g", "a", "1", 9.0, 5.0), ("g", "b", "1", 10.0, 5.0)], "gene string, cell string, exon string, den double, num double")
    assert [tuple(r) for r in psi.psi(counts).collect()] == [("g", "b", "1", 0.5)]
    values = spark.createDataFrame([("g", "1", "a", 0.2), ("g", "1", "b", 0.8)], "gene string, exon string, cell string, psi double")
    assert psi.phi(values, 2).first()["phi"] == pytest.approx(0.72)


def test_ordinals_and_running_totals(spark):
    df = spark.range(1000).select((F.col("id") * 7 % 1000).alias("x"))
    got = ordinal(df, ["x"], "n").where("n <> x + 1").count()
    assert got == 0
    run = running_totals(df, ["x"], {"total": "x"}).where("total <> x * (x + 1) / 2").count()
    assert run == 0
    names = {r.c: r.code for r in codes(spark.createDataFrame([("b",), ("a",), ("b",)], "c string"), "c", "code").collect()}
    assert names == {"a": 1, "b": 2}


def test_noisy_reads_keep_their_barcodes(spark):
    rng = random.Random(1)
    bars = ["".join(rng.choice("ACGT") for _ in range(16)) for _ in range(20)]
    rows = []
    for i in range(120):
        letters = list(rng.choice(bars))
        truth = "".join(letters)
        for _ in range(rng.randint(0, 2)):
            letters[rng.randrange(16)] = rng.choice("ACGT")
        flank = "".join(rng.choice("ACGT") for _ in range(18 + rng.randint(0, 4)))
        tail = "".join(rng.choice("ACGT") for _ in range(17))
        rows.append((f"{i}-{truth}", flank + "".join(letters) + tail))
    reads = spark.createDataFrame(rows, "read_name string, seq string")
    wl = spark.createDataFrame([(b,) for b in bars], "barcode string")
    out = barcode.match_barcodes(reads, wl).select(F.substring_index("read_name", "-", -1).alias("truth"), "barcode").collect()
    assert len(out) > 90 and np.mean([r.truth == r.barcode for r in out]) > 0.95
    again = barcode.match_barcodes(reads.repartition(3), wl)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, barcode.match_barcodes(reads, wl).collect()))


def test_partitioning_does_not_change_clusters(spark):
    nodes = _noisy_nodes(spark, molecules=20).cache()
    a = {r.id: r.cluster for r in umi.cluster(nodes).collect()}
    b = {r.id: r.cluster for r in umi.cluster(nodes.repartition(7), replace(UmiConfig(), pair_bound=3)).collect()}
    assert a == b


def test_highest_passing_number():
    rng = np.random.default_rng(8)
    high = rng.integers(0, 90, 60)
    passing = [set(rng.choice(90, rng.integers(0, 6), replace=False).tolist()) for _ in high]

    def test(rows, j):
        return np.array([x in passing[r] for r, x in zip(rows.tolist(), j.tolist())])

    for chunk in (7, 100, 200_000):
        got = sizes._highest(test, np.arange(60), high, chunk)
        assert got.tolist() == [max((x for x in p if 0 < x <= h), default=0) for p, h in zip(passing, high)]


def test_pair_counts_do_not_depend_on_blocks(spark, monkeypatch):
    rng = random.Random(6)
    rows = [("g", f"p{p}", bool(p % 2), e, rng.choice([None, 0, 1])) for p in range(60) for e in range(1, 9)]
    table = spark.createDataFrame(rows, "gene string, exons string, tail boolean, exon bigint, state int")
    whole = sorted(map(tuple, psi._pair_counts(table).collect()))
    monkeypatch.setattr(psi, "TASK_CELLS", 50)
    assert sorted(map(tuple, psi._pair_counts(table).collect())) == whole
    state = {(p, e): s for _, p, _, e, s in rows}
    for _, a, b, differ, seen, apart in whole:
        pairs = [(state[(f"p{p}", a)], state[(f"p{p}", b)]) for p in range(60)]
        assert differ == sum(x != y for x, y in pairs if x is not None and y is not None)
        assert seen == sum(x is not None for x, _ in pairs) and apart == sum((x is None) != (y is None) for x, y in pairs)


def test_isoform_links_match_brute_force(spark):
    """Every close pair once, whatever squares it lies in; isoforms alone in their group are not dealt out."""
    rng = np.random.default_rng(3)
    rows = {(f"g{k % 3}", "c", "m", f"{a},{a + 40}|{a + 100},{a + 100 + b}") for k, a, b in zip(range(90), rng.integers(1000, 1030, 90), rng.integers(30, 60, 90))}
    rows |= {("g0", "c", "m", f"{a},{a + 3}") for a in (5, 900, 4000)} | {(f"h{k}", "c", "m", "5,80") for k in range(5)}
    got = sizes.isoform_links(spark.createDataFrame(sorted(rows), "gene string, cell string, mid string, isoform string"), 10)
    assert "Window" in got._jdf.queryExecution().optimizedPlan().toString()
    names = {r.h: r.isoform for r in spark.createDataFrame([(r[3],) for r in rows], "isoform string").selectExpr("isoform", "xxhash64(isoform) AS h").collect()}
    found = [(r.gene, frozenset((names[r.a], names[r.b])), r.dis) for r in got.collect()]

    def bases(text):
        return {p for b in text.split("|") for p in range(int(b.split(",")[0]), int(b.split(",")[1]) + 1)}

    want = set()
    for g, _, _, x in rows:
        for h, _, _, y in rows:
            if g == h and x < y and len(bases(x) ^ bases(y)) <= 10:
                want.add((g, frozenset((x, y)), len(bases(x) ^ bases(y))))
    assert len(found) == len(set(found)) and set(found) == want and len(want) > 50


def test_replicates_are_not_shuffled(spark):
    """The cells of an exon meet once, before they enter every replicate."""
    values = spark.createDataFrame([("g", e, f"c{k}", (k % 5 + e) / 10) for e in (1, 2) for k in range(40)], "gene string, exon int, cell string, psi double")
    out = psi.phi_interval(values, 20)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and out.count() == 2


def test_groups_of_texts_are_merged_alike_whole_and_by_components(spark, monkeypatch):
    """Many small groups take no task of their own each, and a large one is taken apart first."""
    nodes = _noisy_nodes(spark).cache()
    distances = legacy.text_distances(nodes).cache()
    found, sizes = {}, sorted(r["count"] for r in distances.groupBy(*umi.KEYS).count().collect())
    for closest in (False, True):
        for bound in (20_000, sizes[-1] - 1):
            monkeypatch.setattr(legacy, "UmiConfig", lambda: UmiConfig(task_edge_bound=bound))
            merged = legacy.merge_clusters(distances, closest)
            assert "FlatMapGroupsInPandas" not in merged._jdf.queryExecution().executedPlan().toString()
            found[closest, bound] = {(r.gene, r.cell, r.umi): r.cluster for r in merged.collect()}
    for closest in (False, True):
        one, other = (found[closest, bound] for bound in (20_000, sizes[-1] - 1))
        assert one == other and 1 < len(set(one.values())) < len(one)
