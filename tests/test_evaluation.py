"""Evaluation, packing, merging and lookups against plain loops."""

import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from isoquilt.operators import barcode, helpers, legacy, splice, umi, umi_evaluation
from isoquilt.plans import queries_legacy
from isoquilt.plans import testbed as tb


def _mse(x, y, norm):
    if norm:
        x, y = ([math.log(v / sum(z) * 10000 + 1) for v in z] for z in (x, y))
    return statistics.fmean((a - b) ** 2 for a, b in zip(x, y))


def test_dedup_errors_per_setting(spark):
    rng = random.Random(1)
    reads, counts = [], []
    for setting in ("low", "high"):
        for cell in range(8):
            for iso in ("1|2|3", "1|3", "1"):
                for m in range(rng.randint(1, 6)):
                    reads += [(setting, f"c{cell}", iso, f"{iso}-{m}")] * rng.randint(1, 5)
                n = rng.randint(1, 9)
                counts.append((setting, f"c{cell}", iso, n + 10, n, n * rng.random() * (cell != 3)))
    counts.append(("low", "not-there", "1|3", 4, 2, 1.0))
    shown, spanned = (lambda i: F.size(F.split(i, r"\|")) > 2), (lambda i: F.size(F.split(i, r"\|")) > 1)
    got = helpers.dedup_evaluation(
        spark.createDataFrame(reads, "setting string, cell string, isoform string, molecule string"),
        spark.createDataFrame(counts, "setting string, cell string, isoform string, size long, cluster long, count double"),
        ["setting"], shown, spanned,
    )
    got = {r["setting"]: r for r in got.collect()}

    def psi(rows, k):
        under = sum(r[k] for r in rows if r[0].count("|") > 0)
        return sum(r[k] for r in rows if r[0].count("|") > 1) / under if under else None

    for setting in ("low", "high"):
        real, found = {}, {}
        for s, c, i, m in reads:
            if s == setting:
                real.setdefault(c, {}).setdefault(i, []).append(m)
        for s, c, i, size, cluster, count in counts:
            if s == setting:
                found.setdefault(c, []).append((i, size, cluster, count))
        rows = {c: [(i, len(m), len(set(m))) for i, m in x.items()] for c, x in real.items()}
        cells = [c for c in found if c in rows]
        kept = [c for c in cells if None not in (psi(found[c], 2), psi(found[c], 3), psi(rows[c], 1))]
        assert len(kept) < len(cells)
        exprs = [sum(r[2] for r in rows[c]) for c in kept]
        want = {
            "pcr": statistics.fmean(n / m for x in rows.values() for _, n, m in x),
            "exprs": statistics.fmean(sum(r[2] for r in x) for x in rows.values()),
            "es_pcr": statistics.fmean(r[1] / r[3] for x in found.values() for r in x if r[3] > 0),
            "es_exprs": statistics.fmean(sum(r[3] for r in x) for x in found.values()),
            "pcr_exprs_diff": _mse([sum(r[1] for r in rows[c]) for c in kept], exprs, True),
            "cluster_exprs_diff": _mse([sum(r[2] for r in found[c]) for c in kept], exprs, True),
            "dedup_exprs_diff": _mse([sum(r[3] for r in found[c]) for c in kept], exprs, True),
            "pcr_psi_diff": _mse([psi(rows[c], 1) for c in kept], [psi(rows[c], 2) for c in kept], False),
            "cluster_psi_diff": _mse([psi(found[c], 2) for c in kept], [psi(rows[c], 2) for c in kept], False),
            "dedup_psi_diff": _mse([psi(found[c], 3) for c in kept], [psi(rows[c], 2) for c in kept], False),
        }
        assert {k: pytest.approx(v) for k, v in want.items()} == {k: got[setting][k] for k in want}
        # the filter changes the answer
        assert want["dedup_exprs_diff"] != pytest.approx(want["cluster_exprs_diff"])


def test_clusters_of_a_grid_of_settings(spark):
    rng = random.Random(3)
    rows, n = [], 0
    for setting, errors in (("clean", 0), ("noisy", 2)):
        for cell in ("a", "b", "c"):
            for m in range(6 if cell == "b" else 3):
                umi = "".join(rng.choice("ACGT") for _ in range(14))
                for copy in range(rng.randint(2, 9)):
                    text = list(umi)
                    for _ in range(errors if copy == 0 else 0):
                        text[rng.randrange(3, 11)] = rng.choice("ACGT")
                    n += 1
                    rows.append((setting, f"r{n}", cell, 1.0, errors if copy == 0 else 0, "A" * 16 + "".join(text), "g", "1,9", f"{cell}{m}", False))
    schema = "setting string, read_name string, barcode string, start double, edit int, seq string, gene string, isoform string, molecule string, polyA boolean"
    got = {r["setting"]: r for r in umi_evaluation.cluster_evaluation(spark.createDataFrame(rows, schema), ["setting"]).collect()}
    for setting in ("clean", "noisy"):
        sizes = {}
        for r in rows:
            if r[0] == setting:
                sizes[r[2]] = sizes.get(r[2], 0) + 1
        mean = sum(sizes.values()) / 3
        cell = min(sizes, key=lambda c: (abs(sizes[c] - mean), c))
        mine = [r for r in rows if r[0] == setting and r[2] == cell]
        assert got[setting]["raw"] == len(mine) and got[setting]["real"] == len({r[8] for r in mine})
    assert got["clean"]["dedup"] == got["clean"]["real"] == got["clean"]["filter_error"]
    assert got["noisy"]["filter_total"] <= got["noisy"]["dedup"]


def test_first_fit_is_the_one_by_one_rule(spark):
    rng = random.Random(8)
    for _ in range(40):
        items = sorted((rng.choice([1, 2, 3, 5, 7, 11, 30]) for _ in range(rng.randint(1, 80))), reverse=True)
        cap = max(items) + rng.randint(0, 30)
        room, want = [], []
        for w in items:
            place = next((k for k, r in enumerate(room) if r >= w), len(room))
            room += [cap] if place == len(room) else []
            room[place] -= w
            want.append((w, place))
        counts = [(w, items.count(w)) for w in sorted(set(items), reverse=True)]
        plan = {}
        for w, done, place in barcode.first_fit(counts, cap):
            plan.setdefault(w, []).append((done, place))
        got = [(w, [p for d, p in plan[w] if d <= k][-1]) for w, n in counts for k in range(n)]
        assert sorted(got) == sorted(want)


def test_packed_genes(spark):
    rng = random.Random(4)
    rows = [(f"g{k:04d}", int(rng.paretovariate(1.1) * 10)) for k in range(1500)] + [("huge", 10**6), ("also", 40)]
    df = spark.createDataFrame(rows, "gene string, weight bigint")
    for bins in (4, 37):
        cap = math.ceil(sum(w for _, w in rows) / bins)
        got = barcode.pack_genes(df, bins).collect()
        assert sorted((r.gene, r.weight) for r in got) == sorted(rows)
        load = {}
        for r in got:
            load[r.bin] = load.get(r.bin, 0) + r.weight
        small = {b: w for b, w in load.items() if b.startswith("bin-")}
        least = math.ceil(sum(small.values()) / cap)
        assert max(small.values()) <= cap and len(small) <= 11 / 9 * least + 1
        assert all(w > cap for b, w in load.items() if b.startswith("alone-"))
    assert barcode.pack_genes(df.limit(3), 5).where("bin <> gene").count() == 0


def _naive(members, dist, closest, thresh):
    """All pairs of clusters scored again in every round."""
    while True:
        best, names = None, sorted(members)
        for i, x in enumerate(names):
            for y in names[i + 1 :]:
                known = [dist[min(u, v), max(u, v)] for u in members[x] for v in members[y] if (min(u, v), max(u, v)) in dist]
                if not known or len(known) * 5 < len(members[x]) * len(members[y]) * 4:
                    continue
                d = sum(known) / len(known)
                if (d >= thresh if closest else int(d) > thresh) or (best and (not closest or d >= best[0])):
                    continue
                best = (d, x, y)
        if best is None:
            return {u: c for c, group in members.items() for u in group}
        members[best[1]] += members.pop(best[2])


@pytest.mark.parametrize("closest", [True, False])
def test_merging_by_heap_equals_rescoring(closest):
    rng = random.Random(21)
    for _ in range(60):
        n = rng.randint(2, 14)
        texts = [f"t{k:02d}" for k in range(n)]
        share = rng.choice([0.5, 0.9, 1.0])
        dist = {(a, b): rng.randint(0, 4) for a in texts for b in texts if a < b and rng.random() < share}
        assert legacy._agglomerate(texts, dist, closest, 2) == _naive({t: [t] for t in texts}, dist, closest, 2)


def test_merging_thousands_of_texts_takes_seconds():
    import time

    rng = random.Random(2)
    texts = [f"t{k:05d}" for k in range(5000)]
    dist = {}
    for k in range(0, 5000, 10):
        dist |= {(texts[i], texts[j]): rng.randint(0, 2) for i in range(k, k + 10) for j in range(i + 1, k + 10)}
    dist |= {(texts[k], texts[k + 10]): 3 for k in range(0, 4990, 10)}
    start = time.time()
    assert len(set(legacy._agglomerate(texts, dist, True, 2).values())) >= 500
    assert time.time() - start < 20


def test_counted_medians(spark):
    rng = random.Random(6)
    rows = [(rng.choice("abc"), rng.choice([None, 1.5, rng.random() * 5, float(rng.randint(0, 3))]), rng.randint(0, 9)) for _ in range(700)]
    rows += [("lone", 4.0, 2), ("none", None, 1), ("pair", 1.0, 1), ("pair", 2.0, 5)]
    df = spark.createDataFrame(rows, "k string, x double, y int")
    got = {r.k: (r.x, r.y) for r in legacy.medians(df, ["k"], ["x", "y"]).collect()}
    want = {r.k: (r.x, r.y) for r in df.groupBy("k").agg(F.median("x").alias("x"), F.median("y").alias("y")).collect()}
    assert got == want


def test_depth_at_places(spark):
    rng = random.Random(7)
    runs, places = [], []
    for g in ("g1", "g2", "g3"):
        at = 1
        for _ in range(40):
            at += rng.randint(0, 4)
            size = rng.randint(1, 9)
            runs.append((g, at, at + size - 1, rng.randint(1, 50)))
            at += size
        places += [(g, rng.randint(0, 260)) for _ in range(120)]
    places.append(("g4", 5))
    got = helpers.depth_at(
        spark.createDataFrame(runs, "gene string, s bigint, e bigint, coverage bigint"), spark.createDataFrame(places, "gene string, at bigint")
    )
    want = {(g, p): float(c) for g, p in set(places) for h, s, e, c in runs if g == h and s <= p <= e}
    assert {(r.gene, r.at): r.depth for r in got.collect()} == want


def test_combined_reads_hold_nodes_and_molecules(spark):
    rng = random.Random(9)
    rows = []
    for n in range(900):
        umi_text = rng.choice(["ACGTACGTACGT", "ACGTTCGTACGT", "GGGTACGTACGT", "ACG"])
        rows.append((f"r{n}", rng.choice("AN"), rng.choice("xy"), 0.0, rng.randint(0, 4), "A" * 15 + umi_text, rng.choice(["g1", "g2"]), rng.choice(["1,9", "2,9"]), rng.choice(["m", "n", None]), rng.random() < 0.5))
    reads = spark.createDataFrame(rows, "read_name string, setting string, barcode string, start double, edit int, seq string, gene string, isoform string, molecule string, polyA boolean")
    known = umi.known_nodes(reads, "setting")
    whole = umi.whole_nodes(known.withColumn("gene", F.concat_ws("/", "setting", "gene")))
    plain = umi.compress(umi.with_umi(reads.withColumn("gene", F.concat_ws("/", "setting", "gene")))).select(*whole.columns)
    assert sorted(whole.collect()) == sorted(plain.collect()) and 0 < whole.agg(F.sum("n")).first()[0] < 900
    # a null molecule is one of its own
    real = known.groupBy("setting", "cell", "gene", "isoform").agg(F.sum("n").alias("n"), F.sum("m").alias("m"), F.sum("n_err").alias("e"))
    want = reads.groupBy("setting", F.col("barcode").alias("cell"), "gene", "isoform").agg(
        F.count("*").alias("n"), F.count_distinct(F.coalesce("molecule", F.lit(""))).alias("m"), F.sum((F.col("edit") > 2).cast("bigint")).alias("e")
    )
    assert sorted(real.collect()) == sorted(want.collect())
    assert splice.error_ratio(known, n="n", wrong="n_err") == splice.error_ratio(reads)


def test_reads_are_shuffled_once_for_the_truth(spark):
    """No join of the reads with themselves, no read is kept, nodes are made where reads were dealt to."""
    plan = queries_legacy._known_nodes(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Join" not in plan
    nodes = spark.createDataFrame([("g", "c", 1, "ACGTACGTACGT", "1,9", 2), ("g", "c", 2, "ACGTACGTACGA", "1,9", 1)], "gene string, cell string, id long, umi string, isoform string, n long")
    pairs = umi.close_pairs(nodes)
    # genes go to every task, also where the planner would not send them
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    busy = umi.busy_genes(tb.true_cell_exon(tb.dealt_reads(spark, "/root/testdata/sf0.001", "gene", "cell")))
    plan = busy._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan
    # counting the groups does not shuffle the nodes beside the pairs
    assert "LeftAnti" not in pairs._jdf.queryExecution().executedPlan().toString() and pairs.count() == 1
