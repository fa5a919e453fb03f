"""Hand-computed fixtures for scalar and array functions, and brute-force checks of alignment."""

import functools
import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from isoquilt.functions import align, communities, intervals, kmer_numbers, seq, stats
from isoquilt.operators import exons, extract, legacy, splice, umi


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def test_sequence_fixtures(spark):
    assert one(spark, seq.revcomp(F.lit("AACG"))) == "CGTT"
    assert one(spark, seq.has_polya(F.lit("A" * 20))) is False
    assert one(spark, seq.has_polya(F.lit("A" * 21))) is True
    assert one(spark, seq.trim_to_last_run(F.lit("CC" + "A" * 12 + "GGT"))) == "A" * 10 + "GGT"
    assert one(spark, seq.kmers(F.lit("ACG"), 8)) == []


def test_read_fixtures(spark):
    cigar = extract.parse_cigar(F.lit("10S201M199N101M99N201M"))
    blocks = extract.blocks_near(extract.exon_blocks(F.lit(999), cigar), F.lit(1000), F.lit(1800), 200)
    assert one(spark, intervals.format_blocks(blocks)) == "1000,1201|1400,1501|1600,1801"
    sites = intervals.inner_sites(F.lit("1000,1201|1400,1501|1600,1801"))
    known = F.array(*[F.lit(x).cast("bigint") for x in (1000, 1200, 1400, 1500, 1600, 1800)])
    assert one(spark, extract.matched_site_share(sites, known)) == 1.0
    assert one(spark, extract.matched_site_share(intervals.inner_sites(F.lit("5,9")), known)) == -1.0
    fwd, rev = extract.soft_clips(extract.parse_cigar(F.lit("5M")), F.lit("ACGTA"))
    assert one(spark, F.concat(fwd, rev)) == "N" * 18


def test_isoform_distances(spark):
    toy = "1000,1200|1400,1500|1600,1800", "1000,1200|1600,1800"
    a, b = (intervals.parse_blocks(F.lit(t)) for t in toy)
    assert one(spark, intervals.span_distance(a, b)) == 101
    far = intervals.parse_blocks(F.lit("1300,1400"))
    assert one(spark, intervals.span_distance(intervals.parse_blocks(F.lit("1000,1200")), far)) == -1


def test_exon_mapping(spark):
    def parts(ids):
        rows = zip(((1000, 1200), (1400, 1500), (1600, 1800)), ids)
        return F.array(
            *[F.struct(F.lit(s).alias("s"), F.lit(e).alias("e"), F.lit(i).alias("exon_id")) for (s, e), i in rows]
        )

    blocks = intervals.parse_blocks(F.lit("1000,1201|1600,1801"))
    assert one(spark, exons.map_isoform(blocks, parts([1, 2, 3]))) == "1|3"
    assert one(spark, exons.map_isoform(blocks, parts([3, 2, 1]))) == "3|1"
    assert one(spark, exons.map_bin(F.lit(2000), F.lit(2100), parts([1, 2, 3]))) == ["N"]


def test_recover(spark):
    sites = F.array(*[F.lit(x).cast("bigint") for x in (1200, 1400, 1500, 1600)])
    picked = splice.selected_sites(F.lit("1001"), sites)
    made = splice.recover_isoform(F.lit(1000).cast("bigint"), picked, F.lit(1800).cast("bigint"))
    assert one(spark, made) == "1000,1200|1600,1800"


def _clip(barcode, umi_text="GTCATTGCAA"):
    return "CTACACGACGCTCTTCCGATCT" + barcode + umi_text + "TTTCTTATATGGG"


def test_infix_fixtures():
    texts = [_clip("GACTTCAGCATGACCA"), _clip("GACTTCAGGATGACCA"), _clip("AACCATGAGCCACGCT")]
    bars = ["GACTTCAGCATGACCA", "GACTTCAGCATGACCA", "AACCATGAGCCACGCT"]
    edit, pos = align.infix_batch(pd.Series(texts), pd.Series(bars))
    assert edit.tolist() == [0, 1, 0]
    assert pos.tolist() == [23, 23, 24]


def _distance(a, b):
    """Edit distance by trying every first step, remembered by suffix lengths."""

    @functools.cache
    def least(i, j):
        if i == len(a) or j == len(b):
            return len(a) - i + len(b) - j
        if a[i] == b[j]:
            return least(i + 1, j + 1)
        return 1 + min(least(i + 1, j), least(i, j + 1), least(i + 1, j + 1))

    return least(0, 0)


def test_infix_edit_is_the_best_of_all_placements():
    """The distance is the least over every substring; the position lies inside a best placement."""
    rng = random.Random(5)
    for i in range(60):
        text = "".join(rng.choice("ACGT") for _ in range(rng.randint(12, 20)))
        pattern = text[4:12] if i % 2 else "".join(rng.choice("ACGT") for _ in range(8))
        pattern = pattern[:3] + rng.choice("ACGT") + pattern[4:]
        found = {}
        for start in range(len(text) + 1):
            for stop in range(start, min(len(text), start + 16) + 1):
                found.setdefault(_distance(pattern, text[start:stop]), []).append((start, stop))
        edit, pos = align.infix_batch(pd.Series([text]), pd.Series([pattern]))
        assert edit[0] == min(found)
        starts, stops = zip(*found[min(found)])
        assert min(starts) <= pos[0] <= max(stops)


# worked by hand: (text, pattern, edits, column at which the first pattern letter is left)
@pytest.mark.parametrize(
    "text, pattern, edit, pos",
    [
        ("AACGTA", "CGT", 0, 3),  # exact, begins at the third letter
        ("CGTACGT", "CGT", 0, 1),  # of two exact placements the first
        ("TTTT", "CGC", 3, 0),  # nothing fits: the empty placement at the left end
        ("AACTA", "CGT", 1, 3),  # one pattern letter without a partner
        ("AACAGTA", "CGT", 1, 5),  # of equal ways the one that leaves the pattern's first letter out
    ],
)
def test_infix_by_hand(text, pattern, edit, pos):
    got = align.infix_batch(pd.Series([text]), pd.Series([pattern]))
    assert (got[0][0], got[1][0]) == (edit, pos)


def test_global_score():
    base = "ACGTTGCAACGT"
    scores = align.global_score_batch(
        pd.Series([base] * 4), pd.Series([base, "C" + base[1:], base[1:] + "A", "TTAACCTGGTAC"])
    )
    assert scores[:3].tolist() == [12, 10, 9]
    assert align.global_score_batch(pd.Series(["A" * 12]), pd.Series(["C" * 12]))[0] == -12


def test_edit_budget_is_exhaustive():
    """Every pair that reaches the score passes both filters derived from it."""
    ops, lost = umi.edit_budget(12, 5)
    assert (ops, lost) == (4, 3)
    rng = random.Random(11)

    def change(text):
        s = list(text)
        for _ in range(rng.randint(0, 4)):
            kind, at = rng.randint(0, 2), rng.randrange(len(s))
            if kind == 0:
                s[at] = rng.choice("ACGT")
            elif kind == 1:
                del s[at]
                s.append(rng.choice("ACGT"))
            else:
                s.insert(at, rng.choice("ACGT"))
                s.pop()
        return "".join(s)

    def shorter(text, n):
        texts = {text}
        for _ in range(n):
            texts = {t[:i] + t[i + 1 :] for t in texts for i in range(len(t))}
        return texts

    a = ["".join(rng.choice("ACGT") for _ in range(12)) for _ in range(400)]
    b = [change(x) for x in a]
    for x, y, score in zip(a, b, align.global_score_batch(pd.Series(a), pd.Series(b))):
        if score >= 5:
            assert shorter(x, lost) & shorter(y, lost)


def test_stats(spark):
    assert stats.mean2var(2) == pytest.approx(2.566)
    sigma = one(spark, stats.updated_sigma(F.lit(4.0), F.lit(100), 10.0))
    assert sigma == pytest.approx(2.104968951757717)
    # known chi-square quantiles
    got = stats.chi2_quantile(np.array([0.975, 0.025, 0.95]), np.array([10.0, 10.0, 2.0]))
    assert got == pytest.approx([20.4831774, 3.2469728, 5.9914645], rel=1e-6)
    assert stats.chi2_cdf(np.array([2 * math.log(2)]), np.array([2.0]))[0] == pytest.approx(0.5)


def _cut_brute(n, edges):
    best = math.inf
    for mask in range(1, 2 ** (n - 1)):
        side = [(mask >> v) & 1 for v in range(n)]
        best = min(best, sum(w for i, j, w in edges if side[i] != side[j]))
    return best


def test_cut_below_matches_brute_force():
    rng = random.Random(3)
    for _ in range(200):
        n = rng.randint(3, 7)
        edges = [(i, i + 1, rng.randint(1, 4)) for i in range(n - 1)]
        edges += [(i, j, rng.randint(1, 4)) for i in range(n) for j in range(i + 2, n) if rng.random() < 0.5]
        best = _cut_brute(n, edges)
        for bound in (1, 2, 3, 5):
            assert communities.cut_below(n, edges, bound) == (best < bound)


def test_split_graph_two_cliques():
    left = [(i, j, 10, 1) for i in range(6) for j in range(i + 1, 6)]
    right = [(i + 6, j + 6, 10, 1) for i in range(6) for j in range(i + 1, 6)]
    labels = communities.split_graph(list(range(100, 112)), [1] * 12, left + right + [(0, 6, 5, 1)], 3, 10)
    assert labels == [100] * 6 + [106] * 6


def test_min_edit(spark):
    assert one(spark, legacy.min_edit(F.lit("AAACCCGGGTTT"), F.lit("AACCCGGGTTTT"))) == 0


def test_bounded_distances(spark):
    """What is within the bound is the distance itself, what is not is null or above it."""
    texts = ["AAACCCGGGTTT", "AACCCGGGTTTT", "AAACCAGGGTTT", "TTTGGGCCCAAA", "ACGT", "AAACCAGCGTTT"]
    pairs = spark.createDataFrame([(a, b) for a in texts for b in texts], "a string, b string")
    for r in pairs.select(legacy.min_edit(F.col("a"), F.col("b")).alias("d"), legacy.min_edit(F.col("a"), F.col("b"), most=2).alias("m")).collect():
        assert r.m == (r.d if r.d is not None and r.d <= 2 else None)
    isoforms = ["1,100|200,300|400,500", "1,100|400,500", "1,100|200,290|400,500", "20,100|200,260|390,500", "600,700"]
    both = spark.createDataFrame([(a, b) for a in isoforms for b in isoforms], "a string, b string")
    a, b = (intervals.parse_blocks(F.col(c)) for c in "ab")
    for r in both.select(intervals.span_distance(a, b).alias("d"), intervals.span_distance(a, b, 80).alias("m")).collect():
        assert r.m == r.d or (r.m is None and r.d > 80)


def _texts(draw, number, length, letters="ACGT"):
    return ["".join(draw.choice(letters) for _ in range(length)) for _ in range(number)]


@pytest.mark.parametrize("letters, k, least", [("ACGT", 4, 0.25), ("AC", 3, 0.25), ("ACGTNx", 3, 0.4), ("ACG", 3, 0.1), ("ACGT", 8, 0.25)])
def test_texts_looked_up_by_pairs_find_what_postings_find(letters, k, least):
    draw = random.Random(k)
    bars = sorted(set(_texts(draw, 150, 16, letters) + _texts(draw, 10, 12, letters) + ["A" * 16, "AC" * 8, "ACG"]))
    texts = [a + draw.choice(bars) + b for a, b in zip(_texts(draw, 60, 7, letters), _texts(draw, 60, 20, letters))]
    texts += _texts(draw, 60, 40, letters) + ["", "A" * 30, bars[0]]
    sets = [{t[i : i + k] for i in range(len(t) - k + 1)} for t in texts]
    known = set().union(*({b[i : i + k] for i in range(len(b) - k + 1)} for b in bars))
    expected = {}
    for t, held in enumerate(s & known for s in sets):
        for n, b in enumerate(bars):
            own = {b[i : i + k] for i in range(len(b) - k + 1)}
            if held & own and len(held & own) / (math.sqrt(len(held)) * math.sqrt(len(own))) >= least:
                expected[t, n] = len(held & own) / math.sqrt(len(held) * len(own))
    for paired in (-1, 1 << 40):
        index = kmer_numbers.Index(bars, k)
        index.PAIRED = paired
        text, barcode, cos = index.similar(pd.Series(texts, dtype=object), least)
        assert dict(zip(zip(text.tolist(), barcode.tolist()), cos.tolist())) == pytest.approx(expected)


def test_long_whitelists_are_not_counted_posting_by_posting(monkeypatch):
    """Pairs of k-mers leave a few of 60 000 barcodes to look at, where each of about 48 k-mers has eight postings."""
    draw = random.Random(5)
    bars, seen, whole = sorted(set(_texts(draw, 60_000, 16))), [], kmer_numbers.Index._verified
    texts = [a + draw.choice(bars) + b for a, b in zip(_texts(draw, 200, 10), _texts(draw, 200, 29))]
    index = kmer_numbers.Index(bars, 8)
    index.PAIRED = 50
    monkeypatch.setattr(kmer_numbers.Index, "_by_postings", lambda self, row, *rest: (seen.append(8 * len(row) * (self is index)), (np.empty(0, int), np.empty(0, int), np.empty(0)))[1])
    monkeypatch.setattr(kmer_numbers.Index, "_verified", lambda self, text, *rest: (seen.append(len(text)), whole(self, text, *rest))[1])
    text, barcode, _ = index.similar(pd.Series(texts), 0.25)
    assert set(range(200)) <= set(text.tolist())
    # barcodes looked at, and the postings of texts that are not looked up by pairs
    assert sum(seen) < 200 * 60
