"""Collocations against counts of every phrase, and slices against whole texts."""

import random
import re
from collections import Counter

import pytest

from isoquilt.llm import phrases
from tests.llm.helpers import documents, odd_rows


def by_hand(rows, least, top):
    count, total = Counter(), Counter()
    for text, lang in rows:
        lang = lang or "und"
        lowered = (text or "").translate({c: c + 32 for c in range(65, 91)})
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            for k in (1, 2, 3):
                count.update((lang, tuple(words[i : i + k])) for i in range(len(words) - k + 1))
    found = {}
    for (lang, p), a in count.items():
        if len(p) > 1 and a >= least:
            cuts = []
            for k in range(1, len(p)):
                l, r = count[lang, p[:k]], count[lang, p[k:]]  # noqa: E741
                cuts.append((1000000 * a * a // (l * r), k, l, r))
            found[lang, p] = (a, *min(cuts))
    dropped = set()
    for (lang, p), (a, *_) in found.items():
        if len(p) == 3:
            dropped |= {(lang, q) for q in (p[:2], p[1:]) if 100 * a >= 50 * found[lang, q][0]}
    out = []
    for lang in total:
        mine = [(-s, -a, " ".join(p).encode(), l, r) for (g, p), (a, s, _, l, r) in found.items() if g == lang and (g, p) not in dropped]
        for k, (s, a, p, l, r) in enumerate(sorted(mine)[:top]):  # noqa: E741
            out.append((lang, k + 1, p.decode(), -a, l, r, total[lang], -s))
    return sorted(out)


def texts(seed, n=150):
    rng = random.Random(seed)
    words = [rng.choice(["a", "Bé", "c d", "E'", "中文"]) + str(int(rng.expovariate(0.08))) for _ in range(400)]
    marks = [" ", " ", "\t", "  ", " ", ", ", ".", "\n", "\x0b"]
    made = []
    for k in range(n):
        text = "".join(rng.choice(words) + rng.choice(marks) for _ in range(rng.randint(0, 120)))
        if k % 3 == 0:
            text += " of the First kind of all; of the first sort"
        made.append((text, rng.choice(["en", "en", "en", None, "fr"])))
    return made + [(None, "en"), ("", None), ("One", "xx"), (" \n\t ", "en")]


@pytest.mark.parametrize("top, frontier", [(2000, 100_000), (7, 30), (25, 11)])
def test_equal_brute_force(spark, top, frontier):
    rows = texts(1)
    docs = spark.createDataFrame(rows, "text string, lang string")
    got = sorted(tuple(r) for r in phrases.collocations(docs, least=4, top=top, frontier=frontier).collect())
    assert got == by_hand(rows, 4, top)
    assert {r[0] for r in got} >= {"en", "fr", "und"}


def test_odd_rows_repeats_and_clashes(spark):
    rows = odd_rows() * 6
    got = sorted(tuple(r) for r in phrases.collocations(documents(spark, rows), top=300).collect())
    assert got == by_hand([(t, lang) for _, t, lang, _ in rows], 10, 300)
    assert phrases.collocations(documents(spark, rows).limit(0)).count() == 0


@pytest.mark.parametrize("most", [8, 20, 64, 1000])
def test_slices_hold_every_phrase_once(most):
    rng = random.Random(most)
    for _ in range(60):
        data = "".join(rng.choice(["ab", "c", "d" * 30, " ", "  ", " ", "."]) for _ in range(rng.randint(0, 80))).encode()
        data = data.translate(phrases._TABLE)
        want, got = Counter(), Counter()
        for part, old, into in [(data, 0, want), *((p, o, got) for p, o in phrases.slices(data, most))]:
            tokens = part.replace(b"\xff", b" \xff ").split()
            for k in (1, 2, 3):
                for i in range(len(tokens) - k + 1):
                    if i + k > old and b"\xff" not in tokens[i : i + k]:
                        into[tuple(tokens[i : i + k])] += 1
        assert got == want


def test_scores_beyond_64_bits(spark):
    a, l, r = 3_000_000_000_001, 7_000_000_000_003, 5_000_000_000_009  # noqa: E741
    df = spark.createDataFrame([(a, l, r)], "a long, l long, r long")
    assert df.select(phrases._score("a", "l", "r")).first()[0] == 1000000 * a * a // (l * r)
