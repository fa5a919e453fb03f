"""Line dedup against a walk over all earlier lines."""

import random

from isoquilt.llm import lines
from .helpers import documents, odd_rows


def _one_edit(a, b):
    if abs(len(a) - len(b)) > 1:
        return False
    a, b = sorted((a, b), key=len)
    i = next((i for i in range(len(a)) if a[i] != b[i]), len(a))
    return a[i + 1 :] == b[i + 1 :] if len(a) == len(b) else a[i:] == b[i + 1 :]


def _brute(rows):
    seen, out = [], {}
    for doc_id, text, *_ in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        if doc_id in out:
            continue
        kept = []
        for line in (text or "").split("\n"):
            content = line.strip(lines.SPACES)
            gone = content and any(
                content == s or min(len(content), len(s)) >= lines.MIN_CHARS and _one_edit(content, s) for s in seen
            )
            if content:
                seen.append(content)
            if not gone:
                kept.append(line)
        out[doc_id] = None if text is None else "\n".join(kept)
    return out


def _check(spark, rows):
    docs = documents(spark, rows)
    made = lines.deduplicated(docs)
    assert made.columns == docs.columns
    got = made.select("doc_id", "text", "n_chars").collect()
    want = _brute(rows)
    assert sorted((str(r.doc_id), r.text) for r in got if r.text) == sorted(
        (str(d), want[d]) for d, *_ in rows if want[d]
    )
    assert len(got) == len(rows) and all(r.n_chars == len(r.text) for r in got if r.text is not None)


def test_random_edits(spark):
    rng = random.Random(3)
    base = ["".join(rng.choice("ab cdé🙂") for _ in range(rng.randint(6, 40))) for _ in range(30)]

    def changed(text):
        for _ in range(rng.choice([0, 1, 1, 1, 2])):
            at, kind = rng.randint(0, len(text)), rng.randint(0, 2)
            text = text[:at] + ("" if kind == 1 else rng.choice("abx")) + text[at + (kind > 0) :]
        return text

    rows = [(i, "\n".join(changed(rng.choice(base)) for _ in range(rng.randint(0, 12))), "en", "s") for i in range(90)]
    _check(spark, rows + [(-5, None, None, None)])


def test_odd_rows(spark):
    rows = odd_rows() + [(20, "  \n\n x\r\nx\n\x0b", "en", "a"), (21, "a" * 9000 + "\n" + "a" * 9001 + "\n" + "a" * 8998, "en", "a")]
    _check(spark, rows)
    # many lines that differ in one place, and one line in many documents
    templates = [(i, f"Page {i % 37} of 9 here\nAll rights reserved.", "en", "a") for i in range(120)]
    _check(spark, templates)


def test_rows_that_share_an_id_or_have_none(spark):
    """Each row with a text of its own loses its own lines only, and each line stays once."""
    for doc_id in (5, None):
        rows = [(1, "common line here\nalone in the first", "en", "a")]
        rows += [(doc_id, f"own line {i * 7919:08x} {'abcdefghij'[i] * 9}\ncommon line here\nshared tail text", "en", "a") for i in range(10)]
        rows += [(doc_id, f"common line here\nonly {'klmnopqrst'[i] * 12} here\nfirst in null rows", "en", "a") for i in range(10)]
        got = [r.text for r in lines.deduplicated(documents(spark, rows)).collect()]
        left = sorted(line for text in got for line in text.split("\n") if line)
        assert len(got) == len(rows) and left == sorted({line for _, text, *_ in rows for line in text.split("\n")})
    ends = [((1 << 63) - 1, "the line of the end"), (None, "the line of the end"), (-(1 << 63), "another line, of the begin")]
    got = lines.report(spark.createDataFrame(ends, "doc_id long, text string")).collect()
    assert {r.doc_id: r.text for r in got} == {ends[0][0]: ends[0][1], None: "", ends[2][0]: ends[2][1]}


def test_empty_table(spark):
    assert lines.report(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    only = lines.report(spark.createDataFrame([(1, "same line here\nsame line here")], "doc_id long, text string"))
    assert [tuple(r) for r in only.collect()] == [(1, "same line here", 1)]
