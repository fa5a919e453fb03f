"""Base spans against plain patterns; what the method adds."""

import hashlib
import re

from isoquilt.llm import pii
from .helpers import documents, odd_rows


def _luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        twice = int(c) * (1 + i % 2)
        total += twice - 9 * (twice > 9)
    return total % 10 == 0


def _digits(text):
    return re.sub("[^0-9]", "", text)


RULES = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m.split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 13 <= len(_digits(m)) <= 19 and _luhn(_digits(m))),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(_digits(m)) <= 15),
]


def _base(text):
    return [(k, m.start(), m.end()) for k, p, ok in RULES for m in re.finditer(p, text or "") if ok(m.group())]


TEXTS = [
    "a@b.cd@e.f x@y@z.com a@b.c_d@e.f a@b..c @x.y",
    "1.2.3.4.5 256.1.1.1 0255.1.1.1 999999999999999.1.1.1 1.2.3",
    "4111 1111 1111 1111 x 4111-1111-1111-1112 5 4111111111111111 4111  1111",
    "+49 (0) 30 1234567 +1 +123 +1 (456) 555-2186. 4111111111111111-",
    "é🙂 m@x.org " + "1" * 3000 + " " + "a" * 3000,
    "a@b." + "x." * 9000 + "c " + "1 " * 9000,
    "write to john (at) corp (dot) com or (456) 555-2186",
]


def test_base_spans(spark):
    rows = odd_rows() + [(100 + i, t, "en", "a") for i, t in enumerate(TEXTS)]
    got = pii.report(documents(spark, rows)).collect()
    want = []
    for doc_id, text, *_ in rows:
        base = _base(text)
        written = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        want.append((doc_id, *(sum(k == kind for k, _, _ in base) for kind in pii.KINDS), hashlib.sha256(written.encode()).hexdigest()))
    assert sorted(map(str, (tuple(r)[:6] for r in got))) == sorted(map(str, want))


def test_digits_written_one_by_one(spark):
    """No two digits are adjacent, and nothing else in the text has digits."""
    texts = [
        " ".join("4111111111111111"), "pay -" + "-".join("4111111111111111") + " now", " ".join("4111111111111112"),
        "+4 9 3 0 1 2 3 4 5", "+4-9-3-0-1-2-3-4-5-", "call +(4)", "+1 2 3", "1-2 3", "+4.9.3.0.1.2.3.4.5",
    ]
    assert sum(len(_base(t)) for t in texts) == 7
    got = {r.doc_id: r for r in pii.report(documents(spark, [(i, t, "en", "a") for i, t in enumerate(texts)])).collect()}
    for i, text in enumerate(texts):
        written = ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(_base(text), key=lambda s: pii.KINDS.index(s[0])))
        assert got[i].spans == written
        assert got[i].base_sha256 == hashlib.sha256(written.encode()).hexdigest()


def test_method_adds_what_looks_alike(spark):
    """Numbers with a plus teach that the same number without one is a phone number as well."""
    rows = [(i, f"call me at +1 (456) 555-{1000 + i} today", "en", "a") for i in range(400)]
    rows += [(1000 + i, f"call me at (456) 555-{2000 + i} today", "en", "a") for i in range(10)]
    rows += [(2000 + i, f"order {i} of {4000 + i} lines and {12 + i} pages", "en", "a") for i in range(50)]
    docs = documents(spark, rows)
    spans = {r.doc_id: r.spans for r in pii.report(docs).collect()}
    assert all(spans[1000 + i] == "phone:11:25" for i in range(10))
    assert all(spans[i] == "phone:11:28" for i in range(400))
    assert not any(spans[2000 + i] for i in range(50))
    texts = {r.doc_id: r.text for r in pii.redacted(docs).collect()}
    assert texts[3] == texts[1003] == "call me at <phone> today" and texts[2003] == rows[413][1]


def test_no_python_on_executors(spark):
    plan = pii.report(documents(spark, odd_rows()))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def test_empty_table(spark):
    assert pii.report(spark.createDataFrame([], "doc_id long, text string")).count() == 0
