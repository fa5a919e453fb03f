"""Archives written, converted and read back."""

import base64
import gzip
import hashlib
import io

import pytest

from isoquilt.llm import archive

ROWS = [
    (5, "http://a.com/x y", "<p>same</p>"), (3, "http://a.com/", "<p>same</p>"), (3, "http://a.com/", "<p>same</p>"),
    (9, None, None), (8, "http://e.com/", ""), (None, "http://n.com/", "<p>same</p>"), (11, "http://u.com/é", "é🙂\r\n\r\nWARC/1.0\r\n"),
    (12, "http://l.com/", "long " * 200_000), (13, "http://c.com/", "http://x 1.1.1.1 20000101000000 text/html 5\nabc\n"),
]


def _digest(payload):
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


@pytest.mark.parametrize("file_records", [archive.FILE_RECORDS, 2])
def test_round_trip(spark, monkeypatch, file_records):
    monkeypatch.setattr(archive.write_arc, "__defaults__", (file_records,))
    monkeypatch.setattr(archive.convert, "__defaults__", (0, file_records))
    table = spark.createDataFrame([(*r, "x", 1) for r in ROWS], "page_id long, url string, html string, record_type string, block int")
    payloads = [(p, (h or "").encode()) for p, _, h in ROWS]
    first = {}
    for page, payload in payloads:
        if page is not None:
            first[payload] = min(page, first.get(payload, page))
    want = []
    for page, payload in payloads:
        own = first.get(payload, page) == page
        want.append((page, len(payload), _digest(payload), "response" if own else "revisit", None if own else first[payload]))
    got = archive.archived(table).collect()
    assert sorted(str(tuple(r)) for r in got) == sorted(map(str, want))
    assert archive.archived(table.limit(0)).count() == 0


def _stream(spark, path):
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).orderBy("path").collect()
    return b"".join(gzip.decompress(f["content"]) for f in files if f["content"])


def test_files(spark, tmp_path):
    table = spark.createDataFrame(ROWS, "page_id long, url string, html string").repartition(3)
    archive.write_arc(table, f"{tmp_path}/arc")
    archive.convert(spark, f"{tmp_path}/arc", f"{tmp_path}/warc")
    arcs = list(archive.arc_records(io.BytesIO(_stream(spark, f"{tmp_path}/arc"))))
    assert {len(fields) for _, fields, _ in arcs} == {5, 10}
    records = list(archive.warc_records(io.BytesIO(_stream(spark, f"{tmp_path}/warc"))))
    kinds = [f["warc-type"] for f, _ in records]
    assert kinds.count("response") == 6 and kinds.count("revisit") == 3 and "warcinfo" in kinds
    ids = [f["warc-record-id"] for f, _ in records]
    assert len(set(ids)) == len(ids)
    for fields, block in records:
        assert int(fields["content-length"]) == len(block)
        if fields["warc-type"] != "warcinfo":
            assert fields["warc-block-digest"] == "sha1:" + _digest(block)
            assert fields["warc-date"].endswith("Z") and len(fields["warc-date"]) == 20
        if fields["warc-type"] == "response":
            assert fields["warc-payload-digest"] == "sha1:" + _digest(block[block.find(b"\r\n\r\n") + 4 :])


def test_versions_and_damage():
    one = b"filedesc://x.arc 0.0.0.0 20000101000000 text/plain %d\n" + b"1 0 o\n" + archive.FIELDS[1].encode() + b"\n\n"
    one = one.replace(b"%d", str(len(b"1 0 o\n" + archive.FIELDS[1].encode() + b"\n")).encode())
    record = b"dns:a b 1.2.3.4 20010203040506 text/dns 5\n12\n45\n"
    rows = list(archive.arc_records(io.BytesIO(one + record + record)))
    assert [r[1][0] for r in rows] == ["filedesc://x.arc", "dns:a b", "dns:a b"] and rows[1][2] == b"12\n45"
    made = archive._synthesised("f", 1, *rows[1][1:], True)
    assert made[1] == "resource" and made[4] == "2001-02-03T04:05:06Z" and made[7] == 5
    with pytest.raises(ValueError):
        list(archive.arc_records(io.BytesIO(one + record[:-4])))
    with pytest.raises(ValueError):
        list(archive.warc_records(io.BytesIO(b"WARC/1.0\r\nContent-Length: 9\r\n\r\nabc")))
