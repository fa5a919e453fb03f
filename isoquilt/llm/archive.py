"""Converter from the legacy ARC format to WARC, with writers and readers of both.

An ARC file is a chain of records: one header line, as many bytes as its last field declares,
a line feed.  The first record, ``filedesc``, names the format version: 1 has five fields a
line, 2 has ten.  Urls may hold spaces, so the fields are taken from the right.  The
converter gives each record the WARC fields that ARC lacks: an identifier made from the
file's name and the record's place in it, an ISO timestamp, a type and SHA-1 digests.

Records are written by Spark's text sink with the format's own record separator, so the
files appear by the commit protocol and a lost task leaves no half of a file; they are
read as whole files of at most ``FILE_RECORDS`` records and parsed record by record.

Defined results: a null url becomes ``urn:page:`` and the id; null html is an empty payload
and counts as one; of equal payloads the smallest page id is the response, and rows that
repeat that id are responses too; a null id revisits if any id has the payload; an empty table
gives no files and an empty result; only page_id, url and html are read, so other columns cannot clash.
A record that ends before its declared length raises an error.
"""

import base64
import gzip
import hashlib
import io
import re
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from isoquilt.llm.common import small_side
from isoquilt.session import checkpoint_dir, cut

FILE_RECORDS = 4000
# Field names of the two ARC versions, and formats of the header lines.
FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
RECORD_TYPES = (
    "record_id string, warc_type string, url string, ip string, date string, content_type string, page_id long, "
    "payload_bytes long, payload_digest string, head_digest string, block_digest string, head binary, payload binary"
)
READ_TYPES = (
    "record_id string, warc_type string, page_id long, payload_bytes long, payload_digest string, refers_to string"
)


def _sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _bytes(text: Column) -> Column:
    return F.octet_length(text).cast("string")


def _place() -> Column:
    """Number of a row inside its partition."""
    return F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))


def write_arc(pages: DataFrame, path: str, file_records: int = FILE_RECORDS) -> None:
    """Write pages as gzipped ARC files; files of odd partitions are of version 2."""
    html = F.coalesce("html", F.lit(""))
    url = F.coalesce("url", F.concat(F.lit("urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("-"))))
    url = F.regexp_replace(url, r"[\x00-\x20\x7F]", "%20")
    date = F.date_format(F.timestamp_seconds(946684800 + F.coalesce(F.pmod("page_id", F.lit(1_000_000_000)), F.lit(0))), "yyyyMMddHHmmss")
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"),
        F.coalesce(F.concat(F.lit("X-Page-Id: "), F.col("page_id").cast("string"), F.lit("\r\n")), F.lit("")),
        F.lit("Content-Length: "), _bytes(html), F.lit("\r\n\r\n"), html,
    )
    rows = pages.select(url.alias("url"), date.alias("date"), http.alias("block"), _place().alias("place"))
    rows = rows.withColumn("v2", F.spark_partition_id() % 2 == 1)
    name = F.concat(F.lit("pages-"), F.spark_partition_id(), F.lit("-"), F.floor(F.col("place") / file_records), F.lit(".arc"))

    def line(target: Column, at: Column, kind: Column, length: Column) -> Column:
        middle = F.when(F.col("v2"), F.concat(F.lit(" 200 - - 0 "), name)).otherwise(F.lit(""))
        return F.concat(target, F.lit(" "), F.lit("192.0.2.1"), F.lit(" "), at, F.lit(" "), kind, middle, F.lit(" "), length, F.lit("\n"))

    about = F.when(F.col("v2"), F.lit(f"2 0 pages\n{FIELDS[2]}\n")).otherwise(F.lit(f"1 0 pages\n{FIELDS[1]}\n"))
    opening = F.concat(line(F.concat(F.lit("filedesc://"), name), F.col("date"), F.lit("text/plain"), _bytes(about)), about, F.lit("\n"))
    record = F.concat(line(F.col("url"), F.col("date"), F.lit("text/html"), _bytes(F.col("block"))), F.col("block"))
    value = F.when(F.col("place") % file_records == 0, F.concat(opening, record)).otherwise(record)
    rows.select(value.alias("value")).write.option("lineSep", "\n").option("compression", "gzip").option(
        "maxRecordsPerFile", file_records
    ).text(path)


def arc_records(stream) -> Iterator[tuple[int, list[str], bytes]]:
    """(place, fields, block) of every record of an ARC stream; 4 or 9 fields after the url.

    The place counts records.  The version that the latest ``filedesc`` names
    says how many fields a line has.
    """
    fields, place = 5, 0
    while line := stream.readline():
        if not line.strip():
            continue
        text = line.decode("utf-8", "replace").rstrip("\r\n")
        if text.startswith("filedesc://"):
            # the version stands in the record itself; its own line has that version's fields
            length = int(text.rsplit(" ", 1)[1])
            block = stream.read(length)
            version = int(block.split(b" ", 1)[0] or 1)
            fields = len(FIELDS[version].split())
        else:
            length = int(text.rsplit(" ", 1)[1])
            block = stream.read(length)
        if len(block) < length:
            raise ValueError(f"record {place} ends {length - len(block)} bytes early: {text[:200]}")
        yield place, text.rsplit(" ", fields - 1), block
        place += 1


def _warc_date(digits: str) -> str:
    d = (digits + "0" * 14)[:14]
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def _synthesised(name: str, place: int, fields: list[str], block: bytes, with_blocks: bool) -> tuple:
    url, ip, date, kind = fields[:4]
    http = block.startswith(b"HTTP/")
    cut_at = block.find(b"\r\n\r\n") + 4 if http else 0
    http = http and cut_at >= 4
    head, payload = (block[:cut_at], block[cut_at:]) if http else (b"", block)
    page = re.search(rb"\r\nX-Page-Id: (-?\d+)\r\n", head)
    warc_type = "warcinfo" if url.startswith("filedesc://") else "response" if http else "resource"
    return (
        uuid.uuid5(uuid.NAMESPACE_URL, f"{name}#{place}").urn,
        warc_type,
        url,
        ip,
        _warc_date(date),
        "application/http; msgtype=response" if http else kind,
        int(page[1]) if page else None,
        len(payload),
        _sha1(payload),
        _sha1(head) if with_blocks else None,
        _sha1(block) if with_blocks else None,
        head if with_blocks else None,
        payload if with_blocks else None,
    )


def _opened(content: bytes):
    raw = io.BytesIO(content)
    return gzip.GzipFile(fileobj=raw) if content[:2] == b"\x1f\x8b" else raw


def _frames(rows: Iterator[tuple], names: list[str], whole: int = 8 << 20) -> Iterator[pd.DataFrame]:
    """Rows in frames of about ``whole`` payload bytes."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += 500 + len(row[-1] or b"")
        if size >= whole:
            yield _frame(held, names)
            held, size = [], 0
    if held:
        yield _frame(held, names)


def _frame(rows: list[tuple], names: list[str]) -> pd.DataFrame:
    frame = pd.DataFrame(rows, columns=names, dtype=object)
    for c in ("page_id", "payload_bytes"):
        frame[c] = frame[c].astype("Int64")
    return frame


def _parsed(spark: SparkSession, path: str, types: str, parse) -> DataFrame:
    """Rows that ``parse(name, stream)`` gives for each file of a folder."""
    names = [x.split()[0] for x in types.split(", ")]

    def run(frames):
        def rows():
            for frame in frames:
                for name, content in zip(frame["path"], frame["content"]):
                    with _opened(content) as stream:
                        yield from parse(name, stream)

        yield from _frames(rows(), names)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select("path", "content").mapInPandas(run, types)


def read_arc(spark: SparkSession, path: str, with_blocks: bool = True) -> DataFrame:
    """ARC records of a folder as WARC fields; ``with_blocks`` False leaves the bytes out."""

    def parse(name, stream):
        for place, fields, block in arc_records(stream):
            yield _synthesised(name, place, fields, block, with_blocks)

    return _parsed(spark, path, RECORD_TYPES, parse)


def _first_of_equal(records: DataFrame, least_bytes: int) -> DataFrame:
    """(payload_digest, first_page, first_record) of payloads that several records have."""
    counted = records.where((F.col("warc_type") == "response") & (F.col("payload_bytes") >= least_bytes))
    equal = counted.groupBy("payload_digest").agg(
        F.count("*").alias("n"),
        F.min("page_id").alias("first_page"),
        F.min(F.struct(F.col("page_id").isNull(), "page_id", "record_id")).getField("record_id").alias("first_record"),
    )
    return equal.where("n > 1").drop("n")


def convert(spark: SparkSession, arc_path: str, warc_path: str, least_bytes: int = 0, file_records: int = FILE_RECORDS) -> None:
    """Convert the ARC files of a folder to gzipped WARC files."""
    equal = cut(_first_of_equal(read_arc(spark, arc_path, with_blocks=False), least_bytes))
    records = read_arc(spark, arc_path).where("warc_type <> 'warcinfo'")
    both = records.join(small_side(equal, equal.count()), "payload_digest", "left")
    later = (F.col("payload_bytes") >= least_bytes) & F.col("first_page").isNotNull() & (
        F.col("page_id").isNull() | (F.col("page_id") > F.col("first_page"))
    )
    revisit = F.coalesce((F.col("warc_type") == "response") & later, F.lit(False))
    both = both.withColumn("revisit", revisit).withColumn("place", _place())
    block = F.when(F.col("revisit"), F.col("head")).otherwise(F.concat("head", "payload"))

    def field(name: str, value) -> Column:
        return F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))

    of_revisit = F.concat(
        F.concat(F.lit("WARC-Refers-To: <"), F.col("first_record"), F.lit(">\r\n")),
        F.lit(f"WARC-Profile: {REVISIT_PROFILE}\r\n"),
    )
    header = F.concat(
        F.lit("WARC/1.0\r\n"),
        field("WARC-Type", F.when(F.col("revisit"), F.lit("revisit")).otherwise(F.col("warc_type"))),
        F.concat(F.lit("WARC-Record-ID: <"), F.col("record_id"), F.lit(">\r\n")),
        field("WARC-Date", F.col("date")),
        field("WARC-Target-URI", F.col("url")),
        field("WARC-IP-Address", F.col("ip")),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("payload_digest"), F.lit("\r\n")),
        field("WARC-Payload-Length", F.col("payload_bytes").cast("string")),
        F.concat(F.lit("WARC-Block-Digest: sha1:"), F.when(F.col("revisit"), F.col("head_digest")).otherwise(F.col("block_digest")), F.lit("\r\n")),
        F.when(F.col("revisit"), of_revisit).otherwise(F.lit("")),
        field("Content-Type", F.col("content_type")),
        field("Content-Length", F.octet_length(block).cast("string")),
        F.lit("\r\n"),
    )
    info = "software: arc converter\r\nformat: WARC file version 1.0\r\n"
    opening = F.concat(
        F.lit("WARC/1.0\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:uuid:"),
        F.regexp_replace(F.md5(F.concat("record_id", F.lit("info"))), "(.{8})(.{4})(.{4})(.{4})(.{12})", "$1-$2-$3-$4-$5"),
        F.lit(">\r\nWARC-Date: "), F.col("date"),
        F.lit(f"\r\nContent-Type: application/warc-fields\r\nContent-Length: {len(info)}\r\n\r\n{info}\r\n\r\n"),
    )
    head = F.when(F.col("place") % file_records == 0, F.concat(opening, header)).otherwise(header)
    value = F.concat(F.encode(head, "UTF-8"), block).cast("string")
    both.select(value.alias("value")).write.option("lineSep", "\r\n\r\n").option("compression", "gzip").option(
        "maxRecordsPerFile", file_records
    ).text(warc_path)


def warc_records(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """(named fields in lower case, block) of every record of a WARC stream."""
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not the beginning of a record: {line[:200]!r}")
        fields = {}
        while (line := stream.readline().strip()) and b":" in line:
            name, _, value = line.decode("utf-8", "replace").partition(":")
            fields[name.strip().lower()] = value.strip()
        length = int(fields["content-length"])
        block = stream.read(length)
        if len(block) < length:
            raise ValueError(f"{fields.get('warc-record-id')} ends {length - len(block)} bytes early")
        yield fields, block


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Response and revisit records of the WARC files of a folder.

    The digest and length of a response are those of the bytes that were read;
    a revisit has no payload of its own and names them in its header.
    """

    def parse(name, stream):
        for fields, block in warc_records(stream):
            kind = fields["warc-type"]
            if kind not in ("response", "revisit"):
                continue
            cut_at = block.find(b"\r\n\r\n") + 4
            page = re.search(rb"\r\nX-Page-Id: (-?\d+)\r\n", block[:cut_at])
            payload = block[cut_at:]
            digest = _sha1(payload) if kind == "response" else fields["warc-payload-digest"].removeprefix("sha1:")
            size = len(payload) if kind == "response" else int(fields["warc-payload-length"])
            refers = fields.get("warc-refers-to", "").strip("<>") or None
            yield fields["warc-record-id"].strip("<>"), kind, int(page[1]) if page else None, size, digest, refers

    return _parsed(spark, path, READ_TYPES, parse)


def archived(pages: DataFrame) -> DataFrame:
    """Pages through ARC files and WARC files and back: what the archives say of each page."""
    spark = pages.sparkSession
    folder = f"{checkpoint_dir(spark)}/archive-{uuid.uuid4().hex}"
    write_arc(pages.select("page_id", "url", "html"), f"{folder}/arc")
    convert(spark, f"{folder}/arc", f"{folder}/warc")
    back = cut(read_warc(spark, f"{folder}/warc"))
    # only responses that something refers to are looked up
    named = back.where("refers_to is not null").select(F.col("refers_to").alias("record_id")).distinct()
    owners = cut(back.join(named, "record_id", "left_semi").select(F.col("record_id").alias("refers_to"), F.col("page_id").alias("owner")))
    both = back.join(small_side(owners, owners.count()), "refers_to", "left")
    return both.select(
        "page_id", "payload_bytes", "payload_digest", F.col("warc_type").alias("record_type"), F.col("owner").alias("refers_to")
    )
