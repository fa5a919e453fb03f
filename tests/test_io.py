"""Sources, sinks, the stream, the command line."""

import pytest
import struct
import zlib

from pyspark.sql import functions as F

from isoquilt.__main__ import parser
from isoquilt.operators import exons
from isoquilt.sources import bam, readers, writers


def _bgzf(data: bytes, size: int) -> bytes:
    out = b""
    for at in list(range(0, len(data), size)) + [None]:
        part = b"" if at is None else data[at : at + size]
        packer = zlib.compressobj(6, zlib.DEFLATED, -15)
        body = packer.compress(part) + packer.flush()
        head = b"\x1f\x8b\x08\x04" + b"\0" * 4 + b"\0\xff" + struct.pack("<H", 6) + b"BC\x02\x00"
        out += head + struct.pack("<H", len(body) + 25) + body + struct.pack("<II", zlib.crc32(part), len(part))
    return out


def _record(name: str, ref: int, pos: int, cigar, seq: str, flag=0, mapq=60) -> bytes:
    codes = "=ACMGRSVTWYHKDBN"
    ops = b"".join(struct.pack("<I", n << 4 | "MIDNSHP=X".index(o)) for n, o in cigar)
    padded = seq + ("=" if len(seq) % 2 else "")
    packed = bytes(codes.index(padded[i]) << 4 | codes.index(padded[i + 1]) for i in range(0, len(padded), 2))
    label = name.encode() + b"\0"
    body = struct.pack("<iiBBHHHiiii", ref, pos, len(label), mapq, 4680, len(cigar), flag, len(seq), -1, -1, 0)
    body += label + ops + packed + b"\xff" * len(seq)
    return struct.pack("<i", len(body)) + body


def test_bam_in_many_splits(spark, tmp_path):
    head = b"@HD\tVN:1.6\n"
    refs = struct.pack("<i", 2) + b"".join(
        struct.pack("<i", len(n) + 1) + n + b"\0" + struct.pack("<i", 10**6) for n in (b"chr1", b"chr2")
    )
    data = b"BAM\1" + struct.pack("<i", len(head)) + head + refs
    want = []
    for i in range(3000):
        seq = ("ACGT" * 60)[i % 7 : i % 7 + 150]
        data += _record(f"read{i}", i % 2, 100 + i, [(20, "S"), (130, "M")], seq)
        want.append((f"read{i}", f"chr{i % 2 + 1}", 100 + i, "20S130M", seq))
    path = str(tmp_path / "x.bam")
    with open(path, "wb") as f:
        f.write(_bgzf(data, 5000))
    for split in (1 << 26, 9000):
        df = bam.read_bam(spark, path, splitBytes=split).select("read_name", "rname", "pos", "cigar", "seq")
        assert sorted(map(tuple, df.collect())) == sorted(want)


def test_text_sources(spark, tmp_path):
    folder = tmp_path / "bed"
    folder.mkdir()
    (folder / "ENSG00000000001.txt").write_text("chr1 100 120 21 +\nchr1 200 230 31 +\n")
    rows = readers.read_gene_beds(spark, str(folder)).orderBy("start").collect()
    assert [tuple(r) for r in rows][0] == ("ENSG00000000001", "chr1", 100, 120, 21, "+")
    (tmp_path / "wl.txt").write_text("ACGT\nTTTT\n")
    assert readers.read_whitelist(spark, str(tmp_path / "wl.txt")).count() == 2
    (tmp_path / "t.txt").write_text("id read_name barcode start edit\n1 r1 ACGT 3.5 2\n")
    row = readers.read_table(spark, str(tmp_path / "t.txt"), readers.BARCODE_MATCH, header=True).first()
    assert tuple(row) == (1, "r1", "ACGT", 3.5, 2)


def test_sinks(spark, tmp_path):
    rows = [("c2", "g1", 1, "1|2", 9, 3, 1, 1.5, 1.0), ("c1", "g1", 1, "1", 5, 3, 1, 1.0, 0.0)]
    df = spark.createDataFrame(rows, readers.EXON_COUNT)
    bundle = exons.matrix_bundle(df)
    writers.write_matrix_bundle(bundle, str(tmp_path / "m"))
    assert [r.value for r in spark.read.text(str(tmp_path / "m/barcodes.tsv")).collect()] == ["c1", "c2"]
    matrix = spark.read.text(str(tmp_path / "m/matrix.mtx")).collect()
    assert sorted(r.value for r in matrix) == ["1 1 1.0", "2 1 1.5"]
    writers.write_by_gene(df, str(tmp_path / "by"))
    assert spark.read.parquet(str(tmp_path / "by")).count() == 2
    reads = spark.createDataFrame([("@a", "ACGT", "IIII")], "read_name string, reads string, qual string")
    writers.write_fastq(reads, str(tmp_path / "fq"))
    assert [r.value for r in spark.read.text(str(tmp_path / "fq")).collect()] == ["@a", "ACGT", "+", "IIII"]
    bed = spark.createDataFrame([("g1", "chr1", 1, 5, 5, "+")], "gene string, chr string, start bigint, end bigint, width bigint, strand string")
    writers.write_gene_beds(bed, str(tmp_path / "beds"))
    assert spark.read.text(str(tmp_path / "beds")).first()["value"] == "chr1 1 5 5 +"


def test_command_line():
    opt = parser().parse_args(["count", "--cells", "x", "-o", "y", "--ulen", "12"])
    assert (opt.stage, opt.ulen, opt.blen) == ("count", 12, 16)


def test_damaged_blocks_are_errors():
    import io
    import struct
    import zlib

    from isoquilt.sources import bam

    def block(content):
        packer = zlib.compressobj(6, zlib.DEFLATED, -15)
        body = packer.compress(content) + packer.flush()
        head = struct.pack("<4BI2BH2BHH", 31, 139, 8, 4, 0, 0, 255, 6, 66, 67, 2, len(body) + 25)
        return head + body + struct.pack("<II", zlib.crc32(content), len(content))

    good = block(b"one" * 50) + block(b"two" * 50)
    assert [c for _, c in bam.blocks(io.BytesIO(good), 0)] == [b"one" * 50, b"two" * 50]
    for bad in (good[:-5], good + b"junk" * 10, block(b"one" * 50) + b"\0" * 40 + block(b"two" * 50)):
        with pytest.raises(ValueError):
            list(bam.blocks(io.BytesIO(bad), 0))
