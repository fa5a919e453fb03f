"""BAM files written, indexed and read back by region."""

import json
import random

import pytest
from pyspark.sql import functions as F

from isoquilt.sources import bam
from isoquilt.sources.bam_index import Index, bin_of, bins_over

REFS = [("chr1", 5_000_000), ("chr2", 1_000_000), ("chrM", 16_000)]
COLUMNS = ["read_name", "flag", "rname", "pos", "mapq", "cigar", "seq"]


def _rows(n=6000):
    rng = random.Random(4)
    rows = []
    for k in range(n):
        name, size = rng.choice(REFS)
        spliced = rng.random() < 0.3
        cigar = f"5S40M{rng.randint(100, 60_000)}N35M" if spliced and name != "chrM" else "5S75M"
        rows.append((f"read{k}", rng.choice([0, 16]), name, rng.randint(0, size - 100), 60, cigar, "".join(rng.choice("ACGTN") for _ in range(80))))
    rows += [(f"un{k}", 4, None, -1, 0, "*", "ACGTA") for k in range(20)]
    order = {n: k for k, (n, _) in enumerate(REFS)}
    return sorted(rows, key=lambda r: (order.get(r[2], 9), r[3]))


def _span(row):
    import re

    along = sum(int(n) for n, o in re.findall(r"(\d+)([MDN=X])", row[5]))
    return row[3], row[3] + max(1, along)


@pytest.fixture(scope="module")
def written(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("bam") / "sorted")
    rows = _rows()
    df = spark.createDataFrame(rows, bam.SCHEMA)
    order = F.create_map(*[F.lit(x) for k, (n, _) in enumerate(REFS) for x in (n, k)])
    at = F.coalesce(order[F.col("rname")], F.lit(9))
    sorted_df = df.withColumn("at", at).repartitionByRange(3, "at", "pos").sortWithinPartitions("at", "pos").drop("at")
    bam.write_bam(sorted_df, path, REFS, "@HD\tVN:1.6\tSO:coordinate\n", index=True)
    return path, rows


def test_written_files_read_back_equal(spark, written):
    path, rows = written
    got = bam.read_bam(spark, path).select(*COLUMNS).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, rows))
    assert bam.bam_header(path) == ("@HD\tVN:1.6\tSO:coordinate\n", REFS)
    # a second write replaces the files and leaves nothing hidden
    bam.write_bam(spark.createDataFrame(rows[:50], bam.SCHEMA), path + "2", REFS)
    bam.write_bam(spark.createDataFrame(rows[:40], bam.SCHEMA), path + "2", REFS)
    assert bam.read_bam(spark, path + "2").count() == 40
    import os

    assert not [x for x in os.listdir(path + "2") if x.startswith("_temp")]


def test_records_keep_what_columns_do_not_show(spark, written):
    path, rows = written
    raw = bam.read_bam(spark, path, raw="true")
    bam.write_bam(raw.where("mapq = 60 AND rname = 'chr2'"), path + "-raw", REFS)
    again = {r.read_name: bytes(r.record) for r in bam.read_bam(spark, path + "-raw", raw="true").collect()}
    want = {r.read_name: bytes(r.record) for r in raw.where("rname = 'chr2'").collect()}
    assert again == want and len(want) > 1000


@pytest.mark.parametrize("regions", ["chr1:100001-200000", "chr2", "chr1:4999000-5000000,chrM:1-500", "chr1:1-2,chrX:5-9"])
def test_regions(spark, written, regions):
    path, rows = written
    asked = bam.parse_regions(regions)
    want = [r[0] for r in rows if any(r[2] == n and _span(r)[0] < high and _span(r)[1] > low for n, low, high in asked)]
    assert sorted(r.read_name for r in bam.read_bam(spark, path, regions=regions).collect()) == sorted(want)
    # without an index the same rows come from a full scan
    plain = path + "-plain"
    bam.write_bam(spark.createDataFrame(rows, bam.SCHEMA), plain, REFS)
    assert sorted(r.read_name for r in bam.read_bam(spark, plain, regions=regions).collect()) == sorted(want)


def test_pushed_filters(spark, written):
    path, rows = written
    df = bam.read_bam(spark, path).where("rname = 'chr1' AND pos >= 1000000 AND pos < 1100000 AND mapq > 3")
    want = sorted(r[0] for r in rows if r[2] == "chr1" and 1_000_000 <= r[3] < 1_100_000)
    assert sorted(r.read_name for r in df.collect()) == want and len(want) > 10
    two = bam.read_bam(spark, path).where("rname IN ('chrM', 'chr2') AND pos BETWEEN 10 AND 9000")
    assert two.count() == sum(r[2] in ("chrM", "chr2") and 10 <= r[3] <= 9000 for r in rows)


def test_a_region_reads_its_chunks_only(tmp_path, monkeypatch):
    rows = _rows(4000)
    monkeypatch.setattr(bam, "FULL", 3000)
    names = [c.split()[0] for c in bam.SCHEMA.split(", ")]
    writer = bam.BamWriter({"path": str(tmp_path), "references": json.dumps(REFS), "index": "true"}, False)
    writer.commit([writer.write(iter(dict(zip(names, r)) for r in rows))])
    seen = []
    blocks = bam.blocks

    def counted(handle, low):
        for offset, content in blocks(handle, low):
            seen.append(offset)
            yield offset, content

    monkeypatch.setattr(bam, "blocks", counted)

    def read(**options):
        reader = bam.BamReader({"path": str(tmp_path), **options})
        parts = reader.partitions()
        seen.clear()
        return [r for part in parts for r in reader.read(part)], len(seen), len(parts)

    whole, every, _ = read()
    some, few, _ = read(regions="chr1:2000001-2016000")
    assert len(whole) == len(rows) and 0 < len(some) < 60
    # spliced records put a few stretches of larger bins among those of the region
    assert every > 150 and few < every / 5
    pieces, _, parts = read(regions="chr1", splitBytes="5000")
    assert len(pieces) == sum(r[2] == "chr1" for r in rows) and parts > 3


def test_paths_are_uris_too(spark, written):
    path, rows = written
    assert bam.read_bam(spark, "file://" + path).count() == len(rows)
    with pytest.raises(Exception, match="nowhere"):
        bam.read_bam(spark, path + "/nowhere").count()


def test_bins():
    assert bin_of(0, 1) == 4681 and bin_of(0, 1 << 29) == 0 and bin_of(16383, 16385) == 585
    for begin, end in ((0, 1), (5, 20_000), (16_384, 16_385), (1 << 20, 1 << 24)):
        over = bins_over(begin, end)
        assert any(bin_of(begin, end) in r for r in over)
    with pytest.raises(ValueError):
        Index(b"nope")


def test_unsorted_rows_have_no_index(spark, tmp_path):
    rows = [("a", 0, "chr1", 500, 60, "5M", "ACGTA"), ("b", 0, "chr1", 100, 60, "5M", "ACGTA")]
    with pytest.raises(Exception, match="sorted"):
        bam.write_bam(spark.createDataFrame(rows, bam.SCHEMA).coalesce(1), str(tmp_path / "x"), REFS, index=True)
    assert not list((tmp_path / "x").glob("*.bam"))
