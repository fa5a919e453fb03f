"""Readers with explicit schemas; each has a ``parse_*`` twin working on lines already loaded."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _field(line: str, n: int, sep: str = r"\t"):
    return F.get(F.split(line, sep), n - 1)


def parse_sam(lines: DataFrame) -> DataFrame:
    """SAM text lines (column ``value``) -> alignment records with 0-based positions."""
    cols = F.split("value", r"\t")
    return lines.where(~F.col("value").startswith("@")).select(
        cols[0].alias("read_name"),
        cols[1].cast("int").alias("flag"),
        cols[2].alias("rname"),
        (cols[3].cast("bigint") - 1).alias("pos"),
        cols[4].cast("int").alias("mapq"),
        cols[5].alias("cigar"),
        cols[9].alias("seq"),
    )


def read_sam(spark: SparkSession, path: str) -> DataFrame:
    return parse_sam(spark.read.text(path))


def parse_bed(lines: DataFrame) -> DataFrame:
    """Headerless gene parts ``chr start end width strand`` plus the ``gene`` column."""
    cols = F.split("value", " ")
    return lines.select(
        "gene",
        cols[0].alias("chr"),
        cols[1].cast("bigint").alias("start"),
        cols[2].cast("bigint").alias("end"),
        cols[3].cast("bigint").alias("width"),
        cols[4].alias("strand"),
    )


def read_gene_beds(spark: SparkSession, folder: str) -> DataFrame:
    """One text file per gene; the gene is the file name without its last four letters."""
    name = F.regexp_extract(F.input_file_name(), r"([^/]+).{4}$", 1)
    return parse_bed(spark.read.text(folder).withColumn("gene", name))


def parse_gtf(lines: DataFrame) -> DataFrame:
    """Exon records of GTF lines."""
    cols = F.split("value", r"\t")

    def attribute(key: str):
        return F.regexp_extract(cols[8], rf'(?:^|[;\s]){key}\s+"([^"]*)"', 1)

    return lines.where(~F.col("value").startswith("#") & (cols[2] == "exon")).select(
        cols[0].alias("chr"),
        cols[3].cast("bigint").alias("start"),
        cols[4].cast("bigint").alias("end"),
        cols[6].alias("strand"),
        attribute("gene_id").alias("gene_id"),
        attribute("transcript_id").alias("transname"),
        attribute("exon_id").alias("exon_id"),
    )


def read_gtf(spark: SparkSession, path: str) -> DataFrame:
    return parse_gtf(spark.read.text(path))


def parse_softclips(lines: DataFrame) -> DataFrame:
    """``name<TAB>sequence`` pairs."""
    cols = F.split("value", r"\s+")
    return lines.select(cols[0].alias("read_name"), cols[1].alias("seq"))


def read_softclips(spark: SparkSession, path: str) -> DataFrame:
    return parse_softclips(spark.read.text(path))


def parse_whitelist(lines: DataFrame) -> DataFrame:
    return lines.select(F.trim("value").alias("barcode")).where(F.col("barcode") != "").distinct()


def read_whitelist(spark: SparkSession, path: str) -> DataFrame:
    return parse_whitelist(spark.read.text(path))


# Column layouts of the whitespace-separated tables.
EXON_READS = "read_name string, seq string, gene string, isoform string, state double, polyA boolean, strand string"
BARCODE_MATCH = "id bigint, read_name string, barcode string, start double, edit int"
CELL_EXON = (
    "read_name string, barcode string, start double, edit int, seq string, gene string, isoform string, "
    "state double, polyA boolean, strand string"
)
SPLICE_COUNT = "cell string, isoform string, size bigint, cluster bigint, count double, polyA double, gene string"
EXON_COUNT = (
    "cell string, gene string, start bigint, exons string, end bigint, size bigint, cluster bigint, "
    "count double, polyA double"
)


def parse_table(lines: DataFrame, layout: str, header: bool = False) -> DataFrame:
    """Whitespace-separated lines -> typed columns by position; a header line repeats the first name."""
    fields = [f.strip().split() for f in layout.split(",")]
    cols = F.split(F.trim("value"), r"\s+")
    if header:
        lines = lines.where(cols[0] != fields[0][0])
    return lines.select(*[cols[i].cast(kind).alias(name) for i, (name, kind) in enumerate(fields)])


def read_table(spark: SparkSession, path: str, layout: str, header: bool = False) -> DataFrame:
    return parse_table(spark.read.text(path), layout, header)


def read_store(spark: SparkSession, path: str, columns: list | None = None) -> DataFrame:
    """Tables kept between runs live as Parquet."""
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df
