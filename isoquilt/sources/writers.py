"""Sinks: partitioned tables, text tables, the matrix bundle, FASTQ, alignment subsets."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F



def write_by_gene(df: DataFrame, path: str) -> None:
    """Parquet partitioned by gene, rows of a gene laid out together."""
    df.repartition("gene").write.mode("overwrite").partitionBy("gene").parquet(path)


def write_table(df: DataFrame, path: str, sep: str = "\t", header: bool = True) -> None:
    """Delimited text, one file per partition."""
    df.write.mode("overwrite").csv(path, sep=sep, header=header, quote="")


def write_store(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_gene_beds(bed: DataFrame, path: str) -> None:
    """Gene parts as space-separated text, one folder per gene."""
    line = F.concat_ws(" ", "chr", "start", "end", "width", "strand").alias("value")
    rows = bed.repartition("gene").sortWithinPartitions("gene", "start").select("gene", line)
    rows.write.mode("overwrite").partitionBy("gene").text(path)


def write_matrix_bundle(bundle: dict, path: str) -> None:
    """Sorted dictionaries and coded tables side by side under ``path``."""
    for name, column in (("barcodes", "cell"), ("features", "gene"), ("isoforms", "exons")):
        code = [c for c in bundle[name].columns if c != column][0]
        bundle[name].orderBy(code).select(column).write.mode("overwrite").text(f"{path}/{name}.tsv")
    write_table(bundle["matrix"].orderBy("cell_code", "gene_code"), f"{path}/matrix.mtx", sep=" ", header=False)
    write_table(bundle["isoform_count"], f"{path}/isoform_count.tsv", sep=" ")


def fastq_record(name: Column, seq: Column, qual: Column) -> Column:
    return F.concat_ws("\n", name, seq, F.lit("+"), qual)


def write_fastq(reads: DataFrame, path: str, compression: str = "gzip") -> None:
    """Four-line records from read_name, reads and qual."""
    record = fastq_record(F.col("read_name"), F.col("reads"), F.col("qual"))
    reads.select(record.alias("value")).write.mode("overwrite").text(path, compression=compression)


def alignment_subset(alignments: DataFrame, names: DataFrame, chrom: str, start: int, end: int) -> DataFrame:
    """Alignments of listed reads inside a region."""
    region = alignments.where((F.col("rname") == chrom) & F.col("pos").between(start, end))
    return region.join(names, "read_name", "left_semi")


def write_split(rows: DataFrame, bins: DataFrame, path: str) -> None:
    """Rows with their gene's bin as the partition column."""
    rows.join(bins.select("gene", "bin"), "gene").repartition("bin").write.mode("overwrite").partitionBy("bin").parquet(path)


