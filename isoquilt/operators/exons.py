"""Exon mapping of isoforms, exon count tables, the coded matrix bundle and the splice object."""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from isoquilt.config import ExonConfig
from isoquilt.functions import intervals
from isoquilt.operators import annotation
from isoquilt.operators.extract import everywhere
from isoquilt.session import codes, cut


def map_bin(start: Column, end: Column, parts: Column, cfg: ExonConfig = ExonConfig()) -> Column:
    """Part ids covered by one block [start, end]; ``N`` marks unannotated stretches."""
    unknown = F.array(F.lit("N"))
    none = F.array().cast("array<string>")

    def walk(cand):
        def visit(p, i):
            begin = F.when(i == 0, start).otherwise(F.get(cand, i - 1)["e"] + 1)
            gap = p["s"] > begin + cfg.bias
            cover = F.least(p["e"], end) - F.when(gap, p["s"]).otherwise(begin) + 1
            share = cover / (p["e"] - p["s"] + 1)
            keep = (cover > cfg.min_cover) | (share >= cfg.min_share)
            return F.concat(
                F.when(gap, unknown).otherwise(none),
                F.when(keep, F.array(p["exon_id"].cast("string"))).otherwise(none),
            )

        rest = F.when(F.element_at(cand, -1)["e"] + 1 < end - cfg.bias, unknown).otherwise(none)
        return F.when(F.size(cand) == 0, unknown).otherwise(F.concat(F.flatten(F.transform(cand, visit)), rest))

    touching = F.filter(parts, lambda p: (p["s"] <= end) & (p["e"] >= start))
    return F.when(end < start, unknown).otherwise(intervals.let(touching, walk))


def map_isoform(blocks: Column, parts: Column, cfg: ExonConfig = ExonConfig()) -> Column:
    """``|``-joined part ids of an isoform; block ends lose their one extra base first."""
    return F.array_join(F.flatten(F.transform(blocks, lambda b: map_bin(b["s"], b["e"] - 1, parts, cfg))), "|")


def gene_parts(bed: DataFrame) -> DataFrame:
    """One row per gene with its sorted parts."""
    part = F.struct(F.col("start").alias("s"), F.col("end").alias("e"), "exon_id")
    return annotation.numbered_parts(bed).groupBy("gene").agg(F.sort_array(F.collect_list(part)).alias("parts"))


def isoform_exons(isoforms: DataFrame, bed: DataFrame, cfg: ExonConfig = ExonConfig()) -> DataFrame:
    """Exon text of every distinct (gene, isoform)."""
    distinct = isoforms.select("gene", "isoform").distinct()
    mapped = distinct.join(gene_parts(bed), "gene")
    blocks = intervals.parse_blocks(F.col("isoform"))
    return mapped.select("gene", "isoform", map_isoform(blocks, F.col("parts"), cfg).alias("exons"))


def exon_counts(counts: DataFrame, bed: DataFrame, cells=None, genes=None, cfg: ExonConfig = ExonConfig()) -> DataFrame:
    """Splice counts -> exon counts, optionally for some cells (column ``cell``) or genes (``gene``)."""
    if cells is not None:
        counts = counts.join(cells, "cell", "left_semi")
    if genes is not None:
        counts = counts.join(genes, "gene", "left_semi")
    # rows are mapped one by one where the parts of all genes go to every task; else each isoform once
    parts = cut(gene_parts(bed))
    side = everywhere(parts)
    if side is parts:
        mapped, exons = counts.join(isoform_exons(counts, bed, cfg), ["gene", "isoform"]), F.col("exons")
    else:
        mapped, exons = counts.join(side, "gene"), map_isoform(intervals.parse_blocks(F.col("isoform")), F.col("parts"), cfg)
    return mapped.select(
        "cell",
        "gene",
        intervals.first_site(F.col("isoform")).alias("start"),
        exons.alias("exons"),
        intervals.last_site(F.col("isoform")).alias("end"),
        "size",
        "cluster",
        "count",
        "polyA",
    )


def matrix_bundle(exon_count: DataFrame) -> dict:
    """Tables of the sparse bundle: sorted dictionaries, coded gene counts, coded isoform counts."""
    data = cut(exon_count)
    cells, genes = codes(data, "cell", "cell_code"), codes(data, "gene", "gene_code")
    isoforms = codes(data, "exons", "exons_code")
    coded = data.join(cells, "cell").join(genes, "gene").join(isoforms, "exons")
    matrix = coded.groupBy("cell_code", "gene_code").agg(F.sum("count").alias("count"))
    rows = coded.select(
        F.col("cell_code").alias("cell"),
        F.col("gene_code").alias("gene"),
        "start",
        F.col("exons_code").alias("exons"),
        "end",
        "size",
        "cluster",
        "count",
        "polyA",
    )
    return {"barcodes": cells, "features": genes, "isoforms": isoforms, "matrix": matrix, "isoform_count": rows}


@dataclass
class SpliceObject:
    """Cells, genes and isoform rows of one data set."""

    cells: DataFrame
    genes: DataFrame
    isoforms: DataFrame


def _summaries(data: DataFrame, total: Column) -> tuple[DataFrame, DataFrame]:
    cells = data.groupBy("cell").agg(F.count_distinct("gene").alias("gene_count"), total.alias("umi_count"))
    genes = data.groupBy("gene").agg(F.count_distinct("cell").alias("cell_count"), total.alias("total_exprs"))
    return cells, genes


def splice_object_from_counts(counts: DataFrame, bed: DataFrame) -> SpliceObject:
    """From splice counts; summaries count rows."""
    data = exon_counts(counts, bed)
    cells, genes = _summaries(data, F.count("*"))
    rows = data.join(codes(data, "cell", "cell_id"), "cell")
    return SpliceObject(cells, genes, rows.select("cell", "cell_id", "gene", "start", "exons", "end", "polyA", "size"))


def splice_object(exon_count: DataFrame, cells=None, genes=None) -> SpliceObject:
    """From exon counts; summaries add up ``count``."""
    if cells is not None:
        exon_count = exon_count.join(cells, "cell", "left_semi")
    if genes is not None:
        exon_count = exon_count.join(genes, "gene", "left_semi")
    cell_table, gene_table = _summaries(exon_count, F.sum("count"))
    return SpliceObject(cell_table, gene_table, exon_count.join(codes(exon_count, "cell", "cell_id"), "cell"))


def gene_isoforms(obj: SpliceObject, gene: str) -> DataFrame:
    return obj.isoforms.where(F.col("gene") == gene)


def to_frame(obj: SpliceObject) -> DataFrame:
    """All isoform rows with cell and gene names first."""
    rest = [c for c in obj.isoforms.columns if c not in ("cell", "gene", "cell_id")]
    return obj.isoforms.select("cell", "gene", *rest)


def subset(obj: SpliceObject, cells=None, genes=None) -> SpliceObject:
    """Part of an object; summaries and cell codes are made anew, empty cells and genes go."""
    if cells is None and genes is None:
        return obj
    return splice_object(obj.isoforms.drop("cell_id"), cells, genes)
