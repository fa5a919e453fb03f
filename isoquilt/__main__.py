"""Command line: ``python -m isoquilt <stage> ...`` (each stage reads and writes tables)."""

import argparse

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from isoquilt.config import BarcodeConfig, ExonConfig, ReadConfig, UmiConfig
from isoquilt.operators import annotation, barcode, exons, extract, psi
from isoquilt.plans import longread
from isoquilt.sources import bam, readers, writers


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="isoquilt")
    stages = p.add_subparsers(dest="stage", required=True)

    def stage(name, *needed):
        s = stages.add_parser(name)
        for option in needed:
            s.add_argument("--" + option, required=True)
        s.add_argument("--out", "-o", required=True)
        return s

    stage("annotate", "gtf")
    s = stage("extract", "bam", "bed")
    s.add_argument("--toolkit", "-t", type=int, choices=(3, 5), default=5)
    s.add_argument("--regions", help="chr1:101-200,chr2: alignments that overlap these; an index is used where there is one")
    s = stage("subset", "bam", "names", "regions")
    s.add_argument("--sort", action="store_true", help="sort the records, so that the files get an index")
    s = stage("match", "reads", "whitelist")
    s.add_argument("--cos-thresh", type=float, default=0.25)
    s.add_argument("--top", type=int, default=8)
    s = stage("count", "cells")
    for option, default in (("sim-thresh", 5), ("blen", 16), ("ulen", 10), ("flank", 1), ("site-thresh", 10)):
        s.add_argument("--" + option, type=int, default=default)
    s = stage("cluster", "cells")
    for option, default in (("sim-thresh", 5), ("blen", 16), ("ulen", 10), ("flank", 1)):
        s.add_argument("--" + option, type=int, default=default)
    s = stage("recount", "clusters")
    s.add_argument("--ratio", type=float, help="share of reads of noisy barcodes; by default the one saved with the clusters")
    s.add_argument("--site-thresh", type=int, default=10)
    s.add_argument("--alpha", type=float, default=0.05)
    stage("exons", "counts", "bed")
    stage("matrix", "exons")
    s = stage("psi", "exons", "bed")
    s.add_argument("--cells", help="text file of the cells to keep")
    s.add_argument("--min-exprs", type=int, default=10)
    s = stage("phi", "psi")
    s.add_argument("--min-cells", type=int, default=30)
    s.add_argument("--iters", type=int, default=100)
    s = stage("run", "bam", "bed", "whitelist")
    s.add_argument("--toolkit", "-t", type=int, choices=(3, 5), default=5)
    return p


def alignments(spark, path, **options):
    return bam.read_bam(spark, path, **options) if path.endswith("bam") else readers.read_sam(spark, path)


def main(argv=None) -> None:
    opt = parser().parse_args(argv)
    spark = SparkSession.builder.appName("isoquilt").getOrCreate()
    store = lambda path: readers.read_store(spark, path)
    if opt.stage == "annotate":
        gtf = readers.read_gtf(spark, opt.gtf)
        writers.write_store(annotation.disjoint_parts(gtf), opt.out + "/gene_bed")
        writers.write_store(annotation.exon_dictionary(gtf), opt.out + "/exon_gtf")
    elif opt.stage == "extract":
        options = {"regions": opt.regions} if opt.regions else {}
        reads = extract.exon_reads(alignments(spark, opt.bam, **options), store(opt.bed), ReadConfig(toolkit=opt.toolkit))
        writers.write_store(reads, opt.out)
    elif opt.stage == "subset":
        names = spark.read.text(opt.names).select(F.trim("value").alias("read_name")).distinct()
        text, references = bam.bam_header(opt.bam)
        some = bam.read_bam(spark, opt.bam, regions=opt.regions, raw="true").join(names, "read_name", "left_semi")
        if opt.sort:
            order = F.create_map(*[F.lit(x) for k, (n, _) in enumerate(references) for x in (n, k)])[F.col("rname")]
            some = some.withColumn("_at", order).sort("_at", "pos").drop("_at")
        bam.write_bam(some, opt.out, references, text, index=opt.sort)
    elif opt.stage == "match":
        cfg = BarcodeConfig(cos_thresh=opt.cos_thresh, top=opt.top)
        reads = store(opt.reads)
        found = barcode.match_barcodes(reads.select("read_name", "seq"), readers.read_whitelist(spark, opt.whitelist), cfg)
        writers.write_store(barcode.assign_cells(found, reads, cfg), opt.out)
    elif opt.stage == "count":
        cfg = UmiConfig(
            sim_thresh=opt.sim_thresh, barcode_len=opt.blen, umi_len=opt.ulen, flank=opt.flank,
            site_thresh=opt.site_thresh, min_reads=opt.site_thresh,
        )
        writers.write_store(longread.count_molecules(store(opt.cells), cfg), opt.out)
    elif opt.stage == "cluster":
        cfg = UmiConfig(sim_thresh=opt.sim_thresh, barcode_len=opt.blen, umi_len=opt.ulen, flank=opt.flank)
        clustered, ratio = longread.cluster_reads(store(opt.cells), cfg)
        writers.write_store(clustered.withColumn("ratio", F.lit(ratio)), opt.out)
    elif opt.stage == "recount":
        clustered = store(opt.clusters)
        ratio = opt.ratio if opt.ratio is not None else (clustered.agg(F.max("ratio")).first()[0] or 0.0)
        cfg = UmiConfig(site_thresh=opt.site_thresh, size_alpha=opt.alpha)
        writers.write_store(longread.recount_clusters(clustered.drop("ratio"), ratio, cfg), opt.out)
    elif opt.stage == "exons":
        writers.write_store(exons.exon_counts(store(opt.counts), store(opt.bed)), opt.out)
    elif opt.stage == "matrix":
        writers.write_matrix_bundle(exons.matrix_bundle(store(opt.exons)), opt.out)
    elif opt.stage == "psi":
        cells = spark.read.text(opt.cells).select(F.trim("value").alias("cell")) if opt.cells else None
        cfg = ExonConfig(min_exprs=opt.min_exprs)
        writers.write_store(psi.gene_psi(store(opt.exons), store(opt.bed), cfg=cfg, cells=cells), opt.out)
    elif opt.stage == "phi":
        writers.write_store(psi.gene_phi(store(opt.psi), ExonConfig(min_cells=opt.min_cells, iters=opt.iters)), opt.out)
    elif opt.stage == "run":
        cfg = longread.LongReadConfig(reads=ReadConfig(toolkit=opt.toolkit))
        whitelist = readers.read_whitelist(spark, opt.whitelist)
        for name, table in longread.run(alignments(spark, opt.bam), store(opt.bed), whitelist, cfg).items():
            writers.write_store(table, f"{opt.out}/{name}")


if __name__ == "__main__":
    main()
