"""Clustering and size filters against the true molecules, for a grid of settings at once."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isoquilt.config import UmiConfig
from isoquilt.operators import sizes, umi
from isoquilt.session import cut


def middle_cells(reads: DataFrame, by: list) -> DataFrame:
    """(by, cell): of each setting the cell whose number of reads is nearest to their mean (ties by name)."""
    n = reads.groupBy(*by, "cell").agg(F.count("*").alias("n"))
    mean = n.groupBy(*by).agg(F.avg("n").alias("mean"))
    pick = F.min(F.struct(F.abs(F.col("n") - F.col("mean")).alias("far"), "cell"))
    return n.join(mean, by).groupBy(*by).agg(pick.alias("p")).select(*by, "p.cell")


def cluster_evaluation(reads: DataFrame, by: list, cfg: UmiConfig = UmiConfig(), pcr_alpha: float = 0.2) -> DataFrame:
    """One row for each setting: reads, true molecules, clusters, and what each filter leaves of the clusters.

    ``reads`` are cell-exon reads with the columns ``by``, whose settings are clustered apart, and the true ``molecule``.  A setting is judged
    at its middle cell, with its own share of reads of more than one edit as the error ratio.
    """
    ratio = reads.groupBy(*by).agg(F.avg((F.col("edit") > 1).cast("double")).alias("ratio"))
    names = reads.withColumn("cell", F.col("barcode"))
    some = cut(names.join(middle_cells(names, by), [*by, "cell"], "left_semi").join(ratio, by))
    # a setting is a gene of its own; all molecules of the cell are clustered, whatever their isoform
    apart = some.withColumns({"gene": F.to_json(F.struct(*by)), "isoform": F.lit("1,2")})
    placed = umi.with_umi(apart, cfg).where(F.length("umi") == cfg.umi_len + 2 * cfg.flank)
    nodes = umi.cluster(cut(umi.compress(placed)), cfg)
    sized = nodes.groupBy("gene", "cell", "cluster").agg(F.sum("n").alias("size"))
    settings = placed.groupBy("gene", "cell", *by, "ratio").agg(F.count("*").alias("raw"), F.count_distinct("molecule").alias("real"))
    keys = [*by, "ratio"]
    sized = cut(sized.join(settings.select("gene", "cell", *keys), ["gene", "cell"]).select(*keys, "size"))
    dedup = sized.groupBy(*keys).agg(F.count("*").alias("dedup"))
    pcr = sizes.count_by_pcr(sized, keys, pcr_alpha).withColumnRenamed("molecules", "filter_pcr")
    error = sizes.count_by_error(sized, keys, "ratio").withColumnRenamed("molecules", "filter_error")
    votes = sizes.noise_votes(sized, keys, "ratio", cfg.size_alpha)
    noise = sized.join(votes, [*keys, "size"]).groupBy(*keys).agg(F.sum("vote").alias("noise"))
    out = settings.select(*keys, "raw", "real").join(dedup, keys).join(pcr, keys, "left").join(error, keys).join(noise, keys)
    return out.select(*by, "raw", "real", "dedup", "filter_pcr", "filter_error", (F.col("dedup") - F.col("noise")).alias("filter_total"))
