"""Splice-site correction and isoform voting on weighted nodes.

Input rows are nodes (gene, cell, cluster, isoform, n, n_polya).  Per-isoform
work is done on the distinct splice patterns of a gene; voting runs on rows already
combined by their splice pattern, as windows over a molecule.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from isoquilt.config import UmiConfig
from isoquilt.functions import intervals
from isoquilt.session import cut

MOLECULE = ["gene", "cell", "cluster"]
#: Sites of all genes that go to every task (64 MB); beyond, nodes are joined with them by gene.
BROADCAST_SITES = 8_000_000


def site_counts(nodes: DataFrame) -> DataFrame:
    """Reads per internal splice site of a gene."""
    iso = nodes.groupBy("gene", "isoform").agg(F.sum("n").alias("n"))
    sites = iso.select("gene", "n", F.explode(intervals.inner_sites(F.col("isoform"))).alias("site"))
    return sites.groupBy("gene", "site").agg(F.sum("n").alias("reads"))


def gene_sites(nodes: DataFrame, cfg: UmiConfig = UmiConfig()) -> DataFrame:
    """Per gene its frequent sites, sorted, as far as isoforms without an infrequent one hold them.

    Isoforms of a gene with the same internal sites are taken together first.  A gene without such sites has no row.
    """
    inner = intervals.inner_sites(F.col("isoform")).alias("inner")
    patterns = cut(nodes.select("gene", inner, "n").groupBy("gene", "inner").agg(F.sum("n").alias("n")))
    reads = patterns.select("gene", "n", F.explode("inner").alias("site")).groupBy("gene", "site").agg(F.sum("n").alias("reads"))
    usable = reads.where(F.col("reads") >= cfg.site_thresh).groupBy("gene").agg(F.collect_list("site").alias("usable"))
    kept = patterns.join(usable, "gene").where(F.size(F.array_except("inner", "usable")) == 0)
    return cut(
        kept.select("gene", F.explode("inner").alias("site")).groupBy("gene").agg(F.sort_array(F.collect_set("site")).alias("sites"))
    )


def _patterned(isoforms: DataFrame, sites: DataFrame) -> DataFrame:
    """Rows whose isoform holds nothing but the sites of its gene, with start, end, internal sites and ``mid``."""
    entries = sites.agg(F.coalesce(F.sum(1 + F.size("sites")), F.lit(0))).first()[0]
    side = F.broadcast(sites) if entries <= BROADCAST_SITES else sites
    placed = isoforms.where("gene is not null").join(side, "gene", "left").withColumn("inner", intervals.inner_sites(F.col("isoform")))
    fits = (F.size("inner") == 0) | F.coalesce(F.size(F.array_except("inner", "sites")) == 0, F.lit(False))
    mid = F.array_join(F.transform("sites", lambda s: F.array_contains("inner", s).cast("int").cast("string")), "")
    start, end = intervals.first_site(F.col("isoform")), intervals.last_site(F.col("isoform"))
    return placed.where(fits).withColumns({"start": start, "end": end, "mid": mid}).drop("sites")


def splice_table(nodes: DataFrame, cfg: UmiConfig = UmiConfig()) -> DataFrame:
    """Per gene and isoform: start, end, internal sites, and ``mid``, the 0/1 text over
    the gene's frequent sites.  Isoforms with an infrequent internal site are left out;
    ``mid`` is null in genes without any frequent site."""
    isoforms = nodes.select("gene", "isoform").distinct()
    return _patterned(isoforms, gene_sites(nodes, cfg)).select("gene", "isoform", "start", "end", "inner", "mid")


def voters(nodes: DataFrame, cfg: UmiConfig = UmiConfig(), sites: DataFrame | None = None) -> DataFrame:
    """Nodes combined by (molecule, splice pattern, start, end); ``sites``: the ``gene_sites`` of the nodes, if known.

    Nodes that are laid out by molecule stay so as long as the sites of all genes go to every task.
    """
    return (
        _patterned(nodes, gene_sites(nodes, cfg) if sites is None else sites)
        .withColumn("mid", F.coalesce("mid", F.lit("null")))
        .groupBy(*MOLECULE, "mid", "inner", "start", "end")
        .agg(F.sum("n").alias("n"), F.sum("n_polya").alias("n_polya"))
    )


def pattern_modes(votes: DataFrame) -> DataFrame:
    """Per molecule its patterns, their reads, and the most read pattern (ties: first in text order)."""
    counts = votes.groupBy(*MOLECULE, "mid").agg(F.sum("n").alias("n"))
    first = F.min(F.struct((-F.col("n")).alias("r"), "mid")).over(W.partitionBy(*MOLECULE))
    return counts.withColumn("mode", first["mid"])


def supported_patterns(modes: DataFrame, cfg: UmiConfig = UmiConfig()) -> DataFrame:
    """Patterns of a gene read mostly in molecules they lead."""
    led = F.sum(F.when(F.col("mid") == F.col("mode"), F.col("n")).otherwise(F.lit(0)))
    other = F.sum(F.when(F.col("mid") != F.col("mode"), F.col("n")).otherwise(F.lit(0)))
    sums = modes.groupBy("gene", "mid").agg(led.alias("led"), other.alias("other"))
    return sums.where((F.col("led") > 0) & (F.col("led") >= cfg.mid_support * F.col("other")))


def correct_molecules(votes: DataFrame, cfg: UmiConfig = UmiConfig()) -> DataFrame:
    """One row per molecule that holds a supported pattern: corrected start, pattern, end, size, polyA."""
    good = cut(supported_patterns(pattern_modes(votes), cfg).select("gene", "mid", F.lit(True).alias("good")))
    if good.count() <= BROADCAST_SITES // 8:
        good = F.broadcast(good)

    def total(*keys, of="n"):
        return F.sum(of).over(W.partitionBy(*MOLECULE, *keys))

    molecule = W.partitionBy(*MOLECULE)
    judged = votes.join(good, ["gene", "mid"], "left").withColumns({"size": total(), "of_mid": total("mid")})
    lead = F.min(F.when(F.col("good"), F.struct((-F.col("of_mid")).alias("r"), "mid"))).over(molecule)
    chosen = judged.withColumn("lead", lead["mid"]).where("mid = lead").drop("lead", "good", "of_mid")
    chosen = chosen.withColumns({"of_start": total("start"), "of_end": total("start", "end")})
    start = F.min(F.struct((-F.col("of_start")).alias("r"), "start")).over(molecule)
    chosen = chosen.withColumn("first", start["start"])
    end = F.max(F.when(F.col("start") == F.col("first"), F.struct("of_end", "end")))
    tail = F.sum("n_polya") / F.sum("n")
    merged = chosen.groupBy(*MOLECULE, "mid", "inner", "first", "size").agg(end["end"].alias("last"), tail.alias("polyA"))
    isoform = recover_isoform(F.col("first"), F.col("inner"), F.col("last"))
    return merged.select(*MOLECULE, "mid", isoform.alias("isoform"), "size", "polyA")


def selected_sites(mid: Column, sites: Column) -> Column:
    """Sites whose digit in ``mid`` is 1."""
    return F.filter(sites, lambda s, i: F.substring(mid, i + 1, F.lit(1)) == "1")


def recover_isoform(start: Column, inner: Column, end: Column) -> Column:
    """Start, internal sites and end paired into ``s,e|s,e``."""
    everything = F.concat(F.array(start), inner, F.array(end))
    return intervals.let(
        everything,
        lambda a: F.array_join(
            F.transform(
                F.sequence(F.lit(0), F.floor(F.size(a) / 2).cast("int") - 1),
                lambda i: F.concat_ws(",", F.get(a, i * 2), F.get(a, i * 2 + 1)),
            ),
            "|",
        ),
    )


def error_ratio(reads: DataFrame, cfg: UmiConfig = UmiConfig(), n: str | None = None, wrong: str | None = None) -> float:
    """Share of all reads whose barcode needed more than ``edit_error`` edits.

    Of combined reads ``n`` and ``wrong`` name their number and that of such reads.
    """
    if n:
        share = reads.agg(F.try_divide(F.sum(wrong), F.sum(n))).first()[0]
    else:
        share = reads.agg(F.avg((F.col("edit") > cfg.edit_error).cast("double"))).first()[0]
    return float(share or 0.0)
