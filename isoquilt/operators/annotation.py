"""Annotation: disjoint parts, splice sites, and how parts, exons and transcripts correspond.

Windows here run inside one gene or transcript, whose exon count the annotation bounds.
"""

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def disjoint_parts(exons: DataFrame) -> DataFrame:
    """Cut overlapping exons of a gene into disjoint parts.

    Break points are every start and every end + 1; a stretch between two
    neighbours is a part if some exon covers it, which a running count of opened
    minus closed exons tells without joining back to the exons.
    """
    gene = F.regexp_replace("gene_id", r"\..*$", "").alias("gene")
    opened = exons.select(gene, "chr", "strand", F.col("start").alias("at"), F.lit(1).alias("step"))
    closed = exons.select(gene, "chr", "strand", (F.col("end") + 1).alias("at"), F.lit(-1).alias("step"))
    keys = ["gene", "chr", "strand"]
    points = opened.unionByName(closed).groupBy(*keys, "at").agg(F.sum("step").alias("step"))
    w = W.partitionBy(*keys).orderBy("at")
    parts = points.withColumn("depth", F.sum("step").over(w)).withColumn("next_at", F.lead("at").over(w))
    return parts.where("depth > 0").select(
        "gene",
        "chr",
        F.col("at").alias("start"),
        (F.col("next_at") - 1).alias("end"),
        (F.col("next_at") - F.col("at")).alias("width"),
        "strand",
    )


def exon_dictionary(exons: DataFrame) -> DataFrame:
    """One row per distinct exon: gene (15 letters), its first transcript, its name."""
    return (
        exons.groupBy("chr", "start", "end", "strand", "exon_id")
        .agg(F.min(F.struct("gene_id", "transname")).alias("first"))
        .select(
            "start",
            "end",
            F.substring("first.gene_id", 1, 15).alias("gene_id"),
            F.col("first.transname").alias("transname"),
            "exon_id",
        )
    )


def numbered_parts(bed: DataFrame) -> DataFrame:
    """Add ``part`` (row number by start) and ``exon_id`` (reversed on the minus strand)."""
    up = W.partitionBy("gene").orderBy("start")
    down = W.partitionBy("gene").orderBy(F.col("start").desc())
    return (
        bed.withColumn("part", F.row_number().over(up).cast("bigint"))
        .withColumn("rank_down", F.row_number().over(down).cast("bigint"))
        .withColumn("exon_id", F.when(F.col("strand") == "+", F.col("part")).otherwise(F.col("rank_down")))
        .drop("rank_down")
    )


def merge_short_parts(bed: DataFrame, min_len: int = 10) -> DataFrame:
    """Give parts shorter than ``min_len`` to an adjacent neighbour, leftmost first.

    Each merge changes what the next one sees, so a gene is folded in order; a
    gene has as many rows as the annotation gives it.
    """

    def fold(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("start")
        ascending = len(pdf) < 2 or pdf["exon_id"].iloc[0] < pdf["exon_id"].iloc[1]
        rows = [[int(s), int(e)] for s, e in zip(pdf["start"], pdf["end"])]
        while True:
            short = next((i for i, (s, e) in enumerate(rows) if e - s + 1 < min_len), None)
            if short is None:
                break
            s, e = rows.pop(short)
            left = rows[short - 1] if short > 0 else None
            right = rows[short] if short < len(rows) else None
            touches_left = left is not None and left[1] + 1 == s
            touches_right = right is not None and right[0] - 1 == e
            if touches_left and touches_right:
                if left[1] - left[0] <= right[1] - right[0]:
                    touches_right = False
                else:
                    touches_left = False
            if touches_left:
                left[1] = e
            elif touches_right:
                right[0] = s
        out = pd.DataFrame(rows, columns=["start", "end"])
        ids = range(1, len(rows) + 1)
        out["exon_id"] = list(ids) if ascending else list(reversed(ids))
        out["length"] = out["end"] - out["start"] + 1
        out.insert(0, "gene", pdf["gene"].iloc[0])
        return out

    return (
        bed.select("gene", "start", "end", "exon_id")
        .groupBy("gene")
        .applyInPandas(fold, "gene string, start bigint, end bigint, exon_id bigint, length bigint")
    )


def splice_sites(bed: DataFrame) -> DataFrame:
    """Annotated splice sites: every end, and every start that does not continue the previous part."""
    w = W.partitionBy("gene").orderBy("start")
    prev = F.lag("end").over(w)
    marked = bed.select("gene", "start", "end", (prev.isNull() | (prev + 1 != F.col("start"))).alias("opens"))
    sites = F.when(F.col("opens"), F.array("start", "end")).otherwise(F.array("end"))
    return marked.select("gene", F.explode(sites).alias("site"))


def mapping_error(spans: DataFrame, bed: DataFrame) -> DataFrame:
    """Share of reads (gene, start, end) that begin before or end after their gene."""
    bounds = bed.groupBy("gene").agg(F.min("start").alias("gene_start"), F.max("end").alias("gene_end"))
    outside = (F.col("start") < F.col("gene_start")) | (F.col("end") > F.col("gene_end"))
    return (
        spans.join(bounds, "gene")
        .groupBy("gene")
        .agg(F.avg(outside.cast("double")).alias("map_error"), F.count("*").alias("reads"))
    )


def exons_within(ranges: DataFrame, parts: DataFrame) -> DataFrame:
    """Ids of parts lying completely inside each (gene, start, end) range."""
    p = parts.select("gene", "exon_id", F.col("start").alias("ps"), F.col("end").alias("pe"))
    return (
        ranges.join(p, "gene")
        .where((F.col("ps") >= F.col("start")) & (F.col("pe") <= F.col("end")))
        .drop("ps", "pe")
    )


def transcript_exons(gtf: DataFrame, parts: DataFrame) -> DataFrame:
    """Per transcript the ``|``-joined part ids of its exons, in transcription order."""
    exon = gtf.select(F.regexp_replace("gene_id", r"\..*$", "").alias("gene"), "transname", "start", "end")
    strand = parts.groupBy("gene").agg(F.first("strand").alias("strand"))
    ids = exons_within(exon, parts).groupBy("gene", "transname").agg(F.sort_array(F.collect_list("exon_id")).alias("ids"))
    ordered = F.when(F.col("strand") == "+", F.col("ids")).otherwise(F.reverse("ids"))
    return ids.join(strand, "gene").select(
        "gene", "transname", F.array_join(F.transform(ordered, lambda x: x.cast("string")), "|").alias("exons")
    )


def part_exon_pairs(parts: DataFrame, exons: DataFrame, flank: int = 10) -> DataFrame:
    """Which annotated exon (numbered by start, end within its gene) holds which part, with tolerance.

    A gene with a single part matches exon 1 only.
    """
    e = exons.select("gene", "exon", F.col("start").alias("es"), F.col("end").alias("ee"))
    sizes = parts.groupBy("gene").agg(F.count("*").alias("n_parts"))
    near = (F.col("es") <= F.col("start") + flank) & (F.col("ee") >= F.col("end") - flank)
    keep = F.when(F.col("n_parts") > 1, near).otherwise(F.col("exon") == 1)
    return parts.join(sizes, "gene").join(e, "gene").where(keep).select("gene", F.col("exon_id").alias("part"), "exon")


def numbered_exons(gtf: DataFrame) -> DataFrame:
    """Distinct annotated exons per gene with their number by (start, end)."""
    w = W.partitionBy("gene").orderBy("start", "end")
    return (
        gtf.select(F.regexp_replace("gene_id", r"\..*$", "").alias("gene"), "start", "end", "exon_id")
        .distinct()
        .withColumn("exon", F.row_number().over(w).cast("bigint"))
    )


def transcript_parts(gtf: DataFrame, parts: DataFrame) -> DataFrame:
    """Per transcript the ascending part ids its exons correspond to (repeats kept)."""
    exons = numbered_exons(gtf)
    pairs = part_exon_pairs(parts, exons)
    tx = gtf.select(F.regexp_replace("gene_id", r"\..*$", "").alias("gene"), "transname", "exon_id").distinct()
    used = tx.join(exons.select("gene", "exon_id", "exon"), ["gene", "exon_id"])
    return (
        used.join(pairs, ["gene", "exon"])
        .groupBy("gene", "transname")
        .agg(F.sort_array(F.collect_list("part")).alias("ids"))
        .select("gene", "transname", F.array_join(F.transform("ids", lambda x: x.cast("string")), "|").alias("parts"))
    )


def annotation_table(gtf: DataFrame, parts: DataFrame) -> DataFrame:
    """0/1 per transcript and part id, over the part ids any transcript of the gene uses."""
    used = (
        transcript_exons(gtf, parts)
        .select("gene", "transname", F.explode(F.split("exons", r"\|")).alias("exon"))
        .select("gene", "transname", F.col("exon").cast("bigint").alias("exon"))
        .distinct()
    )
    names = used.select("gene", "transname").distinct()
    exons = used.select("gene", "exon").distinct()
    grid = names.join(exons, "gene")
    return grid.join(used.withColumn("hit", F.lit(1)), ["gene", "transname", "exon"], "left").select(
        "gene", "transname", "exon", F.coalesce("hit", F.lit(0)).cast("int").alias("value")
    )


def long_enough(groups: DataFrame, parts: DataFrame, min_len: int = 10) -> DataFrame:
    """Exon groups (``exon`` text joined by ``|``) whose parts sum to ``min_len`` bases."""
    single = groups.withColumn("one", F.explode(F.split("exon", r"\|"))).withColumn("exon_id", F.col("one").cast("bigint"))
    widths = parts.select("gene", "exon_id", "width")
    return (
        single.join(widths, ["gene", "exon_id"], "left")
        .groupBy("gene", "exon")
        .agg(F.coalesce(F.sum("width"), F.lit(0)).alias("length"))
        .where(F.col("length") >= min_len)
    )
