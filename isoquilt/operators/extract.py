"""Read extraction: alignments x genes -> barcode search sequence, splice blocks, polyA.

The gene table has one row per gene and goes to every task as long as its counted size
allows; beyond, reads and genes are shuffled by (chromosome, bin).
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from isoquilt.config import ReadConfig
from isoquilt.functions import intervals, seq
from isoquilt.operators import annotation
from isoquilt.session import compute_once, cut

CIGAR = "array<struct<op:string,len:bigint>>"
BLOCKS = "array<struct<s:bigint,e:bigint>>"
NO_CLIP = "NNNNNNNNN"
#: Numbers of a gene table that goes to every task (about 130 MB).
BROADCAST_PLACES = 16_000_000


def parse_cigar(cigar: Column) -> Column:
    """CIGAR text -> array of (op, len)."""
    return F.transform(
        F.regexp_extract_all(cigar, F.lit(r"(\d+[MIDNSHP=X])"), F.lit(1)),
        lambda c: F.struct(
            F.right(c, F.lit(1)).alias("op"), F.substring(c, F.lit(1), F.length(c) - 1).cast("bigint").alias("len")
        ),
    )


def reference_span(cigar: Column) -> Column:
    """Reference bases covered, introns included."""
    return F.aggregate(
        cigar,
        F.lit(0).cast("bigint"),
        lambda acc, c: acc + F.when(c["op"].isin("M", "D", "N", "=", "X"), c["len"]).otherwise(F.lit(0)),
    )


def _fold_blocks(pos: Column, cigar: Column, extends: list, skips: list) -> Column:
    here = (pos + 1).cast("bigint")
    start = F.struct(here.alias("s"), here.alias("e"), F.array().cast(BLOCKS).alias("done"))

    def step(acc, c):
        closed = F.concat(acc["done"], F.array(F.struct(acc["s"].alias("s"), acc["e"].alias("e"))))
        after = acc["e"] + c["len"]
        return (
            F.when(c["op"].isin(*extends), F.struct(acc["s"].alias("s"), after.alias("e"), acc["done"].alias("done")))
            .when(c["op"].isin(*skips), F.struct(after.alias("s"), after.alias("e"), closed.alias("done")))
            .otherwise(acc)
        )

    return F.aggregate(
        cigar,
        start,
        step,
        lambda acc: F.concat(acc["done"], F.array(F.struct(acc["s"].alias("s"), acc["e"].alias("e")))),
    )


def exon_blocks(pos: Column, cigar: Column) -> Column:
    """Exon blocks: matches and deletions extend, introns close; the end is one past the last base."""
    return _fold_blocks(pos, cigar, ["M", "D"], ["N"])


def aligned_blocks(pos: Column, cigar: Column) -> Column:
    """Stretches of aligned bases only: deletions break a block as introns do."""
    return F.filter(_fold_blocks(pos, cigar, ["M", "=", "X"], ["D", "N"]), lambda b: b["e"] > b["s"])


def blocks_near(blocks: Column, start: Column, end: Column, flank: int) -> Column:
    """Blocks that stay within ``flank`` of the gene."""
    return F.filter(blocks, lambda b: (b["s"] >= start - flank) & (b["e"] <= end + flank))


def matched_site_share(sites: Column, annotated: Column, tolerance: int = 1) -> Column:
    """Share of internal sites that hit an annotated site; each annotated site is used once.

    ``sites`` holds the internal sites only; -1 when there is none.
    """
    start = F.struct(F.lit(0).alias("used"), F.lit(0).alias("hits"))

    def step(acc, s):
        skip = F.greatest(acc["used"], F.size(F.filter(annotated, lambda a: a < s - tolerance)))

        def settle(k):
            hit = F.coalesce(F.get(annotated, k) <= s + tolerance, F.lit(False))
            return F.struct(
                F.when(hit, k + 1).otherwise(acc["used"]).alias("used"),
                (acc["hits"] + hit.cast("int")).alias("hits"),
            )

        return F.element_at(F.transform(F.array(skip), settle), 1)

    share = F.aggregate(sites, start, step, lambda acc: acc["hits"] / F.size(sites).cast("double"))
    return F.when(F.size(sites) > 0, share).otherwise(F.lit(-1.0))


def soft_clips(cigar: Column, sequence: Column) -> tuple[Column, Column]:
    """Leading and trailing soft clip, a run of N's where there is none."""
    first, last = F.element_at(cigar, 1), F.element_at(cigar, -1)
    fwd = F.when(first["op"] == "S", F.left(sequence, first["len"].cast("int"))).otherwise(F.lit(NO_CLIP))
    rev = F.when(last["op"] == "S", F.right(sequence, last["len"].cast("int"))).otherwise(F.lit(NO_CLIP))
    return fwd, rev


def search_sequence(fwd: Column, rev: Column, strand: Column, cfg: ReadConfig) -> Column:
    """The clip that may hold the barcode, in barcode orientation; '' if too short."""
    if cfg.toolkit == 3:
        fwd = seq.revcomp(seq.trim_to_last_run(seq.revcomp(fwd), "A", cfg.polya_run))
        rev = seq.trim_to_last_run(rev, "A", cfg.polya_run)
    near5 = F.when(F.length(fwd) > cfg.min_clip, seq.last_bases(fwd, cfg.search_len)).otherwise(F.lit(""))
    near3 = F.when(F.length(rev) > cfg.min_clip, F.left(rev, F.lit(cfg.search_len))).otherwise(F.lit(""))
    minus = strand == "-"
    if cfg.toolkit == 5:
        return F.when(minus, seq.revcomp(near3)).otherwise(near5)
    return F.when(minus, near5).otherwise(seq.revcomp(near3))


def gene_table(bed: DataFrame) -> DataFrame:
    """One row per gene: bounds, strand, sorted parts and annotated splice sites."""
    parts = (
        annotation.numbered_parts(bed)
        .groupBy("gene")
        .agg(
            F.first("chr").alias("chr"),
            F.first("strand").alias("gene_strand"),
            F.min("start").alias("gene_start"),
            F.max("end").alias("gene_end"),
            F.sort_array(F.collect_list(F.struct(F.col("start").alias("s"), F.col("end").alias("e"), "exon_id"))).alias(
                "parts"
            ),
        )
    )
    sites = annotation.splice_sites(bed).groupBy("gene").agg(F.sort_array(F.collect_list("site")).alias("sites"))
    return cut(parts.join(sites, "gene"))


def _is_small(genes: DataFrame) -> bool:
    """Whether a table of genes, counted by the numbers in its lists, may go to every task."""
    lists = [F.size(c) * (2 if c == "parts" else 1) for c in ("parts", "sites") if c in genes.columns]
    return genes.agg(F.coalesce(F.sum(sum(lists, F.lit(4))), F.lit(0))).first()[0] <= BROADCAST_PLACES


def everywhere(genes: DataFrame) -> DataFrame:
    """A table of genes marked for broadcast if its counted size allows; read here and in the join, so kept before."""
    return F.broadcast(genes) if _is_small(genes) else genes


def overlapping_genes(reads: DataFrame, genes: DataFrame, bin_size: int = 1 << 14) -> DataFrame:
    """Interval join reads x genes on (chromosome, bin); a pair is kept in its first common bin only."""
    spans = compute_once(reads, ref_end=F.col("pos") + reference_span(F.col("cigar")))
    bins = lambda lo, hi: F.explode(F.sequence(F.floor(lo / bin_size), F.floor(hi / bin_size)))
    left = spans.withColumn("bin", bins(F.col("pos"), F.col("ref_end")))
    right = genes.withColumn("bin", bins(F.col("gene_start"), F.col("gene_end")))
    if _is_small(genes):
        right = F.broadcast(right)
    joined = left.join(right, (F.col("rname") == F.col("chr")) & (left["bin"] == right["bin"]))
    first_bin = F.greatest(F.floor(F.col("pos") / bin_size), F.floor(F.col("gene_start") / bin_size))
    return joined.where(
        (left["bin"] == first_bin) & (F.col("pos") < F.col("gene_end")) & (F.col("ref_end") > F.col("gene_start"))
    ).drop("bin", "chr")


def usable(reads: DataFrame, cfg: ReadConfig) -> DataFrame:
    """Mapped, primary or supplementary, confident alignments; CIGAR parsed."""
    unmapped_or_secondary = F.col("flag").bitwiseAND(F.lit(4 | 256)) != 0
    good = reads.where(~unmapped_or_secondary & (F.col("mapq") >= cfg.min_mapq))
    return compute_once(good.withColumnRenamed("cigar", "cigar_text"), cigar=parse_cigar(F.col("cigar_text"))).drop(
        "cigar_text"
    )


def viewed(reads: DataFrame, views: dict) -> DataFrame:
    """Replace the sequence by what ``views`` (name -> function of clips and strand) take from it.

    Each view is worked out for both strands of a gene before reads meet genes, so the
    interval join carries short texts and flags instead of whole sequences.
    """
    fwd, rev = soft_clips(F.col("cigar"), F.col("seq"))
    both = {f"{n}{s}": view(fwd, rev, F.lit(s)) for n, view in views.items() for s in "+-"}
    return (compute_once(reads, **both) if both else reads).drop("seq")


def picked(joined: DataFrame, views: dict) -> DataFrame:
    """Of each view the text of the gene's strand."""
    minus = F.col("gene_strand") == "-"
    columns = {n: F.when(minus, F.col(f"`{n}-`")).otherwise(F.col(f"`{n}+`")) for n in views}
    return joined.withColumns(columns).drop(*[f"{n}{s}" for n in views for s in "+-"])


def read_genes(reads: DataFrame, bed: DataFrame, cfg: ReadConfig = ReadConfig(), views: dict | None = None) -> DataFrame:
    """Confident alignments with every gene they overlap, and the wanted views of their clips."""
    views = views or {}
    return picked(overlapping_genes(viewed(usable(reads, cfg), views), gene_table(bed)), views)


def search_view(cfg: ReadConfig):
    """View: the clip that may hold the barcode."""
    return lambda fwd, rev, strand: search_sequence(fwd, rev, strand, cfg)


def tail_view(cfg: ReadConfig):
    """View: whether the clip behind the transcript end holds a polyA window."""

    def found(fwd, rev, strand):
        plus = seq.has_polya(rev, cfg.polya_window, cfg.polya_count)
        return F.when(strand == "-", seq.has_polya(seq.revcomp(fwd), cfg.polya_window, cfg.polya_count)).otherwise(plus)

    return found


def inside_gene(found: Column, cfg: ReadConfig) -> Column:
    """A polyA counts unless the read runs past the gene."""
    return F.when(F.col("ref_end") >= F.col("gene_end") + cfg.gene_flank, F.lit(False)).otherwise(found)


def exon_reads(reads: DataFrame, bed: DataFrame, cfg: ReadConfig = ReadConfig()) -> DataFrame:
    """Exon read table: name, barcode search sequence, gene, isoform, site match, polyA, strand."""
    views = {"search": search_view(cfg), "behind": tail_view(cfg)}
    df = viewed(usable(reads, cfg), views).select(
        "read_name", "rname", "pos", "cigar", exon_blocks(F.col("pos"), F.col("cigar")).alias("blocks"),
        *[f"`{n}{s}`" for n in views for s in "+-"],
    )
    # a read without a search sequence on either strand joins nothing
    df = df.where((F.length("`search+`") > 0) | (F.length("`search-`") > 0))
    df = picked(overlapping_genes(df, gene_table(bed).drop("parts")), views).where(F.length("search") > 0)
    near = blocks_near(F.col("blocks"), F.col("gene_start"), F.col("gene_end"), cfg.gene_flank)
    df = compute_once(df, near=near).where(F.size("near") > 0)
    ends = F.flatten(F.transform("near", lambda b: F.array(b["s"], b["e"])))
    inner = F.slice(ends, F.lit(2), F.size(ends) - 2)
    return df.select(
        "read_name",
        F.col("search").alias("seq"),
        "gene",
        intervals.format_blocks(F.col("near")).alias("isoform"),
        matched_site_share(inner, F.col("sites"), cfg.site_tolerance).alias("state"),
        inside_gene(F.col("behind"), cfg).alias("polyA"),
        F.when(F.col("gene_strand") == "+", "plus").otherwise("minus").alias("strand"),
    )


# ------------------------------------------------- exon-coverage layout


def positions_within(blocks: Column, start: Column, end: Column) -> Column:
    """Aligned positions inside [start, end]; block ends are one past the last base."""
    return F.aggregate(
        blocks,
        F.lit(0).cast("bigint"),
        lambda acc, b: acc + intervals.overlap(b["s"], b["e"] - 1, start, end).cast("bigint"),
    )


def spans_most(genes_reads: DataFrame, min_overlap: int = 12) -> DataFrame:
    """Reads that reach from the first part into the last one."""
    return genes_reads.where(
        (F.col("pos") <= F.element_at("parts", -1)["s"] - min_overlap)
        & (F.col("ref_end") > F.element_at("parts", 1)["e"] + min_overlap)
    )


def part_coverage(blocks: Column, parts: Column) -> Column:
    """Covered fraction of every part."""
    return F.transform(
        parts,
        lambda p: positions_within(blocks, p["s"], p["e"]) / (p["e"] - p["s"] + 1).cast("double"),
    )


def touches_both_ends(coverage: Column) -> Column:
    """Read covers the first and the last part."""
    return (F.element_at(coverage, 1) > 0) & (F.element_at(coverage, -1) > 0)


def present_parts(coverage: Column, parts: Column, full: float = 0.9, edge: float = 0.1) -> Column:
    """Text of part ids: ``id|`` when covered, ``-`` otherwise; edge parts need less cover."""
    places = F.sequence(F.lit(1), F.size(coverage))
    touched = F.filter(places, lambda j: F.element_at(coverage, j) > 0)
    first, last = F.array_min(touched), F.array_max(touched)

    def show(j):
        c = F.element_at(coverage, j)
        shown = (c >= full) | (((j == first) | (j == last)) & (c >= edge))
        return F.when(shown, F.concat(F.element_at(parts, j)["exon_id"].cast("string"), F.lit("|"))).otherwise("-")

    return F.when(F.size(touched) > 0, F.array_join(F.transform(places, show), ""))


def coverage_reads(reads: DataFrame, bed: DataFrame, cfg: ReadConfig = ReadConfig(min_mapq=0)) -> DataFrame:
    """Exon-coverage read table of the older extraction (no mapping quality filter)."""

    def search(fwd, rev, strand):
        near5 = F.when(F.length(fwd) > cfg.min_clip, seq.last_bases(fwd, cfg.search_len)).otherwise(F.lit(""))
        near3 = F.when(F.length(rev) > cfg.min_clip, F.left(rev, F.lit(cfg.search_len))).otherwise(F.lit(""))
        if cfg.toolkit == 5:
            return F.when(strand == "-", seq.revcomp(near3)).otherwise(near5)
        return F.when(strand == "-", seq.revcomp(near5)).otherwise(near3)

    def run_behind(fwd, rev, strand):
        return F.when(strand == "-", seq.revcomp(fwd)).otherwise(rev).contains("A" * cfg.polya_run)

    df = spans_most(read_genes(reads, bed, cfg, {"search": search, "behind": run_behind}))
    df = compute_once(df, blocks=aligned_blocks(F.col("pos"), F.col("cigar")))
    df = compute_once(df, coverage=part_coverage(F.col("blocks"), F.col("parts")))
    df = df.where(F.exists("coverage", lambda c: c > 0))
    return df.select(
        "read_name",
        present_parts(F.col("coverage"), F.col("parts")).alias("exons"),
        "gene",
        F.col("search").alias("seq"),
        F.col("behind").alias("polyA"),
        F.when(F.col("gene_strand") == "-", "minus").otherwise("plus").alias("strand"),
        "coverage",
        touches_both_ends(F.col("coverage")).alias("spanning"),
        F.col("pos").alias("reads_s"),
        F.col("ref_end").alias("reads_e"),
    )
