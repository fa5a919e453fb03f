"""Sources and read extraction."""

from pyspark.sql import functions as F

from isoquilt.config import ReadConfig
from isoquilt.functions import intervals, seq
from isoquilt.operators import extract as ex
from isoquilt.plans import testbed as tb
from isoquilt.plans.registry import query
from isoquilt.session import compute_once
from isoquilt.sources import readers

# ------------------------------------------------------------- sources


@query(
    "src_sam",
    "alignments",
    "SELECT read_name, cast(flag AS int) AS flag, rname, pos, mapq, cigar, length(seq) AS seq_len FROM alignments",
)
def src_sam(spark, sf):
    a = tb.alignments(spark, sf)
    lines = a.select(
        F.concat_ws("\t", "read_name", "flag", "rname", F.col("pos") + 1, "mapq", "cigar", F.lit("*"), F.lit("0"), F.lit("0"), "seq").alias("value")
    )
    return readers.parse_sam(lines).withColumn("seq_len", F.length("seq").cast("bigint")).drop("seq")


@query("src_bed", "gene_bed", "SELECT * FROM gene_bed")
def src_bed(spark, sf):
    b = tb.gene_bed(spark, sf)
    return readers.parse_bed(b.select("gene", F.concat_ws(" ", "chr", "start", "end", "width", "strand").alias("value")))


@query("src_gtf", "gtf_exons", "SELECT * FROM gtf_exons")
def src_gtf(spark, sf):
    g = tb.gtf_exons(spark, sf)
    attributes = F.format_string('gene_id "%s"; transcript_id "%s"; exon_id "%s";', "gene_id", "transname", "exon_id")
    fields = ["chr", F.lit("havana"), F.lit("exon"), "start", "end", F.lit("."), "strand", F.lit("."), attributes]
    return readers.parse_gtf(g.select(F.concat_ws("\t", *fields).alias("value")))


@query("src_softclip", "reads", "SELECT read_name, clip AS seq FROM reads")
def src_softclip(spark, sf):
    return readers.parse_softclips(tb.reads(spark, sf).select(F.concat_ws("\t", "read_name", "clip").alias("value")))


@query("src_whitelist", "whitelist", "SELECT * FROM whitelist")
def src_whitelist(spark, sf):
    lines = tb.whitelist(spark, sf).select(F.concat(F.lit(" "), "barcode").alias("value"))
    return readers.parse_whitelist(lines)


@query("src_whitelist_lines", "whitelist", "SELECT * FROM whitelist")
def src_whitelist_lines(spark, sf):
    return readers.parse_whitelist(tb.whitelist(spark, sf).select(F.concat("barcode", F.lit(" ")).alias("value")))


@query("src_table", "cell_exon", "SELECT * FROM cell_exon")
def src_table(spark, sf):
    names = [f.split()[0] for f in readers.CELL_EXON.split(", ")]
    lines = tb.cell_exon(spark, sf).select(F.concat_ws(" ", *[F.col(n).cast("string") for n in names]).alias("value"))
    return readers.parse_table(lines, readers.CELL_EXON)


@query("src_rds", "", "SELECT s_suppkey, s_nationkey FROM supplier")
def src_rds(spark, sf):
    return readers.read_store(spark, f"{sf}/supplier.parquet", ["s_suppkey", "s_nationkey"])


# ------------------------------------------------------------- extraction

tb.sql_table(
    "genes",
    "gene_bed",
    """SELECT gene, min(chr) AS chr, min(strand) AS gene_strand, min(start) AS gene_start, max("end") AS gene_end
       FROM gene_bed GROUP BY gene""",
)
tb.sql_table(
    "annotated_sites",
    "gene_bed",
    """SELECT gene, site FROM (SELECT gene, "end" AS site FROM gene_bed
        UNION ALL SELECT b.gene, b.start FROM gene_bed b
        WHERE NOT EXISTS (SELECT 1 FROM gene_bed p WHERE p.gene = b.gene AND p."end" + 1 = b.start))""",
)
tb.sql_table(
    "read_genes",
    "clips genes",
    """SELECT c.read_name, g.gene, g.gene_strand, g.gene_start, g.gene_end, c.blocks, c.fwd, c.rev, c.q, c.t,
        c.blocks[1].s - 1 AS pos, c.blocks[-1].e - 1 AS ref_end
       FROM clips c JOIN genes g ON g.chr = c.chr AND c.blocks[1].s - 1 < g.gene_end
        AND c.blocks[-1].e - 1 > g.gene_start""",
)
tb.sql_table("good_read_genes", "read_genes", "SELECT * FROM read_genes WHERE q NOT IN (1, 2) AND t <> 0")


@query("rd_filter", "good_read_genes", "SELECT read_name, gene FROM good_read_genes")
def rd_filter(spark, sf):
    return ex.read_genes(tb.alignments(spark, sf), tb.gene_bed(spark, sf)).select("read_name", "gene")


@query(
    "rd_blocks",
    "good_read_genes",
    """SELECT read_name, gene, array_to_string(list_transform(
        list_filter(blocks, lambda b: b.s >= gene_start - 200 AND b.e <= gene_end + 200),
        lambda b: concat(b.s, ',', b.e)), '|') AS isoform FROM good_read_genes""",
)
def rd_blocks(spark, sf):
    df = ex.read_genes(tb.alignments(spark, sf), tb.gene_bed(spark, sf))
    blocks = ex.blocks_near(
        ex.exon_blocks(F.col("pos"), F.col("cigar")), F.col("gene_start"), F.col("gene_end"), 200
    )
    return df.select("read_name", "gene", intervals.format_blocks(blocks).alias("isoform"))


tb.sql_table(
    "site_state",
    "reads annotated_sites",
    """SELECT i.read_name, i.gene, CASE WHEN len(i.sites) = 0 THEN -1.0 ELSE
        len(list_filter(i.sites, lambda s: len(list_filter(a.sites, lambda x: x BETWEEN s - 1 AND s + 1)) > 0))
            / len(i.sites)::double END AS state
       FROM (SELECT read_name, gene, flatten(list_transform(blocks, lambda b: [b.s, b.e]))[2:-2] AS sites FROM reads) i
       JOIN (SELECT gene, list(site) AS sites FROM annotated_sites GROUP BY gene) a USING (gene)""",
)


@query("rd_site_check", "site_state", "SELECT read_name, gene, round(state, 6) AS state FROM site_state")
def rd_site_check(spark, sf):
    genes = ex.everywhere(ex.gene_table(tb.gene_bed(spark, sf)).select("gene", "sites"))
    r = tb.reads(spark, sf).select("read_name", "gene", "isoform").join(genes, "gene")
    state = ex.matched_site_share(intervals.inner_sites(F.col("isoform")), F.col("sites"))
    return r.select("read_name", "gene", F.round(state, 6).alias("state"))


@query("rd_softclip", "clips", "SELECT read_name, fwd, rev FROM clips")
def rd_softclip(spark, sf):
    a = tb.alignments(spark, sf).withColumn("cigar", ex.parse_cigar(F.col("cigar")))
    fwd, rev = ex.soft_clips(F.col("cigar"), F.col("seq"))
    return a.select("read_name", fwd.alias("fwd"), rev.alias("rev"))


@query("rd_revcomp", "reads", "SELECT read_name, reverse(translate(clip, 'ACGT', 'TGCA')) AS rc FROM reads")
def rd_revcomp(spark, sf):
    return tb.reads(spark, sf).select("read_name", seq.revcomp(F.col("clip")).alias("rc"))


@query(
    "rd_polya_rm",
    "reads",
    """SELECT read_name, CASE WHEN hit IS NULL THEN txt ELSE substr(txt, hit) END AS trimmed FROM (
        SELECT read_name, txt, list_max(list_filter(range(1, length(txt) - 8),
            lambda i: substr(txt, i, 10) = 'AAAAAAAAAA')) AS hit FROM (SELECT read_name, concat(clip, tail) AS txt FROM reads))""",
)
def rd_polya_rm(spark, sf):
    return tb.reads(spark, sf).select("read_name", seq.trim_to_last_run(F.concat("clip", "tail")).alias("trimmed"))


def _sql_polya(text):
    return (
        f"len(list_filter(range(1, length({text}) - 19), "
        f"lambda i: 20 - length(replace(substr({text}, i, 20), 'A', '')) >= 15)) > 0"
    )


@query("rd_polya", "reads", f"""SELECT read_name, {_sql_polya('tail')} AS "polyA" FROM reads""")
def rd_polya(spark, sf):
    return tb.reads(spark, sf).select("read_name", seq.has_polya(F.col("tail")).alias("polyA"))


tb.sql_table(
    "oriented",
    "good_read_genes",
    """SELECT *, CASE WHEN gene_strand = '-' THEN reverse(translate(fwd, 'ACGT', 'TGCA')) ELSE rev END AS end_clip
       FROM good_read_genes""",
)


@query(
    "rd_polya_strand",
    "oriented",
    f"""SELECT read_name, gene, CASE WHEN ref_end >= gene_end + 200 THEN FALSE ELSE {_sql_polya('end_clip')} END AS "polyA"
        FROM oriented""",
)
def rd_polya_strand(spark, sf):
    views = {"behind": ex.tail_view(ReadConfig())}
    df = ex.read_genes(tb.alignments(spark, sf), tb.gene_bed(spark, sf), views=views)
    return df.select("read_name", "gene", ex.inside_gene(F.col("behind"), ReadConfig()).alias("polyA"))


_RC = "reverse(translate({x}, 'ACGT', 'TGCA'))"
_N5 = "CASE WHEN length({f}) > 17 THEN right({f}, 55) ELSE '' END"
_N3 = "CASE WHEN length({f}) > 17 THEN substr({f}, 1, 55) ELSE '' END"
tb.sql_table(
    "search5",
    "good_read_genes",
    f"""SELECT *, CASE WHEN gene_strand = '-' THEN {_RC.format(x=_N3.format(f='rev'))} ELSE {_N5.format(f='fwd')} END AS seq
        FROM good_read_genes""",
)


@query("rd_search_seq", "search5", "SELECT read_name, gene, seq FROM search5 WHERE seq <> ''")
def rd_search_seq(spark, sf):
    return _searched(spark, sf, 5)


def _searched(spark, sf, toolkit):
    views = {"search": ex.search_view(ReadConfig(toolkit=toolkit))}
    df = ex.read_genes(tb.alignments(spark, sf), tb.gene_bed(spark, sf), views=views)
    return df.select("read_name", "gene", F.col("search").alias("seq")).where("seq <> ''")


def _sql_trim(text):
    hit = (
        f"list_max(list_filter(range(1, length({text}) - 8), lambda i: substr({text}, i, 10) = 'AAAAAAAAAA'))"
    )
    return f"CASE WHEN {hit} IS NULL THEN {text} ELSE substr({text}, {hit}) END"


@query(
    "rd_search_seq_3",
    "good_read_genes",
    f""", a AS (SELECT *, {_RC.format(x='fwd')} AS rfwd FROM good_read_genes),
    b AS (SELECT *, {_sql_trim('rfwd')} AS tf, {_sql_trim('rev')} AS tr FROM a),
    c AS (SELECT *, {_RC.format(x='tf')} AS f2 FROM b)
    SELECT read_name, gene, seq FROM (SELECT read_name, gene, CASE WHEN gene_strand = '-' THEN {_N5.format(f='f2')}
        ELSE {_RC.format(x=_N3.format(f='tr'))} END AS seq FROM c) WHERE seq <> ''""",
)
def rd_search_seq_3(spark, sf):
    return _searched(spark, sf, 3)


tb.sql_table(
    "exon_reads",
    "search5 annotated_sites",
    f"""SELECT read_name, seq, gene, isoform, CASE WHEN len(inner_sites) = 0 THEN -1.0 ELSE
        len(list_filter(inner_sites, lambda s: len(list_filter(sites, lambda x: x BETWEEN s - 1 AND s + 1)) > 0))
            / len(inner_sites)::double END AS state,
        CASE WHEN ref_end >= gene_end + 200 THEN FALSE ELSE {_sql_polya('end_clip')} END AS "polyA",
        CASE WHEN gene_strand = '+' THEN 'plus' ELSE 'minus' END AS strand
       FROM (SELECT *, array_to_string(list_transform(bl, lambda b: concat(b.s, ',', b.e)), '|') AS isoform,
            flatten(list_transform(bl, lambda b: [b.s, b.e]))[2:-2] AS inner_sites,
            CASE WHEN gene_strand = '-' THEN {_RC.format(x='fwd')} ELSE rev END AS end_clip
        FROM (SELECT *, list_filter(blocks, lambda b: b.s >= gene_start - 200 AND b.e <= gene_end + 200) AS bl
              FROM search5))
       JOIN (SELECT gene, list(site) AS sites FROM annotated_sites GROUP BY gene) USING (gene)
       WHERE seq <> '' AND len(bl) > 0""",
)


@query("rd_project", "exon_reads", "SELECT * REPLACE (round(state, 6) AS state) FROM exon_reads")
def rd_project(spark, sf):
    out = ex.exon_reads(tb.alignments(spark, sf), tb.gene_bed(spark, sf))
    return out.withColumn("state", F.round("state", 6))


@query("snk_prune", "exon_reads", "SELECT read_name, seq FROM exon_reads")
def snk_prune(spark, sf):
    return ex.exon_reads(tb.alignments(spark, sf), tb.gene_bed(spark, sf)).select("read_name", "seq")


# ------------------------------------------------------------- exon coverage layout

tb.sql_table(
    "spanning_reads",
    "read_genes",
    """SELECT r.* FROM read_genes r JOIN (SELECT gene, max(start) AS last_start, arg_min("end", start) AS first_end
        FROM gene_bed GROUP BY gene) b USING (gene)
       WHERE r.q NOT IN (1, 2) AND r.pos <= b.last_start - 12 AND r.ref_end > b.first_end + 12""",
)
tb.sql_table(
    "read_part_cov",
    "spanning_reads parts",
    """SELECT s.read_name, s.gene, p.part, p.exon_id, s.gene_strand,
        cast(list_sum(list_transform(s.blocks, lambda b: greatest(0, least(b.e - 1, p."end") - greatest(b.s, p.start) + 1)))
            AS bigint) AS bases, p.width
       FROM spanning_reads s JOIN parts p USING (gene)""",
)


def _coverage(spark, sf):
    return ex.coverage_reads(tb.alignments(spark, sf), tb.gene_bed(spark, sf))


@query("rd2_span", "spanning_reads", "SELECT read_name, gene FROM spanning_reads")
def rd2_span(spark, sf):
    reads = ex.read_genes(tb.alignments(spark, sf), tb.gene_bed(spark, sf), ReadConfig(min_mapq=0))
    return ex.spans_most(reads).select("read_name", "gene")


@query(
    "rd2_spanning",
    "read_part_cov",
    """SELECT read_name, gene, arg_min(bases, part) > 0 AND arg_max(bases, part) > 0 AS spanning
       FROM read_part_cov GROUP BY read_name, gene HAVING sum(bases) > 0""",
)
def rd2_spanning(spark, sf):
    return _coverage(spark, sf).select("read_name", "gene", "spanning")


@query(
    "rd2_bsearch",
    "read_part_cov",
    """SELECT read_name, gene, string_agg(bases, '|' ORDER BY part) AS positions FROM read_part_cov GROUP BY read_name, gene""",
)
def rd2_bsearch(spark, sf):
    reads = ex.spans_most(ex.read_genes(tb.alignments(spark, sf), tb.gene_bed(spark, sf), ReadConfig(min_mapq=0)))
    reads = compute_once(reads, blocks=ex.aligned_blocks(F.col("pos"), F.col("cigar")))
    counts = F.transform("parts", lambda p: ex.positions_within(F.col("blocks"), p["s"], p["e"]).cast("string"))
    return reads.select("read_name", "gene", F.array_join(counts, "|").alias("positions"))


@query(
    "rd2_cov",
    "read_part_cov",
    """SELECT read_name, gene, string_agg(cast(round(1000.0 * bases / width) AS bigint), '|' ORDER BY part) AS coverage
       FROM read_part_cov GROUP BY read_name, gene HAVING sum(bases) > 0""",
)
def rd2_cov(spark, sf):
    shown = F.transform("coverage", lambda c: F.round(c * 1000).cast("bigint").cast("string"))
    return _coverage(spark, sf).select("read_name", "gene", F.array_join(shown, "|").alias("coverage"))


@query(
    "rd2_binary",
    "read_part_cov",
    """, m AS (SELECT *, bases / width::double AS cov, min(CASE WHEN bases > 0 THEN part END) OVER w AS fp,
        max(CASE WHEN bases > 0 THEN part END) OVER w AS lp FROM read_part_cov WINDOW w AS (PARTITION BY read_name, gene))
    SELECT read_name, gene, string_agg(CASE WHEN cov >= 0.9 OR (part IN (fp, lp) AND cov >= 0.1)
        THEN concat(exon_id, '|') ELSE '-' END, '' ORDER BY part) AS exons FROM m WHERE fp IS NOT NULL
    GROUP BY read_name, gene""",
)
def rd2_binary(spark, sf):
    return _coverage(spark, sf).select("read_name", "gene", "exons")


@query(
    "rd2_polya",
    "spanning_reads",
    f"""SELECT read_name, gene, contains(CASE WHEN gene_strand = '-' THEN {_RC.format(x='fwd')} ELSE rev END,
        'AAAAAAAAAA') AS "polyA" FROM spanning_reads""",
)
def rd2_polya(spark, sf):
    return _coverage(spark, sf).select("read_name", "gene", "polyA")
