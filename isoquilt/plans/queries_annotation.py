"""Annotation queries."""

from pyspark.sql import functions as F

from isoquilt.operators import annotation as an
from isoquilt.plans import testbed as tb
from isoquilt.plans.registry import query

tb.sql_table(
    "parts",
    "gene_bed",
    """SELECT *, row_number() OVER (PARTITION BY gene ORDER BY start) AS part,
        CASE WHEN strand = '+' THEN row_number() OVER (PARTITION BY gene ORDER BY start)
             ELSE row_number() OVER (PARTITION BY gene ORDER BY start DESC) END AS exon_id FROM gene_bed""",
)
tb.sql_table("gtf", "gtf_exons", r"SELECT *, regexp_replace(gene_id, '\..*$', '') AS gene FROM gtf_exons")


@query(
    "ann_disjoin",
    "gtf",
    """, points AS (SELECT DISTINCT gene, p FROM (SELECT gene, start AS p FROM gtf UNION ALL SELECT gene, "end" + 1 FROM gtf)),
    spans AS (SELECT gene, p AS s, lead(p) OVER (PARTITION BY gene ORDER BY p) - 1 AS e FROM points)
    SELECT s.gene, min(g.chr) AS chr, s.s AS start, s.e AS "end", s.e - s.s + 1 AS width, min(g.strand) AS strand
    FROM spans s JOIN gtf g ON g.gene = s.gene AND g.start <= s.s AND g."end" >= s.e GROUP BY s.gene, s.s, s.e""",
)
def ann_disjoin(spark, sf):
    return an.disjoint_parts(tb.gtf_exons(spark, sf))


@query(
    "ann_exon_gtf",
    "gtf",
    """SELECT start, "end", substr(min(gene_id), 1, 15) AS gene_id, min(transname) AS transname, exon_id
       FROM gtf GROUP BY chr, start, "end", strand, exon_id""",
)
def ann_exon_gtf(spark, sf):
    return an.exon_dictionary(tb.gtf_exons(spark, sf))


@query(
    "ann_part_merge",
    "parts",
    """, grown AS (SELECT gene, strand, start, "end", width,
        lag("end") OVER w AS pe, lead(start) OVER w AS ns, lag(width) OVER w AS pw, lead(width) OVER w AS nw
        FROM parts WINDOW w AS (PARTITION BY gene ORDER BY start)),
    cls AS (SELECT *, CASE WHEN width >= 10 THEN 'keep'
        WHEN pe + 1 = start AND ns - 1 = "end" THEN CASE WHEN pw <= nw THEN 'left' ELSE 'right' END
        WHEN pe + 1 = start THEN 'left' WHEN ns - 1 = "end" THEN 'right' ELSE 'drop' END AS act FROM grown),
    merged AS (SELECT gene, strand, act,
        CASE WHEN lag(act) OVER w = 'right' THEN lag(start) OVER w ELSE start END AS start,
        CASE WHEN lead(act) OVER w = 'left' THEN lead("end") OVER w ELSE "end" END AS "end"
        FROM cls WINDOW w AS (PARTITION BY gene ORDER BY start))
    SELECT gene, start, "end", CASE WHEN strand = '+' THEN row_number() OVER (PARTITION BY gene ORDER BY start)
        ELSE row_number() OVER (PARTITION BY gene ORDER BY start DESC) END AS exon_id, "end" - start + 1 AS length
    FROM merged WHERE act = 'keep'""",
)
def ann_part_merge(spark, sf):
    return an.merge_short_parts(an.numbered_parts(tb.gene_bed(spark, sf)))


@query(
    "ann_sites",
    "gene_bed",
    """, m AS (SELECT *, lag("end") OVER (PARTITION BY gene ORDER BY start) AS pe FROM gene_bed)
    SELECT gene, "end" AS site FROM m UNION ALL SELECT gene, start FROM m WHERE pe IS NULL OR pe + 1 <> start""",
)
def ann_sites(spark, sf):
    return an.splice_sites(tb.gene_bed(spark, sf))


@query(
    "ann_map_error",
    "reads gene_bed",
    """SELECT r.gene, avg(CASE WHEN r.blocks[1].s < b.s OR r.blocks[-1].e > b.e THEN 1.0 ELSE 0.0 END) AS map_error,
        count(*) AS reads
    FROM reads r JOIN (SELECT gene, min(start) AS s, max("end") AS e FROM gene_bed GROUP BY gene) b USING (gene)
    GROUP BY r.gene""",
)
def ann_map_error(spark, sf):
    spans = tb.reads(spark, sf).select(
        "gene", F.element_at("blocks", 1)["s"].alias("start"), F.element_at("blocks", -1)["e"].alias("end")
    )
    return an.mapping_error(spans, tb.gene_bed(spark, sf))


@query(
    "ann_exon_corres",
    "gtf parts",
    """SELECT g.gene, g.transname, g.start, g."end", p.exon_id FROM gtf g JOIN parts p
       ON p.gene = g.gene AND p.start >= g.start AND p."end" <= g."end" """,
)
def ann_exon_corres(spark, sf):
    gtf = tb.gtf_exons(spark, sf).select(
        F.regexp_replace("gene_id", r"\..*$", "").alias("gene"), "transname", "start", "end"
    )
    return an.exons_within(gtf, an.numbered_parts(tb.gene_bed(spark, sf)))


tb.sql_table(
    "tx_exons",
    "gtf parts",
    """SELECT g.gene, g.transname, CASE WHEN min(p.strand) = '+' THEN string_agg(p.exon_id, '|' ORDER BY p.exon_id)
        ELSE string_agg(p.exon_id, '|' ORDER BY p.exon_id DESC) END AS exons
       FROM gtf g JOIN parts p ON p.gene = g.gene AND p.start >= g.start AND p."end" <= g."end"
       GROUP BY g.gene, g.transname""",
)


@query("ann_tx_corres", "tx_exons", "SELECT transname, exons FROM tx_exons")
def ann_tx_corres(spark, sf):
    return an.transcript_exons(tb.gtf_exons(spark, sf), an.numbered_parts(tb.gene_bed(spark, sf))).drop("gene")


@query("ann_gtf_bed", "tx_exons", "SELECT * FROM tx_exons")
def ann_gtf_bed(spark, sf):
    return an.transcript_exons(tb.gtf_exons(spark, sf), an.numbered_parts(tb.gene_bed(spark, sf)))


tb.sql_table(
    "exon_numbers",
    "gtf",
    """SELECT *, row_number() OVER (PARTITION BY gene ORDER BY start, "end") AS exon
       FROM (SELECT DISTINCT gene, start, "end", exon_id FROM gtf)""",
)
tb.sql_table(
    "part_exon",
    "exon_numbers parts",
    """SELECT p.gene, p.exon_id AS part, e.exon FROM parts p JOIN exon_numbers e ON e.gene = p.gene
       AND e.start <= p.start + 10 AND e."end" >= p."end" - 10""",
)


@query("ann_correspond", "part_exon", "SELECT * FROM part_exon")
def ann_correspond(spark, sf):
    return an.part_exon_pairs(an.numbered_parts(tb.gene_bed(spark, sf)), an.numbered_exons(tb.gtf_exons(spark, sf)))


tb.sql_table(
    "tx_parts",
    "gtf exon_numbers part_exon",
    """SELECT g.gene, g.transname, string_agg(pe.part, '|' ORDER BY pe.part) AS parts
       FROM (SELECT DISTINCT gene, transname, exon_id FROM gtf) g JOIN exon_numbers e USING (gene, exon_id)
       JOIN part_exon pe ON pe.gene = g.gene AND pe.exon = e.exon GROUP BY g.gene, g.transname""",
)


@query("ann_tx_part", "tx_parts", "SELECT * FROM tx_parts")
def ann_tx_part(spark, sf):
    return an.transcript_parts(tb.gtf_exons(spark, sf), an.numbered_parts(tb.gene_bed(spark, sf)))


@query(
    "ann_table",
    "tx_exons",
    """, used AS (SELECT DISTINCT gene, transname, cast(unnest(string_split(exons, '|')) AS bigint) AS exon FROM tx_exons)
    SELECT t.gene, t.transname, x.exon, cast(u.exon IS NOT NULL AS int) AS value FROM tx_exons t
    JOIN (SELECT DISTINCT gene, exon FROM used) x USING (gene)
    LEFT JOIN used u ON u.gene = t.gene AND u.transname = t.transname AND u.exon = x.exon""",
)
def ann_table(spark, sf):
    return an.annotation_table(tb.gtf_exons(spark, sf), an.numbered_parts(tb.gene_bed(spark, sf)))


@query(
    "ann_len_filter",
    "tx_exons parts",
    """, one AS (SELECT DISTINCT gene, exons, cast(unnest(string_split(exons, '|')) AS bigint) AS exon_id FROM tx_exons),
    singles AS (SELECT gene, cast(exon_id AS varchar) AS exons, exon_id FROM one)
    SELECT gene, exons AS exon, cast(sum(width) AS bigint) AS length
    FROM (SELECT * FROM one UNION SELECT * FROM singles) JOIN parts USING (gene, exon_id)
    GROUP BY gene, exons HAVING sum(width) >= 10""",
)
def ann_len_filter(spark, sf):
    parts = an.numbered_parts(tb.gene_bed(spark, sf))
    whole = an.transcript_exons(tb.gtf_exons(spark, sf), parts).select("gene", F.col("exons").alias("exon"))
    single = whole.select("gene", F.explode(F.split("exon", r"\|")).alias("exon"))
    return an.long_enough(whole.unionByName(single).distinct(), parts)
