"""Exon mapping, splice object, psi and phi queries."""

from pyspark.sql import functions as F

from isoquilt.config import ExonConfig
from isoquilt.functions import intervals
from isoquilt.operators import annotation, exons, psi
from isoquilt.plans import testbed as tb
from isoquilt.plans.registry import query
from isoquilt.session import cut, stored

CFG = ExonConfig()

tb.sql_table(
    "iso_bins",
    "splice_count",
    """SELECT gene, isoform, bi, split_part(b, ',', 1)::bigint AS s, split_part(b, ',', 2)::bigint - 1 AS e FROM (
        SELECT gene, isoform, unnest(string_split(isoform, '|')) AS b, unnest(range(1, len(string_split(isoform, '|')) + 1)) AS bi
        FROM (SELECT DISTINCT gene, isoform FROM splice_count))""",
)
tb.sql_table(
    "bin_exons",
    "iso_bins parts",
    """SELECT gene, isoform, bi, s, e, CASE WHEN e < s OR count(start) = 0 THEN ['N'] ELSE list_concat(
            flatten(list(list_concat(CASE WHEN gap THEN ['N'] ELSE [] END, CASE WHEN cover > 10 OR cover / width >= 0.5
                THEN [exon_id::varchar] ELSE [] END) ORDER BY start)),
            CASE WHEN max("end") + 1 < e - 5 THEN ['N'] ELSE [] END) END AS ids FROM (
        SELECT *, least("end", e) - CASE WHEN gap THEN start ELSE begin_at END + 1 AS cover FROM (
            SELECT *, start > begin_at + 5 AS gap FROM (
                SELECT b.*, p.start, p."end", p.width::double AS width, p.exon_id,
                    coalesce(lag(p."end") OVER (PARTITION BY b.gene, b.isoform, b.bi ORDER BY p.start) + 1, b.s) AS begin_at
                FROM iso_bins b LEFT JOIN parts p ON p.gene = b.gene AND p.start <= b.e AND p."end" >= b.s)))
       GROUP BY gene, isoform, bi, s, e""",
)
tb.sql_table(
    "iso_exons",
    "bin_exons",
    "SELECT gene, isoform, array_to_string(flatten(list(ids ORDER BY bi)), '|') AS exons FROM bin_exons GROUP BY gene, isoform",
)
tb.sql_table(
    "exon_count",
    "splice_count iso_exons",
    """SELECT cell, gene, split_part(isoform, ',', 1)::bigint AS start, exons, regexp_extract(isoform, '([0-9]+)$', 1)::bigint AS "end",
        size, cluster, count::double AS count, "polyA" FROM splice_count JOIN iso_exons USING (gene, isoform)""",
)


def _exon_count(spark, sf):
    return stored(
        spark, f"exon_count:{sf}", lambda: exons.exon_counts(tb.splice_count(spark, sf), tb.gene_bed(spark, sf))
    )


@query("ex_start", "iso_bins", "SELECT gene, isoform, min(s) AS start FROM iso_bins GROUP BY gene, isoform")
def ex_start(spark, sf):
    iso = tb.splice_count(spark, sf).select("gene", "isoform").distinct()
    return iso.withColumn("start", intervals.first_site(F.col("isoform")))


@query("ex_end", "iso_bins", 'SELECT gene, isoform, max(e) + 1 AS "end" FROM iso_bins GROUP BY gene, isoform')
def ex_end(spark, sf):
    iso = tb.splice_count(spark, sf).select("gene", "isoform").distinct()
    return iso.withColumn("end", intervals.last_site(F.col("isoform")))


@query("ex_bin2exon", "bin_exons", "SELECT DISTINCT gene, s, e, array_to_string(ids, '|') AS exons FROM bin_exons")
def ex_bin2exon(spark, sf):
    iso = tb.splice_count(spark, sf).select("gene", "isoform").distinct()
    bins = iso.select("gene", F.inline(intervals.parse_blocks(F.col("isoform")))).withColumn("e", F.col("e") - 1).distinct()
    mapped = exons.map_bin(F.col("s"), F.col("e"), F.col("parts"), CFG)
    return bins.join(exons.gene_parts(tb.gene_bed(spark, sf)), "gene").select(
        "gene", "s", "e", F.array_join(mapped, "|").alias("exons")
    )


@query("ex_splice2exon", "iso_exons", "SELECT * FROM iso_exons")
def ex_splice2exon(spark, sf):
    return exons.isoform_exons(tb.splice_count(spark, sf), tb.gene_bed(spark, sf), CFG)


@query("ex_isoforms2exon", "iso_exons", "SELECT gene, exons, count(*) AS isoforms FROM iso_exons GROUP BY gene, exons")
def ex_isoforms2exon(spark, sf):
    mapped = exons.isoform_exons(tb.splice_count(spark, sf), tb.gene_bed(spark, sf), CFG)
    return mapped.groupBy("gene", "exons").agg(F.count("*").alias("isoforms"))


@query("ex_create", "exon_count", 'SELECT * REPLACE (round("polyA", 6) AS "polyA") FROM exon_count')
def ex_create(spark, sf):
    out = exons.exon_counts(tb.splice_count(spark, sf), tb.gene_bed(spark, sf))
    return out.withColumn("polyA", F.round("polyA", 6))


tb.sql_table(
    "coded",
    "exon_count",
    """SELECT dense_rank() OVER (ORDER BY cell) AS cell, dense_rank() OVER (ORDER BY gene) AS gene, start,
        dense_rank() OVER (ORDER BY exons) AS exons, "end", size, cluster, count, "polyA" FROM exon_count""",
)


@query("ex_save", "coded", 'SELECT * REPLACE (round("polyA", 6) AS "polyA") FROM coded')
def ex_save(spark, sf):
    return exons.matrix_bundle(_exon_count(spark, sf))["isoform_count"].withColumn("polyA", F.round("polyA", 6))


@query("snk_mtx", "coded", "SELECT cell AS cell_code, gene AS gene_code, round(sum(count), 6) AS count FROM coded GROUP BY cell, gene")
def snk_mtx(spark, sf):
    return exons.matrix_bundle(_exon_count(spark, sf))["matrix"].withColumn("count", F.round("count", 6))


@query("so_class", "exon_count", "SELECT gene, count(DISTINCT cell) AS cell_count, round(sum(count), 6) AS total_exprs FROM exon_count GROUP BY gene")
def so_class(spark, sf):
    return exons.splice_object(_exon_count(spark, sf)).genes.withColumn("total_exprs", F.round("total_exprs", 6))


@query("so_create", "exon_count", "SELECT cell, count(DISTINCT gene) AS gene_count, count(*) AS umi_count FROM exon_count GROUP BY cell")
def so_create(spark, sf):
    return exons.splice_object_from_counts(tb.splice_count(spark, sf), tb.gene_bed(spark, sf)).cells


@query("so_from_list", "exon_count", "SELECT cell, count(DISTINCT gene) AS gene_count, round(sum(count), 6) AS umi_count FROM exon_count GROUP BY cell")
def so_from_list(spark, sf):
    return exons.splice_object(_exon_count(spark, sf)).cells.withColumn("umi_count", F.round("umi_count", 6))


@query(
    "so_extract",
    "exon_count",
    """SELECT dense_rank() OVER (ORDER BY cell) AS cell_id, cell, exons, size FROM exon_count
       QUALIFY gene = 'ENSG00000000003'""",
)
def so_extract(spark, sf):
    obj = exons.splice_object(_exon_count(spark, sf))
    return exons.gene_isoforms(obj, "ENSG00000000003").select("cell_id", "cell", "exons", "size")


@query("so_to_df", "exon_count", 'SELECT * REPLACE (round("polyA", 6) AS "polyA") FROM exon_count')
def so_to_df(spark, sf):
    return exons.to_frame(exons.splice_object(_exon_count(spark, sf))).withColumn("polyA", F.round("polyA", 6))


@query(
    "so_subset",
    "exon_count",
    """SELECT cell, dense_rank() OVER (ORDER BY cell) AS cell_id, gene, exons, size FROM exon_count
       WHERE cell < 'C' AND right(gene, 1) IN ('1', '4', '7')""",
)
def so_subset(spark, sf):
    data = _exon_count(spark, sf)
    cells = data.select("cell").distinct().where("cell < 'C'")
    genes = data.select("gene").distinct().where("right(gene, 1) in ('1', '4', '7')")
    part = exons.subset(exons.splice_object(data), cells, genes)
    return part.isoforms.select("cell", "cell_id", "gene", "exons", "size")


# ------------------------------------------------------------- exon tables and psi

tb.sql_table(
    "exon_rows",
    "exon_count",
    """SELECT *, "polyA" >= 0.5 AS tail, list_transform(string_split(exons, '|'), lambda x: try_cast(x AS bigint)) AS ids FROM exon_count WHERE count > 0""",
)
tb.sql_table(
    "exon_states",
    "exon_rows",
    """SELECT p.gene, p.exons, p.tail, k.exon, cast(CASE WHEN contains(p.exons, 'N') THEN NULL WHEN list_contains(p.ids, k.exon) THEN 1
        WHEN k.exon < list_min(p.ids) OR (k.exon > list_max(p.ids) AND NOT p.tail) THEN NULL ELSE 0 END AS int) AS state
       FROM (SELECT DISTINCT gene, exons, tail, ids FROM exon_rows) p JOIN (SELECT DISTINCT gene, unnest(ids) AS exon FROM exon_rows
            WHERE NOT contains(exons, 'N')) k USING (gene)""",
)
tb.sql_table(
    "exon_flags",
    "exon_states",
    """SELECT gene, a, b, cast(CASE WHEN a = b THEN 1 WHEN differ NOT IN (0, seen) THEN 0 WHEN apart = 0 THEN 1 END AS int) AS flag, differ FROM (
        SELECT x.gene, x.exon AS a, y.exon AS b, coalesce(sum((x.state <> y.state)::int), 0)::bigint AS differ, count(x.state) AS seen,
            sum(((x.state IS NULL) <> (y.state IS NULL))::int)::bigint AS apart
        FROM exon_states x JOIN exon_states y ON x.gene = y.gene AND x.exons = y.exons AND x.tail = y.tail AND x.exon <= y.exon
        GROUP BY x.gene, x.exon, y.exon)""",
)
# Without annotation, mergeable is an equivalence, so a module is everything tied to its smallest exon.
tb.sql_table(
    "exon_module",
    "exon_flags",
    """SELECT gene, exon, string_agg(exon, '|') OVER (PARTITION BY gene, root ORDER BY exon ROWS BETWEEN UNBOUNDED PRECEDING
        AND UNBOUNDED FOLLOWING) AS module, root FROM (SELECT gene, b AS exon, min(a) AS root FROM exon_flags WHERE flag = 1 GROUP BY gene, b)""",
)
tb.sql_table(
    "merged_states",
    "exon_states exon_module exon_flags",
    """SELECT s.gene, s.exons, s.tail, m.module AS exon, max(CASE WHEN f.differ > 0 THEN 1 - s.state ELSE s.state END) AS state
       FROM exon_states s JOIN exon_module m USING (gene, exon) JOIN exon_flags f ON f.gene = m.gene AND f.a = m.root AND f.b = m.exon
       GROUP BY s.gene, s.exons, s.tail, m.module""",
)
tb.sql_table(
    "inclusion",
    "merged_states exon_rows parts",
    """SELECT r.gene, r.cell, m.exon, sum(r.count) AS den, sum(CASE WHEN m.state = 1 THEN r.count ELSE 0 END) AS num
       FROM exon_rows r JOIN merged_states m ON m.gene = r.gene AND m.exons = r.exons AND m.tail = r.tail AND m.state IS NOT NULL
       JOIN (SELECT gene, exon FROM (SELECT DISTINCT gene, exon, unnest(string_split(exon, '|'))::bigint AS exon_id FROM merged_states)
             JOIN parts USING (gene, exon_id) GROUP BY gene, exon HAVING sum(width) >= 10) l ON l.gene = m.gene AND l.exon = m.exon
       GROUP BY r.gene, r.cell, m.exon""",
)
tb.sql_table("psi_table", "inclusion", "SELECT gene, cell, exon, num / den AS psi FROM inclusion WHERE den >= 10")


def _double(df, column):
    """Nullable flags leave as doubles, which keep NULL apart from 0 everywhere."""
    return df.withColumn(column, F.col(column).cast("double"))


def _states(spark, sf):
    return psi.exon_table(_exon_count(spark, sf).where("count > 0"))


def _flags(spark, sf):
    return psi.merge_flags(_states(spark, sf))


def _psi(spark, sf):
    return stored(spark, f"psi:{sf}", lambda: psi.gene_psi(_exon_count(spark, sf), tb.gene_bed(spark, sf)))


@query("et_table", "exon_states", "SELECT * REPLACE (state::double AS state) FROM exon_states")
def et_table(spark, sf):
    return _double(_states(spark, sf), "state")


@query("et_if_merge", "exon_flags", "SELECT gene, a, b, flag::double AS flag FROM exon_flags WHERE a < b")
def et_if_merge(spark, sf):
    return _double(_flags(spark, sf).where("a < b").drop("differ"), "flag")


@query(
    "et_flag",
    "exon_flags",
    "SELECT gene, a, b, flag::double AS flag FROM exon_flags UNION ALL SELECT gene, b, a, flag FROM exon_flags WHERE a < b",
)
def et_flag(spark, sf):
    f = _double(_flags(spark, sf).drop("differ"), "flag")
    return f.unionByName(f.where("a < b").select("gene", F.col("b").alias("a"), F.col("a").alias("b"), "flag"))


tb.sql_table(
    "anno_flags",
    "tx_exons",
    """SELECT x.gene, x.exon AS a, y.exon AS b, cast(x.exon = y.exon OR sum((x.v <> y.v)::int) IN (0, count(*)) AS int) AS anno FROM (
        SELECT t.gene, t.transname, k.exon, list_contains(string_split(t.exons, '|'), k.exon::varchar)::int AS v FROM tx_exons t JOIN
            (SELECT DISTINCT gene, unnest(string_split(exons, '|'))::bigint AS exon FROM tx_exons) k USING (gene)) x
       JOIN (SELECT t.gene, t.transname, k.exon, list_contains(string_split(t.exons, '|'), k.exon::varchar)::int AS v FROM tx_exons t JOIN
            (SELECT DISTINCT gene, unnest(string_split(exons, '|'))::bigint AS exon FROM tx_exons) k USING (gene)) y
       ON x.gene = y.gene AND x.transname = y.transname AND x.exon <= y.exon GROUP BY x.gene, x.exon, y.exon""",
)


def _anno(spark, sf):
    return psi.annotation_flags(tb.gtf_exons(spark, sf), annotation.numbered_parts(tb.gene_bed(spark, sf)))


@query(
    "et_combine",
    "exon_flags anno_flags",
    "SELECT f.gene, f.a, f.b, coalesce(flag, anno, 0) AS flag FROM exon_flags f LEFT JOIN anno_flags USING (gene, a, b)",
)
def et_combine(spark, sf):
    return psi.combined_flags(_flags(spark, sf), _anno(spark, sf)).drop("differ")


def _modules(spark, sf, anno=None):
    return psi.exon_modules(psi.combined_flags(_flags(spark, sf), anno))


@query("et_modules", "exon_module", "SELECT gene, exon, module FROM exon_module")
def et_modules(spark, sf):
    return _modules(spark, sf).drop("first")


@query("et_matrix_merge")
def et_matrix_merge(spark, sf):
    return _modules(spark, sf, _anno(spark, sf)).drop("first")


@query("et_search", "exon_module", "SELECT gene, exon, module FROM exon_module WHERE exon = 3")
def et_search(spark, sf):
    wanted = _exon_count(spark, sf).select("gene").distinct().withColumn("exon", F.lit(3).cast("bigint"))
    return psi.find_module(_modules(spark, sf), wanted)


@query(
    "et_pair_merge",
    "exon_states",
    """, k AS (SELECT gene, exon AS a, lead(exon) OVER (PARTITION BY gene ORDER BY exon) AS b FROM (SELECT DISTINCT gene, exon FROM exon_states)),
    p AS (SELECT x.gene, x.exons, x.tail, k.a, k.b, x.state AS sa, y.state AS sb FROM k JOIN exon_states x ON x.gene = k.gene AND x.exon = k.a
        JOIN exon_states y ON y.gene = x.gene AND y.exons = x.exons AND y.tail = x.tail AND y.exon = k.b)
    SELECT gene, exons, tail, a, b, coalesce(sa, CASE WHEN flip THEN 1 - sb ELSE sb END)::double AS state FROM p JOIN
        (SELECT gene, a, b, coalesce(bool_or(sa <> sb), FALSE) AS flip FROM p GROUP BY gene, a, b) USING (gene, a, b)""",
)
def et_pair_merge(spark, sf):
    t = cut(_states(spark, sf))
    return _double(psi.merge_pairs(t, psi.neighbours(t)), "state")


@query("et_list_merge", "merged_states", "SELECT gene, exons, tail, exon, state::double AS state FROM merged_states")
def et_list_merge(spark, sf):
    return _double(psi.merge_exons(_exon_count(spark, sf)), "state")


@query("et_multi_merge", "merged_states", "SELECT gene, exon, count(state) AS seen, sum(state)::bigint AS held FROM merged_states GROUP BY gene, exon")
def et_multi_merge(spark, sf):
    m = psi.merge_exons(_exon_count(spark, sf))
    return m.groupBy("gene", "exon").agg(F.count("state").alias("seen"), F.sum("state").alias("held"))


@query("et_merge")
def et_merge(spark, sf):
    return psi.merge_exons(_exon_count(spark, sf), _anno(spark, sf))


@query(
    "et_extract",
    "merged_states parts",
    """SELECT m.gene, m.exons, m.tail, m.exon, m.state::double AS state FROM merged_states m SEMI JOIN (SELECT gene, exon FROM
        (SELECT DISTINCT gene, exon, unnest(string_split(exon, '|'))::bigint AS exon_id FROM merged_states)
        JOIN parts USING (gene, exon_id) GROUP BY gene, exon HAVING sum(width) >= 10) l USING (gene, exon)""",
)
def et_extract(spark, sf):
    return _double(_extracted(spark, sf), "state")


def _extracted(spark, sf):
    m = psi.merge_exons(_exon_count(spark, sf))
    parts = annotation.numbered_parts(tb.gene_bed(spark, sf))
    return m.join(annotation.long_enough(m.select("gene", "exon").distinct(), parts), ["gene", "exon"], "left_semi")


@query("ps_counts", "inclusion", "SELECT gene, cell, exon, round(den, 6) AS den, round(num, 6) AS num FROM inclusion")
def ps_counts(spark, sf):
    rows = _exon_count(spark, sf)
    table = _extracted(spark, sf)
    counts = psi.inclusion_counts(rows, table)
    return counts.select("gene", "cell", "exon", F.round("den", 6).alias("den"), F.round("num", 6).alias("num"))


@query("ps_psi", "psi_table", "SELECT gene, cell, exon, round(psi, 10) AS psi FROM psi_table")
def ps_psi(spark, sf):
    out = psi.gene_psi(_exon_count(spark, sf), tb.gene_bed(spark, sf))
    return out.withColumn("psi", F.round("psi", 10))


@query(
    "ps_phi",
    "psi_table",
    """SELECT gene, exon, round(avg(psi), 6) AS mean_psi, round(CASE WHEN avg(psi) * (1 - avg(psi)) > 0 THEN var_samp(psi) / (avg(psi) * (1 - avg(psi))) END, 6) AS phi,
        count(*) AS count FROM psi_table GROUP BY gene, exon HAVING count(*) >= 30""",
)
def ps_phi(spark, sf):
    out = psi.phi(_psi(spark, sf), CFG.min_cells)
    return out.withColumn("mean_psi", F.round("mean_psi", 6)).withColumn("phi", F.round("phi", 6))


# Percentile bounds over replicates with Poisson weights drawn by md5, as the operator draws them.
_POISSON_SQL = " + ".join(f"(u >= {p!r}::double)::int" for p in psi.POISSON_ONE)


def _interval_sql(values):
    return f"""b AS (SELECT gene, exon, rep, sum(w) AS n, sum(w * psi) AS s, sum(w * psi * psi) AS q FROM (SELECT *, ({_POISSON_SQL})::double AS w FROM
        (SELECT *, ('0x' || substr(md5(concat_ws('/', gene, exon, cell, rep)), 1, 8))::bigint / 4294967296.0::double AS u
         FROM {values}, (SELECT unnest(range(1, {CFG.iters + 1})) AS rep))) GROUP BY gene, exon, rep),
    v AS (SELECT gene, exon, s / n AS m, (q - n * (s / n) * (s / n)) / (n - 1) AS var FROM b WHERE n > 1),
    i AS (SELECT gene, exon, avg(var / (m * (1 - m))) AS phi, quantile_cont(var / (m * (1 - m)), 0.025) AS phi_lwr,
        quantile_cont(var / (m * (1 - m)), 0.975) AS phi_upr FROM v WHERE m * (1 - m) <> 0 GROUP BY gene, exon)"""


def _point_sql(values, cells):
    return f"t AS (SELECT gene, exon, avg(psi) AS mean_psi, count(*) AS count FROM {values} GROUP BY gene, exon HAVING count(*) >= {cells})"


_PHI_ROW = "SELECT exon, round(mean_psi, 6) AS mean_psi, round(phi, 5) AS phi, round(phi_lwr, 5) AS phi_lwr, round(phi_upr, 5) AS phi_upr, count, gene FROM t LEFT JOIN i USING (gene, exon)"


def _rounded(phi):
    return phi.select("exon", F.round("mean_psi", 6).alias("mean_psi"), *[F.round(c, 5).alias(c) for c in ("phi", "phi_lwr", "phi_upr")], "count", "gene")


@query(
    "ps_phi_conf",
    "psi_table",
    f", {_interval_sql('psi_table')} SELECT gene, exon, round(phi, 5) AS phi, round(phi_lwr, 5) AS phi_lwr, round(phi_upr, 5) AS phi_upr FROM i",
)
def ps_phi_conf(spark, sf):
    out = psi.phi_interval(_psi(spark, sf), CFG.iters)
    return out.select("gene", "exon", *[F.round(c, 5).alias(c) for c in ("phi", "phi_lwr", "phi_upr")])


@query("ps_gene_phi", "psi_table", f", {_interval_sql('psi_table')}, {_point_sql('psi_table', CFG.min_cells)} {_PHI_ROW}")
def ps_gene_phi(spark, sf):
    return _rounded(psi.gene_phi(_psi(spark, sf), CFG))


@query(
    "ps_select",
    "psi_table merged_states exon_rows",
    """, c AS (SELECT cell FROM exon_rows GROUP BY cell HAVING sum(count) >= (SELECT median(n) FROM (SELECT sum(count) AS n FROM exon_rows GROUP BY cell)))
    SELECT gene, cell, exon, round(psi, 10) AS psi FROM psi_table SEMI JOIN c USING (cell) WHERE list_contains(string_split(exon, '|'), '3')""",
)
def ps_select(spark, sf):
    rows = _exon_count(spark, sf)
    sums = rows.where("count > 0").groupBy("cell").agg(F.sum("count").alias("n"))
    cells = sums.where(F.col("n") >= sums.agg(F.median("n").alias("m")).select("m").scalar())
    wanted = rows.select("gene").distinct().withColumn("exon", F.lit(3).cast("bigint"))
    out = psi.gene_psi(rows, tb.gene_bed(spark, sf), cells=cells, exons=wanted)
    return out.withColumn("psi", F.round("psi", 10))



# ------------------------------------------------------------- censored psi

tb.sql_table("exon_numbers_bed", "exon_grid", "SELECT gene, i AS exon_id FROM exon_grid")
tb.sql_table(
    "plain_transcripts",
    "exon_grid",
    """SELECT gene, string_agg(i, '|' ORDER BY i) AS exons FROM exon_grid GROUP BY gene
       UNION ALL SELECT gene, string_agg(i, '|' ORDER BY i) FROM exon_grid WHERE i <> 2 GROUP BY gene""",
)
tb.sql_table(
    "truncated",
    "exon_coverage_reads exon_numbers_bed plain_transcripts",
    """SELECT *, cast(CASE WHEN tp <> hi AND cov[list_position(ids, tp)] < 0.9 THEN 3 ELSE 0 END
        + CASE WHEN lw <> lo AND cov[list_position(ids, lw)] < 0.9 THEN 5 ELSE 0 END AS int) AS trunc FROM (
        SELECT r.*, list_min(ids) AS lw, list_max(ids) AS tp, b.lo, b.hi, t.exons IS NOT NULL AS ann FROM (
            SELECT *, list_transform(string_split(exon, '|'), lambda x: x::bigint) AS ids,
                list_transform(string_split(coverage, '|'), lambda x: x::double) AS cov FROM exon_coverage_reads) r
        JOIN (SELECT gene, min(exon_id) AS lo, max(exon_id) AS hi FROM exon_numbers_bed GROUP BY gene) b USING (gene)
        LEFT JOIN plain_transcripts t ON t.gene = r.gene AND t.exons = r.exon)""",
)
tb.sql_table(
    "censored",
    "truncated",
    """SELECT gene, cell, here AS exon, sum(list_contains(ids, here)::int) / count(*) AS psi FROM (
        SELECT gene, cell, ids, unnest(range(CASE WHEN trunc = 3 THEN lo ELSE lw END,
            CASE WHEN trunc = 5 AND "polyA" > 0.5 THEN hi ELSE tp END + 1)) AS here FROM truncated WHERE trunc > 0)
       GROUP BY gene, cell, here HAVING count(*) >= 5""",
)


def _truncated(spark, sf):
    bed = tb.table(spark, sf, "supplier").selectExpr(
        "concat('ENSG', lpad(cast(s_suppkey as string), 11, '0')) as gene", "explode(sequence(1L, 4 + s_suppkey % 5)) as exon_id"
    )

    def texts(df):
        ids = df.groupBy("gene").agg(F.sort_array(F.collect_list("exon_id")).alias("x"))
        return ids.select("gene", F.array_join(F.transform("x", lambda v: v.cast("string")), "|").alias("exons"))

    transcripts = texts(bed).unionByName(texts(bed.where("exon_id <> 2")))
    return psi.truncation(tb.exon_coverage_reads(spark, sf), bed, transcripts)


@query("pc_split", "truncated", "SELECT read_name, unnest(ids) AS exon FROM truncated")
def pc_split(spark, sf):
    return tb.exon_coverage_reads(spark, sf).select("read_name", F.explode(psi.exon_ids(F.col("exon"))).alias("exon"))


@query("pc_trunc", "truncated", "SELECT read_name, gene, exon, trunc, ann FROM truncated")
def pc_trunc(spark, sf):
    return _truncated(spark, sf).select("read_name", "gene", "exon", "trunc", "ann")


@query("pc_psi", "censored", "SELECT gene, cell, exon, round(psi, 6) AS psi FROM censored")
def pc_psi(spark, sf):
    return psi.censored_psi(_truncated(spark, sf), CFG.censored_min_reads).withColumn("psi", F.round("psi", 6))


@query("pc_phi", "censored", f", {_interval_sql('censored')}, {_point_sql('censored', CFG.censored_min_cells)} {_PHI_ROW}")
def pc_phi(spark, sf):
    values = psi.censored_psi(_truncated(spark, sf), CFG.censored_min_reads)
    return _rounded(psi.gene_phi(values, CFG, min_cells=CFG.censored_min_cells))
