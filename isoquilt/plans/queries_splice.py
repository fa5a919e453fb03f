"""Splice voting and size filter queries."""

from pyspark.sql import functions as F

from isoquilt.config import UmiConfig
from isoquilt.functions import intervals, stats
from isoquilt.operators import sizes, splice
from isoquilt.plans import testbed as tb
from isoquilt.plans.registry import query
from isoquilt.session import stored

CFG = UmiConfig()
_B = "list_transform(string_split({x}, '|'), lambda b: {{'s': split_part(b, ',', 1)::bigint, 'e': split_part(b, ',', 2)::bigint}})"

# Nodes whose molecule is known from the simulation.
tb.sql_table(
    "voting",
    "reads",
    """SELECT gene, cell, molecule AS cluster, isoform, count(*) AS n, sum((rf = 'A')::int)::bigint AS n_polya
       FROM reads GROUP BY gene, cell, molecule, isoform""",
)


def _voting(spark, sf):
    return (
        tb.dealt_reads(spark, sf, "gene", "cell", "molecule")
        .groupBy("gene", "cell", F.col("molecule").alias("cluster"), "isoform")
        .agg(F.count("*").alias("n"), F.sum((F.col("rf") == "A").cast("bigint")).alias("n_polya"))
    )


tb.sql_table(
    "iso_sites",
    "voting",
    """SELECT gene, isoform, unnest(list_transform(string_split(regexp_replace(isoform, '\\|', ',', 'g'), ','), lambda s: s::bigint)[2:-2])
       AS site FROM (SELECT DISTINCT gene, isoform FROM voting)""",
)
tb.sql_table(
    "site_reads",
    "voting iso_sites",
    """SELECT gene, site, sum(n)::bigint AS reads FROM iso_sites JOIN (SELECT gene, isoform, sum(n) AS n FROM voting GROUP BY ALL)
       USING (gene, isoform) GROUP BY gene, site""",
)
tb.sql_table(
    "splice_tab",
    "voting iso_sites site_reads",
    """SELECT k.gene, k.isoform, split_part(k.isoform, ',', 1)::bigint AS start,
        regexp_extract(k.isoform, '([0-9]+)$', 1)::bigint AS "end",
        string_agg(CASE WHEN i.site IS NULL THEN '0' ELSE '1' END, '' ORDER BY c.site) FILTER (c.site IS NOT NULL) AS mid
       FROM (SELECT DISTINCT gene, isoform FROM voting EXCEPT SELECT gene, isoform FROM iso_sites JOIN site_reads
             USING (gene, site) WHERE reads < 10) k
       LEFT JOIN (SELECT DISTINCT gene, site FROM iso_sites s WHERE NOT EXISTS (SELECT 1 FROM iso_sites t JOIN site_reads r
             USING (gene, site) WHERE r.reads < 10 AND t.gene = s.gene AND t.isoform = s.isoform)) c ON c.gene = k.gene
       LEFT JOIN iso_sites i ON i.gene = k.gene AND i.isoform = k.isoform AND i.site = c.site
       GROUP BY k.gene, k.isoform""",
)
tb.sql_table(
    "votes",
    "voting splice_tab",
    """SELECT gene, cell, cluster, isoform, coalesce(mid, 'null') AS mid, start, "end", n, n_polya
       FROM voting JOIN splice_tab USING (gene, isoform)""",
)
tb.sql_table(
    "modes",
    "votes",
    """SELECT *, first_value(mid) OVER (PARTITION BY gene, cell, cluster ORDER BY n DESC, mid) AS mode FROM (
        SELECT gene, cell, cluster, mid, sum(n)::bigint AS n FROM votes GROUP BY gene, cell, cluster, mid)""",
)
tb.sql_table(
    "good_mids",
    "modes",
    """SELECT gene, mid, led, other FROM (SELECT gene, mid, sum(CASE WHEN mid = mode THEN n ELSE 0 END)::bigint AS led,
        sum(CASE WHEN mid <> mode THEN n ELSE 0 END)::bigint AS other FROM modes GROUP BY gene, mid)
       WHERE led > 0 AND led >= 1.5 * other""",
)
tb.sql_table(
    "molecules",
    "votes modes good_mids",
    """SELECT gene, cell, cluster, mid, isoform, size, "polyA" FROM (
        SELECT v.gene, v.cell, v.cluster, v.mid, sum(v.n_polya) / sum(v.n) AS "polyA",
            min(concat(st, substr(v.isoform, length(v.start::varchar) + 1, length(v.isoform)
                - length(v.start::varchar) - length(v."end"::varchar)), en)) AS isoform
        FROM (SELECT *, first_value(start) OVER (PARTITION BY gene, cell, cluster ORDER BY sn DESC, start) AS st FROM (
                SELECT v.*, sum(v.n) OVER (PARTITION BY v.gene, v.cell, v.cluster, v.start) AS sn FROM votes v
                JOIN (SELECT gene, cell, cluster, arg_min(mid, (-n, mid)) AS mid FROM modes SEMI JOIN good_mids USING (gene, mid)
                      GROUP BY gene, cell, cluster) l USING (gene, cell, cluster, mid))) v
        JOIN (SELECT gene, cell, cluster, start, arg_max("end", (n, "end")) AS en FROM (
                SELECT v.gene, v.cell, v.cluster, v.start, v."end", sum(v.n) AS n FROM votes v
                JOIN (SELECT gene, cell, cluster, arg_min(mid, (-n, mid)) AS mid FROM modes SEMI JOIN good_mids USING (gene, mid)
                      GROUP BY gene, cell, cluster) l USING (gene, cell, cluster, mid) GROUP BY ALL) GROUP BY ALL) e
          ON e.gene = v.gene AND e.cell = v.cell AND e.cluster = v.cluster AND e.start = v.st
        GROUP BY v.gene, v.cell, v.cluster, v.mid)
       JOIN (SELECT gene, cell, cluster, sum(n)::bigint AS size FROM modes GROUP BY ALL) USING (gene, cell, cluster)""",
)


@query("sp_site", "iso_sites", "SELECT * FROM iso_sites")
def sp_site(spark, sf):
    iso = _voting(spark, sf).select("gene", "isoform").distinct()
    return iso.select("gene", "isoform", F.explode(intervals.inner_sites(F.col("isoform"))).alias("site"))


@query("sp_site_count", "site_reads", "SELECT * FROM site_reads")
def sp_site_count(spark, sf):
    return splice.site_counts(_voting(spark, sf))


@query("sp_table", "splice_tab", "SELECT * FROM splice_tab")
def sp_table(spark, sf):
    return splice.splice_table(_voting(spark, sf), CFG).drop("inner")


@query("sp_col_filter", "splice_tab", "SELECT gene, max(length(mid))::int AS sites FROM splice_tab GROUP BY gene")
def sp_col_filter(spark, sf):
    return splice.splice_table(_voting(spark, sf), CFG).groupBy("gene").agg(F.max(F.length("mid")).alias("sites"))


@query("sp_wide", "modes", "SELECT gene, mid AS iso1, mode AS iso2, sum(n)::bigint AS count FROM modes GROUP BY gene, mid, mode")
def sp_wide(spark, sf):
    modes = splice.pattern_modes(splice.voters(_voting(spark, sf), CFG))
    return modes.groupBy("gene", F.col("mid").alias("iso1"), F.col("mode").alias("iso2")).agg(F.sum("n").alias("count"))


@query("sp_cluster_mode", "modes", "SELECT * FROM modes")
def sp_cluster_mode(spark, sf):
    return splice.pattern_modes(splice.voters(_voting(spark, sf), CFG))


@query("sp_mid_filter", "good_mids", "SELECT * FROM good_mids")
def sp_mid_filter(spark, sf):
    return splice.supported_patterns(splice.pattern_modes(splice.voters(_voting(spark, sf), CFG)), CFG)


def _molecules(spark, sf):
    return stored(
        spark, f"molecules:{sf}", lambda: splice.correct_molecules(splice.voters(_voting(spark, sf), CFG), CFG)
    )


@query("sp_cluster_correct", "molecules", 'SELECT * REPLACE (round("polyA", 6) AS "polyA") FROM molecules')
def sp_cluster_correct(spark, sf):
    return _molecules(spark, sf).withColumn("polyA", F.round("polyA", 6))


@query("sp_cells_correct", "molecules", "SELECT gene, cell, count(*) AS molecules, sum(size)::bigint AS reads FROM molecules GROUP BY gene, cell")
def sp_cells_correct(spark, sf):
    return _molecules(spark, sf).groupBy("gene", "cell").agg(F.count("*").alias("molecules"), F.sum("size").alias("reads"))


@query("sp_recover", "splice_tab", "SELECT gene, isoform, isoform AS rebuilt FROM splice_tab WHERE mid IS NOT NULL")
def sp_recover(spark, sf):
    table = splice.splice_table(_voting(spark, sf), CFG)
    sites = table.groupBy("gene").agg(F.sort_array(F.array_distinct(F.flatten(F.collect_set("inner")))).alias("sites"))
    picked = splice.selected_sites(F.col("mid"), F.col("sites"))
    return table.join(sites, "gene").where("mid is not null").select(
        "gene", "isoform", splice.recover_isoform(F.col("start"), picked, F.col("end")).alias("rebuilt")
    )


@query(
    "sp_ratio",
    "cell_exon",
    "SELECT round(avg(CASE WHEN edit > 2 THEN 1.0 ELSE 0.0 END), 6) AS ratio, count(*) AS reads FROM cell_exon",
)
def sp_ratio(spark, sf):
    c = tb.cell_exon(spark, sf)
    share = F.avg((F.col("edit") > CFG.edit_error).cast("double"))
    return c.agg(F.round(share, 6).alias("ratio"), F.count("*").alias("reads"))


# ------------------------------------------------------------- size filter

tb.sql_table(
    "mol_iso_pairs",
    "molecules",
    f"""SELECT x.gene, x.cell, x.mid, x.isoform AS iso_a, y.isoform AS iso_b, x.len + y.len - 2 * coalesce(list_sum(list_transform(x.bl,
        lambda p: coalesce(list_sum(list_transform(y.bl, lambda r: greatest(0, least(p.e, r.e) - greatest(p.s, r.s) + 1))), 0))), 0) AS dis
       FROM (SELECT *, list_sum(list_transform(bl, lambda b: b.e - b.s + 1)) AS len FROM (SELECT DISTINCT gene, cell, mid, isoform, {_B.format(x='isoform')} AS bl FROM molecules)) x
       JOIN (SELECT *, list_sum(list_transform(bl, lambda b: b.e - b.s + 1)) AS len FROM (SELECT DISTINCT gene, cell, mid, isoform, {_B.format(x='isoform')} AS bl FROM molecules)) y
       ON x.gene = y.gene AND x.cell = y.cell AND x.mid = y.mid AND x.isoform < y.isoform""",
)


def _links(spark, sf):
    iso = _molecules(spark, sf).select(*sizes.GROUP, "isoform").distinct()
    links = sizes.isoform_links(iso, CFG.size_eps)
    a = iso.select(*sizes.GROUP, F.xxhash64("isoform").alias("a"), F.col("isoform").alias("ia"))
    b = iso.select(*sizes.GROUP, F.xxhash64("isoform").alias("b"), F.col("isoform").alias("ib"))
    return links.join(a, [*sizes.GROUP, "a"]).join(b, [*sizes.GROUP, "b"]).select(
        *sizes.GROUP, F.least("ia", "ib").alias("iso_a"), F.greatest("ia", "ib").alias("iso_b"), "dis"
    )


@query("sz_iso_dis", "mol_iso_pairs", "SELECT gene, cell, mid, iso_a, iso_b, dis::bigint AS dis FROM mol_iso_pairs WHERE dis <= 10")
def sz_iso_dis(spark, sf):
    return _links(spark, sf)


@query("sz_iso_pairs", "mol_iso_pairs", "SELECT gene, cell, count(*) AS pairs FROM mol_iso_pairs WHERE dis <= 10 GROUP BY gene, cell")
def sz_iso_pairs(spark, sf):
    return _links(spark, sf).groupBy("gene", "cell").agg(F.count("*").alias("pairs"))


tb.sql_table(
    "mol_groups",
    "molecules mol_iso_pairs",
    """SELECT gene, cell, mid, isoform, min(reach) AS root FROM (SELECT * FROM (WITH RECURSIVE
        links AS (SELECT gene, cell, mid, iso_a AS a, iso_b AS b FROM mol_iso_pairs WHERE dis <= 10
            UNION SELECT gene, cell, mid, iso_b, iso_a FROM mol_iso_pairs WHERE dis <= 10),
        walk AS (SELECT gene, cell, mid, isoform, isoform AS reach FROM molecules UNION SELECT w.gene, w.cell, w.mid, w.isoform, l.b
            FROM walk w JOIN links l ON l.gene = w.gene AND l.cell = w.cell AND l.mid = w.mid AND l.a = w.reach)
        SELECT * FROM walk)) GROUP BY gene, cell, mid, isoform""",
)


@query("sz_iso_cluster", "mol_groups", "SELECT gene, cell, mid, root, count(*) AS isoforms FROM mol_groups GROUP BY gene, cell, mid, root")
def sz_iso_cluster(spark, sf):
    iso = _molecules(spark, sf).select(*sizes.GROUP, "isoform").distinct()
    return (
        sizes.isoform_clusters(iso, CFG)
        .groupBy(*sizes.GROUP, "iso_cluster")
        .agg(F.min("isoform").alias("root"), F.count("*").alias("isoforms"))
        .drop("iso_cluster")
    )


# molecule sizes per gene and cell
tb.sql_table("sized", "voting", "SELECT gene, cell, cluster, sum(n)::bigint AS size FROM voting GROUP BY gene, cell, cluster")
tb.sql_table(
    "size_moments",
    "sized",
    "SELECT gene, count(*) AS n, avg(size) AS m, var_samp(size) AS v FROM sized GROUP BY gene HAVING count(*) > 1",
)


def _sized(spark, sf):
    return _voting(spark, sf).groupBy("gene", "cell", "cluster").agg(F.sum("n").alias("size"))


def _moments(spark, sf):
    m = _sized(spark, sf).groupBy("gene").agg(F.count("*").alias("n"), F.avg("size").alias("m"), F.var_samp("size").alias("v"))
    return m.where("n > 1")


@query("sz_mean2var", "size_moments", "SELECT gene, round(2.566 * m - 2.566, 6) AS expected FROM size_moments")
def sz_mean2var(spark, sf):
    return _moments(spark, sf).select("gene", F.round(stats.mean2var(F.col("m")), 6).alias("expected"))


_KURT = "6 * (w - m) / (m * m) + 1 / w + 3"


@query("sz_kurt", "size_moments", f"SELECT gene, round({_KURT}, 6) AS kurt FROM (SELECT *, 2.566 * m - 2.566 AS w FROM size_moments)")
def sz_kurt(spark, sf):
    k = stats.nbinom_kurtosis(F.col("m"), stats.mean2var(F.col("m")))
    return _moments(spark, sf).select("gene", F.round(k, 6).alias("kurt"))


@query(
    "sz_df",
    "size_moments",
    f"SELECT gene, round(2 * n / (({_KURT}) - (n - 3) / (n - 1)::double), 6) AS df FROM (SELECT *, 2.566 * m - 2.566 AS w FROM size_moments)",
)
def sz_df(spark, sf):
    df = stats.variance_df(F.col("m"), stats.mean2var(F.col("m")), F.col("n").cast("double"))
    return _moments(spark, sf).select("gene", F.round(df, 6).alias("df"))


@query("sz_pi")
def sz_pi(spark, sf):
    import pandas as pd

    def bounds(batches):
        for b in batches:
            v = stats.mean2var(b["m"].to_numpy())
            df = stats.variance_df(b["m"].to_numpy(), v, b["n"].to_numpy(float))
            low, high = (stats.chi2_quantile(p, df) * v / df for p in (0.025, 0.975))
            yield pd.DataFrame({"gene": b["gene"], "low": low, "high": high})

    return _moments(spark, sf).mapInPandas(bounds, "gene string, low double, high double")


@query(
    "sz_sub",
    "sized",
    """SELECT gene, size, count(*) AS copies, (sum(count(*)) OVER w)::bigint AS n,
        round((sum(sum(size)) OVER w) / (sum(count(*)) OVER w), 10) AS mean
       FROM sized GROUP BY gene, size WINDOW w AS (PARTITION BY gene ORDER BY size DESC)""",
)
def sz_sub(spark, sf):
    h = sizes.size_histogram(_sized(spark, sf), ["gene"])
    n = F.col("n_above") + F.col("copies")
    return h.select(
        "gene", "size", "copies", n.alias("n"), F.round((F.col("sum_above") + F.col("copies") * F.col("size")) / n, 10).alias("mean")
    )


@query(
    "sz_err",
    "sized",
    """, o AS (SELECT *, row_number() OVER w AS i, sum(size) OVER (w ROWS UNBOUNDED PRECEDING) AS seen, sum(size) OVER (PARTITION BY gene, cell) AS total,
        count(*) OVER (PARTITION BY gene, cell) AS n, max(size) OVER (PARTITION BY gene, cell) AS mx
        FROM sized WINDOW w AS (PARTITION BY gene, cell ORDER BY size DESC, cluster))
    SELECT gene, cell, (CASE WHEN n = 1 OR mx = 1 THEN n ELSE coalesce(min(CASE WHEN size > 1 AND seen::double * 0.2::double / (1 - 0.2::double) >= total - seen THEN i END),
        round_even(n - max(CASE WHEN size > 1 THEN seen::double * 0.2::double / (1 - 0.2::double) END), 0)) END)::bigint AS molecules
    FROM o GROUP BY gene, cell, n, mx""",
)
def sz_err(spark, sf):
    return sizes.count_by_error(_sized(spark, sf), ["gene", "cell"], 0.2)


@query("sz_pcr")
def sz_pcr(spark, sf):
    return sizes.count_by_pcr(_sized(spark, sf), ["gene", "cell"], 0.2)


@query("sz_filter")
def sz_filter(spark, sf):
    return sizes.noise_votes(_sized(spark, sf), ["gene", "cell"], 0.2, CFG.size_alpha)


@query("sz_iso")
def sz_iso(spark, sf):
    return sizes.isoform_counts(_molecules(spark, sf), 0.1, CFG)


@query("sz_cells")
def sz_cells(spark, sf):
    return sz_iso(spark, sf).groupBy("cell").agg(
        F.sum("size").alias("size"), F.sum("cluster").alias("cluster"), F.sum("count").alias("count")
    )
