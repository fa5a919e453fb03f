"""UMI de-duplication queries."""

from pyspark.sql import functions as F

from isoquilt.config import UmiConfig
from isoquilt.functions import intervals
from isoquilt.functions.align import global_score
from isoquilt.operators import umi
from isoquilt.plans import testbed as tb
from isoquilt.plans.registry import query
from isoquilt.session import compute_once, cut, release

CFG = UmiConfig()

tb.sql_table(
    "busy",
    "cell_exon",
    "SELECT * FROM cell_exon WHERE gene IN (SELECT gene FROM cell_exon GROUP BY gene HAVING count(*) >= 10)",
)
tb.sql_table(
    "umi_reads",
    "busy",
    "SELECT * FROM (SELECT *, substr(seq, cast(trunc(start) AS bigint) + 16, 12) AS umi FROM busy) WHERE length(umi) = 12",
)
tb.sql_table(
    "nodes",
    "umi_reads",
    """SELECT gene, barcode AS cell, isoform, umi, count(*) AS n, sum("polyA"::int)::bigint AS n_polya,
        concat(umi, '/', isoform) AS id FROM umi_reads GROUP BY gene, barcode, isoform, umi""",
)
_BLK = "list_transform(string_split({x}, '|'), lambda b: {{'s': split_part(b, ',', 1)::bigint, 'e': split_part(b, ',', 2)::bigint}})"
_LEN = "coalesce(list_sum(list_transform({x}, lambda b: b.e - b.s + 1)), 0)"
_INTER = (
    "coalesce(list_sum(list_transform({x}, lambda p: coalesce(list_sum(list_transform({y}, "
    "lambda r: greatest(0, least(p.e, r.e) - greatest(p.s, r.s) + 1))), 0))), 0)"
)
_CHOP = (
    "list_transform(list_filter({x}, lambda b: b.e > st AND b.s < en), "
    "lambda b: {{'s': greatest(b.s, st), 'e': least(b.e, en)}})"
)
tb.sql_table("gene_isoforms", "nodes", f"SELECT DISTINCT gene, isoform, {_BLK.format(x='isoform')} AS bl FROM nodes")
tb.sql_table("cell_isoforms", "nodes", "SELECT DISTINCT gene, cell, isoform FROM nodes")
tb.sql_table(
    "cell_iso_pairs",
    "cell_isoforms",
    """SELECT DISTINCT a.gene, a.isoform AS iso_a, b.isoform AS iso_b FROM cell_isoforms a JOIN cell_isoforms b
       ON a.gene = b.gene AND a.cell = b.cell AND a.isoform < b.isoform""",
)
tb.sql_table(
    "iso_dis",
    "cell_iso_pairs gene_isoforms",
    f"""SELECT gene, iso_a, iso_b, CASE WHEN st >= en THEN -1 ELSE
        {_LEN.format(x='ca')} + {_LEN.format(x='cb')} - 2 * {_INTER.format(x='ca', y='cb')} END AS dis FROM (
        SELECT *, {_CHOP.format(x='ba')} AS ca, {_CHOP.format(x='bb')} AS cb FROM (
            SELECT p.gene, iso_a, iso_b, x.bl AS ba, y.bl AS bb, greatest(x.bl[1].s, y.bl[1].s) AS st,
                least(x.bl[-1].e, y.bl[-1].e) AS en
            FROM cell_iso_pairs p JOIN gene_isoforms x ON x.gene = p.gene AND x.isoform = iso_a
            JOIN gene_isoforms y ON y.gene = p.gene AND y.isoform = iso_b))""",
)
tb.sql_table(
    "iso_ok",
    "iso_dis cell_isoforms",
    """SELECT gene, iso_a, iso_b FROM iso_dis WHERE dis BETWEEN 0 AND 80
       UNION ALL SELECT gene, iso_b, iso_a FROM iso_dis WHERE dis BETWEEN 0 AND 80
       UNION ALL SELECT DISTINCT gene, isoform, isoform FROM cell_isoforms""",
)
# Every UMI pair of a cell with a compatible isoform, no blocking.
tb.sql_table(
    "umi_pairs",
    "nodes iso_ok",
    """SELECT a.gene, a.cell, a.id AS a, b.id AS b, a.umi AS ua, b.umi AS ub, a.n AS na, b.n AS nb
       FROM nodes a JOIN nodes b ON a.gene = b.gene AND a.cell = b.cell AND a.id < b.id
       JOIN iso_ok o ON o.gene = a.gene AND o.iso_a = a.isoform AND o.iso_b = b.isoform""",
)
# Global score as a row-by-row fold: each new row is built left to right from the one above.
tb.sql_table(
    "umi_scores",
    "umi_pairs",
    """SELECT ua, ub, list_reduce(list_prepend(range(0, -13, -1)::bigint[], list_transform(range(1, 13), lambda i: [i])::bigint[][]),
        lambda prev, step: list_reduce(
            list_prepend([-step[1]]::bigint[], list_transform(range(1, 13), lambda j: [j])::bigint[][]),
            lambda row, jj: list_append(row, greatest(
                prev[jj[1]] + CASE WHEN substr(ua, step[1], 1) = substr(ub, jj[1], 1) THEN 1 ELSE -1 END,
                greatest(prev[jj[1] + 1], row[jj[1]]) - 1))))[13] AS score
       FROM (SELECT DISTINCT ua, ub FROM umi_pairs WHERE levenshtein(ua, ub) <= 7)""",
)
tb.sql_table(
    "umi_edges",
    "umi_pairs umi_scores",
    """SELECT gene, cell, a, b, na, nb, score, na * nb AS capacity, na * nb * score AS ns
       FROM umi_pairs JOIN umi_scores USING (ua, ub) WHERE score >= 5""",
)


def _cell_exon(spark, sf):
    return tb.cell_exon(spark, sf)


def _nodes(spark, sf):
    return umi.compress(umi.with_umi(umi.busy_genes(_cell_exon(spark, sf), CFG), CFG))


def _edges(spark, sf):
    return umi.similar_edges(_kept(spark, sf), CFG)


def _kept(spark, sf):
    """Nodes that are read again; what they took is not needed any more."""
    nodes = cut(_nodes(spark, sf))
    release(spark)
    return nodes


def _named(edges):
    """Readable names for the node ids of edges with their texts."""
    rest = [c for c in edges.columns if c not in ("gene", "cell", "a", "b", *umi.TEXTS)]
    an, bn = F.concat_ws("/", "umi_a", "iso_a"), F.concat_ws("/", "umi_b", "iso_b")
    return edges.select("gene", "cell", F.least(an, bn).alias("a"), F.greatest(an, bn).alias("b"), *rest)


@query("um_main", "busy", "SELECT read_name, gene FROM busy")
def um_main(spark, sf):
    return umi.busy_genes(_cell_exon(spark, sf), CFG).select("read_name", "gene")


@query("um_window", "umi_reads", "SELECT read_name, umi FROM umi_reads")
def um_window(spark, sf):
    return umi.with_umi(umi.busy_genes(_cell_exon(spark, sf), CFG), CFG).select("read_name", "umi")


@query(
    "um_window_counts",
    "nodes",
    """SELECT cell, gene, isoform, sum(n)::bigint AS size, count(*) AS cluster, round(sum(n_polya) / sum(n), 6) AS "polyA"
       FROM nodes GROUP BY cell, gene, isoform""",
)
def um_window_counts(spark, sf):
    return umi.exact_counts(_cell_exon(spark, sf), CFG).withColumn("polyA", F.round("polyA", 6))


@query("um_compress", "nodes", "SELECT gene, cell, isoform, umi, n, n_polya FROM nodes")
def um_compress(spark, sf):
    return _nodes(spark, sf).drop("id")


@query("um_parse_iso", "gene_isoforms", """SELECT gene, isoform, len(bl) AS n, bl[1].s AS s, bl[-1].e AS e FROM gene_isoforms""")
def um_parse_iso(spark, sf):
    iso = _nodes(spark, sf).select("gene", "isoform").distinct()
    b = intervals.parse_blocks(F.col("isoform"))
    return iso.select(
        "gene", "isoform", F.size(b).cast("bigint").alias("n"), F.element_at(b, 1)["s"].alias("s"), F.element_at(b, -1)["e"].alias("e")
    )


@query(
    "um_flatten",
    "gene_isoforms",
    "SELECT gene, isoform, array_to_string(flatten(list_transform(bl, lambda b: [b.s, b.e])), ' ') AS sites FROM gene_isoforms",
)
def um_flatten(spark, sf):
    iso = _nodes(spark, sf).select("gene", "isoform").distinct()
    sites = F.transform(intervals.site_list(F.col("isoform")), lambda s: s.cast("string"))
    return iso.select("gene", "isoform", F.array_join(sites, " ").alias("sites"))


@query("um_iso_len", "gene_isoforms", f"SELECT gene, isoform, {_LEN.format(x='bl')}::bigint AS len FROM gene_isoforms")
def um_iso_len(spark, sf):
    iso = _nodes(spark, sf).select("gene", "isoform").distinct()
    return iso.withColumn("len", intervals.total_length(intervals.parse_blocks(F.col("isoform"))))


@query(
    "um_bin_inter",
    "reads",
    """SELECT read_name, greatest(0, least(blocks[1].e, base + 200) - greatest(blocks[1].s, base + 20) + 1)::bigint AS common FROM reads""",
)
def um_bin_inter(spark, sf):
    b = F.element_at("blocks", 1)
    common = intervals.overlap(b["s"], b["e"], F.col("base") + 20, F.col("base") + 200).cast("bigint")
    return tb.reads(spark, sf).select("read_name", common.alias("common"))


@query(
    "um_chop",
    "reads",
    f"""SELECT read_name, array_to_string(list_transform({_CHOP.format(x='blocks')}, lambda b: concat(b.s, ',', b.e)), '|') AS part
        FROM (SELECT *, base + 50 AS st, base + 900 AS en FROM reads)""",
)
def um_chop(spark, sf):
    part = intervals.clip_blocks(F.col("blocks"), F.col("base") + 50, F.col("base") + 900)
    return tb.reads(spark, sf).select("read_name", intervals.format_blocks(part).alias("part"))


def _iso_pairs(spark, sf, most=None):
    iso = cut(_nodes(spark, sf).select("gene", "cell", "isoform").distinct())
    a, b = iso.withColumnRenamed("isoform", "iso_a"), iso.withColumnRenamed("isoform", "iso_b")
    pairs = a.join(b, ["gene", "cell"]).where("iso_a < iso_b").select("gene", "iso_a", "iso_b").distinct()
    dis = intervals.span_distance(intervals.parse_blocks(F.col("iso_a")), intervals.parse_blocks(F.col("iso_b")), most)
    return compute_once(pairs, dis=dis)


@query("um_iso_dis", "iso_dis", "SELECT gene, iso_a, iso_b, dis::bigint AS dis FROM iso_dis")
def um_iso_dis(spark, sf):
    return _iso_pairs(spark, sf)


@query("um_iso_pairs", "iso_dis", "SELECT gene, iso_a, iso_b FROM iso_dis WHERE dis BETWEEN 0 AND 80")
def um_iso_pairs(spark, sf):
    return _iso_pairs(spark, sf, 80).where("dis between 0 and 80").drop("dis")


@query("um_needle", "umi_scores", "SELECT gene, cell, a, b, score::int AS score FROM umi_pairs JOIN umi_scores USING (ua, ub) WHERE score >= 5")
def um_needle(spark, sf):
    edges = umi.similar_edges(_kept(spark, sf), CFG, texts=True).where("a <> b")
    return _named(edges).select("gene", "cell", "a", "b", "score")


@query("um_edges", "umi_edges", "SELECT gene, cell, a, b, capacity, ns::bigint AS ns FROM umi_edges")
def um_edges(spark, sf):
    edges = umi.similar_edges(_kept(spark, sf), CFG, texts=True).where("a <> b")
    return _named(edges).select("gene", "cell", "a", "b", "capacity", "ns")


@query(
    "um_graph",
    "umi_edges",
    """SELECT gene, cell, a, b, capacity, ns::bigint AS ns FROM umi_edges UNION ALL
       SELECT gene, cell, id, id, n * (n - 1) // 2, 12 * (n * (n - 1) // 2) FROM nodes WHERE n > 1""",
)
def um_graph(spark, sf):
    return _named(umi.similar_edges(_kept(spark, sf), CFG, texts=True)).select("gene", "cell", "a", "b", "capacity", "ns")


@query("um_graph_table", "umi_edges", "SELECT gene, cell, count(*) AS edges, sum(ns)::bigint AS ns FROM umi_edges GROUP BY gene, cell")
def um_graph_table(spark, sf):
    edges = _edges(spark, sf).where("a <> b")
    return edges.groupBy("gene", "cell").agg(F.count("*").alias("edges"), F.sum("ns").alias("ns"))


tb.sql_table(
    "umi_share",
    "umi_edges",
    """SELECT e.gene, e.cell, e.a, e.b, coalesce(sum(s.n), 0)::bigint AS share FROM umi_edges e LEFT JOIN (
        SELECT x.gene, x.cell, x.p AS a, y.p AS b, x.nm AS n FROM
            (SELECT gene, cell, a AS m, na AS nm, b AS p FROM umi_edges UNION ALL SELECT gene, cell, b, nb, a FROM umi_edges) x
            JOIN (SELECT gene, cell, a AS m, b AS p FROM umi_edges UNION ALL SELECT gene, cell, b, a FROM umi_edges) y
            ON x.gene = y.gene AND x.cell = y.cell AND x.m = y.m AND x.p < y.p) s
       ON s.gene = e.gene AND s.cell = e.cell AND s.a = e.a AND s.b = e.b GROUP BY e.gene, e.cell, e.a, e.b""",
)


@query("um_snn", "umi_share", "SELECT * FROM umi_share")
def um_snn(spark, sf):
    return _named(umi.shared_edges(_kept(spark, sf), CFG)).select("gene", "cell", "a", "b", "share")


@query(
    "um_snn_graph",
    "umi_share umi_edges nodes",
    """SELECT gene, cell, a, b, ns::bigint AS ns, share FROM umi_edges JOIN umi_share USING (gene, cell, a, b)
       UNION ALL SELECT gene, cell, id, id, 12 * (n * (n - 1) // 2), 1 FROM nodes WHERE n > 1""",
)
def um_snn_graph(spark, sf):
    full = _named(umi.shared_edges(_kept(spark, sf), CFG, itself=True))
    return full.select("gene", "cell", "a", "b", "ns", F.coalesce("share", F.lit(1)).alias("share"))


tb.sql_table(
    "umi_cc",
    "umi_edges nodes",
    """SELECT gene, cell, id, min(reach) AS component FROM (
        SELECT * FROM (WITH RECURSIVE links AS (SELECT gene, cell, a, b FROM umi_edges UNION SELECT gene, cell, b, a FROM umi_edges),
            walk AS (SELECT gene, cell, id, id AS reach FROM nodes UNION
                SELECT w.gene, w.cell, w.id, l.b FROM walk w JOIN links l ON l.gene = w.gene AND l.cell = w.cell AND l.a = w.reach)
            SELECT * FROM walk)) GROUP BY gene, cell, id""",
)


@query(
    "um_cc",
    "umi_cc",
    "SELECT gene, cell, component AS first, count(*) AS size FROM umi_cc GROUP BY gene, cell, component HAVING count(*) > 1",
)
def um_cc(spark, sf):
    nodes = _kept(spark, sf)
    cc = umi.node_components(nodes, CFG)
    named = cc.join(nodes.select("gene", "cell", "id", F.concat_ws("/", "umi", "isoform").alias("name")), ["gene", "cell", "id"])
    return (
        named.groupBy("gene", "cell", "component")
        .agg(F.min("name").alias("first"), F.count("*").alias("size"))
        .drop("component")
    )


def _clustered(spark, sf):
    return umi.cluster(_kept(spark, sf), CFG)


@query("um_louvain")
def um_louvain(spark, sf):
    return (
        _clustered(spark, sf)
        .groupBy("gene", "cell", "cluster")
        .agg(F.sum("n").alias("size"), F.count("*").alias("nodes"))
    )


@query("um_labels")
def um_labels(spark, sf):
    reads = umi.with_umi(umi.busy_genes(_cell_exon(spark, sf), CFG), CFG)
    return umi.read_clusters(reads, _clustered(spark, sf)).select("read_name", "gene", "barcode", "cluster")


@query("um_cell_loop")
def um_cell_loop(spark, sf):
    return (
        _clustered(spark, sf)
        .groupBy("gene", "cell")
        .agg(F.count_distinct("cluster").alias("molecules"), F.sum("n").alias("reads"))
    )


# What every clustering must keep: reads and nodes of a cell, clusters inside one component, and
# components of up to three nodes (the bound of the cut) in one piece.
@query(
    "um_cluster_check",
    "umi_cc nodes",
    """, c AS (SELECT gene, cell, component, count(*) AS size FROM umi_cc GROUP BY gene, cell, component),
    k AS (SELECT gene, cell, count(*) AS components, count(*) FILTER (size <= 3) AS small FROM c GROUP BY gene, cell)
    SELECT gene, cell, nodes, reads, components, small, small AS small_whole, 0::bigint AS crossing
    FROM k JOIN (SELECT gene, cell, count(*) AS nodes, sum(n)::bigint AS reads FROM nodes GROUP BY gene, cell) USING (gene, cell)""",
)
def um_cluster_check(spark, sf):
    nodes = _kept(spark, sf)
    clustered = umi.cluster(nodes, CFG)
    parts = umi.node_components(nodes, CFG)
    both = cut(
        clustered.join(parts, [*umi.KEYS, "id"], "left").withColumn("component", F.coalesce("component", "id"))
    )
    per = both.groupBy(*umi.KEYS, "component").agg(F.count("*").alias("size"), F.count_distinct("cluster").alias("clusters"))
    small = F.col("size") <= CFG.cut_alpha
    shape = per.groupBy(*umi.KEYS).agg(
        F.count("*").alias("components"),
        F.count_if(small).alias("small"),
        F.count_if(small & (F.col("clusters") == 1)).alias("small_whole"),
    )
    spread = both.groupBy(*umi.KEYS, "cluster").agg(F.count_distinct("component").alias("c"))
    crossing = spread.groupBy(*umi.KEYS).agg(F.count_if(F.col("c") > 1).alias("crossing"))
    sums = both.groupBy(*umi.KEYS).agg(F.count("*").alias("nodes"), F.sum("n").alias("reads"))
    return sums.join(shape, umi.KEYS).join(crossing, umi.KEYS)
