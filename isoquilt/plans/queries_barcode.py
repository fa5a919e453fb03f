"""Barcode matching queries."""

from pyspark.sql import functions as F

from isoquilt.config import BarcodeConfig
from isoquilt.functions import seq, stats
from isoquilt.functions.align import infix_align
from isoquilt.operators import barcode as bc
from isoquilt.plans import testbed as tb
from isoquilt.plans.registry import query

CFG = BarcodeConfig()


def _softclips(spark, sf):
    return tb.reads(spark, sf).select("read_name", seq.last_bases(F.col("clip"), 55).alias("seq"))


tb.sql_table("softclips", "reads", "SELECT read_name, right(clip, 55) AS seq FROM reads")
tb.sql_table("windows", "softclips", "SELECT read_name, substr(seq, 1, 56) AS seq FROM softclips")
tb.sql_table(
    "bar_kmers",
    "whitelist",
    "SELECT DISTINCT barcode, substr(barcode, unnest(range(1, 10)), 8) AS kmer FROM whitelist",
)
tb.sql_table("kmer_dict", "bar_kmers", "SELECT kmer, count(*) AS df FROM bar_kmers GROUP BY kmer")
tb.sql_table(
    "read_kmers",
    "windows kmer_dict",
    """SELECT read_name, seq, kmer FROM (SELECT DISTINCT read_name, seq, substr(seq, unnest(range(1, length(seq) - 6)), 8)
        AS kmer FROM windows) JOIN kmer_dict USING (kmer)""",
)
tb.sql_table(
    "cos_pairs",
    "read_kmers bar_kmers",
    """SELECT p.read_name, p.seq, p.barcode, p.m / (sqrt(r.n) * sqrt(b.n)) AS cos FROM
        (SELECT read_name, seq, barcode, count(*) AS m FROM read_kmers JOIN bar_kmers USING (kmer) GROUP BY ALL) p
        JOIN (SELECT read_name, seq, count(*) AS n FROM read_kmers GROUP BY ALL) r USING (read_name, seq)
        JOIN (SELECT barcode, count(*) AS n FROM bar_kmers GROUP BY ALL) b USING (barcode)
        WHERE p.m / (sqrt(r.n) * sqrt(b.n)) >= 0.25""",
)
tb.sql_table(
    "cos_top",
    "cos_pairs",
    """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY read_name, seq ORDER BY cos DESC, barcode) AS rank
        FROM cos_pairs) WHERE rank <= 8""",
)
# All placements of a barcode with at most six edits: every substring of 10 to 22 letters.
tb.sql_table(
    "infix",
    "cos_top",
    """SELECT read_name, seq, barcode, rank, list_min(flatten(list_transform(range(1, length(seq) - 8),
        lambda i: list_transform(range(10, 23), lambda n: levenshtein(barcode, substr(seq, i, n)))))) AS edit FROM cos_top""",
)


# Placement of a pattern of 16 letters in a text as a fold over the text's letters: a column holds, for every pattern prefix, its edits
# times 1000 plus the column where the first letter's alignment is left; behind them stands the best of the whole pattern so far.
_PLACED = (
    "list_reduce(list_prepend(list_append(list_transform(range(0, 17), lambda i: i * 1000), 16000), "
    "list_transform(range(1, length({t}) + 1), lambda j: [j])), "
    "lambda before, step: list_transform([list_reduce(list_prepend([0]::bigint[], list_transform(range(1, 17), lambda i: [i])), "
    "lambda cur, pl: list_append(cur, "
    "(CASE WHEN substr({p}, pl[1], 1) = substr({t}, step[1], 1) THEN before[pl[1]] // 1000 "
    "ELSE least(cur[pl[1]], before[pl[1] + 1], before[pl[1]]) // 1000 + 1 END) * 1000 + "
    "CASE WHEN pl[1] = 1 THEN step[1] "
    "WHEN cur[pl[1]] // 1000 <= least(before[pl[1] + 1], before[pl[1]]) // 1000 THEN cur[pl[1]] % 1000 "
    "WHEN before[pl[1]] // 1000 <= before[pl[1] + 1] // 1000 THEN before[pl[1]] % 1000 "
    "ELSE before[pl[1] + 1] % 1000 END))], "
    "lambda now: list_append(now, CASE WHEN now[17] // 1000 < before[18] // 1000 THEN now[17] ELSE before[18] END))[1])[18]"
)
tb.sql_table(
    "placed",
    "cos_top",
    f"""SELECT read_name, seq, barcode, rank, v // 1000 AS edit, v % 1000 AS pos FROM cos_top JOIN (
        SELECT seq, barcode, {_PLACED.format(t='seq', p='barcode')} AS v FROM (SELECT DISTINCT seq, barcode FROM cos_top)) USING (seq, barcode)""",
)
tb.sql_table(
    "best_match",
    "placed",
    """SELECT read_name, barcode, round(0.4003602 + pos, 4) AS start, edit::int AS edit FROM (SELECT *, row_number() OVER (
        PARTITION BY read_name, seq ORDER BY edit, abs(pos - 20.0), rank, barcode) AS nth FROM placed WHERE edit <= 6) WHERE nth = 1""",
)


@query("bm_kmer_dict", "kmer_dict", "SELECT * FROM kmer_dict")
def bm_kmer_dict(spark, sf):
    return bc.kmer_dictionary(tb.whitelist(spark, sf), CFG.k)


@query(
    "bm_kmer",
    "softclips",
    """SELECT read_name, array_to_string(list_transform(range(1, length(seq) - 6), lambda i: substr(seq, i, 8)), ',') AS kmers
       FROM softclips""",
)
def bm_kmer(spark, sf):
    return _softclips(spark, sf).select("read_name", F.array_join(seq.kmers(F.col("seq"), CFG.k), ",").alias("kmers"))


@query("bm_kmer_include", "read_kmers", "SELECT read_name, kmer FROM read_kmers")
def bm_kmer_include(spark, sf):
    window = bc.search_window(_softclips(spark, sf), CFG.mu, CFG.sigma, CFG)
    return bc.included_kmers(window, bc.kmer_dictionary(tb.whitelist(spark, sf), CFG.k), CFG.k).select("read_name", "kmer")


@query(
    "bm_index",
    "bar_kmers kmer_dict",
    """SELECT kmer, barcode, cast(count(*) OVER (PARTITION BY barcode) AS int) AS n_bar,
        cast(row_number() OVER (PARTITION BY barcode ORDER BY df, kmer) AS int) AS place
       FROM bar_kmers JOIN kmer_dict USING (kmer)""",
)
def bm_index(spark, sf):
    return bc.kmer_index(tb.whitelist(spark, sf), CFG.k)


def _pairs(spark, sf):
    window = bc.search_window(_softclips(spark, sf), CFG.mu, CFG.sigma, CFG)
    return bc.cosine_pairs(window, tb.whitelist(spark, sf), CFG)


@query("bm_cos", "cos_pairs", "SELECT read_name, barcode, round(cos, 6) AS cos FROM cos_pairs")
def bm_cos(spark, sf):
    return _pairs(spark, sf).select("read_name", "barcode", F.round("cos", 6).alias("cos"))


@query("bm_topk", "cos_top", "SELECT read_name, barcode, cast(rank AS int) AS rank FROM cos_top")
def bm_topk(spark, sf):
    return bc.top_candidates(_pairs(spark, sf), CFG).select("read_name", "barcode", "rank")


@query("bm_edit", "reads", "SELECT read_name, cast(levenshtein(cell, read_bc) AS int) AS edit FROM reads")
def bm_edit(spark, sf):
    return tb.reads(spark, sf).select("read_name", F.levenshtein("cell", "read_bc").alias("edit"))


@query("bm_semiglobal", "infix", "SELECT read_name, barcode, cast(edit AS int) AS edit FROM infix WHERE edit <= 6")
def bm_semiglobal(spark, sf):
    cand = bc.top_candidates(_pairs(spark, sf), CFG)
    hit = cand.select("read_name", "barcode", infix_align("seq", "barcode").alias("h"))
    return hit.select("read_name", "barcode", F.col("h.edit").alias("edit")).where("edit <= 6")


@query(
    "bm_traceback",
    "reads",
    f""", pairs AS (SELECT clip, cell, {_PLACED.format(t='clip', p='cell')} AS v FROM (SELECT DISTINCT clip, cell FROM reads))
    SELECT read_name, (v // 1000)::int AS edit, (v % 1000)::int AS pos FROM reads JOIN pairs USING (clip, cell)""",
)
def bm_traceback(spark, sf):
    r = tb.reads(spark, sf).select("read_name", "cell", F.col("clip").alias("seq"))
    return r.select("read_name", infix_align("seq", "cell").alias("h")).select("read_name", "h.edit", "h.pos")


@query("bm_best", "best_match", "SELECT read_name, barcode, start, edit FROM best_match")
def bm_best(spark, sf):
    best = bc.best_match(_softclips(spark, sf), tb.whitelist(spark, sf), CFG.mu, CFG.sigma, CFG)
    return best.select("read_name", "barcode", F.round("start", 4).alias("start"), "edit")


@query("bm_match", "best_match", "SELECT read_name, barcode, start, edit FROM best_match")
def bm_match(spark, sf):
    best = bc.best_match(_softclips(spark, sf), tb.whitelist(spark, sf), CFG.mu, CFG.sigma, CFG)
    return best.withColumn("start", F.round("start", 4))


@query("bm_adaptive")
def bm_adaptive(spark, sf):
    return bc.match_barcodes(_softclips(spark, sf), tb.whitelist(spark, sf), CFG)


@query("bm_window", "windows", "SELECT read_name, seq FROM windows")
def bm_window(spark, sf):
    return bc.search_window(_softclips(spark, sf), CFG.mu, CFG.sigma, CFG)


@query(
    "bm_dnorm",
    "",
    """SELECT l_quantity AS x, count(*) AS n, round(exp(-power((l_quantity - 20) / 10, 2) / 2) / (10 * sqrt(2 * pi())), 6)
       AS density FROM lineitem GROUP BY l_quantity""",
)
def bm_dnorm(spark, sf):
    x = tb.table(spark, sf, "lineitem").groupBy(F.col("l_quantity").alias("x")).agg(F.count("*").alias("n"))
    return x.withColumn("density", F.round(stats.dnorm(F.col("x"), F.lit(20.0), F.lit(10.0)), 6))


# Reads with start and edit as a matcher would report them.
tb.sql_table(
    "matches",
    "reads",
    """SELECT read_name, cell AS barcode, (17.4 + CASE WHEN d = 7 THEN q - 25 ELSE ln % 3 - 1 END)::double AS start,
        cast(CASE WHEN d = 7 THEN 3 + ln % 3 WHEN d >= 8 OR cell_no % 16 = 5 THEN 2 WHEN d = 6 THEN 1 ELSE 0 END AS int)
        AS edit FROM reads""",
)


def _matches(spark, sf):
    return tb.reads(spark, sf).selectExpr(
        "read_name",
        "cell as barcode",
        "cast(17.4 + case when d = 7 then q - 25 else ln % 3 - 1 end as double) as start",
        "case when d = 7 then cast(3 + ln % 3 as int) when d >= 8 or cell_no % 16 = 5 then 2 "
        "when d = 6 then 1 else 0 end as edit",
    )


@query("bm_mean", "matches", "SELECT barcode, round(avg(start), 8) AS mu FROM matches GROUP BY barcode")
def bm_mean(spark, sf):
    return _matches(spark, sf).groupBy("barcode").agg(F.round(F.avg("start"), 8).alias("mu"))


@query("bm_var", "matches", "SELECT barcode, round(var_samp(start), 6) AS v FROM matches GROUP BY barcode")
def bm_var(spark, sf):
    return _matches(spark, sf).groupBy("barcode").agg(F.round(F.var_samp("start"), 6).alias("v"))


@query(
    "bm_sigma",
    "matches",
    """SELECT count(*) AS n, round(avg(start), 6) AS mu,
        round(sqrt(var_samp(start) * (count(*) + 1) / (count(*) + 0.5)) + 10.0 / count(*), 6) AS sigma FROM matches""",
)
def bm_sigma(spark, sf):
    e = bc.position_estimate(_matches(spark, sf), CFG)
    return e.select("n", F.round("mu", 6).alias("mu"), F.round("sigma", 6).alias("sigma"))


@query(
    "bm_update_prob",
    "matches",
    "SELECT barcode, round(sum(edit) / (16.0::double * count(*)), 10) AS p FROM matches GROUP BY barcode",
)
def bm_update_prob(spark, sf):
    p = F.sum("edit") / (F.lit(float(CFG.barcode_len)) * F.count("*"))
    return _matches(spark, sf).groupBy("barcode").agg(F.round(p, 10).alias("p"))


@query(
    "bm_pos_filter",
    "matches",
    """, m AS (SELECT *, round(abs(start - (SELECT avg(start) FROM matches WHERE edit = 0))) AS off FROM matches),
    n AS (SELECT count(*) AS n, avg(edit) AS me FROM m),
    pe AS (SELECT edit, sum(count(*)) OVER (ORDER BY edit DESC) / (SELECT n FROM n) AS pe FROM m GROUP BY edit),
    po AS (SELECT off, sum(count(*)) OVER (ORDER BY off DESC) / (SELECT n FROM n) AS po FROM m GROUP BY off)
    SELECT read_name, barcode, round(start, 6) AS start, edit FROM m JOIN pe USING (edit) JOIN po USING (off), n
    WHERE power(pe, me) * power(po, 0.5) >= 0.05 OR edit = 0""",
)
def bm_pos_filter(spark, sf):
    return bc.position_filter(_matches(spark, sf), CFG).withColumn("start", F.round("start", 6))


@query("bm_rev", "softclips", "SELECT read_name, reverse(seq) AS seq FROM softclips")
def bm_rev(spark, sf):
    return _softclips(spark, sf).select("read_name", F.reverse("seq").alias("seq"))


tb.sql_table(
    "repeat_matches",
    "matches",
    """SELECT * FROM matches UNION ALL SELECT read_name, barcode, start + 1, cast(edit + 1 AS int) FROM matches WHERE edit < 2""",
)
tb.sql_table(
    "first_matches",
    "repeat_matches",
    """SELECT read_name, barcode, start, edit FROM (SELECT *, row_number() OVER (PARTITION BY read_name
        ORDER BY edit, barcode, start) AS rn FROM repeat_matches) WHERE rn = 1""",
)


def _repeat_matches(spark, sf):
    m = _matches(spark, sf)
    again = m.where("edit < 2").withColumn("start", F.col("start") + 1).withColumn("edit", F.col("edit") + 1)
    return m.unionByName(again)


@query("bm_distinct", "first_matches", "SELECT read_name, barcode, round(start, 6) AS start, edit FROM first_matches")
def bm_distinct(spark, sf):
    return bc.one_per_read(_repeat_matches(spark, sf)).withColumn("start", F.round("start", 6))


tb.sql_table(
    "trusted",
    "first_matches",
    """SELECT * FROM first_matches WHERE barcode IN (SELECT barcode FROM first_matches GROUP BY barcode HAVING avg(edit) < 1.5)""",
)


@query("bm_bc_quality", "trusted", "SELECT read_name, barcode, edit FROM trusted")
def bm_bc_quality(spark, sf):
    return bc.trusted_barcodes(bc.one_per_read(_repeat_matches(spark, sf)), CFG).select("read_name", "barcode", "edit")


tb.sql_table(
    "exon_reads_two",
    "cell_exon",
    """SELECT read_name, seq, gene, isoform, state, "polyA", strand FROM cell_exon
       UNION ALL SELECT read_name, reverse(seq), concat(gene, 'x'), isoform, state, "polyA", strand FROM cell_exon
       WHERE state > 0.4
       UNION ALL SELECT read_name, seq, concat(gene, 'y'), isoform, state - 0.1, "polyA", strand FROM cell_exon
       WHERE state > 0.6""",
)


def _exon_reads_two(spark, sf):
    c = tb.cell_exon(spark, sf).select("read_name", "seq", "gene", "isoform", "state", "polyA", "strand")
    other = c.where("state > 0.4").withColumn("seq", F.reverse("seq")).withColumn("gene", F.concat("gene", F.lit("x")))
    third = (
        c.where("state > 0.6").withColumn("gene", F.concat("gene", F.lit("y"))).withColumn("state", F.col("state") - 0.1)
    )
    return c.unionByName(other).unionByName(third)


tb.sql_table("recorded", "cell_exon", "SELECT read_name, barcode, start, edit FROM cell_exon")
tb.sql_table("joined", "recorded exon_reads_two", "SELECT * FROM recorded JOIN exon_reads_two USING (read_name)")


@query("bm_join", "joined", "SELECT * REPLACE (round(state, 6) AS state) FROM joined")
def bm_join(spark, sf):
    m = tb.cell_exon(spark, sf).select("read_name", "barcode", "start", "edit")
    return bc.attach_exons(m, _exon_reads_two(spark, sf)).withColumn("state", F.round("state", 6))


@query(
    "bm_dup",
    "joined",
    """, c AS (SELECT *, count(*) OVER (PARTITION BY read_name) AS copies,
        levenshtein(barcode, substr(seq, cast(round_even(start, 0) AS bigint), 16)) = edit AS same FROM joined)
    SELECT * EXCLUDE (copies, same, rn) REPLACE (round(state, 6) AS state) FROM (SELECT *, row_number() OVER (
        PARTITION BY read_name ORDER BY state DESC, edit, gene) AS rn FROM c WHERE copies = 1 OR same) WHERE rn = 1""",
)
def bm_dup(spark, sf):
    m = tb.cell_exon(spark, sf).select("read_name", "barcode", "start", "edit")
    joined = bc.attach_exons(m, _exon_reads_two(spark, sf))
    return bc.resolve_duplicates(joined, CFG).withColumn("state", F.round("state", 6))


tb.sql_table("gene_weights", "reads", "SELECT gene, count(*) AS weight FROM reads GROUP BY gene")
tb.sql_table(
    "gene_bins",
    "gene_weights",
    """WITH RECURSIVE capped AS (SELECT *, (SELECT ceil(sum(weight) / 4.0)::bigint FROM gene_weights) AS cap FROM gene_weights),
    ranked AS (SELECT *, row_number() OVER (ORDER BY weight DESC, gene) AS rn FROM capped WHERE weight <= cap),
    fits AS (
        SELECT 0::bigint AS rn, ''::varchar AS gene, 0::bigint AS weight, []::bigint[] AS room, 0::bigint AS place
        UNION ALL
        SELECT rn, gene, weight, CASE WHEN place > len(room) THEN list_append(room, cap - weight)
            ELSE list_transform(room, lambda x, i: CASE WHEN i = place THEN x - weight ELSE x END) END, place
        FROM (SELECT r.rn, r.gene, r.weight, r.cap, f.room, coalesce(
                nullif(list_position(list_transform(f.room, lambda x: x >= r.weight), true), 0), len(f.room) + 1)::bigint AS place
              FROM fits f JOIN ranked r ON r.rn = f.rn + 1))
    SELECT gene, weight, concat('bin-', place - 1) AS bin FROM fits WHERE rn > 0
    UNION ALL SELECT gene, weight, concat('alone-', gene) FROM capped WHERE weight > cap""",
)


def _bins(spark, sf):
    weights = tb.genes_of_reads(spark, sf).groupBy("gene").agg(F.count("*").alias("weight"))
    return bc.pack_genes(weights, 4)


@query("dist_binpack", "gene_bins", "SELECT gene, weight, bin FROM gene_bins")
def dist_binpack(spark, sf):
    return _bins(spark, sf)


@query(
    "snk_split",
    "reads gene_bins",
    "SELECT b.bin, count(*) AS reads FROM reads r JOIN gene_bins b USING (gene) GROUP BY b.bin",
)
def snk_split(spark, sf):
    return tb.genes_of_reads(spark, sf).join(_bins(spark, sf), "gene").groupBy("bin").agg(F.count("*").alias("reads"))


@query(
    "snk_split_simple",
    "gene_weights",
    """SELECT gene, cast(floor((row_number() OVER (ORDER BY gene) - 1) / greatest(1, floor(count(*) OVER () / 4))) + 1 AS bigint)
       AS file FROM gene_weights""",
)
def snk_split_simple(spark, sf):
    return bc.equal_split(tb.genes_of_reads(spark, sf), 4)
