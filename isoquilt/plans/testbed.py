"""Domain tables derived from the generic star-schema tables.

Every lineitem becomes one long read: the supplier is its gene, the order picks
the cell, the part picks the molecule and the transcript, and the small numeric
columns decide sequencing errors.  The same rules exist once as DataFrames and
once as SQL common table expressions for the side-by-side check.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from isoquilt.functions import intervals, seq
from isoquilt.session import stored

# Library layout of the simulated protocol.
ADAPTER = "CTACACGACGCTCTTCCGATCT"
LINKER = "TTTCTTATATGGG"
CELLS = 48


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Rows a task derives at once.
TASK_ROWS = 250_000


def spread(df: DataFrame, keys: list) -> DataFrame:
    """Deal rows out by ``keys`` to as many tasks as their number asks, and to every core.

    A split of a Parquet file is no measure: row groups cannot be divided, so one task may hold them all.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(max(cores, -(-df.count() // TASK_ROWS)), *keys)


def _dna(text: str, n: int) -> str:
    return f"substr(translate(md5({text}), '0123456789abcdef', 'ACGTACGTACGTACGT'), 1, {n})"


def _swap(text: str, at: str, to: str = "CGTA") -> str:
    """SQL that replaces the letter at position ``at``."""
    return (
        f"concat(substr({text}, 1, {at} - 1), translate(substr({text}, {at}, 1), 'ACGT', '{to}'), "
        f"substr({text}, {at} + 1))"
    )


_GENE = "concat('ENSG', lpad(cast({k} as string), 11, '0'))"
_BASE = "(100000 + 10000 * ({k} - case when {k} % 10 = 9 then 1 else 0 end))"
_CHR = "concat('chr', cast(1 + cast(floor({k} / 10.0) as bigint) % 22 as string))"
_STRAND = "case when {k} % 2 = 0 then '+' else '-' end"
_EXON_S = "(base + 400 * (i - 1))"
_EXON_E = "(base + 400 * (i - 1) + 59 + (k * 7 + i * 13) % 90)"

_READ_COLS = [
    (
        "read_name",
        "concat(cast(l_orderkey as string), '_', cast(l_partkey as string), '_', "
        "cast(l_suppkey as string), '_', cast(l_linenumber as string))",
    ),
    ("k", "l_suppkey"),
    ("gene", _GENE.format(k="l_suppkey")),
    ("chr", _CHR.format(k="l_suppkey")),
    ("base", _BASE.format(k="l_suppkey")),
    ("strand", _STRAND.format(k="l_suppkey")),
    ("n_exon", "4 + l_suppkey % 5"),
    ("cell_no", f"l_orderkey % {CELLS}"),
    ("molecule", "l_partkey % 3"),
    ("shape", "l_partkey % 4"),
    ("ln", "cast(l_linenumber as bigint)"),
    ("q", "cast(round(l_quantity) as bigint)"),
    ("d", "cast(round(l_discount * 100) as bigint)"),
    ("t", "cast(round(l_tax * 100) as bigint)"),
    ("rf", "l_returnflag"),
    ("ls", "l_linestatus"),
]

_RAW_COLS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_discount", "l_tax", "l_returnflag", "l_linestatus"]

_CELL_COLS = [
    ("cell", _dna("cast(cell_no as string)", 16)),
    ("umi_base", _dna("concat('u', cast(k as string), '-', cast(cell_no as string))", 10)),
    ("umi_other", _dna("concat('v', cast(k as string), '-', cast(cell_no as string))", 10)),
    (
        "skip",
        "case when q = 4 then 0 when shape = 0 then 0 when shape = 1 then 2 when shape = 2 then 3 "
        "else 1 + ln % n_exon end",
    ),
]
_MOLECULE = (
    "case when molecule = 0 then umi_base when molecule = 2 then umi_other else "
    + _swap(_swap(_swap("umi_base", "2", "TGCA"), "5", "TGCA"), "8", "TGCA")
    + " end"
)
_UMI = "case when ls = 'O' then " + _swap("molecule_umi", "ln") + " else molecule_umi end"
_READ_BC = (
    "case when d = 10 then "
    + _swap("cell", "(1 + ln)")
    + " when d = 9 then concat(substr(cell, 1, 3 + ln), substr(cell, 5 + ln))"
    + " when d = 8 then concat(substr(cell, 1, 8), 'A', substr(cell, 9)) else cell end"
)
_CLIP = f"concat('{ADAPTER}', read_bc, umi, '{LINKER}')"
#: What is kept beside the raw rows.
_KEPT = {"umi": _UMI, "read_bc": _READ_BC}
_TAIL = (
    "case when rf = 'A' then concat(repeat('A', 25), 'CG') when rf = 'N' then repeat('ACGT', 6) else "
    "concat(repeat('A', 8), 'C', repeat('A', 9)) end"
)


def reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per simulated long read with its true layout.

    Only the raw rows and the two texts that take much code are kept, dealt out once per application; the rest of the
    layout is worked out where it is asked for, which takes a seventh of the disk.
    """

    def dealt():
        raw = spread(table(spark, sf_dir, "lineitem").select(*_RAW_COLS), _RAW_COLS[:4])
        return _laid_out(raw.select("*", F.struct("*").alias("raw"))).select("raw.*", *_KEPT)

    return _laid_out(stored(spark, f"lineitem:{sf_dir}", dealt))


def dealt_reads(spark: SparkSession, sf_dir: str, *by: str) -> DataFrame:
    """The same rows, not kept: dealt out by some of gene, cell and molecule, so that no later step by these shuffles
    them again, or by their keys.
    """
    named = dict(_READ_COLS) | {"cell": _CELL_COLS[0][1].replace("cell_no", f"({dict(_READ_COLS)['cell_no']})")}
    raw = table(spark, sf_dir, "lineitem").select(*_RAW_COLS)
    return _laid_out(spread(raw, [F.expr(named[c]) for c in by] or _RAW_COLS[:4]))


def genes_of_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gene of every read: one text a row, so rows are neither dealt out nor kept for it."""
    return _laid_out(table(spark, sf_dir, "lineitem").select(*_RAW_COLS)).select("gene")


def alignments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alignment records of the reads, written once per application."""
    return stored(spark, f"alignments:{sf_dir}", lambda: _build_alignments(spark, sf_dir))


def _laid_out(raw: DataFrame) -> DataFrame:
    beside = [c for c in raw.columns if c not in _RAW_COLS]
    df = raw.selectExpr(*[f"{e} as {n}" for n, e in _READ_COLS], *beside)
    df = df.selectExpr("*", *[f"{e} as {n}" for n, e in _CELL_COLS])
    df = df.selectExpr("*", f"{_MOLECULE} as molecule_umi")
    df = df.selectExpr("*", *[f"{e} as {n}" for n, e in _KEPT.items() if n not in beside])
    df = df.selectExpr("*", f"{_CLIP} as clip", f"{_TAIL} as tail")
    kept = F.filter(
        F.sequence(F.lit(1).cast("bigint"), F.col("n_exon")),
        lambda i: (i != F.col("skip")) & ((F.col("q") != 4) | (i == 1)),
    )
    df = df.withColumn("kept", kept)
    last = F.size("kept") - 1

    def block(i, j):
        s = F.col("base") + 400 * (i - 1)
        e = s + 60 + (F.col("k") * 7 + i * 13) % 90
        noisy = (F.col("q") == 5) & (j == 0) & (last > 0)
        return F.struct(
            (s + F.when(j == 0, F.col("t") % 3).otherwise(F.lit(0))).alias("s"),
            (
                e
                - F.when(j == last, F.col("d") % 2).otherwise(F.lit(0))
                + F.when(noisy, 2 + F.col("ln")).otherwise(F.lit(0))
            ).alias("e"),
        )

    df = df.withColumn("blocks", F.transform("kept", block))
    return df.withColumn("isoform", intervals.format_blocks(F.col("blocks")))


def whitelist(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "customer").selectExpr(_dna("cast(c_custkey as string)", 16) + " as barcode").distinct()


def gene_bed(spark, sf_dir) -> DataFrame:
    """Disjoint exon parts per gene (exons 3 and 4 are cut in two)."""
    df = table(spark, sf_dir, "supplier").selectExpr(
        "s_suppkey as k",
        _GENE.format(k="s_suppkey") + " as gene",
        _CHR.format(k="s_suppkey") + " as chr",
        _BASE.format(k="s_suppkey") + " as base",
        _STRAND.format(k="s_suppkey") + " as strand",
        "explode(sequence(1L, 4 + s_suppkey % 5)) as i",
    )
    df = df.selectExpr("*", f"{_EXON_S} as es", f"{_EXON_E} as ee")
    df = df.selectExpr(
        "gene",
        "chr",
        "strand",
        """explode(case when i = 3 then array(struct(es as s, ee - 20 as e), struct(ee - 19 as s, ee as e))
                        when i = 4 then array(struct(es as s, es + 5 as e), struct(es + 6 as s, ee as e))
                        else array(struct(es as s, ee as e)) end) as p""",
    )
    return df.selectExpr("gene", "chr", "p.s as start", "p.e as `end`", "p.e - p.s + 1 as width", "strand")


def gtf_exons(spark, sf_dir) -> DataFrame:
    """Annotated exons: four transcripts per gene with alternative ends and starts."""
    df = table(spark, sf_dir, "supplier").selectExpr(
        "s_suppkey as k",
        _GENE.format(k="s_suppkey") + " as gene",
        _CHR.format(k="s_suppkey") + " as chr",
        _BASE.format(k="s_suppkey") + " as base",
        _STRAND.format(k="s_suppkey") + " as strand",
        "explode(sequence(1L, 4 + s_suppkey % 5)) as i",
    )
    df = df.selectExpr("*", f"{_EXON_S} as es", f"{_EXON_E} as ee", "explode(array(1, 2, 3, 4)) as tx")
    df = df.where("not (tx = 2 and i = 2)")
    return df.selectExpr(
        "chr",
        "es + case when tx = 4 and i = 4 then 6 else 0 end as start",
        "ee - case when tx = 3 and i = 3 then 20 else 0 end as `end`",
        "strand",
        "concat(gene, '.1') as gene_id",
        "concat(replace(gene, 'ENSG', 'ENST'), '.', cast(tx as string)) as transname",
        """concat(replace(gene, 'ENSG', 'ENSE'), '.', cast(i as string),
               case when (tx = 4 and i = 4) or (tx = 3 and i = 3) then 'b' else '' end) as exon_id""",
    )


def _build_alignments(spark, sf_dir) -> DataFrame:
    """Alignment records (name, flag, chr, 0-based position, mapq, CIGAR, sequence)."""
    r = reads(spark, sf_dir)
    plus = F.col("strand") == "+"
    fwd = F.when(plus, F.col("clip")).otherwise(seq.revcomp(F.col("tail")))
    rev = F.when(plus, F.col("tail")).otherwise(seq.revcomp(F.col("clip")))
    body = F.aggregate("blocks", F.lit(0).cast("bigint"), lambda acc, b: acc + b["e"] - b["s"])
    ops = F.array_join(
        F.transform(
            "blocks",
            lambda b, j: F.concat(
                F.when(j > 0, F.concat((b["s"] - F.get("blocks", j - 1)["e"]).cast("string"), F.lit("N"))).otherwise(
                    F.lit("")
                ),
                (b["e"] - b["s"]).cast("string"),
                F.lit("M"),
            ),
        ),
        "",
    )
    return r.select(
        "read_name",
        F.expr("case when q = 1 then 4 when q = 2 then 256 when q = 3 then 2048 else 0 end").alias("flag"),
        F.col("chr").alias("rname"),
        (F.element_at("blocks", 1)["s"] - 1).alias("pos"),
        F.expr("cast(case when t = 0 then 20 else 30 + t end as int)").alias("mapq"),
        F.concat(F.length(fwd).cast("string"), F.lit("S"), ops, F.length(rev).cast("string"), F.lit("S")).alias("cigar"),
        F.concat(fwd, F.repeat(F.lit("C"), body.cast("int")), rev).alias("seq"),
    )


def cell_exon(spark, sf_dir) -> DataFrame:
    """Reads with an assigned barcode, as the de-duplication stage receives them."""
    return _with_barcode(reads(spark, sf_dir))


def true_cell_exon(r: DataFrame) -> DataFrame:
    """The same of reads ``r``, with their true molecule and a setting, the read's flag."""
    known = [F.col("rf").alias("setting"), F.concat_ws("/", "gene", "molecule").alias("molecule")]
    return _with_barcode(r.where("read_name is not null"), *known)


def _with_barcode(r: DataFrame, *known) -> DataFrame:
    return r.select(
        "read_name",
        F.col("cell").alias("barcode"),
        F.lit(17.0).alias("start"),
        F.expr("case when d >= 8 then 1 when d = 7 then 3 else 0 end").alias("edit"),
        seq.last_bases(F.col("clip"), 55).alias("seq"),
        "gene",
        "isoform",
        (F.col("d") / 10.0).alias("state"),
        (F.col("rf") == "A").alias("polyA"),
        F.expr("case when strand = '+' then 'plus' else 'minus' end").alias("strand"),
        *known,
    )


def splice_count(spark, sf_dir) -> DataFrame:
    """Cell x gene x isoform counts."""
    return (
        dealt_reads(spark, sf_dir, "gene", "cell")
        .groupBy("cell", "gene", "isoform")
        .agg(
            F.sum("q").alias("size"),
            F.count("*").alias("cluster"),
            (F.sum("q") / 5.0).alias("count"),
            F.avg((F.col("rf") == "A").cast("double")).alias("polyA"),
        )
        .select("cell", "isoform", "size", "cluster", "count", "polyA", "gene")
    )


def exon_coverage_reads(spark, sf_dir) -> DataFrame:
    """Reads in the older layout: exon ids and covered fraction per exon, joined by ``|``."""
    return _covered(reads(spark, sf_dir))


def dealt_coverage_reads(spark, sf_dir) -> DataFrame:
    """The same rows, dealt out by their cell, gene and group."""
    return _covered(dealt_reads(spark, sf_dir, "cell", "gene", "molecule"))


def _covered(r: DataFrame) -> DataFrame:
    # reads lose their last or first exon now and then
    r = r.withColumn(
        "kept",
        F.filter(
            "kept",
            lambda i: (F.col("q") == 4)
            | (((i < F.col("n_exon")) | (F.col("ln") % 3 != 0)) & ((i > 1) | (F.col("ln") % 4 != 0))),
        ),
    )
    cov = F.transform("kept", lambda i: F.when((i + F.col("ln")) % 2 == 0, F.lit(0.5)).otherwise(F.lit(1.0)))
    return r.select(
        "read_name",
        "cell",
        "gene",
        F.col("molecule").alias("umi_group"),
        "umi",
        F.array_join(F.transform("kept", lambda i: i.cast("string")), "|").alias("exon"),
        F.array_join(F.transform(cov, lambda c: c.cast("string")), "|").alias("coverage"),
        F.element_at("blocks", 1)["s"].alias("reads_s"),
        F.element_at("blocks", -1)["e"].alias("reads_e"),
        (F.col("rf") == "A").cast("double").alias("polyA"),
    )


# ---------------------------------------------------------------- SQL twins

_SQL: dict[str, tuple[tuple[str, ...], str]] = {}


def sql_table(name: str, needs: str, body: str) -> None:
    """Add a common table expression other SQL may ask for by name."""
    _SQL[name] = (tuple(needs.split()), body)


def with_tables(names: list[str], body: str) -> str:
    """Prefix ``body`` with the common table expressions it needs, in dependency order."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        for dep in _SQL[name][0]:
            visit(dep)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        visit(name)
    if not ordered:
        return body
    ctes = ",\n".join(f"{n} AS ({_SQL[n][1]})" for n in ordered)
    return f"WITH {ctes}\n{body}"


def _cols(pairs) -> str:
    return ", ".join(f"{e} AS {n}" for n, e in pairs)


def _fn_revcomp(text: str) -> str:
    return f"reverse(translate({text}, 'ACGT', 'TGCA'))"


sql_table("reads0", "", f"SELECT {_cols(_READ_COLS)} FROM lineitem")
sql_table("reads1", "reads0", f"SELECT *, {_cols(_CELL_COLS)} FROM reads0")
sql_table("reads2", "reads1", f"SELECT *, {_MOLECULE} AS molecule_umi FROM reads1")
sql_table("reads3", "reads2", f"SELECT *, {_UMI} AS umi, {_READ_BC} AS read_bc FROM reads2")
sql_table(
    "reads4",
    "reads3",
    f"""SELECT *, {_CLIP} AS clip, {_TAIL} AS tail,
        list_filter(range(1, n_exon + 1), lambda i: i <> skip AND (q <> 4 OR i = 1)) AS kept FROM reads3""",
)
sql_table(
    "reads5",
    "reads4",
    """SELECT *, list_transform(kept, lambda i, j: {
        's': base + 400 * (i - 1) + CASE WHEN j = 1 THEN t % 3 ELSE 0 END,
        'e': base + 400 * (i - 1) + 60 + (k * 7 + i * 13) % 90 - CASE WHEN j = len(kept) THEN d % 2 ELSE 0 END
             + CASE WHEN q = 5 AND j = 1 AND len(kept) > 1 THEN 2 + ln ELSE 0 END}) AS blocks FROM reads4""",
)
sql_table(
    "reads",
    "reads5",
    """SELECT *, array_to_string(list_transform(blocks, lambda b: concat(b.s, ',', b.e)), '|') AS isoform
       FROM reads5""",
)
sql_table("whitelist", "", f"SELECT DISTINCT {_dna('cast(c_custkey as string)', 16)} AS barcode FROM customer")
_SUPP = (
    f"SELECT s_suppkey AS k, {_GENE.format(k='s_suppkey')} AS gene, {_CHR.format(k='s_suppkey')} AS chr, "
    f"{_BASE.format(k='s_suppkey')} AS base, {_STRAND.format(k='s_suppkey')} AS strand, "
    "unnest(range(1, 5 + s_suppkey % 5)) AS i FROM supplier"
)
sql_table("exon_grid", "", f"SELECT *, {_EXON_S} AS es, {_EXON_E} AS ee FROM ({_SUPP})")
sql_table(
    "gene_bed",
    "exon_grid",
    """SELECT gene, chr, s AS start, e AS "end", e - s + 1 AS width, strand FROM (
        SELECT gene, chr, strand, es AS s, CASE WHEN i = 3 THEN ee - 20 WHEN i = 4 THEN es + 5 ELSE ee END AS e
        FROM exon_grid
        UNION ALL SELECT gene, chr, strand, CASE WHEN i = 3 THEN ee - 19 ELSE es + 6 END, ee
        FROM exon_grid WHERE i IN (3, 4))""",
)
sql_table(
    "gtf_exons",
    "exon_grid",
    """SELECT chr, es + CASE WHEN tx = 4 AND i = 4 THEN 6 ELSE 0 END AS start,
        ee - CASE WHEN tx = 3 AND i = 3 THEN 20 ELSE 0 END AS "end", strand, concat(gene, '.1') AS gene_id,
        concat(replace(gene, 'ENSG', 'ENST'), '.', cast(tx as string)) AS transname,
        concat(replace(gene, 'ENSG', 'ENSE'), '.', cast(i as string),
            CASE WHEN (tx = 4 AND i = 4) OR (tx = 3 AND i = 3) THEN 'b' ELSE '' END) AS exon_id
       FROM exon_grid, (SELECT unnest([1, 2, 3, 4]) AS tx) WHERE NOT (tx = 2 AND i = 2)""",
)
sql_table(
    "clips",
    "reads",
    f"""SELECT *, CASE WHEN strand = '+' THEN clip ELSE {_fn_revcomp('tail')} END AS fwd,
        CASE WHEN strand = '+' THEN tail ELSE {_fn_revcomp('clip')} END AS rev FROM reads""",
)
sql_table(
    "alignments",
    "clips",
    """SELECT read_name, CASE WHEN q = 1 THEN 4 WHEN q = 2 THEN 256 WHEN q = 3 THEN 2048 ELSE 0 END AS flag,
        chr AS rname, blocks[1].s - 1 AS pos, cast(CASE WHEN t = 0 THEN 20 ELSE 30 + t END AS int) AS mapq,
        concat(length(fwd), 'S', array_to_string(list_transform(blocks, lambda b, j: concat(
            CASE WHEN j > 1 THEN concat(b.s - blocks[j - 1].e, 'N') ELSE '' END, b.e - b.s, 'M')), ''),
            length(rev), 'S') AS cigar,
        concat(fwd, repeat('C', cast(list_sum(list_transform(blocks, lambda b: b.e - b.s)) AS bigint)), rev) AS seq
       FROM clips""",
)
sql_table(
    "cell_exon",
    "reads",
    """SELECT read_name, cell AS barcode, 17.0::double AS start,
        CASE WHEN d >= 8 THEN 1 WHEN d = 7 THEN 3 ELSE 0 END AS edit, right(clip, 55) AS seq, gene, isoform,
        d / 10.0 AS state, rf = 'A' AS "polyA", CASE WHEN strand = '+' THEN 'plus' ELSE 'minus' END AS strand
       FROM reads""",
)
sql_table(
    "splice_count",
    "reads",
    """SELECT cell, gene, isoform, cast(sum(q) AS bigint) AS size, count(*) AS cluster,
        sum(q) / 5.0 AS count, avg(CASE WHEN rf = 'A' THEN 1.0 ELSE 0.0 END) AS "polyA"
       FROM reads GROUP BY cell, gene, isoform""",
)
sql_table(
    "exon_coverage_reads",
    "reads",
    """SELECT read_name, cell, gene, molecule AS umi_group, umi, array_to_string(kept, '|') AS exon,
        array_to_string(list_transform(kept, lambda i: CASE WHEN (i + ln) % 2 = 0 THEN '0.5' ELSE '1.0' END), '|')
            AS coverage,
        blocks[1].s AS reads_s, blocks[-1].e AS reads_e, CASE WHEN rf = 'A' THEN 1.0 ELSE 0.0 END::double AS "polyA"
       FROM (SELECT * REPLACE (list_filter(kept, lambda i: q = 4 OR ((i < n_exon OR ln % 3 <> 0) AND (i > 1 OR ln % 4 <> 0))) AS kept)
             FROM reads)""",
)
