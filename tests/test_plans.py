"""What plans must look like, and where intermediates may go."""

import time
from pathlib import Path
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from isoquilt.config import BarcodeConfig
from isoquilt.functions import intervals
from isoquilt.functions.align import global_score
from isoquilt.operators import barcode, exons, extract, legacy, splice, umi
from isoquilt.plans import longread, queries_barcode, queries_legacy, queries_splice, queries_umi
from isoquilt.plans import testbed as tb
from isoquilt.session import checkpoint_dir, cut, release

SF = "/root/testdata/sf0.001"


def _evaluations(df):
    """Python evaluations in the optimised plan."""
    return df._jdf.queryExecution().optimizedPlan().toString().count("ArrowEvalPython")


def _reads(spark):
    return tb.reads(spark, SF).select("read_name", F.col("clip").alias("seq"))


def test_one_alignment_for_each_pair(spark):
    cfg = BarcodeConfig()
    found = barcode.best_match(_reads(spark), tb.whitelist(spark, SF), cfg.mu, cfg.sigma, cfg)
    assert _evaluations(found) == 1


def test_both_passes_are_kept_before_they_are_used(spark):
    """Nothing of the matcher is left in the plan of the result: each pass ran once."""
    assert _evaluations(barcode.match_barcodes(_reads(spark), tb.whitelist(spark, SF))) == 0


def test_one_score_for_each_pair_of_windows(spark):
    reads = umi.with_umi(umi.busy_genes(tb.cell_exon(spark, SF)))
    assert _evaluations(umi.similar_edges(umi.compress(reads))) == 1


def _cluster(master, folder=None):
    none = SimpleNamespace(isDefined=lambda: False)
    jsc = SimpleNamespace(sc=lambda: SimpleNamespace(getCheckpointDir=lambda: none))
    conf = SimpleNamespace(get=lambda key, default: folder)
    sc = SimpleNamespace(_jsc=jsc, getConf=lambda: conf, master=master, setCheckpointDir=lambda f: None)
    return SimpleNamespace(sparkContext=sc, conf=conf)


def test_intermediates_need_a_shared_folder():
    for master in ("spark://host:7077", "yarn", "local-cluster[2,1,1024]"):
        with pytest.raises(RuntimeError):
            checkpoint_dir(_cluster(master))
    assert checkpoint_dir(_cluster("yarn", "hdfs://shared/x")) == "hdfs://shared/x"
    assert checkpoint_dir(_cluster("local[2]"))


def test_rows_of_one_split_are_dealt_to_tasks(spark, monkeypatch):
    """A row group cannot be divided: one split of many may hold all the rows."""
    monkeypatch.setattr(tb, "TASK_ROWS", 500)
    empty = spark.range(0, 0, 1, 64)
    df = spark.range(0, 20_000, 1, 1).union(empty).selectExpr("id AS a", "id % 7 AS b")
    sizes = [r["n"] for r in tb.spread(df, ["a", "b"]).groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
    assert sum(sizes) == 20_000 and max(sizes) < 1000 and len(sizes) == 40


def test_pairs_are_measured_once_for_their_scores(spark):
    """Scores stand beside the pairs; small and large groups are compared in one place each."""
    rows = [("g", "c", f"{k},{k + 50}", "ACGTACGTACGT"[k % 3 :] + "ACG"[: k % 3], 1, k) for k in range(6)]
    nodes = spark.createDataFrame(rows, "gene string, cell string, isoform string, umi string, n bigint, id bigint")
    edges = umi.similar_edges(nodes)
    assert edges._jdf.queryExecution().optimizedPlan().toString().count("levenshtein(") == 2
    assert edges.where("a <> b").count() == 15
    texts = spark.createDataFrame([("ACGT", "ACGA"), ("A", "ACGT"), ("ACGT", "ACGA"), ("ACGT", "A")] * 3, "a string, b string")
    assert [r.s for r in texts.select(global_score("a", "b").alias("s")).collect()] == [2, -2, 2, -2] * 3


def test_clustered_nodes_are_kept(spark):
    """What reads them several times does not cluster again."""
    clustered, _ = longread.cluster_reads(tb.cell_exon(spark, SF))
    assert "MapInPandas" not in clustered._jdf.queryExecution().optimizedPlan().toString()


def test_voting_deals_reads_out_once(spark, monkeypatch):
    """Reads dealt by molecule stay so; the sites of many genes are joined and give the same votes."""
    nodes = queries_splice._voting(spark, SF)
    modes = splice.pattern_modes(splice.voters(nodes))
    assert modes._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    monkeypatch.setattr(splice, "BROADCAST_SITES", 0)
    joined = splice.pattern_modes(splice.voters(nodes))
    assert modes.count() == joined.count() > 0 and modes.exceptAll(joined).isEmpty()


def test_dealt_reads_are_the_reads(spark):
    one = tb.reads(spark, SF)
    two = tb.dealt_reads(spark, SF, "gene", "cell", "molecule").select(*one.columns)
    assert one.count() == two.count() == spark.read.parquet(f"{SF}/lineitem.parquet").count()
    assert one.exceptAll(two).isEmpty()


def test_reads_stay_where_they_are_to_meet_genes(spark, monkeypatch):
    """What the planner would broadcast by itself does not decide; genes beyond the counted size are joined the same."""
    auto = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        met = extract.read_genes(tb.alignments(spark, SF), tb.gene_bed(spark, SF)).select("read_name", "gene")
        assert "Exchange hashpartitioning" not in met._jdf.queryExecution().executedPlan().toString()
        monkeypatch.setattr(extract, "BROADCAST_PLACES", 0)
        joined = extract.read_genes(tb.alignments(spark, SF), tb.gene_bed(spark, SF)).select("read_name", "gene")
        assert "Exchange hashpartitioning" in joined._jdf.queryExecution().executedPlan().toString()
        assert met.count() == joined.count() > 0 and met.exceptAll(joined).isEmpty()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", auto)


def test_counts_stay_where_they_are_to_meet_exons(spark, monkeypatch):
    """Rows are mapped in place; genes beyond the counted size give the same exons by way of distinct isoforms."""
    counts, bed = tb.splice_count(spark, SF), tb.gene_bed(spark, SF)
    made = exons.exon_counts(counts, bed)
    # the one that adds up the counts
    assert made._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    monkeypatch.setattr(extract, "BROADCAST_PLACES", 0)
    joined = exons.exon_counts(counts, bed)
    assert made.count() == joined.count() > 0 and made.exceptAll(joined).isEmpty()


def test_genes_are_weighed_once(spark):
    """The plan of the bins holds no read any more, and counting genes keeps no reads."""
    packed = queries_barcode.dist_binpack(spark, SF)
    assert "Scan parquet" not in packed._jdf.queryExecution().executedPlan().toString()
    weights = tb.genes_of_reads(spark, SF).groupBy("gene").agg(F.count("*").alias("weight"))
    assert "lineitem.parquet" in weights.inputFiles()[0]
    assert packed.count() > 0 and packed.select("gene", "weight").exceptAll(weights).isEmpty()
    assert weights.exceptAll(tb.reads(spark, SF).groupBy("gene").agg(F.count("*").alias("weight"))).isEmpty()


def test_isoforms_are_parsed_once_for_inclusion(spark):
    """One split of the text for both tests, no pattern for a block, and no reads kept for it."""
    included = queries_legacy.hp_include(spark, SF)
    plan = included._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count(r", \|, -1)") == 1 and "stringsplitsql" not in plan
    assert "lineitem.parquet" in included.inputFiles()[0]
    blocks = spark.range(1).select(intervals.parse_blocks(F.lit("1,20|300,4000")).alias("b")).first().b
    assert [tuple(b) for b in blocks] == [(1, 20), (300, 4000)]


def test_modal_coverage_stays_where_its_reads_are(spark):
    """One shuffle, of the table's rows; the same medians as by modal texts joined back to all reads."""
    made = queries_legacy.ul_coverage(spark, SF)
    assert made._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    keys = ["cell", "gene", "cluster"]
    values = "concat(if(id % 3 = 0, '0.5', '1.0'), '|', id % 7 / 10.0, if(id % 5 = 0, '|0.25', ''))"
    odd = spark.range(600).selectExpr(
        "if(id % 50 = 0, null, 'c') AS cell", "'g' AS gene", "id % 4 AS cluster",
        "if(id % 5 = 0, '1|2|3', if(id % 2 = 0, '1|2', '2|3')) AS exon", f"if(id % 11 = 0, null, {values}) AS coverage",
    )
    for reads in (odd, queries_legacy._coverage_reads(spark, SF).select(*keys, "exon", "coverage")):
        joined = legacy.median_coverage(reads.join(legacy.modal_exons(reads, keys), keys), keys)
        counted = legacy.modal_coverage(reads, keys)
        assert counted.count() == joined.count() > 0 and counted.exceptAll(joined).isEmpty()


def test_pairs_stay_where_their_nodes_are_laid_out(spark):
    """Shares, components and clusters are found there, and no names are joined to the pairs."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plans = {q: getattr(queries_umi, q)(spark, SF)._jdf.queryExecution().executedPlan().toString() for q in ("um_snn", "um_snn_graph", "um_edges", "um_needle", "um_graph")}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    for q in ("um_snn", "um_snn_graph"):
        # the two sides of the pairs, which are one shuffle when it runs
        assert plans[q].count("Exchange ") == 2 and plans[q].count("SortMergeJoin") == 1, q
    for q in ("um_edges", "um_needle", "um_graph"):
        assert plans[q].count("SortMergeJoin") == 4, q


def test_checkpoints_go_when_nothing_refers_to_them(spark):
    folder = Path(checkpoint_dir(spark).removeprefix("file:"))
    assert spark.sparkContext.getConf().get("spark.cleaner.referenceTracking.cleanCheckpoints", "false") == "false"
    files = lambda: {p for p in folder.rglob("part-*") if "rdd-" in str(p)}
    before = files()
    df = cut(spark.range(1000))
    made = files() - before
    assert made and df.count() == 1000
    del df
    for _ in range(40):
        release(spark)
        time.sleep(0.25)
        if not made & files():
            break
    assert not made & files()
    assert spark.sparkContext._jsc.sc().conf().get("spark.cleaner.referenceTracking.cleanCheckpoints", "false") == "false"
