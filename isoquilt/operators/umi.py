"""UMI de-duplication: windows, compressed nodes, similarity edges, clusters.

Reads with the same gene, cell, isoform and UMI window are one node from the
start, so PCR copies are combined before anything is shuffled by gene or cell.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from isoquilt.config import UmiConfig
from isoquilt.functions import intervals
from isoquilt.functions.align import global_score, score_texts
from isoquilt.operators import graph
from isoquilt.session import compute_once, cut

KEYS = ["gene", "cell"]
#: Genes that go to every task (about 100 MB); beyond, reads are joined with them by gene.
BROADCAST_GENES = 1_000_000
#: Nodes whose pairs a task forms, and groups that go to every task.
TASK_NODES, BROADCAST_GROUPS = 50_000, 1_000_000
#: What a pair shows of its two nodes.
TEXTS = ["umi_a", "iso_a", "umi_b", "iso_b"]


def umi_window(seq: Column, start: Column, cfg: UmiConfig) -> Column:
    """UMI with flanks behind the barcode; a fractional start is truncated."""
    return F.substring(
        seq, start.cast("int") + (cfg.barcode_len - cfg.flank + 1), F.lit(cfg.umi_len + 2 * cfg.flank)
    )


def with_umi(reads: DataFrame, cfg: UmiConfig = UmiConfig()) -> DataFrame:
    """Reads whose text holds a complete UMI window."""
    return reads.withColumn("umi", umi_window(F.col("seq"), F.col("start"), cfg)).where(
        F.length("umi") == cfg.umi_len + 2 * cfg.flank
    )


def busy_genes(reads: DataFrame, cfg: UmiConfig = UmiConfig(), n: str | None = None) -> DataFrame:
    """Reads of genes with enough reads; ``n`` names the number of reads in a row of combined ones.

    The genes go to every task by their counted size, whatever the planner makes of them, so that reads stay where they are.
    """
    busy = reads.groupBy("gene").agg((F.sum(n) if n else F.count("*")).alias("n")).where(F.col("n") >= cfg.min_reads)
    busy = cut(busy.select("gene"))
    if busy.count() <= BROADCAST_GENES:
        busy = F.broadcast(busy)
    return reads.join(busy, "gene", "left_semi")


def compress(reads: DataFrame) -> DataFrame:
    """One node per (gene, cell, isoform, umi) with its read and polyA counts.

    The id is a 64-bit hash used only within one (gene, cell).
    """
    return (
        reads.groupBy("gene", F.col("barcode").alias("cell"), "isoform", "umi")
        .agg(F.count("*").alias("n"), F.sum(F.col("polyA").cast("bigint")).alias("n_polya"))
        .withColumn("id", F.xxhash64("gene", "cell", "isoform", "umi"))
    )


def known_nodes(reads: DataFrame, by: str, cfg: UmiConfig = UmiConfig()) -> DataFrame:
    """Reads combined by ``by``, gene, cell, isoform, umi and true ``molecule``.

    Rows hold their reads ``n``, those of more than ``edit_error`` edits ``n_err``, and ``m``, 1 at one row of each molecule of
    an isoform in a cell, else 0.  One row of each node has the node's reads as ``whole`` and ``n_polya``, the others nulls.
    Reads dealt out by gene and cell are not shuffled.
    """
    window = umi_window(F.col("seq"), F.col("start"), cfg).alias("umi")
    place = [by, "gene", "cell", "isoform"]
    rows = reads.select(by, "gene", F.col("barcode").alias("cell"), "isoform", window, "molecule", "polyA", "edit")
    rows = rows.groupBy(*place, "umi", "molecule").agg(
        F.count("*").alias("n"), F.sum(F.col("polyA").cast("bigint")).alias("tails"),
        F.sum((F.col("edit") > cfg.edit_error).cast("bigint")).alias("n_err"),
    )
    node, molecule = W.partitionBy(*place, "umi"), W.partitionBy(*place, "molecule")
    first = F.row_number().over(molecule.orderBy("umi")) == 1
    lead = F.row_number().over(node.orderBy("molecule")) == 1
    rows = rows.withColumns({"m": first.cast("bigint"), "lead": lead, "whole": F.sum("n").over(node), "n_polya": F.sum("tails").over(node)})
    return rows.select(
        *place, "umi", "n", "n_err", "m", *[F.when(F.col("lead"), F.col(c)).alias(c) for c in ("whole", "n_polya")],
    )


def whole_nodes(known: DataFrame, cfg: UmiConfig = UmiConfig()) -> DataFrame:
    """The nodes of ``known_nodes`` with a complete UMI window, as ``compress`` gives them."""
    nodes = known.where("whole is not null").where(F.length("umi") == cfg.umi_len + 2 * cfg.flank)
    return nodes.select("gene", "cell", "isoform", "umi", F.col("whole").alias("n"), "n_polya", F.xxhash64("gene", "cell", "isoform", "umi").alias("id"))


def edit_budget(length: int, thresh: int) -> tuple[int, int]:
    """Limits implied by a global score of ``thresh`` between texts of equal ``length``.

    With x mismatches and g gaps (an even number) the score is length - 2x - 1.5g.
    Returns the largest x + g, and the largest x + g/2: so many letters have to be
    left out of either text to make them equal.
    """
    budget = length - thresh
    ops, lost = 0, 0
    for gaps in range(0, 2 * length, 2):
        if 1.5 * gaps > budget:
            break
        subs = int((budget - 1.5 * gaps) // 2)
        ops, lost = max(ops, subs + gaps), max(lost, subs + gaps // 2)
    return ops, lost


def shortened(text: Column, lost: int) -> Column:
    """All texts made by leaving out ``lost`` letters."""
    texts = F.array(text)
    for _ in range(lost):
        texts = F.array_distinct(
            F.flatten(
                F.transform(
                    texts,
                    lambda s: F.transform(
                        F.sequence(F.lit(1), F.length(s)),
                        lambda i: F.concat(F.substring(s, F.lit(1), i - 1), F.substring(s, i + 1, F.length(s))),
                    ),
                )
            )
        )
    return texts


def split_groups(nodes: DataFrame, cfg: UmiConfig = UmiConfig()) -> tuple[DataFrame, DataFrame | None]:
    """Nodes of the groups of up to ``pair_bound`` nodes, and those of larger ones, None without any."""
    big = cut(nodes.groupBy(*KEYS).agg(F.count("*").alias("size")).where(F.col("size") > cfg.pair_bound).select(*KEYS))
    found = big.count()
    if not found:
        return nodes, None
    if found <= BROADCAST_GROUPS:
        big = F.broadcast(big)
    return nodes.join(big, KEYS, "left_anti"), nodes.join(big, KEYS, "left_semi")


def _named(nodes: DataFrame, tag: str) -> DataFrame:
    return nodes.select(
        *KEYS,
        F.col("id").alias(tag),
        F.col("umi").alias("umi_" + tag),
        F.col("isoform").alias("iso_" + tag),
        F.col("n").alias("n" + tag),
    )


def _near(pairs: DataFrame, cfg: UmiConfig, measure, most) -> DataFrame:
    if measure is None:
        most = edit_budget(cfg.umi_len + 2 * cfg.flank, cfg.sim_thresh)[0]
        measure = lambda a, b: F.levenshtein(a, b, most)
    measured = compute_once(pairs, measure=measure(F.col("umi_a"), F.col("umi_b")))
    return measured.where(F.col("measure").between(0, most))


def _laid(nodes: DataFrame) -> DataFrame:
    """Nodes, which should be read again without much work, laid out once for both sides of their pairs."""
    tasks = max(nodes.sparkSession.sparkContext.defaultParallelism, -(-nodes.count() // TASK_NODES))
    return nodes.select(*KEYS, "id", "umi", "isoform", "n").repartition(tasks, *KEYS)


def direct_pairs(laid: DataFrame, cfg: UmiConfig = UmiConfig(), measure=None, most=None, itself: bool = False) -> DataFrame:
    """``close_pairs`` by comparing all nodes of a (gene, cell); the pairs stay where the nodes are laid."""
    pairs = _named(laid, "a").join(_named(laid, "b"), KEYS)
    return _near(pairs.where("a < b or (a = b and na > 1)" if itself else "a < b"), cfg, measure, most)


def keyed_pairs(nodes: DataFrame, cfg: UmiConfig = UmiConfig(), measure=None, most=None, keys_of=None, itself: bool = False) -> DataFrame:
    """``close_pairs`` by an equality join on shortened texts."""
    if keys_of is None:
        lost = edit_budget(cfg.umi_len + 2 * cfg.flank, cfg.sim_thresh)[1]
        keys_of = lambda text: shortened(text, lost)
    # The join runs on distinct windows; nodes that share a window are attached afterwards.
    texts = nodes.select(*KEYS, "umi").distinct().withColumn("short", F.explode(keys_of(F.col("umi"))))
    left, right = texts.withColumnRenamed("umi", "umi_a"), texts.withColumnRenamed("umi", "umi_b")
    umi_pairs = _near(left.join(right, [*KEYS, "short"]).select(*KEYS, "umi_a", "umi_b").distinct(), cfg, measure, most)
    joined = umi_pairs.join(_named(nodes, "a"), [*KEYS, "umi_a"]).join(_named(nodes, "b"), [*KEYS, "umi_b"]).where("a < b")
    if not itself:
        return joined
    same = _named(nodes.where("n > 1"), "a")
    same = same.select("*", *[F.col(c).alias(c[:-1] + "b" if len(c) > 1 else "b") for c in ("a", "umi_a", "iso_a", "na")])
    return joined.unionByName(same.withColumn("measure", F.lit(0)))


def close_pairs(nodes: DataFrame, cfg: UmiConfig = UmiConfig(), measure=None, most=None, keys_of=None, itself: bool = False) -> DataFrame:
    """Node pairs of a (gene, cell) whose UMI windows can reach the score threshold.

    ``measure(a, b)``, its largest value ``most`` and ``keys_of(text)`` may replace the test and the
    shortened texts; texts within the bound must share a key.  The value is kept as ``measure``.
    ``itself`` adds every node of several reads with itself.

    Small groups are compared directly.  In a large group two windows can only be
    similar enough if they agree after leaving out a few letters, so the pairs
    come from an equality join on those shortened texts; both ways find the same pairs.
    """
    # counted by a window, so that they are not shuffled for it
    sized = _laid(nodes).withColumn("size", F.count("*").over(W.partitionBy(*KEYS)))
    few, many = (sized.where(held) for held in (F.col("size") <= cfg.pair_bound, F.col("size") > cfg.pair_bound))
    return direct_pairs(few, cfg, measure, most, itself).unionByName(keyed_pairs(many, cfg, measure, most, keys_of, itself))


def _fitting(pairs: DataFrame, cfg: UmiConfig) -> DataFrame:
    """Pairs of compatible isoforms."""
    distance = intervals.span_distance(
        intervals.parse_blocks(F.col("iso_a")), intervals.parse_blocks(F.col("iso_b")), cfg.iso_thresh
    )
    measured = compute_once(pairs, dis=F.when(F.col("iso_a") == F.col("iso_b"), F.lit(0)).otherwise(distance))
    return measured.where(F.col("dis").between(0, cfg.iso_thresh))


def _scored(pairs: DataFrame, cfg: UmiConfig, texts: bool) -> DataFrame:
    # scored where they stand: a second way to the pairs would measure all of them again
    one = F.col("a") == F.col("b")
    score = global_score(*[F.when(one, F.lit("")).otherwise(F.col(c)) for c in ("umi_a", "umi_b")])
    scores = compute_once(_fitting(pairs, cfg), found=score)
    scores = scores.withColumn("score", F.when(one, F.length("umi_a")).otherwise(F.col("found")))
    capacity = F.when(one, F.col("na") * (F.col("na") - 1) / 2).otherwise(F.col("na") * F.col("nb")).cast("bigint")
    edges = scores.where(one | (F.col("score") >= cfg.sim_thresh)).withColumn("capacity", capacity)
    edges = edges.withColumn("ns", F.col("capacity") * F.col("score")).where("ns > 0")
    return edges.select(*KEYS, "a", "b", "na", "nb", "score", "capacity", "ns", *(TEXTS if texts else []))


def _scorer(cfg: UmiConfig):
    """The same scores, of the rows of one table, so that a task goes on with them where they are."""
    least = cfg.sim_thresh

    def scored(table: pa.Table) -> pa.Table:
        a, b, na, nb = (table.column(c).to_numpy().astype(np.int64) for c in ("a", "b", "na", "nb"))
        one = a == b
        score = pc.utf8_length(table.column("umi_a")).to_numpy().astype(np.int64)
        two = np.flatnonzero(~one)
        score[two] = score_texts(*[table.column(c).take(pa.array(two)).to_pandas() for c in ("umi_a", "umi_b")])
        capacity = np.where(one, na * (na - 1) // 2, na * nb)
        table = table.append_column("score", pa.array(score.astype(np.int32)))
        table = table.append_column("capacity", pa.array(capacity)).append_column("ns", pa.array(capacity * score))
        return table.filter(pa.array((one | (score >= least)) & (capacity * score > 0)))

    return scored


def similar_edges(nodes: DataFrame, cfg: UmiConfig = UmiConfig(), texts: bool = False) -> DataFrame:
    """Similarity edges between nodes with compatible isoforms, self edges included.

    capacity counts the read pairs behind an edge, ns is capacity x score; ``texts`` adds what the two nodes are.
    """
    return _scored(close_pairs(nodes, cfg, itself=True), cfg, texts)


def node_components(nodes: DataFrame, cfg: UmiConfig = UmiConfig()) -> DataFrame:
    """(gene, cell, id, component) for every node with an edge to another one."""
    few, many = split_groups(nodes, cfg)
    pairs = _fitting(direct_pairs(_laid(few), cfg), cfg).select(*KEYS, "a", "b", "na", "nb", "umi_a", "umi_b")
    found = graph.components_in_tasks(pairs, KEYS, _scorer(cfg))
    if many is None:
        return found
    return found.unionByName(graph.connected_components(_scored(keyed_pairs(many, cfg), cfg, False), KEYS))


def shared_edges(nodes: DataFrame, cfg: UmiConfig = UmiConfig(), itself: bool = False) -> DataFrame:
    """``similar_edges`` with their texts and ``share``, the reads of the nodes adjacent to both ends; null for self edges."""
    few, many = split_groups(nodes, cfg)
    pairs = direct_pairs(_laid(few), cfg, itself=itself)
    fields = _scored(pairs, cfg, True).schema.fields
    pairs = _fitting(pairs, cfg).select(*KEYS, "a", "b", "na", "nb", *TEXTS)
    found = graph.shared_in_tasks(pairs, KEYS, fields, _scorer(cfg))
    if many is None:
        return found
    edges = cut(_scored(keyed_pairs(many, cfg, itself=itself), cfg, True))
    share = graph.shared_neighbours(edges, KEYS)
    return found.unionByName(edges.join(share, [*KEYS, "a", "b"], "left"))


def cluster(nodes: DataFrame, cfg: UmiConfig = UmiConfig()) -> DataFrame:
    """Nodes with their molecule ``cluster`` (unique within gene and cell)."""
    few, many = split_groups(nodes, cfg)
    accept_ns = cfg.sim_thresh + 2
    pairs = _fitting(direct_pairs(_laid(few), cfg, itself=True), cfg).select(*KEYS, "a", "b", "na", "nb", "umi_a", "umi_b")
    found = graph.split_in_tasks(pairs, KEYS, cfg.cut_alpha, accept_ns, _scorer(cfg))
    if many is not None:
        edges = _scored(keyed_pairs(many, cfg, itself=True), cfg, False)
        found = found.unionByName(graph.cluster_graphs(edges, KEYS, cfg.cut_alpha, accept_ns, cfg.task_edge_bound))
    return nodes.join(found, [*KEYS, "id"], "left").withColumn("cluster", F.coalesce("cluster", "id"))


def read_clusters(reads: DataFrame, clustered: DataFrame) -> DataFrame:
    """Cluster label of every read, through its node."""
    labels = clustered.select("gene", F.col("cell").alias("barcode"), "isoform", "umi", "cluster")
    return reads.join(labels, ["gene", "barcode", "isoform", "umi"])


def exact_counts(reads: DataFrame, cfg: UmiConfig = UmiConfig()) -> DataFrame:
    """Counts per cell, gene and isoform when only identical UMI windows are merged."""
    nodes = compress(with_umi(busy_genes(reads, cfg), cfg))
    return nodes.groupBy("cell", "gene", "isoform").agg(
        F.sum("n").alias("size"),
        F.count("*").alias("cluster"),
        (F.sum("n_polya") / F.sum("n")).alias("polyA"),
    )
