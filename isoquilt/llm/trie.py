"""Prefix trie of conversations from sorted sequences, their common prefixes and range minima.

A conversation is a sequence of turn digests.  All sequences are sorted over the cluster, so the
members of every prefix stand next to each other.  In a slice of that order neighbours are compared
once; a sparse table over the lengths of their common prefixes answers range minima, and
every candidate prefix (row, depth) finds its first and its last member by two binary
searches that do not depend on any other candidate.  What a node sums over its subtree are
differences of running sums at the two ends.

A prefix that goes on beyond a slice (its depth is within the common prefix of the two rows at the border) comes
as one part from each slice; parts are added up by the digest of the prefix.  Their number is
bounded by the depth of the sequences at the borders, not by the members.

Defined results: rows without a ``conv_id`` take no part; turns are ordered by turn (null first), turns that
tie by their digest, and repeated rows are repeated turns; a null role or text is empty; a conversation without turns after
rebuilding belongs to the root alone; an empty table has no nodes; very long texts are only hashed and measured; only
conv_id, turn, role and text are read, so other columns cannot clash.  A conversation's digests, 24 bytes a turn,
are held as one row.
"""

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from isoquilt.llm.common import small_side
from isoquilt.session import cut

#: Bytes of a turn's digest.
WIDTH = 16
#: Ids of one piece of a list that is digested over several slices.
PIECE = 512
GROUP = 5
SHARED = 9

_PARTS = (
    "open boolean, node binary, parent binary, piece long, ids string, conv_id long, depth long, parent_conv_id long, "
    "n_convs long, n_children long, n_leaves long, shared long, base long, ends_sha256 string"
)


def sequences(conversations: DataFrame) -> DataFrame:
    """(conv_id, key, sizes): the digests of the turns in their order as one binary, and the bytes of their texts."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.substring(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256), 1, 2 * WIDTH)
    turns = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.struct("turn", digest.alias("digest"), F.octet_length(text).cast("long").alias("size")).alias("one"),
    )
    # nulls come first in the order of structs too
    in_order = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("one")).alias("turns"))
    return in_order.select("conv_id", F.unhex(F.array_join("turns.digest", "")).alias("key"), F.col("turns.size").alias("sizes"))


def rebuilt(found: DataFrame, group: int = GROUP, shared: int = SHARED) -> DataFrame:
    """Sequences that begin with the first turns of their group's first conversation.

    Conversation ``c`` takes the first ``h`` turns of ``c - c % group``, then its own after its first ``h``;
    ``h`` is ``crc32`` of the decimal id modulo ``shared``.
    """
    found = cut(found)
    c = F.col("conv_id")
    h = F.pmod(F.crc32(c.cast("string").cast("binary")), F.lit(shared)).cast("int")
    own = found.withColumns({"h": h, "head": c - c % group})
    heads = found.select(F.col("conv_id").alias("head"), F.col("key").alias("head_key"), F.col("sizes").alias("head_sizes"))
    both = own.join(heads, "head", "left")
    no_key, no_sizes = F.lit(b"").cast("binary"), F.array().cast("array<long>")
    return both.select(
        "conv_id",
        F.expr(f"coalesce(substring(head_key, 1, {WIDTH} * h), X'') || coalesce(substring(key, {WIDTH} * h + 1), X'')").alias("key"),
        F.concat(
            F.coalesce(F.slice("head_sizes", F.lit(1), F.col("h")), no_sizes), F.slice("sizes", F.col("h") + 1, F.greatest(F.size("sizes"), F.lit(1)))
        ).alias("sizes"),
    ).select("conv_id", F.coalesce("key", no_key).alias("key"), "sizes")


def common_prefix(a: bytes, b: bytes) -> int:
    """Turns at the start of both sequences that are equal."""
    n = min(len(a), len(b)) // WIDTH
    if a[: n * WIDTH] == b[: n * WIDTH]:
        return n
    x, y = (np.frombuffer(k, dtype=np.uint64, count=n * WIDTH // 8).reshape(n, -1) for k in (a, b))
    return int(np.argmax((x != y).any(axis=1)))


class RangeMinimum:
    """Minima of every stretch of 2**k values."""

    def __init__(self, values: np.ndarray):
        self.rows = [values]
        while 2 << (len(self.rows) - 1) <= len(values):
            last, step = self.rows[-1], 1 << (len(self.rows) - 1)
            self.rows.append(np.minimum(last[:-step], last[step:]))

    def of(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Least value of first..last, both ends included."""
        k = np.frexp(last - first + 1)[1] - 1
        out = np.empty(len(first), dtype=self.rows[0].dtype)
        for level in np.unique(k):
            at = k == level
            row = self.rows[level]
            out[at] = np.minimum(row[first[at]], row[last[at] - (1 << level) + 1])
        return out

    def right(self, at: np.ndarray, least: np.ndarray) -> np.ndarray:
        """The last place up to which all values after ``at`` are ``least`` or more."""
        at = at.copy()
        for k in range(len(self.rows) - 1, -1, -1):
            row = self.rows[k]
            fits = at + 1 < len(row)
            fits[fits] = row[at[fits] + 1] >= least[fits]
            at[fits] += 1 << k
        return at

    def left(self, at: np.ndarray, least: np.ndarray) -> np.ndarray:
        """The first place after which all values up to ``at`` are ``least`` or more; value 0 is never passed."""
        at = at.copy()
        for k in range(len(self.rows) - 1, -1, -1):
            begin = at - (1 << k) + 1
            fits = begin >= 1
            fits[fits] = self.rows[k][begin[fits]] >= least[fits]
            at[fits] -= 1 << k
        return at


def _digest(ids: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, ids.tolist())).encode()).hexdigest()


def slice_nodes(conv: np.ndarray, keys: list, sizes: list, number: int, before: int, after: int) -> pd.DataFrame:
    """Nodes and parts of nodes of one slice of the order.

    ``before`` and ``after`` are the turns that its first and its last row have in common with their neighbours
    in other slices, -1 where there is none.
    """
    n = len(conv)
    length = np.array([len(k) // WIDTH for k in keys], dtype=np.int64)
    lcp = np.array([before, *[common_prefix(a, b) for a, b in zip(keys, keys[1:])]], dtype=np.int64)
    following = np.append(lcp[1:], after)
    # running bytes of each row's texts, one entry more than it has turns
    starts = np.concatenate(([0], np.cumsum(length + 1)))
    byte_sums = np.zeros(starts[-1], dtype=np.int64)
    for s, x in zip(starts.tolist(), sizes):
        byte_sums[s + 1 : s + 1 + len(x)] = np.cumsum(x)
    shared = byte_sums[starts[:-1] + np.maximum(lcp, 0)]
    leaf_sums = np.concatenate(([0], np.cumsum(following < length)))
    shared_sums = np.concatenate(([0], np.cumsum(shared)))

    # candidates: each row's prefixes from the one it shares with the row before to its whole
    new_from = np.where(np.arange(n) > 0, lcp + 1, 0)
    news = np.maximum(length - new_from + 1, 0)
    row = np.repeat(np.arange(n), news)
    depth = np.arange(len(row)) - np.repeat(np.cumsum(news) - news, news) + new_from[row]
    branch_row = np.flatnonzero((np.arange(n) > 0) & (length > lcp))
    all_row, all_depth = np.concatenate([row, branch_row]), np.concatenate([depth, lcp[branch_row]])
    table = RangeMinimum(lcp)
    first, last = table.left(all_row, all_depth), table.right(all_row, all_depth)
    node_at = np.cumsum(news) - news

    def place(r, d):
        """Number of the node that first shows at row ``r`` with depth ``d``."""
        return node_at[r] + d - new_from[r]

    branch = place(first[len(row) :], all_depth[len(row) :])
    children = np.bincount(branch, minlength=len(row))
    # the row that shows a node first may go on; a child that the slice before has shown already is not counted again
    children[(length[row] > depth) & (depth + 1 > lcp[row])] += 1
    parent = np.where(depth == new_from[row], -1, np.arange(len(row)) - 1)
    above = (parent < 0) & (row > 0)
    branch_of = np.zeros(n, dtype=np.int64)
    branch_of[branch_row] = branch
    parent[above] = branch_of[row[above]]

    first, last = first[: len(row)], last[: len(row)]
    open_left, open_right = (first == 0) & (depth <= before), (last == n - 1) & (depth <= after)
    is_open = open_left | open_right
    least = RangeMinimum(conv).of(first, last)
    base = byte_sums[starts[row] + np.maximum(depth - 1, 0)]
    shared_here = shared_sums[last + 1] - shared_sums[first + np.where(open_left, 0, 1)]
    # equal rows stand at the start of their node
    same = np.append((following[:-1] == length[:-1]) & (length[:-1] == length[1:]), False)
    stops = np.flatnonzero(~same)
    run_end = stops[np.searchsorted(stops, np.arange(n))]
    ends = [conv[f : run_end[f] + 1] if length[f] == d else conv[:0] for f, d in zip(first.tolist(), depth.tolist())]

    def name(r, d):
        return hashlib.sha256(keys[r][: WIDTH * d]).digest()[:WIDTH]

    asks = (parent >= 0) & is_open[parent] & ~is_open
    nodes = pd.DataFrame({
        "open": is_open,
        "node": [name(r, d) if o else None for r, d, o in zip(row.tolist(), depth.tolist(), is_open.tolist())],
        "parent": [name(r, d - 1) if d and (o or a) else None for r, d, o, a in zip(row.tolist(), depth.tolist(), is_open.tolist(), asks.tolist())],
        "piece": -1,
        "ids": None,
        "conv_id": least,
        "depth": depth,
        "parent_conv_id": pd.array(np.where(parent >= 0, least[parent], 0), dtype="Int64"),
        "n_convs": last - first + 1,
        "n_children": children,
        "n_leaves": leaf_sums[last + 1] - leaf_sums[first],
        "shared": shared_here,
        "base": base,
        "ends_sha256": [None if o else _digest(x) for o, x in zip(is_open.tolist(), ends)],
    })
    nodes.loc[(parent < 0) | is_open | asks, "parent_conv_id"] = pd.NA
    pieces = []
    for at in np.flatnonzero(is_open).tolist():
        for k in range(0, len(ends[at]), PIECE):
            ids = ",".join(map(str, ends[at][k : k + PIECE].tolist()))
            pieces.append({"open": True, "node": nodes["node"][at], "piece": (number << 32) + k, "ids": ids})
    return pd.concat([nodes, pd.DataFrame(pieces, columns=nodes.columns).astype({"parent_conv_id": "Int64"})]) if pieces else nodes


def _joined_digests(pieces: DataFrame) -> DataFrame:
    """(node, ends): digest of each node's pieces in their order; a task reads them as a stream."""

    def run(frames):
        node, state = None, None
        for frame in frames:
            out = []
            for name, ids in zip(frame["node"], frame["ids"]):
                if name != node:
                    if node is not None:
                        out.append((node, state.hexdigest()))
                    node, state = name, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            yield pd.DataFrame(out, columns=["node", "ends"])
        if node is not None:
            yield pd.DataFrame([(node, state.hexdigest())], columns=["node", "ends"])

    dealt = pieces.select("node", "piece", "ids").repartition("node").sortWithinPartitions("node", "piece")
    return dealt.select("node", "ids").mapInPandas(run, "node binary, ends string")


def prefix_nodes(found: DataFrame) -> DataFrame:
    """One row for each node of the trie over the sequences ``found`` (conv_id, key, sizes)."""
    ordered = cut(found.orderBy("key", "conv_id").withColumn("slice", F.spark_partition_id()))
    ends = ordered.groupBy("slice").agg(F.min("key").alias("low"), F.max("key").alias("high"))

    @F.pandas_udf("int")
    def alike(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([-1 if x is None or y is None else common_prefix(bytes(x), bytes(y)) for x, y in zip(a, b)], dtype="int32")

    at = W.orderBy("slice")
    borders = ends.select("slice", F.lag("high").over(at).alias("p"), "low", "high", F.lead("low").over(at).alias("q"))
    # two numbers a slice
    borders = borders.select("slice", alike("p", "low").alias("before"), alike("high", "q").alias("after"))
    known = {r["slice"]: (r["before"], r["after"]) for r in borders.collect()}

    def run(frames):
        held = pd.concat(list(frames), ignore_index=True)
        if len(held):
            number = int(held["slice"][0])
            keys = [bytes(k) for k in held["key"]]
            yield slice_nodes(held["conv_id"].to_numpy(), keys, list(held["sizes"]), number, *known[number])

    made = cut(ordered.mapInPandas(run, _PARTS))
    parts = made.where("open AND piece < 0").groupBy("node").agg(
        F.first("parent").alias("parent"), F.min("conv_id").alias("conv_id"), F.first("depth").alias("depth"), F.sum("n_convs").alias("n_convs"),
        F.sum("n_children").alias("n_children"), F.sum("n_leaves").alias("n_leaves"), F.sum("shared").alias("shared"), F.first("base").alias("base"),
    )
    parts = cut(parts.join(_joined_digests(made.where("piece >= 0")), "node", "left"))
    top = small_side(parts.select(F.col("node").alias("parent"), F.col("conv_id").alias("above")), parts.count())
    whole = made.where("NOT open").select(
        "parent", "parent_conv_id", "conv_id", "depth", "n_convs", "n_children", "n_leaves", "shared", "base", "ends_sha256"
    )
    none = hashlib.sha256(b"").hexdigest()
    split = parts.select(
        "parent", F.lit(None).cast("long").alias("parent_conv_id"), "conv_id", "depth", "n_convs", "n_children", "n_leaves", "shared", "base",
        F.coalesce("ends", F.lit(none)).alias("ends_sha256"),
    )
    saved = F.col("shared") - (F.col("n_convs") - 1) * F.col("base")
    return whole.unionByName(split).join(top, "parent", "left").select(
        "conv_id", "depth", F.coalesce("parent_conv_id", "above").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves",
        saved.alias("saved_tokens"), "ends_sha256",
    )


def trie(conversations: DataFrame) -> DataFrame:
    """Nodes of the trie over the rebuilt conversations."""
    return prefix_nodes(rebuilt(sequences(conversations)))
