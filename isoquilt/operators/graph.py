"""Graphs as edge tables: components, shared neighbours, and clusters of many graphs at once.

Every table carries the columns of ``keys`` (the graph a row belongs to) next to
the vertex ids ``a`` < ``b``; all graphs are processed in the same jobs.
"""

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from isoquilt.functions.communities import GRAIN, cut_below, split_graph
from isoquilt.session import cut


def _fingerprint(edges: DataFrame, keys: list):
    mixed = F.sum(F.xxhash64(*keys, "a", "b").cast("decimal(38,0)"))
    return tuple(edges.agg(F.count("*"), mixed).first())


#: Edges that one task clusters, a few thousand small graphs.
TASK_ROWS = 50_000


def whole_groups(batches, keys: list):
    """(table, bounds) of tables whose rows come sorted by ``keys``, no group in two of them."""
    held = None
    for table in batches:
        held = (table if held is None else pa.concat_tables([held, table])).combine_chunks()
        if not held.num_rows:
            continue
        starts = np.zeros(held.num_rows, dtype=bool)
        starts[0] = True
        for k in keys:
            column = held.column(k)
            starts[1:] |= pc.not_equal(column.slice(1), column.slice(0, held.num_rows - 1)).to_numpy()
        bounds = np.flatnonzero(starts)
        if len(bounds) > 1:
            yield held.slice(0, int(bounds[-1])), bounds
            held = held.slice(int(bounds[-1]))
    if held is not None and held.num_rows:
        yield held, np.array([0, held.num_rows])


def in_groups(df: DataFrame, keys: list, run, schema, before=None) -> DataFrame:
    """``run(table, bounds)``, a pyarrow table, of groups of bounded size, many at a time; rows that lie by ``keys`` stay where they are.

    ``before`` may work on the rows of a batch first, keeping their order.
    """
    nth = F.row_number().over(W.partitionBy(*keys).orderBy(F.lit(0)))

    def over(batches):
        tables = (pa.Table.from_batches([batch]).drop_columns(["_nth"]) for batch in batches)
        for table, bounds in whole_groups(map(before, tables) if before else tables, keys):
            yield from run(table, bounds).to_batches()

    return df.dropna(subset=keys).withColumn("_nth", nth).mapInArrow(over, schema)


def _vertices(table: pa.Table, bounds: np.ndarray) -> tuple:
    """Ends of edges as numbers in the order of graph and id; graph, id and first place among all ends of each vertex."""
    rows = table.num_rows
    group = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    ids = np.concatenate([table.column("a").to_numpy(), table.column("b").to_numpy()])
    graph = np.concatenate([group, group])
    order = np.lexsort((ids, graph))
    fresh = np.ones(len(ids), dtype=bool)
    fresh[1:] = (ids[order][1:] != ids[order][:-1]) | (graph[order][1:] != graph[order][:-1])
    number = np.empty(len(ids), dtype=np.int64)
    number[order] = np.cumsum(fresh) - 1
    return number[:rows], number[rows:], order[fresh], ids[order[fresh]]


def components_in_tasks(edges: DataFrame, keys: list, before=None) -> DataFrame:
    """``connected_components`` of graphs of bounded size, a task's graphs at once."""

    def run(table, bounds):
        one, two, place, ids = _vertices(table, bounds)
        least = np.arange(len(ids))
        while True:
            low = np.minimum(least[one], least[two])
            new = least.copy()
            np.minimum.at(new, least[one], low)
            np.minimum.at(new, least[two], low)
            while (new[new] != new).any():
                new = new[new]
            if (new == least).all():
                break
            least = new
        at = pa.array(place % table.num_rows)
        columns = [table.column(k).take(at) for k in keys]
        return pa.table([*columns, pa.array(ids), pa.array(ids[least])], names=[*keys, "id", "component"])

    fields = [f for f in edges.schema.fields if f.name in keys]
    schema = T.StructType([*fields, T.StructField("id", T.LongType()), T.StructField("component", T.LongType())])
    return in_groups(edges.where("a <> b"), keys, run, schema, before)


def shared_in_tasks(edges: DataFrame, keys: list, fields: list, before=None) -> DataFrame:
    """``fields`` of edges and the ``share`` that ``shared_neighbours`` gives them, null for self edges; for graphs of bounded size, a task's at once."""

    def run(table, bounds):
        one, two, _, ids = _vertices(table, bounds)
        na, nb = (table.column(c).to_numpy().astype(np.int64) for c in ("na", "nb"))
        plain = np.flatnonzero(one != two)
        a, b, sizes = one[plain], two[plain], np.zeros(len(ids), dtype=np.int64)
        sizes[one], sizes[two] = na, nb
        # from the end with fewer neighbours to the one with more
        degree = np.bincount(a, minlength=len(ids)) + np.bincount(b, minlength=len(ids))
        turn = (degree[a] > degree[b]) | ((degree[a] == degree[b]) & (a > b))
        u, v = np.where(turn, b, a), np.where(turn, a, b)
        order = np.lexsort((v, u))
        u, v, edge = u[order], v[order], plain[order]
        # paths over u: an edge with every later one from the same end
        last = np.searchsorted(u, u, "right")
        count = last - np.arange(len(u)) - 1
        x = np.repeat(np.arange(len(u)), count)
        y = np.arange(len(x)) - np.repeat(np.cumsum(count) - count, count) + x + 1
        key = u * max(1, len(ids)) + v
        share = np.zeros(table.num_rows, dtype=np.int64)
        for p, q in ((v[x], v[y]), (v[y], v[x])):
            ask = p * max(1, len(ids)) + q
            at = np.minimum(np.searchsorted(key, ask), max(0, len(key) - 1))
            hit = np.flatnonzero(key[at] == ask) if len(key) else np.empty(0, dtype=np.int64)
            closing = at[hit]
            np.add.at(share, edge[closing], sizes[u[x[hit]]])
            np.add.at(share, edge[x[hit]], sizes[v[y[hit]]])
            np.add.at(share, edge[y[hit]], sizes[v[x[hit]]])
        return table.select([f.name for f in fields]).append_column("share", pa.array(share, mask=one == two))

    return in_groups(edges, keys, run, T.StructType([*fields, T.StructField("share", T.LongType())]), before)


def connected_components(edges: DataFrame, keys: list) -> DataFrame:
    """(keys, id, component) for every vertex of an edge; the component is its smallest id.

    Alternates two rewiring steps: every vertex first points its larger neighbours,
    then its smaller ones, at the smallest id it sees.  Stars remain after a number
    of rounds that grows with the logarithm of the longest chain.  Minima are taken
    by partial aggregation and joined back, so a hub is never gathered in one task.
    """
    e = cut(edges.where("a <> b").select(*keys, F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    seen = _fingerprint(e, keys)
    while True:
        both = e.unionByName(e.select(*keys, F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy(*keys, "a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        large = both.where("b > a").join(low, [*keys, "a"]).select(*keys, F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        low = large.groupBy(*keys, "a").agg(F.min("b").alias("m"))
        small = large.join(low, [*keys, "a"])
        moved = small.select(*keys, F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        e = cut(moved.unionByName(low.select(*keys, "a", F.col("m").alias("b"))).distinct())
        now = _fingerprint(e, keys)
        if now == seen:
            break
        seen = now
    leaves = e.select(*keys, F.col("a").alias("id"), F.col("b").alias("component"))
    roots = e.select(*keys, F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    return leaves.unionByName(roots)


def shared_neighbours(edges: DataFrame, keys: list) -> DataFrame:
    """Per edge the summed ``count`` of vertices adjacent to both ends.

    Needs the columns ``a``, ``b``, ``na``, ``nb``.  Edges are turned from the end
    with fewer neighbours to the one with more before paths are formed, so a hub
    starts few paths and the number of paths stays near edges x sqrt(edges).
    """
    e = edges.where("a <> b").select(*keys, "a", "b", "na", "nb")
    degree = (
        e.select(*keys, F.col("a").alias("id"))
        .unionAll(e.select(*keys, F.col("b").alias("id")))
        .groupBy(*keys, "id")
        .agg(F.count("*").alias("deg"))
    )
    e = e.join(degree.withColumnsRenamed({"id": "a", "deg": "da"}), [*keys, "a"]).join(
        degree.withColumnsRenamed({"id": "b", "deg": "db"}), [*keys, "b"]
    )
    first = F.struct("da", "a") < F.struct("db", "b")
    turned = e.select(
        *keys,
        F.when(first, F.col("a")).otherwise(F.col("b")).alias("u"),
        F.when(first, F.col("b")).otherwise(F.col("a")).alias("v"),
        F.when(first, F.col("na")).otherwise(F.col("nb")).alias("nu"),
        F.when(first, F.col("nb")).otherwise(F.col("na")).alias("nv"),
    )
    other = turned.select(*keys, "u", F.col("v").alias("w"), F.col("nv").alias("nw"))
    paths = turned.join(other, [*keys, "u"]).where("v < w")
    closing = e.select(*keys, F.col("a").alias("v"), F.col("b").alias("w"))
    triangles = paths.join(closing, [*keys, "v", "w"])

    def side(x, y, third):
        return triangles.select(*keys, F.least(x, y).alias("a"), F.greatest(x, y).alias("b"), F.col(third).alias("n"))

    shared = (
        side("v", "w", "nu").unionAll(side("u", "v", "nw")).unionAll(side("u", "w", "nv"))
        .groupBy(*keys, "a", "b")
        .agg(F.sum("n").alias("share"))
    )
    return edges.where("a <> b").select(*keys, "a", "b").join(shared, [*keys, "a", "b"], "left").withColumn(
        "share", F.coalesce("share", F.lit(0).cast("bigint"))
    )


def split_in_tasks(edges: DataFrame, keys: list, alpha: int, accept_ns: float, before=None) -> DataFrame:
    """Cluster graphs of bounded size: one pass over edges sorted by graph, which stay where they lie by it."""
    fields = [f for f in edges.schema.fields if f.name in keys]
    schema = T.StructType([*fields, T.StructField("id", T.LongType()), T.StructField("cluster", T.LongType())])

    def solve(held: dict, lo: int, hi: int, out: dict) -> None:
        ends = np.concatenate([held["a"][lo:hi], held["b"][lo:hi]])
        sizes = np.concatenate([held["na"][lo:hi], held["nb"][lo:hi]])
        ids, first, inverse = np.unique(ends, return_index=True, return_inverse=True)
        half = hi - lo
        links = zip(inverse[:half].tolist(), inverse[half:].tolist(), held["ns"][lo:hi].tolist(), held["capacity"][lo:hi].tolist())
        names = ids.tolist()
        out["cluster"] += split_graph(names, sizes[first].tolist(), list(links), alpha, accept_ns)
        out["id"] += names
        for k in keys:
            out[k] += [held[k][lo]] * len(names)

    def run(table, bounds):
        held, out = {c: table.column(c).to_pandas().to_numpy() for c in table.column_names}, {k: [] for k in [*keys, "id", "cluster"]}
        for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            solve(held, lo, hi, out)
        kinds = {k: table.schema.field(k).type for k in keys} | {"id": pa.int64(), "cluster": pa.int64()}
        return pa.table({c: pa.array(v, kinds[c]) for c, v in out.items()})

    return in_groups(edges, keys, run, schema, before)


def _dealt_and_split(edges: DataFrame, keys: list, alpha: int, accept_ns: float) -> DataFrame:
    # an explicit number keeps small graphs from being coalesced into a single Python task
    tasks = max(edges.sparkSession.sparkContext.defaultParallelism, -(-edges.count() // TASK_ROWS))
    edges = edges.select(*keys, "a", "b", "na", "nb", "ns", "capacity").repartition(tasks, *keys)
    return split_in_tasks(edges, keys, alpha, accept_ns)


def _whole(column):
    """Sums and products of weights, wider than a long."""
    return F.col(column).cast("decimal(19,0)") if isinstance(column, str) else column.cast("decimal(19,0)")


def _scores(both: DataFrame, state: DataFrame, total: DataFrame, keys: list) -> DataFrame:
    """(keys, score): modularity of the communities of ``state``, as ``communities.settle`` counts it."""
    near = state.select(*keys, F.col("id").alias("to"), F.col("comm").alias("there"))
    met = both.join(near, [*keys, "to"]).join(state.select(*keys, "id", "comm"), [*keys, "id"]).where("comm = there")
    inside = met.groupBy(*keys, "comm").agg(F.sum("w").alias("inside"))
    mass = state.groupBy(*keys, "comm").agg(F.sum("deg").alias("mass"), F.sum(2 * F.col("loop")).alias("loops"))
    each = mass.join(inside, [*keys, "comm"], "left").join(total, keys)
    held = F.col("loops") + F.coalesce("inside", F.lit(0))
    return each.groupBy(*keys).agg(F.sum(_whole(held) * _whole("total") - _whole("mass") * _whole("mass")).alias("score"))


def _proposals(both: DataFrame, state: DataFrame, total: DataFrame, keys: list) -> DataFrame:
    """(keys, id, own, target, best): every vertex's best move with a positive gain."""
    near = state.select(*keys, F.col("id").alias("to"), F.col("comm").alias("target"))
    pull = both.join(near, [*keys, "to"]).groupBy(*keys, "id", "target").agg(F.sum("w").alias("pull"))
    mass = state.groupBy(*keys, "comm").agg(F.sum("deg").alias("mass"))
    here = state.select(*keys, "id", "deg", F.col("comm").alias("own")).join(
        mass.withColumnsRenamed({"comm": "own", "mass": "own_mass"}), [*keys, "own"]
    )
    options = pull.join(here, [*keys, "id"])
    base = options.where("target = own").select(*keys, "id", F.col("pull").alias("base"))
    others = options.where("target <> own").join(base, [*keys, "id"], "left")
    others = others.join(mass.withColumnRenamed("comm", "target"), [*keys, "target"]).join(total, keys)
    rest = F.col("own_mass") - F.col("deg")
    gain = _whole(F.col("pull") - F.coalesce("base", F.lit(0))) * _whole("total") - _whole("deg") * _whole(
        F.col("mass") - rest
    )
    move = F.struct(gain.alias("gain"), F.xxhash64("id", "target").alias("tie"), "id", "target")
    best = others.withColumn("best", move).where("best.gain > 0").groupBy(*keys, "id").agg(F.max("best").alias("best"))
    return best.join(state.select(*keys, "id", F.col("comm").alias("own")), [*keys, "id"]).select(
        *keys, "id", "own", F.col("best.target").alias("target"), "best"
    )


def _settle(edges: DataFrame, loops: DataFrame, keys: list) -> DataFrame:
    """(keys, id, comm) once no vertex gains by a move: ``communities.settle`` as joins."""
    both = edges.select(*keys, F.col("a").alias("id"), F.col("b").alias("to"), "w")
    both = cut(both.unionByName(edges.select(*keys, F.col("b").alias("id"), F.col("a").alias("to"), "w")))
    pulls = both.groupBy(*keys, "id").agg(F.sum("w").alias("pulled"))
    degree = F.coalesce("pulled", F.lit(0)) + 2 * F.col("loop")
    state = cut(loops.join(pulls, [*keys, "id"], "left").select(*keys, "id", "loop", degree.alias("deg"), F.col("id").alias("comm")))
    total = cut(state.groupBy(*keys).agg(F.sum("deg").alias("total")))
    score = cut(_scores(both, state, total, keys))
    while True:
        moves = cut(_proposals(both, state, total, keys))
        if moves.isEmpty():
            return state.select(*keys, "id", "comm")

        def moved(by: DataFrame, now: DataFrame = state) -> DataFrame:
            new = now.join(by.select(*keys, "id", "target"), [*keys, "id"], "left")
            return new.select(*keys, "id", "loop", "deg", F.coalesce("target", "comm").alias("comm"))

        bold = cut(_scores(both, moved(moves), total, keys))
        better = bold.join(score.withColumnRenamed("score", "before"), keys).where("score > before").select(*keys)
        careful = moves.join(better, keys, "left_anti")
        touched = careful.select(*keys, F.col("own").alias("c"), "best").unionByName(
            careful.select(*keys, F.col("target").alias("c"), "best")
        )
        top = touched.groupBy(*keys, "c").agg(F.max("best").alias("top")).select(*keys, "c", F.col("top.id").alias("top"))
        sure = careful.join(top.withColumnsRenamed({"c": "own", "top": "t1"}), [*keys, "own"])
        sure = sure.join(top.withColumnsRenamed({"c": "target", "top": "t2"}), [*keys, "target"]).where("t1 = id and t2 = id")
        bold_moves = moves.join(better, keys, "left_semi")
        state = cut(moved(bold_moves.select(*keys, "id", "target").unionByName(sure.select(*keys, "id", "target"))))
        score = cut(_scores(both, state, total, keys))


def _communities(edges: DataFrame, keys: list) -> DataFrame:
    """(keys, id, comm): ``communities.multilevel`` as joins; needs ``a``, ``b``, ``w``."""
    ends = edges.select(*keys, F.col("a").alias("id"), F.when(F.col("a") == F.col("b"), F.col("w")).otherwise(0).alias("loop"))
    ends = ends.unionByName(edges.select(*keys, F.col("b").alias("id"), F.lit(0).alias("loop")))
    loops = cut(ends.groupBy(*keys, "id").agg(F.sum("loop").alias("loop")))
    links = cut(edges.where("a <> b and w > 0").select(*keys, "a", "b", "w"))
    label = loops.select(*keys, "id", F.col("id").alias("at"))
    while True:
        comm = _settle(links, loops, keys)
        if comm.where("id <> comm").isEmpty():
            return label.select(*keys, "id", F.col("at").alias("comm"))
        at = comm.withColumnRenamed("id", "at")
        label = cut(label.join(at, [*keys, "at"]).select(*keys, "id", F.col("comm").alias("at")))
        ca, cb = comm.withColumnsRenamed({"id": "a", "comm": "ca"}), comm.withColumnsRenamed({"id": "b", "comm": "cb"})
        moved = links.join(ca, [*keys, "a"]).join(cb, [*keys, "b"])
        moved = cut(moved.select(*keys, F.least("ca", "cb").alias("a"), F.greatest("ca", "cb").alias("b"), "w"))
        inner = moved.where("a = b").select(*keys, F.col("a").alias("id"), F.col("w").alias("loop"))
        held = loops.join(comm, [*keys, "id"]).select(*keys, F.col("comm").alias("id"), "loop").unionByName(inner)
        loops = cut(held.groupBy(*keys, "id").agg(F.sum("loop").alias("loop")))
        links = cut(moved.where("a <> b").groupBy(*keys, "a", "b").agg(F.sum("w").alias("w")))


def _joined_by(links: DataFrame, keys: list) -> DataFrame:
    """Renaming (keys, id, to) that merges the ends of every link."""
    return connected_components(links, keys).withColumnRenamed("component", "to")


def _cut_off(edges: DataFrame, sizes: DataFrame, keys: list, alpha: int) -> DataFrame:
    """Keys of the pieces that some cut of less than ``n / alpha`` capacity takes apart (exact).

    Vertices that no such cut can part are merged: ends of an edge, or of an edge and its two-step
    ways, that together hold the bound.  A piece merged to one vertex has no such cut, one with a
    vertex below the bound has.  What neither settles is small and dense, and goes to the exact search.
    """
    bound = F.col("n") / F.lit(float(alpha))
    left = cut(edges.where("a <> b").groupBy(*keys, "a", "b").agg(F.sum("capacity").alias("w")))
    found = None
    while True:
        ends = left.select(*keys, F.col("a").alias("id"), "w").unionAll(left.select(*keys, F.col("b").alias("id"), "w"))
        degree = ends.groupBy(*keys, "id").agg(F.sum("w").alias("deg"))
        loose = cut(degree.join(sizes, keys).where(F.col("deg") < bound).select(*keys).distinct())
        found = loose if found is None else found.unionByName(loose)
        left = cut(left.join(loose, keys, "left_anti"))
        if left.isEmpty():
            return found
        heavy = left.join(sizes, keys).where(F.col("w") >= bound).select(*keys, "a", "b")
        if heavy.isEmpty():
            heavy = _tied(left, keys).join(sizes, keys).where(F.col("tied") >= bound).select(*keys, "a", "b")
        heavy = cut(heavy)
        if heavy.isEmpty():
            return found.unionByName(_searched(left.join(sizes, keys), keys, alpha))
        names = _joined_by(heavy, keys)
        renamed = left.join(names.withColumnsRenamed({"id": "a", "to": "ta"}), [*keys, "a"], "left").join(
            names.withColumnsRenamed({"id": "b", "to": "tb"}), [*keys, "b"], "left"
        )
        a, b = F.coalesce("ta", "a"), F.coalesce("tb", "b")
        renamed = renamed.select(*keys, F.least(a, b).alias("a"), F.greatest(a, b).alias("b"), "w").where("a <> b")
        left = cut(renamed.groupBy(*keys, "a", "b").agg(F.sum("w").alias("w")))


def _tied(links: DataFrame, keys: list) -> DataFrame:
    """(keys, a, b, tied): capacity of each edge and of all ways over one vertex between its ends."""
    both = links.select(*keys, F.col("a").alias("id"), F.col("b").alias("to"), "w")
    both = both.unionByName(links.select(*keys, F.col("b").alias("id"), F.col("a").alias("to"), "w"))
    one, two = (both.select(*keys, F.col("to").alias("via"), F.col("id").alias(e), F.col("w").alias("w" + e)) for e in "ab")
    ways = links.select(*keys, "a", "b").join(one, [*keys, "a"]).join(two, [*keys, "b", "via"])
    over = ways.groupBy(*keys, "a", "b").agg(F.sum(F.least("wa", "wb")).alias("over"))
    return links.join(over, [*keys, "a", "b"], "left").select(
        *keys, "a", "b", (F.col("w") + F.coalesce("over", F.lit(0))).alias("tied")
    )


def _searched(left: DataFrame, keys: list, alpha: int) -> DataFrame:
    """Keys of the merged pieces for which the search of all cuts finds one below the bound."""
    fields = [f for f in left.schema.fields if f.name in keys]

    def search(pdf: pd.DataFrame) -> pd.DataFrame:
        ids = np.unique(pdf[["a", "b"]].to_numpy())
        at = {v: k for k, v in enumerate(ids.tolist())}
        links = [(at[a], at[b], w) for a, b, w in zip(pdf["a"], pdf["b"], pdf["w"])]
        return pdf[keys].head(int(cut_below(len(ids), links, pdf["n"].iloc[0] / alpha)))

    return left.groupBy(*keys).applyInPandas(search, T.StructType(fields))


def cluster_graphs(edges: DataFrame, keys: list, alpha: int, accept_ns: float, task_edges: int) -> DataFrame:
    """(keys, id, cluster) for every vertex with an edge; the cluster is its smallest id.

    A connected piece stays whole if it has at most ``alpha`` vertices, if every edge is strong, or if
    no cut of less than one ``alpha``-th of its vertices takes it apart; else edges between its
    communities go, and what is left is judged again.  Graphs of up to ``task_edges`` edges are solved inside
    tasks, larger ones by joins; both follow the same rule in whole numbers and give the same labels.
    """
    edges = cut(edges)
    sizes = edges.groupBy(*keys).agg(F.count("*").alias("n_edges"))
    over = cut(sizes.where(F.col("n_edges") > task_edges).select(*keys))
    if over.isEmpty():
        return _dealt_and_split(edges, keys, alpha, accept_ns)
    results = [_dealt_and_split(edges.join(over, keys, "left_anti"), keys, alpha, accept_ns)]
    left = cut(edges.join(over, keys, "left_semi"))
    whole = [*keys, "piece"]
    while not left.isEmpty():
        comp = connected_components(left, keys).withColumnRenamed("component", "piece")
        lone = left.where("a = b").select(*keys, F.col("a").alias("id")).distinct()
        comp = cut(comp.unionByName(lone.join(comp, [*keys, "id"], "left_anti").withColumn("piece", F.col("id"))))
        tagged = cut(left.join(comp.withColumnRenamed("id", "a"), [*keys, "a"]))
        size = tagged.groupBy(*whole).agg(F.count("*").alias("n_edges"), F.min("ns").alias("min_ns"))
        big_keys = cut(size.where(F.col("n_edges") > task_edges))
        fits = tagged.join(big_keys.select(*whole), whole, "left_anti")
        results.append(_dealt_and_split(fits, whole, alpha, accept_ns).drop("piece"))
        big = cut(tagged.join(big_keys.select(*whole), whole, "left_semi"))
        if big.isEmpty():
            break
        members = comp.join(big_keys.select(*whole), whole, "left_semi")
        shape = cut(members.groupBy(*whole).agg(F.count("*").alias("n")).join(big_keys, whole))
        open_ = shape.where((F.col("min_ns") <= accept_ns) & (F.col("n") > alpha)).select(*whole, "n")
        doubtful = big.join(open_.select(*whole), whole, "left_semi")
        loose = cut(_cut_off(doubtful, open_, whole, alpha).distinct())
        cutting = cut(big.join(loose, whole, "left_semi"))
        share = F.when(F.col("a") == F.col("b"), F.lit(1)).when(
            (F.coalesce("share", F.lit(0)) == 0) & (F.col("ns") > accept_ns), F.lit(1)
        ).otherwise(F.coalesce("share", F.lit(0)))
        weight = F.floor(F.col("ns") * F.sqrt(share.cast("double")) * GRAIN).cast("bigint")
        weighed = cutting.join(shared_neighbours(cutting, whole), [*whole, "a", "b"], "left").withColumn("w", weight)
        comm = cut(_communities(cut(weighed.select(*whole, "a", "b", "w")), whole))
        parted = cut(comm.groupBy(*whole).agg(F.count_distinct("comm").alias("parts")).where("parts > 1").select(*whole))
        settled = members.join(parted, whole, "left_anti")
        results.append(cut(settled.select(*keys, "id", F.col("piece").alias("cluster"))))
        ca = comm.withColumnsRenamed({"id": "a", "comm": "ca"})
        cb = comm.withColumnsRenamed({"id": "b", "comm": "cb"})
        kept = cutting.join(parted, whole, "left_semi").join(ca, [*whole, "a"]).join(cb, [*whole, "b"]).where("ca = cb")
        left = cut(kept.select(*keys, "a", "b", "na", "nb", "ns", "capacity"))
        touched = left.select(*keys, F.col("a").alias("id")).union(left.select(*keys, F.col("b").alias("id"))).distinct()
        bare = members.join(parted, whole, "left_semi").join(touched, [*keys, "id"], "left_anti")
        results.append(cut(bare.select(*keys, "id", F.col("id").alias("cluster"))))
    out = results[0]
    for part in results[1:]:
        out = out.unionByName(part)
    return out
