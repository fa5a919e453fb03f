"""Mixing sources to target weights by Sainte-Lague apportionment.

The words of a source, each document up to ``repeats`` times, are laid out as a stream of
equal blocks, cut into shards of about ``shard_words`` words.  The blocks of the whole mix
are given to the sources by highest quotients ``target / (2 k + 1)``, the blocks of a source
to its shards in the same way.  In a shard the documents follow a seeded order, and its quota
is a run of blocks, cyclic, from a seeded start: documents stay whole but for those at the
two ends of a run.

Only blocks that the divisor can still move are ranked: with ``n`` items, ``N`` seats and total
weight ``W`` an item of weight ``w`` gets between ``w (N - n/2) / W - 1/2`` and
``w (N + n/2) / W + 1/2`` seats, so about three candidates an item are sorted, not ``N``.

Defined results: a null text has no words; null is a source of its own, after all others;
documents without words take nothing; equal quotients go to the smaller source, then shard;
repeated rows are documents of their own; an empty table gives an empty result; only the
named columns are read, so other columns cannot clash.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from isoquilt.llm.common import WORD, quoted, small_side, word_count
from isoquilt.session import cut, ordinal, running_totals

WEIGHTS = (5, 2, 1)
SHARE = 1.5
REPEATS = 2
BLOCK_WORDS = 16
SHARD_WORDS = 1_000_000
SEED = 7


def targets(sources: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, repeats: int = REPEATS) -> DataFrame:
    """(source, source_size) with ``source_rank`` and ``target`` added.

    The water level at which no target exceeds its cap is the largest of the levels
    reached when the sources are capped one by one in the order of cap over weight.
    """
    ranked = ordinal(sources, [F.col("source").asc_nulls_last()], "source_rank")
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    ranked = ranked.withColumn("weight", cycle[((F.col("source_rank") - 1) % len(weights)).cast("int")])
    ranked = ranked.withColumn("cap", F.lit(float(repeats)) * F.col("source_size"))
    filled = running_totals(ranked, [F.col("cap") / F.col("weight"), "source_rank"], {"caps": "cap", "weights": "weight"})
    filled = cut(filled)
    whole = filled.agg(
        (F.lit(share) * F.sum("source_size")).alias("mix_size"), F.sum("weight").alias("all_weights")
    )
    total = whole.first()
    if not total["all_weights"]:
        return ranked.withColumn("target", F.col("cap")).drop("weight", "cap")
    left = F.lit(total["mix_size"]) - (F.col("caps") - F.col("cap"))
    level = left / (F.lit(total["all_weights"]) - (F.col("weights") - F.col("weight")))
    water = filled.agg(F.max(level)).first()[0]
    aim = F.least("cap", F.lit(water) * F.col("weight"))
    return filled.withColumn("target", aim).select("source", "source_size", "source_rank", "target")


def apportion(items: DataFrame, group: str, item: str, weight: str, seats: str, name: str) -> DataFrame:
    """``items`` with ``name``: the seats of each item of a group by highest quotients.

    ``seats`` is the number of seats of the group, the same in all its rows.
    """
    per_group = items.groupBy(group).agg(
        F.sum(weight).alias("_weights"), F.count("*").alias("_items"), F.max(seats).alias("_seats")
    )
    groups = cut(per_group)
    bounded = items.join(small_side(groups, groups.count()), group)
    w, n, total, half = F.col(weight), F.col("_seats"), F.col("_weights"), F.col("_items") / 2
    low = F.greatest(F.lit(0.0), F.floor(w * (n - half) / total - 1.5))
    high = F.floor(w * (n + half) / total + 1.5)
    live = (total > 0) & (w > 0) & (n > 0)
    bounded = bounded.withColumn("_low", F.when(live, low).otherwise(0).cast("long"))
    bounded = cut(bounded.withColumn("_high", F.when(live, high).otherwise(0).cast("long")))
    open_seats = bounded.where("_high > _low").select(
        group, item, weight, "_seats", F.explode(F.sequence("_low", F.col("_high") - 1)).alias("_k")
    )
    ranked = ordinal(
        open_seats.withColumn("_quotient", F.col(weight) / (2 * F.col("_k") + 1)),
        [group, F.col("_quotient").desc(), item],
        "_order",
    )
    sums = bounded.groupBy(group).agg((F.max("_seats") - F.sum("_low")).alias("_left"))
    begins = cut(ranked.groupBy(group).agg(F.min("_order").alias("_begin")).join(sums, group))
    won = ranked.join(small_side(begins, begins.count()), group).where(
        F.col("_order") - F.col("_begin") < F.col("_left")
    )
    extra = won.groupBy(group, item).agg(F.count("*").alias("_won"))
    out = bounded.join(extra, [group, item], "left").withColumn(name, F.col("_low") + F.coalesce("_won", F.lit(0)))
    return out.select(*items.columns, name)


def _overlap(start: Column, end: Column, low: Column, high: Column) -> Column:
    return F.greatest(F.lit(0), F.least(end, high) - F.greatest(start, low))


def mix(
    docs: DataFrame,
    weights: tuple = WEIGHTS,
    share: float = SHARE,
    repeats: int = REPEATS,
    block_words: int = BLOCK_WORDS,
    shard_words: int = SHARD_WORDS,
    seed: int = SEED,
    sizes: DataFrame | None = None,
) -> DataFrame:
    """Per row of ``docs`` what the mix takes of it.

    ``docs`` has doc_id, source, size and any columns to be carried along; ``sizes`` may be a cheaper
    table of the same.  With a column text_hash, a long that tells texts apart, shards are dealt by id
    and text, so that rows without an id spread over them.  Adds source_size, target, taken, and
    ``parts``: an array of (from, to) word ranges of the document, one for each time it is used.
    """
    sources = (sizes if sizes is not None else docs).groupBy("source").agg(F.sum("size").alias("source_size"))
    aimed = targets(sources, weights, share, repeats)
    aimed = aimed.withColumn("all", F.lit(1)).withColumn("n_shards", F.ceil(F.col("source_size") / shard_words))
    aimed = cut(aimed.withColumn("n_shards", F.greatest(F.lit(1), F.col("n_shards")).cast("long")))
    blocks = aimed.agg(F.coalesce(F.round(F.sum("target") / block_words), F.lit(0.0)).cast("long")).first()[0]
    aimed = aimed.withColumn("blocks", F.lit(blocks))
    quotas = cut(apportion(aimed, "all", "source_rank", "target", "blocks", "source_blocks").drop("all", "blocks"))
    n_sources = quotas.count()
    named = ["doc_id", *(c for c in ("text_hash",) if c in docs.columns)]
    shard = F.pmod(F.xxhash64(*named, F.lit(seed)), F.col("n_shards")).alias("shard")

    def placed(rows: DataFrame, *columns: str) -> DataFrame:
        known = small_side(quotas.withColumnRenamed("source", "_source"), n_sources)
        both = rows.join(known, F.col("source").eqNullSafe(F.col("_source")))
        return both.select(*[both[quoted(c)] for c in columns], "source_rank", "source_blocks", "source_size", "target", shard)

    of_shards = placed(sizes if sizes is not None else docs, "size").groupBy("source_rank", "shard").agg(
        F.sum("size").cast("double").alias("shard_size"), F.first("source_blocks").alias("source_blocks")
    )
    shares = apportion(cut(of_shards), "source_rank", "shard", "shard_size", "source_blocks", "quota")
    shares = cut(shares.select("source_rank", "shard", F.col("shard_size").cast("long"), "quota"))

    rows = placed(docs, *docs.columns).join(small_side(shares, shares.count()), ["source_rank", "shard"])
    order = [F.xxhash64(*named, F.lit(seed)), *map(F.col, named), F.col("size")]
    before = F.sum("size").over(
        W.partitionBy("source_rank", "shard").orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    )
    rows = rows.withColumn("_start", before - F.col("size"))
    length = F.lit(repeats) * F.col("shard_size")
    count = F.ceil(length / block_words)
    rows = rows.withColumn("_count", count).withColumn("_quota", F.least("quota", count))
    first = F.pmod(F.xxhash64("source_rank", "shard", F.lit(seed)), F.greatest(F.lit(1), F.col("_count")))
    rows = rows.withColumn("_first", first).withColumn("_last", F.col("_first") + F.col("_quota"))
    runs = [
        (F.col("_first") * block_words, F.least(F.col("_last") * block_words, length)),
        (F.lit(0), F.greatest(F.lit(0), (F.col("_last") - F.col("_count")) * block_words)),
    ]
    parts = []
    for copy in range(repeats):
        start = F.col("_start") + copy * F.col("shard_size")
        for low, high in runs:
            begin = F.greatest(start, low) - start
            end = begin + _overlap(start, start + F.col("size"), low, high)
            parts.append(F.struct(begin.cast("long").alias("from"), end.cast("long").alias("to")))
    rows = rows.withColumn("parts", F.filter(F.array(*parts), lambda p: p["to"] > p["from"]))
    taken = F.aggregate("parts", F.lit(0).cast("long"), lambda s, p: s + p["to"] - p["from"])
    return rows.select(*map(quoted, docs.columns), "source_size", "target", taken.alias("taken"), "parts")


def mix_report(docs: DataFrame) -> DataFrame:
    """(doc_id, size, source_size, target, taken) for every document."""
    sized = cut(docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), F.xxhash64("text").alias("text_hash")))
    return mix(sized).select("doc_id", "size", "source_size", "target", "taken")


def mixed(docs: DataFrame) -> DataFrame:
    """The mix itself, with the columns of ``docs``: a row for each time a document is used.

    A document at the end of a run of blocks comes with only the words inside the run.
    """
    own = ["doc_id", "source", "text"]
    size = word_count(F.col("text")).alias("size")
    # sizes are worked out once; a text travels once, next to the row's other columns
    names = [F.xxhash64("text").alias("text_hash"), size]
    sizes = cut(docs.select("doc_id", "source", *names))
    place = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    others = F.struct(F.lit(0).alias("none"), *[F.col(quoted(c)).alias(place[c]) for c in docs.columns if c not in own]).alias("row")
    used = mix(docs.select(*own, others, *names), sizes=sizes).select(*own, "row", "size", F.explode("parts").alias("part"))
    # word k with the white space that follows it
    words = F.regexp_extract_all("text", F.lit(WORD + r"[\x20\x09-\x0D]*"), F.lit(0))
    first, count = F.col("part.from").cast("int"), (F.col("part.to") - F.col("part.from")).cast("int")
    whole = (first == 0) & (count == F.col("size"))
    used = used.withColumn("text", F.when(whole, F.col("text")).otherwise(F.array_join(F.slice(words, first + 1, count), "")))
    made = {c: F.col(c) for c in own} | {"n_chars": F.length("text").cast("long")}
    return used.select(*[made.get(c, F.col(f"row.{place[c]}")).alias(c) for c in docs.columns])
