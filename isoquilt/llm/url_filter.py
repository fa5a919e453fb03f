"""URL filter: a blocked Bloom filter of listed URLs in front of an exact hash join.

A listed entry is a canonical host followed by the beginning of a path.  Of each url the
keys that could be listed are formed: every ending of the host at a label, as many labels
as a listed host has at most, joined with the beginnings of the path of the lengths that
listed paths have.  Keys the Bloom filter rejects are gone at once; the rest meet the list in a hash
join, which removes the false positives, and the longest entry that is left decides.

The filter's blocks are of 256 bits, four words with one bit a key in each.  It has at most
``MAX_BLOCKS`` blocks, two megabytes; a longer list only makes more false positives for the join.

Defined results: a null url, or one without ``://``, has empty host and path and the default
verdict; of an entry listed twice a block wins; repeated rows are each judged; an empty list or table
gives default verdicts or no rows; only the id and url columns are read, so other columns cannot clash.
"""

from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from isoquilt.llm.common import BROADCAST_ROWS

BITS_PER_KEY = 16
WORDS = 4
MAX_BLOCKS = 1 << 16


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Lower-cased host, and path up to a query or fragment; both empty without ``://``."""
    url = F.coalesce(url, F.lit(""))
    host = F.regexp_extract(url, r"://([^/?#]*)", 1)
    return F.translate(host, ascii_uppercase, ascii_lowercase), F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1)


def listed_entries(spark: SparkSession, rules: list[tuple[str, str]]) -> DataFrame:
    """(key, verdict) of (entry, verdict) pairs such as ``("net/es/", "block")``."""
    return spark.createDataFrame(rules, "key string, verdict string")


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks))


def _bit(key: Column, word: int) -> Column:
    place = F.shiftright(F.xxhash64(key, F.lit(1)), 6 * word).bitwiseAND(F.lit(63)).cast("int")
    return F.call_function("shiftleft", F.lit(1).cast("long"), place)


def bloom_filter(keys: DataFrame, blocks: int) -> DataFrame:
    """One row: ``words``, the filter's words in order, as an array of longs."""
    spread = [
        F.struct((_block(F.col("key"), blocks) * WORDS + w).alias("at"), _bit(F.col("key"), w).alias("bit"))
        for w in range(WORDS)
    ]
    masks = keys.select(F.inline(F.array(*spread))).groupBy("at").agg(F.bit_or("bit").alias("mask"))
    every = keys.sparkSession.range(blocks * WORDS).join(masks, F.col("id") == F.col("at"), "left")
    pairs = F.array_sort(F.collect_list(F.struct("id", F.coalesce("mask", F.lit(0).cast("long")).alias("mask"))))
    return every.agg(F.transform(pairs, lambda p: p["mask"]).alias("words"))


def _may_hold(words: Column, key: Column, blocks: int) -> Column:
    hit = None
    for w in range(WORDS):
        bit = _bit(key, w)
        word = F.get(words, (_block(key, blocks) * WORDS + w).cast("int"))
        one = word.bitwiseAND(bit) != 0
        hit = one if hit is None else hit & one
    return hit


def judge(
    pages: DataFrame, listed: DataFrame, id_col: str = "page_id", url_col: str = "url", default: str = "allow"
) -> DataFrame:
    """(page_id, host, path, rule, verdict) for every row of ``pages``."""
    listed = listed.where("key is not null").groupBy("key").agg(F.max("verdict").alias("verdict"))
    host, path = F.substring_index("key", "/", 1), F.col("key")
    shape = listed.agg(
        F.count("*").alias("n"),
        F.coalesce(F.max(F.size(F.split(host, r"\."))), F.lit(0)).alias("labels"),
        F.sort_array(F.collect_set(F.length(path) - F.length(host))).alias("lengths"),
    ).first()
    judged_host, judged_path = host_and_path(F.col(url_col))
    rows = pages.select(F.col(id_col).alias("page_id"), judged_host.alias("host"), judged_path.alias("path"))
    none = F.lit(None).cast("string")
    if not shape["n"]:
        return rows.withColumns({"rule": none, "verdict": F.lit(default)})
    blocks = min(MAX_BLOCKS, -(-shape["n"] * BITS_PER_KEY // (64 * WORDS)))
    # a bounded number of words; the split is folded to one array literal
    made = bloom_filter(listed, blocks).first()["words"]
    words = F.split(F.lit(",".join(map(str, made))), ",").cast("array<bigint>")
    labels = F.split("host", r"\.")
    endings = F.transform(
        F.sequence(F.lit(1), F.least(F.size(labels), F.lit(shape["labels"]))),
        lambda n: F.call_function("substring_index", F.col("host"), F.lit("."), -n),
    )
    beginnings = F.transform(
        F.filter(F.array(*[F.lit(n) for n in shape["lengths"]]), lambda n: n <= F.length("path")),
        lambda n: F.left(F.col("path"), n),
    )
    keys = F.flatten(F.transform(endings, lambda e: F.transform(beginnings, lambda b: F.concat(e, b))))
    passed = F.filter(keys, lambda k: _may_hold(words, k, blocks))
    rows = rows.withColumn("keys", F.when(F.col("host") == "", F.array().cast("array<string>")).otherwise(passed))
    free = rows.where(F.size("keys") == 0).select("page_id", "host", "path", none.alias("rule"), F.lit(default).alias("verdict"))
    # rows that are equal in a partition are counted and given back as often
    group = ["page_id", "host", "path", "slice"]
    probes = rows.where(F.size("keys") > 0).select(
        "page_id", "host", "path", F.spark_partition_id().alias("slice"), F.size("keys").alias("n"), F.explode("keys").alias("key")
    )
    exact = F.broadcast(listed) if shape["n"] <= BROADCAST_ROWS else listed.hint("shuffle_hash")
    found = probes.join(exact, "key", "left")
    best = F.max(F.when(F.col("verdict").isNotNull(), F.struct(F.length("key").alias("long"), "key", "verdict")))
    held = found.groupBy(*group).agg(best.alias("best"), (F.count("*") / F.first("n")).cast("int").alias("copies"))
    held = held.select(
        "page_id",
        "host",
        "path",
        F.col("best.key").alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
        F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"),
    )
    return free.unionByName(held.drop("copy"))
