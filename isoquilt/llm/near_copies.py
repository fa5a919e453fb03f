"""One document of each group of near copies: shingles of five words, Jaccard similarity of 0.8.

Each different set of shingles has the SimHash fingerprint of one of its texts; fingerprints within ``RADIUS`` bits are found by
covering masks (``simhash.near_links``), none is missed, and sets linked by them are candidates.  Sets at the similarity lie
beyond that radius as a rule (two independent bits differ with probability 0.15 at 0.8, 10 of 64), so they get keys as well:
``BANDS`` for each set, each made of ``ROWS`` minima under seeded hashes; sets that share a key are candidates.  A pair at similarity ``s`` is a candidate with probability
``1 - (1 - s**ROWS)**BANDS``, 0.9999 at 0.8.  The similarity of a candidate pair is computed on the whole sets.

The pairs of a bucket are never formed as such.  First every member is compared with the smallest, and sets that fingerprints
link with each other.  Then, where a bucket
still holds several components, the members outside its largest one are compared with ``PIVOTS`` members of that
one, and what is left outside with all members of other components.  A pair is dropped before its sets are read
if its sizes, or the bits of the two sets, rule out the similarity: every shingle flips one of ``BITS`` bits, so sets
differ in at least as many shingles as bits, and sets at Jaccard ``s`` differ in at most ``(n + m) * (1 - s) / (1 + s)``.
No pair at or above the similarity that shares a key is left out unless its sets are in one component already.

Defined results: groups are components over the links; of a group the row stays that is first by
doc_id (null last), then by hashes of its text and of all its columns; of rows equal in all columns
one stays; texts without words are copies of each other; a text of up to five words is one
shingle; an empty table gives an empty result; sets are named by 64-bit hashes.
"""

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from isoquilt.llm.common import quoted, release, small_side
from isoquilt.llm.simhash import fingerprint, near_links, shingle_hashes
from isoquilt.operators.graph import connected_components
from isoquilt.session import cut

SHINGLE = 5
LEAST = 0.8
#: Bits in which fingerprints that link their sets may differ.
RADIUS = 3
BANDS = 24
ROWS = 5
#: Shingles that meet the seeded hashes at once.
CHUNK = 4096
#: Members of a bucket's largest component that all others are compared with first.
PIVOTS = 8
#: Bits that the shingles of a set flip, as longs.
BITS, LONGS = 512, 8
# The seeded hashes, odd factors and masks.
_SEEDS = np.random.default_rng(5).integers(0, 1 << 63, (2, BANDS * ROWS), dtype=np.uint64)
_FACTORS, _FLIPS = _SEEDS[0] * np.uint64(2) + np.uint64(1), _SEEDS[1]


def shingle_set(text: str | None, shingle: int = SHINGLE) -> np.ndarray:
    """The different shingles of one text as sorted unsigned hashes."""
    return np.unique(np.array(shingle_hashes(text, shingle), dtype=np.uint64))


def band_keys(shingles: np.ndarray) -> np.ndarray:
    """The keys of one set as signed longs; none if it is empty."""
    if not len(shingles):
        return np.empty(0, dtype=np.int64)
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(shingles), CHUNK):
        mixed = (shingles[at : at + CHUNK, None] ^ _FLIPS) * _FACTORS
        np.minimum(least, mixed.min(axis=0), out=least)
    rows = least.reshape(BANDS, ROWS)
    return np.array([xxhash.xxh64_intdigest(r.tobytes(), k) for k, r in enumerate(rows)], dtype=np.uint64).view(np.int64)


def parity_bits(shingles: np.ndarray) -> np.ndarray:
    """``BITS`` bits, each flipped by every shingle that falls to it, as signed longs."""
    flips = np.bincount((shingles >> np.uint64(20)).astype(np.int64) % BITS, minlength=BITS) % 2
    return np.packbits(flips.astype(np.uint8)).view(np.int64)


def _sketches(named: DataFrame, shingle: int) -> DataFrame:
    """(doc_id, th, rh, s, n, fp, keys, bits) of each row: its names, its fingerprint, and the name, size, keys and bits of its set."""

    @F.pandas_udf("s long, n int, fp long, keys array<long>, bits array<long>")
    def of(texts: pd.Series) -> pd.DataFrame:
        hashes = [shingle_hashes(t, shingle) for t in texts]
        prints = np.array([fingerprint(h) for h in hashes], dtype=np.uint64).view(np.int64)
        sets = [np.unique(np.array(h, dtype=np.uint64)) for h in hashes]
        names = np.array([xxhash.xxh64_intdigest(x.tobytes(), 7) for x in sets], dtype=np.uint64).view(np.int64)
        sketch = {"s": names, "n": [len(x) for x in sets], "fp": prints}
        return pd.DataFrame(sketch | {"keys": [band_keys(x) for x in sets], "bits": [parity_bits(x) for x in sets]})

    made = named.select("row.doc_id", "th", "rh", of(F.col("row.text")).alias("made"))
    return cut(made.select("doc_id", "th", "rh", "made.*"))


def _named(docs: DataFrame) -> DataFrame:
    """(row, th, rh): each row as one value, a hash of its text and one of all its columns."""
    columns = [quoted(c) for c in docs.columns]
    return docs.select(F.struct(*columns).alias("row"), F.xxhash64("text").alias("th"), F.xxhash64(F.lit(3), *columns).alias("rh"))


def _verified(pairs: DataFrame, reps: DataFrame, named: DataFrame, shingle: int, least: float) -> DataFrame:
    """The pairs (a, b) of sets whose similarity is ``least`` or more."""

    @F.pandas_udf("array<long>")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([shingle_set(t, shingle).view(np.int64) for t in texts])

    asked = cut(pairs.select(F.explode(F.array("a", "b")).alias("s")).distinct().join(reps.select("s", "th", "rh"), "s"))
    texts = named.join(small_side(asked, asked.count()), ["th", "rh"]).select("s", F.col("row.text").alias("text")).dropDuplicates(["s"])
    sets = cut(texts.select("s", of("text").alias("set")))
    both = pairs.join(sets.select(F.col("s").alias("b"), F.col("set").alias("of_b")), "b")
    both = both.join(sets.select(F.col("s").alias("a"), F.col("set").alias("of_a")), "a")
    common = F.size(F.array_intersect("of_a", "of_b"))
    alike = common >= F.lit(least) * (F.size("of_a") + F.size("of_b") - common)
    found = cut(both.where(alike).select("a", "b"))
    release(pairs.sparkSession)
    return found


def _may_be_alike(x: str, y: str, least: float) -> Column:
    """Whether two sets, structs (n, bits), can have the similarity; only pairs that cannot are ruled out."""
    n, m = F.col(f"{x}.n"), F.col(f"{y}.n")
    flipped = sum(F.bit_count(F.col(f"{x}.bits")[k].bitwiseXOR(F.col(f"{y}.bits")[k])) for k in range(LONGS))
    return (F.least(n, m) >= F.lit(least) * F.greatest(n, m)) & (flipped <= (n + m) * F.lit((1 - least) / (1 + least) + 1e-9))


def print_pairs(reps: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Pairs (x, y), x the smaller, that join all sets whose fingerprints are linked: sets (s, fp) of one print with its
    smallest, and the smallest sets of prints within ``radius`` bits."""
    prints = cut(reps.groupBy("fp").agg(F.min("s").alias("first"), F.count("*").alias("many")))
    same = reps.join(prints.where("many > 1"), "fp").where("s <> first").select(F.col("first").alias("x"), F.col("s").alias("y"))
    near = near_links(prints.select("fp"), radius)
    for side in ("a", "b"):
        near = near.join(prints.select(F.col("fp").alias(side), F.col("first").alias("of_" + side)), side)
    near = near.select(F.least("of_a", "of_b").alias("x"), F.greatest("of_a", "of_b").alias("y"))
    return same.unionByName(near).distinct()


def _components(links: DataFrame) -> DataFrame:
    return cut(connected_components(links, []).select(F.col("id").alias("s"), "component"))


def _open(members: DataFrame, joined: DataFrame, reps: DataFrame) -> DataFrame:
    """Members (band, key, a, component, main) of the buckets that hold several components; main: of the largest one."""
    named = members.join(joined, "s", "left").select("band", "key", "s", F.coalesce("component", "s").alias("component"))
    sizes = named.groupBy("band", "key", "component").agg(F.count("*").alias("many"))
    top = sizes.groupBy("band", "key").agg(F.count("*").alias("parts"), F.max(F.struct("many", "component")).alias("top"))
    several = named.join(top.where("parts > 1"), ["band", "key"])
    several = several.select("band", "key", "s", "component", (F.col("component") == F.col("top.component")).alias("main"))
    sets = reps.select("s", F.struct("s", "n", "bits").alias("a"))
    return cut(several.join(sets, "s").select("band", "key", "a", "component", "main"))


def _met(outside: DataFrame, others: DataFrame, least: float) -> DataFrame:
    """Pairs (a, b) of sets in different components of a bucket that may be alike."""
    b = others.select("band", "key", F.col("a").alias("b"), F.col("component").alias("theirs"))
    may = (F.col("component") != F.col("theirs")) & _may_be_alike("a", "b", least)
    met = outside.join(b, ["band", "key"]).where(may)
    return met.select(F.least("a.s", "b.s").alias("a"), F.greatest("a.s", "b.s").alias("b")).distinct()


def groups(docs: DataFrame, shingle: int = SHINGLE, least: float = LEAST, pivots: int = PIVOTS) -> DataFrame:
    """(doc_id, th, rh, component) for every row of ``docs``."""
    named = _named(docs)
    rows = _sketches(named, shingle)
    # rows of one set are alike; the texts are read again at one of them
    reps = rows.groupBy("s").agg(
        F.min(F.struct("th", "rh")).alias("at"), F.min("n").alias("n"), F.min("fp").alias("fp"), F.first("keys").alias("keys"), F.first("bits").alias("bits")
    )
    reps = cut(reps.select("s", "at.th", "at.rh", "n", "fp", "keys", "bits"))
    keyed = reps.select("s", "n", F.posexplode("keys").alias("band", "key"))
    first = keyed.groupBy("band", "key").agg(F.min(F.struct("s", "n")).alias("first"), F.count("*").alias("many")).where("many > 1")
    members = cut(keyed.join(first, ["band", "key"]).select("band", "key", "s", "n", "first"))
    release(docs.sparkSession)

    sized = F.least("n", "first.n") >= F.lit(least) * F.greatest("n", "first.n")
    star = members.where((F.col("s") != F.col("first.s")) & sized).select(F.col("first.s").alias("x"), F.col("s").alias("y"))
    star = star.unionByName(print_pairs(reps.select("s", "fp"))).distinct()
    for side, name in (("x", "a"), ("y", "b")):
        star = star.join(reps.select(F.col("s").alias(side), F.struct("s", "n", "bits").alias(name)), side)
    done = cut(star.where(_may_be_alike("a", "b", least)).select(F.col("x").alias("a"), F.col("y").alias("b")))
    links = _verified(done, reps, named, shingle, least)

    open_ = _open(members.select("band", "key", "s"), _components(links), reps)
    del members
    release(docs.sparkSession)
    if not open_.isEmpty():
        # drawn by hash, so that every band has other ones
        draw = F.xxhash64("a.s", "band")
        drawn = open_.where("main").groupBy("band", "key", F.pmod(draw, F.lit(pivots)).alias("nth")).agg(F.min(F.struct(draw, "a", "component")).alias("p"))
        pairs = _met(open_.where("NOT main"), drawn.select("band", "key", "p.a", "p.component"), least)
        pairs = cut(pairs.join(done, ["a", "b"], "left_anti"))
        links, done = links.unionByName(_verified(pairs, reps, named, shingle, least)), done.unionByName(pairs)
        open_ = _open(open_.select("band", "key", "a.s"), _components(links), reps)
        rest = cut(_met(open_.where("NOT main"), open_, least).join(done, ["a", "b"], "left_anti"))
        links = links.unionByName(_verified(rest, reps, named, shingle, least))

    return rows.join(_components(links), "s", "left").select("doc_id", "th", "rh", F.coalesce("component", "s").alias("component"))


def one_of_each(docs: DataFrame, shingle: int = SHINGLE, least: float = LEAST) -> DataFrame:
    """The first row of each group of ``docs``, with all columns."""
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "th", "rh")
    stays = groups(docs, shingle, least).groupBy("component").agg(F.min(order).alias("first")).select("first.th", "first.rh")
    return _named(docs).join(stays, ["th", "rh"], "left_semi").dropDuplicates(["th", "rh"]).select("row.*")
