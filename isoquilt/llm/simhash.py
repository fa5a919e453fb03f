"""SimHash near-duplicates found by covering locality-sensitive hashing.

Fingerprints of 64 bits are compared under ``2**(radius + 1) - 1`` bit masks.  Every bit
position gets a non-zero vector of ``radius + 1`` bits; mask ``v`` keeps the positions whose
vector has an odd inner product with ``v``.  For any ``radius`` positions there is a ``v``
orthogonal to all their vectors, so two fingerprints that differ in at most ``radius`` bits
agree under that mask: no pair within the radius is ever missed.

A bucket that holds more than ``DENSE`` different fingerprints is divided by applying the same
construction to the bits its mask leaves free.  After that at most about a quarter of the bits is free,
so a bucket is bounded by the bit count and not by the data.

Defined results: null and empty texts have fingerprint zero and link like any other; equal
texts and repeated rows share a fingerprint, each row is returned; a null ``doc_id`` is never
a component's name unless the component has no other; an empty table gives an empty result;
only the id and text columns are read, so other columns cannot clash.
"""

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isoquilt.operators.graph import connected_components
from isoquilt.session import cut

BITS = 64
#: Fingerprints of one bucket that are compared inside one task.
DENSE = 4096
_BIT = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)


def shingle_hashes(text: str | None, shingle: int) -> list[int]:
    """Unsigned 64-bit hashes of the shingles of one text, in their order."""
    words = (text or "").encode().lower().split()
    if not words:
        return []
    flat = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    if len(words) > shingle:
        starts, ends = starts[: 1 - shingle], ends[shingle - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    digest = xxhash.xxh64_intdigest
    return [digest(flat[s:e], 42) for s, e in zip(starts.tolist(), ends.tolist())]


def simhash(text: str | None, shingle: int) -> int:
    """Unsigned 64-bit fingerprint of one text."""
    return fingerprint(shingle_hashes(text, shingle))


def fingerprint(hashes: list[int]) -> int:
    """Unsigned 64-bit fingerprint of the hashes of one text's shingles."""
    if not hashes:
        return 0
    octets = np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8)
    seen = np.bincount((octets + 256 * np.arange(8)).ravel(), minlength=2048).reshape(8, 256)
    ones = (seen @ _BIT).ravel()
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """(doc_id, fp): the fingerprint as a signed long, one row per input row."""

    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        made = np.fromiter((simhash(t, shingle) for t in texts), dtype=np.uint64, count=len(texts))
        return pd.Series(made.view(np.int64))

    return docs.select(F.col(id_col).alias("doc_id"), of(F.col(text_col)).alias("fp"))


def covering_masks(positions: list[int], radius: int) -> list[int]:
    """The masks of one covering family over ``positions``, as signed longs."""
    kinds = (1 << (radius + 1)) - 1
    masks = []
    for v in range(1, kinds + 1):
        mask = sum(1 << p for k, p in enumerate(positions) if ((1 + k % kinds) & v).bit_count() % 2)
        masks.append(mask - (1 << BITS) if mask >> (BITS - 1) else mask)
    return masks


def _free(mask: int) -> list[int]:
    return [p for p in range(BITS) if not (mask >> p) & 1]


def _chains(values: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """(value, seed) links that join the values within ``radius`` of each other, a tree for each set."""
    links = []
    rest = values
    while len(rest) > 1:
        seed, rest, queue = int(rest[0]), rest[1:], [rest[0]]
        while queue and len(rest):
            near = np.bitwise_count(rest ^ queue.pop()) <= radius
            if near.any():
                found = rest[near]
                links += [(int(x), seed) for x in found]
                queue += list(found)
                rest = rest[~near]
    return links


def _bucket_links(bucketed: DataFrame, radius: int) -> DataFrame:
    """Links (a, b) between fingerprints of one bucket; the input has (bucket columns, fp)."""
    keys = [c for c in bucketed.columns if c != "fp"]

    def walk(frames):
        held = None
        for frame in frames:
            frame = frame if held is None else pd.concat([held, frame], ignore_index=True)
            key = frame[keys].to_numpy()
            change = np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1
            last = change[-1] if len(change) else 0
            # the last bucket may go on in the next batch
            held = frame.iloc[last:]
            yield _links_of(frame["fp"].to_numpy()[:last].view(np.uint64), np.concatenate(([0], change)), radius)
        if held is not None:
            yield _links_of(held["fp"].to_numpy().view(np.uint64), np.array([0, len(held)]), radius)

    dealt = bucketed.repartition(*keys).sortWithinPartitions(*keys)
    return dealt.mapInPandas(walk, "a long, b long")


def _links_of(values: np.ndarray, edges: np.ndarray, radius: int) -> pd.DataFrame:
    links = []
    for s, e in zip(edges[:-1].tolist(), edges[1:].tolist()):
        if e - s > 1:
            links += _chains(values[s:e], radius)
    made = np.array(links, dtype=np.uint64).reshape(-1, 2).view(np.int64)
    return pd.DataFrame({"a": made[:, 0], "b": made[:, 1]})


def near_links(prints: DataFrame, radius: int = 3, dense: int = DENSE) -> DataFrame:
    """Links that join every two of the distinct ``fp`` values within ``radius`` bits of each other.

    Not every pair is listed: a set of close values comes as a tree, which is all
    that its component needs.
    """
    first = covering_masks(list(range(BITS)), radius)
    tables = [F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(m)).alias("h")) for t, m in enumerate(first)]
    members = prints.select("fp", F.inline(F.array(*tables)))
    sizes = members.groupBy("t", "h").agg(F.count("*").alias("n")).where("n > 1")
    shared = cut(members.join(sizes, ["t", "h"]))
    plain = shared.where(F.col("n") <= dense).select("t", "h", F.lit(0).alias("u"), F.lit(0).cast("long").alias("g"), "fp")
    families = F.array(*[F.array(*[F.lit(m) for m in covering_masks(_free(mask), radius)]) for mask in first])
    divided = shared.where(F.col("n") > dense).select("t", "h", "fp", F.posexplode(families[F.col("t")]).alias("u", "m"))
    divided = divided.select("t", "h", (F.col("u") + 1).alias("u"), F.col("fp").bitwiseAND(F.col("m")).alias("g"), "fp")
    return _bucket_links(plain.unionByName(divided), radius)


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 3,
    radius: int = 3,
    dense: int = DENSE,
) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row of ``docs``.

    ``component_id`` is the smallest id reachable over links of at most ``radius``
    differing bits, a row's own id included.
    """
    rows = cut(fingerprints(docs, id_col, text_col, shingle))
    prints = rows.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    links = near_links(prints.select("fp"), radius, dense)
    joined = connected_components(links, []).select(F.col("id").alias("fp"), "component")
    named = prints.join(joined, "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    smallest = named.groupBy("component").agg(F.min("first_id").alias("component_id"))
    class_of = named.select("fp", "component").join(smallest, "component").select("fp", "component_id")
    return rows.join(class_of, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def one_of_each(docs: DataFrame) -> DataFrame:
    """One row of each group of near copies, by fingerprints of five-word shingles and the pipeline's own measure."""
    from isoquilt.llm import near_copies

    return near_copies.one_of_each(docs)
