"""Line dedup: a line goes if an earlier line equals it up to ``MAX_EDITS`` edits.

Lines are compared without white space at their ends; order is document id, then a hash of the text,
then place in the document.  Equal lines meet by hash.  For lines that differ by one edit, the variants with one
character deleted meet by hash: lines of equal length that agree after the same place is deleted,
and a whole line with a longer one that equals it after a deletion.  Each group of
equal variants is reduced to its earliest members, never to pairs, and the edit distance of a line to
the earliest member is verified on the texts.

Two lossless filters keep variants few.  Lines within one edit agree in their first or their
second half, so only lines that share a half with another line go on.  Of these, lines within one edit
agree before and after one of ``BLOCKS`` blocks, so variants are made only
for deletions in blocks whose surroundings another line shares.  A line of ``n`` characters thus
costs four half keys, and ``n / BLOCKS`` variants for each block that may match.

Defined results: blank lines always stay, and lines under ``MIN_CHARS`` characters go only if equal
to an earlier one; a line goes also if the earlier line itself goes; null texts stay null; a text that
loses all lines becomes empty, and its row stays; rows equal in id and text count as the same place,
so they keep the same lines; rows that share an id or have none, but differ in their texts, are places
of their own; a null id comes last; an empty table gives an empty result; all columns are kept, and
helper columns live in tables of their own.

A document is named by 95 bits of a hash of its text besides its id.  In the order of the lines 31 of them
tell texts of one id apart (94 if the id is null): should those agree, lines that both texts
hold at one number stay in both.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from isoquilt.llm.common import quoted, small_side
from isoquilt.session import cut

MAX_EDITS = 1
MIN_CHARS = 8
BLOCKS = 16
SPACES = " \t\n\x0b\f\r"
#: More lines than any document has.
LINES = 1 << 31
# Fixed values of the rolling hash: two primes below 2**31 and their bases.
PRIMES = (2147483647, 2147483629)
BASES = (1103515245, 1664525221)


def _whole(value: Column, digits: int) -> Column:
    return value.cast(f"decimal({digits},0)")


def _begin() -> Column:
    """Place of a document in the order of all lines, a multiple of ``LINES``: its id or else a hash, then a hash."""
    # a null id comes after the largest one
    unnamed = _whole(F.lit(1 << 62), 20) * 2 + _whole(_text_hash().bitwiseAND(F.lit((1 << 63) - 1)), 20)
    tie = F.xxhash64(F.lit(1), "text").bitwiseAND(F.lit(LINES - 1))
    named = F.coalesce(_whole(F.col("doc_id"), 20), _whole(unnamed, 20))
    return _whole((named * _whole(F.lit(LINES), 11) + _whole(tie, 10)) * _whole(F.lit(LINES), 11), 38)


def _text_hash() -> Column:
    return F.xxhash64("text")


def _line(pos: Column) -> Column:
    return F.pmod(pos, _whole(F.lit(LINES), 11))


def _begin_of(pos: Column) -> Column:
    return _whole(pos - _line(pos), 38)


def lines_of(docs: DataFrame) -> DataFrame:
    """(doc, content, h1, h2, pos) of every line that is not blank; ``doc`` is a hash of its whole text."""
    # once a document, before its lines
    placed = docs.select("text", _text_hash().alias("doc"), _begin().alias("begin"))
    each = placed.select("doc", "begin", F.posexplode(F.split("text", "\n", -1)).alias("line", "content"))
    each = each.withColumn("content", F.btrim("content", F.lit(SPACES))).where("content <> ''")
    return each.select(
        "doc", "content",
        F.xxhash64("content").alias("h1"), F.xxhash64(F.lit(1), "content").alias("h2"),
        _whole(F.col("begin") + _whole(F.col("line"), 10), 38).alias("pos"),
    )


def _half_keys() -> Column:
    """Keys that two lines within one edit share at least one of; null for short lines."""
    n, keys = F.length("content"), []
    for shorter in (n, n - 1):
        half = F.floor(shorter / 2).cast("int")
        keys.append(F.when(shorter >= MIN_CHARS, F.xxhash64(F.lit(0), shorter, F.left("content", half))))
        keys.append(F.when(shorter >= MIN_CHARS, F.xxhash64(F.lit(1), shorter, F.right("content", shorter - half))))
    return F.array(*keys)


def distinct_lines(docs: DataFrame) -> DataFrame:
    """(h1, h2, pos, copies, k0..k3): each different line with its earliest place."""
    each = lines_of(docs).select("h1", "h2", "pos", _half_keys().alias("keys"))
    return each.groupBy("h1", "h2").agg(
        F.min("pos").alias("pos"), F.count("*").alias("copies"), *[F.min(F.col("keys")[k]).alias(f"k{k}") for k in range(4)]
    )


def _shared(keyed: DataFrame) -> DataFrame:
    """The rows of ``keyed`` whose key another row has too."""
    several = keyed.groupBy("key").agg(F.count("*").alias("_rows")).where("_rows > 1").drop("_rows")
    return keyed.join(several, "key", "left_semi")


class Rolling:
    """Hashes of the beginnings and ends of one line, modulo two primes."""

    powers = [np.ones(1, dtype=np.int64), np.ones(1, dtype=np.int64)]

    def __init__(self, content: str):
        codes = np.frombuffer(content.encode("utf-32-le"), dtype=np.uint32).astype(np.int64) + 1
        self.n = n = len(codes)
        self.head, self.tail = [], []
        for k, (p, b) in enumerate(zip(PRIMES, BASES)):
            power = self._powers(k, n, p, b)
            self.head.append(np.concatenate(([0], np.cumsum(codes % p * power % p))) % p)
            self.tail.append(np.concatenate(([0], np.cumsum(codes[::-1] % p * power % p))) % p)

    @classmethod
    def _powers(cls, k: int, n: int, p: int, b: int) -> np.ndarray:
        known = cls.powers[k]
        while len(known) < n:
            known = np.concatenate([known, known * pow(b, len(known), p) % p])
        if len(known) <= 1 << 20:
            cls.powers[k] = known
        return known[:n]

    def without(self, places: np.ndarray) -> np.ndarray:
        """Hashes of the line with one place deleted, for each place."""
        parts = []
        for h, p, b in zip(self.head, PRIMES, BASES):
            back = pow(b, -1, p)
            parts.append((h[places] + (h[-1] - h[places + 1]) % p * back) % p)
        return parts[0] << 31 ^ parts[1]

    def whole(self) -> int:
        return int(self.head[0][-1]) << 31 ^ int(self.head[1][-1])

    def around(self, start: int, rest: int) -> tuple[int, int, int, int]:
        """Hashes of the first ``start`` and of the last ``rest`` characters."""
        return (*(int(h[start]) for h in self.head), *(int(t[rest]) for t in self.tail))


def _block(shorter: int, block: int) -> tuple[int, int]:
    return shorter * block // BLOCKS, shorter * (block + 1) // BLOCKS


def _block_keys(survivors: DataFrame) -> DataFrame:
    """(key, h1, h2, slot): what surrounds each block, for lines as the shorter and as the longer of a pair."""

    def run(batches):
        for batch in batches:
            out = ([], [], [], [])
            for h1, h2, content in zip(*[c.to_pylist() for c in batch.columns]):
                rolling = Rolling(content)
                for longer in (0, 1):
                    shorter = rolling.n - longer
                    if shorter < MIN_CHARS:
                        continue
                    for block in range(BLOCKS):
                        start, stop = _block(shorter, block)
                        key = hash((shorter, block, *rolling.around(start, shorter - stop)))
                        for column, value in zip(out, (key, h1, h2, longer * BLOCKS + block)):
                            column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], ["key", "h1", "h2", "slot"])

    return survivors.select("h1", "h2", "content").mapInArrow(run, "key long, h1 long, h2 long, slot long")


def _variants(survivors: DataFrame) -> DataFrame:
    """(key, at, whole, h1, h2, pos) of lines with the slots in which they may have a partner.

    ``at`` is the deleted place where both lines lose one, and -1 where a line meets a longer one:
    there ``whole`` tells the shorter from the longer.
    """

    def run(batches):
        for batch in batches:
            columns = dict(zip(batch.schema.names, batch.columns))
            texts, slots = columns["content"].to_pylist(), columns["slots"].to_pylist()
            for row, (content, mine) in enumerate(zip(texts, slots)):
                rolling = Rolling(content)
                keys, places, wholes = [], [], []
                for slot in sorted(set(mine)):
                    start, stop = _block(rolling.n - slot // BLOCKS, slot % BLOCKS)
                    if slot < BLOCKS:
                        at = np.arange(start, stop)
                        keys.append(rolling.without(at))
                        places.append(at)
                    else:
                        keys.append(np.unique(rolling.without(np.arange(start, stop + 1))))
                        places.append(np.full(len(keys[-1]), -1))
                    wholes.append(np.zeros(len(keys[-1]), dtype=bool))
                if min(mine) < BLOCKS:
                    keys.append(np.array([rolling.whole()]))
                    places.append(np.array([-1]))
                    wholes.append(np.array([True]))
                key = np.concatenate(keys)
                same = pa.array(np.full(len(key), row, dtype=np.int64))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key), pa.array(np.concatenate(places)), pa.array(np.concatenate(wholes))]
                    + [columns[c].take(same) for c in ("h1", "h2", "pos")],
                    ["key", "at", "whole", "h1", "h2", "pos"],
                )

    kind = survivors.schema["pos"].dataType.simpleString()
    asked = survivors.select("h1", "h2", "pos", "content", "slots")
    return asked.mapInArrow(run, f"key long, at long, whole boolean, h1 long, h2 long, pos {kind}")


def near_lines(docs: DataFrame, different: DataFrame) -> DataFrame:
    """(h1, h2, kept): the different lines that have an earlier line within one edit, and its place."""
    keys = F.array(*[F.struct(F.col(f"k{k}").alias("key")) for k in range(4)])
    halves = different.select("h1", "h2", "pos", F.inline(keys)).where("key is not null")
    named = cut(_shared(halves).select("h1", "h2", "pos").distinct())
    rows = named.count()
    # the text of a line is taken at its earliest place
    ids = named.select(_begin_of(F.col("pos")).alias("begin")).distinct()
    wanted = docs.withColumn("begin", _begin())
    wanted = wanted.join(small_side(ids, rows), wanted["begin"] == ids["begin"], "left_semi")
    found = lines_of(wanted).select("h1", "h2", "pos", "content")
    survivors = cut(found.join(small_side(named, rows), ["h1", "h2", "pos"], "left_semi").dropDuplicates(["h1", "h2"]))
    slots = _shared(_block_keys(survivors)).groupBy("h1", "h2").agg(F.collect_list("slot").alias("slots"))
    made = _variants(survivors.join(slots, ["h1", "h2"]))
    group = W.partitionBy("key", "at")
    first_whole, first_cut = F.min(F.when(F.col("whole"), F.col("pos"))).over(group), F.min(F.when(~F.col("whole"), F.col("pos"))).over(group)
    partner = F.when((F.col("at") >= 0) | F.col("whole"), first_cut).otherwise(first_whole)
    pairs = made.withColumn("kept", partner).where("kept < pos").select("h1", "h2", "kept").distinct()
    earlier = survivors.select(F.col("pos").alias("kept"), F.col("content").alias("earlier"))
    checked = pairs.join(survivors.select("h1", "h2", "content"), ["h1", "h2"]).join(earlier, "kept")
    near = F.levenshtein("content", "earlier", MAX_EDITS).between(0, MAX_EDITS)
    return checked.where(near).groupBy("h1", "h2").agg(F.min("kept").alias("kept"))


def dropped_lines(docs: DataFrame) -> DataFrame:
    """(begin, doc, lines): numbers of the lines that go, for each id and text that loses some."""
    source = docs.select("doc_id", "text")
    different = cut(distinct_lines(source))
    near = near_lines(source, different).select("h1", "h2", F.lit(True).alias("near"))
    several = different.select("h1", "h2", "pos", "copies").join(near, ["h1", "h2"], "left")
    several = several.where("copies > 1 or near")
    # a line that goes altogether has no place that stays
    # kept, so that both sides of the join are plain exchanges and a very common line can be split
    several = cut(several.select("h1", "h2", F.when(F.col("near").isNull(), F.col("pos")).alias("stays")))
    each = lines_of(source).select("doc", "h1", "h2", "pos")
    gone = each.join(several, ["h1", "h2"]).where("stays is null or pos <> stays")
    gone = gone.select(_begin_of(F.col("pos")).alias("begin"), "doc", _line(F.col("pos")).cast("int").alias("line"))
    return gone.groupBy("begin", "doc").agg(F.collect_set("line").alias("lines"))


def _applied(docs: DataFrame) -> DataFrame:
    """(row, text, gone): each row of ``docs`` as one value, what is left of its text, how many lines went."""
    # what goes grows with the table, so texts and line numbers meet by a shuffle at every size
    gone = dropped_lines(docs)
    rows = docs.select(F.struct(*map(quoted, docs.columns)).alias("row"), _begin().alias("begin"), _text_hash().alias("doc"))
    both = rows.join(gone, ["begin", "doc"], "left")
    lines = F.split("row.text", "\n", -1)
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("lines"))
    text = F.array_join(F.transform(kept, lambda i: F.get(lines, i)), "\n")
    whole = F.col("lines").isNull() | F.col("row.text").isNull()
    return both.select(
        "row", F.when(whole, F.col("row.text")).otherwise(text).alias("text"),
        F.coalesce(F.size("lines"), F.lit(0)).cast("long").alias("gone"),
    )


def deduplicated(docs: DataFrame) -> DataFrame:
    """``docs`` with the texts that are left, and ``n_chars`` of them where there is such a column."""
    changed = {"text": F.col("text"), "n_chars": F.length("text").cast("long")}
    return _applied(docs).select(*[changed.get(c, F.col(f"row.{quoted(c)}")).alias(c) for c in docs.columns])


def report(docs: DataFrame) -> DataFrame:
    """(doc_id, text, lines_gone) for every document."""
    return _applied(docs).select(F.col("row.doc_id").alias("doc_id"), "text", F.col("gone").alias("lines_gone"))
