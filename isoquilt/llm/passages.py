"""Repeated passages removed by a compacted de Bruijn graph of word windows.

An edge is a window of ``WINDOW`` words, between the nodes that are its first and its last ``WINDOW - 1`` words.
Windows are dealt to bins by their minimizer, the ``GRAM`` words of least hash in them, first of equals: equal
windows fall into one bin, and the consecutive windows of one minimizer, a stretch, are a path of edges.  A
bin that has one stretch only is unique and goes.  Of the rest

* stretches of the same words are compacted to one path, which keeps its first source coordinate: wherever the path
  shows again, all its edges are repeated;
* a bin with several paths is where the graph branches: the first stretch of each path is taken apart into edges,
  read again at its source coordinate, and every edge is joined with the first coordinate of its like in other paths.

Every stretch and edge that has an earlier coordinate is a repeated span; the spans of a document, glued
where they touch, are what goes.  A path or an edge is known by 64 bits within a bin named by 64 other bits.

Windows are judged on the input; coordinates are ordered by doc_id (null last), start, then a hash of the text.

Defined results: rows equal in doc_id and text are one document, each is returned; rows that share an id but not the text
are told apart by the hash of the text; a null text has no words; texts of less than ``WINDOW`` words lose nothing; an empty table gives
an empty result; only doc_id and text are read, so other columns cannot clash.  A long text is worked through in blocks
that overlap by a window.
"""

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from isoquilt.llm.common import release
from isoquilt.session import cut

WINDOW = 20
GRAM = 6
#: Words that are hashed at once, and bytes of one text that are split at once.
BLOCK_WORDS = 1 << 20
BLOCK_BYTES = 8 << 20

# White space between words, and odd factors of the hashes.
_SPACE = re.compile(rb"[\x20\x09-\x0D]")
_FACTORS = np.random.default_rng(13).integers(0, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = int(_FACTORS[-1])
#: Numbers of words and rows side by side in one number.
_ROOM = 1 << 40
#: Bits for the places of one block.
_PLACES = np.uint64((1 << 26) - 1)


def _mixed(x: np.ndarray) -> np.ndarray:
    """The bits of sums spread over the whole number."""
    x = (x ^ (x >> np.uint64(31))) * _FACTORS[-2]
    return x ^ (x >> np.uint64(29))


def word_hashes(words: list) -> np.ndarray:
    """64-bit hashes of words; each different one is hashed once."""
    coded = pa.array(words, pa.binary()).dictionary_encode()
    named = [xxhash.xxh64_intdigest(w, 13) for w in coded.dictionary.to_pylist()]
    return np.array(named, dtype=np.uint64)[coded.indices.to_numpy()]


def run_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of every ``size`` consecutive words."""
    n = max(0, len(words) - size + 1)
    out = np.zeros(n, dtype=np.uint64)
    for k in range(size):
        out += words[k : k + n] * _FACTORS[k]
    return _mixed(out)


def span_hashes(words: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Hash of spans of any size: differences of a running sum of powers, moved to one place."""
    up, down = (np.full(len(words) + 1, x, dtype=np.uint64) for x in (_BASE, pow(_BASE, -1, 1 << 64)))
    up[0] = down[0] = 1
    up, down = np.multiply.accumulate(up), np.multiply.accumulate(down)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_mixed(words) * up[:-1], dtype=np.uint64)))
    return _mixed((sums[begin + size] - sums[begin]) * down[begin] + size.astype(np.uint64))


class Block:
    """Words of a batch of texts, or of a part of a long one, as hashes."""

    def __init__(self, held: list):
        """``held`` has (row, number of the first word in its text, words)."""
        self.row = np.array([r for r, _, _ in held], dtype=np.int64)
        self.first = np.array([f for _, f, _ in held], dtype=np.int64)
        size = np.array([len(w) for _, _, w in held], dtype=np.int64)
        self.ends = np.cumsum(size)
        self.begins = self.ends - size
        self.words = word_hashes([w for _, _, words in held for w in words])

    def windows(self, window: int) -> np.ndarray:
        """Places of the windows that lie in one text."""
        last = np.repeat(self.ends, self.ends - self.begins) - window
        return np.flatnonzero(np.arange(len(self.words)) <= last)

    def stretches(self, window: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place, number of windows, minimizer) of runs of windows with one minimizer."""
        grams, at = run_hashes(self.words, gram), self.windows(window)
        # upper bits of the hash, then the place: of equal ones the first is the least
        least = (grams & ~_PLACES) | np.arange(len(grams), dtype=np.uint64)
        held, wide = 1, window - gram + 1
        while held < wide:
            step = min(held, wide - held)
            least, held = np.minimum(least[: max(0, len(least) - step)], least[step:]), held + step
        where = (least[at] & _PLACES).astype(np.int64)
        # windows of different texts never follow each other
        new = np.flatnonzero(np.concatenate((np.ones(min(1, len(at)), bool), (where[1:] != where[:-1]) | (at[1:] != at[:-1] + 1))))
        return at[new], np.diff(np.append(new, len(at))), grams[where[new]]

    def source(self, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, number of the word in its text) of places."""
        part = np.searchsorted(self.ends, place, side="right")
        return self.row[part], self.first[part] + place - self.begins[part]


def blocks(texts: list, window: int, most_words: int, most_bytes: int) -> Iterator[Block]:
    held, size = [], 0
    for row, text in enumerate(texts):
        data, begin, number, tail = (text or "").encode(), 0, 0, []
        while begin < len(data):
            end = len(data)
            if end - begin > most_bytes and (space := _SPACE.search(data, begin + most_bytes)):
                end = space.start()
            words = tail + data[begin:end].split()
            held.append((row, number, words))
            size += len(words)
            # the windows over the border begin with the last words of this part
            tail = words[len(words) - min(len(words), window - 1) :]
            number += len(words) - len(tail)
            begin = end
            if size >= most_words:
                yield Block(held)
                held, size = [], 0
    if held:
        yield Block(held)


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _stretches(docs: DataFrame, window: int, gram: int, whole: bool, most: tuple) -> DataFrame:
    """(m) of each stretch; if ``whole`` (doc_id, th, s, c, m, h): its source, windows, minimizer and the hash of its words."""

    def run(batches):
        for batch in batches:
            for block in blocks(batch.column("text").to_pylist(), window, *most):
                place, many, least = block.stretches(window, gram)
                if not whole:
                    yield pa.RecordBatch.from_arrays([_signed(least)], ["m"])
                    continue
                row, start = block.source(place)
                at = pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").take(at), batch.column("th").take(at), pa.array(start), pa.array(many.astype(np.int32)),
                        _signed(least), _signed(span_hashes(block.words, place, many + window - 1)),
                    ],
                    ["doc_id", "th", "s", "c", "m", "h"],
                )

    if whole:
        return docs.mapInArrow(run, "doc_id long, th long, s long, c int, m long, h long")
    return docs.select("text").mapInArrow(run, "m long")


def _edges(docs: DataFrame, asked: DataFrame, window: int, most: tuple) -> DataFrame:
    """(doc_id, th, s, m, ws): the stretches ``asked``, each with the hashes of its windows."""

    def run(batches):
        for batch in batches:
            listed = batch.column("spans")
            of = np.repeat(np.arange(len(listed)), pc.list_value_length(listed).to_numpy(zero_copy_only=False).astype(np.int64))
            flat = listed.flatten()
            s, c, m = (flat.field(k).to_numpy(zero_copy_only=False) for k in range(3))
            order = np.lexsort((s, of))
            of, s, c, m = of[order], s[order], c[order].astype(np.int64), m[order]
            for block in blocks(batch.column("text").to_pylist(), window, *most):
                place = block.windows(window)
                row, start = block.source(place)
                # the last stretch of its row that starts at a window or before
                k = np.searchsorted(of * _ROOM + s, row * _ROOM + start, side="right") - 1
                inside = (k >= 0) & (of[k] == row) & (start < s[k] + c[k])
                row, start, k = row[inside], start[inside], k[inside]
                named = run_hashes(block.words, window)[place[inside]]
                new = np.flatnonzero(np.concatenate((np.ones(min(1, len(k)), bool), k[1:] != k[:-1])))
                lists = pa.ListArray.from_arrays(pa.array(np.append(new, len(k)).astype(np.int32)), _signed(named))
                at = pa.array(row[new])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(at), batch.column("th").take(at), pa.array(start[new]), pa.array(m[k[new]]), lists],
                    ["doc_id", "th", "s", "m", "ws"],
                )

    listed = asked.groupBy("doc_id", "th").agg(F.collect_list(F.struct("s", "c", "m")).alias("spans"))
    rows = _with_lists(docs, listed, "inner").select("doc_id", "th", "text", "spans")
    return rows.mapInArrow(run, "doc_id long, th long, s long, m long, ws array<long>")


def _with_lists(docs: DataFrame, listed: DataFrame, how: str) -> DataFrame:
    there = listed.withColumnsRenamed({"doc_id": "_d", "th": "_t"})
    return docs.join(there, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("th") == F.col("_t")), how)


def _coordinate() -> Column:
    return F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "s", "th")


def _named(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("th"), "text")


def repeated_spans(
    docs: DataFrame, window: int = WINDOW, gram: int = GRAM, block_words: int = BLOCK_WORDS, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """(doc_id, th, s, c): runs of ``c`` windows from word ``s`` on, each of which also starts earlier.

    ``th`` tells rows of one id apart: xxhash64 of the text.
    """
    rows, most, spark = _named(docs), (block_words, block_bytes), docs.sparkSession
    bins = cut(_stretches(rows, window, gram, False, most).groupBy("m").count().where("count > 1").select("m"))
    shared = cut(_stretches(rows, window, gram, True, most).join(bins, "m", "left_semi"))
    release(spark)
    at = _coordinate()
    paths = cut(shared.groupBy("m", "h").agg(F.min(at).alias("first"), F.first("c").alias("c")))
    again = shared.join(paths.select("m", "h", "first"), ["m", "h"]).where(at > F.col("first")).select("doc_id", "th", "s", "c")
    again = cut(again)
    del shared
    release(spark)
    branching = paths.groupBy("m").count().where("count > 1").select("m")
    heads = paths.join(branching, "m", "left_semi").select("first.doc_id", "first.th", "first.s", "c", "m")
    lists = cut(_edges(rows, heads, window, most))
    release(spark)
    edges = lists.select("doc_id", "th", "m", F.posexplode("ws").alias("k", "w"), F.col("s").alias("begin"))
    edges = edges.select("doc_id", "th", (F.col("begin") + F.col("k")).alias("s"), "m", "w")
    firsts = edges.groupBy("m", "w").agg(F.min(at).alias("first"), F.count("*").alias("n")).where("n > 1").select("m", "w", "first")
    single = edges.join(firsts, ["m", "w"]).where(at > F.col("first")).select("doc_id", "th", "s", F.lit(1).alias("c"))
    return again.unionByName(single)


def without_repeats(docs: DataFrame, window: int = WINDOW, **options) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256): each text without the words that repeated windows cover."""
    spans = repeated_spans(docs, window, **options).groupBy("doc_id", "th").agg(F.collect_set(F.struct("s", "c")).alias("spans"))
    spans = cut(spans)
    release(docs.sparkSession)

    def run(batches):
        for batch in batches:
            total, gone, digests = [], [], []
            for text, spans in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist()):
                words = (text or "").encode().split()
                kept, at = [], 0
                for s, e in sorted((x["s"], x["s"] + x["c"] + window - 1) for x in spans or []):
                    kept += words[at:s]
                    at = max(at, e)
                kept += words[at:]
                total.append(len(words))
                gone.append(len(words) - len(kept))
                digests.append(hashlib.sha256(b" ".join(kept)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(total, pa.int64()), pa.array(gone, pa.int64()), pa.array(digests, pa.string())],
                ["doc_id", "n_words", "n_removed", "kept_sha256"],
            )

    rows = _with_lists(_named(docs), spans, "left").select("doc_id", "text", "spans")
    return rows.mapInArrow(run, "doc_id long, n_words long, n_removed long, kept_sha256 string")
