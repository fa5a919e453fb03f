"""Collocations of each language by best-first branch and bound over prefix counts.

Words and pairs are counted once over the whole corpus; counts below ``least`` end a branch, as no longer phrase
can be more frequent.  A pair ``p`` with count ``f(p)`` and first word ``w`` bounds every triple that it begins: the cut
after the first word gives ``a*a / (f(w)*r)`` with ``a <= f(p)`` and ``r >= a``, so no score is above
``f(p) / f(w)``, nor any count above ``f(p)``.  The pairs are therefore extended in the order of (bound, count); a pair
that may itself be among the best is also extended to both sides, as a longer phrase around it may
drop it.  A round takes the next ``frontier`` extensions, counts their triples, and ends a language when its ``top``-th
surviving (score, count) is above everything that waits; what ties with it is extended.

A round reads the corpus once.  What tasks need of the frontier is bounded by ``frontier``, however large the corpus.

Defined results: null and empty texts have no words; a null lang is ``und``; equal rows count as often as they
occur; texts are worked through in slices cut between words, so one very long text needs no more memory
than others; an empty table gives an empty result; only lang and text are read, so other columns cannot clash.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from isoquilt.session import cut

LEAST = 10
TOP = 2000
SCALE = 1_000_000
#: Extensions counted in one round, of all languages together.
FRONTIER = 100_000
#: Parts of a language's waiting extensions that are put in order side by side.
HANDS = 64
#: Bytes of text that are counted at once.
SLICE = 2 << 20

# A-Z to lower case, tab to space, piece ends to a byte that UTF-8 never holds.
_BREAK = b"\xff"
_TABLE = bytes(
    0xFF if chr(c) in ".,;:!?\n\x0b\x0c\r" else 0x20 if c == 9 else c + 32 if 65 <= c <= 90 else c for c in range(256)
)


def _two_words_back(data: bytes, begin: int, end: int) -> int:
    """Where the last two words of data[begin:end] start."""
    for _ in range(2):
        while end > begin and data[end - 1] == 0x20:
            end -= 1
        end = max(begin, data.rfind(b" ", begin, end) + 1)
    return end


def slices(data: bytes, most: int = SLICE) -> Iterator[tuple[bytes, int]]:
    """(slice, words at its start that were counted before): cuts at a piece's end, else between words."""
    begin, old = 0, 0
    while len(data) - begin > most:
        end = data.rfind(_BREAK, begin, begin + most) + 1
        if end:
            yield data[begin:end], old
            begin, old = end, 0
            continue
        end = data.rfind(b" ", begin, begin + most)
        # two words before the cut are seen again, as phrases go on there; a slice must hold more than those
        while (again := _two_words_back(data, begin, max(end, begin))) == begin:
            end = min((x for x in (data.find(b" ", max(end, begin + most) + 1), data.find(_BREAK, begin)) if x >= 0), default=len(data))
            if end == len(data) or data[end : end + 1] == _BREAK:
                again = end
                break
        yield data[begin:end], old
        old = len(data[again:end].split())
        begin = again
    yield data[begin:], old


class Counted:
    """A batch of slices (lang, text, words counted before) as numbers of their words, each with its language."""

    def __init__(self, parts: list):
        words, begins = [], []
        for _, data, _ in parts:
            begins.append(len(words))
            words += data.replace(_BREAK, b" \xff ").split()
            words.append(_BREAK)
        coded = pa.array(words, pa.binary()).dictionary_encode()
        total = len(words)
        del words
        texts, at = coded.dictionary, coded.indices.to_numpy().astype(np.int64)
        ends = pc.index(texts, pa.scalar(_BREAK, pa.binary())).as_py()
        codes = {lang: k for k, lang in enumerate(dict.fromkeys(lang for lang, _, _ in parts))}
        lang = np.repeat(np.array([codes[x] for x, _, _ in parts]), np.diff([*begins, total]))
        # a word is numbered anew in each language
        both, self.word = np.unique(lang * len(texts) + at, return_inverse=True)
        lang, code = np.divmod(both, len(texts))
        self.many = len(both)
        self.lang = pa.array(list(codes), pa.string()).take(pa.array(lang))
        # the mark that ends a piece is not UTF-8
        self.text = texts.take(pa.array(code, mask=code == ends)).cast(pa.string())
        self.inside = at != ends
        self.fresh = np.ones(total, dtype=bool)
        for begin, (_, _, old) in zip(begins, parts):
            self.fresh[begin : begin + old] = False
        self.linked = self.inside[:-1] & self.inside[1:]

    def table(self, parts: list[np.ndarray], n: np.ndarray) -> pa.RecordBatch:
        """Phrases of the numbered words ``parts`` that occur ``n`` times."""
        words = [self.text.take(pa.array(p)) for p in parts]
        phrase = pc.binary_join_element_wise(*words, " ")
        lang = self.lang.take(pa.array(parts[0]))
        return pa.RecordBatch.from_arrays(
            [lang, pa.array(np.full(len(n), len(parts)), pa.int32()), phrase, pa.array(n)], names=["lang", "words", "phrase", "n"]
        )

    def words_and_pairs(self) -> Iterator[pa.RecordBatch]:
        """Counts of words and pairs, and those of all words of a language as a phrase of none."""
        one, n = np.unique(self.word[self.inside & self.fresh], return_counts=True)
        words = self.table([one], n)
        yield words
        totals = pa.table([words["lang"], words["n"]], names=["lang", "n"]).group_by("lang").aggregate([("n", "sum")])
        zeros, empty = pa.array(np.zeros(len(totals)), pa.int32()), pa.array([""] * len(totals), pa.string())
        yield from pa.table([totals["lang"], zeros, empty, totals["n_sum"]], names=["lang", "words", "phrase", "n"]).to_batches()
        linked = self.linked & self.fresh[1:]
        two, n = np.unique(self.word[:-1][linked] * self.many + self.word[1:][linked], return_counts=True)
        yield self.table(list(np.divmod(two, self.many)), n)

    def triples(self, begins: list, ends: list) -> Iterator[pa.RecordBatch]:
        """Counts of the triples that begin with a pair of ``begins`` or end with one of ``ends``."""
        two = self.word[:-1] * self.many + self.word[1:]
        asked = np.isin(two[:-1], self._numbers(*begins)) | np.isin(two[1:], self._numbers(*ends))
        asked &= self.linked[:-1] & self.linked[1:] & self.fresh[2:]
        two, at = np.unique(two[:-1][asked], return_inverse=True)
        three, n = np.unique(at * self.many + self.word[2:][asked], return_counts=True)
        at, last = np.divmod(three, self.many)
        yield self.table([*np.divmod(two[at], self.many), last], n)

    def _numbers(self, first: pa.Array, second: pa.Array) -> np.ndarray:
        """Pairs given by their tagged words as numbers, where both words are in this batch."""
        if not hasattr(self, "tagged"):
            self.tagged = pc.binary_join_element_wise(self.lang, self.text, " ")
        one, two = (pc.index_in(x, self.tagged).fill_null(-1).to_numpy().astype(np.int64) for x in (first, second))
        known = (one >= 0) & (two >= 0)
        return one[known] * self.many + two[known]


def _counts(docs: DataFrame, of, least: int) -> DataFrame:
    """(lang, words, phrase, n >= least): what ``of`` counts in batches, summed over the corpus."""

    def run(batches):
        held, size = [], 0
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for part, seen in slices(text.encode().translate(_TABLE)):
                    held.append((lang, part, seen))
                    size += len(part)
                    if size >= SLICE:
                        batch, held, size = Counted(held), [], 0
                        yield from of(batch)
        if held:
            yield from of(Counted(held))

    texts = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    found = texts.mapInArrow(run, "lang string, words int, phrase string, n long")
    return found.groupBy("lang", "words", "phrase").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def _score(a: str, l: str, r: str) -> Column:  # noqa: E741
    """floor(SCALE * a * a / (l * r)) in whole numbers."""
    whole = [f"cast({x} AS decimal(16,0))" for x in (a, l, r)]
    return F.expr(f"cast({SCALE} AS decimal(7,0)) * {whole[0]} * {whole[0]} div ({whole[1]} * {whole[2]})").cast("long")


def _first(phrase: str) -> Column:
    return F.substring_index(phrase, " ", 1)


def _last(phrase: str) -> Column:
    return F.substring_index(phrase, " ", -1)


def _lookup(counted: DataFrame, words: int, key: str, name: str) -> DataFrame:
    return counted.where(F.col("words") == words).select("lang", F.col("phrase").alias(key), F.col("n").alias(name))


def _cut_scores(triples: DataFrame, counted: DataFrame) -> DataFrame:
    """Triples (lang, phrase, a) with l, r and score of their lowest-scoring cut."""
    t = triples.select(
        "lang", "phrase", "a", _first("phrase").alias("w1"), F.substring_index("phrase", " ", -2).alias("w23"),
        F.substring_index("phrase", " ", 2).alias("w12"), _last("phrase").alias("w3"),
    )
    for words, key, name in ((1, "w1", "l1"), (2, "w23", "r1"), (2, "w12", "l2"), (1, "w3", "r2")):
        t = t.join(_lookup(counted, words, key, name), ["lang", key])
    t = t.withColumns({"s1": _score("a", "l1", "r1"), "s2": _score("a", "l2", "r2")})
    front = F.col("s1") <= F.col("s2")
    return t.select(
        "lang", "phrase", "a", F.when(front, F.col("l1")).otherwise(F.col("l2")).alias("l"),
        F.when(front, F.col("r1")).otherwise(F.col("r2")).alias("r"), F.least("s1", "s2").alias("score"),
    )


def _extended(docs: DataFrame, asked: list, least: int) -> DataFrame:
    """(lang, phrase, a) of the triples around the pairs ``asked``, rows (lang, phrase, side)."""

    sides = {"right": ([], []), "left": ([], [])}
    for row in asked:
        for held, word in zip(sides[row["side"]], row["phrase"].split(" ")):
            held.append(f"{row['lang']} {word}")
    begins, ends = ([pa.array(x, pa.string()) for x in sides[s]] for s in ("right", "left"))
    return _counts(docs, lambda c: c.triples(begins, ends), least).select("lang", "phrase", F.col("n").alias("a"))


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP, frontier: int = FRONTIER) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the first ``top`` phrases of two and three words of each language."""
    counted = cut(_counts(docs, Counted.words_and_pairs, least))
    pairs = counted.where("words = 2").select("lang", "phrase", F.col("n").alias("a"), _first("phrase").alias("w1"), _last("phrase").alias("w2"))
    pairs = pairs.join(_lookup(counted, 1, "w1", "l"), ["lang", "w1"]).join(_lookup(counted, 1, "w2", "r"), ["lang", "w2"])
    bound = F.expr(f"cast({SCALE} AS decimal(7,0)) * cast(a AS decimal(16,0)) div cast(l AS decimal(16,0))").cast("long")
    pairs = cut(pairs.select("lang", "phrase", "a", "l", "r", _score("a", "l", "r").alias("score"), bound.alias("bound")))

    # what each pair's two extensions can change at most: (score, count)
    waiting = pairs.select("lang", "phrase", F.lit("right").alias("side"), F.col("bound").alias("s"), "a").unionByName(
        pairs.select("lang", "phrase", F.lit("left").alias("side"), F.col("score").alias("s"), "a")
    )
    done = docs.sparkSession.createDataFrame([], "lang string, phrase string, side string")
    triples = docs.sparkSession.createDataFrame([], "lang string, phrase string, a long")
    best = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    while True:
        scored = cut(_cut_scores(triples, counted))
        around = scored.select("lang", F.substring_index("phrase", " ", 2).alias("phrase"), F.col("a").alias("longer")).unionByName(
            scored.select("lang", F.substring_index("phrase", " ", -2).alias("phrase"), F.col("a").alias("longer"))
        )
        around = around.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
        alive = pairs.join(around, ["lang", "phrase"], "left").where("longer IS NULL OR 100 * longer < 50 * a")
        settled = alive.join(done.groupBy("lang", "phrase").count().where("count = 2"), ["lang", "phrase"], "left_semi")
        found = settled.select("lang", "phrase", "a", "l", "r", "score").unionByName(scored)
        ranked = found.withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(*best))).where(F.col("rank") <= top)
        ranked = cut(ranked)
        line = ranked.where(F.col("rank") == top).select("lang", F.col("score").alias("line_s"), F.col("a").alias("line_a"))
        open_ = waiting.join(done, ["lang", "phrase", "side"], "left_anti").join(line, "lang", "left")
        # a dropped pair needs no left extension; its right one may still hold triples
        gone = around.join(pairs, ["lang", "phrase"]).where("100 * longer >= 50 * a").select("lang", "phrase", F.lit("left").alias("side"))
        open_ = open_.join(gone, ["lang", "phrase", "side"], "left_anti")
        open_ = open_.where("line_s IS NULL OR s > line_s OR (s = line_s AND a >= line_a)")
        # each language's best in several hands, so that a large one is not sorted by a single task
        hand = F.pmod(F.xxhash64("phrase"), F.lit(HANDS))
        order = W.partitionBy("lang", "hand").orderBy(F.col("s").desc(), F.col("a").desc(), "phrase", "side")
        turn = open_.withColumn("hand", hand).withColumn("turn", F.row_number().over(order)).where(F.col("turn") <= frontier)
        asked = turn.orderBy("turn", "lang").limit(frontier).select("lang", "phrase", "side").collect()
        if not asked:
            break
        more = _extended(docs, asked, least)
        triples = cut(triples.unionByName(more).groupBy("lang", "phrase").agg(F.max("a").alias("a")))
        done = cut(done.unionByName(docs.sparkSession.createDataFrame(asked, "lang string, phrase string, side string")))
    total = counted.where("words = 0").select("lang", "n")
    return ranked.join(total, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
