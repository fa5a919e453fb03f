"""Language identification by a byte convolutional network, trained here in numpy.

A text is cut into windows of ``WINDOW`` bytes.  Byte embeddings pass filters of several widths,
the largest response of each filter over the window feeds a softmax.  A text's prediction is the mean
of its windows' probabilities, weighted by their bytes; all windows of a text count.

Training: at most about ``2 * PER_LANG`` labelled rows of each language are drawn by a hash of
their id, cut to ``PER_LANG`` in the order of that hash, and of each row ``WINDOWS`` windows spread
evenly over its text.  The sample is the only thing collected, and its bound does not depend on the
size of the table.  Rows whose ``crc32(doc_id) mod 4`` is 2 are held out.

For prediction the filters are folded into one table for each offset, byte by filter, so a window
costs table look-ups and additions only.

Defined results: a text that is null or holds no letter is ``und`` with score 0; without any
labelled row all texts are; equal probabilities go to the smaller language; a null id is never
trained on nor held out; repeated rows are each predicted; an empty table gives an empty result;
the operator reads doc_id, text and lang and carries a row's columns along as one value, so other columns cannot clash.
"""

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from isoquilt.llm.common import quoted

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 16
EMBEDDING = 8
PAD = 256
#: Bound of the training sample.
PER_LANG = 400
WINDOWS = 4
EPOCHS = 6
BATCH = 64
RATE = 0.01
SEED = 11
UNKNOWN = "und"
#: Documents with a lower score are rejected by ``accepted``.
LEAST_SCORE = 0.5
ROWS = 256
_LETTER = regex.compile(r"\p{L}")


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string")) % 4 == 2


def windows_of(text: str) -> np.ndarray:
    """All windows of a text, the last one padded."""
    raw = np.frombuffer(text.encode(), dtype=np.uint8)
    out = np.full(-(-len(raw) // WINDOW) * WINDOW, PAD, dtype=np.uint16)
    out[: len(raw)] = raw
    return out.reshape(-1, WINDOW)


class Network:
    """Embedding, filters of several widths, maximum over the window, softmax."""

    def __init__(self, languages: list[str], seed: int = SEED):
        draw = np.random.default_rng(seed)
        self.languages = languages
        self.filters = FILTERS * len(WIDTHS)
        # Filters of offset k: those of a width above k, wider ones first, so they are a prefix.
        self.reach = [FILTERS * sum(w > k for w in WIDTHS) for k in range(max(WIDTHS))]
        self.embedding = draw.normal(0, 0.3, (PAD + 1, EMBEDDING))
        self.embedding[PAD] = 0
        self.kernel = [draw.normal(0, 0.3, (EMBEDDING, n)) for n in self.reach]
        self.bias = np.zeros(self.filters)
        self.out = draw.normal(0, 0.1, (self.filters, len(languages)))
        self.out_bias = np.zeros(len(languages))

    def tables(self) -> list[np.ndarray]:
        return [(self.embedding @ k).astype(np.float32) for k in self.kernel]

    def responses(self, windows: np.ndarray, tables: list[np.ndarray]) -> np.ndarray:
        """(window, place, filter): the response of each filter at each place it fits."""
        places = windows.shape[1] - len(tables) + 1
        total = tables[0][windows[:, :places]]
        for k, table in enumerate(tables[1:], 1):
            total[:, :, : table.shape[1]] += table[windows[:, k : k + places]]
        return total

    def probabilities(self, windows: np.ndarray, tables: list[np.ndarray]) -> np.ndarray:
        top = np.concatenate([self.responses(windows[i : i + 32], tables).max(axis=1) for i in range(0, len(windows), 32)])
        return _softmax(np.maximum(top + self.bias, 0) @ self.out + self.out_bias)

    def train(self, windows: np.ndarray, answers: np.ndarray, epochs: int, seed: int) -> None:
        draw = np.random.default_rng(seed)
        values = [self.embedding, *self.kernel, self.bias, self.out, self.out_bias]
        first, second = [np.zeros_like(v) for v in values], [np.zeros_like(v) for v in values]
        step = 0
        for _ in range(epochs):
            order = draw.permutation(len(windows))
            for at in range(0, len(order), BATCH):
                rows = order[at : at + BATCH]
                step += 1
                slopes = self._slopes(windows[rows], answers[rows])
                for v, g, m, s in zip(values, slopes, first, second):
                    m += 0.1 * (g - m)
                    s += 0.001 * (g * g - s)
                    v -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.999**step)) + 1e-8)
                self.embedding[PAD] = 0

    def _slopes(self, windows: np.ndarray, answers: np.ndarray) -> list[np.ndarray]:
        n = len(windows)
        total = self.responses(windows, self.tables())
        place = total.argmax(axis=1)
        top = np.take_along_axis(total, place[:, None, :], axis=1)[:, 0, :] + self.bias
        hidden = np.maximum(top, 0)
        error = _softmax(hidden @ self.out + self.out_bias)
        error[np.arange(n), answers] -= 1
        error /= n
        back = (error @ self.out.T) * (top > 0)
        embedding, kernels = np.zeros_like(self.embedding), []
        # only the place of the maximum of each filter passes a slope on
        for k, kernel in enumerate(self.kernel):
            size = kernel.shape[1]
            seen = np.take_along_axis(windows, place[:, :size] + k, axis=1)
            slope = back[:, :size]
            kernels.append(np.einsum("bf,bfe->ef", slope, self.embedding[seen]))
            np.add.at(embedding, seen.ravel(), (slope[:, :, None] * kernel.T[None]).reshape(-1, EMBEDDING))
        return [embedding, *kernels, back.sum(axis=0), hidden.T @ error, error.sum(axis=0)]


def _softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(axis=1, keepdims=True))
    return x / x.sum(axis=1, keepdims=True)


def training_sample(docs: DataFrame, per_lang: int = PER_LANG, windows: int = WINDOWS) -> list[tuple[str, list[bytes]]]:
    """(language, windows) of the bounded sample, in a fixed order."""
    labelled = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")))
    counts = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return []
    shares = F.create_map(*[x for lang, n in counts.items() for x in (F.lit(lang), F.lit(min(1.0, 2 * per_lang / n)))])
    place = F.pmod(F.xxhash64("doc_id", F.lit(SEED)), F.lit(1 << 30))
    drawn = labelled.select("lang", place.alias("place"), "doc_id", "text").where(
        F.col("place") < shares[F.col("lang")] * (1 << 30)
    )

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                if not _LETTER.search(row["text"]):
                    continue
                parts = windows_of(row["text"])
                few = parts[np.unique(np.linspace(0, len(parts) - 1, windows).astype(int))]
                columns = [[row["lang"]], [row["place"]], [row["doc_id"]], [few.astype("<u2").tobytes()]]
                names = ["lang", "place", "doc_id", "windows"]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.int64(), pa.binary()))], names)

    found = drawn.withColumn("doc_id", F.col("doc_id").cast("long")).mapInArrow(run, "lang string, place long, doc_id long, windows binary").collect()
    by_lang = {}
    for row in sorted(found, key=lambda r: (r["place"], r["doc_id"], r["windows"])):
        by_lang.setdefault(row["lang"], []).append(bytes(row["windows"]))
    return [(lang, by_lang[lang][:per_lang]) for lang in sorted(by_lang)]


def trained(docs: DataFrame, per_lang: int = PER_LANG, windows: int = WINDOWS, epochs: int = EPOCHS) -> Network | None:
    """A network fitted to the bounded sample; None if no row is labelled."""
    sample = training_sample(docs, per_lang, windows)
    if not sample:
        return None
    network = Network([lang for lang, _ in sample])
    parts = [np.frombuffer(b"".join(rows), dtype="<u2").reshape(-1, WINDOW) for _, rows in sample]
    # each language gets the same say, whatever its share of the rows
    most = max(map(len, parts))
    parts = [p[np.resize(np.arange(len(p)), most)] for p in parts]
    answers = np.repeat(np.arange(len(parts)), most)
    network.train(np.concatenate(parts).astype(np.int64), answers, epochs, SEED)
    return network


def predict(network: Network | None, tables: list[np.ndarray], texts: list[str | None]) -> tuple[list[str], list[float]]:
    """Language and score of each text."""
    languages, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
    known = [i for i, t in enumerate(texts) if network and t and _LETTER.search(t)]
    if not known:
        return languages, scores
    parts = [windows_of(texts[i]) for i in known]
    starts = np.cumsum([0, *map(len, parts[:-1])])
    windows = np.concatenate(parts)
    weight = (windows != PAD).sum(axis=1)
    chances = network.probabilities(windows, tables) * weight[:, None]
    chances = np.add.reduceat(chances, starts, axis=0) / np.add.reduceat(weight, starts)[:, None]
    for i, row in zip(known, chances):
        best = int(row.argmax())
        languages[i], scores[i] = network.languages[best], float(min(1.0, row[best]))
    return languages, scores


def identify(docs: DataFrame, network: Network | None) -> DataFrame:
    """(row, lang_pred, score): each row of ``docs`` as one value, and its prediction."""
    shared = docs.sparkSession.sparkContext.broadcast((network, network.tables() if network else []))
    packed = docs.select(F.struct(*map(quoted, docs.columns)).alias("row"), F.col("text").alias("text"))

    def run(batches):
        model, tables = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                languages, scores = predict(model, tables, part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(languages, pa.string()), pa.array(scores, pa.float64())],
                    ["row", "lang_pred", "score"],
                )

    fields = [packed.schema["row"], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    return packed.mapInArrow(run, T.StructType(fields))


def predictions(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) for every document."""
    asked = docs.select("doc_id", "text")
    found = identify(asked, trained(docs.select("doc_id", "text", "lang")))
    doc_id = F.col("row.doc_id")
    return found.select(
        doc_id.alias("doc_id"), F.coalesce(held_out(doc_id), F.lit(False)).alias("held_out"), "lang_pred", "score"
    )


def accepted(docs: DataFrame, least_score: float = LEAST_SCORE) -> DataFrame:
    """Documents in a language that is recognised, with that language as their ``lang``."""
    found = identify(docs, trained(docs.select("doc_id", "text", "lang")))
    sure = found.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least_score))
    return sure.select(*[F.col("lang_pred").alias(c) if c == "lang" else F.col(f"row.{quoted(c)}").alias(c) for c in docs.columns])
