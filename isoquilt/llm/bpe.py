"""Byte-level BPE encoding and decoding on a tokenizer file.

Encoding: a piece of text is covered by tokens from the left.  An Aho-Corasick automaton over
the reversed tokens gives the longest token that starts at each byte; when a token cannot
follow the one before it, the next shorter token is tried, and when none fits the last token
is taken back.  Two tokens may follow each other exactly if the merges applied to their
joined bytes give the two tokens again; a sequence in which all neighbours may follow each
other is the result of the merges, so each byte position is entered at most once with
success and the walk is linear.  Decoding copies slices of one byte table by offset.

Defined results: null is the empty text and has no tokens; strings of added tokens become
their ids; ties do not occur, as a text has one encoding; an empty table gives an empty
result; repeated rows are each encoded; only the id and text columns are read.
"""

import hashlib
import json
from functools import cache

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Encoded pieces that one worker remembers.
REMEMBERED = 200_000
#: Longer pieces are rarely seen twice.
REMEMBER_CHARS = 64
#: Documents handled at once.
ROWS = 256
NEVER = 1 << 62

# Fixed value: the public pattern that splits a text before merging, white space spelt out.
SPLIT = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _byte_of_letter() -> dict[str, int]:
    """The letter under which a tokenizer file writes each byte: printable ones stand for themselves."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 255 and b != 173]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}


def load(path: str) -> dict:
    """Tokens, merges and added tokens of a tokenizer file as plain values."""
    with open(path, encoding="utf-8") as file:
        parsed = json.load(file)
    to_byte = _byte_of_letter()
    tokens = {i: bytes(to_byte[c] for c in text) for text, i in parsed["model"]["vocab"].items()}
    ids = {text: i for text, i in parsed["model"]["vocab"].items()}
    merges = []
    for pair in parsed["model"]["merges"]:
        left, right = pair.split(" ") if isinstance(pair, str) else pair
        merges.append((ids[left], ids[right], ids[left + right]))
    added = {x["content"]: x["id"] for x in parsed.get("added_tokens", [])}
    return {"tokens": tokens, "merges": merges, "added": added}


class Encoder(dict):
    """Remembers ``piece -> little-endian ids``; works out a piece when it is first asked for."""

    def __init__(self, vocabulary: dict):
        super().__init__()
        self.tokens = vocabulary["tokens"]
        self.added = vocabulary["added"]
        self.rank, made = {}, {}
        for rank, (left, right, whole) in enumerate(vocabulary["merges"]):
            self.rank.setdefault((left, right), rank)
            made.setdefault(whole, (rank, left, right))
        self.made = made
        self.fits = {}
        self._spines = ({}, {})
        # a token that its own merges never give cannot be part of a result
        usable = {i for i, t in self.tokens.items() if i in made and self._whole(i) or len(t) == 1}
        self.size = {i: len(self.tokens[i]) for i in usable}
        by_bytes = {self.tokens[i]: i for i in usable}
        self.whole_piece = {t: i.to_bytes(4, "little") for t, i in by_bytes.items()}
        self.shorter = {}
        self.automaton = ahocorasick.Automaton()
        for text, i in by_bytes.items():
            self.automaton.add_word(text[::-1].decode("latin-1"), i)
            self.shorter[i] = next((by_bytes[text[:n]] for n in range(len(text) - 1, 0, -1) if text[:n] in by_bytes), None)
        self.automaton.make_automaton()
        self.pieces = regex.compile(SPLIT)
        self.split_added = regex.compile("(" + "|".join(map(regex.escape, sorted(self.added, key=len, reverse=True))) + ")") if self.added else None

    def _spine(self, token: int, side: int) -> list[tuple[int, int]]:
        """(token, rank of the merge that ends it) along one edge of a token's merge tree."""
        known = self._spines[side].get(token)
        if known is None:
            known, end = [], NEVER
            at = token
            while True:
                known.append((at, end))
                if at not in self.made:
                    break
                end, *parts = self.made[at]
                at = parts[side]
            self._spines[side][token] = known
        return known

    def may_follow(self, left: int, right: int) -> bool:
        """Whether no merge reaches over the border of the two tokens."""
        key = left << 32 | right
        known = self.fits.get(key)
        if known is None:
            # Among equal merges the leftmost goes first, hence the two different comparisons.
            known = not any(
                rank < end_a and rank <= end_b
                for a, end_a in self._spine(left, 1)
                for b, end_b in self._spine(right, 0)
                if (rank := self.rank.get((a, b))) is not None
            )
            if len(self.fits) >= 2 * REMEMBERED:
                self.fits.clear()
            self.fits[key] = known
        return known

    def _whole(self, token: int) -> bool:
        """Whether the two halves of a token stay as they are until they are merged."""
        rank, left, right = self.made[token]
        return all(
            found >= min(rank, end_a) or found > end_b
            for a, end_a in self._spine(left, 1)
            for b, end_b in self._spine(right, 0)
            if (found := self.rank.get((a, b))) is not None
        )

    def ids(self, piece: bytes) -> list[int]:
        n = len(piece)
        longest = [None] * n
        size, shorter, may_follow = self.size, self.shorter, self.may_follow
        for end, token in self.automaton.iter(piece[::-1].decode("latin-1")):
            start = n - 1 - end
            if longest[start] is None or size[token] > size[longest[start]]:
                longest[start] = token
        out, at = [], 0
        closed = bytearray(n + 1)
        token = longest[0] if n else None
        while at < n:
            while token is not None and (closed[at + size[token]] or out and not may_follow(out[-1], token)):
                token = shorter[token]
            if token is None:
                closed[at] = 1
                token = out.pop()
                at -= size[token]
            else:
                out.append(token)
                at += size[token]
                token = longest[at] if at < n else None
        return out

    def __missing__(self, piece: str) -> bytes:
        raw = piece.encode()
        made = self.whole_piece.get(raw) or np.array(self.ids(raw), dtype="<u4").tobytes()
        if len(piece) <= REMEMBER_CHARS:
            if len(self) >= REMEMBERED:
                self.clear()
            self[piece] = made
        return made

    def encode(self, text: str | None) -> bytes:
        """Little-endian unsigned 32-bit ids of a whole text."""
        if not text:
            return b""
        if self.split_added is None or not self.split_added.search(text):
            return b"".join([self[piece] for piece in self.pieces.findall(text)])
        parts = self.split_added.split(text)
        return b"".join(
            self.added[part].to_bytes(4, "little") if k % 2 else b"".join([self[x] for x in self.pieces.findall(part)])
            for k, part in enumerate(parts)
        )


class Decoder:
    """One byte table of all tokens, and where each begins."""

    def __init__(self, vocabulary: dict):
        texts = dict(vocabulary["tokens"]) | {i: t.encode() for t, i in vocabulary["added"].items()}
        count = max(texts) + 1
        self.length = np.array([len(texts.get(i, b"")) for i in range(count)], dtype=np.int64)
        self.start = np.concatenate(([0], np.cumsum(self.length)[:-1]))
        self.table = np.frombuffer(b"".join(texts.get(i, b"") for i in range(count)), dtype=np.uint8)

    def decode(self, ids: bytes | None) -> str:
        """The text of little-endian ids; bytes that are not UTF-8 become replacement characters."""
        at = np.frombuffer(ids or b"", dtype="<u4")
        length = self.length[at]
        before = np.cumsum(length) - length
        places = np.repeat(self.start[at] - before, length) + np.arange(length.sum())
        return self.table[places].tobytes().decode("utf-8", "replace")


@cache
def _of_worker(key: str, kind: type):
    """The encoder or decoder of a worker process, made once."""
    vocabulary = json.loads(key)
    vocabulary["tokens"] = {int(i): bytes.fromhex(t) for i, t in vocabulary["tokens"].items()}
    return kind(vocabulary)


def _shared(spark: SparkSession, path: str | None):
    """The vocabulary as a broadcast value: its size is that of the file, whatever the data."""
    vocabulary = load(path or default_path())
    vocabulary["tokens"] = {i: t.hex() for i, t in vocabulary["tokens"].items()}
    return spark.sparkContext.broadcast(json.dumps(vocabulary))


def _mapped(docs: DataFrame, id_col: str, text_col: str, path: str | None, columns: str, row) -> DataFrame:
    """``row(encoder, decoder, text)`` of every document, a few hundred at a time."""
    shared = _shared(docs.sparkSession, path)
    pairs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    names = [x.split()[0] for x in columns.split(", ")]

    def run(batches):
        encoder, decoder = _of_worker(shared.value, Encoder), _of_worker(shared.value, Decoder)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                made = zip(*[row(encoder, decoder, t) for t in part.column(1).to_pylist()])
                yield pa.RecordBatch.from_arrays([part.column(0), *[pa.array(list(x)) for x in made]], ["doc_id", *names])

    ids_type = pairs.schema["doc_id"].dataType.simpleString()
    return pairs.mapInArrow(run, f"doc_id {ids_type}, {columns}")


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """(doc_id, n_tokens, ids): ids of each whole text as little-endian unsigned 32-bit integers."""

    def row(encoder, decoder, text):
        ids = encoder.encode(text)
        return len(ids) // 4, ids

    return _mapped(docs, id_col, text_col, path, "n_tokens long, ids binary", row)


def decode(encoded: DataFrame, ids_col: str = "ids", path: str | None = None) -> DataFrame:
    """``encoded`` with a column ``decoded``: the text of its ids."""
    shared = _shared(encoded.sparkSession, path)

    @F.pandas_udf("string")
    def run(ids: pd.Series) -> pd.Series:
        decoder = _of_worker(shared.value, Decoder)
        return pd.Series([decoder.decode(x) for x in ids], dtype=object)

    return encoded.withColumn("decoded", run(F.col(ids_col)))


def digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Per document the token count and the digests of its ids and of the text they decode to.

    Both directions run in one pass, so neither ids nor texts travel back to Spark.
    """

    def row(encoder, decoder, text):
        ids = encoder.encode(text)
        back = decoder.decode(ids).encode()
        return len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(back).hexdigest()

    columns = "n_tokens long, ids_sha256 string, decoded_sha256 string"
    return _mapped(docs, "doc_id", "text", path, columns, row)
