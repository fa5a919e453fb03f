"""Ids and texts against the tokenizers library."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from isoquilt.llm import bpe
from .helpers import documents, odd_rows

PARTS = ["a", "b", "th", "ing", " ", "  ", "\n", "\t", "é", "ß", "中", "🙂", "1", "23", "'s", "'ll", "!", "--", "\x1c", "\x85", "A"]
PARTS += ["aaaa", "<|endoftext|>", "\u200b", "\u0301", "Ⅷ", "x" * 30, "-" * 70, " " * 20]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def own():
    vocabulary = bpe.load(bpe.default_path())
    return bpe.Encoder(vocabulary), bpe.Decoder(vocabulary)


def _ids(own, text):
    return np.frombuffer(own[0].encode(text), dtype="<u4").tolist()


def test_random_texts(library, own):
    rng = random.Random(1)
    for _ in range(4000):
        text = "".join(rng.choice(PARTS) for _ in range(rng.randint(0, 25)))
        assert _ids(own, text) == library.encode(text, add_special_tokens=False).ids
        assert own[1].decode(own[0].encode(text)) == text


@pytest.mark.parametrize("text", ["a" * 40000, " " * 40000, "ab" * 20000, "=" * 30001, "th" * 9999])
def test_long_pieces(library, own, text):
    assert _ids(own, text) == library.encode(text, add_special_tokens=False).ids


def test_bytes_that_are_no_text(library, own):
    for ids in ([222], [447, 222], [12520, 100, 50256]):
        raw = np.array(ids, dtype="<u4").tobytes()
        assert own[1].decode(raw) == library.decode(ids, skip_special_tokens=False)


def test_small_memory_changes_nothing(library, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 3)
    encoder = bpe.Encoder(bpe.load(bpe.default_path()))
    text = "one two three four five six seven eight one two three"
    assert np.frombuffer(encoder.encode(text), dtype="<u4").tolist() == library.encode(text).ids


def test_digests(spark, library):
    rows = odd_rows() + [(50, "a<|endoftext|>b", "en", "a")]
    docs = documents(spark, rows)
    got = sorted(map(str, map(tuple, bpe.digests(docs).collect())))
    want = []
    for doc_id, text, *_ in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        raw = np.array(ids, dtype="<u4").tobytes()
        back = library.decode(ids, skip_special_tokens=False).encode()
        want.append((doc_id, len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256(back).hexdigest()))
    assert got == sorted(map(str, want))
    assert bpe.decode(bpe.encode(docs)).where("doc_id = 6").first()["decoded"] == rows[6][1]
    assert bpe.digests(docs.limit(0)).count() == 0
