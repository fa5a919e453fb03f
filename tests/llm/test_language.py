"""Held-out accuracy, odd rows, and the slopes of the network."""

import zlib

import numpy as np
import pytest

from isoquilt.llm import language
from .helpers import documents, odd_rows


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = {r["doc_id"]: r for r in language.predictions(docs).collect()}
    lang = {r["doc_id"]: r["lang"] for r in docs.select("doc_id", "lang").collect()}
    assert got.keys() == lang.keys()
    held = [d for d in got if got[d]["held_out"]]
    assert held == [d for d in got if zlib.crc32(str(d).encode()) % 4 == 2] and len(held) > 200
    assert np.mean([got[d]["lang_pred"] == lang[d] for d in held]) > 0.98
    assert all(0 <= r["score"] <= 1 for r in got.values())


def test_held_out_rows_and_columns_do_not_matter(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(80)
    plain = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language.predictions(docs).collect()}
    blinded = docs.selectExpr("doc_id", "text", "if(crc32(string(doc_id)) % 4 = 2, 'xx', lang) lang", "'z' source", "n_chars")
    assert {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language.predictions(blinded).collect()} == plain


def test_odd_rows(spark):
    rows = odd_rows() + [(30, "12 34 !?", "en", "a"), (31, "der die das und nicht " * 50, "de", "a")]
    docs = documents(spark, rows)
    got = language.predictions(docs).collect()
    assert len(got) == len(rows)
    by_id = {r["doc_id"]: r for r in got}
    for doc_id in (3, 4, 5, 30):
        assert (by_id[doc_id]["lang_pred"], by_id[doc_id]["score"]) == ("und", 0.0)
    assert by_id[None]["held_out"] is False and by_id[6]["lang_pred"] in ("en", "de")
    kept = language.accepted(docs)
    assert kept.columns == docs.columns and {3, 4, 5, 30}.isdisjoint(r["doc_id"] for r in kept.collect())
    unlabelled = docs.selectExpr("doc_id", "text", "string(null) lang")
    assert {r["lang_pred"] for r in language.predictions(unlabelled).collect()} == {"und"}
    assert language.predictions(docs.limit(0)).count() == 0


def test_slopes():
    network = language.Network(["a", "b", "c"])
    rng = np.random.default_rng(2)
    windows, answers = rng.integers(0, 256, (5, language.WINDOW)), np.array([0, 1, 2, 1, 0])

    def loss():
        total = network.responses(windows, [network.embedding @ k for k in network.kernel])
        hidden = np.maximum(total.max(axis=1) + network.bias, 0)
        chances = language._softmax(hidden @ network.out + network.out_bias)
        return -np.log(chances[np.arange(5), answers]).mean()

    slopes = network._slopes(windows, answers)
    values = [network.embedding, *network.kernel, network.bias, network.out, network.out_bias]
    for value, slope in zip(values, slopes):
        at = np.unravel_index(np.abs(slope).argmax(), slope.shape)
        before = value[at]
        value[at] = before + 1e-5
        up = loss()
        value[at] = before - 1e-5
        down = loss()
        value[at] = before
        assert slope[at] == pytest.approx((up - down) / 2e-5, rel=0.02, abs=1e-5)


def test_folded_tables_are_the_convolution():
    network = language.Network(["a", "b", "c"])
    rng = np.random.default_rng(3)
    network.bias[:] = rng.normal(0, 1, network.filters)
    windows = np.concatenate([rng.integers(0, 256, (3, language.WINDOW)), language.windows_of("héllo").astype(int)])
    want = []
    for window in windows:
        vectors = [network.embedding[b] for b in window]
        best = []
        for f in range(network.filters):
            width = sorted(language.WIDTHS, reverse=True)[f // language.FILTERS]
            places = range(language.WINDOW - max(language.WIDTHS) + 1)
            best.append(max(sum(vectors[p + k] @ network.kernel[k][:, f] for k in range(width)) for p in places))
        top = np.maximum(np.array(best) + network.bias, 0) @ network.out + network.out_bias
        want.append(np.exp(top) / np.exp(top).sum())
    assert np.allclose(network.probabilities(windows, network.tables()), want, atol=1e-5)
