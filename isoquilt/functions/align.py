"""Pairwise alignment over whole Arrow batches.

Every step of the dynamic programme is one numpy operation over all pairs of
the batch, so the Python cost per pair is a few microseconds.
"""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T


def letters(texts: pd.Series) -> tuple[np.ndarray, np.ndarray]:
    """Texts as a zero-padded byte matrix plus their lengths."""
    lengths = texts.str.len().to_numpy(dtype=np.int64)
    width = int(lengths.max()) if len(lengths) else 0
    flat = "".join(texts.str.ljust(width, "\0")).encode("latin-1", "replace")
    return np.frombuffer(flat, dtype=np.uint8).reshape(len(texts), width), lengths


def infix_batch(texts: pd.Series, patterns: pd.Series) -> tuple[np.ndarray, np.ndarray]:
    """Best placement of each pattern inside its text (free ends in the text).

    Returns the edit distance and the column at which the alignment of the first
    pattern letter is left when walking back from the leftmost best end; the walk
    prefers staying in the column over the diagonal over moving left.
    """
    n = len(texts)
    edit = np.zeros(n, dtype=np.int32)
    pos = np.zeros(n, dtype=np.int32)
    sizes = patterns.str.len().to_numpy()
    for size in np.unique(sizes):
        rows = np.flatnonzero(sizes == size)
        edit[rows], pos[rows] = _infix_same_size(texts.iloc[rows], patterns.iloc[rows], int(size))
    return edit, pos


def _infix_same_size(texts, patterns, m):
    t, lengths = letters(texts)
    p, _ = letters(patterns)
    n, width = t.shape
    prev = np.repeat(np.arange(m + 1, dtype=np.int16)[:, None], n, axis=1)
    origin = np.zeros((m + 1, n), dtype=np.int16)
    best = prev[m].copy()
    best_origin = origin[m].copy()
    for j in range(1, width + 1):
        cur = np.zeros_like(prev)
        org = np.zeros_like(origin)
        org[1] = j
        letter = t[:, j - 1]
        for i in range(1, m + 1):
            left, up, diag = prev[i], cur[i - 1], prev[i - 1]
            least = np.minimum(np.minimum(left, up), diag)
            cur[i] = np.where(p[:, i - 1] == letter, diag, least + 1)
            if i > 1:
                org[i] = np.where(up == least, org[i - 1], np.where(diag == least, origin[i - 1], origin[i]))
        better = (cur[m] < best) & (j <= lengths)
        best = np.where(better, cur[m], best)
        best_origin = np.where(better, org[m], best_origin)
        prev, origin = cur, org
    return best, best_origin


def global_score_batch(a: pd.Series, b: pd.Series, match=1, mismatch=-1, gap=-1) -> np.ndarray:
    """Global alignment score of each pair."""
    x, la = letters(a)
    y, lb = letters(b)
    n, wa = x.shape
    wb = y.shape[1]
    out = np.zeros(n, dtype=np.int32)
    prev = np.repeat((np.arange(wb + 1, dtype=np.int32) * gap)[:, None], n, axis=1)
    rows = np.arange(n)
    done = la == 0
    out[done] = prev[lb[done], rows[done]]
    for i in range(1, wa + 1):
        cur = np.empty_like(prev)
        cur[0] = i * gap
        for j in range(1, wb + 1):
            score = np.where(x[:, i - 1] == y[:, j - 1], match, mismatch)
            cur[j] = np.maximum(prev[j - 1] + score, np.maximum(prev[j], cur[j - 1]) + gap)
        done = la == i
        out[done] = cur[lb[done], rows[done]]
        prev = cur
    return out


@F.pandas_udf(T.StructType([T.StructField("edit", T.IntegerType()), T.StructField("pos", T.IntegerType())]))
def infix_align(texts: pd.Series, patterns: pd.Series) -> pd.DataFrame:
    edit, pos = infix_batch(texts, patterns)
    return pd.DataFrame({"edit": edit, "pos": pos})


def score_texts(a: pd.Series, b: pd.Series) -> np.ndarray:
    """Global alignment scores; many isoforms share a window, so a batch scores each pair of texts once."""
    each, first = np.unique(pd.factorize(a)[0] * (len(a) + 1) + pd.factorize(b)[0], return_index=True, return_inverse=True)[1:][::-1]
    return global_score_batch(a.iloc[first], b.iloc[first])[each]


@F.pandas_udf(T.IntegerType())
def global_score(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series(score_texts(a, b))
