"""Fixtures that every operator must stand: nulls, empty and long texts, ties, repeats, clashing columns."""

import random

CLASHES = ["size", "key", "row", "lines", "gone", "fp", "component", "host", "base", "shard", "ids", "n", "pos", "rank"]


def documents(spark, rows):
    """(doc_id, text, lang, source, n_chars) and columns named like the operators' own."""
    full = [(d, t, lang, source, len(t or ""), *range(len(CLASHES))) for d, t, lang, source in rows]
    clashes = ", ".join(f"{c} int" for c in CLASHES)
    return spark.createDataFrame(full, f"doc_id long, text string, lang string, source string, n_chars long, {clashes}")


def words(seed, n, alphabet="the of and in to that ing tion er on sh ea".split()):
    rng = random.Random(seed)
    return " ".join("".join(rng.choices(alphabet, k=rng.randint(1, 3))) for _ in range(n))


def odd_rows():
    """Rows with nulls, empty and long texts, ties and repeats."""
    long = words(1, 6000)
    return [
        (1, words(2, 80), "en", "b"),
        (2, words(2, 80), "en", "b"),
        (2, words(2, 80), "en", "b"),
        (3, None, None, None),
        (4, "", "en", "a"),
        (5, " \n\t ", "en", "a"),
        (6, long, "en", "c"),
        (7, long + " more", "en", "c"),
        (None, words(3, 40), "en", None),
        (8, "One", "en", "a"),
        (9, "é🙂 中文 one\x0btwo\u00a0three", "en", "é"),
    ]
