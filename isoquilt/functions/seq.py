"""Nucleotide string helpers as native Column expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def revcomp(seq: Column) -> Column:
    """Reverse complement; letters other than ACGT stay as they are."""
    return F.reverse(F.translate(seq, "ACGT", "TGCA"))


def kmers(seq: Column, k: int) -> Column:
    """All overlapping substrings of length ``k`` in order (empty if too short)."""
    cut = F.transform(F.sequence(F.lit(1), F.length(seq) - k + 1), lambda i: F.substring(seq, i, F.lit(k)))
    return F.when(F.length(seq) >= k, cut).otherwise(F.array().cast("array<string>"))


def trim_to_last_run(seq: Column, base: str = "A", run: int = 10) -> Column:
    """Suffix starting where the last run of ``run`` equal bases begins."""
    return F.regexp_replace(seq, f"^.*(?={base}{{{run}}})", "")


def has_polya(seq: Column, window: int = 20, count: int = 15) -> Column:
    """Some window of ``window`` bases holds ``count`` A's; the very last window is not tested.

    Texts with fewer A's in all are told apart first.  A window that begins with another letter can be
    moved on without losing an A, so only those that begin with one are counted, and the last.
    """

    def rich(text):
        last = F.length(text) - window
        letters = lambda i: F.replace(F.substring(text, i, F.lit(window)), F.lit("A"), F.lit(""))
        return F.exists(
            F.sequence(F.lit(1), last),
            lambda i: ((F.substring(text, i, F.lit(1)) == "A") | (i == last)) & (F.length(letters(i)) <= window - count),
        )

    enough = F.length(F.replace(seq, F.lit("A"), F.lit(""))) <= F.length(seq) - count
    # the text is bound once; inside the test of a window it would be worked out for every window
    bound = F.element_at(F.transform(F.array(seq), rich), 1)
    return F.when((F.length(seq) > window) & enough, bound).otherwise(F.lit(False))


def gc_percent(seq: Column) -> Column:
    """Share of G and C in percent."""
    return F.length(F.regexp_replace(seq, "[^GC]", "")) * 100.0 / F.length(seq)


def linear_gc_percent(length: Column, longest: float, shortest: float, gc_high=1.0, gc_low=0.2) -> Column:
    """GC percent assumed to fall linearly with the length."""
    return (F.lit(gc_high) - (length - shortest) * (gc_high - gc_low) / (longest - shortest)) * 100.0


def last_bases(seq: Column, n: int) -> Column:
    """Last ``n`` letters, the whole text if shorter."""
    return F.when(F.length(seq) > n, F.right(seq, F.lit(n))).otherwise(seq)
