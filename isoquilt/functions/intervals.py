"""Isoform and interval arithmetic as native Column expressions.

An isoform is text ``s,e|s,e|...`` at the edges and ``array<struct<s,e>>`` inside.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_blocks(isoform: Column) -> Column:
    """``s,e|s,e`` -> array of (s, e); both texts are cut at one letter, which needs no pattern compiled for every block."""
    return F.transform(
        F.split(isoform, r"\|"),
        lambda b: F.struct(
            F.substring_index(b, ",", 1).cast("bigint").alias("s"),
            F.element_at(F.split(b, ","), 2).cast("bigint").alias("e"),
        ),
    )


def format_blocks(blocks: Column) -> Column:
    """Array of (s, e) -> ``s,e|s,e``."""
    return F.array_join(F.transform(blocks, lambda b: F.concat_ws(",", b["s"], b["e"])), "|")


def site_list(isoform: Column) -> Column:
    """Every start and end in order."""
    return F.transform(F.split(isoform, r"[,|]"), lambda s: s.cast("bigint"))


def inner_sites(isoform: Column) -> Column:
    """Sites without the first start and the last end."""
    sites = site_list(isoform)
    return F.when(F.size(sites) > 2, F.slice(sites, F.lit(2), F.size(sites) - 2)).otherwise(
        F.array().cast("array<bigint>")
    )


def first_site(isoform: Column) -> Column:
    return F.substring_index(isoform, ",", 1).cast("bigint")


def last_site(isoform: Column) -> Column:
    return F.substring_index(isoform, ",", -1).cast("bigint")


def overlap(s1: Column, e1: Column, s2: Column, e2: Column) -> Column:
    """Common bases of two closed intervals."""
    return F.greatest(F.lit(0), F.least(e1, e2) - F.greatest(s1, s2) + 1)


def total_length(blocks: Column) -> Column:
    """Sum of e - s + 1."""
    return F.aggregate(blocks, F.lit(0).cast("bigint"), lambda acc, b: acc + b["e"] - b["s"] + 1)


def common_bases(a: Column, b: Column) -> Column:
    """Overlap of two sorted, disjoint block lists."""
    zero = F.lit(0).cast("bigint")
    return F.aggregate(
        a,
        zero,
        lambda acc, x: acc
        + F.aggregate(b, zero, lambda part, y: part + overlap(x["s"], x["e"], y["s"], y["e"]).cast("bigint")),
    )


def clip_blocks(blocks: Column, start: Column, end: Column) -> Column:
    """Blocks cut to [start, end]; those that only touch a border are dropped."""
    inside = F.filter(blocks, lambda b: (b["e"] > start) & (b["s"] < end))
    return F.transform(
        inside, lambda b: F.struct(F.greatest(b["s"], start).alias("s"), F.least(b["e"], end).alias("e"))
    )


def let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, however often ``use`` mentions it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def span_distance(a: Column, b: Column, most: int | None = None) -> Column:
    """Differing bases inside the span both isoforms cover; -1 if they share no span.

    With ``most`` given, null for pairs whose lengths inside the span alone differ by more.
    """

    def inside(v):
        if most is None:
            return total_length(v["ca"]) + total_length(v["cb"]) - 2 * common_bases(v["ca"], v["cb"])
        return let(F.struct(v.alias("v"), total_length(v["ca"]).alias("la"), total_length(v["cb"]).alias("lb")), bounded)

    def bounded(w):
        # bases that differ are at least those that one has more
        near = F.abs(w["la"] - w["lb"]) <= most
        return F.when(near, w["la"] + w["lb"] - 2 * common_bases(w["v"]["ca"], w["v"]["cb"]))

    def measure(p):
        clipped = F.struct(
            clip_blocks(p["a"], p["st"], p["en"]).alias("ca"), clip_blocks(p["b"], p["st"], p["en"]).alias("cb")
        )
        return F.when(p["st"] >= p["en"], F.lit(-1).cast("bigint")).otherwise(let(clipped, inside))

    def with_span(p):
        span = F.struct(
            p["a"].alias("a"),
            p["b"].alias("b"),
            F.greatest(F.get(p["a"], F.lit(0))["s"], F.get(p["b"], F.lit(0))["s"]).alias("st"),
            F.least(F.element_at(p["a"], -1)["e"], F.element_at(p["b"], -1)["e"]).alias("en"),
        )
        return F.when(p["a"] == p["b"], F.lit(0).cast("bigint")).otherwise(let(span, measure))

    return let(F.struct(a.alias("a"), b.alias("b")), with_span)


def full_distance(a: Column, b: Column) -> Column:
    """Differing bases without any clipping."""
    return let(
        F.struct(a.alias("a"), b.alias("b")),
        lambda p: total_length(p["a"]) + total_length(p["b"]) - 2 * common_bases(p["a"], p["b"]),
    )
