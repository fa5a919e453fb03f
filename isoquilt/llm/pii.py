"""Personal data: overlapping candidates, boosted trees over format and context, calibrated thresholds.

Generators propose spans of four kinds.  The base patterns, checked by their own rules (parts of an
address, check digits, number of digits), give spans that always stay.  Looser
patterns propose more: written-out addresses, numbers without a plus, numbers that fail a check.
A candidate's features are coarse: its kind and generator, how many digits and characters it has, the
characters beside it, its separators.  They never hold the outcome of a check.

What is learnt does not come from the base patterns: a candidate is labelled by a word before it that announces its kind.  Not every
personal span is announced; the share that is, is measured at the base spans of the kind, and divides the share of announced ones
among candidates of a format, which gives the probability that such a candidate is personal data (learning from positive and
unlabelled examples).  All candidates of the table are counted by their features.  Boosted trees are fitted to the counts of
four fifths of the rows, and for each kind the lowest score at which that probability is ``PRECISION`` or more in the other fifth is
the threshold; ``DOUBT`` unannounced candidates are added to the count, so few candidates give no certainty, at any size
of the table.  A candidate that meets no base span and reaches its threshold is added; of added spans that overlap
in a row the one with the highest score stays.

There are at most 40,960 combinations of features, whatever the data: that bounds what the driver sees.
Everything else is in the rows: no Python runs on the executors and nothing is shuffled but the counts.
The patterns start only where a run of their characters starts and never give characters back, and what is known of a
candidate's surroundings is cut from the text between two matches, so the time is linear in the text; spans are compared in sorted order.

Defined results: null is the empty text and has no spans; equal scores go to the earlier, then longer
span; repeated rows are each searched; an empty table gives an empty result; only doc_id and
text are read, so other columns cannot clash.
"""

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
ROUNDS = 20
DEPTH = 2
RATE = 0.3
PRECISION = 0.9
#: Unannounced candidates that are added to those of the calibration fold.
DOUBT = 2
#: The share of announced spans of a kind counts as this at least, as a smaller one says little.
LEAST_SHARE = 0.5
CUE_CHARS = 24

_LOCAL = "A-Za-z0-9._%+-"
_LABEL = "[A-Za-z0-9-]++"
# Patterns of the base spans, each with starts and quantifiers that do not backtrack.
BASE = {
    "email": rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@{_LABEL}(?:\.{_LABEL})++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){12,18}+(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_AT = r"(?:\x20?[(\[{]\x20?at\x20?[)\]}]\x20?|\x20@\x20?|@\x20)"
_DOT = r"(?:\.|\x20?[(\[{]\x20?dot\x20?[)\]}]\x20?)"
LOOSE = {
    "email": rf"(?<![{_LOCAL}])[{_LOCAL}]++{_AT}{_LABEL}(?:{_DOT}{_LABEL})++",
    "ip": r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])",
    "card": r"(?<![0-9])[0-9]{4}(?:[\x20._-]{1,2}[0-9]{4}){3}(?![0-9])",
    "phone": r"(?<![0-9])(?:00[0-9]{1,3}\x20?)?(?:\([0-9]{3}\)\x20?|[0-9]{3}[-.\x20])[0-9]{3}[-.\x20][0-9]{4}(?![0-9])",
}
# A text without this cannot hold the kind: each follows from both patterns of the kind.
GATE = {
    "email": r"(?i)@|[(\[{]\x20?at\x20?[)\]}]",
    "ip": "[0-9A-Fa-f][.:]",
    "card": r"[0-9][\x20-]?[0-9]",
    "phone": r"\+[0-9]|[0-9]{3}",
}
# Words that announce each kind.
CUES = {
    "email": r"(?i)(?:mail|write|contact|kontakt|addr|correo|courriel|schreib|escrib)",
    "ip": r"(?i)(?:\bip\b|server|host|addr|address|login|dirección|adresse)",
    "card": r"(?i)(?:card|visa|account|pay|karte|tarjeta|carte|konto|cuenta)",
    "phone": r"(?i)(?:tel|phone|call|fax|mobil|llam|appel|ruf|handy)",
}
_SPAN = "array<struct<kind:int,loose:int,start:int,stop:int,found:string,cue:int,left:int,right:int>>"


def _class(char: Column) -> Column:
    """Class of a character: nothing or space, letter, digit, other."""
    return F.when(char.rlike(r"^\s?$"), 0).when(char.rlike(r"\p{L}"), 1).when(char.rlike("[0-9]"), 2).otherwise(3)


def _matches(text: Column, kind: str, pattern: str, loose: int) -> Column:
    """Leftmost non-overlapping matches of a pattern with their places in code points and what stands around them."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    both = F.struct(found.alias("m"), F.split(text, pattern, -1).alias("gaps"))

    def around(v: Column) -> Column:
        def piece(m: Column, i: Column) -> Column:
            before = F.concat(F.when(i > 0, F.get(v["m"], i - 1)).otherwise(F.lit("")), F.get(v["gaps"], i))
            after = F.concat(F.get(v["gaps"], i + 1), F.coalesce(F.get(v["m"], i + 1), F.lit("")))
            return F.struct(
                m.alias("m"), F.length(F.get(v["gaps"], i)).alias("gap"), F.right(before, F.lit(CUE_CHARS)).rlike(CUES[kind]).cast("int").alias("cue"),
                _class(F.right(before, F.lit(1))).alias("left"), _class(F.left(after, F.lit(1))).alias("right"),
            )

        return F.transform(v["m"], piece)

    begin = F.struct(F.lit(0).alias("at"), F.array().cast(_SPAN).alias("spans"))

    def step(state: Column, piece: Column) -> Column:
        start = state["at"] + piece["gap"]
        stop = start + F.length(piece["m"])
        span = F.struct(
            F.lit(KINDS.index(kind)).alias("kind"), F.lit(loose).alias("loose"), start.alias("start"), stop.alias("stop"), piece["m"].alias("found"),
            piece["cue"].alias("cue"), piece["left"].alias("left"), piece["right"].alias("right"),
        )
        return F.struct(stop.alias("at"), F.array_append(state["spans"], span).alias("spans"))

    pieces = F.flatten(F.transform(F.array(both), around))
    located = F.aggregate(pieces, begin, step, lambda state: state["spans"])
    return F.when(F.size(found) > 0, located).otherwise(F.array().cast(_SPAN))


def _digits(found: Column) -> Column:
    return F.regexp_replace(found, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    places = F.sequence(F.lit(0), F.length(digits) - 1)

    def add(total: Column, i: Column) -> Column:
        digit = F.substring(digits, F.length(digits) - i, F.lit(1)).cast("int")
        twice = digit * (1 + i % 2)
        return total + twice - F.when(twice > 9, 9).otherwise(0)

    return F.aggregate(places, F.lit(0), add) % 10 == 0


def _valid(span: Column) -> Column:
    """The rules of the base spans beyond their patterns."""
    found, digits = span["found"], _digits(span["found"])
    small = r"0*+(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{0,2})"
    return (
        F.when(span["kind"] == 0, F.lit(True))
        .when(span["kind"] == 1, found.rlike(rf"^{small}(?:\.{small}){{3}}$"))
        .when(span["kind"] == 2, _luhn(digits))
        .otherwise(F.length(digits).between(9, 15))
    )


def with_candidates(docs: DataFrame) -> DataFrame:
    """(doc_id, text, base, candidates): base spans, and every proposed span by kind."""
    none = F.array().cast(_SPAN)
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    gates = {k: F.col("text").rlike(GATE[k]) for k in KINDS}
    strict = {k: F.when(gates[k], _matches(F.col("text"), k, BASE[k], 0)).otherwise(none) for k in KINDS}
    loose = {k: F.when(gates[k], _matches(F.col("text"), k, LOOSE[k], 1)).otherwise(none) for k in KINDS}
    rows = rows.select("*", F.concat(*strict.values()).alias("strict"), F.concat(*loose.values()).alias("loose"))
    return rows.select(
        "doc_id", "text", F.filter("strict", _valid).alias("base"), F.concat("strict", "loose").alias("candidates")
    )


def _bin(value: Column, borders: tuple) -> Column:
    return sum(((value >= b).cast("int") for b in borders), F.lit(0))


def _holds(text: Column, part: str) -> Column:
    return F.contains(text, F.lit(part)).cast("int")


FEATURES: dict[str, Callable[[Column], Column]] = {
    "kind": lambda s: s["kind"],
    "loose": lambda s: s["loose"],
    "digits": lambda s: _bin(F.length(_digits(s["found"])), (1, 7, 10, 13, 17)),
    "size": lambda s: _bin(s["stop"] - s["start"], (8, 16, 20, 30)),
    "left": lambda s: s["left"],
    "right": lambda s: s["right"],
    "separators": lambda s: F.least(F.lit(3), sum((_holds(s["found"], c) for c in (" ", "-", ".", "(")), F.lit(0))),
    "plus": lambda s: _holds(s["found"], "+"),
    "at": lambda s: _holds(s["found"], "@"),
}


def _described(spans: str) -> Column:
    """Candidates with their features and whether a word announces them."""

    def describe(span: Column) -> Column:
        features = [make(span).cast("int").alias(name) for name, make in FEATURES.items()]
        return F.struct(span["start"].alias("start"), span["stop"].alias("stop"), span["cue"].alias("cue"), *features)

    return F.transform(spans, describe)


def feature_counts(found: DataFrame) -> tuple[list[dict], list[float]]:
    """Announced and all candidates of every combination of features, in both folds, a bounded table; and for each kind
    the share of base spans that are announced."""
    fold = F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(5)) == 0
    each = found.where(F.size("candidates") > 0).select(
        fold.alias("fold"), F.inline(F.concat(*[F.transform(_described(c), lambda s, b=b: F.struct(F.lit(b).alias("base"), s.alias("s"))) for b, c in ((False, "candidates"), (True, "base"))]))
    ).select("fold", "base", "s.*")
    counts = each.groupBy("base", *FEATURES).agg(
        F.count_if(~F.col("fold")).alias("seen"),
        F.count_if(~F.col("fold") & (F.col("cue") == 1)).alias("positive"),
        F.count_if("fold").alias("held"),
        F.count_if(F.col("fold") & (F.col("cue") == 1)).alias("held_positive"),
    )
    rows = [r.asDict() for r in counts.orderBy("base", *FEATURES).collect()]
    shares = []
    for kind in range(len(KINDS)):
        base = [r for r in rows if r["base"] and r["kind"] == kind]
        told, all_ = sum(r["positive"] + r["held_positive"] for r in base), sum(r["seen"] + r["held"] for r in base)
        # one more of each, so that a kind without base spans has a share too
        shares.append((told + 1) / (all_ + 2))
    return [r for r in rows if not r["base"]], shares


class Boosted:
    """Boosted regression trees for the log-odds, fitted to counted combinations of features."""

    def __init__(self, cells: list[dict], rounds: int = ROUNDS, depth: int = DEPTH):
        self.trees = []
        cells = [c for c in cells if c["seen"]]
        margin = [0.0] * len(cells)
        for _ in range(rounds if cells else 0):
            slopes = []
            for cell, m in zip(cells, margin):
                p = 1 / (1 + math.exp(-m))
                slopes.append((cell["positive"] - cell["seen"] * p, cell["seen"] * p * (1 - p)))
            tree = self._grow(cells, slopes, list(range(len(cells))), depth)
            self.trees.append(tree)
            margin = [m + self._value(tree, c) for m, c in zip(margin, cells)]

    def _grow(self, cells, slopes, rows, depth):
        g, h = sum(slopes[i][0] for i in rows), sum(slopes[i][1] for i in rows)
        leaf = RATE * g / (h + 1.0)
        best, choice = 1e-6, None
        for name in FEATURES if depth else ():
            by_value = {}
            for i in rows:
                a, b = by_value.get(cells[i][name], (0.0, 0.0))
                by_value[cells[i][name]] = a + slopes[i][0], b + slopes[i][1]
            low_g = low_h = 0.0
            for value in sorted(by_value)[:-1]:
                low_g, low_h = low_g + by_value[value][0], low_h + by_value[value][1]
                gain = low_g**2 / (low_h + 1) + (g - low_g) ** 2 / (h - low_h + 1) - g**2 / (h + 1)
                if gain > best:
                    best, choice = gain, (name, value)
        if choice is None:
            return leaf
        name, value = choice
        low = [i for i in rows if cells[i][name] <= value]
        high = [i for i in rows if cells[i][name] > value]
        return name, value, self._grow(cells, slopes, low, depth - 1), self._grow(cells, slopes, high, depth - 1)

    def _value(self, tree, cell) -> float:
        while isinstance(tree, tuple):
            name, value, low, high = tree
            tree = low if cell[name] <= value else high
        return tree

    def margin(self, cell: dict) -> float:
        return sum(self._value(t, cell) for t in self.trees)

    def column(self, features: Column) -> Column:
        """The margin as an expression over a struct of features."""

        def expression(tree) -> Column:
            if not isinstance(tree, tuple):
                return F.lit(float(tree))
            name, value, low, high = tree
            return F.when(features[name] <= value, expression(low)).otherwise(expression(high))

        return sum((expression(t) for t in self.trees), F.lit(0.0))


def thresholds(model: Boosted, cells: list[dict], shares: list[float], precision: float = PRECISION) -> list[float]:
    """For each kind the lowest margin at which the held fold's probability is the precision; infinite if none has."""
    out = []
    for kind in range(len(KINDS)):
        by_margin = {}
        for c in cells:
            if c["kind"] == kind and c["held"]:
                key = round(model.margin(c), 9)
                n, p = by_margin.get(key, (0, 0))
                by_margin[key] = n + c["held"], p + c["held_positive"]
        least, n, p = math.inf, 0, 0
        for margin in sorted(by_margin, reverse=True):
            n, p = n + by_margin[margin][0], p + by_margin[margin][1]
            if p >= precision * max(LEAST_SHARE, shares[kind]) * (n + DOUBT):
                least = margin - 1e-6
        out.append(least)
    return out


_MARK = "array<struct<start:int,stop:int,base:int,score:double,kind:int>>"


def _swept(marks: Column, free: Callable, border: int, move: Callable) -> Column:
    """Marks without the added ones that ``free`` says meet a base span seen before; one pass in the marks' order."""
    begin = F.struct(F.lit(border).alias("border"), F.array().cast(_MARK).alias("out"))

    def step(state: Column, m: Column) -> Column:
        stays = (m["base"] == 1) | free(m, state["border"])
        now = F.when(m["base"] == 1, move(m, state["border"])).otherwise(state["border"])
        return F.struct(now.alias("border"), F.when(stays, F.array_append(state["out"], m)).otherwise(state["out"]).alias("out"))

    return F.aggregate(marks, begin, step, lambda state: state["out"])


def _best_of_overlapping(marks: Column) -> Column:
    """Of sorted marks that overlap in a row the one with the highest score, then the first, then the longest."""
    none = F.lit(None).cast("struct<start:int,stop:int,base:int,score:double,kind:int>")
    begin = F.struct(F.lit(-1).alias("stop"), none.alias("best"), F.array().cast(_MARK).alias("out"))

    def rank(m: Column) -> Column:
        return F.struct((-m["score"]).alias("a"), m["start"].alias("b"), (-m["stop"]).alias("c"), m["kind"].alias("d"))

    def step(state: Column, m: Column) -> Column:
        apart = m["start"] >= state["stop"]
        out = F.when(apart & state["best"].isNotNull(), F.array_append(state["out"], state["best"])).otherwise(state["out"])
        best = F.when(apart | state["best"].isNull() | (rank(m) < rank(state["best"])), m).otherwise(state["best"])
        return F.struct(F.greatest(state["stop"], m["stop"]).alias("stop"), best.alias("best"), out.alias("out"))

    return F.aggregate(marks, begin, step, lambda s: F.when(s["best"].isNull(), s["out"]).otherwise(F.array_append(s["out"], s["best"])))


def spans(docs: DataFrame, precision: float = PRECISION) -> DataFrame:
    """(doc_id, text, base, added): base spans, and the spans that the method adds."""
    found = with_candidates(docs)
    cells, shares = feature_counts(found)
    model = Boosted(cells)
    least = F.array(*[F.lit(t) for t in thresholds(model, cells, shares, precision)])

    def mark(base: int, score: Callable) -> Callable:
        return lambda c: F.struct(c["start"].alias("start"), c["stop"].alias("stop"), F.lit(base).alias("base"), score(c).alias("score"), c["kind"].alias("kind"))

    chosen = F.filter(F.transform(_described("candidates"), mark(0, model.column)), lambda c: c["score"] >= least[c["kind"]])
    found = found.select("doc_id", "text", "base", F.array_distinct(chosen).cast(_MARK).alias("chosen"))
    marks = F.array_sort(F.concat(F.transform("base", mark(1, lambda c: F.lit(0.0))).cast(_MARK), "chosen"))
    # base spans that start before, then those that start after
    once = _swept(marks, lambda m, stop: m["start"] >= stop, -1, lambda m, stop: F.greatest(stop, m["stop"]))
    twice = _swept(F.reverse(once), lambda m, start: m["stop"] <= start, 2**31 - 1, lambda m, start: F.least(start, m["start"]))
    added = _best_of_overlapping(F.reverse(F.filter(twice, lambda m: m["base"] == 0)))
    return found.select("doc_id", "text", "base", F.when(F.size("chosen") > 0, added).otherwise(F.array().cast(_MARK)).alias("added"))


def _written(found: Column) -> Column:
    """``kind:start:end`` of spans, by kind and start."""
    order = F.array_sort(F.transform(found, lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["stop"].alias("stop"))))
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(order, lambda s: F.concat_ws(":", names[s["kind"]], s["start"].cast("string"), s["stop"].cast("string"))), ",")


def _places(found: Column) -> Column:
    return F.transform(found, lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["stop"].alias("stop")))


def report(docs: DataFrame) -> DataFrame:
    """Counts of base spans by kind, the digest of the base spans, and all spans of each document."""
    found = spans(docs)
    kinds = F.transform("base", lambda s: s["kind"])
    counts = [F.size(F.array_remove(kinds, k)) for k in range(len(KINDS))]
    counts = [(F.size("base") - others).cast("long").alias(f"n_{name}") for others, name in zip(counts, KINDS)]
    every = F.concat(_places(F.col("base")), _places(F.col("added")))
    return found.select(
        "doc_id", *counts, F.sha2(_written(F.col("base")), 256).alias("base_sha256"), _written(every).alias("spans")
    )


def redacted(docs: DataFrame) -> DataFrame:
    """(doc_id, text): texts with every span replaced by its kind in angle brackets."""
    found = spans(docs)
    every = F.array_sort(F.transform(
        F.concat(_places(F.col("base")), _places(F.col("added"))),
        lambda s: F.struct(s["start"].alias("start"), s["stop"].alias("stop"), s["kind"].alias("kind")),
    ))
    names = F.array(*[F.lit(k) for k in KINDS])
    begin = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))

    def step(state: Column, s: Column) -> Column:
        gap = F.substring(F.col("text"), state["at"] + 1, F.greatest(F.lit(0), s["start"] - state["at"]))
        return F.struct(
            F.concat(state["out"], gap, F.lit("<"), names[s["kind"]], F.lit(">")).alias("out"), F.greatest(state["at"], s["stop"]).alias("at")
        )

    rest = lambda state: F.concat(state["out"], F.substring(F.col("text"), state["at"] + 1, F.length("text")))
    return found.select("doc_id", F.aggregate(every, begin, step, rest).alias("text"))
