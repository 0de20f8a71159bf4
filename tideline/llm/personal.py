"""Personal data in texts: base patterns, and candidates scored by boosted trees.

All work on rows is DataFrame expressions. Base spans come from one pattern a kind with a
check of each match (`BASE`). Beside them, generators of high recall (`CANDIDATES`)
propose spans that may overlap base matches that failed as a whole, such as a telephone
number followed by a card number. Every candidate gets a few small whole-number features
of its format and of the characters beside it.

Training. A candidate is a positive if it is a base span, and undecided if it lies in a
longer run that the base pattern takes as one match; other candidates are negatives.
Counts of the feature rows are made over all texts in one grouping. The features are small
codes, so these counts have at most a few thousand rows whatever the input, and boosted
regression trees on the log loss are grown from them. Half of the texts, by a hash, give
the counts that trees are grown on and the other half those that calibrate: for every kind
the threshold is the lowest score from which on at least `PRECISION` of the decided
candidates are positives, by a lower confidence bound. The trees become SQL expressions.

Candidates at or above the threshold that meet no base span are added, of overlapping ones
the higher score, then the longer, then the earlier. Base spans always stay. Offsets are
code points, ends exclusive.

Defined results. Null is the empty text and has no spans. Long texts are searched whole. Rows
that repeat get the same spans each, and count each in training. Without any positive, as in
an empty table, there are no trees and only base spans. Further columns stay; helper columns
take names that the table does not have.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
TREES, DEPTH, RATE, PRECISION = 12, 3, 0.5, 0.9

#: What every match of a kind has in it: cheap tests before the patterns.
GATES = {
    "email": lambda text: F.contains(text, F.lit("@")) | text.rlike(r"(?i)[(\[{ ]at[)\]} ]"),
    "ip": lambda text: text.rlike(r"[0-9]\.[0-9]"),
    "card": lambda text: text.rlike(r"[0-9](?:[ -]?[0-9]){12}"),
    "phone": lambda text: text.rlike(r"\+[0-9]|[0-9][ ().-]{0,2}[0-9]{3}"),
}

#: The base patterns. Possessive loops and the look-behinds (a match may
#: begin where the one before ended, or not inside a run) keep long runs linear.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
OCTET = r"0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9][0-9]?)?"
CANDIDATES = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+(?:@| ?[(\[{]at[)\]}] ?| at )[A-Za-z0-9-]{1,63}+"
    r"(?:(?:\.| ?[(\[{]dot[)\]}] ?| dot )[A-Za-z0-9-]{1,63}+){1,8}+",
    "ip": r"(?<![0-9])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9])",
    "card": r"(?<![0-9])(?:[0-9]{13,19}|[0-9]{4}(?:[ -][0-9]{4}){3}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})(?![0-9])",
    "phone": r"(?<![0-9])(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{2,4}\) ?|[0-9]{2,4}[ .-])[0-9]{3,4}[ .-]?[0-9]{3,4}(?![0-9])",
}
#: A candidate with such characters beside it lies in a longer base match.
RUNS_ON = {
    "email": (r"[A-Za-z0-9._%+-]$", r"^[A-Za-z0-9-]|^\.[A-Za-z0-9-]"),
    "ip": (r"[0-9]\.?$", r"^\.?[0-9]"),
    "card": (r"[0-9][ -]?$", r"^[ -]?[0-9]"),
    "phone": (r"[0-9][ ().-]*$", r"^[ ().-]*[0-9]"),
}
SPAN = "array<struct<start:int,end:int,value:string>>"
FEATURES = ("kind", "digits", "valid", "plus", "marks", "before", "after")


@dataclass
class Model:
    """Trees as nested tuples (feature, cut, left, right) or leaf values, and thresholds."""

    trees: list = field(default_factory=list)
    thresholds: dict[str, float] = field(default_factory=dict)


def matches(text: Column, pattern: str) -> Column:
    """All matches of the pattern as (start, end, value), leftmost and not overlapping.
    The texts between the matches give the offsets."""
    parts = F.arrays_zip(
        F.split(text, pattern, -1).alias("gap"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hit")
    )
    empty = F.struct(F.lit(0).alias("at"), F.array().cast(SPAN).alias("out"))

    def add(done: Column, part: Column) -> Column:
        start = done["at"] + F.length(part["gap"])
        end = start + F.coalesce(F.length(part["hit"]), F.lit(0))
        span = F.struct(start.alias("start"), end.alias("end"), part["hit"].alias("value"))
        more = F.when(part["hit"].isNull(), done["out"]).otherwise(F.concat(done["out"], F.array(span)))
        return F.struct(end.alias("at"), more.alias("out"))

    return F.aggregate(parts, empty, add, lambda done: done["out"])


def digits_of(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether the digits, 1 to 19 of them, pass the checksum."""
    def add(total: Column, i: Column) -> Column:
        digit = F.substring(digits, i, F.lit(1)).cast("int")
        doubled = digit * 2
        folded = F.when(doubled > 9, doubled - 9).otherwise(doubled)
        return total + F.when((F.length(digits) - i) % 2 == 1, folded).otherwise(digit)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def valid(kind: str, value: Column) -> Column:
    """The check that a match of the kind's base pattern must pass."""
    if kind == "ip":
        return value.rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$")
    if kind == "card":
        digits = digits_of(value)
        return F.when(F.length(digits).between(13, 19), luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(digits_of(value)).between(9, 15)
    return F.lit(True)


def _gated(kind: str, text: Column, found: Column) -> Column:
    return F.when(GATES[kind](text), found).otherwise(F.array().cast(SPAN))


def base_spans(kind: str, text: Column) -> Column:
    return _gated(kind, text, F.filter(matches(text, BASE[kind]), lambda s: valid(kind, s["value"])))


def _class(char: Column) -> Column:
    """A character beside a candidate: 0 none, 1 white space, 2 letter, 3 digit, 4 other."""
    return (
        F.when(char == "", 0).when(char.rlike(r"^\s"), 1).when(char.rlike(r"^\p{L}"), 2).when(char.rlike("^[0-9]"), 3)
    ).otherwise(4)


def candidates(kind: str, text: Column, base: Column) -> Column:
    """The kind's candidates with features, `positive` and `undecided`."""
    keys = F.transform(base, lambda s: s["start"].cast("long") * 2**31 + s["end"])

    def described(span: Column) -> Column:
        start, end, value = span["start"], span["end"], span["value"]
        before = F.substring(text, F.greatest(start - 3, F.lit(1)), F.least(start, F.lit(4)))
        after = F.substring(text, end + 1, F.lit(4))
        left, right = RUNS_ON[kind]
        plain = F.contains(value, F.lit("@")) if kind == "email" else F.lit(True)
        positive = F.array_contains(keys, start.cast("long") * 2**31 + end)
        undecided = ~positive & (before.rlike(left) | after.rlike(right) | ~plain)
        marks = F.length(F.regexp_replace(value, "[A-Za-z0-9]", ""))
        return F.struct(
            start.alias("start"),
            end.alias("end"),
            positive.alias("positive"),
            undecided.alias("undecided"),
            F.lit(KINDS.index(kind)).alias("kind"),
            F.least(F.length(digits_of(value)), F.lit(20)).alias("digits"),
            valid(kind, value).cast("int").alias("valid"),
            value.startswith("+").cast("int").alias("plus"),
            F.least(marks, F.lit(8)).alias("marks"),
            _class(F.substring(before, -1, 1)).alias("before"),
            _class(F.substring(after, 1, 1)).alias("after"),
        )

    return F.transform(_gated(kind, text, matches(text, CANDIDATES[kind])), described)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names like these that the table does not have."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def _described(docs: DataFrame, text: str) -> tuple[DataFrame, str, str]:
    """`docs` with the base spans of each kind (an array by kind) and all candidates."""
    base, proposed = fresh(docs, "base_spans", "proposed_spans")
    body = F.coalesce(F.col(text), F.lit(""))
    found = docs.withColumn(base, F.struct(*[base_spans(k, body).alias(k) for k in KINDS]))
    every = F.concat(*[candidates(k, body, F.col(base)[k]) for k in KINDS])
    return found.withColumn(proposed, every), base, proposed


def train(docs: DataFrame, text: str = "text") -> Model:
    """Trees and thresholds from the candidates of all texts."""
    (half,) = fresh(docs, "half")
    found, _, proposed = _described(docs.select(text), text)
    shown = found.select(
        (F.pmod(F.xxhash64(text), F.lit(2)) == 0).alias(half), F.explode(proposed).alias("c")
    ).where("not c.undecided")
    counted = shown.groupBy(half, *[F.col(f"c.{f}").alias(f) for f in FEATURES]).agg(
        F.count("*").alias("n"), F.sum(F.col("c.positive").cast("long")).alias("positives")
    )
    rows = sorted(tuple(r) for r in counted.collect())  # bounded by the features' codes
    table = np.array(rows, float).reshape(-1, len(FEATURES) + 3)
    grown, kept = table[table[:, 0] == 1], table[table[:, 0] == 0]
    if not len(grown) or not len(kept):
        grown = kept = table
    return _grow(grown, kept)


def _grow(grown: np.ndarray, kept: np.ndarray) -> Model:
    x, n, hits = grown[:, 1:-2], grown[:, -2], grown[:, -1]
    if not hits.sum():
        return Model()
    score, trees = np.zeros(len(x)), []
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-score))
        tree = _tree(x, hits - n * p, n * p * (1 - p), DEPTH)
        trees.append(tree)
        score += _values(tree, x)
    thresholds = {}
    at = sum(_values(t, kept[:, 1:-2]) for t in trees) if len(kept) else np.zeros(0)
    for k, kind in enumerate(KINDS):
        own = kept[:, 1] == k if len(kept) else np.zeros(0, bool)
        for cut in np.unique(at[own]):
            above = own & (at >= cut)
            total, good = kept[above, -2].sum(), kept[above, -1].sum()
            share = good / total
            if share - 1.64 * np.sqrt(share * (1 - share) / total) >= PRECISION:
                thresholds[kind] = float(cut)
                break
    return Model(trees, thresholds)


def _tree(x: np.ndarray, slope: np.ndarray, curve: np.ndarray, depth: int):
    """A regression tree on second-order gains, with leaf values already scaled."""
    leaf = round(float(RATE * slope.sum() / (curve.sum() + 1.0)), 6)
    if depth == 0 or len(x) < 2:
        return leaf
    best, at = 1e-9, None
    whole = slope.sum() ** 2 / (curve.sum() + 1.0)
    for f in range(x.shape[1]):
        for cut in np.unique(x[:, f])[1:]:
            low = x[:, f] < cut
            gain = -whole
            for side in (low, ~low):
                gain += slope[side].sum() ** 2 / (curve[side].sum() + 1.0)
            if gain > best:
                best, at = gain, (f, float(cut))
    if at is None:
        return leaf
    low = x[:, at[0]] < at[1]
    parts = [_tree(x[s], slope[s], curve[s], depth - 1) for s in (low, ~low)]
    return (*at, *parts)


def _values(tree, x: np.ndarray) -> np.ndarray:
    if not isinstance(tree, tuple):
        return np.full(len(x), tree)
    f, cut, left, right = tree
    return np.where(x[:, f] < cut, _values(left, x), _values(right, x))


def _expression(tree, span: Column) -> Column:
    if not isinstance(tree, tuple):
        return F.lit(float(tree))
    f, cut, left, right = tree
    return F.when(span[FEATURES[f]] < cut, _expression(left, span)).otherwise(_expression(right, span))


def with_spans(docs: DataFrame, model: Model, text: str = "text") -> tuple[DataFrame, str, str]:
    """`docs` with two more columns, whose names follow: the base spans, and the spans
    that the trees add, as arrays of (kind, start, end) by kind and start. `kind` is a
    place in `KINDS`."""
    found, base, proposed = _described(docs, text)
    columns = docs.columns
    plain, added = fresh(found, "base", "added")
    shape = "array<struct<kind:int,start:int,end:int>>"

    def numbered(k: int) -> Column:
        return F.transform(F.col(base)[KINDS[k]], lambda s: F.struct(F.lit(k), s["start"], s["end"]))

    all_base = F.concat(*[numbered(k).cast(shape) for k in range(len(KINDS))])
    found = found.withColumn(plain, all_base)
    if not model.trees or not model.thresholds:
        return found.select(*columns, plain, F.array().cast(shape).alias(added)), plain, added
    def rated(s: Column) -> Column:
        score = sum((_expression(t, s) for t in model.trees), F.lit(0.0))
        return F.struct(score.alias("score"), s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"))

    def chosen(s: Column) -> Column:
        cut = F.lit(float("inf"))
        for k, kind in enumerate(KINDS):
            if kind in model.thresholds:
                cut = F.when(s["kind"] == k, model.thresholds[kind]).otherwise(cut)
        free = ~F.exists(F.col(plain), lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))
        return (s["score"] >= cut) & free

    def better(a: Column, b: Column) -> Column:
        """Whether b goes before a; b does not begin before a."""
        longer = (b["end"] - b["start"]) > (a["end"] - a["start"])
        return (b["score"] > a["score"]) | ((b["score"] == a["score"]) & longer)

    kept_type = "array<struct<start:int,end:int,score:double,kind:int>>"

    def sweep(kept: Column, s: Column) -> Column:
        last = F.element_at(kept, -1)
        return (
            F.when(
                (F.size(kept) == 0) | (F.try_element_at(kept, F.lit(-1))["end"] <= s["start"]),
                F.concat(kept, F.array(s)),
            )
            .when(better(last, s), F.concat(F.slice(kept, 1, F.size(kept) - 1), F.array(s)))
            .otherwise(kept)
        )

    rated_column, = fresh(found, "rated")
    in_order = F.array_sort(
        F.transform(
            F.filter(F.transform(F.col(proposed), rated), chosen),
            lambda s: F.struct(s["start"], s["end"], s["score"], s["kind"]),
        ).cast(kept_type)
    )
    found = found.withColumn(rated_column, in_order)
    swept = F.when(F.size(rated_column) == 0, F.array().cast(kept_type)).otherwise(
        F.aggregate(F.col(rated_column), F.array().cast(kept_type), sweep)
    )
    result = F.array_sort(F.transform(swept, lambda s: F.struct(s["kind"], s["start"], s["end"])).cast(shape))
    return found.withColumn(added, result).select(*columns, plain, added), plain, added


def count_of(kind: str, spans: str | Column) -> Column:
    """How many spans are of the kind."""
    return F.size(F.filter(spans, lambda s: s["kind"] == KINDS.index(kind))).cast("long")


def written(spans: Column) -> Column:
    """Spans as kind:start:end, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.concat_ws(
        ",",
        F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])),
    )


def redacted(text: Column, spans: Column) -> Column:
    """The text with each span as its kind in brackets; spans that overlap give one."""
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"], s["end"], s["kind"])))
    begin = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))

    def add(done: Column, s: Column) -> Column:
        apart = s["start"] >= done["at"]
        gap = F.substring(text, done["at"] + 1, s["start"] - done["at"])
        more = F.concat(done["out"], F.array(gap, F.get(names, s["kind"])))
        return F.struct(
            F.greatest(done["at"], s["end"]).alias("at"), F.when(apart, more).otherwise(done["out"]).alias("out")
        )

    whole = F.aggregate(
        ordered,
        begin,
        add,
        lambda done: F.concat(F.array_join(done["out"], ""), F.substring(text, done["at"] + 1, F.length(text))),
    )
    return F.when(F.size(spans) == 0, text).otherwise(whole)
