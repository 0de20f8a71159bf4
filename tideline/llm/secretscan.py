"""Secrets in texts: base patterns, and random-looking strings by character Markov models.

Base spans come from one pattern a kind, kept if long enough. Beside them, each run of
`[A-Za-z0-9+/_.=-]`, or what base spans leave of it, is scored if it has `shortest`
characters or more (an argument) and is no mere number: the log likelihood under the best of several
Markov models of random strings, less that under a model of ordinary identifiers or of one
character repeated, for each character. What reaches the threshold is added as kind `random`; strings without a digit
have a stricter one.

Training. The random models start from strings drawn with a fixed seed over usual
alphabets and learn from the values of base spans, each by the model that fits it best;
the identifier model learns from the other runs of four characters or more, but not from
those long enough to be scored. Both samples come from at most `SAMPLE` texts, those with
base spans and others, chosen by a hash of the text. A threshold is the least that no more
than one in `FALSE` of the sampled ordinary runs would pass, but passed by 99 in 100 drawn
strings, and not under `FLOOR`. For strings without a digit it is the greatest that 99 in 100
drawn strings of small letters, of capitals, and of both pass.

Defined results. Offsets are code points, ends exclusive. Null is the empty text; it has no
spans. Texts are scanned whole, whatever their length. Rows that repeat get the same spans
each; in training equal texts count once. Spans that begin together come by kind. Of an empty
table the drawn strings alone make the models. Further columns are not looked at.
"""

from __future__ import annotations

import random
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.llm.batches import strings
from tideline.llm.storage import stored

SAMPLE = 1000  # texts with base spans, and as many without, that the models learn from
SHORTEST, FALSE, FLOOR = 16, 5000, 0.4

#: Base patterns, and the fewest characters of a match (of its value).
KINDS = ("assign", "access", "hex", "random")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
ACCESS = re.compile("AKIA[A-Z0-9]+")
HEX = re.compile("[0-9a-f]{24,}")
ORDINARY = re.compile("[A-Za-z0-9+/_.=-]{4,}")
MARKED = r"AKIA|[0-9a-f]{24}|(?i:password|passwd|secret|token|api_?key).{0,4}[:=]"
DIGIT = re.compile("[0-9]")
LETTER = re.compile("[A-Za-z]")

SIGNS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-"
LETTERS = (SIGNS[26:52], SIGNS[:26], SIGNS[:52])
ALPHABETS = (
    "0123456789abcdef", "0123456789ABCDEF", SIGNS[:62], SIGNS[:64], SIGNS[:26] + SIGNS[52:62], SIGNS[26:62], *LETTERS
)
_PLACE = np.zeros(128, np.int64)
_PLACE[[ord(c) for c in SIGNS]] = np.arange(1, len(SIGNS) + 1)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of every base span, in order."""
    found = []
    if "=" in text or ":" in text:
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    if DIGIT.search(text) or len(text) >= 24:
        found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def beside(start: int, end: int, spans: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """What spans, in order, leave of start to end."""
    out = []
    for a, _, b in spans:
        if a < end and start < b:
            out.append((start, a))
            start = b
    return [(a, b) for a, b in [*out, (start, end)] if a < b]


@dataclass
class Chains:
    """Log chances [model, sign before, sign]; the last two are of identifiers and of
    repeated signs."""

    logs: np.ndarray
    threshold: float
    letters: float  # the threshold of strings without a digit
    shortest: int = SHORTEST

    def ratios(self, runs: list[str]) -> np.ndarray:
        """The log-likelihood ratio for each character of each run."""
        if not runs:
            return np.zeros(0)
        each = _likelihoods(self.logs, runs)
        sizes = np.fromiter(map(len, runs), float, len(runs))
        return (each[:-2].max(axis=0) - each[-2:].max(axis=0)) / sizes

    def random(self, runs: list[str]) -> np.ndarray:
        """Whether each run reaches the threshold of its kind."""
        digit = np.fromiter((bool(DIGIT.search(r)) for r in runs), bool, len(runs))
        return self.ratios(runs) >= np.where(digit, self.threshold, self.letters)


def _pairs(runs: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Signs and the signs before them (0 at a run's start), and where runs begin."""
    sizes = np.fromiter(map(len, runs), np.int64, len(runs))
    sign = _PLACE[np.frombuffer("".join(runs).encode("ascii"), np.uint8)]
    starts = np.cumsum(sizes) - sizes
    before = np.r_[0, sign[:-1]]
    before[starts] = 0
    return before, sign, starts


def _likelihoods(logs: np.ndarray, runs: list[str]) -> np.ndarray:
    before, sign, starts = _pairs(runs)
    return np.stack([np.add.reduceat(model[before, sign], starts) for model in logs])


def _fitted(runs: list[str], smooth: float) -> np.ndarray:
    """Log chances of each sign after each; what was seldom seen leans on how common the
    sign is anywhere, as if `smooth` times the number of signs had been seen so."""
    size = len(SIGNS) + 1
    counts, alone = np.zeros((size, size)), np.full(size, 0.5)
    if runs:
        before, sign, _ = _pairs(runs)
        np.add.at(counts, (before, sign), 1.0)
        alone += np.bincount(sign, minlength=size)
    alone[0] = 0
    counts += smooth * len(SIGNS) * alone / alone.sum()
    with np.errstate(divide="ignore"):
        return np.log(counts / counts.sum(axis=1, keepdims=True))


def _repeats() -> np.ndarray:
    """Log chances of rulers and padding: in 99 of 100 places the sign before once more."""
    chances = np.full((len(SIGNS) + 1, len(SIGNS) + 1), 0.01 / (len(SIGNS) - 1))
    np.fill_diagonal(chances, 0.99)
    chances[0] = 1 / len(SIGNS)
    return np.log(chances)


def fit(secrets: list[str], ordinary: list[str], shortest: int = SHORTEST) -> Chains:
    """Chains from values of secrets and from ordinary identifiers."""
    draw = random.Random(7)
    drawn = [["".join(draw.choices(a, k=40)) for _ in range(300)] for a in ALPHABETS]
    logs = np.stack([_fitted(group, 0.05) for group in drawn])
    if secrets:
        best = _likelihoods(logs, secrets).argmax(axis=0)
        logs = np.stack([_fitted(g + [s for s, b in zip(secrets, best) if b == n], 0.05) for n, g in enumerate(drawn)])
    identifiers = _fitted([o for o in ordinary if len(o) < shortest], 0.5)
    chains = Chains(np.concatenate([logs, identifiers[None], _repeats()[None]]), FLOOR, FLOOR, shortest)
    judged = [o for o in ordinary if len(o) >= shortest]
    long = [o for o in judged if DIGIT.search(o)]
    if long:
        # Some of these may be random themselves: drawn strings bound the threshold from above.
        ratios = np.sort(chains.ratios(long))
        high = ratios[max(0, len(ratios) - 1 - len(ratios) // FALSE)]
        random_low = np.quantile(chains.ratios([s[:shortest] for g in drawn for s in g if DIGIT.search(s)]), 0.01)
        chains.threshold = float(max(FLOOR, min(high, random_low)))
    # Words alone have no digit either, so these must look as random as drawn letters do.
    words = [chains.ratios(["".join(draw.choices(a, k=shortest)) for _ in range(1000)]) for a in LETTERS]
    chains.letters = float(max(FLOOR, min(np.quantile(own, 0.01) for own in words)))
    return chains


def train(docs: DataFrame, text: str = "text", shortest: int = SHORTEST) -> Chains:
    """Chains from texts of the table, base spans being the labels."""
    body = docs.select(F.col(text).alias("text")).where(F.col(text).isNotNull())
    body = body.withColumn("hash", F.xxhash64("text"))
    marked = F.col("text").rlike(MARKED)
    kinds = stored(body.select("hash", marked.alias("marked")).distinct(), "text-kinds")
    parts = [kinds.where(F.col("marked") == has).orderBy("hash").limit(SAMPLE) for has in (True, False)]
    picked = F.broadcast(parts[0].union(parts[1]).select("hash"))  # 2 x SAMPLE rows at most
    rows = body.join(picked, "hash", "left_semi").groupBy("hash").agg(F.min("text").alias("text"))
    secrets, ordinary = [], []
    for row in rows.orderBy("hash").collect():
        spans = base_spans(row.text)
        for start, kind, end in spans:
            part = row.text[start:end]
            secrets.append(ASSIGN.fullmatch(part).group(2) if kind == 0 else part)
        ordinary += [
            m.group()
            for m in ORDINARY.finditer(row.text)
            if not any(a < m.end() and m.start() < b for a, _, b in spans)
        ]
    return fit(secrets, ordinary, shortest)


FORM = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())]))


def secrets(text: str | Column, chains: Chains) -> Column:
    """Array of (start, kind, end), in order; `kind` is a place in `KINDS`."""

    run = "[A-Za-z0-9+/_.=-]{%d,}" % chains.shortest

    @F.arrow_udf("array<struct<start int, kind int, end int>>")
    def scan(column: pa.Array) -> pa.Array:
        rows, runs, where = [], [], []
        for n, body in enumerate(strings(column)):
            found = base_spans(body)
            rows.append(found)
            for m in re.finditer(run, body):
                for start, end in beside(m.start(), m.end(), found):
                    if end - start >= chains.shortest and LETTER.search(body, start, end):
                        runs.append(body[start:end])
                        where.append((n, start, end))
        for (n, start, end), is_random in zip(where, chains.random(runs).tolist()):
            if is_random:
                rows[n].append((start, 3, end))
        return pa.array([[{"start": a, "kind": k, "end": b} for a, k, b in sorted(r)] for r in rows], FORM)

    return scan.asNondeterministic()(text)


def written(spans: Column) -> Column:
    """Spans as kind:start:end, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])))


def count_of(kind: str, spans: str | Column) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == KINDS.index(kind))).cast("long")
