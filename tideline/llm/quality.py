"""Quality of documents: rules, and boosted trees over their statistics.

Statistics of a text are counts and shares of words, symbols, lines and repeats. The rules
are the base: a text fails with fewer than `FEWEST` words, or with more than
`MOST_REPEATED` percent of its words in repeated 8-word windows. Trees of fixed depth are
grown on the log loss from labelled texts with second-order gains; statistics in `RISING`
and `FALLING` can only raise or lower the score, which each split keeps by bounding the
leaf values below it. The grown trees are flattened into arrays of nodes (feature, cut,
children), and all texts of a batch walk all trees one level at a time.

At most `SAMPLE` labelled texts a class are learnt from, chosen by a hash of their id.
Their statistics are taken in tasks; only these go to the driver.

Defined results. Words are runs of characters other than space and tab to carriage return.
Null and empty texts have no words and fail the rules. Very long texts are measured whole.
Rows that repeat get the same result each; in learning equal texts count once, with the
least of their labels. Equal gains go to the first statistic and the least cut. Without
labels of both kinds, as with empty tables, the rules alone decide. Further columns are not
looked at.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.llm.batches import chunks, list_array, strings
from tideline.llm.hashing import run_hashes, step

FEWEST, MOST_REPEATED, WINDOW = 20, 30, 8
SAMPLE = 2000
TREES, DEPTH, RATE, BINS, RIDGE = 40, 4, 0.3, 32, 2.0
SYMBOLS = b"#*$%&|<>"

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
STATISTICS = (
    "log_words", "mean_word", "symbols_per_word", "dup_line_share", "repeat_share", "upper_share",
    "digit_share", "punctuated_share", "distinct_share", "top_word_share", "words_per_line", "symbol_word_share",
)
#: Statistics that may only lower the score, or only raise it.
FALLING = ("symbols_per_word", "repeat_share", "dup_line_share", "symbol_word_share")
RISING = ("distinct_share",)

_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(SYMBOLS)] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_END = np.zeros(256, bool)
_END[list(b".,;:!?")] = True
_WORD = re.compile("[^\\x20\\x09-\\x0D]")


def statistics(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The counts and the statistics of each text, a row a text."""
    n = len(texts)
    coded = [t.encode("utf-8", "replace") for t in texts]
    sizes = np.fromiter(map(len, coded), np.int64, n) + 1
    data = np.frombuffer(b"\n".join(coded) + b"\n", np.uint8)
    ends = np.cumsum(sizes)
    inside = ~_SPACE[data]
    edge = np.diff(inside.astype(np.int8), prepend=0)
    starts = np.flatnonzero(edge == 1)
    lengths = np.flatnonzero(edge == -1) - starts
    owner = np.searchsorted(ends, starts, side="right")
    words = np.bincount(owner, minlength=n)
    hashes = run_hashes(data, starts, lengths)

    def per_text(flags: np.ndarray) -> np.ndarray:
        upto = np.r_[0, np.cumsum(flags)]
        return upto[ends] - upto[ends - sizes]

    chars = per_text(inside & ((data & 0xC0) != 0x80))
    symbols = per_text(_SYMBOL[data])
    repeats = _repeat_words(hashes, owner, words)
    duplicates, lines = np.zeros(n, np.int64), np.ones(n, np.int64)
    for i, text in enumerate(texts):
        if "\n" in text:
            full = [line for line in text.split("\n") if _WORD.search(line)]
            duplicates[i] = len(full) - len(set(full))
            lines[i] = max(1, len(full))
    order = np.lexsort((hashes, owner))
    new = np.ones(len(order), bool)
    new[1:] = (hashes[order][1:] != hashes[order][:-1]) | (owner[order][1:] != owner[order][:-1])
    at = np.flatnonzero(new)
    often = np.diff(at, append=len(order))
    distinct = np.bincount(owner[order][at], minlength=n)
    top = np.zeros(n, np.int64)
    np.maximum.at(top, owner[order][at], often)
    ended = np.bincount(owner, _END[data[starts + lengths - 1]], minlength=n) if len(starts) else np.zeros(n)
    marked = np.bincount(owner, _SYMBOL[data[starts + lengths - 1]], minlength=n) if len(starts) else np.zeros(n)
    some, letters = np.maximum(words, 1), np.maximum(chars, 1)
    counts = np.column_stack([words, chars, symbols, duplicates, repeats])
    table = np.column_stack(
        [
            np.log1p(words), chars / some, symbols / some, duplicates / lines, repeats / some,
            per_text(_UPPER[data]) / letters, per_text(_DIGIT[data]) / letters, ended / some, distinct / some,
            top / some, words / lines, marked / some,
        ]
    )
    return counts, table


def _repeat_words(hashes: np.ndarray, owner: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Words of each text that lie in a window of words found twice or more in the text."""
    many = np.maximum(words - WINDOW + 1, 0)
    text = np.repeat(np.arange(len(words)), many)
    at = np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many) + (np.cumsum(words) - words)[text]
    value = np.zeros(len(at), np.uint64)
    for j in range(WINDOW):
        value += hashes[at + j] * step(j + 1)
    order = np.lexsort((value, text))
    same = (value[order][1:] == value[order][:-1]) & (text[order][1:] == text[order][:-1])
    twice = np.zeros(len(at), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    cover = np.zeros(len(hashes) + 1, np.int64)
    np.add.at(cover, at[twice], 1)
    np.add.at(cover, at[twice] + WINDOW, -1)
    covered = np.cumsum(cover)[:-1] > 0
    return np.bincount(owner[covered], minlength=len(words))


@dataclass
class Forest:
    """Nodes of all trees: feature (-1 for a leaf), cut, the children, and the value."""

    roots: np.ndarray
    feature: np.ndarray
    cut: np.ndarray
    low: np.ndarray
    high: np.ndarray
    value: np.ndarray
    start: float

    def score(self, table: np.ndarray) -> np.ndarray:
        """The chance of good quality of each row."""
        total = np.full(len(table), self.start)
        if len(self.roots):
            at = np.tile(self.roots, (len(table), 1))
            rows = np.arange(len(table))[:, None]
            for _ in range(DEPTH):
                feature = self.feature[at]
                goes = table[rows, np.maximum(feature, 0)] < self.cut[at]
                at = np.where(feature < 0, at, np.where(goes, self.low[at], self.high[at]))
            total += self.value[at].sum(axis=1)
        return 1 / (1 + np.exp(-total))


def grow(table: np.ndarray, good: np.ndarray) -> Forest:
    """A forest from labelled statistics."""
    nodes: list[list[float]] = []
    roots: list[int] = []
    share = (good.sum() + 1) / (len(good) + 2)
    start = float(np.log(share / (1 - share)))
    if good.any() and not good.all():
        cuts = [np.unique(np.quantile(column, np.linspace(0, 1, BINS + 1)[1:-1])) for column in table.T]
        binned = np.column_stack([np.searchsorted(c, column, side="right") for c, column in zip(cuts, table.T)])
        sign = np.array([(s in RISING) - (s in FALLING) for s in STATISTICS])
        score = np.full(len(good), start)
        for _ in range(TREES):
            p = 1 / (1 + np.exp(-score))
            roots.append(len(nodes))
            _grow_node(nodes, binned, cuts, sign, good - p, p * (1 - p), np.arange(len(good)), DEPTH, -4.0, 4.0, score)
    flat = np.array(nodes, float).reshape(-1, 5).T
    return Forest(
        np.array(roots, np.int64), flat[0].astype(np.int64), flat[1], flat[2].astype(np.int64),
        flat[3].astype(np.int64), flat[4], start,
    )


def _leaf(slope: float, curve: float, least: float, most: float) -> float:
    return float(np.clip(slope / (curve + RIDGE), least, most))


def _grow_node(nodes, binned, cuts, sign, slope, curve, rows, depth, least, most, score) -> int:
    """Appends the best subtree for the rows; leaves also move the rows' scores."""
    own = len(nodes)
    nodes.append([-1, 0.0, 0, 0, 0.0])
    g, h = slope[rows].sum(), curve[rows].sum()
    value = _leaf(g, h, least, most)
    best = (1e-6, None)
    if depth:
        for f in range(binned.shape[1]):
            if not len(cuts[f]):
                continue
            gs = np.cumsum(np.bincount(binned[rows, f], slope[rows], len(cuts[f]) + 1))[:-1]
            hs = np.cumsum(np.bincount(binned[rows, f], curve[rows], len(cuts[f]) + 1))[:-1]
            left, right = gs / (hs + RIDGE), (g - gs) / (h - hs + RIDGE)
            gain = gs**2 / (hs + RIDGE) + (g - gs) ** 2 / (h - hs + RIDGE) - g**2 / (h + RIDGE)
            wrong = ((right - left) * sign[f] < 0) | (hs < 1.0) | (h - hs < 1.0)
            gain[wrong] = -1
            if gain.max() > best[0]:
                best = (gain.max(), (f, int(gain.argmax())))
    if best[1] is None:
        nodes[own][4] = RATE * value
        score[rows] += RATE * value
        return own
    f, at = best[1]
    goes = binned[rows, f] <= at
    sides = rows[goes], rows[~goes]
    middle = np.mean([_leaf(slope[r].sum(), curve[r].sum(), least, most) for r in sides])
    bounds = {0: ((least, most), (least, most)), 1: ((least, middle), (middle, most)), -1: ((middle, most), (least, middle))}
    low, high = bounds[int(sign[f])]
    nodes[own][:2] = [f, float(cuts[f][at])]
    nodes[own][2] = _grow_node(nodes, binned, cuts, sign, slope, curve, sides[0], depth - 1, *low, score)
    nodes[own][3] = _grow_node(nodes, binned, cuts, sign, slope, curve, sides[1], depth - 1, *high, score)
    return own


def train(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", good: str = "quality") -> Forest:
    """A forest from labelled documents; of several labels of a document the least counts."""
    kinds = labels.where(F.col(id).isNotNull() & F.col(good).isNotNull())
    kinds = kinds.groupBy(F.col(id).alias("id")).agg(F.min(F.col(good).cast("int")).alias("label"))
    chosen = [kinds.where(F.col("label") == v).orderBy(F.xxhash64("id"), "id").limit(SAMPLE) for v in (0, 1)]
    picked = F.broadcast(chosen[0].union(chosen[1]))  # 2 x SAMPLE rows at most
    rows = docs.select(F.col(id).alias("id"), F.col(text).alias("text")).join(picked, "id")
    texts = rows.groupBy("text").agg(F.min("label").alias("label"))
    measured = texts.select(F.xxhash64("text").alias("key"), "label", _statistics_of("text").alias("row"))
    found = sorted((r.key, r.label, r.row) for r in measured.collect())  # a few numbers a text
    table = np.array([row for _, _, row in found], float).reshape(-1, len(STATISTICS))
    return grow(table, np.array([label == 1 for _, label, _ in found], bool))


def _statistics_of(text: str | Column) -> Column:
    @F.arrow_udf("array<double>")
    def measure(column: pa.Array) -> pa.Array:
        parts = [pa.array([], pa.list_(pa.float64()))]
        for texts in chunks(strings(column)):
            table = statistics(texts)[1].astype(np.float64)
            parts.append(list_array(table.ravel(), np.full(len(texts), len(STATISTICS))))
        return pa.concat_arrays(parts)

    return measure(text)


def base_failed(words: Column, repeats: Column) -> Column:
    return (words < FEWEST) | (100 * repeats > MOST_REPEATED * words)


def quality(text: str | Column, forest: Forest) -> Column:
    """Struct of the counts and the forest's chance of good quality."""
    form = pa.struct([*[(c, pa.int64()) for c in COUNTS], ("score", pa.float64())])

    @F.arrow_udf(f"struct<{', '.join(f'{c} long' for c in COUNTS)}, score double>")
    def measure(column: pa.Array) -> pa.Array:
        parts = []
        for texts in chunks(strings(column)):
            counts, table = statistics(texts)
            fields = [pa.array(c, pa.int64()) for c in counts.T] + [pa.array(forest.score(table))]
            parts.append(pa.StructArray.from_arrays(fields, fields=list(form)))
        return pa.concat_arrays(parts) if parts else pa.array([], form)

    return measure.asNondeterministic()(text)
