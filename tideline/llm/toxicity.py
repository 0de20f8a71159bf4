"""Toxic spans and document scores from a linear-chain conditional random field.

The chains are the lines of a text, however long. Each word is toxic or not; its emission
weight is a sum over its features (the word or a beginning of it, if marked in training,
and the words beside it), and transitions couple neighbours. Forward-backward messages give
each word's chance of being toxic. With two states a message is one number, the log odds, so
a step over all chains of a batch is a few array operations. Lines of more than `CHAIN`
words go in pieces of so many, each as a 2 x 2 matrix that carries the message across it.

Training. Labels are of documents, so tokens are labelled first: in labelled toxic
documents, the words that are, or begin with 3 to 6 characters that are, far commoner in
toxic than in clean documents, by a log odds and a likelihood ratio test over distinct
texts; the mark must also stand beside as many different words, lest the words of much
copied toxic texts count. The field is fitted to these tokens by gradient steps on its likelihood with a
ridge, and a logistic regression on the expected number of toxic words, their density and
the highest chance turns marginals into a document score. Both use at most `SAMPLE`
documents a class, chosen by a hash of their id; scoring runs on all rows and whole texts.

Defined results. Null and empty texts have no words and get the score of a text without toxic
words. Long texts are scored whole. Rows that repeat get the same score each. Without labels
of both kinds, as with empty tables, every text has the smoothed share of toxic labels as
score. Further columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.llm.batches import chunks, strings
from tideline.llm.hashing import mix, step, word_beginnings, word_places

SAMPLE = 600  # labelled documents of each class that the model is fitted on, at most
CHAIN = 128  # words that messages pass one by one
BEGINNINGS = (3, 4, 5, 6)  # characters
FEATURES = 3 + len(BEGINNINGS)
PURE = 1.7  # least log odds of a word or beginning, by documents, to label tokens
SURE = 30.0  # its least likelihood ratio statistic
FAINT = 0.1  # lower chances are none in a document's score, however long it is
ROUNDS, RATE, RIDGE = 30, 0.4, 0.02
RESULT = "struct<score double, spans array<struct<start int, end int, chance float>>>"


@dataclass
class Field:
    """Weights: features by hash in order, transitions [from, to], document regression."""

    keys: np.ndarray
    weights: np.ndarray
    bias: float
    moves: np.ndarray
    document: np.ndarray


def _features(texts: list[str], word: np.ndarray, chain: np.ndarray) -> list[np.ndarray]:
    """Feature hashes of each word; the first ones are the word and its beginnings."""
    before, after = np.zeros_like(word), np.zeros_like(word)
    if len(word):
        same = chain[1:] == chain[:-1]
        before[1:][same] = word[:-1][same]
        after[:-1][same] = word[1:][same]
    kinds = (word, *word_beginnings(texts, BEGINNINGS), before, after)
    return [np.where(x == 0, 0, mix(x + step(n + 1))) for n, x in enumerate(kinds)]


class _Steps:
    """Forward log odds of every word, over all chains at once."""

    def __init__(self, chain: np.ndarray):
        begins = np.flatnonzero(np.diff(chain, prepend=-1))
        lengths = np.diff(begins, append=len(chain))
        pieces = -(-lengths // CHAIN)
        rank = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        starts = np.repeat(begins, pieces) + rank * CHAIN
        sizes = np.minimum(np.repeat(lengths, pieces) - rank * CHAIN, CHAIN)
        self.first = self._layout(starts[rank == 0], sizes[rank == 0])
        self.later = self._layout(starts[rank > 0], sizes[rank > 0])
        across = (rank > 0) & (rank < np.repeat(pieces, pieces) - 1)
        self.across = starts[across]
        by_rank = np.argsort(rank, kind="stable")
        ends = np.cumsum(np.bincount(rank)) if len(rank) else np.zeros(1, int)
        self.ranks = [starts[by_rank[a:b]] for a, b in zip(ends, ends[1:])]

    @staticmethod
    def _layout(starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, list[int]]:
        """The pieces from the longest on, and how many have each word."""
        order = np.argsort(-sizes, kind="stable")
        sizes = sizes[order]
        longest = int(sizes[0]) if len(sizes) else 0
        return starts[order], np.searchsorted(-sizes, -np.arange(longest), side="left").tolist()

    def run(self, emission: np.ndarray, moves: np.ndarray) -> np.ndarray:
        ahead = emission.copy()
        (stay, enter), (leave, keep) = moves

        def moved(x):
            return np.logaddexp(enter, keep + x) - np.logaddexp(stay, leave + x)

        def walk(starts, active):
            for t, n in enumerate(active[1:], 1):
                at = starts[:n] + t
                ahead[at] += moved(ahead[at - 1])

        walk(*self.first)
        if self.ranks:
            # Logs of the matrix that turns (odds, 1) before a piece into those at its end.
            toxic = np.stack([np.zeros(len(self.across)), np.full(len(self.across), -np.inf)])
            clean = toxic[::-1].copy()
            for t in range(CHAIN):
                toxic, clean = (
                    emission[self.across + t] + np.logaddexp(keep + toxic, enter + clean),
                    np.logaddexp(leave + toxic, stay + clean),
                )
            incoming = ahead[self.ranks[0] - 1]
            ahead[self.ranks[0]] += moved(incoming)
            for before, starts in zip(self.ranks, self.ranks[1:]):
                goes_on = np.searchsorted(before, starts - CHAIN)
                x, at = incoming[goes_on], np.searchsorted(self.across, starts - CHAIN)
                incoming = np.logaddexp(toxic[0, at] + x, toxic[1, at]) - np.logaddexp(clean[0, at] + x, clean[1, at])
                ahead[starts] += moved(incoming)
            walk(*self.later)
        return ahead


class Messages:
    """Forward and backward log odds of every word, over all chains at once."""

    def __init__(self, chain: np.ndarray):
        self.forward, self.backward = _Steps(chain), _Steps(chain[::-1])

    def run(self, emission: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        back = self.backward.run(emission[::-1], moves.T)[::-1] - emission
        return self.forward.run(emission, moves), back


def _chance(odds: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(odds, -40, 40)))


def _emissions(field: Field, features: list[np.ndarray]) -> np.ndarray:
    total = np.full(len(features[0]), field.bias)
    if len(field.keys):
        for part in features:
            at = np.minimum(np.searchsorted(field.keys, part), len(field.keys) - 1)
            total += np.where(field.keys[at] == part, field.weights[at], 0.0)
    return total


def _document_features(chance: np.ndarray, owner: np.ndarray, texts: int) -> np.ndarray:
    """A row per text: 1, logs of 1 + the expected toxic words and of 1 + 50 times their
    share of all words, the highest chance."""
    chance = np.where(chance < FAINT, 0.0, chance)
    most = np.zeros(texts)
    np.maximum.at(most, owner, chance)
    expected = np.bincount(owner, chance, minlength=texts)
    share = expected / (np.bincount(owner, minlength=texts) + 20)
    return np.column_stack([np.ones(texts), np.log1p(expected), np.log1p(50 * share), most])


def toxic_marks(features: list[np.ndarray], owner: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """Hashes of the words and beginnings that label tokens; `toxic` is each text's label.
    Words come first, then beginnings from the longest on, each judged by the tokens that
    nothing before has marked: so `stu` is not toxic for the sake of `stupid`."""
    found, left = [], np.ones(len(owner), bool)
    many_bad, many_good = toxic.sum(), (~toxic).sum()
    for mark in (features[0], *features[len(BEGINNINGS) : 0 : -1]):
        held = _pairs(mark[left], owner[left])
        of_toxic = left & toxic[owner]
        names, inverse = np.unique(held[:, 0], return_inverse=True)
        bad = np.bincount(inverse, toxic[held[:, 1].astype(int)].astype(float), minlength=len(names))
        good = np.bincount(inverse, minlength=len(names)) - bad
        for beside in features[-2:]:  # near copies of a toxic text have the same words beside
            around = _pairs(mark[of_toxic], beside[of_toxic])[:, 0]
            bad = np.minimum(bad, np.bincount(np.searchsorted(names, around), minlength=len(names)))
        odds = np.log((bad + 0.5) / (many_bad + 1)) - np.log((good + 0.5) / (many_good + 1))
        share = (bad + good) / len(toxic)
        with np.errstate(divide="ignore", invalid="ignore"):
            sure = 2 * np.nan_to_num(bad * np.log(bad / (many_bad * share)))
            sure += 2 * np.nan_to_num(good * np.log(good / (many_good * share)))
        found.append(names[(odds >= PURE) & (sure >= SURE) & (names != 0)])
        left &= ~np.isin(mark, found[-1])
    return np.concatenate(found)


def _pairs(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Distinct pairs as rows, in order."""
    right = right.astype(np.uint64)
    order = np.lexsort((right, left))
    left, right = left[order], right[order]
    new = np.ones(len(left), bool)
    new[1:] = (left[1:] != left[:-1]) | (right[1:] != right[:-1])
    return np.column_stack([left[new], right[new]])


def _numbered(features: list[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray]]:
    """Hashes of the features that occur three times or more, and for each kind of feature
    the number of every word's one; rarer ones have the number after the last."""
    kept = []
    for part in features:
        names, count = np.unique(part, return_counts=True)
        kept.append(names[(count >= 3) & (names != 0)])
    total, start, where = sum(map(len, kept)), 0, []
    for part, names in zip(features, kept):
        at = np.searchsorted(names, part).astype(np.int32)
        if len(names):
            missing = names[np.minimum(at, len(names) - 1)] != part
            at += np.int32(start)
            at[missing] = total
        else:
            at[:] = total
        where.append(at)
        start += len(names)
    return np.concatenate(kept), where


def fit(texts: list[str], toxic: np.ndarray, share: float) -> Field:
    """A field fitted to whole labelled texts. `share` of all labels are toxic, which is the
    score where the texts are of one class only."""
    nothing = np.zeros(0, np.uint64), np.zeros(0)
    if not toxic.any() or toxic.all():
        odds = np.log((share + 1e-3) / (1 - share + 1e-3))
        return Field(*nothing, 0.0, np.zeros((2, 2)), np.array([odds, 0.0, 0.0, 0.0]))
    word, owner, _, _, chain = word_places(texts)
    features = _features(texts, word, chain)
    marks = toxic_marks(features, owner, toxic)
    label = np.zeros(len(word), bool)
    for part in features[: 1 + len(BEGINNINGS)]:
        marked = np.isin(part, marks)
        label |= marked & toxic[owner]
        part[~marked] = 0  # other words and beginnings are no features
    keys, where = _numbered(features)
    messages, follows = Messages(chain), np.flatnonzero(chain[1:] == chain[:-1])
    parts = [np.zeros(len(keys) + 1), np.zeros(1), np.zeros((2, 2))]
    parts[1][0] = np.log((label.sum() + 1) / (len(label) + 2))
    pushed = [np.zeros_like(x) for x in parts]
    spread = [np.zeros_like(x) for x in parts]
    pair = label[follows].astype(int) * 2 + label[follows + 1].astype(int)
    seen = np.bincount(pair, minlength=4).reshape(2, 2)
    for turn in range(1, ROUNDS + 1):
        weights, bias, moves = parts
        emission = bias[0] + sum(weights[at] for at in where)
        ahead, back = messages.run(emission, moves)
        off = _chance(ahead + back) - label
        x, c = ahead[follows], (emission + back)[follows + 1]
        logits = np.stack([moves[0, 0] + 0 * x, moves[0, 1] + c, moves[1, 0] + x, moves[1, 1] + x + c])
        joint = np.exp(logits - logits.max(axis=0))
        expected = (joint / joint.sum(axis=0)).sum(axis=1).reshape(2, 2)
        slope = sum(np.bincount(at, off, minlength=len(weights)) for at in where) + RIDGE * weights
        slope[-1] = 0  # rare features have no weight
        slopes = [slope, np.array([off.sum()]), expected - seen + RIDGE * moves]
        for n, g in enumerate(slopes):  # steps scaled by running means of the slopes
            pushed[n] = 0.8 * pushed[n] + 0.2 * g
            spread[n] = 0.95 * spread[n] + 0.05 * g * g
            ahead_by = pushed[n] / (1 - 0.8**turn)
            parts[n] = parts[n] - RATE * ahead_by / (np.sqrt(spread[n] / (1 - 0.95**turn)) + 1e-6)
    weights, bias, moves = parts
    heavy = np.flatnonzero(np.abs(weights[:-1]) > 0.05)
    heavy = heavy[np.argsort(keys[heavy])]
    field = Field(keys[heavy], weights[heavy], float(bias[0]), moves, np.zeros(4))
    ahead, back = messages.run(_emissions(field, features), moves)
    rows = _document_features(_chance(ahead + back), owner, len(texts))
    field.document = _regression(rows, toxic)
    return field


def _regression(rows: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """Logistic regression with a small ridge, in which both classes weigh the same."""
    weight = np.where(toxic, 0.5 / toxic.mean(), 0.5 / (1 - toxic.mean()))
    beta = np.zeros(rows.shape[1])
    ridge = np.diag([1e-6, 1e-2, 1e-2, 1e-2])
    for _ in range(50):
        p = _chance(rows @ beta)
        slope = rows.T @ (weight * (p - toxic)) + ridge @ beta
        curve = (rows * (weight * p * (1 - p))[:, None]).T @ rows + ridge + 1e-9 * np.eye(4)
        beta = beta - np.clip(np.linalg.solve(curve, slope), -2, 2)
    return beta


def train(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", toxic: str = "toxic") -> Field:
    """A field from labelled documents. `labels` holds the rows that may be learnt from;
    of several labels of a document the highest counts, null ones do not."""
    kinds = labels.where(F.col(id).isNotNull() & F.col(toxic).isNotNull())
    kinds = kinds.groupBy(F.col(id).alias("id")).agg(F.max(F.col(toxic).cast("int")).alias("label"))
    total, bad = kinds.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0))).first()
    if not total:
        return fit([], np.zeros(0, bool), 0.0)
    chosen = [
        kinds.where(F.col("label") == value).orderBy(F.xxhash64("id"), "id").limit(SAMPLE) for value in (0, 1)
    ]
    picked = F.broadcast(chosen[0].union(chosen[1]))  # 2 x SAMPLE rows at most
    rows = docs.select(F.col(id).alias("id"), F.col(text).alias("text")).join(picked, "id")
    found = rows.groupBy("text").agg(F.max("label").alias("label")).orderBy(F.xxhash64("text"), "text").collect()
    return fit([r.text or "" for r in found], np.array([r.label == 1 for r in found], bool), bad / total)


def scorer(field: Field) -> Callable[[list[str]], tuple[np.ndarray, list[np.ndarray]]]:
    """Scores texts: their scores, and rows (text, first byte, byte after, chance) of
    every maximal run of words with a chance of a half or more."""

    def run(texts: list[str]):
        word, owner, start, length, chain = word_places(texts)
        emission = _emissions(field, _features(texts, word, chain))
        ahead, back = Messages(chain).run(emission, field.moves)
        chance = _chance(ahead + back) if len(field.keys) else np.zeros(len(word))
        score = _chance(_document_features(chance, owner, len(texts)) @ field.document)
        hit = np.flatnonzero(chance >= 0.5)
        first = (np.diff(hit, prepend=-2) != 1) | (np.diff(chain[hit], prepend=-1) != 0)
        opens = np.flatnonzero(first)
        last = np.append(opens[1:], len(hit))[: len(opens)] - 1
        most = np.maximum.reduceat(chance[hit], opens) if len(opens) else np.zeros(0)
        ends = start[hit[last]] + length[hit[last]]
        return score, [owner[hit[opens]], start[hit[opens]], ends, most]

    return run


def _characters(texts: list[str], owner: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Byte places in texts as code points."""
    coded: dict[int, bytes] = {}
    out = []
    for n, at in zip(owner.tolist(), places.tolist()):
        if n not in coded:
            coded = {n: texts[n].encode("utf-8", "replace")}
        out.append(at if texts[n].isascii() else len(coded[n][:at].decode("utf-8")))
    return np.array(out, np.int32)


def toxicity(text: str | Column, field: Field) -> Column:
    """Struct of the document score and the toxic spans (code points, end exclusive)."""

    @F.arrow_udf(RESULT)
    def tag(column: pa.Array) -> pa.Array:
        run, scores, spans = scorer(field), [], []
        span = pa.struct({"start": pa.int32(), "end": pa.int32(), "chance": pa.float32()})
        for texts in chunks(strings(column)):
            score, (owner, start, end, chance) = run(texts)
            items = pa.StructArray.from_arrays(
                [
                    pa.array(_characters(texts, owner, start), pa.int32()),
                    pa.array(_characters(texts, owner, end), pa.int32()),
                    pa.array(chance.astype(np.float32)),
                ],
                fields=list(span),
            )
            offsets = np.r_[0, np.cumsum(np.bincount(owner, minlength=len(texts)))].astype(np.int32)
            scores.append(pa.array(score))
            spans.append(pa.ListArray.from_arrays(pa.array(offsets), items))
        if not scores:
            return pa.array([], pa.struct({"score": pa.float64(), "spans": pa.list_(span)}))
        return pa.StructArray.from_arrays([pa.concat_arrays(scores), pa.concat_arrays(spans)], ["score", "spans"])

    return tag.asNondeterministic()(text)
