"""Benchmark passages in documents, found by the q-gram lemma and banded alignment.

An item of m characters that stands in a text with at most k edits shares at least
m - q + 1 - k q of its q-grams with it, and they lie within k + 1 neighbouring diagonals
(position in the text less position in the item). So shared q-grams are counted in
overlapping bands of 2 (k + 1) diagonals; bands that reach the bound are regions, and a
banded alignment of the whole item in each region decides. The budget k is `RATE` of the
item's length, less for short items so that the bound stays at `LEAST` shared q-grams.

Letters count in lower case and every white-space character as a space. Items of fewer
than `Q + LEAST - 1` characters cannot have that many q-grams; they are searched exactly, as
whole words: no letter or digit may stand beside one of theirs. They are looked up by a hash
of each run of their length, a pass over the text for each length there is.

Defined results. Null and empty texts and items match nothing, nor do items without a letter
or digit. An item without an id is searched too and reported with a null one. Of overlapping
places of one item the one with the fewest edits counts, then the first. Items that repeat
are each reported. Very long and very repetitive texts are worked off in bounded slices of
shared q-grams. Empty tables give no rows; other columns are not looked at. Every item is
searched in every whole text; the items are sent to the tasks in blocks of bounded size, with
one column for each block.
"""

from __future__ import annotations

from bisect import bisect_left
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.llm.batches import chunks, ranges, strings
from tideline.llm.hashing import BASE, mix

Q = 8
RATE = 0.08
LEAST = 8
BLOCK_CHARS = 4_000_000  # of items that are sent to the tasks at once, at most
SLICE = 4_000_000  # shared q-grams that are counted at once, at most
NO_ID = -(2**63)  # stands for the id of an item that has none
BELOW = 2**24  # above any item's length: keeps the numbers of bands positive
APART = 0xFFFFFF  # stands between texts; no character
MATCHES = "array<struct<item long, start int, end int, edits int>>"


@lru_cache(maxsize=1)
def _folded() -> np.ndarray:
    """Each of the first 12,288 characters in lower case, white space as a space."""
    table = np.arange(0x3000, dtype=np.uint32)
    for c in range(0x3000):
        char = chr(c)
        if char.isspace():
            table[c] = 32
        elif len(char.lower()) == 1:
            table[c] = ord(char.lower())
    return table


@lru_cache(maxsize=1)
def _in_word() -> np.ndarray:
    """Whether each of the first 12,288 characters is a letter, digit or underscore. Scripts
    beyond them do not part words by spaces."""
    return np.array([chr(c).isalnum() or chr(c) == "_" for c in range(0x3000)])


def in_word(code: np.ndarray) -> np.ndarray:
    return (code < 0x3000) & _in_word()[np.minimum(code, 0x2FFF)]


def run_values(code: np.ndarray, width: int) -> np.ndarray:
    """A hash of the `width` characters from each position on."""
    total = np.zeros(max(0, len(code) - width + 1), np.uint64)
    for j in range(width):
        total = total * BASE + code[j : j + len(total)].astype(np.uint64) + np.uint64(1)
    return mix(total)


class ShortItems:
    """Items that are searched exactly, by length."""

    def __init__(self, ids: list[int], texts: list[str]):
        self.by_length: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        for size in sorted({len(t) for t in texts}):
            own = [n for n, t in enumerate(texts) if len(t) == size]
            code = folded([texts[n] for n in own])[0].reshape(-1, size + 1)[:, :-1]
            shown = in_word(code).any(axis=1) | (code >= 0x3000).any(axis=1)
            code, own = code[shown], np.array(ids, np.int64)[own][shown]
            value = np.array([run_values(c, size)[0] for c in code], np.uint64)
            order = np.argsort(value, kind="stable")
            if len(order):
                self.by_length[size] = value[order], code[order], own[order]

    def matches(self, texts: list[str]) -> list[np.ndarray]:
        """As `Items.matches`."""
        code, ends = folded(texts)
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        inner = in_word(code)
        open_left, open_right = ~np.r_[False, inner[:-1]], ~np.r_[inner[1:], False]
        found: list[tuple[np.ndarray, np.ndarray, int]] = []
        for size, (values, codes, ids) in self.by_length.items():
            value = run_values(code, size)
            low, high = (np.searchsorted(values, value, side=x) for x in ("left", "right"))
            at = np.flatnonzero(high > low)
            bounded = (open_left[at] | ~inner[at]) & (open_right[at + size - 1] | ~inner[at + size - 1])
            at = at[bounded]
            item = ranges(low[at], high[at] - low[at])
            place = np.repeat(at, high[at] - low[at])
            same = (code[place[:, None] + np.arange(size)] == codes[item]).all(axis=1)
            found.append((place[same], ids[item[same]], size))
        start = np.concatenate([x[0] for x in found] or [np.zeros(0, np.int64)])
        item = np.concatenate([x[1] for x in found] or [np.zeros(0, np.int64)])
        size = np.concatenate([np.full(len(x[0]), x[2]) for x in found] or [np.zeros(0, np.int64)])
        owner = np.searchsorted(ends, start, side="right")
        start = start - (ends - lengths - 1)[owner]
        order = np.lexsort((item, start, owner))
        return [x[order] for x in (owner, item, start, start + size, np.zeros(len(start), np.int64))]


def folded(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts, each text followed by `APART`, and the texts' ends."""
    code = np.frombuffer("\0".join([*texts, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)
    code = np.where(code < 0x3000, _folded()[np.minimum(code, 0x2FFF)], code)
    code[ends - 1] = APART
    return code, ends


def grams(code: np.ndarray) -> np.ndarray:
    """A hash of the Q = 8 characters from each position on, by doubling."""
    total = code.astype(np.uint64) + np.uint64(1)
    power = BASE
    for width in (1, 2, 4):
        if len(total) <= width:
            return np.zeros(0, np.uint64)
        total = total[:-width] * power + total[width:]
        power = np.uint64(int(power) ** 2 % 2**64)
    return total


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each key once, with its counts added up."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    new = np.flatnonzero(np.diff(keys, prepend=~keys[:1]))
    return keys[new], np.add.reduceat(counts[order], new) if len(new) else counts[:0]


def _apart(owner, item, start, end, edits) -> np.ndarray:
    """Which matches stay when of overlapping ones of an item in a text the one with the fewest
    edits, then the first, does. Most overlap none, and are not looked at one by one."""
    order = np.lexsort((start, item, owner))
    same = (owner[order][1:] == owner[order][:-1]) & (item[order][1:] == item[order][:-1])
    group = np.r_[0, np.cumsum(~same)] if len(order) else order
    far = np.maximum.accumulate(end[order] + group * 2**33)  # the furthest end so far, by group
    touches = np.r_[False, same & (start[order][1:] + group[1:] * 2**33 < far[:-1])]
    cluster = np.cumsum(~touches)
    stays = np.ones(len(order), bool)
    sizes = np.bincount(cluster) if len(order) else np.zeros(0, np.int64)
    for one in np.flatnonzero(sizes > 1):
        members = np.arange(*np.searchsorted(cluster, [one, one + 1]))
        ranked = sorted(members.tolist(), key=lambda m: (edits[order[m]], start[order[m]]))
        taken_starts: list[int] = []
        taken_ends: list[int] = []
        for m in ranked:
            a, b = int(start[order[m]]), int(end[order[m]])
            i = bisect_left(taken_starts, b)
            if i and taken_ends[i - 1] > a:
                stays[m] = False
            else:
                taken_starts.insert(i, a)
                taken_ends.insert(i, b)
    out = np.zeros(len(order), bool)
    out[order] = stays
    return out


class Items:
    """The q-gram index of a block of items."""

    def __init__(self, ids: list[int], texts: list[str]):
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        self.ids, self.lengths = np.array(ids, np.int64), lengths
        self.code, self.ends = folded(texts)
        most = (lengths - Q + 1 - LEAST) // Q
        self.budget = np.minimum(np.floor(RATE * lengths).astype(np.int64), most)
        self.bound = lengths - Q + 1 - self.budget * Q
        gram = grams(self.code)
        item = np.searchsorted(self.ends, np.arange(len(gram)), side="right")
        place = np.arange(len(gram)) - (self.ends - lengths - 1)[item]
        whole = place + Q <= lengths[item]
        gram, item, place = gram[whole], item[whole], place[whole]
        order = np.argsort(gram, kind="stable")
        self.gram, self.item, self.place = gram[order], item[order], place[order]
        self.names, self.first, self.count = np.unique(self.gram, return_index=True, return_counts=True)
        bits = 20
        while 2**bits < 32 * len(gram):
            bits += 1
        self.shift = np.uint64(64 - bits)
        self.maybe = np.zeros(2**bits, bool)
        self.maybe[mix(self.names) >> self.shift] = True

    def regions(self, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Item and lowest diagonal of every band that has enough shared q-grams."""
        gram = grams(code)
        at = np.flatnonzero(self.maybe[(mix(gram) >> self.shift).astype(np.int64)])
        name = np.minimum(np.searchsorted(self.names, gram[at]), max(0, len(self.names) - 1))
        if not len(self.names):
            return at[:0], at[:0]
        found = self.names[name] == gram[at]
        at, name = at[found], name[found]
        keys, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        upto = np.cumsum(self.count[name])
        begin = 0
        while begin < len(at):
            shared = upto[begin - 1] if begin else 0
            end = max(begin + 1, int(np.searchsorted(upto, shared + SLICE, side="right")))
            more, n = self._bands(at[begin:end], name[begin:end])
            keys, counts = _summed(np.r_[keys, more], np.r_[counts, n])
            begin = end
        item, band = (keys >> np.uint64(40)).astype(np.int64), (keys & np.uint64(2**40 - 1)).astype(np.int64)
        enough = counts >= self.bound[item]
        item, band = item[enough], band[enough]
        return item, (band - BELOW) * (self.budget[item] + 1)

    def _bands(self, at: np.ndarray, name: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bands, as item and number in one key, of q-grams shared at these places, and how
        many each has."""
        hit = ranges(self.first[name], self.count[name])
        item = self.item[hit]
        diagonal = np.repeat(at, self.count[name]) - self.place[hit]
        band = diagonal // (self.budget[item] + 1) + BELOW
        keys = np.concatenate([(item << 40) | (band - 1), (item << 40) | band]).astype(np.uint64)
        return _summed(keys, np.ones(len(keys), np.int64))

    def align(self, code, item, low, backward=False, width=None):
        """Fewest edits of each item inside the diagonals low .. low + width of the text,
        free at both ends of the text, and where such an alignment ends. Backward, items
        and text are read from their ends and `low` counts from the text's end."""
        if backward:
            code = code[::-1]
        out_edits, out_end = np.zeros(len(item), np.int64), np.zeros(len(item), np.int64)
        for part in range(0, len(item), 256):
            which = slice(part, part + 256)
            name, start = item[which], low[which]
            size, budget = self.lengths[name], self.budget[name]
            span = int((width[which] if width is not None else 2 * (budget + 1)).max()) + 1
            begin = self.ends[name] - 1 - size
            column = np.arange(span)
            cost = np.zeros((len(name), span), np.int64)
            edits, end = np.zeros(len(name), np.int64), np.zeros(len(name), np.int64)
            for j in range(int(size.max())):
                at = begin + (size - 1 - j if backward else j)
                own = self.code[np.clip(at, 0, len(self.code) - 1)]
                place = start[:, None] + j + column
                there = code[np.clip(place, 0, len(code) - 1)]
                differs = (there != own[:, None]) | (place < 0) | (place >= len(code))
                skipped = np.concatenate([cost[:, 1:], np.full((len(name), 1), 1 << 20)], axis=1)
                cost = np.minimum(cost + differs, skipped + 1)
                cost = np.minimum.accumulate(cost - column, axis=1) + column
                over = np.flatnonzero(size == j + 1)
                if len(over):
                    best = cost[over].argmin(axis=1)
                    edits[over] = cost[over, best]
                    end[over] = start[over] + j + 1 + best
            out_edits[which], out_end[which] = edits, end
        return out_edits, out_end

    def matches(self, texts: list[str]) -> list[np.ndarray]:
        """Text number, item id, start, end and edits of each item found in a text."""
        code, ends = folded(texts)
        item, low = self.regions(code)
        edits, end = self.align(code, item, low)
        good = edits <= self.budget[item]
        item, edits, end = item[good], edits[good], end[good]
        # The start is where the alignment ends when both are read backward from there.
        slack = edits
        back, stop = self.align(
            code, item, len(code) - end - slack, backward=True, width=2 * slack
        )
        start = len(code) - stop
        owner = np.searchsorted(ends, start, side="right")
        order = np.lexsort((start, edits, end, item))
        item, edits, end, start, owner = (x[order] for x in (item, edits, end, start, owner))
        new = np.ones(len(item), bool)
        new[1:] = (item[1:] != item[:-1]) | (end[1:] != end[:-1])
        item, edits, end, start, owner = (x[new] for x in (item, edits, end, start, owner))
        new = _apart(owner, item, start, end, edits)
        item, edits, end, start, owner = (x[new] for x in (item, edits, end, start, owner))
        order = np.lexsort((self.ids[item], start, owner))
        first = (ends - np.fromiter(map(len, texts), np.int64, len(texts)) - 1)[owner]
        return [x[order] for x in (owner, self.ids[item], start - first, end - first, edits)]


@lru_cache(maxsize=4)
def _index(ids: tuple[int, ...], texts: tuple[str, ...]) -> list[Items | ShortItems]:
    """What searches the items: by q-grams, and exactly, as far as there are any."""
    parts: list[Items | ShortItems] = []
    for kind, long in ((Items, True), (ShortItems, False)):
        own = [n for n, t in enumerate(texts) if (len(t) >= Q + LEAST - 1) == long]
        if own:
            parts.append(kind([ids[n] for n in own], [texts[n] for n in own]))
    return parts


def blocks(items: DataFrame, id: str = "item_id", text: str = "text") -> list[tuple[tuple[int, ...], tuple[str, ...]]]:
    """The searchable items, in blocks that hold at most `BLOCK_CHARS` characters or one item."""
    size = F.length(text)
    item = F.coalesce(F.col(id).cast("long"), F.lit(NO_ID)).alias("item")
    usable = items.where(size > 0).select(item, F.col(text).alias("passage"), size.alias("size"))
    total = usable.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    parts = 1 + 2 * total // BLOCK_CHARS
    out = []
    for part in range(parts):
        rows = usable.where(F.pmod(F.xxhash64("item", "passage"), F.lit(parts)) == part)
        part_ids, part_texts, held = [], [], 0
        for row in rows.orderBy("item", "passage").collect():
            if part_ids and held + row.size > BLOCK_CHARS:
                out.append((tuple(part_ids), tuple(part_texts)))
                part_ids, part_texts, held = [], [], 0
            part_ids.append(row.item)
            part_texts.append(row.passage)
            held += row.size
        if part_ids:
            out.append((tuple(part_ids), tuple(part_texts)))
    return out


def leaks(text: str | Column, found: list[tuple[tuple[int, ...], tuple[str, ...]]]) -> Column:
    """Array of (item, start, end, edits): where items of the blocks stand in the text
    (code points, end exclusive), in the order of start and item within a block."""
    columns = [_leaks(text, ids, texts) for ids, texts in found]
    return F.concat(*columns) if columns else F.array().cast(MATCHES)


def _leaks(text, ids, texts) -> Column:
    @F.arrow_udf(MATCHES)
    def search(column: pa.Array) -> pa.Array:
        index, parts = _index(ids, texts), []
        kind = pa.struct({"item": pa.int64(), "start": pa.int32(), "end": pa.int32(), "edits": pa.int32()})
        for part in chunks(strings(column)):
            found = [np.concatenate(x) for x in zip(*(searched.matches(part) for searched in index))]
            order = np.lexsort((found[1], found[2], found[0]))
            owner, *rest = (x[order] for x in found)
            fields = [pa.array(x, f.type) for x, f in zip(rest[1:], list(kind)[1:])]
            named = pa.array(rest[0], pa.int64(), mask=rest[0] == NO_ID)
            items = pa.StructArray.from_arrays([named, *fields], fields=list(kind))
            offsets = np.r_[0, np.cumsum(np.bincount(owner, minlength=len(part)))].astype(np.int32)
            parts.append(pa.ListArray.from_arrays(pa.array(offsets), items))
        return pa.concat_arrays(parts) if parts else pa.array([], pa.list_(kind))

    return search.asNondeterministic()(text)
