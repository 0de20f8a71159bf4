"""SentencePiece BPE: texts to piece ids and back, by vectorised merge rounds.

A text is cut into words (a run of word marks and what follows up to the next), and a
word is cut again wherever two neighbouring characters stand together in no piece, since
nothing can merge across. Each distinct word of a batch is encoded once. All segments are
worked on at once as one flat array of symbols: the best pair rank of each segment is a
segmented minimum, every leftmost non-overlapping occurrence of it merges in the same
round, and segments without a mergeable pair are compacted away.

The library merges one pair at a time. Merging all occurrences at once gives the same
result unless a pair made by such a merge ranks before the merged pair, or pieces tie;
pieces for which the vocabulary allows that are marked when it is read, and of the
segment's best pair only the leftmost occurrence merges if it makes a marked piece.

Defined results. Null and empty texts have no ids; an empty id list is the empty text. Long
texts are encoded whole; a word without an end is one segment. Of pairs of equal rank the
leftmost merges first. Rows that repeat get the same ids each. An empty table gives an empty
result; further columns are not looked at.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.llm.batches import chunks, list_array, ranges, strings, text_chunks

MARK = "▁"  # stands for a space
WORD = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")
UNKNOWN = " ⁇ "  # how the library writes the unknown id
NONE = np.int32(2**31 - 1)
CACHED_WORDS = 120_000  # words whose ids a worker remembers


class Numbered(dict):
    """Numbers words, without their first mark, in the order of their first look-up."""

    def __missing__(self, word: str) -> int:
        self[word] = at = len(self)
        return at


class PairTable:
    """Pairs of ids to a value, by open addressing, looked up for whole arrays."""

    SLOTS = 2**19

    def __init__(self, pairs: dict[int, int]):
        slots = self.SLOTS
        while slots < 8 * len(pairs):
            slots *= 2
        self.mask, self.probes = slots - 1, 0
        self.keys = np.full(slots, -1, np.int64)
        self.values = np.full(slots, -1, np.int32)
        keys = np.fromiter(pairs, np.int64, len(pairs))
        values = np.fromiter(pairs.values(), np.int32, len(pairs))
        at = self._slot(keys)
        while len(keys):
            free = self.keys[at] == -1
            self.keys[at[free]] = keys[free]  # of several for one slot the last stays
            own = self.keys[at] == keys
            self.values[at[own]] = values[own]
            keys, values, at = keys[~own], values[~own], (at[~own] + 1) & self.mask
            self.probes += 1

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(40)).astype(np.int64) & self.mask

    def look(self, keys: np.ndarray) -> np.ndarray:
        """The value of each key, or -1."""
        at = self._slot(keys)
        there = self.keys[at]
        out = np.where(there == keys, self.values[at], -1)
        left = np.flatnonzero((there != keys) & (there != -1))
        for _ in range(self.probes):
            if not len(left):
                break
            slot = (at[left] + 1) & self.mask
            at[left] = slot
            there = self.keys[slot]
            found = there == keys[left]
            out[left[found]] = self.values[slot[found]]
            left = left[~found & (there != -1)]
        return out


class Vocabulary:
    """Tables of one model file: pieces, scores as ranks, and the pairs that merge."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        names = [model.id_to_piece(i) for i in range(size)]
        plain = [
            not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))
            for i in range(size)
        ]
        ids = {name: i for i, name in enumerate(names) if plain[i]}
        scores = np.array([model.get_score(i) for i in range(size)])
        self.rank = np.unique(-scores, return_inverse=True)[1].astype(np.int32)
        self.byte = np.full(256, model.unk_id(), np.int32)
        self.byte_of = np.full(size, -1, np.int32)
        for i, name in enumerate(names):
            if model.is_byte(i):
                self.byte[int(name[3:5], 16)] = i
                self.byte_of[i] = int(name[3:5], 16)
        self.single = np.full(0x110000, -1, np.int32)
        self.careful = np.zeros(size, bool)
        pairs, beside = {}, set()
        for name, i in ids.items():
            if len(name) == 1:
                self.single[ord(name)] = i
            for cut in range(1, len(name)):
                beside.add((ord(name[cut - 1]), ord(name[cut])))
                left, right = ids.get(name[:cut]), ids.get(name[cut:])
                if left is not None and right is not None:
                    pairs[left * size + right] = i
                for part in (left, right):
                    if part is not None and self.rank[part] >= self.rank[i]:
                        self.careful[part] = True
        self.size = size
        self.careful |= np.bincount(self.rank)[self.rank] > 1
        self.pairs = PairTable(pairs)
        chars = sorted({c for pair in beside for c in pair})
        self.char_class = np.zeros(0x110000, np.int32)
        self.char_class[chars] = np.arange(1, len(chars) + 1)
        self.beside = np.zeros((len(chars) + 1, len(chars) + 1), bool)
        for left, right in beside:
            self.beside[self.char_class[left], self.char_class[right]] = True
        self.shown = [
            b"" if model.is_control(i)
            else UNKNOWN.encode() if model.is_unknown(i)
            else bytes([self.byte_of[i]]) if self.byte_of[i] >= 0
            else name.replace(MARK, " ").encode()
            for i, name in enumerate(names)
        ]
        self.shown_mark = np.array([plain[i] and name.startswith(MARK) for i, name in enumerate(names)])
        self.control = np.array([model.is_control(i) for i in range(size)])
        self.known = Numbered()
        self.starts = np.zeros(0, np.int64)
        self.lengths = np.zeros(0, np.int64)
        self.flat = np.zeros(0, np.int32)

    def joined(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The piece that each pair of symbols merges to, or -1."""
        keys = left.astype(np.int64) * self.size + right
        keys[(left < 0) | (right < 0)] = -2
        return self.pairs.look(keys)

    def pair_rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        made = self.joined(left, right)
        return np.where(made >= 0, self.rank[made], NONE)

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words, flat, and how many each word has."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        text = "".join(words)
        code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        total = len(code)
        if total == 0:
            return np.zeros(0, np.int32), lengths
        opens = np.zeros(total, bool)
        opens[(np.cumsum(lengths) - lengths)[lengths > 0]] = True
        kind = self.char_class[code]
        opens[1:] |= ~self.beside[kind[:-1], kind[1:]]
        symbol = self.single[code]
        place = np.arange(total, dtype=np.int32)
        final = np.full(total, -2, np.int32)  # -2: merged into an earlier place
        segment = np.cumsum(opens, dtype=np.int32)
        rank = np.full(total, NONE, np.int32)  # of the pair that a symbol leads
        rank[:-1] = self.pair_rank(symbol[:-1], symbol[1:])
        rank[:-1][opens[1:]] = NONE
        while True:
            starts = np.flatnonzero(np.diff(segment, prepend=-1))
            sizes = np.diff(starts, append=len(segment))
            best = np.minimum.reduceat(rank, starts)
            over = best == NONE
            if over.any():
                ready = np.repeat(over, sizes)
                final[place[ready]] = symbol[ready]
                if over.all():
                    break
                ready = ~ready
                symbol, place, segment, rank = (x[ready] for x in (symbol, place, segment, rank))
                best, sizes = best[~over], sizes[~over]
            hit = np.flatnonzero(rank == np.repeat(best, sizes))
            of = segment[hit]
            leads = np.diff(of, prepend=-1) != 0
            made = self.joined(symbol[hit], symbol[hit + 1])
            take = leads | ~self.careful[made]
            if not leads.all():
                # Of hits side by side every other one merges, counted from the leftmost.
                hit, of, made = hit[take], of[take], made[take]
                count = np.arange(len(hit))
                first = (np.diff(hit, prepend=-2) != 1) | (np.diff(of, prepend=-1) != 0)
                take = (count - np.maximum.accumulate(np.where(first, count, 0))) % 2 == 0
                hit, made = hit[take], made[take]
            symbol[hit] = made
            keep = np.ones(len(symbol), bool)
            keep[hit + 1] = False
            symbol, place, segment, rank = (x[keep] for x in (symbol, place, segment, rank))
            hit -= np.arange(len(hit))  # where the merged symbols are now
            again = np.concatenate([hit, hit[hit > 0] - 1])
            inside = again < len(symbol) - 1
            rank[again[~inside]] = NONE
            again = again[inside]
            fresh = self.pair_rank(symbol[again], symbol[again + 1])
            fresh[segment[again] != segment[again + 1]] = NONE
            rank[again] = fresh
        return self._with_bytes(final, code, lengths)

    def _with_bytes(self, final, code, lengths):
        """Drop merged places; write characters without a piece as byte pieces."""
        owner = np.repeat(np.arange(len(lengths)), lengths)
        kept = np.flatnonzero(final != -2)
        ids, owner, code = final[kept], owner[kept], code[kept]
        odd = np.flatnonzero(ids == -1)
        if len(odd):
            spelled = [chr(c).encode("utf-8", "replace") for c in code[odd].tolist()]
            width = np.ones(len(ids), np.int64)
            width[odd] = [len(s) for s in spelled]
            ids, owner = np.repeat(ids, width), np.repeat(owner, width)
            ids[ids == -1] = self.byte[np.frombuffer(b"".join(spelled), np.uint8)]
        return ids, np.bincount(owner, minlength=len(lengths))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, flat, and how many each text has."""
        if len(self.known) > CACHED_WORDS:
            self.known = Numbered()
            self.starts, self.lengths, self.flat = self.starts[:0], self.lengths[:0], self.flat[:0]
        known, index, counts, before = self.known, [], [], len(self.known)
        for text in texts:
            if not text:
                words = []
            elif text[0] == " " or "  " in text or MARK in text:
                words = [word[1:] for word in WORD.findall(MARK + text.replace(" ", MARK))]
            else:
                words = text.split(" ")
            counts.append(len(words))
            index.extend(map(known.__getitem__, words))
        if len(known) > before:
            ids, lengths = self.encode_words([MARK + word for word in islice(known, before, None)])
            self.starts = np.r_[self.starts, len(self.flat) + np.cumsum(lengths) - lengths]
            self.lengths = np.r_[self.lengths, lengths]
            self.flat = np.r_[self.flat, ids]
        index = np.array(index, np.int64)
        ids = self.flat[ranges(self.starts[index], self.lengths[index])]
        upto = np.r_[0, np.cumsum(self.lengths[index])]
        ends = np.cumsum(np.array(counts, np.int64))
        return ids, upto[ends] - upto[ends - counts]

    def decode(self, ids: np.ndarray, lengths: np.ndarray) -> list[str]:
        """The text of each id list, as the library's decode gives it."""
        shown, texts, at = self.shown, [], 0
        control = self.control[ids]
        for end in np.cumsum(lengths).tolist():
            part = ids[at:end].tolist()
            try:
                whole = not control[at:end].any()  # bytes do not join across a control id
                text = b"".join([shown[i] for i in part]).decode() if whole else self._with_byte_runs(part)
            except UnicodeDecodeError:
                text = self._with_byte_runs(part)
            first = next((i for i in part if not self.control[i]), None)
            if first is not None and self.shown_mark[first]:
                text = text[1:]
            texts.append(text)
            at = end
        return texts

    def _with_byte_runs(self, ids: list[int]) -> str:
        """Runs of byte pieces are UTF-8; each byte that is not part of any is U+FFFD."""
        out, run = [], bytearray()
        for i in [*ids, -1]:
            byte = self.byte_of[i] if i >= 0 else -1
            if byte >= 0:
                run.append(byte)
                continue
            if run:
                out.append(_lenient(bytes(run)))
                run.clear()
            if i >= 0:
                out.append(self.shown[i].decode())
        return "".join(out)


def _lenient(run: bytes) -> str:
    out, at = [], 0
    while at < len(run):
        for width in (1, 2, 3, 4):
            try:
                char = run[at : at + width].decode()
            except UnicodeDecodeError:
                continue
            if len(char) == 1:
                out.append(char)
                at += width
                break
        else:
            out.append("�")
            at += 1
    return "".join(out)


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def piece_ids(text: str | Column, model: str) -> Column:
    """Ids of the text in the model file `model`: array of int, empty for null.

    Declared nondeterministic only so that Spark does not encode again for every use."""

    @F.arrow_udf("array<int>")
    def encode(column: pa.Array) -> pa.Array:
        vocab, parts = vocabulary(model), []
        for part in chunks(strings(column)):
            parts.append(list_array(*vocab.encode(part)))
        return pa.concat_arrays(parts) if parts else pa.array([], pa.list_(pa.int32()))

    return encode.asNondeterministic()(text)


def piece_text(ids: str | Column, model: str) -> Column:
    """The text of an id list; the empty text for null."""

    @F.arrow_udf("string")
    def decode(column: pa.Array) -> pa.Array:
        vocab = vocabulary(model)
        column = column.fill_null([])
        lengths = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        flat = column.flatten().to_numpy(zero_copy_only=False)
        return pa.array(vocab.decode(flat, lengths), pa.string())

    return decode.asNondeterministic()(ids)


def piece_round_trip(text: str | Column, model: str) -> Column:
    """`piece_ids` and their `piece_text` from one Python worker: struct of ids, text."""

    @F.arrow_udf("struct<ids array<int>, text string>")
    def code(column: pa.Array) -> pa.Array:
        vocab, ids, back = vocabulary(model), [], []
        for part in chunks(strings(column)):
            flat, lengths = vocab.encode(part)
            ids.append(list_array(flat, lengths))
            back.append(pa.array(vocab.decode(flat, lengths), pa.string()))
        if not ids:
            return pa.array([], pa.struct({"ids": pa.list_(pa.int32()), "text": pa.string()}))
        return pa.StructArray.from_arrays([pa.concat_arrays(ids), pa.concat_arrays(back)], ["ids", "text"])

    return code.asNondeterministic()(text)


def piece_round_trips(docs: DataFrame, model: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, ids, text) of every row, as `piece_round_trip`, handed on in small batches: a task
    holds the ids of about a million characters at a time, however many rows Spark sends."""

    def code(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(model)
        for batch in batches:
            at = 0
            for part in text_chunks(batch.column(1)):
                flat, lengths = vocab.encode(part)
                back = pa.array(vocab.decode(flat, lengths), pa.string())
                columns = [batch.column(0).slice(at, len(part)), list_array(flat, lengths), back]
                yield pa.RecordBatch.from_arrays(columns, ["id", "ids", "text"])
                at += len(part)

    kind = docs.schema[id].dataType.simpleString()
    rows = docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
    return rows.mapInArrow(code, f"id {kind}, ids array<int>, text string")
