"""Repeated passages across documents, by sliding runs of consecutive sentences.

A sentence ends at a line end, or after one of `. ! ?` and other signs that white space
follows. Passages may begin and end inside sentences, so sentences are cut further, into
pieces: the word with the least hash of any `NEAR` consecutive ones begins a piece, all of
them in a tie. Where pieces begin depends on the words near it only, and no piece has more
than `NEAR` words. Words compare in lower case.

Of each text these runs are hashed:

- from every piece on, the fewest pieces that have `least_words` words;
- up to every piece's end, the fewest pieces that have `least_words` words;
- any `several` consecutive sentences, however short;
- the whole text, if it has none of these.

All runs are grouped by hash over the whole corpus. The first place of a hash is the one
with the least document id, then the least position; pieces covered by any run in another
place are removed whole, with the white space after them. In one text a run is a repeat
only if it does not overlap the first of its hash. A text that loses all its words is
empty. Two texts that share `least_words + 3 * NEAR - 2` words in a row share a run, and of
what they share `NEAR` words at most are left at either end; shared sentences that have
`least_words` words, or `several` of them, go whole.

Only hashes and positions are shuffled, combined by hash before the first shuffle. The hashes
that repeat set bits in an array of `MOST_BITS` bits at most, which every task gets, and runs
whose bit is not set are left out before the second one; hashes that share a bit by
chance are told apart by the join, so results do not depend on the array's size. Adaptive
execution can split a hot hash in that join.

Null and empty texts, and those without a word, stay as they are. Long texts are handled
whole. Rows with equal id and text count as one document and get the same result; of equal
ids with different texts, the text hash decides which is earlier. A null id counts as the
least number. An empty table gives an empty result; further columns are not looked at.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.llm.batches import chunks, list_array, strings
from tideline.llm.hashing import BASE, mix, step, word_places
from tideline.llm.storage import sized, stored

NEAR = 10  # words
LEAST = 20  # words
SEVERAL = 3  # sentences
MOST_BITS = 2**27  # 16 MB
END = re.compile(r"[.!?]+[^\w\s]*\s+|\n\s*")
#: A word as `word_places` finds them, with the signs and white space that close it.
WORD = re.compile(r"[0-9A-Za-z_\x80-\U0010ffff]+(?:[^\s0-9A-Za-z_\x80-\U0010ffff]*\s+)?")


def sentences(text: str) -> list[int]:
    """Where each sentence begins, then the text's length."""
    begins = [0, *(m.end() for m in END.finditer(text))]
    return [*begins, len(text)] if begins[-1] < len(text) else begins


def runs(
    texts: list[str], several: int = SEVERAL, least_words: int = LEAST
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text number, first word, number of words and hash of each run, by text, hash and
    first word; runs that are found in two ways stand there once."""
    parts, part_text = [], []
    for n, text in enumerate(texts):
        places = sentences(text)
        parts += [text[a:b] for a, b in zip(places, places[1:])]
        part_text += [n] * (len(places) - 1)
    word, part = word_places(parts, full_lower=True)[:2]
    owner = np.array(part_text, np.int64)[part]
    total = len(word)
    size = np.bincount(owner, minlength=len(texts))
    begin = np.cumsum(size) - size
    end = begin + size
    opens = np.flatnonzero(np.diff(part, prepend=-1))  # first words of sentences
    cut = _least(word, end[owner] - np.arange(total) >= NEAR)
    cut[opens] = True
    starts = np.flatnonzero(cut)
    edges = np.r_[starts, total]

    until = np.searchsorted(edges, starts + least_words)
    onward = starts + least_words <= end[owner[starts]]
    closes = edges[1:]
    since = edges[np.maximum(np.searchsorted(edges, closes - least_words, side="right") - 1, 0)]
    back = closes - least_words >= begin[owner[starts]]
    ends = np.r_[opens, total, np.full(several - 1, total + 1)][several:]
    many = ends <= end[owner[opens]]
    first = np.r_[starts[onward], since[back], opens[many]]
    last = np.r_[edges[until[onward]], closes[back], ends[many]]
    found = np.bincount(owner[first], minlength=len(texts))
    whole = np.flatnonzero((found == 0) & (size > 0))
    first, last = np.r_[first, begin[whole]], np.r_[last, end[whole]]

    value = _run_hashes(word, first, last)
    order = np.lexsort((first, value, owner[first]))
    first, last, value = first[order], last[order], value[order]
    new = np.ones(len(first), bool)
    new[1:] = (np.diff(first) != 0) | (np.diff(last) != 0)
    first, last, value = first[new], last[new], value[new]
    at = owner[first]
    return at, first - begin[at], last - first, value


def _run_hashes(word: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """A hash of the words `first` to `last` (exclusive) of each run, from sums of the word
    hashes times powers of an odd number, which are taken back to the run's own place."""
    size = len(word) + 1
    powers = np.cumprod(np.r_[np.uint64(1), np.full(size - 1, BASE, np.uint64)])
    back = np.cumprod(np.r_[np.uint64(1), np.full(size - 1, np.uint64(pow(int(BASE), -1, 2**64)), np.uint64)])
    sums = np.r_[np.uint64(0), np.cumsum(word * powers[:-1], dtype=np.uint64)]
    return mix((sums[last] - sums[first]) * back[first] + (last - first).astype(np.uint64) * step(3))


def _least(value: np.ndarray, full: np.ndarray) -> np.ndarray:
    """Whether each value is the least of any `NEAR` consecutive ones; `full` tells where
    such a group begins."""
    size = len(value)
    padded = np.r_[value, np.full(NEAR, 2**64 - 1, np.uint64)]
    least = value.copy()
    for j in range(1, NEAR):
        np.minimum(least, padded[j : j + size], out=least)
    most = np.zeros(size, np.uint64)
    least[~full] = 0
    for j in range(min(NEAR, size)):
        np.maximum(most[j:], least[: size - j], out=most[j:])
    inside = np.zeros(size, bool)
    for j in range(min(NEAR, size)):
        inside[j:] |= full[: size - j]
    return inside & (value == most)


RUNS = (
    "rank long, key long, hash array<long>, first array<int>, size array<int>, "
    "again_first array<int>, again_size array<int>"
)


def _run_rows(several: int, least_words: int):
    def make(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = 0
            for texts in chunks(strings(batch.column("text"))):
                owner, first, size, value = runs(texts, several, least_words)
                new = np.ones(len(owner), bool)
                new[1:] = (np.diff(owner) != 0) | (value[1:] != value[:-1])
                head = np.flatnonzero(new)[np.cumsum(new) - 1]
                again = first >= (first + size)[head]
                rows = batch.slice(done, len(texts))
                done += len(texts)
                columns = [rows.column("rank"), rows.column("key"), _lists(value.view(np.int64), owner, new, texts)]
                for kept in (new, again):
                    columns += [_lists(x.astype(np.int32), owner, kept, texts) for x in (first, size)]
                yield pa.RecordBatch.from_arrays(
                    columns, ["rank", "key", "hash", "first", "size", "again_first", "again_size"]
                )

    return make


def _lists(values: np.ndarray, owner: np.ndarray, kept: np.ndarray, texts: list[str]) -> pa.ListArray:
    return list_array(values[kept], np.bincount(owner[kept], minlength=len(texts)))


def _bits(repeated: DataFrame) -> bytes:
    """An array of bits, set at the lower part of each hash: about 16 bits a hash, and no
    more than `MOST_BITS`."""
    count = min(MOST_BITS, max(2**15, 2 ** (16 * repeated.count()).bit_length()))
    place = F.col("hash").bitwiseAND(F.lit(count - 1))
    blocks = (
        repeated.select(F.shiftright(place, 15).alias("block"), place.bitwiseAND(F.lit(2**15 - 1)).alias("bit"))
        .groupBy("block")
        .agg(F.bitmap_construct_agg("bit").alias("bits"))
    )
    out = bytearray(count // 8)
    for row in blocks.toLocalIterator():
        out[row["block"] * 4096 : (row["block"] + 1) * 4096] = row["bits"]
    return bytes(out)


def _may_repeat(bits: bytes):
    """(rank, tag, hash, first, size) of the runs whose hash has its bit set."""

    def make(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.frombuffer(bits, np.uint8)
        for batch in batches:
            hashes = batch.column("hash").flatten()
            place = hashes.to_numpy().view(np.uint64) & np.uint64(len(bits) * 8 - 1)
            hit = (held[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & 1
            kept = pa.array(hit.astype(bool))
            row = pc.list_parent_indices(batch.column("hash")).filter(kept)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("rank").take(row),
                    batch.column("tag").take(row),
                    hashes.filter(kept),
                    batch.column("first").flatten().filter(kept),
                    batch.column("size").flatten().filter(kept),
                ],
                ["rank", "tag", "hash", "first", "size"],
            )

    return make


def removed_spans(text: str, first: np.ndarray, size: np.ndarray) -> list[tuple[int, int]]:
    """The spans of the runs with these first words and numbers of words."""
    begins, ends = [], []
    places = sentences(text)
    for a, b in zip(places, places[1:]):
        found = [m.end() for m in WORD.finditer(text, a, b)]
        if found:
            begins += [a, *found[:-1]]
            ends += [*found[:-1], b]
    gone = np.bincount(first, minlength=len(begins) + 1) - np.bincount(first + size, minlength=len(begins) + 1)
    gone = (np.cumsum(gone) > 0).astype(np.int8)
    if gone[:-1].all():
        return [(0, len(text))]
    edges = np.flatnonzero(np.diff(gone, prepend=0))
    return [(begins[a], ends[b - 1]) for a, b in zip(edges[::2].tolist(), edges[1::2].tolist())]


KEPT = "struct<text string, removed array<struct<start int, end int>>>"
KEPT_ARROW = pa.struct({
    "text": pa.string(),
    "removed": pa.list_(pa.struct({"start": pa.int32(), "end": pa.int32()})),
})
ROWS = 200  # texts that are there as Python strings at a time


def _without(text: Column, covered: Column) -> Column:
    @F.arrow_udf(KEPT)
    def cut(texts: pa.Array, runs_of: pa.Array) -> pa.Array:
        ends = runs_of.offsets.to_numpy()
        first, size = (runs_of.values.field(x).to_numpy() for x in ("first", "size"))
        parts = [pa.array([], KEPT_ARROW)]
        for at in range(0, len(texts), ROWS):
            out = []
            for n, text in enumerate(texts.slice(at, ROWS).to_pylist(), at):
                own = slice(ends[n], ends[n + 1])
                spans = removed_spans(text, first[own], size[own]) if text and ends[n] < ends[n + 1] else []
                bounds = [0, *(x for span in spans for x in span), len(text or "")]
                left = "".join(text[a:b] for a, b in zip(bounds[::2], bounds[1::2])) if spans else text
                out.append({"text": left, "removed": [{"start": a, "end": b} for a, b in spans]})
            parts.append(pa.array(out, KEPT_ARROW))
        return pa.concat_arrays(parts)

    return cut(text, covered)


def without_repeats(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    several: int = SEVERAL,
    least_words: int = LEAST,
) -> DataFrame:
    """(id, text, removed) of every row: the text without its repeated passages, and the
    removed spans of the old text (code points, end exclusive)."""
    rows = docs.select(
        F.col(id).cast("long").alias("id"), F.xxhash64(F.col(text)).alias("key"), F.col(text).alias("text")
    ).withColumn("rank", F.coalesce("id", F.lit(-(2**63))))
    found = stored(rows.mapInArrow(_run_rows(several, least_words), RUNS), "runs")
    differ = found.groupBy("rank").agg(F.min("key").alias("least"), F.max("key").alias("most")).where("least < most")
    differ = sized(stored(differ.select("rank", F.lit(True).alias("differ")), "differ"))
    tied = not differ.isEmpty()

    def tagged(df: DataFrame) -> DataFrame:
        """With `tag`, the text's hash where texts differ under an id, else 0."""
        if not tied:
            return df.withColumn("tag", F.lit(0).cast("long"))
        return df.join(differ, "rank", "left").withColumn("tag", F.when(F.col("differ"), F.col("key")).otherwise(0))

    found = tagged(found)
    repeated = stored(
        found.select("rank", F.explode("hash").alias("hash"))
        .groupBy("hash")
        .agg(F.min("rank").alias("least"), F.max("rank").alias("most"))
        .where("least < most")
        .select("hash", "least"),
        "repeated",
    )
    placed = found.select("rank", "tag", "hash", "first", "size")
    shape = "rank long, tag long, hash long, first int, size int"
    likely = placed.mapInArrow(_may_repeat(_bits(repeated)), shape)
    later = likely.join(repeated, "hash").where("rank > least").select("rank", "tag", "first", "size")
    again = F.explode(F.arrays_zip("again_first", "again_size"))
    later = later.unionAll(
        found.select("rank", "tag", again.alias("run")).select("rank", "tag", "run.again_first", "run.again_size")
    )
    if tied:
        own = placed.join(differ, "rank", "left_semi").select(
            "rank", "tag", F.explode(F.arrays_zip("hash", "first", "size")).alias("run")
        ).select("rank", "tag", "run.hash", "run.first", "run.size")
        ties = stored(
            own.groupBy("rank", "hash")
            .agg(F.min("tag").alias("least"), F.max("tag").alias("most"))
            .where("least < most")
            .select("rank", "hash", "least"),
            "ties",
        )
        both = own.join(ties, ["rank", "hash"]).where("tag > least")
        later = later.unionAll(both.select("rank", "tag", "first", "size"))
    covered = stored(
        later.groupBy("rank", "tag").agg(F.collect_list(F.struct("first", "size")).alias("covered")), "covered"
    )
    joined = tagged(rows).join(covered, ["rank", "tag"], "left").select(
        "id", _without(F.col("text"), F.col("covered")).alias("kept")
    )
    return joined.select(F.col("id").alias(id), F.col("kept.text").alias("text"), F.col("kept.removed").alias("removed"))
