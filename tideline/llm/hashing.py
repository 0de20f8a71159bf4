"""Hashes of words and shingles for whole batches of texts, without a loop over words."""

from __future__ import annotations

import numpy as np

#: Odd 64-bit multipliers of the hashes.
GOLDEN = np.uint64(0x9E3779B97F4A7C15)
MIX_A = np.uint64(0xBF58476D1CE4E5B9)
MIX_B = np.uint64(0x94D049BB133111EB)
BASE = np.uint64(0x100000001B3)

#: Bytes that belong to words: ASCII letters, digits, underscore, all of non-ASCII characters.
IN_WORD = np.zeros(256, bool)
IN_WORD[[*range(48, 58), *range(65, 91), 95, *range(97, 123), *range(128, 256)]] = True
#: ASCII letters in lower case, other bytes as they are.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def step(n: int) -> np.uint64:
    """The n-th of a row of odd multipliers."""
    return np.uint64((int(GOLDEN) * n | 1) % 2**64)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * MIX_A
    x = (x ^ (x >> np.uint64(27))) * MIX_B
    return x ^ (x >> np.uint64(31))


def run_hashes(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """A hash of each run of values `data[start : start + length]`; length is 1 or more
    and the runs are in order and do not overlap."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    powers = np.cumprod(np.full(int(lengths.max()), BASE, np.uint64))
    inside = np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    at = inside + np.repeat(starts, lengths)
    terms = (data[at].astype(np.uint64) + np.uint64(1)) * powers[inside]
    return mix(np.add.reduceat(terms, np.cumsum(lengths) - lengths))


def word_places(
    texts: list[str], full_lower: bool = False
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of each word of the texts, in order: hash, text number, first byte and length in
    the text's UTF-8, and the number of its line, counted through all texts.

    Words are runs of ASCII letters, digits, underscores and non-ASCII characters; ASCII
    letters count as lower case. `full_lower` lowers other letters too; then the bytes
    are those of the lowered text."""
    coded = [(t.lower() if full_lower else t).encode("utf-8", "replace") for t in texts]
    sizes = np.fromiter(map(len, coded), np.int64, len(coded)) + 1
    data = LOWER[np.frombuffer(b"\n".join(coded) + b"\n", np.uint8)]
    edge = np.diff(IN_WORD[data].astype(np.int8), prepend=0)
    starts = np.flatnonzero(edge == 1)
    lengths = np.flatnonzero(edge == -1) - starts
    ends = np.cumsum(sizes)
    owner = np.searchsorted(ends, starts, side="right")
    line = np.searchsorted(np.flatnonzero(data == 10), starts)
    return run_hashes(data, starts, lengths), owner, starts - (ends - sizes)[owner], lengths, line


def word_beginnings(texts: list[str], chars: tuple[int, ...]) -> list[np.ndarray]:
    """For each number of characters, a hash of that beginning of each word as found by
    `word_places`; 0 for words that are not longer than that."""
    data = LOWER[np.frombuffer("\n".join([*texts, ""]).encode("utf-8", "replace"), np.uint8)]
    edge = np.diff(IN_WORD[data].astype(np.int8), prepend=0)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    heads = np.flatnonzero((data & 0xC0) != 0x80)  # first bytes of characters
    first = np.searchsorted(heads, starts)
    out = []
    for n in chars:
        cut = heads[np.minimum(first + n, max(0, len(heads) - 1))]
        long = cut < ends
        found = np.zeros(len(starts), np.uint64)
        found[long] = run_hashes(data, starts[long], (cut - starts)[long])
        out.append(found)
    return out


def words(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text number of each word of the texts, in order, in lower case."""
    return word_places(texts, full_lower=True)[:2]


def shingles(texts: list[str], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text number of each run of `width` words, in order, with repeats. A text
    of fewer words has one shingle of them all, a text without words none."""
    word, owner = words(texts)
    counts = np.bincount(owner, minlength=len(texts))
    first = np.cumsum(counts) - counts
    made = np.maximum(counts - width + 1, np.minimum(counts, 1))
    shingle_owner = np.repeat(np.arange(len(texts)), made)
    at = np.arange(int(made.sum())) - np.repeat(np.cumsum(made) - made, made) + first[shingle_owner]
    left = first[shingle_owner] + counts[shingle_owner] - at
    padded = np.r_[word, np.zeros(width, np.uint64)]
    total = np.zeros(len(at), np.uint64)
    for j in range(width):
        part = padded[at + j] * step(j + 1)
        part[left <= j] = 0
        total += part
    return mix(total), shingle_owner


def distinct_shingles(texts: list[str], width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """48-bit hash, text number and count of each distinct shingle of each text, for at
    most 65,536 texts."""
    value, owner = shingles(texts, width)
    keys = np.sort((owner.astype(np.uint64) << np.uint64(48)) | (value >> np.uint64(16)))
    at = np.flatnonzero(np.diff(keys, prepend=~keys[:1]))
    keys, count = keys[at], np.diff(at, append=len(keys))
    return keys & np.uint64(2**48 - 1), (keys >> np.uint64(48)).astype(np.int64), count
