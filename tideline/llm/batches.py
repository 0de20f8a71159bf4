"""Arrow batches inside tasks: string columns as lists, numpy arrays as list columns."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa

CHUNK_CHARS = 1_000_000


def chunks(texts: list[str], most: int = CHUNK_CHARS) -> Iterator[list[str]]:
    """`texts` in order, in lists of about `most` characters and no more than 50,000
    texts; a longer text is alone."""
    part: list[str] = []
    size = 0
    for text in texts:
        if part and (size + len(text) > most or len(part) == 50_000):
            yield part
            part, size = [], 0
        part.append(text)
        size += len(text)
    if part:
        yield part


def text_chunks(column: pa.Array, most: int = CHUNK_CHARS, rows: int = 500) -> Iterator[list[str]]:
    """As `chunks` of the column's texts (null is the empty text), of which no more than a
    chunk and `rows` further ones are there as Python strings at a time."""
    part: list[str] = []
    size = 0
    for at in range(0, len(column), rows):
        for text in strings(column.slice(at, rows)):
            if part and size + len(text) > most:
                yield part
                part, size = [], 0
            part.append(text)
            size += len(text)
    if part:
        yield part


def strings(column: pa.Array) -> list[str]:
    """The column's texts; null is the empty text."""
    return ["" if x is None else x for x in column.to_pylist()]


def list_array(values: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """A list column from flat values and the length of each row's list."""
    offsets = np.zeros(len(lengths) + 1, np.int32)
    np.cumsum(lengths, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The positions start .. start + length - 1 of every pair, one after another."""
    total = int(lengths.sum())
    ends = np.cumsum(lengths)
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)


def in_batches(table: Iterable[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """Batches of at most `rows` rows."""
    for batch in table:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
