"""Rows with vectors: which take part, and queries against blocks of rows.

Rows stand in blocks of about `BLOCK`, numbered by the operator. Each query is sent to the
blocks that it has to visit, both are dealt out by block, and a task goes through its blocks
in order: it holds the rows of one block and the queries of one Arrow batch, and keeps the
best entries of each query over all its blocks. Nothing depends on how many blocks or queries
there are, so a group of copies of any size is a run of blocks like others.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK = 1024
#: Blocks that a task works off, and tasks at most.
BLOCKS_A_TASK, TASKS = 4, 20_000
#: Scores computed at once; entries kept in a task before they are thinned out.
SCORES, KEPT = 2_000_000, 1_000_000


def finite(vector: Column) -> Column:
    """Whether there is a vector and all of its components are finite numbers."""
    whole = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & F.coalesce(whole, F.lit(False))


def of_one_length(rows: DataFrame, vector: str) -> tuple[DataFrame, int, int]:
    """The rows whose vector has the commonest length (of several the least), how many
    there are, and that length; lengths are few, and none of several is an error."""
    sizes = rows.groupBy(F.size(vector).alias("size")).count()
    found = sizes.agg(F.max_by(F.struct("size", "count"), F.struct("count", -F.col("size"))).alias("most")).first()
    if found.most is None:
        return rows, 0, 0
    return rows.where(F.size(vector) == found.most.size), found.most["count"], found.most.size


def some(rows: DataFrame, total: int, most: int) -> DataFrame:
    """About `most` of `total` rows, chosen by a hash of the row, and never twice as many."""
    share = min(2**30, -(-most * 2**30 // max(1, total)))
    return rows.where(F.pmod(F.xxhash64(*rows.columns), F.lit(2**30)) < share).limit(2 * most)


def matrix(column: pa.Array, kind=np.float64) -> np.ndarray:
    """A list column without nulls, all of one length, as a matrix."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def numbers(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False)


def first_of(keys: np.ndarray, scores: np.ndarray, ids: np.ndarray, most: int) -> np.ndarray:
    """Places of the best `most` entries of each key: highest score, then smallest id."""
    order = np.lexsort((ids, -scores, keys))
    sorted_keys = keys[order]
    begins = np.flatnonzero(np.diff(sorted_keys, prepend=~sorted_keys[:1]))
    nth = np.arange(len(order)) - np.repeat(begins, np.diff(np.r_[begins, len(order)]))
    return order[nth < most]


def best(scores: np.ndarray, allowed: np.ndarray, most: int, slack: np.ndarray | int) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of allowed entries that can be among a row's best `most`: those no
    more than `slack` under the `most`-th, so all that tie with it."""
    least = np.iinfo(scores.dtype).min // 2 if scores.dtype.kind == "i" else -np.inf
    shown = np.where(allowed, scores, least)
    if scores.shape[1] > most:
        cut = np.partition(shown, -most, axis=1)[:, -most]
        allowed = allowed & (shown >= (cut - slack)[:, None])
    return np.nonzero(allowed)


class Entries:
    """Entries (key, score, id) found in a task, of which the best of each key count. They
    are thinned out when many; what then still fills the place is handed on as it is."""

    def __init__(self, most: int, names: tuple[str, str, str]):
        self.most, self.names, self.parts, self.held = most, names, [], 0

    def add(self, keys: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> Iterator[pa.RecordBatch]:
        self.parts.append((keys, scores, ids))
        self.held += len(keys)
        if self.held > KEPT:
            self._thin()
            if self.held > KEPT // 2:
                yield from self.rest()

    def _thin(self) -> None:
        keys, scores, ids = (np.concatenate(x) for x in zip(*self.parts))
        at = first_of(keys, scores, ids, self.most)
        self.parts, self.held = [(keys[at], scores[at], ids[at])], len(at)

    def rest(self) -> Iterator[pa.RecordBatch]:
        if self.parts:
            self._thin()
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in self.parts[0]], list(self.names))
        self.parts, self.held = [], 0


Ask = Callable[[pa.RecordBatch, pa.RecordBatch], Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]]


def meet(
    rows: DataFrame, queries: DataFrame, blocks: int, ask: Ask, most: int, names: tuple[str, str, str], score: str
) -> DataFrame:
    """The best `most` entries (key, score, id) of each key.

    `rows` and `queries` both have `block` (long) and columns of their own, under different
    names. `ask` gets the rows of a block and some of its queries, as Arrow batches, and
    yields keys, scores and ids of entries. A block without rows answers nothing.
    """
    own, theirs = rows.columns, queries.columns
    both = rows.withColumn("asks", F.lit(False)).unionByName(
        queries.withColumn("asks", F.lit(True)), allowMissingColumns=True
    )
    tasks = min(TASKS, 1 + blocks // BLOCKS_A_TASK)
    dealt = both.repartition(tasks, "block").sortWithinPartitions("block", "asks")

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entries, block, held, table = Entries(most, names), None, [], None
        for batch in batches:
            place, asks = numbers(batch.column("block")), numbers(batch.column("asks"))
            edges = np.flatnonzero((np.diff(place) != 0) | (asks[1:] != asks[:-1])) + 1
            for a, b in zip([0, *edges.tolist()], [*edges.tolist(), batch.num_rows]):
                if b == a:
                    continue
                if place[a] != block:
                    block, held, table = place[a], [], None
                part = batch.slice(a, b - a)
                if not asks[a]:
                    held.append(part.select(own))
                elif held:
                    if table is None:
                        table = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                    step = max(1, SCORES // table.num_rows)
                    for at in range(0, b - a, step):
                        for found in ask(table, part.select(theirs).slice(at, step)):
                            yield from entries.add(*found)
        yield from entries.rest()

    kinds = f"{names[0]} long, {names[1]} {score}, {names[2]} long"
    return dealt.mapInArrow(work, kinds)
