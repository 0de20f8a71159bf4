"""Nearest neighbours by inner product from an inverted multi-index.

Vectors are cut in two halves and each half is quantised by a codebook of its own; a pair of
centroids is a cell, and the rows of a cell are its entries. A query goes through the cells by
the sum of its halves' distances (a half's distance to a centroid is minus their inner
product), least first, by a heap over pairs of the two sorted lists, until the cells passed
hold `depth` entries. All entries of these cells are then scored on the original vectors.

The codebooks are fitted on about `SAMPLE` rows; every row is indexed. Centroids of a half
are as many as gives cells of about `CELL` rows, `CENTROIDS` at most, so what describes the
index (codebooks and the size of each cell) has a bounded size and goes to every task. The
depth is measured, not guessed: `PROBES` queries are compared with all rows, and the depth
is the share of all entries that a traversal has passed when it has met `aim` of their true
neighbours. Where vectors fall into clusters that is a small share; where they are spread
evenly, as random ones are, no index has a small one.

Since a traversal passes exactly the cells up to the summed distance of its last one, a query
is sent out with that one number; entries stand in blocks by cell (`vectors`), and a block's
task scores those of its rows whose cell is not beyond.

Defined results. Rows with a null id, a null, empty or zero vector, one with a null or
non-finite component, or of another length than most have, take no part. Rows that repeat
are candidates each; a row is never compared with rows of its own id. Ties go to the smaller
id. Scores are sums in order of the components, in double precision. Empty tables, and a
table of one row, give no rows. Further columns, whatever their names, are not looked at.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideline.llm import vectors
from tideline.llm.storage import stored

SAMPLE, CELL, CENTROIDS, ROUNDS, PROBES = 16_384, 32, 256, 10, 64
RESULT = "query long, rank int, id long, score double"


def centroids(points: np.ndarray, number: int) -> np.ndarray:
    """Means of groups of points, by Lloyd's rounds from evenly spaced distinct points."""
    if not points.shape[1]:
        return np.zeros((1, 0))
    distinct = np.unique(points, axis=0)
    means = distinct[np.linspace(0, len(distinct) - 1, min(number, len(distinct))).astype(int)]
    for _ in range(ROUNDS):
        group = nearest(points, means)
        size = np.bincount(group, minlength=len(means))
        sums = np.stack([np.bincount(group, column, len(means)) for column in points.T], axis=1)
        means = np.where(size[:, None] > 0, sums / np.maximum(size, 1)[:, None], means)
    return means


def nearest(points: np.ndarray, means: np.ndarray) -> np.ndarray:
    return ((means**2).sum(axis=1) - 2 * points @ means.T).argmin(axis=1)


@dataclass
class Index:
    """Codebooks of both halves and the number of entries of each cell (row by first half)."""

    first: np.ndarray
    second: np.ndarray
    sizes: np.ndarray

    @property
    def half(self) -> int:
        return self.first.shape[1]

    def cells(self, x: np.ndarray) -> np.ndarray:
        return nearest(x[:, : self.half], self.first) * len(self.second) + nearest(x[:, self.half :], self.second)

    def distances(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of each row of `x`, the distance of its halves to all centroids."""
        return -(x[:, : self.half] @ self.first.T), -(x[:, self.half :] @ self.second.T)

    def reach(self, one: np.ndarray, two: np.ndarray, depth: int) -> float:
        """The summed distance of the cell at which the cells passed hold `depth` entries."""
        by_one, by_two = np.argsort(one, kind="stable"), np.argsort(two, kind="stable")
        sizes = self.sizes.reshape(len(one), len(two))[by_one][:, by_two].tolist()
        one, two = one[by_one].tolist(), two[by_two].tolist()
        heap, held, reached = [(one[0] + two[0], 0, 0)], 0, -np.inf
        while heap and held < depth:
            reached, i, j = heapq.heappop(heap)
            held += sizes[i][j]
            if j + 1 < len(two):
                heapq.heappush(heap, (one[i] + two[j + 1], i, j + 1))
            if j == 0 and i + 1 < len(one):
                heapq.heappush(heap, (one[i + 1] + two[0], i + 1, 0))
        return reached


def prepared(df: DataFrame, id: str, vector: str) -> tuple[DataFrame, int, int]:
    """Rows (id, x) that take part, stored; how many, and their length."""
    rows = df.select(F.col(id).cast("long").alias("id"), F.col(vector).alias("x"))
    rows = rows.where(F.col("id").isNotNull() & vectors.finite(F.col("x")) & F.exists("x", lambda x: x != 0))
    rows, total, size = vectors.of_one_length(rows, "x")
    return stored(rows, "vectors"), total, size


def indexed(rows: DataFrame, total: int, size: int) -> tuple[DataFrame, Index]:
    """Rows (id, x, cell) of the index, stored, and what describes it."""
    sample = vectors.some(rows, total, SAMPLE).toArrow().column("x").combine_chunks()
    points = vectors.matrix(sample) if len(sample) else np.zeros((1, size))
    number = max(1, min(CENTROIDS, round((total / CELL) ** 0.5)))
    half = -(-size // 2)
    index = Index(centroids(points[:, :half], number), centroids(points[:, half:], number), np.zeros(0))

    @F.arrow_udf("int")
    def cell(x: pa.Array) -> pa.Array:
        return pa.array(index.cells(vectors.matrix(x)).astype(np.int32))

    entries = stored(rows.select("id", "x", cell("x").alias("cell")), "index")
    index.sizes = np.zeros(len(index.first) * len(index.second), np.int64)
    for row in entries.groupBy("cell").count().collect():  # a row a cell: CENTROIDS squared at most
        index.sizes[row.cell] = row["count"]
    return entries, index


def in_order(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of the rows of `a` and `b`, summed in order of the components."""
    return np.cumsum(a * b, axis=1)[:, -1]


def scored(x: np.ndarray, rows: np.ndarray, allowed: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Place in `x`, place in `rows` and score of pairs that can be among the best `most`."""
    rough = x @ rows.T
    norms = np.sqrt((x**2).sum(axis=1)), np.sqrt((rows**2).sum(axis=1).max())
    slack = 4 * np.finfo(np.float64).eps * x.shape[1] * norms[0] * norms[1]
    q, r = vectors.best(rough, allowed, most, slack)
    return q, r, in_order(x[q], rows[r])


def measured_depth(entries: DataFrame, index: Index, queries: DataFrame, asked: int, k: int, aim: float) -> int:
    """How many entries a traversal passes until it has met `aim` of the true `k` nearest, over
    some queries that are compared with every row."""
    probes = vectors.some(queries.select("id", "x"), asked, PROBES).toArrow()
    if not probes.num_rows:
        return 0
    keys = vectors.numbers(probes.column("id").combine_chunks())
    x = vectors.matrix(probes.column("x").combine_chunks())

    def near(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = vectors.Entries(k, ("probe", "score", "cell"))
        for batch in batches:
            rows, ids = vectors.matrix(batch.column("x")), vectors.numbers(batch.column("id"))
            cells = vectors.numbers(batch.column("cell")).astype(np.int64)
            for at in range(0, len(rows), vectors.BLOCK):
                part = slice(at, at + vectors.BLOCK)
                q, r, score = scored(x, rows[part], keys[:, None] != ids[part], k)
                yield from found.add(q, score, cells[part][r])
        yield from found.rest()

    met = entries.mapInArrow(near, "probe long, score double, cell long")
    place = F.row_number().over(Window.partitionBy("probe").orderBy(F.desc("score"), "cell"))
    truth = met.withColumn("place", place).where(F.col("place") <= k).select("probe", "cell").collect()
    if not truth:
        return 0
    passed = []
    for probe, (one, two) in enumerate(zip(*index.distances(x))):
        order = np.argsort((one[:, None] + two).ravel(), kind="stable")
        upto = np.empty(len(order), np.int64)
        upto[order] = np.cumsum(index.sizes[order])
        passed += [int(upto[t.cell]) for t in truth if t.probe == probe]
    return int(np.quantile(passed, aim, method="higher"))


def nearest_neighbours(
    df: DataFrame, asks: Column, k: int = 20, id: str = "vec_id", vector: str = "embedding", aim: float = 0.97
) -> DataFrame:
    """(query, rank, id, score) of the `k` nearest found for each row whose id fulfils `asks`,
    a condition on the column `id`. `aim` is the recall that the depth is measured for."""
    spark = df.sparkSession
    rows, total, size = prepared(df, id, vector)
    if not total:
        return spark.createDataFrame([], RESULT)
    entries, index = indexed(rows, total, size)
    queries = stored(
        rows.where(asks).select("id", "x", F.monotonically_increasing_id().alias("key")), "queries"
    )
    depth = measured_depth(entries, index, queries, queries.count(), k, aim)
    begins = np.cumsum(index.sizes) - index.sizes
    blocks = -(-total // vectors.BLOCK)

    @F.arrow_udf("struct<reach: double, blocks: array<long>>")
    def visits(x: pa.Array) -> pa.Array:
        points, reaches, visited = vectors.matrix(x), [], []
        for one, two in zip(*index.distances(points)):
            reach = index.reach(one, two, depth)
            reach += 1e-9 * (np.abs(one).max() + np.abs(two).max())  # sums differ in their last digits
            cells = np.flatnonzero(~((one[:, None] + two).ravel() > reach) & (index.sizes > 0))
            first, last = begins[cells] // vectors.BLOCK, (begins[cells] + index.sizes[cells] - 1) // vectors.BLOCK
            spans = np.zeros(blocks + 1, np.int64)
            np.add.at(spans, first, 1)
            np.add.at(spans, last + 1, -1)
            reaches.append(reach)
            visited.append(np.flatnonzero(np.cumsum(spans[:-1])))
        lengths = np.array([len(v) for v in visited], np.int32)
        offsets = pa.array(np.r_[0, np.cumsum(lengths)].astype(np.int32))
        lists = pa.ListArray.from_arrays(offsets, pa.array(np.concatenate([*visited, np.zeros(0, np.int64)])))
        return pa.StructArray.from_arrays([pa.array(reaches, pa.float64()), lists], ["reach", "blocks"])

    @F.arrow_udf("long")
    def block(cell: pa.Array, dealt: pa.Array) -> pa.Array:
        cells = vectors.numbers(cell)
        place = begins[cells] + vectors.numbers(dealt) % np.maximum(1, index.sizes[cells])
        return pa.array(place // vectors.BLOCK)

    dealt = F.xxhash64("id", F.monotonically_increasing_id()).bitwiseAND(F.lit(2**62 - 1))
    stands = entries.select("id", "x", "cell", block("cell", dealt).alias("block"))
    asked = queries.withColumn("found", visits.asNondeterministic()("x")).select(
        "key",
        F.col("id").alias("query"),
        F.col("x").alias("q"),
        F.col("found.reach").alias("reach"),
        F.explode("found.blocks").alias("block"),
    )

    def ask(rows: pa.RecordBatch, queries: pa.RecordBatch):
        x, q = vectors.matrix(rows.column("x")), vectors.matrix(queries.column("q"))
        ids, cells = vectors.numbers(rows.column("id")), vectors.numbers(rows.column("cell"))
        one, two = index.distances(q)
        far = one[:, cells // len(index.second)] + two[:, cells % len(index.second)]
        reach, own = vectors.numbers(queries.column("reach")), vectors.numbers(queries.column("query"))
        allowed = ~(far > reach[:, None]) & (ids != own[:, None])
        a, b, score = scored(q, x, allowed, k)
        yield vectors.numbers(queries.column("key"))[a], score, ids[b]

    found = vectors.meet(stands, asked, blocks, ask, k, ("key", "score", "id"), "double")
    place = F.row_number().over(Window.partitionBy("key").orderBy(F.desc("score"), "id"))
    named = queries.select("key", F.col("id").alias("query"))
    return (
        found.withColumn("rank", place)
        .where(F.col("rank") <= k)
        .join(named, "key")
        .select("query", "rank", "id", "score")
    )
