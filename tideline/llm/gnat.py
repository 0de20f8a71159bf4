"""Hard negatives by a multiway hyperplane tree (a geometric near-neighbour access tree).

Scores are integer inner products of the vectors' components times 256, rounded down. A row of
the tree's space has one more component, which brings all rows to the largest norm; then the
distance of an anchor (its further component is 0) falls as its score grows, and a window of
scores is an annulus of distances around the anchor.

The tree is laid out on about `SAMPLE` rows: a node has up to `WAYS` split points, each as
far as can be from those before, and a row belongs to its nearest one, so siblings are parted by
hyperplanes. Every row of the table goes down to its leaf, and every split point stores the least
and greatest distance to all rows of each sibling subtree. Both the layout and these ranges
have a bounded size and go to every task.

A search gives each anchor an annulus. With distance d from the anchor to a split point, rows in
the annulus are between `max(near - d, d - far)` and `d + far` away from that point; a sibling
whose range does not meet that is left out. Leaves that remain are scored exactly, in blocks
(`vectors`). Four turns: an anchor's own leaf bounds its positives' scores from below; rows
within that bound give the positives; negatives are searched in the annuli of their windows. A
leaf of any size, as one of copies, is a run of blocks.

Defined results. Rows with a null id, label or vector, with a null or non-finite component, of
another length than most have, or with a component beyond 2^16 (whose products might not fit
64 bits) take no part. Rows that repeat count each; a row is never compared with rows of its
own id. Ties go to the smaller id. Negative positive scores have an empty window. An anchor
without other rows of its label gives no rows, as do empty tables. Further columns, whatever
their names, are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideline.llm import vectors
from tideline.llm.storage import stored

SAMPLE, WAYS, LEAF, DEPTH = 8_192, 8, 512, 8
#: Fixed value: components are multiplied by this and rounded down.
SCALE = 256
LARGEST = 2.0**16
RESULT = (
    "anchor long, positive long, rank int, negative long, positive_score long, negative_score long"
)


@dataclass
class Node:
    """Split points in the tree's space; children are numbers of nodes or, from -1 down, leaves;
    `least[i, j]` and `greatest[i, j]` are distances from point i to rows of child j."""

    points: np.ndarray
    children: list[int]
    least: np.ndarray = field(init=False)
    greatest: np.ndarray = field(init=False)

    def __post_init__(self):
        ways = len(self.points)
        self.least, self.greatest = np.full((ways, ways), np.inf), np.full((ways, ways), -np.inf)

    def distances(self, x: np.ndarray) -> np.ndarray:
        square = (x**2).sum(axis=1)[:, None] + (self.points**2).sum(axis=1) - 2 * x @ self.points.T
        return np.sqrt(np.maximum(square, 0))


class Tree:
    """Nodes, the first being the root, and the number of leaves; no nodes: one leaf. `peak` is
    the greatest square of a row's norm."""

    def __init__(self, sample: np.ndarray, total: int, peak: float):
        self.nodes: list[Node] = []
        self.leaves, self.peak, self.share = 0, peak, total / max(1, len(sample))
        self._grow(self.raised(sample), 0)

    def _grow(self, x: np.ndarray, depth: int) -> int:
        """The number of the new node, or of the leaf, for these rows of the sample."""
        points = _far_apart(x) if depth < DEPTH and len(x) * self.share > LEAF and len(x) > 2 * WAYS else []
        if len(points) < 2:
            self.leaves += 1
            return -self.leaves
        node, at = Node(points, []), len(self.nodes)
        self.nodes.append(node)
        child = node.distances(x).argmin(axis=1)
        node.children = [self._grow(x[child == j], depth + 1) for j in range(len(points))]
        return at

    def raised(self, x: np.ndarray) -> np.ndarray:
        """Rows in the tree's space."""
        return np.c_[x, np.sqrt(np.maximum(self.peak - (x**2).sum(axis=1), 0))]

    def _down(self, x: np.ndarray, at: int, rows: np.ndarray, leaf: np.ndarray, ranges: bool) -> None:
        if at < 0:
            leaf[rows] = -at - 1
            return
        node = self.nodes[at]
        far = node.distances(x[rows])
        child = far.argmin(axis=1)
        for j, below in enumerate(node.children):
            own = child == j
            if own.any():
                if ranges:
                    node.least[:, j] = np.minimum(node.least[:, j], far[own].min(axis=0))
                    node.greatest[:, j] = np.maximum(node.greatest[:, j], far[own].max(axis=0))
                self._down(x, below, rows[own], leaf, ranges)

    def leaf_of(self, x: np.ndarray, ranges: bool = False) -> np.ndarray:
        """The leaf of each point of the tree's space; `ranges` widens the stored ranges."""
        leaf = np.zeros(len(x), np.int64)
        self._down(x, 0 if self.nodes else -1, np.arange(len(x)), leaf, ranges)
        return leaf

    def surviving(self, x: np.ndarray, near: np.ndarray, far: np.ndarray) -> np.ndarray:
        """Whether each leaf can hold rows that are `near` to `far` away from each point."""
        out = np.zeros((len(x), self.leaves), bool)
        slack = 1e-6 * np.sqrt(self.peak + (x**2).sum(axis=1).max(initial=0)) + 1e-9
        self._survive(x, near, far, slack, 0 if self.nodes else -1, np.arange(len(x)), out)
        return out

    def _survive(self, x, near, far, slack, at, rows, out) -> None:
        if at < 0:
            out[rows, -at - 1] = True
            return
        node = self.nodes[at]
        d = node.distances(x[rows])
        low = np.maximum(near[rows, None] - d, d - far[rows, None]) - slack
        high = d + far[rows, None] + slack
        for j, below in enumerate(node.children):
            meets = ((low <= node.greatest[:, j]) & (high >= node.least[:, j])).all(axis=1)
            if meets.any():
                self._survive(x, near, far, slack, below, rows[meets], out)


def _far_apart(x: np.ndarray) -> np.ndarray:
    """Up to `WAYS` different rows, each as far as can be from those before."""
    chosen = [0]
    apart = ((x - x[0]) ** 2).sum(axis=1)
    while len(chosen) < WAYS and apart.max() > 0:
        chosen.append(int(apart.argmax()))
        apart = np.minimum(apart, ((x - x[chosen[-1]]) ** 2).sum(axis=1))
    return x[chosen]


def prepared(df: DataFrame, id: str, label: str | Column, vector: str) -> tuple[DataFrame, int, int]:
    """Rows (id, label, x) that take part, `x` being whole numbers, stored; how many; length."""
    label = F.col(label) if isinstance(label, str) else label
    rows = df.select(F.col(id).cast("long").alias("id"), label.alias("label"), F.col(vector).alias("v"))
    small = F.forall("v", lambda x: F.abs(x) <= LARGEST)
    rows = rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & vectors.finite(F.col("v")) & small)
    whole = F.transform("v", lambda x: F.floor(x.cast("double") * SCALE).cast("int"))
    rows, total, size = vectors.of_one_length(rows.select("id", "label", whole.alias("x")), "x")
    return stored(rows, "vectors"), total, size


@dataclass
class Forest:
    """A tree over a table: its rows (id, label, x, leaf), stored, and rows of each leaf."""

    rows: DataFrame
    tree: Tree
    sizes: np.ndarray

    @property
    def begins(self) -> np.ndarray:
        return np.cumsum(self.sizes) - self.sizes

    @property
    def blocks(self) -> int:
        return -(-int(self.sizes.sum()) // vectors.BLOCK)


def planted(rows: DataFrame, total: int, size: int) -> Forest:
    """Lays out the tree, sends every row to its leaf and measures the ranges of all siblings."""
    square = F.aggregate("x", F.lit(0).cast("long"), lambda a, x: a + x.cast("long") * x.cast("long"))
    peak = float(rows.agg(F.max(square)).first()[0])
    sample = vectors.some(rows, total, SAMPLE).toArrow().column("x").combine_chunks()
    tree = Tree(vectors.matrix(sample) if len(sample) else np.zeros((0, size)), total, peak)

    @F.arrow_udf("int")
    def leaf(x: pa.Array) -> pa.Array:
        return pa.array(tree.leaf_of(tree.raised(vectors.matrix(x))).astype(np.int32))

    leafed = stored(rows.withColumn("leaf", leaf("x")), "leaves")

    def measure(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tree.leaf_of(tree.raised(vectors.matrix(batch.column("x"))), ranges=True)
        for at, node in enumerate(tree.nodes):
            i, j = np.nonzero(np.isfinite(node.least))
            columns = [np.full(len(i), at), i, j, node.least[i, j], node.greatest[i, j]]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["node", "i", "j", "least", "greatest"])

    kinds = "node long, i long, j long, least double, greatest double"
    ranges = leafed.select("x").mapInArrow(measure, kinds).groupBy("node", "i", "j")
    for row in ranges.agg(F.min("least").alias("least"), F.max("greatest").alias("greatest")).collect():
        node = tree.nodes[row.node]  # WAYS squared rows a node at most, and nodes as the sample allows
        node.least[row.i, row.j], node.greatest[row.i, row.j] = row.least, row.greatest
    sizes = np.zeros(tree.leaves, np.int64)
    for row in leafed.groupBy("leaf").count().collect():  # a row a leaf
        sizes[row.leaf] = row["count"]
    return Forest(leafed, tree, sizes)


def standing(forest: Forest) -> DataFrame:
    """Rows with their block: leaves follow each other, a row's place in its leaf is by hash."""
    begins, sizes = forest.begins, forest.sizes

    @F.arrow_udf("long")
    def block(leaf: pa.Array, dealt: pa.Array) -> pa.Array:
        at = vectors.numbers(leaf)
        return pa.array((begins[at] + vectors.numbers(dealt) % np.maximum(1, sizes[at])) // vectors.BLOCK)

    dealt = F.xxhash64("id", F.monotonically_increasing_id()).bitwiseAND(F.lit(2**62 - 1))
    return forest.rows.select("id", "label", "x", block("leaf", dealt).alias("block"))


def visited(forest: Forest, own_leaf: bool) -> Column:
    """Blocks that the anchor `q` has to visit for scores `low` to `high` (lists of bounds of
    windows; null is no bound), or those of its own leaf."""
    tree, begins, sizes = forest.tree, forest.begins, forest.sizes
    blocks = forest.blocks

    @F.arrow_udf("array<long>")
    def visits(q: pa.Array, low: pa.Array, high: pa.Array) -> pa.Array:
        x = vectors.matrix(q)
        raised = np.c_[x, np.zeros(len(x))]
        if own_leaf:
            alive = np.zeros((len(x), tree.leaves), bool)
            alive[np.arange(len(x)), tree.leaf_of(raised)] = True
        else:
            owner = np.repeat(np.arange(len(x)), np.diff(low.offsets.to_numpy()))
            reach = (x**2).sum(axis=1)[owner] + tree.peak
            lows = vectors.numbers(low.flatten().cast(pa.float64()).fill_null(-np.inf))
            highs = vectors.numbers(high.flatten().cast(pa.float64()).fill_null(np.inf))
            near, far = (np.sqrt(np.maximum(reach - 2 * s, 0)) for s in (highs, lows))
            alive = np.zeros((len(x), tree.leaves), bool)
            np.logical_or.at(alive, owner, tree.surviving(raised[owner], near, far))
        out = []
        for leaves in alive:
            at = np.flatnonzero(leaves & (sizes > 0))
            spans = np.zeros(blocks + 1, np.int64)
            np.add.at(spans, begins[at] // vectors.BLOCK, 1)
            np.add.at(spans, (begins[at] + sizes[at] - 1) // vectors.BLOCK + 1, -1)
            out.append(np.flatnonzero(np.cumsum(spans[:-1])).tolist())
        return pa.array(out, pa.list_(pa.int64()))

    return visits.asNondeterministic()("q", "low", "high")


def whole_scores(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers, exact: in doubles where none can reach 2^53."""
    most = float(np.abs(q).max(initial=0)) * float(np.abs(x).max(initial=0)) * x.shape[1]
    if most < 2**53:
        return (q @ x.T).astype(np.int64)
    return q.astype(np.int64) @ x.astype(np.int64).T


def _asked(anchors: DataFrame, forest: Forest, own_leaf: bool, *columns: str) -> DataFrame:
    blocks = F.explode(visited(forest, own_leaf)).alias("block")
    return anchors.select("key", "anchor", "kind", "q", *columns, blocks)


def _placed(found: DataFrame, key: str, most: int) -> DataFrame:
    place = F.row_number().over(Window.partitionBy(key).orderBy(F.desc("score"), "id"))
    return found.withColumn("place", place).where(F.col("place") <= most)


def same_label(forest: Forest, anchors: DataFrame, most: int, own_leaf: bool) -> DataFrame:
    """(key, score, id, place) of each anchor's best rows of its label, of its own leaf or of
    all within its annuli."""

    def ask(rows: pa.RecordBatch, queries: pa.RecordBatch):
        score = whole_scores(vectors.matrix(queries.column("q")), vectors.matrix(rows.column("x")))
        ids, labels = vectors.numbers(rows.column("id")), vectors.numbers(rows.column("label"))
        own = vectors.numbers(queries.column("anchor"))[:, None] != ids
        alike = vectors.numbers(queries.column("kind"))[:, None] == labels
        a, b = vectors.best(score, own & alike, most, 0)
        yield vectors.numbers(queries.column("key"))[a], score[a, b], ids[b]

    asked = _asked(anchors, forest, own_leaf)
    found = vectors.meet(standing(forest), asked, forest.blocks, ask, most, ("key", "score", "id"), "long")
    return _placed(found, "key", most)


def in_windows(forest: Forest, anchors: DataFrame, most: int, share: tuple[int, int], windows: int) -> DataFrame:
    """(key, score, id, place) of the best rows of other labels in each window of each anchor:
    those whose score is `share[0]` to `share[1]` in `share[1]` of a positive's. The key is the
    anchor's times `windows` plus the number of the positive among `scores`."""
    least, whole = share

    def ask(rows: pa.RecordBatch, queries: pa.RecordBatch):
        score = whole_scores(vectors.matrix(queries.column("q")), vectors.matrix(rows.column("x")))
        ids, labels = vectors.numbers(rows.column("id")), vectors.numbers(rows.column("label"))
        unlike = vectors.numbers(queries.column("kind"))[:, None] != labels
        unlike &= vectors.numbers(queries.column("anchor"))[:, None] != ids
        keys = vectors.numbers(queries.column("key"))
        tops = queries.column("scores").to_pylist()
        for n in range(windows):
            top = np.array([t[n] if n < len(t) else -1 for t in tops], np.int64)[:, None]
            # At least `least` in `whole` of the top, without products that might overflow.
            floor = top // whole * least - (-(top % whole * least) // whole)
            a, b = vectors.best(score, unlike & (score <= top) & (score >= floor) & (top >= 0), most, 0)
            yield keys[a] * windows + n, score[a, b], ids[b]

    asked = _asked(anchors, forest, False, "scores")
    found = vectors.meet(standing(forest), asked, forest.blocks, ask, most, ("key", "score", "id"), "long")
    return _placed(found, "key", most)


def hard_negatives(
    df: DataFrame,
    asks: Column,
    positives: int = 5,
    negatives: int = 5,
    share: tuple[int, int] = (80, 100),
    id: str = "vec_id",
    label: str | Column = "label",
    vector: str = "embedding",
) -> DataFrame:
    """(anchor, positive, rank, negative, positive_score, negative_score): for each anchor, a
    row whose id fulfils the condition `asks` on the column `id`, and each of its best
    `positives` rows of the same label, the best `negatives` rows of another label that score
    from `share[0]` in `share[1]` of the positive up to the positive itself. `label` is of a
    whole-number type."""
    spark = df.sparkSession
    rows, total, size = prepared(df, id, label, vector)
    if not total:
        return spark.createDataFrame([], RESULT)
    forest = planted(rows, total, size)
    key = F.monotonically_increasing_id().alias("key")
    named = rows.where(asks).select(key, F.col("id").alias("anchor"), F.col("label").alias("kind"), F.col("x").alias("q"))
    anchors = stored(named, "anchors")
    nothing = F.array(F.lit(None).cast("long"))

    near = same_label(forest, anchors.withColumns({"low": nothing, "high": nothing}), positives, own_leaf=True)
    bound = near.where(F.col("place") == positives).select("key", F.array("score").alias("low"))
    bounded = stored(
        anchors.join(bound, "key", "left").withColumns({"low": F.coalesce("low", nothing), "high": nothing}), "bounded"
    )
    found = stored(same_label(forest, bounded, positives, own_leaf=False), "positives")

    tops = found.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("place", "score"))).alias("tops"))
    scores = F.filter(F.col("tops.score"), lambda s: s >= 0)
    windowed = anchors.join(tops, "key").select("key", "anchor", "kind", "q", scores.alias("scores"))
    least, whole = share
    low = F.transform("scores", lambda s: (s.cast("double") * least / whole - 1).cast("long"))
    windowed = stored(windowed.withColumns({"low": low, "high": F.col("scores")}), "windows")
    mined = in_windows(forest, windowed.where(F.size("scores") > 0), negatives, share, positives)

    numbered = mined.select(
        F.floor(F.col("key") / positives).cast("long").alias("anchor_key"),
        (F.pmod("key", F.lit(positives)) + 1).cast("int").alias("nth"),
        F.col("place").alias("rank"),
        F.col("id").alias("negative"),
        F.col("score").alias("negative_score"),
    )
    pairs = found.join(anchors.select("key", "anchor"), "key").select(
        F.col("key").alias("anchor_key"),
        F.col("place").alias("nth"),
        "anchor",
        F.col("id").alias("positive"),
        F.col("score").alias("positive_score"),
    )
    return numbered.join(pairs, ["anchor_key", "nth"]).select(
        "anchor", "positive", "rank", "negative", "positive_score", "negative_score"
    )
