import heapq
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tideline.llm import multiindex, vectors
from tideline.llm.multiindex import Index, in_order, nearest_neighbours
from tideline.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>, label int, cell string, score string, reach double"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, "c", "s", 0.5) for i, v in rows], SCHEMA)


def asked(df, **more):
    found = defaultdict(list)
    for r in nearest_neighbours(df, F.col("id") % 20 == 0, **more).collect():
        found[r["query"]].append((r["rank"], r["id"], r["score"]))
    return {q: sorted(rows) for q, rows in found.items()}


def truth(rows, k):
    usable = [(i, np.array(v, np.float32).astype(float)) for i, v in rows]
    out = {}
    for i, a in usable:
        if i % 20 == 0:
            scores = [(-float(in_order(a[None], b[None])[0]), j) for j, b in usable if j != i]
            out[i] = [(n, j, -s) for n, (s, j) in enumerate(heapq.nsmallest(k, scores), 1)]
    return out


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_recall_of_the_query(spark, sf):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"/root/testdata/{sf}/embeddings.parquet").collect()]
    want, got = truth(rows, 20), defaultdict(list)
    for r in QUERIES["op12_multi_index"](spark, f"/root/testdata/{sf}").collect():
        got[r.query_id].append((r["rank"], r.vec_id, r.score))
    scores = {(q, i): s for q, found in got.items() for _, i, s in found}
    assert set(got) == set(want) and all(len(g) == 20 for g in got.values())
    for q, found in got.items():
        assert [n for n, _, _ in sorted(found)] == list(range(1, 21))
        assert [(-s, i) for _, i, s in sorted(found)] == sorted((-s, i) for _, i, s in found)
    hits = [scores.get((q, i)) == s for q, near in want.items() for _, i, s in near if (q, i) in scores]
    assert all(hits)  # the same sums, to the last digit
    assert len(hits) >= 0.9 * 20 * len(want)


def test_exact_where_the_depth_is_all(spark, monkeypatch):
    """Small blocks and cells, copies with a third of all rows, ties."""
    monkeypatch.setattr(vectors, "BLOCK", 16)
    monkeypatch.setattr(multiindex, "CELL", 8)
    draw = np.random.default_rng(1)
    rows = [(i, [1.0, 2.0, 0.5] if i % 3 == 0 else draw.normal(size=3).round(1).tolist()) for i in range(300)]
    assert asked(frame(spark, rows), k=7, aim=1.0).keys() == truth(rows, 7).keys()
    monkeypatch.setattr(multiindex, "measured_depth", lambda *_: len(rows))
    assert asked(frame(spark, rows), k=7) == truth(rows, 7)


def test_odd_rows(spark):
    rows = [(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [2.0, 1.0]), (20, [1.0, 1.0]), (21, [-1.0, 0.25])]
    odd = [(40, None), (60, [None, 1.0]), (80, [float("nan"), 1.0]), (100, [float("inf"), 1.0])]
    odd += [(120, [0.0, 0.0]), (140, []), (160, [1.0, 2.0, 3.0]), (None, [1.0, 1.0])]
    assert asked(frame(spark, rows + odd), aim=1.0) == truth(rows, 20)
    twice = asked(frame(spark, [*rows, rows[2]]), aim=1.0)
    assert [i for _, i, _ in twice[0]] == [2, 2, 20, 1, 21]
    for few in ([], rows[:1], odd, [(0, [1.0]), (0, [1.0])]):
        assert asked(frame(spark, few)) == {}
    assert asked(frame(spark, [(0, [1.0]), (1, [3.0])])) == {0: [(1, 1, 3.0)]}
    huge = [(0, [3e38] * 4), (1, [-3e38] * 4), (2, [3e38, 1.0, 1.0, 1.0])]
    assert [i for _, i, _ in asked(frame(spark, huge))[0]] == [2, 1]


def test_a_traversal_passes_cells_by_summed_distance():
    draw = np.random.default_rng(2)
    index = Index(draw.normal(size=(7, 3)), draw.normal(size=(5, 2)), draw.integers(0, 9, 35))
    one, two = index.distances(draw.normal(size=(20, 5)))
    for a, b in zip(one, two):
        sums = (a[:, None] + b).ravel()
        order = np.argsort(sums)
        upto = np.cumsum(index.sizes[order])
        for depth in (1, 20, 80, int(index.sizes.sum())):
            assert index.reach(a, b, depth) == sums[order][np.searchsorted(upto, depth)]
