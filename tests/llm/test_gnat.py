from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from compare import compare, duck
from tideline.llm import gnat, vectors
from tideline.llm.gnat import Tree, hard_negatives, whole_scores
from tideline.llm.queries import ORACLE, QUERIES

SCHEMA = "vec_id long, embedding array<double>, label int, score string, x long, block string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, k, "s", 1, "b") for i, v, k in rows], SCHEMA)


def plain(rows, positives=5, negatives=5):
    """The definition, row by row."""
    whole = [
        (i, [int(np.floor(256 * x)) for x in v], k)
        for i, v, k in rows
        if i is not None and k is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)
    ]
    out = Counter()
    for i, a, k in whole:
        if i % 100:
            continue
        scores = sorted((-sum(p * q for p, q in zip(a, b)), j, c) for j, b, c in whole if j != i)
        for s, j, _ in [x for x in scores if x[2] == k][:positives]:
            window = [x for x in scores if x[2] != k and 80 * -s <= 100 * -x[0] <= 100 * -s]
            for n, (t, m, _) in enumerate(window[:negatives], 1):
                out[i, j, n, m, -s, -t] += 1
    return out


def mined(df, **more):
    return Counter(tuple(r) for r in hard_negatives(df, F.col("id") % 100 == 0, **more).collect())


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_equals_sql(spark, sf):
    folder = f"/root/testdata/{sf}"
    rows, odd = compare(QUERIES["op11_hard_negatives"](spark, folder), duck(folder), ORACLE["op11_hard_negatives"])
    assert rows > 0 and odd == []


def test_equals_the_definition(spark, monkeypatch):
    """Clusters, many ties, one group of copies with a third of all rows, and odd rows."""
    monkeypatch.setattr(vectors, "BLOCK", 32)
    monkeypatch.setattr(gnat, "LEAF", 40)
    draw = np.random.default_rng(3)
    middles = draw.normal(size=(6, 4))
    rows = []
    for i in range(600):
        v = [0.5, 0.25, -0.5, 1.0] if i % 3 == 0 else (middles[i % 6] + draw.normal(size=4) * 0.1).round(1).tolist()
        rows.append((i, v, int(draw.integers(0, 4))))
    rows += [(600, None, 1), (700, [1.0, None, 1.0, 1.0], 1), (800, [float("nan"), 1.0, 1.0, 1.0], 2)]
    rows += [(900, [float("inf"), 1.0, 1.0, 1.0], 2), (601, [1.0, 1.0, 1.0, 1.0], None), (None, [1.0] * 4, 1)]
    rows += [(1000, [0.0] * 4, 1), (1100, [-9.0, -9.0, -9.0, -9.0], 1), (1200, [2.0, 2.0, 2.0, 2.0], 77)]
    rows += [rows[0], rows[100], rows[200], rows[7]]
    got = mined(frame(spark, rows))
    assert got == plain(rows) and len(got) > 50


def test_few_rows_and_none(spark):
    rows = [(0, [1.0], 1), (1, [2.0], 1), (2, [1.75], 2), (3, [0.5], 2)]
    assert mined(frame(spark, rows)) == plain(rows) == Counter({(0, 1, 1, 2, 512 * 256, 448 * 256): 1})
    for few in ([], rows[:1], [(0, [], 1), (1, [], 2)], [(0, None, 1)]):
        assert mined(frame(spark, few)) == Counter()
    assert mined(frame(spark, [*rows, (4, [1.0, 2.0], 2)])) == plain(rows)


def test_ranges_hold_all_rows_and_eliminate_leaves():
    draw = np.random.default_rng(5)
    middles = draw.normal(size=(40, 8)) * 300
    x = np.floor(middles[draw.integers(0, 40, 4000)] + draw.normal(size=(4000, 8)) * 5)
    tree = Tree(x[:1000], 4000, float((x**2).sum(axis=1).max()))
    assert tree.leaves > 20
    leaf = tree.leaf_of(tree.raised(x), ranges=True)
    asks = x[:50]
    score = whole_scores(asks, x)
    visited = 0
    for share in (0.0, 0.8, 0.99):
        top = score.max(axis=1)
        reach = (asks**2).sum(axis=1) + tree.peak
        near, far = np.sqrt(np.maximum(reach - 2 * top, 0)), np.sqrt(reach - 2 * share * top)
        alive = tree.surviving(np.c_[asks, np.zeros(50)], near, far)
        inside = score >= share * top[:, None]
        rows, at = np.nonzero(inside)
        assert alive[rows, leaf[at]].all()
        visited = alive.mean()
    assert visited < 0.5  # the narrowest annuli leave out more than half of the leaves


def test_scores_beyond_doubles_are_exact():
    big = np.array([[2.0**24 - 1] * 300, [3.0] * 300])
    assert whole_scores(big, big).tolist() == [[300 * (2**24 - 1) ** 2, 900 * (2**24 - 1)], [900 * (2**24 - 1), 2700]]
