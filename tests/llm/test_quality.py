import random
import re
from collections import defaultdict

import numpy as np

from tideline.llm import quality as rules
from tideline.llm.quality import grow, quality, statistics, train

WORD = "[^\x20\x09-\x0D]+"


def brute(text):
    words, windows = re.findall(WORD, text), defaultdict(list)
    for i in range(len(words) - 7):
        windows[tuple(words[i : i + 8])].append(i)
    covered = {j for found in windows.values() if len(found) > 1 for i in found for j in range(i, i + 8)}
    lines = [x for x in text.split("\n") if re.search(WORD, x)]
    return [len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)]


def test_counts_equal_brute_force():
    draw = random.Random(1)
    texts = ["".join(draw.choices(["a", "b ", "c\n", "é ", "#", "| ", "\t", "\x1c", "\xa0", "\r", "\x85 ", "x y z "], k=draw.randint(0, 120))) for _ in range(500)]
    assert statistics(texts)[0].tolist() == [brute(t) for t in texts]


def labelled(seed, n):
    draw, texts, good = random.Random(seed), [], []
    for i in range(n):
        words = ["".join(draw.choices("abcdefgh", k=draw.randint(2, 8))) for _ in range(draw.randint(30, 80))]
        good.append(i % 3 != 0)
        texts.append(" ".join(words) if good[-1] else " ".join(w + draw.choice(["###", "!!", " |"]) for w in words).upper())
    return texts, np.array(good)


def test_held_out_accuracy():
    texts, good = labelled(1, 600)
    forest = grow(statistics(texts)[1], good)
    unseen, truth = labelled(2, 300)
    assert ((forest.score(statistics(unseen)[1]) >= 0.5) == truth).mean() > 0.98


def test_chosen_statistics_only_lower_or_raise_the_score():
    draw = np.random.default_rng(4)
    table = draw.normal(size=(800, len(rules.STATISTICS)))
    good = table[:, 2] + table[:, 0] + 0.5 * draw.normal(size=800) > 0  # against the falling one
    forest = grow(table, good)
    for name in (*rules.FALLING, *rules.RISING):
        moved = table.copy()
        moved[:, rules.STATISTICS.index(name)] += 1.0
        change = forest.score(moved) - forest.score(table)
        assert (change <= 1e-12).all() if name in rules.FALLING else (change >= -1e-12).all()
    assert len(set(forest.feature.tolist()) - {-1}) > 1


def test_rows(spark, docs_of, odd_docs):
    texts, good = labelled(5, 90)
    labels = spark.createDataFrame([*[(i, int(g)) for i, g in enumerate(good)], (None, 1), (3, None)], "doc_id long, quality int")
    forest = train(docs_of(texts), labels)
    rows = odd_docs.withColumn("q", quality("text", forest)).collect()
    for row in rows:
        assert [row.q[c] for c in rules.COUNTS] == brute(row.text or "")
        assert 0 <= row.q.score <= 1
    assert odd_docs.limit(0).select(quality("text", forest)).collect() == []
    nothing = train(odd_docs.limit(0), labels.limit(0))
    assert {r.q.score for r in odd_docs.select(quality("text", nothing).alias("q")).collect()} == {0.5}
