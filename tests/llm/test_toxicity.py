import random

import numpy as np

from tideline.llm import toxicity
from tideline.llm.toxicity import Messages, fit, scorer, train
from tideline.llm.toxicity import toxicity as toxic_of


def texts_and_labels(seed, n, bad=("grobnar", "flunked", "snarth")):
    draw, texts, labels = random.Random(seed), [], []
    for i in range(n):
        words = ["".join(draw.choices("aeioubdgklmnprst", k=draw.randint(2, 7))) for _ in range(draw.randint(20, 90))]
        label = i % 4 == 0
        if label:
            for _ in range(draw.randint(2, 5)):
                words.insert(draw.randrange(len(words)), draw.choice(bad) + draw.choice(["", "er", "ing"]))
        texts.append(". ".join(" ".join(words[a : a + 12]) for a in range(0, len(words), 12)))
        labels.append(label)
    return texts, np.array(labels)


def test_marginals_equal_enumeration():
    draw = np.random.default_rng(3)
    chain = np.array([0, 0, 0, 0, 1, 2, 2, 2])
    emission, moves = draw.normal(size=8), draw.normal(size=(2, 2))
    ahead, back = Messages(chain).run(emission, moves)
    got = 1 / (1 + np.exp(-(ahead + back)))
    for c in np.unique(chain):
        at = np.flatnonzero(chain == c)
        total, toxic = 0.0, np.zeros(len(at))
        for state in range(2 ** len(at)):
            bits = np.array([(state >> k) & 1 for k in range(len(at))])
            weight = np.exp((emission[at] * bits).sum() + sum(moves[a, b] for a, b in zip(bits, bits[1:])))
            total += weight
            toxic += weight * bits
        assert np.allclose(got[at], toxic / total)


def test_marginals_of_long_lines():
    draw = np.random.default_rng(5)
    sizes = [1, 127, 128, 129, 256, 257, 700, 3, 1500]
    chain = np.repeat(np.arange(len(sizes)) * 2, sizes)
    emission, moves = draw.normal(size=len(chain)) * 3, draw.normal(size=(2, 2)) * 2
    ahead, back = Messages(chain).run(emission, moves)
    for c in np.unique(chain):
        at = np.flatnonzero(chain == c)
        weights = [np.exp([0, e]) for e in emission[at]]
        forward, backward = [weights[0]], [np.ones(2)]
        for w in weights[1:]:
            x = forward[-1] @ np.exp(moves) * w
            forward.append(x / x.sum())
        for w in weights[:0:-1]:
            x = np.exp(moves) @ (w * backward[-1])
            backward.append(x / x.sum())
        both = np.array(forward) * np.array(backward[::-1])
        assert np.allclose((ahead + back)[at], np.log(both[:, 1] / both[:, 0]))


def test_a_span_crosses_the_words_of_a_long_line():
    field = fit(*texts_and_labels(1, 400), 0.25)
    plain = " ".join(["aka"] * 126)
    for text in (f"{plain} grobnar snarth flunked grobnar {plain} {plain}", f"{plain} {plain} grobnar snarth flunked grobnar {plain}"):
        _, (_, start, end, _) = scorer(field)([text])
        assert [text[a:b] for a, b in zip(start, end)] == ["grobnar snarth flunked grobnar"]


def test_held_out_accuracy_and_offsets():
    texts, labels = texts_and_labels(1, 400)
    field = fit(texts, labels, labels.mean())
    unseen, truth = texts_and_labels(2, 200)
    score, (owner, start, end, chance) = scorer(field)(unseen)
    assert ((score >= 0.5) == truth).mean() > 0.98
    spotted = {unseen[o].encode()[a:b].decode() for o, a, b in zip(owner, start, end)}
    assert spotted and all(any(w.startswith(s) for w in x.split(" ") for s in ("grobnar", "flunked", "snarth")) for x in spotted)


def test_training_reads_labels_and_odd_rows_score(spark, docs_of, odd_docs):
    texts, labels = texts_and_labels(5, 200)
    docs = docs_of([*texts, texts[0]], [*range(200), 0])
    rows = [(i, int(y)) for i, y in enumerate(labels)] + [(0, 0), (None, 1), (7, None), (10_000, 1)]
    table = spark.createDataFrame(rows, "doc_id long, toxic int")
    field = train(docs, table)
    out = odd_docs.withColumn("toxicity", toxic_of("text", field)).collect()
    assert len(out) == odd_docs.count()
    assert all(0 <= r.toxicity.score < 0.5 and r.toxicity.spans == [] for r in out)
    hit = docs_of(["é è grobnar aka snarthing, so"]).select(toxic_of("text", field).alias("t")).first().t
    assert hit.score > 0.5 and (hit.spans[0].start, hit.spans[-1].end) == (4, 25)
    assert odd_docs.limit(0).select(toxic_of("text", field)).collect() == []


def test_without_labels_the_score_is_the_share(spark, docs_of, odd_docs):
    table = spark.createDataFrame([], "doc_id long, toxic int")
    for field in (train(odd_docs, table), train(odd_docs.limit(0), table)):
        scores = {r.t.score for r in odd_docs.select(toxic_of("text", field).alias("t")).collect()}
        assert len(scores) == 1 and scores.pop() < 0.5
    assert toxicity.SAMPLE >= 100
