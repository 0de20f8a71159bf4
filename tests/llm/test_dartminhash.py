import random

import numpy as np

from tideline.llm import dartminhash
from tideline.llm.dartminhash import near_classes, signatures
from tideline.llm.hashing import distinct_shingles, mix


def copies(seed, groups, each, words=120, edits=2):
    draw = random.Random(seed)
    texts = []
    for g in range(groups):
        base = [f"w{draw.randrange(5000)}" for _ in range(words)]
        for _ in range(each):
            own = list(base)
            for _ in range(draw.randint(0, edits)):
                own[draw.randrange(words)] = f"new{draw.random()}"
            texts.append(" ".join(own))
    return texts


def brute(texts, similarity=0.8):
    sets = []
    for text in texts:
        value, _, _ = distinct_shingles([text or ""], 5)
        sets.append(set(value.tolist()))
    label = list(range(len(texts)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            alike = both and both >= similarity * (len(sets[i]) + len(sets[j]) - both)
            if alike or (texts[i] or "") == (texts[j] or ""):
                a, b = root(i), root(j)
                label[max(a, b)] = min(a, b)
    return [root(i) for i in range(len(texts))]


def test_signatures_estimate_weighted_similarity():
    names = np.arange(1, 6, dtype=np.uint64)
    a, b = np.array([1.0, 2.5, 4, 0.3, 2]), np.array([2.0, 1.5, 4, 0.6, 2])
    agree = []
    for seed in range(150):
        element = np.tile(mix(names + np.uint64(1000 * seed)), 2)
        rows = signatures(element, np.repeat([0, 1], 5), np.r_[a, b], 2, 64)
        agree.append((rows[0] == rows[1]).mean())
    assert abs(np.mean(agree) - np.minimum(a, b).sum() / np.maximum(a, b).sum()) < 0.02


def test_texts_of_any_length_fill_every_coordinate():
    texts = [" ".join(f"w{i}" for i in range(n)) for n in (1, 2, 5, 6, 50, 5000)]
    element, owner, _ = distinct_shingles(texts, 5)
    assert (signatures(element, owner, np.ones(len(element)), len(texts), 256) != 0).all()


def test_classes_equal_brute_force(spark, docs_of, monkeypatch):
    texts = copies(1, 12, 6, edits=6) + copies(2, 30, 1) + ["one two three", "one two three", "lone words here"]
    random.Random(3).shuffle(texts)
    for block in (64, 2):  # blocks of two members work bigger buckets off in many groups
        monkeypatch.setattr(dartminhash, "BLOCK", block)
        rows = near_classes(docs_of(texts)).collect()
        assert [r.class_id for r in sorted(rows, key=lambda r: r.doc_id)] == brute(texts)


def test_chain_of_copies_is_one_class(docs_of):
    words = [f"w{i}" for i in range(400)]
    texts = []
    for step in range(12):  # each text is near the one before, the ends are far apart
        words[step * 30 : step * 30 + 18] = [f"s{step}-{i}" for i in range(18)]
        texts.append(" ".join(words))
    want = brute(texts)
    assert set(want) == {0}
    assert [r.class_id for r in sorted(near_classes(docs_of(texts)).collect(), key=lambda r: r.doc_id)] == want


def test_odd_rows_and_empty_table(odd_docs):
    rows = near_classes(odd_docs.where("doc_id is not null")).collect()
    assert {(r.doc_id, r.class_id) for r in rows} == {(0, 0), (1, 0), *((i, i) for i in range(2, 8))}
    assert near_classes(odd_docs.limit(0)).collect() == []
