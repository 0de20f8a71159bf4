import hashlib
import math
import random
import re
from collections import Counter
from zlib import crc32

import pytest

from tideline.llm import resample as module
from tideline.llm.queries import ORACLE, QUERIES
from tideline.llm.resample import Head, buckets_of, resample, word_lists
from compare import compare, duck

SF_DIR = "/root/testdata/sf0.01"


def plain_features(text, longest):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lowered)
    runs = [words[i : i + n] for n in range(1, longest + 1) for i in range(len(words) - n + 1)]
    return len(words), [crc32(" ".join(r).encode()) for r in runs]


def plain(docs, target, longest, buckets, least, percent):
    """(id, features, weight, score, rank) of every document, by the definition."""
    s = Counter(f % buckets for _, t in docs for f in plain_features(t, longest)[1])
    t = Counter(f % buckets for x in target for f in plain_features(x, longest)[1])
    gain = {
        b: math.floor(1000 * math.log((t[b] + 1) * (s.total() + buckets) / ((s[b] + 1) * (t.total() + buckets))))
        for b in range(buckets)
    }
    rows = []
    for i, text in docs:
        n_words, found = plain_features(text, longest)
        weight = sum(gain[f % buckets] for f in found)
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))
        rows.append((n_words >= least, i, len(found), weight, score))
    able = sorted((r for r in rows if r[0]), key=lambda r: (-r[4], r[1] is None, r[1] or 0, r[2:4]))
    drawn = [r[1:] + (n,) for n, r in enumerate(able[: len(able) * percent // 100], 1)]
    return Counter(drawn + [r[1:] + (None,) for r in able[len(drawn) :] + [r for r in rows if not r[0]]])


def drawn(df):
    return Counter((r["id"], r.n_features, r.weight, r.score, r["rank"]) for r in df.collect())


def test_query_equals_sql(spark):
    rows, odd = compare(QUERIES["op13_resample"](spark, SF_DIR), duck(SF_DIR), ORACLE["op13_resample"])
    assert rows == 1000 and odd == []


@pytest.mark.parametrize("longest", [1, 2, 3])
@pytest.mark.parametrize("head", [0, 3, 65_536])
def test_equals_the_definition(docs_of, odd_docs, monkeypatch, longest, head):
    """With no head, a small one and all features in it; texts in one piece and in many."""
    monkeypatch.setattr(module, "HEAD", head)
    monkeypatch.setattr(module, "PIECE", 40)
    monkeypatch.setattr(module, "COUNTED", 5)
    draw = random.Random(longest)
    signs = ["a", "B", "the", "The", "x1", "é", "É", "漢字", "-", "\n", "'", "a_b", "\x7f", "\x80"]
    texts = [" ".join(draw.choices(signs, k=draw.randint(0, 30))) for _ in range(120)]
    docs = docs_of(texts, draw.sample(range(10_000), 120)).unionByName(odd_docs)
    target = docs_of(["the x1 the", None, "é 漢字 a"])
    given = [(r.doc_id, r.text) for r in docs.collect()]
    want = plain(given, ["the x1 the", None, "é 漢字 a"], longest, 500, 5, 30)
    monkeypatch.setattr(module.head_of, "__defaults__", ("text", 1, head))
    got = drawn(resample(docs, target, longest=longest, buckets=500, least_words=5, percent=30))
    assert got == want


def test_pieces_hold_whole_words_and_carry_the_last_ones(monkeypatch):
    monkeypatch.setattr(module, "PIECE", 10)
    text = " ".join(["word", "x" * 35, "é" * 20, "1"] * 9)
    parts = list(word_lists(text, 2))
    assert len(parts) > 5
    assert [w for n, p in enumerate(parts) for w in p[2 * (n > 0) :]] == [w.encode() for w in text.split()]
    head = Head.of([b"word"], [b"1 word"])
    found = Counter(int(b) for _, part in buckets_of(head, text, 3, 1 << 32) for b in part)
    assert found == Counter(plain_features(text, 3)[1])


def test_many_partitions_rank_in_one_order(docs_of, monkeypatch):
    monkeypatch.setattr(module, "RANKED_ROWS", 40)
    texts = [f"w{n % 7} " * 25 for n in range(300)]
    got = resample(docs_of(texts).unionByName(docs_of(texts[:50])), docs_of(["w1 w2"]), percent=50).collect()
    placed = sorted((r["rank"], -r.score, r["id"]) for r in got if r["rank"])
    assert [p[0] for p in placed] == list(range(1, 176))
    assert placed == sorted(placed, key=lambda p: p[1:])


def test_empty_tables(docs_of):
    none, some = docs_of(["x"]).limit(0), docs_of(["a b " * 20, ""])
    assert resample(none, some).collect() == []
    rows = resample(some, none).collect()
    assert {r["id"]: (r.n_features, r["rank"]) for r in rows} == {0: (40, None), 1: (0, None)}
