import random
import re

from pyspark.sql import functions as F

from tideline.llm import secretscan
from tideline.llm.secretscan import KINDS, base_spans, fit, secrets, train, written

BASE = {
    "assign": (r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", lambda m: len(m[2]) >= 6),
    "access": ("AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 20),
    "hex": ("[0-9a-f]+", lambda m: len(m[0]) >= 24),
}


def brute(text):
    return sorted((m.start(), k, m.end()) for k, name in enumerate(BASE) for m in re.finditer(BASE[name][0], text) if BASE[name][1](m))


def test_base_spans_equal_plain_patterns():
    draw = random.Random(9)
    parts = ["password", "Token", "ſecret", "api_key", "APIKEY", "=", ":", " ", '"', "'", "abc", "0123456789abcdef" * 2, "AKIA", "ABCDEFGHIJKLMNOP", "é", "\n", "x.y-z", "12345"]
    for _ in range(3000):
        text = "".join(draw.choices(parts, k=draw.randint(1, 12)))
        assert base_spans(text) == brute(text), repr(text)


def test_models_tell_random_strings_from_identifiers():
    draw = random.Random(3)
    syllables = ["get", "user", "name", "set", "value", "index", "for", "list", "max", "count", "er", "ing"]
    names = ["".join(draw.choices(syllables, k=4)) + draw.choice(["", "_1", "-v2", "2024"]) for _ in range(4000)]
    chains = fit([], names[:2000])
    keys = ["".join(draw.choices(secretscan.SIGNS[:62], k=32)) for _ in range(500)]
    long = [n for n in names[2000:] if len(n) >= secretscan.SHORTEST]
    assert (chains.ratios(keys) >= chains.threshold).mean() > 0.95
    assert (chains.ratios(long) >= chains.threshold).mean() < 0.02


def test_short_and_letter_keys_are_found(docs_of):
    draw = random.Random(12)
    syllables = ["get", "user", "name", "set", "value", "index", "for", "list", "max", "count", "er", "ing"]
    names = ["".join(draw.choices(syllables, k=draw.randint(1, 6))) + draw.choice(["", "", "_1", "-v2", "2024"]) for _ in range(6000)]
    chains = fit([], names[:3000])
    for signs in (secretscan.SIGNS[:62], *secretscan.LETTERS):
        keys = ["".join(draw.choices(signs, k=draw.randint(16, 24))) for _ in range(400)]
        texts = [f"the key is {k} and no more" for k in keys]
        rows = docs_of(texts).select("doc_id", secrets("text", chains).alias("s")).collect()
        found = sum([(x.start, KINDS[x.kind], x.end) for x in r.s] == [(11, "random", 11 + len(keys[r.doc_id]))] for r in rows)
        assert found >= 0.97 * len(keys)
    ordinary = [n for n in names[3000:] if len(n) >= secretscan.SHORTEST]
    rows = docs_of(ordinary).select(secrets("text", chains).alias("s")).collect()
    assert sum(bool(r.s) for r in rows) < 0.02 * len(ordinary)


def test_lower_case_keys_of_each_length_and_a_shorter_least_length(docs_of):
    draw = random.Random(14)
    syllables = ["get", "user", "name", "set", "value", "index", "for", "list", "max", "count", "er", "ing"]
    names = ["".join(draw.choices(syllables, k=draw.randint(1, 6))) for _ in range(3000)]
    for shortest, size in ((16, 16), (16, 20), (16, 24), (12, 12)):
        chains = fit([], names, shortest)
        keys = ["".join(draw.choices(secretscan.LETTERS[0], k=size)) for _ in range(300)]
        rows = docs_of(keys).select(secrets("text", chains).alias("s")).collect()
        assert sum(bool(r.s) for r in rows) >= 0.95 * len(keys)
    assert not docs_of(keys).select(secrets("text", fit([], names)).alias("s")).where("size(s) > 0").count()


def test_what_base_spans_leave_of_a_run(docs_of):
    draw = random.Random(13)
    names = ["".join(draw.choices(["get", "user", "name", "er", "ing", "To"], k=4)) for _ in range(3000)]
    chains = fit([], names)
    key, code = "Zx8Qv2LmT5rYw9Kp-", "0a1b2c3d" * 3
    texts = [key + code, f"é {code}/{key}", f"{key}{code}{key[::-1]} AKIA{'Q' * 16}", f"{key[:9]}{code}", "get.user.name.in.password=hunter22"]
    rows = docs_of(texts).select("doc_id", secrets("text", chains).alias("s")).collect()
    found = {r.doc_id: [(x.start, KINDS[x.kind], x.end) for x in r.s] for r in rows}
    assert found == {
        0: [(0, "random", 17), (17, "hex", 41)],
        1: [(2, "hex", 26), (26, "random", 44)],
        2: [(0, "random", 17), (17, "hex", 41), (41, "random", 58), (59, "access", 79)],
        3: [(9, "hex", 33)],
        4: [(17, "assign", 34)],
    }


def test_rows(odd_docs, docs_of):
    draw = random.Random(6)
    signs = [*"aeinorst_", "er", "ing", "the", "Max", "To", "Value", "Id"]
    words = " ".join("".join(draw.choices(signs, k=draw.randint(3, 8))) for _ in range(20_000))
    key = "Zx8Qv2LmT5rYw9KpD3sHb7Nc"
    texts = [words, f"é {key} and password = 'hunter22' tail", "AKIA" + "Q" * 16 + " " + "0a" * 12]
    chains = train(docs_of([*texts, None, ""]))
    rows = docs_of(texts).select("doc_id", secrets("text", chains).alias("s")).collect()
    found = {r.doc_id: [(x.start, KINDS[x.kind], x.end) for x in r.s] for r in rows}
    assert found == {0: [], 1: [(2, "random", 26), (31, "assign", 51)], 2: [(0, "access", 20), (21, "hex", 45)]}
    form = docs_of(texts[1:2]).select(secrets("text", chains).alias("s")).select(written(F.col("s"))).first()[0]
    assert form == "random:2:26,assign:31:51"
    assert all(r.s == [] for r in odd_docs.select(secrets("text", chains).alias("s")).collect())
    assert odd_docs.limit(0).select(secrets("text", train(odd_docs.limit(0)))).collect() == []
