import random

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tideline.llm import tokenfiles
from tideline.llm.tokenfiles import packed, read_tokens, token_bytes, unpacked, write_tokens

FILE = public_tokenizers.path("word_bpe_49k.json")


def test_numbers_of_any_size_come_back():
    draw = np.random.default_rng(1)
    for size in (0, 1, 2, 3, 4, 5, 1000):
        numbers = (draw.integers(0, 2**32, size) >> draw.integers(0, 32, size)).astype(np.uint32)
        control, data = packed(numbers)
        assert len(control) == -(-size // 4)
        assert (unpacked(np.frombuffer(control, np.uint8), np.frombuffer(data, np.uint8), size) == numbers).all()


def test_ids_equal_the_library(docs_of, odd_docs):
    draw, tokenizer = random.Random(2), Tokenizer.from_file(FILE)
    signs = "019aAbB'tll 12\n\t\x0b\x1c\x85\xa0éÉéΣςĐ漢🙂<|endoftext|>._"
    texts = ["".join(draw.choices(signs, k=draw.randint(0, 60))) for _ in range(800)] + ["x <|endoftext|> y<|startoftext|>z"]
    rows = docs_of(texts).select("doc_id", token_bytes("text", FILE).alias("t")).collect()
    for row in rows:
        want = tokenizer.encode(texts[row.doc_id], add_special_tokens=False).ids
        assert np.frombuffer(row.t, "<u4").tolist() == want, repr(texts[row.doc_id])


def test_files_hold_the_documents_in_order(spark, docs_of, odd_docs, monkeypatch):
    monkeypatch.setattr(tokenfiles, "FILE_IDS", 3000)
    monkeypatch.setattr(tokenfiles, "BLOCK_IDS", 500)
    tokenizer, draw = Tokenizer.from_file(FILE), random.Random(4)
    texts = [" ".join(draw.choices(["one", "two", "Three", "quixotic", "zzyzx"], k=draw.randint(0, 60))) for _ in range(300)]
    docs = docs_of(texts, draw.sample(range(-500, 5000), 300)).unionByName(odd_docs)
    files = write_tokens(docs, FILE, end=1)
    assert files.listed.count() > 3
    rows = read_tokens(spark, files).orderBy("start").collect()
    given = sorted(((r.doc_id is not None, r.doc_id or 0, r.text or "") for r in docs.collect()))
    assert [(r.id is not None, r.id or 0) for r in rows] == [g[:2] for g in given]
    at = 0
    for row in rows:
        ids = np.frombuffer(row.tokens, "<u4").tolist()
        texts_of = [t for _, i, t in given if i == (row.id or 0)]
        assert ids in [[*tokenizer.encode(t, add_special_tokens=False).ids, 1] for t in texts_of]
        assert row.start == at
        at += len(ids)
    assert [r.start for r in files.listed.orderBy("start").collect()][0] == 0


def test_empty_table(spark, odd_docs):
    assert read_tokens(spark, write_tokens(odd_docs.limit(0), FILE, end=1)).select(F.col("id")).collect() == []


def test_a_small_cache_gives_the_same_ids(monkeypatch):
    """Words are thinned out between texts; those that come often are kept."""
    monkeypatch.setattr(tokenfiles, "CACHED_WORDS", 20)
    tokenizer, draw = Tokenizer.from_file(FILE), random.Random(6)
    words = tokenfiles.Words(FILE)
    for _ in range(60):
        texts = ["the " + " ".join("".join(draw.choices("abcdeé漢", k=4)) for _ in range(9)) for _ in range(3)]
        ids, lengths = words.encode(texts)
        assert ids.tolist() == [i for t in texts for i in tokenizer.encode(t, add_special_tokens=False).ids]
        assert len(words.known) == len(words.uses) == len(words.starts) <= 20 + 3 * 30 and "the" in words.known


def test_a_word_is_split_into_runs_once(monkeypatch):
    """Further texts of words that were seen are looked up whole, whatever the runs in them."""
    words, tokenizer = tokenfiles.Words(FILE), Tokenizer.from_file(FILE)
    texts = ["It's well-known: a1b22 (foo), BAR! naïve.", "漢字 It's ÉTÉ, well-known:"]
    want = [i for t in texts for i in tokenizer.encode(t, add_special_tokens=False).ids]
    assert words.encode(texts)[0].tolist() == want
    monkeypatch.setattr(tokenfiles, "RUNS", None)
    monkeypatch.setattr(words, "runs", None)
    ids, lengths = words.encode([texts[1], "", texts[0]])
    assert lengths.tolist()[1] == 0 and sorted(ids.tolist()) == sorted(want)


def test_a_small_cache_of_runs_gives_the_same_ids(monkeypatch):
    monkeypatch.setattr(tokenfiles, "CACHED_RUNS", 5)
    words, tokenizer, draw = tokenfiles.Words(FILE), Tokenizer.from_file(FILE), random.Random(8)
    for _ in range(20):
        text = " ".join("".join(draw.choices("abé,.1", k=5)) for _ in range(9))
        assert words.encode([text])[0].tolist() == tokenizer.encode(text, add_special_tokens=False).ids
        assert len(words.runs) <= 5 + 9 * 5


def test_many_new_words_are_merged_at_once(monkeypatch):
    """In few calls of the library, whatever the chunk: short texts, one long text, white space at either end."""
    monkeypatch.setattr(tokenfiles, "CHUNK_BYTES", 5000)
    tokenizer, draw = Tokenizer.from_file(FILE), random.Random(9)
    signs = "aabbccddeeééñßÿÀ12.,;!-_¡§ð"
    words = ["".join(draw.choices(signs, k=draw.randint(1, 12))) for _ in range(3000)]
    texts = [" ".join(words), None, "", " \t", "\nA b\x0b", " J̌ Ǆ H̱ <|ENDOFTEXT|> ", "É\n", "a\x1cb\x85c\xa0d "]
    texts += [" ".join(draw.choices(words, k=50)) for _ in range(60)]
    found = tokenfiles.Words(FILE)
    library, calls = found.runs.tokenizer, []

    class Counted:
        def encode_batch_fast(self, some, **more):
            calls.append(len(some))
            return library.encode_batch_fast(some, **more)

    found.runs.tokenizer = Counted()
    monkeypatch.setattr(tokenfiles, "_words", lambda path: found)
    parts = list(tokenfiles._parts(pa.array(texts[1:]).fill_null("")))
    assert len(parts) > 2 and sum(map(len, parts)) == len(texts) - 1
    have = [ids.tolist() for ids in tokenfiles._encoded(pa.array(texts), FILE, None)]
    assert have == [tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert len(calls) <= len(parts) + 1 and sum(calls) < 3000


def test_contents_of_files_are_not_shuffled(spark, docs_of):
    """However large they are; the list of files is a row a file."""
    files = write_tokens(docs_of(["one two", "three"]), FILE, end=1)
    least = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = read_tokens(spark, files)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", least)
    assert "Exchange hashpartitioning" not in plan
