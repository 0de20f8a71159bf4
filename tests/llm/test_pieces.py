import random

import public_tokenizers
import sentencepiece
from pyspark.sql import functions as F

from tideline.llm.batches import text_chunks
from tideline.llm.pieces import piece_ids, piece_round_trip, piece_round_trips, piece_text, vocabulary

MODEL = public_tokenizers.path("piece_bpe_32k.model")


def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def random_texts(n):
    draw = random.Random(11)
    signs = "ab  ▁éñ漢字🙂\x00\n\ttheing aaa...--==  nthe"
    texts = ["".join(draw.choices(signs, k=draw.randint(0, 80))) for _ in range(n)]
    texts += ["".join(chr(draw.choice([draw.randint(32, 0x2FFF), draw.randint(32, 126)])) for _ in range(60)) for _ in range(n // 4)]
    return texts + [" " * k for k in range(70)] + ["a" * k for k in range(40)] + ["ab" * 90, "=-" * 50, "0" * 500]


def test_ids_equal_the_library():
    texts, model, vocab = random_texts(3000), library(), vocabulary(MODEL)
    ids, lengths = vocab.encode(texts)
    at = 0
    for text, size in zip(texts, lengths.tolist()):
        assert ids[at : at + size].tolist() == model.encode(text), repr(text)
        at += size
    assert vocab.decode(ids, lengths) == [model.decode(model.encode(t)) for t in texts]


def test_any_ids_decode_as_the_library_does():
    import numpy as np

    draw, model = random.Random(5), library()
    lists = [[draw.randint(0, 300 if draw.random() < 0.5 else 31_999) for _ in range(draw.randint(0, 20))] for _ in range(3000)]
    flat = np.array([i for ids in lists for i in ids], np.int32)
    assert vocabulary(MODEL).decode(flat, np.array([len(x) for x in lists])) == [model.decode(x) for x in lists]


def test_columns_on_odd_rows(odd_docs):
    model = library()
    out = odd_docs.withColumn("ids", piece_ids("text", MODEL)).withColumn("back", piece_text("ids", MODEL))
    both = out.withColumn("both", piece_round_trip(F.col("text"), MODEL))
    rows = both.collect()
    assert len(rows) == odd_docs.count()
    for row in rows:
        want = model.encode(row.text or "")
        assert row.ids == row.both.ids == want
        assert row.back == row.both.text == model.decode(want)


def test_round_trips_in_small_batches(odd_docs, monkeypatch):
    """Rows stay beside their ids when a batch is cut into many chunks."""
    model = library()
    monkeypatch.setattr(text_chunks, "__defaults__", (10, 2))
    rows = piece_round_trips(odd_docs, MODEL).collect()
    have = sorted(((r.id, list(r.ids), r.text) for r in rows), key=str)
    want = [(r.doc_id, model.encode(r.text or "")) for r in odd_docs.collect()]
    assert have == sorted(((i, ids, model.decode(ids)) for i, ids in want), key=str)
    assert piece_round_trips(odd_docs.limit(0), MODEL).collect() == []


def test_empty_table(odd_docs):
    assert odd_docs.limit(0).select(piece_round_trip(F.col("text"), MODEL)).collect() == []
