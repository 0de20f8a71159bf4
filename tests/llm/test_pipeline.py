"""The pipeline and the registered queries on a small set of tables with known answers."""

import random
import re
import tempfile

import pytest
import sentencepiece

import corpus_pipeline
import __spark_entry__ as driver
from tideline.llm.queries import tokenizer_file

BAD = ("grobnar", "snarth")
PASSAGE = "Which of the following answers belongs to the second question of the seventh chapter, and why so?"


def word(draw):
    return "".join(draw.choices("aeioubdgklmnprst", k=draw.randint(2, 7)))


def made_documents():
    """(id, text, kind): kind says what should become of it."""
    draw, rows = random.Random(12), []
    for n in range(160):
        words = [word(draw) for _ in range(draw.randint(60, 120))]
        kind = "kept"
        if n % 4 == 0:
            kind = "toxic"
            for _ in range(4):
                words.insert(draw.randrange(len(words)), draw.choice(BAD) + draw.choice(["", "s", "ing"]))
        rows.append((n, " ".join(words) + ".", kind))
    plain = [t for _, t, k in rows if k == "kept"]
    rows += [(1000 + n, plain[n] + " tail.", "copy") for n in range(10)]
    rows += [(1100 + n, plain[n], "copy") for n in range(5, 15)]
    rows += [(1200 + n, f"{plain[n][:200].title()} {PASSAGE.upper()} {word(draw)} " + " ".join(word(draw) for _ in range(80)), "leak") for n in range(20, 25)]
    rows += [(1300, "Write to a.b@mail.example.com or +1 (487) 555-7209, é " + " ".join(word(draw) for _ in range(30)), "kept")]
    return rows


@pytest.fixture(scope="module")
def sf_dir(spark):
    folder, rows = tempfile.mkdtemp(prefix="run-", dir="/tmp"), made_documents()
    docs = [(i, t, "en", "s", len(t)) for i, t, _ in rows]
    docs += [docs[1], docs[1], (None, "without an id", "en", "s", 13), (5000, None, None, "s", None), (5001, "", "de", None, 0)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    labels = [(i, 1, int(k == "toxic")) for i, _, k in rows]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, PASSAGE), (2, None)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    draw = random.Random(5)
    vectors = [(i, [draw.gauss(0, 1) for _ in range(4)], i % 3) for i in range(101)]
    spark.createDataFrame(vectors, "vec_id long, embedding array<float>, label int").write.parquet(f"{folder}/embeddings.parquet")
    pages = [(i, f"http://h/{i}", f"<p>{i % 3}</p>") for i in range(9)]
    spark.createDataFrame(pages, "page_id long, url string, html string").write.parquet(f"{folder}/pages.parquet")
    return folder


def test_pipeline_equals_the_known_answer(spark, sf_dir):
    model = sentencepiece.SentencePieceProcessor(model_file=tokenizer_file("piece_bpe_32k.model"))
    want = {}
    for i, text, kind in made_documents():
        if kind == "kept":
            text = re.sub(r"[a-z.]+@[a-z.]+", "[EMAIL]", text)
            text = re.sub(r"\+1 \([0-9]+\) [0-9-]+", "[PHONE]", text)
            want[i] = model.encode(text)
    want |= {None: model.encode("without an id"), 5000: []}  # 5001 is as empty as 5000
    rows = corpus_pipeline.run(spark, sf_dir).collect()
    assert len(rows) == len({r.doc_id for r in rows})
    assert {r.doc_id: list(r.ids) for r in rows} == want


def test_near_copies_without_an_id_or_under_one(spark):
    draw = random.Random(3)
    a, b, c = (" ".join(word(draw) for _ in range(150)) for _ in range(3))
    rows = [(4, a), (None, a), (None, a + " tail"), (None, b), (None, b), (7, b + " tail"), (9, c), (9, a[::-1]), (9, c), (2, "é"), (None, None)]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    left = corpus_pipeline.drop_near_copies(spark, docs, "").collect()
    want = [(4, a), (7, b + " tail"), (9, c), (9, a[::-1]), (2, "é"), (None, None)]
    assert sorted(((r.doc_id, r.text) for r in left), key=str) == sorted(want, key=str)


def test_near_copies_beside_clashing_names_and_maps(spark):
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (None, "a b c d e f"), (2, "g"), (2, "h")]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs = docs.selectExpr("*", "1 AS number", "2 AS number_rows", "3 AS digest_of", "4 AS rows", "5 AS row", "map('k', 1) AS m", "6 AS count")
    left = corpus_pipeline.drop_near_copies(spark, docs, "")
    assert left.columns == docs.columns and left.dtypes == docs.dtypes
    assert sorted((r.doc_id, r.text, r.number_rows, r.m["k"]) for r in left.collect()) == [
        (1, "a b c d e f", 2, 1), (2, "g", 2, 1), (2, "h", 2, 1)]


def test_stages_keep_columns_and_take_empty_tables(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").selectExpr(
        "*", "'x' AS found", "1 AS places", "2 AS added", "3 AS base_spans"
    )
    for name, stage in corpus_pipeline.STAGES[:-1]:
        some, none = stage(spark, docs, sf_dir), stage(spark, docs.limit(0), sf_dir)
        assert some.columns == none.columns == docs.columns, name
        assert dict(some.dtypes) == dict(docs.dtypes), name
        assert none.count() == 0
        assert some.where("found = 'x' AND places = 1 AND added = 2 AND base_spans = 3").count() > 100


def test_every_dealt_query_runs_over_its_whole_table(spark, sf_dir):
    known = driver.queries()
    names = {n.split("_")[0]: n for n in known if n.startswith("op")}
    assert set(names) == {f"op{n}" for n in range(1, 14)} and "pipeline" in known
    documents, pages = len(made_documents()) + 5, 9
    for short, name in names.items():
        rows = known[name](spark, sf_dir).count()
        if short == "op11":
            assert 5 <= rows <= 2 * 5 * 5
        else:
            assert rows == {"op8": pages, "op9": 5, "op12": 6 * 20}.get(short, documents), name
