import random

from tideline.llm import decontaminate
from tideline.llm.decontaminate import Items, blocks, leaks


def fold(text):
    return "".join(" " if c.isspace() else c.lower() for c in text)


def distance(item, text):
    """Fewest edits of the item in any part of the text."""
    before = [0] * (len(text) + 1)
    for i, x in enumerate(item, 1):
        now = [i]
        for j, y in enumerate(text, 1):
            now.append(min(before[j - 1] + (x != y), before[j] + 1, now[-1] + 1))
        before = now
    return min(before)


def edited(draw, text, edits):
    signs = list(text)
    for _ in range(edits):
        at = draw.randrange(len(signs))
        kind = draw.randrange(3)
        if kind == 0:
            signs[at] = draw.choice("xyzq")
        elif kind == 1:
            signs.insert(at, draw.choice("xyzq"))
        else:
            del signs[at]
    return "".join(signs)


def words(draw, n):
    return " ".join("".join(draw.choices("abcdeinorst", k=draw.randint(2, 8))) for _ in range(n))


def test_found_exactly_when_within_the_budget():
    draw = random.Random(4)
    items = [words(draw, draw.randint(4, 25)) for _ in range(25)]
    index = Items(list(range(25)), items)
    texts, wanted = [], []
    for _ in range(120):
        k = draw.randrange(25)
        body = words(draw, 40)
        at = draw.randrange(len(body))
        texts.append(body[:at] + " " + edited(draw, items[k], draw.randint(0, int(index.budget[k] * 1.7) + 1)) + "\n" + body[at:])
        wanted.append(k)
    owner, item, start, end, edits = (x.tolist() for x in index.matches(texts))
    found = {(o, i): (s, e, d) for o, i, s, e, d in zip(owner, item, start, end, edits)}
    for n, (text, k) in enumerate(zip(texts, wanted)):
        least = distance(fold(items[k]), fold(text))
        if least <= index.budget[k]:
            s, e, d = found[n, k]
            assert d == least == distance(fold(text)[s:e], fold(items[k])) or distance(fold(items[k]), fold(text)[s:e]) == d
        else:
            assert (n, k) not in found


def test_odd_rows(spark, odd_docs, docs_of, monkeypatch):
    passage = "an item of the benchmark, with enough characters to be searched for"
    items = spark.createDataFrame([(1, passage), (2, None), (3, ""), (4, "short"), (5, passage)], "item_id long, text string")
    assert odd_docs.select(leaks("text", blocks(items)).alias("m")).where("size(m) > 0").count() == 0
    held = docs_of(["Say: " + passage.upper() + " twice. " + passage, passage.replace(" ", "\n")])
    for most in (4_000_000, 10):  # one block, and a block for every item
        monkeypatch.setattr(decontaminate, "BLOCK_CHARS", most)
        rows = held.select(leaks("text", blocks(items)).alias("m")).collect()
        assert sorted((m.item, m.start, m.edits) for m in rows[0].m) == [(1, 5, 0), (1, 80, 0), (5, 5, 0), (5, 80, 0)]
        assert sorted((m.item, m.start, m.end) for m in rows[1].m) == [(1, 0, len(passage)), (5, 0, len(passage))]
    assert odd_docs.limit(0).select(leaks("text", blocks(items))).collect() == []
    assert odd_docs.select(leaks("text", blocks(items.limit(0))).alias("m")).where("size(m) > 0").count() == 0


def test_short_items_as_whole_words_and_items_without_an_id(spark, docs_of):
    long = "a passage that is long enough to be searched by its q-grams"
    rows = [(1, "Cat"), (2, "cat"), (3, "3.14"), (4, "..."), (5, " "), (6, "x-ray map"), (7, "漢字"), (None, "zebra"), (None, long)]
    found = blocks(spark.createDataFrame(rows, "item_id long, text string"))
    texts = ["The CAT, concat cat2 _cat cat", "13.14 3.14.", "an X-ray\tmap of 字漢字漢", "... zebras Zebra", long.upper(), None, ""]
    got = {r.doc_id: r.m for r in docs_of(texts).select("doc_id", leaks("text", found).alias("m")).collect()}
    assert [(m.item, m.start, m.end) for m in got[0]] == [(1, 4, 7), (2, 4, 7), (1, 26, 29), (2, 26, 29)]
    assert [(m.item, m.start, m.end) for m in got[1]] == [(3, 6, 10)]
    assert [(m.item, m.start, m.end) for m in got[2]] == [(6, 3, 12), (7, 17, 19)]
    assert [(m.item, m.start, m.end, m.edits) for m in got[3]] == [(None, 11, 16, 0)]
    assert [(m.item, m.start, m.end, m.edits) for m in got[4]] == [(None, 0, len(long), 0)]
    assert got[5] == got[6] == []


def test_repetitive_texts_in_bounded_memory(monkeypatch):
    """An item that begins with 200 dashes, and a text of a million; the peak of numpy's memory."""
    import tracemalloc

    item = "-" * 200 + " and then some words"
    index = Items([1], [item])
    tracemalloc.start()
    owner, _, start, end, edits = index.matches(["-" * 300_000 + " and then some words", "-" * 700_000])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 1e9
    assert (owner.tolist(), edits.tolist()) == ([0], [0]) and end[0] == 300_000 + 20
    monkeypatch.setattr(decontaminate, "SLICE", 500)
    text = "-" * 3000 + " and then some words. " + "-" * 900
    whole = [x.tolist() for x in index.matches([text])]
    monkeypatch.undo()
    assert whole == [x.tolist() for x in index.matches([text])]
