import random
import re

from pyspark.sql import functions as F

from tideline.llm import personal

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def passes(kind, value):
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(p) <= 255 for p in value.split("."))
    if kind == "card":
        return 13 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 9 <= len(digits) <= 15


def base_of(text):
    return [
        (personal.KINDS.index(k), m.start(), m.end())
        for k, p in BASE.items()
        for m in re.finditer(p, text or "")
        if passes(k, m.group())
    ]


def spans_of(docs, model):
    found, base, added = personal.with_spans(docs, model)
    rows = found.select("doc_id", F.col(base).alias("b"), F.col(added).alias("a")).collect()
    return {r.doc_id: ([tuple(s) for s in r.b], [tuple(s) for s in r.a]) for r in rows}


def test_base_spans_equal_plain_patterns(docs_of):
    draw = random.Random(8)
    parts = ["a@b.c", "_d@e.f", "x..@q-.z", "1.2.3.4", ".5.6.7.8", "256.1.1.1", "4111111111111111", "4111 1111-1111 1111",
             "+1 (487) 555-7209", "+12", "12", " ", "-", ".", "@", "é", "🙂", "\n", "x", "0", "007.1.1.1", "378282246310005"]
    texts = ["".join(draw.choices(parts, k=draw.randint(1, 14))) for _ in range(600)] + ["@" * 500, "1." * 3000, "1 " * 3000, "a" * 20_000, "a.b" * 3000 + "@c.d"]
    found = spans_of(docs_of(texts), personal.Model())
    for n, text in enumerate(texts):
        assert found[n] == (base_of(text), []), repr(text[:80])


def training_texts():
    draw = random.Random(2)
    def card():
        while True:
            digits = "".join(draw.choices("0123456789", k=16))
            if luhn(digits):
                return digits
    out = []
    for n in range(400):
        phone = f"+1 ({draw.randint(100, 999)}) 555-{draw.randint(1000, 9999)}"
        ip = ".".join(str(draw.randint(1, 255)) for _ in range(4))
        bad = "".join(draw.choices("0123456789", k=16))
        out.append(f"word {n} mail me.{n}@host.example.com or {phone} and {ip} then {card()} not {bad} nor 300.{n}.1.1 end")
    return out


def test_spans_inside_failed_runs_are_added(docs_of):
    model = personal.train(docs_of(training_texts()))
    assert set(model.thresholds) == set(personal.KINDS)
    text = "so +1 (269) 555-3296 4524132264652876 é 7536784127813050 4845168114407329 and 1234567890123456 x"
    base, added = spans_of(docs_of([text]), model)[0]
    assert base == base_of(text)
    values = {text[a:b] for _, a, b in added}
    assert "+1 (269) 555-3296" in values
    assert {v for v in values if v.isdigit()} == {d for d in ("4524132264652876", "7536784127813050", "4845168114407329") if luhn(d)}
    every = [*base, *added]
    assert all(a[2] <= b[1] or b[2] <= a[1] for a in added for b in every if a != b)


def test_redaction(docs_of):
    docs = docs_of(["é a@b.cd, +1 (487) 555-7209.", "clean", None, "9 1.2.3.4"])
    found, base, added = personal.with_spans(docs, personal.Model())
    rows = found.select("doc_id", personal.redacted(F.col("text"), F.concat(base, added)).alias("t")).collect()
    assert {r.doc_id: r.t for r in rows} == {0: "é [EMAIL], [PHONE].", 1: "clean", 2: None, 3: "9 [IP]"}


def test_odd_rows_empty_tables_and_written_form(odd_docs, docs_of):
    model = personal.train(odd_docs)
    assert model == personal.Model()
    assert all(v == ([], []) for v in spans_of(odd_docs, model).values())
    found, base, added = personal.with_spans(odd_docs, model)
    assert [c for c in found.columns if c not in (base, added)] == odd_docs.columns
    assert personal.train(odd_docs.limit(0)) == personal.Model()
    assert spans_of(odd_docs.limit(0), model) == {}
    found, base, _ = personal.with_spans(docs_of(["1.2.3.4 a@b.c"]), model)
    assert found.select(personal.written(F.col(base))).first()[0] == "email:8:13,ip:0:7"


def test_no_python_in_the_plan(docs_of):
    found, base, added = personal.with_spans(docs_of(["a"]), personal.Model([(1, 2.0, 0.5, (2, 1.0, -1.0, 1.0))], {"card": 0.1}))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
