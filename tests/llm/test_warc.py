import base64
import hashlib

from tideline.llm import warc


def read_back(spark, pages):
    folder, files = warc.write_warc(pages)
    return warc.captures(warc.read_records(spark, folder, files))


def test_pages_survive_and_copies_are_revisits(spark, monkeypatch):
    monkeypatch.setattr(warc, "FILE_BYTES", 1500)
    html = ["<p>é</p>", "same", "same", None, "", "x\r\n\r\ny" * 2000, "same"]
    rows = [(i, f"http://h/{i}" if i else None, t, "extra") for i, t in enumerate(html)]
    rows += [(None, "http://a b/\r\nEvil: 1", "same", "extra"), (6, "http://h/6", "same", "extra")]
    found = read_back(spark, spark.createDataFrame(rows, "page_id long, url string, html string, main string")).collect()
    assert len(found) == len(rows)
    largest = {}
    for i, _, t, _ in rows:
        if i is not None:
            largest[t or ""] = max(i, largest.get(t or "", -1))
    seen = []
    for capture in found:
        main, page = capture.main, capture.main.record_id.split(":")[2].split("/")[0]
        page = None if page == "none" else int(page)
        seen.append(page)
        text = next(t or "" for i, _, t, _ in rows if i == page)
        payload = text.encode()
        assert main.payload_bytes == len(payload)
        assert main.digest == base64.b32encode(hashlib.sha1(payload).digest()).decode()
        if page == largest[text]:
            assert (main.kind, main.refers_to, main.payload) == ("response", None, payload)
        else:
            assert (main.kind, main.refers_to, main.payload) == ("revisit", f"urn:page:{largest[text]}", None)
        assert capture.others == 0
        assert capture.request.record_id.endswith("/request") and capture.metadata.payload.startswith(b"page:")
    assert sorted(seen, key=str) == sorted((r[0] for r in rows), key=str)
    assert next(c for c in found if c.main.record_id.startswith("urn:page:none")).main.target == "http://a%20b/%0D%0AEvil:%201"


def test_transactions_with_missing_and_repeated_records(spark):
    columns = "record_id string, kind string, concurrent_to string, refers_to string, target string, digest string, payload_bytes long, payload binary"
    rows = [("r1", "response", None, None, "t", "d", 1, b"x"), ("r2", "revisit", None, "r1", "t", "d", 1, None),
            ("q2", "request", "r1", None, "t", None, None, b"2"), ("q1", "request", "r1", None, "t", None, None, b"1"),
            ("m1", "metadata", "gone", None, "t", None, None, b"")]
    found = {c.main.record_id: c for c in warc.captures(spark.createDataFrame(rows, columns)).collect()}
    assert set(found) == {"r1", "r2"}
    assert (found["r1"].request.record_id, found["r1"].metadata, found["r1"].others) == ("q1", None, 1)
    assert (found["r2"].request, found["r2"].metadata, found["r2"].others) == (None, None, 0)


def test_empty_table(spark):
    assert read_back(spark, spark.createDataFrame([], "page_id long, url string, html string")).collect() == []
