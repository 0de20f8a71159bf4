"""WARC archives: pages to record files, and files to one nested row a capture.

Writing. Each page becomes three records: a request, the response or a revisit, and
metadata; the first and last name the middle one in WARC-Concurrent-To. Of pages with
equal payloads the one with the largest id is the response and the others are revisits
with its id in WARC-Refers-To and no payload; their stored HTTP header keeps the payload's
length. Payloads are compared by SHA-1 digest, found by one grouping; only digests that
repeat are joined back, from a written table: broadcast if that is small, else so that
adaptive execution can split a digest that very many pages share. Records are gzip members of files of about
`FILE_BYTES`.

Reading. Files become rows of records, and transactions are put together by identifier:
what is concurrent to a record is grouped by that identifier, combined before the shuffle
(of several requests or metadata records the least identifier stands, and `others` counts
the rest), and joined to the response or revisit. A request or metadata record whose main
record is missing gives no capture.

Defined results. A null payload is empty; a null id is written as `none` and is never the
largest; a null address has no target header. Long payloads are written and read whole. Rows
with equal ids are captures of their own. An empty table makes no captures; further columns
are not looked at.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.llm.files import file_name, new_file
from tideline.llm.storage import shared_folder, sized, stored

FILE_BYTES = 8_000_000  # of a file, compressed
BATCH = 500  # records in an Arrow batch
PIECE = 8192  # bytes given to the decompressor at once
WHEN = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MEMBER = 16 + zlib.MAX_WBITS  # gzip framing
RECORD = (
    "record_id string, kind string, concurrent_to string, refers_to string, target string, digest string, "
    "payload_bytes long, payload binary"
)


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_bytes(kind: str, record_id: str, headers: dict[str, str | None], block: bytes) -> bytes:
    """One record as a gzip member."""
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <{record_id}>", f"WARC-Date: {WHEN}"]
    lines += [f"{name}: {value}" for name, value in headers.items() if value is not None]
    lines += [f"Content-Length: {len(block)}", "", ""]
    packer = zlib.compressobj(1, wbits=MEMBER)
    return packer.compress("\r\n".join(lines).encode() + block + b"\r\n\r\n") + packer.flush()


def _address(url: str | None) -> str | None:
    """The address without characters that would end a header line."""
    return None if url is None else re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m.group()):02X}", url)


def page_records(page: int | None, url: str | None, html: str | None, response: int | None, unique: str) -> bytes:
    """The three records of a page; `response` is the page that holds its payload."""
    own, payload = "none" if page is None else str(page), (html or "").encode("utf-8", "replace")
    main, target = f"urn:page:{own}/{unique}/main", _address(url)
    digest = payload_digest(payload)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    common = {"WARC-Target-URI": target, "WARC-Concurrent-To": f"<{main}>"}
    head = {"WARC-Target-URI": target, "WARC-Payload-Digest": f"sha1:{digest}"}
    if response is None or response == page:
        body = record_bytes("response", main, head | {"Content-Type": "application/http;msgtype=response"}, http + payload)
    else:
        head |= {"WARC-Refers-To": f"<urn:page:{response}>", "WARC-Profile": PROFILE}
        body = record_bytes("revisit", main, head | {"Content-Type": "application/http;msgtype=response"}, http)
    ask = record_bytes(
        "request",
        f"urn:page:{own}/{unique}/request",
        common | {"Content-Type": "application/http;msgtype=request"},
        f"GET {target or '/'} HTTP/1.1\r\n\r\n".encode(),
    )
    about = record_bytes(
        "metadata",
        f"urn:page:{own}/{unique}/metadata",
        common | {"Content-Type": "application/warc-fields"},
        f"page: {own}\r\n".encode(),
    )
    return ask + body + about


def _writer(folder: str):
    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def pages():
            for batch in batches:
                yield from zip(*[batch.column(c).to_pylist() for c in ("page", "url", "html", "response")])

        left, files = pages(), 0
        row = next(left, None)
        while row is not None:
            name, size, captures = file_name(files, ".warc.gz"), 0, 0
            mark = uuid.uuid4().hex
            with new_file(folder, name) as out:
                while row is not None and size < FILE_BYTES:
                    data = page_records(*row, f"{mark}-{captures}")
                    out.write(data)
                    size += len(data)
                    captures += 1
                    row = next(left, None)
            files += 1
            yield pa.RecordBatch.from_pylist([{"name": name, "captures": captures}])

    return write


def write_warc(
    pages: DataFrame, id: str = "page_id", url: str = "url", html: str = "html"
) -> tuple[str, DataFrame]:
    """Writes the pages' records to a new shared folder: its address, and the list of
    files (name, captures) of the tasks that finished."""
    folder = shared_folder(pages.sparkSession, "warc")
    rows = pages.select(
        F.col(id).cast("long").alias("page"), F.col(url).cast("string").alias("url"), F.col(html).alias("html")
    ).withColumn("digest", F.unhex(F.sha1(F.coalesce("html", F.lit("")).cast("binary"))))
    repeated = stored(
        rows.groupBy("digest").agg(F.max("page").alias("response"), F.count("*").alias("n")).where("n > 1").drop("n"),
        "payloads",
    )
    marked = rows.join(sized(repeated), "digest", "left").select("page", "url", "html", "response")
    return folder, stored(marked.mapInArrow(_writer(folder), "name string, captures long"), "warc-files")


def records_of(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (names in lower case) and block of every record of a file of gzip members."""
    whole, at = memoryview(content), 0
    while at < len(whole):
        member, parts = zlib.decompressobj(MEMBER), []
        while not member.eof and at < len(whole):
            piece = whole[at : at + PIECE]  # what is left over of it is copied, so not too much
            parts.append(member.decompress(piece))
            at += len(piece) - len(member.unused_data)
        data = b"".join(parts)
        head, _, rest = data.partition(b"\r\n\r\n")
        lines = head.decode("utf-8", "replace").split("\r\n")[1:]
        headers = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}
        yield headers, rest[: int(headers["content-length"])]


def _bare(reference: str | None) -> str | None:
    return None if reference is None else reference.strip("<>")


def _row(headers: dict[str, str], block: bytes, with_payload: bool) -> dict:
    kind = headers["warc-type"]
    row = {
        "record_id": _bare(headers["warc-record-id"]),
        "kind": kind,
        "concurrent_to": _bare(headers.get("warc-concurrent-to")),
        "refers_to": _bare(headers.get("warc-refers-to")),
        "target": headers.get("warc-target-uri"),
        "digest": headers.get("warc-payload-digest", "").removeprefix("sha1:") or None,
        "payload_bytes": None,
        "payload": None,
    }
    if kind == "response":
        payload = block.partition(b"\r\n\r\n")[2]
        if payload_digest(payload) != row["digest"]:
            raise ValueError(f"payload of {row['record_id']} differs from its digest")
        row |= {"payload_bytes": len(payload), "payload": payload if with_payload else None}
    elif kind == "revisit":
        length = re.search(rb"(?i)\r\ncontent-length: *(\d+)", block)
        row["payload_bytes"] = int(length.group(1)) if length else None
    else:
        row["payload"] = block if with_payload else None
    return row


def read_records(spark: SparkSession, folder: str, files: DataFrame, with_payload: bool = True) -> DataFrame:
    """All records of the listed files of the folder."""

    def parse(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        form = pa.schema(
            [(n, pa.string()) for n in ("record_id", "kind", "concurrent_to", "refers_to", "target", "digest")]
            + [("payload_bytes", pa.int64()), ("payload", pa.binary())]
        )
        for batch in batches:
            for content in batch.column("content"):
                rows: list[dict] = []
                for headers, block in records_of(content.as_buffer().to_pybytes()):
                    rows.append(_row(headers, block, with_payload))
                    if len(rows) == BATCH:
                        yield pa.RecordBatch.from_pylist(rows, form)
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, form)

    if files.isEmpty():
        return spark.createDataFrame([], RECORD)
    contents = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.gz").load(folder)
    named = contents.select(F.element_at(F.split("path", "/"), -1).alias("name"), "content")
    return named.join(files.select("name"), "name", "left_semi").select("content").mapInArrow(parse, RECORD)


def captures(records: DataFrame) -> DataFrame:
    """One row a response or revisit: `main`, `request` and `metadata` as records, and the
    number of `others` concurrent to it."""
    columns = [c for c in records.columns if c != "concurrent_to"]
    record = F.struct(*columns)
    beside = (
        records.where("kind in ('request', 'metadata') and concurrent_to is not null")
        .groupBy(F.col("concurrent_to").alias("main_id"))
        .agg(
            F.min(F.when(F.col("kind") == "request", record)).alias("request"),
            F.min(F.when(F.col("kind") == "metadata", record)).alias("metadata"),
            F.count("*").alias("n"),
        )
    )
    main = records.where("kind in ('response', 'revisit')").select(F.col("record_id").alias("main_id"), record.alias("main"))
    others = F.coalesce("n", F.lit(0)) - F.col("request").isNotNull().cast("int") - F.col("metadata").isNotNull().cast("int")
    return main.join(beside, "main_id", "left").select("main", "request", "metadata", others.alias("others"))


def page_of(record_id: str) -> Column:
    """The page id in a record's identifier; null for none."""
    return F.expr(f"try_cast(regexp_extract({record_id}, '^urn:page:([^/]+)', 1) AS BIGINT)")
