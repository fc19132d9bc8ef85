"""Legacy archive converter: ARC files, version 1 and 2, to equivalent WARC files, and both read back.

ARC records are found by their version block's header fields and their declared lengths; WARC identifiers, dates, types
and digests are made from them. HTTP responses become ``response`` records, whatever else (DNS answers, files)
``resource`` records, repeated payloads ``revisit`` records. Archives are gzip files that Spark's text sink writes, one
row a file of about ``ARCHIVE_BYTES`` (the sink's line separator is the record separator, and bytes pass as they are), so
writes are committed per task, readable from every executor, and no archive grows with the task that writes it.
"""

from __future__ import annotations

import datetime
import gzip
import hashlib
import io
import re
import uuid
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sft_tables.llm.common import read_table, scratch_dir, slices

#: Header fields of a record line by ARC version (fixed values of the format).
FIELDS = {
    "1": "URL IP-address Archive-date Content-type Archive-length".split(),
    "2": "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length".split(),
}
#: Names of WARC headers that are read, whose case does not matter (fixed values of the format).
HEADERS = {n.lower(): n for n in (
    "WARC-Type", "WARC-Record-ID", "WARC-Date", "WARC-Target-URI", "WARC-Payload-Digest", "WARC-Refers-To-Page", "Content-Type", "Content-Length")}
NO_IP, NO_URL, NO_ID = "0.0.0.0", "urn:none", "-"
EPOCH = datetime.datetime(2000, 1, 1)
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
LEAST_REVISIT = 100
ARCHIVE_BYTES = 32 << 20
WHOLE_FILES = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED", "maxRecordsPerFile": 1}
CRLF = "\r\n"
HTTP = b"HTTP/"
PAGE = re.compile(rb"(?im)^X-Page-Id:[ \t]*(-?[0-9]{1,19})[ \t]*\r?$")
LENGTH = re.compile(rb"(?im)^Content-Length:[ \t]*([0-9]{1,18})[ \t]*\r?$")


class First(NamedTuple):
    """The record whose payload a revisit repeats."""

    path: str
    at: int
    page_id: int | None
    url: str
    date: str


def archives(records: Iterator[bytes], begin, end: bytes) -> Iterator[bytes]:
    """Records packed into files of about ``ARCHIVE_BYTES`` (or one longer record); ``begin(n)`` opens file n."""
    held: list[bytes] = []
    size = number = 0
    for record in records:
        if not held:
            held.append(begin(number))
        held.append(record)
        size += len(record)
        if size >= ARCHIVE_BYTES:
            yield end.join(held)
            held, size, number = [], 0, number + 1
    if held:
        yield end.join(held)


def one_each(values: Iterator[bytes]) -> Iterator[pa.RecordBatch]:
    for value in values:
        yield pa.RecordBatch.from_arrays([pa.array([value], pa.large_binary() if len(value) >= 1 << 31 else pa.binary())], ["value"])


def arc_files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole ARC files: a version block, then a line and an HTTP response per page. Tasks take versions by turns."""
    task = TaskContext.get().partitionId()
    version = "1" if task % 2 == 0 else "2"

    def records() -> Iterator[bytes]:
        for batch in slices(batches, "html"):
            for page, url, html in zip(*(c.to_pylist() for c in batch.columns)):
                yield arc_record(page, url, html, version).encode()

    yield from one_each(archives(records(), lambda n: version_block(f"filedesc://pages-{task}-{n}.arc", version).encode(), b"\n"))


def version_block(name: str, version: str) -> str:
    body = f"{version} 0 sft-tables\n{' '.join(FIELDS[version])}\n"
    return f"{name} {NO_IP} {EPOCH:%Y%m%d%H%M%S} text/plain {'200 - - 0 - ' if version == '2' else ''}{len(body)}\n{body}"


def arc_record(page: int | None, url: str | None, html: str | None, version: str) -> str:
    payload = html or ""
    size = len(payload.encode())
    head = CRLF.join(["HTTP/1.1 200 OK", "Content-Type: text/html; charset=utf-8", f"X-Page-Id: {NO_ID if page is None else page}",
                      f"Content-Length: {size}", "", ""])
    date = (EPOCH + datetime.timedelta(seconds=(page or 0) % 10**9)).strftime("%Y%m%d%H%M%S")
    place = "".join(f"%{b:02X}" if b <= 32 or b == 127 else chr(b) for b in url.encode()) if url and url.isascii() else quoted(url)
    fields = [place, NO_IP, date, "text/html", *(["200", "-", "-", "0", "-"] if version == "2" else []), str(len(head) + size)]
    return f"{' '.join(fields)}\n{head}{payload}"


def quoted(url: str | None) -> str:
    """A URL without blanks, controls or other than ASCII characters; null and empty become a name of their own."""
    return "".join(c if " " < c < "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in url) if url else NO_URL


class Reader:
    """Reads an archive forward, gzip (one member, or one per record) or plain, and knows where it is."""

    def __init__(self, content: bytes):
        raw = io.BytesIO(content)
        self.stream = io.BufferedReader(gzip.GzipFile(fileobj=raw), 1 << 16) if content[:2] == b"\x1f\x8b" else raw
        self.at = 0

    def line(self) -> bytes:
        found = self.stream.readline()
        self.at += len(found)
        return found

    def take(self, n: int) -> bytes:
        found = self.stream.read(n)
        self.at += n
        if len(found) != n:
            raise ValueError(f"the archive ends inside a record of {n} bytes")
        return found


def version_fields(body: bytes) -> list[str]:
    """Names of the fields of record lines, as a version block states them."""
    names = body.split(b"\n")[1].decode().split() if b"\n" in body else []
    if "URL" not in names or names[-1] != "Archive-length":
        raise ValueError(f"unknown record fields: {' '.join(names)}")
    return names


def arc_records(content: bytes) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(offset, header fields, body) of the records of an ARC file, version blocks left out.

    A version block holds until the next one, so files may be joined. Blanks in a record line beyond those between its
    fields belong to the URL.
    """
    reader = Reader(content)
    fields: list[str] | None = None
    while True:
        at, line = reader.at, reader.line()
        if not line:
            return
        if not line.strip(b"\r\n"):
            continue
        parts = line.decode(errors="replace").rstrip("\r\n").split(" ")
        if not parts[-1].isascii() or not parts[-1].isdigit():
            raise ValueError(f"no length ends the record line at {at}")
        body = reader.take(int(parts[-1]))
        if parts[0].startswith("filedesc://"):
            fields = version_fields(body)
            continue
        if fields is None:
            raise ValueError("an ARC file begins with its version block")
        more = len(parts) - len(fields)
        if more < 0:
            raise ValueError(f"{len(parts)} fields in a record line; the version block names {len(fields)}")
        place = fields.index("URL")
        yield at, dict(zip(fields, [*parts[:place], " ".join(parts[place:place + more + 1]), *parts[place + more + 1:]])), body


def http_parts(body: bytes) -> tuple[bytes, bytes, int | None]:
    """(header with its blank line, payload, page id if the header has one) of an HTTP response; without a blank line
    all is header."""
    blank = re.search(rb"\r?\n\r?\n", body)
    end = blank.end() if blank else len(body)
    page = PAGE.search(body, 0, end)
    number = int(page[1]) if page else None
    return body[:end], body[end:], number if number is not None and -(1 << 63) <= number < 1 << 63 else None


def body_parts(body: bytes) -> tuple[bytes, bytes, int | None]:
    """As ``http_parts``; a body that is no HTTP response is all payload."""
    return http_parts(body) if body.startswith(HTTP) else (b"", body, None)


def warc_date(digits: str | None) -> str:
    """ISO date of an ARC date; one that is cut short counts from its beginning, an unreadable one is ``EPOCH``."""
    full = (digits or "") + "00000101000000"[len(digits or ""):]
    try:
        return f"{datetime.datetime.strptime(full[:14], '%Y%m%d%H%M%S'):%Y-%m-%dT%H:%M:%SZ}"
    except ValueError:
        return f"{EPOCH:%Y-%m-%dT%H:%M:%SZ}"


def record_id(path: str, at: int | str) -> str:
    """The same for the same place of the same archive, and for no other."""
    return f"<urn:uuid:{uuid.UUID(hashlib.sha256(f'{path} {at}'.encode()).hexdigest()[:32], version=5)}>"


def warc_record(kind: str, headers: list[tuple[str, str]], block: bytes) -> bytes:
    """One record without the two line ends that close it."""
    lines = ["WARC/1.1", f"WARC-Type: {kind}", *(f"{k}: {v}" for k, v in headers), f"Content-Length: {len(block)}", "", ""]
    return CRLF.join(lines).encode() + block


def warc_info(path: str, number: int) -> bytes:
    about = f"software: sft-tables{CRLF}format: WARC File Format 1.1{CRLF}conformsTo: ARC{CRLF}"
    return warc_record("warcinfo", [("WARC-Record-ID", record_id(path, f"info {number}")), ("WARC-Date", f"{EPOCH:%Y-%m-%dT%H:%M:%SZ}"),
                                    ("Content-Type", "application/warc-fields")], about.encode())


def converted(content: bytes, revisits: dict[int, First], path: str = "") -> Iterator[bytes]:
    """WARC records of an ARC file; revisits: offset of a record -> the record that holds the same payload."""
    for at, fields, body in arc_records(content):
        head, payload, page = body_parts(body)
        same = revisits.get(at)
        http = bool(head)
        block = body if same is None else head
        kind = "revisit" if same else "response" if http else "resource"
        media = fields.get("Content-type", "-")
        headers = [
            ("WARC-Record-ID", record_id(path, at)), ("WARC-Date", warc_date(fields.get("Archive-date"))), ("WARC-Target-URI", quoted(fields["URL"])),
            *([("WARC-IP-Address", fields["IP-address"])] if fields.get("IP-address", "-") != "-" else []),
            ("Content-Type", "application/http; msgtype=response" if http else media if "/" in media else "application/octet-stream"),
            ("WARC-Payload-Digest", f"sha256:{hashlib.sha256(payload).hexdigest()}"), ("WARC-Block-Digest", f"sha256:{hashlib.sha256(block).hexdigest()}"),
        ]
        if same:
            headers += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(same.path, same.at)), ("WARC-Refers-To-Target-URI", quoted(same.url)),
                        ("WARC-Refers-To-Date", warc_date(same.date)), ("WARC-Refers-To-Page", NO_ID if same.page_id is None else str(same.page_id)),
                        ("X-Payload-Bytes", str(len(payload)))]
        yield warc_record(kind, headers, block)


def warc_records(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of the records of a WARC file, by their declared lengths."""
    reader = Reader(content)
    while line := reader.line():
        if not re.fullmatch(rb"WARC/[0-9]+\.[0-9]+\r?\n", line):
            raise ValueError(f"no WARC record begins here: {line[:40]!r}")
        headers: dict[str, str] = {}
        name = ""
        while (line := reader.line()).strip(b"\r\n"):
            text = line.decode(errors="replace").rstrip(CRLF)
            if text[0] in " \t" and name:
                headers[name] += " " + text.strip()
                continue
            name, _, value = text.partition(":")
            name = HEADERS.get(name.strip().lower(), name.strip())
            headers[name] = value.strip()
        if not headers.get("Content-Length", "").isdigit():
            raise ValueError("a WARC record without its length")
        block = reader.take(int(headers["Content-Length"]))
        if reader.take(4) != b"\r\n\r\n":
            raise ValueError("a WARC record goes on past its declared length")
        yield headers, block


def files(spark: SparkSession, path: str, pattern: str = "part-*") -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path).select("path", "content")


def each_file(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


def batched(rows: Iterator[tuple], schema: pa.Schema, most: int = 2000) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) >= most:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def write_files(rows: DataFrame, path: str, end: str) -> None:
    """Each binary value a file; a cast to text changes no byte."""
    rows.select(F.col("value").cast("string").alias("value")).write.options(lineSep=end, **WHOLE_FILES).text(path)


def write_arc(pages: DataFrame, path: str) -> None:
    """ARC files of about ``ARCHIVE_BYTES``, version 1 and 2 by turns of tasks."""
    rows = pages.select(F.col("page_id").cast("bigint"), F.col("url").cast("string"), F.col("html").cast("string"))
    write_files(rows.mapInArrow(arc_files, "value binary"), path, "\n")


def convert(spark: SparkSession, arc_path: str, warc_path: str, least: int = LEAST_REVISIT, pattern: str = "part-*") -> None:
    """ARC files to WARC files. Records with the payload of another become revisits of the one with the smallest page id.

    Archives may come from elsewhere (``pattern`` tells their names): plain or gzip, with any payload bytes. Payloads are
    compared by SHA-256 and length; those under ``least`` bytes are never revisits. Among records of one page id, or
    without one, the first by file and offset stays; records without an id come last. Only digests are grouped; each file
    then gets the list of its own revisits. A broken record stops the conversion.
    """
    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("path", pa.string()), ("at", pa.int64()), ("page_id", pa.int64()), ("url", pa.string()), ("date", pa.string()),
                            ("digest", pa.binary()), ("size", pa.int64())])

        def rows() -> Iterator[tuple]:
            for file in each_file(batches):
                for at, fields, body in arc_records(file["content"]):
                    _, payload, page = body_parts(body)
                    if len(payload) >= least:
                        yield file["path"], at, page, fields["URL"], fields.get("Archive-date"), hashlib.sha256(payload).digest(), len(payload)

        yield from batched(rows(), schema)

    found = files(spark, arc_path, pattern).mapInArrow(digests, "path string, at bigint, page_id bigint, url string, date string, digest binary, size bigint")
    records = found.select("digest", "size", F.struct(F.col("page_id").isNull().alias("none"), "page_id", "path", "at", "url", "date").alias("r"))
    # grouped by digest and size but joined by digest: both sides of the join are exchanges, which adaptive execution can split
    first = records.groupBy("digest", "size").agg(F.min("r").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1").select("digest", "first")
    again = records.select("digest", F.struct("r.path", "r.at").alias("r")).join(first, "digest").filter(
        (F.col("r.path") != F.col("first.path")) | (F.col("r.at") != F.col("first.at"))).select(
        F.col("r.path").alias("path"), F.struct(F.col("r.at").alias("at"), F.struct(*[f"first.{f}" for f in First._fields]).alias("first")).alias("revisit"))
    lists = again.groupBy("path").agg(F.collect_list("revisit").alias("revisits"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for file in each_file(batches):
            path = file["path"]
            revisits = {r["at"]: First(**r["first"]) for r in file["revisits"] or []}
            records = converted(file["content"], revisits, path)
            yield from one_each(archives(records, lambda n: warc_info(path, n), (CRLF * 2).encode()))

    write_files(files(spark, arc_path, pattern).join(lists, "path", "left").mapInArrow(write, "value binary"), warc_path, CRLF * 2)


def read_warc(spark: SparkSession, path: str, pattern: str = "part-*") -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to, url, date) of the records with a payload.

    ``warcinfo`` and ``request`` records are left out. Digests are bare SHA-256, computed from the payload, and must agree
    with a SHA-256 in the header; revisits, whose payload is elsewhere, have what their header says (a digest by another
    function keeps its prefix, a length nobody states is null). Records without an ``X-Page-Id`` have a null page id. A
    broken record stops the read.
    """
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()),
                            ("refers_to", pa.int64()), ("url", pa.string()), ("date", pa.string())])

        def rows() -> Iterator[tuple]:
            for file in each_file(batches):
                for headers, block in warc_records(file["content"]):
                    kind = headers["WARC-Type"]
                    if kind in ("warcinfo", "request"):
                        continue
                    head, payload, page = body_parts(block)
                    stated = headers.get("WARC-Payload-Digest")
                    size, digest = len(payload), None
                    if kind == "revisit":
                        length = LENGTH.search(head)
                        size = int(headers["X-Payload-Bytes"]) if "X-Payload-Bytes" in headers else int(length[1]) if length else None
                        digest = stated.removeprefix("sha256:") if stated else None
                    else:
                        digest = hashlib.sha256(payload).hexdigest()
                        if stated and stated.startswith("sha256:") and stated != f"sha256:{digest}":
                            raise ValueError(f"the payload of {headers.get('WARC-Record-ID')} differs from its digest")
                    same = headers.get("WARC-Refers-To-Page", NO_ID)
                    yield page, size, digest, kind, None if same == NO_ID else int(same), headers.get("WARC-Target-URI"), headers.get("WARC-Date")

        yield from batched(rows(), schema)

    return files(spark, path, pattern).mapInArrow(
        read, "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, url string, date string")


def round_trip(pages: DataFrame, least: int = LEAST_REVISIT) -> DataFrame:
    """Write ``pages`` to ARC files, convert these to WARC files in the shared folder, and read those back.

    One row per page. Null html counts as an empty payload; a null url is archived as ``urn:none``, a null page id as
    ``-``; blanks and characters beyond ASCII in urls are percent-encoded. Repeated rows are archived each; an empty
    table gives no rows; further columns are ignored.
    """
    spark = pages.sparkSession
    arc, warc = scratch_dir(spark, "arc") + "/files", scratch_dir(spark, "warc") + "/files"
    write_arc(pages, arc)
    convert(spark, arc, warc, least)
    return read_warc(spark, warc)


def query(spark, sf_dir: str) -> DataFrame:
    return round_trip(read_table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, sha256(html) AS payload_digest FROM p),
f AS (SELECT payload_digest, min(page_id) AS f FROM d WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT page_id, payload_bytes, d.payload_digest, CASE WHEN f.f < page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN f.f < page_id THEN f.f END AS refers_to
FROM d LEFT JOIN f ON d.payload_digest = f.payload_digest AND payload_bytes >= 100
"""
