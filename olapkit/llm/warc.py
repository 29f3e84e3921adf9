"""Legacy archive (ARC) files and their conversion to WARC.

``write_arc`` stores pages as ARC files, one per task, in version 1 and 2 by turns. ``read_arc`` reads the version block
of each file, takes the field names of its URL records from there, and cuts records by their declared lengths.
``convert`` synthesises for every record the WARC identifier (a name-based UUID of place and payload), timestamp (from
the 14-digit date), type and digests: of the records with equal payloads the one with the smallest page id is a response,
the others revisit it. ``write_warc`` and ``read_warc`` store and parse WARC files; reading recomputes the payloads'
digests and compares them.

Files are written by Spark's text writer (its line separator is the formats' record end) with gzip, and read by Spark's
binary reader, so any file system of Spark's does, tasks are repeated safely, and no file is larger than one task's
pages. Payloads of responses are shuffled once, by digest and page; equal payloads meet only as digests, whose minimum is
combined before the shuffle.

Defined results: null html is an empty payload; a null url is written as ``urn:page``, blanks and control characters of
urls are percent-encoded. A null page id is kept and comes after all numbers; repeated rows of a page with equal payloads
are each the response if their page is the first. An empty table gives no records. Broken archives (wrong version block,
field counts, lengths or digests) raise an error with the file's name. Only page_id, url and html are read.
"""

from __future__ import annotations

import base64
import datetime as dt
import gzip
import hashlib
import io
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path

#: URL-record fields by ARC version (fixed values of the format).
FIELDS = {1: "URL IP-address Archive-date Content-type Archive-length",
          2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length"}
START = dt.datetime(2024, 1, 1)
YEAR = 365 * 86400
ROWS = 256
ARC_SCHEMA = "page_id long, url string, date string, head string, html string, payload_bytes long, payload_digest string"


def payload_digest(payload: bytes) -> str:
    """Bare upper-case base32 of the SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _http_head(page_id: int | None, length: int) -> str:
    own = "" if page_id is None else f"X-Page-Id: {page_id}\r\n"
    return f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n{own}Content-Length: {length}\r\n\r\n"


def _url(url: str | None) -> str:
    return quote(url, safe="!#$%&'()*+,/:;=?@[]~") if url else "urn:page"


def write_arc(pages: DataFrame, path: str) -> None:
    """ARC files of all pages. The text writer ends each record with the newline that the format wants."""

    def run(batches):
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        version, name, offset, begun = part % 2 + 1, f"pages-{part:05d}.arc", 0, False
        for b in batches:
            values = []
            if not begun and len(b):
                body = f"{version} 0 olapkit\n{FIELDS[version]}\n"
                values.append(f"filedesc://{name} 0.0.0.0 {START:%Y%m%d%H%M%S} text/plain {len(body)}\n{body}")
                offset, begun = len(values[0]) + 1, True
            for page_id, url, html in zip(*(c.to_pylist() for c in b.columns)):
                html = html or ""
                payload = html.encode()
                block = _http_head(page_id, len(payload)) + html
                length = len(block) - len(html) + len(payload)
                date = START + dt.timedelta(seconds=(page_id or 0) % YEAR)
                fields = [_url(url), "0.0.0.0", f"{date:%Y%m%d%H%M%S}", "text/html"]
                if version == 2:
                    fields += ["200", hashlib.md5(payload).hexdigest(), "-", str(offset), name]
                head = " ".join([*fields, str(length)])
                values.append(f"{head}\n{block}")
                offset += len(head) + length + 2
            yield pa.RecordBatch.from_arrays([pa.array(values, pa.string())], ["value"])

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html").mapInArrow(run, "value string")
    rows.write.option("lineSep", "\n").option("compression", "gzip").text(path)


def parse_arc(stream, name: str) -> Iterator[tuple[dict, bytes]]:
    """(fields, content) of every URL record of an ARC stream, after its version block."""

    def header(fields: list[str] | None) -> tuple[list[str], bytes] | None:
        line = stream.readline()
        if not line:
            return None
        parts = line.decode().rstrip("\r\n").split(" ")
        if fields is not None and len(parts) != len(fields) or not parts[-1].isdigit():
            raise ValueError(f"{name}: broken URL record {line[:200]!r}")
        content = stream.read(int(parts[-1]))
        if len(content) < int(parts[-1]) or stream.read(1) not in (b"\n", b""):
            raise ValueError(f"{name}: the record of {parts[0]} does not have its declared length")
        return parts, content

    first = header(None)
    if first is None:
        return
    lines = first[1].decode().split("\n")
    if not first[0][0].startswith("filedesc://") or len(lines) < 2 or not lines[0][:1].isdigit():
        raise ValueError(f"{name}: no version block")
    version = int(lines[0].split(" ")[0])
    if version not in FIELDS or lines[1].split(" ") != FIELDS[version].split(" "):
        raise ValueError(f"{name}: unknown version {lines[:2]}")
    fields = FIELDS[version].split(" ")
    while (record := header(fields)) is not None:
        yield dict(zip(fields, record[0]), version=version), record[1]


def _files(spark, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content")


def _head_value(head: str, name: str) -> str | None:
    for line in head.split("\r\n"):
        key, _, value = line.partition(":")
        if key.lower() == name:
            return value.strip()
    return None


def _chunks(rows: Iterator[tuple], size: int = ROWS) -> Iterator[list[tuple]]:
    held = []
    for r in rows:
        held.append(r)
        if len(held) == size:
            yield held
            held = []
    if held:
        yield held


def read_arc(spark, path: str) -> DataFrame:
    """The records of all ARC files (see ``ARC_SCHEMA``)."""

    def records(name: str, content: bytes) -> Iterator[tuple]:
        for fields, block in parse_arc(gzip.GzipFile(fileobj=io.BytesIO(content)), name):
            head, _, payload = block.partition(b"\r\n\r\n")
            head = head.decode()
            page_id = _head_value(head, "x-page-id")
            yield (None if page_id is None else int(page_id), fields["URL"], fields["Archive-date"], head,
                   payload.decode(), len(payload), payload_digest(payload))

    def run(batches):
        types = [pa.int64(), *[pa.string()] * 4, pa.int64(), pa.string()]
        names = [f.split()[0] for f in ARC_SCHEMA.split(", ")]
        for b in batches:
            for name, content in zip(*b.columns):
                for rows in _chunks(records(name.as_py(), content.as_py())):
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    return _files(spark, path).mapInArrow(run, ARC_SCHEMA)


def convert(arc: DataFrame) -> DataFrame:
    """ARC records with their WARC type: (page_id, url, date, head, html, payload_bytes, payload_digest, record_type,
    refers_to); html is null for revisits. ``arc`` is read twice: for digests, and for the responses' payloads."""
    narrow = arc.select("page_id", "url", "date", "head", "payload_bytes", "payload_digest")
    first = narrow.groupBy("payload_digest").agg(F.min("page_id").alias("first"))
    typed = narrow.join(first, "payload_digest")
    again = typed.where(~F.col("page_id").eqNullSafe(F.col("first"))).select(
        "page_id", "url", "date", "head", F.lit(None).cast("string").alias("html"), "payload_bytes", "payload_digest",
        F.lit("revisit").alias("record_type"), F.col("first").alias("refers_to"))
    f = first.select(F.col("payload_digest").alias("d"), F.col("first").alias("p"))
    kept = arc.join(f, (F.col("payload_digest") == F.col("d")) & F.col("page_id").eqNullSafe(F.col("p")), "left_semi")
    return again.unionByName(kept.withColumn("record_type", F.lit("response")).withColumn(
        "refers_to", F.lit(None).cast("long")))


def record_id(url: str, page_id: int | None, digest: str) -> str:
    """The identifier of a page's record: the same wherever the record is made."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id} {digest} {url}')}>"


def _iso(date: str) -> str:
    return dt.datetime.strptime(date, "%Y%m%d%H%M%S").strftime("%Y-%m-%dT%H:%M:%SZ")


def write_warc(records: DataFrame, path: str) -> None:
    """WARC files of converted records, each begun by a warcinfo record. The text writer ends each record with the
    two blank lines that the format wants."""

    def record(kind: str, ident: str, date: str, content: str, extra: list[str], block: str) -> str:
        lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {ident}", f"WARC-Date: {date}",
                 f"Content-Type: {content}", *extra, f"Content-Length: {len(block.encode())}"]
        return "\r\n".join(lines) + "\r\n\r\n" + block

    def run(batches):
        begun = False
        for b in batches:
            values = []
            if not begun and len(b):
                values.append(record("warcinfo", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, 'olapkit')}>",
                                     f"{START:%Y-%m-%dT%H:%M:%SZ}", "application/warc-fields", [],
                                     "software: olapkit\r\nformat: WARC File Format 1.1\r\n"))
                begun = True
            for page, url, date, head, html, size, digest, kind, refers in zip(*(c.to_pylist() for c in b.columns)):
                block = head + "\r\n\r\n" + (html or "")
                extra = [f"WARC-Target-URI: {url}", f"WARC-Payload-Digest: sha1:{digest}",
                         f"WARC-Block-Digest: sha1:{payload_digest(block.encode())}"]
                if kind == "revisit":
                    extra += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                              f"X-Refers-To-Page: {refers}", f"X-Payload-Length: {size}"]
                values.append(record(kind, record_id(url, page, digest), _iso(date),
                                     "application/http; msgtype=response", extra, block))
            yield pa.RecordBatch.from_arrays([pa.array(values, pa.string())], ["value"])

    cols = ["page_id", "url", "date", "head", "html", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    (records.select(*cols).mapInArrow(run, "value string").write
     .option("lineSep", "\r\n\r\n").option("compression", "gzip").text(path))


def parse_warc(stream, name: str) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers in lower case, block) of every record of a WARC stream."""
    while line := stream.readline():
        if not line.startswith(b"WARC/1."):
            raise ValueError(f"{name}: no record where one should begin: {line[:200]!r}")
        headers = {}
        while (line := stream.readline()).strip():
            key, _, value = line.decode().partition(":")
            headers[key.strip().lower()] = value.strip()
        length = int(headers["content-length"])
        block = stream.read(length)
        if len(block) < length or stream.read(4) != b"\r\n\r\n":
            raise ValueError(f"{name}: {headers.get('warc-record-id')} does not have its declared length")
        yield headers, block


def read_warc(spark, path: str) -> DataFrame:
    """Responses and revisits of all WARC files: page_id, payload_bytes, payload_digest, record_type, refers_to,
    target_uri, warc_date, record_id."""

    def records(name: str, content: bytes) -> Iterator[tuple]:
        for h, block in parse_warc(gzip.GzipFile(fileobj=io.BytesIO(content)), name):
            kind, digest = h["warc-type"], h.get("warc-payload-digest", "").removeprefix("sha1:")
            if kind not in ("response", "revisit"):
                continue
            head, _, payload = block.partition(b"\r\n\r\n")
            if payload_digest(block) != h["warc-block-digest"].removeprefix("sha1:") or (
                    kind == "response" and payload_digest(payload) != digest):
                raise ValueError(f"{name}: {h['warc-record-id']} does not have its digest")
            page = _head_value(head.decode(), "x-page-id")
            yield (None if page is None else int(page),
                   len(payload) if kind == "response" else int(h["x-payload-length"]), digest, kind,
                   int(h["x-refers-to-page"]) if kind == "revisit" else None,
                   h["warc-target-uri"], h["warc-date"], h["warc-record-id"])

    def run(batches):
        types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), *[pa.string()] * 3]
        names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "target_uri", "warc_date",
                 "record_id"]
        for b in batches:
            for name, content in zip(*b.columns):
                for rows in _chunks(records(name.as_py(), content.as_py()), 4096):
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    return _files(spark, path).mapInArrow(run, "page_id long, payload_bytes long, payload_digest string, "
                                               "record_type string, refers_to long, target_uri string, "
                                               "warc_date string, record_id string")


def report(pages: DataFrame) -> DataFrame:
    """Pages to ARC, ARC to WARC, and the WARC records read back."""
    spark = pages.sparkSession
    old, new = scratch_path(spark, "arc"), scratch_path(spark, "warc")
    write_arc(pages, old)
    write_warc(convert(read_arc(spark, old)), new)
    return read_warc(spark, new).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP3_SQL = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload, sha1(coalesce(html, '')) AS hex FROM pages),
b AS (SELECT page_id, octet_length(payload) AS payload_bytes, array_to_string(list_transform(string_split(hex, ''),
      lambda h: ['0000', '0001', '0010', '0011', '0100', '0101', '0110', '0111', '1000', '1001', '1010', '1011', '1100',
                 '1101', '1110', '1111'][strpos('0123456789abcdef', h)]), '') AS bits FROM p),
d AS (SELECT page_id, payload_bytes, array_to_string(list_transform(range(32), lambda i: substr(
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + 16 * substr(bits, 5 * i + 1, 1)::INT + 8 * substr(bits, 5 * i + 2, 1)::INT
      + 4 * substr(bits, 5 * i + 3, 1)::INT + 2 * substr(bits, 5 * i + 4, 1)::INT + substr(bits, 5 * i + 5, 1)::INT,
      1)), '') AS payload_digest FROM b),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM d)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes, payload_digest,
       CASE WHEN page_id IS NOT DISTINCT FROM first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM first THEN first END AS refers_to FROM f"""
