"""Metadata and plain-text records derived from WARC responses.

Each response gives two records: metadata with what the source headers and the
page say, and a conversion with its plain text. Both name the response they refer
to and carry its target, date, payload digest and all HTTP headers, repeated ones
too. Record ids are made from the response's id, so that a task that runs again
writes the same ones. The records are written as WARC files and read back.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import html as html_entities
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm.common import map_text, prepare, scratch_path, string_type

VERSION = "WARC/1.1"
#: Date of responses made from pages, which have none.
CAPTURE_DATE = "2024-01-01T00:00:00Z"
RECORDS_PER_FILE = 5_000
#: Extension header that carries the key of the row that a record was derived from.
KEY_HEADER = "WARC-Source-Key"
END = "\r\n\r\n"

_NAMES = uuid.NAMESPACE_URL
_HIDDEN = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style|noscript|template|head)\b.*?(?:</\1\s*>|\Z)", re.I | re.S)
_TITLE = re.compile(r"<title[^>]*>(.*?)</title", re.I | re.S)
_LINK = re.compile(r"""<a\s[^>]*?href\s*=\s*["']?([^"'\s>]+)""", re.I)
_LANGUAGE = re.compile(r"""<html[^>]*?\slang\s*=\s*["']?([A-Za-z-]+)""", re.I)
_BREAK = re.compile(r"</?(?:p|div|br|li|ul|ol|h[1-6]|tr|table|article|section|nav|header|footer|blockquote|pre)\b[^>]*>", re.I)
_TAG = re.compile(r"<[a-zA-Z/!?][^>]*>?")
_BLANKS = re.compile(r"[^\S\n]+")
_LINES = re.compile(r" ?\n[ \n]*")
_HEADER = re.compile(rb"([^:\r\n]+):[ \t]*([^\r\n]*)\r?\n")


def digest(data: bytes) -> str:
    """SHA-1 in base 32, as WARC headers write it."""
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(*parts: str) -> str:
    """A record id that depends on its parts only."""
    return f"<urn:uuid:{uuid.uuid5(_NAMES, chr(0).join(parts))}>"


def _one_line(value: str) -> str:
    return " ".join(value.split())


def make_record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    """A record: headers, length and digest of the block, the block. ``END`` follows it in a file."""
    lines = [VERSION, *(f"{k}: {_one_line(v)}" for k, v in headers if v)]
    lines += [f"WARC-Block-Digest: {digest(block)}", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + END.encode() + block


def parse_record(record: bytes) -> tuple[dict[str, str], bytes]:
    """Headers (names in lower case) and block of one record."""
    head, _, rest = record.partition(END.encode())
    found = {k.decode("latin-1").strip().lower(): v.decode("utf-8", "replace").strip() for k, v in _HEADER.findall(head + b"\r\n")}
    length = found.get("content-length", "")
    return found, rest[: int(length)] if length.isdigit() else rest


def response_record(url: str | None, page: str | None, name: str) -> bytes:
    """The response that a stored page came in."""
    payload = (page or "").encode("utf-8", "surrogatepass")
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nContent-Length: {len(payload)}{END}".encode()
    headers = [
        ("WARC-Type", "response"),
        ("WARC-Record-ID", record_id(name, url or "", digest(payload))),
        ("WARC-Target-URI", url or ""),
        ("WARC-Date", CAPTURE_DATE),
        ("Content-Type", "application/http; msgtype=response"),
        ("WARC-Payload-Digest", digest(payload)),
    ]
    return make_record(headers, http + payload)


def plain_text(page: str) -> str:
    """Visible text of a page: no scripts, styles or head, a line for each block."""
    text = _BREAK.sub("\n", _HIDDEN.sub(" ", page))
    text = html_entities.unescape(_TAG.sub("", text)).replace("\r", "\n").replace("\0", "")
    return _LINES.sub("\n", _BLANKS.sub(" ", text)).strip()


def derive(record: bytes, key: str | None = None) -> list[tuple[str, str, str, bytes]]:
    """Metadata and conversion of a response: type, record id, id referred to, record.

    A record that is no response gives none. A missing payload digest is computed.
    Every source header is a field of the metadata, in order; ``key`` goes into an
    extension header of both records.
    """
    headers, block = parse_record(record)
    if headers.get("warc-type") != "response":
        return []
    http, _, payload = block.partition(END.encode())
    status, _, http_lines = http.partition(b"\r\n")
    source = headers.get("warc-record-id") or record_id(digest(block))
    fields_of = [(k.decode("latin-1").strip().lower(), v.decode("latin-1")) for k, v in _HEADER.findall(http_lines + b"\r\n")]
    media_type = next((v for k, v in fields_of if k == "content-type"), "")
    charset = re.search(r"charset=[\"']?([\w-]+)", media_type, re.I)
    try:
        page = payload.decode(charset[1] if charset else "utf-8", "replace")
    except LookupError:
        page = payload.decode("utf-8", "replace")
    shared = [
        ("WARC-Target-URI", headers.get("warc-target-uri", "")),
        ("WARC-Date", headers.get("warc-date", "")),
        ("WARC-Refers-To", source),
        ("WARC-Payload-Digest", headers.get("warc-payload-digest") or digest(payload)),
        (KEY_HEADER, key or ""),
    ]
    title, language = _TITLE.search(page), _LANGUAGE.search(page)
    fields = [("fetch-status", status.decode("latin-1")), *((f"http-{k}", v) for k, v in fields_of)]
    fields += [("title", html_entities.unescape(title[1]) if title else ""), ("language", language[1] if language else "")]
    fields += [("outlink", html_entities.unescape(x)) for x in dict.fromkeys(_LINK.findall(page))]
    body = "".join(f"{k}: {_one_line(v)}\r\n" for k, v in fields if _one_line(v)).encode("utf-8", "replace")
    found = []
    for name, media, block_ in (
        ("metadata", "application/warc-fields", body),
        ("conversion", "text/plain; charset=UTF-8", plain_text(page).encode("utf-8", "replace")),
    ):
        own = record_id(source, name)
        found.append((name, own, source, make_record([("WARC-Type", name), ("WARC-Record-ID", own), *shared, ("Content-Type", media)], block_)))
    return found


def responses(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Rows (key, record) with a response record for each page; a null page has an empty payload."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
        for batch in batches:
            names, urls, bodies = (c.to_pylist() for c in batch.columns)
            yield [batch.column(0), [response_record(u, b, n or "") for n, u, b in zip(names, urls, bodies)]]

    rows = map_text(pages.select(*string_type(pages, [key, url, html])), run, "id string, record binary")
    return rows.select(F.col("id").cast(pages.schema[key].dataType).alias(key), "record")


def derivatives(df: DataFrame, key: str = "page_id", record: str = "record") -> DataFrame:
    """Rows (key, record_type, record_id, refers_to, record): two for each response record.

    Other records and nulls give no rows; equal responses give equal rows. Each
    record is derived where it lies, without a shuffle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
        for batch in batches:
            found = [(n, *d) for n, r in zip(*(c.to_pylist() for c in batch.columns)) if r for d in derive(r, n)]
            yield [list(c) for c in zip(*found)] if found else [[] for _ in range(5)]

    schema = "id string, record_type string, record_id string, refers_to string, record binary"
    rows = map_text(df.select(F.col(f"`{key}`").cast("string"), F.col(f"`{record}`").cast("binary")), run, schema)
    return rows.withColumn("id", F.col("id").cast(df.schema[key].dataType)).withColumnRenamed("id", key)


def describe(records: DataFrame, key: str = "page_id", key_type: str = "bigint") -> DataFrame:
    """Rows (key, record_type, record_id, refers_to, target_uri, payload_digest, block_digest, block_bytes, block_sha256, intact).

    One row for each row with a ``record``. The key is read from the record; a
    record without one, or with one that is not of ``key_type``, has a null key.
    ``intact`` tells whether the block still has its length and digest.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
        for batch in batches:
            parsed = [parse_record(r) for r in batch.column(0).to_pylist() if r is not None]
            pick = lambda name, p=parsed: [h.get(name) for h, _ in p]
            intact = [h.get("warc-block-digest") == digest(b) and h.get("content-length") == str(len(b)) for h, b in parsed]
            yield [
                pick(KEY_HEADER.lower()), pick("warc-type"), pick("warc-record-id"), pick("warc-refers-to"), pick("warc-target-uri"),
                pick("warc-payload-digest"), pick("warc-block-digest"), [len(b) for _, b in parsed],
                [hashlib.sha256(b).hexdigest() for _, b in parsed], intact,
            ]

    schema = ("id string, record_type string, record_id string, refers_to string, target_uri string, payload_digest string, "
              "block_digest string, block_bytes bigint, block_sha256 string, intact boolean")  # fmt: skip
    rows = map_text(records.select("record"), run, schema)
    return rows.withColumn("id", F.expr(f"try_cast(id AS {key_type})")).withColumnRenamed("id", key)


def write_warc(records: DataFrame, path: str) -> None:
    """Write records as gzip-compressed WARC files; their blocks must be UTF-8, as those of ``derivatives`` are.

    A record is a line of Spark's text sink with the record end as line separator.
    """
    records.select(F.col("record").cast("string").alias("value")).write.options(
        lineSep=END, compression="gzip", maxRecordsPerFile=RECORDS_PER_FILE
    ).text(path)


def split_records(data: bytes) -> Iterator[bytes]:
    """Records of the content of a WARC file."""
    at = 0
    while at < len(data):
        head = data.find(END.encode(), at)
        if head < 0:
            return
        length = parse_record(data[at : head + 4])[0].get("content-length", "0")
        end = head + 4 + int(length)
        yield data[at:end]
        at = end + len(END)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Rows (file, record) of the WARC files of a folder; a file, of bounded records, is read by one task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
        for batch in batches:
            for name, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                data = data.as_py()
                found = list(split_records(gzip.decompress(data) if name.endswith(".gz") else data))
                yield [[name] * len(found), found]

    files = prepare(spark).read.format("binaryFile").option("pathGlobFilter", "*.txt*").load(path)
    return map_text(files.select("path", "content"), run, "file string, record binary")


def derivative_files(pages: DataFrame, key: str = "page_id") -> DataFrame:
    """Write the derivatives of all pages as WARC files to the shared folder and describe what the files give back."""
    spark = pages.sparkSession
    path = scratch_path(spark, "warc")
    write_warc(derivatives(responses(pages, key), key), path)
    return describe(read_warc(spark, path), key, pages.schema[key].dataType.simpleString())
