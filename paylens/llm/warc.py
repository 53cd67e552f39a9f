"""WARC derivatives: linked metadata and plain-text conversion records of response records.

A response record holds an HTTP response. For each one a ``metadata`` record describes the headers
and the page (JSON), and a ``conversion`` record holds its visible text. Both name the response in
``WARC-Refers-To`` and carry its address, date, source headers and payload digest, and digests of
their own.
"""

from __future__ import annotations

import base64
import hashlib
import html
import json
import re
import uuid
from collections.abc import Iterator
from urllib.parse import urljoin

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import picked

VERSION = b"WARC/1.1"
_SPACE = uuid.uuid5(uuid.NAMESPACE_URL, "warc-derivatives")
_HIDDEN = re.compile(r"<!--.*?(?:-->|\Z)|<svg\b[^>]*/>|<(script|style|template|noscript|svg|iframe)\b[^>]*>.*?(?:</\1\s*>|\Z)", re.S | re.I)
_INLINE = re.compile(r"</?(?:a|abbr|b|bdi|bdo|big|cite|code|del|dfn|em|font|i|ins|kbd|mark|q|s|samp|small|span|strong|sub|sup|tt|u|var|wbr)\b[^>]*>", re.I)
_TAG = re.compile(r"<[!?/a-zA-Z][^<>]*(?:>|\Z)")
_TITLE = re.compile(r"<title\b[^>]*>(.*?)(?:</title\s*>|\Z)", re.S | re.I)
_LINK = re.compile(r"""<a\b[^<>]*?\bhref\s*=\s*(?:"([^"<>]*)"|'([^'<>]*)'|([^\s"'<>]+))""", re.I)
_CHARSET = re.compile(rb"charset\s*=\s*[\"']?([A-Za-z0-9_.:-]+)", re.I)

SCHEMA = ("source_id string, type string, record_id string, refers_to string, target_uri string, date string, "
          "payload_digest string, block_digest string, content_length long, record binary")


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(*parts: str) -> str:
    """The same id for the same parts, so that a task run twice writes the same record."""
    return f"<urn:uuid:{uuid.uuid5(_SPACE, chr(0).join(parts))}>"


def serialize(headers: list[tuple[str, str]], block: bytes) -> bytes:
    clean = (f"{k}: {' '.join(v.split())}".encode() for k, v in headers if v)
    return b"\r\n".join([VERSION, *clean, b"", block, b"", b""])


def parse(record: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields (lower-case names; the first of a name holds) and block of one record."""
    head, _, rest = record.partition(b"\r\n\r\n")
    lines = re.sub(rb"\r\n[ \t]+", b" ", head).split(b"\r\n")
    fields: dict[str, str] = {}
    for line in lines[1:]:
        name, colon, value = line.partition(b":")
        if colon:
            fields.setdefault(name.strip().lower().decode("utf-8", "replace"), value.strip().decode("utf-8", "replace"))
    length = fields.get("content-length", "")
    return fields, rest[:int(length)] if length.isdigit() else rest.removesuffix(b"\r\n\r\n")


def visible_text(page: str) -> str:
    """Text without markup; one line for each run between block tags."""
    bare = _TAG.sub("\n", _INLINE.sub("", _HIDDEN.sub("\n", page)))
    lines = (" ".join(line.split()) for line in html.unescape(bare).split("\n"))
    return "\n".join(line for line in lines if line)


def decoded(headers: dict[str, str], body: bytes) -> str:
    named = _CHARSET.search(headers.get("content-type", "").encode()) or _CHARSET.search(body[:1024])
    try:
        return body.decode(named[1].decode() if named else "utf-8", "replace")
    except LookupError:
        return body.decode("utf-8", "replace")


def describe(fields: dict[str, str], status: str, headers: dict[str, str], page: str, text: str) -> bytes:
    title = _TITLE.search(page)
    target = fields.get("warc-target-uri", "")
    links = []
    for match in _LINK.findall(page):
        try:
            links.append(urljoin(target, html.unescape("".join(match)).strip()))
        except ValueError:  # not an address
            continue
    about = {
        "warc-headers": fields, "http-status": status, "http-headers": headers,
        "title": " ".join(html.unescape(title[1]).split()) if title else "", "links": links,
        "text-chars": len(text), "text-words": len(text.split()),
    }
    return json.dumps(about, ensure_ascii=False, sort_keys=True).encode("utf-8", "replace")


def derive(record: bytes) -> list[tuple]:
    """The metadata and the conversion record of a response; any other record gives none."""
    fields, block = parse(record)
    if fields.get("warc-type", "").lower() != "response":
        return []
    head, _, body = block.partition(b"\r\n\r\n")
    status, *lines = head.decode("utf-8", "replace").split("\r\n")
    headers: dict[str, str] = {}
    for line in lines:
        name, colon, value = line.partition(":")
        if colon:
            headers.setdefault(name.strip().lower(), value.strip())
    page = decoded(headers, body)
    text = visible_text(page)
    source = fields.get("warc-record-id", "")
    payload = fields.get("warc-payload-digest") or digest(body)
    out = []
    for kind, media, data in (
        ("metadata", "application/json", describe(fields, status, headers, page, text)),
        ("conversion", "text/plain; charset=utf-8", text.encode("utf-8", "replace")),
    ):
        own = record_id(kind, source, payload)
        written = [
            ("WARC-Type", kind), ("WARC-Record-ID", own), ("WARC-Refers-To", source),
            ("WARC-Target-URI", fields.get("warc-target-uri", "")), ("WARC-Date", fields.get("warc-date", "")),
            ("WARC-Refers-To-Date", fields.get("warc-date", "")), ("WARC-Payload-Digest", payload),
            ("WARC-Block-Digest", digest(data)), ("WARC-Source-Content-Type", headers.get("content-type", "")),
            ("Content-Type", media), ("Content-Length", str(len(data))),
        ]
        out.append((kind, own, source, fields.get("warc-target-uri", ""), fields.get("warc-date", ""), payload,
                    digest(data), len(data), serialize(written, data)))
    return out


def response(url: str, body: bytes, date: str, name: str) -> bytes:
    """A response record around a page."""
    block = b"\r\n".join([b"HTTP/1.1 200 OK", b"Content-Type: text/html; charset=utf-8",
                          b"Content-Length: " + str(len(body)).encode(), b"", body])
    return serialize([
        ("WARC-Type", "response"), ("WARC-Record-ID", record_id("response", name, url, digest(body))), ("WARC-Target-URI", url),
        ("WARC-Date", date), ("WARC-Payload-Digest", digest(body)), ("WARC-Block-Digest", digest(block)),
        ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block))),
    ], block)


def responses(pages: DataFrame, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """``source_id``, ``record``: pages as response records; a null page or address is empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [response(u or "", (p or "").encode("utf-8", "replace"), date, str(i)) for i, u, p in
                    zip(*(batch.column(c).to_pylist() for c in ("source_id", "url", "html")))]
            yield pa.RecordBatch.from_arrays([batch.column("source_id"), pa.array(made, pa.binary())], ["source_id", "record"])

    rows = picked(pages, source_id="page_id", url="url", html="html").withColumn("source_id", F.col("source_id").cast("string"))
    return rows.mapInArrow(run, "source_id string, record binary")


def derivatives(records: DataFrame, id_col: str = "source_id", record_col: str = "record") -> DataFrame:
    """Two rows for each response record: ``source_id``, ``type``, ``record_id``, ``refers_to``,
    ``target_uri``, ``date``, ``payload_digest``, ``block_digest``, ``content_length``, ``record``.

    ``records`` holds one whole WARC record in each row. Records of other types, null and empty
    ones give no row. A missing header is empty and not written out. Repeated records give
    repeated rows with the same ids. Other columns play no part; an empty table gives an empty
    result.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [part.split()[0] for part in SCHEMA.split(", ")]
        kinds = [pa.string()] * 8 + [pa.int64(), pa.binary()]
        for batch in batches:
            for at in range(0, len(batch), 256):
                part = batch.slice(at, 256)
                rows = [(i, *row) for i, record in zip(part.column("source_id").to_pylist(), part.column("record").to_pylist())
                        if record for row in derive(record)]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows) if rows else [[]] * 10, kinds)], names)

    return picked(records, source_id=id_col, record=record_col).mapInArrow(run, SCHEMA)
