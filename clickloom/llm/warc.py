"""WARC derivatives: a metadata and a plain-text conversion record for every response.

Records are rows with the named fields of a WARC record and its block as bytes.  A
derivative refers to its response by id and keeps its address, date and payload digest;
the metadata record also keeps the response's HTTP header lines, and names the conversion
record as made at the same time.  Ids follow from what a record is made of, so a rerun,
or a task repeated after a lost executor, gives the same ids.

Rows stay where they are: no shuffle, and a task holds one batch of pages.

Defined results: a null url or body is empty; a body without text gives an empty
conversion block; rows repeated with the same id, url and body give the same records
again; a null ``page_id`` counts as empty text in the id.  An empty table gives no rows.
"""

from __future__ import annotations

import base64
import hashlib
import html
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.llm.queries import query
from clickloom.llm.shared import small_batches, table

# Names and formats of the record format, and what ends a line of text.
VERSION = b"WARC/1.1"
NAMES = {
    "warc_type": "WARC-Type", "record_id": "WARC-Record-ID", "refers_to": "WARC-Refers-To",
    "concurrent_to": "WARC-Concurrent-To", "target_uri": "WARC-Target-URI", "date": "WARC-Date",
    "payload_digest": "WARC-Payload-Digest", "block_digest": "WARC-Block-Digest", "content_type": "Content-Type",
}
BLOCKS = (
    "address|article|aside|blockquote|br|dd|div|dl|dt|fieldset|figure|footer|form|h[1-6]|header|hr|li|main|nav|ol|p|pre|"
    "section|table|td|th|title|tr|ul"
)
DATE = "2024-01-01T00:00:00Z"
HIDDEN = re.compile(r"<!--.*?(?:-->|$)|<(script|style|noscript|template)\b.*?(?:</\1\s*>|$)", re.DOTALL | re.IGNORECASE)
# What has begun runs to the end of the page where it is not closed, so no pattern scans a page twice.
BREAK = re.compile(rf"</?(?:{BLOCKS})\b[^>]*(?:>|$)", re.IGNORECASE)
TAG = re.compile(r"<[a-zA-Z/!?][^>]*(?:>|$)")
SPACE = re.compile(r"[ \t\r\f\v\xa0]+")
LINES = re.compile(r" ?\n[ \n]*")
TITLE = re.compile(r"<title\b[^>]*(?:>|$)(.*?)(?:</title|$)", re.DOTALL | re.IGNORECASE)
ROOT = re.compile(r"<html\b([^>]*)", re.IGNORECASE)
LANG = re.compile(r"\blang\s*=\s*[\"']?([\w-]+)", re.IGNORECASE)
ANCHOR = re.compile(r"<a\b([^>]*)", re.IGNORECASE)
HREF = re.compile(r"\bhref\s*=\s*", re.IGNORECASE)
VALUE = re.compile(r"\"([^\"]*)\"|'([^']*)'|([^\s>]+)")


def plain_text(page: str) -> str:
    """The text a page shows, one line per block."""
    text = TAG.sub("", BREAK.sub("\n", HIDDEN.sub(" ", page)))
    return LINES.sub("\n", SPACE.sub(" ", html.unescape(text))).strip()


def language(page: str) -> str | None:
    """What the page's root element calls its language."""
    root = ROOT.search(page)
    found = root and LANG.search(root[1])
    return found[1] if found else None


def outlinks(page: str) -> Iterator[str]:
    """Targets of the page's links, in order; a quoted one may hold a ``>``."""
    for anchor in ANCHOR.finditer(page):
        target = HREF.search(page, anchor.start(1), anchor.end(1))
        value = target and VALUE.match(page, target.end())
        if value:
            yield " ".join(html.unescape(next(filter(None, value.groups()), "")).split())


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def made_id(*parts: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, '\0'.join(parts))}>"


RESPONSE = (
    "page_id long, record_id string, warc_type string, refers_to string, concurrent_to string, target_uri string, date string, "
    "content_type string, payload_digest string, block_digest string, content_length long, block binary"
)
RECORD_NAMES = [f.split()[0] for f in RESPONSE.split(", ")]
RECORD_TYPES = [{"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}[f.split()[1]] for f in RESPONSE.split(", ")]


def record(page_id, kind, record_id, refers_to, concurrent_to, uri, date, content_type, payload_digest, block) -> tuple:
    return (page_id, record_id, kind, refers_to, concurrent_to, uri, date, content_type, payload_digest, digest(block),
            len(block), block)


def batch_of(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[]] * len(RECORD_NAMES)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, RECORD_TYPES, strict=True)], names=RECORD_NAMES)


def responses(pages: DataFrame, date: str = DATE) -> DataFrame:
    """Response records of pages: an HTTP header and the page as payload."""
    small_batches(pages.sparkSession)
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("url", "html")],
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for page_id, url, page in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                body = page.encode()
                head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(body)}\r\n\r\n"
                payload = digest(body)
                record_id = made_id("response", "" if page_id is None else str(page_id), url, payload)
                uri = re.sub(r"[\r\n]", "", url)
                out.append(record(page_id, "response", record_id, None, None, uri, date, "application/http; msgtype=response",
                                  payload, head.encode() + body))
            yield batch_of(out)

    return rows.mapInArrow(run, RESPONSE)


def split_response(block: bytes) -> tuple[list[str], bytes]:
    """Header lines and payload of an HTTP response."""
    head, mark, body = block.partition(b"\r\n\r\n")
    return (head.decode("utf-8", "replace").split("\r\n"), body) if mark else ([], block)


def derivatives(records: DataFrame) -> DataFrame:
    """A metadata and a conversion record for every response among the records."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                source, uri, date = r["record_id"], r["target_uri"], r["date"]
                head, body = split_response(r["block"])
                page = body.decode("utf-8", "replace")
                text = plain_text(page).encode()
                payload = r["payload_digest"] or digest(body)
                conversion, metadata = made_id("conversion", source), made_id("metadata", source)
                title, lang = TITLE.search(page), language(page)
                fields = [("source-record", source), ("source-payload-digest", payload), ("conversion-record", conversion)]
                fields += [("source-header", line) for line in head]
                fields += [("title", " ".join(plain_text(title[1]).split()))] if title else []
                fields += [("language", lang)] if lang else []
                fields += [("outlink", link) for link in outlinks(page)]
                lines = "".join(f"{k}: {v}\r\n" for k, v in fields).encode()
                out.append(record(r["page_id"], "metadata", metadata, source, conversion, uri, date, "application/warc-fields",
                                  payload, lines))
                out.append(record(r["page_id"], "conversion", conversion, source, metadata, uri, date,
                                  "text/plain; charset=utf-8", payload, text))
            yield batch_of(out)

    return records.where(F.col("warc_type") == "response").select(*RECORD_NAMES).mapInArrow(run, RESPONSE)


def record_bytes(row: dict) -> bytes:
    """A record as it stands in a WARC file."""
    lines = [f"{name}: {row[key]}" for key, name in NAMES.items() if row[key] is not None]
    head = "\r\n".join([*lines, f"Content-Length: {len(row['block'])}"]).encode()
    return VERSION + b"\r\n" + head + b"\r\n\r\n" + row["block"] + b"\r\n\r\n"


def parse_records(data: bytes) -> Iterator[dict]:
    """The records of a WARC file's bytes, each found by its length."""
    keys, at = {v.lower(): k for k, v in NAMES.items()}, 0
    while at < len(data):
        stop = data.index(b"\r\n\r\n", at)
        fields = dict.fromkeys(NAMES)
        lines = data[at:stop].decode().split("\r\n")
        if lines[0].encode() != VERSION:
            raise ValueError(f"no record at byte {at}")
        size = 0
        for line in lines[1:]:
            name, _, value = line.partition(":")
            if name.lower() == "content-length":
                size = int(value)
            elif name.lower() in keys:
                fields[keys[name.lower()]] = value.strip()
        yield fields | {"block": data[stop + 4 : stop + 4 + size]}
        at = stop + 4 + size + 4


def file_bytes(records: DataFrame) -> DataFrame:
    """(record_id, data): every record as it stands in a file, for a binary sink."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data = [record_bytes(r) for r in batch.to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("record_id"), pa.array(data, pa.binary())], names=["record_id", "data"])

    return records.select(*RECORD_NAMES).mapInArrow(run, "record_id string, data binary")


@query("op5_warc_derivatives")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = derivatives(responses(table(spark, sf_dir, "pages")))
    return made.withColumn("block", F.col("block").cast("string"))
