"""Derivative WARC records of responses.

Each response gets a metadata and a conversion record. Both refer to the response
by its record id, target URI and date. The metadata record carries the response's
HTTP headers and digests; the conversion record holds the plain text. The two name
each other as concurrent. Ids follow from the content, so a repeated task makes
the same records.
"""

from __future__ import annotations

import base64
import hashlib
import html
import re
import uuid
import zlib
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logtide.llm.words import arrow_map

DATE = "1970-01-01T00:00:00Z"
# A tag's name ends at white space, a slash or the end of the tag: <title-bar> is another
# tag. Quotes open a value only after the equals sign of an attribute.
_REST = (
    r"(?:[\s/]++|[^\s/>][^\s/>=]*+(?:\s*+=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\s>\"'][^\s>]*+|(?=>)))?+)*+>"
)
_HIDDEN = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))"
    r"|<(script|style|template|noscript|title)(?=[\s/>])" + _REST + r".*?(?:</\1(?=[\s/>])[^>]*>|\Z)",
    re.S | re.I,
)
_TITLE = re.compile(
    r"<title(?=[\s/>])" + _REST + r"(.*?)(?:</title(?=[\s/>])[^>]*>|\Z)", re.S | re.I
)
_LANG = re.compile(r"<html\b[^>]*?\blang\s*=\s*[\"']?([A-Za-z-]+)", re.I)
_BLOCK_TAG = re.compile(
    r"</?(?:address|article|aside|blockquote|body|br|dd|div|dl|dt|footer|form|h[1-6]|head|header|hr"
    r"|html|li|main|nav|ol|option|p|pre|section|table|td|th|tr|ul)(?=[\s/>])" + _REST,
    re.I,
)
_TAG = re.compile(r"<(?:[!?]|/[^a-zA-Z>])[^>]*>|</>|</?[a-zA-Z][^\s/>]*+" + _REST)
_CHARSET = re.compile(r"charset\s*=\s*[\"']?([\w.:-]+)", re.I)
_RESPONSES = (
    "page_id long, record_id string, target_uri string, date string, http_headers string,"
    " payload string, payload_digest string"
)
_DERIVED = (
    "page_id long, warc_type string, record_id string, refers_to string, concurrent_to string,"
    " target_uri string, source_digest string, block_digest string, content_length long,"
    " record string"
)


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(*parts: str) -> str:
    name = hashlib.md5("\x1f".join(parts).encode("utf-8", "surrogatepass")).digest()
    return f"<urn:uuid:{uuid.UUID(bytes=name)}>"


def _one_line(value: str) -> str:
    return " ".join(value.split())


def plain_text(page: str) -> str:
    """Visible text, a line per block, entities resolved, white space collapsed."""
    text = _BLOCK_TAG.sub("\n", _HIDDEN.sub(" ", page))
    text = html.unescape(_TAG.sub("", text))
    return "\n".join(line for line in (" ".join(x.split()) for x in text.split("\n")) if line)


def title_of(page: str) -> str:
    found = _TITLE.search(page)
    return _one_line(html.unescape(found[1])) if found else ""


def record_text(headers: list[tuple[str, str]], block: str) -> str:
    """A record without the two line ends that close it."""
    lines = "".join(f"{name}: {value}\r\n" for name, value in headers)
    return f"WARC/1.1\r\n{lines}\r\n{block}"


def responses(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
    date: str = DATE,
) -> DataFrame:
    """Response rows of fetched pages; a null page has an empty payload, a null URL
    is empty."""

    def build(batches) -> Iterator[dict]:
        for batch in batches:
            ids, urls, bodies = (c.to_pylist() for c in batch.columns)
            urls, bodies = [_one_line(u or "") for u in urls], [b or "" for b in bodies]
            sizes = [len(b.encode()) for b in bodies]
            yield {
                "page_id": ids,
                "record_id": [
                    record_id("response", str(i), u, b) for i, u, b in zip(ids, urls, bodies, strict=True)
                ],
                "target_uri": urls,
                "date": [date] * len(ids),
                "http_headers": [
                    "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
                    f"Content-Length: {n}\r\n" for n in sizes
                ],
                "payload": bodies,
                "payload_digest": [digest(b.encode()) for b in bodies],
            }

    return arrow_map(
        pages.select(
            F.col(f"`{id_col}`").cast("long"), F.col(f"`{url_col}`").cast("string"),
            F.col(f"`{html_col}`").cast("string"),
        ),
        build, _RESPONSES,
    )


def derivatives(found: DataFrame) -> DataFrame:
    """A metadata and a conversion row per response row.

    ``record`` is the whole record but for the two line ends that close it. Repeated
    responses give repeated records with the same ids. Missing values count as
    empty. Whole pages of any length are read; other columns are left out, so no name
    clashes; no rows give no rows. One row in, two rows out; nothing is shuffled.
    """

    def derive(batches) -> Iterator[dict]:
        for batch in batches:
            out: dict[str, list] = {field.split()[0]: [] for field in _DERIVED.split(", ")}
            for page_id, source, uri, date, headers, payload, source_digest in zip(
                *(c.to_pylist() for c in batch.columns), strict=True
            ):
                source, uri, payload = source or "", uri or "", payload or ""
                text = plain_text(payload)
                language = _LANG.search(payload)
                fields = [("title", title_of(payload)), ("text-characters", str(len(text)))]
                if language:
                    fields.append(("language", language[1].lower()))
                status, *lines = (headers or "").split("\r\n")
                fields.append(("http-status", status))
                fields += [
                    (f"http-header-{name.strip().lower()}", value.strip())
                    for name, _, value in (x.partition(":") for x in lines if x)
                ]
                fields.append(("source-payload-digest", source_digest or ""))
                made = {
                    "metadata": ("application/warc-fields", "".join(f"{k}: {v}\r\n" for k, v in fields)),
                    "conversion": ("text/plain; charset=utf-8", text),
                }
                names = {kind: record_id(kind, source) for kind in made}
                for kind, other in (("metadata", "conversion"), ("conversion", "metadata")):
                    content_type, block = made[kind]
                    raw = block.encode()
                    head = [
                        ("WARC-Type", kind),
                        ("WARC-Record-ID", names[kind]),
                        ("WARC-Date", date or DATE),
                        ("WARC-Target-URI", uri),
                        ("WARC-Refers-To", source),
                        ("WARC-Refers-To-Target-URI", uri),
                        ("WARC-Refers-To-Date", date or DATE),
                        ("WARC-Concurrent-To", names[other]),
                        ("WARC-Block-Digest", digest(raw)),
                        ("Content-Type", content_type),
                        ("Content-Length", str(len(raw))),
                    ]
                    row = (
                        page_id, kind, names[kind], source, names[other], uri, source_digest,
                        digest(raw), len(raw), record_text(head, block),
                    )
                    for name, value in zip(out, row, strict=True):
                        out[name].append(value)
            yield out

    return arrow_map(found.select(*(f.split()[0] for f in _RESPONSES.split(", "))), derive, _DERIVED)


def write_warc(records: DataFrame, path: str, column: str = "record", **options: str) -> None:
    """Records as WARC files, one per task; ``compression="gzip"`` packs whole files."""
    records.select(F.col(column).alias("value")).write.options(lineSep="\r\n\r\n", **options).text(path)


def parse_records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of every record of a file."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].decode().split("\r\n")
        headers = dict(line.split(": ", 1) for line in lines[1:])
        size = int(headers["Content-Length"])
        yield headers, data[end + 4 : end + 4 + size]
        at = end + 4 + size + 4


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """``headers`` and ``block`` of the records below a path, a file at a time."""

    def parse(batches) -> Iterator[dict]:
        for batch in batches:
            for content in batch.column(0).to_pylist():
                found = list(parse_records(content))
                yield {"headers": [list(h.items()) for h, _ in found], "block": [b for _, b in found]}

    files = spark.read.format("binaryFile").load(path).select("content")
    return arrow_map(files, parse, "headers map<string,string>, block binary")


def _unchunked(body: bytes) -> bytes:
    """A body without the sizes of its chunks; one that is cut short ends early."""
    out, at = [], 0
    while (end := body.find(b"\r\n", at)) >= 0:
        try:
            size = int(body[at:end].split(b";")[0], 16)
        except ValueError:
            break
        if not size:
            break
        out.append(body[end + 2 : end + 2 + size])
        at = end + 2 + size + 2
    return b"".join(out)


def payload_of(block: bytes) -> tuple[str, str, bytes]:
    """HTTP headers, decoded page and body of a response block.

    Chunks and gzip are undone. The page is read in the charset of its content type,
    UTF-8 without one or with an unknown one; bytes that do not fit it become U+FFFD.
    """
    head, _, body = block.partition(b"\r\n\r\n")
    headers = head.decode("utf-8", "replace") + "\r\n"
    fields = {
        name.strip().lower(): value.strip()
        for name, _, value in (line.partition(":") for line in headers.split("\r\n")[1:])
    }
    raw = body
    if "chunked" in fields.get("transfer-encoding", "").lower():
        raw = _unchunked(raw)
    if "gzip" in fields.get("content-encoding", "").lower():
        opened = zlib.decompressobj(31)
        try:
            raw = opened.decompress(raw)
        except zlib.error:
            raw = b""
    charset = _CHARSET.search(fields.get("content-type", ""))
    try:
        page = raw.decode(charset[1] if charset else "utf-8", "replace")
    except LookupError:
        page = raw.decode("utf-8", "replace")
    return headers, page, body


def responses_of(records: DataFrame) -> DataFrame:
    """Response rows of WARC records as ``read_warc`` gives them; other records are left out.

    Record id, target URI and date are those of the record; a payload digest that it
    lacks is made from the body as it was sent. ``page_id`` is null.
    """

    def build(batches) -> Iterator[dict]:
        for batch in batches:
            out: dict[str, list] = {field.split()[0]: [] for field in _RESPONSES.split(", ")}
            for pairs, block in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                told = {name.lower(): value for name, value in pairs}
                if told.get("warc-type") != "response":
                    continue
                headers, page, body = payload_of(block)
                values = (
                    None, told.get("warc-record-id", ""), told.get("warc-target-uri", ""),
                    told.get("warc-date", DATE), headers, page,
                    told.get("warc-payload-digest") or digest(body),
                )
                for name, value in zip(out, values, strict=True):
                    out[name].append(value)
            yield out

    return arrow_map(records.select("headers", "block"), build, _RESPONSES)


def response_records(found: DataFrame) -> DataFrame:
    """Response rows as the ``record`` text that ``write_warc`` writes."""

    def build(batches) -> Iterator[dict]:
        for batch in batches:
            records = []
            for name, uri, date, headers, payload, told in zip(
                *(c.to_pylist() for c in batch.columns), strict=True
            ):
                block = f"{headers or ''}\r\n{payload or ''}"
                head = [
                    ("WARC-Type", "response"), ("WARC-Record-ID", name or ""), ("WARC-Date", date or DATE),
                    ("WARC-Target-URI", uri or ""), ("WARC-Payload-Digest", told or ""),
                    ("Content-Type", "application/http; msgtype=response"),
                    ("Content-Length", str(len(block.encode()))),
                ]
                records.append(record_text(head, block))
            yield {"record": records}

    columns = ("record_id", "target_uri", "date", "http_headers", "payload", "payload_digest")
    return arrow_map(found.select(*columns), build, "record string")
