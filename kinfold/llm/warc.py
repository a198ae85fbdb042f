"""WARC derivatives: a linked metadata record and a plain-text conversion record for every response.

`responses` shows page rows as response records; `derivatives` turns responses into two records each;
`write_warc` and `read_warc` are the file form (WARC/1.1).  A derivative names its source through
WARC-Refers-To, -Refers-To-Target-URI and -Refers-To-Date, and carries the source's payload digest;
the metadata block keeps the source's HTTP headers, its digests and the page's title and links.
Record ids are name-based, so a task that runs twice gives the same records.

A response whose payload is null has an empty payload; a null URI becomes an empty header value; an
empty table gives no records; repeated rows give repeated records; extra columns are ignored.  Pages are read
in linear time; a title element without its end is no title.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import html
import io
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import chunks
from .markup import attributes, tokens

DATE = "2024-01-01T00:00:00Z"
VERSION = "WARC/1.1"
RECORD = ("page_id long, warc_type string, record_id string, refers_to string, target_uri string, warc_date string, "
          "content_type string, block_digest string, payload_digest string, content_length long, "
          "header string, block string")
RESPONSE = "page_id long, record_id string, target_uri string, warc_date string, http_headers string, payload string"

# Element names of HTML.
DROPPED = frozenset("noscript script style template".split())
LINES = frozenset("address article aside blockquote body br dd div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html "
                  "li main nav ol option p pre section table td th title tr ul".split())
_TITLE_END = re.compile(r"</title\s*+>", re.I)
_LINE = re.compile(r"[^\n]+")


def read_page(page: str) -> tuple[str, str | None, list[str]]:
    """Visible text (one line per block, white space of a line as one space), the title (None without one) and the links' targets."""
    pieces, links = [], []
    title = None
    titled, at = False, 0
    for m in tokens(page, DROPPED):
        pieces.append(page[at : m.start].replace("\n", " "))
        at = m.end
        if m.skipped:
            pieces.append(" ")
        elif m.tag in LINES:
            pieces.append("\n")
        if m.closing:
            continue
        if m.tag == "a":
            links += [_value(html.unescape(v)) for name, v in attributes(m.attributes) if name == "href"][:1]
        elif m.tag == "title" and not titled:
            titled, end = True, _TITLE_END.search(page, m.end)
            title = _value(html.unescape(page[m.end : end.start()])) if end else None
    pieces.append(page[at:].replace("\n", " "))
    lines = (" ".join(html.unescape(m.group()).split()) for m in _LINE.finditer("".join(pieces)))
    return "\n".join(x for x in lines if x), title, links


def digest(block: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode()


def _value(text: str | None) -> str:
    return " ".join((text or "").split())


def _record(kind: str, source: tuple, content_type: str, block: str, payload_digest: str) -> tuple:
    page, record_id, uri, date, _, _ = source
    data = block.encode()
    own = f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{kind} {record_id}')}>"
    fields = {
        "WARC-Type": kind, "WARC-Record-ID": own, "WARC-Date": _value(date), "WARC-Target-URI": _value(uri),
        "WARC-Refers-To": _value(record_id), "WARC-Refers-To-Target-URI": _value(uri), "WARC-Refers-To-Date": _value(date),
        "WARC-Source-Payload-Digest": payload_digest, "WARC-Block-Digest": digest(data),
        "Content-Type": content_type, "Content-Length": str(len(data)),
    }
    header = VERSION + "\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields.items())
    return (page, kind, own, record_id, uri, date, content_type, fields["WARC-Block-Digest"], payload_digest, len(data), header, block)


def derive(source: tuple) -> list[tuple]:
    """The metadata and the conversion record of one response (RESPONSE's columns)."""
    _, _, _, _, headers, payload = source
    payload, headers = payload or "", headers or ""
    payload_digest = digest(payload.encode())
    text, title, links = read_page(payload)
    fields = [("source-payload-digest", payload_digest), ("source-block-digest", digest((headers + payload).encode()))]
    fields += [("source-http", _value(x)) for x in headers.split("\r\n") if x.strip()]
    fields += [("title", title)] if title is not None else []
    fields += [("outlink", x) for x in links]
    block = "".join(f"{k}: {v}\r\n" for k, v in fields)
    return [_record("metadata", source, "application/warc-fields", block, payload_digest),
            _record("conversion", source, "text/plain; charset=utf-8", text, payload_digest)]


def _arrow(ddl: str) -> pa.Schema:
    return pa.schema([(c.split()[0], pa.int64() if c.endswith("long") else pa.string()) for c in ddl.split(", ")])


def _derive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = _arrow(RECORD)
    for part, _ in chunks(batches):  # by the payload, the last column
        out = [r for row in zip(*(c.to_pylist() for c in part.columns), strict=True) for r in derive(row)]
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)


def responses(pages: DataFrame, page_id: str = "page_id", url: str = "url", page: str = "html", date: str = DATE) -> DataFrame:
    """Page rows as response records: a name-based id, the fetch date and the HTTP headers."""
    name = F.md5(F.concat_ws("\n", F.col(page_id).cast("string"), F.col(url), F.md5(F.coalesce(F.col(page), F.lit("")))))
    cut = [F.substring(name, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    length = F.octet_length(F.coalesce(F.col(page), F.lit("")))
    headers = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), length.cast("string"), F.lit("\r\n\r\n"))
    return pages.select(
        F.col(page_id).cast("long").alias("page_id"), F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cut), F.lit(">")).alias("record_id"),
        F.col(url).alias("target_uri"), F.lit(date).alias("warc_date"), headers.alias("http_headers"), F.col(page).alias("payload"))


def derivatives(source: DataFrame) -> DataFrame:
    """Two rows (RECORD) for each response row (RESPONSE)."""
    columns = [c.split()[0] for c in RESPONSE.split(", ")]
    return source.select(*columns[:-1], F.coalesce("payload", F.lit("")).alias("payload")).mapInArrow(_derive, RECORD)


def write_warc(records: DataFrame, path: str, records_per_file: int = 50_000) -> None:
    """Records as WARC files: header, empty line, block, and the record's end of two line breaks."""
    text = records.select(F.concat("header", F.lit("\r\n"), "block").alias("value"))
    text.write.option("lineSep", "\r\n\r\n").option("maxRecordsPerFile", records_per_file).text(path)


def unpacked(data: bytes) -> bytes:
    """The bytes of a file, its gzip members (commonly one for each record) put one after the other."""
    if not data.startswith(b"\x1f\x8b"):
        return data
    try:
        with gzip.GzipFile(fileobj=io.BytesIO(data)) as members:
            return members.read()
    except EOFError as e:
        raise ValueError("a WARC file's last gzip member is cut short") from e


def parse_warc(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields, block) of every record; lengths are taken from Content-Length.  A file that is cut short or no WARC file fails."""
    at = 0
    while at < len(data):
        end = data.find(b"\r\n\r\n", at)
        first, *lines = data[at:end].decode("utf-8", "replace").split("\r\n") if end >= 0 else [""]
        if not first.startswith("WARC/"):
            raise ValueError(f"no WARC record at byte {at}")
        fields = {name.strip(): value.strip() for name, _, value in (x.partition(":") for x in lines)}
        size = int({k.lower(): v for k, v in fields.items()}["content-length"])
        if end + 4 + size > len(data):
            raise ValueError(f"the WARC record at byte {at} is cut short")
        yield fields, data[end + 4 : end + 4 + size]
        at = end + 4 + size
        while data.startswith(b"\r\n", at):
            at += 2


def read_warc(spark: SparkSession, path: str, files: str = "part-*") -> DataFrame:
    """(fields map, block binary) of the records of all files whose names match `files`; plain or gzip, each of at most 2 GB."""
    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.map_(pa.string(), pa.string())
        for batch in batches:
            for data in batch.column(0):
                found = list(parse_warc(unpacked(data.as_py())))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([list(f.items()) for f, _ in found], kind), pa.array([b for _, b in found], pa.binary())], ["fields", "block"])

    content = spark.read.format("binaryFile").option("pathGlobFilter", files).load(path)
    return content.select("content").mapInArrow(parse, "fields map<string,string>, block binary")
