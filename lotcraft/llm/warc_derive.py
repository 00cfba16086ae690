"""Metadata and plain-text records derived from WARC responses.

Every response record gives a `metadata` record (JSON: the source's WARC and HTTP headers,
title, metas and links) and a `conversion` record (the visible text). Both name the response in
WARC-Refers-To, carry its target, date, id in the source and payload digest, and have a block
digest of their own; the metadata record names the conversion in WARC-Concurrent-To. Records
are written as WARC/1.1, one gzip member each, the two of a response side by side.

Text: scripts, styles, templates and comments go, block elements end a line, blanks run
together, character references are resolved. Unclosed tags count as text.

Null payloads are empty and give records with empty text; a null target is left out of the
headers and read back as null. Equal rows are the same response: their records and ids are
equal. Other columns are not read. An empty table gives no file and an empty result. Ids and
digests depend on the content alone, and a task that is run again writes the same file.
"""

from __future__ import annotations

import hashlib
import html
import json
import re
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache
from urllib.parse import quote, urljoin, urlsplit

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotcraft.llm.files import put, store_of
from lotcraft.sources.staging import cut_lineage, new_folder

DATE = "2000-01-01T00:00:00Z"
FILE_BYTES = 32 << 20
_STEP_BYTES = 8 << 10
_NAMESPACE = uuid.UUID("8d3c0f9a-55b1-4f0e-9d57-2f6d4c1b7e10")

# Elements that end a line, and elements whose content is not text.
BLOCKS = frozenset((
    "address article aside blockquote body br caption center dd details div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 head header hr html legend li main nav ol option p pre section select summary table tbody "
    "td tfoot th thead title tr ul"
).split())
RAW = frozenset(("script", "style", "noscript", "template", "textarea", "svg"))
NOTED = RAW | {"title", "meta", "a", "link", "img"}  # elements of which more than a line's end is read

# A tag ends before the next "<": what looks like one and does not end is text.
_TAG = re.compile(
    r"<(?:!--.*?(?:-->|\Z)|[!?][^<>]*+>"
    r"|(/?)([a-zA-Z][^\s/<>]*+)([^<>\"']*+(?:(?:\"[^\"<]*+\"|'[^'<]*+')[^<>\"']*+)*+)>)", re.DOTALL)
_ATTRIBUTE = re.compile(r"(?<![^\s=/\"'>])([^\s=/\"'>]++)\s*+=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
_BLANKS = re.compile(r"[^\S\n ][^\S\n]*+| [^\S\n]++")  # a single space is left as it is
_ROOTED = re.compile(r"(?:/\w+)+")  # a path from the root without anything that needs resolving
_BASE32 = [a + b for a in "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567" for b in "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"]
_CONTROLS = re.compile(r"[\x00-\x1f\x7f]")


def digest(block: bytes) -> str:
    value = int.from_bytes(hashlib.sha1(block).digest())
    return "sha1:" + "".join([_BASE32[value >> at & 1023] for at in range(150, -1, -10)])


def _attributes(text: str) -> dict[str, str]:
    return {m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in reversed(list(_ATTRIBUTE.finditer(text)))}


def parsed(page: str) -> tuple[str, str | None, list[dict[str, str]], list[dict[str, str]]]:
    """(text, title, metas, links) of a page."""
    parts: list[str] = []
    metas: list[dict[str, str]] = []
    links: list[dict[str, str]] = []
    at, title, title_from = 0, None, -1
    lower = None
    while True:  # again behind an element whose content is not text
        for match in _TAG.finditer(page, at):
            start, end = match.span()
            if start > at:
                parts.append(page[at:start])
            at = end
            closing, name, inside = match.groups()
            if name is None:
                continue
            name = name.lower()
            raw = False
            if closing:
                if name == "title" and title is None and title_from >= 0:
                    title = " ".join(html.unescape("".join(parts[title_from:])).split())
            elif name not in NOTED:
                pass
            elif name in RAW:
                raw = True
                lower = lower if lower is not None else page.lower()
                end = lower.find("</" + name, at) if len(lower) == len(page) else page.find("</" + name, at)
                at = end if end >= 0 else len(page)
            elif name == "title":
                title_from = len(parts) + 1
            elif name == "meta":
                metas.append(_attributes(inside))
            else:
                target = _attributes(inside)
                found = target.get("src" if name == "img" else "href")
                if found:
                    links.append({"path": f"{name.upper()}@/{'src' if name == 'img' else 'href'}", "url": found})
            if name in BLOCKS:
                parts.append("\n")
            if raw:
                break
        else:
            break
    parts.append(page[at:])
    text = _BLANKS.sub(" ", html.unescape("".join(parts)))
    lines = [s for s in map(str.strip, text.split("\n")) if s]
    return "\n".join(lines), title, metas, links


@lru_cache(maxsize=64)
def _site(target: str) -> str | None:
    """Scheme and host of a web address, what a path from the root is put behind."""
    try:
        parts = urlsplit(target)
    except ValueError:
        return None
    return f"{parts.scheme}://{parts.netloc}" if parts.scheme in ("http", "https") and parts.netloc else None


def resolved(target: str, reference: str) -> str:
    """A reference of a page as an address; one that cannot be resolved stays as it is written."""
    if _ROOTED.fullmatch(reference) and (site := _site(target)):
        return site + reference
    try:
        return urljoin(target, reference)
    except ValueError:
        return reference


def _field(value: str) -> str:
    """A header value on one line."""
    return value if value.isprintable() else _CONTROLS.sub(lambda m: quote(m[0]), value)


def record(fields: list[tuple[str, str | None]], block: bytes) -> bytes:
    """One record without compression; fields without a value are left out."""
    head = ["WARC/1.1", *(f"{k}: {_field(v)}" for k, v in fields if v is not None), f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _member(data: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def _id(*parts: str) -> str:
    """A name-based id (UUID version 5) of the parts."""
    name = bytearray(hashlib.sha1(_NAMESPACE.bytes + chr(0).join(parts).encode()).digest()[:16])
    name[6], name[8] = name[6] & 0x0F | 0x50, name[8] & 0x3F | 0x80
    text = name.hex()
    return f"<urn:uuid:{text[:8]}-{text[8:12]}-{text[12:16]}-{text[16:20]}-{text[20:]}>"


def responses(pages: DataFrame, *, page_id: str = "page_id", url: str = "url", body: str = "html",
              date: str = DATE) -> DataFrame:
    """Response records of a table of pages: (source_id, target, date, http_header, payload)."""
    payload = F.coalesce(F.col(body).cast("string"), F.lit(""))
    header = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                      F.octet_length(payload).cast("string"), F.lit("\r\n\r\n"))
    return pages.select(F.col(page_id).cast("long").alias("source_id"), F.col(url).cast("string").alias("target"),
                        F.lit(date).alias("date"), header.alias("http_header"), payload.alias("payload"))


def derived(source_id: int | None, target: str | None, date: str, http_header: str, payload: str) -> list[bytes]:
    """The metadata and the conversion record of a response."""
    body = payload.encode()
    payload_digest = digest(body)
    source = "" if source_id is None else str(source_id)
    response = _id("response", source, target or "", date, http_header, payload_digest)
    text, title, metas, links = parsed(payload)
    if target:
        for link in links:
            link["url"] = resolved(target, link["url"])
    status, *lines = http_header.strip().split("\r\n")
    envelope = {
        "WARC-Header-Metadata": {
            "WARC-Type": "response", "WARC-Record-ID": response, "WARC-Target-URI": target, "WARC-Date": date,
            "WARC-Payload-Digest": payload_digest, "WARC-Block-Digest": digest(http_header.encode() + body),
            "Content-Type": "application/http; msgtype=response"},
        "Payload-Metadata": {"HTTP-Response-Metadata": {
            "Response-Message": status,
            "Headers": {k.strip(): v.strip() for k, _, v in (line.partition(":") for line in lines)},
            "HTML-Metadata": {"Head": {"Title": title, "Metas": metas}, "Links": links}}},
    }
    blocks = {"metadata": json.dumps({"Envelope": envelope}, ensure_ascii=False).encode(), "conversion": text.encode()}
    kinds = {"metadata": "application/json", "conversion": "text/plain; charset=utf-8"}
    ids = {kind: _id(kind, response) for kind in blocks}
    return [record([
        ("WARC-Type", kind), ("WARC-Record-ID", ids[kind]), ("WARC-Date", date), ("WARC-Target-URI", target),
        ("WARC-Refers-To", response),
        ("WARC-Concurrent-To", ids["conversion"] if kind == "metadata" else None),
        ("Content-Type", kinds[kind]), ("WARC-Block-Digest", digest(block)),
        ("X-Source-Payload-Digest", payload_digest), ("X-Source-Id", source or None),
    ], block) for kind, block in blocks.items()]


def write_derivatives(source: DataFrame, folder: str, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write the records of all responses to `folder`; returns (file, n_records, n_bytes)."""
    store, root = store_of(folder)
    store.create_dir(root, recursive=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target, place = store_of(folder)
        part, members, size, made = TaskContext.get().partitionId(), [], 0, 0

        def close() -> pa.RecordBatch:
            nonlocal members, size, made
            name = f"derived-{part:06d}-{made:06d}.warc.gz"
            put(target, f"{place}/{name}", members)
            row = pa.RecordBatch.from_arrays(
                [pa.array([name]), pa.array([2 * len(members)]), pa.array([size])], ["file", "n_records", "n_bytes"])
            members, size, made = [], 0, made + 1
            return row

        for batch in batches:
            for at in range(0, len(batch), 64):  # only so many pages as Python objects at a time
                columns = [c.to_pylist() for c in batch.slice(at, 64).columns]
                for row in zip(*columns, strict=True):
                    members.append(b"".join(map(_member, derived(*row))))
                    size += len(members[-1])
                    if size >= file_bytes:
                        yield close()
        if members:
            yield close()

    return source.mapInArrow(run, "file string, n_records long, n_bytes long")


def records(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(fields, block) of every record of a file, one gzip member each or plain."""
    at = 0
    while at < len(content):
        if content[at : at + 2] != b"\x1f\x8b":
            yield from _plain(content[at:])
            return
        reader, parts = zlib.decompressobj(31), []
        # In steps, as what a member leaves over of its last step is copied.
        while not reader.eof:
            step = content[at : at + _STEP_BYTES]
            if not step:
                raise ValueError("a WARC file ends within a record")
            parts.append(reader.decompress(step))
            at += len(step) - len(reader.unused_data)
        yield from _plain(b"".join(parts))


def _plain(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        version, *lines = data[at:end].decode().split("\r\n")
        if not version.startswith("WARC/"):
            raise ValueError("not a WARC record")
        fields = {k.strip(): v.strip() for k, _, v in (line.partition(":") for line in lines)}
        size = int(fields["Content-Length"])
        yield fields, data[end + 4 : end + 4 + size]
        at = end + 4 + size + 4


READ = (
    "source_id long, kind string, record_id string, refers_to string, concurrent_to string, target_uri string, "
    "date string, content_type string, content_length long, block_digest string, source_payload_digest string, "
    "digest_ok boolean, n_chars long, n_links long, title string"
)


def read_derivatives(spark: SparkSession, folder: str) -> DataFrame:
    """One row a record, from the files; `digest_ok`: the block has the digest its header names."""
    names = [f.split()[0] for f in READ.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                rows = []
                for fields, block in records(batch.column(0)[i].as_py()):
                    kind, own = fields["WARC-Type"], digest(block)
                    page = json.loads(block)["Envelope"]["Payload-Metadata"]["HTTP-Response-Metadata"][
                        "HTML-Metadata"] if kind == "metadata" else None
                    source = fields.get("X-Source-Id")
                    rows.append((
                        int(source) if source else None, kind, fields["WARC-Record-ID"], fields["WARC-Refers-To"],
                        fields.get("WARC-Concurrent-To"), fields.get("WARC-Target-URI"), fields["WARC-Date"],
                        fields["Content-Type"], len(block), own, fields["X-Source-Payload-Digest"],
                        own == fields["WARC-Block-Digest"], len(block.decode()),
                        len(page["Links"]) if page else None, page["Head"]["Title"] if page else None))
                if rows:
                    types = [pa.int64(), *[pa.string()] * 7, pa.int64(), pa.string(), pa.string(), pa.bool_(),
                             pa.int64(), pa.int64(), pa.string()]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.gz").load(folder)
    return files.select("content").mapInArrow(run, READ)


def build(pages: DataFrame, *, folder: str | None = None, **settings) -> DataFrame:
    """Write the derivatives of a table of pages and read them back."""
    spark = pages.sparkSession
    folder = folder or new_folder(spark, "derived")
    cut_lineage(write_derivatives(responses(pages, **settings), folder), "derived-files")
    return read_derivatives(spark, folder)
