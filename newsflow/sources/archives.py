"""Archive manifests and the records of web archives."""

from __future__ import annotations

import gzip
import io
import re
import zlib
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession, functions as F

RECORD_SCHEMA = (
    "warc_path string, record_no bigint, rec_type string, url string, payload binary, payload_bytes bigint, read_error string"
)
_CHARSET = re.compile(rb"charset\s*=\s*[\"']?\s*([A-Za-z0-9_.:-]+)", re.I)
_META_CHARSET = re.compile(rb"<meta[^>]{0,500}?charset\s*=\s*[\"']?\s*([A-Za-z0-9_.:-]+)", re.I)
_HEAD_END = re.compile(rb"</head\s*>|<body[\s>]", re.I)
BAD_BODY = (OSError, EOFError, ValueError, zlib.error)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """``warc_path`` and ``month`` from (gzipped) text files with one path per line."""
    lines = spark.read.text(path).where(F.length("value") > 0)
    month = F.regexp_extract("value", r"crawl-data/CC-NEWS/(\d{4}/\d{2})/", 1)
    return lines.select(F.col("value").alias("warc_path"), F.coalesce(F.nullif(month, F.lit("")), F.lit("unknown")).alias("month"))


def filesystem_of(path: str):
    """File system and name of a path or URI (local, HDFS, S3, GCS)."""
    from pyarrow import fs

    if path.startswith("file:"):
        path = "/" + path[5:].lstrip("/")
    return fs.FileSystem.from_uri(path)


def _members(raw) -> Iterator[bytes]:
    """Inflated chunks of a file of concatenated gzip members."""
    inflater, inside = zlib.decompressobj(31), False
    while chunk := raw.read(1 << 20):
        while chunk:
            yield inflater.decompress(chunk, 8 << 20)
            inside = not inflater.eof
            if inside:
                chunk = inflater.unconsumed_tail
            else:
                chunk, inflater = inflater.unused_data, zlib.decompressobj(31)
    yield inflater.flush()
    if inside:
        raise EOFError("archive ends inside a gzip member")


class _Chunks(io.RawIOBase):
    def __init__(self, chunks: Iterator[bytes]):
        self._chunks, self._rest = chunks, b""

    def readable(self) -> bool:
        return True

    def readinto(self, buffer) -> int:
        while not self._rest:
            try:
                self._rest = next(self._chunks)
            except StopIteration:
                return 0
        size = min(len(buffer), len(self._rest))
        buffer[:size], self._rest = self._rest[:size], self._rest[size:]
        return size


def _headers(stream) -> dict[str, str]:
    found = {}
    while (line := stream.readline()).strip():
        name, _, value = line.decode("utf-8", "replace").partition(":")
        found[name.strip().lower()] = value.strip()
    return found


def _as_utf8(body: bytes, content_type: str) -> tuple[bytes, str | None]:
    """A text body in UTF-8, and where bytes of it mean nothing in its charset.

    The charset is the header's, else the one the page's head names, else UTF-8.
    """
    if content_type and not re.search("text|html|xml|json", content_type, re.I):
        return body, None
    named = _CHARSET.search(content_type.encode())
    if not named:
        end = _HEAD_END.search(body)
        named = _META_CHARSET.search(body, 0, end.start() if end else len(body))
    name = named[1].decode().lower() if named else "utf-8"
    if name in ("iso-8859-1", "latin1", "us-ascii", "ascii"):
        name = "cp1252"  # as browsers read them
    try:
        text = body.decode(name)
    except LookupError:
        return body, None
    except UnicodeDecodeError as found:
        # Binary bodies come without a type, too.
        problem = f"UnicodeDecodeError: {found.reason} at byte {found.start} of {name}" if content_type or named else None
        return (body if name in ("utf-8", "utf8") else body.decode(name, "replace").encode("utf-8", "replace")), problem
    return (body if name in ("utf-8", "utf8") else text.encode("utf-8", "replace")), None


def _http_body(block: bytes) -> tuple[bytes, str | None]:
    """Body of an HTTP response as its sender meant it, texts in UTF-8.

    A body that is not coded as declared stays as it is, with the problem.
    """
    stream = io.BytesIO(block)
    if not block.startswith(b"HTTP/"):
        return block, None
    stream.readline()
    headers = _headers(stream)
    raw = stream.read()
    problem = None
    try:
        body = _decoded(raw, headers)
    except BAD_BODY as found:
        body, problem = raw, f"{type(found).__name__}: {found}"
    body, unread = _as_utf8(body, headers.get("content-type", ""))
    return body, problem or unread


def _decoded(body: bytes, headers: dict[str, str]) -> bytes:
    """The body without transfer and content encodings."""
    if headers.get("transfer-encoding", "").lower() == "chunked":
        source, parts = io.BytesIO(body), []
        while size := int(source.readline().split(b";")[0].strip() or b"0", 16):
            parts.append(source.read(size))
            source.readline()
        body = b"".join(parts)
    coding = headers.get("content-encoding", "").lower()
    if coding in ("gzip", "x-gzip"):
        return gzip.decompress(body)
    if coding == "deflate":
        # With the zlib header, or without as some servers send it.
        return zlib.decompress(body, 15 if body[:1] == b"\x78" else -15)
    if coding not in ("", "identity"):
        raise ValueError(f"content encoding {coding} is not read")
    return body


def _skip(stream, size: int) -> int:
    """Read past ``size`` bytes without keeping them; how many there were."""
    left = size
    while left and (chunk := stream.read(min(left, 1 << 20))):
        left -= len(chunk)
    return size - left


def records(path: str, keeps_body: Callable[[str, str | None], bool]) -> Iterator[tuple[str, str | None, bytes | None, str | None]]:
    """Type, target URL, payload and decoding problem of each record; ``keeps_body`` says which have a payload."""
    filesystem, name = filesystem_of(path)
    with filesystem.open_input_stream(name, compression=None) as raw:
        stream = io.BufferedReader(_Chunks(_members(raw)), 1 << 20)
        while line := stream.readline():
            if not line.strip():
                continue
            if not line.startswith(b"WARC/"):
                raise ValueError("not a web archive record")
            headers = _headers(stream)
            size = int(headers.get("content-length", 0))
            kind = headers.get("warc-type", "")
            url = headers.get("warc-target-uri", "").strip("<>") or None
            kept = keeps_body(kind, url)
            block = stream.read(size) if kept else b""
            if (len(block) if kept else _skip(stream, size)) < size:
                raise EOFError("archive ends inside a record")
            yield kind, url, *(_http_body(block) if kept else (None, None))


def read_archives(
    manifest: DataFrame, root: str, denied: tuple[str, ...] = (), allowed: tuple[str, ...] = (), max_bytes: int | None = None
) -> DataFrame:
    """Records of the archives in ``manifest``, whose paths are relative to ``root``.

    A gzip file cannot be split, so an archive is one partition; it is
    streamed record by record and leaves the task in Arrow batches of bounded
    size. As with any file source, the driver knows the names of the files.
    Filters on ``warc_path, record_no, rec_type`` and ``url`` reach the reader;
    ``denied``, ``allowed`` and ``max_bytes`` name records whose payload is not
    needed (null; ``payload_bytes`` is that of the payload where it was read).
    """
    from newsflow.sources import archive_source

    paths = sorted(r["warc_path"] for r in manifest.select("warc_path").where("warc_path IS NOT NULL").distinct().toLocalIterator())
    return archive_source.load(manifest.sparkSession, paths, root, archive_source.BodyRules(tuple(denied), tuple(allowed), max_bytes))


def decode_payload(records: DataFrame) -> DataFrame:
    """Payload as text; bytes that are no UTF-8 become U+FFFD (``read_error`` names the first)."""
    return records.withColumn("html", F.make_valid_utf8(F.col("payload").cast("string")))
