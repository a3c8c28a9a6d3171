"""Web archives as a data source of Spark's: an archive is a partition, and refused records ship no body.

Filters on the columns of a record's header are taken over from the plan: an
archive that ``warc_path`` rules out is not opened, and a record that the others
rule out is passed over without being decoded. Rules for urls and sizes come as
options: a record they refuse stays a row, for the counters, but has no payload.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from typing import Any

import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql import datasource as ds

from newsflow.sources import archives

NAME = "news_archives"
#: Columns known before a record's body is read.
HEADER = ("warc_path", "record_no", "rec_type", "url")
_SCHEMA = pa.schema(
    [
        ("warc_path", pa.string()),
        ("record_no", pa.int64()),
        ("rec_type", pa.string()),
        ("url", pa.string()),
        ("payload", pa.binary()),
        ("payload_bytes", pa.int64()),
        ("read_error", pa.string()),
    ]
)
_BATCH_BYTES = 16 << 20
_AUTHORITY = re.compile(r"(?:[a-z][a-z0-9+.-]*:)?//([^/?#]*)", re.I | re.A)

_COMPARED: dict[type, Callable[[Any, Any], bool]] = {
    ds.EqualTo: lambda x, y: x == y,
    ds.GreaterThan: lambda x, y: x > y,
    ds.GreaterThanOrEqual: lambda x, y: x >= y,
    ds.LessThan: lambda x, y: x < y,
    ds.LessThanOrEqual: lambda x, y: x <= y,
    ds.In: lambda x, y: x in y,
    ds.StringStartsWith: lambda x, y: x.startswith(y),
    ds.StringEndsWith: lambda x, y: x.endswith(y),
    ds.StringContains: lambda x, y: y in x,
}


def understood(given: ds.Filter) -> bool:
    """Can a filter be decided by a record's header?"""
    if isinstance(given, ds.Not):
        return understood(given.child)
    return isinstance(given, (*_COMPARED, ds.IsNull, ds.IsNotNull)) and given.attribute in {(c,) for c in HEADER}


def column_of(given: ds.Filter) -> str:
    return column_of(given.child) if isinstance(given, ds.Not) else given.attribute[0]


def decided(given: ds.Filter, header: dict[str, Any]) -> bool | None:
    """Truth of an understood filter; None where it compares with null."""
    if isinstance(given, ds.Not):
        inner = decided(given.child, header)
        return None if inner is None else not inner
    value = header[given.attribute[0]]
    if isinstance(given, (ds.IsNull, ds.IsNotNull)):
        return (value is None) == isinstance(given, ds.IsNull)
    return None if value is None else _COMPARED[type(given)](value, given.value)


@dataclass(frozen=True)
class BodyRules:
    """Which records keep their payload: refused are urls that hold a ``denied`` part or whose authority holds
    none of ``allowed`` (if there are any), and payloads beyond ``max_bytes``.

    The job's own checks decide; this only spares work. So a url that is not
    plain ASCII, where engines differ in case folding, is never refused here.
    """

    denied: tuple[str, ...] = ()
    allowed: tuple[str, ...] = ()
    max_bytes: int | None = None

    def refuse(self, url: str | None) -> bool:
        if not url or not url.isascii():
            return not url
        authority = _AUTHORITY.match(url)
        host = authority[1].lower() if authority else ""
        return any(part in url for part in self.denied) or bool(self.allowed) and not any(a in host for a in self.allowed)


@dataclass
class ArchivePartition(ds.InputPartition):
    warc_path: str


class Archives(ds.DataSource):
    """Options: ``root``, ``paths`` (JSON list, relative to the root), ``denied`` and ``allowed`` (JSON lists), ``max_bytes``."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return archives.RECORD_SCHEMA

    def reader(self, schema) -> ArchiveReader:
        return ArchiveReader(dict(self.options))


class ArchiveReader(ds.DataSourceReader):
    def __init__(self, options: dict[str, str]) -> None:
        listed = lambda name: tuple(json.loads(options.get(name) or "[]"))
        self.root, self.paths = options["root"].rstrip("/"), listed("paths")
        most = options.get("max_bytes")
        self.rules = BodyRules(listed("denied"), listed("allowed"), int(most) if most else None)
        self.filters: list[ds.Filter] = []

    def pushFilters(self, filters: list[ds.Filter]) -> Iterable[ds.Filter]:
        for given in filters:
            if understood(given):
                self.filters.append(given)
            else:
                yield given

    def _wanted(self, header: dict[str, Any], columns: tuple[str, ...] = HEADER) -> bool:
        return all(decided(f, header) for f in self.filters if column_of(f) in columns)

    def partitions(self) -> list[ArchivePartition]:
        return [ArchivePartition(p) for p in self.paths if self._wanted({"warc_path": p}, ("warc_path",))]

    def read(self, partition: ArchivePartition | None) -> Iterator[pa.RecordBatch]:
        if partition is None:  # what Spark asks for where there are no archives
            return
        path, number = partition.warc_path, -1
        rows: list[tuple] = []
        size = 0

        def flush() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _SCHEMA)], schema=_SCHEMA)

        def keeps_body(kind: str, url: str | None) -> bool:
            header = {"warc_path": path, "record_no": number + 1, "rec_type": kind, "url": url}
            return kind == "response" and not self.rules.refuse(url) and self._wanted(header)

        try:
            for number, (kind, url, payload, problem) in enumerate(archives.records(f"{self.root}/{path}", keeps_body)):
                if not self._wanted({"warc_path": path, "record_no": number, "rec_type": kind, "url": url}):
                    continue
                length = None if payload is None else len(payload)
                if length is not None and self.rules.max_bytes is not None and length > self.rules.max_bytes:
                    payload = None
                rows.append((path, number, kind, url, payload, length, problem))
                size += len(payload or b"") + 200
                if size >= _BATCH_BYTES:
                    yield flush()
                    rows, size = [], 0
        except archives.BAD_BODY as found:
            # One bad archive is a row of its own, not the end of the job.
            if self._wanted({"warc_path": path, "record_no": number + 1, "rec_type": "error", "url": None}):
                rows.append((path, number + 1, "error", None, None, None, f"{type(found).__name__}: {found}"))
        if rows:
            yield flush()


def load(spark: SparkSession, paths: list[str], root: str, rules: BodyRules):
    """Records of the archives named."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(Archives)
    reader = spark.read.format(NAME).option("root", root).option("paths", json.dumps(paths))
    reader = reader.option("denied", json.dumps(rules.denied)).option("allowed", json.dumps(rules.allowed))
    if rules.max_bytes is not None:
        reader = reader.option("max_bytes", rules.max_bytes)
    return reader.load()
