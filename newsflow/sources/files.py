"""Scans of landed article files: JSON lines, CSV and parquet, mixed in one tree."""

from __future__ import annotations

import csv
import io
import json
import re

import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from newsflow import schemas
from newsflow.functions.text import half_even

_SUFFIXES = ("csv", "jsonl", "parquet")

READ_ORDER = ["source_file", "source_block", "source_row"]


def read_order() -> list[Column]:
    """The order rows have in their files, whatever tasks read them."""
    return [F.col(c).asc() for c in READ_ORDER]


def with_read_order(df: DataFrame) -> DataFrame:
    """Add file, block and row position.

    Within a block the ids grow line by line; the file and the block come
    first in the order, so it does not matter which task reads a block.
    """
    return df.select(
        "*",
        F.col("_metadata.file_path").alias("source_file"),
        F.col("_metadata.file_block_start").alias("source_block"),
        F.monotonically_increasing_id().alias("source_row"),
    )


def file_listing(spark: SparkSession, root: str) -> DataFrame:
    """``path, suffix, bytes, modified`` of every file below ``root``; contents stay unread.

    Spark names JSON lines ``.json``; they count as ``jsonl``.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    return files.select(
        "path",
        F.regexp_replace(F.lower(F.regexp_extract("path", r"\.([^./]+)$", 1)), "^json$", "jsonl").alias("suffix"),
        F.col("length").alias("bytes"),
        F.col("modificationTime").alias("modified"),
    )


def scan_jsonl(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """JSON lines with the given columns as text. No inference pass; absent ones are null."""
    return with_read_order(_scan_jsonl(spark, path, columns))


def _scan_jsonl(spark: SparkSession, root: str, columns: list[str] | None) -> DataFrame:
    reader = spark.read.options(recursiveFileLookup=True, pathGlobFilter="*.[jJ][sS][oO][nN]{,[lL]}")
    return (reader.schema(schemas.text_schema(columns)) if columns else reader).json(root)


def _csv_columns(header: list[str]) -> list[str]:
    """Column names of a header; empty and repeated ones are told apart by their place."""
    lowered = [h.lower() for h in header]
    return [f"{h or '_c'}{i}" if not h or lowered.count(h.lower()) > 1 else h for i, h in enumerate(header)]


def _scan_alike(spark: SparkSession, paths: list[str], suffix: str, head: str) -> DataFrame:
    """CSV files of one header, or parquet files of one schema."""
    literal = [re.sub(r"([\[\]{}*?\\])", r"\\\1", p) for p in paths]
    reader = spark.read.option("recursiveFileLookup", True)
    if suffix == "csv":
        # All values are text. Quoted values may hold line feeds, so a file is one task.
        reader = reader.schema(schemas.text_schema(_csv_columns(json.loads(head))))
        return reader.options(header=True, mode="DROPMALFORMED", multiLine=True, escape='"').csv(literal)
    return reader.parquet(*literal)


def _file_head(path: str, suffix: str) -> str:
    """What files must share to be read together: column names (CSV) or schema (parquet)."""
    from newsflow.sources.archives import filesystem_of

    filesystem, name = filesystem_of(path)
    if suffix == "csv":
        with filesystem.open_input_stream(name) as stream:
            lines = io.TextIOWrapper(stream, "utf-8-sig", errors="replace", newline="")
            return json.dumps(next((row for row in csv.reader(lines) if row), []))
    with filesystem.open_input_file(name) as file:
        return pq.read_schema(file).remove_metadata().to_string()


def _alike(files: DataFrame) -> list[tuple[str, str, list[str]]]:
    """Suffix, head and paths of the files that can be read together; JSON lines need no paths.

    Headers and footers are read inside the tasks. Paths come to the driver,
    where Spark keeps the list of files of every scan anyway.
    """

    def heads(batches):
        for batch in batches:
            text = batch["suffix"] == "jsonl"
            batch["head"] = ["" if t else _file_head(p, s) for t, p, s in zip(text, batch["path"], batch["suffix"])]
            batch.loc[text, "path"] = None
            yield batch

    found = files.select("suffix", "path").mapInPandas(heads, "suffix string, path string, head string")
    groups = found.groupBy("suffix", "head").agg(F.sort_array(F.collect_list("path")).alias("paths"))
    return [(r["suffix"], r["head"], r["paths"]) for r in groups.orderBy("suffix", "head").collect()]


def scan_tree(spark: SparkSession, root: str, columns: list[str] | None = None) -> DataFrame:
    """All rows of the CSV, JSON-lines and parquet files below ``root``, united by name.

    CSV files may differ in their headers and parquet files in their types:
    files that agree are one scan. Empty files are skipped and malformed CSV
    rows dropped. With ``columns`` those are returned as text and no file is
    read to infer its types; without, types are inferred and columns of mixed
    type become text. The lineage columns of ``READ_ORDER`` are added. An
    empty tree gives no rows.
    """
    files = file_listing(spark, root).where(F.col("suffix").isin(*_SUFFIXES) & (F.col("bytes") > 0))
    parts = []
    for suffix, head, paths in _alike(files):
        scan = _scan_jsonl(spark, root, columns) if suffix == "jsonl" else _scan_alike(spark, paths, suffix, head)
        part = with_read_order(scan)
        if columns:
            present = set(part.columns)
            part = part.select(
                *[(F.col(c) if c in present else F.lit(None)).cast("string").alias(c) for c in columns], *READ_ORDER
            )
        parts.append(part)
    if not parts:
        fields = ", ".join(f"{c} string" for c in columns or [])
        order = "source_file string, source_block bigint, source_row bigint"
        return spark.createDataFrame([], f"{fields}, {order}" if fields else order)
    return union_relaxed(parts)


def union_relaxed(parts: list[DataFrame]) -> DataFrame:
    """Union by name with nulls for absent columns. A column of mixed type becomes text."""
    types: dict[str, set[str]] = {}
    for part in parts:
        for field in part.schema.fields:
            types.setdefault(field.name, set()).add(field.dataType.simpleString())
    numeric = {"tinyint", "smallint", "int", "bigint", "float", "double"}
    mixed = {c: ("double" if t <= numeric else "string") for c, t in types.items() if len(t) > 1}
    whole = {"tinyint", "smallint", "int", "bigint"}
    mixed = {c: ("bigint" if types[c] <= whole else t) for c, t in mixed.items()}
    aligned = [
        part.select(*[F.col(c).cast(mixed[c]).alias(c) if c in mixed else F.col(c) for c in part.columns])
        for part in parts
    ]
    out = aligned[0]
    for part in aligned[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out


def month_of_path(path: Column) -> Column:
    """``yyyy/MM`` of a file below ``yyyy/MM/`` or ``year=yyyy/month=MM/``."""
    year = F.regexp_extract(path, r"/(?:year=)?(\d{4})/(?:month=)?\d{2}/", 1)
    month = F.regexp_extract(path, r"/(?:year=)?\d{4}/(?:month=)?(\d{2})/", 1)
    return F.when(year != "", F.concat_ws("/", year, month))


def file_metrics(files: DataFrame) -> DataFrame:
    """Files, bytes and megabytes per month of a listing."""
    return (
        files.groupBy(month_of_path(F.col("path")).alias("month"))
        .agg(F.count("*").alias("files_found"), F.sum("bytes").alias("bytes_found"))
        .withColumn("volume_mb", half_even(F.col("bytes_found") / (1024.0 * 1024.0)))
    )


def expired_files(files: DataFrame, days: int, now: Column | None = None) -> DataFrame:
    """Files last changed more than ``days`` before ``now``."""
    now = F.current_timestamp() if now is None else now
    return files.where(F.col("modified") < now - F.make_dt_interval(days=F.lit(days)))


def delete_files(files: DataFrame) -> DataFrame:
    """Delete the files of a listing inside the tasks; one row with their number.

    A file that is gone already is not an error, so a retried task is safe.
    """
    from newsflow.sources.archives import filesystem_of

    def delete(batches):
        import pandas as pd

        for batch in batches:
            deleted = 0
            for path in batch["path"]:
                filesystem, name = filesystem_of(path)
                try:
                    filesystem.delete_file(name)
                    deleted += 1
                except FileNotFoundError:
                    pass
            yield pd.DataFrame({"deleted": [deleted]})

    return files.select("path").mapInPandas(delete, "deleted bigint").agg(
        F.coalesce(F.sum("deleted"), F.lit(0)).alias("deleted")
    )


def query(spark: SparkSession, sql: str, params: list | dict | None = None) -> DataFrame:
    """Run a statement with parameters; one without result gives an empty frame."""
    return spark.sql(sql, args=params) if params else spark.sql(sql)
