"""Stored tables in parts, of which a merge rewrites only those it touches.

A table keyed by id is laid out by a hash of the id, one of articles by day.
The new state of the touched parts is written to the shared folder first, then
takes their place; all other files stay where they are, under their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from newsflow import schemas
from newsflow.functions.vectors import shard_of
from newsflow.operators.dedup import first_per_key
from newsflow.operators.merge import absent_rows
from newsflow.session import work_dir
from newsflow.sources.tables import table_exists

PART = "part"
#: Parts of a table keyed by id.
PARTS = 256
#: The part of rows without a day.
NO_DAY = "none"


def hash_part(key: Column, parts: int = PARTS) -> Column:
    """Part of an id; the same in any engine."""
    return F.lpad(shard_of(key, parts).cast("string"), 6, "0")


def day_part(day: Column) -> Column:
    return F.coalesce(day.cast("date").cast("string"), F.lit(NO_DAY))


def _with_part(schema: StructType) -> StructType:
    return StructType([*schema.fields, StructField(PART, StringType())])


def _write(df: DataFrame, path: str, mode: str) -> None:
    writer = df.hint("rebalance", PART).write.partitionBy(PART).mode(mode)
    writer.option("partitionOverwriteMode", "dynamic").parquet(path)


def create_store(df: DataFrame, path: str, schema: StructType, part: Column) -> None:
    """Write a new table; fails where there is one."""
    placed = schemas.align(df, schema).withColumn(PART, part)
    _write(placed, path, "errorifexists")


def _parts(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    if not table_exists(spark, path):
        return spark.createDataFrame([], _with_part(schema))
    return spark.read.schema(_with_part(schema)).parquet(path)


def read_store(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The whole table; empty where nothing has been written yet."""
    return _parts(spark, path, schema).drop(PART)


def _replace_parts(state: DataFrame, path: str, schema: StructType) -> None:
    """Put ``state`` (with its part) in the place of all its parts."""
    staged = work_dir(state.sparkSession, "parts")
    _write(state, staged, "errorifexists")
    _write(state.sparkSession.read.schema(_with_part(schema)).parquet(staged), path, "overwrite")


def upsert_parts(
    batch: DataFrame, path: str, order: list[Column], key: str, schema: StructType, parts: int = PARTS
) -> list[str]:
    """Store the first row of the batch per key, in the place of a stored one; names the parts rewritten.

    Parts that hold no key of the batch are neither read nor written. Their
    names are all that reaches the driver.
    """
    spark = batch.sparkSession
    newest = schemas.align(first_per_key(batch, [key], order), schema).withColumn(PART, hash_part(F.col(key), parts))
    offered = work_dir(spark, "batch")
    _write(newest, offered, "errorifexists")
    newest = spark.read.schema(_with_part(schema)).parquet(offered)
    touched = sorted(r[PART] for r in newest.select(PART).distinct().collect())
    if touched:
        stored = _parts(spark, path, schema).where(F.col(PART).isin(*touched))
        _replace_parts(absent_rows(stored, newest, key).unionByName(newest), path, schema)
    return touched


def update_parts(
    spark: SparkSession, path: str, schema: StructType, due: Column, changes: dict[str, Column]
) -> list[str]:
    """Change columns of the rows that are ``due``, in their parts only; names the parts rewritten.

    ``due`` may name the part, and then prunes what is read. Changes must leave
    rows in their parts.
    """
    rows = _parts(spark, path, schema)
    touched = sorted(r[PART] for r in rows.where(due).select(PART).distinct().collect())
    if touched:
        changed = {c: F.when(due, new).otherwise(F.col(c)).alias(c) for c, new in changes.items()}
        state = rows.where(F.col(PART).isin(*touched)).select(*(changed.get(c, F.col(c)) for c in rows.columns))
        _replace_parts(state, path, schema)
    return touched
