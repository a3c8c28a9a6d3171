"""Fixed table schemas and the statements that create them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import (
    ArrayType,
    DateType,
    FloatType,
    IntegerType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def _text(name: str, required: bool = False) -> StructField:
    return StructField(name, StringType(), not required)


ARTICLES = StructType(
    [
        _text("article_id", True),
        _text("text_hash", True),
        _text("source_type", True),
        _text("source_warc"),
        _text("domain"),
        _text("title"),
        _text("url", True),
        StructField("datetime", TimestampType()),
        StructField("date", DateType()),
        _text("author"),
        _text("lang"),
        _text("text", True),
    ]
)

EMBEDDINGS = StructType(
    [
        _text("article_id", True),
        StructField("text_embedding", ArrayType(FloatType())),
        _text("model_name", True),
        StructField("updated_at", TimestampType(), False),
    ]
)

ARCHIVE_LEDGER = StructType(
    [
        _text("warc_path", True),
        _text("month", True),
        _text("status", True),
        StructField("rows_written", IntegerType(), False),
        StructField("rows_inserted", IntegerType(), False),
        _text("error_text"),
        StructField("updated_at", TimestampType(), False),
    ]
)

MONTH_LEDGER = StructType(
    [
        _text("month", True),
        StructField("total_warcs", IntegerType(), False),
        StructField("done_warcs", IntegerType(), False),
        StructField("failed_warcs", IntegerType(), False),
        StructField("updated_at", TimestampType(), False),
    ]
)

LEGACY_ARTICLES = StructType(
    [
        _text("id", True),
        _text("source", True),
        _text("title", True),
        _text("url", True),
        StructField("published_at", TimestampType()),
        StructField("collected_at", TimestampType(), False),
        _text("origin", True),
        _text("language"),
        _text("hash", True),
        StructField("embedding", ArrayType(FloatType())),
    ]
)

TABLES = {
    "news_articles": ARTICLES,
    "news_embeddings": EMBEDDINGS,
    "archive_ledger": ARCHIVE_LEDGER,
    "month_ledger": MONTH_LEDGER,
    "legacy_articles": LEGACY_ARTICLES,
}

# Columns a landed article line may carry; all are read as text and cast later.
LANDED_ARTICLE_COLUMNS = ["url", "domain", "title", "datetime", "date", "author", "lang", "text"]

# The states an archive may be in, and the origins of legacy rows.
ARCHIVE_STATES = ["running", "done", "failed"]
LEGACY_ORIGINS = ["rss", "gdelt"]


def text_schema(columns: list[str]) -> StructType:
    return StructType([_text(c) for c in columns])


def align(df: DataFrame, schema: StructType) -> DataFrame:
    """Project to ``schema``; a column the data does not have yet becomes null."""
    present = set(df.columns)
    return df.select(
        *[
            (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def create_tables(spark: SparkSession, database: str) -> None:
    """Create the database and its tables where they do not exist yet."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for name, schema in TABLES.items():
        columns = ", ".join(
            f"`{f.name}` {f.dataType.simpleString()}{'' if f.nullable else ' NOT NULL'}" for f in schema.fields
        )
        spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{name} ({columns}) USING parquet")


def add_missing_columns(spark: SparkSession, table: str, schema: StructType) -> list[str]:
    """Additive schema change: add the columns ``table`` lacks and name them."""
    present = set(spark.table(table).columns)
    missing = [f for f in schema.fields if f.name not in present]
    if missing:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in missing)
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({columns})")
    return [f.name for f in missing]


def broken_rows(
    df: DataFrame, schema: StructType, key: str | None = None, allowed: dict[str, list[str]] | None = None
) -> DataFrame:
    """Rows that break a NOT NULL column of ``schema``, a list of ``allowed`` values, or repeat ``key``."""
    required = [f.name for f in schema.fields if not f.nullable and f.name in df.columns]
    nulls = F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in required]))
    bad = df.select(F.lit("null").alias("problem"), F.explode(nulls).alias("detail"))
    for column, values in (allowed or {}).items():
        other = df.where(~F.col(column).isin(*values))
        bad = bad.unionAll(other.select(F.lit("value not allowed"), F.col(column).cast("string")))
    if key:
        repeated = df.groupBy(key).count().where("count > 1")
        bad = bad.unionAll(repeated.select(F.lit("duplicate key"), F.col(key).cast("string")))
    return bad
