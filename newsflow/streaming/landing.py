"""Landed feed lines as a stream into the article table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType, TimestampType

from newsflow import schemas
from newsflow.functions.dates import lenient_timestamp
from newsflow.functions.text import sha256_hex
from newsflow.operators import unify
from newsflow.operators.merge import stored_rows
from newsflow.sources import tables
from newsflow.sources.files import READ_ORDER, read_order


def landed_lines(spark: SparkSession, landing: str, max_files: int | None = None) -> DataFrame:
    """Stream of landed JSON lines with the file they came from."""
    reader = (
        spark.readStream.schema(schemas.text_schema([*schemas.LANDED_ARTICLE_COLUMNS, "collected_at"]))
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.json*")
    )
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    lines = reader.json(landing)
    return lines.withColumn("source_file", F.col("_metadata.file_path")).withColumn("source_block", F.col("_metadata.file_block_start"))


def first_seen_links(lines: DataFrame, keep: str | None = None) -> DataFrame:
    """Lines without repeats of a link, however late they come.

    The state holds one id per link for good. With ``keep`` it forgets links
    older than that, and lines that come later than that are lost, seen or not.
    """
    if keep is None:
        return lines.withColumn("article_id", sha256_hex(F.col("url"))).dropDuplicates(["article_id"])
    timed = lines.withColumn("collected_ts", lenient_timestamp(F.col("collected_at")))
    keyed = timed.withColumn("article_id", sha256_hex(F.col("url")))
    return keyed.withWatermark("collected_ts", keep).dropDuplicatesWithinWatermark(["article_id"])


def load_stream(
    lines: DataFrame, articles: str, checkpoint: str, after_batch: Callable[[DataFrame], None] | None = None
) -> StreamingQuery:
    """Merge all files landed since the last run, then stop.

    The merge is keyed by article, so a batch that is replayed after a crash
    adds nothing. The first line of an article counts, by file and place in it,
    whatever tasks read it. ``after_batch`` is handed the stored articles that
    the batch brought or repeated, for instance to embed them.
    """

    def merge(batch: DataFrame, batch_id: int) -> None:
        numbered = batch.withColumn("source_row", F.monotonically_increasing_id())
        rows = unify.feed_articles(numbered, extra=READ_ORDER)
        tables.append_if_absent(rows, articles, read_order())
        if after_batch is not None:
            stored = tables.read_table(batch.sparkSession, articles, schemas.ARTICLES)
            after_batch(stored_rows(stored, rows))

    return (
        lines.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


MONTH_COUNTS = StructType([StructField("month", TimestampType()), StructField("articles", LongType())])


def month_counts_stream(lines: DataFrame, sink: str, checkpoint: str, keep: int = 2) -> StreamingQuery:
    """Keep article counts per month current; each trigger publishes one snapshot with all months.

    A snapshot has a row per month, however many triggers there were; the last ``keep`` are left.
    """
    month = F.date_trunc("month", lenient_timestamp(F.coalesce("datetime", "date")))
    counts = lines.groupBy(month.alias("month")).agg(F.count("*").alias("articles"))

    def publish(changed: DataFrame, batch_id: int) -> None:
        former = read_month_counts(changed.sparkSession, sink)
        old = former.alias("f").join(changed.alias("c"), F.col("f.month").eqNullSafe(F.col("c.month")), "left_anti")
        tables.publish_snapshot(old.unionByName(changed.select("month", "articles")), sink, MONTH_COUNTS)
        tables.drop_snapshots(changed.sparkSession, sink, keep)

    return (
        counts.writeStream.outputMode("update")
        .foreachBatch(publish)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_month_counts(spark: SparkSession, sink: str) -> DataFrame:
    """The latest count of every month."""
    return tables.read_snapshot(spark, sink, MONTH_COUNTS)
