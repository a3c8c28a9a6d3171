"""Merges into a table that has no MERGE of its own.

Each merge returns the rows to append or the new state as a DataFrame. An
insert first cuts the stored keys to those of the batch: where Spark finds the
batch's keys small it broadcasts them, and the stored table stays in place; a
large batch is joined by a shuffle of keys. What is left of the stored keys is
no more than the batch has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from newsflow import settings
from newsflow.functions.text import cut_error
from newsflow.functions.urls import strip_www
from newsflow.operators.dedup import first_per_key


def absent_rows(batch: DataFrame, stored: DataFrame, key: str = "article_id") -> DataFrame:
    """Rows of the batch whose key is not stored yet."""
    return batch.join(stored.select(key), key, "left_anti")


def new_rows(batch: DataFrame, stored: DataFrame, keys: DataFrame, key: str = "article_id") -> DataFrame:
    """As ``absent_rows``, for a batch that is small against the stored table.

    ``keys`` holds at least the keys of the batch; it is read apart from it.
    """
    return absent_rows(batch, stored.select(key).join(keys.select(key), key, "left_semi"), key)


def stored_rows(batch: DataFrame, stored: DataFrame, key: str = "article_id") -> DataFrame:
    """Rows of the batch whose key is stored."""
    return batch.join(stored.select(key), key, "left_semi")


def insert_if_absent(
    batch: DataFrame, stored: DataFrame, order: list[Column], key: str = "article_id"
) -> DataFrame:
    """Rows to append: the first one per new key. Stored rows never change."""
    return new_rows(first_per_key(batch, [key], order), stored, batch, key)


def merge_counts(batch: DataFrame, inserted: DataFrame) -> DataFrame:
    """One row: rows offered and rows inserted."""
    offered = batch.agg(F.count("*").alias("rows_in_df"))
    return offered.join(F.broadcast(inserted.agg(F.count("*").alias("inserted_estimate"))))


def upsert_latest(stored: DataFrame, batch: DataFrame, order: list[Column], key: str = "article_id") -> DataFrame:
    """New state: the last row of the batch per key, else the stored one."""
    newest = first_per_key(batch, [key], order)
    return absent_rows(stored, newest, key).unionByName(newest)


def apply_status_updates(stored: DataFrame, updates: DataFrame) -> DataFrame:
    """New state of the archive ledger after updates numbered by ``update_no``.

    ``done`` sets both counters and clears the error. ``failed`` sets the
    error, cut to its limit, and keeps the counters of the last ``done``. One
    aggregation folds all updates of an archive and combines before the shuffle.
    """
    old = stored.select("*", F.lit(-1).cast("bigint").alias("update_no"), F.lit(True).alias("_stored"))
    new = updates.select("*", F.lit(False).alias("_stored"))
    counted = F.col("_stored") | (F.col("status") == "done")
    counter_no = F.when(counted, F.col("update_no"))
    last = lambda c: F.max_by(c, "update_no")
    return (
        old.unionByName(new, allowMissingColumns=True)
        .groupBy("warc_path")
        .agg(
            last("month").alias("month"),
            last("status").alias("status"),
            F.coalesce(F.max_by("rows_written", counter_no), F.lit(0)).cast("int").alias("rows_written"),
            F.coalesce(F.max_by("rows_inserted", counter_no), F.lit(0)).cast("int").alias("rows_inserted"),
            last(F.when(F.col("status") == "failed", cut_error(F.col("error_text"), settings.ERROR_TEXT_CHARS))).alias(
                "error_text"
            ),
            last("updated_at").alias("updated_at"),
        )
    )


def strip_www_since(articles: DataFrame, since: str = "2026-03-01") -> DataFrame:
    """Drop a leading ``www.`` from the domain of rows dated ``since`` or later."""
    due = F.col("domain").startswith("www.") & (F.col("date") >= F.lit(since).cast("date"))
    return articles.withColumn("domain", F.when(due, strip_www(F.col("domain"))).otherwise(F.col("domain")))


def strip_www_stored(spark: SparkSession, path: str, schema: StructType, since: str = "2026-03-01") -> list[str]:
    """``strip_www_since`` on a table stored by day: only days since then that have a due row are written again."""
    from newsflow.sources import stores

    recent = (F.col(stores.PART) >= since) & (F.col(stores.PART) != stores.NO_DAY)
    due = recent & F.coalesce(F.col("domain").startswith("www."), F.lit(False))
    return stores.update_parts(spark, path, schema, due, {"domain": strip_www(F.col("domain"))})


def cascade_delete(embeddings: DataFrame, articles: DataFrame) -> DataFrame:
    """Embeddings whose article still exists."""
    return stored_rows(embeddings, articles)


def drain(work_set: DataFrame, processed: DataFrame, key: str = "article_id") -> DataFrame:
    """What is left of a work set after a processed batch."""
    return absent_rows(work_set, processed, key)
