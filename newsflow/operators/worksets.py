"""Selection of articles that still need an embedding."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from newsflow import settings
from newsflow.functions.text import embedding_input, percent
from newsflow.functions.vectors import check_shard, shard_of
from newsflow.operators.merge import absent_rows, stored_rows


def embedding_backlog(articles: DataFrame, embeddings: DataFrame) -> DataFrame:
    """Articles without an embedding."""
    return absent_rows(articles, embeddings, "article_id")


def embedding_work_set(
    articles: DataFrame,
    embeddings: DataFrame,
    model: str = settings.DEFAULT_MODEL,
    shard: int = 0,
    shards: int = 1,
    null_title: str = "propagate",
) -> DataFrame:
    """Id, encoder input and time of one shard of the backlog.

    The shard is a property of the id alone, so it is cut before the join and
    both sides of the join shrink with it. Ids alone decide what is due; only
    then are the texts of those articles fetched.
    """
    check_shard(shard, shards)
    if shards > 1:
        articles = articles.where(shard_of(F.col("article_id"), shards) == shard)
        embeddings = embeddings.where(shard_of(F.col("article_id"), shards) == shard)
    text = embedding_input(F.col("title"), F.col("text"), model, null_title)
    due = embedding_backlog(articles.select("article_id"), embeddings)
    return stored_rows(articles, due).select("article_id", text.alias("text"), "datetime")


def backlog_shares(articles: DataFrame, embeddings: DataFrame, shards: int) -> DataFrame:
    """Backlog per shard with its share of the whole; every shard has a row."""
    check_shard(0, shards)
    backlog = embedding_backlog(articles.select("article_id"), embeddings)
    counts = backlog.groupBy(shard_of(F.col("article_id"), shards).cast("int").alias("shard_id")).agg(
        F.count("*").alias("shard_rows")
    )
    every = backlog.sparkSession.range(shards).select(F.col("id").cast("int").alias("shard_id"))
    filled = every.join(F.broadcast(counts), "shard_id", "left").select(
        "shard_id", F.coalesce("shard_rows", F.lit(0)).alias("shard_rows")
    )
    # One row per shard, so the total may come from a window.
    total = F.sum("shard_rows").over(Window.partitionBy(F.lit(0)))
    return filled.withColumn("total_rows", total).select(
        "shard_id",
        "shard_rows",
        "total_rows",
        percent(F.col("shard_rows"), F.col("total_rows")).alias("share_pct"),
    )


def newest_first(work_set: DataFrame, limit: int) -> DataFrame:
    """The next batch: newest articles, those without a time last.

    Ids and times alone are sorted, which is all that passes one task; the
    texts of the chosen articles are fetched after that.
    """
    chosen = work_set.select("article_id", "datetime").orderBy(F.desc_nulls_last("datetime"), F.asc("article_id")).limit(limit)
    return stored_rows(work_set, chosen)


def batch_limit(batch_size: int, max_rows: int | None, processed: int) -> int:
    """Rows the next batch may hold."""
    return batch_size if max_rows is None else max(0, min(batch_size, max_rows - processed))


def latest(df: DataFrame, moment: str, limit: int, columns: list[str], tie: str) -> DataFrame:
    """The latest rows by ``moment``."""
    return df.orderBy(F.desc(moment), F.asc(tie)).limit(limit).select(*columns)


def non_empty_texts(batch: DataFrame) -> DataFrame:
    return batch.agg(
        F.count("*").alias("batch_rows"),
        F.count_if(F.coalesce(F.col("text"), F.lit("")) != "").alias("non_empty_texts"),
    )


def batch_progress(batches: DataFrame, total: DataFrame) -> DataFrame:
    """Processed rows and progress after each batch, from one row per batch.

    ``batches`` has ``shard_id, batch_no, batch_rows``; ``total`` has
    ``shard_id, shard_rows, total_rows``.
    """
    so_far = Window.partitionBy("shard_id").orderBy("batch_no").rowsBetween(Window.unboundedPreceding, 0)
    done = F.sum("batch_rows").over(so_far)
    return (
        batches.withColumn("processed", done)
        .join(F.broadcast(total.select("shard_id", "shard_rows", "total_rows")), "shard_id")
        .select(
            "shard_id",
            "batch_no",
            "batch_rows",
            "processed",
            (F.col("shard_rows") - F.col("processed")).alias("shard_remaining"),
            F.when(F.col("shard_rows") == 0, 100.0)
            .otherwise(F.col("processed") / F.col("shard_rows") * 100)
            .alias("shard_progress_pct"),
            F.when(F.col("total_rows") == 0, 100.0)
            .otherwise(F.col("processed") / F.col("total_rows") * 100)
            .alias("global_progress_pct"),
        )
    )
