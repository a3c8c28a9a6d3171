"""Embed the articles that have no vector yet, and compare articles by vector."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from newsflow import schemas, settings
from newsflow.operators import worksets
from newsflow.operators.embed import embed_texts
from newsflow.operators.neighbours import nearest_neighbours, with_titles
from newsflow.sources import tables


def refresh_embeddings(
    spark: SparkSession,
    articles: DataFrame,
    store: str,
    model: str = settings.DEFAULT_MODEL,
    make_encoder: Callable | None = None,
    dim: int = settings.EMBEDDING_DIM,
    batch_size: int = 128,
    max_rows: int | None = None,
    shard: int = 0,
    shards: int = 1,
) -> dict[str, int]:
    """Embed one shard of the backlog into the store.

    Tasks take the place of the batch loop. ``max_rows`` takes the newest
    articles first. The backlog holds only articles the store lacks, so its
    vectors are appended and nothing stored is rewritten; shards may run at
    the same time. To replace vectors, publish ``upsert_latest`` instead.
    """
    stored = tables.read_table(spark, store, schemas.EMBEDDINGS)
    work = worksets.embedding_work_set(articles, stored, model, shard, shards)
    if max_rows is not None:
        work = worksets.newest_first(work, max_rows)
    done = Observation()
    fresh = embed_texts(work, model, make_encoder, dim, batch_size).observe(done, F.count("*").alias("n"))
    backlog = worksets.embedding_backlog(articles.select("article_id"), stored).count()
    tables.append_rows(fresh, store, schemas.EMBEDDINGS)
    processed = done.get["n"]
    return {
        "processed": processed,
        "upserted": processed,
        "embedding_dim": dim,
        "shard_id": shard,
        "num_shards": shards,
        "total_non_embedded": backlog,
    }


def closest_articles(embeddings: DataFrame, articles: DataFrame) -> DataFrame:
    """Every embedded article with its nearest other one and both titles."""
    closest = nearest_neighbours(embeddings, "article_id", "text_embedding")
    return with_titles(closest, articles)
