"""Unified corpus from three landed trees, and the coverage report over it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from newsflow import settings
from newsflow.functions.text import is_filled
from newsflow.functions.urls import domain_from_url, is_article_url
from newsflow.operators import coverage, unify
from newsflow.sources.files import READ_ORDER, scan_tree


def build_corpus(
    spark: SparkSession,
    archive_root: str,
    feed_root: str,
    bulk_root: str,
    allowed=settings.ALLOWED_DOMAINS,
    fingerprint_chars: int | None = None,
) -> DataFrame:
    """The corpus of three trees. Whole texts are compared unless ``fingerprint_chars`` limits it."""
    line = ["url", "title", "date", "author", "lang", "text"]
    parts = [
        unify.archive_part(scan_tree(spark, archive_root, line), READ_ORDER, allowed),
        unify.feed_part(scan_tree(spark, feed_root, line), READ_ORDER),
        unify.bulk_part(scan_tree(spark, bulk_root, ["url", "title", "date", "author", "article"]), READ_ORDER),
    ]
    return unify.unified_corpus(parts, READ_ORDER, chars=fingerprint_chars)


def page_coverage(pages: DataFrame, denied=settings.DENIED_URL_PARTS) -> DataFrame:
    """Domains that cover 80 % of the unique article URLs of a page table."""
    urls = pages.select("url").where(is_filled(F.col("url")) & is_article_url(F.col("url"), denied))
    counts = coverage.unique_urls(urls.withColumn("domain", domain_from_url(F.col("url"))))
    return coverage.coverage_cut(coverage.domain_shares(counts))
