"""Normalisation of landed articles to the one article schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from newsflow import settings
from newsflow.functions.dates import feed_timestamp, lenient_date, lenient_timestamp
from newsflow.functions.text import is_filled, sha256_hex, text_fingerprint
from newsflow.functions.urls import domain_or_host, domain_pattern, mentions_domain
from newsflow.operators.dedup import dedup_in_turn
from newsflow.sources.files import union_relaxed

ARTICLE_COLUMNS = [
    "article_id", "text_hash", "source_type", "domain", "title", "url", "datetime", "date", "author", "lang", "text",
]


def _text(df: DataFrame, name: str) -> Column:
    """A column as text; null if the data has none of that name."""
    return (F.col(name) if name in df.columns else F.lit(None)).cast("string")


def has_url_and_text(df: DataFrame) -> DataFrame:
    return df.where(is_filled(F.col("url")) & is_filled(F.col("text")))


def with_keys(
    df: DataFrame, fingerprint_order: str = "slice_first", chars: int | None = settings.FINGERPRINT_CHARS
) -> DataFrame:
    """Add the article id and the text fingerprint."""
    return df.withColumn("article_id", sha256_hex(F.col("url"))).withColumn(
        "text_hash", text_fingerprint(F.col("text"), fingerprint_order, chars)
    )


def archive_articles(
    lines: DataFrame, source_type: str = "ccnews", extra: list[str] | None = None
) -> DataFrame:
    """Archive lines in article form: day from the text date, host where no domain is given."""
    extra = extra or []
    typed = has_url_and_text(
        lines.select(
            _text(lines, "url").alias("url"),
            _text(lines, "title").alias("title"),
            _text(lines, "domain").alias("domain"),
            lenient_timestamp(_text(lines, "date")).alias("datetime"),
            _text(lines, "author").alias("author"),
            _text(lines, "lang").alias("lang"),
            _text(lines, "text").alias("text"),
            *extra,
        )
    )
    return (
        with_keys(typed)
        .withColumn("source_type", F.lit(source_type))
        .withColumn("domain", domain_or_host(F.col("domain"), F.col("url")))
        .withColumn("date", F.to_date("datetime"))
        .select(*ARTICLE_COLUMNS, *extra)
    )


def feed_articles(lines: DataFrame, source_type: str = "rss", extra: list[str] | None = None) -> DataFrame:
    """Feed lines in article form: moment and day are read apart, the domain is taken as given."""
    extra = extra or []
    moment, day = _text(lines, "datetime"), _text(lines, "date")
    typed = has_url_and_text(
        lines.select(
            F.lit(source_type).alias("source_type"),
            F.lower(_text(lines, "domain")).alias("domain"),
            _text(lines, "title").alias("title"),
            _text(lines, "url").alias("url"),
            feed_timestamp(moment, day).alias("datetime"),
            lenient_date(day).alias("date"),
            _text(lines, "author").alias("author"),
            _text(lines, "lang").alias("lang"),
            _text(lines, "text").alias("text"),
            *extra,
        )
    )
    return with_keys(typed).select(*ARTICLE_COLUMNS, *extra)


def _corpus_part(
    df: DataFrame, source_type: str, domain: Column, lang: Column, text: str, order: list[str]
) -> DataFrame:
    return df.select(
        F.lit(source_type).alias("source_type"),
        domain.alias("domain"),
        _text(df, "title").alias("title"),
        _text(df, "url").alias("url"),
        lenient_timestamp(_text(df, "date")).alias("datetime"),
        _text(df, "author").alias("author"),
        lang.alias("lang"),
        _text(df, text).alias("text"),
        *order,
    )


def archive_part(df: DataFrame, order: list[str], allowed=settings.ALLOWED_DOMAINS) -> DataFrame:
    """Corpus part from archives: only URLs that mention an allowed domain."""
    kept = df.where(mentions_domain(_text(df, "url"), allowed))
    url = _text(kept, "url")
    return _corpus_part(kept, "ccnews_manual", domain_pattern(url, lower=True), _text(kept, "lang"), "text", order)


def feed_part(df: DataFrame, order: list[str]) -> DataFrame:
    return _corpus_part(df, "rss", domain_pattern(_text(df, "url")), _text(df, "lang"), "text", order)


def bulk_part(df: DataFrame, order: list[str]) -> DataFrame:
    """Corpus part from the bulk data set, which is English and calls its text ``article``."""
    kept = df.where(F.col("url").isNotNull())
    return _corpus_part(kept, "all_the_news", domain_pattern(_text(kept, "url")), F.lit("en"), "article", order)


def unified_corpus(
    parts: list[DataFrame],
    order: list[str],
    dedup_keys: tuple[str, ...] = ("article_id", "text_hash"),
    fingerprint_order: str = "strip_first",
    chars: int | None = settings.FINGERPRINT_CHARS,
) -> DataFrame:
    """One corpus out of several parts, earlier parts first.

    De-duplicates by each key in turn; ``order`` names the columns that give
    the order of rows within a part. Texts count as equal if their first
    ``chars`` characters are (None: if they are equal as a whole).
    """
    numbered = [p.withColumn("_part", F.lit(n)) for n, p in enumerate(parts)]
    keyed = with_keys(has_url_and_text(union_relaxed(numbered)), fingerprint_order, chars)
    first = [F.col("_part"), *[F.col(c) for c in order]]
    return (
        dedup_in_turn(keyed, list(dedup_keys), first)
        .withColumn("date", F.to_date("datetime"))
        .select(*ARTICLE_COLUMNS)
    )
