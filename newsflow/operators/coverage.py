"""Coverage reports: unique URLs per domain and month, shares and the 80 % cut."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from newsflow import settings
from newsflow.functions.dates import lenient_timestamp, month_start
from newsflow.functions.text import clean_key, is_filled, strip
from newsflow.operators.running import running_total


def language_slice(df: DataFrame, lang: str) -> DataFrame:
    """Rows of one language with cleaned keys; a domain equal to the code is noise."""
    return (
        df.withColumn("lang", clean_key(F.col("lang")))
        .where(F.col("lang") == lang)
        .withColumn("domain", clean_key(F.col("domain")))
        .withColumn("url", strip(F.col("url")))
        .where((F.col("domain") != lang) & is_filled(F.col("url")))
    )


def unique_urls(df: DataFrame, by: str = "domain", approximate: bool = False) -> DataFrame:
    """Unique URLs per group.

    The exact count groups by (group, url) first, so even one group with a
    third of all rows is spread over all tasks.
    """
    count = F.approx_count_distinct("url") if approximate else F.count_distinct("url")
    return df.groupBy(by).agg(count.alias("unique_urls"))


def domain_shares(counts: DataFrame) -> DataFrame:
    """Share and cumulative share of every domain, largest first, ties by name.

    The total is taken from the ranked counts, which are stored by then, so
    the articles are read once.
    """
    ranked = running_total(counts, [F.desc("unique_urls"), F.asc("domain")], "unique_urls", "cum_urls")
    total = ranked.agg(F.sum("unique_urls").alias("total_urls"))  # one row
    return ranked.join(F.broadcast(total)).select(
        "domain",
        "unique_urls",
        (F.col("unique_urls") * 100.0 / F.col("total_urls")).alias("share_pct"),
        (F.col("cum_urls") * 100.0 / F.col("total_urls")).alias("cum_share_pct"),
        ((F.col("cum_urls") - F.col("unique_urls")) * 100.0 / F.col("total_urls")).alias("_before_pct"),
    )


def coverage_cut(shares: DataFrame, cut_pct: float = settings.COVERAGE_CUT_PCT) -> DataFrame:
    """The largest domains up to the cut, and the one that crosses it."""
    return shares.where(F.col("_before_pct") <= cut_pct).drop("_before_pct")


def coverage_reached(cut: DataFrame) -> DataFrame:
    return cut.agg(F.count("*").alias("domains"), F.round(F.sum("share_pct"), 2).alias("coverage_pct"))


def top_domains(counts: DataFrame, n: int = 30) -> DataFrame:
    return counts.orderBy(F.desc("unique_urls"), F.asc("domain")).limit(n)


def corpus_totals(df: DataFrame) -> DataFrame:
    """Rows, distinct URLs and distinct domains."""
    return df.agg(
        F.count("*").alias("total_rows"),
        F.count_distinct("url").alias("unique_urls"),
        F.count_distinct("domain").alias("unique_domains"),
    )


def monthly_unique_urls(df: DataFrame, date: str = "date", after: str = "2020-01-01") -> DataFrame:
    """Unique URLs per month of the rows dated after ``after``; bad dates drop out."""
    dated = df.withColumn("_day", lenient_timestamp(F.col(date).cast("string")))
    kept = dated.where((F.col("_day") > F.lit(after).cast("timestamp")) & F.col("url").isNotNull())
    return (
        kept.groupBy(month_start(F.col("_day")).alias("month"))
        .agg(F.count_distinct("url").alias("unique_articles"))
        .orderBy("month")
    )
