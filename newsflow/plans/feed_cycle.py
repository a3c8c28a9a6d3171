"""One feed cycle: landed feeds and fetched pages -> landing -> article table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from newsflow import schemas, settings
from newsflow.functions.dates import publication_iso
from newsflow.functions.text import sha256_hex
from newsflow.functions.urls import domain_from_url
from newsflow.operators import gate, unify
from newsflow.operators.dedup import first_per_key
from newsflow.operators.key_filter import new_rows_by_filter
from newsflow.operators.merge import new_rows
from newsflow.session import broadcast_if_small, materialise
from newsflow.sources import feeds, tables
from newsflow.sources.files import READ_ORDER, read_order, with_read_order

MAX_BROADCAST_LINKS = 500_000  # rows of about 300 bytes


def _within(entries: DataFrame, max_entries: int | None) -> DataFrame:
    return entries if max_entries is None else feeds.first_entries(entries, max_entries)


def new_candidates(
    entries: DataFrame,
    stored: DataFrame,
    max_entries: int | None = None,
    known: tuple[DataFrame, int] | None = None,
    **lists,
) -> DataFrame:
    """Links of the feeds that are allowed and not stored yet, once per link; all entries unless limited.

    ``known`` is a Bloom filter of the stored ids with its number of pages:
    with it only links that may be stored are joined with the stored ids.
    """
    marked = feeds.mark_entries(_within(entries, max_entries), **lists)
    links = feeds.candidates(marked).withColumn("article_id", sha256_hex(F.col("url")))
    firsts = first_per_key(links, ["article_id"], [F.col("feed_url")])
    if known is not None:
        return new_rows_by_filter(firsts, stored, known[0], "article_id", known[1])
    return new_rows(firsts, stored, links)


def feed_lines(
    links: DataFrame,
    pages: DataFrame,
    langs: tuple[str, ...] = settings.ALLOWED_LANGS,
    min_chars: int = settings.MIN_TEXT_CHARS,
) -> DataFrame:
    """Landing lines of the links whose page (``url, html``) passes the gate.

    A cycle has few new links and the page table is large: below a counted
    bound the links are broadcast, so that no page is shuffled.
    """
    fetched = pages.select("url", "html").join(broadcast_if_small(links, MAX_BROADCAST_LINKS), "url")
    page = gate.extract_pages(fetched).withColumn("lang", gate.page_lang(F.col("html")))
    outcome = gate.gate_outcome(
        gate.is_filled(F.col("text")), F.lit(False), F.col("text"), F.col("lang"), langs, min_chars
    )
    kept = page.where(outcome == "kept").select(
        "url",
        domain_from_url(F.col("url")).alias("domain"),
        "title",
        publication_iso(F.col("published"), F.col("date")).alias("datetime"),
        "date",
        "author",
        "lang",
        "text",
        F.col("feed_url").alias("rss_url"),
    )
    return tables.landing_line(kept)


def cycle_counters(
    entries: DataFrame,
    stored: DataFrame,
    max_entries: int | None = None,
    pages: DataFrame | None = None,
    langs: tuple[str, ...] = settings.ALLOWED_LANGS,
    min_chars: int = settings.MIN_TEXT_CHARS,
    **lists,
) -> DataFrame:
    """Counters of a cycle, one row: up to the choice of links, and with ``pages`` (``url, html``) also what came of them.

    A link counts once per feed. A page is extracted once, however many feeds link to it.
    """
    marked = feeds.mark_entries(_within(entries, max_entries), **lists)
    count = lambda stage, name: F.count_if(F.col("entry_stage") == stage).alias(name)
    seen = marked.agg(
        F.count_distinct("feed_url").alias("feeds"),
        F.count("*").alias("rss_entries"),
        count("url_filtered_out", "url_filtered_out"),
        count("domain_filtered_out", "domain_filtered_out"),
    )
    links = feeds.candidates(marked).withColumn("article_id", sha256_hex(F.col("url")))
    known = stored.select("article_id", F.lit(1).alias("_known"))
    links = links.join(known, "article_id", "left").select("feed_url", "url", "_known")
    if pages is not None:
        due = links.where("_known IS NULL").select("url").distinct()
        fetched = pages.where("html IS NOT NULL").select("url", "html").join(due, "url", "left_semi")
        page = gate.extract_pages(fetched).withColumn("lang", gate.page_lang(F.col("html")))
        outcome = gate.gate_outcome(gate.is_filled(F.col("text")), F.lit(False), F.col("text"), F.col("lang"), langs, min_chars)
        links = links.join(page.select("url", outcome.alias("outcome")), "url", "left")
    else:
        links = links.withColumn("outcome", F.lit(None).cast("string"))
    is_due = F.col("_known").isNull()
    came = lambda *outcomes: F.coalesce(is_due & F.col("outcome").isin(*outcomes), F.lit(False))
    flag = lambda condition, name: F.count_if(condition).alias(name)
    found = [F.count("*").alias("candidates"), F.count("_known").alias("already_in_db")]
    if pages is not None:
        found += [
            flag(is_due & F.col("outcome").isNotNull(), "fetched_ok"),
            flag(is_due & F.col("outcome").isNull(), "fetch_fail"),
            flag(came("kept"), "extract_ok"),
            flag(came(*(o for o in gate.OUTCOMES if o != "kept")), "extract_fail"),
            flag(came("short_text", "lang_error", "lang_filtered_out", "kept"), "extract_non_empty"),
            flag(came("json_error"), "json_errors"),
            flag(came("lang_error"), "lang_errors"),
            flag(came("lang_filtered_out"), "lang_filtered_out"),
            flag(came("kept"), "written"),
        ]
    return seen.join(F.broadcast(links.agg(*found)))


def run_cycle(spark: SparkSession, entries: DataFrame, pages: DataFrame, landing: str, articles: str) -> dict[str, int]:
    """Land the new articles of the feeds and merge all landed lines."""
    stored = tables.read_table(spark, articles, schemas.ARTICLES)
    links = materialise(new_candidates(entries, stored))
    tables.land_articles(feed_lines(links, pages), landing)
    return load_landed(spark, landing, articles)


def load_landed(spark: SparkSession, landing: str, articles: str) -> dict[str, int]:
    """Merge every landed feed line; lines loaded before add nothing."""
    lines = spark.read.schema(schemas.text_schema(schemas.LANDED_ARTICLE_COLUMNS)).json(landing)
    batch = unify.feed_articles(with_read_order(lines), extra=READ_ORDER)
    return tables.append_if_absent(batch, articles, read_order())
