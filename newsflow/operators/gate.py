"""Extraction of pages, the quality gate behind it, and the counters of both."""

from __future__ import annotations

import json
from html.entities import html5

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from newsflow import settings
from newsflow.functions.pages import page_parts
from newsflow.functions.text import in_languages, is_filled, strip
from newsflow.functions.urls import in_allow_list_loose, is_article_url

_REFERENCE = r"&(?:#[0-9]{1,7}|#[xX][0-9A-Fa-f]{1,6}|[A-Za-z][A-Za-z0-9]{1,31});"


def _named_references() -> Column:
    """All named character references of HTML, without "&" and ";", by the table of Python's library."""
    table = {name[:-1]: value for name, value in html5.items() if name.endswith(";")}
    return F.from_json(F.lit(json.dumps(table | {"nbsp": " "})), "map<string, string>")


def unescape(text: Column) -> Column:
    """Replace character references, named and numeric; what is none, or no character, stays.

    A text is cut at its references and each is decoded once, so what a
    reference stands for is not taken for the begin of another one.
    """
    char = lambda code: F.decode(F.unhex(F.lpad(code, 8, "0")), "UTF-32")
    valid = lambda n: (n > 0) & ((n < 0xD800) | ((n > 0xDFFF) & (n < 0x110000)))
    inner = lambda p: F.substring(p, F.lit(2), F.length(p) - 2)
    code = lambda p: F.when(
        F.lower(F.substring(p, 3, 1)) == "x", F.conv(F.substring(p, F.lit(4), F.length(p) - 4), 16, 10).cast("int")
    ).otherwise(F.try_to_number(F.substring(p, F.lit(3), F.length(p) - 3), F.lit("9999999")).cast("int"))
    numeric = lambda p: F.coalesce(F.when(valid(code(p)), char(F.hex(code(p).cast("bigint")))), p)
    decoded = lambda p: (
        F.when(~p.startswith("&") | (F.length(p) < 3), p).when(F.substring(p, 2, 1) == "#", numeric(p)).otherwise(F.coalesce(F.try_element_at(_named_references(), inner(p)), p))
    )
    pieces = F.regexp_extract_all(text, F.lit(rf"(?s){_REFERENCE}|[^&]+|&"), F.lit(0))
    return F.when(text.contains("&"), F.array_join(F.transform(pieces, decoded), "")).otherwise(text)


def page_lang(html: Column) -> Column:
    """Two-letter code of the page's own language mark."""
    tag = F.regexp_extract(html, r"(?is)^(?>.*?<html(?=[\s>]))([^>]*)", 1)
    lang = F.regexp_extract(tag, r"(?i)\slang=[\"']?([A-Za-z]{2,3})", 1)
    return F.nullif(F.lower(lang), F.lit(""))


def extract_pages(df: DataFrame, html: str = "html") -> DataFrame:
    """Add title, date, author and text of a page.

    The text is that of the article block, with one line per block element.
    One scan over a page's tags finds its parts; it counts as
    non-deterministic, so that a filter on the results is not copied below it,
    which would scan every page twice. A null page has no parts.
    """

    @F.pandas_udf("title string, author string, stamp string, plain string")
    def parts(pages: pd.Series) -> pd.DataFrame:
        found = [(None, None, None, None) if page is None else page_parts(page) for page in pages]
        return pd.DataFrame(found, columns=["title", "author", "stamp", "plain"], dtype=object)

    raw = df.withColumn("_parts", parts.asNondeterministic()(F.col(html)))
    # One expression decodes all three texts.
    decoded = F.transform(F.array("_parts.title", "_parts.author", "_parts.plain"), unescape)
    title, author, text = (F.col("_decoded")[n] for n in range(3))
    spaced = F.regexp_replace(F.regexp_replace(text, r"[ \t\r]+", " "), r" ?\n[ \n]*", "\n")
    filled = lambda c: F.nullif(strip(c), F.lit(""))
    return raw.withColumn("_decoded", decoded).select(
        *df.columns,
        filled(F.regexp_replace(title, r"[ \t\r\n]+", " ")).alias("title"),
        F.nullif(F.regexp_extract(F.col("_parts.stamp"), r"^(\d{4}-\d{2}-\d{2})", 1), F.lit("")).alias("date"),
        filled(author).alias("author"),
        filled(spaced).alias("text"),
    )


EXTRACTED = "title string, date string, author string, text string"


def parse_extracted(json: Column) -> Column:
    """Extractor output from JSON text, with ``_broken`` set where it is no JSON object."""
    return F.from_json(
        json, f"{EXTRACTED}, _broken string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_broken"}
    )


def language_sample(title: Column, text: Column, chars: int | None = None) -> Column:
    """Title and text for language identification; ``chars`` limits the text."""
    body = text if chars is None else F.substring(text, 1, chars)
    return F.concat(F.coalesce(title, F.lit("")), F.lit(" "), body)


# Outcomes of the gate, in the order they are decided.
OUTCOMES = ("empty", "json_error", "short_text", "lang_error", "lang_filtered_out", "kept")


def gate_outcome(
    non_empty: Column,
    broken: Column,
    text: Column,
    lang: Column,
    allowed_langs: tuple[str, ...] = settings.ALLOWED_LANGS,
    min_chars: int = settings.MIN_TEXT_CHARS,
) -> Column:
    """Name of the first check an extracted page fails, or ``kept``."""
    return (
        F.when(~non_empty, "empty")
        .when(broken, "json_error")
        .when(~is_filled(text) | (F.length(text) < min_chars), "short_text")
        .when(lang.isNull(), "lang_error")
        .when(~in_languages(lang, allowed_langs), "lang_filtered_out")
        .otherwise("kept")
    )


def gate_json(
    df: DataFrame,
    json: str = "extracted",
    lang: str = "lang",
    allowed_langs: tuple[str, ...] = settings.ALLOWED_LANGS,
    min_chars: int = settings.MIN_TEXT_CHARS,
) -> DataFrame:
    """Gate landed extractor output. Adds title, date, author, text and outcome."""
    parsed = df.withColumn("_x", parse_extracted(F.col(json)))
    broken = F.col("_x._broken").isNotNull()
    return parsed.select(
        *[c for c in df.columns if c not in ("title", "date", "author", "text")],
        "_x.title", "_x.date", "_x.author", "_x.text",
        gate_outcome(
            is_filled(F.col(json)), broken, F.col("_x.text"), F.col(lang), allowed_langs, min_chars
        ).alias("outcome"),
    )


def stage_pages(
    pages: DataFrame,
    denied: tuple[str, ...] = settings.DENIED_URL_PARTS,
    allowed: tuple[str, ...] = settings.ALLOWED_DOMAINS,
    max_bytes: int | None = settings.MAX_PAGE_BYTES,
) -> DataFrame:
    """Mark how far each record (``rec_type, url, payload_bytes``) gets before extraction.

    Cheap checks on the URL come before the one on the size, so a plan that
    filters on ``stage`` extracts nothing that was refused. Without
    ``max_bytes`` no page is too large.
    """
    too_large = F.lit(False) if max_bytes is None else F.col("payload_bytes") > max_bytes
    url_ok = is_article_url(F.col("url"), denied) & in_allow_list_loose(F.col("url"), allowed)
    return pages.withColumn(
        "stage",
        F.when(F.coalesce(F.col("rec_type") != "response", F.lit(True)), "other_record")
        .when(~is_filled(F.col("url")), "no_url")
        .when(~url_ok, "url_filtered")
        .when(too_large, "too_large")
        .otherwise("extract"),
    )


def _flag(condition: Column, name: str) -> Column:
    return F.coalesce(F.sum(condition.cast("bigint")), F.lit(0)).alias(name)


def archive_counters() -> list[Column]:
    """Aggregates over ``stage`` and ``outcome`` (null where not extracted)."""
    stage, outcome = F.col("stage"), F.coalesce(F.col("outcome"), F.lit("none"))
    return [
        F.count("*").alias("records_seen"),
        _flag(stage != "other_record", "response_records"),
        _flag(stage.isin("too_large", "extract"), "after_url_filters"),
        _flag(stage == "extract", "after_size_filter"),
        _flag(outcome.isin("short_text", "lang_error", "lang_filtered_out", "kept"), "extract_non_empty"),
        _flag(outcome == "json_error", "json_errors"),
        _flag(outcome == "lang_error", "lang_errors"),
        _flag(outcome == "lang_filtered_out", "lang_filtered_out"),
        _flag(outcome == "kept", "written"),
    ]


COUNTERS = [
    "records_seen", "response_records", "after_url_filters", "after_size_filter", "extract_non_empty",
    "json_errors", "lang_errors", "lang_filtered_out", "written",
]


def fold_counters(per_archive: DataFrame, by: str = "month") -> DataFrame:
    """Sum the counters of archives."""
    return per_archive.groupBy(by).agg(F.count("*").alias("archives"), *[F.sum(c).alias(c) for c in COUNTERS])
