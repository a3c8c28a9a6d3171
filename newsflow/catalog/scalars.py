"""Scalar functions and predicates over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from newsflow import settings
from newsflow.catalog import inputs as I
from newsflow.catalog.registry import query
from newsflow.functions import dates, text, urls, vectors
from newsflow.sources import feeds

_MIXED_URL = "CASE page_id % 5 WHEN 0 THEN upper(url) WHEN 1 THEN regexp_replace(url, '^https?://', '') WHEN 2 THEN '//user:pw@' || regexp_replace(url, '^https?://', '') WHEN 3 THEN NULL ELSE '  ' || url END"


def _mixed_urls(spark, d):
    n, url = F.col("page_id"), F.col("url")
    bare = F.regexp_replace(url, "^https?://", "")
    return I.table(spark, d, "pages").select(
        "page_id",
        F.when(n % 5 == 0, F.upper(url))
        .when(n % 5 == 1, bare)
        .when(n % 5 == 2, F.concat(F.lit("//user:pw@"), bare))
        .when(n % 5 == 3, F.lit(None))
        .otherwise(F.concat(F.lit("  "), url))
        .alias("u"),
    )


@query("url_domain", f"SELECT page_id, {I.sql_domain('u')} AS \"domain\" FROM (SELECT page_id, {_MIXED_URL} AS u FROM pages) AS p")
def url_domain(spark, d):
    return _mixed_urls(spark, d).select("page_id", urls.domain_from_url(F.col("u")).alias("domain"))


_PATTERN = "coalesce(nullif(regexp_extract(u, '^(?:https?://)?(?:www\\.)?([^/]+)', 1), ''), 'unknown')"


@query(
    "url_domain_pattern",
    f"SELECT page_id, {_PATTERN} AS as_written, lower({_PATTERN}) AS lowered FROM (SELECT page_id, {_MIXED_URL} AS u FROM pages) AS p",
)
def url_domain_pattern(spark, d):
    return _mixed_urls(spark, d).select(
        "page_id",
        urls.domain_pattern(F.col("u")).alias("as_written"),
        urls.domain_pattern(F.col("u"), lower=True).alias("lowered"),
    )


_SUFFIXED = "CASE page_id % 3 WHEN 0 THEN replace(host, '.example.com', '.co.uk') WHEN 1 THEN replace(host, 'example.org', 'gov.uk') ELSE host END"


@query(
    "registrable_domains",
    f"""WITH h AS (SELECT page_id, {_SUFFIXED} AS host FROM (SELECT page_id, {I.sql_domain('url')} AS host FROM pages) AS p)
SELECT page_id, host, {I.sql_registrable('host')} AS registrable FROM h""",
)
def registrable_domains(spark, d):
    host = urls.domain_from_url(F.col("url"))
    n = F.col("page_id")
    changed = (
        F.when(n % 3 == 0, F.replace(host, F.lit(".example.com"), F.lit(".co.uk")))
        .when(n % 3 == 1, F.replace(host, F.lit("example.org"), F.lit("gov.uk")))
        .otherwise(host)
    )
    hosts = I.table(spark, d, "pages").select("page_id", changed.alias("host"))
    return hosts.withColumn("registrable", urls.registrable_domain(F.col("host")))


@query(
    "clean_tracking_links",
    f"WITH {I.ENTRIES} SELECT entry_no, {I.SQL_CLEAN_LINK} AS url, sha256({I.SQL_CLEAN_LINK}) AS article_id FROM entries",
)
def clean_tracking_links(spark, d):
    url = urls.clean_url(text.strip(F.col("link")))
    return I.entries(spark, d).select("entry_no", url.alias("url"), text.sha256_hex(url).alias("article_id"))


_PADDED = "CASE WHEN doc_id % 5 = 0 THEN ' ' || chr(10) || chr(160) || text || chr(8195) ELSE text END"


@query(
    "text_fingerprints",
    f"""SELECT doc_id, sha256({I.sql_strip('lower(substr(t, 1, 500))')}) AS slice_first,
  sha256(substr({I.sql_strip('lower(t)')}, 1, 500)) AS strip_first
FROM (SELECT doc_id, {_PADDED} AS t FROM documents) AS x""",
)
def text_fingerprints(spark, d):
    padded = F.when(
        F.col("doc_id") % 5 == 0, F.concat(F.lit(" \n "), F.col("text"), F.lit(" "))
    ).otherwise(F.col("text"))
    return (
        I.table(spark, d, "documents")
        .withColumn("t", padded)
        .select(
            "doc_id",
            text.text_fingerprint(F.col("t")).alias("slice_first"),
            text.text_fingerprint(F.col("t"), "strip_first").alias("strip_first"),
        )
    )


@query(
    "domain_fallback",
    f"""WITH {I.LINES} SELECT copy_no, doc_id,
  CASE WHEN "domain" IS NULL OR length("domain") = 0 THEN {I.sql_domain('url')} ELSE lower("domain") END AS "domain" FROM lines""",
)
def domain_fallback(spark, d):
    return I.lines(spark, d).select(
        "copy_no", "doc_id", urls.domain_or_host(F.col("domain"), F.col("url")).alias("domain")
    )


@query(
    "legacy_feed_records",
    f"""WITH {I.ENTRIES},
r AS (SELECT coalesce(feed_title, feed_url) AS s, trim(link) AS url, coalesce(nullif(trim(title), ''), trim(link)) AS title,
    trim(language) AS language FROM entries WHERE trim(link) <> '')
SELECT CASE WHEN trim(s) <> '' THEN trim(s) ELSE {I.sql_netloc('url')} END AS source, title, url, 'rss' AS origin, language,
  sha256(CASE WHEN url <> '' THEN url ELSE lower(title) END) AS hash FROM r""",
)
def legacy_feed_records(spark, d):
    return feeds.legacy_articles(I.entries(spark, d)).select("source", "title", "url", "origin", "language", "hash")


@query(
    "embedding_input_text",
    f"""WITH {I.ARTICLES} SELECT article_id, sha256(trim(coalesce('passage: ' || title || ' ' || text, ''), ' ' || chr(9) || chr(10) || chr(13))) AS default_model,
  sha256(trim(coalesce(title || ' ' || text, text), ' ' || chr(9) || chr(10) || chr(13))) AS other_model FROM articles""",
)
def embedding_input_text(spark, d):
    default = text.embedding_input(F.col("title"), F.col("text"))
    other = text.embedding_input(F.col("title"), F.col("text"), "another-model", null_title="skip")
    return I.articles(spark, d).select(
        "article_id",
        text.sha256_hex(text.safe_text(default)).alias("default_model"),
        text.sha256_hex(text.safe_text(other)).alias("other_model"),
    )


_ARCHIVE = "'crawl-data/CC-NEWS/(\\d{4})/(\\d{2})/(.+)$'"


@query(
    "archive_path_parts",
    f"""WITH {I.MANIFEST} SELECT warc_path, coalesce(nullif(regexp_extract(warc_path, {_ARCHIVE}, 1), ''), 'unknown') AS year,
  coalesce(nullif(regexp_extract(warc_path, {_ARCHIVE}, 2), ''), 'unknown') AS month,
  replace(list_extract(string_split(warc_path, '/'), -1), '.warc.gz', '.jsonl') AS landing_file FROM manifest""",
)
def archive_path_parts(spark, d):
    path = F.col("warc_path")
    return I.manifest(spark, d).select(
        "warc_path",
        urls.archive_year(path).alias("year"),
        urls.archive_month(path).alias("month"),
        urls.archive_file(path).alias("landing_file"),
    )


@query("error_text_cut", "SELECT doc_id, sha256(substr(text, 1, 2000)) AS cut_hash, length(substr(text, 1, 2000)) AS cut_chars FROM documents")
def error_text_cut(spark, d):
    cut = text.cut_error(F.col("text"))
    return I.table(spark, d, "documents").select(
        "doc_id", text.sha256_hex(cut).alias("cut_hash"), F.length(cut).cast("bigint").alias("cut_chars")
    )


@query("half_even_percent", """SELECT o_orderkey, round_even((o_orderkey % 97) / 32.0, 2) AS rounded,
  CASE WHEN o_orderkey % 5 = 0 THEN 0.0 ELSE round_even((o_orderkey % 97) * 1.0 / (o_orderkey % 5) * 100, 2) END AS pct FROM orders""")
def half_even_percent(spark, d):
    n = F.col("o_orderkey")
    return I.table(spark, d, "orders").select(
        "o_orderkey",
        text.half_even((n % 97) / 32.0).alias("rounded"),
        text.half_even(text.percent(n % 97, n % 5)).alias("pct"),
    )


@query(
    "article_url_filter",
    f"""SELECT page_id, NOT {I.sql_contains_any('url', settings.DENIED_URL_PARTS)} AS passes_default,
  NOT {I.sql_contains_any('url', I.DENIED)} AS passes_given FROM pages""",
)
def article_url_filter(spark, d):
    url = F.col("url")
    return I.table(spark, d, "pages").select(
        "page_id",
        urls.is_article_url(url).alias("passes_default"),
        urls.is_article_url(url, I.DENIED).alias("passes_given"),
    )


@query(
    "allow_list_loose",
    f"SELECT page_id, url FROM pages WHERE {I.sql_contains_any('lower(' + I.sql_netloc('url') + ')', I.ALLOWED)}",
)
def allow_list_loose(spark, d):
    return I.table(spark, d, "pages").where(urls.in_allow_list_loose(F.col("url"), I.ALLOWED)).select("page_id", "url")


_STRICT = [a.removeprefix("www.") for a in I.ALLOWED]


def _sql_strict(host: str) -> str:
    return "(" + " OR ".join(f"{host} = '{a}' OR {host} LIKE '%.{a}'" for a in _STRICT) + ")"


@query(
    "allow_list_strict",
    f"SELECT page_id, host FROM (SELECT page_id, {I.sql_domain('url')} AS host FROM pages) AS p WHERE {_sql_strict('host')}",
)
def allow_list_strict(spark, d):
    pages = I.table(spark, d, "pages").where(urls.in_allow_list(F.col("url"), I.ALLOWED))
    return pages.select("page_id", urls.domain_from_url(F.col("url")).alias("host"))


@query(
    "host_below_domain",
    f"""SELECT page_id, host = 'ththen.example.com' OR host LIKE '%.ththen.example.com' AS below_host,
  host = 'example.org' OR host LIKE '%.example.org' AS below_org FROM (SELECT page_id, {I.sql_domain('url')} AS host FROM pages) AS p""",
)
def host_below_domain(spark, d):
    host = urls.domain_from_url(F.col("url"))
    return I.table(spark, d, "pages").select(
        "page_id",
        urls.host_matches(host, F.lit("ththen.example.com")).alias("below_host"),
        urls.host_matches(host, F.lit("Example.org ")).alias("below_org"),
    )


@query("url_mentions_domain", f"SELECT page_id FROM pages WHERE {I.sql_contains_any('url', I.ALLOWED)}")
def url_mentions_domain(spark, d):
    return I.table(spark, d, "pages").where(urls.mentions_domain(F.col("url"), I.ALLOWED)).select("page_id")


_PREFIXES = ["rss.", "feeds.", "www.", "api."]


def _sql_expected(feed: str) -> str:
    """CTEs that give ``expected(feed_url, expected_domain)`` for the table ``feed``."""
    strips = " UNION ".join(
        f"SELECT feed_url, host[{len(p) + 1}:] FROM hosts WHERE host LIKE '{p}%'" for p in _PREFIXES
    )
    members = " UNION ALL ".join(
        f"SELECT {n} AS group_no, '{m}' AS member" for n, g in enumerate(I.GROUPS) for m in g
    )
    return f"""hosts AS (SELECT feed_url, {I.sql_domain('feed_url')} AS host FROM (SELECT DISTINCT feed_url FROM {feed}) AS f),
stripped AS (SELECT feed_url, host FROM hosts UNION {strips}),
own AS (SELECT feed_url, host AS dom FROM stripped UNION SELECT feed_url, {I.sql_registrable('host')} FROM stripped),
members AS ({members}),
expected AS (SELECT feed_url, dom AS expected_domain FROM own
  UNION SELECT o.feed_url, other.member FROM own o JOIN members m ON contains(o.dom, m.member)
  JOIN members other ON other.group_no = m.group_no)"""


@query("feed_expected_domains", f"WITH {I.ENTRIES}, {_sql_expected('entries')} SELECT feed_url, expected_domain FROM expected")
def feed_expected_domains(spark, d):
    dimension = feeds.feed_dimension(I.entries(spark, d), I.GROUPS)
    return dimension.select("feed_url", F.explode("expected").alias("expected_domain"))


@query(
    "publisher_group_members",
    f"""WITH h AS (SELECT DISTINCT {I.sql_domain('url')} AS host FROM pages),
members AS ({" UNION ALL ".join(f"SELECT {n} AS group_no, '{m}' AS member" for n, g in enumerate(I.GROUPS) for m in g)})
SELECT host, CAST(count(DISTINCT group_no) AS BIGINT) AS publisher_groups FROM h JOIN members ON contains(host, member) GROUP BY host""",
)
def publisher_group_members(spark, d):
    hosts = I.table(spark, d, "pages").select(urls.domain_from_url(F.col("url")).alias("host")).distinct()
    hits = [text.matches_any(F.col("host"), g).cast("bigint") for g in I.GROUPS]
    counted = hosts.withColumn("publisher_groups", sum(hits[1:], hits[0]))
    return counted.where("publisher_groups > 0")


_PROXIES = ", ".join(f"'{p}'" for p in I.PROXIES)
FEED_GATE = f"""{I.ENTRIES}, {_sql_expected('entries')},
cleaned AS (SELECT *, {I.SQL_CLEAN_LINK} AS url FROM entries),
hosted AS (SELECT *, {I.sql_domain('url')} AS host, {I.sql_domain('feed_url')} AS feed_host FROM cleaned),
marked AS (SELECT h.*, CASE WHEN url = '' THEN 'no_link' WHEN {I.sql_contains_any('url', I.DENIED)} THEN 'url_filtered_out'
  WHEN NOT CASE WHEN host = 'unknown' THEN false WHEN feed_host IN ({_PROXIES}) THEN {_sql_strict('host')}
    ELSE EXISTS (SELECT 1 FROM expected e WHERE e.feed_url = h.feed_url AND (host = expected_domain
      OR host LIKE '%.' || expected_domain OR {I.sql_registrable('host')} = expected_domain)) END THEN 'domain_filtered_out'
  ELSE 'candidate' END AS entry_stage FROM hosted h)"""


def marked_entries(spark, d):
    return feeds.mark_entries(I.entries(spark, d), I.DENIED, I.ALLOWED, I.GROUPS, I.PROXIES)


@query("feed_entry_gate", f"WITH {FEED_GATE} SELECT entry_no, feed_url, url, entry_stage FROM marked")
def feed_entry_gate(spark, d):
    return marked_entries(spark, d).select("entry_no", "feed_url", "url", "entry_stage")


@query("page_size_filter", "SELECT page_id, CAST(strlen(html) AS INTEGER) AS page_bytes FROM pages WHERE strlen(html) <= 5000")
def page_size_filter(spark, d):
    size = F.octet_length("html")
    return I.table(spark, d, "pages").where(size <= 5000).select("page_id", size.alias("page_bytes"))


@query(
    "long_texts_in_languages",
    "SELECT doc_id, lang FROM documents WHERE text IS NOT NULL AND length(text) >= 500 AND lang IN ('en', 'fr')",
)
def long_texts_in_languages(spark, d):
    docs = I.table(spark, d, "documents")
    return docs.where(text.long_enough(F.col("text")) & text.in_languages(F.col("lang"), I.LANGS)).select("doc_id", "lang")


@query("required_fields", f"WITH {I.LINES} SELECT copy_no, doc_id FROM lines WHERE url IS NOT NULL AND text IS NOT NULL AND length(url) > 0 AND length(text) > 0")
def required_fields(spark, d):
    from newsflow.operators.unify import has_url_and_text

    return has_url_and_text(I.lines(spark, d)).select("copy_no", "doc_id")


@query(
    "language_slice",
    f"""WITH {I.LINES} SELECT copy_no, doc_id, lower(trim("domain")) AS "domain", trim(url) AS url FROM lines
WHERE lower(trim(lang)) = 'en' AND lower(trim("domain")) <> 'en' AND trim(url) <> ''""",
)
def language_slice(spark, d):
    from newsflow.operators.coverage import language_slice

    return language_slice(I.lines(spark, d), "en").select("copy_no", "doc_id", "domain", "url")


@query("non_empty_links", f"WITH {I.ENTRIES} SELECT entry_no, trim(link) AS link FROM entries WHERE trim(link) <> ''")
def non_empty_links(spark, d):
    link = text.strip(F.col("link"))
    return I.entries(spark, d).where(text.is_filled(link)).select("entry_no", link.alias("link"))


_RFC = "regexp_extract(published, '^\\s*(?:[A-Za-z]{3,9},?\\s+)?(.*?)\\s*([+-]\\d{4}|[A-Za-z]+)?$', 1)"
_ZONE = "regexp_extract(published, '([+-]\\d{4}|[A-Z]+)$', 1)"
_OFFSET = f"CASE {_ZONE} WHEN 'GMT' THEN '+0000' WHEN 'EST' THEN '-0500' WHEN '' THEN NULL ELSE {_ZONE} END"
_LOCAL = f"coalesce(try_strptime({_RFC}, '%d %b %Y %H:%M:%S'), try_strptime({_RFC}, '%d %b %Y %H:%M'))"
RFC_DATES = f"""dated AS (SELECT *, {_LOCAL} AS local, {_OFFSET} AS off FROM entries)"""
_RFC_ISO = "strftime(local, '%Y-%m-%dT%H:%M:%S') || coalesce(substr(off, 1, 3) || ':' || substr(off, 4, 2), '')"


@query(
    "mail_dates",
    f"""WITH {I.ENTRIES}, {RFC_DATES}
SELECT entry_no, {_RFC_ISO} AS iso_text,
  strftime(local - to_minutes(CAST(CASE WHEN off LIKE '-%' THEN -1 ELSE 1 END * (CAST(substr(off, 2, 2) AS INTEGER) * 60 + CAST(substr(off, 4, 2) AS INTEGER)) AS INTEGER)), '%Y-%m-%d %H:%M:%S') AS utc_text
FROM dated""",
)
def mail_dates(spark, d):
    published = F.col("published")
    return I.entries(spark, d).select(
        "entry_no",
        dates.rfc822_iso(published).alias("iso_text"),
        F.date_format(dates.rfc822_timestamp(published), "yyyy-MM-dd HH:mm:ss").alias("utc_text"),
    )


@query(
    "publication_time",
    f"""WITH {I.ENTRIES}, {RFC_DATES} SELECT entry_no, coalesce({_RFC_ISO}, CASE WHEN entry_no % 2 = 0 THEN '2025-07-06T05:04:03+00:00' END) AS published_iso FROM dated""",
)
def publication_time(spark, d):
    page_date = F.when(F.col("entry_no") % 2 == 0, "Sun, 06 Jul 2025 05:04:03 GMT").otherwise("2025-07-06")
    return I.entries(spark, d).select(
        "entry_no", dates.publication_iso(F.col("published"), page_date).alias("published_iso")
    )


_TS = "%Y-%m-%d %H:%M:%S"
# Text with an offset is turned to UTC; the result does not depend on the session's zone.
_SQL_UTC = (
    "CASE WHEN regexp_matches({c}, 'T.*[+-]\\d{{2}}:?\\d{{2}}$') "
    "THEN TRY_CAST({c} AS TIMESTAMPTZ) AT TIME ZONE 'UTC' ELSE TRY_CAST({c} AS TIMESTAMP) END"
)
SQL_LENIENT = "CASE WHEN regexp_matches({c}, '^\\d{{4}}-\\d{{2}}-\\d{{2}}') THEN " + _SQL_UTC + " END"
SQL_FEED_TS = (
    "CASE WHEN regexp_matches({c}, '^\\d{{4}}-\\d{{2}}-\\d{{2}}T\\d{{2}}:\\d{{2}}:\\d{{2}}[+-]\\d{{2}}:?\\d{{2}}$') THEN "
    + _SQL_UTC
    + " END"
)


@query(
    "lenient_dates",
    f"""WITH {I.LINES} SELECT copy_no, doc_id, strftime({SQL_LENIENT.format(c='"datetime"')}, '{_TS}') AS ts_text,
  strftime({SQL_LENIENT.format(c='"date"')}, '%Y-%m-%d') AS day_text FROM lines""",
)
def lenient_dates(spark, d):
    return I.lines(spark, d).select(
        "copy_no",
        "doc_id",
        F.date_format(dates.lenient_timestamp(F.col("datetime")), "yyyy-MM-dd HH:mm:ss").alias("ts_text"),
        dates.lenient_date(F.col("date")).cast("string").alias("day_text"),
    )


@query(
    "feed_datetimes",
    f"""WITH {I.LINES}, m AS (SELECT *, coalesce("datetime", "date" || 'T00:00:00+00:00') AS moment FROM lines)
SELECT copy_no, doc_id, strftime({SQL_FEED_TS.format(c='moment')}, '{_TS}') AS ts_text FROM m""",
)
def feed_datetimes(spark, d):
    return I.lines(spark, d).select(
        "copy_no",
        "doc_id",
        F.date_format(dates.feed_timestamp(F.col("datetime"), F.col("date")), "yyyy-MM-dd HH:mm:ss").alias("ts_text"),
    )


@query("hash_shards", """SELECT doc_id, CAST(CAST('0x' || substr(sha256(CAST(doc_id AS VARCHAR)), 1, 8) AS BIGINT) % 8 AS BIGINT) AS shard FROM documents""")
def hash_shards(spark, d):
    return I.table(spark, d, "documents").select("doc_id", vectors.shard_of(F.col("doc_id"), 8).alias("shard"))


@query(
    "vector_normalise",
    """SELECT vec_id, round(sqrt(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE) * x))), 6) AS length,
  round(list_cosine_similarity(CAST(embedding AS DOUBLE[]), list_reverse(CAST(embedding AS DOUBLE[]))), 6) + 0.0 AS mirror_cosine FROM embeddings""",
)
def vector_normalise(spark, d):
    v = F.col("embedding")
    return I.table(spark, d, "embeddings").select(
        "vec_id",
        F.round(vectors.norm(v), 6).alias("length"),
        (F.round(vectors.cosine(v, F.reverse(v)), 6) + F.lit(0.0)).alias("mirror_cosine"),
    )


_BROKEN = "CASE WHEN event_id % 7 = 0 THEN substr(props, 1, length(props) - 1) WHEN event_id % 11 = 0 THEN '' ELSE props END"


@query(
    "json_object_parse",
    f"""SELECT event_id, CASE WHEN json_valid(p) THEN CAST(json_extract_string(p, '$.k') AS BIGINT) ELSE -1 END AS k, NOT json_valid(p) AS broken
FROM (SELECT event_id, {_BROKEN} AS p FROM events) AS e WHERE p <> ''""",
)
def json_object_parse(spark, d):
    n, props = F.col("event_id"), F.col("props")
    cut = F.expr("substring(props, 1, length(props) - 1)")
    events = I.table(spark, d, "events").select(
        "event_id", F.when(n % 7 == 0, cut).when(n % 11 == 0, "").otherwise(props).alias("p")
    )
    parsed = events.where("p <> ''").withColumn(
        "j", F.from_json("p", "k bigint, _broken string", {"columnNameOfCorruptRecord": "_broken"})
    )
    broken = F.col("j._broken").isNotNull()
    return parsed.select(
        "event_id", F.when(broken, F.lit(-1)).otherwise(F.col("j.k")).alias("k"), broken.alias("broken")
    )


@query("month_buckets", "SELECT event_id, strftime(date_trunc('month', ts), '%Y-%m-%d') AS month FROM events")
def month_buckets(spark, d):
    return I.table(spark, d, "events").select(
        "event_id", F.date_format(dates.month_start(F.col("ts")), "yyyy-MM-dd").alias("month")
    )


@query(
    "clean_key_fields",
    f"""WITH {I.LINES} SELECT copy_no, doc_id, lower(trim("domain")) AS "domain", lower(trim(lang)) AS lang, trim(url) AS url FROM lines""",
)
def clean_key_fields(spark, d):
    return I.lines(spark, d).select(
        "copy_no",
        "doc_id",
        text.clean_key(F.col("domain")).alias("domain"),
        text.clean_key(F.col("lang")).alias("lang"),
        text.strip(F.col("url")).alias("url"),
    )


@query("strip_www_hosts", f"SELECT page_id, regexp_replace({I.sql_netloc('url')}, '^www\\.', '') AS host FROM pages")
def strip_www_hosts(spark, d):
    return I.table(spark, d, "pages").select("page_id", urls.strip_www(urls.netloc(F.col("url"))).alias("host"))
