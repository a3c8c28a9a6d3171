"""Landed feed documents: RSS and Atom files, one file per feed fetch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from newsflow import settings
from newsflow.functions.dates import rfc822_timestamp
from newsflow.functions.text import is_filled, strip
from newsflow.functions.urls import (
    clean_url,
    domain_from_url,
    host_in_allow_list,
    is_article_url,
    link_matches,
    netloc_or_unknown,
    own_domains,
    registrable_part,
    with_publisher_groups,
)
from newsflow.operators.dedup import first_n_per_key, last_value

_RSS = (
    "channel struct<title: string, item: array<struct<"
    "title: string, link: string, published: string, pubDate: string, updated: string, language: string>>>"
)
# RSS 1.0: items stand beside their channel.
_RDF = "channel struct<title: string>, item array<struct<title: string, link: string, date: string, language: string>>"
_ATOM = (
    "title string, entry array<struct<"
    "title: string, link: array<struct<_href: string, _rel: string>>, published: string, updated: string>>"
)


def _documents(spark: SparkSession, path: str, row_tag: str, schema: str, **options: str) -> DataFrame:
    reader = spark.read.format("xml").option("rowTag", row_tag).option("recursiveFileLookup", True)
    return reader.option("ignoreNamespace", True).options(**options).schema(schema).load(path)


def _feed_name(file: str = "_metadata.file_name"):
    """A feed is landed as ``<url-encoded feed address>.xml``; Spark encodes file names once more."""
    return F.try_url_decode(F.try_url_decode(F.regexp_replace(F.col(file), r"\.xml$", "")))


def read_feeds(spark: SparkSession, path: str) -> DataFrame:
    """Entries of the landed feeds in document order.

    ``feed_url, feed_title, entry_no, link, title, published, language``; the
    date is the first of published, pubDate and updated that is given. RSS,
    Atom and RSS 1.0 are read; ``feed_rejects`` names what is none of them.
    """
    rss = _documents(spark, path, "rss", _RSS).select(
        _feed_name().alias("feed_url"),
        F.col("channel.title").alias("feed_title"),
        F.posexplode("channel.item").alias("entry_no", "item"),
    )
    rss = rss.select(
        "feed_url", "feed_title", "entry_no", "item.link", "item.title",
        F.coalesce("item.published", "item.pubDate", "item.updated").alias("published"),
        "item.language",
    )
    atom = _documents(spark, path, "feed", _ATOM).select(
        _feed_name().alias("feed_url"),
        F.col("title").alias("feed_title"),
        F.posexplode("entry").alias("entry_no", "entry"),
    )
    main_links = F.filter("entry.link", lambda x: x["_rel"].isNull() | (x["_rel"] == "alternate"))
    atom = atom.select(
        "feed_url", "feed_title", "entry_no",
        F.get(main_links, 0)["_href"].alias("link"),
        "entry.title",
        F.coalesce("entry.published", "entry.updated").alias("published"),
        F.lit(None).cast("string").alias("language"),
    )
    rdf = _documents(spark, path, "RDF", _RDF).select(
        _feed_name().alias("feed_url"),
        F.col("channel.title").alias("feed_title"),
        F.posexplode("item").alias("entry_no", "item"),
    )
    rdf = rdf.select("feed_url", "feed_title", "entry_no", "item.link", "item.title", F.col("item.date").alias("published"), "item.language")
    return rss.unionByName(atom).unionByName(rdf)


def feed_rejects(spark: SparkSession, path: str) -> DataFrame:
    """``feed_url, bytes, reason`` of the landed documents that hold no feed that can be read.

    The reason is ``empty``, ``no_feed`` (no element of a known kind) or
    ``broken`` (one that does not end, or is not XML).
    """
    found = []
    for tag, schema, part in (("rss", _RSS, "channel"), ("feed", _ATOM, "entry"), ("RDF", _RDF, "item")):
        read = _documents(spark, path, tag, f"{schema}, _broken string", columnNameOfCorruptRecord="_broken")
        # Spark does not read the column of broken records alone.
        whole = F.col("_broken").isNull() & (F.xxhash64(part) != 0)
        found.append(read.where(whole).select(F.col("_metadata.file_path").alias("file")))
    good = found[0].unionByName(found[1]).unionByName(found[2]).distinct()
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    landed = files.select(F.col("_metadata.file_path").alias("file"), _feed_name().alias("feed_url"), F.col("length").alias("bytes"), "content")
    rejects = landed.join(good, "file", "left_anti")
    some = F.decode("content", "UTF-8").rlike(r"<(?:rss|feed|rdf:RDF)[\s>]")
    rejects = rejects.select("feed_url", "bytes", F.when(some, "broken").otherwise("no_feed").alias("reason"))
    # Spark reads no empty files, but lists them, one name per feed.
    listed = spark.createDataFrame([(f.rsplit("/", 1)[-1],) for f in files.inputFiles()], "name string")
    empty = listed.select(_feed_name("name").alias("feed_url")).join(landed.select("feed_url"), "feed_url", "left_anti")
    return rejects.unionByName(empty.select("feed_url", F.lit(0).cast("bigint").alias("bytes"), F.lit("empty").alias("reason")))


def reject_counts(rejects: DataFrame) -> DataFrame:
    return rejects.groupBy("reason").agg(F.count("*").alias("documents"))


def first_entries(entries: DataFrame, n: int = settings.MAX_ENTRIES_PER_FEED) -> DataFrame:
    """The first entries of every feed."""
    return first_n_per_key(entries, "feed_url", "entry_no", n)


def with_expected_domains(df: DataFrame, groups=settings.PUBLISHER_GROUPS) -> DataFrame:
    """Add the host of ``feed_url`` and the domains the feed may link to.

    The steps are columns of their own, so that Spark computes each once.
    """
    return (
        df.withColumn("feed_host", domain_from_url(F.col("feed_url")))
        .withColumn("expected", own_domains(F.col("feed_host")))
        .withColumn("expected", with_publisher_groups(F.col("expected"), groups))
    )


def feed_dimension(entries: DataFrame, groups=settings.PUBLISHER_GROUPS) -> DataFrame:
    """One row per feed with the domains it may link to."""
    return with_expected_domains(entries.select("feed_url").distinct(), groups)


def mark_entries(
    entries: DataFrame,
    denied=settings.DENIED_URL_PARTS,
    allowed=settings.ALLOWED_DOMAINS,
    groups=settings.PUBLISHER_GROUPS,
    proxies=settings.PROXY_FEED_HOSTS,
) -> DataFrame:
    """Clean the links and say which check each entry fails, or ``candidate``.

    A link must belong to the publisher of its feed; for feeds served by a
    proxy host, to the allow-list. The stage passes through a generator, so a
    filter on it is not copied below, where all checks would run twice.
    """
    hosts = (
        with_expected_domains(entries, groups)
        .withColumn("url", clean_url(strip(F.coalesce("link", F.lit("")))))
        .withColumn("_host", domain_from_url(F.col("url")))
        .withColumn("_registered", registrable_part(F.col("_host")))
    )
    host = F.col("_host")
    publisher = (
        F.when(host == settings.DEFAULT_DOMAIN, F.lit(False))
        .when(F.col("feed_host").isin(*proxies), host_in_allow_list(host, allowed))
        .otherwise(link_matches(host, F.col("_registered"), F.col("expected")))
    )
    stage = (
        F.when(~is_filled(F.col("url")), "no_link")
        .when(~is_article_url(F.col("url"), denied), "url_filtered_out")
        .when(~publisher, "domain_filtered_out")
        .otherwise("candidate")
    )
    return hosts.select(*entries.columns, "url", F.explode(F.array(stage)).alias("entry_stage"))


def candidates(marked: DataFrame) -> DataFrame:
    """One row per feed and link; the last entry of a link gives its date."""
    kept = marked.where("entry_stage = 'candidate'")
    return last_value(kept, ["feed_url", "url"], "published", "entry_no")


def legacy_articles(entries: DataFrame) -> DataFrame:
    """Entries as records of the legacy article table."""
    blank = lambda c: F.nullif(strip(c), F.lit(""))
    link = strip(F.coalesce("link", F.lit("")))
    records = entries.where(link != "").select(
        F.coalesce("feed_title", "feed_url").alias("source"),
        F.coalesce(blank(F.col("title")), link).alias("title"),
        link.alias("url"),
        rfc822_timestamp(F.col("published")).alias("published_at"),
        F.lit("rss").alias("origin"),
        "language",
    )
    return normalise_records(records)


def normalise_records(records: DataFrame) -> DataFrame:
    """Trim a legacy record, fill its defaults and add its hash and collection time."""
    blank = lambda c: F.nullif(strip(F.col(c)), F.lit(""))
    return records.select(
        F.coalesce(blank("source"), netloc_or_unknown(F.col("url"))).alias("source"),
        F.coalesce(blank("title"), F.col("url")).alias("title"),
        strip(F.col("url")).alias("url"),
        "published_at",
        F.current_timestamp().alias("collected_at"),
        "origin",
        strip(F.col("language")).alias("language"),
    ).withColumn("hash", F.sha2(F.coalesce(blank("url"), F.lower(strip(F.col("title")))), 256))


def feed_health(domains: DataFrame, entries: DataFrame) -> DataFrame:
    """Which domains have a landed feed, and how many entries it holds.

    ``domains`` has ``domain, feed_url``. Domains with a feed come first.
    """
    counts = entries.groupBy("feed_url").agg(
        F.count("*").alias("entries"), F.max("feed_title").alias("feed_title")
    )
    joined = domains.join(counts, "feed_url", "left")
    found = F.col("entries").isNotNull()
    return joined.select(
        "domain",
        found.alias("rss_found"),
        F.when(found, F.col("feed_url")).alias("feed_url"),
        F.coalesce("entries", F.lit(0)).alias("entries"),
        "feed_title",
    ).orderBy(F.desc("rss_found"), F.desc("entries"), F.asc("domain"))


def feed_health_totals(health: DataFrame) -> DataFrame:
    return health.agg(
        F.count_distinct("domain").alias("domains_total"),
        F.count_if("rss_found").alias("domains_with_rss"),
    )
