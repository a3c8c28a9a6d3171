"""Views over the given tables that stand in for news data, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from newsflow.functions.text import sha256_hex

# Lists used over the given tables, whose hosts all lie below example.com, .net and .org.
DENIED = ("cheap-pills", "/de/")
ALLOWED = ("www.ththen.example.com", "example.net", "spam-farm.example.org", "therin")
GROUPS = (("ththen.example.com", "ththen.example.org", "ththen.example.net"), ("ththe", "example.org"))
PROXIES = ("therou.example.com", "m.therou.example.com")
LANGS = ("en", "fr")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def lines(spark: SparkSession, folder: str) -> DataFrame:
    """Landed article lines: every document, then a copy under the URL of its group of ten.

    Domain, date, title and text have the gaps and bad values real lines have.
    """
    docs = table(spark, folder, "documents")
    both = docs.withColumn("copy_no", F.lit(0)).unionByName(docs.withColumn("copy_no", F.lit(1)))
    key = F.when(F.col("copy_no") == 0, F.col("doc_id")).otherwise(F.col("doc_id") - F.col("doc_id") % 10)
    host = F.concat(F.lit("site"), (key % 17).cast("string"), F.lit(".Example.com"))
    day = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("doc_id") % 365).cast("int")).cast("string")
    by = lambda n, r: F.col("doc_id") % n == r
    return both.select(
        "copy_no",
        "doc_id",
        F.concat(F.lit("https://www."), host, F.lit("/news/"), key.cast("string")).alias("url"),
        F.when(by(4, 0), F.lit(None)).when(by(4, 1), "").otherwise(F.concat(F.lit("WWW."), host)).alias("domain"),
        F.when(by(6, 0), F.lit(None)).otherwise(F.substring_index("text", "\n", 1)).alias("title"),
        F.when(by(9, 0), "not a date").when(by(9, 1), F.lit(None)).otherwise(day).alias("date"),
        F.when(by(7, 0), F.lit(None))
        .when(by(7, 1), F.concat(day, F.lit("T10:20:30")))
        .when(by(7, 2), F.concat(day, F.lit("T10:20:30-05:30")))
        .otherwise(F.concat(day, F.lit("T10:20:30+00:00")))
        .alias("datetime"),
        F.lit(None).cast("string").alias("author"),
        "lang",
        F.when(by(50, 7), F.lit(None)).when(by(50, 8), "").otherwise(F.col("text")).alias("text"),
    )


_KEY = "(CASE WHEN copy_no = 0 THEN doc_id ELSE doc_id - doc_id % 10 END)"
_HOST = f"'site' || ({_KEY} % 17) || '.Example.com'"
_DAY = "strftime(DATE '2024-01-01' + CAST(doc_id % 365 AS INTEGER), '%Y-%m-%d')"
LINES = f"""lines AS (
  SELECT copy_no, doc_id,
    'https://www.' || {_HOST} || '/news/' || {_KEY} AS url,
    CASE doc_id % 4 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE 'WWW.' || {_HOST} END AS "domain",
    CASE WHEN doc_id % 6 = 0 THEN NULL ELSE split_part(text, chr(10), 1) END AS title,
    CASE doc_id % 9 WHEN 0 THEN 'not a date' WHEN 1 THEN NULL ELSE {_DAY} END AS "date",
    CASE doc_id % 7 WHEN 0 THEN NULL WHEN 1 THEN {_DAY} || 'T10:20:30'
      WHEN 2 THEN {_DAY} || 'T10:20:30-05:30' ELSE {_DAY} || 'T10:20:30+00:00' END AS "datetime",
    CAST(NULL AS VARCHAR) AS author, lang,
    CASE doc_id % 50 WHEN 7 THEN NULL WHEN 8 THEN '' ELSE text END AS text
  FROM (SELECT *, 0 AS copy_no FROM documents UNION ALL SELECT *, 1 AS copy_no FROM documents) AS twice)"""


def articles(spark: SparkSession, folder: str) -> DataFrame:
    """Stored articles: one per document, titles missing from some."""
    docs = table(spark, folder, "documents")
    return docs.select(
        "doc_id",
        sha256_hex(F.concat(F.lit("article-"), F.col("doc_id").cast("string"))).alias("article_id"),
        F.concat(F.col("source"), F.lit(".example.com")).alias("domain"),
        F.when(F.col("doc_id") % 6 == 0, F.lit(None)).otherwise(F.substring_index("text", "\n", 1)).alias("title"),
        F.when(F.col("doc_id") % 11 == 0, F.lit(None))
        .otherwise(F.expr("timestamp'2024-01-01 00:00:00' + make_dt_interval(cast(doc_id % 365 as int))"))
        .alias("datetime"),
        "lang",
        "text",
    )


ARTICLES = """articles AS (
  SELECT doc_id, sha256('article-' || doc_id) AS article_id, source || '.example.com' AS "domain",
    CASE WHEN doc_id % 6 = 0 THEN NULL ELSE split_part(text, chr(10), 1) END AS title,
    CASE WHEN doc_id % 11 = 0 THEN NULL
      ELSE TIMESTAMP '2024-01-01 00:00:00' + to_days(CAST(doc_id % 365 AS INTEGER)) END AS "datetime",
    lang, text
  FROM documents)"""


def embedded(spark: SparkSession, folder: str) -> DataFrame:
    """Ids of the articles that have an embedding: the labelled documents."""
    labels = table(spark, folder, "labels")
    return labels.select(
        "doc_id",
        sha256_hex(F.concat(F.lit("article-"), F.col("doc_id").cast("string"))).alias("article_id"),
        "quality",
    )


EMBEDDED = "embedded AS (SELECT doc_id, sha256('article-' || doc_id) AS article_id, quality FROM labels)"


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    """Archive paths, one per order, some outside the usual layout."""
    orders = table(spark, folder, "orders")
    month = F.date_format("o_orderdate", "yyyy/MM")
    name = F.concat(F.lit("NEWS-"), F.col("o_orderkey").cast("string"), F.lit(".warc.gz"))
    return orders.select(
        F.when(F.col("o_orderkey") % 20 == 0, F.concat(F.lit("other/"), name))
        .otherwise(F.concat(F.lit("crawl-data/CC-NEWS/"), month, F.lit("/"), name))
        .alias("warc_path"),
        month.alias("month"),
        "o_orderkey",
        "o_orderstatus",
        "o_totalprice",
    )


MANIFEST = """manifest AS (
  SELECT CASE WHEN o_orderkey % 20 = 0 THEN 'other/' ELSE 'crawl-data/CC-NEWS/' || month || '/' END
      || 'NEWS-' || o_orderkey || '.warc.gz' AS warc_path, month, o_orderkey, o_orderstatus, o_totalprice
  FROM (SELECT *, strftime(o_orderdate, '%Y/%m') AS month FROM orders) AS o)"""


def archive_ledger(spark: SparkSession, folder: str) -> DataFrame:
    """Ledger of the archives: F is done, P failed, O not started."""
    counted = F.col("o_orderstatus") == "F"
    return (
        manifest(spark, folder)
        .where("o_orderstatus <> 'O'")
        .select(
            "warc_path",
            "month",
            F.when(counted, "done").otherwise("failed").alias("status"),
            F.when(counted, F.floor("o_totalprice").cast("int")).otherwise(0).alias("rows_written"),
            F.when(counted, F.floor(F.col("o_totalprice") / 2).cast("int")).otherwise(0).alias("rows_inserted"),
        )
    )


LEDGER = f"""{MANIFEST},
ledger AS (
  SELECT warc_path, month, CASE WHEN o_orderstatus = 'F' THEN 'done' ELSE 'failed' END AS status,
    CASE WHEN o_orderstatus = 'F' THEN CAST(floor(o_totalprice) AS INTEGER) ELSE 0 END AS rows_written,
    CASE WHEN o_orderstatus = 'F' THEN CAST(floor(o_totalprice / 2) AS INTEGER) ELSE 0 END AS rows_inserted
  FROM manifest WHERE o_orderstatus <> 'O')"""


def entries(spark: SparkSession, folder: str) -> DataFrame:
    """Feed entries, one per page, in four feeds of which one is large.

    Links repeat within a feed; every fifth links to another publisher.
    """
    pages = table(spark, folder, "pages")
    return pages.select(
        F.when(F.col("page_id") % 3 == 0, "https://feeds.ththen.example.com/rss")
        .when(F.col("page_id") % 3 == 1, "https://www.rss.example.org/all.xml")
        .when(F.col("page_id") % 6 == 2, "http://m.therou.example.com/feed")
        .otherwise("https://api.example.net/feed?x=1")
        .alias("feed_url"),
        F.when(F.col("page_id") % 2 == 0, "A feed").alias("feed_title"),
        F.col("page_id").alias("entry_no"),
        F.when(F.col("page_id") % 13 == 0, "  ")
        .otherwise(F.concat(F.lit(" "), F.replace("url", F.lit("ref="), F.lit("traffic_source="))))
        .alias("link"),
        F.when(F.col("page_id") % 8 == 0, " ").otherwise(F.concat(F.lit(" title "), F.col("page_id"))).alias("title"),
        rfc822_text().alias("published"),
        F.when(F.col("page_id") % 4 == 0, " en ").alias("language"),
    )


def rfc822_text():
    """Mail dates of many shapes, by page number."""
    n = F.col("page_id")
    day = (n % 28 + 1).cast("string")
    month = F.element_at(
        F.array(*[F.lit(m) for m in "Jan Feb Mar Apr May Jun Jul Aug Sep Oct Nov Dec".split()]),
        (n % 12 + 1).cast("int"),
    )
    clock = F.concat(F.lpad((n % 24).cast("string"), 2, "0"), F.lit(":"), F.lpad((n % 60).cast("string"), 2, "0"))
    base = F.concat(day, F.lit(" "), month, F.lit(" 2025 "), clock)
    return (
        F.when(n % 9 == 0, F.lit(None))
        .when(n % 9 == 1, "2025-03-04T05:06:07")
        .when(n % 9 == 2, F.concat(F.lit("Mon, "), base, F.lit(":07 GMT")))
        .when(n % 9 == 3, F.concat(F.lit("Tue, "), base, F.lit(":08 EST")))
        .when(n % 9 == 4, F.concat(base, F.lit(":09 +0530")))
        .when(n % 9 == 5, F.concat(F.lit("Wed, "), base, F.lit(" -0800")))
        .otherwise(F.concat(F.lit("Sun, "), base, F.lit(":11 +0000")))
    )


_BASE = (
    "(page_id % 28 + 1) || ' ' || list_extract(['Jan','Feb','Mar','Apr','May','Jun','Jul','Aug','Sep','Oct','Nov','Dec'],"
    " CAST(page_id % 12 + 1 AS INTEGER)) || ' 2025 ' || lpad(CAST(page_id % 24 AS VARCHAR), 2, '0') || ':'"
    " || lpad(CAST(page_id % 60 AS VARCHAR), 2, '0')"
)
RFC822_TEXT = f"""CASE page_id % 9 WHEN 0 THEN NULL WHEN 1 THEN '2025-03-04T05:06:07'
      WHEN 2 THEN 'Mon, ' || {_BASE} || ':07 GMT' WHEN 3 THEN 'Tue, ' || {_BASE} || ':08 EST'
      WHEN 4 THEN {_BASE} || ':09 +0530' WHEN 5 THEN 'Wed, ' || {_BASE} || ' -0800'
      ELSE 'Sun, ' || {_BASE} || ':11 +0000' END"""

ENTRIES = f"""entries AS (
  SELECT CASE WHEN page_id % 3 = 0 THEN 'https://feeds.ththen.example.com/rss'
      WHEN page_id % 3 = 1 THEN 'https://www.rss.example.org/all.xml'
      WHEN page_id % 6 = 2 THEN 'http://m.therou.example.com/feed'
      ELSE 'https://api.example.net/feed?x=1' END AS feed_url,
    CASE WHEN page_id % 2 = 0 THEN 'A feed' END AS feed_title,
    page_id AS entry_no,
    CASE WHEN page_id % 13 = 0 THEN '  ' ELSE ' ' || replace(url, 'ref=', 'traffic_source=') END AS link,
    CASE WHEN page_id % 8 = 0 THEN ' ' ELSE ' title ' || page_id END AS title,
    {RFC822_TEXT} AS published,
    CASE WHEN page_id % 4 = 0 THEN ' en ' END AS language
  FROM pages)"""


# SQL text of the URL functions.
def sql_netloc(url: str) -> str:
    return f"regexp_extract({url}, '^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//([^/?#]*)', 1)"


def sql_strip(text: str) -> str:
    return rf"regexp_replace({text}, '^[\s\x0b\x1c-\x1f\x{{85}}\x{{a0}}\x{{1680}}\x{{2000}}-\x{{200a}}\x{{2028}}\x{{2029}}\x{{202f}}\x{{205f}}\x{{3000}}]+|[\s\x0b\x1c-\x1f\x{{85}}\x{{a0}}\x{{1680}}\x{{2000}}-\x{{200a}}\x{{2028}}\x{{2029}}\x{{202f}}\x{{205f}}\x{{3000}}]+$', '', 'g')"


def sql_domain(url: str) -> str:
    u = f"trim(coalesce({url}, ''))"
    host = f"coalesce(nullif({sql_netloc(u)}, ''), regexp_extract({u}, '^([^/?#]*)', 1))"
    return f"coalesce(nullif(regexp_replace(trim(lower({host})), '^www\\.', ''), ''), 'unknown')"


def sql_registrable(host: str) -> str:
    """Of a lower-case host without ``www.``."""
    parts = f"string_split({host}, '.')"
    suffixes = ["co.uk", "org.uk", "ac.uk", "gov.uk", "com.au", "co.nz", "co.za"]
    test = " OR ".join(f"{host} LIKE '%.{s}'" for s in suffixes)
    return f"array_to_string(list_slice({parts}, CASE WHEN {test} THEN -3 ELSE -2 END, -1), '.')"


def sql_contains_any(text: str, literals) -> str:
    return "(" + " OR ".join(f"contains({text}, '{x}')" for x in literals) + ")"


# Link of an entry without its tracking parameter; the other parameters of the pages are plain.
SQL_CLEAN_LINK = (
    "regexp_replace(regexp_replace(trim(link), '&traffic_source=[^&#]*', ''), '[?]traffic_source=[^&#]*', '')"
)
