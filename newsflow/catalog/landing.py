"""Landing files, archives, feeds, sinks, whole jobs and streams.

The files are derived from the given tables by Spark and written below the
shared folder; every call uses a folder of its own.
"""

from __future__ import annotations

import gzip
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from newsflow import schemas, settings
from newsflow.catalog import inputs as I
from newsflow.catalog.registry import query
from newsflow.catalog.scalars import SQL_FEED_TS, SQL_LENIENT
from newsflow.catalog.tables import _FILLED, _HASH, shown
from newsflow.catalog.texts import _OUTCOME, PAGE_TEXT
from newsflow.functions import text, urls
from newsflow.operators import gate, unify
from newsflow.operators.dedup import first_per_key
from newsflow.plans import backfill, embedding_refresh, feed_cycle
from newsflow.session import work_dir
from newsflow.sources import archives, feeds, files, tables
from newsflow.sources.archives import filesystem_of
from newsflow.streaming import landing as streams

# Pages per synthesised archive and entries per synthesised feed document.
_PAGES_PER_ARCHIVE = 50
_ENTRIES_PER_FEED = 40


def _write_named(df: DataFrame, root: str) -> None:
    """Write each row's ``content`` to the file ``name`` below ``root``, inside the tasks."""

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, content in zip(batch["name"], batch["content"]):
                filesystem, path = filesystem_of(f"{root}/{name}")
                filesystem.create_dir(path.rsplit("/", 1)[0], recursive=True)
                with filesystem.open_output_stream(path, compression=None) as out:
                    out.write(content)
            yield pd.DataFrame({"files": [len(batch)]})

    df.select("name", "content").mapInPandas(write, "files bigint").agg(F.sum("files")).collect()


def archive_paths(pages: DataFrame) -> DataFrame:
    number = F.floor(F.col("page_id") / _PAGES_PER_ARCHIVE).cast("string")
    month = F.concat(F.lit("crawl-data/CC-NEWS/2025/"), F.lpad(((F.floor(F.col("page_id") / 100)) % 3 + 1).cast("string"), 2, "0"))
    return pages.withColumn("warc_path", F.concat(month, F.lit("/NEWS-"), number, F.lit(".warc.gz")))


SQL_ARCHIVE = f"'crawl-data/CC-NEWS/2025/' || lpad(CAST((page_id // 100) % 3 + 1 AS VARCHAR), 2, '0') || '/NEWS-' || (page_id // {_PAGES_PER_ARCHIVE}) || '.warc.gz'"


def write_archives(spark, d, root: str) -> DataFrame:
    """Archives with one gzip member per record: a request and a response for every page."""

    def member(kind: str, url: str, block: bytes) -> bytes:
        head = f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Target-URI: {url}\r\nContent-Length: {len(block)}\r\n\r\n"
        return gzip.compress(head.encode() + block + b"\r\n\r\n", compresslevel=1)

    def build(rows: pd.DataFrame) -> pd.DataFrame:
        parts = []
        for row in rows.sort_values("page_id").itertuples():
            parts.append(member("request", row.url, b"GET / HTTP/1.1\r\n\r\n"))
            body = row.html.encode("utf-8")
            head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n"
            if row.page_id % 3 == 1:
                body, head = gzip.compress(body, compresslevel=1), head + b"Content-Encoding: gzip\r\n"
            if row.page_id % 3 == 2:
                half = len(body) // 2
                chunks = [body[:half], body[half:], b""]
                body = b"".join(b"%x\r\n" % len(c) + c + b"\r\n" for c in chunks)
                head += b"Transfer-Encoding: chunked\r\n"
            parts.append(member("response", row.url, head + b"\r\n" + body))
        return pd.DataFrame({"name": [rows["warc_path"].iloc[0]], "content": [b"".join(parts)]})

    pages = archive_paths(I.table(spark, d, "pages"))
    built = pages.groupBy("warc_path").applyInPandas(build, "name string, content binary")
    _write_named(built, root)
    manifest = pages.select(F.col("warc_path").alias("name")).distinct().repartition(1)
    manifest.select("name").write.option("compression", "gzip").text(f"{root}/manifest")
    return archives.read_manifest(spark, f"{root}/manifest")


@query("archive_manifest", f"SELECT DISTINCT {SQL_ARCHIVE} AS warc_path, '2025/' || lpad(CAST((page_id // 100) % 3 + 1 AS VARCHAR), 2, '0') AS month FROM pages")
def archive_manifest(spark, d):
    return write_archives(spark, d, work_dir(spark, "archives"))


@query(
    "archive_records",
    f"""SELECT {SQL_ARCHIVE} AS warc_path, page_id % {_PAGES_PER_ARCHIVE} * 2 + k AS record_no, CASE k WHEN 0 THEN 'request' ELSE 'response' END AS rec_type, url,
  CASE k WHEN 0 THEN -1 ELSE strlen(html) END AS payload_bytes, CASE k WHEN 0 THEN '-' ELSE sha256(html) END AS html_hash
FROM pages CROSS JOIN (SELECT unnest([0, 1]) AS k) AS two""",
)
def archive_records(spark, d):
    root = work_dir(spark, "archives")
    records = archives.decode_payload(archives.read_archives(write_archives(spark, d, root), root))
    return records.select(
        "warc_path", "record_no", "rec_type", "url",
        F.coalesce("payload_bytes", F.lit(-1)).cast("bigint").alias("payload_bytes"),
        F.coalesce(text.sha256_hex(F.col("html")), F.lit("-")).alias("html_hash"),
    )


@query("archive_responses", "SELECT page_id, url FROM pages")
def archive_responses(spark, d):
    root = work_dir(spark, "archives")
    records = archives.read_archives(write_archives(spark, d, root), root)
    responses = records.where((F.col("rec_type") == "response") & text.is_filled(F.col("url")))
    number = F.regexp_extract("warc_path", r"NEWS-(\d+)\.", 1).cast("bigint") * _PAGES_PER_ARCHIVE
    return responses.select((number + F.floor(F.col("record_no") / 2)).alias("page_id"), "url")


def write_feeds(spark, d, root: str) -> None:
    """Feed documents of the entries, in turn RSS, Atom, RSS and RSS 1.0; with each fifth one an unreadable document."""
    entries = I.entries(spark, d).withColumn("doc_no", F.floor(F.col("entry_no") / _ENTRIES_PER_FEED))
    esc = lambda c: F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    tag = lambda name, c: F.coalesce(F.concat(F.lit(f"<{name}>"), esc(F.col(c)), F.lit(f"</{name}>")), F.lit(""))
    rss = F.concat(F.lit("<item>"), tag("title", "title"), tag("link", "link"), tag("pubDate", "published"), F.lit("</item>"))
    atom = F.concat(
        F.lit("<entry>"), tag("title", "title"), F.lit('<link rel="self" href="x"/><link rel="alternate" href="'),
        esc(F.col("link")), F.lit('"/>'), tag("updated", "published"), F.lit("</entry>"),
    )
    rdf = F.concat(F.lit("<item>"), tag("title", "title"), tag("link", "link"), tag("dc:date", "published"), F.lit("</item>"))
    is_rss, is_atom = F.col("doc_no") % 2 == 0, F.col("doc_no") % 4 == 1
    items = entries.withColumn("item", F.when(is_rss, rss).when(is_atom, atom).otherwise(rdf))
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("entry_no", "item"))), lambda x: x["item"]), "\n")
    docs = items.groupBy("doc_no").agg(body.alias("body"))
    rss_doc = F.concat(F.lit('<?xml version="1.0"?><rss version="2.0"><channel><title>Feed '), F.col("doc_no"), F.lit("</title>\n"), F.col("body"), F.lit("</channel></rss>"))
    atom_doc = F.concat(F.lit('<?xml version="1.0"?><feed xmlns="http://www.w3.org/2005/Atom"><title>Feed '), F.col("doc_no"), F.lit("</title>\n"), F.col("body"), F.lit("</feed>"))
    rdf_doc = F.concat(
        F.lit('<?xml version="1.0"?><rdf:RDF xmlns:rdf="http://www.w3.org/1999/02/22-rdf-syntax-ns#" xmlns:dc="http://purl.org/dc/elements/1.1/" xmlns="http://purl.org/rss/1.0/"><channel><title>Feed '),
        F.col("doc_no"), F.lit("</title></channel>\n"), F.col("body"), F.lit("</rdf:RDF>"),
    )
    name = lambda *path: F.concat(F.url_encode(F.concat(F.lit("https://feeds.example.com/"), *path, F.col("doc_no"))), F.lit(".xml"))
    whole = F.when(is_rss, rss_doc).when(is_atom, atom_doc).otherwise(rdf_doc)
    bad = F.when(F.col("doc_no") % 15 == 0, "").when(F.col("doc_no") % 15 == 5, F.concat(F.lit("<html>"), F.col("doc_no"), F.lit("</html>")))
    bad = bad.otherwise(F.substring(whole, F.lit(1), F.floor(F.length(whole) / 2).cast("int")))
    named = docs.select(name().alias("name"), whole.cast("binary").alias("content"))
    broken = docs.where("doc_no % 5 = 0").select(name(F.lit("bad/")).alias("name"), bad.cast("binary").alias("content"))
    _write_named(named.unionByName(broken), root)


@query(
    "feed_scan",
    f"""WITH {I.ENTRIES} SELECT 'https://feeds.example.com/' || (entry_no // {_ENTRIES_PER_FEED}) AS feed_url, 'Feed ' || (entry_no // {_ENTRIES_PER_FEED}) AS feed_title,
  CAST(entry_no % {_ENTRIES_PER_FEED} AS INTEGER) AS entry_no, trim(link) AS link, trim(title) AS title, published FROM entries""",
)
def feed_scan(spark, d):
    root = work_dir(spark, "feeds")
    write_feeds(spark, d, root)
    return feeds.read_feeds(spark, root).select(
        "feed_url", "feed_title", "entry_no",
        F.coalesce(F.trim("link"), F.lit("")).alias("link"), F.coalesce(F.trim("title"), F.lit("")).alias("title"), "published",
    )


@query(
    "feed_rejects",
    f"""WITH {I.ENTRIES}, n AS (SELECT DISTINCT entry_no // {_ENTRIES_PER_FEED} AS doc_no FROM entries)
SELECT 'https://feeds.example.com/bad/' || doc_no AS feed_url, CASE doc_no % 15 WHEN 0 THEN 'empty' WHEN 5 THEN 'no_feed' ELSE 'broken' END AS reason FROM n WHERE doc_no % 5 = 0""",
)
def feed_rejects(spark, d):
    root = work_dir(spark, "feeds")
    write_feeds(spark, d, root)
    return feeds.feed_rejects(spark, root).select("feed_url", "reason")


def _three_formats(spark, d, root: str) -> None:
    rows = I.lines(spark, d).where("text <> ''")
    third = lambda n: rows.where(F.col("doc_id") % 3 == n)
    third(0).write.json(f"{root}/2024/01/json")
    third(1).write.parquet(f"{root}/2024/02/parquet")
    third(2).drop("author").write.option("header", True).option("escape", '"').csv(f"{root}/2024/03/csv")


@query(
    "mixed_tree_scan",
    f"""WITH {I.LINES} SELECT CAST(copy_no AS VARCHAR) AS copy_no, CAST(doc_id AS VARCHAR) AS doc_id, url, nullif("domain", '') AS "domain", "date", lang,
  sha256(text) AS text_hash FROM lines WHERE text <> ''""",
)
def mixed_tree_scan(spark, d):
    root = work_dir(spark, "tree")
    _three_formats(spark, d, root)
    columns = ["copy_no", "doc_id", "url", "domain", "date", "author", "lang", "text"]
    rows = files.scan_tree(spark, root, columns)
    return rows.select(
        "copy_no", "doc_id", "url", F.nullif("domain", F.lit("")).alias("domain"), "date", "lang",
        text.sha256_hex(F.col("text")).alias("text_hash"),
    )


@query("month_folder_rows", f"WITH {I.LINES} SELECT '2024/0' || (doc_id % 3 + 1) AS month, count(*) AS rows_found, count(DISTINCT url) AS unique_urls FROM lines WHERE text <> '' GROUP BY 1")
def month_folder_rows(spark, d):
    root = work_dir(spark, "tree")
    _three_formats(spark, d, root)
    rows = files.scan_tree(spark, root, ["url"])
    return rows.groupBy(files.month_of_path(F.col("source_file")).alias("month")).agg(
        F.count("*").alias("rows_found"), F.count_distinct("url").alias("unique_urls")
    )


@query(
    "file_metrics",
    f"""WITH {I.LINES} SELECT '2024/0' || (doc_id % 3 + 1) AS month, TRUE AS some_files, TRUE AS bytes_plausible, TRUE AS volume_agrees FROM lines WHERE text <> '' GROUP BY 1""",
)
def file_metrics(spark, d):
    """Months with files of more bytes than a tenth of a line each; sizes on disk are no matter of SQL."""
    root = work_dir(spark, "tree")
    _three_formats(spark, d, root)
    listing = files.file_listing(spark, root).where(F.col("suffix").isin("csv", "jsonl", "parquet"))
    volume = F.bround(F.col("bytes_found") / (1024.0 * 1024.0), 2)
    return files.file_metrics(listing).select(
        "month", (F.col("files_found") > 0).alias("some_files"), (F.col("bytes_found") > 1000).alias("bytes_plausible"), (F.col("volume_mb") == volume).alias("volume_agrees")
    )


@query("jsonl_text_scan", "SELECT CAST(doc_id AS VARCHAR) AS doc_id, lang, CAST(n_chars AS VARCHAR) AS n_chars, sha256(text) AS text_hash FROM documents")
def jsonl_text_scan(spark, d):
    root = work_dir(spark, "jsonl")
    I.table(spark, d, "documents").write.json(root)
    rows = files.scan_jsonl(spark, root, ["doc_id", "lang", "n_chars", "text", "absent"])
    return rows.where("absent IS NULL").select("doc_id", "lang", "n_chars", text.sha256_hex(F.col("text")).alias("text_hash"))


@query(
    "bulk_dataset_scan",
    f"""WITH {I.LINES} SELECT 'all_the_news' AS source_type, 'site' || regexp_extract(url, 'site(\\d+)', 1) || '.Example.com' AS "domain", title, url, 'en' AS lang,
  length(text) AS text_chars FROM lines WHERE text <> ''""",
)
def bulk_dataset_scan(spark, d):
    root = work_dir(spark, "bulk")
    I.lines(spark, d).where("text <> ''").withColumnRenamed("text", "article").drop("lang").write.parquet(root)
    part = unify.bulk_part(spark.read.parquet(root), [])
    return part.select("source_type", "domain", "title", "url", "lang", F.length("text").cast("bigint").alias("text_chars"))


@query(
    "landing_by_month",
    f"""WITH {I.LINES} SELECT coalesce(strftime({SQL_LENIENT.format(c='"date"')}, '%Y/%m'), strftime(now() AT TIME ZONE 'UTC', '%Y/%m')) AS month, count(*) AS landed,
  CAST(sum(coalesce(length(text), 0)) AS BIGINT) AS chars FROM lines GROUP BY 1""",
)
def landing_by_month(spark, d):
    root = work_dir(spark, "landing")
    tables.land_articles(tables.landing_line(I.lines(spark, d)), root)
    landed = spark.read.schema("text string, year string, month string").json(root)
    month = F.concat_ws("/", "year", "month")
    return landed.groupBy(month.alias("month")).agg(
        F.count("*").alias("landed"), F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("chars")
    )


@query(
    "landing_by_archive",
    f"""SELECT '2025' AS year, lpad(CAST((page_id // 100) % 3 + 1 AS VARCHAR), 2, '0') AS month, 'NEWS-' || (page_id // {_PAGES_PER_ARCHIVE}) || '.jsonl' AS archive, count(*) AS landed FROM pages GROUP BY ALL""",
)
def landing_by_archive(spark, d):
    root = work_dir(spark, "landing")
    tables.land_archive_lines(archive_paths(I.table(spark, d, "pages")).drop("html"), root)
    landed = spark.read.schema("page_id bigint, year string, month string, archive string").json(root)
    return landed.groupBy("year", "month", "archive").agg(F.count("*").alias("landed"))


@query("json_line_encode", "SELECT doc_id, sha256(lang || text) AS content FROM documents")
def json_line_encode(spark, d):
    coded = tables.to_json_lines(I.table(spark, d, "documents"))
    parsed = coded.select(F.from_json("value", "doc_id bigint, lang string, text string").alias("j"))
    return parsed.select("j.doc_id", F.sha2(F.concat("j.lang", "j.text"), 256).alias("content"))


_MERGED = f"""{I.LINES}, m AS (SELECT *, coalesce("datetime", "date" || 'T00:00:00+00:00') AS moment FROM lines WHERE {_FILLED}),
merged AS (SELECT sha256(url) AS article_id, min({_HASH}) AS text_hash, count(*) AS offered FROM m GROUP BY url)"""


@query("append_if_absent", f"WITH {_MERGED} SELECT count(*) AS stored, count(DISTINCT article_id) AS ids, count(*) AS first_inserted, 0 AS second_inserted FROM merged")
def append_if_absent(spark, d):
    path = work_dir(spark, "articles")
    batch = unify.feed_articles(I.lines(spark, d), extra=["copy_no", "doc_id"])
    order = [F.col("copy_no"), F.col("doc_id")]
    first = tables.append_if_absent(batch, path, order)
    second = tables.append_if_absent(batch, path, order)
    stored = tables.read_table(spark, path, schemas.ARTICLES)
    return stored.agg(
        F.count("*").alias("stored"),
        F.count_distinct("article_id").alias("ids"),
        F.lit(first["inserted_estimate"]).cast("bigint").alias("first_inserted"),
        F.lit(second["inserted_estimate"]).alias("second_inserted"),
    )


@query("snapshot_publish", "SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'new' ELSE 'old' END AS model_name FROM documents")
def snapshot_publish(spark, d):
    from newsflow.operators.merge import upsert_latest

    root = work_dir(spark, "snapshots")
    rows = I.table(spark, d, "documents").select(
        F.col("doc_id").cast("string").alias("article_id"),
        F.array(F.lit(1.0).cast("float")).alias("text_embedding"),
        F.lit("old").alias("model_name"),
        F.lit("2024-01-01").cast("timestamp").alias("updated_at"),
    )
    tables.publish_snapshot(rows, root, schemas.EMBEDDINGS)
    new = rows.where("article_id % 3 = 0").withColumn("model_name", F.lit("new"))
    stored = tables.read_snapshot(spark, root, schemas.EMBEDDINGS)
    tables.publish_snapshot(upsert_latest(stored, new, [F.desc("updated_at")]), root, schemas.EMBEDDINGS)
    state = tables.read_snapshot(spark, root, schemas.EMBEDDINGS)
    return state.select(F.col("article_id").cast("bigint").alias("doc_id"), "model_name")


def _job(spark, root: str) -> backfill.Backfill:
    return backfill.Backfill(
        archive_root=f"{root}/archives", landing=f"{root}/landing", articles=f"{root}/articles",
        archive_ledger=f"{root}/archive_ledger", month_ledger=f"{root}/month_ledger",
        denied=I.DENIED, allowed=(), langs=I.LANGS,
    )


_BACKFILLED = f"""{PAGE_TEXT}, good AS (SELECT *, {SQL_ARCHIVE} AS warc_path FROM page_text
  WHERE NOT {I.sql_contains_any('url', I.DENIED)} AND {_OUTCOME} = 'kept')"""


@query("month_backfill", f"WITH {_BACKFILLED} SELECT sha256(url) AS article_id, {_HASH} AS text_hash, 'ccnews' AS source_type, warc_path AS source_warc, {I.sql_netloc('url')} AS \"domain\", title, url, lang FROM good")
def month_backfill(spark, d):
    root = work_dir(spark, "backfill-run")
    job = _job(spark, root)
    manifest = write_archives(spark, d, job.archive_root)
    backfill.run_backfill(spark, manifest, job).collect()
    stored = tables.read_table(spark, job.articles, schemas.ARTICLES)
    return stored.select("article_id", "text_hash", "source_type", "source_warc", "domain", "title", "url", "lang")


@query(
    "resumed_backfill_ledger",
    f"""WITH {_BACKFILLED}, n AS (SELECT warc_path, CAST(count(*) AS INTEGER) AS n FROM good GROUP BY warc_path)
SELECT a.warc_path, 'done' AS status, coalesce(n, 0) AS rows_written, coalesce(n, 0) AS rows_inserted
FROM (SELECT DISTINCT {SQL_ARCHIVE} AS warc_path FROM pages) AS a LEFT JOIN n ON a.warc_path = n.warc_path""",
)
def resumed_backfill_ledger(spark, d):
    """A run over part of the archives, then one over the rest."""
    from dataclasses import replace

    root = work_dir(spark, "backfill-run")
    job = _job(spark, root)
    manifest = write_archives(spark, d, job.archive_root)
    backfill.run_backfill(spark, manifest, replace(job, max_archives=2)).collect()
    backfill.run_backfill(spark, manifest, job).collect()
    state = tables.read_snapshot(spark, job.archive_ledger, schemas.ARCHIVE_LEDGER)
    return state.select("warc_path", "status", "rows_written", "rows_inserted")


@query(
    "feed_cycle_articles",
    f"""WITH {PAGE_TEXT}, {I.ENTRIES}, l AS (SELECT DISTINCT {I.SQL_CLEAN_LINK} AS url FROM entries WHERE trim(link) <> ''),
p AS (SELECT *, regexp_replace(regexp_replace(url, '&ref=[^&#]*', ''), '[?]ref=[^&#]*', '') AS clean FROM page_text),
one AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY clean ORDER BY length(html), page_id) AS rn FROM p) AS r WHERE rn = 1),
kept AS (SELECT o.title, o.lang, o.text, l.url, {I.sql_domain('l.url')} AS host FROM l JOIN one o ON o.clean = l.url
  WHERE o.lang IN ('en', 'ru') AND length(o.text) >= 500 AND NOT {I.sql_contains_any('l.url', settings.DENIED_URL_PARTS)})
SELECT sha256(url) AS article_id, {_HASH} AS text_hash, 'rss' AS source_type, host AS "domain", title, url, lang FROM kept WHERE host LIKE '%.example.com'""",
)
def feed_cycle_articles(spark, d):
    root = work_dir(spark, "feed-cycle")
    write_feeds(spark, d, f"{root}/feeds")
    entries = feeds.read_feeds(spark, f"{root}/feeds")
    pages = I.table(spark, d, "pages").select(
        "page_id", urls.clean_url(F.replace("url", F.lit("ref="), F.lit("traffic_source="))).alias("url"), "html"
    )
    pages = first_per_key(pages, ["url"], [F.length("html"), F.col("page_id")])
    feed_cycle.run_cycle(spark, entries, pages, f"{root}/landing", f"{root}/articles")
    return tables.read_table(spark, f"{root}/articles", schemas.ARTICLES).select(
        "article_id", "text_hash", "source_type", "domain", "title", "url", "lang"
    )


@query("embedding_refresh", "SELECT sha256('article-' || doc_id) AS article_id, 'hashed-tokens-384' AS model_name, 384 AS dims FROM documents")
def embedding_refresh_run(spark, d):
    root = work_dir(spark, "embedding-store")
    articles = I.articles(spark, d)
    for shard in range(2):
        embedding_refresh.refresh_embeddings(spark, articles, root, shard=shard, shards=2)
    state = tables.read_table(spark, root, schemas.EMBEDDINGS)
    return state.select("article_id", "model_name", F.size("text_embedding").alias("dims"))


def _land_for_stream(spark, d, root: str, rows: DataFrame | None = None) -> DataFrame:
    rows = I.lines(spark, d) if rows is None else rows
    tables.land_articles(tables.landing_line(rows.select(*schemas.LANDED_ARTICLE_COLUMNS)), root)
    return streams.landed_lines(spark, root)


@query("stream_load", f"WITH {_MERGED} SELECT article_id FROM merged")
def stream_load(spark, d):
    """Two runs of the stream with new files, then one without."""
    root = work_dir(spark, "stream")
    for part in (0, 1):
        rows = I.lines(spark, d).where(F.col("doc_id") % 2 == part)
        source = _land_for_stream(spark, d, f"{root}/landing", rows)
        streams.load_stream(source, f"{root}/articles", f"{root}/checkpoint").awaitTermination()
    source = streams.landed_lines(spark, f"{root}/landing")
    streams.load_stream(source, f"{root}/articles", f"{root}/checkpoint").awaitTermination()
    return tables.read_table(spark, f"{root}/articles", schemas.ARTICLES).select("article_id")


@query("stream_replay_is_idempotent", f"WITH {_MERGED} SELECT count(*) AS articles, count(DISTINCT article_id) AS ids FROM merged")
def stream_replay(spark, d):
    """The same files through two checkpoints: the second run meets every article again."""
    root = work_dir(spark, "stream")
    source = _land_for_stream(spark, d, f"{root}/landing")
    for run in (1, 2):
        streams.load_stream(source, f"{root}/articles", f"{root}/checkpoint{run}").awaitTermination()
    stored = tables.read_table(spark, f"{root}/articles", schemas.ARTICLES)
    return stored.agg(F.count("*").alias("articles"), F.count_distinct("article_id").alias("ids"))


@query("stream_first_seen_links", f"WITH {I.LINES} SELECT DISTINCT sha256(url) AS article_id FROM lines")
def stream_first_seen(spark, d):
    root = work_dir(spark, "stream")
    unique = streams.first_seen_links(_land_for_stream(spark, d, f"{root}/landing")).select("article_id")
    run = (
        unique.writeStream.format("parquet").option("path", f"{root}/links")
        .option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start()
    )
    run.awaitTermination()
    return spark.read.schema("article_id string").parquet(f"{root}/links")


@query(
    "stream_month_counts",
    f"""WITH {I.LINES}, t AS (SELECT {SQL_LENIENT.format(c='coalesce("datetime", "date")')} AS ts FROM lines)
SELECT coalesce(strftime(date_trunc('month', ts), '%Y-%m'), '-') AS month, count(*) AS articles FROM t GROUP BY 1""",
)
def stream_month_counts(spark, d):
    root = work_dir(spark, "stream")
    for part in (0, 1):
        rows = I.lines(spark, d).where(F.col("doc_id") % 2 == part)
        source = _land_for_stream(spark, d, f"{root}/landing", rows)
        streams.month_counts_stream(source, f"{root}/months", f"{root}/checkpoint").awaitTermination()
    months = streams.read_month_counts(spark, f"{root}/months")
    return months.select(F.coalesce(F.date_format("month", "yyyy-MM"), F.lit("-")).alias("month"), "articles")


@query("stream_embeds_new_articles", f"WITH {_MERGED} SELECT article_id, 384 AS dims, 'hashed-tokens-384' AS model_name FROM merged")
def stream_embeds(spark, d):
    """Every loaded batch is followed by an embedding refresh."""
    root = work_dir(spark, "stream")
    source = _land_for_stream(spark, d, f"{root}/landing")

    def embed(articles):
        embedding_refresh.refresh_embeddings(articles.sparkSession, articles, f"{root}/vectors")

    streams.load_stream(source, f"{root}/articles", f"{root}/checkpoint", embed).awaitTermination()
    state = tables.read_table(spark, f"{root}/vectors", schemas.EMBEDDINGS)
    return state.select("article_id", F.size("text_embedding").alias("dims"), "model_name")
