"""Readers and writers on generated files."""

import gzip
import json
import os
import time
import zlib

import pytest
from pyspark.sql import functions as F

from newsflow import schemas
from newsflow.catalog.landing import write_archives
from newsflow.operators.gate import page_lang
from newsflow.operators.language import train_language_model
from newsflow.plans import backfill
from newsflow.session import materialise
from newsflow.sources import archives, feeds, files, tables
from newsflow.streaming import landing as landing_stream


def put(path, content):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(content if isinstance(content, bytes) else content.encode())


def test_tree_of_formats(spark, tmp_path):
    put(tmp_path / "2024/01/a.jsonl", '{"url": "u1", "n": 1}\n{"url": "u2", "n": 2}\n')
    put(tmp_path / "2024/01/empty.jsonl", "")
    put(tmp_path / "2024/02/b.CSV", 'url,n\nu3,x\n"u4","two\nlines"\n')
    put(tmp_path / "2024/02/empty.parquet", "")
    put(tmp_path / "notes.txt", "not read")
    spark.range(1).select(F.lit("u5").alias("url"), F.lit(1.5).alias("n")).write.parquet(str(tmp_path / "2024/03/p"))
    rows = files.scan_tree(spark, str(tmp_path))
    assert sorted((r.url, r.n) for r in rows.collect()) == [
        ("u1", "1"), ("u2", "2"), ("u3", "x"), ("u4", "two\nlines"), ("u5", "1.5"),
    ]
    picked = files.scan_tree(spark, str(tmp_path), ["url", "absent"])
    assert picked.columns == ["url", "absent", *files.READ_ORDER]
    ordered = [r.url for r in picked.where("source_file LIKE '%a.jsonl'").orderBy(*files.read_order()).collect()]
    assert ordered == ["u1", "u2"]
    months = files.file_metrics(files.file_listing(spark, str(tmp_path)).where("bytes > 0 AND suffix <> 'txt'"))
    assert {r.month for r in months.collect()} >= {"2024/01", "2024/02", "2024/03"}


def test_csv_headers_and_parquet_types_may_differ(spark, tmp_path):
    put(tmp_path / "a.csv", "url,title,text\nu1,t1,x1\n")
    put(tmp_path / "b[1].csv", "﻿title,url,text\nt2,u2,x2\n")
    put(tmp_path / "c.csv", 'url,text\nu3,"x3, more"\n')
    for name, kind in (("n", "bigint"), ("s", "string")):
        spark.range(7, 8).select(F.col("id").cast(kind).alias("url"), F.lit(name).alias("title")).write.parquet(str(tmp_path / name))
    expected = [("7", "n", None), ("7", "s", None), ("u1", "t1", "x1"), ("u2", "t2", "x2"), ("u3", None, "x3, more")]
    for columns in (["url", "title", "text"], None):
        rows = files.scan_tree(spark, str(tmp_path), columns)
        assert sorted(((r.url, r.title, r.text) for r in rows.collect()), key=str) == expected


def test_empty_tree(spark, tmp_path):
    put(tmp_path / "notes.txt", "x")
    assert files.scan_tree(spark, str(tmp_path), ["url"]).count() == 0


def test_expired_files_are_deleted_once(spark, tmp_path):
    for name, age in (("old.jsonl", 40), ("new.jsonl", 1)):
        put(tmp_path / name, "{}")
        then = time.time() - age * 86400
        os.utime(tmp_path / name, (then, then))
    expired = files.expired_files(files.file_listing(spark, str(tmp_path)), 30)
    assert files.delete_files(expired).first().deleted == 1
    assert [p.name for p in tmp_path.iterdir() if p.suffix == ".jsonl"] == ["new.jsonl"]


def test_manifest(spark, tmp_path):
    lines = "crawl-data/CC-NEWS/2025/03/NEWS-1.warc.gz\nelsewhere/NEWS-2.warc.gz\n"
    put(tmp_path / "warc.paths.gz", gzip.compress(lines.encode()))
    rows = archives.read_manifest(spark, str(tmp_path / "warc.paths.gz")).collect()
    assert sorted((r.warc_path[-13:], r.month) for r in rows) == [("EWS-1.warc.gz", "2025/03"), ("EWS-2.warc.gz", "unknown")]


def test_a_broken_archive_fails_alone_and_is_retried(spark, tmp_path):
    root = str(tmp_path / "archives")
    manifest = write_archives(spark, "/root/testdata/sf0.01", root)
    paths = sorted(r.warc_path for r in manifest.collect())
    broken, missing = tmp_path / "archives" / paths[0], tmp_path / "archives" / paths[1]
    good = {p: p.read_bytes() for p in (broken, missing)}
    broken.write_bytes(good[broken][: len(good[broken]) // 2])
    missing.rename(tmp_path / "kept-aside")
    job = backfill.Backfill(
        archive_root=root, landing=str(tmp_path / "landing"), articles=str(tmp_path / "articles"),
        archive_ledger=str(tmp_path / "ledger"), month_ledger=str(tmp_path / "months"), allowed=(), langs=("en", "fr"),
    )
    first = backfill.run_backfill(spark, manifest, job).first()
    assert first.failed == 2 and first.skipped_done == 0 and first.selected_total_warcs == len(paths)
    stored = tables.read_table(spark, job.articles, schemas.ARTICLES)
    before = stored.count()
    assert before == first.inserted_total and stored.where(F.col("source_warc").isin(paths[:2])).count() == 0
    for path, content in good.items():
        path.write_bytes(content)
    second = backfill.run_backfill(spark, manifest, job).first()
    assert second.failed == 0 and second.selected_total_warcs == 2 and second.skipped_done == len(paths) - 2
    stored = tables.read_table(spark, job.articles, schemas.ARTICLES)
    assert stored.count() == before + second.inserted_total == stored.select("article_id").distinct().count()
    months = tables.read_snapshot(spark, job.month_ledger, schemas.MONTH_LEDGER)
    assert months.agg(F.sum("total_warcs"), F.sum("done_warcs"), F.sum("failed_warcs")).first() == (len(paths), len(paths), 0)


def test_backfill_keeps_pages_over_a_million_bytes(spark, tmp_path):
    html = "<html lang='en'><head><title>T</title></head><body><article><p>" + "many words here " * 100_000 + "</p></article></body></html>"
    spark.createDataFrame([(1, "http://news.example.com/en/1", html)], "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    root = str(tmp_path / "archives")
    manifest = write_archives(spark, str(tmp_path), root)
    job = backfill.Backfill(
        archive_root=root, landing=str(tmp_path / "landing"), articles=str(tmp_path / "articles"),
        archive_ledger=str(tmp_path / "ledger"), month_ledger=str(tmp_path / "months"), allowed=(), langs=("en",),
    )
    assert backfill.run_backfill(spark, manifest, job).first().inserted_total == 1
    assert tables.read_table(spark, job.articles, schemas.ARTICLES).first().url == "http://news.example.com/en/1"


def test_backfill_with_a_language_model(spark, tmp_path):
    folder, root = "/root/testdata/sf0.001", str(tmp_path / "archives")
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("lang", "text")
    manifest = write_archives(spark, folder, root)
    job = backfill.Backfill(
        archive_root=root, landing=str(tmp_path / "landing"), articles=str(tmp_path / "articles"),
        archive_ledger=str(tmp_path / "ledger"), month_ledger=str(tmp_path / "months"), allowed=(),
        langs=("en", "fr", "de", "es"), max_rows_per_archive=1500,
    )
    backfill.run_backfill(spark, manifest, job, materialise(train_language_model(docs))).collect()
    stored = tables.read_table(spark, job.articles, schemas.ARTICLES).select("url", "lang")
    marked = spark.read.parquet(f"{folder}/pages.parquet").select("url", page_lang(F.col("html")).alias("mark"))
    rows = stored.join(marked, "url").collect()
    assert rows and sum(r.lang == r.mark for r in rows) >= 0.9 * len(rows)


def test_feed_documents(spark, tmp_path):
    rss = "<rss><channel><title>T</title><item><title> a </title><link> http://x.example.com/1 </link><pubDate>Mon, 20 Nov 1995 19:12:08 GMT</pubDate></item><item><link></link></item></channel></rss>"
    put(tmp_path / "https%3A%2F%2Fx.example.com%2Frss.xml", rss)
    entries = feeds.read_feeds(spark, str(tmp_path))
    assert [r.feed_url for r in entries.collect()] == ["https://x.example.com/rss"] * 2
    row = feeds.legacy_articles(entries).first()
    assert (row.source, row.title, row.url, row.origin) == ("T", "a", "http://x.example.com/1", "rss")
    assert str(row.published_at) == "1995-11-20 19:12:08"


def test_snapshots_ignore_an_unfinished_write(spark, tmp_path):
    root = str(tmp_path / "table")
    rows = spark.createDataFrame([("2025/01", 1, 0, 0)], "month string, total_warcs int, done_warcs int, failed_warcs int")
    rows = rows.withColumn("updated_at", F.current_timestamp())
    assert tables.read_snapshot(spark, root, schemas.MONTH_LEDGER).count() == 0
    tables.publish_snapshot(rows, root, schemas.MONTH_LEDGER)
    (tmp_path / "table" / "version=2").mkdir()
    assert tables.read_snapshot(spark, root, schemas.MONTH_LEDGER).count() == 1
    # The unfinished version may be another writer's: it stays as it is.
    assert tables.publish_snapshot(rows.unionByName(rows), root, schemas.MONTH_LEDGER) == 3
    assert tables.read_snapshot(spark, root, schemas.MONTH_LEDGER).count() == 2


def test_json_lines_keep_other_scripts(spark):
    line = tables.to_json_lines(spark.createDataFrame([("привет", None)], "a string, b string")).first().value
    assert "привет" in line and json.loads(line) == {"a": "привет", "b": None}


def test_tables_and_additive_columns(spark):
    schemas.create_tables(spark, "newsflow_test")
    schemas.create_tables(spark, "newsflow_test")
    assert spark.table("newsflow_test.news_articles").columns == schemas.ARTICLES.fieldNames()
    spark.sql("CREATE TABLE IF NOT EXISTS newsflow_test.narrow (article_id string, url string) USING parquet")
    added = schemas.add_missing_columns(spark, "newsflow_test.narrow", schemas.ARTICLES)
    assert "source_warc" in added and spark.table("newsflow_test.narrow").count() == 0
    spark.sql("DROP DATABASE newsflow_test CASCADE")


def test_broken_rows(spark):
    rows = spark.createDataFrame([("a", "u"), ("a", None)], "article_id string, url string")
    found = sorted(tuple(r) for r in schemas.broken_rows(rows, schemas.ARTICLES, "article_id").collect())
    assert found == [("duplicate key", "a"), ("null", "url")]
    states = spark.createDataFrame([("p", "done"), ("q", "lost")], "warc_path string, status string")
    found = schemas.broken_rows(states, schemas.ARCHIVE_LEDGER, allowed={"status": schemas.ARCHIVE_STATES})
    assert [tuple(r) for r in found.collect()] == [("value not allowed", "lost")]


@pytest.mark.parametrize("sql, params, rows", [("SELECT ? AS x", [1], 1), ("SHOW TABLES", None, None)])
def test_query(spark, sql, params, rows):
    frame = files.query(spark, sql, params)
    assert rows is None or frame.count() == rows


def record(url, headers, body):
    http = b"HTTP/1.1 200 OK\r\n" + "".join(f"{k}: {v}\r\n" for k, v in headers.items()).encode() + b"\r\n" + body
    head = f"WARC/1.0\r\nWARC-Type: response\r\nWARC-Target-URI: {url}\r\nContent-Length: {len(http)}\r\n\r\n"
    return gzip.compress(head.encode() + http + b"\r\n\r\n")


def test_bodies_of_all_encodings_and_charsets(spark, tmp_path):
    page = "<html><p>Привет, мир</p></html>"
    marked = '<html><meta charset="windows-1251"><p>Привет</p></html>'
    deflated = zlib.compress(page.encode())
    records = [
        record("http://a/0", {"Content-Encoding": "gzip"}, b"not gzip"),
        record("http://a/1", {"Transfer-Encoding": "chunked"}, b"zz\r\nnot chunked"),
        record("http://a/2", {"Content-Type": "text/html; charset=windows-1251"}, page.encode("cp1251")),
        record("http://a/3", {"Content-Type": "text/html"}, marked.encode("cp1251")),
        record("http://a/4", {"Content-Encoding": "deflate"}, deflated),
        record("http://a/5", {"Content-Encoding": "deflate"}, deflated[2:-4]),
        record("http://a/6", {"Content-Type": "text/html; charset=nonsense"}, page.encode()),
        record("http://a/7", {"Content-Encoding": "br"}, b"\x8b"),
    ]
    put(tmp_path / "one.warc.gz", b"".join(records))
    manifest = spark.createDataFrame([("one.warc.gz",)], "warc_path string")
    rows = archives.decode_payload(archives.read_archives(manifest, str(tmp_path))).orderBy("record_no").collect()
    assert [r.record_no for r in rows] == list(range(8)) and {r.rec_type for r in rows} == {"response"}
    assert [r.html for r in rows[:7]] == ["not gzip", "zz\r\nnot chunked", page, marked, page, page, page]
    assert [r.record_no for r in rows if r.read_error] == [0, 1, 7]


def test_late_lines_of_a_stream_are_kept(spark, tmp_path):
    landing, out = tmp_path / "landing", str(tmp_path / "out")
    seen = []
    for n, lines in enumerate([[("u1", "10")], [("u2", "05"), ("u3", "11")], [("u4", "05"), ("u1", "05"), ("u5", "12")]]):
        text = "".join(json.dumps({"url": u, "collected_at": f"2025-01-{day}T00:00:00"}) + "\n" for u, day in lines)
        put(landing / f"{n}.json", text.encode())
        links = landing_stream.first_seen_links(landing_stream.landed_lines(spark, str(landing))).select("url")
        links.writeStream.format("parquet").option("path", out).option("checkpointLocation", str(tmp_path / "state")).trigger(
            availableNow=True
        ).start().awaitTermination()
        seen = sorted(r.url for r in spark.read.schema("url string").parquet(out).collect())
    assert seen == ["u1", "u2", "u3", "u4", "u5"]
