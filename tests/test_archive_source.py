"""The archive data source: pushed filters, refused bodies, charsets, and runs that end early."""

import gzip

import pytest
from conftest import plan_of
from pyspark.sql import datasource as ds, functions as F

from newsflow import schemas
from newsflow.functions import urls
from newsflow.plans import backfill
from newsflow.sources import archive_source, archives, tables


def member(kind, url, body=b"", head=b"Content-Type: text/html\r\n"):
    block = b"HTTP/1.1 200 OK\r\n" + head + b"\r\n" + body if kind == "response" else body
    lines = f"WARC/1.0\r\nWARC-Type: {kind}\r\nContent-Length: {len(block)}\r\n" + (f"WARC-Target-URI: {url}\r\n" if url else "")
    return gzip.compress(lines.encode() + b"\r\n" + block + b"\r\n\r\n")


TEXT = "word " * 200
PAGES = [
    ("request", "http://news.example.com/a", b"GET"),
    ("response", "http://news.example.com/a", f"<html lang=en><article>{TEXT}</article>".encode()),
    ("response", "http://other.org/b", b"<p>not allowed</p>" * 50),
    ("response", "http://news.example.com/video/c", b"<p>denied</p>" * 50),
    ("response", "http://news.example.com/d", b"<p>" + b"x" * 5000),
    ("response", None, b"<p>no url</p>"),
    ("response", "http://Exämple.com/e", b"<p>left to Spark</p>"),
]


@pytest.fixture
def stored(spark, tmp_path):
    for name in ("one", "two"):
        (tmp_path / f"{name}.warc.gz").write_bytes(b"".join(member(*p) for p in PAGES))
    (tmp_path / "cut.warc.gz").write_bytes(b"".join(member(*p) for p in PAGES[:2])[:-30])
    return spark.createDataFrame([("one.warc.gz",), ("two.warc.gz",), ("cut.warc.gz",)], "warc_path string"), str(tmp_path)


def test_refused_records_carry_no_bytes(spark, stored):
    manifest, root = stored
    rows = archives.read_archives(manifest.where("warc_path LIKE 'o%'"), root, ("/video/",), ("example.com",), 2000).orderBy("record_no").collect()
    assert [(r.record_no, r.rec_type, r.url) for r in rows] == [(n, k, u) for n, (k, u, _) in enumerate(PAGES)]
    assert [r.payload is not None for r in rows] == [False, True, False, False, False, False, True]
    assert [r.payload_bytes for r in rows] == [None, len(PAGES[1][2]), None, None, 5003, None, len(PAGES[6][2])]
    everything = archives.read_archives(manifest.where("warc_path LIKE 'o%'"), root).where("rec_type = 'response' AND url IS NOT NULL").collect()
    assert [r.payload for r in everything] == [b for k, u, b in PAGES if k == "response" and u]


def test_filters_reach_the_reader(spark, stored, monkeypatch):
    manifest, root = stored
    frame = archives.read_archives(manifest, root).where("rec_type = 'response' AND url LIKE '%example.com/%' AND warc_path IN ('one.warc.gz', 'cut.warc.gz') AND NOT url LIKE '%/video/%'")
    assert sorted({(r.warc_path, r.record_no) for r in frame.collect()}) == [("one.warc.gz", 1), ("one.warc.gz", 4)]
    plan = plan_of(frame)
    assert "Filter" not in plan or "url" not in plan.split("Filter", 1)[1].split("\n")[0], plan
    assert frame.rdd.getNumPartitions() == 2
    assert archives.read_archives(manifest.limit(0), root).collect() == []
    assert archives.read_archives(manifest, root).where("warc_path = 'none'").collect() == []
    # A filter on what only the body tells stays with Spark.
    assert archives.read_archives(manifest, root).where("payload_bytes > 3000 AND record_no < 5").count() == 2


def test_filters_decide_as_sql_does():
    url = ("url",)
    cases = [
        (ds.EqualTo(url, "a"), "a", True), (ds.EqualTo(url, "a"), None, None), (ds.Not(ds.EqualTo(url, "a")), None, None), (ds.Not(ds.EqualTo(url, "a")), "b", True),
        (ds.In(url, ("a", "b")), "b", True), (ds.StringContains(url, "x"), "axb", True), (ds.StringStartsWith(url, "x"), "axb", False), (ds.StringEndsWith(url, "b"), "axb", True),
        (ds.IsNull(url), None, True), (ds.IsNotNull(url), None, False), (ds.Not(ds.IsNull(url)), "a", True),
    ]
    for given, value, truth in cases:
        assert archive_source.understood(given) and archive_source.decided(given, {"url": value}) is truth, given
    assert not archive_source.understood(ds.EqualTo(("payload",), b"")) and not archive_source.understood(ds.EqualTo(("url", "x"), "a"))
    assert archive_source.decided(ds.GreaterThan(("record_no",), 3), {"record_no": 4})


def test_refusals_agree_with_the_gate(spark):
    given = ["http://a.example.com/x", "HTTPS://A.EXAMPLE.COM/x", "//example.com", "example.com/x", "http://b.org/example.com", "http://a.example.com/video/1", "http://u@example.com:80?q", "x", "http://a.example.com/VIDEO/"]
    rules = archive_source.BodyRules(("/video/",), ("example.com",))
    kept = urls.is_article_url(F.col("url"), rules.denied) & urls.in_allow_list_loose(F.col("url"), rules.allowed)
    rows = spark.createDataFrame([(u,) for u in given], "url string").select("url", kept.alias("kept")).collect()
    assert {r.url: bool(r.kept) for r in rows} == {u: not rules.refuse(u) for u in given}
    assert not archive_source.BodyRules().refuse("http://x") and archive_source.BodyRules().refuse(None)


def test_charsets_named_late_and_wrongly(spark, tmp_path):
    late = "<html><head><script>" + "x" * 9000 + '</script><meta charset="windows-1251"></head><p>Привет</p>'
    wrong = b"<html><head></head><p>caf\xe9</p>"
    decoy = "<html><head></head><body>é <meta charset=windows-1251></body>"
    (tmp_path / "a.warc.gz").write_bytes(member("response", "http://a/0", late.encode("cp1251")) + member("response", "http://a/1", wrong) + member("response", "http://a/2", decoy.encode()))
    manifest = spark.createDataFrame([("a.warc.gz",)], "warc_path string")
    rows = archives.decode_payload(archives.read_archives(manifest, str(tmp_path))).orderBy("record_no").collect()
    assert [r.html for r in rows] == [late, "<html><head></head><p>caf�</p>", decoy]
    assert [bool(r.read_error) for r in rows] == [False, True, False] and "at byte" in rows[1].read_error


def test_a_run_that_ends_early_lands_nothing_twice(spark, stored, tmp_path, monkeypatch):
    manifest, root = stored
    job = backfill.Backfill(
        archive_root=root, landing=str(tmp_path / "landing"), articles=str(tmp_path / "articles"), archive_ledger=str(tmp_path / "ledger"),
        month_ledger=str(tmp_path / "months"), denied=("/video/",), allowed=("example.com",), langs=("en",),
    )
    manifest = manifest.withColumn("month", F.lit("2025/01"))
    publish = tables.publish_snapshot
    monkeypatch.setattr(tables, "publish_snapshot", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError, match="lost"):
        backfill.run_backfill(spark, manifest, job)
    monkeypatch.setattr(tables, "publish_snapshot", publish)
    summary = backfill.run_backfill(spark, manifest, job).first()
    assert spark.read.json(job.landing).count() == 2  # one kept page in each whole archive
    assert tables.read_table(spark, job.articles, schemas.ARTICLES).count() == 1
    ledger = {r.warc_path: (r.status, r.rows_written, r.rows_inserted) for r in tables.read_snapshot(spark, job.archive_ledger, schemas.ARCHIVE_LEDGER).collect()}
    assert ledger == {"one.warc.gz": ("done", 1, 1), "two.warc.gz": ("done", 1, 0), "cut.warc.gz": ("failed", 0, 0)} and summary.inserted_total == 1


def test_of_two_writers_the_later_fails(spark, tmp_path, monkeypatch):
    root, one = str(tmp_path / "s"), spark.createDataFrame([("2025/01", 1, 0, 0)], "month string, total_warcs int, done_warcs int, failed_warcs int").withColumn("updated_at", F.current_timestamp())
    assert tables.publish_snapshot(one, root, schemas.MONTH_LEDGER) == 1
    assert tables.publish_snapshot(one, root, schemas.MONTH_LEDGER) == 2
    monkeypatch.setattr(tables, "_versions", lambda *a, **b: [1])
    with pytest.raises(Exception, match="(?i)already.exists"):
        tables.publish_snapshot(one, root, schemas.MONTH_LEDGER)
