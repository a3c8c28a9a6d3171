"""Stores rewritten by part, Bloom filters, sketches, feeds of all kinds, and counters of a cycle."""

import random
from pathlib import Path

from conftest import plan_of
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

from newsflow.operators import key_filter, merge, sketches
from newsflow.plans.feed_cycle import cycle_counters
from newsflow.sources import feeds, stores, tables
from newsflow.streaming import landing as streams

ROWS = StructType([StructField("id", StringType()), StructField("value", LongType())])


def files(path):
    found = {}
    for f in Path(path).rglob("*.parquet"):
        found.setdefault(f.parent.name, set()).add(f.name)
    return found


def test_an_upsert_leaves_other_parts_alone(spark, tmp_path):
    path = str(tmp_path / "store")
    assert stores.read_store(spark, path, ROWS).collect() == []
    old = spark.range(2000).select(F.col("id").cast("string"), F.lit(0).cast("long").alias("value"))
    stores.create_store(old, path, ROWS, stores.hash_part(F.col("id"), 32))
    before = files(path)
    assert len(before) == 32
    batch = spark.createDataFrame([("7", 1, 1), ("7", 2, 2), ("8", 3, 1), ("new", 4, 1), ("7", 0, 0)], "id string, value long, at int")
    touched = stores.upsert_parts(batch, path, [F.desc("at")], "id", ROWS, 32)
    after = files(path)
    changed = {p for p in before if before[p] != after[p]}
    assert 1 <= len(touched) <= 3 and changed == {f"part={p}" for p in touched} and set(after) == set(before)
    state = {r.id: r.value for r in stores.read_store(spark, path, ROWS).collect()}
    assert len(state) == 2001 and (state["7"], state["8"], state["new"]) == (2, 3, 4) and sum(state.values()) == 9
    assert stores.upsert_parts(batch.limit(0), path, [F.desc("at")], "id", ROWS, 32) == [] and files(path) == after
    # The first batch of a store makes it.
    assert len(stores.upsert_parts(old, str(tmp_path / "other"), [F.col("value")], "id", ROWS, 4)) == 4
    assert stores.read_store(spark, str(tmp_path / "other"), ROWS).count() == 2000


def test_an_update_rewrites_days_with_due_rows_only(spark, tmp_path):
    path = str(tmp_path / "articles")
    rows = [(1, "www.a.com", "2026-02-01"), (2, "www.a.com", "2026-03-01"), (3, "b.com", "2026-03-02"), (4, "www.c.com", "2026-03-03"), (5, "d.com", "2026-03-03"), (6, "www.e.com", None), (7, None, "2026-03-04")]
    given = spark.createDataFrame(rows, "id long, domain string, day string").select("id", "domain", F.col("day").cast("date").alias("date"))
    stores.create_store(given, path, given.schema, stores.day_part(F.col("date")))
    before = files(path)
    assert merge.strip_www_stored(spark, path, given.schema) == ["2026-03-01", "2026-03-03"]
    after = files(path)
    assert {p for p in before if before[p] != after[p]} == {"part=2026-03-01", "part=2026-03-03"}
    state = {r.id: r.domain for r in stores.read_store(spark, path, given.schema).collect()}
    assert state == {1: "www.a.com", 2: "a.com", 3: "b.com", 4: "c.com", 5: "d.com", 6: "www.e.com", 7: None}
    assert merge.strip_www_stored(spark, path, given.schema) == [] and files(path) == after


def test_filters_see_all_stored_keys_and_few_others(spark):
    keys = spark.range(30_000).select(F.concat(F.lit("k"), "id").alias("key"), "id")
    pages = key_filter.page_count(20_000)
    parts = [key_filter.key_filter(keys.where(f"id < 20000 AND id % 3 = {n}"), "key", pages) for n in range(3)]
    asked = key_filter.with_maybe(keys.unionByName(spark.createDataFrame([(None, -1)], "key string, id long")), key_filter.joined_filters(*parts), "key", pages)
    counts = asked.agg(F.count_if(F.expr("maybe AND id < 20000 AND id >= 0")).alias("a"), F.count_if(F.expr("maybe AND id >= 20000")).alias("b"), F.count_if(F.expr("maybe AND id < 0")).alias("c")).first()
    assert counts.a == 20_000 and counts.b < 0.02 * 10_000 and counts.c == 0
    assert key_filter.key_filter(keys.limit(0), "key", 3).collect() == []


def test_most_new_rows_skip_the_join(spark):
    stored = spark.range(5000).select(F.concat(F.lit("k"), "id").alias("key"))
    batch = spark.range(4900, 9900).select(F.concat(F.lit("k"), "id").alias("key"), F.col("id").alias("text"))
    pages = key_filter.page_count(5000)
    known = key_filter.key_filter(stored, "key", pages)
    new = key_filter.new_rows_by_filter(batch, stored, known, "key", pages)
    assert sorted(r.text for r in new.collect()) == list(range(5000, 9900))
    plan = plan_of(new)
    sure, unsure = plan.split("Union", 1)[1].split("LeftAnti", 1)
    assert "LeftAnti" in plan and plan.count("LeftAnti") == plan.count("Join") and "Join" not in sure.rsplit("\n", 1)[0]
    asked = key_filter.with_maybe(batch, known, "key", pages).agg(F.count_if("maybe")).first()[0]
    assert 100 <= asked < 100 + 0.03 * 4900
    assert new.columns == batch.columns and key_filter.new_rows_by_filter(batch.limit(0), stored, known, "key", pages).collect() == []


def test_sketches_of_loads_are_one_sketch(spark, tmp_path):
    schema = StructType([StructField("domain", StringType()), StructField("sketch", BinaryType())])
    rows = spark.range(60_000).select(F.when(F.col("id") % 3 > 0, "big").otherwise(F.concat(F.lit("d"), F.col("id") % 300)).alias("domain"), F.when(F.col("id") % 1000 > 0, F.concat(F.lit("u"), F.col("id") % 50_000)).alias("url"))
    root = str(tmp_path / "s")
    for n in range(4):
        sketches.add_load(spark, rows.where(F.xxhash64("url") % 3 == n % 3 - 1), root, ["domain"], schema)
    sketches.add_load(spark, rows, root, ["domain"], schema)
    sketches.add_load(spark, rows, root, ["domain"], schema)
    got = {r.domain: r.unique_urls for r in sketches.estimated_unique(tables.read_snapshot(spark, root, schema), ["domain"]).collect()}
    exact = {r.domain: r.n for r in rows.groupBy("domain").agg(F.count_distinct("url").alias("n")).collect()}
    assert set(got) == set(exact) and all(abs(got[d] - n) <= 4 * sketches.ERROR * n + 0.5 for d, n in exact.items())
    total = sketches.estimated_unique(tables.read_snapshot(spark, root, schema).withColumn("all", F.lit(1)), ["all"]).first().unique_urls
    assert abs(total - 49_950) < 4 * sketches.ERROR * 49_950


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)


def test_feeds_of_three_kinds_and_rejects(spark, tmp_path):
    rdf = 'xmlns:rdf="http://www.w3.org/1999/02/22-rdf-syntax-ns#" xmlns:dc="http://purl.org/dc/elements/1.1/" xmlns="http://purl.org/rss/1.0/"'
    put(tmp_path / "rdf.xml", f'<?xml version="1.0"?><rdf:RDF {rdf}><channel><title>R</title></channel><item rdf:about="x"><title>a &amp; b</title><link>http://r/1</link><dc:date>2024-01-02</dc:date></item><item><title>c</title></item></rdf:RDF>')
    put(tmp_path / "rss.xml", "<rss><channel><title>S</title><item><title>s</title><link>http://s/1</link></item></channel></rss>")
    put(tmp_path / "atom.xml", '<feed xmlns="http://www.w3.org/2005/Atom"><title>A</title><entry><title>e</title><link href="http://a/1"/></entry></feed>')
    put(tmp_path / "none.xml", "<rss><channel><title>no items</title></channel></rss>")
    put(tmp_path / "cut.xml", "<rss><channel><title>S</title><item><title>s</title>")
    put(tmp_path / "page.xml", "<html><p>rss</p></html>")
    put(tmp_path / "empty.xml", "")
    got = sorted((r.feed_url, r.feed_title, r.entry_no, r.link, r.title, r.published) for r in feeds.read_feeds(spark, str(tmp_path)).collect())
    assert got == [("atom", "A", 0, "http://a/1", "e", None), ("rdf", "R", 0, "http://r/1", "a & b", "2024-01-02"), ("rdf", "R", 1, None, "c", None), ("rss", "S", 0, "http://s/1", "s", None)]
    rejects = feeds.feed_rejects(spark, str(tmp_path))
    assert {r.feed_url: r.reason for r in rejects.collect()} == {"cut": "broken", "page": "no_feed", "empty": "empty"}
    assert {r.reason: r.documents for r in feeds.reject_counts(rejects).collect()} == {"broken": 1, "no_feed": 1, "empty": 1}


def test_counters_of_what_came_of_the_links(spark):
    link = lambda n: (f"https://x.example.com/rss", n, f"https://x.example.com/{n}", "t", None)
    entries = spark.createDataFrame([link(n) for n in range(7)] + [("https://y.example.com/rss", 0, "https://y.example.com/0", "t", None)], "feed_url string, entry_no int, link string, title string, published string")
    text = "word " * 200
    page = lambda n, lang, body: (f"https://x.example.com/{n}", f"<html lang={lang}><article>{body}</article>")
    pages = spark.createDataFrame([page(0, "en", text), page(1, "en", "short"), page(2, "de", text), page(3, "xx1", text), page(4, "en", ""), ("https://x.example.com/5", None), page(6, "en", text)], "url string, html string")
    stored = spark.createDataFrame([("https://x.example.com/6",)], "url string").select(F.sha2("url", 256).alias("article_id"))
    got = cycle_counters(entries, stored, pages=pages, denied=("/no/",), allowed=(), groups=(), proxies=()).first().asDict()
    assert got == dict(
        feeds=2, rss_entries=8, url_filtered_out=0, domain_filtered_out=0, candidates=8, already_in_db=1, fetched_ok=5, fetch_fail=2, extract_ok=1,
        extract_fail=4, extract_non_empty=4, json_errors=0, lang_errors=0, lang_filtered_out=2, written=1,
    )
    assert "written" not in cycle_counters(entries, stored, denied=("/no/",), allowed=(), groups=(), proxies=()).columns


def test_month_counts_are_one_snapshot(spark, tmp_path):
    chance = random.Random(1)
    sink, total = str(tmp_path / "months"), {}
    for run in range(4):
        days = [f"2025-{chance.randrange(1, 5):02d}-03" for _ in range(30)]
        put(tmp_path / f"landing/{run}.json", "".join(f'{{"url": "u{i}", "date": "{d}"}}\n' for i, d in enumerate(days)))
        for d in days:
            total[d[:7]] = total.get(d[:7], 0) + 1
        lines = streams.landed_lines(spark, str(tmp_path / "landing"))
        streams.month_counts_stream(lines, sink, str(tmp_path / "state")).awaitTermination()
        assert {r.m: r.articles for r in streams.read_month_counts(spark, sink).withColumn("m", F.date_format("month", "yyyy-MM")).collect()} == total
    assert len(list(Path(sink).glob("version=*"))) == 2
