"""Operators on small frames with hot keys, against brute force; and their plans."""

import random

import numpy as np
import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from newsflow.operators import coverage, dedup, ledger, merge, neighbours, running, unify, worksets
from newsflow.operators.embed import embed_texts
from newsflow.operators.language import detect_language, train_language_model


def hot_rows(spark, n=3000, partitions=6):
    """A third of the rows share one key."""
    rows = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("key"),
        F.expr("(id * 7919) % 3001").alias("position"),
    )
    return rows.repartition(partitions)


def brute_first_n(rows, n):
    groups = {}
    for key, position in rows:
        groups.setdefault(key, []).append(position)
    return sorted((k, p) for k, ps in groups.items() for p in sorted(ps)[:n])


@pytest.mark.parametrize("n", [1, 5, 1200])
def test_first_n_per_key(spark, n):
    rows = hot_rows(spark)
    got = sorted(map(tuple, dedup.first_n_per_key(rows, "key", "position", n, span=100).collect()))
    assert got == brute_first_n([tuple(r) for r in rows.collect()], n)


def test_first_row_limits_groups_before_the_shuffle(spark):
    plan = plan_of(dedup.first_per_key(hot_rows(spark), ["key"], [F.col("position")]))
    assert plan.count("WindowGroupLimit") == 2 and plan.rindex("Partial") > plan.index("Exchange")


def test_first_row_does_not_depend_on_partitions(spark):
    results = {
        tuple(sorted(map(tuple, dedup.first_per_key(hot_rows(spark, partitions=p), ["key"], [F.col("position")]).collect())))
        for p in (1, 3, 7)
    }
    assert len(results) == 1


def test_running_total(spark):
    rng = random.Random(5)
    rows = [(f"d{i}", rng.choice([1, 1, 1, 2, 50])) for i in range(400)]
    frame = spark.createDataFrame(rows, "domain string, unique_urls bigint")
    got = running.running_total(frame, [F.desc("unique_urls"), F.asc("domain")], "unique_urls", "upto", slices=7)
    total, expected = 0, {}
    for domain, n in sorted(rows, key=lambda r: (-r[1], r[0])):
        total += n
        expected[domain] = total
    assert {r.domain: r.upto for r in got.collect()} == expected


def test_coverage_cut_includes_the_crossing_domain(spark):
    counts = spark.createDataFrame([("a", 50), ("b", 29), ("c", 2), ("d", 19)], "domain string, unique_urls bigint")
    cut = coverage.coverage_cut(coverage.domain_shares(counts))
    assert sorted(r.domain for r in cut.collect()) == ["a", "b", "d"]
    assert coverage.coverage_reached(cut).first().coverage_pct == 98.0


def brute_nearest(vectors):
    unit = {k: np.array(v, dtype=np.float64) for k, v in vectors.items()}
    unit = {k: v / (np.linalg.norm(v) or 1.0) for k, v in unit.items()}
    out = {}
    for a in unit:
        best = min((-round(float(unit[a] @ unit[b]), 9), b) for b in unit if b != a)
        out[a] = (best[1], round(-best[0], 6))
    return out


@pytest.mark.parametrize("shape", ["spread", "hot", "copies"])
def test_nearest_neighbours_match_brute_force(spark, shape):
    rng = np.random.default_rng(11)
    vectors = rng.normal(size=(150, 8)).astype(np.float32)
    if shape == "hot":  # two thirds in one narrow cone
        vectors[:100] = np.ones(8) + 0.01 * vectors[:100]
    if shape == "copies":  # equal vectors, and a zero one
        vectors[:60] = vectors[0]
        vectors[149] = 0
    rows = {i: v.tolist() for i, v in enumerate(vectors)}
    frame = spark.createDataFrame(list(rows.items()), "vec_id bigint, embedding array<float>")
    got = neighbours.nearest_neighbours(frame, pivots=6, block_rows=16)
    found = {r.vec_id: (r.closest_vec_id, round(r.closest_similarity, 6)) for r in got.collect()}
    assert found == brute_nearest(rows)


def test_nearest_neighbours_with_text_keys_and_few_rows(spark):
    rows = {"b": [1.0, 0.0], "a": [0.9, 0.1], "c": [0.0, 1.0]}
    frame = spark.createDataFrame(list(rows.items()), "article_id string, v array<float>")
    got = {r[0]: r[1] for r in neighbours.nearest_neighbours(frame, "article_id", "v").collect()}
    assert got == {"b": "a", "a": "b", "c": "a"}
    assert neighbours.nearest_neighbours(frame.where("false"), "article_id", "v").count() == 0
    assert neighbours.nearest_neighbours(frame.where("article_id = 'a'"), "article_id", "v").count() == 0


def test_merge_is_idempotent(spark):
    batch = spark.createDataFrame([("a", 2), ("a", 1), ("b", 1)], "article_id string, n int")
    stored = spark.createDataFrame([("b", 9)], "article_id string, n int")
    new = merge.insert_if_absent(batch, stored, [F.col("n")])
    assert [tuple(r) for r in new.collect()] == [("a", 1)]
    assert merge.insert_if_absent(batch, stored.unionByName(new), [F.col("n")]).count() == 0


def test_merge_of_a_small_batch_does_not_shuffle_the_stored_table(spark, tmp_path):
    key = F.col("id").cast("string").alias("article_id")
    spark.range(100000).select(key).write.parquet(str(tmp_path / "stored"))
    spark.range(99999, 100010).select(key).write.parquet(str(tmp_path / "batch"))
    stored, batch = (spark.read.parquet(str(tmp_path / n)) for n in ("stored", "batch"))
    plan = plan_of(merge.absent_rows(stored, batch))
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan
    assert merge.upsert_latest(stored, batch, [F.col("article_id")]).count() == 100010


def test_insert_of_a_small_batch_leaves_the_stored_table_in_place(spark, tmp_path):
    key = F.col("id").cast("string").alias("article_id")
    spark.range(3_000_000).select(key).write.parquet(str(tmp_path / "stored"))
    spark.range(2_999_990, 3_000_010).select(key).write.parquet(str(tmp_path / "batch"))
    stored, batch = (spark.read.parquet(str(tmp_path / n)) for n in ("stored", "batch"))
    new = merge.insert_if_absent(batch, stored, [F.col("article_id")])
    lines = plan_of(new).splitlines()
    scan = next(n for n, line in enumerate(lines) if "FileScan" in line and "/stored" in line)
    above = [line for line in lines[:scan] if "Exchange" in line or "LeftSemi" in line]
    assert "BroadcastHashJoin" in above[-1] and "LeftSemi" in above[-1]
    assert sorted(r.article_id for r in new.collect()) == [str(n) for n in range(3_000_000, 3_000_010)]


def test_failed_archive_keeps_counts_and_retry_clears_the_error(spark):
    columns = "warc_path string, month string, status string, rows_written int, rows_inserted int, error_text string, updated_at timestamp"
    stored = spark.createDataFrame([], columns)
    step = lambda n, s, w, e: ("p", "2025/01", s, w, w, e, None, n)
    rows = [step(1, "done", 5, None), step(2, "failed", None, "x" * 3000)]
    schema = columns + ", update_no bigint"
    failed = merge.apply_status_updates(stored, spark.createDataFrame(rows, schema))
    row = failed.first()
    assert (row.status, row.rows_written, len(row.error_text)) == ("failed", 5, 2000)
    again = merge.apply_status_updates(failed, spark.createDataFrame([step(1, "done", 7, None)], schema)).first()
    assert (again.status, again.rows_written, again.error_text) == ("done", 7, None)


def test_progress_has_a_total_and_survives_no_archives(spark):
    manifest = spark.createDataFrame([("a", "2025/01"), ("b", "2025/01"), ("c", "2025/02")], "warc_path string, month string")
    done = spark.createDataFrame([("a", "done"), ("b", "failed")], "warc_path string, status string")
    rows = ledger.progress_report(manifest, done).collect()
    assert [(r.month, r.total_warcs, r.processed_warcs, r.processed_pct) for r in rows] == [
        ("2025/01", 2, 1, 50.0), ("2025/02", 1, 0, 0.0), (None, 3, 1, 33.33),
    ]


def test_backlog_shares_of_an_empty_backlog(spark):
    none = spark.createDataFrame([("a",)], "article_id string")
    rows = worksets.backlog_shares(none, none, 2).collect()
    assert [(r.shard_rows, r.share_pct) for r in rows] == [(0, 0.0), (0, 0.0)]


def test_batch_limit():
    assert [worksets.batch_limit(500, m, p) for m, p in ((None, 0), (700, 500), (700, 700))] == [500, 200, 0]


def test_wrong_dimension_fails(spark):
    texts = spark.createDataFrame([("a", "x")], "article_id string, text string")
    from newsflow.operators.embed import hashed_tokens

    with pytest.raises(Exception, match="expected 384 dimensions"):
        embed_texts(texts, make_encoder=hashed_tokens(16)).collect()


def test_language_model_separates_languages(spark):
    en = ["the cat and the dog went to the house", "this is what they said about the weather"]
    fr = ["le chat et le chien sont dans la maison", "ce que les gens ont dit sur le temps"]
    rows = [(i, lang, t) for i, (lang, t) in enumerate([("en", t) for t in en] + [("fr", t) for t in fr])]
    docs = spark.createDataFrame(rows, "doc_id int, lang string, text string")
    model = train_language_model(docs)
    new = spark.createDataFrame([(1, "they went to the house"), (2, "les gens dans la maison"), (3, "")], "doc_id int, text string")
    found = {r.doc_id: r.detected_lang for r in detect_language(new, model).collect()}
    assert found[1] == "en" and found[2] == "fr" and found[3] == "en"


def test_relational_plans_stay_in_the_jvm(spark):
    lines = spark.createDataFrame([("https://a.example.com/1", "text")], "url string, text string")
    for frame in (unify.archive_articles(lines), unify.feed_articles(lines)):
        plan = plan_of(frame)
        assert "Python" not in plan and "CartesianProduct" not in plan


def test_a_filter_on_extracted_text_does_not_extract_twice(spark):
    from newsflow.operators.gate import extract_pages

    pages = spark.createDataFrame([("<p>x</p>",)], "html string")
    plan = plan_of(extract_pages(pages).where(F.length("text") > 500).select("title"))
    assert plan.count("ArrowEvalPython") == 1


def test_a_block_is_searched_in_slices():
    """Two full blocks: far less than their 4,096 x 4,096 similarities are held at once."""
    import tracemalloc

    import pandas as pd

    chance = np.random.default_rng(2)
    block = lambda first: pd.DataFrame({"id": range(first, first + 4096), "vector": list(chance.normal(size=(4096, 8)).astype("f4"))})
    rows, others = block(0), block(4096)
    tracemalloc.start()
    found = neighbours._best(rows, others)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(found) == 4096 and found["partner"].min() >= 4096 and peak < 60e6
