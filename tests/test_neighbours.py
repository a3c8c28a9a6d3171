"""The exact neighbour search: what it leaves on disk, and answers that need exact numbers."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from newsflow.operators import neighbours


def table(spark, matrix, ids=None):
    ids = range(len(matrix)) if ids is None else ids
    rows = [(i, v.tolist()) for i, v in zip(ids, matrix.astype("f4"))]
    return spark.createDataFrame(rows, f"vec_id {'string' if isinstance(rows[0][0], str) else 'bigint'}, embedding array<float>")


def brute(matrix):
    """Place of the nearest other row, the first of a tie, and its similarity."""
    wide = matrix.astype("f4").astype(float)
    lengths = np.linalg.norm(wide, axis=1, keepdims=True)
    unit = wide / np.where(lengths > 0, lengths, 1.0)
    similarity = np.round(unit @ unit.T, 9)
    np.fill_diagonal(similarity, -2)
    return similarity.argmax(axis=1), similarity.max(axis=1)


def shuffled_bytes(spark):
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    files = [found.apply(i) for i in range(found.size())]
    return sum(f.length() for f in files if f.getName().startswith("shuffle_"))


def test_spread_vectors_are_not_copied_on_disk(spark):
    """Nothing can be ruled out here, so every block meets every other; rows must not be written for each."""
    matrix = np.random.default_rng(1).normal(size=(4000, 64))
    vectors = table(spark, matrix).checkpoint()
    before = shuffled_bytes(spark)
    got = neighbours.nearest_neighbours(vectors, block_rows=200).collect()
    written = shuffled_bytes(spark) - before
    best, similarity = brute(matrix)
    assert {r[0]: r[1] for r in got} == dict(enumerate(best))
    assert np.allclose([r[2] for r in sorted(got)], similarity, atol=1e-9)
    assert written < 4 * matrix.size * 4


def shaped(shape):
    chance = np.random.default_rng(4)
    matrix = chance.normal(size=(500, 16))
    if shape == "clusters":  # where cells are ruled out
        matrix = 30 * chance.normal(size=(20, 16))[chance.integers(0, 20, 500)] + matrix
    if shape == "near copies":  # nearer to one another than single precision can tell
        matrix[50:350] = matrix[0] + 1e-4 * matrix[50:350]
    if shape == "one direction":  # all similarities of a group are equal
        matrix[50:350] = matrix[0] * np.arange(1, 301)[:, None]
    if shape == "zeros and far ends":
        matrix[3:5] = 0
        matrix[100:200] = -matrix[:100]
    return matrix


@pytest.mark.parametrize("shape", ["spread", "clusters", "near copies", "one direction", "zeros and far ends"])
def test_answers_across_blocks(spark, shape):
    matrix = shaped(shape)
    best, similarity = brute(matrix)
    names = [f"k{i:04}" for i in range(len(matrix))]
    for ids in (None, names):
        found = neighbours.nearest_neighbours(table(spark, matrix, ids).repartition(5), block_rows=64)
        got = sorted(found.collect())
        plain = lambda i: i if ids is None else names[i]
        assert [r[0] for r in got] == [plain(i) for i in range(len(matrix))]
        assert [r[1] for r in got] == [plain(i) for i in best]
        assert np.allclose([r[2] for r in got], similarity, atol=2e-9)


def test_numbers_that_are_not_finite_spoil_no_other_answer(spark):
    matrix = np.random.default_rng(6).normal(size=(60, 4))
    best, _ = brute(matrix)
    odd = np.vstack([matrix, [[np.nan, 1, 1, 1], [np.inf, 1, 1, 1], [np.nan, 1, 1, 1], [np.nan, 1, 1, 1]]])
    got = neighbours.nearest_neighbours(table(spark, odd), block_rows=16).collect()
    assert {r[0]: r[1] for r in got} == dict(enumerate(best))


def test_rows_of_one_key(spark):
    """A key is no partner of its own other vectors; a row that comes twice is its own partner."""
    rows = [(1, [1.0, 0.0]), (1, [0.9, 0.1]), (2, [0.5, 0.6]), (3, [0.0, 1.0]), (4, [-1.0, 0.0]), (4, [-1.0, 0.0])]
    vectors = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    for block_rows in (1, 100):
        got = {r[0]: r[1] for r in neighbours.nearest_neighbours(vectors, block_rows=block_rows).collect()}
        assert got == {1: 2, 2: 3, 3: 2, 4: 4}


def test_cells_of_a_layout_fill_blocks():
    centres = np.eye(6)
    layout = neighbours._Layout(centres, [(0, 0.1, 10), (1, 0.1, 250), (2, 0.1, 90), (4, 0.1, 60), (5, 0.1, 40)], 100)
    assert layout.blocks == 5
    assert layout.parts.tolist() == [1, 3, 1, 0, 1, 1]
    rows = np.zeros(layout.blocks)
    for cell, _, count in [(0, 0, 10), (1, 0, 250), (2, 0, 90), (4, 0, 60), (5, 0, 40)]:
        rows[layout.first[cell] : layout.first[cell] + layout.parts[cell]] += count / layout.parts[cell]
    assert rows.max() <= 100 and sorted(c for cells in layout.cells for c in cells) == [0, 1, 1, 1, 2, 4, 5]


def test_titles_that_nobody_asked_for_stay_where_they_are(spark):
    long = F.concat_ws(" ", *(F.sha2(F.concat("id", F.lit(str(n))), 256) for n in range(4)))
    articles = spark.range(20_000).select((F.col("id") + 5).alias("article_id"), long.alias("title"), F.lit("text").alias("text"))
    articles = articles.withColumn("title", F.when(F.col("article_id") != 7, F.col("title"))).checkpoint()
    closest = spark.createDataFrame([(i, i * 10) for i in range(1, 301)] + [(None, 11)], "article_id bigint, closest_article_id bigint")
    titles = {r.article_id: r.title for r in articles.where("article_id <= 3000").collect()}
    limit, before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold"), shuffled_bytes(spark)
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
        got = neighbours.with_titles(closest, articles).collect()
        written = shuffled_bytes(spark) - before
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert sorted((r.article_id or 0, r.closest_article_id) for r in got) == sorted((r.article_id or 0, r.closest_article_id) for r in closest.collect())
    for r in got:
        assert (r.title, r.text) == (titles.get(r.article_id), "text" if r.article_id in titles else None)
        assert r.closest_title == titles.get(r.closest_article_id)
    assert titles[7] is None and written < 20_000 * 260 / 4

    words = closest.selectExpr("string(article_id) article_id", "string(closest_article_id) closest_article_id")
    assert sorted(r.closest_title or "" for r in neighbours.with_titles(words, articles).collect()) == sorted(r.closest_title or "" for r in got)
