"""The approximate neighbour graph: recall against exact answers, equal runs, hostile rows."""

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from newsflow.operators import neighbour_graph as graph
from newsflow.operators.neighbours import nearest_neighbours


def exact(matrix, k):
    unit = matrix / np.linalg.norm(matrix, axis=1, keepdims=True)
    similarity = unit @ unit.T
    np.fill_diagonal(similarity, -2)
    return np.argsort(-similarity, axis=1)[:, :k], similarity


def table(spark, path, matrix):
    pq.write_table(pa.table({"vec_id": pa.array(range(len(matrix))), "embedding": pa.array(list(matrix.astype("f4")), pa.list_(pa.float32()))}), path)
    return spark.read.parquet(str(path))


@pytest.mark.parametrize("kind", ["loose", "spread"])
def test_recall_against_all_pairs(spark, tmp_path, kind):
    chance = np.random.default_rng(3)
    n, dim = 5000, 32 if kind == "spread" else 64
    matrix = chance.normal(size=(n, dim))
    if kind == "loose":  # a third of all rows in one cluster, the rest in many small ones
        matrix[: n // 3] = matrix[0] + 0.6 * chance.normal(size=(n // 3, dim))
        matrix[n // 3 :] = matrix[n // 3 + chance.integers(0, 200, n - n // 3)] + 0.4 * chance.normal(size=(n - n // 3, dim))
    vectors = table(spark, tmp_path / f"{kind}.parquet", matrix.astype("f4"))
    found = graph.neighbour_graph(vectors).collect()
    best, similarity = exact(matrix.astype("f4").astype(float), 10)
    assert len(found) == n
    first = hit = 0
    for r in found:
        ids = [e.id for e in r.neighbours]
        assert len(ids) == len(set(ids)) == graph.LIST and r.vec_id not in ids
        assert [-e.similarity for e in r.neighbours] == sorted(-e.similarity for e in r.neighbours)
        assert np.allclose([e.similarity for e in r.neighbours], similarity[r.vec_id, ids], atol=1e-6)
        first += ids[0] == best[r.vec_id, 0]
        hit += len(set(ids[:10]) & set(best[r.vec_id]))
    assert first >= 0.95 * n and hit >= 0.9 * 10 * n


def test_answers_next_to_the_exact_operator(spark):
    vectors = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    near = graph.approximate_neighbours(vectors).collect()
    best = {r.vec_id: r.closest_similarity for r in nearest_neighbours(vectors).collect()}
    assert {r.vec_id for r in near} == set(best)
    assert np.mean([abs(r.closest_similarity - best[r.vec_id]) < 1e-6 for r in near]) >= 0.95
    again = graph.approximate_neighbours(vectors.repartition(13, "label")).collect()
    assert sorted(map(tuple, near)) == sorted(map(tuple, again))


def test_what_a_round_shuffles_follows_the_table(spark, tmp_path):
    chance = np.random.default_rng(5)
    sizes = {}
    for n in (1000, 4000):
        matrix = chance.normal(size=(n, 8))
        matrix[:] = np.where(np.arange(n)[:, None] % 3 == 0, matrix[0] + 0.01 * matrix, matrix)  # a hub that many rows are near to
        vectors = table(spark, tmp_path / f"v{n}.parquet", matrix)
        rows = vectors.selectExpr("vec_id AS id", "embedding AS vector")
        pairs = graph._first_lists(rows, n, 8, 2, 256, 7)
        lists = graph.materialise(graph._lists(pairs.selectExpr("*", "true AS fresh"), 8))
        edges = lists.selectExpr("explode(near) AS e").count()
        assert edges <= 8 * n
        sizes[n] = graph._offers(rows, lists, n, 8).count()
        assert sizes[n] <= n * (2 * 8) * (2 * 8)
    assert sizes[4000] < 8 * sizes[1000]


def test_hostile_vectors(spark):
    rows = [(1, [1.0, 0.0], "x"), (2, [1.0, 0.0], "x"), (3, [1.0, 0.0], "x"), (4, [0.0, 0.0], "x"), (5, None, "x"), (6, [float("nan"), 1.0], "x"), (7, [None, 1.0], "x"), (8, [], "x"), (9, [0.6, 0.8], None)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>, id string")
    got = {r.vec_id: (r.closest_vec_id, round(r.closest_similarity, 6)) for r in graph.approximate_neighbours(vectors).collect()}
    assert got == {1: (2, 1.0), 2: (1, 1.0), 3: (1, 1.0), 4: (1, 0.0), 9: (1, 0.6)}
    assert graph.approximate_neighbours(vectors.limit(0)).collect() == []
    assert graph.approximate_neighbours(vectors.limit(1)).collect() == []
    named = spark.createDataFrame([("a", [1.0, 0.1]), ("b", [1.0, 0.2]), ("c", [0.1, 1.0])], "vec_id string, embedding array<float>")
    assert {r.vec_id: r.closest_vec_id for r in graph.approximate_neighbours(named).collect()} == {"a": "b", "b": "a", "c": "b"}


def test_a_group_offers_no_more_than_a_list_holds(spark, tmp_path):
    matrix = np.random.default_rng(6).normal(size=(1000, 8))
    rows = table(spark, tmp_path / "v.parquet", matrix).selectExpr("vec_id AS id", "embedding AS vector")
    lists = graph.materialise(graph._lists(graph._first_lists(rows, 1000, 8, 2, 256, 7).selectExpr("*", "true AS fresh"), 8))
    offers = graph._offers(rows, lists, 1000, 8).toPandas()  # one group
    assert len(offers) and offers.groupby("id").size().max() <= 8 and not offers.duplicated(["id", "partner"]).any()
