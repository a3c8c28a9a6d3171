"""Approximate nearest neighbours: a graph of near vectors, refined in rounds.

Each vector keeps a list of its ``k`` nearest so far. The first lists come from
blocks of vectors that lie on the same sides of random planes. In a round the
vectors that share a neighbour meet there, in groups of bounded size, and are
offered to one another; pairs that have met before do not meet again. What a
round shuffles is a fixed number of vectors for each vector, so it grows in
line with the table. Rounds end when hardly any list changes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from newsflow.session import materialise

LIST = 32
ROUNDS = 8
#: Vectors of a block of the first lists, at most and on average half as many.
BLOCK_ROWS = 512
#: Rows that one call of the refining step works on, on average.
GROUP_ROWS = 20_000
_TIE_DIGITS = 9


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    flat = pa.concat_arrays([c.flatten() for c in column.chunks]) if isinstance(column, pa.ChunkedArray) else column.flatten()
    return flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _unit(matrix: np.ndarray) -> np.ndarray:
    lengths = np.linalg.norm(matrix, axis=1, keepdims=True)
    return matrix / np.where(lengths > 0, lengths, 1.0)


def _pairs(ids: pa.Array, key_type: pa.DataType, a: np.ndarray, b: np.ndarray, similarity: np.ndarray) -> pa.Table:
    taken = lambda at: ids.take(pa.array(at, pa.int64())).cast(key_type)
    return pa.table({"id": taken(a), "partner": taken(b), "similarity": pa.array(similarity, pa.float64())})


def _best_offers(pairs: pa.Table, k: int) -> pa.Table:
    """Of each id the ``k`` best different partners, as ``_lists`` orders them: no other pair can come into a list."""
    pairs = pairs.group_by(["id", "partner"]).aggregate([("similarity", "max")]).rename_columns(["id", "partner", "similarity"])
    pairs = pairs.sort_by([("id", "ascending"), ("similarity", "descending"), ("partner", "ascending")])
    ids = pairs.column("id").combine_chunks().dictionary_encode().indices.to_numpy()
    first = np.flatnonzero(np.diff(ids, prepend=-1))
    place = np.arange(len(ids)) - np.repeat(first, np.diff(first, append=len(ids)))
    return pairs.filter(pa.array(place < k))


def _nearest(similarity: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Places (row, column) of the ``k`` largest entries of each row."""
    k = min(k, similarity.shape[1])
    best = np.argpartition(-similarity, k - 1, axis=1)[:, :k]
    return np.repeat(np.arange(len(similarity)), k), best.ravel()


def _first_lists(rows: DataFrame, n: int, k: int, tables: int, block_rows: int, seed: int) -> DataFrame:
    """Pairs (id, partner, similarity) from blocks of vectors on the same sides of random planes."""
    key = rows.schema["id"].dataType.simpleString()
    planes = max(0, int(np.ceil(np.log2(max(n, 1) / (block_rows / 2)))))

    def sides(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            matrix = _matrix(batch.column("vector"))
            for t in range(tables):
                chosen = np.random.default_rng([seed, t]).normal(size=(matrix.shape[1], planes))
                bits = (matrix @ chosen > 0) @ (1 << np.arange(planes, dtype=np.int64)) if planes else np.zeros(len(batch), np.int64)
                cell = pa.array(bits.astype(np.int64) * tables + t)
                yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("vector"), cell], names=["id", "vector", "cell"])

    placed = materialise(rows.select("id", "vector").mapInArrow(sides, f"id {key}, vector array<float>, cell long"))
    sizes = placed.groupBy("cell").count()
    blocks = sizes.select("cell", F.ceil(F.col("count") / block_rows).cast("int").alias("_blocks"))
    blocked = placed.join(blocks, "cell").withColumn("block", F.pmod(F.xxhash64("id", "cell"), F.col("_blocks")).cast("int"))

    def search(table: pa.Table) -> pa.Table:
        ids = table.column("id").combine_chunks()
        unit = _unit(_matrix(table.column("vector")))
        similarity = unit @ unit.T
        np.fill_diagonal(similarity, -np.inf)
        a, b = _nearest(similarity, k)
        found = similarity[a, b]
        real = np.isfinite(found)
        return _pairs(ids, ids.type, a[real], b[real], np.round(found[real], _TIE_DIGITS))

    return blocked.select("cell", "block", "id", "vector").groupBy("cell", "block").applyInArrow(search, f"id {key}, partner {key}, similarity double")


def _lists(pairs: DataFrame, k: int) -> DataFrame:
    """``id`` and ``near``: its ``k`` nearest partners (distance, partner, fresh), of ``pairs`` with a mark ``fresh``.

    A partner known before is not fresh. Equal distances go to the smallest partner. All pairs of an id go through one shuffle.
    """
    best = pairs.repartition("id").groupBy("id", "partner").agg(F.max("similarity").alias("similarity"), F.min("fresh").alias("fresh"))
    ranked = F.row_number().over(Window.partitionBy("id").orderBy(F.desc("similarity"), "partner"))
    kept = best.withColumn("_place", ranked).where(F.col("_place") <= k)
    near = F.array_sort(F.collect_list(F.struct((-F.col("similarity")).alias("distance"), "partner", "fresh")))
    return kept.groupBy("id").agg(near.alias("near"))


def _offers(rows: DataFrame, lists: DataFrame, n: int, k: int) -> DataFrame:
    """Pairs of vectors that share a neighbour and are nearer than what one of them has listed."""
    key = rows.schema["id"].dataType.simpleString()
    edges = lists.select("id", F.explode("near").alias("e")).select("id", "e.partner", "e.fresh")
    back = edges.select(F.col("partner").alias("at"), F.col("id").alias("member"), "fresh")
    some = F.row_number().over(Window.partitionBy("at").orderBy(F.desc("fresh"), F.xxhash64("member", "at"), "member"))
    back = back.withColumn("_place", some).where(F.col("_place") <= k).drop("_place")
    members = edges.select(F.col("id").alias("at"), F.col("partner").alias("member"), "fresh").unionByName(back)
    members = members.groupBy("at", "member").agg(F.max("fresh").alias("fresh"))
    # Where no member is fresh, all have met: their vectors stay where they are.
    members = members.withColumn("_any", F.max("fresh").over(Window.partitionBy("at"))).where("_any").drop("_any")
    # Whoever has a full list takes nearer ones only.
    worst = F.when(F.size("near") >= k, F.element_at("near", -1)["distance"])
    known = rows.join(lists.select("id", worst.alias("worst")), "id", "left").select(F.col("id").alias("member"), "vector", "worst")
    # A vector meets those it has listed and at most k of those that list it.
    degrees = edges.groupBy("partner").count().select(F.sum("count"), F.sum(F.least("count", F.lit(k)))).first()
    groups = 1 + min(2 * n * k, sum(d or 0 for d in degrees)) // GROUP_ROWS
    met = members.join(known, "member").withColumn("group", F.pmod(F.xxhash64("at"), F.lit(groups)))

    def compare(table: pa.Table) -> pa.Table:
        table = table.sort_by([("at", "ascending"), ("member", "ascending")])
        ids = table.column("member").combine_chunks()
        unit = _unit(_matrix(table.column("vector")))
        fresh = table.column("fresh").to_numpy(zero_copy_only=False).astype(bool)
        limit = -table.column("worst").to_numpy(zero_copy_only=False).astype(float)
        limit[np.isnan(limit)] = -np.inf
        at = table.column("at").combine_chunks().dictionary_encode().indices.to_numpy()
        cuts = np.flatnonzero(np.diff(at, prepend=-1, append=-1))
        found: list[tuple[np.ndarray, ...]] = []
        for a, b in zip(cuts[:-1], cuts[1:]):
            if not fresh[a:b].any():
                continue
            similarity = np.round(unit[a:b] @ unit[a:b].T, _TIE_DIGITS)
            wanted = (fresh[a:b, None] | fresh[None, a:b]) & (similarity > limit[a:b, None])
            np.fill_diagonal(wanted, False)
            x, y = np.nonzero(wanted)
            found.append((x + a, y + a, similarity[x, y]))
        x, y, similarity = (np.concatenate(c) for c in zip(*found)) if found else (np.zeros(0, int), np.zeros(0, int), np.zeros(0))
        return _best_offers(_pairs(ids, ids.type, x, y, similarity), k)

    columns = met.select("group", "at", "member", "fresh", "worst", "vector")
    return columns.groupBy("group").applyInArrow(compare, f"id {key}, partner {key}, similarity double")


def neighbour_graph(
    vectors: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    k: int = LIST,
    rounds: int = ROUNDS,
    tables: int = 2,
    block_rows: int = BLOCK_ROWS,
    still: float = 0.002,
    seed: int = 7,
) -> DataFrame:
    """``key`` and ``neighbours``: up to ``k`` near vectors (similarity, id), nearest first.

    Approximate: a near vector can be missing from a list, but similarities
    are those of the vectors themselves, rounded to nine decimals. Keys must be
    unique and vectors of one length; null vectors, and such with null or
    non-finite components, are left out. Rounds end when at most ``still`` of
    all list entries are new, or after ``rounds``. The same table gives the
    same graph, whatever its partitions.
    """
    floats = F.col(vector).cast("array<float>")
    bad = F.exists(floats, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = vectors.where(floats.isNotNull() & (F.size(floats) > 0) & ~bad).select(F.col(key).alias("id"), floats.alias("vector"))
    rows = materialise(rows)
    n = rows.count()
    pairs = _first_lists(rows, n, k, tables, block_rows, seed)
    lists = materialise(_lists(pairs.withColumn("fresh", F.lit(True)), k))
    for _ in range(rounds if n > block_rows else 0):
        held = lists.select("id", F.explode("near").alias("e")).select("id", "e.partner", (-F.col("e.distance")).alias("similarity"), F.lit(False).alias("fresh"))
        offers = _offers(rows, lists, n, k).withColumn("fresh", F.lit(True))
        lists = materialise(_lists(held.unionByName(offers), k))
        new = lists.agg(F.sum(F.size(F.filter("near", lambda e: e["fresh"])))).first()[0] or 0
        if new <= still * n * k:
            break
    entry = lambda e: F.struct((-e["distance"]).alias("similarity"), e["partner"].alias("id"))
    return lists.select(F.col("id").alias(key), F.transform("near", entry).alias("neighbours"))


def approximate_neighbours(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", **options) -> DataFrame:
    """``key``, ``closest_<key>`` and ``closest_similarity``, as ``nearest_neighbours`` gives them, but
    approximate and at a cost that grows in line with the table.

    Of equal vectors only the two smallest keys take part; the further copies get the second one's answer.
    """
    floats = vectors.select(F.col(key).alias("id"), F.col(vector).cast("array<float>").alias("vector"))
    copy = F.row_number().over(Window.partitionBy("vector").orderBy("id"))
    kept = materialise(floats.withColumn("copy", copy).where("copy <= 2"))
    graph = neighbour_graph(kept.select("id", "vector"), "id", "vector", **options)
    found = materialise(graph.where(F.size("neighbours") > 0).select("id", F.col("neighbours")[0].alias("best")).select("id", F.col("best.id").alias("partner"), "best.similarity"))
    answers = kept.where("copy = 2").join(found, "id").select("vector", "partner", "similarity")
    further = floats.join(kept.select("id"), "id", "left_anti").join(answers, "vector")
    return found.unionByName(further.select("id", "partner", "similarity")).select(
        F.col("id").alias(key), F.col("partner").alias(f"closest_{key}"), F.col("similarity").alias("closest_similarity")
    )
