"""Nearest other vector by cosine, exact, without a cross join of rows.

The method is a pivot-based nearest-neighbour join. Every vector goes to the
cell of its nearest pivot, near cells are put together to blocks of bounded
size (a large cell is cut by hash), and a first pass finds the best partner
inside the own block and so a lower bound on the similarity. The triangle
inequality on angles then rules out all cells that cannot hold a better one.

Where vectors are spread nothing can be ruled out, and every block has to meet
every other. So no row is sent to blocks by a shuffle: a block is packed to one
row of a stored table, the product of that table with itself reads its
partitions again for each task, and both blocks of a pair learn from one
comparison. A task returns at most one partner for each of its rows, and there
are at most ``MAX_SPANS`` squared tasks, so what is written grows in line with
the table while the work may grow with its square.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from newsflow.operators.key_filter import key_filter, page_count, with_maybe
from newsflow.session import broadcast_if_small, materialise

BLOCK_ROWS = 4096
MAX_PIVOTS = 4096
#: The product of blocks has at most so many spans of blocks on either side.
MAX_SPANS = 12
#: Hashes of vectors with several copies that are broadcast at most.
MAX_HASHES = 100_000
#: Pages (4 kB) of a filter of keys that is broadcast at most.
MAX_PAGES = 4096
#: Similarities that a task holds at once; rows are compared in slices of so many.
SLICE_CELLS = 1 << 20
_TIE_DIGITS = 9
_SLACK = 1e-6  # never prune on a difference this small


def _unit_rows(vectors: pd.Series) -> np.ndarray:
    """Matrix of unit vectors; a zero vector stays zero."""
    matrix = np.stack(vectors.to_numpy()).astype(np.float64)
    return matrix / _lengths(matrix)[:, None]


def _lengths(matrix: np.ndarray) -> np.ndarray:
    """Lengths of rows, 1 for a zero vector."""
    lengths = np.linalg.norm(matrix, axis=1)
    return np.where(lengths == 0, 1.0, lengths)


def _slices(rows: int, width: int) -> Iterator[slice]:
    """Slices of rows whose matrix of ``width`` columns has at most ``SLICE_CELLS`` entries (or one row)."""
    step = max(1, SLICE_CELLS // max(1, width))
    return (slice(at, at + step) for at in range(0, rows, step))


def _found(ids: np.ndarray, partners: np.ndarray, similarity: np.ndarray) -> pd.DataFrame:
    """Result rows. Text keys stay plain objects, which Arrow takes in one piece."""
    plain = lambda a: pd.Series(a, dtype=object if a.dtype == object else a.dtype)
    return pd.DataFrame({"id": plain(ids), "partner": plain(partners), "similarity": similarity})


def _column(values: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.array(values, from_pandas=True).cast(kind)


def _best(rows: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
    """Best partner in ``block`` for each of ``rows``, -inf where there is none; ties go to the smallest id."""
    block = block.sort_values("id")
    ids = block["id"].to_numpy()
    own = rows["id"].to_numpy()
    mine, others = _unit_rows(rows["vector"]), _unit_rows(block["vector"])
    first, last = np.searchsorted(ids, own), np.searchsorted(ids, own, "right")
    twice = (last - first).max(initial=0) > 1
    best, found = np.empty(len(rows), np.int64), np.empty(len(rows))
    for part in _slices(len(rows), len(block)):
        similarity = mine[part] @ others.T
        np.round(similarity, _TIE_DIGITS, out=similarity)
        if twice:
            for r, lo, hi in zip(range(len(similarity)), first[part], last[part]):
                equal = lo + np.flatnonzero((others[lo:hi] == mine[part][r]).all(axis=1))
                whole = similarity[r, equal[1:]]  # a row that comes twice is its own partner
                similarity[r, lo:hi] = -np.inf
                similarity[r, equal[1:]] = whole
        else:
            same = np.flatnonzero(last[part] > first[part])
            similarity[same, first[part][same]] = -np.inf
        best[part] = similarity.argmax(axis=1)
        found[part] = similarity[np.arange(len(similarity)), best[part]]
    return _found(own, ids[best], found)


class _Block:
    """Rows of one block, sorted by id, with the best partners known so far."""

    def __init__(self, number: int, ids: np.ndarray, vectors: bytes, partner: np.ndarray, best: np.ndarray, better: np.ndarray | None = None):
        self.number, self.ids, self.partner, self.best, self.better = number, ids, partner, best, better
        self.vectors = np.frombuffer(vectors, np.float32).reshape(len(ids), -1)
        self.lengths = _lengths(self.vectors.astype(np.float64))
        self.unit = (self.vectors / self.lengths[:, None]).astype(np.float32)

    def exact(self, rows: np.ndarray) -> np.ndarray:
        return self.vectors[rows] / self.lengths[rows, None]

    def angles(self, centres: np.ndarray) -> np.ndarray:
        return np.arccos(np.clip(self.vectors.astype(np.float64) @ centres.T / self.lengths[:, None], -1.0, 1.0))

    def take(self, rows: np.ndarray, partners: np.ndarray, similarity: np.ndarray) -> None:
        """Keep the offered partners, one for each of ``rows``, that beat the known ones."""
        wins = similarity > self.best[rows]
        ties = np.flatnonzero((similarity == self.best[rows]) & (similarity > -np.inf))
        wins[ties] = (partners[ties] < self.partner[rows[ties]]).astype(bool)
        rows = rows[wins]
        self.best[rows], self.partner[rows], self.better[rows] = similarity[wins], partners[wins], True

    def offer(self, rows: np.ndarray, other: _Block, at: np.ndarray) -> None:
        """Compare pairs of rows exactly; a row may come more than once."""
        for begin in range(0, len(rows), SLICE_CELLS >> 6):
            i, j = rows[begin : begin + (SLICE_CELLS >> 6)], at[begin : begin + (SLICE_CELLS >> 6)]
            similarity = np.round(np.einsum("ij,ij->i", self.exact(i), other.exact(j)), _TIE_DIGITS)
            order = np.lexsort((j, -similarity, i))
            order = order[np.flatnonzero(np.diff(i[order], prepend=-1))]
            self.take(i[order], other.ids[j[order]], similarity[order])


def _entries(similarity: np.ndarray, top: np.ndarray, best: np.ndarray, band: float) -> tuple[np.ndarray, np.ndarray]:
    """Places (row, column) whose entry may be, but for rounding, the largest of its row and not below ``best``."""
    rows = np.flatnonzero((top >= best - band) & (top > -np.inf))
    i, j = np.nonzero(similarity[rows] >= np.maximum(top[rows], best[rows])[:, None] - band)
    return rows[i], j


def _compare(x: _Block, rows: np.ndarray, y: _Block, columns: np.ndarray) -> None:
    """Let rows of two blocks learn of each other.

    Single precision finds the few pairs that can matter: whatever is nearer to
    the largest similarity than twice the error of a product, with room to
    spare. These are compared again in double precision. Where too many are as
    near as that, the whole slice is.
    """
    band = 2.0 * (x.vectors.shape[1] + 16) * 2.0**-23 + 10.0**-_TIE_DIGITS
    first, last = np.searchsorted(y.ids, x.ids), np.searchsorted(y.ids, x.ids, "right")
    shared = np.flatnonzero(last > first)  # a row is no partner of its own key
    units, room = y.unit[columns], None
    for part in _slices(len(rows), len(columns)):
        own = rows[part]
        hidden = [(r, np.flatnonzero((columns >= first[p]) & (columns < last[p]))) for p in shared for r in np.flatnonzero(own == p)]
        room = np.empty((len(own), len(columns)), np.float32) if room is None else room  # touched once, used for all slices
        similarity = np.matmul(x.unit[own], units.T, out=room[: len(own)])
        for r, at in hidden:
            similarity[r, at] = -np.inf
        i, j = _entries(similarity, similarity.max(axis=1), x.best[own], band)
        l, k = _entries(similarity.T, similarity.max(axis=0), y.best[columns], band)
        if len(i) + len(l) <= similarity.size >> 5:
            x.offer(own[i], y, columns[j])
            y.offer(columns[l], x, own[k])
            continue
        exact = np.round(x.exact(own) @ y.exact(columns).T, _TIE_DIGITS)
        for r, at in hidden:
            exact[r, at] = -np.inf
        j, k = exact.argmax(axis=1), exact.argmax(axis=0)
        x.take(own, y.ids[columns[j]], exact[np.arange(len(own)), j])
        y.take(columns, x.ids[own[k]], exact[k, np.arange(len(columns))])


def _meet(x: _Block, y: _Block, x_open: np.ndarray, y_open: np.ndarray) -> None:
    """Compare the rows of ``x`` to which ``y`` is open with ``y``, then the others with rows of ``y`` to which ``x`` is."""
    if x_open.any():
        _compare(x, np.flatnonzero(x_open), y, np.arange(len(y.ids)))
    if y_open.any() and not x_open.all():
        _compare(x, np.flatnonzero(~x_open), y, np.flatnonzero(y_open))


class _Layout:
    """Which blocks the rows of a cell go to, and which cells a row has to search.

    Cells are taken in a chain of near ones. What fits goes to one block
    together; a cell of more rows than a block has several of its own.
    """

    def __init__(self, centres: np.ndarray, cells: list[tuple[int, float, int]], block_rows: int):
        radius, rows = np.full(len(centres), -np.inf), np.zeros(len(centres), np.int64)
        for cell, reach, count in cells:
            radius[cell], rows[cell] = reach, count
        self.centres, self.radius = centres, radius
        self.first, self.parts = np.zeros((2, len(centres)), np.int32)
        self.blocks = block = room = 0
        left = rows > 0
        at = int(left.argmax())
        while left[at]:
            left[at] = False
            if rows[at] > block_rows:
                self.first[at], self.parts[at] = self.blocks, ceil(rows[at] / block_rows)
                self.blocks += int(self.parts[at])
            else:
                if rows[at] > room:
                    block, room = self.blocks, block_rows
                    self.blocks += 1
                self.first[at], self.parts[at] = block, 1
                room -= rows[at]
            at = int(np.where(left, centres @ centres[at], -np.inf).argmax())
        self.cells = [np.flatnonzero((self.first <= b) & (b < self.first + self.parts)) for b in range(self.blocks)]

    def open(self, rows: _Block, cells: np.ndarray) -> np.ndarray:
        """For each row and cell, whether the cell may hold a partner at least as good as the known one."""
        reach = np.cos(np.maximum(rows.angles(self.centres[cells]) - self.radius[cells], 0.0))
        return reach + _SLACK >= rows.best[:, None]

    def open_blocks(self, rows: _Block) -> np.ndarray:
        """For each block, whether any row has to search it."""
        flags = np.zeros(self.blocks, bool)
        cells = np.flatnonzero(self.parts)
        for part in _slices(len(cells), len(rows.ids)):
            for cell in cells[part][self.open(rows, cells[part]).any(axis=0)]:
                flags[self.first[cell] : self.first[cell] + self.parts[cell]] = True
        return flags


def _first_copies(rows: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """The two smallest keys of equal vectors, numbered by ``copy``, and all rows that may have more copies, if any.

    Equal vectors have equal hashes, so the vectors themselves are dealt out
    only where a hash comes more than twice.
    """
    rows = rows.withColumn("hash", F.xxhash64("vector"))
    often = materialise(rows.groupBy("hash").count().where("count > 2").select("hash"))
    if not often.limit(1).count():
        return rows.drop("hash").withColumn("copy", F.lit(1)), None
    few = broadcast_if_small(often, MAX_HASHES)
    copied = rows.join(few, "hash", "left_semi").drop("hash")
    number = F.row_number().over(Window.partitionBy("vector").orderBy("id"))
    numbered = copied.withColumn("copy", number).where("copy <= 2")
    return rows.join(few, "hash", "left_anti").drop("hash").withColumn("copy", F.lit(1)).unionByName(numbered), copied


def nearest_neighbours(
    vectors: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    pivots: int | None = None,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """``key``, ``closest_<key>`` and ``closest_similarity`` for every vector.

    Similarities are compared after rounding to nine decimals, and ties go to
    the smallest key. Keys must be unique. The number of pivots is at most
    ``MAX_PIVOTS``; they, one row of limits per cell and the hashes of copied
    vectors are all that is broadcast. Vectors with a component that is no
    finite number take no part.

    Of equal vectors only the two smallest keys take part in the search: no
    other copy can be the smallest of a tie, and its own answer is that of
    the second copy. So a vector with very many copies costs nothing.
    """
    rows = vectors.select(F.col(key).alias("id"), F.col(vector).cast("array<float>").alias("vector"))
    kept, copied = _first_copies(rows)
    assigned = _assigned(kept, _centres(rows, pivots or max(1, int(rows.count() ** 0.5))))
    found = _pivot_join(*assigned, block_rows)
    if copied is not None:
        found = materialise(found)
        answers = assigned[0].where("copy = 2").join(found, "id").select("vector", "partner", "similarity")
        further = copied.join(assigned[0].select("id"), "id", "left_anti").join(answers, "vector")
        found = found.unionByName(further.select("id", "partner", "similarity"))
    return found.select(
        F.col("id").alias(key),
        F.col("partner").alias(f"closest_{key}"),
        F.col("similarity").alias("closest_similarity"),
    )


def _centres(rows: DataFrame, pivots: int) -> np.ndarray:
    """Different unit vectors of rows chosen by hash."""
    chosen = rows.orderBy(F.xxhash64("id"), "id").limit(min(pivots, MAX_PIVOTS)).select("vector").collect()
    if not chosen:
        return np.zeros((1, 1))
    units = _unit_rows(pd.Series([np.array(r["vector"], dtype=np.float64) for r in chosen]))
    units = np.unique(units[np.isfinite(units).all(axis=1)], axis=0)
    return units if len(units) else np.zeros((1, len(chosen[0]["vector"])))


def _assigned(rows: DataFrame, centres: np.ndarray) -> tuple[DataFrame, np.ndarray]:
    """``id, vector, copy`` with the cell and the angle to its pivot, stored; the pivots."""
    shared = rows.sparkSession.sparkContext.broadcast(centres)

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for part in _slices(len(batch), len(shared.value)):
                out = batch.iloc[part]
                units = _unit_rows(out["vector"])
                finite = np.isfinite(units).all(axis=1)
                out, near = out[finite].copy(), np.clip(units[finite] @ shared.value.T, -1.0, 1.0)
                cell = near.argmax(axis=1)
                out["cell"] = cell.astype(np.int32)
                out["angle"] = np.arccos(near[np.arange(len(out)), cell])
                yield out

    kind = rows.schema["id"].dataType.simpleString()
    return materialise(rows.mapInPandas(assign, f"id {kind}, vector array<float>, copy int, cell int, angle double")), centres


def _packed(assigned: DataFrame, layout: _Layout) -> DataFrame:
    """A row for each block: its rows with their partners in the block, and the blocks that they have to search."""
    spark = assigned.sparkSession
    places = [(int(c), int(layout.first[c]), int(layout.parts[c])) for c in np.flatnonzero(layout.parts)]  # at most MAX_PIVOTS rows
    places = spark.createDataFrame(places, "cell int, first int, parts int")
    part = F.pmod(F.xxhash64("id", "vector"), F.col("parts")).cast("int")
    blocked = assigned.join(F.broadcast(places), "cell").select((F.col("first") + part).alias("block"), "id", "vector")
    shared = spark.sparkContext.broadcast(layout)

    def pack(table: pa.Table) -> pa.Table:
        table = table.sort_by("id")
        number, ids = table.column("block")[0].as_py(), table.column("id").combine_chunks()
        frame = table.select(["id", "vector"]).to_pandas()
        found = _best(frame, frame)
        partner, best = found["partner"].to_numpy(), found["similarity"].to_numpy()
        vectors = np.stack(frame["vector"].to_numpy()).astype(np.float32).tobytes()
        flags = shared.value.open_blocks(_Block(number, found["id"].to_numpy(), vectors, partner, best))
        one = lambda values: pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)
        return pa.table({
            "block": pa.array([number], pa.int32()),
            "ids": one(ids),
            "vectors": pa.array([vectors], pa.binary()),
            "partners": one(_column(partner, ids.type)),
            "best": one(pa.array(best, pa.float64())),
            "open": one(pa.array(flags)),
        })

    kind = assigned.schema["id"].dataType.simpleString()
    schema = f"block int, ids array<{kind}>, vectors binary, partners array<{kind}>, best array<double>, open array<boolean>"
    return materialise(blocked.groupBy("block").applyInArrow(pack, schema))


def _pivot_join(assigned: DataFrame, centres: np.ndarray, block_rows: int) -> DataFrame:
    """``id, partner, similarity`` of the nearest other row for ``id, vector, cell, angle``."""
    spark = assigned.sparkSession
    limits = assigned.groupBy("cell").agg(F.max("angle"), F.count("*"))
    layout = _Layout(centres, [tuple(r) for r in limits.collect()], block_rows)  # at most MAX_PIVOTS rows
    packed = _packed(assigned, layout)
    pairs = F.explode(F.arrays_zip(F.col("ids").alias("id"), F.col("partners").alias("partner"), F.col("best").alias("similarity")))
    local = packed.select(pairs.alias("p")).select("p.*").where("similarity >= -2")
    found = local.unionByName(_remote(packed, layout)) if layout.blocks > 1 else local
    # Largest similarity, then smallest partner, in one aggregate that combines before the shuffle.
    best = found.groupBy("id").agg(F.min(F.struct((-F.col("similarity")).alias("distance"), F.col("partner"))).alias("best"))
    return best.select("id", "best.partner", (-F.col("best.distance")).alias("similarity"))


def _remote(packed: DataFrame, layout: _Layout) -> DataFrame:
    """Better partners than the known ones, from other blocks.

    Of the two orders of a pair the sum of the numbers chooses one, so spans
    of blocks on either side share the work evenly.
    """
    spark = packed.sparkSession
    shared = spark.sparkContext.broadcast(layout)
    kind = packed.schema["ids"].dataType.elementType.simpleString()
    spans = min(MAX_SPANS, max(4, ceil((6 * spark.sparkContext.defaultParallelism) ** 0.5)))
    side = lambda name: packed.coalesce(spans).select(*(F.col(c).alias(f"{name}_{c}") for c in packed.columns))
    even = (F.col("x_block") + F.col("y_block")) % 2 == 0
    order = F.when(F.col("x_block") < F.col("y_block"), even).otherwise(~even & (F.col("x_block") != F.col("y_block")))
    wanted = F.get("x_open", F.col("y_block")) | F.get("y_open", F.col("x_block"))
    pairs = side("x").join(side("y").hint("shuffle_replicate_nl"), order & wanted).drop("x_open", "y_open")

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[int, tuple[np.ndarray, ...]] = {}
        x = None
        key_type = pa.null()

        def block(batch: pa.RecordBatch, row: int, name: str) -> _Block:
            """The block as it comes, with what it has learned in this task."""
            value = lambda c: batch.column(f"{name}_{c}")[row]
            number = value("block").as_py()
            plain = lambda c: value(c).values.to_numpy(zero_copy_only=False)
            if number not in known:  # copies, since a view would hold the whole batch
                ids, partner, best = (plain(c).copy() for c in ("ids", "partners", "best"))
                known[number] = ids, partner, best, np.zeros(len(ids), bool)
            ids, *learned = known[number]
            return _Block(number, ids, value("vectors").as_buffer(), *learned)

        for batch in batches:
            key_type = batch.schema.field("x_ids").type.value_type
            for row in range(batch.num_rows):
                if x is None or x.number != batch.column("x_block")[row].as_py():
                    x = block(batch, row, "x")
                y = block(batch, row, "y")
                cells = shared.value.cells
                _meet(x, y, shared.value.open(x, cells[y.number]).any(axis=1), shared.value.open(y, cells[x.number]).any(axis=1))
        for ids, partner, best, better in known.values():
            columns = [_column(ids[better], key_type), _column(partner[better], key_type), pa.array(best[better], pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "partner", "similarity"])

    return pairs.mapInArrow(meet, f"id {kind}, partner {kind}, similarity double")


def with_titles(closest: DataFrame, articles: DataFrame, key: str = "article_id") -> DataFrame:
    """Own title and text, and the title of the neighbour.

    Articles that nobody asked for are dropped by a filter of the keys before
    their titles are dealt out. A popular neighbour repeats on the left side
    only; Spark splits such a partition at run time because the right side is
    unique.
    """
    closest = materialise(closest)
    articles = _asked_for(articles.select(key, "title", "text"), closest, key)
    own = closest.join(articles, key, "left")
    other = articles.select(F.col(key).alias(f"closest_{key}"), F.col("title").alias("closest_title"))
    return own.join(other, f"closest_{key}", "left")


def _asked_for(articles: DataFrame, closest: DataFrame, key: str) -> DataFrame:
    """The articles of all keys on either side of ``closest``, and a few others."""
    keys = closest.select(F.explode(F.array(key, f"closest_{key}")).alias("id"))
    pages = page_count(closest.count())  # nearly every neighbour is a key too
    if pages > MAX_PAGES or articles.schema[key].dataType != keys.schema["id"].dataType:
        return articles
    known = materialise(key_filter(keys, "id", pages))
    return with_maybe(articles, F.broadcast(known), key, pages).where("maybe").drop("maybe")
