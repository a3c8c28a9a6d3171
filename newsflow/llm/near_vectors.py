"""Near-duplicate vectors by a forest of random-projection trees with overlapping splits."""

from __future__ import annotations

import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from newsflow.llm.common import bounded_batches, id_type
from newsflow.llm.links import PAIRED, first_shared, in_blocks, labelled, summed_up
from newsflow.session import materialise

TREES = 4
LEAF = 512
SPILL = 0.75
SAMPLE = 30_000  # vectors that the splits are fitted on; every vector is indexed
FORESTS = 16  # of different lengths
PROBE, PROBE_PAIRS = 1_000, 5_000  # vectors and close pairs that judge the splits of a node
LARGE = 4  # a leaf of so many times the wanted rows is split again, on rows of its own
CHUNK = 20_000  # rows of a large leaf that one call routes
KEPT = 0.6  # share of a node's close pairs that the splits above and at it leave together, in one tree
TILE = 1024  # vectors compared with all of their piece at once


def _units(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """Per row: id and the bytes of its unit vector in double precision; null if it has no direction."""
    bounded_batches(df.sparkSession)
    chosen = df.select(F.col(id_col).alias("id"), F.col(vec_col).cast("array<double>").alias("vec"))

    def unit(values) -> bytes | None:
        if values is None or any(v is None for v in values):
            return None
        x = np.array(values, float)
        top = np.abs(x).max(initial=0.0)
        if not len(x) or not np.isfinite(x).all() or top == 0:
            return None
        x = x / top
        return (x / np.sqrt(x @ x) + 0.0).tobytes()

    def run(batches):
        for batch in batches:
            units = [unit(v.as_py()) for v in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(units, pa.binary())], names=["id", "unit"])

    return chosen.mapInArrow(run, f"id {id_type(df, id_col)}, unit binary")


class Forest:
    """Trees of random splits. A vector near a split goes down both sides.

    A split is taken where the node's own pairs at ``threshold`` show that it
    parts few of them and that it saves work; along a path at least KEPT of
    them stay together. A region too dense for that is one leaf.
    """

    def __init__(self, sample: np.ndarray, trees: int, leaf: int, margin: float, threshold: float, seed: int = 0) -> None:
        self.random, self.margin, self.threshold, self.leaves = np.random.default_rng(seed), margin, threshold, 0
        self.directions: list[np.ndarray] = []
        self.nodes: list[tuple] = []  # (direction, split, left, right), or (leaf,)
        self.roots = [self._grow(sample, np.arange(len(sample)), leaf, 0, 1.0) for _ in range(trees)]
        self.random = None

    def _grow(self, sample: np.ndarray, rows: np.ndarray, leaf: int, depth: int, kept: float) -> int:
        at = len(self.nodes)
        self.nodes.append(())
        best = self._split(sample[rows], kept) if len(rows) > leaf and depth < 40 else None
        if best is None:
            self.nodes[at] = (self.leaves,)  # small enough, or too much alike to be split
            self.leaves += 1
            return at
        _, direction, split, kept = best
        self.directions.append(direction)
        number, place = len(self.directions) - 1, sample[rows] @ direction
        left, right = rows[place <= split + self.margin], rows[place > split - self.margin]
        self.nodes[at] = (number, split, self._grow(sample, left, leaf, depth + 1, kept), self._grow(sample, right, leaf, depth + 1, kept))
        return at

    def _split(self, points: np.ndarray, kept: float) -> tuple | None:
        """Of some directions and places the one that parts the fewest close pairs for the work it saves."""
        if len(points) > PROBE:
            points = points[self.random.choice(len(points), PROBE, replace=False)]
        a, b = np.nonzero(np.triu(points @ points.T >= self.threshold, 1))
        if len(a) > PROBE_PAIRS:
            some = self.random.choice(len(a), PROBE_PAIRS, replace=False)
            a, b = a[some], b[some]
        best = None
        for _ in range(8):
            direction = self.random.standard_normal(points.shape[1])
            direction /= np.sqrt(direction @ direction)
            place = points @ direction
            low, high = np.minimum(place[a], place[b]), np.maximum(place[a], place[b])
            for split in map(float, np.quantile(place, (0.3, 0.4, 0.5, 0.6, 0.7))):
                left, right = (place <= split + self.margin).mean(), (place > split - self.margin).mean()
                work = left**2 + right**2
                loss = ((low <= split - self.margin) & (high > split + self.margin)).mean() if len(a) >= 20 else 0.0
                if work <= 0.8 and kept * (1 - loss) >= KEPT and (best is None or loss + work / 4 < best[0]):
                    best = loss + work / 4, direction, split, kept * (1 - loss)
        return best

    def leaves_of(self, x: np.ndarray) -> list[list[int]]:
        found: list[list[int]] = [[] for _ in x]
        todo = [(root, np.arange(len(x))) for root in self.roots]
        while todo:
            at, rows = todo.pop()
            node = self.nodes[at]
            if len(node) == 1:
                for r in rows:
                    found[r].append(node[0])
            elif len(rows):
                place = x[rows] @ self.directions[node[0]]
                todo.append((node[2], rows[place <= node[1] + self.margin]))
                todo.append((node[3], rows[place > node[1] - self.margin]))
        return found


_PLACED = "leaf long, cls long, size long, unit binary"


def _split_again(members: DataFrame, leaf: int, margins: dict[int, float], threshold: float, trees_sample: int) -> DataFrame | None:
    """``members`` (leaf, cls, size, unit) with large leaves split by trees of their own; None if none was split.

    The forest is fitted on a bounded sample of the table, so in a large table
    its leaves hold many rows. A tree is fitted on a bounded sample of each
    such leaf, inside a task, and the leaf's rows run down it in chunks. That
    is repeated until no leaf is large but those too dense to be split.
    """
    done = None
    while True:
        sizes = members.groupBy("leaf").agg(F.count("*").alias("n"), F.max(F.length("unit")).alias("width")).where(F.col("n") > LARGE * leaf)
        large = materialise(sizes.where(F.col("width").isin(*margins)))
        if large.isEmpty():
            return None if done is None else members.unionByName(done)
        rows = members.join(large, "leaf")
        drawn = F.pmod(F.xxhash64("unit", "leaf"), F.lit(1 << 20)) < trees_sample / F.col("n") * (1 << 20)

        def fit(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
            units = table.column("unit").to_pylist()
            n, number = table.column("n")[0].as_py(), key[0].as_py()
            points = np.stack([np.frombuffer(u) for u in units])
            tree = Forest(points, 1, max(8, leaf * len(points) // n), margins[len(units[0])], threshold, abs(number))
            return pa.table({"leaf": [number], "tree": pa.array([pickle.dumps(tree)], pa.binary()), "leaves": [tree.leaves], "n": [n]})

        trees = rows.where(drawn).select("leaf", "n", "unit").groupBy("leaf").applyInArrow(fit, "leaf long, tree binary, leaves long, n long")
        trees = materialise(trees)
        split = trees.where("leaves > 1")
        if split.isEmpty():
            return None if done is None else members.unionByName(done)
        untouched = members.join(split.select("leaf"), "leaf", "left_anti")
        dense = untouched.join(large.select("leaf"), "leaf", "left_semi")
        chunks = lambda n: F.ceil(n / CHUNK).cast("int")
        dealt = members.join(split.select("leaf", "n"), "leaf").withColumn("chunk", F.pmod(F.xxhash64("cls"), chunks(F.col("n"))).cast("int"))
        copies = split.select("leaf", "tree", F.explode(F.sequence(F.lit(0), chunks(F.col("n")) - 1)).alias("chunk"))

        def route(table: pa.Table, copies: pa.Table) -> pa.Table:
            if not len(table) or not len(copies):
                return pa.table({"leaf": pa.array([], pa.int64()), "cls": pa.array([], pa.int64()), "size": pa.array([], pa.int64()), "unit": pa.array([], pa.binary())})
            tree: Forest = pickle.loads(copies.column("tree")[0].as_py())
            found = tree.leaves_of(np.stack([np.frombuffer(u) for u in table.column("unit").to_pylist()]))
            at = np.repeat(np.arange(len(found)), [len(f) for f in found])
            taken = table.take(pa.array(at))
            return pa.table({"leaf": taken.column("leaf"), "cls": taken.column("cls"), "size": taken.column("size"), "unit": taken.column("unit"), "part": pa.array(np.concatenate([np.array(f, "int64") for f in found]))})

        parts = dealt.select("leaf", "chunk", "cls", "size", "unit").groupBy("leaf", "chunk").cogroup(copies.groupBy("leaf", "chunk")).applyInArrow(route, _PLACED + ", part long")
        parts = parts.select(F.xxhash64("leaf", "part").alias("leaf"), "cls", "size", "unit")
        done = dense if done is None else done.unionByName(dense)
        small = untouched.join(large.select("leaf"), "leaf", "left_anti")
        members = materialise(small.unionByName(parts))
        done = materialise(done)


def _met_before(leaves: list[np.ndarray], start: int, this: int) -> np.ndarray:
    """Which members of the tile at ``start`` share a leaf before ``this`` with which others, as ``first_shared`` by products."""
    row = np.repeat(np.arange(len(leaves)), [len(v) for v in leaves])
    leaf = np.concatenate(leaves)
    row, leaf = row[leaf < this], leaf[leaf < this]
    met = np.zeros((min(TILE, len(leaves) - start), len(leaves)), bool)
    # Only leaves that some member of the tile is in.
    inside = np.unique(leaf[(row >= start) & (row < start + TILE)])
    for at in range(0, len(inside), 256):
        part = inside[at : at + 256]
        column = np.minimum(np.searchsorted(part, leaf), len(part) - 1)
        there = part[column] == leaf
        marks = np.zeros((len(leaves), len(part)), "float32")
        marks[row[there], column[there]] = 1
        met |= marks[start : start + TILE] @ marks.T > 0
    return met


def link_vectors(
    df: DataFrame,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    threshold: float = 0.95,
    trees: int = TREES,
    leaf: int = LEAF,
    spill: float = SPILL,
    sample: int = SAMPLE,
) -> DataFrame:
    """Per row: id, n_links (other vectors linked directly), component_id and kept.

    Vectors link if the forest brings them together and their cosine, in
    double precision, is at least ``threshold``; none below it link. Trees are
    fitted on at most ``sample`` vectors chosen by hash; all vectors run down
    them. ``spill`` is the overlap of splits, in standard deviations of how far
    a pair at the threshold lies apart along a random direction. A split that
    would part too many of the close pairs of its node is not made, so a dense
    region stays one leaf. Leaves that hold more rows than a sample shows are
    split again on rows of their own, so they do not grow with the table. Equal vectors are one class and always link. Leaves beyond ``leaf`` vectors are compared
    in pairs of blocks, without a limit; pairs are counted where they are found
    and not written out.

    Null, empty and zero vectors, and vectors with null or non-finite
    components, link with nothing. Only vectors of one length link. Each of the
    FORESTS most frequent lengths has a forest of its own; the vectors of any
    rarer length are one leaf, compared exactly. component_id is the least id of a
    component; null ids count as ids only where there are no others. Repeated
    rows are copies of one another. An empty table gives no rows; other columns
    are not read. ``kept`` is whether the id is the component's.
    """
    rows = materialise(_units(df, id_col, vec_col))
    grouped = rows.where("unit IS NOT NULL").groupBy("unit").agg(F.min("id").alias("least_id"), F.count("*").alias("size"))
    classes = materialise(grouped.withColumn("cls", F.monotonically_increasing_id()))
    widths = classes.groupBy(F.length("unit").alias("width")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "width").limit(FORESTS).collect()
    if not widths:
        return rows.select(F.col("id").alias(id_col), F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"), F.lit(True).alias("kept"))
    total, forests, first_leaf, margins = classes.count(), {}, 0, {}
    for width, n in widths:
        if n <= leaf:
            continue  # as one leaf
        share = min(sample, max(sample // FORESTS, sample * n // total))
        fitted = classes.where(F.length("unit") == width).select("unit", F.xxhash64("unit").alias("_h")).orderBy("_h", "unit").limit(share).collect()
        points = np.stack([np.frombuffer(r["unit"]) for r in fitted])
        margin = spill * np.sqrt(2 - 2 * threshold) / np.sqrt(width / 8) / 2
        # So many sample points that a leaf holds about ``leaf`` of all vectors.
        margins[width] = margin
        forests[width] = first_leaf, Forest(points, trees, max(8, leaf * len(points) // n), margin, threshold)
        first_leaf += forests[width][1].leaves
    forest = df.sparkSession.sparkContext.broadcast(forests)

    def leaves_of(units: list[bytes]) -> list[list[int]]:
        """Leaves by row; numbers below 0 are lengths without a forest."""
        found = [[-len(u)] for u in units]
        lengths = np.array([len(u) for u in units])
        for width, (first, trees) in forest.value.items():
            own = np.flatnonzero(lengths == width)
            if len(own):
                for r, placed in zip(own, trees.leaves_of(np.stack([np.frombuffer(units[r]) for r in own]))):
                    found[r] = [first + x for x in placed]
        return found

    def route(batches):
        for batch in batches:
            leaves = leaves_of(batch.column("unit").to_pylist())
            placed = [(r, leaf) for r, own in enumerate(leaves) for leaf in own]
            for start in range(0, len(placed), 20_000):
                part = placed[start : start + 20_000]
                taken = batch.take(pa.array([r for r, _ in part], pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([leaf for _, leaf in part], pa.int64()),
                        taken.column("cls"),
                        taken.column("size"),
                        taken.column("unit"),
                        pa.array([leaves[r] for r, _ in part], pa.list_(pa.int64())),
                    ],
                    names=["leaf", "cls", "size", "unit", "leaves"],
                )

    members = materialise(classes.select("cls", "size", "unit").mapInArrow(route, _PLACED + ", leaves array<long>"))
    again = _split_again(members.drop("leaves"), leaf, margins, threshold, max(sample // 4, 16))
    if again is not None:
        leaves_by_class = again.groupBy("cls").agg(F.array_sort(F.collect_set("leaf")).alias("leaves"))
        members = materialise(again.dropDuplicates(["leaf", "cls"]).join(leaves_by_class, "cls"))

    def compare(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        x = np.stack([np.frombuffer(v.as_py()) for v in table.column("unit")])
        own, cls, sizes = (table.column(c).to_numpy() for c in ("_own", "cls", "size"))
        leaves, this = [np.array(v) for v in table.column("leaves").to_pylist()], key[0].as_py()
        found = []
        for start in range(0, len(x), TILE):
            close = np.triu(x[start : start + TILE] @ x.T >= threshold, start + 1)
            if key[1].as_py() != key[2].as_py():
                close &= own[start : start + TILE, None] != own[None, :]
            few = np.count_nonzero(close) <= 50_000
            if not few:
                close &= ~_met_before(leaves, start, this)
            a, b = np.nonzero(close)
            a += start
            if few and len(a):
                once = first_shared(leaves, a, b, this)
                a, b = a[once], b[once]
            if len(a):
                found.append(summed_up(cls, sizes, a, b))
        return pa.concat_tables(found) if found else PAIRED.empty_table()

    pieces = in_blocks(members, "leaf", "cls", F.lit(1), 8 * leaf, 1 << 40)
    paired = pieces.groupBy("leaf", "_i", "_j").applyInArrow(compare, "cls long, links long, root long")
    found = labelled(classes, paired).select("unit", "n_links", "component_id")
    joined = rows.join(found, "unit", "left")
    return joined.select(
        F.col("id").alias(id_col),
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
        F.coalesce("component_id", "id").alias("component_id"),
        F.col("id").eqNullSafe(F.coalesce("component_id", "id")).alias("kept"),
    )
