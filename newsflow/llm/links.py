"""Comparing the members of many groups, and joining what they link into components."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from newsflow.session import materialise

#: Tasks that the rows of one group are dealt out to before they are cut into blocks.
SALTS = 16
PAIRED = pa.schema([("cls", pa.int64()), ("links", pa.int64()), ("root", pa.int64())])


def in_blocks(members: DataFrame, group: str, item: str, weight: Column, most_rows: int, most_weight: int) -> DataFrame:
    """Deal the members of groups out so that all pairs of a group meet, in pieces of bounded size.

    A group beyond ``most_rows`` rows or ``most_weight`` is cut into blocks by a
    hash, and each pair of blocks becomes a piece (``_i``, ``_j``). Groups of
    one member have no pairs and are left out. ``_own`` is the row's block.
    """
    sizes = members.groupBy(group).agg(F.count("*").alias("_n"), F.sum(weight).alias("_w")).where("_n > 1")
    blocks = F.ceil(F.greatest(F.col("_n") / most_rows, F.col("_w") / most_weight)).cast("int")
    # A group may hold most rows, so its rows meet its size in several tasks.
    salted = sizes.select(group, blocks.alias("_blocks"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt"))
    return (
        members.withColumn("_salt", F.pmod(F.xxhash64(item, F.lit(1)), F.lit(SALTS)).cast("int"))
        .join(salted, [group, "_salt"])
        .drop("_salt")
        .withColumn("_own", F.pmod(F.xxhash64(item), F.col("_blocks")).cast("int"))
        .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
        .withColumn("_i", F.least("_own", "_other"))
        .withColumn("_j", F.greatest("_own", "_other"))
        .drop("_other", "_blocks")
    )


def first_shared(groups: list[np.ndarray], a: np.ndarray, b: np.ndarray, this: int) -> np.ndarray:
    """Which pairs have ``this`` as the smallest group they share, so that each pair counts once."""
    member = np.repeat(np.arange(len(groups)), [len(g) for g in groups])
    group = np.concatenate(groups)
    member, group = member[group < this], group[group < this]
    known, place, count = np.unique(group, return_inverse=True, return_counts=True)
    place, member = (np.cumsum(count > 1) - 1)[place[count[place] > 1]], member[count[place] > 1]
    keep = np.ones(len(a), bool)
    # Marks of so many groups at a time as bits: members x 64 groups a word.
    for start in range(0, int((count > 1).sum()), 64):
        own = (place >= start) & (place < start + 64)
        marks = np.zeros(len(groups), "uint64")
        np.bitwise_or.at(marks, member[own], np.uint64(1) << (place[own] - start).astype("uint64"))
        keep &= (marks[a] & marks[b]) == 0
    return keep


def summed_up(cls: np.ndarray, sizes: np.ndarray, a: np.ndarray, b: np.ndarray) -> pa.Table:
    """Links of each member (copies counted), and the least member it is joined with by these pairs."""
    links = np.bincount(a, sizes[b], len(cls)) + np.bincount(b, sizes[a], len(cls))
    root = cls.copy()
    while True:
        low = np.minimum(root[a], root[b])
        before = root.copy()
        np.minimum.at(root, a, low)
        np.minimum.at(root, b, low)
        if (root == before).all():
            break
    some = links > 0
    return pa.table([cls[some], links[some].astype("int64"), root[some]], schema=PAIRED)


def components(edges: DataFrame) -> DataFrame:
    """Connected components of edges (a, b): node, component (the least node).

    Stars alternate: every node hands its larger neighbours to the least one
    it knows, then its smaller ones, until all edges lead to a node that leads
    nowhere. Edges never grow in number, and each round is written to the
    shared folder.
    """
    flat = lambda df: materialise(df.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    edges = flat(edges)
    while not _stars(edges):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = flat(both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")))
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        edges = flat(small.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b"))))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))


def _stars(edges: DataFrame) -> bool:
    """Whether no node has both a larger neighbour and a smaller one, nor two smaller ones."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("low"), F.lit(0).alias("high")).unionByName(
        edges.groupBy("b").agg(F.lit(0).alias("low"), F.lit(1).alias("high")).withColumnRenamed("b", "node")
    )
    return ends.groupBy("node").agg(F.sum("low").alias("low"), F.max("high").alias("high")).where("low > 1 OR (low > 0 AND high > 0)").isEmpty()


def labelled(classes: DataFrame, paired: DataFrame) -> DataFrame:
    """Classes (cls, least_id, size) with n_links of a member and component_id, from compared pieces.

    The component's id is the least id of any of its members; null ids are no
    ids unless there are no others.
    """
    paired = materialise(paired)
    joined = components(paired.select(F.col("cls").alias("a"), F.col("root").alias("b")))
    links = paired.groupBy("cls").agg(F.sum("links").alias("_links"))
    placed = (
        classes.join(joined.withColumnRenamed("node", "cls"), "cls", "left")
        .join(links, "cls", "left")
        .withColumn("component", F.coalesce("component", "cls"))
    )
    placed = materialise(placed)
    ids = placed.groupBy("component").agg(F.min("least_id").alias("component_id"))
    return placed.join(ids, "component").withColumn("n_links", F.coalesce("_links", F.lit(0)) + F.col("size") - 1).drop("_links")


