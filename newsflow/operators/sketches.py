"""Unique counts kept current: one mergeable sketch per group, beside the exact counts.

A load adds its own sketches; the state is their union. Counting again after
each load would read every url ever stored, a sketch is some kilobytes.
"""

from __future__ import annotations

from math import sqrt

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from newsflow.sources import tables

#: Logarithm of the number of a sketch's buckets.
SIZE = 14
#: Relative standard error of an estimate.
ERROR = 1.04 / sqrt(1 << SIZE)


def unique_sketches(rows: DataFrame, by: list[str], value: str = "url", size: int = SIZE) -> DataFrame:
    """``by`` and ``sketch`` of the values; nulls count nothing."""
    return rows.groupBy(*by).agg(F.hll_sketch_agg(value, F.lit(size)).alias("sketch"))


def merged_sketches(sketches: DataFrame, by: list[str]) -> DataFrame:
    """Sketches of fewer or the same groups."""
    return sketches.groupBy(*by).agg(F.hll_union_agg("sketch").alias("sketch"))


def estimated_unique(sketches: DataFrame, by: list[str], name: str = "unique_urls") -> DataFrame:
    return merged_sketches(sketches, by).select(*by, F.hll_sketch_estimate("sketch").alias(name))


def add_load(spark: SparkSession, rows: DataFrame, root: str, by: list[str], schema: StructType, value: str = "url") -> int:
    """Publish the state at ``root`` with the rows of a load added; its version.

    A load that is added twice changes nothing.
    """
    state = tables.read_snapshot(spark, root, schema)
    return tables.publish_snapshot(merged_sketches(state.unionByName(unique_sketches(rows, by, value)), by), root, schema)
