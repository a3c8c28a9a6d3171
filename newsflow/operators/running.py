"""Running totals over a whole, sorted data set without a single-task window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from newsflow.session import materialise


def running_total(df: DataFrame, order: list[Column], value: str, name: str, slices: int | None = None) -> DataFrame:
    """Add the running sum of ``value`` in the given total order.

    The rows are range-partitioned into slices, which are written out once so
    that slice numbers cannot change. Each slice sums on its own; the totals
    of the slices before it (one row per slice) are added.
    """
    slices = slices or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sliced = materialise(df.repartitionByRange(slices, *order).withColumn("_slice", F.spark_partition_id()))
    earlier = Window.partitionBy(F.lit(0)).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        sliced.groupBy("_slice")
        .agg(F.sum(value).alias("_total"))
        .select("_slice", F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_offset"))
    )
    within = Window.partitionBy("_slice").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    # One row per slice: the broadcast is bounded by the number of partitions.
    return (
        sliced.join(F.broadcast(offsets), "_slice")
        .withColumn(name, F.sum(value).over(within) + F.col("_offset"))
        .drop("_slice", "_offset")
    )
