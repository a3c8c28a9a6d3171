"""First, last and first-n rows per key.

``row_number() = 1`` is planned with a group limit before the shuffle, so a
task sends at most one row of a key on: a key that holds a third of all rows
stays cheap. Large limits go through counted spans instead.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

# Spark limits groups before the shuffle up to this many rows
# (spark.sql.optimizer.windowGroupLimitThreshold).
_GROUP_LIMIT = 1000


def first_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """Keep the first row of every key. ``order`` must be total within a key."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).where("_rank = 1").drop("_rank")


def dedup_in_turn(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """De-duplicate by the first key, then what is left by the next one."""
    for key in keys:
        df = first_per_key(df, [key], order)
    return df


def last_value(df: DataFrame, keys: list[str], value: str, order: str) -> DataFrame:
    """The value of the last row of every key, combined before the shuffle."""
    return df.groupBy(*keys).agg(F.max_by(value, order).alias(value))


def first_n_per_key(df: DataFrame, key: str, position: str, n: int, span: int = 10_000) -> DataFrame:
    """Keep the ``n`` rows of lowest ``position`` (unique within ``key``).

    Beyond Spark's group limit, rows are counted per span of positions. The
    running count of a key says how many rows lie before each span, so every
    rank is taken within one span and no task sees a whole hot key.
    """
    if n <= _GROUP_LIMIT:
        window = Window.partitionBy(key).orderBy(position)
        return df.withColumn("_rank", F.row_number().over(window)).where(F.col("_rank") <= n).drop("_rank")
    spanned = df.withColumn("_span", F.floor(F.col(position) / span))
    earlier = Window.partitionBy(key).orderBy("_span").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        spanned.groupBy(key, "_span")
        .count()
        .select(key, "_span", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("_before"))
        .where(F.col("_before") < n)
    )
    within = Window.partitionBy(key, "_span").orderBy(position)
    return (
        spanned.join(starts, [key, "_span"])
        .withColumn("_rank", F.row_number().over(within) + F.col("_before"))
        .where(F.col("_rank") <= n)
        .drop("_span", "_before", "_rank")
    )


def limit_flags(df: DataFrame, key: str, n: int) -> DataFrame:
    """Rows kept per key under a limit of ``n``, and whether the limit was reached."""
    return (
        df.groupBy(key)
        .count()
        .select(
            key,
            F.least("count", F.lit(n)).cast("bigint").alias("written"),
            (F.col("count") >= n).cast("int").alias("stopped_by_limit"),
        )
    )
