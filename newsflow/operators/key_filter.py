"""Bloom filters as tables, so that keys which are surely new skip the join with the stored ones.

All bits of a key lie in one page, found by hash, and a page is one of Spark's
own bitmaps. So a filter of any size is a table of pages, built by an
aggregation; looking a key up is one join with a page, whose bits say whether
the key may be stored. Only keys that may be are joined with the stored ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from newsflow.operators.merge import absent_rows
from newsflow.session import materialise

# Fixed value: bits of one of Spark's bitmaps.
PAGE_BITS = 32_768
HASHES = 5
#: Keys of a page for which about one absent key in a hundred looks stored.
KEYS_PER_PAGE = 3_000
FILTER = StructType([StructField("page", LongType(), False), StructField("bits", BinaryType(), False)])


def page_count(keys: int) -> int:
    """Pages for a table that will hold ``keys`` keys; a filter keeps its number for good."""
    return max(1, -(-keys // KEYS_PER_PAGE))


def _page(key: Column, pages: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(0), key), F.lit(pages)).cast("bigint")


def _bit(key: Column, n: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(n), key), F.lit(PAGE_BITS))


def key_filter(keys: DataFrame, key: str, pages: int) -> DataFrame:
    """``page, bits`` of the keys; null keys are in no filter."""
    given = keys.where(F.col(key).isNotNull())
    bits = F.explode(F.array(*(_bit(F.col(key), n) for n in range(1, HASHES + 1))))
    placed = given.select(_page(F.col(key), pages).alias("page"), bits.alias("bit"))
    return placed.groupBy("page").agg(F.bitmap_construct_agg("bit").alias("bits"))


def joined_filters(*filters: DataFrame) -> DataFrame:
    """One filter for the keys of several of the same number of pages."""
    every = filters[0]
    for more in filters[1:]:
        every = every.unionByName(more)
    return every.groupBy("page").agg(F.bitmap_or_agg("bits").alias("bits"))


def with_maybe(batch: DataFrame, filter_table: DataFrame, key: str, pages: int) -> DataFrame:
    """``batch`` with ``maybe``: false where the key is surely not in the filter."""
    found = batch.withColumn("page", _page(F.col(key), pages)).join(filter_table, "page", "left")

    def is_set(n: int) -> Column:
        bit = _bit(F.col(key), n)
        byte = F.conv(F.hex(F.substring(F.col("bits"), F.floor(bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        return F.getbit(byte, (bit % 8).cast("int")) == 1

    maybe = F.col("bits").isNotNull()
    for n in range(1, HASHES + 1):
        maybe = maybe & is_set(n)
    return found.withColumn("maybe", F.coalesce(maybe, F.lit(False))).drop("page", "bits")


def new_rows_by_filter(batch: DataFrame, stored: DataFrame, filter_table: DataFrame, key: str, pages: int) -> DataFrame:
    """Rows of ``batch`` whose key is not stored.

    ``filter_table`` holds at least the stored keys. The batch is marked once
    and written; rows without a chance of being stored are not joined again.
    """
    marked = materialise(with_maybe(batch, filter_table, key, pages))
    surely_new = marked.where("NOT maybe").drop("maybe")
    return surely_new.unionByName(absent_rows(marked.where("maybe").drop("maybe"), stored, key))
