"""Hash shards and vector arithmetic on array columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def shard_of(key: Column, shards: int) -> Column:
    """Shard number from the first 32 bits of the key's hash; the same in any engine."""
    if shards < 1:
        raise ValueError(f"shards must be at least 1, got {shards}")
    bits = F.conv(F.substring(F.sha2(key.cast("string"), 256), 1, 8), 16, 10).cast("bigint")
    return F.pmod(bits, F.lit(shards))


def check_shard(shard: int, shards: int, most: int | None = None) -> None:
    if shards < 1:
        raise ValueError(f"shards must be at least 1, got {shards}")
    if most is not None and shards > most:
        raise ValueError(f"shards must be at most {most}, got {shards}")
    if not 0 <= shard < shards:
        raise ValueError(f"shard must be in [0, {shards}), got {shard}")


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def normalise(a: Column) -> Column:
    """Unit vector as array<float>; a zero vector stays zero.

    The length is bound to a lambda variable, so it is computed once per row.
    """
    scaled = F.transform(
        F.array(norm(a)),
        lambda length: F.transform(
            a, lambda x: F.when(length > 0, x.cast("double") / length).otherwise(0.0).cast("float")
        ),
    )
    return F.get(scaled, F.lit(0))


def cosine(a: Column, b: Column) -> Column:
    lengths = norm(a) * norm(b)
    return F.when(lengths > 0, dot(a, b) / lengths).otherwise(0.0)
