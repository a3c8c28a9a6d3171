"""Writers: landing files by month, appended tables and versioned snapshots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import StructType

from newsflow import schemas
from newsflow.functions.dates import lenient_date, partition_month, partition_year
from newsflow.functions.urls import archive_file, archive_month, archive_year
from newsflow.operators.dedup import first_per_key
from newsflow.operators.merge import new_rows


def land_articles(lines: DataFrame, root: str) -> None:
    """Append lines as JSON below ``year=/month=``; an unreadable date means this month.

    Rebalancing gathers the rows of a month into few files and cuts a month
    that holds much of the data into several.
    """
    day = lenient_date(F.col("date").cast("string"))
    parted = lines.withColumn("year", partition_year(day)).withColumn("month", partition_month(day))
    parted.hint("rebalance", "year", "month").write.partitionBy("year", "month").mode("append").json(root)


def land_archive_lines(lines: DataFrame, root: str, path: str = "warc_path", replace: bool = False) -> None:
    """Write lines as JSON below year, month and archive, as found in the archive's path.

    They are added to what is there, or with ``replace`` take the place of the
    lines of the same archives, so that a repeated run lands nothing twice.
    """
    parted = (
        lines.withColumn("year", archive_year(F.col(path)))
        .withColumn("month", archive_month(F.col(path)))
        .withColumn("archive", archive_file(F.col(path)))
    )
    parts = ["year", "month", "archive"]
    writer = parted.hint("rebalance", *parts).write.partitionBy(*parts)
    writer = writer.mode("overwrite").option("partitionOverwriteMode", "dynamic") if replace else writer.mode("append")
    writer.json(root)


def landing_line(articles: DataFrame) -> DataFrame:
    """Add the time of collection to feed lines."""
    stamp = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return articles.withColumn("collected_at", stamp)


def to_json_lines(df: DataFrame) -> DataFrame:
    """One JSON text per row; characters beyond ASCII stay as they are."""
    return df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value"))


def table_exists(spark: SparkSession, path: str) -> bool:
    """Has anything been written to this path?"""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def read_table(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A parquet table; empty where nothing has been written yet."""
    if not table_exists(spark, path):
        return spark.createDataFrame([], schema)
    return schemas.align(spark.read.schema(schema).parquet(path), schema)


def append_if_absent(
    batch: DataFrame,
    path: str,
    order: list[Column],
    key: str = "article_id",
    schema: StructType = schemas.ARTICLES,
    partition: str | None = None,
) -> dict[str, int]:
    """Append the rows whose key is not stored and count them.

    The first row of a key wins and stored rows never change, so a repeated
    run adds nothing. Both counts come from the write itself.
    """
    spark = batch.sparkSession
    offered, written = Observation(), Observation()
    firsts = first_per_key(batch, [key], order).observe(offered, F.count("*").alias("n"))
    new = new_rows(firsts, read_table(spark, path, schema), batch, key)
    new = schemas.align(new, schema).observe(written, F.count("*").alias("n"))
    writer = new.write.mode("append")
    if partition:
        writer = new.hint("rebalance", partition).write.mode("append").partitionBy(partition)
    writer.parquet(path)
    return {"rows_in_df": offered.get["n"], "inserted_estimate": written.get["n"]}


def append_rows(df: DataFrame, path: str, schema: StructType) -> None:
    """Append rows whose keys are known to be new. Jobs over disjoint keys may do so at once."""
    schemas.align(df, schema).write.mode("append").parquet(path)


def _versions(spark: SparkSession, root: str, complete: bool = True) -> list[int]:
    """Snapshots below ``root``, complete ones or all that were begun."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    filesystem = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not filesystem.exists(path):
        return []
    found = filesystem.globStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{root}/version=*" + "/_SUCCESS" * complete))
    paths = [s.getPath().getParent() if complete else s.getPath() for s in found or []]
    return sorted(int(p.getName().split("=")[1]) for p in paths)


def read_snapshot(spark: SparkSession, root: str, schema: StructType) -> DataFrame:
    """The latest complete snapshot; empty where there is none."""
    versions = _versions(spark, root)
    if not versions:
        return spark.createDataFrame([], schema)
    return schemas.align(spark.read.schema(schema).parquet(f"{root}/version={versions[-1]}"), schema)


def publish_snapshot(df: DataFrame, root: str, schema: StructType) -> int:
    """Write a new state next to the old ones; it counts once its write is complete.

    The state being read is never overwritten, and a failed write leaves the
    former snapshot in force. A version that someone else has begun is never
    written to: of two writers at once the later one fails.
    """
    versions = _versions(df.sparkSession, root, complete=False)
    version = versions[-1] + 1 if versions else 1
    schemas.align(df, schema).write.mode("errorifexists").parquet(f"{root}/version={version}")
    return version


def drop_snapshots(spark: SparkSession, root: str, keep: int = 2) -> int:
    """Remove all but the last ``keep`` complete snapshots; how many went."""
    old = _versions(spark, root)[: -max(keep, 1)]
    for version in old:
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/version={version}")
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return len(old)
