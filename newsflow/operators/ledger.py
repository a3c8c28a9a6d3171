"""Archive and month ledgers: selection of work, progress and reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from newsflow.functions.text import half_even, percent


def done_archives(ledger: DataFrame) -> DataFrame:
    return ledger.where("status = 'done'")


def pending_archives(manifest: DataFrame, ledger: DataFrame) -> DataFrame:
    """Archives not done yet; failed ones come up again."""
    return manifest.join(done_archives(ledger).select("warc_path"), "warc_path", "left_anti")


def finished_archives(manifest: DataFrame, ledger: DataFrame) -> DataFrame:
    return manifest.join(done_archives(ledger).select("warc_path"), "warc_path", "left_semi")


def seeded_order(path: str, seed: int) -> list[Column]:
    """A random order that a seed repeats, on any cluster."""
    return [F.sha2(F.concat(F.lit(f"{seed}:"), F.col(path).cast("string")), 256), F.col(path)]


def select_archives(
    manifest: DataFrame,
    ledger: DataFrame,
    max_archives: int | None,
    order: list[Column],
    limit_first: bool = False,
) -> DataFrame:
    """The next archives to read.

    By default finished ones are skipped before the limit is applied; with
    ``limit_first`` they use up places of it.
    """
    chosen = manifest if limit_first else pending_archives(manifest, ledger)
    if max_archives is not None:
        chosen = chosen.orderBy(*order).limit(max_archives)
    return pending_archives(chosen, ledger) if limit_first else chosen


def status_counts(ledger: DataFrame) -> DataFrame:
    """Done and failed archives per month."""
    return ledger.groupBy("month").agg(
        F.count_if(F.col("status") == "done").cast("int").alias("done_warcs"),
        F.count_if(F.col("status") == "failed").cast("int").alias("failed_warcs"),
    )


def month_totals(manifest: DataFrame) -> DataFrame:
    return manifest.groupBy("month").agg(F.count("*").cast("int").alias("total_warcs"))


def refresh_month_ledger(months: DataFrame, ledger: DataFrame) -> DataFrame:
    """Month ledger with new counts. A month without ledger rows keeps its own."""
    counts = status_counts(ledger).withColumnsRenamed({"done_warcs": "_done", "failed_warcs": "_failed"})
    now = F.current_timestamp()
    return months.join(counts, "month", "left").select(
        "month",
        "total_warcs",
        F.coalesce("_done", "done_warcs").alias("done_warcs"),
        F.coalesce("_failed", "failed_warcs").alias("failed_warcs"),
        F.when(F.col("_done").isNotNull(), now).otherwise(F.col("updated_at")).alias("updated_at"),
    )


def month_counts(requested: DataFrame, months: DataFrame) -> DataFrame:
    """Counts of the requested months; zeros where the ledger has none."""
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return requested.join(months, "month", "left").select(
        "month", zero("total_warcs"), zero("done_warcs"), zero("failed_warcs")
    )


_SUMS = ["total_warcs", "processed_warcs", "remaining_warcs", "files_found", "rows_found", "volume_mb"]


def progress_report(manifest: DataFrame, ledger: DataFrame, landed: DataFrame | None = None) -> DataFrame:
    """Progress per month and, with a null month, over all of them.

    ``landed`` may bring ``month, files_found, rows_found, bytes_found``.
    """
    done = done_archives(ledger).select("warc_path", F.lit(1).alias("_done"))
    months = (
        manifest.join(done, "warc_path", "left")
        .groupBy("month")
        .agg(
            F.count("*").alias("total_warcs"),
            F.count("_done").alias("processed_warcs"),
        )
    )
    if landed is not None:
        months = months.join(landed, "month", "left")
    else:
        months = months.select("*", *[F.lit(0).alias(c) for c in ("files_found", "rows_found", "bytes_found")])
    months = months.select(
        "month",
        "total_warcs",
        "processed_warcs",
        (F.col("total_warcs") - F.col("processed_warcs")).alias("remaining_warcs"),
        *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("files_found", "rows_found")],
        half_even(F.coalesce("bytes_found", F.lit(0)) / (1024.0 * 1024.0)).alias("volume_mb"),
    )
    return (
        months.rollup("month")
        .agg(*[F.sum(c).alias(c) for c in _SUMS])
        .withColumn("volume_mb", half_even(F.col("volume_mb")))
        .withColumn("processed_pct", half_even(percent(F.col("processed_warcs"), F.col("total_warcs"))))
        .orderBy(F.asc_nulls_last("month"))
    )


def run_summary(selected: DataFrame, skipped: DataFrame, results: DataFrame) -> DataFrame:
    """One row about a backfill run from its selection and its ledger rows."""
    outcome = results.agg(
        F.coalesce(F.sum("rows_written"), F.lit(0)).alias("written_total"),
        F.coalesce(F.sum("rows_inserted"), F.lit(0)).alias("inserted_total"),
        F.count_if(F.col("status") == "failed").alias("failed"),
    )
    one_row = selected.agg(F.count("*").alias("selected_total_warcs"))
    one_row = one_row.join(F.broadcast(skipped.agg(F.count("*").alias("skipped_done"))))
    return one_row.join(F.broadcast(outcome))
