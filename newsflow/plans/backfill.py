"""Monthly backfill: archives -> landing -> article table -> ledgers."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from newsflow import schemas, settings
from newsflow.functions.urls import netloc
from newsflow.operators import gate, ledger, unify
from newsflow.operators.dedup import first_n_per_key, first_per_key
from newsflow.operators.language import language_of
from newsflow.operators.merge import absent_rows, apply_status_updates, new_rows, upsert_latest
from newsflow.session import work_dir
from newsflow.sources import tables
from newsflow.sources.archives import decode_payload, read_archives


@dataclass(frozen=True)
class Backfill:
    """Where a backfill reads and writes, and its limits."""

    archive_root: str
    landing: str
    articles: str
    archive_ledger: str
    month_ledger: str
    denied: tuple[str, ...] = settings.DENIED_URL_PARTS
    allowed: tuple[str, ...] = settings.ALLOWED_DOMAINS
    langs: tuple[str, ...] = settings.ALLOWED_LANGS
    max_archives: int | None = None
    limit_first: bool = False
    max_page_bytes: int | None = None  # no limit
    max_rows_per_archive: int | None = None  # no limit
    min_text_chars: int = settings.MIN_TEXT_CHARS
    sample_rate: float | None = None
    seed: int = 0
    source_type: str = "ccnews"


def staged_records(records: DataFrame, job: Backfill, language_model: DataFrame | None = None) -> DataFrame:
    """Every record with the stage it reached and, where it was extracted, its outcome and text.

    URL and size decide before extraction: a refused page hands an empty text
    to the extractor's expressions.
    """
    marked = gate.stage_pages(decode_payload(records), job.denied, job.allowed, job.max_page_bytes)
    page = marked.withColumn("html", F.when(F.col("stage") == "extract", F.col("html")))
    page = gate.extract_pages(page.drop("payload"))
    if language_model is None:
        page = page.withColumn("lang", gate.page_lang(F.col("html")))
    else:
        sample = gate.language_sample(F.col("title"), F.col("text"))
        page = page.withColumn("lang", F.when(gate.is_filled(F.col("text")), language_of(language_model)(sample)))
    outcome = gate.gate_outcome(
        gate.is_filled(F.col("text")), F.lit(False), F.col("text"), F.col("lang"), job.langs, job.min_text_chars
    )
    page = page.withColumn("outcome", F.when(F.col("stage") == "extract", outcome))
    kept = F.col("outcome") == "kept"
    return page.select(
        "warc_path", "record_no", "rec_type", "url", "read_error", "stage", "outcome",
        netloc(F.lower(F.col("url"))).alias("domain"),
        *[F.when(kept, F.col(c)).alias(c) for c in ("title", "date", "author", "lang", "text")],
    )


def run_backfill(
    spark: SparkSession, manifest: DataFrame, job: Backfill, language_model: DataFrame | None = None
) -> DataFrame:
    """Process the pending archives of a manifest (``warc_path, month``); one summary row.

    The archives are read and extracted once, into a staging table in the
    shared folder; counters, landing files and the merge read that table. A run
    that ends early can be repeated: landed lines are replaced by archive, and
    articles that are there already are counted for their archive. An
    archive with a read error is recorded as failed, adds no article and comes
    up again in the next run.
    """
    archives = tables.read_snapshot(spark, job.archive_ledger, schemas.ARCHIVE_LEDGER)
    months = tables.read_snapshot(spark, job.month_ledger, schemas.MONTH_LEDGER)
    order = ledger.seeded_order("warc_path", job.seed)
    pending = ledger.select_archives(manifest, archives, job.max_archives, order, job.limit_first)

    stage_path = work_dir(spark, "backfill")
    records = read_archives(pending, job.archive_root, job.denied, job.allowed, job.max_page_bytes)
    if job.sample_rate is not None:
        records = records.where((F.col("rec_type") == "error") | (F.rand(job.seed) < job.sample_rate))
    staged_records(records, job, language_model).write.parquet(stage_path)
    selection_path = work_dir(spark, "selection")
    pending.write.parquet(selection_path)
    staged, pending = spark.read.parquet(stage_path), spark.read.parquet(selection_path)

    failed = staged.where("rec_type = 'error'").groupBy("warc_path").agg(F.max("read_error").alias("error_text"))
    good = absent_rows(staged.where("outcome = 'kept'"), failed, "warc_path")
    limit = job.max_rows_per_archive
    lines = good if limit is None else first_n_per_key(good, "warc_path", "record_no", limit)
    tables.land_archive_lines(
        lines.select("url", "domain", "title", "date", "author", "lang", "text", "warc_path", "record_no"), job.landing, replace=True
    )
    batch = unify.archive_articles(lines, job.source_type, ["warc_path", "record_no"])
    firsts = first_per_key(batch, ["article_id"], [F.col("warc_path"), F.col("record_no")])
    stored = tables.read_table(spark, job.articles, schemas.ARTICLES)
    new_path = work_dir(spark, "new-articles")
    new_rows(firsts, stored, batch).withColumn("source_warc", F.col("warc_path")).write.parquet(new_path)
    new = spark.read.parquet(new_path)
    schemas.align(new, schemas.ARTICLES).write.mode("append").parquet(job.articles)

    written = lines.groupBy("warc_path").agg(F.count("*").cast("int").alias("rows_written"))
    # Counted in the table: a run that ended before its ledger was published may have added some of them.
    added = tables.read_table(spark, job.articles, schemas.ARTICLES).select(F.col("source_warc").alias("warc_path"))
    inserted = added.join(pending.select("warc_path"), "warc_path", "left_semi").groupBy("warc_path").agg(F.count("*").cast("int").alias("rows_inserted"))
    updates = (
        pending.join(failed, "warc_path", "left")
        .join(written, "warc_path", "left")
        .join(inserted, "warc_path", "left")
        .select(
            "warc_path",
            "month",
            F.when(F.col("error_text").isNull(), "done").otherwise("failed").alias("status"),
            F.coalesce("rows_written", F.lit(0)).alias("rows_written"),
            F.coalesce("rows_inserted", F.lit(0)).alias("rows_inserted"),
            "error_text",
            F.current_timestamp().alias("updated_at"),
            F.lit(0).cast("bigint").alias("update_no"),
        )
    )
    tables.publish_snapshot(apply_status_updates(archives, updates), job.archive_ledger, schemas.ARCHIVE_LEDGER)
    archives = tables.read_snapshot(spark, job.archive_ledger, schemas.ARCHIVE_LEDGER)

    totals = ledger.month_totals(manifest).join(
        months.select("month", "done_warcs", "failed_warcs"), "month", "left"
    )
    totals = totals.select(
        "month", "total_warcs",
        F.coalesce("done_warcs", F.lit(0)).alias("done_warcs"),
        F.coalesce("failed_warcs", F.lit(0)).alias("failed_warcs"),
        F.current_timestamp().alias("updated_at"),
    )
    new_months = upsert_latest(months, totals, [F.desc("updated_at")], "month")
    tables.publish_snapshot(
        ledger.refresh_month_ledger(new_months, archives), job.month_ledger, schemas.MONTH_LEDGER
    )
    skipped = ledger.finished_archives(manifest, archives).join(pending, "warc_path", "left_anti")
    return ledger.run_summary(pending, skipped, archives.join(pending.select("warc_path"), "warc_path", "left_semi"))


def archive_counters(staged: DataFrame) -> DataFrame:
    """The counters of every archive, from the staging table."""
    return staged.where("rec_type <> 'error'").groupBy("warc_path").agg(*gate.archive_counters())
