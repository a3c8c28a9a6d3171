"""A training corpus from raw documents, in stages that are written and read again."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from newsflow.llm import mixing, ngram_join, packing, personal_data, site_quality
from newsflow.llm.common import stored
from newsflow.session import prepare


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that the quality classifier rejects; sources are sites, their languages paths."""
    labels = prepare(spark).read.parquet(f"{sf_dir}/labels.parquet")
    return site_quality.keep_good(docs, labels, F.col("source"), F.col("lang"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group linked by five-word shingles at a similarity of 0.8."""
    prepare(spark)
    return ngram_join.drop_near_duplicates(docs, size=5, percent=80)


def privacy(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data by its kind."""
    prepare(spark)
    return personal_data.mask_documents(docs, length_col="n_chars")


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take whole documents of each source up to its target, some of them repeatedly."""
    prepare(spark)
    return mixing.mixed_rows(docs)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack all documents into sequences of 4,096 tokens: one row per piece."""
    prepare(spark)
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality classifier", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("personal data", privacy),
    ("source mixing", mixture),
    ("best-fit packing", sequences),
]

#: SQL cannot express the trained classifier, the iterated scores or the packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's result is a table in the shared folder."""
    docs = prepare(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
