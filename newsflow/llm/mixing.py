"""Mixing sources to target weights: random keys, sorted slices, prefix sums, a cut per source."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from newsflow.llm.common import stored, whole_row, word_count
from newsflow.operators.running import running_total
from newsflow.session import materialise

WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3


def mix_key(identity: Column, seed: int = 0) -> Column:
    """A hash-random 60-bit key, the same in any engine."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(identity.cast("string"), F.lit("null"))))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.0, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Targets of the sources in ``sizes`` (source, source_size), one row per source.

    Sources in code point order, null last, take the weights in turn. Each
    gets its part of ``share`` of all words, but ``max_epochs`` times its own
    at most; the excess goes to the others by weight. Sorted by limit over
    weight, the sources that stop form a prefix: a source stops if its limit
    is below its part of what the earlier ones leave. Running totals find it,
    so nothing here needs all sources in one task.
    """
    one = F.lit(1).cast("long")
    order = [F.col("source").isNull(), F.col("source")]
    placed = running_total(sizes.withColumn("_one", one), order, "_one", "_place").drop("_one")
    weighed = placed.withColumn("_weight", F.element_at(F.array(*map(F.lit, weights)), ((F.col("_place") - 1) % len(weights) + 1).cast("int")).cast("long"))
    limited = weighed.withColumn("_limit", F.col("source_size") * max_epochs)
    by_limit = [F.col("_limit") / F.col("_weight"), F.col("_place")]
    summed = running_total(running_total(limited, by_limit, "_limit", "_limits"), by_limit, "_weight", "_weights")
    summed = materialise(summed)
    words, all_weights = summed.agg(F.sum("source_size"), F.sum("_weight")).first()
    budget, all_weights = (words or 0) * share, all_weights or 0
    stops = (
        F.col("_limit") * (F.lit(all_weights) - (F.col("_weights") - F.col("_weight")))
        <= (F.lit(budget) - (F.col("_limits") - F.col("_limit"))) * F.col("_weight")
    )
    judged = summed.withColumn("_stops", stops)
    stopped, stopped_weight = judged.where("_stops").agg(F.sum("_limit"), F.sum("_weight")).first()
    free = F.lit(float(budget - (stopped or 0))) * F.col("_weight") / F.lit(float(all_weights - (stopped_weight or 0)))
    return judged.select(
        "source", "source_size", F.when(F.col("_stops"), F.col("_limit").cast("double")).otherwise(free).alias("target")
    )


def mix(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.0, max_epochs: int = MAX_EPOCHS, seed: int = 0, whole_documents: bool = False, identity: str = "id") -> DataFrame:
    """Say how many words of each document the mix takes.

    ``sized`` has a row id ``id``, ``source`` and ``size`` (words) and is used
    several times: hand in a stored frame. Adds ``source_size``, ``target``,
    ``epochs`` (how often the whole document is taken) and ``taken`` (words).
    Within its source every document has a hash-random place; a source's
    budget is so many whole epochs, and for the rest the documents up to the
    cut. The document at the cut gives the words that are missing; with
    ``whole_documents`` it is taken if that brings the source nearer.

    Keys are of the column ``identity``, so that they do not depend on how rows
    are numbered. A null source is a source. Null ids and rows that repeat one another share
    a key and stand side by side. Sizes of 0 give 0. An empty table gives
    none. Sums run over sorted slices, so a source may hold most of the rows.
    """
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = materialise(source_targets(sizes, weights, share, max_epochs))
    order = [F.col("source").isNull(), F.col("source"), F.col("_key"), F.col(identity), F.col("size"), F.col("id")]
    total = running_total(sized.withColumn("_key", mix_key(F.col(identity), seed)), order, "size", "_end")
    # Words before each source's first document, from the sums of the sources.
    starts = running_total(targets, order[:2], "source_size", "_through").withColumn("_start", F.col("_through") - F.col("source_size"))
    joined = total.alias("d").join(
        starts.alias("s"), F.col("d.source").eqNullSafe(F.col("s.source")), "left"
    ).select("d.*", "s.source_size", "s.target", "s._start")
    budget = F.round("target").cast("long")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0).cast("long")
    rest = budget - F.col("_epochs") * F.col("source_size")
    before = F.col("_end") - F.col("_start") - F.col("size")
    if whole_documents:
        extra = F.when(2 * before + F.col("size") < 2 * rest, F.col("size")).otherwise(0)
    else:
        extra = F.greatest(F.lit(0), F.least(F.col("size"), rest - before))
    return (
        joined.withColumn("_epochs", epochs)
        .withColumn("_extra", extra.cast("long"))
        .select(
            *(c for c in sized.columns),
            "source_size",
            "target",
            (F.col("_epochs") + F.when((F.col("_extra") == F.col("size")) & (F.col("size") > 0), 1).otherwise(0)).cast("long").alias("epochs"),
            (F.col("_epochs") * F.col("size") + F.col("_extra")).alias("taken"),
        )
    )


def mix_documents(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", **options) -> DataFrame:
    """``mix`` over documents, whose sizes are their numbers of words (null text: 0).

    Texts are read once, for their sizes.
    """
    sized = materialise(docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size")))
    return mix(sized, **options).withColumnRenamed("id", id_col)


def mixed_rows(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", **options) -> DataFrame:
    """The mix as rows: whole documents only, each as often as it is taken, with the columns of ``docs``."""
    rows = docs.select(
        F.monotonically_increasing_id().alias("id"), F.col(id_col).alias("name"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"), whole_row(docs).alias("doc")
    )
    keyed = stored(rows, "mix")
    sized = materialise(keyed.select("id", "name", "source", "size"))
    taken = mix(sized, whole_documents=True, identity="name", **options).select("id", "epochs").where("epochs > 0")
    return keyed.select("id", "doc").join(taken, "id").withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("epochs")))).select("doc.*")
