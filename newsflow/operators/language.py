"""Language identification: naive Bayes over hashed character n-grams, with a model of fixed size.

Every n-gram falls into one of a fixed number of slots, so a model is one row
of weights per language, whatever it was trained on. A text is scored inside
its row: its slots pick rows of the weight matrix, which add up. There is no
join, and the only shuffle is that of the counts in training, a fixed number
of rows per task and language.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

SLOTS = 1 << 16
# Fixed value: an odd number of 32 bits; its powers weigh the characters of an n-gram.
_FACTOR = 2654435761
_PART = 1024
#: Languages whose counts a task holds at once.
_HELD = 256


def multipliers(n: int) -> list[int]:
    return [pow(_FACTOR, n - k, 1 << 32) for k in range(n)]


def plain(text: Column) -> Column:
    """Lowered text with single blanks around words; null counts as empty."""
    return F.concat(F.lit(" "), F.array_join(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[ \t\r\n]+"), " "), F.lit(" "))


def gram_slots(text: str, n: int = 3, slots: int = SLOTS) -> np.ndarray:
    """Slots of all overlapping n-grams: the high bits of a weighted sum of code points (``slots`` is a power of two)."""
    codes = np.frombuffer(text.encode("utf-32-le", "replace"), "<u4").astype("uint64")
    count = max(0, len(codes) - n + 1)
    total = sum((codes[k : k + count] * np.uint64(m) for k, m in enumerate(multipliers(n))), np.zeros(count, "uint64"))
    return ((total & np.uint64(0xFFFFFFFF)) >> np.uint64(33 - slots.bit_length())).astype("int64")


def train_language_model(labelled: DataFrame, n: int = 3, slots: int = SLOTS) -> DataFrame:
    """Model rows ``lang, n, prior, weights`` from ``lang, text``; rows without a language teach nothing.

    ``weights`` are log probabilities of the slots, counts plus one. Rows are
    as many as languages, each of the same size.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {}

        def rows() -> pa.RecordBatch:
            made = [
                (lang, part, texts if part == 0 else 0, counts[part * _PART : (part + 1) * _PART].tobytes())
                for lang, (texts, counts) in held.items()
                for part in range(-(-slots // _PART))
            ]
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*made)], names=["lang", "part", "texts", "counts"])

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                entry = held.setdefault(lang, [0, np.zeros(slots, "<i8")])
                entry[0] += 1
                entry[1] += np.bincount(gram_slots(text.as_py(), n, slots), minlength=slots)
            if len(held) >= _HELD:
                yield rows()
        if held:
            yield rows()

    def summed(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(c, "<i8") for c in table.column("counts").to_pylist())
        texts = sum(table.column("texts").to_pylist())
        return pa.table({"lang": [key[0].as_py()], "part": pa.array([key[1].as_py()], pa.int64()), "texts": [texts], "total": [int(total.sum())], "counts": [total.tolist()]})

    given = labelled.where("lang IS NOT NULL").select("lang", plain(F.col("text")).alias("text"))
    parts = given.mapInArrow(count, "lang string, part bigint, texts bigint, counts binary")
    parts = parts.groupBy("lang", "part").applyInArrow(summed, "lang string, part bigint, texts bigint, total bigint, counts array<bigint>")
    whole = parts.groupBy("lang").agg(
        F.sum("texts").alias("texts"),
        F.sum("total").alias("total"),
        F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("part", "counts"))), lambda p: p["counts"])).alias("counts"),
    )
    everything = whole.agg(F.sum("texts").alias("all_texts"))  # a single row
    return (
        whole.join(F.broadcast(everything))
        .select(
            "lang",
            F.lit(n).alias("n"),
            F.log(F.col("texts") / F.col("all_texts")).alias("prior"),
            F.transform("counts", lambda c: F.log(c + 1.0) - F.log(F.col("total") + float(slots))).alias("weights"),
        )
    )


def language_scorer(model: DataFrame) -> tuple[list[str], Callable[[Column], Column]]:
    """The languages of a model in alphabetic order, and a function from a text column to an array of their scores.

    What is broadcast is one row of weights per language.
    """
    rows = model.orderBy("lang").collect()
    langs, n = [r["lang"] for r in rows], rows[0]["n"] if rows else 0
    if not rows:
        return [], lambda text: F.array().cast("array<double>")
    held = model.sparkSession.sparkContext.broadcast(
        (np.array([r["prior"] for r in rows]), np.ascontiguousarray(np.array([r["weights"] for r in rows]).T))
    )

    @F.pandas_udf("array<double>")
    def scores(text: pd.Series) -> pd.Series:
        prior, weights = held.value
        return pd.Series([(prior + weights.take(gram_slots(t, n, len(weights)), axis=0).sum(axis=0)).tolist() for t in text])

    return langs, lambda text: scores(plain(text))


def language_of(model: DataFrame) -> Callable[[Column], Column]:
    """A function from a text column to the code of its best language.

    Scores are compared after rounding to six decimals; equal ones go to the
    first code in the alphabet. Null and empty texts go by the priors alone; a
    model without rows gives null.
    """
    langs, scores = language_scorer(model)
    if not langs:
        return lambda text: F.lit(None).cast("string")
    codes = F.array(*map(F.lit, langs))

    def best(text: Column) -> Column:
        rounded = lambda s: F.transform(s, lambda x: F.round(x, 6))
        place = lambda s: F.array_position(rounded(s), F.array_max(rounded(s)))
        return F.transform(F.array(scores(text)), lambda s: F.element_at(codes, place(s).cast("int")))[0]

    return best


def score_languages(texts: DataFrame, model: DataFrame, key: str = "doc_id") -> DataFrame:
    """``key`` and ``scores``, an array of language and score for every text."""
    langs, scores = language_scorer(model)
    codes = F.array(*map(F.lit, langs)) if langs else F.array().cast("array<string>")
    return texts.select(key, F.zip_with(codes, scores(F.col("text")), lambda c, s: F.struct(c.alias("lang"), s.alias("score"))).alias("scores"))


def detect_language(texts: DataFrame, model: DataFrame, key: str = "doc_id") -> DataFrame:
    """``key`` and ``detected_lang``, the best language per text."""
    return texts.select(key, language_of(model)(F.col("text")).alias("detected_lang"))
