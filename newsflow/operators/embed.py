"""Batch text embedding with a pluggable encoder."""

from __future__ import annotations

import re
from collections.abc import Callable
from hashlib import md5

import numpy as np
from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, FloatType

from newsflow import settings
from newsflow.functions.text import safe_text
from newsflow.functions.vectors import normalise

_SPACE = re.compile(r"[ \t\r\n]+")

Encoder = Callable[[np.ndarray], np.ndarray]


class _Places(dict):
    """Place and sign of tokens, as 2 x place + sign; forgets all when full."""

    def __init__(self, dim: int, most: int = 1 << 18) -> None:
        super().__init__()
        self.dim, self.most = dim, most

    def __missing__(self, token: str) -> int:
        bits = int(md5(token.encode("utf-8")).hexdigest()[:8], 16)
        place = 2 * ((bits >> 4) % self.dim) + (bits & 1)
        if len(self) >= self.most:
            self.clear()
        self[token] = place
        return place


def hashed_name(dim: int = settings.EMBEDDING_DIM) -> str:
    """The name that vectors of the default encoder carry."""
    return f"hashed-tokens-{dim}"


def hashed_tokens(dim: int = settings.EMBEDDING_DIM) -> Callable[[], Encoder]:
    """Maker of the default encoder: signed counts of hashed tokens.

    It needs no model file and gives the same vector everywhere. Hand
    ``embed_texts`` another maker to use a neural model.
    """

    def make() -> Encoder:
        place_of = _Places(dim)

        def encode(texts: np.ndarray) -> np.ndarray:
            out = np.zeros((len(texts), dim), dtype=np.float32)
            for row, text in enumerate(texts):
                tokens = [t for t in _SPACE.split(text.lower()) if t]
                counts = np.bincount(list(map(place_of.__getitem__, tokens)), minlength=2 * dim)
                out[row] = counts[1::2] - counts[::2]
            return out

        return encode

    return make


def embed_texts(
    work_set: DataFrame,
    model: str | None = None,
    make_encoder: Callable[[], Encoder] | None = None,
    dim: int = settings.EMBEDDING_DIM,
    batch_size: int = 128,
    normalised: bool = True,
) -> DataFrame:
    """Embedding rows for ``article_id, text``.

    The encoder is loaded once per Python worker and sees Arrow batches. A
    vector of another length than ``dim`` fails the job. Rows carry the name of
    the encoder that ran: the default one's own, or ``model`` for a given one.
    """
    name = hashed_name(dim) if make_encoder is None else model or settings.DEFAULT_MODEL
    encode = predict_batch_udf(
        make_encoder or hashed_tokens(dim), return_type=ArrayType(FloatType()), batch_size=batch_size
    )
    encoded = work_set.select("article_id", encode(safe_text(F.col("text"))).alias("_raw"))
    checked = F.when(F.size("_raw") == dim, F.col("_raw")).otherwise(
        F.raise_error(F.concat(F.lit(f"expected {dim} dimensions, got "), F.size("_raw").cast("string")))
    )
    vectors = encoded.select("article_id", checked.alias("_vector"))
    vector = normalise(F.col("_vector")) if normalised else F.col("_vector")
    return vectors.select(
        "article_id",
        vector.alias("text_embedding"),
        F.lit(name).alias("model_name"),
        F.current_timestamp().alias("updated_at"),
    )
