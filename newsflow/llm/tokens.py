"""Token counts of whole texts, with a shortcut for words that are one token.

A BPE model of pieces works on a text in which every space is the mark "▁".
If no piece holds a mark behind another character, no merge ever crosses the
place before a run of marks, so a text's count is the sum over its pre-tokens
(a run of marks and what follows). Which vocabulary strings encode alone as
exactly one token is proved beforehand with the library itself; such
pre-tokens are counted directly and only the others are merged, those of a
text in one call of the library.
"""

from __future__ import annotations

import re
from functools import cache

import numpy as np
from pyspark.sql import DataFrame, functions as F

from newsflow.llm.common import Memo, by_text, id_type

MARK = "▁"
_RUNS = re.compile(f"{MARK}+[^{MARK}]*")
TOKEN_LIMIT = 4096


@cache
def load(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


@cache
def splits_at_marks(path: str) -> bool:
    """Whether no piece of the vocabulary has a mark behind another character, or a line feed."""
    model = load(path)
    pieces = [model.id_to_piece(i) for i in range(model.vocab_size())]
    return not any(re.search(f"[^{MARK}]{MARK}|\n", p) for p in pieces)


@cache
def whole_tokens(path: str) -> dict[str, int]:
    """Words that, as a pre-token of one mark and the word, are one token: proved by encoding each alone."""
    model = load(path)
    words = [p[1:] for p in map(model.id_to_piece, range(model.vocab_size())) if p[:1] == MARK and p[1:] and MARK not in p[1:]]
    return {w: 1 for w, ids in zip(words, model.encode(words)) if len(ids) == 1}


def counter(path: str):
    """A function that gives the number of tokens of a text."""
    model = load(path)
    if not splits_at_marks(path):
        return lambda text: len(model.encode(text))
    starts = np.array([model.id_to_piece(i)[:1] == MARK for i in range(model.vocab_size())])

    def merged(words: list[str]) -> dict[str, int]:
        """Counts of pre-tokens, here without their first mark, merged in one call.

        A pre-token of one mark has one token that begins with a mark, its
        first, so the tokens of all of them together fall into words again.
        """
        plain = [w for w in words if w and MARK not in w]
        ids = np.array(model.encode(" ".join(plain)), int)
        first = np.flatnonzero(starts[ids])
        known = dict(zip(plain, np.diff(first, append=len(ids)).tolist())) if len(first) == len(plain) else {}
        # A mark alone is one token; words of several marks are merged one by one.
        return {w: known.get(w) or (len(model.encode(w.replace(MARK, " "))) if w else 1) for w in words}

    base = whole_tokens(path)
    memo = Memo(base, merged)

    def count(text: str) -> int:
        if not text:
            return 0
        if MARK in text or "  " in text or text[0] == " " or text[-1] == " ":
            # Runs of marks: pieces of several marks exist, so a run stays with what follows it.
            words = [run[1:] for run in _RUNS.findall(MARK + text.replace(" ", MARK))]
        else:
            words = text.split(" ")
        return sum(memo.values(words))

    return count


def count_tokens(df: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = TOKEN_LIMIT) -> DataFrame:
    """Per row: the id, bytes (UTF-8), tokens and whether they are over ``limit``.

    Counts equal the library's for the whole text without added tokens. Null
    and empty texts have 0 bytes and 0 tokens. Repeated rows and null ids give
    a row each; an empty table gives none; other columns are not read. There is
    no shuffle. ``model_path`` must exist on every executor.
    """

    def make():
        count = counter(model_path)
        return lambda key, text: [(key, len(text.encode()), n := count(text), n > limit)]

    counted = by_text(df, id_col, text_col, f"id {id_type(df, id_col)},n_bytes long,n_tokens long,over_limit boolean", make)
    return counted.select(F.col("id").alias(id_col), "n_bytes", "n_tokens", "over_limit")
