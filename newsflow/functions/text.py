"""Text clean-up, hashes, fingerprints and number formatting."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from newsflow import settings

# What Python counts as white space: the Unicode property plus four control characters.
_EDGE_SPACE = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$"


def strip(col: Column) -> Column:
    """Remove white space at both ends (``trim`` removes blanks only)."""
    return F.regexp_replace(col, _EDGE_SPACE, "")


def clean_key(col: Column) -> Column:
    return strip(F.lower(col))


def safe_text(col: Column) -> Column:
    """Null becomes empty, then strip."""
    return F.coalesce(strip(col), F.lit(""))


def is_filled(col: Column) -> Column:
    return col.isNotNull() & (F.length(col) > 0)


def sha256_hex(col: Column) -> Column:
    return F.sha2(col, 256)


def text_fingerprint(text: Column, order: str = "slice_first", chars: int | None = settings.FINGERPRINT_CHARS) -> Column:
    """Hash of the lowered, stripped opening of a text; of all of it where ``chars`` is None.

    ``slice_first`` cuts, then strips; ``strip_first`` strips, then cuts. They
    differ for texts that start with white space.
    """
    if order not in ("slice_first", "strip_first"):
        raise ValueError(f"unknown fingerprint order: {order}")
    if chars is None:
        return sha256_hex(clean_key(text))
    if order == "slice_first":
        return sha256_hex(clean_key(F.substring(text, 1, chars)))
    return sha256_hex(F.substring(clean_key(text), 1, chars))


def long_enough(text: Column, min_chars: int = settings.MIN_TEXT_CHARS) -> Column:
    return F.coalesce(F.length(text) >= min_chars, F.lit(False)) & is_filled(text)


def in_languages(lang: Column, allowed: tuple[str, ...] = settings.ALLOWED_LANGS) -> Column:
    return F.coalesce(lang.isin(*allowed), F.lit(False))


def embedding_input(
    title: Column, text: Column, model: str = settings.DEFAULT_MODEL, null_title: str = "propagate"
) -> Column:
    """Text handed to the encoder; the default model expects a prefix.

    With ``null_title='propagate'`` an article without title has no input at
    all; ``'skip'`` uses its body alone.
    """
    if null_title not in ("propagate", "skip"):
        raise ValueError(f"unknown null_title: {null_title}")
    body = F.concat(title, F.lit(" "), text)
    if null_title == "skip":
        body = F.when(title.isNull(), text).otherwise(body)
    return F.concat(F.lit("passage: "), body) if model == settings.DEFAULT_MODEL else body


def cut_error(col: Column, chars: int = settings.ERROR_TEXT_CHARS) -> Column:
    return F.substring(col, 1, chars)


def half_even(col: Column, digits: int = 2) -> Column:
    return F.bround(col, digits)


def percent(part: Column, whole: Column) -> Column:
    """Unrounded share of the whole; zero when there is no whole."""
    return F.when(F.coalesce(whole, F.lit(0)) == 0, F.lit(0.0)).otherwise(part / whole * 100)


def matches_any(col: Column, literals: tuple[str, ...]) -> Column:
    """True where ``col`` contains any of the literals."""
    hit = F.lit(False)
    for literal in literals:
        hit = hit | col.contains(literal)
    return hit
