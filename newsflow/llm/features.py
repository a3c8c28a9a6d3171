"""Counts of a text that quality rules and the quality classifier build on, in one pass."""

from __future__ import annotations

import re

import numpy as np

COUNTS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines",
    "n_distinct", "n_upper", "n_letters", "n_digits", "n_exclaims", "n_bars", "n_ended", "n_unspaced",
)

_SYMBOLS = b"#*$%&|<>"
_UPPER = bytes(range(65, 91))
_ASCII_OTHER = bytes(b for b in range(128) if not (65 <= b <= 90 or 97 <= b <= 122))
_CONTINUING = bytes(range(128, 192))
_DIGITS = b"0123456789"
_SPACE = b" \t\n\x0b\x0c\r"
#: What ends a line of prose.
_ENDS = tuple(c.encode() for c in (".", "?", "!", ":", '"', "。", "！", "？", "…", "»", "”", "’", "」", "।", "॥", "۔", "؟", "։"))
# Letters of scripts that are written without blanks between words: Thai, Lao, Burmese, Khmer, kana and Han.
_UNSPACED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]+")
_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63], "uint64")


def repeated_words(words: list[bytes], window: int = 5) -> int:
    """Words inside windows that stand at two or more places of the text, the first included."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    number = {w: i for i, w in enumerate(dict.fromkeys(words))}
    if len(number) == len(words):
        return 0
    ids = np.fromiter(map(number.__getitem__, words), "int64", len(words))
    mixed = sum(ids[k : n + k].astype("uint64") * _MIX[k % 5] for k in range(window))
    ordered = np.sort(mixed)
    if not (ordered[1:] == ordered[:-1]).any():
        return 0  # equal windows would have equal sums
    same = ids[:n]
    for k in range(1, window):  # exact: numbers of distinct windows, grown a word at a time
        _, same = np.unique(same * len(number) + ids[k : n + k], return_inverse=True)
    again = np.bincount(same)[same] > 1
    change = np.zeros(len(words) + 1, "int64")
    change[np.flatnonzero(again)] += 1
    change[np.flatnonzero(again) + window] -= 1
    return int((np.cumsum(change) > 0).sum())


def counts(text: str) -> tuple[int, ...]:
    """The values of ``COUNTS``; all 0 for an empty text."""
    raw = text.encode()
    words = raw.split()
    lines = [x for x in raw.split(b"\n") if x.split(None, 1)]
    without = lambda drop: len(raw) - len(raw.translate(None, drop))
    return (
        len(words),
        len(text) - without(_SPACE),
        without(_SYMBOLS),
        len(lines) - len(set(lines)),
        repeated_words(words),
        len(lines),
        len(set(words)),
        without(_UPPER),
        len(raw.translate(None, _ASCII_OTHER + _CONTINUING)),
        without(_DIGITS),
        raw.count(b"!"),
        raw.count(b"|"),
        sum(x.rstrip().endswith(_ENDS) for x in lines),
        0 if text.isascii() else sum(map(len, _UNSPACED.findall(text))),
    )
