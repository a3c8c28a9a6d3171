"""Periodic runs: stretches of words that repeat with a smallest period, and texts without the repeats.

Suffixes that share enough words are ordered by prefix doubling. The tree of
their intervals of common prefixes is built from below; each node holds the
places of its suffixes. Two places of a node from different children, with
different words to their left, are a maximal pair: the words between the first
place and the end of the second copy repeat with the pair's distance, and
neither neighbour carries them on. So a pair whose distance fits its length is
a run as it stands and needs no extension.

A pair of a distance within its length matters only between places that follow
one another in their node: a place between them would be a smaller period. So
places of both classes are kept in text order and only neighbours are compared.
"""

from __future__ import annotations

from bisect import bisect_right, insort
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, functions as F

from newsflow.llm.common import by_text, id_type, text_hash

_MIX = np.uint64(0x9E3779B97F4A7C15)
_BLOCK = 1024


class Places:
    """Places in text order, in blocks, so that adding one costs little whatever their number."""

    def __init__(self, place: int) -> None:
        self.blocks, self.firsts, self.size = [[place]], [place], 1

    def __iter__(self) -> Iterator[int]:
        for block in self.blocks:
            yield from block

    def around(self, place: int) -> list[int]:
        """The nearest places before and after."""
        b = bisect_right(self.firsts, place) - 1
        if b < 0:
            return [self.firsts[0]]
        block = self.blocks[b]
        k = bisect_right(block, place)
        if k < len(block):
            return [block[k - 1], block[k]]
        return [block[-1], *self.firsts[b + 1 : b + 2]]

    def add(self, place: int) -> None:
        b = max(0, bisect_right(self.firsts, place) - 1)
        block = self.blocks[b]
        insort(block, place)
        self.firsts[b] = block[0]
        self.size += 1
        if len(block) > 2 * _BLOCK:
            self.blocks[b : b + 1] = [block[:_BLOCK], block[_BLOCK:]]
            self.firsts[b : b + 1] = [block[0], block[_BLOCK]]


def _windows(ids: np.ndarray, width: int) -> np.ndarray | None:
    """Numbers of the windows of ``width`` words from each place on, in their order, equal for equal
    windows; None if all of them differ. Beyond the end stands a word less than all others."""
    n = len(ids)
    ids = np.concatenate([ids + 1, np.zeros(width - 1, "int64")])
    mixed = np.zeros(n, "uint64")
    for k in range(width):
        mixed = (mixed + ids[k : n + k].astype("uint64")) * _MIX
        mixed ^= mixed >> np.uint64(29)
    ordered = np.sort(mixed)
    if not (ordered[1:] == ordered[:-1]).any():
        return None  # equal windows would have equal mixtures
    same, words = ids[:n], int(ids.max()) + 1
    for k in range(1, width):  # exact: a word more at a time
        _, same = np.unique(same * words + ids[k : n + k], return_inverse=True)
    return same


def _ordered_suffixes(ids: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Places that share ``width`` words or more with another place, in suffix order, and the
    number of words each has in common with the one before it (0 for the first)."""
    n = len(ids)
    same = _windows(ids, width) if n > width else None
    if same is None:
        return np.zeros(0, "int64"), np.zeros(0, "int64")
    count = np.bincount(same)
    below = np.cumsum(count) - count
    rank = below[same]
    active = np.flatnonzero(count[same] > 1)
    places, levels, length = active, [], width
    while len(active):
        levels.append((length, rank.astype("int32")))
        behind = active + length
        second = np.where(behind < n, rank[np.minimum(behind, n - 1)], -1)
        first = rank[active]
        order = np.lexsort((second, first))
        active, first, second = active[order], first[order], second[order]
        new_first = np.concatenate([[True], first[1:] != first[:-1]])
        new = new_first | np.concatenate([[True], second[1:] != second[:-1]])
        at = np.arange(len(active))
        group, part = np.maximum.accumulate(np.where(new_first, at, 0)), np.maximum.accumulate(np.where(new, at, 0))
        rank = rank.copy()
        rank[active] = first + part - group
        alone = new & np.concatenate([new[1:], [True]])
        active, length = active[~alone], 2 * length
    order = places[np.argsort(rank[places], kind="stable")]
    a, b = order[:-1], order[1:]
    common = np.zeros(len(a), "int64")
    for length, level in reversed(levels):
        x, y = a + common, b + common
        fits = np.maximum(x, y) < n
        common += np.where(fits & (level[np.minimum(x, n - 1)] == level[np.minimum(y, n - 1)]), length, 0)
    for _ in range(width - 1):
        x, y = a + common, b + common
        step = (np.maximum(x, y) < n) & (ids[np.minimum(x, n - 1)] == ids[np.minimum(y, n - 1)])
        if not step.any():
            break
        # Whoever stops once stops for good, since the place looked at stays the same.
        common += step
    return order, np.concatenate([[0], common])


def runs_of(ids: np.ndarray, min_length: int = 6, min_exponent: int = 4) -> list[tuple[int, int, int]]:
    """All runs (start, length, period) of numbered words, by start, then period.

    A run is a stretch of smallest period p and length of at least
    ``min_length`` and ``min_exponent`` (2 or more) times p that no neighbour carries on.
    """
    width = min(max(min_length - d, (min_exponent - 1) * d) for d in range(1, max(min_length, 2)))
    order, common = _ordered_suffixes(ids, max(width, 1))
    if not len(order):
        return []
    left = [-1, *ids.tolist()]
    found: dict[tuple[int, int], int] = {}

    def merged(a: Places, b: Places, length: int) -> Places:
        large, small = (a, b) if a.size >= b.size else (b, a)
        for i in small:
            for j in large.around(i):
                period = abs(i - j)
                if period * (min_exponent - 1) <= length and period + length >= min_length and left[i] != left[j]:
                    run = (min(i, j), period + length)
                    found[run] = min(period, found.get(run, period))
        for i in small:
            large.add(i)
        return large

    stack: list[tuple[int, Places]] = []
    places = order.tolist()
    for before, length in zip(places, [*common[1:].tolist(), 0]):
        node = Places(before)
        while stack and stack[-1][0] > length:
            depth, open_node = stack.pop()
            node = merged(open_node, node, depth)
        if length < width:
            stack = []
        elif stack and stack[-1][0] == length:
            stack[-1] = (length, merged(stack[-1][1], node, length))
        else:
            stack.append((length, node))
    return sorted((start, length, period) for (start, length), period in found.items())


def kept_words(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Which of ``n`` words stay if each run keeps its first period only."""
    change = np.zeros(n + 1, "int64")
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return np.cumsum(change[:n]) == 0


def find_runs(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = 6, min_exponent: int = 4
) -> DataFrame:
    """Per row: id, runs (array of start, length, period by start, then period), collapsed and _hash (of the text).

    Words lie between ASCII white space and are numbered from 0. ``collapsed``
    has the words that no run holds behind its first period, joined by single
    blanks. Null, empty and blank texts have no runs and collapse to ''.
    Repeated rows and null ids give a row each; an empty table gives none;
    other columns are not read. A text is worked on as a whole inside one task;
    time grows as n log n with its words, whatever repeats in it.
    """

    def make():
        def rows(key, text):
            words = text.encode().split()
            number = {w: i for i, w in enumerate(dict.fromkeys(words))}
            runs = []
            if len(number) < len(words):
                runs = runs_of(np.fromiter(map(number.__getitem__, words), "int64", len(words)), min_length, min_exponent)
            if runs:
                words = [words[i] for i in np.flatnonzero(kept_words(len(words), runs))]
            starts, lengths, periods = zip(*runs) if runs else ((), (), ())
            yield key, list(starts), list(lengths), list(periods), b" ".join(words)

        return rows

    schema = f"id {id_type(docs, id_col)},start array<long>,length array<long>,period array<long>,collapsed string"
    found = by_text(docs, id_col, text_col, schema, make, {"_hash": text_hash(F.col(text_col))})
    return found.select(F.col("id").alias(id_col), F.arrays_zip("start", "length", "period").alias("runs"), "collapsed", "_hash")
