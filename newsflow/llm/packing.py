"""Best-fit packing by minimum bin slack.

Documents become pieces of at most ``capacity`` tokens. Packing looks at the
histogram of piece lengths only (``capacity`` counters, whatever the corpus):
each bin starts with the longest piece left, a bitset over sums finds the
fullest combination of lengths still available, and the combination is taken
out as often as its lengths last. Pieces then find their place by their rank
among the pieces of their length, which Spark computes in sorted slices.
"""

from __future__ import annotations

import struct
import zlib
from functools import cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, functions as F

from newsflow.llm.common import Remembered, by_text, id_type
from newsflow.operators.running import running_total
from newsflow.session import materialise

CAPACITY = 4096
END_ID = 1

# The tokenizer's own pattern of words.
_PARTS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
#: Chunks for which one-character lower-casing and no composing are certain; others go through the library whole.
_PLAIN = regex.compile(r"[\x21-\x7eÀ-ÖØ-öø-įĴ-ňŊ-ž]+")
#: Signs that form one part at the end of a word.
_CLOSING = ".,;:!?)"


@cache
def load(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def _byte_characters() -> dict[int, str]:
    """The printable stand-ins of bytes in byte-level vocabularies."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}


@cache
def encoder(path: str):
    """A function that gives a text's ids as little-endian unsigned 32-bit bytes.

    White space separates words and no token spans it, so a text's ids are
    those of its chunks between white space, one after the other. One function
    serves all tasks of a worker, which so share what it remembers.
    """
    tokenizer = load(path)
    stand_ins = _byte_characters()
    special = {t.content for t in tokenizer.get_added_tokens_decoder().values()}

    def whole(text: str) -> bytes:
        return np.array(tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def word_ids(word: str) -> bytes:
        found = tokenizer.model.tokenize(word if word.isascii() else word.encode().decode("latin1").translate(stand_ins))
        return struct.pack(f"<{len(found)}I", *[t.id for t in found])

    words = Remembered(word_ids, 400_000)

    def chunk_ids(chunk: str) -> bytes:
        plain = chunk.isascii()
        if not plain and not _PLAIN.fullmatch(chunk):
            return whole(chunk)
        low = chunk.lower() if plain else "".join(map(str.lower, chunk))
        core = low.rstrip(_CLOSING)
        if core.isalpha():
            return words[core] + words[low[len(core) :]] if len(core) < len(low) else words[core]
        return b"".join(map(words.__getitem__, _PARTS.findall(low))) if _PLAIN.fullmatch(chunk) else whole(chunk)

    chunks = Remembered(chunk_ids, 600_000)
    # Special strings are tokens, and these four separate words in one library only.
    odd = (*special, "\x1c", "\x1d", "\x1e", "\x1f")

    def ids(text: str) -> bytes:
        if any(s in text for s in odd):
            return whole(text)
        return b"".join(map(chunks.__getitem__, text.split()))

    return ids


def token_pieces(df: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Cut every document (its ids, then ``end_id``) into pieces of at most ``capacity`` tokens.

    Null and empty texts are one piece of one token. Nothing is truncated.
    """

    def make():
        encode, end = encoder(tokenizer_path), np.array([end_id], "<u4").tobytes()

        def rows(key, text):
            ids = encode(text) + end
            total = len(ids) // 4
            for number, start in enumerate(range(0, total, capacity)):
                part = ids[4 * start : 4 * (start + capacity)]
                yield key, number, start, len(part) // 4, zlib.crc32(part)

        return rows

    return by_text(df, id_col, text_col, f"id {id_type(df, id_col)},piece int,start long,length long,ids_crc32 long", make)


def fullest(counts: dict[int, int], room: int) -> dict[int, int]:
    """The combination of available lengths with the largest sum up to ``room``.

    Bit s of ``reach`` is set if some of the lengths seen so far sum to s. The
    states after each step are kept to walk back from the best sum.
    """
    mask, reach = (1 << (room + 1)) - 1, 1
    steps: list[tuple[int, int]] = []
    for length in sorted(counts, reverse=True):
        if length > room:
            continue
        for _ in range(min(counts[length], room // length)):
            grown = (reach | reach << length) & mask
            if grown == reach:
                break
            steps.append((length, reach))
            reach = grown
            if reach >> room & 1:
                break
        if reach >> room & 1:
            break
    total, taken = reach.bit_length() - 1, {}
    for length, before in reversed(steps):
        if not before >> total & 1:
            taken[length] = taken.get(length, 0) + 1
            total -= length
    return taken


def plan_bins(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, dict[int, int]]]:
    """Bins as (how often, pieces by length). Every entry uses up some length, so entries are few."""
    left = {length: n for length, n in histogram.items() if n > 0}
    plan = []
    while left:
        longest = max(left)
        left[longest] -= 1
        taken = fullest({k: n for k, n in left.items() if n}, capacity - longest)
        left[longest] += 1
        taken[longest] = taken.get(longest, 0) + 1
        times = min(left[k] // n for k, n in taken.items())
        plan.append((times, taken))
        for k, n in taken.items():
            left[k] -= times * n
            if not left[k]:
                del left[k]
    return plan


def _places(plan: list[tuple[int, dict[int, int]]]) -> dict[int, tuple[np.ndarray, ...]]:
    """By length: first rank, pieces per bin, offset and first sequence of each entry that uses it."""
    used: dict[int, int] = {}
    rows: dict[int, list[tuple[int, int, int, int]]] = {}
    sequence = 0
    for times, taken in plan:
        offset = 0
        for length, n in sorted(taken.items(), reverse=True):
            rows.setdefault(length, []).append((used.get(length, 0), n, offset, sequence))
            used[length] = used.get(length, 0) + times * n
            offset += n * length
        sequence += times
    return {k: tuple(np.array(c, "int64") for c in zip(*v)) for k, v in rows.items()}


def pack(pieces: DataFrame, order: list[Column], capacity: int = CAPACITY) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces with a ``length`` between 1 and ``capacity``.

    The pieces are used several times: hand in a stored frame. ``order`` names
    columns that fix the order of equal lengths; rows equal in all of them are
    interchangeable. The driver sees the histogram of lengths only, at most
    ``capacity`` rows. An empty table gives no rows.
    """
    histogram = {int(r["length"]): int(r["n"]) for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    places = _places(plan_bins(histogram, capacity))
    starts, before = {}, 0
    for length in sorted(histogram):
        starts[length] = before
        before += histogram[length]
    ranked = running_total(pieces.withColumn("_one", F.lit(1)), [F.col("length"), *order], "_one", "_rank").drop("_one")

    def place(batches):
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("_rank").to_numpy() - 1
            sequence, offset = np.zeros(len(length), "int64"), np.zeros(len(length), "int64")
            for k in np.unique(length):
                at = np.flatnonzero(length == k)
                first, per_bin, base, first_sequence = places[int(k)]
                own = rank[at] - starts[int(k)]
                entry = np.searchsorted(first, own, "right") - 1
                bins, slot = np.divmod(own - first[entry], per_bin[entry])
                sequence[at] = first_sequence[entry] + bins
                offset[at] = base[entry] + slot * k
            kept = [i for i, n in enumerate(batch.schema.names) if n != "_rank"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in kept), pa.array(sequence), pa.array(offset)],
                names=[*(batch.schema.names[i] for i in kept), "sequence_id", "offset"],
            )

    return ranked.mapInArrow(place, ",".join(f"{f.name} {f.dataType.simpleString()}" for f in ranked.drop("_rank").schema) + ",sequence_id long,offset long")


def pack_documents(df: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Pack documents into as few sequences of at most ``capacity`` tokens as the method finds.

    Per piece: id, piece, start, length, ids_crc32, sequence_id, offset. Only
    documents longer than ``capacity`` are cut. Null and empty texts are packed
    as their end id. Repeated rows are packed each on its own; null ids are
    kept; other columns are not read. ``tokenizer_path`` must exist on every
    executor. Pieces are written once, before their lengths are counted.
    """
    pieces = materialise(token_pieces(df, tokenizer_path, id_col, text_col, capacity, end_id))
    order = [F.xxhash64("id", "piece"), F.col("id"), F.col("piece"), F.col("start"), F.col("ids_crc32")]
    packed = pack(pieces, order, capacity)
    return packed.select(F.col("id").alias(id_col), "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
