"""Phrases whose words stand together more often than by chance, by language.

Texts become batches of numbered words of one language. The first pass sums up
the n-grams of each batch as a Misra-Gries summary per hash partition. The
summaries of a partition are merged with more counters than its mass divided by
the threshold, so no n-gram of that frequency is lost; what the error bound
shows to be rarer is dropped. Each batch gets the survivors among its own
n-grams back, by a join on the batch, and the second pass counts these exactly,
as words and not as hashes.

Every part of a frequent phrase is frequent too. So single words run through the
same passes, and the frequent n-grams are all that the scores need.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window, functions as F

from newsflow.llm.common import bounded_batches, stored
from newsflow.session import materialise

UNKNOWN = "und"
#: Bytes of text in a batch; a longer text is a batch by itself.
BATCH_BYTES = 4 << 20
#: Occurrences in a hash partition, on average.
PART_MASS = 4_000_000

_KEY_BYTES = 6  # equal keys of different n-grams only add survivors, which the second pass counts apart
_BREAKS = b".,;:!?\n\x0b\x0c\r"
_TABLE = bytes(10 if c in _BREAKS else c + 32 if 65 <= c <= 90 else c for c in range(256))
_ODD = np.uint64(0x9E3779B97F4A7C15)
_BATCH = pa.schema([("lang", pa.string()), ("n_words", pa.int64()), ("words", pa.binary()), ("codes", pa.binary())])


def numbered(texts: list[bytes]) -> tuple[list[bytes], np.ndarray]:
    """Distinct words of texts, and the texts as their numbers from 1 on; 0 stands between pieces."""
    number: defaultdict[bytes, int] = defaultdict()
    number.default_factory = number.__len__
    number[b"\n"], number[b""]
    tokens = b"\n".join(texts).translate(_TABLE).replace(b"\t", b" ").replace(b"\n", b" \n ").split(b" ")
    codes = np.fromiter(map(number.__getitem__, tokens), "int32", len(tokens))
    codes = codes[codes != 1]
    return list(number)[2:], np.where(codes > 1, codes - 1, 0).astype("int32")


def word_batches(docs: DataFrame, text_col: str, lang_col: str, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """Rows of one language and up to ``batch_bytes`` of text: batch, lang, n_words, words, codes."""

    def row(lang: str, texts: list[bytes]) -> pa.RecordBatch:
        words, codes = numbered(texts)
        cells = [lang], [int((codes > 0).sum())], [zstandard.compress(b" ".join(words))], [zstandard.compress(codes.tobytes())]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cells, _BATCH)], schema=_BATCH)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[bytes]] = {}
        size: dict[str, int] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = text.as_py()
                held.setdefault(lang, []).append(text)
                size[lang] = size.get(lang, 0) + len(text)
                if size[lang] >= batch_bytes:
                    del size[lang]
                    yield row(lang, held.pop(lang))
                elif len(size) > 64 and sum(size.values()) >= 4 * batch_bytes:
                    for lang in list(held):
                        yield row(lang, held.pop(lang))
                    size.clear()
        for lang in held:
            yield row(lang, held[lang])

    bounded_batches(docs.sparkSession)
    chosen = docs.select(
        F.coalesce(F.col(lang_col).cast("string"), F.lit(UNKNOWN)).alias("lang"),
        F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"),
    )
    made = chosen.mapInArrow(run, "lang string,n_words long,words binary,codes binary")
    return stored(made.withColumn("batch", F.monotonically_increasing_id()), "word-batches")


def gram_keys(lang: str, words: list[bytes], codes: np.ndarray, max_words: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each size: the places where n-grams start inside a piece, and their keys of 48 bits."""
    seed = xxhash.xxh64_intdigest(lang)
    hashes = np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in words), "uint64", len(words))
    hashes = np.concatenate([np.zeros(1, "uint64"), hashes])
    at = np.flatnonzero(codes)
    mixed = np.zeros(len(at), "uint64")
    for size in range(1, max_words + 1):
        if size > 1:
            inside = at + size - 1 < len(codes)
            inside[inside] = codes[at[inside] + size - 1] > 0
            at, mixed = at[inside], mixed[inside]
        mixed = (mixed + hashes[codes[at + size - 1]]) * _ODD
        mixed ^= mixed >> np.uint64(32)
        yield size, at, (mixed * _ODD) >> np.uint64(64 - 8 * _KEY_BYTES)


def packed(keys: np.ndarray) -> bytes:
    """Sorted keys as their low four bytes, then the steps of their high two, which compress well."""
    high = (keys >> np.uint64(32)).astype("<u2")
    return (keys & np.uint64(0xFFFFFFFF)).astype("<u4").tobytes() + np.diff(high, prepend=high.dtype.type(0)).tobytes()


def unpacked(data: bytes) -> np.ndarray:
    n = len(data) // _KEY_BYTES
    high = np.cumsum(np.frombuffer(data, "<u2", n, 4 * n), dtype="uint64")
    return (high << np.uint64(32)) | np.frombuffer(data, "<u4", n)


def _counts(data: bytes, n: int) -> np.ndarray:
    return np.frombuffer(data, f"<u{len(data) // n}" if n else "u1").astype("int64")


def merged(summaries: list[tuple[np.ndarray, np.ndarray, int]], capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """One Misra-Gries summary (sorted keys, counts, error) of at most ``capacity`` counters for several.

    A key's true count lies between its counter and its counter plus the error;
    a key without counter counts no more than the error, and the error is less
    than the summed-up mass divided by ``capacity`` + 1.
    """
    keys, place = np.unique(np.concatenate([k for k, _, _ in summaries]), return_inverse=True)
    counts = np.bincount(place, np.concatenate([c for _, c, _ in summaries]), len(keys)).astype("int64")
    error = sum(e for _, _, e in summaries)
    if len(keys) > capacity:
        cut = int(np.partition(counts, len(counts) - capacity - 1)[len(counts) - capacity - 1])
        some = counts > cut
        keys, counts, error = keys[some], counts[some] - cut, error + cut
    return keys, counts, error


def frequent_keys(summaries: list[tuple[np.ndarray, np.ndarray, int]], threshold: int) -> np.ndarray:
    """Sorted keys among which all are that count ``threshold`` or more over all summaries."""
    capacity = int(sum(c.sum() for _, c, _ in summaries)) // threshold + 1
    whole, waiting, size = (np.zeros(0, "uint64"), np.zeros(0, "int64"), 0), [], 0
    for summary in summaries:
        waiting.append(summary)
        size += len(summary[0])
        if size > max(capacity, 1_000_000):
            whole, waiting, size = merged([whole, *waiting], capacity), [], 0
    keys, counts, error = merged([whole, *waiting], capacity)
    return keys[counts + error >= threshold]


def frequent_grams(batches: DataFrame, max_words: int, threshold: int, part_mass: int = PART_MASS) -> DataFrame:
    """All n-grams of up to ``max_words`` words that occur ``threshold`` times or more: lang, phrase, size, f."""
    total = batches.agg(F.sum("n_words")).first()[0] or 0
    parts = 1 + total * max_words // part_mass
    first = pa.schema([("part", pa.int64()), ("batch", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary())])

    def read(row: dict) -> tuple[list[bytes], np.ndarray]:
        words, codes = map(zstandard.decompress, (row["words"], row["codes"]))
        return (words.split(b" ") if words else []), np.frombuffer(codes, "int32")

    def summaries(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows_of in rows:
            for row in (r for i in range(len(rows_of)) for r in rows_of.slice(i, 1).to_pylist()):
                found = [k for _, _, k in gram_keys(row["lang"], *read(row), max_words)]
                keys, counts = np.unique(np.concatenate(found), return_counts=True)
                counts = counts.astype("<u1" if counts.max(initial=0) < 256 else "<u4")
                part = ((keys >> np.uint64(24)) * np.uint64(parts)) >> np.uint64(24)  # in the order of keys
                starts = np.flatnonzero(np.diff(part, prepend=part[:1] + 1)).tolist()
                spans = [(int(part[a]), a, b) for a, b in zip(starts, [*starts[1:], len(keys)])]
                columns = zip(*((p, row["batch"], packed(keys[a:b]), counts[a:b].tobytes()) for p, a, b in spans))
                if spans:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, first)], schema=first)

    def survivors(table: pa.Table) -> pa.Table:
        own = [unpacked(k) for k in table.column("keys").to_pylist()]
        counts = [_counts(c, len(k)) for c, k in zip(table.column("counts").to_pylist(), own)]
        frequent = frequent_keys([(k, c, 0) for k, c in zip(own, counts)], threshold)
        answers = [(b, packed(k[np.isin(k, frequent, assume_unique=True)])) for b, k in zip(table.column("batch").to_pylist(), own)]
        answers = [a for a in answers if a[1]]
        return pa.table([pa.array([a[0] for a in answers], pa.int64()), pa.array([a[1] for a in answers], pa.binary())], names=["batch", "keys"])

    def exact(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows_of in rows:
            for row in (r for i in range(len(rows_of)) for r in rows_of.slice(i, 1).to_pylist()):
                words, codes = read(row)
                wanted = np.sort(np.concatenate([unpacked(k) for k in row["keys"]]))
                for size, at, keys in gram_keys(row["lang"], words, codes, max_words):
                    place = np.minimum(np.searchsorted(wanted, keys), len(wanted) - 1)
                    at = at[wanted[place] == keys]
                    same = codes[at].astype("int64")
                    for k in range(1, size):
                        _, same = np.unique(same * (len(words) + 1) + codes[at + k], return_inverse=True)
                    _, where, counts = np.unique(same, return_index=True, return_counts=True)
                    starts = at[where]
                    parts_of = [[words[c - 1] for c in codes[starts + k].tolist()] for k in range(size)]
                    phrases = [b" ".join(p) for p in zip(*parts_of)]
                    n = len(phrases)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([row["lang"]] * n, pa.string()), pa.array(phrases, pa.string()), pa.array([size] * n, pa.int32()), pa.array(counts, pa.int64())],
                        names=["lang", "phrase", "size", "f"],
                    )

    bounded_batches(batches.sparkSession)
    given = batches.select("batch", "lang", "words", "codes")
    answers = given.mapInArrow(summaries, "part long,batch long,keys binary,counts binary").groupBy("part").applyInArrow(survivors, "batch long,keys binary")
    listed = answers.groupBy("batch").agg(F.collect_list("keys").alias("keys"))
    counted = given.join(listed, "batch").mapInArrow(exact, "lang string,phrase string,size int,f long")
    sums = counted.groupBy("lang", "phrase", "size").agg(F.sum("f").alias("f"))
    return sums.where(F.col("f") >= threshold)


def collocations(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    max_words: int = 3,
    threshold: int = 10,
    absorb_percent: int = 50,
    batch_bytes: int = BATCH_BYTES,
    part_mass: int = PART_MASS,
) -> DataFrame:
    """Phrases of 2 to ``max_words`` words that occur ``threshold`` times or more in their language.

    Columns: lang, phrase (space-joined, A-Z as a-z), a (occurrences), l and r
    (those of the two parts of the lowest-scoring cut), score (the whole part
    of 1,000,000 a a / (l r)), n (words of the language). Phrases stay within
    pieces between ``.,;:!?`` and line ends. A phrase that stands inside a
    longer one of at least ``absorb_percent`` of its occurrences is left out.
    Of cuts that score alike the first counts.

    A null language counts as ``und``; null and empty texts hold no words;
    repeated rows count each time; other columns are not read; an empty table
    gives no rows. Counts are exact over all texts, up to 10^13 each.
    """
    batches = word_batches(docs, text_col, lang_col, batch_bytes)
    words = batches.groupBy("lang").agg(F.sum("n_words").alias("n"))
    grams = materialise(frequent_grams(batches, max_words, threshold, part_mass))
    phrases = grams.where("size > 1").select("lang", "phrase", "size", F.col("f").alias("a"))

    cuts = phrases.select("*", F.explode(F.expr("sequence(1, size - 1)")).alias("k"))
    cuts = cuts.withColumn("left", F.expr("substring_index(phrase, ' ', k)")).withColumn("right", F.expr("substring_index(phrase, ' ', k - size)"))
    part = lambda name, value: grams.select("lang", F.col("phrase").alias(name), F.col("f").alias(value))
    known = cuts.join(part("left", "l"), ["lang", "left"]).join(part("right", "r"), ["lang", "right"])
    exact = {c: f"cast({c} AS decimal(13,0))" for c in "alr"}
    known = known.withColumn("score", F.expr(f"({exact['a']} * {exact['a']} * cast(1000000 AS decimal(7,0))) div ({exact['l']} * {exact['r']})"))
    scored = known.groupBy("lang", "phrase", "size", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))

    inner = phrases.where("size > 2").select("lang", "a", F.expr("split(phrase, ' ')").alias("w"), "size")
    inner = inner.select("lang", "a", "w", "size", F.explode(F.expr("sequence(2, size - 1)")).alias("s"))
    inner = inner.select("lang", "a", "w", "s", F.explode(F.expr("sequence(1, size - s + 1)")).alias("i"))
    longest = inner.groupBy("lang", F.expr("array_join(slice(w, i, s), ' ')").alias("phrase")).agg(F.max("a").alias("longer"))
    kept = scored.join(longest, ["lang", "phrase"], "left").where(F.coalesce(F.col("longer") * 100 < F.col("a") * absorb_percent, F.lit(True)))
    return kept.join(words, "lang").select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")


def top_collocations(docs: DataFrame, first: int = 2000, **options) -> DataFrame:
    """The ``first`` phrases of each language by score, then a, then phrase in byte order, with their rank.

    A language is cut down in parts of its phrases first, so that no task sorts all of them.
    """
    found = collocations(docs, **options).withColumn("_part", F.pmod(F.xxhash64("phrase"), F.lit(64)))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    cut = found.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "_part").orderBy(*order))).where(F.col("rank") <= first)
    ranked = cut.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= first)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
