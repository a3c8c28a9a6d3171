"""Similarity join of documents on word n-grams, filtered under several global orders of the n-grams.

If two sets reach a Jaccard similarity of t, then under any global order of
all tokens the first n - ceil(t n) + 1 tokens of each (its prefix) have one in
common. That holds under every order at once, so only documents that share a
prefix token under each of several orders are compared.

The first order puts a fixed part of all tokens (by hash) first, the rare
before the frequent, by exact counts. Counting that part is enough, since
prefixes seldom reach beyond it. A document whose prefix no other document
shares any token of links with none and leaves here. The other orders are by
different hashes; they filter the pairs that the first one leaves.

Documents of equal sets are one class. Sets that link are of like sizes, so
classes are split into levels by size, a step the similarity apart. Classes of
a level and the one below it that share a prefix token meet at the least of
them that has the token. A group of many near copies has its prefix tokens in
common, so its members meet at few such hubs and travel a few times only, as
packed texts; what a text shares with texts of other sizes costs no copy of
it. Pairs are compared inside tasks and not written.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window, functions as F

from newsflow.llm.common import Memo, bounded_batches, by_text, id_type, stored, text_hash, whole_row, word_count
from newsflow.llm.links import PAIRED, SALTS, first_shared, in_blocks, labelled, summed_up
from newsflow.session import materialise

PART = 4  # one token of so many is counted exactly
ORDERS = 3
_ODD = np.uint64(0x9E3779B97F4A7C15)
_SEEDS = np.array([0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], "uint64")


def _mixed(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijection of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * _SEEDS[seed % 4]
    x = (x ^ (x >> np.uint64(27))) * _SEEDS[(seed + 1) % 4]
    return x ^ (x >> np.uint64(31))


def shingler(size: int):
    """A function from a text to its sorted, distinct n-grams of words, as 64-bit hashes.

    A-Z count as a-z; words are separated by ASCII white space. A text of
    fewer words has one n-gram, of all its words; one without words has none.
    """
    memo = Memo({}, lambda words: {w: xxhash.xxh64_intdigest(w) for w in words})

    def shingles(text: str) -> np.ndarray:
        words = text.encode().lower().split()
        if not words:
            return np.zeros(0, "uint64")
        hashes = np.fromiter(memo.values(words), "uint64", len(words))
        width = min(size, len(words))
        n, total = len(words) - width + 1, np.full(len(words) - width + 1, width, "uint64")
        for k in range(width):
            total = _mixed(total * _ODD + hashes[k : n + k], k)
        return np.unique(total)

    return shingles


def prefix_length(n: int, percent: int) -> int:
    return n - (-(-percent * n // 100)) + 1 if n else 0


def _first_tokens(tokens: np.ndarray, percent: int) -> np.ndarray:
    """The tokens that the prefix under the first order is among.

    All of the counted part, which stands first; if that is shorter than a
    prefix, also the next tokens by value.
    """
    counted = tokens % np.uint64(PART) == 0
    short = prefix_length(len(tokens), percent) - int(counted.sum())
    return tokens[counted] if short <= 0 else np.concatenate([tokens[counted], tokens[~counted][:short]])


def _prefixes(tokens: np.ndarray, percent: int, orders: int) -> list[np.ndarray]:
    """Prefixes under the other orders, by different hashes of the tokens."""
    length = prefix_length(len(tokens), percent)
    return [tokens[np.argsort(_mixed(tokens, k), kind="stable")[:length]] for k in range(1, orders)]


def _meeting(sets: list[np.ndarray]) -> np.ndarray:
    """How many tokens each two of the sets have in common, from the tokens that more than one of them has."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, token, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = count[token] > 1
    owner, token = owner[shared], token[shared]
    number = np.cumsum(count > 1) - 1
    token = number[token]
    common = np.zeros((len(sets), len(sets)), "float32")
    order = np.argsort(token, kind="stable")
    owner, token = owner[order], token[order]
    step = 4096
    for start in range(0, int(token[-1]) + 1 if len(token) else 0, step):
        a, b = np.searchsorted(token, [start, start + step])
        part = np.zeros((len(sets), step), "float32")
        part[owner[a:b], token[a:b] - start] = 1
        common += part @ part.T
    return common


def link_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = 5,
    percent: int = 80,
    orders: int = ORDERS,
    block_rows: int = 512,
    block_tokens: int = 500_000,
) -> DataFrame:
    """Per row: id, n_shingles (size of its set), component_id and n_links (other documents linked directly).

    Also component (a number of the component, null for empty sets) and _hash (of the text).

    Documents link if 100 * intersection >= ``percent`` * union of their sets
    of ``size``-word n-grams. component_id is the least id reachable by links.
    Null texts and texts without words have empty sets and link with nothing,
    not even one another. Repeated rows are copies of one another. Null ids
    count as ids only where a component has no others. An empty table gives no
    rows; other columns are not read.

    Texts are read twice: for the prefixes, and those that have candidates for
    the comparison. N-grams are 64-bit hashes, classes 64 bits of a hash.
    """

    def make():
        shingles = shingler(size)

        def rows(key, text):
            tokens = shingles(text)
            name = hashlib.blake2b(tokens.tobytes(), digest_size=8).digest() if len(tokens) else None
            yield key, len(tokens), None if name is None else int.from_bytes(name, "little", signed=True), _first_tokens(tokens, percent).view("int64").tolist()

        return rows

    schema = f"id {id_type(docs, id_col)},n_shingles long,cls long,tokens array<long>"
    rows = stored(by_text(docs, id_col, text_col, schema, make, {"_hash": text_hash(F.col(text_col))}), "ngrams")
    classes = materialise(
        rows.where("cls IS NOT NULL").groupBy("cls").agg(
            F.min("id").alias("least_id"),
            F.count("*").alias("size"),
            F.max(F.struct("_hash", "id")).alias("_row"),  # a document whose text stands for the class
            F.first("n_shingles").alias("n"),
        )
    )
    counted = F.pmod("token", F.lit(PART)) == 0
    length = F.col("n") - F.ceil(F.col("n") * percent / F.lit(100)) + 1

    # Tokens of one class only cannot be shared. A class with a prefix of them has no candidates.
    postings = rows.where("cls IS NOT NULL").select("cls", F.explode("tokens").alias("token"))
    alone = postings.groupBy("token").agg(F.min("cls").alias("cls"), F.max("cls").alias("_max")).where("cls = _max")
    lonely = alone.groupBy("cls").agg(F.count(F.when(counted, 1)).alias("_alone"))
    left = classes.join(lonely, "cls", "left").where(F.coalesce("_alone", F.lit(0)) < length)
    left = materialise(left.select("cls", "size", "n", "_row"))

    # Among the classes left: the prefix is what is alone, then shared tokens, the rarest first.
    # A class may hold most documents: its rows are dealt out over several tasks until equal ones are one.
    salts = F.sequence(F.lit(0), F.lit(SALTS - 1))
    dealt = rows.where("cls IS NOT NULL").select("cls", F.pmod(F.xxhash64("_hash", "id"), F.lit(SALTS)).cast("int").alias("salt"), "tokens")
    chosen = left.select("cls", F.explode(salts).alias("salt"))
    postings = dealt.join(chosen, ["cls", "salt"], "left_semi").select("cls", F.explode("tokens").alias("token")).distinct()
    shared = postings.groupBy("token").agg(F.count("*").alias("df"))
    placed = postings.join(shared, "token")
    rarest_first = Window.partitionBy("cls").orderBy(~counted, F.when(counted, F.col("df")), "token")
    prefix = placed.withColumn("_place", F.row_number().over(rarest_first)).join(left.select("cls", "n"), "cls").where((F.col("_place") <= length) & (F.col("df") > 1))
    # A step is a little wider than the similarity, so that sets that link are one level apart at most.
    level = F.floor(F.log("n") / (1.0001 * float(np.log(100 / percent)))) if percent < 100 else F.col("n")
    prefix = stored(prefix.select("cls", "token", level.alias("level")), "prefixes")
    spread = prefix.withColumn("top", F.explode(F.array("level", F.col("level") + 1)))
    # A top level without members of its own joins classes that meet one level lower anyway.
    hubs = spread.groupBy("token", "top").agg(F.min("cls").alias("least"), F.count("*").alias("_members"), F.max("level").alias("_highest"))
    hubs = hubs.where((F.col("_members") > 1) & (F.col("_highest") == F.col("top"))).withColumn("hub", F.xxhash64("least", "top"))
    met = spread.join(hubs.select("token", "top", "hub"), ["token", "top"]).groupBy("cls").agg(F.array_sort(F.collect_set("hub")).alias("hubs"))
    chosen = left.join(met, "cls").select("cls", "size", "n", "hubs", F.col("_row._hash").alias("_hash"), F.col("_row.id").alias("_id"))
    texts = docs.select(F.col(id_col).alias("_i"), text_hash(F.col(text_col)).alias("_h"), F.col(text_col).alias("text"))
    chosen = chosen.join(texts, (F.col("_hash") == F.col("_h")) & F.col("_id").eqNullSafe(F.col("_i"))).select("cls", "size", "n", "hubs", F.col("text").cast("binary").alias("text"))

    def pack(batches):
        for batch in batches:
            texts = pa.array([zstandard.compress(t.as_py()) for t in batch.column("text")], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], texts], names=batch.schema.names)

    bounded_batches(docs.sparkSession)
    packed = chosen.mapInArrow(pack, "cls long,size long,n long,hubs array<long>,text binary")
    members = stored(packed, "texts").select("*", F.explode("hubs").alias("hub"))

    def compare(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        cls = table.column("cls").to_numpy()
        _, at = np.unique(cls, return_index=True)  # rows that repeat the document that stands for a class
        table, cls = table.take(pa.array(at)), cls[at]
        shingles = shingler(size)
        sets = [shingles(zstandard.decompress(t.as_py()).decode()) for t in table.column("text")]
        n = np.array([len(s) for s in sets], float)
        possible = np.triu(100 * np.minimum.outer(n, n) >= percent * np.maximum.outer(n, n), 1)
        if key[1].as_py() != key[2].as_py():
            own = table.column("_own").to_numpy()
            possible &= own[:, None] != own[None, :]
        prefixes = [_prefixes(s, percent, orders) for s in sets]
        for k in range(orders - 1):
            if not possible.any():
                return PAIRED.empty_table()
            possible &= _meeting([p[k] for p in prefixes]) > 0
        some = np.flatnonzero(possible.any(axis=0) | possible.any(axis=1))
        if not len(some):
            return PAIRED.empty_table()
        common = _meeting([sets[i] for i in some]).astype(float)
        union = np.add.outer(n[some], n[some]) - common
        a, b = np.nonzero(possible[np.ix_(some, some)] & (100 * common >= percent * union))
        a, b = some[a], some[b]
        if not len(a):
            return PAIRED.empty_table()
        once = first_shared([np.array(v) for v in table.column("hubs").to_pylist()], a, b, key[0].as_py())
        return summed_up(cls, table.column("size").to_numpy(), a[once], b[once])

    pieces = in_blocks(members, "hub", "cls", F.col("n"), block_rows, block_tokens)
    paired = pieces.groupBy("hub", "_i", "_j").applyInArrow(compare, "cls long, links long, root long")
    found = labelled(classes.select("cls", "least_id", "size"), paired).select("cls", "component", "component_id", "n_links")
    return rows.select("id", "_hash", "n_shingles", "cls").join(found, "cls", "left").select(
        F.col("id").alias(id_col), "n_shingles", F.coalesce("component_id", "id").alias("component_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"), "component", "_hash"
    )


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with one document of each group of linked ones, that of the least id.

    Of rows of that id and text the first by their other columns, as JSON,
    stays. Documents without words all stay. Null
    ids come last. All columns are kept.
    """
    linked = link_documents(docs, id_col, text_col, **options)
    kept = linked.where("component IS NOT NULL").groupBy("component").agg(F.min(F.struct(F.col(id_col).isNull().alias("last"), F.col(id_col).alias("id"), "_hash")).alias("k"))
    kept = kept.select(F.col("k.id").alias("_id"), F.col("k._hash").alias("_same"))
    rows = docs.select(whole_row(docs).alias("_doc"), F.col(id_col).alias("_i"), text_hash(F.col(text_col)).alias("_h"), (word_count(F.col(text_col)) > 0).alias("_some"))
    first = rows.where("_some").join(kept, F.col("_i").eqNullSafe(F.col("_id")) & (F.col("_h") == F.col("_same")), "left_semi")
    # Rows of one id and text are told apart by their other columns, so the choice does not depend on partitions.
    others = [F.col("_doc")[c].alias(c) for c in docs.columns if c != text_col]
    rest = F.to_json(F.struct(*others), {"ignoreNullFields": "false"}) if others else F.lit("")
    one = first.groupBy("_i", "_h").agg(F.min_by("_doc", rest).alias("_doc"))
    return one.select("_doc.*").unionByName(rows.where("NOT _some").select("_doc.*"))
