"""Small helpers that the operators share."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from newsflow.session import work_dir

#: Words are runs of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"

Rows = Callable[[list, list], Iterator[tuple]]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def word_count(text: Column) -> Column:
    """Number of words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def text_hash(text: Column) -> Column:
    """With the id, the identity of a row up to exact repeats; null texts count as ''."""
    text = F.coalesce(text, F.lit(""))
    return F.xxhash64(text, F.length(text))


def quoted(name: str) -> str:
    """A column name as it stands, dots and all."""
    return "`" + name.replace("`", "``") + "`"


def whole_row(df: DataFrame) -> Column:
    """All columns of a row as one struct."""
    return F.struct(*(F.col(quoted(c)).alias(c) for c in df.columns))


def bounded_batches(spark: SparkSession) -> None:
    """Keep one Arrow batch of long texts to some 16 MB (one row may be larger)."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "16m")


def by_text(
    df: DataFrame,
    id_col: str,
    text_col: str,
    schema: str,
    make: Callable[[], Callable[[object, str], Iterable[tuple]]],
    carry: dict[str, Column] | None = None,
) -> DataFrame:
    """Give every row's (id, text) to a function that returns output rows.

    ``make`` runs once per task and returns that function; null texts come as
    ''. Only the columns named travel to Python, in Arrow batches. ``carry``
    names further columns that are put behind the output columns as they are.
    """
    bounded_batches(df.sparkSession)
    carry = carry or {}
    chosen = df.select(
        F.col(id_col).alias("id"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
        *(c.alias(f"_c_{n}") for n, c in carry.items()),
    )
    for name in carry:
        schema += f",{name} {chosen.schema[f'_c_{name}'].dataType.simpleString()}"
    target = pa_schema(schema)
    carried_columns, own = len(carry), len(target) - len(carry)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows_of = make()

        def packed(batch, found, sources):
            carried = [batch.column(i + 2).take(pa.array(sources, pa.int64())) for i in range(carried_columns)]
            made = to_batch(found, pa.schema(list(target)[:own]))
            return pa.RecordBatch.from_arrays([*made.columns, *carried], schema=target)

        for batch in batches:
            found: list[tuple] = []
            sources: list[int] = []
            for i, (key, text) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1))):
                before = len(found)
                found.extend(rows_of(key, text.as_py()))
                sources.extend([i] * (len(found) - before))
                if len(found) >= 20_000:
                    yield packed(batch, found, sources)
                    found, sources = [], []
            if found:
                yield packed(batch, found, sources)

    return chosen.mapInArrow(run, schema)


def to_batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


_ARROW = {"smallint": pa.int16(), "long": pa.int64(), "bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "double": pa.float64(), "boolean": pa.bool_(), "binary": pa.binary()}


def pa_schema(ddl: str) -> pa.Schema:
    """Arrow schema of a flat DDL string (scalars and arrays of scalars)."""
    fields = []
    for part in ddl.split(","):
        name, kind = part.split()
        inner = re.fullmatch(r"array<(\w+)>", kind)
        fields.append((name, pa.list_(_ARROW[inner[1]]) if inner else _ARROW[kind]))
    return pa.schema(fields)


def id_type(df: DataFrame, column: str) -> str:
    """DDL type of an id column, as the flat schemas spell it."""
    return df.select(column).schema[0].dataType.simpleString()


class Memo:
    """Values of words, computed once per word; forgets all but the base beyond ``bound`` words."""

    def __init__(self, base: dict, fill: Callable[[list], dict], bound: int = 600_000, long: int = 100) -> None:
        self.base, self.fill, self.bound, self.long = base, fill, bound, long
        self.known, self.drop = dict(base), []

    def values(self, words: list) -> Iterator:
        for word in self.drop:
            self.known.pop(word, None)
        self.drop = []
        missing = set(words).difference(self.known)
        if missing:
            if len(self.known) + len(missing) > self.bound:
                self.known = dict(self.base)
                missing = set(words).difference(self.known)
            self.known.update(self.fill(list(missing)))
            self.drop = [w for w in missing if len(w) > self.long]
        return map(self.known.__getitem__, words)


class Remembered(dict):
    """Values of words by a function, computed when first asked for.

    Holds at most ``bound`` words: when the younger half is full, the older
    half is forgotten, save for the words asked for since. Words of over
    ``long`` characters are not kept.
    """

    def __init__(self, fill: Callable[[str], bytes], bound: int, long: int = 100) -> None:
        super().__init__()
        self.fill, self.half, self.long, self.older = fill, bound // 2, long, {}

    def __missing__(self, word: str) -> bytes:
        value = self.older.get(word)
        if value is None:
            value = self.fill(word)
        if len(word) <= self.long:
            if len(self) >= self.half:
                self.older = dict(self)
                self.clear()
            self[word] = value
        return value


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` as a table below the shared folder and read it: computed once, lineage cut."""
    target = work_dir(df.sparkSession, purpose)
    df.write.parquet(target)
    return df.sparkSession.read.schema(df.schema).parquet(target)
