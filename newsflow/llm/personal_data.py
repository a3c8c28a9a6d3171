"""Personal data by fixed patterns, and more of it by the contexts these stand in.

Four fixed patterns give the base spans; they are the seeds. Words around a
seed form lexical patterns. Other strings that look like identifiers stand in
patterns too. Patterns and strings are the two sides of a graph that Spark
scores in rounds: a pattern is as sure as the share of its strings that are
known, a string as sure as the patterns it stands in, together. Strings that
sure patterns find are added, and count as known in the next round.
"""

from __future__ import annotations

import itertools
import re
from bisect import bisect_left, bisect_right
from hashlib import blake2b

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from newsflow.llm.common import by_text, id_type, quoted, text_hash, whole_row
from newsflow.session import materialise

KINDS = ("email", "ip", "card", "phone")
FOUND = "id"
#: Longer names and context words are known by their hash.
LONG_NAME = 128

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# Numbers are followed by something else than a digit, so each number is tried once.
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_NO_DIGIT = re.compile(r"[^0-9]+")
_DIGIT_OR_AT = re.compile(r"[0-9@]")
_GROUPS = re.compile(r"(?<![^ \t\n(\[\"'=:])[0-9]{2,}(?: [0-9]{2,})+(?![^\s.,;:!?)\]\"'])")
_SOME_DIGITS = re.compile(r"[0-9]{3}|@")
_SPACE = re.compile(r"\s")
_WORDS = re.compile(r"\S+")
_NEXT = re.compile(r"\w+|[^\w\s]+")
_EDGES = "\"'`.,;:!?()[]{}<>*#$%&|"
_DOUBLED = (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)


def _luhn(digits: str) -> bool:
    total = sum(int(d) for d in digits[-1::-2]) + sum(_DOUBLED[int(d)] for d in digits[-2::-2])
    return total % 10 == 0


def _emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches, found from each "@" outwards so that long words cost no more than their length."""
    found, end, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            end = domain.end()
            found.append((start, end))
        else:
            end = max(end, at + 1)
        at = text.find("@", max(at + 1, end))
    return found


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans (kind, start, end) by kind, then start; code points, end exclusive."""
    spans = [("email", s, e) for s, e in _emails(text)]
    spans += [("ip", *m.span()) for m in _IP.finditer(text) if all(len(p) <= 3 and int(p or 0) <= 255 for p in (g.lstrip("0") for g in m.groups()))]
    for m in _CARD.finditer(text):
        if len(m[0]) >= 16 and 16 <= len(digits := _NO_DIGIT.sub("", m[0])) <= 19 and _luhn(digits):
            spans.append(("card", *m.span()))
    if "+" in text:
        spans += [("phone", *m.span()) for m in _PHONE.finditer(text) if 8 <= len(_NO_DIGIT.sub("", m[0])) <= 15]
    return spans


class Spans:
    """Places as disjoint stretches in order, to ask what overlaps them."""

    def __init__(self, spans: list[tuple[int, int]]) -> None:
        self.starts: list[int] = []
        self.ends: list[int] = []
        for s, e in sorted(spans):
            if self.ends and s < self.ends[-1]:
                self.ends[-1] = max(self.ends[-1], e)
            else:
                self.starts.append(s)
                self.ends.append(e)

    def meet(self, a: int, b: int) -> bool:
        i = bisect_right(self.ends, a)
        return i < len(self.starts) and self.starts[i] < b


def lookalikes(text: str, taken: list[tuple[str, int, int]]) -> list[tuple[int, int]]:
    """Other strings that look like identifiers: words of six characters or more with four digits or an "@".

    Groups of digits joined by single blanks are one string if none of them is one by itself.
    """
    known = Spans([(s, e) for _, s, e in taken])
    found, end = [], 0
    for m in _DIGIT_OR_AT.finditer(text):
        if m.start() < end:
            continue
        start = m.start()
        while start > end and not text[start - 1].isspace():
            start -= 1
        stop = _SPACE.search(text, m.end())
        end = stop.start() if stop else len(text)
        first = _SOME_DIGITS.search(text, m.start(), end) or m
        for cut in "=:":
            start = max(start, text.rfind(cut, start, first.start()) + 1)
        a, b = start, end
        while a < b and text[a] in _EDGES:
            a += 1
        while b > a and text[b - 1] in _EDGES:
            b -= 1
        if b - a >= 6 and not known.meet(a, b) and ("@" in text[a:b] or sum(c.isdigit() for c in text[a:b]) >= 4):
            found.append((a, b))
    single = Spans(found)
    for m in _GROUPS.finditer(text):
        a, b = m.span()
        if b - a >= 6 and sum(c.isdigit() for c in m[0]) >= 4 and not known.meet(a, b) and not single.meet(a, b):
            found.append((a, b))
    return sorted(found)


def _short(name: str) -> str:
    """A name, or for a long one its hash."""
    return name if len(name) <= LONG_NAME else "blake2b " + blake2b(name.encode()).hexdigest()


def _plain(word: str) -> str:
    return _short(re.sub(r"[0-9]+", "0", word.lower().strip(_EDGES)) or word.lower())


def contexts(text: str, start: int, end: int, words: list[tuple[int, int]]) -> list[str]:
    """Lexical patterns around a span: two words before; one before and one behind; a label right before it.

    ``words`` are the places of all words of the text, in order.
    """
    at = bisect_left(words, (start, -1))
    whole = lambda i: text[words[i][0] : words[i][1]]
    if at and words[at - 1][1] > start:  # joined to the span: "key=", 'id:"'
        first = words[at - 1][0]
        i = start
        while i > first and text[i - 1] in "=:\"'":
            i -= 1
        j = i
        while j > first and (text[j - 1].isalnum() or text[j - 1] in "_-."):
            j -= 1
        return [f"label {_short(text[j:start].lower())}"] if i < start else []
    behind = bisect_left(words, (end, -1))
    # What stands behind the span in its own word counts as the next one.
    if behind and words[behind - 1][1] > end:
        right = _NEXT.match(text, end)[0]
    else:
        right = whole(behind) if behind < len(words) else ""
    left = [whole(i) for i in range(max(0, at - 2), at)]
    patterns = []
    if left and left[-1][-1:] in ("=", ":"):
        patterns.append("label " + " ".join(_short(w.lower()) for w in left))
    if len(left) > 1:
        patterns.append(f"before {_plain(left[-2])} {_plain(left[-1])}")
    if left and right:
        patterns.append(f"around {_plain(left[-1])} {_plain(right)}")
    return patterns


def _occurrences(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Per row: id, hash of the text, base spans, and arrays of all identifier-like places."""
    schema = (
        f"id {id_type(df, id_col)},base string,n_email long,n_ip long,n_card long,n_phone long,"
        "starts array<long>,ends array<long>,kinds array<string>,names array<string>,patterns array<string>"
    )

    def make():
        def rows(key, text):
            spans = base_spans(text)
            places = spans + [("", s, e) for s, e in lookalikes(text, spans)]
            words = [m.span() for m in _WORDS.finditer(text)] if places else []
            number = [sum(k == kind for k, _, _ in spans) for kind in KINDS]
            yield (
                key, ",".join(f"{k}:{s}:{e}" for k, s, e in spans), *number,
                [s for _, s, _ in places], [e for _, _, e in places], [k for k, _, _ in places],
                [_short(text[s:e].lower()) for _, s, e in places], ["\x1f".join(contexts(text, s, e, words)) for _, s, e in places],
            )

        return rows

    return by_text(df, id_col, text_col, schema, make, {"_hash": text_hash(F.col(text_col))})


def bootstrap(places: DataFrame, rounds: int | None = None, min_known: int = 5, min_share: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """Score the graph of ``places`` (pattern, name, kind; kind '' if unknown).

    Returns the sure patterns (pattern, kind, confidence) and the names they
    find (name, confidence). A pattern is sure for a kind if at least
    ``min_known`` different names known to be of it stand in it and they are
    ``min_share`` of all its names. An unknown name's score is one minus the
    product of its sure patterns' doubts; from ``min_share`` on it is known.
    Rounds go on until none finds a new name, or ``rounds`` of them.
    """
    edges = materialise(places.groupBy("pattern", "name").agg(F.max("kind").alias("kind")))
    known = edges.where("kind <> ''").groupBy("name").agg(F.max("kind").alias("known"))
    patterns = names = None
    for _ in itertools.count() if rounds is None else range(rounds):
        totals = edges.join(known, "name", "left").groupBy("pattern", "known").agg(F.count("*").alias("n"))
        shares = totals.groupBy("pattern").agg(
            F.sum("n").alias("n"), F.max(F.when(F.col("known").isNotNull(), F.struct("n", "known"))).alias("best")
        )
        patterns = materialise(
            shares.select("pattern", F.col("best.known").alias("kind"), (F.col("best.n") / F.col("n")).alias("confidence"), F.col("best.n").alias("_known"))
            .where((F.col("_known") >= min_known) & (F.col("confidence") >= min_share))
            .drop("_known")
        )
        scored = (
            edges.where("kind = ''")
            .join(patterns.select("pattern", F.col("kind").alias("like"), "confidence"), "pattern")
            .groupBy("name", "like")
            .agg((1 - F.exp(F.sum(F.log(F.greatest(1 - F.col("confidence"), F.lit(1e-9)))))).alias("confidence"))
            .groupBy("name")
            .agg(F.max(F.struct("confidence", "like")).alias("best"))
            .select("name", "best.like", "best.confidence")
            .where(F.col("confidence") >= min_share)
        )
        names = materialise(scored)
        found = names.select("name", F.col("like").alias("known")).join(known.select("name"), "name", "left_anti")
        if found.isEmpty():
            break
        known = materialise(known.unionByName(found))
    return patterns, names


def find_personal_data(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Per row: id, counts of base spans by kind, base (string), n_found, spans (string) and _hash of the text.

    Strings of spans are ``kind:start:end`` by kind (email, ip, card, phone,
    then id for what the contexts found), then start, comma-joined; code
    points, end exclusive. Base spans are always kept; found ones do not
    overlap them. Null and empty texts have none. Repeated rows and null ids
    give a row each; an empty table gives none; other columns are not read.
    Texts are read once; what is shuffled is the places that look like
    identifiers, counted per pattern and name first.
    """
    rows = materialise(_occurrences(df, id_col, text_col))
    zipped = F.arrays_zip("starts", "ends", "kinds", "names", "patterns")
    places = rows.select("id", "_hash", F.explode(zipped).alias("p")).select(
        "id", "_hash", "p.starts", "p.ends", F.col("p.kinds").alias("kind"), F.col("p.names").alias("name"), "p.patterns"
    )
    _, names = bootstrap(places.select(F.explode(F.split("patterns", "\x1f")).alias("pattern"), "name", "kind").where("pattern <> ''"), **options)
    found = (
        places.where("kind = ''")
        .join(names.select("name"), "name")
        .groupBy(F.col("id").alias("_id"), F.col("_hash").alias("_same"))
        .agg(F.sort_array(F.collect_set(F.struct("starts", "ends"))).alias("found"))
    )
    joined = rows.join(found, F.col("id").eqNullSafe(F.col("_id")) & (F.col("_hash") == F.col("_same")), "left")
    more = F.transform(F.coalesce("found", F.array()), lambda s: F.concat(F.lit(f"{FOUND}:"), s["starts"].cast("string"), F.lit(":"), s["ends"].cast("string")))
    return joined.select(
        F.col("id").alias(id_col), *(f"n_{k}" for k in KINDS), "base",
        F.coalesce(F.size("found"), F.lit(0)).cast("long").alias("n_found"),
        F.array_join(F.array_compact(F.concat(F.array(F.nullif("base", F.lit(""))), more)), ",").alias("spans"), "_hash",
    )


def masked(text: str, spans: str) -> str:
    """The text with every span replaced by its kind in brackets; overlapping spans are one, named by the first."""
    marks = sorted((int(s), -int(e), k) for k, s, e in (x.split(":") for x in spans.split(",") if x))
    parts, at, last = [], 0, None
    for start, minus_end, kind in marks:
        if last is not None and start < last[1]:
            last = (last[0], max(last[1], -minus_end), last[2])
            continue
        if last:
            parts += [text[at : last[0]], f"[{last[2].upper()}]"]
            at = last[1]
        last = (start, -minus_end, kind)
    if last:
        parts += [text[at : last[0]], f"[{last[2].upper()}]"]
        at = last[1]
    return "".join(parts) + text[at:]


def mask_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length_col: str | None = None, **options) -> DataFrame:
    """``docs`` with all spans of personal data replaced by their kinds; ``length_col`` gets the new length.

    Rows without spans stay as they are, whatever they hold. Only the texts
    that have spans go through Python a second time.
    """
    spans = find_personal_data(docs, id_col, text_col, **options).where("spans <> ''")
    spans = spans.select(F.col(id_col).alias("_id"), F.col("_hash").alias("_same"), "spans").distinct()

    @F.pandas_udf("string")
    def mask(text: pd.Series, spans: pd.Series) -> pd.Series:
        return pd.Series([None if s is None else masked(t, s) for t, s in zip(text, spans)])

    rows = docs.select(whole_row(docs).alias("_doc"), F.col(id_col).alias("_i"), text_hash(F.col(text_col)).alias("_h"), F.col(text_col).alias("_text"))
    joined = rows.join(spans, F.col("_i").eqNullSafe(F.col("_id")) & (F.col("_h") == F.col("_same")), "left")
    changed = joined.withColumn("_new", mask(F.when(F.col("spans").isNotNull(), F.col("_text")), "spans"))
    values = {c: F.col(f"_doc.{quoted(c)}") for c in docs.columns}
    values[text_col] = F.coalesce("_new", values[text_col])
    if length_col:
        values[length_col] = F.when(F.col("_new").isNotNull(), F.length("_new")).otherwise(values[length_col]).cast(docs.schema[length_col].dataType)
    return changed.select(*(v.alias(c) for c, v in values.items()))
