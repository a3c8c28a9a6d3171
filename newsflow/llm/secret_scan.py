"""Secrets by fixed patterns, and more of them by a conditional random field.

A chunk is a run of characters that secrets are written in, those that the
fixed patterns take, with digits or without. All chunks of a text are tagged,
but those shorter than a span has to be, which cannot hold one. The tokens of a
chunk, its words and single signs, are tagged begin, inside or outside by their
shapes, the words around the chunk and what the whole file looks like. Chunks
with a digit and chunks without one have weights of their own. What the fixed
patterns find teaches them, on a bounded sample of documents, together with
examples made by rule.
"""

from __future__ import annotations

import math
import random
import re
import zlib
from bisect import bisect_right
from collections.abc import Callable, Iterator

import numpy as np
from pyspark.sql import DataFrame, functions as F

from newsflow.llm.common import Remembered, by_text, id_type
from newsflow.llm.tagger import BEGIN, INSIDE, OUTSIDE, Tagger, fit
from newsflow.session import materialise

KINDS = ("assign", "access", "hex")
FOUND = "secret"
SLOTS = 1 << 14
#: Characters of a span that the model adds, at least.
MIN_LENGTH = 8
#: Documents the model is fitted on, at most: so many with pattern secrets, so many others.
FIT_ROWS = 2000
#: Documents with more tokens in chunks do not enter the sample; all are searched.
FIT_TOKENS = 100
#: Chunks of a kind (with a digit, without) the model is fitted on, at most, besides the examples made by rule.
FIT_CHUNKS = 12_000
#: Of the chunks without a digit, one in 4 in one in so many texts enters the sample, and all that hold a base span.
FIT_EVERY = 16

_KEYWORDS = ("password", "passwd", "secret", "token", "api")
_ASSIGN = re.compile(r"(?:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.IGNORECASE | re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")  # the greedy match begins at the first place and takes all
_HEX = re.compile(r"[0-9a-f]{16,}")
_CHUNK = re.compile(rf"[A-Za-z0-9+/_.=~-]{{{MIN_LENGTH},}}")
_DIGIT = re.compile(r"[0-9]")
_TOKEN = re.compile(r"[A-Za-z0-9]+|[^A-Za-z0-9]")
_RUN = re.compile(r"[a-z]+|[A-Z]+|[0-9]+")
_LETTERS = re.compile(r"[^\W\d_]+")
_DIGITS = "0123456789"


def base_spans(text: str) -> list[tuple[int, str, int, int]]:
    """Matches of the fixed patterns: start, kind, end, start of the secret; by start, then kind as listed."""
    found = []
    low = text.lower()
    if any(k in low for k in _KEYWORDS):
        found += [(m.start(), 0, m.end(), m.start(1)) for m in _ASSIGN.finditer(text) if len(m[1]) >= 12]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end(), m.start()) for m in _ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end(), m.start()) for m in _HEX.finditer(text)]
    return [(s, KINDS[k], e, inner) for s, k, e, inner in sorted(found)]


def chunks(text: str) -> list[tuple[int, int]]:
    """Places that may hold a secret: all runs of its characters that a span of ``MIN_LENGTH`` has room in."""
    found = []
    for m in _CHUNK.finditer(text):
        a, b = m.span()
        while a < b and text[a] in "=.~":
            a += 1
        while b > a and text[b - 1] in ".-_~":
            b -= 1
        if b - a >= MIN_LENGTH:
            found.append((a, b))
    return found


def _level(x: float, *steps: float) -> int:
    return bisect_right(steps, x)


def _classes(token: str) -> str:
    if not token.isalnum():
        return token
    return ("a" if token.upper() != token else "") + ("A" if token.lower() != token else "") + ("0" if any(c in _DIGITS for c in token) else "")


def _known(word: str) -> str:
    """A word as context: its letters, or 0 for a word of none."""
    if word.isalpha():
        return word.lower()
    letters = _LETTERS.findall(word)
    return "_".join(letters).lower() if letters else "0"


def file_features(text: str) -> list[str]:
    lines = text.split("\n")
    marked = sum("=" in x or ":" in x for x in lines)
    digits = sum(map(text.count, _DIGITS))
    words = text.count(" ") + len(lines)
    return [f"marks{_level(marked / len(lines), 0.01, 0.1, 0.3, 0.7)}", f"digits{_level(digits / len(text), 0.002, 0.01, 0.05, 0.2)}", f"line{_level(words / len(lines), 2, 4, 8, 20)}"]


def chunk_features(text: str, a: int, b: int, around: tuple[str, str, str, str], file: list[str]) -> tuple[list[tuple[int, int]], list[list[int]]]:
    """Tokens (start, end) of a chunk and the slots of their features, the same number for each token.

    ``around``: two words before (the nearer second), what is joined to the chunk in front of it, a word behind.
    """
    chunk = text[a:b]
    tokens = [(a + m.start(), a + m.end()) for m in _TOKEN.finditer(chunk)]
    parts = [text[s:e] for s, e in tokens]
    kinds = ["^", *map(_classes, parts), "$"]
    signs = "".join(sorted(set(c for c in chunk if not c.isalnum())))
    front, back = text[a - 1 : a] or "^", text[b : b + 1] or "$"
    second, first, joined, behind = around
    label = _known(joined) if _LETTERS.search(joined) else _known(first) if first else "^"
    fixed = [
        f"front {front}", f"back {back}", f"signs {signs}", f"size {_level(b - a, 12, 16, 20, 28, 36, 48, 80)}",
        f"tokens {_level(len(parts), 2, 3, 4, 6, 10)}", f"dots {chunk.count('.')} {_level(chunk.count('-'), 1, 2, 4)}",
        f"label {label}", f"second {_known(second) if second else '^'}", f"behind {_known(behind) if behind else '$'}",
        f"label {label} {front if not front.isspace() else ' '}", *(f"file {x}" for x in file),
    ]
    fixed = [zlib.crc32(f.encode()) % SLOTS for f in fixed]
    rows, label_here = [], label
    for i, part in enumerate(parts):
        runs = _RUN.findall(part)
        size, kind = _level(len(part), 2, 3, 5, 8, 12, 16, 20, 32, 40), kinds[i + 1]
        digits = sum(c in _DIGITS for c in part) / len(part)
        mixed = _level(len(runs) / len(part), 0.15, 0.3, 0.5)
        hexlike = all(c in "0123456789abcdef" for c in part)
        own = [
            "always", f"kind {kind}", f"size {size} {kind}", f"runs {_level(len(runs), 2, 3, 5, 8)} {size}", f"mixed {mixed} {size}",
            f"different {int(10 * len(set(part)) / len(part))} {size}", f"hex {hexlike} {_level(digits, 0.01, 0.3, 0.7, 1.0)} {size}",
            f"start {''.join('0' if c in _DIGITS else c for c in part[:3])}", f"before {kinds[i]}", f"after {kinds[i + 2]}",
            f"inner {label_here} {kind}", f"place {min(i, 4)} {len(parts) - i == 1}", f"signs {signs} {kind} {_level(len(part), 4, 8, 16)}",
        ]
        rows.append([zlib.crc32(f.encode()) % SLOTS for f in own] + fixed)
        if part.isalpha():
            label_here = part.lower()
    return tokens, rows


def contexts(text: str, places: list[tuple[int, int]]) -> Iterator[tuple[int, int, tuple[str, str, str, str], bool]]:
    """Chunks, what is around them (as ``chunk_features`` takes it), and whether they hold a digit."""
    last, end, i = {True: 0, False: 0}, 0, 0
    for line in text.split("\n") if places else ():
        words = line.split()
        for k, word in enumerate(words):
            if len(word) < MIN_LENGTH:
                continue
            start = text.index(word, end)  # the words between are shorter, so none of them holds this one
            end = start + len(word)
            second, first = words[k - 2] if k > 1 else "", words[k - 1] if k else ""
            behind = words[k + 1] if k + 1 < len(words) else ""
            while i < len(places) and places[i][0] < end:
                a, b = places[i]
                i += 1
                digit = _DIGIT.search(text, a, b) is not None
                # Joined is what lies behind the chunk before of the same kind: the name of a secret may be a chunk itself.
                yield a, b, (second, first, text[max(start, last[digit]) : a], behind), digit
                last[digit] = b
            if i == len(places):
                return


def tagged_chunks(text: str, base: list[tuple[int, str, int, int]], every: int = 0) -> list[tuple[list[list[int]], list[int] | None, bool]]:
    """Per chunk: slots of features, tags by the base spans, and whether it holds a digit; no tags where these tell nothing.

    Sixteen digits alone match a pattern but may as well be a number of any kind.
    Of the chunks with neither a digit nor a base span, one in 4 in one in ``every`` texts is taken, by hash; all if that is 0.
    """
    secret: list[tuple[int, int]] = []
    for s, e in sorted((inner, e) for _, _, e, inner in base):
        if secret and s < secret[-1][1]:
            secret[-1] = (secret[-1][0], max(secret[-1][1], e))
        else:
            secret.append((s, e))
    first = [s for s, _ in secret]

    drawn = not every or not zlib.crc32(text.encode()) % every
    if not drawn and not secret and not _DIGIT.search(text):
        return []

    def wanted(a: int, b: int) -> bool:
        if _DIGIT.search(text, a, b):
            return True
        i = bisect_right(first, b - 1)  # the spans do not overlap, so the last that begins before the end reaches farthest
        return i > 0 and secret[i - 1][1] > a or drawn and (not every or not zlib.crc32(text[a:b].encode()) % 4)

    places = [(a, b) for a, b in chunks(text) if wanted(a, b)]
    if not places:
        return []
    file, out, near = file_features(text), [], 0
    for a, b, around, digit in contexts(text, places):
        tokens, rows = chunk_features(text, a, b, around, file)
        tags: list[int] | None = []
        for s, e in tokens:
            while near < len(secret) and secret[near][1] <= s:
                near += 1
            if near == len(secret) or secret[near][0] > s:
                tags.append(OUTSIDE)
            else:
                tags.append(INSIDE if tags and tags[-1] != OUTSIDE and s > secret[near][0] else BEGIN)
        if any(tags) and all(c in _DIGITS for (s, e), tag in zip(tokens, tags) if tag for c in text[s:e]):
            tags = None
        out.append((rows, tags, digit))
    return out


def _random(chance: random.Random, letters: str, n: int) -> str:
    while True:
        made = "".join(chance.choices(letters, k=n))
        if any(c in _DIGITS for c in made):
            return made


_FRAMES = (
    "{k} = {s}", "{k}={s}", "{k}: {s}", '"{k}": "{s}"', "export {K}={s}", "{w} {w} {k} {s} {w}", "Authorization: Bearer {s}",
    "the {k} is {s} and {w}", "--{k} {s}", "<{k}>{s}</{k}>", "{w} {w} {s} {w} {w}", "curl -H 'X-Api-Key: {s}' {w}",
)
_NAMES = ("password", "passwd", "secret", "token", "api_key", "apikey", "access_key", "private_key", "client_secret", "auth", "credential", "pwd", "key")
_OTHERS = (
    "{w} {w} {s} {w} {w}", "{w} on {s}, {w}", "{w}: {s}", "date: {s}", "id = {s}", "version {s}", "see {s} for {w}", "({s}) {w}",
    "phone {s}", "order {s} {w}", "{s}", "the {w} of {s} {w}", '"{w}": "{s}"', "{w}={s}",
)


def _word(chance: random.Random) -> str:
    return "".join(chance.choices("abcdefghilmnoprstu", k=chance.randrange(3, 9)))


def _lines(chance: random.Random, n: int, secrets: tuple[Callable[[], str], ...], plain: tuple[Callable[[], str], ...]) -> list[tuple[str, list[tuple[int, int]]]]:
    """Every third line frames one of ``secrets``, the others one of ``plain``."""
    w, made = lambda: _word(chance), []
    for i in range(n):
        good = i % 3 == 0
        frame, value = chance.choice(_FRAMES if good else _OTHERS), chance.choice(secrets if good else plain)()
        if frame == "{w} {w} {s} {w} {w}" and good and len(value) < 24:
            frame = "{k}: {s}"  # short ones are secrets by what names them only
        name = chance.choice(_NAMES)
        frame = frame.replace("{k}", name).replace("{K}", name.upper())
        while "{w}" in frame:
            frame = frame.replace("{w}", w(), 1)
        at = frame.index("{s}")
        more = "\n".join(" ".join(w() for _ in range(chance.randrange(3, 14))) for _ in range(chance.randrange(4)))
        text = frame.replace("{s}", value) + "\n" + more
        made.append((text, [(at, at + len(value))] if good else []))
    return made


def examples(seed: int = 12, n: int = 1500) -> list[tuple[str, list[tuple[int, int]]]]:
    """Lines made by rule, with the places of the secrets in them, all with digits."""
    chance = random.Random(seed)
    small, upper, base = "abcdefghijklmnopqrstuvwxyz0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    d = lambda k: "".join(chance.choices(_DIGITS, k=k))
    h = lambda k: "".join(chance.choices("0123456789abcdef", k=k))
    w = lambda: _word(chance)
    secrets = (
        lambda: _random(chance, base, chance.randrange(16, 44)),
        lambda: _random(chance, base + "+/", chance.choice([24, 32, 40])) + chance.choice(["", "=", "=="]),
        lambda: f"{chance.choice(['sk', 'pk', 'rk'])}_{chance.choice(['live', 'test'])}_{_random(chance, base, 24)}",
        lambda: f"gh{chance.choice('pousr')}_{_random(chance, base, 36)}",
        lambda: f"xox{chance.choice('bap')}-{d(11)}-{d(11)}-{_random(chance, base, 24)}",
        lambda: f"eyJ{_random(chance, base, 30)}.{_random(chance, base + '_-', 40)}.{_random(chance, base + '_-', 43)}",
        lambda: f"AKIA{_random(chance, upper, 16)}",
        lambda: h(chance.choice([20, 32, 40, 64])),
        lambda: _random(chance, small, chance.randrange(18, 32)),
    )
    plain = (
        lambda: f"20{d(2)}-0{chance.randrange(1, 9)}-{chance.randrange(10, 28)}",
        lambda: f"20{d(2)}-0{chance.randrange(1, 9)}-1{d(1)}T1{d(1)}:{d(2)}:{d(2)}Z",
        lambda: f"{chance.randrange(1, 20)}.{d(2)}.{d(3)}-beta{d(1)}",
        lambda: f"{w()}.{d(2)}@{w()}{d(1)}.example.com",
        lambda: ".".join(str(chance.randrange(256)) for _ in range(4)),
        lambda: f"+{d(1)} ({d(3)}) 555-{d(4)}",
        lambda: f"{d(3)}-{d(3)}-{d(4)}",
        lambda: f"{h(8)}-{h(4)}-4{h(3)}-a{h(3)}-{h(12)}",
        lambda: f"https://www.{w()}.com/20{d(2)}/{d(2)}/{w()}-{w()}-{w()}-{d(2)}.html",
        lambda: f"{w()}_{w()}_20{d(2)}.pdf",
        lambda: f"/usr/lib/{w()}{d(1)}/{w()}.so.{d(1)}",
        lambda: f"INV-20{d(2)}-{d(5)}",
        lambda: f"978-{d(1)}-{d(3)}-{d(5)}-{d(1)}",
        lambda: f"{d(1)}{d(6)}.{d(2)}",
        lambda: f"{w()}{w()}{d(2)}",
        lambda: f"{d(4)}-{d(4)}",
        lambda: f"{d(chance.randrange(8, 15))}",
        lambda: f"{w().title()}{w().title()}{d(1)}",
        lambda: f"{w()}-{w()}-{d(2)}",
        lambda: f"{chance.choice(['DE', 'FR', 'GB'])}{d(20)}",
        lambda: f"{d(2)}/{d(2)}/20{d(2)}",
    )
    return _lines(chance, n, secrets, plain)


def letter_examples(seed: int = 13, n: int = 900) -> list[tuple[str, list[tuple[int, int]]]]:
    """Lines made by rule, with the places of the secrets in them, all without digits."""
    chance = random.Random(seed)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
    w = lambda: _word(chance)
    long = lambda: (w() + w() + w())[:16] if chance.random() < 0.5 else w() + chance.choice(["ation", "ingly", "ments", "ities", "ological"])
    secrets = (
        lambda: "".join(chance.choices(letters, k=chance.randrange(16, 44))),
        lambda: "".join(chance.choices(letters, k=chance.randrange(10, 16))),
        lambda: "".join(chance.choices(letters + "+/", k=chance.choice([24, 32, 40]))) + chance.choice(["", "=", "=="]),
        lambda: f"{chance.choice(['sk', 'pk', 'rk'])}_{chance.choice(['live', 'test'])}_{''.join(chance.choices(letters, k=24))}",
        lambda: f"gh{chance.choice('pousr')}_{''.join(chance.choices(letters, k=36))}",
    )
    plain = (
        long, long, long, lambda: long().title(), lambda: long().upper(), lambda: f"{long()}s",
        lambda: w().title() + w().title() + w().title(), lambda: w() + w().title() + w().title(),
        lambda: f"{w()}-{w()}-{w()}", lambda: f"{w()}_{w()}_{w()}", lambda: f"{w().upper()}_{w().upper()}_{w().upper()}",
        lambda: f"https://www.{w()}.com/{w()}/{w()}-{w()}-{w()}.html", lambda: f"/usr/lib/{w()}/{w()}.so", lambda: f"{w()}.{w()}.{w()}()",
        lambda: f"{w()}.{w()}@{w()}.example.com", lambda: f"{w()}/{w()}/{w()}.py", lambda: f"{long()}/{long()}", lambda: f"{w()}...{w()}",
        lambda: chance.choice("-=_.+") * chance.randrange(8, 30),
    )
    return _lines(chance, n, secrets, plain)


def _example_sequences() -> dict[bool, list[tuple[np.ndarray, list[int]]]]:
    """Tagged chunks of the examples: with a digit, and without."""
    found: dict[bool, list[tuple[np.ndarray, list[int]]]] = {True: [], False: []}
    for kind, made in ((True, examples()), (False, letter_examples())):
        for text, places in made:
            for rows, tags, digit in tagged_chunks(text, [(s, FOUND, e, s) for s, e in places]):
                if tags is not None and digit == kind:
                    found[kind].append((np.array(rows), tags))
    return found


def _lessons(df: DataFrame, id_col: str, text_col: str, fit_tokens: int) -> DataFrame:
    """Chunks to learn from, those of a row with a digit and those without in a row each: id, digit, where the chunks begin, tags and features.

    Rows of more than ``fit_tokens`` tokens are left out.
    """

    def make():
        def rows(key, text):
            found = tagged_chunks(text, base_spans(text), FIT_EVERY)
            for digit in (True, False):
                firsts, tags, slots = [], [], []
                for features, tagged, kind in found:
                    if kind == digit:
                        firsts.append(len(tags))
                        tags += [-1] * len(features) if tagged is None else tagged
                        slots += features
                if 0 < len(tags) <= fit_tokens:
                    packed = np.array(slots, "<u2").tobytes()
                    yield key, digit, firsts, tags, packed, zlib.crc32(packed)

        return rows

    return by_text(df, id_col, text_col, f"id {id_type(df, id_col)},digit boolean,firsts array<long>,tags array<long>,slots binary,key long", make)


def _sequences(tags: list[int], firsts: list[int], slots: bytes) -> list[tuple[np.ndarray, list[int]]]:
    table = np.frombuffer(slots, "<u2").reshape(len(tags), -1).astype("int64")
    return [(table[a:b], tags[a:b]) for a, b in zip(firsts, [*firsts[1:], len(tags)])]


def train(lessons: DataFrame, fit_rows: int = FIT_ROWS, fit_chunks: int = FIT_CHUNKS) -> dict[bool, Tagger]:
    """The models for chunks with a digit (True) and without, each from at most ``fit_rows`` rows of
    ``lessons`` with pattern secrets and as many others, picked by hash, and of these at most
    ``fit_chunks`` chunks."""
    usable = lessons.withColumn("some", F.exists("tags", lambda t: t == BEGIN)).withColumn("_drawn", F.xxhash64("id", "key"))
    made, models = _example_sequences(), {}
    for digit in (True, False):
        sequences: list[tuple[np.ndarray, list[int]]] = []
        own = usable.where(F.col("digit") == digit)
        for part in (own.where("some"), own.where("NOT some")):
            # Some twice as many as wanted are drawn by hash before they are sorted, so that no task sends its own ``fit_rows``.
            share = min(1.0, 2 * fit_rows / max(1, part.count()))
            drawn = part.where(F.pmod("_drawn", F.lit(1 << 20)) <= int(share * (1 << 20)))
            for r in drawn.orderBy("_drawn", "key", "slots", "tags").limit(fit_rows).select("tags", "firsts", "slots").collect():
                sequences += [s for s in _sequences(r.tags, r.firsts, r.slots) if -1 not in s[1]]
        first = fit(made[digit], SLOTS)
        # A chunk that no pattern matches may hold a secret all the same: where the examples alone say so, it teaches nothing.
        sure = [s for s in sequences[:fit_chunks] if BEGIN in s[1] or BEGIN not in first.decode(s[0])]
        models[digit] = fit(made[digit] + sure, SLOTS)
    return models


def searcher(models: dict[bool, Tagger]) -> Callable[[str], list[tuple[int, int]]]:
    """A function that gives the spans which the models tag in a text, in order.

    A chunk that is one word of letters has no steps between tags: it is a
    secret if its features gain more by beginning one than by staying outside.
    But for its first letters, a word's own features are those of its shape:
    letter cases, length, runs, different letters, and whether it could be hex.
    What a shape gains is remembered; the others are a sum of a few slots.
    """
    field = models[False]
    gain = (field.features[:, BEGIN] - field.features[:, OUTSIDE]).tolist()
    ends = float((field.first + field.last)[BEGIN] - (field.first + field.last)[OUTSIDE])
    crc = zlib.crc32
    in_label, in_second, in_behind, in_inner, in_start = (crc(f"{x} ".encode()) for x in ("label", "second", "behind", "inner", "start"))
    signs = Remembered(lambda feature: gain[crc(feature.encode()) % SLOTS], 20_000)

    def around_it(front: str, back: str, label: str, second: str, behind: str, kind: str) -> float:
        name = label.encode()
        labelled = crc(name, in_label)
        return (
            signs["front " + front] + signs["back " + back] + gain[labelled % SLOTS]
            + gain[crc(second.encode(), in_second) % SLOTS] + gain[crc(behind.encode(), in_behind) % SLOTS]
            + gain[crc(b"  " if front.isspace() else f" {front}".encode(), labelled) % SLOTS] + gain[crc(f" {kind}".encode(), crc(name, in_inner)) % SLOTS]
        )

    def first_letters(word: str) -> float:
        return gain[crc(word[:3].encode(), in_start) % SLOTS]

    def shape_gain(word: str, kind: str) -> float:
        """Of a word's own features but its first letters; exactly the same for all words of a shape."""
        slots = chunk_features(word, 0, len(word), ("", "", "", ""), [])[1][0]
        return math.fsum([ends, *(gain[x] for x in slots), -first_letters(word), -around_it("^", "$", "^", "^", "$", kind)])

    shapes: dict[tuple, float] = {}

    def spans(text: str) -> list[tuple[int, int]]:
        places, found = chunks(text), []
        if not places:
            return found
        file = file_features(text)
        whole = sum(signs[f"file {x}"] for x in file)
        for a, b, around, digit in contexts(text, places):
            chunk = text[a:b]
            if chunk.isalpha():
                second, first, joined, behind = around
                label = _known(joined) if _LETTERS.search(joined) else _known(first) if first else "^"
                if chunk.islower():
                    kind, shape = "a", (b - a, len(set(chunk)), not chunk.strip("abcdef"))
                elif chunk.isupper():
                    kind, shape = "A", (b - a, len(set(chunk)))
                else:
                    kind, shape = "aA", (b - a, len(set(chunk)), len(_RUN.findall(chunk)), "aA")
                own = shapes.get(shape)
                if own is None:
                    if len(shapes) >= 50_000:
                        shapes.clear()
                    own = shapes[shape] = shape_gain(chunk, kind)
                beside = around_it(text[a - 1 : a] or "^", text[b : b + 1] or "$", label, _known(second) if second else "^", _known(behind) if behind else "$", kind)
                if own + first_letters(chunk) + whole + beside > 0:
                    found.append((a, b))
                continue
            tokens, rows = chunk_features(text, a, b, around, file)
            for (s, e), tag in zip(tokens, models[digit].decode(np.array(rows))):
                if tag == BEGIN:
                    found.append((s, e))
                elif tag == INSIDE:
                    found[-1] = (found[-1][0], e)
        return found

    return spans


def all_spans(base: str, found: list[tuple[int, int]], min_length: int = MIN_LENGTH) -> tuple[str, int]:
    """Base spans and the found ones that overlap none of them, by start; and how many were added."""
    own = [(int(s), int(e), KINDS.index(k), k) for k, s, e in (x.split(":") for x in base.split(",") if x)]
    taken = sorted((s, e) for s, e, _, _ in own)
    reach, added, i = 0, [], 0
    for s, e in found:
        while i < len(taken) and taken[i][0] < e:
            reach = max(reach, taken[i][1])
            i += 1
        if e - s >= min_length and reach <= s:
            added.append((s, e, len(KINDS), FOUND))
    ordered = sorted(own + added, key=lambda x: (x[0], x[2]))
    return ",".join(f"{k}:{s}:{e}" for s, e, _, k in ordered), len(added)


def find_secrets(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", fit_rows: int = FIT_ROWS, fit_tokens: int = FIT_TOKENS) -> DataFrame:
    """Per row: id, n_assign, n_access, n_hex (base spans by kind), base, spans and n_found.

    Spans are ``kind:start:end`` by start, then kind (assign, access, hex, and
    secret for what the model adds), comma-joined; code points, end exclusive.
    Base spans always stay; added ones overlap none of them. Null and empty
    texts have none. Repeated rows and null ids give a row each; an empty table
    gives none; other columns are not read. Texts are read twice: for a bounded
    sample that the models (tables of fixed size) are fitted on, then to tag
    every chunk of every text. Time grows with the length of a text.
    """
    models = train(materialise(_lessons(df, id_col, text_col, fit_tokens)), fit_rows)

    def make():
        find = searcher(models)

        def rows(key, text):
            base = base_spans(text)
            number = [sum(k == kind for _, k, _, _ in base) for kind in KINDS]
            listed = ",".join(f"{k}:{s}:{e}" for s, k, e, _ in base)
            yield key, *number, listed, *all_spans(listed, find(text))

        return rows

    schema = f"id {id_type(df, id_col)},n_assign long,n_access long,n_hex long,base string,spans string,n_found long"
    return by_text(df, id_col, text_col, schema, make).withColumnRenamed("id", id_col)
