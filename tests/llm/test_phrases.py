"""Collocations against brute force, the guarantee of merged summaries, and hostile rows."""

import collections
import random
import re

import numpy as np
import pytest

from newsflow.llm import phrases


def brute(rows, max_words=3, threshold=10, absorb=50, first=2000):
    f, n = collections.defaultdict(collections.Counter), collections.Counter()
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(lower)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for s in range(1, max_words + 1):
                f[lang].update(tuple(words[i : i + s]) for i in range(len(words) - s + 1))
    out = []
    for lang, counts in f.items():
        candidates = {p: a for p, a in counts.items() if len(p) > 1 and a >= threshold}
        ranked = []
        for p, a in candidates.items():
            inside = lambda q: any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
            if any(len(q) > len(p) and 100 * b >= absorb * a and inside(q) for q, b in candidates.items()):
                continue
            score, k = min((1_000_000 * a * a // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p)))
            ranked.append((-score, -a, " ".join(p).encode(), " ".join(p), counts[p[:k]], counts[p[k:]]))
        for rank, (score, a, _, phrase, left, right) in enumerate(sorted(ranked)[:first], 1):
            out.append((lang, rank, phrase, -a, left, right, n[lang], -score))
    return sorted(out)


def rows_of(frame):
    return sorted(map(tuple, frame.collect()))


SCHEMA = "lang string, text string, phrase string, size string, n string, batch string"


def frame(spark, rows, parts=5):
    return spark.createDataFrame([(*r, "x", "y", None, "z") for r in rows], SCHEMA).repartition(parts)


@pytest.mark.parametrize("seed", range(3))
def test_phrases_equal_brute_force(spark, seed):
    chance = random.Random(seed)
    vocabulary = ["New", "york", "İstanbul", "é", "ab", "a\x1cb", "x y", "of", "the", "THE", "﻿", "日本", "\x00", "longer-word"]
    weights = [chance.random() ** 2 for _ in vocabulary]
    rows = []
    for _ in range(250):
        words = chance.choices(vocabulary, weights, k=chance.randrange(30))
        text = "".join(w + chance.choice([" ", " ", " ", "  ", "\t", ". ", "\n", ",", "\r\n"]) for w in words)
        rows.append((chance.choice(["en", "en", "en", "de", None, ""]), text))
    rows += [("en", "New york city")] * 40 + [("en", None), (None, ""), ("fr", " . ")]
    want = brute(rows)
    assert len(want) > 30
    assert rows_of(phrases.top_collocations(frame(spark, rows))) == want
    # Many small batches and partitions, so that summaries are merged and cut.
    assert rows_of(phrases.top_collocations(frame(spark, rows), batch_bytes=500, part_mass=300)) == want
    longer = brute(rows, 5, 4, 70, 50)
    assert rows_of(phrases.top_collocations(frame(spark, rows), first=50, max_words=5, threshold=4, absorb_percent=70, batch_bytes=2000, part_mass=900)) == longer


def test_merged_summaries_keep_every_frequent_key():
    for seed in range(30):
        chance = np.random.default_rng(seed)
        parts = [np.unique(chance.zipf(1.3, 4000) % 3000, return_counts=True) for _ in range(12)]
        true = collections.Counter()
        for keys, counts in parts:
            true.update(dict(zip(keys.tolist(), counts.tolist())))
        mass = sum(true.values())
        for threshold in (10, 60, 400):
            capacity = mass // threshold + 1
            whole = (np.zeros(0, "uint64"), np.zeros(0, "int64"), 0)
            for keys, counts in parts:
                whole = phrases.merged([whole, (keys.astype("uint64"), counts, 0)], capacity)
            keys, counts, error = whole
            assert len(keys) <= capacity and error < threshold
            assert all(c <= true[k] <= c + error for k, c in zip(keys.tolist(), counts.tolist()))
            assert {k for k, c in true.items() if c >= threshold} <= set(keys.tolist())
            got = phrases.frequent_keys([(k.astype("uint64"), c, 0) for k, c in parts], threshold)
            assert {k for k, c in true.items() if c >= threshold} <= set(got.tolist())


def test_scores_are_exact_beyond_64_bits(spark):
    grams = [("en", "a", 1, 9_000_000_000_001), ("en", "b", 1, 9_000_000_000_000), ("en", "a b", 2, 8_999_999_999_999)]
    a, left, right = (g[3] for g in (grams[2], grams[0], grams[1]))
    text = spark.createDataFrame([(a, left, right)], "a long, l long, r long").selectExpr(
        "(cast(a AS decimal(13,0)) * cast(a AS decimal(13,0)) * cast(1000000 AS decimal(7,0))) div (cast(l AS decimal(13,0)) * cast(r AS decimal(13,0))) AS score"
    )
    assert text.first().score == 1_000_000 * a * a // (left * right)


def test_empty_tables_and_long_texts(spark):
    assert rows_of(phrases.top_collocations(frame(spark, [("en", "x")]).limit(0))) == []
    assert rows_of(phrases.top_collocations(frame(spark, [(None, None), ("en", "")]))) == []
    long = " ".join(f"w{i % 997} v{i % 13}" for i in range(60_000))
    rows = [("en", long), ("en", "one two")]
    assert rows_of(phrases.top_collocations(frame(spark, rows), batch_bytes=1000)) == brute(rows)
