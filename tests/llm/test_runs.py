"""Periodic runs against brute force, and on hostile rows."""

import hashlib
import random
import time
import zlib

import numpy as np
import pytest

from newsflow.llm import runs
from newsflow.llm.queries import QUERIES


def brute(words, min_length=6, min_exponent=4):
    n, found = len(words), []

    def smallest(part):
        return next(q for q in range(1, len(part) + 1) if part[q:] == part[: len(part) - q])

    for q in range(1, n):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j + q - i
            if length >= max(min_length, min_exponent * q) and smallest(words[i : i + length]) == q:
                found.append((i, length, q))
            i = j
    return sorted(found)


@pytest.mark.parametrize("limits", [(6, 4), (2, 2), (9, 3), (4, 4), (30, 5)])
def test_runs_equal_brute_force(limits):
    chance = random.Random(sum(limits))
    for trial in range(400):
        n, letters = chance.randrange(60), chance.choice([1, 2, 3, 6])
        words = [chance.randrange(letters) for _ in range(n)]
        if trial % 2 and n > 4:
            q, at = chance.randrange(1, 6), chance.randrange(n)
            words = words[:at] + words[at : at + q] * chance.randrange(1, 9) + words[at:]
        assert runs.runs_of(np.array(words, "int64"), *limits) == brute(words, *limits), words


def test_long_texts_take_little_more_than_their_length():
    same = np.zeros(200_000, "int64")
    start = time.time()
    assert runs.runs_of(same) == [(0, 200_000, 1)]
    line = np.tile(np.arange(17), 6000)
    assert runs.runs_of(line) == [(0, 102_000, 17)]
    # One phrase with other neighbours each time: a node of many places and no run.
    phrase = np.concatenate([np.r_[np.arange(8), 10 + i, 50_000 + i] for i in range(20_000)])
    assert runs.runs_of(phrase) == []
    assert time.time() - start < 60


def test_hostile_rows_of_an_operator(spark):
    long = "a b " * 50_000
    rows = [(1, None, "x"), (2, "", "x"), (3, " \n\t ", None), (4, "a a\ta\na\x0ba\x0ca end", "x"), (4, "a a\ta\na\x0ba\x0ca end", "x"), (None, "no run", "x"), (5, long, "x"), (6, "a a a a", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs string")
    got = sorted(((r.doc_id, [tuple(x) for x in r.runs], r.collapsed) for r in runs.find_runs(docs).collect()), key=str)
    whole = [(0, 6, 1)]
    want = [(1, [], ""), (2, [], ""), (3, [], ""), (4, whole, "a end"), (4, whole, "a end"), (None, [], "no run"), (5, [(0, 100_000, 2)], "a b"), (6, [], "a a a a")]
    assert got == sorted(want, key=str)
    assert runs.find_runs(docs.limit(0)).collect() == []


def test_query_on_its_table(spark, tmp_path):
    chance = random.Random(13)
    texts = {i: " ".join(chance.choice("abcdefgh") + chance.choice("xy") for _ in range(chance.randrange(90))) for i in range(300)}
    texts |= {301: None, 302: "", 303: "one", 304: "z " * 40, 305: "p q r " * 9 + "p q q q q q q q q"}
    spark.createDataFrame(list(texts.items()), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in QUERIES["op13_periodic_runs"](spark, str(tmp_path)).collect()}
    assert len(got) == len(texts)
    for i, text in texts.items():
        words = (text or "").split()
        n, h = len(words), zlib.crc32(str(i).encode())
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if k < a else words[a + (k - a) % p] for k, w in enumerate(words)]
        found = brute(words)
        dropped = {k for s, length, q in found for k in range(s + q, s + length)}
        r = got[i]
        assert r.n_runs == len(found)
        if found:
            best = min(found, key=lambda x: (-x[1] / x[2], x[0], x[2]))
            assert (r.start, r.length, r.period, r.exponent_milli) == (*best, 1000 * best[1] // best[2])
        else:
            assert (r.start, r.length, r.period, r.exponent_milli) == (None,) * 4
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        assert r.runs_sha256 == sha("".join(f"{s},{length},{q}\n" for s, length, q in found))
        assert r.collapsed_sha256 == sha(" ".join(w for k, w in enumerate(words) if k not in dropped))
