"""The text operators on hostile rows, and against brute force."""

import collections
import re
import textwrap
import time
import zlib

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from newsflow.llm import licenses, links, mixing, near_vectors, ngram_join, packing, personal_data, queries, rules, site_quality, tokens, url_rules
from newsflow.llm.features import counts

WORD = r"[^\x20\x09-\x0D]+"
LONG = " ".join(f"word{i % 700}{chr(97 + i % 26)}" for i in range(9000))
BASE = " ".join(f"w{i}" for i in range(60))
TEXTS = [
    (1, None), (2, ""), (3, " \n\t "), (4, BASE), (5, BASE), (5, BASE), (6, BASE + " tail"), (7, BASE.upper()),
    (8, LONG), (9, "a"), (10, "a b"), (11, "  two  spaces ▁ and\n\nlines\x1cfs <|endoftext|> é Σίσυφος ﬁ"), (None, "no id here"),
    (12, "x" * 3000), (13, "Mail a.b@c.example.com or +1 (555) 555-0100, ip 10.0.0.300 10.1.2.3 card 4111 1111 1111 1111."),
]
SCHEMA = "doc_id long, text string, source string, lang string, n_chars long, id string, size string, kept string, cls string, _hash string"


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, ["s1", None, "s1", "s2"][n % 4], "en", len(t or ""), "x", "y", "z", "c", "h") for n, (i, t) in enumerate(TEXTS)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(4, 1, 0, "t"), (8, 1, 0, "t"), (12, 0, 0, "t"), (12, None, 0, "t")], "doc_id long, quality int, toxic int, text string")


def bag(rows):
    return collections.Counter(map(tuple, rows))


def test_token_counts_equal_the_library(docs, none):
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    got = tokens.count_tokens(docs, path)
    assert bag(got.collect()) == bag((i, len((t or "").encode()), n := len(model.encode(t or "")), n > 4096) for i, t in TEXTS)
    assert tokens.count_tokens(none, path).collect() == []
    whole = tokens.whole_tokens(path)
    assert len(whole) > 5000 and all(len(model.encode(w)) == 1 for w in list(whole)[:200])


def test_packing_is_exact_and_full(docs, none):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    want = []
    for i, t in TEXTS:
        ids = library.encode(t or "", add_special_tokens=False).ids + [1]
        want += [(i, p, s, len(ids[s : s + 4096]), zlib.crc32(np.array(ids[s : s + 4096], "<u4").tobytes())) for p, s in enumerate(range(0, len(ids), 4096))]
    got = packing.pack_documents(docs, path).collect()
    assert bag(r[:5] for r in got) == bag(want)
    bins = collections.defaultdict(list)
    for r in got:
        bins[r.sequence_id].append((r.offset, r.length))
    for parts in bins.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 4096
    assert packing.pack_documents(none, path).collect() == []


def test_bins_are_the_fullest():
    random = np.random.default_rng(1)
    for _ in range(30):
        sizes = random.integers(1, 30, 8).tolist()
        room = int(random.integers(5, 60))
        taken = packing.fullest(collections.Counter(sizes), room)
        sums = {0}
        for s in sizes:
            sums |= {x + s for x in sums}
        assert sum(k * n for k, n in taken.items()) == max(x for x in sums if x <= room)
        assert all(n <= sizes.count(k) for k, n in taken.items())
    plan = packing.plan_bins({4096: 1000, 4000: 10, 96: 10, 50: 3}, 4096)
    assert sum(t for t, _ in plan) == 1011


def brute_spans(text):
    shapes = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
        "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+",
        "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    }
    found = []
    for kind, shape in shapes.items():
        for m in re.finditer(shape, text):
            digits = re.sub("[^0-9]", "", m[0])
            luhn = sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(digits))) % 10 == 0
            if kind == "ip" and max(map(int, m[0].split("."))) > 255 or kind == "card" and not (16 <= len(digits) <= 19 and luhn) or kind == "phone" and not 8 <= len(digits) <= 15:
                continue
            found.append((kind, m.start(), m.end()))
    return found


def test_base_spans_equal_the_patterns():
    random = np.random.default_rng(2)
    pieces = ["a@b.c", "@", ".", "+", "1.2.3.4", "256.1.1.1", "4111 1111 1111 1111", "x", " ", "-", "+1 (555) 555-0100", "12", "é", "\n", "a.b@c-d.e.f+g@h.i", "1.2.3.4.5.6.7.8"]
    for _ in range(2000):
        text = "".join(random.choice(pieces, 8))
        assert personal_data.base_spans(text) == brute_spans(text), text
    zeros = "0" * 5000
    assert personal_data.base_spans(f"at {zeros}1.2.3.{zeros}255") == [("ip", 3, 10012)]


def test_contexts_find_unseen_identifiers(spark, docs, none):
    rows = [(n, f"please write to contact mail user{n}@site{n}.example.com today") for n in range(12)]
    rows += [(100, "please write to contact mail user77xx99@localhost today"), (101, "some other words 123456 stand here")]
    got = {r.doc_id: r for r in personal_data.find_personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[100].spans == "id:29:49" and got[100].n_found == 1 and got[101].spans == ""
    assert all(got[n].n_email == 1 and got[n].spans.startswith("email:29:") for n in range(12))
    found = personal_data.find_personal_data(docs).select("doc_id", "base").collect()
    assert bag(found) == bag((i, ",".join(f"{k}:{a}:{b}" for k, a, b in brute_spans(t or ""))) for i, t in TEXTS)
    assert personal_data.find_personal_data(none).collect() == []
    assert personal_data.masked("to a@b.cd +1 2", "email:3:9") == "to [EMAIL] +1 2"
    masked = personal_data.mask_documents(docs, length_col="n_chars")
    assert masked.columns == docs.columns and masked.where("doc_id = 13").first().text.startswith("Mail [EMAIL] or [PHONE], ip 10.0.0.300 [IP] card [CARD]")


def test_identifiers_of_all_shapes_and_places(spark):
    shapes = ["0a:1b:2c:3d:4e:5f", "AB12CD34", "QQ12-34-56C", "12-34-56", "1234 5678 9012"]
    for shape in shapes:
        assert personal_data.lookalikes(f"some {shape}, here", []) == [(5, 5 + len(shape))], shape
    assert personal_data.lookalikes("id1:12345678 x", []) == [(4, 12)]
    rows = [(n, f"please write to contact mail user{n}@site{n}.example.com today") for n in range(40)]
    rows += [(100 + n, f"please write to contact mail {shape} today") for n, shape in enumerate(shapes)]
    rows += [(200 + n, f"{shape} stands elsewhere") for n, shape in enumerate(shapes)]
    got = {r.doc_id: r.spans for r in personal_data.find_personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for n, shape in enumerate(shapes):
        assert got[100 + n] == f"id:29:{29 + len(shape)}" and got[200 + n] == f"id:0:{len(shape)}"


def test_rounds_go_on_to_the_last_name(spark):
    """Each pattern is sure only by the name that the pattern before found."""
    edges = [("p0", f"a{i}", "email") for i in range(5)] + [("p0", "n0", "")]
    for k in range(1, 6):
        edges += [(f"p{k}", f"n{k - 1}", ""), (f"p{k}", f"n{k}", "")] + [(f"p{k}", f"b{k}-{i}", "email") for i in range(4)]
    _, names = personal_data.bootstrap(spark.createDataFrame(edges, "pattern string, name string, kind string"))
    assert {r.name for r in names.collect()} == {f"n{k}" for k in range(6)}


def test_licenses(spark, docs, none):
    s = licenses.SENTENCES
    bsd = ["bsd-grant", "bsd-source", "bsd-binary"]
    rows = [
        (1, "\n".join(s[x] + "." for x in bsd)),
        (2, "\n".join("# " + s[x].upper().replace("<>", "THE COPYRIGHT HOLDER") + ":" for x in [*bsd, "bsd-endorse"])),
        (3, "\n".join(s[x] for x in reversed(bsd))),
        (4, "x. Licensed under the Apache License, Version 2.0.\nReleased under the MIT License."),
        (4, "x. Licensed under the Apache License, Version 2.0.\nReleased under the MIT License."),
        (5, None),
    ]
    got = licenses.find_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert bag(got) == bag([(1, 3, "BSD-2-Clause"), (2, 4, "BSD-3-Clause"), (3, 3, ""), (4, 2, "Apache-2.0,MIT"), (4, 2, "Apache-2.0,MIT"), (5, 0, "")])
    assert licenses.find_licenses(docs).count() == len(TEXTS) and licenses.find_licenses(none).count() == 0


MPL = "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."


def test_wrapped_licenses(spark):
    s = licenses.SENTENCES
    mit = f"Copyright (c) 2020 Somebody\n{s['mit-grant']}:\n\n{s['mit-condition']}.\n\n{s['mit-warranty']}. IN NO EVENT"
    bsd = f"{s['bsd-grant']}:\n\n1. {s['bsd-source']}.\n2. {s['bsd-binary']}.\n3. {s['bsd-endorse'].replace('<>', 'the copyright holder', 1).replace('<>', 'its contributors')}."
    gpl = lambda first: f"{s[first]}.\n\n{s['gpl-hope']}; {s['gpl-fitness']}. See the GNU General Public License for more details."
    apache = f"{s['apache-notice-long']};\n{s['apache-compliance']}.\n{s['apache-copy']}\n\nhttp://www.apache.org/licenses/LICENSE-2.0"
    title = "        Apache License\n     Version 2.0, January 2004\n  http://www.apache.org/licenses/"
    texts = [("MIT", mit), ("MIT", f"MIT License\n{mit}"), ("BSD-3-Clause", bsd), ("GPL-3.0", gpl("gpl-free")), ("GPL-2.0", gpl("gpl2-free")), ("Apache-2.0", apache), ("MPL-2.0", MPL), ("ISC", s["isc-grant"] + ".")]
    rows = [("Apache-2.0", title)]
    for name, text in texts:
        for width in (30, 72, 80):
            for mark in ("", "# ", " * ", "// "):
                lines = [x for line in text.split("\n") for x in textwrap.wrap(line, width) or [""]]
                rows.append((name, "\n".join(["import os", "", *(mark + x for x in lines)])))
    rows += [("", s["mit-grant"][:200] + "\n\n" + s["mit-grant"][200:])]  # two paragraphs
    frame = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(rows)], "doc_id long, text string")
    got = {r.doc_id: r.licenses for r in licenses.find_licenses(frame).collect()}
    assert [(i, got[i], n) for i, (n, _) in enumerate(rows) if got[i] != n] == []


def named_texts():
    """Licence texts with holders' names, of the lesser known licences, and SPDX lines."""
    s = licenses.SENTENCES
    bsd = [s["bsd-grant"] + ":", "1. " + s["bsd-source"] + ".", "2. " + s["bsd-binary"] + "."]
    endorse = lambda name, more: s["bsd-endorse"].replace("<>", name, 1).replace("<>", more) + "."
    free = "This program is free software: "
    texts = [
        ("BSD-3-Clause", "\n".join([*bsd, "3. " + endorse("Google Inc.", "its contributors")])),
        ("BSD-3-Clause", "\n".join([*bsd, "* " + endorse("the University of California, Berkeley", "its contributors")])),
        ("BSD-3-Clause", "\n".join([*bsd, "3. " + s["bsd-endorse-2"].replace("<>", "the author") + "."])),
        ("BSD-2-Clause", "\n".join(bsd)),
        ("LGPL-2.1", s["lgpl21-free"] + "."), ("LGPL-3.0", free + s["lgpl3-free"] + "."), ("AGPL-3.0", free + s["agpl3-free"] + "."),
        ("EPL-2.0", s["epl2-notice"] + "/"), ("Zlib", f"{s['zlib-as-is']}. In no event.\n\n{s['zlib-grant']}:"), ("BSL-1.0", s["bsl-notice"] + ".\n(See accompanying file)"),
        ("Apache-2.0,MIT", "x\n// SPDX-License-Identifier: MIT OR Apache-2.0\ncode"), ("", "SPDX-License-Identifier: LicenseRef-Own"), ("", "Neither the name of it"),
    ]
    texts += [(license, f"#!/bin/sh\n# SPDX-License-Identifier: {name}\n\ncode") for name, license in licenses.SPDX.items()]
    return texts


def test_named_holders_and_spdx_lines(spark, tmp_path):
    import duckdb

    rows = []
    for name, text in named_texts():
        for width in (36, 78, 1000):
            for mark in ("", " * "):
                if "SPDX" not in text or width == 1000:
                    rows.append((name, "\n".join(mark + x for line in text.split("\n") for x in textwrap.wrap(line, width, break_long_words=False) or [""])))
    frame = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(rows)], "doc_id long, text string")
    got = {r.doc_id: (r.n_sentences, r.licenses) for r in licenses.find_licenses(frame).collect()}
    assert [(i, got[i], n) for i, (n, _) in enumerate(rows) if got[i][1] != n] == []
    # The SQL counterpart describes the same, wrapped lines and names included.
    connection = duckdb.connect()
    connection.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    connection.executemany("INSERT INTO documents VALUES (?, ?)", [(i, t) for i, (_, t) in enumerate(rows)])
    assert {i: (n, names) for i, n, names in connection.execute(queries.ORACLES["op1_license_scan"]).fetchall()} == got


def test_mixing_meets_targets(spark, docs, none):
    got = mixing.mix_documents(docs).collect()
    assert bag((r.doc_id, r.size) for r in got) == bag((i, len(re.findall(WORD, t or ""))) for i, t in TEXTS)
    per = collections.defaultdict(list)
    for r in got:
        per[r.source].append(r)
        assert 0 <= r.taken <= 3 * r.size
    for rows in per.values():
        assert sum(r.taken for r in rows) == int(rows[0].target + 0.5) and rows[0].target <= 3 * rows[0].source_size
        assert sum(r.size for r in rows) == rows[0].source_size
    assert abs(sum(rows[0].target for rows in per.values()) - sum(r.size for r in got)) < 1e-6
    assert bag(mixing.mix_documents(docs).collect()) == bag(got)
    assert mixing.mix_documents(none).collect() == []
    mixed = mixing.mixed_rows(docs)
    assert bag(mixed.collect()) == bag(mixing.mixed_rows(docs.repartition(3, "n_chars")).collect())
    assert mixed.columns == docs.columns and mixing.mixed_rows(none).collect() == []


def test_targets_share_the_excess(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 1000), ("c", 500), ("d", 1)], "source string, source_size long")
    got = {r.source: r.target for r in mixing.source_targets(sizes).collect()}
    assert got["a"] == 30 and got["d"] == 3 and abs(sum(got.values()) - 1511) < 1e-9 and abs(got["b"] / got["c"] - 2) < 1e-9


def test_url_rules(spark):
    urls = [None, "", "nohost", "http://", "http://www.example.com", "HTTP://WWW.Example.com/en/x?y#z", "x://a.example.com/en/1", "http://net/es/", "http://a.net/fr", "http://xexample.com/en/", "http://a.b.net/fr/x", "q://com/", "q://example.com/en/sub/deep"]
    pages = spark.createDataFrame([(n, u, "h") for n, u in enumerate(urls)] + [(5, urls[5], "h")], "page_id long, url string, host string")
    listed = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("example.com", "/en/sub/", "allow"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block"), ("net", "/fr/", "block"), (None, "/", "block")]
    ruled = spark.createDataFrame(listed, "host string, path string, verdict string")
    want = []
    for n, u in [*enumerate(urls), (5, urls[5])]:
        rest = u.split("://", 1)[1] if u and "://" in u else ""
        host = re.split("[/?#]", rest)[0]
        path = re.split("[?#]", rest[len(host) :])[0]
        host = host.lower()
        fits = [(len(h + p), len(h), h + p, v) for h, p, v in listed if h and ("." + host).endswith("." + h) and path.startswith(p)]
        best = max(fits, default=(0, 0, None, "allow"))
        want.append((n, host, path, best[2], best[3]))
    assert bag(url_rules.judge_urls(pages, ruled).collect()) == bag(want)
    assert url_rules.judge_urls(pages.limit(0), ruled).collect() == [] and url_rules.judge_urls(pages, ruled.limit(0)).count() == len(want)


def test_url_with_a_second_scheme(spark):
    urls = ["http://example.com?u=http://x.org/en/1", "http://example.com#http://x.org/en/1", "http://example.com/en/?u=http://x.org/fr/1", "http://?http://example.com/en/1"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    ruled = spark.createDataFrame([("com", "/", "allow"), ("example.com", "/en/", "block")], "host string, path string, verdict string")
    got = bag(url_rules.judge_urls(pages, ruled).collect())
    assert got == bag([(0, "example.com", "", None, "allow"), (1, "example.com", "", None, "allow"), (2, "example.com", "/en/", "example.com/en/", "block"), (3, "", "", None, "allow")])


def test_urls_of_control_characters(spark):
    urls = ["http://net\x01x/es/1", "http://com\x01evil/a", "http://x.com\x00/a", "http://a\x00.net/es/", "http://\x01.net/es/", "http://net/es/\x00", "http://x\x01\x02.com/", "http://net\x00/es/1", "http://a.net\n/es/"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    listed = [("com", "/", "allow"), ("net", "/es/", "block"), ("a\x00", "/x", "block"), ("a", "\x00/x", "block"), ("x\x01\x02.com", "/", "block")]
    ruled = spark.createDataFrame(listed, "host string, path string, verdict string")
    want = []
    for n, u in enumerate(urls):
        host, path = re.fullmatch(r"(?s)http://([^/]*)(/.*)", u).groups()
        fits = [(len(h + p), len(h), h + p, v) for h, p, v in listed if ("." + host).endswith("." + h) and path.startswith(p)]
        best = max(fits, default=(0, 0, None, "allow"))
        want.append((n, host, path, best[2], best[3]))
    assert bag(url_rules.judge_urls(pages, ruled).collect()) == bag(want)


def test_quality_rules(docs, none):
    def slow(text):
        words, lines = re.findall(WORD, text), [x for x in text.split("\n") if re.search(WORD, x)]
        windows = collections.Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
        inside = {k for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for k in range(i, i + 5)}
        return len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(inside)

    got = rules.judge(docs).collect()
    assert bag((r.doc_id, *r[1:6]) for r in got) == bag((i, *slow(t or "")) for i, t in TEXTS)
    assert all(not r.kept for r in got if r.base_failed) and rules.judge(none).collect() == []
    patterns = np.array([[-1, 0, 0], [0, 0, 1], [0, -1, 0], [0, 0, 0]])
    assert (rules.posterior(patterns, 0.5, rules.fit_votes(patterns, np.array([30.0, 900, 30, 5]))) >= 0.5).tolist() == [False, True, False, True]


def test_counts_of_repeats():
    assert counts("a b c d e f a b c d e g")[4] == 10 and counts("")[0] == 0 and counts("x " * 20)[4] == 20


def test_site_quality(spark, docs, labels, none):
    got = site_quality.classify(docs, labels, F.col("source"), F.col("lang")).collect()
    assert bag([r.doc_id] for r in got) == bag([i] for i, _ in TEXTS)
    assert all((r.quality == 0 and not r.kept) for r in got if r.doc_id in (1, 2, 3))
    assert site_quality.classify(none, labels, F.col("source"), F.col("lang")).collect() == []
    assert site_quality.classify(docs, labels.limit(0), F.col("source"), F.col("lang")).where("kept").count() == len(TEXTS) - 3
    kept = site_quality.keep_good(docs, labels, F.col("source"), F.col("lang"))
    assert kept.columns == docs.columns and kept.count() == sum(r.kept for r in got)


def test_classifier_on_held_out_labels(spark):
    folder = "/root/testdata/sf0.01"
    given = spark.read.parquet(f"{folder}/labels.parquet")
    judged = site_quality.classify(spark.read.parquet(f"{folder}/documents.parquet"), given.where("doc_id % 2 = 0"), F.col("source"), F.col("lang"))
    right = judged.select("doc_id", "kept").join(given.where("doc_id % 2 = 1"), "doc_id").agg(F.avg((F.col("kept") == (F.col("quality") == 1)).cast("int"))).first()[0]
    assert right > 0.97


def shingles(text, size):
    words = (text or "").encode().lower().split()
    return frozenset(tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))) if words else frozenset()


def grouped(ids, linked):
    least = dict(zip(range(len(ids)), range(len(ids))))
    def find(x):
        while least[x] != x:
            x = least[x]
        return x
    for a, b in linked:
        a, b = find(a), find(b)
        least[max(a, b)] = min(a, b)
    groups = collections.defaultdict(list)
    for i in range(len(ids)):
        groups[find(i)].append(ids[i])
    return [min((x for x in groups[find(i)] if x is not None), default=None) for i in range(len(ids))]


@pytest.mark.parametrize("size,percent", [(3, 90), (5, 80)])
def test_ngram_join_equals_brute_force(spark, docs, none, size, percent):
    random = np.random.default_rng(3)
    vocabulary = [f"v{i}" for i in range(40)]
    rows = [(i, t) for i, t in TEXTS]
    for g in range(12):
        base = random.choice(vocabulary, int(random.integers(2, 90))).tolist()
        for _ in range(12):
            copy = list(base)
            for _ in range(int(random.integers(0, 4))):
                copy[int(random.integers(len(copy)))] = str(random.choice(vocabulary))
            rows.append((len(rows) + 100, " ".join(copy)))
    sets = [shingles(t, size) for _, t in rows]
    linked = [(a, b) for a in range(len(rows)) for b in range(a) if sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    degree = collections.Counter(x for pair in linked for x in pair)
    component = grouped([i for i, _ in rows], linked)
    want = bag((i, len(sets[n]), component[n], degree[n]) for n, (i, _) in enumerate(rows))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    for most in (512, 5):  # one piece a group, and pairs of blocks
        got = ngram_join.link_documents(frame, size=size, percent=percent, block_rows=most)
        assert bag(got.select("doc_id", "n_shingles", "component_id", "n_links").collect()) == want
    assert ngram_join.link_documents(none).collect() == []
    kept = ngram_join.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert bag([r.doc_id] for r in kept.collect()) == bag([i] for i in [1, 2, 3, 4, 8, 9, 10, 11, None, 12, 13])


def test_the_row_that_stays_does_not_depend_on_partitions(spark):
    rows = [(1, BASE, s, n) for n, s in enumerate(["z", "y", "x", None, "w", "x"])] + [(2, BASE + " more", "a", 0), (None, "", "s", 1), (None, "", "r", 2)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string, `a.b` long")
    kept = [bag(ngram_join.drop_near_duplicates(f).collect()) for f in (frame.repartition(1), frame.repartition(7), frame.repartition(3, "source"), frame.repartitionByRange(5, F.desc("`a.b`")))]
    assert all(k == kept[0] for k in kept) and sorted(map(str, kept[0])) == sorted(map(str, [(1, BASE, "w", 4), (None, "", "s", 1), (None, "", "r", 2)]))


def test_compilations_travel_few_times(spark, monkeypatch):
    """Two near-equal texts made of 3,000 short ones that are there too: few copies of the long ones."""
    random = np.random.default_rng(9)
    short = [" ".join(f"w{x}" for x in random.integers(0, 50_000, 12)) for _ in range(3000)]
    long = "\n".join(short)
    rows = list(enumerate([*short, long, long.replace(short[7], "nothing of the kind here"), long[:2000]]))
    sizes, real = [], ngram_join.in_blocks

    def recorded(members, *rest):
        sizes.append(members.agg(F.sum(F.octet_length("text")), F.count("*"), F.max(F.size("hubs"))).first())
        return real(members, *rest)

    monkeypatch.setattr(ngram_join, "in_blocks", recorded)
    got = {r.doc_id: r for r in ngram_join.link_documents(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()}
    assert (got[3000].component_id, got[3000].n_links, got[3001].component_id) == (3000, 1, 3000)
    assert all(got[i].component_id == i and got[i].n_links == 0 for i in [*range(3000), 3002])
    assert sizes[0][0] < 3 * len(long) and sizes[0][2] <= 4


def test_first_shared_against_sets():
    random = np.random.default_rng(10)
    groups = [np.unique(random.integers(-60, 60, int(random.integers(1, 40)))) for _ in range(120)]
    a, b = np.triu_indices(len(groups), 1)
    for this in (-20, 0, 35):
        want = [not any(h < this for h in set(groups[i]) & set(groups[j])) for i, j in zip(a, b)]
        assert links.first_shared(groups, a, b, this).tolist() == want


def test_personal_data_in_linear_time():
    def seconds(n):
        text = " ".join(f"{i % 97:02d} {i:05d} id={i:06d},b:{i:07d}" for i in range(n)) + "," .join(f"k={i:08d}" for i in range(n)) + " " + "9" * n
        start = time.process_time()
        spans = personal_data.base_spans(text)
        places = personal_data.lookalikes(text, spans)
        words = [m.span() for m in re.finditer(r"\S+", text)]
        for s, e in places + [(s, e) for _, s, e in spans]:
            personal_data.contexts(text, s, e, words)
        assert len(places) > n
        return time.process_time() - start

    seconds(500)
    assert seconds(20_000) < 15 * seconds(2_000)
    long = "a" * 500 + "1234"
    assert personal_data.lookalikes(f"key {long} end", []) == [(4, 508)]


def test_vectors_against_brute_force(spark):
    random = np.random.default_rng(4)
    centers = random.standard_normal((40, 16))
    rows = []
    for i in range(600):
        v = centers[i % 40] + random.standard_normal(16) * (0.12 if i % 3 else 2)
        rows.append((i, v.tolist(), "x"))
    rows += [(600, rows[0][1], "x"), (600, rows[0][1], "x"), (601, None, "x"), (602, [], "x"), (603, [0.0] * 16, "x"), (604, [float("nan")] * 16, "x"), (605, [None] * 16, "x"), (606, [1.0], "x"), (None, rows[1][1], "x")]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, unit string")
    unit = [np.array(v) / np.linalg.norm(v) if v and len(v) == 16 and None not in v and np.isfinite(v).all() and any(v) else None for _, v, _ in rows]
    linked = [(a, b) for a in range(len(rows)) for b in range(a) if unit[a] is not None and unit[b] is not None and unit[a] @ unit[b] >= 0.95]
    degree = collections.Counter(x for pair in linked for x in pair)
    component = grouped([i for i, _, _ in rows], linked)
    got = near_vectors.link_vectors(frame, leaf=64).collect()
    assert bag((r.vec_id, r.n_links, r.component_id) for r in got) == bag((i, degree[n], component[n]) for n, (i, _, _) in enumerate(rows))
    assert near_vectors.link_vectors(frame.limit(0)).collect() == []


def test_forest_recall(spark):
    frame = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    x = np.array([r[0] for r in frame.select("embedding").collect()], float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    links_there = int((x @ x.T >= 0.95).sum()) - len(x)
    found = near_vectors.link_vectors(frame, leaf=64).agg(F.sum("n_links")).first()[0]
    assert 0.9 * links_there <= found <= links_there


def test_recall_in_a_loose_cluster(spark, tmp_path):
    """A third of the rows around one centre, at cosines around 0.95; all parameters as in production."""
    random = np.random.default_rng(5)
    n, width = 30_000, 64
    x = random.standard_normal((n, width))
    center = random.standard_normal(width)
    x[: n // 3] = center / np.linalg.norm(center) + random.standard_normal((n // 3, width)) * np.sqrt((1 / 0.95 - 1) / width)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    x = x[random.permutation(n)]
    there = np.concatenate([(x[i : i + 1000] @ x.T >= 0.95).sum(axis=1) - 1 for i in range(0, n, 1000)])
    pd.DataFrame({"vec_id": range(n), "embedding": list(x)}).to_parquet(f"{tmp_path}/vectors.parquet")
    frame = spark.read.parquet(f"{tmp_path}/vectors.parquet")
    found = near_vectors.link_vectors(frame).select("vec_id", "n_links").toPandas().sort_values("vec_id")["n_links"].to_numpy()
    assert there.sum() > 10**7 and found.sum() >= 0.9 * there.sum()
    assert found.sum() <= there.sum() + 100  # no pair counts twice; some may round across the threshold


def test_vectors_of_several_lengths(spark, monkeypatch):
    random = np.random.default_rng(7)
    vectors = []
    for width, n in ((16, 330), (24, 270), (8, 40)):
        centers = random.standard_normal((20, width))
        vectors += [(centers[i % 20] + random.standard_normal(width) * 0.12).tolist() for i in range(n)]
    frame = spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<double>")
    unit = [np.array(v) / np.linalg.norm(v) for v in vectors]
    linked = [(a, b) for a in range(len(unit)) for b in range(a) if len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= 0.95]
    degree, component = collections.Counter(x for pair in linked for x in pair), grouped(list(range(len(unit))), linked)
    assert all(any(degree[i] for i in part) for part in (range(330), range(330, 600), range(600, 640)))
    want = bag((i, degree[i], component[i]) for i in range(len(unit)))
    for forests in (16, 1):  # a forest for each frequent length, and one with the others compared exactly
        monkeypatch.setattr(near_vectors, "FORESTS", forests)
        got = near_vectors.link_vectors(frame, leaf=64)
        assert bag(got.select("vec_id", "n_links", "component_id").collect()) == want


def test_pairs_met_before_equal_first_shared():
    random = np.random.default_rng(6)
    leaves = [np.unique(random.integers(0, 900, 30)) for _ in range(1500)]
    a, b = np.nonzero(np.ones((len(leaves) - 1024, len(leaves)), bool))
    want = ~links.first_shared(leaves, a[:200_000] + 1024, b[:200_000], 700)
    got = near_vectors._met_before(leaves, 1024, 700)[a[:200_000], b[:200_000]]
    assert (got == want).all() and 0 < got.sum() < len(got)


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(50)] + [(100, 100 + i) for i in range(1, 40)] + [(139, 200), (200, 139), (7, 7)]
    got = dict(map(tuple, links.components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert got == {**{i: 0 for i in range(1, 51)}, **{100 + i: 100 for i in range(1, 40)}, 200: 100}


def test_pipeline_keeps_columns_and_words(spark, docs, labels, tmp_path):
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    frame = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        frame = stage(spark, frame, str(tmp_path))
        assert frame.columns == docs.columns, name
    packed = corpus_pipeline.run(spark, str(tmp_path))
    assert packed.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"] and packed.count() > 0


def test_leaves_do_not_grow_with_the_table(spark, monkeypatch):
    """A forest fitted on few vectors: its large leaves are split again on their own rows."""
    random = np.random.default_rng(11)
    n, width = 4000, 24
    x = random.standard_normal((n, width))
    x[: n // 2] = x[random.integers(n // 2, n, n // 2)] + random.standard_normal((n // 2, width)) * 0.1
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    there = (x @ x.T >= 0.95).sum() - n
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    sizes, real = [], near_vectors.in_blocks

    def recorded(members, *rest):
        sizes.append(members.groupBy("leaf").count().agg(F.max("count"), F.sum("count")).first())
        return real(members, *rest)

    monkeypatch.setattr(near_vectors, "in_blocks", recorded)
    found = near_vectors.link_vectors(frame, leaf=32, sample=80).agg(F.sum("n_links")).first()[0]
    assert 0.9 * there <= found <= there
    assert sizes[0][0] <= near_vectors.LARGE * 32 and sizes[0][1] < 40 * n


def test_what_the_packing_encoder_remembers_is_bounded():
    """Within a worker's memory in the pipeline, whatever the number of different chunks."""
    import gc

    from newsflow.llm.common import Remembered

    encode = packing.encoder.__wrapped__(public_tokenizers.path("word_bpe_49k.json"))
    before = {id(o) for o in gc.get_objects() if isinstance(o, Remembered)}
    for i in range(0, 1_000_000, 1000):
        encode(" ".join(map(str, range(i, i + 1000))))
    held = [len(o) + len(o.older) for o in gc.get_objects() if isinstance(o, Remembered) and (id(o) in before or len(o) > 0)]
    assert max(held) <= 600_000
