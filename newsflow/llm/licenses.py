"""Licence recognition: sentences become identifiers, sequences of identifiers match rules."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F

# Sentences of well-known licences and notices, by identifier. "<>" stands for a name, of one word or more.
SENTENCES = {
    "mit-notice": "Released under the MIT License",
    "mit-notice-2": "Licensed under the MIT License",
    "mit-title": "The MIT License (MIT)",
    "mit-title-2": "MIT License",
    "mit-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions",
    "mit-condition": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software",
    "mit-warranty": "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT",
    "apache-notice": "Licensed under the Apache License, Version 2.0",
    "apache-notice-long": "Licensed under the Apache License, Version 2.0 (the \"License\")",
    "apache-compliance": "you may not use this file except in compliance with the License",
    "apache-copy": "You may obtain a copy of the License at",
    "apache-title": "Apache License Version 2.0, January 2004",
    "gpl3-notice": "This work is licensed under the GNU General Public License, version 3",
    "gpl3-notice-2": "Licensed under the GNU General Public License, version 3",
    "gpl-free": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
    "gpl2-free": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version",
    "gpl-hope": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY",
    "gpl-fitness": "without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE",
    "bsd-grant": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "bsd-source": "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer",
    "bsd-binary": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution",
    "bsd-endorse": "Neither the name of <> nor the names of <> may be used to endorse or promote products derived from this software without specific prior written permission",
    "bsd-endorse-2": "The name of <> may not be used to endorse or promote products derived from this software without specific prior written permission",
    "bsd-notice": "Licensed under the BSD License",
    "isc-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies",
    "mpl2-notice": "This Source Code Form is subject to the terms of the Mozilla Public License, v.2.0",
    "unlicense": "This is free and unencumbered software released into the public domain",
    "lgpl21-free": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version",
    "lgpl3-free": "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
    "agpl3-free": "you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
    "epl2-notice": "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0",
    "epl2-title": "Eclipse Public License - v 2.0",
    "zlib-as-is": "This software is provided 'as-is', without any express or implied warranty",
    "zlib-grant": "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions",
    "bsl-notice": "Distributed under the Boost Software License, Version 1.0",
    "bsl-title": "Boost Software License - Version 1.0 - August 17th, 2003",
    "cc-by-nc-4": "Licensed under CC BY-NC 4.0",
    "cc-by-4": "Licensed under CC BY 4.0",
    "cc-by-sa-4": "Licensed under CC BY-SA 4.0",
    "cc0": "Licensed under CC0 1.0",
}

# Licences as sequences of sentences that stand in this order, others in between allowed.
RULES = (
    ("MIT", ("mit-grant", "mit-condition", "mit-warranty")),
    ("MIT", ("mit-title",)),
    ("MIT", ("mit-title-2", "mit-grant")),
    ("MIT", ("mit-notice",)),
    ("MIT", ("mit-notice-2",)),
    ("Apache-2.0", ("apache-notice",)),
    ("Apache-2.0", ("apache-notice-long", "apache-compliance", "apache-copy")),
    ("Apache-2.0", ("apache-title",)),
    ("GPL-3.0", ("gpl3-notice",)),
    ("GPL-3.0", ("gpl3-notice-2",)),
    ("GPL-3.0", ("gpl-free", "gpl-hope", "gpl-fitness")),
    ("GPL-2.0", ("gpl2-free", "gpl-hope", "gpl-fitness")),
    ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse")),
    ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse-2")),
    ("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary")),
    ("BSD", ("bsd-notice",)),
    ("ISC", ("isc-grant",)),
    ("MPL-2.0", ("mpl2-notice",)),
    ("LGPL-2.1", ("lgpl21-free",)),
    ("LGPL-3.0", ("lgpl3-free",)),
    ("AGPL-3.0", ("agpl3-free",)),
    ("EPL-2.0", ("epl2-notice",)),
    ("EPL-2.0", ("epl2-title",)),
    ("Zlib", ("zlib-as-is", "zlib-grant")),
    ("BSL-1.0", ("bsl-notice",)),
    ("BSL-1.0", ("bsl-title",)),
    ("Unlicense", ("unlicense",)),
    ("CC-BY-NC-4.0", ("cc-by-nc-4",)),
    ("CC-BY-4.0", ("cc-by-4",)),
    ("CC-BY-SA-4.0", ("cc-by-sa-4",)),
    ("CC0-1.0", ("cc0",)),
)

# Identifiers in "SPDX-License-Identifier" lines, and the licences they name.
SPDX = {
    "MIT": "MIT", "Apache-2.0": "Apache-2.0", "GPL-2.0-only": "GPL-2.0", "GPL-2.0-or-later": "GPL-2.0", "GPL-2.0": "GPL-2.0", "GPL-2.0+": "GPL-2.0",
    "GPL-3.0-only": "GPL-3.0", "GPL-3.0-or-later": "GPL-3.0", "GPL-3.0": "GPL-3.0", "LGPL-2.1-only": "LGPL-2.1", "LGPL-2.1-or-later": "LGPL-2.1",
    "LGPL-2.1": "LGPL-2.1", "LGPL-3.0-only": "LGPL-3.0", "LGPL-3.0-or-later": "LGPL-3.0", "AGPL-3.0-only": "AGPL-3.0", "AGPL-3.0-or-later": "AGPL-3.0",
    "BSD-2-Clause": "BSD-2-Clause", "BSD-3-Clause": "BSD-3-Clause", "ISC": "ISC", "MPL-2.0": "MPL-2.0", "EPL-2.0": "EPL-2.0", "Zlib": "Zlib",
    "BSL-1.0": "BSL-1.0", "Unlicense": "Unlicense", "CC0-1.0": "CC0-1.0", "CC-BY-4.0": "CC-BY-4.0", "CC-BY-SA-4.0": "CC-BY-SA-4.0",
}
_MARK = "SPDX-License-Identifier"
SENTENCES |= {f"spdx/{name}": f"{_MARK}: {name}" for name in SPDX}
RULES += tuple((license, (f"spdx/{name}",)) for name, license in SPDX.items())
# Two licences to choose from, in either order.
_PAIRS = [(a, b) for a in ("MIT", "Apache-2.0", "GPL-2.0-or-later", "GPL-3.0-or-later", "BSD-3-Clause") for b in ("MIT", "Apache-2.0", "BSD-3-Clause") if a != b]
SENTENCES |= {f"spdx/{x}/{y}": f"{_MARK}: {x} OR {y}" for a, b in _PAIRS for x, y in ((a, b), (b, a))}
RULES += tuple((SPDX[one], (f"spdx/{x}/{y}",)) for a, b in _PAIRS for x, y in ((a, b), (b, a)) for one in (x, y))

NAME = "<>"
#: Words a name in the place of NAME may have, in count of lines it may be wrapped over.
_NAME_WORDS = 40

# Ends of holders' names that a full stop belongs to.
FIRMS = ("Inc", "Ltd", "Corp", "Co")
# A sentence ends at . ; : ! ? before white space or the end, but not inside "v. 2" or behind the SPDX mark or "Inc", and at a line without letters and digits.
_FIRM = "|".join(rf"(?<=\b{f})" for f in FIRMS)
_CLOSES = rf"(?!(?<=\b[vV])\.\s[^A-Za-z0-9]{{0,9}}[0-9]|(?:{_FIRM})\.|(?<=SPDX-License-Identifier):)[.;:!?]+(?=\s|$)"
_ENDS = _CLOSES + r"|\n[^\p{L}\p{N}\n]*(?=\n)"


def sentences_of(text: Column) -> Column:
    """The parts of a text between closing marks and blank lines (or bare comment marks)."""
    return F.split(text, _ENDS)


def normalised(sentence: Column) -> Column:
    """Lower case; line feeds stay; all else but letters a-z and digits is one space; none at the ends of lines."""
    plain = F.regexp_replace(F.lower(sentence), r"[^a-z0-9\n]+", " ")
    return F.btrim(F.regexp_replace(plain, r" ?\n[ \n]*", "\n"), F.lit(" \n"))


def _known(sentences: dict[str, str]) -> tuple[dict[str, str], dict[str, list[str]]]:
    """Identifiers by normalised sentence; and by given identifier those of the sentences it is split into."""
    known: dict[str, str] = {}
    parts: dict[str, list[str]] = {}
    for name, sentence in sentences.items():
        marked = sentence.replace(NAME, "xnamex")
        plain = [re.sub(r"[^a-z0-9]+", " ", x.lower()).strip().replace("xnamex", NAME) for x in re.split(_CLOSES, marked)]
        plain = [x for x in plain if x]
        parts[name] = [known.setdefault(x, name if len(plain) == 1 else f"{name}/{i}") for i, x in enumerate(plain, 1)]
    return known, parts


def _begins(known: dict[str, str]) -> str:
    """Pattern for the begin of a line that may begin a known sentence: up to three of its words, fewer if the line ends."""
    starts = set()
    for sentence in known:
        pattern = ""
        for w in reversed(sentence.split(" ")[: min(3, (sentence + " " + NAME).split(" ").index(NAME))]):
            pattern = rf"{w}(?:\n|$| {pattern})"
        starts.add(pattern)
    return "(?:" + "|".join(sorted(starts)) + ")"


def _named(known: dict[str, str]) -> dict[str, str]:
    """Known sentences with a place for a name, and the patterns of what they stand for."""
    return {s: "^" + s.replace(NAME, "[a-z0-9][a-z0-9 ]*") + "$" for s in known if NAME in s}


def find_licenses(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    sentences: dict[str, str] | None = None,
    rules: tuple[tuple[str, tuple[str, ...]], ...] | None = None,
) -> DataFrame:
    """Licences of every document: id, n_sentences (known ones), licenses (sorted, comma-joined).

    A rule matches if its sentences stand in the document in this order, with
    or without others between them. Sentences may be wrapped: any run of lines
    of a paragraph can be one, comment marks do not count. "<>" in a known
    sentence stands for any words, as a holder's name. Known sentences are
    split as texts are, and n_sentences counts these parts. Where a matching rule's sentences are a
    part of another matching rule's, in order, only the longer one counts.
    Documents without text or licence have 0 and ''. Repeated rows and null
    ids give a row each; an empty table gives none; other columns are not read.

    Known sentences and rules are parameters held by the driver, so the
    broadcasts are bounded by them. Only documents with a known sentence are
    shuffled with anything but their id and a hash.
    """
    spark = docs.sparkSession
    sentences = SENTENCES if sentences is None else sentences
    rules = RULES if rules is None else rules
    by_sentence, by_name = _known(sentences)
    rules = tuple((name, tuple(x for s in seq for x in by_name[s])) for name, seq in rules)
    known = F.broadcast(spark.createDataFrame(list(by_sentence.items()), "sentence string, sentence_id string"))
    begins = _begins(by_sentence)
    text = F.coalesce(F.col(text_col), F.lit(""))
    keyed = docs.select(F.col(id_col).alias("id"), text.alias("text"), F.xxhash64(text, F.length(text)).alias("_hash"))
    parts = keyed.select("id", "_hash", F.posexplode(sentences_of(F.col("text"))).alias("pos", "part"))
    # Only lines that begin like a known sentence go on; every run of lines from there on may be one.
    lines = (
        parts.select("id", "_hash", "pos", normalised(F.col("part")).alias("part"))
        .where(F.col("part").rlike(rf"(?:^|\n){begins}"))
        .select("id", "_hash", "pos", F.split("part", "\n").alias("lines"))
        .select("id", "_hash", "pos", "lines", F.posexplode("lines").alias("line", "begin"))
        .where(F.col("begin").rlike(f"^{begins}"))
    )
    most = max((s.count(" ") + 1 + _NAME_WORDS * s.count(NAME) for s in by_sentence), default=1)  # lines have a word at least
    sentence = F.col("sentence")
    for whole, pattern in _named(by_sentence).items():
        sentence = F.when(F.col("sentence").rlike(pattern), whole).otherwise(sentence)
    runs = F.sequence(F.lit(1), F.least(F.lit(most), F.size("lines") - F.col("line")))
    hits = (
        lines.select("id", "_hash", "pos", "line", "lines", F.explode(runs).alias("n"))
        .select("id", "_hash", "pos", "line", "n", F.array_join(F.slice("lines", F.col("line") + 1, F.col("n")), " ").alias("sentence"))
        .withColumn("sentence", sentence)
        .join(known, "sentence")
        # Rows that repeat a document give the same places again.
        .groupBy("id", "_hash")
        .agg(F.sort_array(F.collect_set(F.struct("pos", "line", "n", "sentence_id"))).alias("found"))
    )
    listed = spark.createDataFrame([(name, list(seq), seq[0]) for name, seq in rules], "license string, needed array<string>, first string")
    matched = (
        hits.select("id", "_hash", "found", F.explode(F.array_distinct(F.transform("found", lambda f: f["sentence_id"]))).alias("first"))
        .join(F.broadcast(listed), "first")
        .where(_in_order(F.transform("found", lambda f: f["sentence_id"]), F.col("needed")))
        .groupBy("id", "_hash")
        .agg(F.collect_set(F.struct("license", "needed")).alias("rules"), F.first(F.size("found")).alias("n"))
    )
    kept = F.filter("rules", lambda r: ~F.exists("rules", lambda o: (F.size(o["needed"]) > F.size(r["needed"])) & _in_order(o["needed"], r["needed"])))
    names = matched.select("id", "_hash", F.array_join(F.array_sort(F.array_distinct(F.transform(kept, lambda r: r["license"]))), ",").alias("licenses"))
    found = hits.select("id", "_hash", F.size("found").cast("long").alias("n_sentences")).join(names.withColumnRenamed("id", "_i").withColumnRenamed("_hash", "_h"), F.col("id").eqNullSafe(F.col("_i")) & (F.col("_hash") == F.col("_h")), "left")
    found = found.select(F.col("id").alias("_id"), F.col("_hash").alias("_same"), "n_sentences", "licenses")
    return keyed.select("id", "_hash").join(found, F.col("id").eqNullSafe(F.col("_id")) & (F.col("_hash") == F.col("_same")), "left").select(
        F.col("id").alias(id_col),
        F.coalesce("n_sentences", F.lit(0)).alias("n_sentences"),
        F.coalesce("licenses", F.lit("")).alias("licenses"),
    )


def _in_order(sequence: Column, needed: Column) -> Column:
    """Whether ``needed`` is a subsequence of ``sequence``: walk it with the number of needed ones found so far."""
    found = F.aggregate(sequence, F.lit(0), lambda n, s: n + F.when(F.try_element_at(needed, n + 1) == s, 1).otherwise(0))
    return found == F.size(needed)
