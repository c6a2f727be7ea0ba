"""Licence scans: TF-IDF cosine of headers and licence files to templates, and inheritance from the nearest folder."""

from __future__ import annotations

import math
import re
from collections import Counter
from functools import cache, reduce
from itertools import groupby
from operator import and_, or_
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.llm.common import write_once
from lexmill.operators.scale import lookup_join

# The notices by which authors put a file under a licence.
NOTICES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "MIT": "Released under the MIT License.",
    "BSD-2-Clause": "Licensed under the BSD 2-Clause License.",
    "BSD-3-Clause": "Licensed under the BSD 3-Clause License.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "LGPL-3.0": "This library is licensed under the GNU Lesser General Public License, version 3.",
    "AGPL-3.0": "This work is licensed under the GNU Affero General Public License, version 3.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC0-1.0": "Released into the public domain under CC0 1.0.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
}
# The standard header of the GNU licences, with the kind of work, the licence and its version.
GNU_HEADER = (
    "This {work} is free software: you can redistribute it and/or modify it under the terms of the GNU {name} as published by the "
    "Free Software Foundation, either version {version} of the License, or (at your option) any later version."
)
GNU = [
    ("GPL-2.0", "program", "General Public License", "2"),
    ("GPL-3.0", "program", "General Public License", "3"),
    ("LGPL-2.1", "library", "Lesser General Public License", "2.1"),
    ("LGPL-3.0", "library", "Lesser General Public License", "3"),
    ("AGPL-3.0", "program", "Affero General Public License", "3"),
]
# Other standard headers, and paragraphs that only one licence has.
HEADERS = [
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at'),
    ("Apache-2.0", 'Licensed to the Apache Software Foundation (ASF) under one or more contributor license agreements. See the NOTICE file distributed with this work for additional information regarding copyright ownership. The ASF licenses this file to You under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at'),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Use of this source code is governed by an MIT-style license that can be found in the LICENSE file."),
    ("BSD-3-Clause", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
]
# How the files of long licences open.
OPENINGS = [
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/"),
    ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("LGPL-2.1", "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999"),
    ("LGPL-3.0", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("AGPL-3.0", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
    ("CC-BY-4.0", "Creative Commons Attribution 4.0 International Public License"),
    ("CC-BY-SA-4.0", "Creative Commons Attribution-ShareAlike 4.0 International Public License"),
    ("CC-BY-NC-4.0", "Creative Commons Attribution-NonCommercial 4.0 International Public License"),
    ("CC0-1.0", "CC0 1.0 Universal"),
]
# The bodies of short licences.
BSD_OPENING = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"
BSD_CLAUSES = """Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."""
BSD_NAMES = "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
BSD_DISCLAIMER = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.
IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
BODIES = [
    ("MIT", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    ("BSD-2-Clause", "\n".join([BSD_OPENING, BSD_CLAUSES, BSD_DISCLAIMER])),
    ("BSD-3-Clause", "\n".join([BSD_OPENING, BSD_CLAUSES, BSD_NAMES, BSD_DISCLAIMER])),
    ("ISC", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""),
    ("Unlicense", """This is free and unencumbered software released into the public domain.
Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.
In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
]
#: Words that any text may have, and words of texts about software. They only steer which terms a text is first searched for.
FUNCTION = (
    "a all an and any are as at be but by can do for from if in into is it its may must no not of on one only or our out see so such that the "
    "this to under was we with you your"
).split()
GENERIC = (
    "1 2 3 code conditions copies copy copyright data documentation file files form found free general in license list make means name notice other "
    "provided public released rights software source style terms use version way work"
).split()
FILE_NAMES = r"(?i)(^|/)(licen[cs]e|copying|copyright|unlicense)(\.(txt|md|rst))?$"
COSINE = 0.8
#: A file is also a licence file if a unit that matches a template makes up this part of its words.
MOSTLY = 0.5
TERM = r"[a-z0-9]+(?:\.[0-9]+)*"
NUMBER = r"^[0-9]+(?:\.[0-9]+)*$"
#: Between blocks are empty lines; between paragraphs also lines of nothing but marks of comments.
BLOCKS = r"\n(?:[ \t]*\n)+"
PARAGRAPHS = r"\n(?:[ \t]*[#/*;%!.-]*[ \t]*\n)+"


class Template(NamedTuple):
    licence: str
    #: Bodies are compared with whole texts too.
    body: bool
    text: str


def templates() -> list[Template]:
    """Notices, standard headers, SPDX lines, openings of licence files and bodies of short licences."""
    found = [Template(name, False, text) for name, text in NOTICES.items()]
    found += [Template(name, False, GNU_HEADER.format(work=work, name=long, version=version)) for name, work, long, version in GNU]
    found += [Template(name, False, text) for name, text in [*HEADERS, *OPENINGS]]
    gnu = {name for name, *_ in GNU}
    for name in sorted({t.licence for t in found} | {name for name, _ in BODIES}):
        ends = ("", "-only", "-or-later") if name in gnu else ("",)
        found += [Template(name, False, f"SPDX-License-Identifier: {name}{end}") for end in ends]
    return found + [Template(name, True, text) for name, text in BODIES]


@cache
def _weights() -> tuple[list[dict[str, float]], dict[str, float], float]:
    """Of each template its unit vector, of (1 + log tf) idf; the idf of each term; the idf of a term that no template has."""
    terms = [Counter(re.findall(TERM, t.text.lower())) for t in templates()]
    df = Counter(t for counts in terms for t in counts)
    idf = {t: math.log((1 + len(terms)) / (1 + n)) + 1 for t, n in df.items()}
    vectors = []
    for counts in terms:
        v = {t: (1 + math.log(n)) * idf[t] for t, n in counts.items()}
        size = math.sqrt(sum(x * x for x in v.values()))
        vectors.append({t: x / size for t, x in v.items()})
    return vectors, idf, math.log(1 + len(terms)) + 1


@cache
def key_terms(least: float = COSINE) -> tuple[str, ...]:
    """Terms of which a unit has at least one if its cosine to a template is ``least`` or more.

    What a template's other terms can give at most is their own length in its unit vector (Cauchy-Schwarz); terms are
    taken, those that serve most templates first and common words last, until that is below ``least`` for each: the test loses no unit.
    """
    vectors = _weights()[0]
    need, left = [1 - least * least + 1e-9] * len(vectors), set(_weights()[1])
    cost = {t: 1000 if t in FUNCTION else 8 if t in GENERIC else 1 for t in left}
    while any(n > 0 for n in need):
        gain = {t: sum(min(v.get(t, 0.0) ** 2, max(n, 0.0)) for v, n in zip(vectors, need)) / cost[t] for t in left}
        best = min(left, key=lambda t: (-gain[t], t))
        left.remove(best)
        need = [n - v.get(best, 0.0) ** 2 for v, n in zip(vectors, need)]
    return tuple(sorted(set(cost) - left))


def _terms(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(f"({TERM})"), F.lit(1))


def _adder(squares: Column):
    return lambda total, term: total + F.element_at(squares, term)


def _enough(terms: Column, least: float, bodies: bool) -> Column:
    """Whether a unit with these terms can reach ``least``: what it has of some template's unit vector is that long.

    A cosine is at most the length of the template's part in the unit's terms (Cauchy-Schwarz), so no unit is lost. A
    template's numbers must be there too, as :func:`matches` asks.
    """
    tests = []
    for template, vector in zip(templates(), _weights()[0]):
        if bodies and not template.body:
            continue
        squares = F.create_map(*[F.lit(v) for t, x in sorted(vector.items()) for v in (t, x * x)])
        found = F.array_intersect(terms, F.array(*map(F.lit, sorted(vector))))
        test = F.aggregate(found, F.lit(0.0), _adder(squares)) >= least * least - 1e-9
        numbers = sorted(t for t in vector if re.match(NUMBER, t))
        tests.append(reduce(and_, [*[F.array_contains(terms, n) for n in numbers], test]))
    return reduce(or_, tests)


def matches(files: DataFrame, path: str = "path", text: str = "text", least: float = COSINE) -> DataFrame:
    """(path, licence, cosine, share): the best template of each file of which a unit reaches ``least``.

    Units are the lines of the text, its paragraphs, its blocks (between empty lines, so that a comment is one) and, for bodies of licences, the whole text.
    A unit must have all numbers of the template, which tell versions apart. share is the part of the file's terms that are in the longest unit that matches. Ties go to the
    first line, paragraph or block, then to the licence first by name.
    """
    vectors, idf, other = _weights()
    vocabulary = F.array(*map(F.lit, sorted(idf)))
    starts = [(c, [re.escape(t[1:]) for t in terms]) for c, terms in groupby(key_terms(least), lambda t: t[0])]
    likely = r"(?i)\b(?:" + "|".join(f"{c}(?:{'|'.join(rests)})" for c, rests in starts) + r")\b"
    body = F.regexp_replace(F.col(text).cast("string"), "\r\n?", "\n")
    docs = files.select(F.col(path).alias("path"), body.alias("text")).where(F.col("text").rlike(likely))

    def possible(bodies: bool):
        # The one-element array binds the terms to a variable, so that they are found once.
        return lambda u: u.rlike(likely) & F.exists(F.array(F.array_intersect(_terms(u), vocabulary)), lambda terms: _enough(terms, least, bodies))

    parts = F.array_distinct(F.concat(*[F.split("text", by) for by in ("\n", PARAGRAPHS, BLOCKS)]))
    marked = lambda units, bodies: F.transform(F.filter(units, possible(bodies)), lambda u: F.struct(u.alias("unit"), F.lit(bodies).alias("whole")))
    units = F.concat(marked(parts, False), marked(F.array("text"), True))
    rows = docs.select("path", F.size(_terms(F.col("text"))).alias("size"), F.posexplode(units).alias("at", "u"))
    rows = rows.select("path", "size", "at", "u.whole", F.explode(_terms(F.col("u.unit"))).alias("term"))
    rows = rows.groupBy("path", "at", "whole", "term").agg(F.max("size").alias("size"), F.count(F.lit(1)).alias("tf"))
    spark = files.sparkSession
    idfs = F.broadcast(spark.createDataFrame([(t, x) for t, x in sorted(idf.items())], "term string, idf double"))
    weights = [(term, k, t.licence, t.body, x, int(bool(re.match(NUMBER, term)))) for k, (t, v) in enumerate(zip(templates(), vectors)) for term, x in sorted(v.items())]
    held = F.broadcast(spark.createDataFrame(weights, "term string, template int, licence string, body boolean, weight double, number int"))
    numbers = F.broadcast(held.groupBy("template").agg(F.sum("number").alias("numbers")))
    rows = rows.join(idfs, "term", "left").withColumn("x", (1 + F.log(F.col("tf"))) * F.coalesce("idf", F.lit(other)))
    rows = write_once(rows, "licence-terms")
    norms = rows.groupBy("path", "at").agg(F.sqrt(F.sum(F.col("x") * F.col("x"))).alias("norm"), F.sum("tf").alias("n"), F.max("size").alias("size"))
    dots = rows.join(held, "term").where(F.col("body") | ~F.col("whole"))
    dots = dots.groupBy("path", "at", "template", "licence").agg(F.sum(F.col("x") * F.col("weight")).alias("dot"), F.sum("number").alias("has"))
    dots = dots.join(numbers, "template").where(F.col("has") == F.col("numbers"))
    close = dots.join(norms, ["path", "at"]).withColumn("cosine", F.round(F.col("dot") / F.col("norm"), 6)).where(F.col("cosine") >= least)
    per = close.groupBy("path").agg(F.min(F.struct((-F.col("cosine")).alias("c"), "at", "licence")).alias("b"), F.max("n").alias("n"), F.max("size").alias("size"))
    # Rows that repeat a path share their units' numbers, so their terms may add up to more than one text has.
    return per.select("path", F.col("b.licence").alias("licence"), (-F.col("b.c")).alias("cosine"), F.round(F.least(F.lit(1.0), F.col("n") / F.col("size")), 6).alias("share"))


def _folders(path: Column) -> Column:
    """The folder of a path and those above it, up to the empty path."""
    parts = F.split(path, "/")
    return F.transform(F.sequence(F.lit(0), F.size(parts) - 1), lambda n: F.array_join(F.slice(parts, 1, n), "/"))


def scan(files: DataFrame, path: str = "path", text: str = "text", least: float = COSINE) -> DataFrame:
    """(path, licence, how, cosine, folder) for each row of ``files`` (path, text).

    A line, paragraph, block or whole text whose cosine to a template is ``least`` or more puts a file under that licence (how: header; file for a
    licence file). A file is a licence file by its name, or if such a unit is at least half of its words. A file without one of its own takes the
    licence of the licence file in its folder or the nearest above (how: inherited, with that folder); of several in one
    folder the one of highest cosine, then the first path. Others have nulls.

    Null and empty texts inherit. A null path has neither header nor folder. Rows that repeat a path are one file whose best line counts,
    each a row of the result. The folders of licence files are joined to the folders above each path, so no folder is gathered, however many files it has.
    """
    rows = files.select(F.col(path).cast("string").alias("path"), F.col(text).alias("text"))
    own = write_once(matches(rows.where(F.col("path").isNotNull()), "path", "text", least), "matches")
    file = F.col("path").rlike(FILE_NAMES) | (F.col("share") >= MOSTLY)
    rank = F.min(F.struct((-F.col("cosine")).alias("c"), "path", "licence"))
    folder = F.element_at(_folders(F.col("path")), -1)
    known = own.where(file).groupBy(folder.alias("folder")).agg(rank.alias("b")).select("folder", F.col("b.licence").alias("licence"))
    known = write_once(known, "licence-folders")
    paths = rows.select("path")
    lone = paths.where(F.col("path").isNotNull()).distinct().join(own.select("path"), "path", "left_anti")
    above = lone.select("path", F.posexplode(_folders(F.col("path"))).alias("depth", "folder"))
    taken = lookup_join(above, known, ["folder"]).groupBy("path").agg(F.max(F.struct("depth", "folder", "licence")).alias("b"))
    heirs = taken.select("path", "b.licence", F.lit("inherited").alias("how"), F.lit(None).cast("double").alias("cosine"), "b.folder")
    direct = own.select("path", "licence", F.when(file, "file").otherwise("header").alias("how"), "cosine", F.lit(None).cast("string").alias("folder"))
    found = write_once(direct.union(heirs), "licences")
    return paths.join(found, "path", "left").select("path", "licence", "how", "cosine", "folder")
