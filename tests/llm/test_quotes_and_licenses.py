from pyspark.sql import functions as F

from lexmill.llm import licenses, quotes

CHAT = "conv_id bigint, turn bigint, role string, text string, position string, thread int, hash string, message int"


def _chat(spark, rows):
    return spark.createDataFrame([(c, t, r, x, "p", 1, "h", 2) for c, t, r, x in rows], CHAT)


def _by(df):
    return {(r.conv_id, r.turn): r for r in df.collect()}


def test_nested_quotes_lead_to_their_messages(spark):
    rows = [
        (1, 0, "user", "First question.\nSecond  LINE here"),
        (1, 1, "assistant", "An answer to it"),
        (1, 2, "user", "Something else"),
        (1, 3, "user", "> an ANSWER to it\n>> First question.\n>> Second line here\nI see"),
        (1, 4, "assistant", ">>> nobody said this\n > Something   else\nYes\n\n> second line here"),
        (1, 5, "user", "> I see\r\n> later words\r\nQuite"),
        (1, 6, "user", "> I see\nreply"),
        (1, 7, "user", "no quote, a > b\n-> c"),
        (2, 0, "user", "> An answer to it\nother conversation"),
    ]
    found = _by(quotes.link_quotes(_chat(spark, rows)))
    assert [(found[1, t].reply_to, found[1, t].thread, found[1, t].depth) for t in range(8)] == [(None, 0, 0), (None, 1, 0), (None, 2, 0), (1, 1, 1), (2, 2, 1), (None, 5, 0), (3, 1, 2), (None, 7, 0)]
    assert [(found[1, t].n_quotes, found[1, t].n_linked) for t in (3, 4, 5, 6)] == [(2, 2), (3, 2), (1, 0), (1, 1)]
    assert [found[1, t].content for t in (3, 4, 5, 7)] == ["I see", "Yes", "Quite", "no quote, a > b\n-> c"]
    order = sorted((r.position, r.turn) for (c, _), r in found.items() if c == 1)
    assert order == list(enumerate([0, 1, 3, 6, 2, 4, 5, 7]))
    assert (found[2, 0].reply_to, found[2, 0].content) == (None, "other conversation")


def test_a_long_chain_of_replies(spark):
    rows = [(1, 0, "user", "m0")] + [(1, t, "user", f"> m{t - 1}\nm{t}") for t in range(1, 20)]
    found = _by(quotes.link_quotes(_chat(spark, rows)))
    assert [(r.thread, r.depth, r.position) for (_, t), r in sorted(found.items())] == [(0, t, t) for t in range(20)]


def test_odd_messages(spark):
    rows = [(None, 0, "user", "a"), (None, None, "user", "> a"), (3, 0, None, None), (3, 1, "user", ""), (3, 1, "user", ""), (3, 2, "user", ">"), (3, 3, "user", "> x\n" * 2000 + "y " * 50_000), (3, 2, "assistant", "> a")]
    found = quotes.link_quotes(_chat(spark, rows)).collect()
    assert len(found) == len(rows)
    assert sorted(r.position for r in found if r.conv_id == 3) == list(range(6))
    assert {r.content for r in found if r.conv_id == 3 and r.turn == 2} == {""}
    assert quotes.link_quotes(_chat(spark, [])).collect() == []


def test_parts_of_messages_are_quotes_too(spark):
    rows = [
        (1, 0, "user", "A first paragraph\n\nthe second one\nover two lines\n\nand a third"),
        (1, 1, "assistant", "one line\nanother line\nmore of it\nthe last of them"),
        (1, 2, "user", "the second one\nis not the same"),
        (1, 3, "user", "> a first paragraph\n>\n> the second one over\n> two lines\nyes"),
        (1, 4, "user", "> another line\n> more of it\nindeed"),
        (1, 5, "user", "> one line\n> another line\n> more of\nwell"),
        (1, 6, "user", "> the second one\n> is something else altogether\nno"),
    ]
    found = _by(quotes.link_quotes(_chat(spark, rows)))
    assert [(found[1, t].n_linked, found[1, t].reply_to) for t in range(3, 7)] == [(1, 0), (1, 1), (1, 1), (0, None)]


def test_passages_that_break_off_inside_a_line(spark):
    rows = [
        (1, 0, "user", "I think that the main point of this plan is its cost, and nobody has said\nanything about it so far"),
        (1, 1, "assistant", "Quite another matter is the main point of this plan and who said so"),
        (1, 2, "user", "> I think that the main point of this plan\nyes"),
        (1, 3, "user", "> the main point of this pl...\nyes"),
        (1, 4, "user", "> main point of this plan and [...]\nyes"),
        (1, 5, "user", "> its cost, and nobody has said anything about\nyes"),
        (1, 6, "user", "> hink that the main point of\nno"),
        (1, 7, "user", "> the main point\ntoo short"),
        (1, 8, "user", "> words that come later on\nno"),
        (1, 9, "user", "some words that come later on, in a line"),
        (2, 1, "user", "> I think that the main point of this plan\nother conversation"),
    ]
    found = _by(quotes.link_quotes(_chat(spark, rows)))
    assert [(found[1, t].n_linked, found[1, t].reply_to) for t in range(2, 9)] == [(1, 0), (1, 0), (1, 1), (1, 0), (0, None), (0, None), (0, None)]
    assert found[2, 1].n_linked == 0


def test_quotes_equal_the_sql(spark):
    import random

    import duckdb

    from lexmill.llm.oracle import SQL

    dice, rows = random.Random(5), []
    for conv in (*range(6), None):
        told = []
        for turn in range(25):
            text = "\n".join(" ".join(dice.choices("red blue the a green", k=dice.randint(0, 7))) for _ in range(dice.randint(1, 5)))
            if told and dice.random() < 0.7:
                lines = dice.choice(told).split("\n")
                part = lines[dice.randrange(len(lines)) :][: dice.randint(1, 4)]
                part[-1] = part[-1][: dice.choice([5, 12, 99])] + dice.choice(["", "", " ...", "…"])
                text = "\n".join("> " * dice.randint(1, 2) + line for line in part) + "\n" + text
            told.append(text)
            rows.append((conv, turn, "user", text))
    db = duckdb.connect()
    chat = _chat(spark, rows)
    db.register("conversations", chat.select("conv_id", "turn", "role", "text").toArrow())
    expected = sorted(map(repr, db.sql(SQL["op6_quotes"]).fetchall()))
    assert sorted(repr(tuple(r)) for r in quotes.link_quotes(chat).collect()) == expected


FILES = "path string, text string, licence string, term string, folder int"


def _files(spark, rows):
    return spark.createDataFrame([(p, t, "l", "t", 1) for p, t in rows], FILES)


def test_headers_files_and_folders(spark):
    rows = [
        ("a/LICENSE", "Released under the MIT License.\n" + "free words " * 40),
        ("a/x.py", "code only"),
        ("a/b/c/y.py", "more code"),
        ("a/b/COPYING.txt", "licensed under the GNU general public license, version 3\n" + "terms " * 90),
        ("a/b/z.py", "# Licensed under the Apache License, Version 2.0\nimport os, sys, re, json, math, time, uuid"),
        ("n/only.txt", "Licensed under CC BY-NC 4.0.\nshort"),
        ("n/other.txt", "text"),
        ("q/none.txt", "this is in the general form of code that is free"),
        ("top.txt", "nothing"),
    ]
    found = {r.path: (r.licence, r.how, r.folder) for r in licenses.scan(_files(spark, rows)).collect()}
    assert found == {
        "a/LICENSE": ("MIT", "file", None),
        "a/x.py": ("MIT", "inherited", "a"),
        "a/b/c/y.py": ("GPL-3.0", "inherited", "a/b"),
        "a/b/COPYING.txt": ("GPL-3.0", "file", None),
        "a/b/z.py": ("Apache-2.0", "header", None),
        "n/only.txt": ("CC-BY-NC-4.0", "file", None),
        "n/other.txt": ("CC-BY-NC-4.0", "inherited", "n"),
        "q/none.txt": (None, None, None),
        "top.txt": (None, None, None),
    }


def test_the_test_by_key_terms_loses_nothing(spark, monkeypatch):
    own = [t.text for t in licenses.templates()]
    more = ["Released under MIT", "work licensed under public version", "subject to the terms of the Mozilla Public License", "CC BY 4.0", "the under license", "General Public License version 2"]
    more += [" ".join(t.split()[::2]) for t in own] + [" ".join(t.split()[: -(len(t.split()) // 4)]) + " and other words" for t in own]
    texts = [(f"f{i}", t) for i, t in enumerate([*own, *more])]
    found = {tuple(r) for r in licenses.matches(_files(spark, texts)).collect()}
    monkeypatch.setattr(licenses, "key_terms", lambda least: tuple(sorted(licenses._weights()[1])))
    monkeypatch.setattr(licenses, "_enough", lambda terms, least, bodies: F.lit(True))
    assert {tuple(r) for r in licenses.matches(_files(spark, texts)).collect()} == found
    names = {r[0]: r[1] for r in found}
    assert [names[f"f{i}"] for i in range(len(own))] == [t.licence for t in licenses.templates()]
    assert len(found) > len(own) + 20


def _comment(text, mark="#", blank="#", width=70):
    import textwrap

    return "\n".join(blank if not p else "\n".join(f"{mark} {line}" for line in textwrap.wrap(p, width)) for p in text.split("\n"))


def test_headers_spdx_lines_and_licence_files(spark):
    bodies = dict(licenses.BODIES)
    apache = """Copyright 2020 Some One

Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."""
    gnu = """This file is part of a program.

This program is free software; you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation; either version {} of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful."""
    code = "\n\nimport os\n\n\ndef f(x):\n    return os.path.join(x, 'y')\n" + "value = other(value, 1)\n" * 60
    rows = [
        ("h/apache.py", "\n".join(f"# {line}".rstrip() for line in apache.split("\n")) + code, "Apache-2.0", "header"),
        ("h/gpl2.c", "/*\n" + "\n".join(f" * {line}".rstrip() for line in gnu.format(2).split("\n")) + "\n */" + code, "GPL-2.0", "header"),
        ("h/gpl3.py", ("\n".join(f"# {line}".rstrip() for line in gnu.format(3).split("\n")) + code).replace("\n", "\r\n"), "GPL-3.0", "header"),
        ("h/mit.py", _comment("Copyright (c) 2021 Some One\n\n" + bodies["MIT"]) + code, "MIT", "header"),
        ("h/bsd2.py", _comment("Copyright (c) 2021 Some One. All rights reserved.\n\n" + bodies["BSD-2-Clause"]) + code, "BSD-2-Clause", "header"),
        ("h/bsd3.py", _comment("Copyright (c) 2021 Some One. All rights reserved.\n\n" + bodies["BSD-3-Clause"].replace("\n", "\n\n")) + code, "BSD-3-Clause", "header"),
        ("s/a.py", "# SPDX-License-Identifier: MIT" + code, "MIT", "header"),
        ("s/b.rs", "// SPDX-License-Identifier: Apache-2.0" + code, "Apache-2.0", "header"),
        ("s/c.c", "/* SPDX-License-Identifier: GPL-2.0-or-later */" + code, "GPL-2.0", "header"),
        ("s/d.c", "/* SPDX-License-Identifier: LGPL-2.1-only */" + code, "LGPL-2.1", "header"),
        ("s/e.c", "/* SPDX-License-Identifier: GPL-1.0-or-later */" + code, None, None),
        ("m/LICENSE", "MIT License\n\nCopyright (c) 2019 Some One and others\n\n" + bodies["MIT"].replace("\n", "\n\n"), "MIT", "file"),
        ("b/LICENSE.txt", "BSD 3-Clause License\n\nCopyright (c) 2019, Some One\nAll rights reserved.\n\n" + bodies["BSD-3-Clause"].replace("\n", "\n\n"), "BSD-3-Clause", "file"),
        ("b2/copyright-of-it", "Copyright (c) 2019, Some One\n\n" + bodies["BSD-2-Clause"].replace("\n", "\n\n"), "BSD-2-Clause", "file"),
        ("i/any-name", "ISC License\n\nCopyright (c) 2019, Some One\n\n" + bodies["ISC"].replace("\n", "\n\n"), "ISC", "file"),
        ("u/UNLICENSE", bodies["Unlicense"], "Unlicense", "file"),
        ("a/LICENSE", " " * 33 + "Apache License\n" + " " * 27 + "Version 2.0, January 2004\n" + " " * 24 + "http://www.apache.org/licenses/\n\n   TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION\n\n   1. Definitions.\n" + "many terms follow " * 300, "Apache-2.0", "file"),
        ("g3/COPYING", "                    GNU GENERAL PUBLIC LICENSE\n                       Version 3, 29 June 2007\n\n Copyright (C) 2007 Some Foundation\n" + "many terms follow " * 300, "GPL-3.0", "file"),
        ("g2/COPYING", "                    GNU GENERAL PUBLIC LICENSE\n                       Version 2, June 1991\n\n Copyright (C) 1989, 1991\n" + "many terms follow " * 300, "GPL-2.0", "file"),
        ("l/COPYING", "                  GNU LESSER GENERAL PUBLIC LICENSE\n                       Version 3, 29 June 2007\n\n" + "many terms follow " * 300, "LGPL-3.0", "file"),
        ("m/src/x.py", code, "MIT", "inherited"),
        ("a/x.py", code, "Apache-2.0", "inherited"),
        ("i/x.py", "the software is provided to any person and the copyright notice is of use for the public version 3", "ISC", "inherited"),
        ("z/x.py", "the software is provided as is, and any person may use, copy and modify it in any form without a license", None, None),
    ]
    found = {r.path: (r.licence, r.how) for r in licenses.scan(_files(spark, [r[:2] for r in rows])).collect()}
    assert found == {r[0]: r[2:] for r in rows}


def test_licences_equal_the_sql(spark):
    import duckdb

    from lexmill.llm.oracle import SQL

    own = [t.text for t in licenses.templates()]
    texts = [*own, *["\r\n\r\n".join(["# some words", t, "code = 1"]) for t in own], *["x y\n#\n" + t.replace(". ", ".\n#\n") + "\n\nz" for t in own], None, "", "words", "\n\n"]
    rows = [(i, "s", f"l{i % 40}", t) for i, t in enumerate(texts)] + [(None, "s", "l1", own[0])]
    db = duckdb.connect()
    docs = spark.createDataFrame(rows, "doc_id bigint, source string, lang string, text string")
    db.register("documents", docs.toArrow())
    expected = sorted(map(repr, db.sql(SQL["op8_licenses"]).fetchall()))
    path = F.when(F.col("doc_id").isNotNull(), F.concat_ws("/", "source", "lang", F.col("doc_id").cast("string")))
    found = licenses.scan(docs.select(path.alias("path"), "text")).select(F.substring_index("path", "/", -1).cast("bigint"), "path", "licence", "how", "cosine", "folder")
    assert sorted(repr(tuple(r)) for r in found.collect()) == expected


def test_odd_files(spark):
    mit = licenses.NOTICES["MIT"]
    rows = [(None, mit), ("e/empty", ""), ("e/null", None), ("e/long", "word " * 100_000 + "\n" + mit), ("e/long", mit), ("e/long", "x"), ("/abs/LICENCE", mit), ("/abs/f", "x"), ("", "x")]
    found = licenses.scan(_files(spark, rows)).collect()
    assert len(found) == len(rows)
    by = {r.path: (r.licence, r.how) for r in found}
    assert by[None] == (None, None) and by["e/long"] == ("MIT", "header") and by["e/null"] == (None, None)
    assert by["/abs/f"] == ("MIT", "inherited") and by[""] == (None, None)
    assert licenses.scan(_files(spark, [])).collect() == []
