import re
import textwrap

import pytest

from txengine.llm.license_sentences import OP9_SQL, RULES, SENTENCES, TRIGGERS, scan

MIT = f"{SENTENCES[3]}:\n\n{SENTENCES[4]}.\n\n{SENTENCES[5].upper()}.\n{SENTENCES[6]}."


def test_rules(spark):
    cases = {
        0: (None, 0, None, None),
        1: ("", 0, None, None),
        2: ("Some text.\nReleased under the MIT License.", 2, "<1>", "MIT"),
        3: ("word\nLicensed under the Apache License, Version 2.0. End", 3, "<7>", "Apache-2.0"),
        4: (MIT, 4, "<3><4><5><6>", "MIT"),
        5: (f"{SENTENCES[4]}. Own words! {SENTENCES[3]}.", 3, "<4><3>", None),  # out of order
        6: ("Licensed under CC BY-NC 4.0. Released under the MIT License. Licensed under CC BY-NC 4.0.", 3, "<14><1><14>", "MIT;CC-BY-NC-4.0"),
        7: ("Permission is hereby granted,\nfree of charge, to any person obtaining a copy", 1, None, None),
        8: ("prose. " * 50_000, 50_000, None, None),
        9: (f"{SENTENCES[3]}. A note of ours. {SENTENCES[4]}.", 3, "<3><4>", "MIT"),
    }
    rows = [(i, c[0]) for i, c in cases.items()] + [(2, cases[2][0]), (None, cases[2][0])]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' as licenses")
    got = scan(df, "doc_id").collect()
    assert len(got) == len(rows)
    for r in got:
        want = cases[r.doc_id if r.doc_id is not None else 2][1:]
        assert (r.n_sentences, r.sentence_ids, r.licenses) == want, r.doc_id
    assert scan(df.limit(0), "doc_id").count() == 0


#: Sentence runs of each licence, as their texts have them.
WHOLE = {
    "MIT": (3, 4, 5, 6), "Apache-2.0": (8, 9, 10), "GPL-3.0-or-later": (12, 13), "BSD-3-Clause": (18, 19, 20, 21, 22),
    "BSD-2-Clause": (18, 19, 20, 22), "ISC": (23, 24), "GPL-2.0-or-later": (28, 13), "GPL-2.0-only": (29,),
    "LGPL-2.1-or-later": (30, 13), "LGPL-3.0-or-later": (31,), "AGPL-3.0-or-later": (32, 13), "CC-BY-SA-4.0": (34,),
    "CC-BY-4.0": (17,), "CC-BY-NC-4.0": (15,), "CC0-1.0": (36,), "Unlicense": (37, 38),
}


def _written_out(number):
    """A sentence as its licence spells it: names begin with capitals, so wrapped lines do too."""
    s = SENTENCES[number]
    for w in ("software", "license", "copyright", "gnu", "permission", "redistribution", "foundation", "free", "public", "general"):
        s = re.sub(rf"\b{w}\b", w.capitalize(), s)
    return s[0].upper() + s[1:] + "."


@pytest.mark.parametrize("columns", [40, 72, 80])
def test_wrapped_licences(spark, columns):
    cases = []
    for name, run in WHOLE.items():
        body = "\n\n".join(textwrap.fill(_written_out(k), columns, break_on_hyphens=False) for k in run)
        cases.append((name, f"Copyright 2020 Somebody\n\n{body}\n"))
    mozilla = (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."
    )
    cases.append(("MPL-2.0", textwrap.fill(mozilla, columns)))
    wraps = sum(bool(re.search(r"[a-z]\n[A-Z][a-z]", t)) for _, t in cases)
    assert wraps >= 5  # line ends that look like new sentences
    got = {r.name: r.licenses for r in scan(spark.createDataFrame(cases, "name string, text string"), "name").collect()}
    assert got == {name: name for name, _ in cases}


def test_notices_inside_sentences_and_neighbours(spark):
    cases = {
        "This project is released under the MIT License and comes with nothing else.": "MIT",
        "Unreleased under the MIT license": None,
        "released under the mit licenses": None,
        "Released under the MIT License. Released under the MIT License. Released under the MIT License.": "MIT",
        "It may be used freely.\nThis work is licensed under a Creative\nCommons Attribution-ShareAlike 4.0\nInternational License, as you see.": "CC-BY-SA-4.0",
        "We say permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
        "provided that the above copyright notice and this permission notice appear in all copies.": None,  # not a sentence of its own
    }
    df = spark.createDataFrame([(t,) for t in cases], "text string")
    assert {r.text: r.licenses for r in scan(df, "text").collect()} == cases


def test_every_sentence_has_a_trigger_and_a_rule():
    assert all(any(t in s for t in TRIGGERS) for s in SENTENCES.values())
    used = {k for _, run in RULES for k in run}
    assert used >= set(SENTENCES) - {13} and used <= set(SENTENCES)


def test_sql_on_wrapped_and_neighbouring_sentences(spark):
    import duckdb

    texts = [None, "", "x", *SENTENCES.values()]
    texts += [". ".join(SENTENCES[k] for k in run) + "." for run in WHOLE.values()]
    texts += ["\n".join(_written_out(k) for k in (1, 1, 1, 2, 14, 33, 16, 35)), "released under the mit license " * 4, "a\x01b\x02Released under the MIT License\x01"]
    texts += [textwrap.fill(_written_out(k), 30) for k in SENTENCES]
    rows = list(enumerate(texts))
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    got = scan(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id").collect()
    assert sorted(tuple(r) for r in got) == sorted(con.sql(OP9_SQL).fetchall())
