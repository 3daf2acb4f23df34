"""Licence scan by sentence rules.

A text is cut into sentences, each sentence is normalised (A-Z lower-cased, everything but
letters and digits one blank), and known licence sentences are replaced by their numbers. What
remains of a text is its sequence of sentence numbers; rules, tried in order, name a licence for
a run of numbers, and numbers that a rule has used are not used again.

Built-in expressions only, row by row: no shuffle, and the sentence table and the rules are
constants of the plan. Only texts that hold one of ``TRIGGERS``, words of which every known
sentence has one, are compared with the table.

Sentences end at ``.``, ``!`` or ``?`` before a blank or the end, at an empty line, and before
a line that begins with a capital and a small letter. Prose starts new sentences there, but
licences are also wrapped there: a known sentence may go on over such line ends, as long as it
begins and ends where a sentence does. Short notices (``NOTICES``) are also found inside a longer
sentence, at whole words. Defined results: NULL and empty texts have no sentence and no licence;
sentences between two numbers of a run do not break it; repeated rows are scanned each; extra
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txengine.llm.common import lower_ascii, table

#: Known licence sentences, normalised (fixed values: the licences' own words).
SENTENCES = {
    1: "released under the mit license",
    2: "licensed under the mit license",
    3: "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions",
    4: "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    5: "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement",
    6: "in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software",
    7: "licensed under the apache license version 2 0",
    8: "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license",
    9: "you may obtain a copy of the license at http www apache org licenses license 2 0 unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied",
    10: "see the license for the specific language governing permissions and limitations under the license",
    11: "this work is licensed under the gnu general public license version 3",
    12: "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    13: "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose",
    14: "licensed under cc by nc 4 0",
    15: "this work is licensed under a creative commons attribution noncommercial 4 0 international license",
    16: "licensed under cc by 4 0",
    17: "this work is licensed under a creative commons attribution 4 0 international license",
    18: "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    19: "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
    20: "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution",
    21: "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    22: "this software is provided by the copyright holders and contributors as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed",
    23: "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    24: "the software is provided as is and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness",
    25: "this source code form is subject to the terms of the mozilla public license v",
    26: "if a copy of the mpl was not distributed with this file you can obtain one at http mozilla org mpl 2 0",
    27: "if a copy of the mpl was not distributed with this file you can obtain one at https mozilla org mpl 2 0",
    28: "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version",
    29: "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license version 2 as published by the free software foundation",
    30: "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 2 1 of the license or at your option any later version",
    31: "this program is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    32: "this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    33: "licensed under cc by sa 4 0",
    34: "this work is licensed under a creative commons attribution sharealike 4 0 international license",
    35: "licensed under cc0 1 0",
    36: "to the extent possible under law the author s have dedicated all copyright and related and neighboring rights to this software to the public domain worldwide",
    37: "this is free and unencumbered software released into the public domain",
    38: "anyone is free to copy modify publish use compile sell or distribute this software either in source code form or as a compiled binary for any purpose commercial or non commercial and by any means",
}

#: Sentences that say all by themselves, wherever they stand.
NOTICES = (1, 2, 7, 11, 14, 15, 16, 17, 33, 34, 35, 37)

#: Every known sentence has one of these words.
TRIGGERS = ("licen", "permission", "software", "redistribution", "mpl")

#: (licence, run of sentence numbers), tried in this order: longer runs before their parts.
RULES = (
    ("MIT", (3, 4, 5, 6)),
    ("MIT", (3, 4, 5)),
    ("MIT", (3, 4)),
    ("MIT", (1,)),
    ("MIT", (2,)),
    ("Apache-2.0", (8, 9, 10)),
    ("Apache-2.0", (8, 9)),
    ("Apache-2.0", (8,)),
    ("Apache-2.0", (7,)),
    ("GPL-3.0-or-later", (12, 13)),
    ("GPL-3.0-or-later", (12,)),
    ("GPL-3.0", (11,)),
    ("CC-BY-NC-4.0", (14,)),
    ("CC-BY-NC-4.0", (15,)),
    ("CC-BY-4.0", (16,)),
    ("CC-BY-4.0", (17,)),
    ("BSD-3-Clause", (18, 19, 20, 21, 22)),
    ("BSD-3-Clause", (18, 19, 20, 21)),
    ("BSD-2-Clause", (18, 19, 20, 22)),
    ("BSD-2-Clause", (18, 19, 20)),
    ("ISC", (23, 24)),
    ("ISC", (23,)),
    ("MPL-2.0", (25, 26)),
    ("MPL-2.0", (25, 27)),
    ("GPL-2.0-or-later", (28, 13)),
    ("GPL-2.0-or-later", (28,)),
    ("GPL-2.0-only", (29,)),
    ("LGPL-2.1-or-later", (30,)),
    ("LGPL-3.0-or-later", (31,)),
    ("AGPL-3.0-or-later", (32,)),
    ("CC-BY-SA-4.0", (33,)),
    ("CC-BY-SA-4.0", (34,)),
    ("CC0-1.0", (35,)),
    ("CC0-1.0", (36,)),
    ("Unlicense", (37, 38)),
    ("Unlicense", (37,)),
)

# Where a sentence ends for certain, and where it may go on.
HARD, SOFT = "\x01", "\x02"


def sentences(text: Column) -> Column:
    """The normalised text, a mark at each end of a sentence and at both ends of the text."""
    t = F.regexp_replace(F.coalesce(text, F.lit("")), r"[.!?]+([\x20\x09-\x0D]|\z)", HARD)
    t = F.regexp_replace(t, r"\n[ \t\r]*\n", HARD)
    t = F.regexp_replace(t, r"\n[ \t]*([A-Z][a-z])", SOFT + "$1")
    t = F.regexp_replace(lower_ascii(t), r"[^\p{L}\p{N}\x01\x02]+", " ")
    return F.regexp_replace(F.concat(F.lit(HARD), t, F.lit(HARD)), r" *([\x01\x02]) *", "$1")


def _patterns() -> list[tuple[int, str, str]]:
    """(number, what may stand before and after, the sentence as a pattern), longest first."""
    order = sorted(SENTENCES, key=lambda k: (-len(SENTENCES[k]), k))
    return [(k, r"[ \x01\x02]" if k in NOTICES else r"[\x01\x02]", SENTENCES[k].replace(" ", r"[ \x02]")) for k in order]


def scan(docs: DataFrame, *carried: Column | str) -> DataFrame:
    """(carried..., n_sentences, sentence_ids, licenses): the numbers found, in order, and
    the licences named by the rules, in rule order, each once. NULL where there is none."""
    # Generate keeps the planner from computing the sentences once per use
    rows = docs.select(*carried, F.explode(F.array(sentences(F.col("text")))).alias("__s"))
    own = [F.col(f"`{c}`") for c in rows.columns[:-1]]
    table_ = F.array(
        *(F.struct(F.lit(f"(?<={end}){p}(?={end})").alias("p"), F.lit(f"<{k}>").alias("k")) for k, end, p in _patterns())
    )
    numbered = F.aggregate(table_, F.col("__s"), lambda t, x: F.regexp_replace(t, x["p"], x["k"]))
    ids = F.array_join(F.regexp_extract_all(numbered, F.lit("<[0-9]+>"), F.lit(0)), "")
    known = F.when(F.col("__s").rlike("|".join(TRIGGERS)), ids).otherwise(F.lit(""))
    count = F.size(F.filter(F.split("__s", r"[\x01\x02]"), lambda s: s != "")).cast("bigint")
    rows = rows.select(*own, count.alias("n_sentences"), F.explode(F.array(known)).alias("__ids"))
    rest, named = F.col("__ids"), []
    for name, run in RULES:
        pattern = "".join(f"<{i}>" for i in run)
        named.append(F.when(F.instr(rest, pattern) > 0, F.lit(name)))
        rest = F.replace(rest, F.lit(pattern), F.lit("|"))
    licenses = F.array_join(F.array_distinct(F.array_compact(F.array(*named))), ";")
    none_if_empty = lambda c: F.when(c != "", c)
    return rows.select(
        *own, "n_sentences", none_if_empty(F.col("__ids")).alias("sentence_ids"),
        # a text without any known sentence needs no rule
        F.when(F.col("__ids") != "", none_if_empty(licenses)).alias("licenses"),
    )


def op9_license_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id")


def _op9_sql() -> str:
    numbered = "t"
    for k, end, p in _patterns():
        for _ in range(2):  # the mark between two neighbours is used up by the first
            numbered = f"regexp_replace({numbered}, '({end}){p}({end})', '\\1<{k}>\\2', 'g')"
    rest, named = "ids", []
    for name, run in RULES:
        pattern = "".join(f"<{i}>" for i in run)
        named.append(f"CASE WHEN contains({rest}, '{pattern}') THEN '{name}' END")
        rest = f"replace({rest}, '{pattern}', '|')"
    return rf"""
WITH a AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[.!?]+([\x20\x09-\x0D]|\z)', chr(1), 'g') AS t FROM documents),
b AS (SELECT doc_id, regexp_replace(t, '\n[ \t\r]*\n', chr(1), 'g') AS t FROM a),
c AS (SELECT doc_id, regexp_replace(t, '\n[ \t]*([A-Z][a-z])', chr(2) || '\1', 'g') AS t FROM b),
d AS (SELECT doc_id, regexp_replace(translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\p{{L}}\p{{N}}\x01\x02]+', ' ', 'g') AS t FROM c),
e AS (SELECT doc_id, regexp_replace(chr(1) || t || chr(1), ' *([\x01\x02]) *', '\1', 'g') AS t FROM d),
f AS (SELECT doc_id, len(list_filter(string_split(replace(t, chr(2), chr(1)), chr(1)), lambda s: s <> ''))::BIGINT AS n_sentences,
             array_to_string(regexp_extract_all({numbered}, '<[0-9]+>'), '') AS ids FROM e),
g AS (SELECT doc_id, n_sentences, ids, list_filter([{", ".join(named)}], lambda x: x IS NOT NULL) AS n FROM f)
SELECT doc_id, n_sentences, nullif(ids, '') AS sentence_ids,
       nullif(array_to_string([x FOR x, i IN n IF list_position(n, x) = i], ';'), '') AS licenses
FROM g
"""


OP9_SQL = _op9_sql()
