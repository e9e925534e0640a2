"""License scans by sentence-rule recognition.

A text is split into sentences, each is normalised and looked up among known licence sentences, and the resulting
identifier sequence is matched against ordered rules: a rule names a licence and the sentence identifiers that must
follow each other, with at most ``MAX_GAP`` other sentences between two of them. All rules that match are reported,
in rule order, and the first decides.

A text is read three ways, and a rule matches by any of them: by lines, each line break ending a sentence; and as hard-wrapped
text, where single line breaks and comment marks are spaces, once with colons and semicolons as ends of sentences and once
without. List numbers are no sentences of wrapped text. ``n_sentences`` counts by lines.

Sentences are looked up in a map and become one character each, so their number does not change the work; sentences and
rules are parameters of :func:`scan`. Only DataFrame functions, all within the row: no shuffle.

Defined cases: null and empty texts have no sentences and no licence; repeated sentences count each time; unknown
sentences only widen gaps; repeated rows are judged alike; very long texts are read whole; an empty table gives no rows;
other columns pass through :func:`scan` under any name, except ones named as its added columns, which are replaced.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import column, prefixed, working

#: Normalised sentences of public licences and notices, by identifier.
SENTENCES = {
    "mit-name": "released under the mit license",
    "mit-name-2": "this project is licensed under the mit license",
    "mit-grant": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions",
    "mit-notice": "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    "apache-name": "licensed under the apache license version 2 0",
    "apache-header": "licensed under the apache license version 2 0 the license",
    "apache-comply": "you may not use this file except in compliance with the license",
    "apache-obtain": "you may obtain a copy of the license at",
    "apache-as-is": "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied",
    "gpl3-name": "this work is licensed under the gnu general public license version 3",
    "gpl3-redistribute": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "gpl-warranty": "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose",
    "gpl2-redistribute": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version",
    "cc-by-nc-name": "licensed under cc by nc 4 0",
    "cc-by-name": "licensed under cc by 4 0",
    "cc-by-sa-name": "licensed under cc by sa 4 0",
    "cc-by-work": "this work is licensed under a creative commons attribution 4 0 international license",
    "cc0-name": "to the extent possible under law the author has waived all copyright and related rights to this work",
    "bsd-redistribution": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "bsd-endorse": "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "rights-reserved": "all rights reserved",
    "mit-as-is": "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement",
    "bsd-source": "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
    "bsd-binary": "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution",
    "isc-grant": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    "0bsd-grant": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
    "isc-as-is": "the software is provided as is and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness",
    "mpl2-notice": "this source code form is subject to the terms of the mozilla public license v 2 0",
    "mpl2-copy": "if a copy of the mpl was not distributed with this file you can obtain one at https mozilla org mpl 2 0",
    "lgpl3-redistribute": "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "lgpl21-redistribute": "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 2 1 of the license or at your option any later version",
    "lgpl-warranty": "this library is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose",
    "agpl3-redistribute": "this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "unlicense-domain": "this is free and unencumbered software released into the public domain",
    "unlicense-anyone": "anyone is free to copy modify publish use compile sell or distribute this software either in source code form or as a compiled binary for any purpose commercial or non commercial and by any means",
    "boost-grant": "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license the software to use reproduce display distribute execute and transmit the software and to prepare derivative works of the software and to permit third parties to whom the software is furnished to do so all subject to the following",
    "zlib-as-is": "this software is provided as is without any express or implied warranty",
    "zlib-grant": "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions",
    "mit-spdx": "spdx license identifier mit",
    "apache-spdx": "spdx license identifier apache 2 0",
    "gpl2-spdx": "spdx license identifier gpl 2 0 only",
    "gpl3-spdx": "spdx license identifier gpl 3 0 only",
    "bsd3-spdx": "spdx license identifier bsd 3 clause",
    "mpl2-spdx": "spdx license identifier mpl 2 0",
    "cc-by-sa-work": "this work is licensed under a creative commons attribution sharealike 4 0 international license",
    "cc-by-nc-work": "this work is licensed under a creative commons attribution noncommercial 4 0 international license",
    "cc-by-nd-work": "this work is licensed under a creative commons attribution noderivatives 4 0 international license",
}
#: Fixed values: (rule, licence, sentence identifiers in order); earlier rules come first.
RULES = (
    ("mit-full", "MIT", ("mit-grant", "mit-notice")),
    ("apache-full", "Apache-2.0", ("apache-header", "apache-comply", "apache-obtain", "apache-as-is")),
    ("apache-short", "Apache-2.0", ("apache-header", "apache-comply")),
    ("gpl3-full", "GPL-3.0-or-later", ("gpl3-redistribute", "gpl-warranty")),
    ("gpl2-full", "GPL-2.0-or-later", ("gpl2-redistribute", "gpl-warranty")),
    ("bsd3-full", "BSD-3-Clause", ("bsd-redistribution", "bsd-endorse")),
    ("bsd2-full", "BSD-2-Clause", ("bsd-redistribution",)),
    ("gpl3-name", "GPL-3.0-only", ("gpl3-name",)),
    ("gpl3-notice", "GPL-3.0-or-later", ("gpl3-redistribute",)),
    ("gpl2-notice", "GPL-2.0-or-later", ("gpl2-redistribute",)),
    ("cc-by-nc", "CC-BY-NC-4.0", ("cc-by-nc-name",)),
    ("cc-by-sa", "CC-BY-SA-4.0", ("cc-by-sa-name",)),
    ("cc-by", "CC-BY-4.0", ("cc-by-name",)),
    ("cc-by-work", "CC-BY-4.0", ("cc-by-work",)),
    ("cc0", "CC0-1.0", ("cc0-name",)),
    ("apache-name", "Apache-2.0", ("apache-name",)),
    ("mit-name", "MIT", ("mit-name",)),
    ("mit-name-2", "MIT", ("mit-name-2",)),
    ("mit-grant", "MIT", ("mit-grant",)),
    ("reserved", "Proprietary", ("rights-reserved",)),
    ("mit-text", "MIT", ("mit-grant", "mit-notice", "mit-as-is")),
    ("bsd3-text", "BSD-3-Clause", ("bsd-redistribution", "bsd-source", "bsd-binary", "bsd-endorse")),
    ("bsd2-text", "BSD-2-Clause", ("bsd-redistribution", "bsd-source", "bsd-binary")),
    ("isc", "ISC", ("isc-grant", "isc-as-is")),
    ("0bsd", "0BSD", ("0bsd-grant", "isc-as-is")),
    ("mpl2", "MPL-2.0", ("mpl2-notice", "mpl2-copy")),
    ("lgpl3", "LGPL-3.0-or-later", ("lgpl3-redistribute", "lgpl-warranty")),
    ("lgpl21", "LGPL-2.1-or-later", ("lgpl21-redistribute", "lgpl-warranty")),
    ("agpl3", "AGPL-3.0-or-later", ("agpl3-redistribute", "gpl-warranty")),
    ("unlicense", "Unlicense", ("unlicense-domain", "unlicense-anyone")),
    ("boost", "BSL-1.0", ("boost-grant",)),
    ("zlib", "Zlib", ("zlib-as-is", "zlib-grant")),
    ("mit-spdx", "MIT", ("mit-spdx",)),
    ("apache-spdx", "Apache-2.0", ("apache-spdx",)),
    ("gpl2-spdx", "GPL-2.0-only", ("gpl2-spdx",)),
    ("gpl3-spdx", "GPL-3.0-only", ("gpl3-spdx",)),
    ("bsd3-spdx", "BSD-3-Clause", ("bsd3-spdx",)),
    ("mpl2-spdx", "MPL-2.0", ("mpl2-spdx",)),
    ("cc-by-sa-work", "CC-BY-SA-4.0", ("cc-by-sa-work",)),
    ("cc-by-nc-work", "CC-BY-NC-4.0", ("cc-by-nc-work",)),
    ("cc-by-nd-work", "CC-BY-ND-4.0", ("cc-by-nd-work",)),
)
MAX_GAP = 2
_SPACES, _LEAD = r"[\x20\x09-\x0D]+", r"[\x20\x09\x0D#*/]*"
#: Ends of sentences by lines, of wrapped text, and of wrapped text with colons and semicolons.
BREAKS = (rf"[.!?:;]+(?:{_SPACES}|$)|\n+", rf"[.!?]+(?:{_SPACES}|$)|\n{_LEAD}\n{_LEAD}", rf"[.!?:;]+(?:{_SPACES}|$)|\n{_LEAD}\n{_LEAD}")
_NUMBER = "^(?:[0-9]{1,2}|[a-z])$"
_OTHER = "_"


def code_of(place: int) -> str:
    """The character of the sentence at a place of the list: from the private use areas, 137,000 in all."""
    return chr(0xE000 + place if place < 6400 else 0xF0000 + place - 6400)


def rule_pattern(rule: Sequence[str], sentences: Mapping[str, str] = SENTENCES) -> str:
    """The rule as a pattern over sentence codes."""
    codes = {name: code_of(i) for i, name in enumerate(sentences)}
    return f".{{0,{MAX_GAP}}}".join(codes[s] for s in rule)


def sentence_codes(text: Column, reading: int = 0, sentences: Mapping[str, str] = SENTENCES) -> Column:
    """One character by sentence of a reading: the known sentence's code, or the mark of an unknown one."""
    said = F.transform(F.split(F.lower(text), BREAKS[reading], -1), lambda s: F.trim(F.regexp_replace(s, r"[^a-z0-9\x{80}-\x{10FFFF}]+", " ")))
    said = F.filter(said, lambda s: (s != "") & ~s.rlike(_NUMBER) if reading else s != "")
    known = F.create_map(*[F.lit(x) for i, one in enumerate(sentences.values()) for x in (one, code_of(i))])
    return F.array_join(F.transform(said, lambda s: F.when(s.isin(*sentences.values()), F.element_at(known, s)).otherwise(F.lit(_OTHER))), "")


def scan(docs: DataFrame, text_col: str = "text", sentences: Mapping[str, str] = SENTENCES, rules: Sequence[tuple[str, str, Sequence[str]]] = RULES) -> DataFrame:
    """``docs`` with n_sentences, n_known, rules, licences and licence (of the first rule; null without one).

    ``sentences``: normalised ones by identifier; ``rules``: name, licence and identifiers in order, first rules first.
    """
    added = ["n_sentences", "n_known", "rules", "licences", "licence"]
    kept = [c for c in docs.columns if c not in added]
    text = F.coalesce(column(text_col), F.lit(""))
    # a text without the longest word of any sentence has none of them: it is read by lines alone, for its count
    words = sorted({max(one.split(), key=len) for one in sentences.values()})
    worth = F.lower(text).rlike("|".join(words))
    codes = [sentence_codes(text, 0, sentences), *[F.when(worth, sentence_codes(text, k, sentences)).otherwise(F.lit("")) for k in (1, 2)]]
    rows = docs.select(*[prefixed(c) for c in kept], *[c.alias(f"_codes{k}") for k, c in enumerate(codes)])
    read = [F.col(f"_codes{k}") for k in range(len(BREAKS))]

    def hit(name: str, licence: str, rule: Sequence[str]) -> Column:
        pattern = rule_pattern(rule, sentences)
        return F.when(read[0].rlike(pattern) | read[1].rlike(pattern) | read[2].rlike(pattern), F.struct(F.lit(name).alias("rule"), F.lit(licence).alias("licence")))

    some = F.greatest(*[F.length(F.replace(c, F.lit(_OTHER), F.lit(""))) for c in read])
    rows = rows.withColumn("_known", some.cast("long"))
    none = F.array().cast("array<struct<rule:string,licence:string>>")
    rows = rows.withColumn("_hits", F.when(F.col("_known") > 0, F.array_compact(F.array(*[hit(*r) for r in rules]))).otherwise(none))
    return rows.select(
        *[F.col(working(c)).alias(c) for c in kept],
        F.length("_codes0").cast("long").alias("n_sentences"),
        F.col("_known").alias("n_known"),
        F.array_join(F.transform("_hits", lambda h: h["rule"]), ",").alias("rules"),
        F.array_join(F.array_distinct(F.transform("_hits", lambda h: h["licence"])), ",").alias("licences"),
        F.get("_hits", F.lit(0))["licence"].alias("licence"),
    )


def digest(docs: DataFrame) -> DataFrame:
    return scan(docs.select("doc_id", "text")).drop("text")


def _quoted(names) -> str:
    return ", ".join(f"'{n}'" for n in names)


def _sql_codes(reading: int) -> str:
    said = rf"list_transform(regexp_split_to_array(lower(coalesce(text, '')), '{BREAKS[reading]}'), lambda x: trim(regexp_replace(x, '[^a-z0-9\x{{80}}-\x{{10FFFF}}]+', ' ', 'g')))"
    said = f"list_filter({said}, lambda x: x <> ''" + (f" AND NOT regexp_matches(x, '{_NUMBER}'))" if reading else ")")
    codes = _quoted(code_of(i) for i in range(len(SENTENCES)))
    return f"array_to_string(list_transform({said}, lambda x: coalesce([{codes}][list_position([{_quoted(SENTENCES.values())}], x)], '{_OTHER}')), '')"


def _sql_hit(reading: int, rule: Sequence[str]) -> str:
    return f"regexp_matches(c{reading}, '{rule_pattern(rule)}')"


_SQL_HITS = ", ".join(f"CASE WHEN {' OR '.join(_sql_hit(r, s) for r in range(3))} THEN {k + 1} END" for k, (_, _, s) in enumerate(RULES))
ORACLE = rf"""
WITH c AS (SELECT doc_id, {_sql_codes(0)} AS c0, {_sql_codes(1)} AS c1, {_sql_codes(2)} AS c2 FROM documents),
h AS (SELECT *, list_filter([{_SQL_HITS}], lambda x: x IS NOT NULL) AS hits FROM c),
n AS (SELECT *, list_transform(hits, lambda k: [{_quoted(n for _, n, _ in RULES)}][k]) AS names FROM h)
SELECT doc_id, length(c0)::BIGINT AS n_sentences,
  greatest(length(replace(c0, '{_OTHER}', '')), length(replace(c1, '{_OTHER}', '')), length(replace(c2, '{_OTHER}', '')))::BIGINT AS n_known,
  array_to_string(list_transform(hits, lambda k: [{_quoted(r for r, _, _ in RULES)}][k]), ',') AS rules,
  array_to_string(list_filter(names, lambda x, i: list_position(names, x) = i), ',') AS licences,
  names[1] AS licence
FROM n
"""
