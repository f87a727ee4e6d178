"""License scan by sentence rules, with DataFrame functions only.

A text falls into pieces (at line ends and after . ! ? ; with white space), which are normalised: A-Z lower-cased, all but
letters, digits and inner dots made single spaces; empty pieces count as blank lines. A table maps known licence sentences to
identifiers. A known sentence is one piece or as many as its wrapped lines make, the longest first; it goes on past an end mark
or a blank line only where its own text has one (MARKED). Other pieces are gaps, save those that say that something is licensed,
if need be over a line end, which are unknown references. Ordered rules are then matched against the sequence of identifiers:
the first rule that fits takes its identifiers, so that longer rules come first.

The SQL form knows no wrapped lines: it gives the same rows where no known sentence is wrapped or has an end mark within.

Null and empty texts have no sentence and no licence; empty tables give empty results. A licence found twice is named once, repeated
rows are judged alike, texts of any length are read. Extra columns pass through, those with the names put out are replaced.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: identifier -> normalised sentence; several sentences may share the first part of an identifier
SENTENCES: dict[str, tuple[str, ...]] = {
    "mit-ref": ("released under the mit license", "licensed under the mit license", "this project is licensed under the mit license", "spdx license identifier mit"),
    "mit-grant": ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions",),
    "mit-notice": ("the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",),
    "as-is": ("the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement",),
    "apache-ref": ("licensed under the apache license version 2.0", "released under the apache license version 2.0", "licensed under the apache license version 2.0 the license", "spdx license identifier apache 2.0"),
    "apache-use": ("you may not use this file except in compliance with the license",),
    "apache-copy": ("you may obtain a copy of the license at http www.apache.org licenses license 2.0",),
    "apache-law": ("unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied",),
    "gpl3-ref": ("this work is licensed under the gnu general public license version 3", "licensed under the gnu general public license version 3", "spdx license identifier gpl 3.0 only", "spdx license identifier gpl 3.0 or later"),
    "gpl2-ref": ("licensed under the gnu general public license version 2", "this work is licensed under the gnu general public license version 2", "spdx license identifier gpl 2.0 only"),
    "gpl-grant": ("this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",),
    "gpl-hope": ("this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose",),
    "agpl3-ref": ("licensed under the gnu affero general public license version 3", "spdx license identifier agpl 3.0 only"),
    "lgpl-ref": ("licensed under the gnu lesser general public license version 2.1", "licensed under the gnu lesser general public license version 3"),
    "bsd-ref": ("licensed under the bsd license", "released under the bsd license", "licensed under the bsd 3 clause license", "spdx license identifier bsd 3 clause"),
    "bsd-grant": ("redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",),
    "mpl-ref": ("licensed under the mozilla public license version 2.0", "this source code form is subject to the terms of the mozilla public license v. 2.0"),
    "cc-by": ("licensed under cc by 4.0", "this work is licensed under a creative commons attribution 4.0 international license"),
    "cc-by-sa": ("licensed under cc by sa 4.0", "this work is licensed under a creative commons attribution sharealike 4.0 international license"),
    "cc-by-nc": ("licensed under cc by nc 4.0", "this work is licensed under a creative commons attribution noncommercial 4.0 international license"),
    "cc-by-nd": ("licensed under cc by nd 4.0", "licensed under cc by nc nd 4.0"),
    "cc0": ("licensed under cc0 1.0", "this work is dedicated to the public domain", "to the extent possible under law the author has waived all copyright and related rights to this work"),
    "reserved": ("all rights reserved",),
    "bsd-source": ("redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",),
    "bsd-binary": ("redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution",),
    "bsd-names": ("neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission", "neither the name of the nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission"),
    "bsd-as-is": ("this software is provided by the copyright holders and contributors as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed",),
    "mit-liable": ("in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software",),
    "isc-grant": ("permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",),
    "isc-ref": ("licensed under the isc license", "released under the isc license", "spdx license identifier isc"),
    "zlib-grant": ("permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions",),
    "boost-ref": ("distributed under the boost software license version 1.0", "licensed under the boost software license version 1.0", "spdx license identifier bsl 1.0"),
    "unlicense": ("this is free and unencumbered software released into the public domain",),
    "epl-ref": ("licensed under the eclipse public license version 2.0", "this program and the accompanying materials are made available under the terms of the eclipse public license v2.0", "spdx license identifier epl 2.0"),
    "lgpl-grant": ("this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 2.1 of the license or at your option any later version",),
    "agpl-grant": ("this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version",),
    "gpl2-grant": ("this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version",),
    "gpl-copy": ("you should have received a copy of the gnu general public license along with this program",),
    "gfdl": ("permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license version 1.3 or any later version published by the free software foundation",),
    "odbl": ("this database is made available under the open database license",),
    "cc-by-3": ("licensed under cc by 3.0", "this work is licensed under a creative commons attribution 3.0 unported license"),
    "cc-by-sa-3": ("licensed under cc by sa 3.0", "this work is licensed under a creative commons attribution sharealike 3.0 unported license"),
    "cc-by-nc-sa": ("licensed under cc by nc sa 4.0", "this work is licensed under a creative commons attribution noncommercial sharealike 4.0 international license"),
    "secret": ("this document contains confidential and proprietary information",),
}
#: (licence, kind, sequence of identifiers), tried in this order
RULES: tuple[tuple[str, str, tuple[str, ...]], ...] = (
    ("Apache-2.0", "permissive", ("apache-ref", "apache-use", "apache-copy", "apache-law")),
    ("MIT", "permissive", ("mit-grant", "mit-notice", "as-is", "mit-liable")),
    ("MIT", "permissive", ("mit-grant", "mit-notice", "as-is")),
    ("BSD-3-Clause", "permissive", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-names")),
    ("BSD-2-Clause", "permissive", ("bsd-grant", "bsd-source", "bsd-binary")),
    ("GPL-3.0-or-later", "copyleft", ("gpl-grant", "gpl-hope", "gpl-copy")),
    ("GPL-2.0-or-later", "copyleft", ("gpl2-grant", "gpl-hope", "gpl-copy")),
    ("GPL-2.0-or-later", "copyleft", ("gpl2-grant", "gpl-hope")),
    ("AGPL-3.0-or-later", "copyleft", ("agpl-grant", "gpl-hope")),
    ("LGPL", "weak copyleft", ("lgpl-grant", "gpl-hope")),
    ("GPL-3.0-or-later", "copyleft", ("gpl-grant", "gpl-hope")),
    ("Apache-2.0", "permissive", ("apache-ref", "apache-use")),
    ("MIT", "permissive", ("mit-grant", "mit-notice")),
    ("MIT", "permissive", ("mit-ref",)),
    ("MIT", "permissive", ("mit-grant",)),
    ("Apache-2.0", "permissive", ("apache-ref",)),
    ("GPL-3.0-only", "copyleft", ("gpl3-ref",)),
    ("GPL-2.0-only", "copyleft", ("gpl2-ref",)),
    ("GPL-3.0-or-later", "copyleft", ("gpl-grant",)),
    ("AGPL-3.0-only", "copyleft", ("agpl3-ref",)),
    ("LGPL", "weak copyleft", ("lgpl-ref",)),
    ("BSD", "permissive", ("bsd-ref",)),
    ("BSD", "permissive", ("bsd-grant",)),
    ("MPL-2.0", "weak copyleft", ("mpl-ref",)),
    ("CC-BY-4.0", "permissive", ("cc-by",)),
    ("CC-BY-SA-4.0", "copyleft", ("cc-by-sa",)),
    ("CC-BY-NC-4.0", "restricted", ("cc-by-nc",)),
    ("CC-BY-ND-4.0", "restricted", ("cc-by-nd",)),
    ("CC0-1.0", "permissive", ("cc0",)),
    ("GPL-2.0-or-later", "copyleft", ("gpl2-grant",)),
    ("AGPL-3.0-or-later", "copyleft", ("agpl-grant",)),
    ("LGPL", "weak copyleft", ("lgpl-grant",)),
    ("ISC", "permissive", ("isc-grant",)),
    ("ISC", "permissive", ("isc-ref",)),
    ("Zlib", "permissive", ("zlib-grant",)),
    ("BSL-1.0", "permissive", ("boost-ref",)),
    ("Unlicense", "permissive", ("unlicense",)),
    ("EPL-2.0", "weak copyleft", ("epl-ref",)),
    ("GFDL-1.3-or-later", "copyleft", ("gfdl",)),
    ("ODbL-1.0", "copyleft", ("odbl",)),
    ("CC-BY-3.0", "permissive", ("cc-by-3",)),
    ("CC-BY-SA-3.0", "copyleft", ("cc-by-sa-3",)),
    ("CC-BY-NC-SA-4.0", "restricted", ("cc-by-nc-sa",)),
    ("confidential", "restricted", ("secret",)),
    ("all-rights-reserved", "restricted", ("reserved",)),
    ("unknown-reference", "unknown", ("unknown",)),
)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BREAK, NOT_KEPT, OUTER_DOTS, SAYS_LICENSED = r"([.!?;])[ \t\r\f]+", r"[^a-z0-9.]+", r"[.]*( |$)[. ]*", r"(^| )(licen[sc]ed|released) under "


#: neighbouring words between which the known text itself has an end mark or a blank line
MARKED = {("v.", "2.0"), ("warranty", "without"), ("at", "http")}
#: in the text as a whole / stands for a line end and | for the end of a sentence or paragraph
END_MARK, NOT_KEPT_WHOLE, PARAGRAPH, LINE, SAYS = r"[.!?;][ \t\r\f/]+", r"[^a-z0-9.|/]+", r"[. ]*(?:/[. ]*[/|]|[|])[|/ ]*", r"[. ]*/ ?", r"[ |/](?:licen[sc]ed|released)"


def normalised(text: Column) -> Column:
    """The normalised pieces, with / or | before each."""
    plain = F.regexp_replace(F.translate(text, f"{UPPER}|/\n", f"{LOWER}  /"), END_MARK, "|")
    words = F.regexp_replace(F.regexp_replace(plain, NOT_KEPT_WHOLE, " "), OUTER_DOTS, " ")
    return F.concat(F.lit("|"), F.btrim(F.regexp_replace(F.regexp_replace(words, PARAGRAPH, "|"), LINE, "/"), F.lit("|/ ")))


def _pieces(known: dict[str, tuple[str, ...]]) -> str:
    """Matches a known sentence over its lines, or a piece with those that "licensed under" goes on in.

    The sentences stand in it as a tree by their words, so that a place in the text is compared with each beginning once, however many
    sentences begin so; where one goes on in another, the longer is tried first.
    """
    tree: dict = {}
    for s in sorted(s for ss in known.values() for s in ss):
        node = tree
        for w in s.split(" "):
            node = node.setdefault(w, {})
        node[""] = {}

    def below(node: dict, before: str | None) -> str:
        step = lambda w: "" if before is None else "[ /|]" if (before, w) in MARKED else "[ /]"
        ways = [step(w) + re.escape(w if before is None else w.rstrip(".")) + below(n, w) for w, n in node.items() if w]
        if not ways:
            return ""
        return f"(?:{'|'.join(ways)})" + ("?" if "" in node else "") if len(ways) > 1 or "" in node else ways[0]

    return rf"[|/](?:{below(tree, None)})(?=[|/]|$)|[|/][^|/]*+(?:(?<={SAYS})/under[ /][^|/]*+|(?<={SAYS} under)/[^|/]*+)*"


def identifiers(text: Column, known: dict[str, tuple[str, ...]] = SENTENCES) -> Column:
    """`|id|id|...|` with `~` for gaps."""
    table = F.create_map(*[F.lit(x) for i, ss in known.items() for s in ss for x in (s.replace(". ", " "), i)])
    pieces = F.regexp_extract_all(normalised(F.coalesce(text, F.lit(""))), F.lit(_pieces(known)), F.lit(0))
    sentences = F.transform(pieces, lambda p: F.translate(F.substring(p, 2, 2**31 - 1), "|/", "  "))
    each = F.transform(sentences, lambda s: F.coalesce(F.try_element_at(table, s), F.when(s.rlike(SAYS_LICENSED), "unknown"), F.lit("~")))
    return F.regexp_replace(F.concat(F.lit("|"), F.array_join(each, "|"), F.lit("|")), r"(\|~)+\|", "|~|")


def scan(docs: DataFrame, text: str = "text", known: dict[str, tuple[str, ...]] = SENTENCES, rules: tuple[tuple[str, str, tuple[str, ...]], ...] = RULES) -> DataFrame:
    """The rows with licenses and kinds (sorted distinct names joined by commas) and n_sentences, the licence sentences found."""
    kept = [c for c in docs.columns if c not in ("licenses", "kinds", "n_sentences")]
    # the input's columns go in one, so that none of their names meets one of ours
    out = docs.select(F.struct(*kept, F.lit(0).alias("")).alias("row"), identifiers(F.col(text), known).alias("ids"))
    count = F.size(F.regexp_extract_all("ids", F.lit(r"\|[^|~]+"), F.lit(0))).cast("long")
    left, names, kinds = F.col("ids"), [], []
    for name, kind, ids in rules:
        part = "|" + "|".join(ids) + "|"
        names.append(F.when(F.contains(left, F.lit(part)), name))
        kinds.append(F.when(F.contains(left, F.lit(part)), kind))
        if len(ids) > 1:
            left = F.replace(left, F.lit(part), F.lit("|~|"))
    joined = lambda xs: F.array_join(F.array_sort(F.array_distinct(F.array_compact(F.array(*xs)))), ",")
    return out.select(*[F.col("row")[c].alias(c) for c in kept], joined(names).alias("licenses"), joined(kinds).alias("kinds"), count.alias("n_sentences"))


def read_sentences(path: str) -> dict[str, tuple[str, ...]]:
    """{identifier: sentences} of a file of `identifier<tab>normalised sentence` lines, for known=."""
    out: dict[str, tuple[str, ...]] = {}
    with open(path, encoding="utf-8") as f:
        for line in f:
            if line.strip():
                name, sentence = line.rstrip("\n").split("\t", 1)
                out[name] = (*out.get(name, ()), sentence.strip())
    return out


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return scan(docs).select("doc_id", "licenses", "kinds", "n_sentences")


def _sql() -> str:
    keys = [(s, i) for i, ss in SENTENCES.items() for s in ss]
    table = f"MAP {{{', '.join(f"'{s}': '{i}'" for s, i in keys)}}}"
    left, names, kinds = "ids", [], []
    for name, kind, ids in RULES:
        part = "|" + "|".join(ids) + "|"
        names.append(f"CASE WHEN contains({left}, '{part}') THEN '{name}' END")
        kinds.append(f"CASE WHEN contains({left}, '{part}') THEN '{kind}' END")
        if len(ids) > 1:
            left = f"replace({left}, '{part}', '|~|')"
    joined = lambda xs: f"array_to_string(list_sort(list_distinct(list_filter([{', '.join(xs)}], lambda x: x IS NOT NULL))), ',')"
    norm = f"trim(regexp_replace(regexp_replace(translate(s, '{UPPER}', '{LOWER}'), '{NOT_KEPT}', ' ', 'g'), '{OUTER_DOTS}', ' ', 'g'))"
    return f"""
WITH a AS (SELECT doc_id, list_transform(string_split_regex(regexp_replace(coalesce(text, ''), '{BREAK}', '\\1' || chr(10), 'g'), '\\n+'), lambda s: {norm}) AS ss FROM documents),
b AS (SELECT doc_id, regexp_replace('|' || array_to_string(list_transform(ss, lambda s: coalesce({table}[s], CASE WHEN regexp_matches(s, '{SAYS_LICENSED}') THEN 'unknown' END, '~')), '|') || '|', '(\\|~)+\\|', '|~|', 'g') AS ids FROM a)
SELECT doc_id, {joined(names)} AS licenses, {joined(kinds)} AS kinds, CAST(len(regexp_extract_all(ids, '\\|[^|~]+')) AS BIGINT) AS n_sentences FROM b"""


QUERIES = {"op8_license_scan": op8_license_scan}
SQL = {"op8_license_scan": _sql()}
