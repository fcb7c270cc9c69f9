"""Licence scan by sentence rules, in DataFrame operations only.

A text is cut into sentences, each is normalised (lower case, runs of other than letters and digits become a space), and
normalised sentences are mapped to the identifiers of known licence sentences. A document thus becomes a string like
``<MITperm><MITnotice>|<GPLref3>``, where a bar stands for more than ``GAP`` unknown sentences. Licence rules are sequences of
identifiers; they are tried in their order, longest texts first, and what a rule has matched is cut out, so
that no sentence speaks for two licences. Known sentences that no rule has used are reported as left over.

Two readings are made: one in which only punctuation ends a sentence (wrapped headers), and one in which a line end
does as well (a notice under a heading or in a list). The licences of both are united.

Everything happens within a row: no shuffle, and the work of a document is bounded by its own text. Texts without any of
``CUES`` hold none of the known sentences, which a test asserts, and are not cut up. Null texts count as empty;
rows that repeat an id get a row each; ids are cast to long. Other columns, whatever their names, are not read.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.llm.common import table

#: Unknown sentences that may stand between two of one rule.
GAP = 2

#: Sentences of public licence texts and notices, by identifier.
SENTENCES = {
    "MITperm": [
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
        "permit persons to whom the Software is furnished to do so, subject to the following conditions",
    ],
    "MITnotice": [
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of "
        "the Software",
    ],
    "MITwarranty": [
        'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO '
        "THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT",
    ],
    "MITref": [
        "Released under the MIT License", "Licensed under the MIT License", "This project is licensed under the MIT License",
        "Distributed under the MIT License", "MIT License", "The MIT License", "The MIT License (MIT)", "License: MIT",
    ],
    "ISCperm": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies",
    ],
    "ISCref": ["ISC License", "Licensed under the ISC License", "Released under the ISC License"],
    "BSDredist": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met",
    ],
    "BSDsource": [
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following "
        "disclaimer",
    ],
    "BSDbinary": [
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following "
        "disclaimer in the documentation and/or other materials provided with the distribution",
    ],
    "BSDendorse": [
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
        "derived from this software without specific prior written permission",
    ],
    "BSD2ref": ["Licensed under the BSD 2-Clause License", "BSD 2-Clause License"],
    "BSD3ref": [
        "Licensed under the BSD 3-Clause License", "BSD 3-Clause License", "Released under the 3-clause BSD License",
    ],
    "BSDref": ["Licensed under the BSD License", "Released under the BSD License", "BSD License"],
    "ApacheRef2": [
        "Licensed under the Apache License, Version 2.0", 'Licensed under the Apache License, Version 2.0 (the "License")',
        "Released under the Apache License, Version 2.0", "Apache License, Version 2.0", "Released under the Apache License 2.0",
        "This project is licensed under the Apache License 2.0", "Licensed under the Apache License 2.0",
    ],
    "ApacheUse": ["you may not use this file except in compliance with the License"],
    "ApacheCopy": [
        "You may obtain a copy of the License at", "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "You may obtain a copy of the License at https://www.apache.org/licenses/LICENSE-2.0",
    ],
    "ApacheAsIs": [
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
        '"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied',
    ],
    "GPLref2": [
        "This work is licensed under the GNU General Public License, version 2",
        "Licensed under the GNU General Public License, version 2", "GNU General Public License, version 2",
        "Released under the GNU General Public License, version 2",
    ],
    "GPLref3": [
        "This work is licensed under the GNU General Public License, version 3",
        "Licensed under the GNU General Public License, version 3", "GNU General Public License, version 3",
        "Released under the GNU General Public License, version 3",
    ],
    "GPLfree": [
        "This program is free software", "This file is free software", "This is free software licensed under the GNU GPL",
    ],
    "GPLlater2": [
        "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free "
        "Software Foundation; either version 2 of the License, or (at your option) any later version",
        "either version 2 of the License, or (at your option) any later version",
    ],
    "GPLlater3": [
        "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free "
        "Software Foundation, either version 3 of the License, or (at your option) any later version",
        "either version 3 of the License, or (at your option) any later version",
    ],
    "GPLterms": [
        "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free "
        "Software Foundation",
    ],
    "LGPLterms": [
        "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the "
        "Free Software Foundation",
    ],
    "LGPLref21": ["Licensed under the GNU Lesser General Public License, version 2.1"],
    "LGPLref3": ["Licensed under the GNU Lesser General Public License, version 3"],
    "LGPLlater21": ["either version 2.1 of the License, or (at your option) any later version"],
    "AGPLterms": [
        "you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the "
        "Free Software Foundation",
    ],
    "AGPLref3": ["Licensed under the GNU Affero General Public License, version 3"],
    "MPLsubject": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v",
        "Licensed under the Mozilla Public License, version 2.0", "Released under the Mozilla Public License 2.0",
    ],
    "EPLref2": ["Licensed under the Eclipse Public License 2.0", "Licensed under the Eclipse Public License, version 2.0"],
    "CCBY4": [
        "Licensed under CC BY 4.0", "This work is licensed under CC BY 4.0",
        "This work is licensed under a Creative Commons Attribution 4.0 International License",
    ],
    "CCBYSA4": [
        "Licensed under CC BY-SA 4.0", "This work is licensed under CC BY-SA 4.0",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
    ],
    "CCBYNC4": [
        "Licensed under CC BY-NC 4.0", "This work is licensed under CC BY-NC 4.0",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
    ],
    "CCBYND4": ["Licensed under CC BY-ND 4.0", "This work is licensed under CC BY-ND 4.0"],
    "CC0": ["Licensed under CC0 1.0", "This work is licensed under CC0 1.0 Universal"],
    "UnlicenseDomain": [
        "This is free and unencumbered software released into the public domain",
    ],
    "UnlicenseFree": [
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or "
        "as a compiled binary, for any purpose, commercial or non-commercial, and by any means",
    ],
    "BoostRef": ["Distributed under the Boost Software License, Version 1.0"],
    "ZlibPerm": [
        "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it "
        "and redistribute it freely, subject to the following restrictions",
    ],
    "Reserved": ["All rights reserved"],
    "SpdxMIT": ["SPDX-License-Identifier: MIT"],
    "SpdxApache2": ["SPDX-License-Identifier: Apache-2.0"],
    "SpdxGPL2": ["SPDX-License-Identifier: GPL-2.0-only"],
    "SpdxGPL3": ["SPDX-License-Identifier: GPL-3.0-only"],
    "SpdxGPL3later": ["SPDX-License-Identifier: GPL-3.0-or-later"],
    "SpdxBSD3": ["SPDX-License-Identifier: BSD-3-Clause"],
}

#: Licences with the sentences they take, in the order they are tried.
RULES = [
    ("MIT", ["MITref", "MITperm", "MITnotice", "MITwarranty"]),
    ("MIT", ["MITperm", "MITnotice", "MITwarranty"]),
    ("MIT", ["MITperm", "MITnotice"]),
    ("BSD-3-Clause", ["BSD3ref", "BSDredist", "BSDsource", "BSDbinary", "BSDendorse"]),
    ("BSD-3-Clause", ["BSDredist", "BSDsource", "BSDbinary", "BSDendorse"]),
    ("BSD-2-Clause", ["BSD2ref", "BSDredist", "BSDsource", "BSDbinary"]),
    ("BSD-2-Clause", ["BSDredist", "BSDsource", "BSDbinary"]),
    ("Apache-2.0", ["ApacheRef2", "ApacheUse", "ApacheCopy", "ApacheAsIs"]),
    ("Apache-2.0", ["ApacheRef2", "ApacheUse", "ApacheCopy"]),
    ("Apache-2.0", ["ApacheRef2", "ApacheUse"]),
    ("Apache-2.0", ["ApacheUse", "ApacheCopy", "ApacheAsIs"]),
    ("AGPL-3.0-or-later", ["GPLfree", "AGPLterms", "GPLlater3"]),
    ("LGPL-2.1-or-later", ["GPLfree", "LGPLterms", "LGPLlater21"]),
    ("LGPL-3.0-or-later", ["GPLfree", "LGPLterms", "GPLlater3"]),
    ("GPL-2.0-or-later", ["GPLfree", "GPLterms", "GPLlater2"]),
    ("GPL-3.0-or-later", ["GPLfree", "GPLterms", "GPLlater3"]),
    ("GPL-2.0-or-later", ["GPLfree", "GPLlater2"]),
    ("GPL-3.0-or-later", ["GPLfree", "GPLlater3"]),
    ("Unlicense", ["UnlicenseDomain", "UnlicenseFree"]),
    ("ISC", ["ISCref", "ISCperm"]),
    ("ISC", ["ISCperm"]),
    ("Zlib", ["ZlibPerm"]),
    ("Unlicense", ["UnlicenseDomain"]),
    ("MIT", ["MITref"]),
    ("ISC", ["ISCref"]),
    ("BSD-2-Clause", ["BSD2ref"]),
    ("BSD-3-Clause", ["BSD3ref"]),
    ("BSD", ["BSDref"]),
    ("Apache-2.0", ["ApacheRef2"]),
    ("GPL-2.0-only", ["GPLref2"]),
    ("GPL-3.0-only", ["GPLref3"]),
    ("LGPL-2.1-only", ["LGPLref21"]),
    ("LGPL-3.0-only", ["LGPLref3"]),
    ("AGPL-3.0-only", ["AGPLref3"]),
    ("MPL-2.0", ["MPLsubject"]),
    ("EPL-2.0", ["EPLref2"]),
    ("CC-BY-4.0", ["CCBY4"]),
    ("CC-BY-SA-4.0", ["CCBYSA4"]),
    ("CC-BY-NC-4.0", ["CCBYNC4"]),
    ("CC-BY-ND-4.0", ["CCBYND4"]),
    ("CC0-1.0", ["CC0"]),
    ("BSL-1.0", ["BoostRef"]),
    ("MIT", ["SpdxMIT"]),
    ("Apache-2.0", ["SpdxApache2"]),
    ("GPL-2.0-only", ["SpdxGPL2"]),
    ("GPL-3.0-only", ["SpdxGPL3"]),
    ("GPL-3.0-or-later", ["SpdxGPL3later"]),
    ("BSD-3-Clause", ["SpdxBSD3"]),
]

#: Every known sentence holds one of these.
CUES = ["licen", "permission", "redistribut", "software", "warrant", "copyright", "public domain", "rights reserved"]
_CUE = "(?i)" + "|".join(c.replace(" ", r"\W+") for c in CUES)

#: What ends a sentence: a stop before white space or the end of the text, a colon at the end of a line, a line without words.
_STOP = r"[.!?;]+(\s|$)|:\s*(\n|$)|\n[^\p{L}\p{N}\n]*\n"
_STOP_OR_LINE = _STOP + r"|\n"
_MARK = "\x01"
_NOT_WORD = r"[^\p{L}\p{N}]+"


def normalised(sentence: str) -> str:
    return re.sub(r"[\W_]+", " ", sentence.lower()).strip()


def known_sentences() -> dict[str, str]:
    """Known normalised sentence to identifier."""
    return {normalised(sentence): name for name, own in SENTENCES.items() for sentence in own}


def sentence_string(text: Column, stop: str) -> Column:
    """The document as identifiers, with a bar for each long run of unknown sentences."""
    known = F.create_map(*[F.lit(x) for s, name in known_sentences().items() for x in (s, f"<{name}>")])
    own = F.split(F.regexp_replace(F.lower(text), stop, _MARK), _MARK, -1)
    names = F.transform(own, lambda s: F.coalesce(known[F.trim(F.regexp_replace(s, _NOT_WORD, " "))], F.lit(".")))
    return F.replace(F.regexp_replace(F.array_join(names, ""), f"[.]{{{GAP + 1},}}", "|"), F.lit("."), F.lit(""))


def apply_rules(sequence: Column) -> Column:
    """licences (in the order of the rules) and rest (the sequence without what they matched)."""
    rules = F.array(*[
        F.struct(F.lit(licence).alias("licence"), F.lit("".join(f"<{s}>" for s in own)).alias("own")) for licence, own in RULES
    ])
    start = F.struct(F.array().cast("array<string>").alias("licences"), sequence.alias("rest"))

    def step(state: Column, rule: Column) -> Column:
        holds = F.contains(state["rest"], rule["own"])
        return F.struct(
            F.when(holds, F.array_union(state["licences"], F.array(rule["licence"]))).otherwise(state["licences"]).alias("licences"),
            F.when(holds, F.replace(state["rest"], rule["own"], F.lit("|"))).otherwise(state["rest"]).alias("rest"),
        )

    return F.aggregate(rules, start, step)


def licences(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, licences (sorted), sentences (identifiers in order), left_over (those of no rule), for every row.

    sentences and left_over are of the reading that keeps line ends apart if it found more, else of the other.
    """
    text = F.col("text")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    likely = text.rlike(_CUE)
    read = rows.select(
        "doc_id",
        F.when(likely, sentence_string(text, _STOP)).otherwise("").alias("wrapped"),
        F.when(likely, sentence_string(text, _STOP_OR_LINE)).otherwise("").alias("lined"),
    )
    ruled = read.select(
        "doc_id", "wrapped", "lined",
        F.when(F.col("wrapped") != "", apply_rules(F.col("wrapped"))).alias("w"),
        F.when(F.col("lined") != "", apply_rules(F.col("lined"))).alias("l"),
    )
    none = F.array().cast("array<string>")
    more = F.length(F.regexp_replace("lined", "[^<]", "")) > F.length(F.regexp_replace("wrapped", "[^<]", ""))
    names = lambda s: F.regexp_extract_all(s, F.lit("<([^>]+)>"), F.lit(1))
    return ruled.select(
        "doc_id",
        F.sort_array(F.array_union(F.coalesce("w.licences", none), F.coalesce("l.licences", none))).alias("licences"),
        names(F.when(more, F.col("lined")).otherwise(F.col("wrapped"))).alias("sentences"),
        names(F.coalesce(F.when(more, F.col("l.rest")).otherwise(F.col("w.rest")), F.lit(""))).alias("left_over"),
    )


def op7_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licences(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", F.array_join("licences", ",").alias("licences"), F.size("sentences").cast("long").alias("n_sentences"),
        F.array_join("sentences", ",").alias("sentences"), F.array_join("left_over", ",").alias("left_over"),
    )


def _oracle() -> str:
    """The same in DuckDB, a step per rule."""
    quoted = lambda s: "'" + s.replace("'", "''") + "'"
    known = ", ".join(f"({quoted(s)}, '<{name}>')" for s, name in known_sentences().items())
    steps, last = [], "base"
    for i, (licence, own) in enumerate(RULES):
        sequence = "".join(f"<{s}>" for s in own)
        steps.append(
            f"r{i} AS (SELECT doc_id, reading, seq, CASE WHEN contains(rest, '{sequence}') THEN list_append(out, '{licence}') "
            f"ELSE out END AS out, replace(rest, '{sequence}', '|') AS rest FROM {last})"
        )
        last = f"r{i}"
    sentence = r"trim(regexp_replace(s, '[^\p{L}\p{N}]+', ' ', 'g'))"
    cue = r"'(?i)" + "|".join(c.replace(" ", r"\W+") for c in CUES) + "'"
    return rf"""
WITH known(sentence, name) AS (VALUES {known}
), dict AS (
  SELECT map_from_entries(list((sentence, name))) AS m FROM known
), d AS (
  SELECT doc_id, coalesce(text, '') AS t FROM documents
), read AS (
  SELECT doc_id, 1 AS reading, string_split(regexp_replace(lower(t), '{_STOP}', chr(1), 'g'), chr(1)) AS own
  FROM d WHERE regexp_matches(t, {cue})
  UNION ALL
  SELECT doc_id, 2, string_split(regexp_replace(lower(t), '{_STOP_OR_LINE}', chr(1), 'g'), chr(1))
  FROM d WHERE regexp_matches(t, {cue})
), named AS (
  SELECT doc_id, reading,
         replace(regexp_replace(array_to_string(
           list_transform(own, lambda s: coalesce(m[{sentence}], '.')), ''), '[.]{{{GAP + 1},}}', '|', 'g'), '.', '') AS seq
  FROM read, dict
), base AS (
  SELECT doc_id, reading, seq, []::VARCHAR[] AS out, seq AS rest FROM named
), {", ".join(steps)}, counted AS (
  SELECT *, len(regexp_extract_all(seq, '<')) AS n FROM {last}
), one AS (
  SELECT doc_id, list_sort(list_distinct(flatten(list(out)))) AS licences,
         arg_max(seq, n * 2 + (2 - reading)) AS seq, arg_max(rest, n * 2 + (2 - reading)) AS rest
  FROM counted GROUP BY 1
)
SELECT d.doc_id, coalesce(array_to_string(licences, ','), '') AS licences,
       CAST(coalesce(len(regexp_extract_all(seq, '<')), 0) AS BIGINT) AS n_sentences,
       coalesce(array_to_string(regexp_extract_all(seq, '<([^>]+)>', 1), ','), '') AS sentences,
       coalesce(array_to_string(regexp_extract_all(rest, '<([^>]+)>', 1), ','), '') AS left_over
FROM d LEFT JOIN one USING (doc_id)
"""


ORACLE = _oracle()
