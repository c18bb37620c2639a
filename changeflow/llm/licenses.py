"""Licences of texts by sentence rules.

A text is cut into sentences at punctuation, blank lines and list marks.  Sentences are normalised
(lower case, letters and digits only) and known ones become identifiers, in order; one that is wrapped
over lines, with or without comment leaders, is one sentence, and each line may be one, too.  The identifier sequence is matched against the
rules in their order, longer rules first; what a rule has matched is used up.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Identifier of each known sentence, by the sentence in normal form.
SENTENCES = {
    "licensed under the apache license version 2 0": "ApacheRef",
    "licensed under the apache license version 2 0 the license": "ApacheRef",
    "you may not use this file except in compliance with the license": "ApacheUse",
    "you may obtain a copy of the license at": "ApacheCopy",
    "unless required by applicable law or agreed to in writing software distributed under the license is distributed "
    "on an as is basis without warranties or conditions of any kind either express or implied": "ApacheAsIs",
    "see the license for the specific language governing permissions and limitations under the license": "ApacheSee",
    "released under the mit license": "MITRef",
    "licensed under the mit license": "MITRef",
    "this project is licensed under the mit license": "MITRef",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
    "documentation files the software to deal in the software without restriction including without limitation the "
    "rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit "
    "persons to whom the software is furnished to do so subject to the following conditions": "MITGrant",
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions "
    "of the software": "MITNotice",
    "the software is provided as is without warranty of any kind express or implied including but not limited to the "
    "warranties of merchantability fitness for a particular purpose and noninfringement": "MITAsIs",
    "this work is licensed under the gnu general public license version 3": "GPL3Ref",
    "licensed under the gnu general public license version 3": "GPL3Ref",
    "this work is licensed under the gnu general public license version 2": "GPL2Ref",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public "
    "license as published by the free software foundation either version 3 of the license or at your option any later "
    "version": "GPL3Grant",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public "
    "license as published by the free software foundation either version 2 of the license or at your option any later "
    "version": "GPL2Grant",
    "this program is distributed in the hope that it will be useful but without any warranty without even the implied "
    "warranty of merchantability or fitness for a particular purpose": "GPLAsIs",
    "see the gnu general public license for more details": "GPLSee",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the "
    "following conditions are met": "BSDGrant",
    "redistributions of source code must retain the above copyright notice this list of conditions and the following "
    "disclaimer": "BSDSource",
    "redistributions in binary form must reproduce the above copyright notice this list of conditions and the "
    "following disclaimer in the documentation and or other materials provided with the distribution": "BSDBinary",
    "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
    "products derived from this software without specific prior written permission": "BSDNames",
    "licensed under cc by nc 4 0": "CCByNcRef",
    "licensed under cc by 4 0": "CCByRef",
    "licensed under cc by sa 4 0": "CCBySaRef",
    "this work is licensed under a creative commons attribution 4 0 international license": "CCByRef",
}
# Licence of each sequence of identifiers, in the order in which rules are tried.
RULES = [
    (("ApacheRef", "ApacheUse", "ApacheCopy", "ApacheAsIs", "ApacheSee"), "Apache-2.0"),
    (("GPL3Grant", "GPLAsIs", "GPLSee"), "GPL-3.0-or-later"),
    (("GPL2Grant", "GPLAsIs", "GPLSee"), "GPL-2.0-or-later"),
    (("BSDGrant", "BSDSource", "BSDBinary", "BSDNames"), "BSD-3-Clause"),
    (("BSDGrant", "BSDSource", "BSDBinary"), "BSD-2-Clause"),
    (("MITGrant", "MITNotice", "MITAsIs"), "MIT"),
    (("ApacheRef",), "Apache-2.0"),
    (("GPL3Grant",), "GPL-3.0-or-later"),
    (("GPL2Grant",), "GPL-2.0-or-later"),
    (("MITRef",), "MIT"),
    (("GPL3Ref",), "GPL-3.0-only"),
    (("GPL2Ref",), "GPL-2.0-only"),
    (("CCByNcRef",), "CC-BY-NC-4.0"),
    (("CCBySaRef",), "CC-BY-SA-4.0"),
    (("CCByRef",), "CC-BY-4.0"),
]
#: Where a sentence ends in the SQL, which knows no wrapped ones, and what the normal form takes for one space.
ENDS, OTHER = r"\n|[.!?;:]+[ \t\r\n]+", "[^a-z0-9]+"


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, sentences, licenses, unmatched) for every row of docs.

    sentences: identifiers of all known sentences of the whole text in order; licenses: the
    licences of the rules that match, each once, in rule order; unmatched: identifiers that no
    rule used, in order; all joined by commas and empty for null and empty texts.  Unknown
    sentences between known ones don't break a sequence.  Repeated rows stay repeated.
    """
    known = F.create_map(*(F.lit(x) for pair in SENTENCES.items() for x in pair))
    # Texts without any of these words have no known sentence: they are not cut.
    told = F.lower(F.col(text_col).cast("string"))
    some = told.rlike("licen[sc]|permi|warrant|software|redistribut")
    seen = F.regexp_extract_all(_marked(told), F.lit(_KNOWN), F.lit(0))
    cut = F.when(some, seen).otherwise(F.array().cast("array<string>"))
    found = F.transform(cut, lambda s: F.try_element_at(known, F.replace(s, F.lit(" /"), F.lit(""))))
    listed = docs.select(F.col(id_col).alias("doc_id"), F.array_join(found, ",").alias("sentences"))
    rest: Column = F.concat(F.lit(","), F.regexp_replace("sentences", ",", ",,"), F.lit(","))
    rules = F.array(*(F.struct(F.lit(_wanted(x)).alias("wanted"), F.lit(name).alias("name")) for x, name in RULES))

    def apply(state: Column, rule: Column) -> Column:
        named = F.array_union(state["found"], F.array(rule["name"]))
        return F.struct(
            F.replace(state["left"], rule["wanted"], F.lit("")).alias("left"),
            F.when(F.contains(state["left"], rule["wanted"]), named).otherwise(state["found"]).alias("found"),
        )

    start = F.struct(rest.alias("left"), F.array().cast("array<string>").alias("found"))
    state = listed.withColumn("_state", F.aggregate(rules, start, apply))
    left = F.array_join(F.filter(F.split("_state.left", ","), lambda x: x != ""), ",")
    return state.select(
        "doc_id", "sentences", F.array_join("_state.found", ",").alias("licenses"), left.alias("unmatched")
    )


def _wanted(sequence: tuple[str, ...]) -> str:
    return "".join(f",{x}," for x in sequence)


# A known sentence from one mark to another; any of its spaces may be the end of a line or a clause.  Longer ones are tried first.
_KNOWN = r"(?<=[|/] )(?:%s)(?= [|/])" % "|".join(
    sentence.replace(" ", "(?: /)? ") for sentence in sorted(SENTENCES, key=lambda x: (-len(x), x))
)


def _marked(text: Column) -> Column:
    """Normal form of a lower-case text with | where a sentence ends and / where only a line or a clause does."""
    steps = [
        (r"(?md)^[^a-z0-9\n]+", ""),  # indents and comment leaders
        (r"(?md)^(?:[0-9]{1,2}|[a-z]|[ivx]{2,4})\)[ \t]", "\n\n"),  # list marks; those with a full stop end as sentences
        (r"[.!?][.!?;:]*[ \t\r\n]+", "\n\n"),
        (r"[;:]+[ \t]+", "\n"),  # may stand in a sentence, or end it as a line does
        (r"[^a-z0-9\n]+", " "),
        (r" ?\n ?\n[\n ]*", " | "),
        (r" ?\n ?", " / "),
    ]
    for pattern, by in steps:
        text = F.regexp_replace(text, pattern, by)
    return F.concat(F.lit("| "), F.trim(text), F.lit(" |"))


def scan_sql() -> str:
    """The same in SQL for texts whose known sentences stand on one line each."""
    pairs = ", ".join(f"'{sentence}': '{name}'" for sentence, name in SENTENCES.items())
    steps = [
        f"""WITH known AS (SELECT MAP {{{pairs}}} AS k),
s0 AS (SELECT doc_id, array_to_string(list_filter(list_transform(
    regexp_split_to_array(lower(coalesce(text, '')), '\\n|[.!?;:]+[ \\t\\r\\n]+'),
    lambda s: k[trim(regexp_replace(s, '{OTHER}', ' ', 'g'))]), lambda x: x IS NOT NULL), ',') AS sentences
  FROM documents, known),
r0 AS (SELECT doc_id, sentences, ',' || replace(sentences, ',', ',,') || ',' AS rest, '' AS found FROM s0)"""
    ]
    for i, (sequence, name) in enumerate(RULES):
        wanted = _wanted(sequence)
        steps.append(
            f"""r{i + 1} AS (SELECT doc_id, sentences, replace(rest, '{wanted}', '') AS rest,
  CASE WHEN contains(rest, '{wanted}') AND NOT contains(',' || found || ',', ',{name},')
       THEN found || CASE WHEN found = '' THEN '' ELSE ',' END || '{name}' ELSE found END AS found FROM r{i})"""
        )
    return (
        ",\n".join(steps)
        + f"""
SELECT doc_id, sentences, found AS licenses,
  array_to_string(list_filter(string_split(rest, ','), lambda x: x <> ''), ',') AS unmatched FROM r{len(RULES)}"""
    )
