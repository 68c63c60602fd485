"""Licence recognition by sentence rules (operator 9), in DataFrame operations only.

Texts are normalised (lower case, runs of anything but letters and digits one space) with a mark
where a line or a clause ends and another where a sentence ends. Wordings of a table are looked for
from one mark to another, so that a notice may be wrapped over lines or stand on one: inside a
wording, lines and clauses may end anywhere, sentences only where the wording has such an end. Of
wordings that begin at one place the longest counts. Each stands for an identifier; short grants
("licensed under the ...") may have a subject before them ("this project is ..."). The sequence of
a document's identifiers is matched against ordered rules; the first rule whose identifiers follow
one another in the sequence names the licence. Sentences that no rule uses are still reported.

Null and empty texts have no sentences; very long texts are scanned whole, in time proportional to
their length. Rows are independent: repeated rows give equal results. Of rules that match, the
first counts. An empty table stays empty; other columns pass through, whatever their names.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ontime_spark.llm import common

# Identifiers and wording of public licence notices, normalised but for ". " where a
# sentence end stands inside.
SENTENCES = [
    ("apache2-short", "licensed under the apache license version 2 0"),
    ("apache2-grant", "licensed under the apache license version 2 0 the license"),
    ("apache2-comply", "you may not use this file except in compliance with the license"),
    ("apache2-copy", "you may obtain a copy of the license at http www apache org licenses license 2 0"),
    ("apache2-warranty", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied"),
    ("mit-short", "released under the mit license"),
    ("mit-name", "the mit license"),
    ("mit-grant", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions"),
    ("mit-notice", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("mit-warranty", "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement"),
    ("gpl3-short", "this work is licensed under the gnu general public license version 3"),
    ("gpl-free", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version"),
    ("gpl-hope", "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose"),
    ("gpl-copy", "you should have received a copy of the gnu general public license along with this program"),
    ("bsd-redistribute", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("bsd-source", "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"),
    ("bsd-binary", "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution"),
    ("cc-by-nc4-short", "licensed under cc by nc 4 0"),
    ("cc-by4-short", "licensed under cc by 4 0"),
    ("cc-by-sa4-short", "licensed under cc by sa 4 0"),
    ("cc0-short", "released into the public domain under cc0 1 0"),
    ("mpl2", "this source code form is subject to the terms of the mozilla public license v. 2 0"),
    ("rights", "all rights reserved"),
    ("bsd-names", "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission"),
    ("gpl2-free", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version"),
    ("lgpl21-free", "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 2 1 of the license or at your option any later version"),
    ("lgpl3-free", "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version"),
    ("agpl3-free", "this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version"),
    ("isc-grant", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies"),
    ("unlicense-grant", "this is free and unencumbered software released into the public domain"),
    ("mit-title", "mit license"),
    ("apache2-title", "apache license version 2 0 january 2004"),
    ("gpl3-title", "gnu general public license version 3 29 june 2007"),
    ("gpl2-title", "gnu general public license version 2 june 1991"),
    ("bsd2-title", "bsd 2 clause license"),
    ("bsd3-title", "bsd 3 clause license"),
    ("isc-title", "isc license"),
]
# Names of licences in short grants, and public licence identifiers.
NAMES = [
    ("Apache-2.0", "the apache license 2 0"), ("Apache-2.0", "the apache license version 2 0"), ("MIT", "the mit license"),
    ("BSD-2-Clause", "the bsd 2 clause license"), ("BSD-3-Clause", "the bsd 3 clause license"), ("ISC", "the isc license"),
    ("GPL-3.0", "the gnu general public license version 3"), ("GPL-2.0", "the gnu general public license version 2"),
    ("MPL-2.0", "the mozilla public license 2 0"), ("Unlicense", "the unlicense"),
]
IDENTIFIERS = ["Apache-2.0", "MIT", "BSD-2-Clause", "BSD-3-Clause", "ISC", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0-only", "GPL-3.0-or-later",
               "LGPL-2.1-or-later", "LGPL-3.0-or-later", "AGPL-3.0-or-later", "MPL-2.0", "CC0-1.0", "CC-BY-4.0", "CC-BY-SA-4.0", "Unlicense"]
VERBS = ("licensed", "released", "distributed")
SUBJECTS = ("project", "software", "code", "library", "package", "file", "work", "program", "repository")
# Ordered rules, the licence and the identifiers that must follow one another.
RULES = [
    ("Apache-2.0", ("apache2-grant", "apache2-comply", "apache2-copy", "apache2-warranty")),
    ("Apache-2.0", ("apache2-grant", "apache2-comply")),
    ("Apache-2.0", ("apache2-short",)),
    ("MIT", ("mit-grant", "mit-notice", "mit-warranty")),
    ("MIT", ("mit-grant", "mit-notice")),
    ("MIT", ("mit-short",)),
    ("GPL-2.0-or-later", ("gpl2-free",)),
    ("LGPL-2.1-or-later", ("lgpl21-free",)),
    ("LGPL-3.0-or-later", ("lgpl3-free",)),
    ("AGPL-3.0-or-later", ("agpl3-free",)),
    ("ISC", ("isc-grant",)),
    ("Unlicense", ("unlicense-grant",)),
    ("GPL-3.0-or-later", ("gpl-free", "gpl-hope", "gpl-copy")),
    ("GPL-3.0-or-later", ("gpl-free",)),
    ("GPL-3.0", ("gpl3-short",)),
    ("BSD-3-Clause", ("bsd-redistribute", "bsd-source", "bsd-binary", "bsd-names")),
    ("BSD-2-Clause", ("bsd-redistribute", "bsd-source", "bsd-binary")),
    ("BSD-2-Clause", ("bsd-redistribute", "bsd-source")),
    ("CC-BY-NC-4.0", ("cc-by-nc4-short",)),
    ("CC-BY-SA-4.0", ("cc-by-sa4-short",)),
    ("CC-BY-4.0", ("cc-by4-short",)),
    ("CC0-1.0", ("cc0-short",)),
    ("MPL-2.0", ("mpl2",)),
    ("MIT", ("mit-name",)),
    ("MIT", ("mit-title",)),
    ("Apache-2.0", ("apache2-title",)),
    ("GPL-3.0", ("gpl3-title",)),
    ("GPL-2.0", ("gpl2-title",)),
    ("BSD-2-Clause", ("bsd2-title",)),
    ("BSD-3-Clause", ("bsd3-title",)),
    ("ISC", ("isc-title",)),
    ("proprietary", ("rights",)),
]


def _with_short_forms() -> None:
    """Adds the short grants (verb and name) that the table does not have word for word, the
    identifier lines, and their rules: before all others, for they name the licence outright."""
    have = {text for _, text in SENTENCES}
    first, last = [], []
    for k, (licence, name) in enumerate(NAMES):
        for verb in VERBS:
            if (text := f"{verb} under {name}") not in have:
                SENTENCES.append((f"grant-{verb}-{k}", text))
                last.append((licence, (f"grant-{verb}-{k}",)))
    for ident in IDENTIFIERS:
        key = "spdx-" + ident.lower()
        SENTENCES.append((key, "spdx license identifier " + re.sub("[^a-z0-9]+", " ", ident.lower())))
        first.append((ident, (key,)))
    RULES[:0] = first
    RULES[-1:-1] = last


_with_short_forms()
#: A sentence ends at . ! or ? before white space, a clause at ; or : before it.
SENTENCE_END = r"[.!?](?=[\x20\x09-\x0D])"
CLAUSE_END = r"[;:](?=[\x20\x09-\x0D])|\n"


def marked(text: Column) -> Column:
    """Lower case, with E for sentence ends and L for the ends of lines and clauses (and of the
    text); runs of characters other than ASCII letters and digits are one space or mark."""
    out = F.regexp_replace(F.regexp_replace(F.lower(text), SENTENCE_END, "E"), CLAUSE_END, "L")
    out = F.concat(F.lit("L"), F.regexp_replace(out, "[^a-z0-9EL]+", " "), F.lit("L"))
    return F.regexp_replace(F.regexp_replace(out, " ?L[ L]*", "L"), "[ L]?E[ EL]*", "E")


def plain(wording: str) -> str:
    """A wording of the table without marks."""
    return re.sub("[^a-z0-9]+", " ", wording.lower()).strip()


def _pattern(wording: str) -> str:
    """Matches the wording in a marked text."""
    sentences = re.split(SENTENCE_END, wording)
    return "[ LE]".join(plain(s).replace(" ", "[ L]") for s in sentences if plain(s))


#: What may stand before a short grant.
_SUBJECT = "this (?:" + "|".join(SUBJECTS) + ") is "


def identified(docs: DataFrame, text_col: str = "text", sentences=SENTENCES, rules=RULES) -> tuple[DataFrame, str]:
    """``docs`` plus a struct (its name is returned too): sentences (identifiers in text order),
    licence (of the first rule that matches, else null) and rule (its number from 1, 0 if none).

    Null and empty texts have no sentences. A wording counts as often as it occurs. The tables
    are part of the expression; their size is fixed."""
    name = common.fresh(docs.columns, "_licence")
    table = F.create_map(*[F.lit(x) for ident, text in sentences for x in (plain(text), ident)])
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    # A wording cannot be there without its longest word: other texts are not normalised.
    rare = sorted({max(plain(t).split(" "), key=len) for _, t in sentences})
    any_word = F.lower(text).rlike("|".join(rare))
    longest_first = sorted((t for _, t in sentences), key=lambda t: -len(plain(t)))
    wording = f"[LE](?:{_SUBJECT.replace(' ', '[ L]')})?(?:{'|'.join(map(_pattern, longest_first))})(?=[LE])"

    def ident(s: Column) -> Column:
        words = F.trim(F.translate(s, "LE", "  "))
        bare = F.regexp_replace(words, f"^{_SUBJECT}(?=(?:{'|'.join(VERBS)}) under )", "")
        return F.coalesce(F.element_at(table, words), F.element_at(table, bare))

    # A subject belongs to short grants alone: what else it stands before is no known sentence.
    found = F.filter(F.transform(F.regexp_extract_all(marked(text), F.lit(wording), F.lit(0)), ident), lambda x: x.isNotNull())
    rows = docs.withColumn(name, F.when(any_word, found).otherwise(F.array().cast("array<string>")))
    sequence = F.concat(F.lit("|"), F.array_join(name, "|"), F.lit("|"))
    which, number = None, None
    for i, (licence, idents) in enumerate(rules, 1):
        hit = sequence.contains("|" + "|".join(idents) + "|")
        which = F.when(hit, licence) if which is None else which.when(hit, licence)
        number = F.when(hit, i) if number is None else number.when(hit, i)
    return rows.withColumn(name, F.struct(F.col(name).alias("sentences"), which.alias("licence"),
                                            number.otherwise(0).alias("rule"))), name


def op9_license_scan(spark, sf_dir: str) -> DataFrame:
    """Every document with its licence sentences and the licence they amount to."""
    done, r = identified(common.read(spark, sf_dir, "documents").select("doc_id", "text"))
    return done.select("doc_id", F.size(F.col(r)["sentences"]).cast("long").alias("n_sentences"),
                       F.array_join(F.col(r)["sentences"], ",").alias("sentence_ids"),
                       F.col(r)["licence"].alias("licence"), F.col(r)["rule"].cast("long").alias("rule"))


def _sql() -> str:
    """The same marks and wordings; marks are doubled, since the pattern language has no look-ahead."""
    q = lambda s: "'" + s.replace("'", "''") + "'"
    keys, idents = ", ".join(q(plain(t)) for _, t in SENTENCES), ", ".join(q(i) for i, _ in SENTENCES)
    arm = lambda i, ids: f"WHEN contains(seq, {q('|' + '|'.join(ids) + '|')}) THEN "
    licence = " ".join(arm(i, ids) + q(name) for i, (name, ids) in enumerate(RULES, 1))
    number = " ".join(arm(i, ids) + str(i) for i, (name, ids) in enumerate(RULES, 1))
    longest = sorted((t for _, t in SENTENCES), key=lambda t: -len(plain(t)))
    wording = "|".join("(?: |LL|EE)".join(plain(p).replace(" ", "(?: |LL)") for p in re.split(SENTENCE_END, t) if plain(p)) for t in longest)
    subject = _SUBJECT.replace(" ", "(?: |LL)")
    space = r"[\x20\x09-\x0D]"
    return rf"""
WITH a AS (SELECT row_number() OVER () AS r, doc_id, lower(coalesce(text, '')) AS t FROM documents),
b AS (SELECT r, doc_id, regexp_replace(regexp_replace(regexp_replace(t, '[.!?]({space})', 'E\1', 'g'), '[;:]({space})', 'L\1', 'g'), '\n', 'L', 'g') AS t FROM a),
c AS (SELECT r, doc_id, 'L' || regexp_replace(t, '[^a-z0-9EL]+', ' ', 'g') || 'L' AS t FROM b),
m AS (SELECT r, doc_id, regexp_replace(regexp_replace(t, ' ?L[ L]*', 'L', 'g'), '[ L]?E[ EL]*', 'E', 'g') AS t FROM c),
f AS (SELECT r, doc_id, list_filter(list_transform(list_transform(regexp_extract_all(replace(replace(t, 'L', 'LL'), 'E', 'EE'), '[LE](?:{subject})?(?:{wording})[LE]'),
    lambda s: trim(regexp_replace(translate(s, 'LE', '  '), ' +', ' ', 'g'))),
    lambda s: coalesce([{idents}][list_position([{keys}], s)],
                       [{idents}][list_position([{keys}], regexp_replace(s, '^{_SUBJECT}((?:{'|'.join(VERBS)}) under )', '\1'))])), lambda s: s IS NOT NULL) AS ids FROM m),
j AS (SELECT doc_id, ids, '|' || array_to_string(ids, '|') || '|' AS seq FROM f)
SELECT doc_id, CAST(len(ids) AS BIGINT) AS n_sentences, array_to_string(ids, ',') AS sentence_ids, CASE {licence} END AS licence,
    CAST(CASE {number} ELSE 0 END AS BIGINT) AS rule FROM j"""


SQL = {"op9_license_scan": _sql()}
