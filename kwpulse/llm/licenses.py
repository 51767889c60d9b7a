"""Licence scans: known licence sentences become identifiers, identifier sequences meet ordered rules."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Sentences of public licence texts and notices, each with its identifier.
SENTENCES = {
    "ApacheNotice": "Licensed under the Apache License, Version 2.0",
    "ApacheNoticeThe": 'Licensed under the Apache License, Version 2.0 (the "License")',
    "ApacheCompliance": "you may not use this file except in compliance with the License",
    "ApacheCopy": "You may obtain a copy of the License at",
    "AsIsApache": 'Unless required by applicable law or agreed to in writing, software distributed under the License is '
                  'distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied',
    "ApacheTitle": "Apache License",
    "ApacheVersion": "Version 2.0, January 2004",
    "MitNotice": "Released under the MIT License",
    "MitNoticeLicensed": "Licensed under the MIT License",
    "MitTitle": "MIT License",
    "MitTitleThe": "The MIT License",
    "MitGrant": 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated '
                'documentation files (the "Software"), to deal in the Software without restriction, including without '
                'limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of '
                'the Software, and to permit persons to whom the Software is furnished to do so, subject to the following '
                'conditions:',
    "MitKeep": "The above copyright notice and this permission notice shall be included in all copies or substantial "
               "portions of the Software",
    "Gpl2Notice": "This work is licensed under the GNU General Public License, version 2",
    "Gpl3Notice": "This work is licensed under the GNU General Public License, version 3",
    "GplTitle": "GNU GENERAL PUBLIC LICENSE",
    "GplVersion2": "Version 2, June 1991",
    "GplVersion3": "Version 3, 29 June 2007",
    "GplHead": "This program is free software",
    "GplFree3": "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
                "the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
    "GplTerms": "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
                "the Free Software Foundation",
    "GplAny2": "either version 2 of the License, or (at your option) any later version",
    "LgplTitle": "GNU LESSER GENERAL PUBLIC LICENSE",
    "LgplNotice": "This library is licensed under the GNU Lesser General Public License, version 3",
    "AgplTitle": "GNU AFFERO GENERAL PUBLIC LICENSE",
    "BsdGrant": "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
                "that the following conditions are met:",
    "BsdSource": "Redistributions of source code must retain the above copyright notice, this list of conditions and the "
                 "following disclaimer",
    "BsdBinary": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
                 "following disclaimer in the documentation and/or other materials provided with the distribution",
    "BsdEndorse": "Neither the name of {} nor the names of its contributors may be used to endorse or "
                  "promote products derived from this software without specific prior written permission",
    "BsdEndorseNames": "The names of its contributors may not be used to endorse or promote products derived from this "
                       "software without specific prior written permission",
    "BsdEndorseName": "The name of {} may not be used to endorse or promote products derived from this software without "
                      "specific prior written permission",
    # what an abbreviated holder ("Someone Inc.") leaves of these as a sentence
    "BsdEndorseTail": "nor the names of its contributors may be used to endorse or promote products derived from this software "
                      "without specific prior written permission",
    "BsdEndorseNameTail": "may not be used to endorse or promote products derived from this software without specific prior "
                          "written permission",
    "BsdEndorseNeither": "Neither the name of {} may be used to endorse or promote products derived from this software "
                         "without specific prior written permission",
    "IscGrant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
                "hereby granted, provided that the above copyright notice and this permission notice appear in all copies",
    "MplNotice": "This Source Code Form is subject to the terms of the Mozilla Public License, v",
    "CcByNc": "Licensed under CC BY-NC 4.0",
    "CcByNcSa": "Licensed under CC BY-NC-SA 4.0",
    "CcByNd": "Licensed under CC BY-ND 4.0",
    "CcBySa": "Licensed under CC BY-SA 4.0",
    "CcBy": "Licensed under CC BY 4.0",
    "CcZero": "Licensed under CC0 1.0",
    "Unlicense": "This is free and unencumbered software released into the public domain",
    "PublicDomain": "This work is in the public domain",
    "Reserved": "All rights reserved",
}

# Ordered: the first rules see the sequence whole, what a rule matches is taken out for the later ones.
RULES = (
    ("Apache-2.0", "(ApacheTitle ApacheVersion )?(ApacheNotice|ApacheNoticeThe) (ApacheCompliance )?(ApacheCopy )?(AsIsApache )?"),
    ("Apache-2.0", "ApacheTitle ApacheVersion "),
    ("MIT", "((MitTitle|MitTitleThe) )?MitGrant MitKeep "),
    ("MIT", "(MitNotice|MitNoticeLicensed) "),
    ("GPL-3.0", "GplTitle GplVersion3 |Gpl3Notice "),
    ("GPL-3.0-or-later", "(GplHead )?GplFree3 "),
    ("GPL-2.0", "GplTitle GplVersion2 |Gpl2Notice "),
    ("GPL-2.0-or-later", "(GplHead )?GplTerms GplAny2 "),
    ("LGPL-3.0", "LgplTitle GplVersion3 |LgplNotice "),
    ("AGPL-3.0", "AgplTitle GplVersion3 "),
    ("BSD-3-Clause", "(Reserved )?BsdGrant BsdSource BsdBinary BsdEndorse(Names|Name|Tail|NameTail|Neither)? "),
    ("BSD-2-Clause", "(Reserved )?BsdGrant BsdSource BsdBinary (?!BsdEndorse)"),
    ("ISC", "IscGrant "),
    ("MPL-2.0", "MplNotice "),
    ("CC-BY-NC-SA-4.0", "CcByNcSa "),
    ("CC-BY-NC-4.0", "CcByNc "),
    ("CC-BY-ND-4.0", "CcByNd "),
    ("CC-BY-SA-4.0", "CcBySa "),
    ("CC-BY-4.0", "CcBy "),
    ("CC0-1.0", "CcZero "),
    ("Unlicense", "Unlicense "),
    ("public-domain", "PublicDomain "),
    ("all-rights-reserved", "Reserved "),
)
UNMATCHED = "unknown"

# A sentence ends at . ! ? ; : before white space or the end, and at a line end, unless that follows a comma or the
# next line goes on in lower case, with a bracket or a quotation mark (wrapped licence texts).
_ENDS = r"[.!?;:]++(?=\s|$)|(?<![,\s])(?:\r\n|[\r\n])(?:(?=[ \t]*[\r\n])|(?![ \t*#/]{0,16}[a-z(\"]))"


def sentences(text):
    """An array column of normalised sentences (``_ENDS`` says where they end): lower case,
    every run of other characters than a-z and 0-9 one blank, ends trimmed."""
    cut = F.regexp_replace(F.coalesce(text, F.lit("")), _ENDS, "\x01")
    plain = F.regexp_replace(F.lower(cut), "[^a-z0-9\x01]+", " ")
    return F.transform(F.split(plain, "\x01"), lambda s: F.trim(s))


SLOT = "{}"  # in a known sentence: whatever a text has there, at least one word
_SLOT_WORD = "zslotz"  # what stands for a slot while a known sentence is normalised


def normal_sentences(spark, known: Mapping[str, str]) -> dict[str, list[str]]:
    """Identifier -> its normalised sentences, by the same functions as the texts; slots stay as ``SLOT``.

    Entries without a word, and two entries with one normal form, are errors."""
    if not known:
        return {}
    rows = spark.createDataFrame([(k, v.replace(SLOT, f" {_SLOT_WORD} ")) for k, v in known.items()], "id string, s string")
    out = {r["id"]: [x.replace(_SLOT_WORD, SLOT) for x in r["s"] if x] for r in rows.select("id", sentences(F.col("s")).alias("s")).collect()}
    seen: dict[tuple[str, ...], str] = {}
    for name in known:
        form = tuple(out[name])
        if not form:
            raise ValueError(f"the known sentence {name} has no words")
        if form in seen:
            raise ValueError(f"the known sentences {seen[form]} and {name} are the same")
        seen[form] = name
    return out


def _identified(found: Column, normal: Mapping[str, list[str]]) -> Column:
    """The array of the identifiers of known sentences, in the order of the text.

    Every sentence of any entry has a mark of its own; where an entry has several, they must follow one another in the
    text. Longer entries are looked for first."""
    marks: dict[str, str] = {}
    for parts in normal.values():
        for x in parts:
            marks.setdefault(x, f"S{len(marks)}")
    plain = {x: m for x, m in marks.items() if SLOT not in x}
    slotted = {x: m for x, m in marks.items() if SLOT in x}

    def mark(s: Column) -> Column:
        out = F.lit("-")  # an unknown sentence: it parts the sentences around it
        for x, m in slotted.items():
            head, tail = x.split(SLOT)[0], x.split(SLOT)[-1]
            pattern = "^" + ".+".join(x.split(SLOT)) + "$"  # normalised sentences hold letters, digits and blanks only
            out = F.when(F.startswith(s, F.lit(head)) & F.endswith(s, F.lit(tail)) & F.regexp_like(s, F.lit(pattern)), F.lit(m)).otherwise(out)
        if plain:
            table = F.create_map(*[F.lit(x) for kv in plain.items() for x in kv])
            out = F.when(s.isin(*plain), F.element_at(table, s)).otherwise(out)
        return out

    several = {name: parts for name, parts in normal.items() if len(parts) > 1}
    single = {marks[parts[0]]: name for name, parts in normal.items() if len(parts) == 1}
    seq = F.transform(found, mark)
    if several:  # a run of marks becomes the identifier; what is left of such sentences alone is unknown
        line = F.concat(F.array_join(seq, " "), F.lit(" "))
        for name, parts in sorted(several.items(), key=lambda kv: (-len(kv[1]), kv[0])):
            line = F.regexp_replace(line, "(?:^|(?<= ))" + " ".join(marks[x] for x in parts) + " ", f"={name} ")
        seq = F.filter(F.split(line, " "), lambda x: x != "")
    names = F.create_map(*[F.lit(x) for kv in single.items() for x in kv]) if single else None
    named = F.transform(seq, lambda x: F.when(F.startswith(x, F.lit("=")), F.substring(x, 2, 1 << 20)).otherwise(
        F.when(x.isin(*single), F.element_at(names, x)) if single else F.lit(None).cast("string")))
    return F.filter(named, lambda x: x.isNotNull())


def scan(docs: DataFrame, known: Mapping[str, str] = SENTENCES, rules: Sequence[tuple[str, str]] = RULES,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, ``n_sentences`` (not empty after normalisation), ``sequence`` (the
    identifiers of its known sentences, in order, joined by blanks), ``licenses`` (names in rule order,
    comma-joined; ``unknown`` last if known sentences are left that no rule takes).

    A known sentence is found where its normalised form is a whole sentence of the text; ``{}`` in it stands for
    any words (a holder's name), and one that normalises to several sentences is found where these follow one another. Identifiers
    are words of letters and digits; a rule is a regular expression over the sequence in which each
    identifier is followed by one blank and begins after a blank or the start. Rules apply in their
    order, each to what the earlier ones left. A null or empty text has no sentences and empty results.
    Whole texts of any length are read; repeated rows and other columns are left as they are (other
    columns are not returned). Everything happens in one row's expressions: no join and no shuffle, so
    no key can be hot; the table of known sentences is a literal of the plan, fixed by the caller.
    """
    normal = normal_sentences(docs.sparkSession, known)
    found = F.col("_s")
    seq = _identified(found, normal) if normal else F.array().cast("array<string>")
    out = (docs.select(F.col(id_col).alias("_id"), sentences(F.col(text_col)).alias("_s"))
           .select("_id", F.filter("_s", lambda s: s != "").alias("_s"))
           .select("_id", F.size("_s").cast("long").alias("n_sentences"), F.array_join(seq, " ").alias("sequence")))
    out = out.withColumn("_left", F.when(F.col("sequence") == "", "").otherwise(F.concat("sequence", F.lit(" "))))
    names = []
    for k, (name, rule) in enumerate(rules):
        pattern = rf"(?:^|(?<= ))(?:{rule})"
        hit = F.regexp_like("_left", F.lit(pattern))
        names.append(F.when(F.col("sequence") != "", F.when(F.col(f"_hit{k}"), F.lit(name))))
        out = out.withColumn(f"_hit{k}", hit).withColumn("_left", F.when(F.col(f"_hit{k}"), F.regexp_replace(
            "_left", pattern, "| ")).otherwise(F.col("_left")))
    rest = F.when(F.regexp_like("_left", F.lit("[A-Za-z0-9]")), F.lit(UNMATCHED))
    licenses = F.array_join(F.array_distinct(F.filter(F.array(*names, rest), lambda x: x.isNotNull())), ",")
    return out.select(F.col("_id").alias(id_col), "n_sentences", "sequence", licenses.alias("licenses"))
