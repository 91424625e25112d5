"""Licence scans by sentence rules.

A text is cut into sentences, each is normalised (lower case, runs of other characters than letters, digits and dots
inside numbers become one space) and mapped to the identifier of a known licence sentence. The identifiers of a
document, in order, are matched against rules: a rule names a licence and the sentences that must follow one
another, other sentences in between allowed. A rule whose sentences all lie in a longer rule that also matched is left
out. Lines are sentences of their own in the first reading; in the second, line ends count as spaces, so that licence
text with hard line ends is recognised too. The third reads paragraphs: comment signs before a line are left out, blank
lines and the lines around a copyright notice end a sentence, other line ends count as spaces, and an address begins a
sentence. So a title and a copyright line do not run into a wrapped grant.

Everything happens inside the row of a document, as column expressions: nothing is shuffled, and only texts with one of
the words in ``HINT``, one of which every known sentence has, are cut up at all.

Defined results: null and empty texts have no licence; documents without one are not returned; every row is scanned for
itself, so repeated rows give repeated results; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnlake.llm.common import let

#: Known licence sentences, normalised, by identifier; cut where ``sentences`` cuts the published text.
SENTENCES = {
    "mit-released": "released under the mit license",
    "mit-licensed": "licensed under the mit license",
    "mit-title": "the mit license",
    "mit-grant": "permission is hereby granted free of charge to any person obtaining a copy of this software and "
                 "associated documentation files the software to deal in the software without restriction including "
                 "without limitation the rights to use copy modify merge publish distribute sublicense and or sell "
                 "copies of the software and to permit persons to whom the software is furnished to do so subject to "
                 "the following conditions",
    "mit-notice": "the above copyright notice and this permission notice shall be included in all copies or "
                  "substantial portions of the software",
    "asis-software": "the software is provided as is without warranty of any kind express or implied including but "
                     "not limited to the warranties of merchantability fitness for a particular purpose and "
                     "noninfringement",
    "apache-licensed": "licensed under the apache license version 2.0",
    "apache-grant": "licensed under the apache license version 2.0 the license",
    "apache-use": "you may not use this file except in compliance with the license",
    "apache-copy": "you may obtain a copy of the license at",
    "gpl3-licensed": "this work is licensed under the gnu general public license version 3",
    "gpl-free": "this program is free software",
    "gpl3-or-later": "you can redistribute it and or modify it under the terms of the gnu general public license as "
                     "published by the free software foundation either version 3 of the license or at your option any "
                     "later version",
    "gpl-warranty": "this program is distributed in the hope that it will be useful but without any warranty",
    "gpl-implied": "without even the implied warranty of merchantability or fitness for a particular purpose",
    "ccbync4-licensed": "licensed under cc by nc 4.0",
    "ccby4-licensed": "licensed under cc by 4.0",
    "ccbysa4-licensed": "licensed under cc by sa 4.0",
    "bsd-redistribution": "redistribution and use in source and binary forms with or without modification are "
                          "permitted provided that the following conditions are met",
    "bsd-endorsement": "neither the name of the copyright holder nor the names of its contributors may be used to "
                       "endorse or promote products derived from this software without specific prior written "
                       "permission",
    "reserved": "all rights reserved",
}
#: Rule, licence, sentences in order.
RULES = (
    ("mit-short", "MIT", ("mit-released",)),
    ("mit-short-licensed", "MIT", ("mit-licensed",)),
    ("mit-full", "MIT", ("mit-grant", "mit-notice")),
    ("mit-full-titled", "MIT", ("mit-title", "mit-grant", "mit-notice", "asis-software")),
    ("apache-short", "Apache-2.0", ("apache-licensed",)),
    ("apache-header", "Apache-2.0", ("apache-grant", "apache-use", "apache-copy")),
    ("gpl3-short", "GPL-3.0-only", ("gpl3-licensed",)),
    ("gpl3-header", "GPL-3.0-or-later", ("gpl-free", "gpl3-or-later", "gpl-warranty", "gpl-implied")),
    ("cc-by-nc-short", "CC-BY-NC-4.0", ("ccbync4-licensed",)),
    ("cc-by-short", "CC-BY-4.0", ("ccby4-licensed",)),
    ("cc-by-sa-short", "CC-BY-SA-4.0", ("ccbysa4-licensed",)),
    ("bsd-2", "BSD-2-Clause", ("bsd-redistribution",)),
    ("bsd-3", "BSD-3-Clause", ("bsd-redistribution", "bsd-endorsement")),
    ("reserved", "Proprietary", ("reserved",)),
)


#: Every known sentence contains one of these.
HINT = r"(?i)licen[cs]|permission|copyright|redistribut|rights|warrant|free software"


#: Stands for a dot between digits while other signs become spaces.
DOT = "\uE000"


def normalised(sentence: Column) -> Column:
    """Lower case; a dot stays only between digits; every other run that is not a letter or digit is one space."""
    lower = F.regexp_replace(F.replace(F.lower(sentence), F.lit(DOT), F.lit(" ")), r"([0-9])\.([0-9])", f"$1{DOT}$2")
    return F.btrim(F.replace(F.regexp_replace(lower, r"[^\p{L}\p{N}" + DOT + "]+", F.lit(" ")), F.lit(DOT), F.lit(".")))


def sentences(text: Column) -> Column:
    """Sentences end after . ! ? : ; or a comma-free line end."""
    return F.split(F.regexp_replace(text, r"([.!?:;])\s+", "$1\n"), "\n")


def paragraphs(text: Column) -> Column:
    """The third reading: only blank lines, copyright lines and addresses keep a line end."""
    lines = F.regexp_replace(F.regexp_replace(text, r"\r\n?", "\n"), r"(^|\n)[^\p{L}\p{N}\n]+", "$1")
    notices = F.regexp_replace(lines, r"(?im)^(copyright\s*(?:\(c\)|[©0-9<\[]).*)$", "\n$1\n")
    return F.regexp_replace(F.regexp_replace(notices, r"(?<!\n)\n(?!\n)", " "), r"\s(?=https?://)", "\n")


def _matches(ids: Column, wanted: tuple[str, ...]) -> Column:
    """Whether the wanted identifiers occur in this order: a fold that steps on when the next one is met."""
    order = F.array(*[F.lit(w) for w in wanted])
    met = F.aggregate(ids, F.lit(0), lambda at, x: F.when(F.get(order, at) == x, at + 1).otherwise(at))
    return met == len(wanted)


def matched_rules(text: Column) -> Column:
    """Names of the rules that a text matches, the longest ones only."""
    known = F.create_map(*[F.lit(x) for k, v in SENTENCES.items() for x in (v, k)])

    def rules(reading: Column) -> Column:
        ids = F.array_compact(F.transform(sentences(reading), lambda x: F.try_element_at(known, normalised(x))))
        return let(ids, lambda i: F.array_compact(F.array(*[F.when(_matches(i, s), F.lit(r)) for r, _, s in RULES])))

    longer = F.create_map(*[x for r, _, s in RULES for x in (F.lit(r), F.array(
        *[F.lit(o) for o, _, t in RULES if o != r and set(s) < set(t)]).cast("array<string>"))])
    both = F.array_distinct(F.concat(
        rules(text), rules(F.regexp_replace(text, "\n", " ")), rules(paragraphs(text))))
    longest = let(both, lambda m: F.filter(m, lambda r: ~F.arrays_overlap(F.element_at(longer, r), m)))
    return F.when(text.rlike(HINT), longest).otherwise(F.array().cast("array<string>"))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, rule, license, n_sentences: one row for each rule that a document's sentences match."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    each = docs.select(F.col(f"`{id_col}`").alias("id"), F.explode(matched_rules(text)).alias("rule"))
    names = F.create_map(*[F.lit(x) for r, n, _ in RULES for x in (r, n)])
    sizes = F.create_map(*[F.lit(x) for r, _, s in RULES for x in (r, len(s))])
    return each.select(F.col("id").alias(id_col), "rule", F.element_at(names, F.col("rule")).alias("license"),
                       F.element_at(sizes, F.col("rule")).alias("n_sentences"))
