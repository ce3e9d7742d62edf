"""Licence scan by sentence rules, in DataFrame functions only.

A text is normalised (lower case, comment leaders and quotes dropped, white space folded)
and cut into sentences.  A sentence that matches a known pattern becomes that sentence's
identifier; the others that speak of licensing become ``unknown``.  The document's
identifier sequence is matched against rules in order: the first rule whose sequence occurs
takes its identifiers away, so a specific licence is not reported again as a general one.
An SPDX expression is taken apart: each operand of its ORs and ANDs has an identifier, and
exceptions after WITH are left out.  A sentence that denies a licence names none, and reserved
rights count only in texts without a licence.

Every document gives one row.  Null, empty and licence-free texts have no sentences and no
licences.  Repeated rows give equal rows; order of sentences is that of the text.  Only the
key and text are read, so other columns cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The GNU file notices: who published the licence, and the version's number and its end.
_GNU = r"general public license,? as published by the free software foundation[;:,]? (either )?version "
_LATER = r"( of the license)?[;,]? or (\(?at your option\)?,? )?any later version"

#: SPDX: licence and the identifiers that name it, in lower case.  Fixed values.
SPDX: list[tuple[str, tuple[str, ...]]] = [
    ("0BSD", ("0bsd",)),
    ("AGPL-3.0", ("agpl-3.0", "agpl-3.0-only")),
    ("AGPL-3.0-or-later", ("agpl-3.0+", "agpl-3.0-or-later")),
    ("Apache-2.0", ("apache-2.0",)),
    ("Artistic-2.0", ("artistic-2.0",)),
    ("BSD-2-Clause", ("bsd-2-clause",)),
    ("BSD-3-Clause", ("bsd-3-clause",)),
    ("BSL-1.0", ("bsl-1.0",)),
    ("CC-BY", ("cc-by-3.0", "cc-by-4.0")),
    ("CC-BY-NC", ("cc-by-nc-3.0", "cc-by-nc-4.0")),
    ("CC-BY-NC-ND", ("cc-by-nc-nd-3.0", "cc-by-nc-nd-4.0")),
    ("CC-BY-NC-SA", ("cc-by-nc-sa-3.0", "cc-by-nc-sa-4.0")),
    ("CC-BY-ND", ("cc-by-nd-3.0", "cc-by-nd-4.0")),
    ("CC-BY-SA", ("cc-by-sa-3.0", "cc-by-sa-4.0")),
    ("CC0-1.0", ("cc0-1.0",)),
    ("CDDL-1.0", ("cddl-1.0",)),
    ("EPL-1.0", ("epl-1.0",)),
    ("EPL-2.0", ("epl-2.0",)),
    ("EUPL-1.2", ("eupl-1.2",)),
    ("GPL-1.0-or-later", ("gpl-1.0+", "gpl-1.0-or-later")),
    ("GPL-2.0", ("gpl-2.0", "gpl-2.0-only")),
    ("GPL-2.0-or-later", ("gpl-2.0+", "gpl-2.0-or-later")),
    ("GPL-3.0", ("gpl-3.0", "gpl-3.0-only")),
    ("GPL-3.0-or-later", ("gpl-3.0+", "gpl-3.0-or-later")),
    ("ISC", ("isc",)),
    ("LGPL-2.0", ("lgpl-2.0", "lgpl-2.0-only")),
    ("LGPL-2.0-or-later", ("lgpl-2.0+", "lgpl-2.0-or-later")),
    ("LGPL-2.1", ("lgpl-2.1", "lgpl-2.1-only")),
    ("LGPL-2.1-or-later", ("lgpl-2.1+", "lgpl-2.1-or-later")),
    ("LGPL-3.0", ("lgpl-3.0", "lgpl-3.0-only")),
    ("LGPL-3.0-or-later", ("lgpl-3.0+", "lgpl-3.0-or-later")),
    ("MIT", ("mit",)),
    ("MIT-0", ("mit-0",)),
    ("MPL-1.1", ("mpl-1.1",)),
    ("MPL-2.0", ("mpl-2.0",)),
    ("Unlicense", ("unlicense",)),
    ("Zlib", ("zlib",)),
]
#: Leads the pseudo-sentence of one operand of an SPDX expression.
SPDX_LEAD = "spdx:"
SPDX_SENTENCES = [(f"spdx_{ids[0]}", "^" + SPDX_LEAD + "(" + "|".join(i.replace(".", r"\.").replace("+", r"\+")
                                                                     for i in ids) + ")$") for _, ids in SPDX]

#: Known licence sentences: identifier and a pattern on the normalised sentence.  Fixed
#: values: the wording of the public licences' own notices.  The first match counts.
SENTENCES: list[tuple[str, str]] = SPDX_SENTENCES + [
    ("spdx_other", "^" + SPDX_LEAD),
    ("denied", r"\b(not|never|no longer) (released|licensed|distributed|available|covered) (under|by)"),
    ("apache_2_notice", r"licensed under the apache license,? version 2(\.0)?"),
    ("apache_compliance", r"may not use this file except in compliance with the license"),
    ("apache_copy", r"may obtain a copy of the license at"),
    ("apache_as_is", r"distributed under the license is distributed on an as is basis"),
    ("mit_notice", r"(released|licensed|distributed|available) under the (terms of the )?(mit|expat) license"),
    ("mit_grant", r"permission is hereby granted, free of charge, to any person obtaining a copy"),
    ("mit_condition", r"above copyright notice and this permission notice shall be included"),
    ("as_is_warranty", r"the software is provided as is,? without warranty of any kind"),
    ("agpl_3_notice", r"(gnu )?affero general public license,? (version|v) ?3"),
    ("lgpl_3_notice", r"(gnu )?lesser general public license,? (version|v) ?3"),
    ("lgpl_21_notice", r"(gnu )?lesser general public license,? (version|v) ?2\.1"),
    ("lgpl_2_notice", r"library general public license,? (version|v) ?2"),
    ("gpl_3_notice", r"(gnu )?general public license,? (version|v) ?3"),
    ("gpl_2_notice", r"(gnu )?general public license,? (version|v) ?2"),
    ("agpl_3_published_later", r"affero " + _GNU + r"3(\.0)?" + _LATER),
    ("agpl_3_published", r"affero " + _GNU + r"3"),
    ("lgpl_3_published_later", r"(lesser|library) " + _GNU + r"3(\.0)?" + _LATER),
    ("lgpl_3_published", r"(lesser|library) " + _GNU + r"3"),
    ("lgpl_21_published_later", r"(lesser|library) " + _GNU + r"2\.1" + _LATER),
    ("lgpl_21_published", r"(lesser|library) " + _GNU + r"2\.1"),
    ("lgpl_2_published_later", r"(lesser|library) " + _GNU + r"2(\.0)?" + _LATER),
    ("lgpl_2_published", r"(lesser|library) " + _GNU + r"2"),
    ("gpl_3_published_later", r"(gnu|the) " + _GNU + r"3(\.0)?" + _LATER),
    ("gpl_3_published", r"(gnu|the) " + _GNU + r"3"),
    ("gpl_2_published_later", r"(gnu|the) " + _GNU + r"2(\.0)?" + _LATER),
    ("gpl_2_published", r"(gnu|the) " + _GNU + r"2"),
    ("gpl_1_published_later", r"(gnu|the) " + _GNU + r"1(\.0)?" + _LATER),
    ("gpl_free_software", r"free software[;:,] you can redistribute it and/or modify it"),
    ("gpl_no_warranty", r"distributed in the hope that it will be useful,? but without any warranty"),
    ("gpl_details", r"see the (gnu )?(lesser |library |affero )?general public license for more details"),
    ("gpl_received", r"should have received a copy of the gnu (lesser |library |affero )?general public license"),
    ("gpl_address", r"if not,? (see <?https?://www\.gnu\.org/licenses|write to the free software foundation)"),
    ("bsd_grant", r"redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("bsd_source", r"redistributions of source code must retain the above copyright notice"),
    ("bsd_binary", r"redistributions in binary form must reproduce the above copyright notice"),
    ("bsd_endorse", r"neither the name of .* may be used to endorse or promote"),
    ("bsd_warranty", r"this software is provided by .* as is and any express or implied warranties"),
    ("mpl_2_notice", r"mozilla public license,? (version|v)([. ]*2\.0|\.$)"),
    ("epl_2_notice", r"eclipse public license( -)?,? ?(version|v\.?)? ?2"),
    ("epl_1_notice", r"eclipse public license( -)?,? ?(version|v\.?)? ?1"),
    ("isc_grant", r"permission to use, copy, modify, and/?(or)? distribute this software for any purpose"),
    ("unlicense", r"free and unencumbered software released into the public domain"),
    ("cc0_notice", r"\b(cc0|creative commons zero)\b"),
    ("cc_by_nc_nd", r"(cc[ -]by-nc-nd|attribution-noncommercial-noderivatives)"),
    ("cc_by_nc_sa", r"(cc[ -]by-nc-sa|attribution-noncommercial-sharealike)"),
    ("cc_by_nc", r"(cc[ -]by-nc|attribution-noncommercial)"),
    ("cc_by_sa", r"(cc[ -]by-sa|attribution-sharealike)"),
    ("cc_by_nd", r"(cc[ -]by-nd|attribution-noderivatives)"),
    ("cc_by", r"(cc[ -]by\b|creative commons attribution)"),
    ("all_rights_reserved", r"all rights reserved"),
    ("copyright", r"(copyright|\(c\)|©) .*\d{4}"),
]

#: What follows the notice in the published headers.
_TERMS = ("gpl_no_warranty", "gpl_details", "gpl_received")

#: Licence rules in order: licence and the identifiers that state it, in sequence.
RULES: list[tuple[str, tuple[str, ...]]] = [(name, (f"spdx_{ids[0]}",)) for name, ids in SPDX] + [
    ("Apache-2.0", ("apache_2_notice", "apache_copy", "apache_as_is")),
    ("Apache-2.0", ("apache_2_notice", "apache_copy")),
    ("Apache-2.0", ("apache_2_notice",)),
    ("MIT", ("mit_grant", "mit_condition", "as_is_warranty")),
    ("MIT", ("mit_notice",)),
    ("MIT", ("mit_grant",)),
    ("AGPL-3.0-or-later", ("agpl_3_published_later", *_TERMS, "gpl_address")),
    ("AGPL-3.0-or-later", ("agpl_3_published_later", *_TERMS)),
    ("AGPL-3.0-or-later", ("agpl_3_published_later",)),
    ("AGPL-3.0", ("agpl_3_published", *_TERMS, "gpl_address")),
    ("AGPL-3.0", ("agpl_3_published", *_TERMS)),
    ("AGPL-3.0", ("agpl_3_published",)),
    ("LGPL-3.0-or-later", ("lgpl_3_published_later", *_TERMS, "gpl_address")),
    ("LGPL-3.0-or-later", ("lgpl_3_published_later", *_TERMS)),
    ("LGPL-3.0-or-later", ("lgpl_3_published_later",)),
    ("LGPL-3.0", ("lgpl_3_published", *_TERMS, "gpl_address")),
    ("LGPL-3.0", ("lgpl_3_published", *_TERMS)),
    ("LGPL-3.0", ("lgpl_3_published",)),
    ("LGPL-2.1-or-later", ("lgpl_21_published_later", *_TERMS, "gpl_address")),
    ("LGPL-2.1-or-later", ("lgpl_21_published_later", *_TERMS)),
    ("LGPL-2.1-or-later", ("lgpl_21_published_later",)),
    ("LGPL-2.1", ("lgpl_21_published", *_TERMS, "gpl_address")),
    ("LGPL-2.1", ("lgpl_21_published", *_TERMS)),
    ("LGPL-2.1", ("lgpl_21_published",)),
    ("LGPL-2.0-or-later", ("lgpl_2_published_later", *_TERMS, "gpl_address")),
    ("LGPL-2.0-or-later", ("lgpl_2_published_later", *_TERMS)),
    ("LGPL-2.0-or-later", ("lgpl_2_published_later",)),
    ("LGPL-2.0", ("lgpl_2_published", *_TERMS, "gpl_address")),
    ("LGPL-2.0", ("lgpl_2_published", *_TERMS)),
    ("LGPL-2.0", ("lgpl_2_published",)),
    ("GPL-3.0-or-later", ("gpl_3_published_later", *_TERMS, "gpl_address")),
    ("GPL-3.0-or-later", ("gpl_3_published_later", *_TERMS)),
    ("GPL-3.0-or-later", ("gpl_3_published_later",)),
    ("GPL-3.0", ("gpl_3_published", *_TERMS, "gpl_address")),
    ("GPL-3.0", ("gpl_3_published", *_TERMS)),
    ("GPL-3.0", ("gpl_3_published",)),
    ("GPL-2.0-or-later", ("gpl_2_published_later", *_TERMS, "gpl_address")),
    ("GPL-2.0-or-later", ("gpl_2_published_later", *_TERMS)),
    ("GPL-2.0-or-later", ("gpl_2_published_later",)),
    ("GPL-2.0", ("gpl_2_published", *_TERMS, "gpl_address")),
    ("GPL-2.0", ("gpl_2_published", *_TERMS)),
    ("GPL-2.0", ("gpl_2_published",)),
    ("GPL-1.0-or-later", ("gpl_1_published_later", *_TERMS, "gpl_address")),
    ("GPL-1.0-or-later", ("gpl_1_published_later", *_TERMS)),
    ("GPL-1.0-or-later", ("gpl_1_published_later",)),
    ("AGPL-3.0", ("agpl_3_notice",)),
    ("LGPL-3.0", ("lgpl_3_notice",)),
    ("LGPL-2.1", ("lgpl_21_notice",)),
    ("LGPL-2.0", ("lgpl_2_notice",)),
    ("GPL-3.0-or-later", ("gpl_free_software", "gpl_3_notice", "gpl_no_warranty", "gpl_received")),
    ("GPL-3.0", ("gpl_3_notice",)),
    ("GPL-2.0", ("gpl_2_notice",)),
    ("BSD-3-Clause", ("bsd_grant", "bsd_source", "bsd_binary", "bsd_endorse", "bsd_warranty")),
    ("BSD-3-Clause", ("bsd_grant", "bsd_source", "bsd_binary", "bsd_endorse")),
    ("BSD-2-Clause", ("bsd_grant", "bsd_source", "bsd_binary")),
    ("MPL-2.0", ("mpl_2_notice",)),
    ("EPL-2.0", ("epl_2_notice",)),
    ("EPL-1.0", ("epl_1_notice",)),
    ("ISC", ("isc_grant",)),
    ("Unlicense", ("unlicense",)),
    ("CC0-1.0", ("cc0_notice",)),
    ("CC-BY-NC-ND", ("cc_by_nc_nd",)),
    ("CC-BY-NC-SA", ("cc_by_nc_sa",)),
    ("CC-BY-NC", ("cc_by_nc",)),
    ("CC-BY-SA", ("cc_by_sa",)),
    ("CC-BY-ND", ("cc_by_nd",)),
    ("CC-BY", ("cc_by",)),
    ("Proprietary", ("copyright", "all_rights_reserved")),
    ("Proprietary", ("all_rights_reserved",)),
]
#: A licence that is reported only where no other was found: licensed texts reserve rights too.
LAST = "Proprietary"

UNKNOWN = "unknown"
#: What a sentence must contain to be looked at.
HINT = (r"licen[sc]e|copyright|\(c\)|©|permission|warrant|redistribut|rights reserved|spdx|"
        r"free software|public domain|creative commons|cc0|cc[ -]by|attribution-")
#: Comment leaders at line starts, then quotes, then white space (ASCII only, as engines
#: differ on the rest).
LEADER = r"(^|\n)[ \t]*(//+|/?\*+/?|#+|--+|;+|%+|\|)[ \t]*"
QUOTES = r"[\"'`“”]"
SPACE = r"[ \t\r\f\n]+"
#: A sentence ends after . ! ? before white space, or at a line's end before a line that
#: starts a notice; version numbers have no space after their point.
LINE_BREAK = r"\n[ \t]*\n|([.!?])[ \t\r]*\n|([.!?])[ \t]+"
MARK = "\u0001"


#: An SPDX expression up to its last operand; exceptions change no licence's name.
EXPRESSION = (r"spdx-license-identifier: ?(\(* ?[a-z0-9][a-z0-9.+-]*\)*"
              r"( (or|and|with) \(* ?[a-z0-9][a-z0-9.+-]*\)*)*)")
EXCEPTION = r" with [a-z0-9.+-]+"
BRACKETS = r"[() ]|\.( |$)"


def operands(sentence: Column) -> Column:
    """An SPDX sentence as one pseudo-sentence per operand, any other as itself."""
    expression = F.regexp_replace(F.regexp_extract(sentence, EXPRESSION, 1), EXCEPTION, "")
    named = F.transform(F.split(expression, " (or|and) "),
                        lambda o: F.concat(F.lit(SPDX_LEAD), F.regexp_replace(o, BRACKETS, "")))
    return F.when(sentence.rlike(EXPRESSION), named).otherwise(F.array(sentence))


def normalised(text: Column) -> Column:
    plain = F.regexp_replace(F.lower(text), LEADER, "$1")
    marked = F.regexp_replace(F.regexp_replace(plain, QUOTES, ""), LINE_BREAK, "$1$2" + MARK)
    return F.regexp_replace(marked, SPACE, " ")


def identifier(sentence: Column) -> Column:
    out = None
    for name, pattern in SENTENCES:
        hit = sentence.rlike(pattern)
        out = F.when(hit, F.lit(name)) if out is None else out.when(hit, F.lit(name))
    return out.otherwise(F.lit(UNKNOWN))


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, sentences, identifiers, licences): what licence texts say, one row per document."""
    own = F.col(text)
    spoken = F.when(F.lower(own).rlike(HINT), F.filter(
        F.split(normalised(own), MARK), lambda s: s.rlike(HINT)))
    rows = docs.select(F.col(key).alias(key), F.coalesce(
        spoken, F.array().cast("array<string>")).alias("sentences"))
    rows = rows.withColumn("identifiers", F.transform(F.flatten(F.transform("sentences", operands)), identifier))
    rules = F.array(*[F.struct(F.lit(name).alias("licence"),
                               F.lit("|" + "|".join(ids) + "|").alias("ids"))
                      for name, ids in RULES])
    # identifiers stand between bars, each with bars of its own, so sequences are substrings
    chain = F.concat(F.lit("|"), F.array_join("identifiers", "|"), F.lit("|"))
    empty = F.struct(chain.alias("left"), F.array().cast("array<string>").alias("found"))

    def apply_rule(state: Column, rule: Column) -> Column:
        taken = F.struct(
            F.replace(state["left"], rule["ids"], F.lit("||")).alias("left"),
            F.array_union(state["found"], F.array(rule["licence"])).alias("found"))
        return F.when(F.contains(state["left"], rule["ids"]), taken).otherwise(state)

    found = F.aggregate(rules, empty, apply_rule)["found"]
    matched = F.when(F.size(found) > 1, F.array_remove(found, LAST)).otherwise(found)
    return rows.withColumn("licences", F.when(F.size("identifiers") > 0, matched)
                           .otherwise(F.array().cast("array<string>")))
