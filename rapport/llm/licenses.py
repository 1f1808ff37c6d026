"""Licence recognition: sentences to identifiers, identifier sequences to licences."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Licence sentences as they read after ``normalised`` (lower case, one blank
# between words, no punctuation, "licence" spelt "license"). A sentence gets the identifiers
# of all patterns found in it; of those that overlap the first in this order counts.
SENTENCES: list[tuple[str, str]] = [
    # Tags name the license themselves; "spdx" is one with another name.
    ("agpl", r"\bspdx license identifier agpl 3 0\b"),
    ("lgpl_or_later", r"\bspdx license identifier lgpl [23] [01] or later\b"),
    ("lgpl", r"\bspdx license identifier lgpl [23] [01]\b"),
    ("gpl_or_later", r"\bspdx license identifier gpl [123] 0 or later\b"),
    ("gpl_3", r"\bspdx license identifier gpl 3 0\b"),
    ("gpl_2", r"\bspdx license identifier gpl 2 0\b"),
    ("apache_2", r"\bspdx license identifier apache 2 0\b"),
    ("mit", r"\bspdx license identifier mit\b"),
    ("bsd_3", r"\bspdx license identifier bsd 3 clause\b"),
    ("bsd_2", r"\bspdx license identifier bsd 2 clause\b"),
    ("isc", r"\bspdx license identifier isc\b"),
    ("mpl_2", r"\bspdx license identifier mpl 2 0\b"),
    ("epl", r"\bspdx license identifier epl [12] 0\b"),
    ("boost", r"\bspdx license identifier bsl 1 0\b"),
    ("zlib", r"\bspdx license identifier zlib\b"),
    ("unlicense", r"\bspdx license identifier unlicense\b"),
    ("cc0", r"\bspdx license identifier cc0 1 0\b"),
    ("spdx", r"\bspdx license identifier [a-z0-9]"),
    ("mit_grant", r"\bpermission is hereby granted free of charge to any person obtaining a copy\b"),
    ("mit_condition", r"\bthe above copyright notice and this permission notice (?:including the next paragraph )?shall be included in all\b"),
    ("mit_disclaimer", r"\bthe software is provided as is without warranty of any kind\b"),
    ("mit_liability", r"\bin no event shall the authors or copyright holders be liable for any claim\b"),
    ("bsd_grant", r"\bredistribution and use in source and binary forms with or without modification are permitted\b"),
    ("bsd_source", r"\bredistributions of source code must retain the above copyright notice\b"),
    ("bsd_binary", r"\bredistributions in binary form must reproduce the above copyright notice\b"),
    ("bsd_endorse", r"\bmay be used to endorse or promote products derived from this software without\b"),
    ("bsd_advertise", r"\ball advertising materials mentioning features or use of this software must display\b"),
    ("bsd_disclaimer", r"\bthis software is provided by .{1,80} as is and any express or implied warranties\b"),
    ("isc_grant", r"\bpermission to use copy modify and (?:or )?distribute this software for any purpose with or without fee\b"),
    ("isc_disclaimer", r"\bthe software is provided as is and .{1,80} disclaims? all warranties\b"),
    ("apache_terms", r"\byou may not use this file except in compliance with the license\b"),
    ("apache_copy", r"\byou may obtain a copy of the license at\b"),
    ("gpl_or_later", r"\bgnu general public license .{0,80}\bor at your option any later version\b"),
    ("lgpl_or_later", r"\bgnu (?:lesser|library) general public license .{0,80}\bor at your option any later version\b"),
    ("agpl", r"\bgnu affero general public license\b"),
    ("lgpl", r"\bgnu (?:lesser|library) general public license\b|\blgpl\b"),
    ("gpl_3", r"\bgnu general public license version 3\b|\bgpl ?v? ?3\b"),
    ("gpl_2", r"\bgnu general public license version 2\b|\bgpl ?v? ?2\b"),
    ("gpl", r"\bgnu general public license\b|\bgnu gpl\b"),
    ("apache_2", r"\bapache license (?:version )?2\b"),
    ("apache", r"\bapache license\b|\bapache software license\b"),
    ("mpl_2", r"\bmozilla public license (?:version |v )?2\b"),
    ("mpl", r"\bmozilla public license\b"),
    ("epl", r"\beclipse public license\b"),
    ("cc0", r"\bcc0\b|\bcreative commons zero\b"),
    ("cc_by_nc_sa", r"\b(?:cc by nc sa|attribution noncommercial sharealike)\b"),
    ("cc_by_nc_nd", r"\b(?:cc by nc nd|attribution noncommercial noderiv)"),
    ("cc_by_nc", r"\b(?:cc by nc|attribution noncommercial)\b"),
    ("cc_by_sa", r"\b(?:cc by sa|attribution sharealike)\b"),
    ("cc_by_nd", r"\b(?:cc by nd|attribution noderiv)"),
    # Without a version or a license near it "cc by" may be any words.
    ("cc_by", r"\bcc by (?:[1-4]\b|license\b)|\blicensed under (?:the |a )?cc by\b|\bcreative commons attribution\b"),
    ("boost", r"\bboost software license\b"),
    ("zlib", r"\bzlib license\b|\bzlib libpng license\b"),
    ("wtfpl", r"\bwtfpl\b|\bdo what the fuck you want to public license\b"),
    ("mit", r"\bmit license\b|\blicensed under (?:the )?mit\b"),
    ("bsd_3", r"\bbsd 3 clause\b|\b3 clause bsd\b"),
    ("bsd_2", r"\bbsd 2 clause\b|\b2 clause bsd\b"),
    ("bsd", r"\bbsd license\b|\bbsd style license\b"),
    ("isc", r"\bisc license\b"),
    ("unlicense", r"\bthis is free and unencumbered software released into the public domain\b|\bthe unlicense\b"),
    ("public_domain", r"\b(?:in|into|to) the public domain\b"),
    ("rights_reserved", r"\ball rights reserved\b"),
    ("see_license", r"\bsee (?:the )?license (?:file )?for\b"),
]

# Every pattern needs one of these in the lower-cased text. Single words, as a line break or
# any marks may stand between two.
MARKERS = ["licen", "permission", "warrant", "redistribution", "redistribute", "liable", "endorse", "advertising",
           "domain", "unencumbered", "reserved", "spdx", "gpl", "cc", "creative", "attribution",
           "bsd", "gnu", "wtfpl"]

# Licences as sequences of identifiers, the longer before the shorter. A rule
# takes the identifiers it matches, so a shorter rule does not see them again.
RULES: list[tuple[str, list[str]]] = [
    ("BSD-4-Clause", ["bsd_grant", "bsd_source", "bsd_binary", "bsd_advertise", "bsd_endorse", "bsd_disclaimer"]),
    ("BSD-3-Clause", ["bsd_grant", "bsd_source", "bsd_binary", "bsd_endorse", "bsd_disclaimer"]),
    ("BSD-2-Clause", ["bsd_grant", "bsd_source", "bsd_binary", "bsd_disclaimer"]),
    ("MIT", ["mit_grant", "mit_condition", "mit_disclaimer", "mit_liability"]),
    ("MIT", ["mit_grant", "mit_condition", "mit_disclaimer"]),
    ("ISC", ["isc_grant", "isc_disclaimer"]),
    ("ISC", ["isc_grant", "mit_disclaimer"]),
    ("Apache-2.0", ["apache_2", "apache_terms", "apache_copy"]),
    ("Apache-2.0", ["apache_2", "apache_terms"]),
    # The standard notice names the license again where it disclaims and says where to find it.
    ("GPL-or-later", ["gpl_or_later", "gpl", "gpl"]),
    ("GPL-or-later", ["gpl_or_later", "gpl"]),
    ("GPL-or-later", ["gpl_or_later"]),
    ("LGPL-or-later", ["lgpl_or_later", "lgpl", "lgpl"]),
    ("LGPL-or-later", ["lgpl_or_later", "lgpl"]),
    ("LGPL-or-later", ["lgpl_or_later"]),
    ("AGPL", ["agpl"]),
    ("LGPL", ["lgpl"]),
    ("GPL-3.0", ["gpl_3"]),
    ("GPL-2.0", ["gpl_2"]),
    ("GPL", ["gpl"]),
    ("Apache-2.0", ["apache_2"]),
    ("Apache", ["apache"]),
    ("MPL-2.0", ["mpl_2"]),
    ("MPL", ["mpl"]),
    ("EPL", ["epl"]),
    ("CC0-1.0", ["cc0"]),
    ("CC-BY-NC-SA", ["cc_by_nc_sa"]),
    ("CC-BY-NC-ND", ["cc_by_nc_nd"]),
    ("CC-BY-NC", ["cc_by_nc"]),
    ("CC-BY-SA", ["cc_by_sa"]),
    ("CC-BY-ND", ["cc_by_nd"]),
    ("CC-BY", ["cc_by"]),
    ("MIT", ["mit"]),
    ("BSD-3-Clause", ["bsd_3"]),
    ("BSD-2-Clause", ["bsd_2"]),
    ("BSD", ["bsd"]),
    ("ISC", ["isc"]),
    ("Unlicense", ["unlicense"]),
    ("Public-domain", ["public_domain"]),
    ("BSL-1.0", ["boost"]),
    ("Zlib", ["zlib"]),
    ("WTFPL", ["wtfpl"]),
    ("SPDX-tagged", ["spdx"]),
]

# A sentence ends at a stop that no letter or digit follows, or at a blank line; a semicolon
# parts it further where no identifier spans it.
SENTENCE_END = r"[.!?]+(?![A-Za-z0-9])|\n[ \t]*\n"
# Words that mark comments at the start of a line; other marks are punctuation.
COMMENT = r"(?im)^[ \t]*(?:rem|dnl|c)(?=[ \t]|$)"


def normalised(sentence: Column) -> Column:
    """Lower case, words apart by one blank, no punctuation or comment marks, one spelling of "license"."""
    plain = F.regexp_replace(F.lower(F.regexp_replace(sentence, COMMENT, " ")), r"[^\p{L}\p{N}]+", " ")
    return F.trim(F.regexp_replace(plain, r"\blicence", "license"))


def identifiers(sentence: Column) -> Column:
    """Distinct identifiers of a normalised sentence in order of place, an empty list if none.

    Each pattern's matches give way to its number between line feeds, which no pattern spans.
    """
    held = sentence
    for k, (_, pattern) in enumerate(SENTENCES):
        held = F.regexp_replace(held, pattern, f"\n#{k}\n")
    numbers = F.regexp_extract_all(held, F.lit(r"\n#(\d+)\n"), F.lit(1))
    names = F.array(*[F.lit(name) for name, _ in SENTENCES])
    return F.transform(F.array_distinct(numbers), lambda k: F.get(names, k.cast("int")))


def _match(ids: Column) -> Column:
    """Names of the rules found in an ordered list of identifiers, in the rules' order."""
    # One identifier per pair of bars; each rule cuts out what it matches.
    rest = F.concat(F.lit("|"), F.array_join(ids, "||"), F.lit("|"))
    state = F.struct(rest.alias("rest"), F.array().cast("array<string>").alias("found"))

    def step(held: Column, rule: Column) -> Column:
        hit = F.contains(held["rest"], rule["run"])
        return F.struct(
            F.when(hit, F.replace(held["rest"], rule["run"], F.lit("#"))).otherwise(held["rest"]).alias("rest"),
            F.when(hit, F.array_append(held["found"], rule["name"])).otherwise(held["found"]).alias("found"),
        )

    rules = F.array(*[F.struct(F.lit(name).alias("name"), F.lit("|" + "||".join(run) + "|").alias("run")) for name, run in RULES])
    return F.array_distinct(F.aggregate(rules, state, step, lambda s: s["found"]))


def licenses(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Licences of every document: (id, licenses, sentence_ids, n_sentences, sentences).

    The text is cut into sentences and each normalised one mapped to the identifiers of the
    known licence sentences in it; other sentences are passed over. A sentence is cut at its
    semicolons if its parts have the same identifiers. The identifiers in text order
    are matched against ordered rules, longest first, and a matched run is used up, so a full
    MIT text is not also a mention of MIT. ``licenses`` holds the names found (an empty list if none),
    ``sentence_ids`` the identifiers in text order, ``sentences`` the sentence of each.

    Every row gives one row: a null or empty text has empty lists and a null id stays
    null. All work is per row, without a shuffle; texts with no marker word, of which every
    pattern needs one, skip the cutting. Other columns are not read.
    """
    def marked(part: Column) -> Column:
        lowered = F.lower(part)
        return reduce(lambda a, b: a | b, [F.contains(lowered, F.lit(m)) for m in MARKERS])

    def known(parts: Column) -> Column:
        held = F.transform(parts, lambda s: F.struct(s.alias("sentence"), identifiers(normalised(s)).alias("ids")))
        return F.filter(held, lambda s: F.size(s["ids"]) > 0)

    def parted(held: Column) -> Column:
        parts = known(F.split(held["sentence"], ";"))
        whole = F.array(held)
        # An array of one, so that the parts are looked for once.
        chosen = F.transform(
            F.array(parts), lambda p: F.when(F.array_distinct(F.flatten(p["ids"])) == held["ids"], p).otherwise(whole)
        )
        return F.when(F.contains(held["sentence"], F.lit(";")), F.element_at(chosen, 1)).otherwise(whole)

    # A line break alone ends no sentence, as licence texts are wrapped.
    cut = known(F.filter(F.split(F.col(text), SENTENCE_END), marked))
    found = F.flatten(F.transform(cut, parted))
    found = F.transform(found, lambda s: F.transform(s["ids"], lambda i: F.struct(F.trim(s["sentence"]).alias("sentence"), i.alias("id"))))
    found = F.flatten(found)
    none = F.array().cast("array<struct<sentence:string,id:string>>")
    rows = docs.select(F.col(id).alias(id), F.when(marked(F.col(text)), found).otherwise(none).alias("found"))
    rows = rows.select(id, F.coalesce("found", none).alias("found"))
    ids = F.col("found.id")
    return rows.select(
        id,
        _match(ids).alias("licenses"),
        ids.alias("sentence_ids"),
        F.size("found").cast("long").alias("n_sentences"),
        F.col("found.sentence").alias("sentences"),
    )
