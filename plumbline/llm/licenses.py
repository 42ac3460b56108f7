"""Licence recognition by sentence rules.

Each text is cut into pieces at sentence marks and line breaks, which are normalised.
Known licence sentences are found as one piece or as several that follow each other, so that
wrapped notices count, and become identifiers. The sequence of identifiers is matched against ordered rules:
a rule is a run of identifiers that names a licence, and rules with longer runs
come first, so that a notice is not taken for a part of itself. DataFrame functions
only; the texts stay in their rows.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Known sentences, normalised, by identifier.
SENTENCES: dict[str, str] = {
    "mit_released": "released under the mit license",
    "mit_licensed": "licensed under the mit license",
    "mit_grant": "permission is hereby granted free of charge to any person obtaining a copy of this software and "
                 "associated documentation files the software to deal in the software without restriction including without "
                 "limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the "
                 "software and to permit persons to whom the software is furnished to do so subject to the following conditions",
    "mit_notice": "the above copyright notice and this permission notice shall be included in all copies or substantial "
                  "portions of the software",
    "as_is": "the software is provided as is without warranty of any kind express or implied including but not limited to "
             "the warranties of merchantability fitness for a particular purpose and noninfringement",
    "apache_licensed": "licensed under the apache license version 2.0",
    "apache_the_license": "licensed under the apache license version 2.0 the license",
    "apache_comply": "you may not use this file except in compliance with the license",
    "apache_obtain": "you may obtain a copy of the license at http www.apache.org licenses license 2.0",
    "gpl3_work": "this work is licensed under the gnu general public license version 3",
    "gpl3_licensed": "licensed under the gnu general public license version 3",
    "gpl_free": "this program is free software you can redistribute it and or modify it under the terms of the gnu general "
                "public license as published by the free software foundation either version 3 of the license or at your "
                "option any later version",
    "gpl2_free": "this program is free software you can redistribute it and or modify it under the terms of the gnu general "
                 "public license as published by the free software foundation either version 2 of the license or at your "
                 "option any later version",
    "gpl_hope": "this program is distributed in the hope that it will be useful but without any warranty without even the "
                "implied warranty of merchantability or fitness for a particular purpose",
    "ccbync_licensed": "licensed under cc by nc 4.0",
    "ccby_licensed": "licensed under cc by 4.0",
    "ccbysa_licensed": "licensed under cc by sa 4.0",
    "cc0": "to the extent possible under law the author has waived all copyright and related rights to this work",
    "mpl2": "this source code form is subject to the terms of the mozilla public license v. 2.0",
    "bsd_redistribute": "redistribution and use in source and binary forms with or without modification are permitted "
                        "provided that the following conditions are met",
    "bsd_source": "redistributions of source code must retain the above copyright notice this list of conditions and the "
                  "following disclaimer",
    "bsd_binary": "redistributions in binary form must reproduce the above copyright notice this list of conditions and the "
                  "following disclaimer in the documentation and or other materials provided with the distribution",
    "bsd_endorse": "neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
                   "promote products derived from this software without specific prior written permission",
    "isc_grant": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
                 "granted provided that the above copyright notice and this permission notice appear in all copies",
    "lgpl21_free": "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser "
                   "general public license as published by the free software foundation either version 2.1 of the license or "
                   "at your option any later version",
    "lgpl3_free": "this program is free software you can redistribute it and or modify it under the terms of the gnu lesser "
                  "general public license as published by the free software foundation either version 3 of the license or at "
                  "your option any later version",
    "lgpl_hope": "this library is distributed in the hope that it will be useful but without any warranty without even the "
                 "implied warranty of merchantability or fitness for a particular purpose",
    "agpl3_free": "this program is free software you can redistribute it and or modify it under the terms of the gnu affero "
                  "general public license as published by the free software foundation either version 3 of the license or at "
                  "your option any later version",
    "epl2_available": "this program and the accompanying materials are made available under the terms of the eclipse public "
                      "license 2.0 which is available at https www.eclipse.org legal epl 2.0",
    "boost_distributed": "distributed under the boost software license version 1.0",
    "zlib_grant": "permission is granted to anyone to use this software for any purpose including commercial applications and "
                  "to alter it and redistribute it freely subject to the following restrictions",
    "unlicense_free": "this is free and unencumbered software released into the public domain",
    "reserved": "all rights reserved",
}

# Ordered rules, a licence for a run of identifiers.
RULES: list[tuple[tuple[str, ...], str]] = [
    (("bsd_redistribute", "bsd_source", "bsd_binary", "bsd_endorse"), "BSD-3-Clause"),
    (("bsd_redistribute", "bsd_source", "bsd_binary"), "BSD-2-Clause"),
    (("mit_grant", "mit_notice", "as_is"), "MIT"),
    (("mit_grant", "mit_notice"), "MIT"),
    (("apache_the_license", "apache_comply", "apache_obtain"), "Apache-2.0"),
    (("apache_the_license", "apache_comply"), "Apache-2.0"),
    (("gpl_free", "gpl_hope"), "GPL-3.0-or-later"),
    (("gpl2_free", "gpl_hope"), "GPL-2.0-or-later"),
    (("gpl_free",), "GPL-3.0-or-later"),
    (("gpl2_free",), "GPL-2.0-or-later"),
    (("gpl3_work",), "GPL-3.0-only"),
    (("gpl3_licensed",), "GPL-3.0-only"),
    (("apache_the_license",), "Apache-2.0"),
    (("apache_licensed",), "Apache-2.0"),
    (("mit_released",), "MIT"),
    (("mit_licensed",), "MIT"),
    (("ccbync_licensed",), "CC-BY-NC-4.0"),
    (("ccbysa_licensed",), "CC-BY-SA-4.0"),
    (("ccby_licensed",), "CC-BY-4.0"),
    (("cc0",), "CC0-1.0"),
    (("mpl2",), "MPL-2.0"),
    (("isc_grant",), "ISC"),
    (("lgpl21_free", "lgpl_hope"), "LGPL-2.1-or-later"),
    (("lgpl21_free",), "LGPL-2.1-or-later"),
    (("lgpl3_free", "gpl_hope"), "LGPL-3.0-or-later"),
    (("lgpl3_free",), "LGPL-3.0-or-later"),
    (("agpl3_free", "gpl_hope"), "AGPL-3.0-or-later"),
    (("agpl3_free",), "AGPL-3.0-or-later"),
    (("epl2_available",), "EPL-2.0"),
    (("boost_distributed",), "BSL-1.0"),
    (("zlib_grant",), "Zlib"),
    (("unlicense_free",), "Unlicense"),
    (("reserved",), "LicenseRef-Proprietary"),
]

#: Named only where no other licence is: many notices begin with a copyright line that ends "All rights reserved."
LAST_RESORT = "LicenseRef-Proprietary"

# Every known sentence has one of these words, so a text without them has none.
HINT = "(?i)licen[sc]e|permission|redistribut|copyright|warranty|rights[^a-z0-9]+reserved|public[^a-z0-9]+domain"

#: The end of a sentence: a mark before white space, unless a number follows ("v. 2.0").
SENTENCE_END, LINE = r"[.!?;:][ \t\f\r\n\x0B]+([^0-9 \t\f\r\n\x0B])", r"[\r\n]+"
#: No known sentence goes on beyond these marks; beyond line breaks, ';' and ':' it may,
#: and beyond a dot before a number, also with comment marks between.
FULL_STOP = r"(?<=[^ \t\f\r\n\x0B.!?])[.!?]+[ \t\f\r\n\x0B]+(?=[^0-9 \t\f\r\n\x0B])(?![^a-zA-Z0-9]{0,8}[0-9])"
OTHER = r"[^a-z0-9.]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
EDGE = r"^[ .]+|[ .]+$"


def normalised(sentence: Column) -> Column:
    """A-Z in lower case, words and dots between single blanks, no dots or blanks at the ends."""
    return F.regexp_replace(F.regexp_replace(F.translate(sentence, UPPER, LOWER), OTHER, " "), EDGE, "")


def sentences(text: Column) -> Column:
    """The normalised sentences of a text, in order."""
    marked = F.regexp_replace(F.coalesce(text, F.lit("")), SENTENCE_END, "\n$1")
    return F.filter(F.transform(F.split(marked, LINE), normalised), lambda s: s != "")


def _pieces(text: Column) -> Column:
    """The normalised sentences of a text as lines, with a form feed after each full stop."""
    return F.array_join(F.transform(F.split(text, FULL_STOP), lambda s: F.array_join(sentences(s), "\n")), "\f")


def _any_of(known: list[str]) -> str:
    """A pattern for whole lines that are one of the sentences when joined, the longest at a place.

    A dot at the end of a word is lost at a line break.
    """
    def words(sentence: str) -> str:
        return r"[ \n]".join(re.escape(w[:-1]) + r"(?:\.|(?=\n))" if w.endswith(".") else re.escape(w) for w in sentence.split(" "))

    longest = sorted(set(known), key=lambda s: (-len(s), s))
    return r"(?<![^\n\f])(?:" + ("|".join(words(s) for s in longest) or "(?!)") + r")(?![^\n\f])"


def recognise(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", known: dict[str, str] | None = None,
    rules: list[tuple[tuple[str, ...], str]] | None = None, hint: str | None = HINT,
) -> DataFrame:
    """(doc_id, sentence_ids, licenses, status) of each row of ``docs``.

    ``sentence_ids`` are the identifiers of the text's known sentences in order; a sentence
    may be wrapped over lines, behind comment marks of any signs, or hold ';' and ':'. Of
    known sentences that begin at one place the longest counts. ``licenses`` are the
    licences of the rules whose runs occur in it, sorted; ``LAST_RESORT`` only where it is alone. A rule takes
    its identifiers out of the sequence, so later rules do not see them. ``status`` is
    ``none`` without known sentences, ``recognised`` if rules took them all, else
    ``unclear``. Only texts in which ``hint`` occurs are cut into sentences; it must
    occur in each known sentence, or be None.

    Null and empty texts have no sentences. A sentence that repeats is listed and matched
    each time; long texts are read whole. Rows that repeat are judged each for itself; an
    empty table gives no rows. Other columns are not read.
    """
    known = SENTENCES if known is None else known
    rules = RULES if rules is None else rules
    number = {name: i for i, name in enumerate(known)}
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    # Joined lines may lack the dots at the ends of their words.
    plain = lambda s: F.regexp_replace(s, r"\.?(\n| |$)", " ")
    all_known = F.array(*(plain(F.lit(s)) for s in known.values()))
    found = F.regexp_extract_all(_pieces(text), F.lit(_any_of(list(known.values()))), F.lit(0))
    numbers = F.transform(found, lambda s: F.array_position(all_known, plain(s)))
    if hint is not None:
        numbers = F.when(text.rlike(hint), numbers).otherwise(F.array().cast("array<bigint>"))
    names = F.array(*(F.lit(n) for n in known))
    # The sequence as text, each identifier between bars of its own: |3||7|
    found = docs.select(F.col(id_col).alias("doc_id"), numbers.alias("numbers")).select(
        "doc_id", F.transform("numbers", lambda i: F.element_at(names, i.cast("int"))).alias("sentence_ids"),
        F.concat_ws("", F.transform("numbers", lambda i: F.concat(F.lit("|"), (i - 1).cast("string"), F.lit("|")))).alias("rest"))
    rest, took = F.col("rest"), []
    # A sentence of the last resort is taken out like any other, but adds no name beside another licence.
    for run, name in rules:
        mark = F.lit("".join(f"|{number[i]}|" for i in run))
        took.append(F.when(F.contains(rest, mark), F.lit(name)))
        rest = F.replace(rest, mark, F.lit(" "))
    given = F.array_sort(F.array_distinct(F.filter(F.array(*took), lambda x: x.isNotNull())))
    others = F.filter(given, lambda x: x != LAST_RESORT)
    return found.select(
        "doc_id", "sentence_ids", F.when(F.size(others) > 0, others).otherwise(given).alias("licenses"),
        F.when(F.size("sentence_ids") == 0, "none").when(F.trim(rest) == "", "recognised").otherwise("unclear").alias("status"))
