"""Licence scans by sentence rules, in DataFrame expressions alone.

A text is cut into sentences, twice: by lines, and across line breaks for wrapped licence texts. A
sentence in lower case without punctuation is looked up among the known licence sentences; what is
found gives the text's sequence of sentence identifiers. A rule is an ordered list of identifiers, and
a licence is recognised if its rule's identifiers occur in this order. Everything happens within the
row, so nothing is shuffled. Comment marks at the start of lines are left out before the cuts, and cuts
within a known sentence are undone.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Known sentences by identifier. They are compared in lower case, without punctuation.
SENTENCES = {
    "apache-2.0.notice": "Licensed under the Apache License, Version 2.0",
    "apache-2.0.grant": "Licensed under the Apache License, Version 2.0 (the \"License\")",
    "apache-2.0.compliance": "you may not use this file except in compliance with the License",
    "apache-2.0.copy": "You may obtain a copy of the License at",
    "apache-2.0.as-is": "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied",
    "mit.notice": "Released under the MIT License",
    "mit.licensed": "Licensed under the MIT License",
    "mit.title": "MIT License",
    "mit.grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions",
    "mit.condition": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software",
    "mit.as-is": "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT",
    "isc.grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies",
    "bsd.grant": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "bsd.source": "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer",
    "bsd.binary": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution",
    "bsd.endorse": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "gpl-3.0.notice": "This work is licensed under the GNU General Public License, version 3",
    "gpl.grant": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
    "gpl.warranty": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY",
    "gpl.received": "You should have received a copy of the GNU General Public License along with this program",
    "mpl-2.0.notice": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    "cc-by-4.0.notice": "Licensed under CC BY 4.0",
    "cc-by-sa-4.0.notice": "Licensed under CC BY-SA 4.0",
    "cc-by-nc-4.0.notice": "Licensed under CC BY-NC 4.0",
    "cc-by-4.0.work": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "cc-by-nc-4.0.work": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
    "cc0.notice": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work",
    "spdx.mit": "SPDX-License-Identifier: MIT",
    "spdx.apache-2.0": "SPDX-License-Identifier: Apache-2.0",
    "spdx.gpl-3.0": "SPDX-License-Identifier: GPL-3.0-or-later",
    "all-rights": "All rights reserved",
}
# Licence, its sentences in order, and its kind.
RULES = (
    ("Apache-2.0", ("apache-2.0.notice",), "permissive"),
    ("Apache-2.0", ("apache-2.0.grant", "apache-2.0.as-is"), "permissive"),
    ("Apache-2.0", ("spdx.apache-2.0",), "permissive"),
    ("MIT", ("mit.notice",), "permissive"),
    ("MIT", ("mit.licensed",), "permissive"),
    ("MIT", ("mit.grant", "mit.condition", "mit.as-is"), "permissive"),
    ("MIT", ("spdx.mit",), "permissive"),
    ("ISC", ("isc.grant",), "permissive"),
    ("BSD-2-Clause", ("bsd.grant", "bsd.source", "bsd.binary"), "permissive"),
    ("BSD-3-Clause", ("bsd.grant", "bsd.source", "bsd.binary", "bsd.endorse"), "permissive"),
    ("GPL-3.0", ("gpl-3.0.notice",), "copyleft"),
    ("GPL-3.0", ("gpl.grant", "gpl.warranty", "gpl.received"), "copyleft"),
    ("GPL-3.0", ("spdx.gpl-3.0",), "copyleft"),
    ("MPL-2.0", ("mpl-2.0.notice",), "copyleft"),
    ("CC-BY-4.0", ("cc-by-4.0.notice",), "permissive"),
    ("CC-BY-4.0", ("cc-by-4.0.work",), "permissive"),
    ("CC-BY-SA-4.0", ("cc-by-sa-4.0.notice",), "copyleft"),
    ("CC-BY-NC-4.0", ("cc-by-nc-4.0.notice",), "noncommercial"),
    ("CC-BY-NC-4.0", ("cc-by-nc-4.0.work",), "noncommercial"),
    ("CC0-1.0", ("cc0.notice",), "permissive"),
    ("proprietary", ("all-rights",), "restricted"),
)
# A rule that holds makes a weaker one void.
STRONGER = {"BSD-2-Clause": "BSD-3-Clause"}
KINDS = ("noncommercial", "restricted", "copyleft", "permissive")       # the most limiting first

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
CUT = "\x01"
# Where sentences end: at line breaks, or at marks and empty lines only.
BY_LINE, ACROSS_LINES = "[.!?;:]+[ \t\r\n]+|[\r\n]+", "[.!?;:]+[ \t\r\n]+|\r?\n[ \t]*\r?\n"
NOISE = "[^a-z0-9\x01]+"
COMMENT = "(^|[\r\n])[ \t]*(?:#+|//+|/?[*]+/?|<!--+|--+>?|;+|%+)[ \t]*"


def plain(sentence: str) -> str:
    """A sentence as it is compared."""
    return " ".join("".join(c if c.isascii() and c.isalnum() else " " for c in sentence.lower()).split())


def inner_cuts() -> str:
    """A pattern of the cuts that fall inside a known sentence, with the whole of it around them."""
    places = set()
    for sentence in SENTENCES.values():
        pieces = [plain(p) for p in re.split(ACROSS_LINES, sentence)]
        for k in range(1, len(pieces)):
            before, behind = (f" ?{CUT} ?".join(x) for x in (pieces[:k], pieces[k:]))
            places.add(f"(?={behind} ?(?:{CUT}|$))(?<=(?:^|{CUT}) ?{before} ?{CUT} ?)")
    return f" ?{CUT} ?(?:{'|'.join(sorted(places))})"


def found(text: Column, ends: str) -> Column:
    """Identifiers of the known sentences of a text, in order."""
    cut = F.translate(F.regexp_replace(F.regexp_replace(text, COMMENT, "$1"), ends, CUT), UPPER, LOWER)
    sentences = F.split(F.regexp_replace(F.regexp_replace(cut, NOISE, " "), inner_cuts(), " "), CUT)
    known = F.create_map(*(F.lit(x) for name, sentence in SENTENCES.items() for x in (plain(sentence), name)))
    return F.filter(F.transform(sentences, lambda s: F.try_element_at(known, F.trim(s))), lambda x: x.isNotNull())


def pattern(names: tuple[str, ...]) -> str:
    """Identifiers in this order, with others between them."""
    return "(^| )" + "( .*)? ".join(n.replace(".", "[.]") for n in names) + "( |$)"


def scan(documents: DataFrame) -> DataFrame:
    """doc_id, sentence_ids, licenses and kind of every row of ``documents`` (doc_id, text).

    ``sentence_ids`` are those found by lines, separated by spaces; ``licenses`` are sorted and separated
    by commas, empty if there is none; ``kind`` is the most limiting kind of them, or null. Null and
    empty texts have none. Rows that repeat are scanned each.
    """
    text = F.coalesce("text", F.lit(""))
    rows = documents.select("doc_id", F.array_join(found(text, BY_LINE), " ").alias("sentence_ids"), F.array_join(found(text, ACROSS_LINES), " ").alias("wrapped"))
    held: dict[str, Column] = {}
    for licence, names, _ in RULES:
        hit = F.col("sentence_ids").rlike(pattern(names)) | F.col("wrapped").rlike(pattern(names))
        held[licence] = held[licence] | hit if licence in held else hit
    for weaker, stronger in STRONGER.items():
        held[weaker] = held[weaker] & ~held[stronger]
    kinds = {licence: kind for licence, _, kind in RULES}
    names = F.array_compact(F.array(*(F.when(held[n], F.lit(n)) for n in sorted(held))))
    out = rows.withColumn("found", names)
    kind = F.coalesce(*(F.when(F.arrays_overlap("found", F.array(*(F.lit(n) for n in sorted(kinds) if kinds[n] == k))), F.lit(k)) for k in KINDS))
    return out.select("doc_id", "sentence_ids", F.array_join("found", ",").alias("licenses"), kind.alias("kind"))


def oracle() -> str:
    """The same scan as a DuckDB statement over ``documents``."""
    quoted = lambda s: "'" + s.replace("'", "''") + "'"
    known = "MAP {" + ", ".join(f"{quoted(plain(s))}: {quoted(n)}" for n, s in SENTENCES.items()) + "}"

    def ids(ends: str) -> str:
        cut = f"translate(regexp_replace(coalesce(text, ''), {quoted(ends)}, chr(1), 'g'), '{UPPER}', '{LOWER}')"
        parts = f"string_split(regexp_replace({cut}, '[^a-z0-9\\x01]+', ' ', 'g'), chr(1))"
        return f"array_to_string(list_filter(list_transform({parts}, lambda s: {known}[trim(s)]), lambda x: x IS NOT NULL), ' ')"

    held: dict[str, str] = {}
    for licence, names, _ in RULES:
        hit = f"regexp_matches(sentence_ids, {quoted(pattern(names))}) OR regexp_matches(wrapped, {quoted(pattern(names))})"
        held[licence] = f"{held[licence]} OR {hit}" if licence in held else hit
    for weaker, stronger in STRONGER.items():
        held[weaker] = f"({held[weaker]}) AND NOT ({held[stronger]})"
    kinds = {licence: kind for licence, _, kind in RULES}
    names = ", ".join(f"CASE WHEN {held[n]} THEN {quoted(n)} END" for n in sorted(held))
    kind = " ".join(f"WHEN list_has_any(found, [{', '.join(quoted(n) for n in sorted(kinds) if kinds[n] == k)}]) THEN {quoted(k)}" for k in KINDS)
    return f"""WITH sentences AS (SELECT doc_id, {ids(BY_LINE)} AS sentence_ids, {ids(ACROSS_LINES)} AS wrapped FROM documents),
ruled AS (SELECT *, list_filter([{names}], lambda x: x IS NOT NULL) AS found FROM sentences)
SELECT doc_id, coalesce(sentence_ids, '') AS sentence_ids, coalesce(array_to_string(found, ','), '') AS licenses, CASE {kind} END AS kind FROM ruled"""
