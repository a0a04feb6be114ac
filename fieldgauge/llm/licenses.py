"""Licence scan: normalised text against licence templates by Dice over word bigrams.

A text is one run of words. Compared with each template are the whole text, its lines, its
paragraphs, its sentences, and windows of as many words as the template has, wherever they
begin with a pair of words of the template. So a notice is found alone, wrapped, in a comment
block, and inside a longer line or paragraph. Paragraphs end at lines without a letter or
digit, so also at lines of comment marks alone. Of likenesses that overlap, the one with the
most pairs in common counts, then the largest Dice, the shortest, and the first name.

Two bounds end the work early, and lose nothing. Dice of at least t needs t / (2 - t) of a
template's n bigrams. A text without m of its words lacks m - 1 of its bigrams at least, so
most texts end after one look at their words; and sizes must be within a factor of (2 - t) / t.
All DataFrame functions, row by row; the templates are a constant. Nothing is shuffled.

Normalising: lower case, and everything but letters and digits is a blank.

Defined cases: a null or empty text has no licence (null, 0.0, no matches). Of templates
that are equally like, the first by name counts. Rows that repeat give equal results.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

THRESHOLD = 0.8

#: Notices and opening paragraphs of public licences: fixed values.
TEMPLATES = {
    "AGPL-3.0": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-notice": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0',
    "Apache-2.0-warranty": 'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.',
    "BSD-conditions": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "BSD-disclaimer": 'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.',
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "GPL-2.0-or-later": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-or-later": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "MIT": "Released under the MIT License.",
    "MIT-notice": "This project is licensed under the terms of the MIT License.",
    "MIT-permission": 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:',
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
    "Zlib": "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.",
}


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), 0)


def _words(unit: Column) -> Column:
    """The words; none for a unit without letters and digits."""
    found = F.split(F.btrim(F.regexp_replace(F.lower(unit), "[^\\p{L}\\p{N}]+", " ")), " ")
    return F.filter(found, lambda w: w != "")


def _bigrams(words: Column) -> Column:
    """Pairs of neighbours in order, as strings; none for fewer than two words."""
    pairs = F.transform(F.sequence(F.lit(0), F.size(words) - 2), lambda i: F.concat_ws(" ", F.get(words, i), F.get(words, i + 1)))
    return F.when(F.size(words) < 2, F.array().cast("array<string>")).otherwise(pairs)


def _ranges(pieces: Column) -> Column:
    """The place of each piece's first word in the text, and the number of its words."""
    none = F.array().cast("array<struct<start:int,n:int>>")
    sums = F.aggregate(
        F.transform(pieces, lambda p: F.size(_words(p))),
        F.struct(F.lit(0).alias("at"), none.alias("found")),
        lambda s, n: F.struct(
            (s["at"] + n).alias("at"),
            F.when(n < 2, s["found"]).otherwise(F.concat(s["found"], F.array(F.struct(s["at"].alias("start"), n.alias("n"))))).alias("found"),
        ),
    )
    return sums["found"]


def _prepared(templates: dict[str, str]) -> list[tuple[str, list[str], list[str]]]:
    """(name, words, distinct bigrams)."""
    found = []
    for name in sorted(templates):
        words = re.sub(r"[\W_]+", " ", templates[name].lower()).split()
        found.append((name, words, sorted({f"{a} {b}" for a, b in zip(words, words[1:], strict=False)})))
    return found


#: Between paragraphs: a line without letters and digits follows. Between sentences: also blanks after a mark.
_PARAGRAPH = "\n(?=[^\\p{L}\\p{N}\n]*\n)"
_SENTENCE = _PARAGRAPH + "|(?<=[.!?])\\s+"


def scan(docs: DataFrame, text: str = "text", templates: dict[str, str] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """All columns of ``docs`` and: licence (string), dice (double), n_matches (long: places
    that reach the threshold), licences (array of names, sorted). Own names go."""
    added = ["licence", "dice", "n_matches", "licences"]
    least = threshold / (2 - threshold)
    constant = F.array(
        *[
            F.struct(
                F.lit(name).alias("name"),
                F.lit(least * len(grams)).alias("low"),
                F.lit(len(grams) / least).alias("high"),
                F.lit(len(words)).alias("n"),
                F.array(*[F.lit(w) for w in sorted(set(words))]).alias("words"),
                # distinct words that a text must have at least
                F.lit(len(set(words)) - math.floor(len(grams) * (1 - least) + 1 + 1e-9)).alias("need"),
                F.array(*[F.lit(g) for g in grams]).alias("grams"),
            )
            for name, words, grams in _prepared(templates)
        ]
    )
    vocabulary = F.array(*[F.lit(w) for w in sorted({w for _, words, _ in _prepared(templates) for w in words})])

    def like(bigrams: Column, template: Column, start: Column, n: Column) -> Column:
        """A range of words against a template; smaller is better, by hits and loss."""
        return _let(
            F.array_distinct(F.slice(bigrams, start + 1, n - 1)),
            lambda own: _let(
                F.size(F.array_intersect(own, template["grams"])),
                lambda both: F.struct(
                    (-both).alias("hits"),
                    (1 - 2.0 * both / (F.size(own) + F.size(template["grams"]))).alias("loss"),
                    n.alias("n"),
                    start.alias("start"),
                    template["name"].alias("name"),
                    (2.0 * both / (F.size(own) + F.size(template["grams"]))).alias("dice"),
                ),
            ),
        )

    def places(bigrams: Column, units: Column, template: Column) -> Column:
        """All places where the text is like the template."""
        fits = F.filter(units, lambda u: (u["n"] - 1 >= template["low"]) & (F.size(F.array_distinct(F.slice(bigrams, u["start"] + 1, u["n"] - 1))) <= template["high"]))
        begins = F.filter(F.sequence(F.lit(0), F.size(bigrams) - 1), lambda i: F.array_contains(template["grams"], F.get(bigrams, i)))
        windows = F.transform(begins, lambda i: F.struct(i.alias("start"), F.least(template["n"], F.size(bigrams) + 1 - i).alias("n")))
        return F.filter(
            F.transform(F.concat(fits, windows), lambda u: like(bigrams, template, u["start"], u["n"])),
            lambda m: m["dice"] >= threshold,
        )

    def apart(matches: Column) -> Column:
        """The best of the matches that overlap."""
        return F.aggregate(
            F.sort_array(matches),
            none,
            lambda kept, m: F.when(
                F.exists(kept, lambda k: (m["start"] < k["start"] + k["n"]) & (k["start"] < m["start"] + m["n"])), kept
            ).otherwise(F.concat(kept, F.array(m))),
        )

    none = F.array().cast("array<struct<hits:int,loss:double,n:int,start:int,name:string,dice:double>>")
    whole = F.coalesce(F.col(text), F.lit(""))

    def search(words: Column, live: Column) -> Column:
        units = F.concat(
            F.array(F.struct(F.lit(0).alias("start"), F.size(words).alias("n"))),
            _ranges(F.split(whole, "\n", -1)),
            _ranges(F.split(whole, _PARAGRAPH, -1)),
            _ranges(F.split(whole, _SENTENCE, -1)),
        )
        return _let(
            _bigrams(words),
            lambda bigrams: _let(
                F.filter(live, lambda t: F.size(F.array_intersect(bigrams, t["grams"])) >= t["low"]),
                lambda near: F.when(F.size(near) == 0, none).otherwise(
                    _let(units, lambda u: apart(F.flatten(F.transform(near, lambda t: places(bigrams, u, t)))))
                ),
            ),
        )

    def search_if_any(words: Column) -> Column:
        present = F.array_intersect(words, vocabulary)
        live = _let(present, lambda has: F.filter(constant, lambda t: F.size(F.array_intersect(has, t["words"])) >= t["need"]))
        return _let(live, lambda t: F.when((F.size(t) == 0) | (F.size(words) < 2), none).otherwise(search(words, t)))

    units = _let(_words(whole), search_if_any)
    found = "__licences_found"
    top = F.aggregate(
        F.transform(F.col(found), lambda b: F.struct(b["dice"].alias("dice"), b["name"].alias("name"))),
        F.struct(F.lit(0.0).alias("dice"), F.lit(None).cast("string").alias("name")),
        lambda a, b: F.when((b["dice"] > a["dice"]) | ((b["dice"] == a["dice"]) & (b["name"] < a["name"])), b).otherwise(a),
    )
    rest = docs.drop(*[c for c in added if c != text])
    return (
        rest.withColumn(found, units)
        .withColumn("__licence_top", top)
        .select(
            *[F.col(f"`{c}`") for c in rest.columns],
            F.col("__licence_top")["name"].alias("licence"),
            F.col("__licence_top")["dice"].alias("dice"),
            F.size(found).cast("long").alias("n_matches"),
            F.sort_array(F.array_distinct(F.transform(F.col(found), lambda b: b["name"]))).alias("licences"),
        )
    )
