"""Licence notices in texts, by likeness to templates.

Texts are compared piece by piece: every line, and every paragraph of several lines. A piece and a
template are normalised alike (A-Z lowered, all but a-z and 0-9 to single spaces) and compared by the
Dice coefficient of their sets of word bigrams, 2 * common / (one + other). Dice of at least t asks
that the smaller set have t / (2 - t) of the larger: templates beyond that are not compared.

Built from DataFrame functions alone, one pass without a shuffle; the templates are a fixed list in
the plan. Null and empty texts have no pieces and no licence; a piece of one word has no bigrams.
Each row is judged alone, so repeated rows and equal ids do not matter. Pieces of any length are
measured whole; those too long for every template end there. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEAST_PCT = 80  # of the Dice coefficient; whole numbers, so that bounds are exact

#: Notices as their licences word them.
TEMPLATES: tuple[tuple[str, str], ...] = (
    ("all-rights-reserved", "All rights reserved."),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use "
     "this file except in compliance with the License. You may obtain a copy of the License at "
     "http://www.apache.org/licenses/LICENSE-2.0"),
    ("apache-2.0", "Unless required by applicable law or agreed to in writing, software distributed "
     "under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY "
     "KIND, either express or implied. See the License for the specific language governing "
     "permissions and limitations under the License."),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are "
     "permitted provided that the following conditions are met:"),
    ("cc-by-4.0", "Licensed under CC BY 4.0."),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International "
     "License."),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0."),
    ("cc-by-nc-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 "
     "International License."),
    ("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0."),
    ("cc-by-sa-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 "
     "International License."),
    ("cc0-1.0", "To the extent possible under law, the author has waived all copyright and related "
     "or neighboring rights to this work."),
    ("gpl-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl-3.0", "This program is free software: you can redistribute it and/or modify it under the "
     "terms of the GNU General Public License as published by the Free Software Foundation, either "
     "version 3 of the License, or (at your option) any later version."),
    ("agpl-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("lgpl-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with "
     "or without fee is hereby granted, provided that the above copyright notice and this permission "
     "notice appear in all copies."),
    ("mit", "Released under the MIT License."),
    ("mit", "Licensed under the MIT License."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
     "software and associated documentation files (the \"Software\"), to deal in the Software without "
     "restriction, including without limitation the rights to use, copy, modify, merge, publish, "
     "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the "
     "Software is furnished to do so, subject to the following conditions:"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. "
     "2.0. If a copy of the MPL was not distributed with this file, You can obtain one at "
     "http://mozilla.org/MPL/2.0/."),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
)

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _plain(text: str) -> list[str]:
    kept = "".join(c if c.isascii() and c.isalnum() else " " for c in text)
    return kept.lower().split()


def template_bigrams(text: str) -> list[str]:
    words = _plain(text)
    return sorted({f"{a} {b}" for a, b in zip(words, words[1:])})


def _words(piece: Column) -> Column:
    kept = F.regexp_replace(F.translate(piece, _UPPER, _LOWER), "[^a-z0-9]+", " ")
    return F.filter(F.split(kept, " "), lambda w: w != "")


def _pieces(text: Column) -> Column:
    """Lines, and paragraphs of several lines, as (kind, place, text)."""
    def numbered(kind: str, parts: Column) -> Column:
        return F.transform(parts, lambda p, i: F.struct(
            F.lit(kind).alias("kind"), i.alias("place"), p.alias("text")))

    paragraphs = numbered("paragraph", F.split(text, r"\n[ \t\r]*\n", -1))
    return F.concat(numbered("line", F.split(text, "\n", -1)),
                    F.filter(paragraphs, lambda p: F.contains(p["text"], F.lit("\n"))))


def find_licenses(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  least_pct: int = LEAST_PCT) -> DataFrame:
    """Per row: id, ``found``: an array of (kind, place, license, dice), one for each piece that is
    like a template, by its best one (ties: the last name)."""
    templates = [(name, template_bigrams(text)) for name, text in TEMPLATES]
    table = F.array(*(F.struct(F.lit(name).alias("license"), F.lit(len(b)).alias("n"),
                               F.array(*map(F.lit, b)).alias("bigrams")) for name, b in templates))
    sizes = [len(b) for _, b in templates]
    # A set of bigrams has at most one less than the words; the distinct ones are counted below.
    shortest = min(sizes) * least_pct // (200 - least_pct)

    rows = df.select(id_col, F.coalesce(F.col(text_col), F.lit("")).alias("__text"))
    rows = rows.withColumn("__pieces", F.transform(_pieces(F.col("__text")), lambda p: F.struct(
        p["kind"].alias("kind"), p["place"].alias("place"), _words(p["text"]).alias("words"))))
    rows = rows.withColumn("__grams", F.transform(
        F.filter("__pieces", lambda p: F.size(p["words"]) - 1 >= shortest), lambda p: F.struct(
            p["kind"].alias("kind"), p["place"].alias("place"), F.array_distinct(F.transform(
                F.sequence(F.lit(0), F.size(p["words"]) - 2), lambda i: F.concat_ws(
                    " ", F.get(p["words"], i), F.get(p["words"], i + 1)))).alias("grams"))))
    near = F.transform("__grams", lambda p: F.struct(
        p["kind"].alias("kind"), p["place"].alias("place"), p["grams"].alias("grams"),
        F.filter(table, lambda t: (
            F.least(t["n"], F.size(p["grams"])) * (200 - least_pct)
            >= F.greatest(t["n"], F.size(p["grams"])) * least_pct)).alias("near")))
    rows = rows.withColumn("__near", F.filter(near, lambda p: F.size(p["near"]) > 0))
    scored = F.transform("__near", lambda p: F.struct(
        p["kind"].alias("kind"), p["place"].alias("place"), F.array_max(F.transform(
            p["near"], lambda t: F.struct(
                (2.0 * F.size(F.array_intersect(t["bigrams"], p["grams"]))
                 / (t["n"] + F.size(p["grams"]))).alias("dice"), t["license"].alias("license"))
        )).alias("best")))
    found = F.filter(scored, lambda p: 100 * p["best"]["dice"] >= least_pct)
    return rows.select(id_col, F.transform(found, lambda p: F.struct(
        p["kind"].alias("kind"), p["place"].alias("place"), p["best"]["license"].alias("license"),
        p["best"]["dice"].alias("dice"))).alias("found"))
