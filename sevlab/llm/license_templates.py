"""License scans: text units compared to license templates by the Dice coefficient over word bigrams
(DataFrame functions only).

A unit is a line, or a whole text that is not longer than a template can be. Its words are lower-cased
runs of letters and digits, its set the distinct pairs of neighbouring words. A template can only reach
``PERCENT`` if the smaller of the two sets has at least percent / (200 - percent) of the larger one's
size; each template is listed under the sizes that it can match, and units meet it by an equi join on
their size. Units that share no bigram with any template are dropped before.

Templates are a fixed table in this module, so what is broadcast does not grow with the data. Nothing is
grouped but the (document, line, license) matches of one document.

Defined results: null and empty texts and units of fewer than two words match nothing; a unit may match
several licenses (each is a row); equal rows give equal matches, once for each doc_id; empty tables give
empty results.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PERCENT = 80
#: License notices in common use, by identifier.
TEMPLATES = (
    ("all-rights-reserved", "All rights reserved."),
    ("agpl-3.0", "Licensed under the GNU Affero General Public License, version 3."),
    ("agpl-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."),
    ("bsd-2-clause", "Released under the BSD 2-Clause License."),
    ("bsd-3-clause", "Released under the BSD 3-Clause License."),
    ("cc-by-4.0", "Licensed under CC BY 4.0."),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0."),
    ("cc-by-nc-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0."),
    ("cc-by-sa-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("cc0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("gpl-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("lgpl-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("mit", "Released under the MIT License."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
)


def template_bigrams(text: str) -> set[str]:
    words = re.findall(r"[^\W_]+", text.lower())
    return {f"{a} {b}" for a, b in zip(words, words[1:], strict=False)}


def admissible(size: int, percent: int = PERCENT) -> range:
    """Sizes of sets that can reach the coefficient with a set of ``size``."""
    return range(-(-size * percent // (200 - percent)), size * (200 - percent) // percent + 1)


def words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def bigrams(w: Column) -> Column:
    pairs = F.zip_with(w, F.slice(w, F.lit(2), F.size(w)), lambda a, b: F.concat(a, F.lit(" "), b))  # the last word has none
    return F.array_distinct(F.filter(pairs, lambda p: p.isNotNull()))


def scan(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, line (from 0; -1 for a whole text of several lines), license and dice_permille of every match."""
    templates = [(name, sorted(template_bigrams(text))) for name, text in TEMPLATES]
    known = sorted({b for _, t in templates for b in t})
    longest = max(max(admissible(len(t), percent)) for _, t in templates)
    spark = docs.sparkSession
    by_size = spark.range(1).select(F.explode(F.array(*[
        F.struct(F.lit(name).alias("license"), F.array(*map(F.lit, t)).alias("template"), F.array(*map(F.lit, admissible(len(t), percent))).alias("sizes")) for name, t in templates])).alias("t"))
    by_size = by_size.select("t.license", "t.template", F.explode("t.sizes").alias("size"))

    # Every step is a function of one array, so that no text is split again for each of its words.
    lines = docs.select("doc_id", F.transform(F.split(docs["text"], "\n", -1), words).alias("lines"))
    by_line = F.transform("lines", lambda w, i: F.struct(i.alias("line"), bigrams(w).alias("bigrams")))
    whole = F.when(F.size("lines") > 1, F.transform(F.array(F.flatten("lines")), lambda w: F.struct(F.lit(-1).alias("line"), bigrams(w).alias("bigrams"))))
    nothing = F.array().cast("array<struct<line:int,bigrams:array<string>>>")
    close = lambda u: F.size(u["bigrams"]).between(1, longest) & F.exists(u["bigrams"], lambda b: b.isin(known))
    units = lines.select("doc_id", F.explode(F.filter(F.concat(F.coalesce(by_line, nothing), F.coalesce(whole, nothing)), close)).alias("u"))
    sets = units.select("doc_id", "u.line", "u.bigrams", F.size("u.bigrams").alias("size"))
    shared = F.size(F.array_intersect("bigrams", "template"))
    scored = sets.join(F.broadcast(by_size), "size").select("doc_id", "line", "license", shared.alias("shared"), (F.col("size") + F.size("template")).alias("sizes"))
    good = scored.filter(200 * F.col("shared") >= percent * F.col("sizes"))
    return good.groupBy("doc_id", "line", "license").agg(F.max(F.floor(2000 * F.col("shared") / F.col("sizes")).cast("int")).alias("dice_permille"))
