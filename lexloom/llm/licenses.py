"""License scans by Dice coefficient over word bigrams, in DataFrame operations only."""

from __future__ import annotations

import re
from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import ascii_lower

THRESHOLD = 0.8

# Licence notices and short texts as their publishers word them.
TEMPLATES: dict[str, list[str]] = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    ],
    "MIT": [
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ],
    "GPL-2.0": ["This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."],
    "LGPL-3.0": ["This library is licensed under the GNU Lesser General Public License, version 3."],
    # The opening sentence, which both have; the conditions as a whole tell them apart, and the last of them does.
    "BSD-unspecified": ["Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"],
    "BSD-2-Clause": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    ],
    "BSD-3-Clause": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
        "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    ],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."],
    "ISC": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."],
    "Unlicense": ["This is free and unencumbered software released into the public domain."],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "CC0-1.0": ["Released under CC0 1.0 Universal."],
}


def bigrams(text: str) -> list[str]:
    """Distinct word bigrams of the normalised text, sorted."""
    words = re.findall("[a-z0-9]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    return sorted({f"{a} {b}" for a, b in zip(words, words[1:], strict=False)})


def template_rows(templates: dict[str, list[str]] = TEMPLATES) -> list[tuple[str, list[str]]]:
    return [(name, grams) for name in sorted(templates) for text in templates[name] if (grams := bigrams(text))]


def signal_bigrams(rows: list[tuple[str, list[str]]], threshold: float) -> list[str]:
    """Bigrams of which any text that reaches the threshold against some template holds one at least.

    A text of a bigrams that reaches it against m shares at least ``threshold * (a + m) / 2`` of them, and has
    at least ``threshold * m / (2 - threshold)`` itself; so it can miss only the rest of the m.  Bigrams of
    few templates are taken first.
    """
    spread = Counter(g for _, grams in rows for g in grams)
    out: dict[str, None] = {}
    for _, grams in rows:
        m = len(grams)
        shared = -(-round(threshold * m / (2 - threshold) * 10**6) // 10**6)
        need = m - shared + 1
        have = [g for g in grams if g in out]
        for g in sorted((g for g in grams if g not in out), key=lambda g: (spread[g], -len(g), g))[: max(0, need - len(have))]:
            out[g] = None
    return sorted(out)


def signal_pattern(signals: list[str]) -> str:
    """Finds a signal bigram in a text as it stands: two words, and anything that separates words between."""
    seconds: dict[str, list[str]] = {}
    for gram in signals:
        first, second = gram.split(" ")
        seconds.setdefault(first, []).append(second)
    return "(?i)(?<![a-z0-9])(?:" + "|".join(f"{a}[^a-z0-9]++(?:{'|'.join(b)})" for a, b in seconds.items()) + ")(?![a-z0-9])"


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, templates: dict[str, list[str]] = TEMPLATES, windows: bool = False) -> DataFrame:
    """One row a document: id, ``license`` (null if none), ``dice`` of its best match (0.0 if none), ``n_matches``.

    Units are the lines and the paragraphs (runs of lines without an empty one) of the whole text.  A unit is
    lower-cased (A-Z), everything but a-z and 0-9 separates words, and its distinct word bigrams are held
    against each template's: ``2 * shared / (unit + template)``.  A unit matches a template from ``threshold``
    on; ``n_matches`` counts distinct matching units.  The best is the highest coefficient, then the first name.

    With ``windows``, what stands in no such unit is sought in windows of words: of each paragraph that does not match, less its
    lines that do, the windows of a template's admissible size that begin and end with one of its bigrams.  Of
    windows that overlap only the best counts, as a further unit.

    A text that holds no signal bigram (``signal_bigrams``) is done at once.  Only units whose number of bigrams lies between the bounds of some template, and which hold one of the
    signal bigrams, are ever compared, and then only with templates whose own bounds admit them.  Everything
    happens within a row: nothing is shuffled.  Null and empty texts have no units.  Rows that repeat an id
    stand for themselves.  An empty table gives none; other columns are not read.
    """
    rows = template_rows(templates)
    low, high = threshold / (2 - threshold) - 1e-9, (2 - threshold) / threshold + 1e-9
    least, most = min(len(g) for _, g in rows) * low, max(len(g) for _, g in rows) * high
    known = F.array(*[F.struct(F.lit(name).alias("name"), F.lit(len(g)).alias("m"), F.array(*map(F.lit, g)).alias("grams")) for name, g in rows])
    signal = signal_pattern(signal_bigrams(rows, threshold))
    signals = F.array(*map(F.lit, signal_bigrams(rows, threshold)))

    text = F.regexp_replace(ascii_lower(F.col(text_col)), r"[^a-z0-9\n]+", " ")
    lines, paragraphs = F.split(text, "\n"), F.transform(F.split(text, r"\n *\n"), lambda p: F.translate(p, "\n", " "))
    words_in = lambda u: F.char_length(u) - F.char_length(F.replace(u, F.lit(" "))) + 1  # noqa: E731  of a trimmed unit
    # A unit of n words has n - 1 bigrams at most; repeated ones make fewer, so only the lower bound holds for words.
    likely = lambda u: words_in(u) - 1 >= F.lit(least)
    units = F.array_distinct(F.filter(F.transform(F.concat(lines, paragraphs), lambda u: F.trim(F.regexp_replace(u, " +", " "))), likely))

    def grams_of(unit):
        words = F.split(unit, " ")
        pairs = F.zip_with(F.slice(words, F.lit(1), F.size(words) - 1), F.slice(words, F.lit(2), F.size(words) - 1), lambda a, b: F.concat(a, F.lit(" "), b))
        return F.array_distinct(pairs)

    def best_of(g):
        n = F.size(g)
        fit = F.filter(known, lambda t: (n >= t["m"] * F.lit(low)) & (n <= t["m"] * F.lit(high)))
        # Struct order: the larger coefficient first by its negative, then the smaller name.
        dice = F.transform(fit, lambda t: F.struct((-2.0 * F.size(F.array_intersect(g, t["grams"])) / (n + t["m"])).alias("dice"), t["name"].alias("name")))
        return F.array_min(F.filter(dice, lambda d: d["dice"] <= -threshold))

    # Lambdas evaluate what they name again at each call; a value bound by another lambda is evaluated once.
    let = lambda value, then: F.element_at(F.transform(F.array(value), then), 1)

    def windows_of(run):
        """Matching windows of a run of words that no better one overlaps."""

        def of_template(t, pairs):
            longest, need = F.floor(t["m"] * F.lit(high)).cast("int"), t["m"] * F.lit(low)

            def from_start(i, at):
                def scored(j):
                    dice = lambda held: -2.0 * F.size(F.array_intersect(held, t["grams"])) / (F.size(held) + t["m"])
                    return F.struct(let(F.array_distinct(F.slice(pairs, i, j - i + 1)), dice).alias("dice"), t["name"].alias("name"), i.alias("first"), j.alias("last"))

                return F.array_min(F.transform(F.filter(at, lambda j: (j - i + 1 >= need) & (j - i < longest)), scored))

            def matching(at):
                starts = F.filter(at, lambda i: F.size(F.array_intersect(F.slice(pairs, i, longest), t["grams"])) >= need)
                return F.filter(F.transform(starts, lambda i: from_start(i, at)), lambda w: w["dice"] <= -threshold)

            return let(F.filter(F.sequence(F.lit(1), F.size(pairs)), lambda k: F.array_contains(t["grams"], F.element_at(pairs, k))), matching)

        def of_pairs(words, pairs):
            fit = F.filter(known, lambda t: F.size(F.array_intersect(pairs, t["grams"])) >= t["m"] * F.lit(low))
            alone = lambda every: F.filter(every, lambda w: ~F.exists(every, lambda v: (v < w) & (v["first"] <= w["last"] + 1) & (w["first"] <= v["last"] + 1)))
            told = let(F.flatten(F.transform(fit, lambda t: of_template(t, pairs))), alone)
            return F.transform(told, lambda w: F.struct(w["dice"].alias("dice"), w["name"].alias("name"), F.array_join(F.slice(words, w["first"], w["last"] - w["first"] + 2), " ").alias("unit")))

        def of_words(words):
            pairs = F.zip_with(F.slice(words, F.lit(1), F.size(words) - 1), F.slice(words, F.lit(2), F.size(words) - 1), lambda a, b: F.concat(a, F.lit(" "), b))
            return let(pairs, lambda p: of_pairs(words, p))

        return let(F.split(run, " "), of_words)

    with_grams = F.transform(units, lambda u: F.struct(u.alias("unit"), grams_of(u).alias("grams")))
    signalled = F.filter(with_grams, lambda x: F.arrays_overlap(x["grams"], signals))
    signalled = F.when(F.col(text_col).rlike(signal), signalled).otherwise(F.array().cast("array<struct<unit:string,grams:array<string>>>"))
    fitting = F.filter(F.col("_signalled"), lambda x: F.size(x["grams"]).between(F.lit(least), F.lit(most)))
    whole = F.filter(F.transform(fitting, lambda x: F.struct(best_of(x["grams"]).alias("best"), x["unit"].alias("unit"))), lambda d: d["best"].isNotNull())
    whole = F.transform(whole, lambda d: F.struct(d["best"]["dice"].alias("dice"), d["best"]["name"].alias("name"), d["unit"].alias("unit")))
    tidy = lambda u: F.trim(F.regexp_replace(F.translate(u, "\n", " "), " +", " "))
    is_whole = lambda u: F.exists(F.col("_whole"), lambda d: d["unit"] == tidy(u))
    # A paragraph that matches goes; a line that does becomes an empty one, which ends a run.
    others = F.filter(F.split(text, r"\n *\n"), lambda p: ~is_whole(p))
    runs = F.flatten(F.transform(others, lambda p: F.split(F.array_join(F.transform(F.split(p, "\n"), lambda x: F.when(is_whole(x), F.lit("")).otherwise(x)), "\n"), r"\n *\n")))
    runs = F.filter(F.transform(runs, tidy), lambda r: likely(r) & r.rlike(signal))
    in_runs = F.when(F.size("_signalled") > 0, F.flatten(F.transform(F.array_distinct(runs), windows_of))).otherwise(F.slice(F.col("_whole"), F.lit(1), F.lit(0)))

    told = docs.select(F.col(id_col), F.col(text_col), signalled.alias("_signalled")).withColumn("_whole", whole)
    found = F.array_distinct(F.concat("_whole", in_runs)) if windows else F.col("_whole")
    told = told.select(F.col(id_col), found.alias("_found")).withColumn("_best", F.array_min("_found"))
    return told.select(
        F.col(id_col),
        F.col("_best.name").alias("license"),
        F.coalesce(F.round(-F.col("_best.dice"), 6), F.lit(0.0)).alias("dice"),
        F.size("_found").cast("long").alias("n_matches"),
    )


def oracle_sql(threshold: float = THRESHOLD, templates: dict[str, list[str]] = TEMPLATES) -> str:
    """The scan in plain SQL, every unit against every template."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    values = ", ".join(f"({quote(name)}, [{', '.join(map(quote, grams))}])" for name, grams in template_rows(templates))
    return rf"""
WITH t(name, grams) AS (VALUES {values}),
d AS (SELECT doc_id, regexp_replace(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^a-z0-9\n]+', ' ', 'g') AS x FROM documents),
u AS (SELECT DISTINCT doc_id, trim(regexp_replace(replace(v, chr(10), ' '), ' +', ' ', 'g')) AS unit
      FROM (SELECT doc_id, unnest(list_concat(string_split(x, chr(10)), regexp_split_to_array(x, '\n *\n'))) AS v FROM d)),
w AS (SELECT doc_id, unit, string_split(unit, ' ') AS ws FROM u WHERE unit <> ''),
g AS (SELECT doc_id, unit, list_distinct([ws[i] || ' ' || ws[i + 1] for i in range(1, len(ws))]) AS gs FROM w WHERE len(ws) > 1),
s AS (SELECT doc_id, gs, name, 2.0::DOUBLE * len(list_intersect(gs, grams)) / (len(gs) + len(grams)) AS dice FROM g, t),
m AS (SELECT doc_id, gs, max(dice) AS dice, arg_min(name, (-dice, name)) AS name FROM s WHERE dice >= {threshold} GROUP BY doc_id, gs),
b AS (SELECT doc_id, arg_min(name, (-dice, name)) AS license, round(max(dice), 6) AS dice, count(*) AS n_matches FROM m GROUP BY doc_id)
SELECT documents.doc_id, license, coalesce(dice, 0.0) AS dice, coalesce(n_matches, 0) AS n_matches
FROM documents LEFT JOIN b USING (doc_id)
"""
