"""License notices in documents: min-hash bands retrieve templates, exact shingle containment verifies them. SQL functions only.

Words are runs of letters and digits in lower case, shingles are ``SHINGLE`` words. A template matches where a window of the text holds at
least ``PERCENT`` of its shingles. Windows belong to a size class and overlap so far that the place of any template of the class lies wholly
in one of them. ``least_similarity`` is the smallest Jaccard similarity of a matching window to its template, computed from the sizes of both; the
lowest of all templates is 0.298. There are as many bands of ``ROWS`` values as retrieve even that match in one window with a chance of a miss
below ``MISS`` (``bands_needed``).

Sibling notices of other licenses differ in a few words, such as a version, NonCommercial or Lesser, and reach each other's share. ``apart`` gives the
shingles that set a template apart from each such sibling; a match with one of them for every sibling is reported under its name. Other matches are
parts of a sibling's notice where windows overlap a reported one, and fall away; elsewhere they are reported as ``unclear`` license of the family, since
the text doesn't say which it is.

Windows need not be cut everywhere: every template has anchor words such that more than (100 - PERCENT) of its shingles hold one of them, so a match
always holds an anchor word, and only windows around anchor words are signed. That loses nothing and skips nearly all text.

Edge cases: null and empty texts and texts without an anchor word match nothing; a text repeated in several rows is scanned in each; a template that
occurs several times in a text is reported once, with its number of matching windows; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.llm.common import id_and_text

SHINGLE, PERCENT, ROWS, MISS = 3, 80, 1, 1e-5

# Public notices, by their usual identifiers.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0",
    "Apache-2.0-header": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with'
    " the License. You may obtain a copy of the License at",
    "BSD-clauses": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the"
    " following conditions are met",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3",
    "GPL-3.0-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License"
    " as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
    "MIT": "Released under the MIT License",
    "MIT-permission": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation"
    ' files (the "Software"), to deal in the Software without restriction',
}

_GRANT = "This program is free software: you can redistribute it and/or modify it under the terms of the GNU {} General Public License as published by the Free Software Foundation, either version {} of the License, or (at your option) any later version"
_OLD_GRANT = _GRANT.replace("software: you", "software; you").replace("Foundation, either", "Foundation; either")
_LIBRARY = _OLD_GRANT.replace("program", "library")
#: Siblings of these, further licenses, and what follows the first sentence.
FURTHER = {
    **{f"{name}-{v}": f"This work is licensed under the GNU {kind}General Public License, version {v}".removesuffix(".0")
       for name, kind, v in [("GPL", "", "2.0"), ("LGPL", "Lesser ", "2.1"), ("LGPL", "Lesser ", "3.0"), ("AGPL", "Affero ", "3.0")]},
    "GPL-2.0-header": _OLD_GRANT.format("", "2"),
    "LGPL-2.1-header": _LIBRARY.format("Lesser", "2.1"),
    "LGPL-3.0-header": _GRANT.format("Lesser", "3"),
    "AGPL-3.0-header": _GRANT.format("Affero", "3"),
    **{f"CC-{c}-4.0-sentence": f"This work is licensed under a Creative Commons {long} 4.0 International License"
       for c, long in [("BY-NC", "Attribution-NonCommercial"), ("BY-SA", "Attribution-ShareAlike"), ("BY-ND", "Attribution-NoDerivatives"),
                       ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"), ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives")]
    },
    **{f"CC-{c}-4.0-short": f"Licensed under CC {c} 4.0" for c in ("BY", "BY-ND", "BY-NC-SA", "BY-NC-ND")},
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the"
    " above copyright notice and this permission notice appear in all copies",
    "MIT-notice": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software",
    "MIT-rights": "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
    "BSD-notice": "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer",
    "BSD-3-endorsement": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived"
    " from this software without specific prior written permission",
    "Apache-2.0-disclaimer": 'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS"'
    " BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied",
}
#: All notices that are looked for.
NOTICES = TEMPLATES | FURTHER


def words_of(text: str) -> list[str]:
    return re.findall("[a-z0-9]+", text.lower())


def shingles_of(words: list[str]) -> list[str]:
    return sorted({" ".join(words[i : i + SHINGLE]) for i in range(max(1, len(words) - SHINGLE + 1))})


def size_class(n: int) -> int:
    """Words of the templates of a class: the next power of two."""
    return 1 << (n - 1).bit_length()


def anchor_words(templates: dict[str, str] = NOTICES, percent: int = PERCENT) -> list[str]:
    """Words without which no template reaches its share of shingles; as few and as long ones as a greedy choice gives."""
    chosen: set[str] = set()
    for text in templates.values():
        shingles = [s.split() for s in shingles_of(words_of(text))]
        need = len(shingles) * (100 - percent)  # in hundredths of shingles
        while 100 * sum(bool(chosen & set(s)) for s in shingles) <= need:
            rest = {w for s in shingles for w in s} - chosen
            chosen.add(max(rest, key=lambda w: (w in ("license", "licensed"), len(w), w)))
    return sorted(chosen)


def license_of(name: str) -> str:
    """The license that a template stands for: its name up to the version, or the first word of names without one."""
    return re.match(r"[A-Za-z0-9-]*?-\d+\.\d+|[A-Za-z]+", name)[0]


def apart(name: str, templates: dict[str, str], percent: int = PERCENT) -> list[list[str]]:
    """The shingles that set a template apart from each one of another license whose notice reaches its share."""
    own = set(shingles_of(words_of(templates[name])))
    others = [set(shingles_of(words_of(t))) for n, t in templates.items() if license_of(n) != license_of(name)]
    return [sorted(own - s) for s in others if 100 * len(own & s) >= percent * len(own)]


def least_similarity(n_shingles: int, size: int, percent: int = PERCENT) -> float:
    """Jaccard similarity of a template to a full window of so many words, all distinct, that holds just its share."""
    need = -(-percent * n_shingles // 100)
    return need / (n_shingles + max(need, size - SHINGLE + 1) - need)


def bands_needed(templates: dict[str, str], percent: int = PERCENT) -> int:
    """Bands that find every match in one window with a chance of a miss of at most MISS."""
    sizes = {c: n for c, n, _ in window_sizes(templates)}
    words = [words_of(t) for t in templates.values()]
    least = min(least_similarity(len(shingles_of(w)), sizes[size_class(len(w))], percent) for w in words)
    return math.ceil(math.log(MISS) / math.log1p(-(least**ROWS))) if least < 1 else 1


def band(shingles: str, number: str) -> str:
    """SQL for one band of an array of shingles: the hash of ROWS minima."""
    minima = [f"array_min(transform({shingles}, s -> xxhash64(s, {number} * {ROWS} + {i})))" for i in range(ROWS)]
    return f"xxhash64({', '.join(minima)}, {number})"


def with_bands(rows: DataFrame, shingles: str, bands: int) -> DataFrame:
    """A row per band: rows with the band's key added as ``band``."""
    return rows.selectExpr("*", f"explode(sequence(0, {bands - 1})) AS number").selectExpr("*", f"{band(shingles, 'number')} AS band").drop("number")


def window_sizes(templates: dict[str, str] = NOTICES) -> list[tuple[int, int, int]]:
    """(class, words of a window, step between windows): a window holds the largest template of its class wherever it begins."""
    classes = sorted({size_class(len(words_of(t))) for t in templates.values()})
    return [(c, c + max(1, c // 4), max(1, c // 4) + 1) for c in classes]


def template_bands(spark, templates: dict[str, str], percent: int = PERCENT) -> DataFrame:
    rows = []
    for name, text in templates.items():
        w, kind = words_of(text), re.match("[A-Z]+", license_of(name).replace("LGPL", "GPL").replace("AGPL", "GPL"), re.I)[0]
        rows.append((name, f"{kind}-unclear", size_class(len(w)), shingles_of(w), apart(name, templates, percent)))
    table = spark.createDataFrame(rows, "license string, unclear string, class int, t_shingles array<string>, apart array<array<string>>")
    return with_bands(table, "t_shingles", bands_needed(templates, percent))


def windows(docs: DataFrame, templates: dict[str, str] = NOTICES, percent: int = PERCENT) -> DataFrame:
    """(doc_id, row, class, at, shingles) of the windows that hold an anchor word; row numbers the rows of docs, which has doc_id and text."""
    anchors = anchor_words(templates, percent)
    listed = ", ".join(f"'{w}'" for w in anchors)
    some = docs.where(F.col("text").rlike("(?i)" + "|".join(anchors)))
    # no filter passes the row number, so the words are split once and not for every use of them
    tokens = some.selectExpr("doc_id", "monotonically_increasing_id() AS row", "filter(split(lower(text), '[^a-z0-9]+'), w -> w != '') AS w")
    placed = tokens.selectExpr("doc_id", "row", "w", f"filter(transform(w, (x, i) -> IF(x IN ({listed}), i, -1)), i -> i >= 0) AS anchors")
    # windows begin at multiples of the step; those that hold place p begin in (p - n, p]
    cuts = ", ".join(
        "transform(array_distinct(flatten(transform(anchors, p -> transform("
        f"sequence(greatest(0, (p - {n} + {step}) div {step}), p div {step}), m -> cast(m * {step} AS int))))),"
        f" at -> struct({c} AS class, at, slice(w, at + 1, {n}) AS v))"
        for c, n, step in window_sizes(templates)
    )
    cut = placed.selectExpr("doc_id", "row", f"inline(flatten(array({cuts})))")
    joined = ", ' ', ".join(f"v[i + {k}]" for k in range(SHINGLE))
    return cut.selectExpr(
        "doc_id", "row", "class", "at",
        f"CASE WHEN size(v) < {SHINGLE} THEN array(array_join(v, ' ')) ELSE"
        f" array_distinct(transform(sequence(0, size(v) - {SHINGLE}), i -> concat({joined}))) END AS shingles",
    )


def scan(docs: DataFrame, templates: dict[str, str] = NOTICES, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document and license found in it: doc_id, license, n_windows, containment (best share of shingles in percent, rounded down).

    Matching needs a join with the templates alone, a table of fixed size, so no text is shuffled.
    """
    signed = with_bands(windows(id_and_text(docs, id_col, text_col), templates, percent), "shingles", bands_needed(templates, percent))
    hits = signed.join(F.broadcast(template_bands(docs.sparkSession, templates, percent)), ["class", "band"])
    share = hits.selectExpr(
        "doc_id", "row", "license", "unclear", "class", "at", "cast(100 * size(array_intersect(shingles, t_shingles)) AS int) AS got",
        "size(t_shingles) AS n", "forall(apart, x -> arrays_overlap(shingles, x)) AS clear",
    )
    width = "CASE class " + " ".join(f"WHEN {c} THEN {n}" for c, n, _ in window_sizes(templates)) + " END"
    kept = share.where(f"got >= {percent} * n").selectExpr("*", f"at + {width} AS upto")
    hit = "struct(license, unclear, class, at, upto, cast(got div n AS int) AS share, clear)"
    found = kept.groupBy("doc_id", "row").agg(F.expr(f"collect_set({hit})").alias("hits"))
    # a match that could be several licenses counts only where none of them is named
    near = "exists(hits, y -> y.clear AND y.unclear = x.unclear AND y.at < x.upto AND x.at < y.upto)"
    named = found.selectExpr("doc_id", "row", f"explode(filter(hits, x -> x.clear OR NOT {near})) AS x").selectExpr(
        "doc_id", "row", "IF(x.clear, x.license, x.unclear) AS license", "x.class", "x.at", "x.share"
    )
    return (
        named.groupBy("doc_id", "row", "license")
        .agg(F.countDistinct("class", "at").alias("n_windows"), F.max("share").alias("containment"))
        .groupBy("doc_id", "license")
        .agg(F.sum("n_windows").alias("n_windows"), F.max("containment").alias("containment"))
    )
