"""License scan: MinHash bands over overlapping text windows retrieve notice templates, exact containment verifies them.
Built-in functions only; a document is judged within its row, so nothing is shuffled.

A text's words are the runs of digits, letters and characters beyond ASCII, lower-cased; a shingle is ``SHINGLE`` words in
a row. Windows of ``WINDOW`` shingles start at every ``STRIDE``-th shingle of a text and at every shingle of a template. A
window's signature is ``BANDS`` bands of ``ROWS`` minima of its shingles' hashes under fixed permutations; a template is
retrieved where a window has a band in common with one of the template's windows. Two windows with Jaccard similarity j
share a band with probability ``1 - (1 - j**ROWS)**BANDS``; equal windows always do. A notice of at least
``WINDOW + STRIDE - 1`` shingles that occurs unchanged contains an aligned window whole, so it is always retrieved; with
changed words it is retrieved with certainty if any aligned window is left whole. Shingles have three words rather than
five since the shortest notices have five words.

Templates too short to hold an aligned window whole are also retrieved by any one of their shingles.

A retrieved template is verified on the shingles around the window, as many on either side as the template has: it is found
if at least ``CONTAINED`` of its distinct shingles are there, and as large a share of those that tell it from each relative.
Relatives are templates of other licenses that hold at least ``RELATED`` of its shingles. Where a few shingles tell two apart,
such as those of the name or the version, that is all of them.

Null texts, and texts or templates with fewer words than a shingle, have no shingles and no licenses. Repeated documents are
judged each; other columns are ignored; without documents the result is empty.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rosterkeep.llm.common import pick
from rosterkeep.llm.license_notices import NOTICES

SHINGLE = 3
WINDOW = 2
STRIDE = 2
BANDS = 2
ROWS = 2
CONTAINED = 0.8
RELATED = 0.5

#: Names of licenses with notices by which texts refer to them.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance '
        "with the License. You may obtain a copy of the License at",
    ),
    (
        "BSD",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met:",
    ),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    (
        "GPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version.",
    ),
    ("MIT", "Released under the MIT License."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction',
    ),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
)

#: Odd multiples of the golden ratio's fraction: the exclusive or with one reorders 64-bit hashes.
_PERMUTATIONS = [(0x9E3779B97F4A7C15 * (2 * i + 1)) % (1 << 64) - (1 << 63) for i in range(BANDS * ROWS)]


def collision_probability(similarity: float, bands: int = BANDS, rows: int = ROWS) -> float:
    return 1 - (1 - similarity**rows) ** bands


def _words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"), lambda w: w != "")


def _shingles(words: Column) -> Column:
    """Hashes of the shingles in order."""
    n = F.size(words) - (SHINGLE - 1)
    return F.when(n > 0, F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda i: F.xxhash64(F.slice(words, i, SHINGLE)))).otherwise(
        F.array().cast("array<bigint>")
    )


def _permuted(constant: int):
    return lambda x: x.bitwiseXOR(F.lit(constant))


def _bands(shingles: Column, start: Column) -> list[Column]:
    """The band keys of the window at a place."""
    window = F.slice(shingles, start, WINDOW)
    minima = [F.array_min(F.transform(window, _permuted(c))) for c in _PERMUTATIONS]
    return [F.xxhash64(F.lit(b), *minima[b * ROWS : (b + 1) * ROWS]) for b in range(BANDS)]


def _band(shingles: Column, b: int):
    return lambda start: _bands(shingles, start)[b]


def _starts(shingles: Column, stride: int) -> Column:
    """Places of windows; the last one also covers a rest shorter than the stride."""
    last = F.size(shingles) - (WINDOW - 1)
    return F.sequence(F.lit(1), F.greatest(last + (stride - 1), F.lit(1)), F.lit(stride))


def _templates(spark: SparkSession, templates) -> list[tuple[str, list[int], list[list[int]]]]:
    """Of each template its name, distinct shingles, and keys of each band; a few values each."""
    rows = spark.createDataFrame([(i, text) for i, (_, text) in enumerate(templates)], "i int, text string")
    cut = rows.select("i", _words(F.col("text")).alias("words")).select("i", _shingles(F.col("words")).alias("shingles"))
    keyed = cut.select(
        "i",
        F.array_distinct("shingles").alias("shingles"),
        *[F.transform(_starts(F.col("shingles"), 1), _band(F.col("shingles"), b)).alias(f"b{b}") for b in range(BANDS)],
    )
    out = [(templates[r["i"]][0], r["shingles"], [r[f"b{b}"] for b in range(BANDS)]) for r in keyed.orderBy("i").collect() if r["shingles"]]
    # Notices that differ only in case or punctuation are one.
    return list({(name, *own): (name, own, keys) for name, own, keys in out}.values())


def _short(own: list[int]) -> bool:
    return len(own) < WINDOW + STRIDE - 1


def _decisive(known: list[tuple[str, list[int], list[list[int]]]]) -> list[list[tuple[list[int], int]]]:
    """For each template the sets of shingles that tell it from its relatives, and how many of each have to be there."""
    out, sets = [], [(name, set(own)) for name, own, _ in known]
    for name, own in sets:
        apart = {frozenset(own - other) for relative, other in sets if relative != name and len(own & other) >= RELATED * len(own)}
        needed = [(x, math.ceil(CONTAINED * len(x))) for x in apart if x]
        every = frozenset().union(*[x for x, n in needed if n == len(x)])
        needed = [(x, n) for x, n in needed if n < len(x)] + ([(every, len(every))] if every else [])
        out.append([(sorted(x), n) for x, n in needed])
    return out


def scan(docs: DataFrame, templates=(*TEMPLATES, *NOTICES)) -> DataFrame:
    """Per document: ``doc_id``, ``n_shingles``, ``n_candidates`` (windows that retrieved a template) and ``found``.

    ``found`` holds for each verified template its license, the share of its shingles, and the word the region starts with.
    """
    known = _templates(docs.sparkSession, templates)
    rows = pick(docs, "doc_id", "text").select("doc_id", _words(F.coalesce("text", F.lit(""))).alias("words"))
    rows = rows.select("doc_id", _shingles(F.col("words")).alias("shingles"))
    shingles = F.col("shingles")
    every = [sorted({k for _, _, keys in known for k in keys[b]}) for b in range(BANDS)]
    shorts = sorted({x for _, own, _ in known if _short(own) for x in own})

    def retrieves(start: Column) -> Column:
        hit = F.lit(False)
        for i in range(STRIDE if shorts else 0):
            hit = hit | F.coalesce(F.get(shingles, start - 1 + i).isin(shorts), F.lit(False))
        for key, own in zip(_bands(shingles, start), every, strict=True):
            hit = hit | key.isin(own)
        return hit

    def keyed(start: Column) -> Column:
        return F.struct(start.alias("start"), F.slice(shingles, start, STRIDE).alias("own"), *[k.alias(f"b{b}") for b, k in enumerate(_bands(shingles, start))])

    candidates = F.when(F.size(shingles) > 0, F.filter(_starts(shingles, STRIDE), retrieves)).otherwise(F.array().cast("array<int>"))
    rows = rows.select("doc_id", "shingles", F.transform(candidates, keyed).alias("candidates"))

    # One literal for all templates; an expression for each would take longer to plan than to run.
    literal = [
        {"license": name, "own": own, "short": own if _short(own) else [], "apart": [{"told": x, "least": n} for x, n in apart]} | {f"b{b}": keys[b] for b in range(BANDS)}
        for (name, own, keys), apart in zip(known, _decisive(known), strict=True)
    ]
    keys_form = "".join(f", b{b}: array<bigint>" for b in range(BANDS))
    form = f"array<struct<license: string, own: array<bigint>, short: array<bigint>, apart: array<struct<told: array<bigint>, least: int>>{keys_form}>>"

    def verified(template: Column) -> Column:
        """The best region among the windows that retrieve this template; its share is 0 where a relative is told apart."""
        n = F.size(template["own"])

        def retrieved(window: Column) -> Column:
            hit = F.arrays_overlap(template["short"], window["own"])
            for b in range(BANDS):
                hit = hit | F.array_contains(template[f"b{b}"], window[f"b{b}"])
            return hit

        def at(window: Column) -> Column:
            first = F.greatest(window["start"] - n, F.lit(1))
            region = F.slice(shingles, first, WINDOW + 2 * n)
            told = F.forall(template["apart"], lambda x: F.size(F.array_intersect(x["told"], region)) >= x["least"])
            share = F.size(F.array_intersect(template["own"], region)) / n.cast("double")
            return F.struct(F.when(told, share).otherwise(0.0).alias("share"), (-first).alias("back"))

        best = F.array_max(F.transform(F.filter("candidates", retrieved), at))
        return F.struct(template["license"].alias("license"), best["share"].alias("contained"), (-best["back"] - 1).alias("word"))

    kind = "array<struct<license: string, contained: double, word: int>>"
    templates_there = F.from_json(F.lit(json.dumps(literal)), form)
    found = F.filter(F.transform(templates_there, verified), lambda x: x["contained"] >= CONTAINED).cast(kind)
    found = F.when(F.size("candidates") > 0, found).otherwise(F.array().cast(kind))
    return rows.select("doc_id", F.size("shingles").cast("long").alias("n_shingles"), F.size("candidates").cast("long").alias("n_candidates"), found.alias("found"))
