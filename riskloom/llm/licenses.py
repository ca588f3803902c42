"""Licence scans: MinHash bands over overlapping text windows retrieve templates, exact containment verifies them.

A text becomes digests of its five-word shingles. For each template length n it is cut into windows of 2n
shingles that overlap by half, so any passage of n shingles lies whole in one window. A window's MinHash values, in bands,
are looked up among the templates' bands; a window that holds a template to the wanted share is retrieved with a
probability of at least ``ASSURED``, from which the number of bands follows. Retrieved templates are verified by the
share of their shingles that the window really holds. Only SQL expressions are used, row by row, without a shuffle.

Texts and windows without any of the anchor words are passed over. That loses nothing: the anchors are chosen so that, in every
template, more shingles hold one than a match may lack. All templates share a few anchors, which choose the texts; the
windows of a length are chosen by the anchors of its own templates.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm.shared import fresh, read

SHINGLE = 5
CONTAINED = 0.8
ROWS = 1
ASSURED = 0.9999

# Customary notices and opening paragraphs of public licences.
TEMPLATES = {
    "mit-notice": "Released under the MIT License.",
    "mit": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
        "permit persons to whom the Software is furnished to do so"
    ),
    "apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0": (
        "you may not use this file except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0"
    ),
    "gpl-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "gpl": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation"
    ),
    "cc-by-nc-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "cc-by-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "bsd": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met"
    ),
    "isc": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies."
    ),
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "unlicense": "This is free and unencumbered software released into the public domain.",
    "warranty": "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED",
}


def words_of(text: str) -> list[str]:
    """Runs of letters and digits, in lower case, as the scan takes them."""
    return re.findall(r"[^\W_]+", text.lower())


def shingles_of(text: str) -> list[str]:
    w = words_of(text)
    return [" ".join(w[i : i + SHINGLE]) for i in range(len(w) - SHINGLE + 1)]


def bands_needed(rows: int = ROWS, contained: float = CONTAINED, assured: float = ASSURED) -> int:
    """Bands of ``rows`` values so that a window of 2n shingles with ``contained`` of a template's n is found that surely.

    The window's resemblance to the template is at least contained * n / (2n + (1 - contained) * n).
    """
    alike = contained / (3 - contained)
    return math.ceil(math.log(1 - assured) / math.log(1 - alike**rows))


def anchors(templates: dict[str, str] = TEMPLATES, contained: float = CONTAINED) -> list[str]:
    """A few words such that more than 1 - ``contained`` of every template's shingles hold one of them."""
    lists = {name: [s.split() for s in shingles_of(t)] for name, t in templates.items()}
    chosen: list[str] = []

    def short(name: str) -> bool:
        return sum(any(a in s for a in chosen) for s in lists[name]) <= (1 - contained) * len(lists[name])

    while left := [n for n in lists if short(n)]:
        votes: dict[str, float] = {}
        for n in left:
            for s in lists[n]:
                for w in set(s):
                    if len(w) >= 3:
                        votes[w] = votes.get(w, 0.0) + len(w) ** 2 / len(lists[n])
        chosen.append(max(votes, key=lambda w: (votes[w], w)))
    return chosen


def _digests(words: Column) -> Column:
    """The digests of the five-word shingles of an array of words."""
    n = F.size(words)
    return F.when(n >= SHINGLE, F.transform(F.sequence(F.lit(1), n - SHINGLE + 1), lambda i: F.xxhash64(F.array_join(F.slice(words, i, SHINGLE), " ")))).otherwise(
        F.array().cast("array<bigint>")
    )


def _signature(window: Column, bands: int, rows: int) -> Column:
    """One digest per band: the band's number and its ``rows`` MinHash values."""
    hashes = F.transform(F.sequence(F.lit(0), F.lit(bands * rows - 1)), lambda j: F.array_min(F.transform(window, lambda h: F.xxhash64(h, j))))
    return F.transform(F.sequence(F.lit(0), F.lit(bands - 1)), lambda b: F.xxhash64(b, F.array_join(F.slice(hashes, b * rows + 1, rows), ",")))


def _let(value: Column, use) -> Column:
    return F.element_at(F.transform(F.array(value), use), 1)


def _verifier(digests: Column, n: int, group: list, bands: int, rows: int):
    """What window number k holds of the templates of ``n`` shingles in ``group``: retrieval by bands, then containment."""

    def judged(window: Column, here: Column) -> Column:
        tests = []
        for r in group:
            share = F.size(F.array_intersect(F.array(*[F.lit(d) for d in r["digests"]]), window)) / F.lit(float(len(r["digests"])))
            met = F.arrays_overlap(here, F.array(*[F.lit(b) for b in r["bands"]]))
            tests.append(F.when(met, F.struct(F.lit(r["name"]).alias("license"), share.alias("containment"))))
        return F.filter(F.array(*tests), lambda t: t.isNotNull() & (t["containment"] >= CONTAINED))

    def at(k: Column) -> Column:
        window = F.slice(digests, (k * n + 1).cast("int"), 2 * n)
        return _let(window, lambda w: _let(_signature(w, bands, rows), lambda here: judged(w, here)))

    return at


def find_licenses(docs: DataFrame, text: str = "text", out: str = "licenses", templates: dict[str, str] = TEMPLATES, rows: int = ROWS) -> DataFrame:
    """``docs`` with an array ``out`` of (license, containment), ordered by name, one entry per template that matches.

    Null, empty and short texts match nothing and get an empty array. Texts are scanned whole. Templates need at least five
    words. Other columns pass unchanged whatever their names; a column already called ``out`` is an error.
    """
    if fresh(docs, out) != out:
        raise ValueError(f"the table already has a column {out}")
    if short := [n for n, t in templates.items() if not shingles_of(t)]:
        raise ValueError(f"templates of less than {SHINGLE} words: {short}")
    spark = docs.sparkSession
    bands = bands_needed(rows)
    words_at = anchors(templates)
    # A dozen templates of fixed size: their shingles and bands are worked out once and become literals.
    side = spark.createDataFrame([(n, sorted(set(shingles_of(t)))) for n, t in templates.items()], "name string, shingles array<string>")
    side = side.withColumn("digests", F.transform("shingles", lambda s: F.xxhash64(s))).withColumn("bands", _signature(F.col("digests"), bands, rows))
    known = sorted(side.select("name", "digests", "bands").collect())
    size = {n: len(shingles_of(templates[n])) for n in templates}
    words = F.filter(F.split(F.regexp_replace(F.lower(F.col(text)), r"[^\p{L}\p{N}]+", " "), " "), lambda w: w != "")
    marked = F.col(text).rlike("(?i)" + "|".join(words_at))
    names = [fresh(docs, x) for x in ("license_words", "license_digests")]
    with_words = docs.withColumn(names[0], F.when(marked, words))
    with_digests = with_words.withColumn(names[1], F.when(F.col(names[0]).isNotNull(), _digests(F.col(names[0]))))
    digests = F.col(names[1])
    found = []
    for n in sorted(set(size.values())):
        group = [r for r in known if size[r["name"]] == n]
        # Each length has anchors of its own templates. Windows [kn, kn + 2n) that hold a shingle with one are looked at;
        # shingles i - 4 .. i hold word i.
        own = anchors({r["name"]: templates[r["name"]] for r in group})
        places = F.filter(F.transform(F.col(names[0]), lambda w, i: F.when(w.isin(own), i)), lambda i: i.isNotNull())  # noqa: B023
        starts = F.array_distinct(
            F.flatten(F.transform(places, lambda i: F.sequence(F.greatest(F.floor((i - SHINGLE + 1) / n) - 1, F.lit(0)).cast("int"), F.floor(i / n).cast("int"))))  # noqa: B023
        )
        starts = F.filter(starts, lambda k: k * n < F.size(digests))  # noqa: B023

        found.append(F.flatten(F.transform(starts, _verifier(digests, n, group, bands, rows))))
    every = fresh(docs, "license_found")
    held = with_digests.withColumn(every, F.when(F.size(digests) > 0, F.concat(*found)))
    best = F.transform(
        F.array_sort(F.array_distinct(F.transform(F.col(every), lambda t: t["license"]))),
        lambda name: F.struct(
            name.alias("license"),
            F.array_max(F.transform(F.filter(F.col(every), lambda t: t["license"] == name), lambda t: t["containment"])).alias("containment"),
        ),
    )
    empty = F.array().cast("array<struct<license:string,containment:double>>")
    return held.select(*[F.col(f"`{c}`") for c in docs.columns], F.coalesce(best, empty).alias(out))


def op7_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, the licences that its whole text holds, and the largest containment, for every document."""
    docs = find_licenses(read(spark, folder, "documents").select("doc_id", "text"))
    return docs.select(
        "doc_id",
        F.array_join(F.transform("licenses", lambda t: t["license"]), ",").alias("licenses"),
        F.coalesce(F.array_max(F.transform("licenses", lambda t: t["containment"])), F.lit(0.0)).alias("containment"),
    )
