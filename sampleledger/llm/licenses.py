"""Licence notices in texts, found by MinHash bands and verified by shingle containment.

Templates are the notices by which common licences are named. A text is cut into windows of words
that overlap, in a few sizes, so that some window of the right size holds any notice whole. The
bands of a window's MinHash retrieve the templates that may be in it, and the share of the
template's five-word shingles that the window holds, counted exactly, decides.

With one row a band, a window of similarity s to a template meets it in some band with probability
1 - (1 - s) ** BANDS. The least s of a match follows from the template's own number of shingles and
the window's (``least_similarity``). Where 24 bands find it with probability RECALL or more, bands
retrieve the template. Short templates have less (one shingle of a window's eight in "MIT"): some of
their shingles, so many that no match lacks them all, are keys of their own, which find every match.
Only DataFrame functions are used.
"""

from __future__ import annotations

from collections import Counter
from math import ceil

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SHINGLE, CONTAINED, BANDS = 5, 0.8, 24
SMALLEST = 8
#: Least probability with which bands alone may retrieve a template.
RECALL = 0.9998

# The notices as their licences prescribe or as they are commonly written.
TEMPLATES = {
    "MIT": "Released under the MIT License.",
    "MIT-permission": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
    "LGPL-header": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
    "BSD-conditions": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-work": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC0": "This work has been dedicated to the public domain under CC0 1.0 Universal.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
}


def normal_words(text: Column) -> Column:
    """Lower-case runs of letters and digits."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def plain_words(text: str) -> list[str]:
    return "".join(c if c.isalnum() else " " for c in text.lower()).split()


def size_of(words: int) -> int:
    """The size of windows that serve a template of so many words."""
    size = SMALLEST
    while size < words:
        size = size * 3 // 2
    return size


def plain_shingles(text: str) -> list[str]:
    """The distinct five-word shingles of a template."""
    words = plain_words(text)
    return list(dict.fromkeys(" ".join(words[i : i + SHINGLE]) for i in range(max(1, len(words) - SHINGLE + 1))))


def _needed(many: int) -> int:
    """Shingles of so many that a match holds at least."""
    return next(k for k in range(ceil(CONTAINED * many) - 1, many + 1) if k / many >= CONTAINED)


def least_similarity(text: str) -> float:
    """The least Jaccard similarity of a template to a window that matches: the window has as many
    other shingles as it has room for."""
    many, room = len(plain_shingles(text)), size_of(len(plain_words(text))) * 3 // 2 - SHINGLE + 1
    return _needed(many) / (many + room - _needed(many))


def sure_shingles(text: str) -> list[str]:
    """Shingles of which every match holds one, for a template that bands find too seldom."""
    if 1 - (1 - least_similarity(text)) ** BANDS >= RECALL:
        return []
    found = plain_shingles(text)
    return found[: len(found) - _needed(len(found)) + 1]


def needed_words(templates: dict[str, str]) -> list[str]:
    """A few words, one of which every text with a match must hold.

    A text without any of a set of words lacks all shingles with one of them. For each template the
    set takes words, long and widely useful ones first, until the shingles without them are too few for a
    match; so nothing that matches is passed over.
    """
    shingles = {n: [w[i : i + SHINGLE] for i in range(max(1, len(w) - SHINGLE + 1))] for n, w in ((n, plain_words(t)) for n, t in templates.items())}
    spread = Counter(w for many in shingles.values() for w in {w for s in many for w in s} if len(w) > 3)
    chosen: set[str] = set()
    for many in shingles.values():
        while sum(not chosen & set(s) for s in many) >= CONTAINED * len(set(map(tuple, many))):
            rest = {w for s in many for w in s} - chosen
            chosen.add(max(rest, key=lambda w: (len(w) >= 7, spread[w], sum(w in s for s in many), w)))
    return sorted(chosen)


def shingles(words: Column) -> Column:
    """Hashes of the distinct five-word shingles; fewer words are one shingle."""
    last = F.greatest(F.size(words) - SHINGLE + 1, F.lit(1))
    each = F.transform(F.sequence(F.lit(1), last), lambda i: F.xxhash64(F.array_join(F.slice(words, i, SHINGLE), " ")))
    return F.when(F.size(words) > 0, F.array_distinct(each)).otherwise(F.array().cast("array<bigint>"))


def bands(marks: Column) -> Column:
    """(band, value): the smallest of each seeded hash of the shingles."""

    def smallest(band: int) -> Column:
        return F.array_min(F.transform(marks, lambda x: F.xxhash64(x, F.lit(band))))

    return F.array(*[F.struct(F.lit(b).alias("band"), smallest(b).alias("value")) for b in range(BANDS)])


def sure_keys(texts: list[str]) -> Column:
    """The hashes of the templates' sure shingles."""
    return F.array(*[F.xxhash64(F.lit(x)) for x in dict.fromkeys(x for t in texts for x in sure_shingles(t))]).cast("array<bigint>")


def keys(marks: Column, sure: Column) -> Column:
    """(band, value): the bands, and those of the sure shingles among ``marks`` as one band more."""
    return F.concat(bands(marks), F.transform(F.array_intersect(marks, sure), lambda x: F.struct(F.lit(BANDS).alias("band"), x.alias("value"))))


def template_table(spark: SparkSession, templates: dict[str, str]) -> DataFrame:
    """(license, size, marks, sure) of the templates, whose number is that of the parameter."""
    rows = [
        F.struct(F.lit(n).alias("license"), F.lit(size_of(len(plain_words(t)))).alias("size"), F.lit(t).alias("notice"), sure_keys([t]).alias("sure"))
        for n, t in templates.items()
    ]
    out = spark.range(1).select(F.inline(F.array(*rows)))
    return out.select("license", "size", shingles(normal_words(F.col("notice"))).alias("marks"), "sure")


def notices(docs: DataFrame, templates: dict[str, str] = TEMPLATES) -> DataFrame:
    """(doc_id, license, containment, n_windows, first_word): the notices in each text.

    ``containment`` is the largest share of the template's shingles that one window holds,
    ``n_windows`` the windows that hold 0.8 or more, ``first_word`` the place of the first of them,
    from 0. Null, empty and wordless texts have none. Rows that repeat a doc_id add up. A text is
    handled within its own row until only its windows' bands leave it, so a common notice or source
    gathers nowhere.
    """
    spark = docs.sparkSession
    known = template_table(spark, templates)
    low = F.lower("text")
    may = None
    for word in needed_words(templates):
        may = low.contains(word) if may is None else may | low.contains(word)
    rows = docs.filter(may).select("doc_id", normal_words(F.col("text")).alias("words")).filter(F.size("words") > 0)
    sizes = sorted({size_of(len(plain_words(t))) for t in templates.values()})

    def cuts(size: int) -> Column:
        # whole steps, up to the first window that reaches the end
        length, step = size * 3 // 2, size // 2
        last = F.greatest(F.ceil((F.size("words") - length) / step), F.lit(0)).cast("int")
        return F.transform(F.sequence(F.lit(0), last), lambda i: F.struct(F.lit(size).alias("size"), (i * step).alias("at"), F.slice("words", i * step + 1, length).alias("part")))

    windows = rows.select("doc_id", F.inline(F.flatten(F.array(*map(cuts, sizes)))))
    sure = sure_keys(list(templates.values()))
    marked = windows.select("doc_id", "size", "at", shingles(F.col("part")).alias("marks"))
    banded = marked.select("doc_id", "size", "at", F.col("marks").alias("have"), F.explode(keys(F.col("marks"), sure)).alias("b"))
    banded = banded.select("doc_id", "size", "at", "have", "b.band", "b.value")
    asked = known.select("license", "size", F.col("marks").alias("want"), F.explode(keys(F.col("marks"), F.col("sure"))).alias("b")).select("license", "size", "want", "b.band", "b.value")
    # the bounded table of templates against windows; a pair may meet in several bands
    met = banded.join(F.broadcast(asked), ["size", "band", "value"])
    share = F.size(F.array_intersect("want", "have")) / F.size("want")
    good = met.withColumn("containment", share).filter(F.col("containment") >= CONTAINED)
    once = good.groupBy("doc_id", "license", "at").agg(F.max("containment").alias("containment"))
    return once.groupBy("doc_id", "license").agg(
        F.max("containment").alias("containment"), F.count("*").alias("n_windows"), F.min("at").cast("long").alias("first_word")
    )
