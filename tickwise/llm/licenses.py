"""Licence notices in texts: MinHash bands over windows, exact containment.

Everything is DataFrame functions. A notice is found where a window of a text
holds at least ``CONTAINMENT`` of a template's five-word shingles.

1. A text that can match holds a shingle from every choice of more than
   ``1 - CONTAINMENT`` of a template's shingles, so also one of a few words that
   cover such a choice; other texts are left at once, by substring search.
2. Windows have as many words as a template and overlap by seven eighths or
   more; a window without any template shingle cannot match and is not made.
3. At the worst offset, such a window and its template have a Jaccard
   similarity of 0.58 at least; 24 bands of 2 then collide with probability
   1 - (1 - 0.58^2)^24 > 0.9999. Windows meet templates by a join on bands.
4. Containment is counted on the shingles themselves, at every start between a
   found window's neighbours; of templates that match one window, those with the
   highest containment stay.
"""

from __future__ import annotations

import json
import math
import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickwise.llm.common import stored

WIDTH = 5
CONTAINMENT = 0.8
BANDS = 24
#: Templates are a parameter that every task gets; their shingles are bounded.
MAX_SHINGLES = 20_000

#: The wording of widely used licence notices.
TEMPLATES: tuple[tuple[str, str], ...] = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not "
                   "use this file except in compliance with the License. You may obtain a copy of "
                   "the License at"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
            "software and associated documentation files (the \"Software\"), to deal in the "
            "Software without restriction"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under "
                "the terms of the GNU General Public License as published by the Free Software "
                "Foundation, either version 3 of the License, or (at your option) any later "
                "version."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International "
                  "License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 "
                     "International License."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without "
                     "modification, are permitted provided that the following conditions are met"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, "
                "v. 2.0."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose "
            "with or without fee is hereby granted"),
)


def words(text: Column) -> Column:
    """Lower-cased runs of letters and digits."""
    plain = F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))
    return F.filter(F.split(plain, " "), lambda w: w != "")


def shingles(words_: Column) -> Column:
    """Hash of each run of five words; of all words, if fewer."""
    n = F.size(words_)
    return F.when(n == 0, F.array().cast("array<bigint>")).otherwise(F.transform(
        F.sequence(F.lit(1), F.greatest(n - WIDTH + 1, F.lit(1))),
        lambda i: F.xxhash64(F.array_join(F.slice(words_, i, F.lit(WIDTH)), " "))))


def band_keys(window: Column, bands: int = BANDS) -> Column:
    """Keys of bands of two MinHash coordinates each."""
    def low(k: int) -> Column:
        return F.array_min(F.transform(window, lambda x: F.xxhash64(x, F.lit(k))))

    return F.array(*[F.xxhash64(low(2 * b), low(2 * b + 1), F.lit(b)) for b in range(bands)])


def cover_words(text: str, containment: float = CONTAINMENT) -> set[str]:
    """Words of which a text must hold one to hold ``containment`` of the
    template's shingles: they cover the fewest shingles that cannot all be
    missing, longest words first."""
    w = re.findall(r"[^\W_]+", text.lower())
    runs = [w[i:i + WIDTH] for i in range(max(1, len(w) - WIDTH + 1))] if w else []
    distinct = {tuple(r) for r in runs}
    needed = math.floor((1 - containment) * len(distinct) + 1e-9) + 1
    best: set[str] = set()
    for word in sorted(set(w), key=lambda x: (-len(x), x)):
        if sum(1 for r in distinct if best & set(r)) >= needed:
            break
        best.add(word)
    return best


def _templates(spark: SparkSession, templates: tuple[tuple[str, str], ...]) -> DataFrame:
    """template, license, shingles (distinct) and window length in shingles."""
    rows = json.dumps([{"template": i, "license": k, "text": t}
                       for i, (k, t) in enumerate(templates)])
    parsed = F.from_json(F.lit(rows), "array<struct<template:int,license:string,text:string>>")
    return (spark.range(1).select(F.explode(parsed).alias("t")).select("t.*")
            .withColumn("own", shingles(words(F.col("text"))))
            .select("template", "license", F.size("own").alias("span"),
                    F.array_distinct("own").alias("own")).where("span > 0"))


#: Matches of a text are compared in pieces of so many starts at least.
PLACE = 64


def _best_by_place(matches: DataFrame, widest: int) -> DataFrame:
    """The matches that no better one of another licence overlaps by half or
    more of the shorter window; ``widest`` is the longest window's length.

    Matches meet in pieces of a text, so that a text full of notices is dealt to
    many tasks; a match is offered to every piece in which it may overlap another.
    """
    piece = max(PLACE, widest)
    better = matches.groupBy("doc_id", "t", "license", "span", "start").agg(
        F.max("containment").alias("containment")).select(
        F.col("doc_id").alias("d"), F.col("t").alias("u"), F.col("license").alias("l"),
        F.col("span").alias("n"), F.col("start").alias("s"), F.col("containment").alias("c"),
        F.explode(F.sequence(F.floor((F.col("start") - widest) / piece),
                             F.floor((F.col("start") + F.col("span")) / piece))).alias("q"))
    shared = (F.least(F.col("start") + F.col("span"), F.col("s") + F.col("n"))
              - F.greatest("start", "s"))
    return matches.withColumn("p", F.floor(F.col("start") / piece)).join(
        better, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("t") == F.col("u"))
        & (F.col("p") == F.col("q")) & (F.col("license") != F.col("l"))
        & (F.col("c") > F.col("containment")) & (2 * shared >= F.least("span", "n")),
        "left_anti").drop("p")


def find_licenses(docs: DataFrame, templates: tuple[tuple[str, str], ...] = TEMPLATES,
                  containment: float = CONTAINMENT, bands: int = BANDS,
                  by_place: bool = False) -> DataFrame:
    """One row for each document and licence found in it: doc_id, license, the
    best containment, the first word (from 0) of the best window and the number
    of windows that match.

    Of templates that match one window the best stays. With ``by_place``, a match
    also goes if a better one of another licence, by any template, overlaps it by
    half or more of the shorter of the two: a notice after other text is then not
    reported as another version too. A match that goes still outdoes weaker ones.

    Null and empty texts hold none; a template of fewer than five words is one
    shingle. Each text of an id is judged by itself, equal ones as one; other columns are ignored; an
    empty table or no templates give no rows.
    """
    spark = docs.sparkSession
    known = _templates(spark, templates)
    own = known.collect()                                     # a parameter, bounded below
    if sum(len(r["own"]) for r in own) > MAX_SHINGLES:
        raise ValueError(f"templates of more than {MAX_SHINGLES} shingles in all")
    cover = set().union(*[cover_words(t, containment) for _, t in templates])
    text = F.lower(F.col("text").cast("string"))
    may = F.lit(False)
    for word in sorted(cover):
        may = may | F.contains(text, F.lit(word))
    # arrays that later steps use several times are written first: the optimizer
    # would else repeat their making at every use
    texts = docs.where(may).select(F.col("doc_id").cast("long").alias("doc_id"),
                                   words(F.col("text").cast("string")).alias("w"))
    rows = stored(stored(texts, "words").select("doc_id", shingles(F.col("w")).alias("h"))
                  .withColumn("t", F.xxhash64("h")), "shingles")
    by_span: dict[int, set[int]] = {}
    for r in own:
        by_span.setdefault(r["span"], set()).update(r["own"])

    def starts(span: int, table: set[int]) -> Column:
        """Starts of the windows of ``span`` shingles that hold a template's."""
        step = max(1, span // 8)
        last = F.greatest(F.size("h") - span + 1, F.lit(1))
        hit = F.filter(F.sequence(F.lit(1), F.greatest(F.size("h"), F.lit(1))),
                       lambda i: F.get("h", i - 1).isin(list(table)))
        near = F.array_distinct(F.flatten(F.transform(hit, lambda p: F.transform(
            F.sequence(F.floor((F.greatest(p - span, F.lit(0))) / step).cast("int"),
                       F.floor((p - 1) / step).cast("int")),
            lambda s: F.least(s * step + 1, last)))))
        return F.transform(near, lambda s: F.struct(F.lit(span).alias("span"), s.alias("start")))

    placed = stored(rows.select("doc_id", "t", "h", F.array_distinct(F.concat(
        F.array().cast("array<struct<span:int,start:int>>"),
        *[starts(s, t) for s, t in sorted(by_span.items())])).alias("at")), "windows")
    # with what lies between a window and its neighbours: a notice's own place
    # may be at any start there
    reach = F.greatest(F.floor(F.col("at.span") / 8).cast("int"), F.lit(1)) - 1
    left = F.greatest(F.col("at.start") - reach, F.lit(1))
    windows = (placed.select("doc_id", "t", "h", F.explode("at").alias("at"))
               .select("doc_id", "t", F.col("at.span").alias("span"),
                       F.array_distinct(F.slice("h", F.col("at.start"), F.col("at.span")))
                       .alias("held"), left.alias("left"), (F.col("at.start") + reach).alias("right"),
                       F.slice("h", left, F.col("at.start") + reach + F.col("at.span") - left)
                       .alias("wide")))
    keyed = stored(windows.withColumn("keys", band_keys(F.col("held"), bands)), "banded")
    known_bands = known.withColumn("keys", band_keys(F.col("own"), bands)).select(
        "template", "license", "span", "own", F.posexplode("keys").alias("band", "key"))
    found = (keyed.select("doc_id", "t", "span", "left", "right", "wide",
                          F.posexplode("keys").alias("band", "key"))
             .join(known_bands, ["span", "band", "key"])
             .dropDuplicates(["doc_id", "t", "span", "left", "right", "wide", "template"]))
    last = F.greatest("left", F.least("right", F.col("left") + F.size("wide") - F.col("span")))
    pairs = (found.withColumn("start", F.explode(F.sequence("left", last)))
             .withColumn("held", F.array_distinct(F.slice(
                 "wide", F.col("start") - F.col("left") + 1, F.col("span")))))
    share = F.size(F.array_intersect("held", "own")) / F.size("own")
    # a version's notice also resembles the other version's: the best stays
    best = F.max("containment").over(Window.partitionBy("doc_id", "t", "span", "start"))
    matches = (pairs.withColumn("containment", share)
               .where(F.col("containment") >= containment)
               .dropDuplicates(["doc_id", "t", "span", "start", "held", "template"])
               .select("doc_id", "t", "license", "span", "start", "containment")
               .withColumn("best", best).where("containment = best").drop("best"))
    if by_place:
        matches = _best_by_place(stored(matches, "matches"),
                                 max((r["span"] for r in own), default=1))
    return (matches.groupBy("doc_id", "license").agg(
                F.max("containment").alias("containment"),
                (F.min_by("start", F.struct(-F.col("containment"), F.col("start"))) - 1)
                .cast("long").alias("word"),
                F.count(F.lit(1)).alias("n_windows")))
