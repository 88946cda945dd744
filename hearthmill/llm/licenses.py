"""Licence notices by the Dice coefficient over word bigrams, in DataFrame operations only."""

from __future__ import annotations

from functools import cache
from importlib import resources

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hearthmill.llm.common import known
from hearthmill.llm.contamination import shingles, words
from hearthmill.sources.shared import settle

# Short notices as they are commonly written.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": (
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"
    ),
    "MIT": "Released under the MIT License.",
    "MIT-grant": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the Software), to deal in the Software without restriction, including without limitation the "
        "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"
    ),
    "BSD-3-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met"
    ),
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."
    ),
    "GPL-2.0-header": (
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."
    ),
    "LGPL-2.1-header": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General "
        "Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."
    ),
    "LGPL-3.0-header": (
        "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."
    ),
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
}


# Above this many words a template's passages are located by its unrepeated bigrams.
LONGEST_SPAN = 400


@cache
def full_texts() -> dict[str, str]:
    """Whole licence texts, named by licence and '-text'."""
    folder = resources.files("hearthmill.llm").joinpath("license_texts")
    return {f"{file.name.removesuffix('.txt')}-text": file.read_text("utf-8") for file in sorted(folder.iterdir(), key=lambda f: f.name)}


def _templates(spark: SparkSession, templates: dict[str, str], least: float) -> DataFrame:
    """license, its words, distinct and unrepeated bigrams, places a span may take and bigrams it must share."""
    low, high = least / (2 - least), (2 - least) / least
    rows = spark.createDataFrame(list(templates.items()), "license string, notice string")
    rows = rows.select("license", words(F.col("notice")).alias("w")).withColumn("pattern", F.array_distinct(_bigrams()))
    counted = rows.select("license", F.posexplode(_bigrams()).alias("offset", "g")).groupBy("license", "g").agg(F.count("*").alias("n"), F.min("offset").alias("offset"))
    places = counted.filter("n = 1").groupBy("license").agg(F.sort_array(F.collect_list(F.struct("offset", "g"))).alias("places"))
    return rows.join(places, "license", "left").select(
        "license", "w", "pattern", "places", (F.size("w") > LONGEST_SPAN).alias("long"), (F.size("w") == 1).alias("single"),
        F.expr(f"cast(floor(size(w) * {high} + 1e-9) as int)").alias("most"),
        F.expr(f"cast(ceil(size(pattern) * {low} - 1e-9) as int)").alias("need"),
    )


def _bigrams():
    """Neighbouring words; a single word is taken as it is."""
    return shingles("w", 2)


def license_lines(docs: DataFrame, templates: dict[str, str] | None = None, least: float = 0.8) -> DataFrame:
    """(id, own, line, license, dice): passages similar to a template, by the line they begin in.

    Text is normalised to lower-cased words without punctuation; line ends
    part words only. A passage is the span of words with the highest Dice
    coefficient among those that overlap it, at most as long as ``least``
    admits. A coefficient of ``least`` needs a number of shared bigrams, so
    only documents with that many are searched, from the places of shared
    bigrams. A template beyond LONGEST_SPAN words is looked for where its
    unrepeated bigrams stand in order, and in the whole document; a notice
    inside such a passage is part of it and not reported.
    """
    spark = docs.sparkSession
    texts = settle(_templates(spark, full_texts() | TEMPLATES if templates is None else templates, least), "license-patterns")
    patterns = texts.drop("places", "w")
    # Short templates' bigrams together: a document's other bigrams are put aside once.
    grams = settle(patterns.filter("not long").select(F.array_distinct(F.flatten(F.collect_list("pattern"))).alias("vocabulary")), "license-bigrams")
    cut = docs.select(known("doc_id").alias("id"), F.xxhash64(F.col("text").cast("string")).alias("own"), F.col("text").cast("string").alias("body"))
    cut = cut.withColumn("w", words(F.col("body"))).select("id", "own", "body", "w", F.array_distinct(_bigrams()).alias("g"))
    held = cut.crossJoin(grams).select("id", "own", "body", "w", "g", F.array_intersect("g", "vocabulary").alias("h"))
    # Few documents have as many bigrams as a long template asks for, so its own are compared with all of theirs.
    meets = F.expr(
        "(not long and not single and size(h) >= need and size(array_intersect(h, pattern)) >= need) or (single and array_contains(w, pattern[0]))"
        " or (long and size(g) >= need and size(array_intersect(g, pattern)) >= need)"
    )
    met = held.join(patterns, meets)
    # Each step is exploded from an array of one, so that no later step is folded into it and evaluates it again.
    met = met.select("id", "own", "license", "body", "pattern", "long", "most", "need", F.explode(F.array(F.when(F.col("single"), F.col("w")).otherwise(_bigrams()))).alias("a"))
    # Per place: whether its bigram is the template's, and how far back it last stood (0: not within a span).
    marks = (
        "transform(a, (g, p) -> struct(array_contains(pattern, g) as shared, "
        "cast(array_position(reverse(slice(a, greatest(p - most, 0) + 1, least(p, most))), g) as int) as back))"
    )
    marks = f"if(long, cast(null as array<struct<shared: boolean, back: int>>), {marks})"
    marked = met.select("*", F.explode(F.expr(f"array({marks})")).alias("marks"))
    # Spans begin and end at a shared bigram; a bigram counts where it stands first in the span.
    starts = "filter(sequence(0, size(a) - 1), p -> marks[p].shared and size(array_intersect(slice(a, p + 1, most), pattern)) >= need)"
    first = "(marks[e].back = 0 or e - marks[e].back < p)"
    total, shared = f"(s.total + int({first}))", f"(s.shared + int(marks[e].shared and {first}))"
    dice = f"2.0D * {shared} / ({total} + size(pattern))"
    best = f"if(marks[e].shared and {dice} >= s.best.dice, struct({dice} as dice, p as start, e as stop), s.best)"
    step = f"(s, e) -> struct({total} as total, {shared} as shared, {best} as best)"
    span = f"aggregate(sequence(p, least(p + most, size(a)) - 1), struct(0 as total, 0 as shared, struct(0.0D as dice, p as start, p as stop) as best), {step}).best"
    spans = F.expr(f"if(long or size(a) = 0, cast(array() as array<struct<dice: double, start: int, stop: int>>), transform({starts}, p -> {span}))")
    found = marked.select("id", "own", "license", "body", "long", "a", F.explode(F.array(spans)).alias("spans"))
    found = found.select("id", "own", "license", "body", "long", "a", F.explode(F.array(F.expr(f"filter(spans, x -> x.dice >= {least})"))).alias("near"))
    # Only long passages are still to be found; nothing else of the others' text is kept.
    lines = F.when(F.col("long") | (F.size("near") > 0), F.flatten(F.transform(F.split("body", "\n"), lambda body, line: F.transform(words(body), lambda _: line))))
    found = found.select("id", "own", "license", "long", F.when(F.col("long"), F.col("a")).alias("a"), lines.alias("lines"), _apart("near").alias("kept"))
    found = settle(found.filter("long or size(kept) > 0"), "license-spans")
    passages = settle(_long_passages(found.filter("long"), texts.filter("long"), least), "license-passages")
    notices = found.filter("not long").select("id", "own", "license", "lines", F.explode("kept").alias("k"))
    inside = passages.select("id", "own", F.col("k.start").alias("from"), F.col("k.stop").alias("to"))
    notices = notices.join(inside, ["id", "own"], "left").groupBy("id", "own", "license", "k").agg(
        F.first("lines").alias("lines"), F.max(F.coalesce(F.expr("k.start >= `from` and k.stop <= `to`"), F.lit(False))).alias("part")
    )
    every = notices.filter("not part").select("id", "own", "license", "lines", "k").union(passages.select("id", "own", "license", "lines", "k"))
    return every.select("id", "own", F.expr("lines[k.start]").alias("line"), "license", F.col("k.dice").alias("dice"))


def _apart(spans: str) -> Column:
    """The best of overlapping spans stays: higher coefficient, then earlier."""
    ordered = f"array_sort(transform({spans}, x -> struct(-x.dice as d, x.start as start, x.stop as stop)))"
    kept = "if(exists(kept, k -> k.start <= x.stop and x.start <= k.stop), kept, concat(kept, array(struct(-x.d as dice, x.start as start, x.stop as stop))))"
    return F.expr(f"aggregate({ordered}, slice({spans}, 1, 0), (kept, x) -> {kept})")


def _long_passages(met: DataFrame, patterns: DataFrame, least: float) -> DataFrame:
    """(id, own, license, lines, k): where long templates stand in documents that hold enough of their bigrams.

    A bigram that a template has once tells by its place where the text would
    begin. Beginnings are counted in strips of a sixteenth of the template;
    strips with a twentieth of its bigrams that lie near each other are one
    passage, from the commonest beginning of its first quarter to the
    commonest end of its last.
    """
    places = patterns.select("license", F.size("w").alias("n_words"), F.size("places").alias("n_places"), F.explode("places").alias("x")).select("license", "n_words", "n_places", "x.g", "x.offset")
    stood = met.select("id", "own", "license", F.posexplode("a").alias("p", "g")).join(places, ["license", "g"])
    stood = stood.withColumn("begin", F.col("p") - F.col("offset")).withColumn("strip", F.expr("cast(floor(begin * 16 / n_words) as int)"))
    strips = stood.groupBy("id", "own", "license", "strip", "n_words").agg(
        F.count("*").alias("n"), F.first("n_places").alias("n_places"),
        F.expr("mode(begin, true) filter (where offset * 4 < n_words)").alias("head"), F.expr("count_if(offset * 4 < n_words)").alias("heads"),
        F.expr("mode(begin, true) filter (where offset * 4 >= 3 * n_words)").alias("tail"), F.expr("count_if(offset * 4 >= 3 * n_words)").alias("tails"),
        F.min("begin").alias("low"), F.max("begin").alias("high"),
    ).filter("20 * n >= n_places")
    of_text = "partition by id, own, license order by strip"
    strips = strips.withColumn("new", F.expr(f"int(coalesce(strip - lag(strip) over ({of_text}) > 4, true))"))
    strips = strips.withColumn("passage", F.expr(f"sum(new) over ({of_text})"))
    ends = strips.groupBy("id", "own", "license", "passage").agg(
        F.coalesce(F.max_by("head", F.when(F.col("head").isNotNull(), F.struct("heads", -F.col("strip")))), F.min("low")).alias("begin"),
        (F.coalesce(F.max_by("tail", F.when(F.col("tail").isNotNull(), F.struct("tails", F.col("strip")))), F.max("high")) + F.first("n_words") - 2).alias("end"),
    )
    ends = ends.groupBy("id", "own", "license").agg(F.collect_list(F.struct("begin", "end")).alias("ends"))
    spans = met.join(ends, ["id", "own", "license"], "left").join(patterns.select("license", "pattern"), "license")
    whole = "array(struct(0 as start, size(a) - 1 as stop))"
    cut = f"concat({whole}, coalesce(transform(ends, e -> struct(int(greatest(e.begin, 0)) as start, int(least(e.end, size(a) - 1)) as stop)), array()))"
    own = "slice(a, x.start + 1, x.stop - x.start + 1)"
    dice = f"2.0D * size(array_intersect({own}, pattern)) / (size(array_distinct({own})) + size(pattern))"
    spans = spans.select("id", "own", "license", "lines", "a", "pattern", F.expr(f"filter({cut}, x -> x.start <= x.stop)").alias("cut"))
    spans = spans.select("id", "own", "license", "lines", F.expr(f"filter(transform(cut, x -> struct({dice} as dice, x.start as start, x.stop as stop)), x -> x.dice >= {least})").alias("near"))
    return spans.select("id", "own", "license", "lines", F.explode(_apart("near")).alias("k"))


def document_licenses(docs: DataFrame, templates: dict[str, str] | None = None, least: float = 0.8) -> DataFrame:
    """One row per row of docs: doc_id, license, dice, line, n_lines.

    The best match by coefficient, then line, then name; ``n_lines`` counts
    the lines in which a match of any template begins. Without a match, and for null or
    empty texts, license, dice and line are null and n_lines is 0. Rows that
    repeat give equal rows, empty tables none. Texts of any length are
    searched whole; further columns are not read.
    """
    matches = license_lines(docs, templates, least).distinct()
    best = matches.groupBy("id", "own").agg(
        F.min(F.struct((-F.col("dice")).alias("d"), "line", "license")).alias("best"), F.count_distinct("line").alias("n_lines")
    )
    best = settle(best, "license-matches")
    rows = docs.select("doc_id", known("doc_id").alias("id"), F.xxhash64(F.col("text").cast("string")).alias("own"))
    return rows.join(best, ["id", "own"], "left").select(
        "doc_id", F.col("best.license").alias("license"), (-F.col("best.d")).alias("dice"),
        F.col("best.line").cast("long").alias("line"), F.coalesce("n_lines", F.lit(0)).cast("long").alias("n_lines"),
    )
