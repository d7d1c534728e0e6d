"""Licence scans, in DataFrame functions only.

The whole text, each of its lines, each sentence of a line with several, and windows
of the text's words are compared with licence templates: lower-cased words of letters
and digits, as sets of word bigrams, by the Dice coefficient. With threshold t a
template of b bigrams can only match a unit of b*t/(2-t) to b*(2-t)/t bigrams; units
that no template's bounds admit are dropped before their bigrams are looked up, and
each template only counts for units within its bounds.

A match shares at least t*(low + b)/2 of a template's bigrams, so it holds one of any
set of the template's bigrams that leaves fewer than that: its key bigrams, the longest
ones. A text without any template's key bigram can match nowhere and is dropped before
its units are made. Where a key bigram occurs, the template's whole length is laid over
the text's words with that bigram in its place, whatever lines, comment marks and
sentences the words stand in: a window, cut at the text's ends. Of matching windows of
one template that begin within half its length of the one before, the best is
reported (ties: the first).

The templates are a fixed list of this module, so their index is broadcast.
Null texts and units with fewer than two words have no bigrams and match nothing.
Repeated rows are reported as often as they occur. Texts are taken whole, however long;
other columns of the documents, whatever their names, are not read.
"""

from __future__ import annotations

import re
from collections import defaultdict
from math import ceil, floor

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.text import let, prepare

LEAST_DICE = 0.8

# Customary notices of public licences.
TEMPLATES = {
    "MIT-notice": "Released under the MIT License.",
    "MIT-notice-long": "This project is licensed under the terms of the MIT license.",
    "MIT-grant": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
        "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
        "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
        "following conditions:"
    ),
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0"
    ),
    "GPL-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version."
    ),
    "LGPL-3.0-notice": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "AGPL-3.0-notice": "This work is licensed under the GNU Affero General Public License, version 3.",
    "MPL-2.0-header": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
        "was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."
    ),
    "BSD-notice": "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    "BSD-grant": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met:"
    ),
    "ISC-grant": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies."
    ),
    "Unlicense": "This is free and unencumbered software released into the public domain.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-ND-4.0": "Licensed under CC BY-ND 4.0.",
    "CC0-1.0": "Released under CC0 1.0 Universal.",
    "CC-BY-4.0-long": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0-long": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
}


def _template_words(text: str) -> list[str]:
    return re.findall(r"[^\W_]+", text.lower())


def _bounds(size: int, least: float) -> tuple[int, int]:
    return ceil(size * least / (2 - least) - 1e-9), floor(size * (2 - least) / least + 1e-9)


def _template_rows(templates: dict[str, str], least: float) -> list[tuple]:
    rows = []
    for name, text in sorted(templates.items()):
        words = _template_words(text)
        grams = sorted({f"{a} {b}" for a, b in zip(words, words[1:])})
        low, high = _bounds(len(grams), least)
        rows += [(gram, name, len(grams), low, high) for gram in grams]
    return rows


def key_rows(templates: dict[str, str], least: float) -> list[tuple]:
    """(gram, licence, place, words, template's bigrams, low, high) for each place of a key bigram in its template."""
    rows = []
    for name, text in sorted(templates.items()):
        words = _template_words(text)
        ordered = [f"{a} {b}" for a, b in zip(words, words[1:])]
        grams = sorted(set(ordered), key=lambda g: (-len(g), g))
        low, high = _bounds(len(grams), least)
        keys = set(grams[: len(grams) - ceil(least * (low + len(grams)) / 2 - 1e-9) + 1])
        rows += [(gram, name, k, len(words), sorted(grams), low, high) for k, gram in enumerate(ordered) if gram in keys]
    return rows


def _key_pattern(grams: set[str]) -> str:
    """A regular expression that finds any of the bigrams in a lower-cased text."""
    seconds: dict[str, list[str]] = defaultdict(list)
    for gram in sorted(grams):
        first, second = gram.split(" ")
        seconds[first].append(second)
    pairs = "|".join(f"{first}[^\\p{{L}}\\p{{N}}]+(?:{'|'.join(after)})" for first, after in seconds.items())
    return rf"(?<![\p{{L}}\p{{N}}])(?:{pairs})(?![\p{{L}}\p{{N}}])"


def _words(unit: Column) -> Column:
    return F.filter(F.split(unit, " "), lambda w: w != "")


def _pairs(words: Column) -> Column:
    return F.zip_with(
        F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0))), F.slice(words, 2, F.size(words)),
        lambda a, b: F.concat_ws(" ", a, b))


def _grams(unit: Column) -> Column:
    """Distinct word bigrams of a normal unit."""
    return F.array_distinct(let(_words(unit), _pairs))


def _windows(spark: SparkSession, base: DataFrame, keys: list[tuple], least: float) -> DataFrame:
    """Matches of templates laid over the words of `base` (doc_id, copy, lines) where a key bigram occurs."""
    reach, grams = max(r[3] for r in keys), sorted({r[0] for r in keys})
    index = F.broadcast(spark.createDataFrame(
        keys, "gram string, licence string, shift int, words int, template array<string>, low int, high int"))

    def hits(w: Column) -> Column:
        numbered = F.transform(_pairs(w), lambda g, k: F.struct(g.alias("gram"), k.alias("at")))
        first = lambda h: F.greatest(h["at"] - reach, F.lit(0))
        return F.transform(F.filter(numbered, lambda h: h["gram"].isin(grams)), lambda h: F.struct(
            h["gram"].alias("gram"), h["at"].alias("at"), first(h).alias("first"),
            F.slice(w, first(h) + 1, h["at"] - first(h) + reach).alias("near")))

    found = base.select("doc_id", "copy", F.explode(let(_words(F.translate("lines", "\n", " ")), hits)).alias("h"))
    laid = found.select("doc_id", "copy", "h.*").join(index, "gram").withColumn("start", F.col("at") - F.col("shift"))
    begin = F.greatest("start", F.lit(0))
    inside = F.slice("near", begin - F.col("first") + 1, F.col("start") + F.col("words") - begin)
    laid = laid.withColumn("grams", F.array_distinct(let(inside, _pairs))).withColumn("n_bigrams", F.size("grams"))
    laid = laid.where(F.col("n_bigrams").between(F.col("low"), F.col("high"))).withColumn(
        "n_shared", F.size(F.array_intersect("grams", "template")))
    laid = laid.withColumn("dice", 2 * F.col("n_shared") / (F.col("n_bigrams") + F.size("template")))
    laid = laid.where(F.col("dice") >= least).select(
        "doc_id", "copy", "licence", begin.alias("begin"), "words", "n_bigrams", "n_shared", "dice").distinct()
    order = Window.partitionBy("doc_id", "copy", "licence").orderBy("begin", "n_bigrams", "n_shared")
    apart = F.coalesce(2 * (F.col("begin") - F.lag("begin").over(order)) > F.col("words"), F.lit(True))
    runs = laid.withColumn("run", apart.cast("int"))
    runs = runs.withColumn("run", F.sum("run").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    best = runs.groupBy("doc_id", "copy", "licence", "run").agg(
        F.max(F.struct("dice", (-F.col("begin")).alias("back"), "n_bigrams", "n_shared")).alias("b"))
    return best.select("doc_id", F.lit("window").alias("unit"), (1 - F.col("b.back")).alias("place"), "licence",
                       "b.n_bigrams", "b.n_shared", "b.dice")


def licences(spark: SparkSession, docs: DataFrame, templates: dict[str, str] = TEMPLATES,
             least: float = LEAST_DICE) -> DataFrame:
    """One row per unit and template that match: doc_id, unit, place, licence, n_bigrams, n_shared, dice.

    `unit` is text, line, sentence or window; `place` counts lines, sentences of the text, or its words up to
    the window's first, from 1 (0 for the text).
    """
    prepare(spark)
    keys = key_rows(templates, least)
    rows = _template_rows(templates, least)
    index = F.broadcast(spark.createDataFrame(rows, "gram string, licence string, size int, low int, high int"))
    lowest, highest = min(r[3] for r in rows), max(r[4] for r in rows)
    normal = lambda text: F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}\n]+", " ")
    lines = normal(F.col("text"))
    sentences = normal(F.regexp_replace(F.col("text"), r"([.!?])[\x20\t]+", "$1\n"))
    numbered = lambda kind, column: F.transform(
        F.split(column, "\n"), lambda u, k: F.struct(F.lit(kind).alias("unit"), (k + 1).alias("place"), u.alias("words")))
    whole = F.array(F.struct(F.lit("text").alias("unit"), F.lit(0).alias("place"),
                             F.translate(F.col("lines"), "\n", " ").alias("words")))
    several = F.size(F.split("sentences", "\n")) > F.size(F.split("lines", "\n"))
    none = F.array().cast("array<struct<unit:string,place:int,words:string>>")
    many = F.size(F.split("lines", "\n")) > 1
    base = docs.where(F.lower("text").rlike(_key_pattern({r[0] for r in keys}))).select(
        "doc_id", lines.alias("lines"), sentences.alias("sentences"), F.monotonically_increasing_id().alias("copy")
    )
    units = base.select("doc_id", "copy", F.explode(F.concat(
        whole, F.when(many, numbered("line", F.col("lines"))).otherwise(none),
        F.when(several, numbered("sentence", F.col("sentences"))).otherwise(none),
    )).alias("u")).select("doc_id", "copy", "u.*")
    # At most one bigram per space: cheap bounds before the bigrams are built.
    units = units.where(F.length("words") - F.length(F.replace("words", F.lit(" "), F.lit(""))) >= lowest)
    units = units.select("doc_id", "copy", "unit", "place", _grams(F.col("words")).alias("grams"))
    units = units.withColumn("n_bigrams", F.size("grams")).where(F.col("n_bigrams").between(lowest, highest))
    hits = units.select("doc_id", "copy", "unit", "place", "n_bigrams", F.explode("grams").alias("gram")).join(
        index, "gram").where(F.col("n_bigrams").between(F.col("low"), F.col("high")))
    shared = hits.groupBy("doc_id", "copy", "unit", "place", "licence", "n_bigrams", "size").agg(
        F.count("*").cast("int").alias("n_shared"))
    dice = 2 * F.col("n_shared") / (F.col("n_bigrams") + F.col("size"))
    matched = shared.withColumn("dice", dice).where(F.col("dice") >= least).select(
        "doc_id", "unit", "place", "licence", "n_bigrams", "n_shared", "dice")
    return matched.unionByName(_windows(spark, base, keys, least))
