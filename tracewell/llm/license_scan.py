"""Licence scan: sparse TF-IDF cosine of headers and licence files to templates, and inheritance from the nearest ancestor directory.

Only DataFrame functions. There are two kinds of templates: short notices, and the full licence texts of the folder ``licenses``. Each kind has
the vocabulary of its templates without stop words; document frequencies are counted over all documents.

Every window of up to WINDOW adjacent lines of a text is a header candidate, so notices that are wrapped or stand in a comment are found.
Lines of marks and stop words only don't count as lines. A window is kept if each of its lines has a word of the notices, becomes a sparse
vector of (line, n, term) rows, and meets the notices in a join on the term.

A text is a licence file in two cases: its whole vector is close to a notice and lines with a word of the notices make up four fifths of it; or its
whole vector is close to a full licence text, four fifths of its words are of those texts, and it has half as many of them as that text or more. A
document without a licence of its own takes that of the licence file in the nearest directory above it, by a join of the distinct
directories' ancestors with the directories that have one. A file grants its licence if it is the text of a licence, or if it has the name of a licence
file (NAMES); a page that only says how it is licensed itself doesn't.

The templates are fixed tables of this module, so broadcasting them is bounded; nothing else is broadcast by hand.

Defined results: a null or empty text, or one without close lines, has no licence of its own. Of equal similarities the first name in the
alphabet counts. Documents without a path inherit nothing. Repeated rows get the same result; without rows there are none.
"""

from __future__ import annotations

import re
from collections import Counter
from functools import cache
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewell.llm.spark_util import cut

HEADER, FILE = 0.72, 0.72
SALTS = 64
#: Lines of a header at most; the longest notice is wrapped to so many at 40 columns.
WINDOW = 6
#: Names of files that speak for their directory.
NAMES = r"(?i)^(un)?licen[cs]e|^copying|^copyright|^notice"
TEXTS = Path(__file__).with_name("licenses")
#: Names and the usual wording of notices.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction"),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "To the extent possible under law, the author has dedicated all copyright to the public domain, CC0 1.0 Universal."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("Proprietary", "All rights reserved."),
]
STOP = ["a", "all", "an", "and", "any", "are", "as", "at", "be", "by", "can", "for", "found", "free", "from", "in", "into", "is", "it", "may", "not", "of", "on", "or", "such", "that", "the", "this", "to", "up", "use", "with", "work", "you"]


def _words(c: Column) -> Column:
    return F.split(F.lower(c), "[^a-z0-9]+")


def templates(spark: SparkSession) -> DataFrame:
    """(template, license, term, tf)."""
    rows = spark.createDataFrame([(i, n, t) for i, (n, t) in enumerate(TEMPLATES)], "template int, license string, t string")
    terms = rows.select("template", "license", F.explode(_words(F.col("t"))).alias("term")).where((F.col("term") != "") & ~F.col("term").isin(STOP))
    return terms.groupBy("template", "license", "term").agg(F.count("*").alias("tf"))


def vocabulary() -> list[str]:
    return sorted({w for _, t in TEMPLATES for w in re.split("[^a-z0-9]+", t.lower()) if w} - set(STOP))


@cache
def full_texts() -> tuple[tuple[str, Counter], ...]:
    """The name and the counts of words of each full licence text."""
    return tuple((p.stem, Counter(w for w in re.split("[^a-z0-9]+", p.read_text("utf-8", "replace").lower()) if w and w not in STOP)) for p in sorted(TEXTS.glob("*.txt")))


def _among(words: list[str]) -> str:
    return "IN (" + ", ".join(f"'{w}'" for w in words) + ")"


def scan(files: DataFrame) -> DataFrame:
    """(doc_id, path, license, similarity, how) of each row of files(doc_id, path, text); how: header, file, inherited or null."""
    spark = files.sparkSession
    given = files.select("doc_id", "path", "text").withColumn("content", F.xxhash64("text"))
    vocab = F.array(*map(F.lit, vocabulary()))
    # Copies of a text are scanned once for each place in the table; the result goes to all of them by the text's hash.
    texts = given.where("text IS NOT NULL")
    copies = texts.groupBy("content").agg(F.count("*").alias("copies"))
    lines = texts.select("content", F.length("text").alias("chars"), F.transform(F.split("text", "\n"), lambda x: F.struct(F.length(x).alias("line_chars"), F.filter(_words(x), lambda w: (w != "") & ~w.isin(STOP)).alias("words"))).alias("lines"))
    lines = lines.select("content", "chars", F.expr("filter(lines, x -> size(x.words) > 0)").alias("lines"))
    lines = lines.select("content", "chars", F.transform("lines", lambda x: F.struct(x["line_chars"].alias("line_chars"), F.filter(x["words"], lambda w: F.array_contains(vocab, w)).alias("words"))).alias("lines"))
    # From each line with a word of the notices, the windows that begin there, as far as every line has such a word.
    begins = "filter(sequence(0, size(lines) - 1), i -> size(lines[i].words) > 0)"
    sizes = f"filter(sequence(1, {WINDOW}), n -> i + n <= size(lines) AND forall(slice(lines, i + 1, n), x -> size(x.words) > 0))"
    window = "struct(i AS line, n AS n, lines[i].line_chars AS line_chars, flatten(transform(slice(lines, i + 1, n), x -> x.words)) AS words)"
    windows = lines.where("size(lines) > 0").select("content", "chars", F.explode(F.expr(f"flatten(transform({begins}, i -> transform({sizes}, n -> {window})))")).alias("w"))
    terms = windows.select("content", "chars", "w.line", "w.n", "w.line_chars", F.explode("w.words").alias("term"))
    key = ["content", "line", "n", "term", "chars", "line_chars"]
    terms = cut(terms.groupBy(*key).agg(F.count("*").alias("times")).join(copies, "content").select(*key, F.expr("times div copies").alias("tf"), "copies"))

    total = F.lit(given.count())
    weigh = lambda df: (F.log((total + 1) / (F.coalesce(df, F.lit(0)) + 1)) + 1).alias("idf")

    def weighted(shape: DataFrame, counted: DataFrame) -> tuple[DataFrame, DataFrame]:
        """The unit vectors of the templates (template, license, term, w), and (term, idf)."""
        idf = cut(shape.select("term").distinct().join(counted, "term", "left").select("term", weigh(F.col("df"))))
        shape = shape.join(F.broadcast(idf), "term").withColumn("w", F.col("tf") * F.col("idf"))
        norms = shape.groupBy("template").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
        return F.broadcast(cut(shape.join(norms, "template").select("template", "license", "term", (F.col("w") / F.col("norm")).alias("w")))), F.broadcast(idf)

    shape, weights = weighted(templates(spark), terms.where("n = 1").select("content", "term", "copies").distinct().groupBy("term").agg(F.sum("copies").alias("df")))

    def closest(rows: DataFrame, shape: DataFrame, weights: DataFrame, *key: str) -> DataFrame:
        """The best template of each vector in rows(key, term, tf), with its cosine."""
        rows = rows.join(weights, "term").withColumn("v", F.col("tf") * F.col("idf"))
        norm = rows.groupBy(*key).agg(F.sqrt(F.sum(F.col("v") * F.col("v"))).alias("norm"))
        dots = rows.join(shape, "term").groupBy(*key, "template", "license").agg(F.sum(rows["v"] * F.col("w")).alias("dot"))
        best = dots.groupBy(*key).agg(F.min(F.struct((-F.round("dot", 9)).alias("minus"), "license")).alias("best"))
        return best.join(norm, list(key)).select(*key, F.col("best.license").alias("license"), F.round(-F.col("best.minus") / F.col("norm"), 6).alias("similarity"))

    own = closest(terms, shape, weights, "content", "line", "n").where(F.col("similarity") >= HEADER)
    own = own.groupBy("content").agg(F.min(F.struct((-F.col("similarity")).alias("minus"), "license")).alias("h"))
    single = terms.where("n = 1")
    short = single.groupBy("content", "term").agg(F.sum("tf").alias("tf"))
    lengths = single.select("content", "line", "chars", "line_chars").distinct().groupBy("content").agg(F.sum("line_chars").alias("covered"), F.first("chars").alias("chars"))
    short = closest(short, shape, weights, "content").where(F.col("similarity") >= FILE).join(lengths.where("5 * covered >= 4 * chars"), "content").select("content", "license", "similarity")

    # Few texts are mostly of words of the full licence texts; the words of all others are only counted for the document frequencies.
    full = full_texts()
    known = sorted(set().union(*(c for _, c in full)))
    sizes = {n: c.total() for n, c in full}
    worded = texts.select("content", F.filter(_words(F.col("text")), lambda w: (w != "") & ~w.isin(STOP)).alias("all")).select("content", F.size("all").alias("size"), F.expr(f"filter(all, w -> w {_among(known)})").alias("words"))
    counted = worded.select(F.explode(F.array_distinct("words")).alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    rows = spark.createDataFrame([(i, n, w, k) for i, (n, c) in enumerate(full) for w, k in sorted(c.items())], "template int, license string, term string, tf long")
    full_shape, full_weights = weighted(rows, counted)
    gate = f"size >= {min(sizes.values()) // 2} AND 5 * size(words) >= 4 * size"
    whole = worded.select("content", "size", F.explode(F.expr(f"CASE WHEN {gate} THEN words END")).alias("term"))
    whole = cut(whole.groupBy("content", "size", "term").agg(F.count("*").alias("times")).join(copies, "content").select("content", "size", "term", F.expr("times div copies").alias("tf")))
    least = F.expr("CASE license " + " ".join(f"WHEN '{n}' THEN {k}" for n, k in sizes.items()) + " END")
    whole = closest(whole, full_shape, full_weights, "content", "size").where((F.col("similarity") >= FILE) & (2 * F.col("size") >= least)).select("content", "license", "similarity")
    whole = whole.withColumn("short", F.lit(False)).unionByName(short.withColumn("short", F.lit(True))).groupBy("content").agg(F.min(F.struct((-F.col("similarity")).alias("minus"), "license", "short")).alias("f"))
    whole = whole.select("content", F.struct("f.license", (-F.col("f.minus")).alias("similarity"), "f.short").alias("f"))
    found = own.join(whole, "content", "full")
    parts = F.split("path", "/")
    rows = given.select("doc_id", "path", "content", F.when(F.size(parts) > 1, F.array_join(F.slice(parts, 1, F.size(parts) - 1), "/")).otherwise(F.when(F.col("path").isNotNull(), F.lit(""))).alias("dir"))
    grants = F.col("f").isNotNull() & F.col("dir").isNotNull() & (~F.col("f.short") | F.element_at(parts, -1).rlike(NAMES))
    rows = cut(rows.join(found, "content", "left").select("doc_id", "path", "dir", F.coalesce(grants, F.lit(False)).alias("grants"), F.coalesce("f.license", "h.license").alias("license"), F.coalesce(F.col("f.similarity"), -F.col("h.minus")).alias("similarity"), F.when(F.col("f").isNotNull(), "file").when(F.col("h").isNotNull(), "header").alias("how")))

    granting = rows.where("grants").groupBy("dir").agg(F.min(F.struct((-F.col("similarity")).alias("minus"), "license")).alias("g")).select(F.col("dir").alias("above"), "g")
    steps = F.split("dir", "/")
    dirs = rows.where("dir IS NOT NULL").select("dir").distinct()
    above = dirs.select("dir", F.explode(F.when(F.col("dir") == "", F.array(F.lit(""))).otherwise(F.concat(F.array(F.lit("")), F.transform(F.sequence(F.lit(1), F.size(steps)), lambda i: F.array_join(F.slice(steps, F.lit(1), i), "/"))))).alias("above"))
    inherited = above.join(granting, "above").groupBy("dir").agg(F.max_by("g", F.length("above")).alias("g"))
    # One directory may hold a large part of all rows (and rows without a path all have the same null), so the join is salted.
    salted = inherited.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    out = rows.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int")).join(salted, ["dir", "salt"], "left")
    return out.select("doc_id", "path", F.coalesce("license", "g.license").alias("license"), F.coalesce(F.col("similarity"), -F.col("g.minus")).alias("similarity"), F.coalesce("how", F.when(F.col("g").isNotNull(), "inherited")).alias("how"))
