"""Licences of files: TF-IDF cosine of their lines and whole texts to templates, then inheritance by directory.

Every line of every file (a header may stand anywhere) and every file as a whole
(a licence file is all licence) is compared with the templates as a sparse TF-IDF
vector. Document frequencies are counted over all lines of all files. A segment's
norm needs the frequencies of all its words, which no task holds; but a segment
cut down to the words of the templates has a cosine at least as high, so only
segments that pass with those few words are joined with the frequencies. Of the
templates that pass in one segment the best counts; a file has the licences of
all its segments. A whole text that resembles a neighbour of what one of its lines
is closer to (GPL 3 for GPL 2) is explained by that line.

A file without a licence of its own takes those of the nearest directory above
it that holds a licence file. Directories are joined with their ancestors, not
files, so a root directory with all files below it is one row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from . import textkit
from .common import Scratch, small

# least cosine of a segment and a template
THRESHOLD = 0.7
# base names of licence files
LICENSE_FILE = r"(?i)^(licen[cs]e|copying|unlicense|notice)([-_.].*)?$"

# SPDX identifiers and the customary notices of these licences; callers may pass others. The first sentence of
# the BSD licences is the same in both and stands for the longer one.
_CC = "This work is licensed under a Creative Commons {} International License."
_GNU = "This work is licensed under the GNU {}General Public License, version {}."
_FREE = (
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU {}General Public License "
    "as published by the Free Software Foundation, either version {} of the License, or (at your option) any later version."
)
_CLAUSES = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    *[(name, text.format(kind, version)) for text in (_GNU, _FREE) for name, kind, version in [
        ("GPL-3.0", "", "3"), ("GPL-2.0", "", "2"), ("LGPL-3.0", "Lesser ", "3"), ("LGPL-2.1", "Lesser ", "2.1"), ("AGPL-3.0", "Affero ", "3"),
    ]],
    *[(f"CC-{short}-4.0", f"Licensed under CC {short} 4.0.") for short in ("BY-NC", "BY", "BY-SA", "BY-ND", "BY-NC-SA", "BY-NC-ND")],
    *[(f"CC-{short}-4.0", _CC.format(f"{full} 4.0")) for short, full in [
        ("BY-NC", "Attribution-NonCommercial"), ("BY", "Attribution"), ("BY-SA", "Attribution-ShareAlike"), ("BY-ND", "Attribution-NoDerivatives"),
        ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"), ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives"),
    ]],
    ("BSD-3-Clause", _CLAUSES),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("BSD-2-Clause", "Released under the BSD 2-Clause License."),
    ("ISC", "Released under the ISC License."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that "
            "the above copyright notice and this permission notice appear in all copies."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
]


def _segments(part: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of every word: its hash, its text, its line over all texts; and the first line of each text."""
    words = textkit.Words(part, between=textkit.MARKS)
    doc = np.repeat(np.arange(len(part)), np.diff(words.bounds))
    line = np.searchsorted(words.breaks, words.starts) + doc  # a text's end ends a line too
    first = np.searchsorted(words.breaks, words.text_starts) + np.arange(len(part))
    return words.hashes(), doc, line, first


def _frequency_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of (text) to (term, df), partial counts of lines; the term null counts all lines with words."""
    for batch in batches:
        for _, part in textkit.pieces(batch.column(0)):
            hashes, _, line, _ = _segments(part)
            order = np.lexsort((line, hashes))
            h, l = hashes[order], line[order]
            new = np.ones(len(h), bool)
            new[1:] = (h[1:] != h[:-1]) | (l[1:] != l[:-1])
            terms, df = np.unique(h[new], return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array([None, *terms.view(np.int64).tolist()], pa.int64()), pa.array([len(np.unique(line)), *df.tolist()], pa.int64())], names=["term", "df"]
            )


def _template_vectors(templates: list[tuple[str, str]], idf: dict[int, float], unseen: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(sorted terms, their idf, (term, template) unit vectors)."""
    words = textkit.Words(pa.array([t for _, t in templates], pa.string()), between=textkit.MARKS)
    hashes = words.hashes()
    terms = np.unique(hashes)
    weights = np.array([idf.get(int(t), unseen) for t in terms.view(np.int64)])
    vectors = np.zeros((len(terms), len(templates)))
    for i in range(len(templates)):
        np.add.at(vectors[:, i], np.searchsorted(terms, hashes[words.bounds[i] : words.bounds[i + 1]]), 1)
    vectors *= weights[:, None]
    # a template without words matches nothing
    return terms, weights, vectors / np.maximum(np.linalg.norm(vectors, axis=0), 1e-300)


def _candidate_rows(terms: np.ndarray, idf: np.ndarray, vectors: np.ndarray):
    """Batches of (row, text) to candidate segments (row, whole, template, dot, words, tf)."""

    def of(seg: np.ndarray, hashes: np.ndarray, n: int) -> Iterator[tuple]:
        at = np.searchsorted(terms, hashes)
        hit = terms[np.minimum(at, len(terms) - 1)] == hashes
        keys, tf = np.unique(seg[hit] * len(terms) + at[hit], return_counts=True)
        s, t = keys // len(terms), keys % len(terms)
        weight = tf * idf[t]
        norm = np.bincount(s, weight * weight, minlength=n)
        # all templates have one norm, so the largest dot product is the largest cosine
        best, dot = np.zeros(n, np.int64), np.zeros(n)
        for i in range(vectors.shape[1]):
            held = np.flatnonzero(vectors[t, i])
            mine = np.bincount(s[held], weight[held] * vectors[t[held], i], minlength=n)
            best[mine > dot + 1e-12] = i
            dot = np.where(best == i, mine, dot) if i else mine
        for k in np.flatnonzero((dot >= THRESHOLD * np.sqrt(norm) - 1e-9) & (dot > 0)):
            own, count = np.unique(hashes[seg == k], return_counts=True)
            yield int(k), int(best[k]), float(dot[k]), own.view(np.int64).tolist(), count.tolist()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, part in textkit.pieces(batch.column(1)):
                hashes, doc, line, first = _segments(part)
                if not len(hashes):
                    continue
                found = [(start + int(np.searchsorted(first, k, side="right") - 1), False, *rest) for k, *rest in of(line, hashes, int(line[-1]) + 1)]
                found += [(start + k, True, *rest) for k, *rest in of(doc, hashes, len(part))]
                columns = list(zip(*found)) or [[]] * 6
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(columns[0], pa.int64())), pa.array(columns[1], pa.bool_()), pa.array(columns[2], pa.int32()),
                     pa.array(columns[3], pa.float64()), pa.array(columns[4], pa.list_(pa.int64())), pa.array(columns[5], pa.list_(pa.int64()))],
                    names=["row", "whole", "template", "dot", "words", "tf"],
                )

    return rows


def own_licenses(files: DataFrame, scratch: Scratch, templates: list[tuple[str, str]]) -> DataFrame:
    """``(row, own, cosine)``: the licences of all segments of each file, for ``files`` (row, text) with one at all."""
    counts = scratch.save(
        files.select("text").mapInArrow(_frequency_rows, "term bigint, df bigint").groupBy("term").agg(F.sum("df").alias("df")), "frequencies"
    )
    lines = (counts.filter("term is null").first() or {"df": 0})["df"]
    idf = F.log((1 + F.lit(lines)) / (1 + F.coalesce("df", F.lit(0)))) + 1
    # the words of the templates: a few hundred
    words = textkit.Words(pa.array([t for _, t in templates], pa.string()), between=textkit.MARKS).hashes()
    wanted = [int(t) for t in np.unique(words).view(np.int64)]
    known = {r["term"]: r["idf"] for r in counts.filter(F.col("term").isin(wanted)).select("term", idf.alias("idf")).collect()}
    vectors = _template_vectors(templates, known, float(np.log(1 + lines) + 1))
    kind = files.schema["row"].dataType.simpleString()
    shape = f"row {kind}, whole boolean, template int, dot double, words array<bigint>, tf array<bigint>"
    found = files.select("row", "text").mapInArrow(_candidate_rows(*vectors), shape)
    found = scratch.save(found.withColumn("segment", F.monotonically_increasing_id()), "candidates")
    terms = found.select("segment", F.explode(F.arrays_zip("words", "tf")).alias("t")).select("segment", F.col("t.words").alias("term"), F.col("t.tf").alias("tf"))
    norms = terms.join(counts.filter("term is not null"), "term").groupBy("segment").agg(F.sqrt(F.sum((F.col("tf") * idf) ** 2)).alias("norm"))
    scored = found.join(norms, "segment").withColumn("cosine", F.col("dot") / F.col("norm")).filter(F.col("cosine") >= THRESHOLD - 1e-9)
    # per file at most two rows of each template
    best = scored.groupBy("row", "whole", "template").agg(F.max("cosine").alias("cosine"))
    best = best.groupBy("row").agg(F.collect_list(F.struct("whole", "template", "cosine")).alias("found"), F.max("cosine").alias("cosine"))
    near = np.argwhere(vectors[2].T @ vectors[2] >= THRESHOLD)
    near = F.array(*[F.lit(int(a * len(templates) + b)) for a, b in near]).cast("array<int>")
    names = F.array(*[F.lit(n) for n, _ in templates])

    def stays(s):
        closer = lambda l: ~l["whole"] & (l["cosine"] >= s["cosine"]) & F.array_contains(near, s["template"] * len(templates) + l["template"])
        return ~s["whole"] | ~F.exists("found", closer)

    own = F.transform(F.filter("found", stays), lambda s: F.element_at(names, s["template"] + 1))
    return best.select("row", F.sort_array(F.array_distinct(own)).alias("own"), "cosine")


def _directory(path: str):
    """The directory of a path, '' at the root."""
    return F.regexp_replace(path, r"/?[^/]*$", "")


def scan_licenses(
    files: DataFrame, path_column: str = "path", text_column: str = "text", templates: list[tuple[str, str]] | None = None
) -> DataFrame:
    """``(path, licenses, origin, cosine, distance)`` for every row of ``files``.

    ``licenses`` holds SPDX identifiers, or the names in ``templates`` (name, text):
    the file's own licences (``origin`` "own", with the best cosine), else all those of licence files in the nearest directory at or
    above the file's ("inherited", ``distance`` directories up), else nothing
    ("none"). A licence file without a recognised licence declares none. Paths
    are relative, with "/" between names.

    Null and empty texts have no licence of their own; a null path lies in no
    directory and inherits nothing. Repeated rows are files each. An empty table
    gives no rows. Other columns are ignored.
    """
    scratch = Scratch(files.sparkSession, "licenses")
    given = files.select(F.col(path_column).alias("path"), F.col(text_column).alias("text"))
    slim = scratch.save(given.withColumn("row", F.monotonically_increasing_id()), "files")
    own, n_own = scratch.save_counted(own_licenses(slim.select("row", "text"), scratch, TEMPLATES if templates is None else templates), "own")
    placed = slim.select("row", "path", _directory("path").alias("directory")).join(small(own, n_own["n"], 64), "row", "left")
    placed = scratch.save(placed, "placed")
    declares = placed.filter(F.col("own").isNotNull() & F.regexp_extract("path", r"[^/]*$", 0).rlike(LICENSE_FILE))
    declared = declares.select("directory", F.explode("own").alias("license")).groupBy("directory").agg(F.sort_array(F.collect_set("license")).alias("declared"))
    declared, n_declared = scratch.save_counted(declared.withColumnRenamed("directory", "above"), "declared")
    # distinct directories without a file of their own to speak for: each with itself and all above it
    needing = placed.filter(F.col("own").isNull() & F.col("path").isNotNull()).select("directory").distinct()
    parts = F.split("directory", "/")
    depth = F.when(F.col("directory") == "", 0).otherwise(F.size(parts))
    above = needing.select("directory", depth.alias("depth"), F.explode(F.sequence(F.lit(0), depth)).alias("level"), parts.alias("parts"))
    above = above.select("directory", (F.col("depth") - F.col("level")).alias("distance"), F.array_join(F.slice("parts", 1, F.col("level")), "/").alias("above"))
    nearest = above.join(small(declared, n_declared["n"], 256), "above").groupBy("directory").agg(F.min(F.struct("distance", "declared")).alias("nearest"))
    nearest, n_nearest = scratch.save_counted(nearest, "nearest")
    joined = placed.join(small(nearest, n_nearest["n"], 256), "directory", "left")
    mine = F.col("own").isNotNull()
    return joined.select(
        F.col("path").alias(path_column),
        F.when(mine, F.col("own")).otherwise(F.coalesce("nearest.declared", F.lit([]).cast("array<string>"))).alias("licenses"),
        F.when(mine, "own").when(F.col("nearest").isNotNull(), "inherited").otherwise("none").alias("origin"),
        F.when(mine, F.col("cosine")).alias("cosine"), F.when(~mine, F.col("nearest.distance")).alias("distance"),
    )
