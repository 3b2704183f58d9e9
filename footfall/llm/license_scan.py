"""License scan: TF-IDF cosine of passages and files to templates, inheritance by directory.

Built from DataFrame functions only. A line, a run of lines about as long as a template or a
leading comment that is close to a template is a license header; a
file that is close to one as a whole is a license file and speaks for its directory. A file
without a header inherits from the license file in the nearest directory above it.
"""

from __future__ import annotations

import math
import re
from collections.abc import Sequence
from pathlib import Path

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from footfall.llm.common import fresh, identified, quoted, stored, text_or_empty

#: Customary license notices, as published with the licenses.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this '
        "file except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0",
    ),
    ("MIT", "Released under the MIT License."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        'software and associated documentation files (the "Software"), to deal in the Software '
        "without restriction",
    ),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    (
        "GPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the "
        "terms of the GNU General Public License as published by the Free Software Foundation, "
        "either version 3 of the License, or (at your option) any later version.",
    ),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3."),
    (
        "MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    ),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("BSD-2-Clause", "Released under the BSD 2-Clause License."),
    (
        "BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met",
    ),
    ("ISC", "Released under the ISC License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0."),
    (
        "Unlicense",
        "This is free and unencumbered software released into the public domain.",
    ),
)
FREE = (
    "This {} is free software: you can redistribute it and/or modify it under the terms of the "
    "GNU {} General Public License as published by the Free Software Foundation, either version "
    "{} of the License, or (at your option) any later version."
)
#: Further notices, so that a wrapped one is not taken for that of a sister license.
NOTICES = (
    ("GPL-2.0", FREE.format("program", "", "2")),
    ("LGPL-2.1", FREE.format("library", "Lesser", "2.1")),
    ("LGPL-3.0", FREE.format("library", "Lesser", "3")),
    ("AGPL-3.0", FREE.format("program", "Affero", "3")),
)
#: The whole texts of licenses.
TEXTS = tuple(
    (path.stem, path.read_text("utf-8"))
    for path in sorted(Path(__file__).with_name("licenses").glob("*.txt"))
)
#: Templates of more words are compared with whole files and leading comments only.
WINDOW_WORDS = 400
#: How a line of a comment begins.
COMMENT = r"^\s*($|#|//|/?\*|--|;|%|<!--|dnl\b|rem\b|REM\b)"
#: The cosine from which a text counts as the license.
THRESHOLD = 0.75
#: Terms are runs of ASCII letters and digits, in lower case.
SPLIT = "[^a-z0-9]+"
#: Decimals a cosine is rounded to before it is compared.
DECIMALS = 6
#: Parts a term common to many passages is dealt over where its weight is looked up.
SALTS = 16


def terms(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), SPLIT), lambda t: t != "")


def document_frequencies(files: DataFrame, text_col: str) -> DataFrame:
    """``term n``: in how many files each term is; the empty term counts the files.

    Counted over all files and whole texts; every task adds up its own before the shuffle.
    """
    found = F.array_distinct(terms(text_or_empty(quoted(text_col))))
    each = files.select(F.explode(F.array_append(found, F.lit(""))).alias("term"))
    return each.groupBy("term").agg(F.count("*").alias("n"))


def inverse_frequencies(
    frequencies: DataFrame, words: Sequence[str]
) -> tuple[dict[str, float], int]:
    """``ln((1 + files) / (1 + files with the term)) + 1`` of ``words``, and the files."""
    rows = frequencies.filter(F.col("term").isin("", *words)).collect()  # template words only
    found = {r.term: r.n for r in rows}
    total = found.get("", 0)
    return {w: math.log((1 + total) / (1 + found.get(w, 0))) + 1 for w in words}, total


def distinctive(vectors: dict[int, dict[str, float]], threshold: float) -> list[str]:
    """Terms of which every text with a cosine of ``threshold`` to a template has at least one.

    Common terms are left out one after the other, the lightest first, as long as no template
    has more than ``threshold`` of its length in the terms left out: by the inequality of Cauchy
    and Schwarz a text that shares only those stays below the threshold.
    """
    weight: dict[str, float] = {}
    for vector in vectors.values():
        for term, value in vector.items():
            weight[term] = min(weight.get(term, value), value)
    holders: dict[str, list[int]] = {}
    for i, vector in vectors.items():
        for term in vector:
            holders.setdefault(term, []).append(i)
    most = {i: (threshold - 1e-6) ** 2 * sum(v * v for v in x.values()) for i, x in vectors.items()}
    share = dict.fromkeys(vectors, 0.0)
    out: set[str] = set()
    for term in sorted(weight, key=lambda t: (weight[t], t)):
        trial = {i: share[i] + vectors[i][term] ** 2 for i in holders[term]}
        if all(value < most[i] for i, value in trial.items()):
            share |= trial
            out.add(term)
    return sorted(set(weight) - out)


def fewest(vector: dict[str, float], threshold: float) -> int:
    """How many terms of the template a text with that cosine has at least (Cauchy-Schwarz)."""
    squares = sorted((v * v for v in vector.values()), reverse=True)
    least, n = (threshold - 1e-6) ** 2 * sum(squares), 0
    while least > 0 and n < len(squares):
        least, n = least - squares[n], n + 1
    return max(n, 1)


def scan_licenses(
    files: DataFrame,
    path_col: str = "path",
    text_col: str = "text",
    templates: Sequence[tuple[str, str]] = TEMPLATES,
    threshold: float = THRESHOLD,
    notices: Sequence[tuple[str, str]] = NOTICES,
    texts: Sequence[tuple[str, str]] = TEXTS,
) -> DataFrame:
    """Every row of ``files`` with ``license similarity line origin``, its text left out.

    Compared are the whole text, its lines, its leading comment, and from each line on as many
    words as a template has. What reaches the threshold with one of ``texts`` goes before what
    does with a notice, and a whole file that does so before its passages.

    ``origin`` is ``file`` where the whole text has the highest cosine, ``header`` where a line
    or passage has it (``line`` is its first one, from 0), ``directory`` where the license comes from the nearest
    directory above that has a license file, and null where there is none; equal cosines go to
    the earlier line, the whole text first, and then to the earlier template. Of several license
    files in a directory the most similar one speaks for it, then the alphabetically last
    license. Directories are the parts of the path before a slash; a null path has none, a null
    or empty text no license of its own. Own columns of the four names are replaced.
    """
    added = ("license", "similarity", "line", "origin")
    files = files.drop(*[c for c in files.columns if c.lower() in added])
    row = fresh(files, "row_name")
    files = identified(files, row)
    templates = [*templates, *notices, *texts]
    split = [re.split(SPLIT, notice.lower()) for _, notice in templates]
    counts = [{t: ts.count(t) for t in ts if t} for ts in split]
    words = sorted({t for c in counts for t in c})
    frequencies = stored(document_frequencies(files, text_col), "frequencies")
    idf, total = inverse_frequencies(frequencies, words)
    vectors = {i: {t: n * idf[t] for t, n in c.items()} for i, c in enumerate(counts)}
    found = stored(
        _own(
            *(files, row, text_col, templates, len(texts), counts, vectors),
            *(idf, frequencies, total, threshold),
        ),
        "licenses",
    )
    rest = [c for c in files.columns if c != text_col]
    path = F.col(quoted(path_col))
    places = files.select(row, path.alias("path"))
    holders = (
        found.filter(F.col("whole") >= threshold)
        .join(places, row)
        .select(F.regexp_replace("path", "/?[^/]*$", "").alias("dir"), "whole", "whole_license")
        .filter("dir IS NOT NULL")
        .groupBy("dir")
        .agg(F.max(F.struct("whole", F.col("whole_license").alias("license"))).alias("best"))
    )
    parts = F.split("path", "/")
    above = F.transform(
        F.sequence(F.lit(0), F.size(parts) - 1),
        lambda n: F.struct(n.alias("depth"), F.array_join(F.slice(parts, 1, n), "/").alias("dir")),
    )
    missing = places.join(found.select(row), row, "left_anti").filter("path IS NOT NULL")
    inherited = (
        missing.select(row, F.explode(above).alias("up"))
        .select(row, "up.depth", "up.dir")
        .join(holders, "dir")
        .groupBy(row)
        .agg(F.max(F.struct("depth", F.col("best.license").alias("license"))).alias("from"))
    )
    return (
        files.select(*[quoted(c) for c in rest])
        .join(found.select(row, "best"), row, "left")
        .join(inherited, row, "left")
        .select(
            *[quoted(c) for c in rest if c != row],
            F.coalesce("best.license", "from.license").alias("license"),
            F.col("best.similarity").alias("similarity"),
            F.when(F.col("best.line") >= 0, F.col("best.line")).alias("line"),
            F.when(F.col("best.line") >= 0, "header")
            .when(F.col("best.line") < 0, "file")
            .when(F.col("from").isNotNull(), "directory")
            .alias("origin"),
        )
    )


def _own(
    files, row, text_col, templates, n_texts, counts, vectors, idf, frequencies, total, threshold
):
    """``row best whole whole_license`` for files with a passage that reaches the threshold."""
    spark = files.sparkSession
    sizes = [sum(c.values()) for c in counts]
    short = [i for i, n in enumerate(sizes) if n <= WINDOW_WORDS]
    needed = F.array(*[F.lit(t) for t in distinctive(vectors, threshold)])
    few = F.array(*[F.lit(t) for t in distinctive({i: vectors[i] for i in short}, threshold)])

    def may_match(text, needed):
        return F.arrays_overlap(F.split(F.lower(text), SPLIT), needed)

    def may_be(words, i):
        """Whether these distinct words hold as many of the template's as it takes."""
        own = F.array(*[F.lit(t) for t in sorted(vectors[i])])
        return F.size(F.array_intersect(words, own)) >= fewest(vectors[i], threshold)

    def may_be_any(words):
        which = [F.when(may_be(words, i), F.lit(i)) for i in range(len(templates))]
        return F.coalesce(*which).isNotNull()

    lengths = [math.sqrt(sum(v * v for v in vectors[i].values())) for i in range(len(templates))]
    # One row per template word: fixed values, so the broadcast is bounded.
    weights = spark.createDataFrame(
        [(t, idf[t], *(vectors[i].get(t, 0.0) for i in range(len(templates)))) for t in idf],
        "term string, idf double, " + ", ".join(f"v{i} double" for i in range(len(templates))),
    )
    text = F.col(quoted(text_col))
    likely = files.filter(may_match(text, needed)).select(row, text.alias("text"))
    lines = likely.select(row, "text", F.split("text", "\n").alias("lines"))
    code = F.array_position(F.transform("lines", lambda x: x.rlike(COMMENT)), False)
    start = F.ltrim("text")
    lead = (
        F.when(start.startswith("/*"), F.substring_index("text", "*/", 1))
        .when(start.startswith("<!--"), F.substring_index("text", "-->", 1))
        .when(code > 1, F.array_join(F.slice("lines", 1, F.greatest(code - 1, F.lit(0))), "\n"))
    )
    # A unit is a passage by its first line (-1: the whole) and size (0: a line, -1: the comment).
    # Words are made in generators, which the optimizer does not copy into the filters above.
    large = F.array(
        *[
            F.struct(
                F.lit(line).alias("line"),
                F.lit(size).alias("size"),
                passage.alias("passage"),
                F.array_distinct(terms(passage)).alias("words"),
            )
            for line, size, passage in ((-1, 0, F.col("text")), (0, -1, F.col("lead")))
        ]
    )
    large = (
        lines.select(row, "text", F.explode(F.array(lead)).alias("lead"))
        .select(row, F.explode(large).alias("p"))
        .select(row, "p.*")
        .filter("passage IS NOT NULL")
        .filter(may_be_any(F.col("words")))
        .drop("words")
    )
    text_ = F.col("text")
    wanted = F.array_compact(
        F.array(
            *[F.when(may_be(F.col("words"), i), F.lit(sizes[i])) for i in short],
        )
    )
    each = (
        likely.filter(may_match(F.col("text"), few))
        .select(row, "text", F.explode(F.array(F.array_distinct(terms(text_)))).alias("words"))
        .select(row, "text", F.explode(F.array(F.array_distinct(wanted))).alias("sizes"))
        .filter(F.size("sizes") > 0)
        .select(row, "sizes", F.posexplode(F.split("text", "\n")).alias("line", "passage"))
        .select("*", F.explode(F.array(terms(F.col("passage")))).alias("words"))
        .filter(F.size("words") > 0)
        .withColumn("hit", F.arrays_overlap("words", few))
    )
    single = each.filter("hit").select(row, "line", F.lit(0).alias("size"), "passage")
    # Each of these lines has a word, so a run of n words takes n lines at most.
    order = Window.partitionBy(row).orderBy("line")
    far = max((sizes[i] for i in short), default=1)
    run = F.slice(F.flatten(F.collect_list("words").over(order.rowsBetween(0, far - 1))), 1, far)
    part = F.slice("run", 1, F.col("size"))
    of_size = F.lit(False)
    for i in short:
        of_size = of_size | ((F.col("size") == sizes[i]) & may_be(F.col("words"), i))
    windows = (
        each.withColumn("ahead", F.max("hit").over(order.rowsBetween(0, far - 1)))
        .withColumn("behind", F.max("hit").over(order.rowsBetween(1 - far, 0)))
        .filter("ahead OR behind")
        .withColumn("run", run)
        .filter("ahead")
        .select(row, "line", "run", F.size("words").alias("first"), F.explode("sizes").alias("size"))
        .filter(F.least(F.col("size"), F.size("run")) > F.col("first"))
        .select(row, "line", "size", F.explode(F.array(part)).alias("words"))
        .filter(of_size)
        .select(row, "line", "size", F.array_join("words", " ").alias("passage"))
    )
    passages = large.unionByName(single).unionByName(windows)
    unit = [row, "line", "size"]
    counted = (
        passages.select(*unit, F.explode(terms(F.col("passage"))).alias("term"))
        .groupBy(*unit, "term")
        .agg(F.count("*").alias("n"))
        .join(F.broadcast(weights), "term", "left")
        .withColumn("w", F.col("n") * F.col("idf"))
    )
    other = F.col("idf").isNull()
    parts = counted.groupBy(*unit).agg(
        F.coalesce(F.sum(F.col("w") * F.col("w")), F.lit(0.0)).alias("known"),
        F.sum(F.when(other, F.col("n") * F.col("n")).otherwise(0)).alias("least"),
        F.collect_list(F.when(other, F.struct("term", "n"))).alias("others"),
        *[
            F.sum(F.col("w") * F.coalesce(f"v{i}", F.lit(0.0))).alias(f"d{i}")
            for i in range(len(templates))
        ],
    )
    # No term weighs less than 1: what stays below the threshold even so is left out early.
    highest = F.greatest(*[F.col(f"d{i}") / F.lit(x) for i, x in enumerate(lengths)])
    near = stored(
        parts.filter(highest >= F.lit(threshold - 1e-6) * F.sqrt(F.col("known") + F.col("least"))),
        "near",
    )
    rest = near.select(*unit, F.explode("others").alias("o")).select(*unit, "o.term", "o.n")
    idfs = rest.select("term").distinct().join(frequencies, "term").select(
        "term",
        (F.log(F.lit(1.0 + total) / (1 + F.col("n"))) + 1).alias("idf"),
        F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"),
    )
    rest = (
        rest.withColumn("salt", F.pmod(F.xxhash64(row), F.lit(SALTS)).cast("int"))
        .join(idfs, ["term", "salt"])
        .groupBy(*unit)
        .agg(F.sum(F.pow(F.col("n") * F.col("idf"), 2)).alias("rest"))
    )
    dots = near.join(rest, unit, "left").withColumn(
        "length", F.sqrt(F.col("known") + F.coalesce("rest", F.lit(0.0)))
    )
    scored = []
    for i, (name, _) in enumerate(templates):
        cosine = F.round(F.col(f"d{i}") / (F.col("length") * F.lit(lengths[i])), DECIMALS)
        full = (cosine >= threshold) & F.lit(i >= len(templates) - n_texts)
        names = (full.alias("full"), cosine.alias("s"), F.lit(-i).alias("order"))
        scored.append(F.struct(*names, F.lit(name).alias("license")))
    best = dots.select(*unit, F.greatest(*scored).alias("top")).filter(
        F.col("top.s") >= threshold
    )
    whole = F.when(F.col("line") < 0, F.struct("top.full", "top.s", "top.license"))
    return (
        best.groupBy(row)
        .agg(
            F.max(
                F.struct(
                    (F.col("top.full") & (F.col("line") < 0)).alias("file"),
                    F.col("top.full").alias("full"),
                    F.col("top.s").alias("similarity"),
                    (-F.col("line")).alias("up"),
                    (-F.abs("size")).alias("narrow"),
                    F.col("line").alias("line"),
                    F.col("top.license").alias("license"),
                )
            ).alias("best"),
            F.max(whole).alias("of_whole"),
        )
        .select(
            row,
            "best",
            F.col("of_whole.s").alias("whole"),
            F.col("of_whole.license").alias("whole_license"),
        )
    )
