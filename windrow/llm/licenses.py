"""License scan: MinHash bands over overlapping windows, then exact shingle containment.

DataFrame expressions only.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from windrow.llm.common import SPACE, stored

SHINGLE_WORDS = 5
LEAST_CONTAINMENT = 0.75
#: A window that holds 75 % of a template's shingles has a Jaccard similarity of at least
#: 0.75 / 1.5 = 0.5 with it (see window_of), so with 24 bands of one row it is missed with
#: probability 0.5 ** 24 = 6e-8 at most.
BANDS = 24
_HASHES = "hashes"


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), SPACE), "")


def shingle_hashes(words: Column) -> Column:
    """64-bit hashes of the shingles, in order; none if there are too few words."""
    count = F.size(words) - (SHINGLE_WORDS - 1)
    return F.when(
        count > 0,
        F.transform(
            F.sequence(F.lit(1), F.greatest(count, F.lit(1))),
            lambda i: F.xxhash64(F.array_join(F.slice(words, i, SHINGLE_WORDS), " ")),
        ),
    ).otherwise(F.array().cast("array<bigint>"))


def signature(hashes: Column) -> Column:
    """The least value of each band's hash function over the shingles."""

    def least(band: int) -> Column:
        return F.array_min(F.transform(hashes, lambda h: F.xxhash64(h, F.lit(band))))

    return F.array(*[least(band) for band in range(BANDS)])


def window_of(n_shingles: int) -> tuple[int, int]:
    """Stride and length of the windows for templates of n shingles: a quarter, and five
    quarters, so that any n shingles in a row lie within one window."""
    stride = max(1, n_shingles // 4)
    return stride, n_shingles + stride


def template_table(spark: SparkSession, templates: Sequence[tuple[str, str]]) -> DataFrame:
    """license, hashes (distinct), n and anchors (each shingle's longest word) of every template."""
    rows = spark.createDataFrame(list(templates), "license string, text string")
    words = rows.select("license", words_of(F.col("text")).alias("words"))
    longest = F.transform(
        F.sequence(F.lit(1), F.size("words") - (SHINGLE_WORDS - 1)),
        lambda i: F.array_max(
            F.transform(F.slice("words", i, SHINGLE_WORDS), lambda w: F.struct(F.length(w), w.alias("word")))
        )["word"],
    )
    if words.where(F.size("words") < SHINGLE_WORDS).count():
        raise ValueError(f"a template needs {SHINGLE_WORDS} words")
    return words.select(
        "license", F.array_distinct(shingle_hashes(F.col("words"))).alias(_HASHES),
        F.array_distinct(longest).alias("anchors"),
    ).withColumn("n", F.size(_HASHES))


def scan_licenses(
    docs: DataFrame, templates: Sequence[tuple[str, str]], id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """doc_id, license, containment and first_word for each template a document's text holds.

    Words are lower-cased runs without white space; a template is held if a window of the text
    holds at least 75 % of its distinct five-word shingles. ``containment`` is that of the best
    window and ``first_word`` the place (from 0) where the first such window starts. Whole
    texts are scanned. Null texts and texts of fewer than five words hold nothing; rows that
    share an id (null included) count as one document; no rows give no rows. Other columns are
    not read. Templates of fewer than five words are refused.

    Texts are only split into words unless they hold an anchor, the longest word of some
    template shingle: without one they share no shingle with any template. Windows without a
    shingle of a template of their length cannot collide with one and are not signed. The
    templates are a parameter and small; joins with them follow Spark's own size check.
    """
    spark = docs.sparkSession
    table = stored(template_table(spark, templates), "license-templates")
    known = table.select("n", _HASHES, "anchors").collect()
    if not known:
        return spark.createDataFrame([], "doc_id bigint, license string, containment double, first_word int")
    anchors = sorted({a for row in known for a in row["anchors"]})
    by_size: dict[int, set[int]] = {}
    for row in known:
        by_size.setdefault(row["n"], set()).update(row[_HASHES])
    words = words_of(F.coalesce(F.col(text_column).cast("string"), F.lit("")))
    likely = docs.select(F.col(id_column).alias("doc_id"), words.alias("words")).where(
        F.arrays_overlap("words", F.lit(anchors))
    )
    # Stored, as Spark would else split the text anew for every shingle.
    likely = stored(likely, "license-words")
    hashed = likely.select("doc_id", shingle_hashes(F.col("words")).alias(_HASHES))
    # Only documents that hold some template shingle go on, with the places of these.
    every = F.lit(np.array(sorted(set().union(*by_size.values())), dtype=np.int64))
    hashed = stored(hashed.where(F.arrays_overlap(_HASHES, every)), "license-likely")

    def windows(n: int, wanted: set[int]) -> Column:
        stride, length = window_of(n)
        size = F.size(_HASHES)
        mine = F.lit(np.array(sorted(wanted), dtype=np.int64))
        places = F.filter(
            F.sequence(F.lit(0), size - 1), lambda i: F.array_contains(mine, F.get(_HASHES, i))
        )
        starts = F.array_distinct(
            F.flatten(
                F.transform(
                    places,
                    lambda p: F.transform(
                        F.sequence(
                            F.greatest(F.lit(0), F.ceil((p - (length - 1)) / stride)).cast("int"),
                            F.floor(p / stride).cast("int"),
                        ),
                        lambda k: k * stride,
                    ),
                )
            )
        )
        return F.transform(
            starts,
            lambda s: F.struct(
                F.lit(n).alias("n"), s.alias("start"), F.slice(_HASHES, s + 1, length).alias("window")
            ),
        )

    found = hashed.select(
        "doc_id", F.explode(F.flatten(F.array(*[windows(n, w) for n, w in sorted(by_size.items())]))).alias("w")
    ).select("doc_id", "w.n", "w.start", "w.window")
    signed = found.select("*", F.posexplode(signature(F.col("window"))).alias("band", "least"))
    bands = table.select("license", "n", F.posexplode(signature(F.col(_HASHES))).alias("band", "least"))
    candidates = (
        signed.join(bands, ["n", "band", "least"])
        .groupBy("doc_id", "license", "start").agg(F.first("window").alias("window"))
    )
    verified = candidates.join(table.select("license", "n", _HASHES), "license").withColumn(
        "containment", F.size(F.array_intersect("window", _HASHES)) / F.col("n")
    )
    best = F.max(F.struct("containment", (-F.col("start")).alias("start"))).alias("best")
    held = verified.where(F.col("containment") >= LEAST_CONTAINMENT).groupBy("doc_id", "license").agg(best)
    return held.select(
        "doc_id", "license", F.round("best.containment", 6).alias("containment"),
        (-F.col("best.start")).alias("first_word"),
    )


#: The notices by which public licenses are applied, and their opening passages.
TEMPLATES: list[tuple[str, str]] = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0 header", "you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under the Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL header", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation,"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,"),
    ("MIT", "Released under the MIT License."),
    ("MIT permission", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
]
