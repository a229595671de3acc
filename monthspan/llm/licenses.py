"""License scans: which documents contain which license notices.

Texts are cut into overlapping windows of ``WINDOW`` words, ``STEP`` words apart, so that every run of
``WORDS`` words lies whole in a window. A window's bands are MinHash values of its word shingles, one
value each, under ``BANDS`` orders. A window that holds a shingle of a template meets a template window
in a given band when that shingle comes first in the band's order, one time in n for a window of n
shingles; of all bands at least one does with probability 1 - (1 - 1/n)^bands, over 99.998% for a single
shared shingle and more with each further one. Windows that meet retrieve templates, and a document
contains a template when the exact containment of the template's shingles in the document reaches
``CONTAINMENT``.

Everything is a column expression; only retrieved pairs of a document and a template leave their row.
The templates' bands are the one thing that is handed to every task; their size depends on the
templates alone and is checked.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from monthspan.llm.shared import whole_texts

WORDS = 5
WINDOW = 6
STEP = 2
BANDS = 16
CONTAINMENT = 0.8
# Shingles of all templates together at most.
MOST_SHINGLES = 20_000

# License notices and the operative parts of short licenses, as their stewards publish them.
TEMPLATES = {
    "apache-2.0-line": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-notice": """Licensed under the Apache License, Version 2.0 (the "License"); you may not
        use this file except in compliance with the License. You may obtain a copy of the License at
        http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in
        writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT
        WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the
        specific language governing permissions and limitations under the License.""",
    "bsd-clauses": """Redistribution and use in source and binary forms, with or without modification,
        are permitted provided that the following conditions are met: Redistributions of source code
        must retain the above copyright notice, this list of conditions and the following disclaimer.
        Redistributions in binary form must reproduce the above copyright notice, this list of
        conditions and the following disclaimer in the documentation and/or other materials provided
        with the distribution.""",
    "cc-by-4.0-line": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-nc-4.0-line": "Licensed under CC BY-NC 4.0.",
    "cc-by-sa-4.0-line": """This work is licensed under a Creative Commons Attribution-ShareAlike 4.0
        International License.""",
    "gpl-3.0-line": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-3.0-notice": """This program is free software: you can redistribute it and/or modify it under
        the terms of the GNU General Public License as published by the Free Software Foundation,
        either version 3 of the License, or (at your option) any later version. This program is
        distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the
        implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General
        Public License for more details.""",
    "isc": """Permission to use, copy, modify, and/or distribute this software for any purpose with or
        without fee is hereby granted, provided that the above copyright notice and this permission
        notice appear in all copies.""",
    "mit": """Permission is hereby granted, free of charge, to any person obtaining a copy of this
        software and associated documentation files (the "Software"), to deal in the Software without
        restriction, including without limitation the rights to use, copy, modify, merge, publish,
        distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the
        Software is furnished to do so, subject to the following conditions: The above copyright
        notice and this permission notice shall be included in all copies or substantial portions of
        the Software.""",
    "mit-line": "Released under the MIT License.",
    "mpl-2.0-notice": """This Source Code Form is subject to the terms of the Mozilla Public License,
        v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at
        https://mozilla.org/MPL/2.0/.""",
    "unlicense": """This is free and unencumbered software released into the public domain. Anyone is
        free to copy, modify, publish, use, compile, sell, or distribute this software, either in
        source code form or as a compiled binary, for any purpose, commercial or non-commercial, and
        by any means.""",
}


def words(text: Column) -> Column:
    """Runs of letters and digits, in small letters."""
    told = F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))
    return F.when(told != "", F.split(told, " ")).otherwise(F.array().cast("array<string>"))


def shingles(found: Column) -> Column:
    """Hashes of all runs of ``WORDS`` words; none for fewer words."""
    starts = F.sequence(F.lit(0), F.size(found) - WORDS)
    hashes = F.transform(starts, lambda i: F.xxhash64(*[F.get(found, i + k) for k in range(WORDS)]))
    return F.when(F.size(found) >= WORDS, hashes).otherwise(F.array().cast("array<bigint>"))


def _windows(found: Column, step: int) -> Column:
    """A text's shingles by window."""
    starts = F.sequence(F.lit(1), F.greatest(F.size(found), F.lit(1)), F.lit(step))
    return F.transform(starts, lambda start: F.slice(found, start, F.lit(WINDOW - WORDS + 1)))


def _band(window: str, band: int) -> str:
    """The least of a window's shingles in a band's order, which turns some bits of their hashes."""
    turned = np.random.default_rng(band).integers(-(1 << 63) + 1, 1 << 63)
    return f"least({', '.join(f'get({window}, {i}) ^ {turned}L' for i in range(WINDOW - WORDS + 1))})"


def _longs(values: list[int]) -> str:
    return ", ".join(f"{value}L" for value in values)


def template_table(spark: SparkSession, templates: dict[str, str]) -> DataFrame:
    """license and its shingles; templates of fewer than ``WORDS`` words are an error."""
    rows = spark.createDataFrame(sorted(templates.items()), "license string, text string")
    rows = rows.select("license", words(F.col("text")).alias("words"))
    table = rows.select("license", F.array_distinct(shingles(F.col("words"))).alias("wanted"))
    held = table.select("license", F.size("wanted").alias("n")).collect()
    if short := [r["license"] for r in held if not r["n"]]:
        raise ValueError(f"templates of fewer than {WORDS} words: {short}")
    if sum(r["n"] for r in held) > MOST_SHINGLES:
        raise ValueError(f"the templates have more than {MOST_SHINGLES} shingles")
    return table


def scan(
    docs: DataFrame,
    templates: dict[str, str] = TEMPLATES,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """doc_id, n_licenses, licenses (names, comma-joined in order) and containment (the largest one,
    0 without a license) of every whole text.

    Null and short texts contain nothing. Repeated rows and rows without a doc_id each give a row;
    an empty table gives none; other columns are ignored.
    """
    spark = docs.sparkSession
    table = template_table(spark, templates)
    wanted = {r["license"]: r["wanted"] for r in table.collect()}
    # Windows of a template start at every word, as a text's windows may.
    bands = table.select("license", F.explode(_windows(F.col("wanted"), 1)).alias("window"))
    values = bands.select(*[F.expr(_band("window", b)) for b in range(BANDS)]).distinct().collect()
    known = [sorted({row[b] for row in values}) for b in range(BANDS)]
    found = whole_texts(docs, id_col, text_col).select("doc_id", words(F.col("text")).alias("_words"))
    found = found.select("doc_id", shingles(F.col("_words")).alias("_s"))
    found = found.select("doc_id", "_s", _windows(F.col("_s"), STEP).alias("_w"))

    # The windows that meet a template window, and the shingles there. As SQL text, the many numbers
    # reach the JVM at once.
    meets = " or ".join(f"{_band('w', b)} in ({_longs(known[b])})" for b in range(BANDS))
    found = found.select("doc_id", "_s", F.expr(f"filter(_w, w -> {meets})").alias("_met"))
    listed = F.expr(
        "array({})".format(
            ", ".join(
                f"named_struct('license', '{name}', 'wanted', array({_longs(wanted[name])}))"
                for name in sorted(wanted)
            )
        )
    )
    near = F.array_distinct(F.flatten("_met"))
    retrieved = F.when(
        F.size("_met") > 0, F.filter(listed, lambda t: F.arrays_overlap(t["wanted"], near))
    )
    found = found.select("doc_id", F.when(F.size("_met") > 0, F.col("_s")).alias("_s"), retrieved.alias("_t"))
    contained = F.transform(
        F.coalesce("_t", F.array().cast("array<struct<license:string,wanted:array<bigint>>>")),
        lambda t: F.struct(
            t["license"].alias("license"),
            (F.size(F.array_intersect(t["wanted"], F.col("_s"))) / F.size(t["wanted"])).alias("part"),
        ),
    )
    found = found.select("doc_id", contained.alias("_c"))
    verified = F.filter("_c", lambda c: c["part"] >= CONTAINMENT)
    found = found.select("doc_id", verified.alias("_c"))
    return found.select(
        "doc_id",
        F.size("_c").cast("long").alias("n_licenses"),
        F.array_join(F.transform("_c", lambda c: c["license"]), ",").alias("licenses"),
        F.coalesce(F.array_max(F.transform("_c", lambda c: c["part"])), F.lit(0.0)).alias("containment"),
    )
