"""License scan: MinHash bands retrieve templates, shingles verify them.

Texts become lower-case words (letters and digits; digits read as 0, so that
a version matches the template of its family).  Templates are grouped by
length; each group reads a document in overlapping windows about as long as
its longest template, stepping by an eighth of it.  A window's MinHash
signature is cut into bands, and equal bands retrieve templates.  With R rows
and B bands, likeness s is retrieved with probability 1 - (1 - s**R)**B: the
values below give more than 0.9995 from 0.4 up, which a template shares with
its best aligned window when at least 0.8 of it is there.  A retrieved pair
is then verified exactly: the share of the template's distinct five-word
shingles that occur, in a stretch one step longer than the template at both
ends, must reach ``CONTAINMENT``.

Before any signature is made, windows without a single template shingle go:
they hold none of what is looked for, so no match is lost.  That leaves a
small part of a corpus, found by a join with the templates' shingles, whose
number is fixed by the library and not by the data.

Only DataFrame functions.  Defined cases: null, empty and short texts match
nothing; rows with one ``doc_id`` are scanned each by themselves (``row_md5``
tells them apart; identical rows give one); a null ``doc_id`` is kept.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimscope.llm.shared import stored

SHINGLE = 5
CONTAINMENT = 0.8
BANDS, ROWS = 15, 1
#: Windows step by this part of their length.
STEPS = 8

# Notices and headers of common licenses.
TEMPLATES = {
    "gpl-notice": "This work is licensed under the GNU General Public License, version 3.",
    "mit-notice": "Released under the MIT License.",
    "apache-notice": "Licensed under the Apache License, Version 2.0.",
    "cc-by-notice": "Licensed under CC BY 4.0.",
    "cc-by-sa-notice": "Licensed under CC BY-SA 4.0.",
    "cc-by-nc-notice": "Licensed under CC BY-NC 4.0.",
    "cc-by-nc-sa-notice": "Licensed under CC BY-NC-SA 4.0.",
    "cc-by-full": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-sa-full": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "cc-by-nc-full": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    "mpl": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    "mit": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "isc": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "bsd-2": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "bsd-3-clause": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    "apache-header": "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    "gpl-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "lgpl-header": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
    "unlicense": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    "cc0": "To the extent possible under law, the author has dedicated all copyright and related and neighboring rights to this work to the public domain worldwide.",
}


def plain_words(text: Column | str) -> Column:
    """Lower-case runs of letters and digits, digits read as 0."""
    words = F.split(F.lower(F.translate(text, "123456789", "000000000")), r"[^\p{L}\p{N}]+", -1)
    return F.filter(F.coalesce(words, F.array().cast("array<string>")), lambda w: w != "")


def shingle_hashes(words: Column, size: int = SHINGLE) -> Column:
    """The hash of every run of ``size`` words, by position; none if there are fewer."""

    def hashed(w: Column) -> Column:
        each = F.transform(F.sequence(F.lit(0), F.size(w) - size), lambda i: F.xxhash64(*(F.get(w, i + k) for k in range(size))))
        return F.when(F.size(w) >= size, each).otherwise(F.array().cast("array<long>"))

    return F.get(F.transform(F.array(words), hashed), F.lit(0))  # the words are bound once


def signature(shingles: Column, count: int = BANDS * ROWS) -> Column:
    def least(k: int) -> Column:
        return F.array_min(F.transform(shingles, lambda h: F.xxhash64(h, F.lit(k))))

    return F.array(*map(least, range(count)))


def bands(shingles: Column) -> Column:
    """array<struct<band, value>> of a shingle array's signature."""
    minima = signature(shingles)
    return F.array(*(F.struct(F.lit(b).alias("band"), F.xxhash64(*(minima[b * ROWS + r] for r in range(ROWS))).alias("value")) for b in range(BANDS)))


def _classes(templates: dict[str, str]) -> dict[str, int]:
    """Window length, in words, of each template: its own length rounded up in eighths of a power of two."""
    out = {}
    for name, text in templates.items():
        n = len([w for w in re.split(r"[\W_]+", text) if w])
        grain = max(1, 1 << max(0, n.bit_length() - 3))
        out[name] = -(-n // grain) * grain
    return out


def template_table(spark: SparkSession, templates: dict[str, str] = TEMPLATES) -> DataFrame:
    """license, window, shingles (distinct): one row for each template."""
    window = _classes(templates)
    rows = spark.createDataFrame([(k, window[k], v) for k, v in templates.items()], "license string, window int, text string")
    rows = rows.select("license", "window", F.array_distinct(shingle_hashes(plain_words("text"))).alias("shingles"))
    return stored(rows.where(F.size("shingles") > 0), "templates")


def scan(docs: DataFrame, templates: dict[str, str] = TEMPLATES, containment: float = CONTAINMENT) -> DataFrame:
    """doc_id, row_md5, license, containment (the highest), first_word (where
    the first verified window begins) and windows (how many verified)."""
    table = template_table(docs.sparkSession, templates)
    vocabulary = table.select("window", F.explode("shingles").alias("shingle")).distinct()
    known = sorted({r.shingle for r in vocabulary.select("shingle").collect()})  # the library's, whatever the corpus

    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.md5("text").alias("row_md5"), shingle_hashes(plain_words("text")).alias("shingles"))
    read = stored(read.where(F.arrays_overlap("shingles", F.lit(known))), "matching")

    hits = read.select("doc_id", "row_md5", F.posexplode("shingles").alias("place", "shingle"))
    hits = hits.join(F.broadcast(vocabulary), "shingle")  # as many rows as the templates have words
    step = F.greatest(F.lit(1), (F.col("window") / STEPS).cast("int"))
    run = F.col("window") - SHINGLE + 1  # shingles in a window
    low = F.greatest(F.lit(0), F.ceil((F.col("place") - run + 1) / step)).cast("int")
    high = F.floor(F.col("place") / step).cast("int")
    spots = hits.select("doc_id", "row_md5", "window", step.alias("step"), F.explode(F.sequence(low, high)).alias("number"))
    spots = spots.groupBy("doc_id", "row_md5").agg(F.collect_set(F.struct("window", "step", "number")).alias("spots"))
    spots = spots.select(F.col("doc_id").alias("spot_id"), F.col("row_md5").alias("spot_md5"), "spots")

    same = F.col("doc_id").eqNullSafe(F.col("spot_id")) & (F.col("row_md5") == F.col("spot_md5"))
    found = read.dropDuplicates(["doc_id", "row_md5"]).join(spots, same)
    found = found.select("doc_id", "row_md5", "shingles", F.explode("spots").alias("spot"))
    begin = F.col("spot.number") * F.col("spot.step")
    length = F.col("spot.window") - SHINGLE + 1
    wide = F.slice("shingles", F.greatest(F.lit(1), begin - F.col("spot.step") + 1), length + F.least(begin, F.col("spot.step")) + F.col("spot.step"))
    windows = found.select("doc_id", "row_md5", F.col("spot.window").alias("window"), begin.alias("begin"), F.slice("shingles", begin + 1, length).alias("own"), wide.alias("wide"))
    windows = windows.withColumn("key", F.explode(bands(F.col("own"))))

    keys = table.select("license", "window", F.col("shingles").alias("wanted"), F.explode(bands(F.col("shingles"))).alias("key"))
    met = windows.join(F.broadcast(keys), ["window", "key"])
    share = F.size(F.array_intersect("wide", "wanted")) / F.size("wanted")
    verified = met.select("doc_id", "row_md5", "license", "begin", share.alias("share")).where(F.col("share") >= containment)
    return verified.groupBy("doc_id", "row_md5", "license").agg(F.max("share").alias("containment"), F.min("begin").alias("first_word"), F.countDistinct("begin").alias("windows"))
