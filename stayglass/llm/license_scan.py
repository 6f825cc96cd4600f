"""License scans: MinHash bands over overlapping windows retrieve templates, shingle containment verifies them.

Words are runs of letters and digits of the lowered text; shingles are ``width`` words. A template of m shingles belongs
to the scale L, the smallest power of two with L >= m. Windows of a scale have 2 L shingles and begin every L, so any
run of L shingles, and with it the whole template, lies in one window.

Bands have one MinHash each. A window that holds ``percent`` of a template has, in the worst case, m = L / 2 + 1 and 2 L
shingles, so the Jaccard similarity is at least percent / 100 / 4; ``bands`` are as many as make a collision
``certainty`` likely at that similarity. Retrieved templates match when a window contains ``percent`` of their shingles.

A window without any shingle of any template can't match, so its signature is not computed, and a text without any has
no windows cut at all. This changes no result.

Everything is DataFrame expressions on the row, without a shuffle. Templates are a list in code, so the constants in the
plan don't grow with the data.

Defined results: null and empty texts match nothing; templates with fewer than ``width`` words are one shingle of all
their words and raise, since texts have no such shingles; repeated rows are scanned each.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stayglass.llm.common import name_of
from stayglass.llm.quality_rules import with_value

WIDTH = 5
PERCENT = 80
CERTAINTY = 0.999

# Notices of public licenses.
TEMPLATES = {
    "apache-2.0": "Licensed under the Apache License, Version 2.0",
    "apache-2.0-header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. "
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in "
        "writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, "
        "either express or implied. See the License for the specific language governing permissions and limitations under the License."
    ),
    "bsd": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"
    ),
    "cc-by-4.0": "Licensed under CC BY 4.0",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0",
    "cc-by-sa-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3",
    "gpl-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
        "the Free Software Foundation, either version 3 of the License, or (at your option) any later version."
    ),
    "isc": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the "
        "above copyright notice and this permission notice appear in all copies."
    ),
    "mit": "Released under the MIT License",
    "mit-text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "
        "\"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, "
        "distribute, sublicense, and/or sell copies of the Software"
    ),
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    "unlicense": "This is free and unencumbered software released into the public domain",
}


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+", -1), lambda w: w != "")


def shingles_of(words: Column, width: int) -> Column:
    """Hash of each run of words, in order; none where there are fewer words."""

    def runs(own: Column) -> Column:
        hashed = F.transform(own, lambda h, i: F.xxhash64(h, *(F.get(own, i + k) for k in range(1, width))))
        return F.slice(hashed, 1, F.greatest(F.size(own) - width + 1, F.lit(0)))

    return with_value(F.transform(words, lambda w: F.xxhash64(w)), runs)


def bands_for(percent: int, certainty: float) -> int:
    return math.ceil(math.log(1 - certainty) / math.log(1 - percent / 400))


def signature(window: Column, bands: int) -> Column:
    """One value for each band: the band's number and the least hash under it, together."""
    return F.transform(F.sequence(F.lit(1), F.lit(bands)), lambda b: F.xxhash64(b, F.array_min(F.transform(window, lambda h: F.xxhash64(h, b)))))


def template_rows(spark: SparkSession, templates: dict[str, str], width: int, bands: int) -> list:
    """(name, scale, shingles, signature) of each template, made by the expressions that texts go through."""
    rows = spark.createDataFrame(list(templates.items()), "name string, text string")
    rows = rows.select("name", F.array_distinct(shingles_of(words_of(F.col("text")), width)).alias("shingles"))
    out = rows.select("name", "shingles", F.when(F.size("shingles") > 0, signature(F.col("shingles"), bands)).alias("bands")).collect()
    short = [r.name for r in out if not r.shingles]
    if short:
        raise ValueError(f"templates with fewer than {width} words: {short}")
    return sorted((r.name, 1 << (len(r.shingles) - 1).bit_length(), list(r.shingles), list(r.bands)) for r in out)


def scan(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", templates: dict[str, str] | None = None, width: int = WIDTH, percent: int = PERCENT, certainty: float = CERTAINTY
) -> DataFrame:
    """(doc_id, n_shingles, matches) of every row; matches are structs (name, percent, at) sorted by name: how much of
    the template the best window holds, and the first shingle of the first such window."""
    bands = bands_for(percent, certainty)
    known = template_rows(docs.sparkSession, TEMPLATES if templates is None else templates, width, bands)
    every = F.array(*(F.lit(h) for h in sorted({h for r in known for h in r[2]}))).cast("array<bigint>")

    def matches(own: Column) -> Column:
        found = F.array().cast("array<struct<name:string,percent:double,at:int>>")
        for scale in sorted({r[1] for r in known}):
            of_scale = [r for r in known if r[1] == scale]
            found = F.concat(found, _windows(own, scale, of_scale, every, bands, percent))
        return found

    def best(found: Column) -> Column:
        names = F.array_sort(F.array_distinct(F.transform(found, lambda m: m["name"])))

        def of(name: Column) -> Column:
            own = F.filter(found, lambda m: m["name"] == name)
            most = F.array_max(F.transform(own, lambda m: m["percent"]))
            return F.struct(name.alias("name"), most.alias("percent"), F.array_min(F.transform(F.filter(own, lambda m: m["percent"] == most), lambda m: m["at"])).alias("at"))

        return F.transform(names, of)

    none = F.array().cast("array<struct<name:string,percent:double,at:int>>")
    rows = docs.select(name_of(doc_id), shingles_of(words_of(name_of(text)), width).alias("_shingles"))
    found = F.when(F.arrays_overlap("_shingles", every), with_value(matches(F.col("_shingles")), best)).otherwise(none)
    return rows.select(name_of(doc_id), F.size("_shingles").cast("bigint").alias("n_shingles"), found.alias("matches"))


def _windows(own: Column, scale: int, templates: list, every: Column, bands: int, percent: int) -> Column:
    """Matches of the templates of one scale in all windows."""
    begins = F.sequence(F.lit(0), F.floor((F.size(own) - 1) / scale).cast("int"))

    def one(window: Column) -> Column:
        items = window["items"]

        def checked(signs: Column) -> Column:
            cells = []
            for name, _, shingles, own_bands in templates:
                held = F.size(F.array_intersect(items, F.array(*map(F.lit, shingles)).cast("array<bigint>")))
                hit = F.arrays_overlap(signs, F.array(*map(F.lit, own_bands)).cast("array<bigint>")) & (held * 100 >= percent * len(shingles))
                match = F.struct(F.lit(name).alias("name"), F.round(held * 100.0 / len(shingles), 4).alias("percent"), window["at"].alias("at"))
                cells.append(F.when(hit, match))
            return F.filter(F.array(*cells), lambda m: m.isNotNull())

        return with_value(signature(items, bands), checked)

    cut = F.transform(begins, lambda k: F.struct((k * scale).cast("int").alias("at"), F.slice(own, k * scale + 1, 2 * scale).alias("items")))
    return F.flatten(F.transform(F.filter(cut, lambda w: F.arrays_overlap(w["items"], every)), one))
