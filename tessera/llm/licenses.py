"""License scans: MinHash bands over text windows, then exact containment.

Texts and templates are lower-cased runs of letters and digits, and
shingles of five of them.  A document's windows are eight words long and
four apart, so they overlap in four words and every shingle lies in one
window of four shingles.  A template's windows begin at every shingle
and may hang over its ends, so whatever part of a template a document's
window holds, the template has a window of just those shingles.  A band
is the least hash of a window's shingles under one of ``BANDS`` hash
functions (bands of one row): a window that shares one shingle of four
with a template's window misses all bands with probability at most
(3/4)^48 = 1e-6, one that shares two with 4e-15, and a window inside the
template never.

Candidates (document, place, template) are then verified exactly: the
share of the template's shingles found around that place in the document
must reach ``MIN_CONTAINMENT``.  Each shingle of a document lies in one
window, so the candidate windows hold all that count.

The templates (``LICENSES``) are short notices in their usual wordings,
standard file headers, and the whole licence texts in ``license_texts``.
One licence may hold another (BSD-3 holds the BSD-2 text); a document has
a row for each.

Everything is DataFrame expressions: windows and bands are exploded and
joined with the templates' bands in one stage, without a shuffle; the
bands of the templates (a parameter, not data) are broadcast when they
number at most ``MAX_BROADCAST``, and joined by shuffle otherwise.  Only
candidate windows are shuffled.  The share around every place is a
running sum over the places where a shingle begins and ends to count, so
a long licence costs no more per word than a short one.

Defined results: a NULL text, or one of fewer than five words, matches
nothing; templates of fewer than five words are refused; a document has
one row per template it contains, with the best containment and how
many places show it; rows that repeat an id are reported together; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from importlib import resources

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.common import materialise

SHINGLE, STRIDE, BANDS = 5, 4, 48
MIN_CONTAINMENT = 0.8
MAX_BROADCAST = 2_000_000     # rows of two numbers

# Notices as they are commonly written (fixed values).
TEMPLATES = {
    "mit-notice": "Released under the MIT License.",
    "apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "gpl-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "cc-by-nc-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "bsd-3-clause-notice": "This project is licensed under the BSD 3-Clause License.",
    "mpl-2.0-notice": "This file is subject to the terms of the Mozilla Public License, version 2.0.",
    "cc-by-4.0-notice":
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "mit-grant":
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
        "and associated documentation files, to deal in the software without restriction.",
}

_GNU = "under the terms of the GNU {} Public License"
_FSF = "as published by the Free Software Foundation"
_CC = {"cc-by": "Attribution", "cc-by-sa": "Attribution-ShareAlike", "cc-by-nc": "Attribution-NonCommercial",
       "cc-by-nd": "Attribution-NoDerivatives", "cc-by-nc-sa": "Attribution-NonCommercial-ShareAlike",
       "cc-by-nc-nd": "Attribution-NonCommercial-NoDerivatives"}
_GNUS = {"gpl-2.0": ("General", "2", "GPL"), "gpl-3.0": ("General", "3", "GPL"),
         "lgpl-2.1": ("Lesser General", "2.1", "LGPL"), "lgpl-3.0": ("Lesser General", "3", "LGPL"),
         "agpl-3.0": ("Affero General", "3", "AGPL")}
_SHORT = {"mit": "MIT", "isc": "ISC", "bsd-2-clause": "BSD 2-Clause", "bsd-3-clause": "BSD 3-Clause"}


def _wordings() -> dict[str, str]:
    """Other usual wordings of the short notices, and the standard file headers."""
    out = {}
    for name, short in _SHORT.items():
        for verb in ("licensed", "released", "distributed", "available", "provided", "published", "is"):
            out[f"{name}-{verb}"] = f"{verb} under the {short} License"
        out[f"{name}-terms"] = f"under the terms of the {short} License"
        out[f"{name}-file"] = f"{short} License. See the LICENSE file"
    out["mit-title"] = "The MIT License (MIT) Copyright (c)"
    out["mit-style"] = "governed by an MIT-style license that can be found in the LICENSE file"
    out["bsd-style"] = "governed by a BSD-style license that can be found in the LICENSE file"
    out["bsd-conditions"] = ("Redistribution and use in source and binary forms, with or without modification, "
                             "are permitted provided that the following conditions are met")
    for verb in ("released", "distributed", "available", "provided", "published"):
        out[f"apache-2.0-{verb}"] = f"{verb} under the Apache License, Version 2.0"
    for verb in ("licensed", "released", "distributed", "available"):
        out[f"apache-2.0-{verb}-short"] = f"{verb} under the Apache License 2.0"
        out[f"apache-2.0-{verb}-plain"] = f"{verb} under the Apache 2.0 License"
    out["apache-2.0-spdx"] = "SPDX-License-Identifier: Apache-2.0"
    out["apache-2.0-header"] = (
        "you may not use this file except in compliance with the License. You may obtain a copy of the "
        "License at http://www.apache.org/licenses/LICENSE-2.0")
    for name, (kind, version, short) in _GNUS.items():
        terms = _GNU.format(kind)
        out[f"{name}-or-later"] = f"{terms} {_FSF}, either version {version} of the License"
        out[f"{name}-only"] = f"{terms} version {version} {_FSF}"
        out[f"{name}-old-header"] = f"{terms} {_FSF}; version {version} of the License"
        for what in ("program", "project", "software", "code"):
            out[f"{name}-{what}"] = f"{what} is licensed under the GNU {kind} Public License v{version}.0" \
                if "." not in version else f"{what} is licensed under the GNU {kind} Public License v{version}"
            out[f"{name}-{what}-version"] = \
                f"This {what} is licensed under the GNU {kind} Public License, version {version}"
        for verb in ("licensed", "released", "distributed", "available"):
            out[f"{name}-{verb}-short"] = f"{verb} under the {short} v{version}"
        out[f"{name}-spdx"] = f"SPDX-License-Identifier: {short}-{version if '.' in version else version + '.0'}"
    out["mpl-2.0-header"] = (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of "
        "the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/")
    for verb in ("licensed", "released", "distributed", "available"):
        out[f"mpl-2.0-{verb}"] = f"{verb} under the Mozilla Public License, version 2.0"
        out[f"mpl-2.0-{verb}-short"] = f"{verb} under the Mozilla Public License 2.0"
    out["mpl-2.0-spdx"] = "SPDX-License-Identifier: MPL-2.0"
    for name, words in _CC.items():
        out[f"{name}-4.0-licence"] = f"Creative Commons {words} 4.0 International License"
        for verb in ("licensed", "released", "distributed", "available"):
            out[f"{name}-4.0-{verb}"] = f"{verb} under {name.replace('-', ' ', 1).upper()} 4.0"
    out["cc0-1.0-notice"] = "To the extent possible under law, the author has waived all copyright and related " \
                            "or neighboring rights to this work"
    # those that only repeat a notice above would make a second row of each of its matches
    known = set(map(_plain, TEMPLATES.values()))
    return {name: text for name, text in out.items() if _plain(text) not in known}


def _plain(text: str) -> str:
    return " ".join("".join(c if c.isalnum() else " " for c in text.lower()).split())


def _bodies() -> dict[str, str]:
    """The whole licence texts that come with the package, by file name."""
    folder = resources.files(__package__) / "license_texts"
    return {f.name.removesuffix(".txt") + "-text": f.read_text(encoding="utf-8")
            for f in sorted(folder.iterdir(), key=lambda f: f.name) if f.name.endswith(".txt")}


LICENSES = {**TEMPLATES, **_wordings(), **_bodies()}


def word_hashes(text: Column) -> Column:
    """Hashes of the words of a text in order."""
    words = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))
    return F.transform(words, lambda w: F.xxhash64(w))


def _shingle_hashes(hashes: Column) -> Column:
    """Hash of the five words at every place; ``hashes`` must be a plain column."""
    return F.when(F.size(hashes) >= SHINGLE, F.transform(
        F.sequence(F.lit(0), F.size(hashes) - SHINGLE),
        lambda i: F.xxhash64(*[F.get(hashes, i + j) for j in range(SHINGLE)]))) \
        .otherwise(F.array().cast("array<bigint>"))


def _bands(windows: DataFrame) -> DataFrame:
    """A row per window ``w`` (four shingle hashes, NULL where it hangs over) and band.

    A window without any shingle has band 0; a band that is never NULL
    spares the join a filter that would hash everything twice.
    """
    exploded = windows.withColumn("k", F.explode(F.array(*[F.lit(k) for k in range(BANDS)])))
    hashed = [F.when(F.get("w", F.lit(j)).isNotNull(), F.xxhash64(F.get("w", F.lit(j)), F.col("k")))
              for j in range(STRIDE)]
    return exploded.withColumn("band", F.coalesce(F.least(*hashed), F.lit(0))).drop("k")


def template_table(spark: SparkSession, templates: dict[str, str]) -> DataFrame:
    """``license`` and ``shingles`` (distinct shingle hashes in order of place)."""
    values = [F.struct(F.lit(name).alias("license"), F.lit(text).alias("text"))
              for name, text in sorted(templates.items())]
    table = spark.range(1).select(F.inline(F.array(*values)))
    return table.withColumn("hashes", word_hashes(F.col("text"))).select(
        "license", _shingle_hashes(F.col("hashes")).alias("shingles"))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         templates: dict[str, str] | None = None,
         min_containment: float = MIN_CONTAINMENT) -> DataFrame:
    """``doc_id``, ``license``, ``containment``, ``places`` and ``first_word`` of every match."""
    spark = docs.sparkSession
    table = materialise(template_table(spark, templates or LICENSES), "licenses")
    short = [r["license"] for r in table.filter(F.size("shingles") == 0).select("license").collect()]
    if short:
        raise ValueError(f"templates of fewer than {SHINGLE} words: {short}")
    pad = F.array(*[F.lit(None).cast("bigint")] * (STRIDE - 1))
    known = table.select("license", F.concat(pad, "shingles", pad).alias("padded"))
    known = known.select("license", F.explode(F.transform(
        F.sequence(F.lit(1), F.size("padded") - STRIDE + 1),
        lambda i: F.slice(F.col("padded"), i, F.lit(STRIDE)))).alias("w"))
    known = _bands(known).drop("w").distinct()
    size = F.size("shingles")
    table = table.select("license", size.alias("size"), F.size(F.array_distinct("shingles")).alias("distinct"),
                         F.explode(F.array_distinct("shingles")).alias("s"))
    if known.count() <= MAX_BROADCAST:
        known, table = F.broadcast(known), F.broadcast(table)

    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(F.col(text_col)).alias("text_key"),
                       word_hashes(F.col(text_col)).alias("hashes"))
    rows = rows.select("doc_id", "text_key", _shingle_hashes(F.col("hashes")).alias("found"))
    # explode_outer and no filter here: a filter on the arrays would be pushed below them
    # and compute them a second time
    rows = rows.select("doc_id", "text_key", F.when(F.size("found") > 0, F.transform(
        F.sequence(F.lit(1), F.size("found"), F.lit(STRIDE)),
        lambda i: F.struct(i.alias("at"), F.slice(F.col("found"), i, F.lit(STRIDE)).alias("w"))))
        .alias("windows"))
    windows = rows.select("doc_id", "text_key", F.explode_outer("windows").alias("x")) \
        .select("doc_id", "text_key", F.col("x.at").alias("at"), F.col("x.w").alias("w"))
    candidates = _bands(windows).join(known, "band").select(
        "doc_id", "text_key", "license", "at", "w").distinct()
    matches = _containment(candidates, table).filter(F.col("containment") >= min_containment)
    return matches.groupBy("doc_id", "license").agg(
        F.max("containment").alias("containment"), F.countDistinct("at").alias("places"),
        F.min("at").alias("first_word")).withColumnRenamed("doc_id", id_col)


def _containment(candidates: DataFrame, table: DataFrame) -> DataFrame:
    """``containment`` around every candidate place ``at``.

    The shingles around a place are the 2 * size + STRIDE from size - 1
    before it (or the first) on.  A shingle at ``p`` whose last copy is at
    ``q`` is a new one to the ranges that begin after q, hold p, and begin
    at p at the latest: two steps of a running sum over beginnings.
    """
    text = Window.partitionBy("doc_id", "text_key", "license")
    hits = candidates.select("doc_id", "text_key", "license", "at", F.posexplode("w").alias("j", "s")) \
        .join(table, ["license", "s"]).withColumn("p", F.col("at") + F.col("j"))
    last = F.lag("p", 1, 0).over(Window.partitionBy("doc_id", "text_key", "license", "s").orderBy("p"))
    hits = hits.withColumn("first", F.greatest(last + 1, F.col("p") - 2 * F.col("size") - STRIDE + 1))
    none = F.lit(None).cast("int")
    steps = hits.select("doc_id", "text_key", "license", "distinct", F.explode(F.array(
        F.struct(F.col("first").alias("l"), F.lit(1).alias("step"), none.alias("at")),
        F.struct((F.col("p") + 1).alias("l"), F.lit(-1).alias("step"), none.alias("at")),
        F.struct(F.greatest(F.col("at") - F.col("size") + 1, F.lit(1)).alias("l"), F.lit(0).alias("step"),
                 F.col("at").alias("at")))).alias("e")).select(
                     "doc_id", "text_key", "license", "distinct", "e.*")
    inside = F.sum("step").over(text.orderBy("l")) / F.col("distinct")
    return steps.withColumn("containment", inside).filter(F.col("at").isNotNull())
