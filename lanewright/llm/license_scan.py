"""License statements in documents, by MinHash bands and exact containment.

Only DataFrame functions run here. A text is cut into runs of SHINGLE words, and
these into windows of WINDOW shingles that start every STRIDE shingles. K hash
functions give each window K minima, each a band of one row: a window and a
template window of similarity s share a band with probability 1 - (1 - s)**K.
Template windows start at every shingle, so a window that lies inside a copied
statement equals one of them and always collides; at s = 0.5 and K = 6 the
probability is 0.984 for one window, and a longer statement gives several.
Templates shorter than a window are retrieved by their single shingles: a band
over a window of one, where equal shingles always collide.

A candidate counts if at least ``threshold`` of the template's distinct
shingles, compared as words, stand in the stretch of the text where the
template would lie.

Words are lower-cased runs of letters and digits.

Defined cases: null and empty texts, and texts under SHINGLE words, hold no
statement; templates under SHINGLE words are refused; equal templates are each
reported; repeated rows of a document give one row for each license; an empty
table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lanewright.llm.common import stage
from lanewright.sources.staging import Stage

SHINGLE, WINDOW, STRIDE, BANDS = 5, 8, 4, 6
THRESHOLD = 0.8

# Statements that name or grant a license.
TEMPLATES = {
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "MIT": "Released under the MIT License.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0": (
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."
    ),
    "MIT-text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
        "and associated documentation files (the \"Software\"), to deal in the Software without "
        "restriction, including without limitation the rights to use, copy, modify, merge, publish, "
        "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the "
        "Software is furnished to do so, subject to the following conditions"
    ),
    "Apache-2.0-text": (
        "you may not use this file except in compliance with the License. You may obtain a copy of the "
        "License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or "
        "agreed to in writing, software distributed under the License is distributed on an \"AS IS\" "
        "BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."
    ),
    "BSD-text": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted "
        "provided that the following conditions are met"
    ),
    "GPL-text": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the "
        "GNU General Public License as published by the Free Software Foundation"
    ),
}


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def _shingle_ids(hashes: Column) -> Column:
    """Hash of every SHINGLE word hashes in a row."""
    at = lambda i, k: F.get(hashes, i + k)
    return F.when(
        F.size(hashes) >= SHINGLE,
        F.transform(
            F.sequence(F.lit(0), F.size(hashes) - SHINGLE),
            lambda i: F.xxhash64(*[at(i, k) for k in range(SHINGLE)]),
        ),
    ).otherwise(F.array().cast("array<bigint>"))


# One xor constant makes one hash function out of shingle hashes.
_SALTS = [((k + 1) * 0x9E3779B97F4A7C15) % (1 << 63) for k in range(BANDS)]


def _with_ids(df: DataFrame, text: Column) -> DataFrame:
    df = df.withColumn("hashes", F.transform(words_of(text), lambda w: F.xxhash64(w)))
    return df.withColumn("ids", _shingle_ids(F.col("hashes"))).drop("hashes")


def _bands(start: Column) -> Column:
    """The window's key in each band. Elements are taken by place, since a slice
    of an array costs as much as the whole array."""
    window = [F.get("ids", start + j) for j in range(WINDOW)]
    least = lambda salt: F.least(*[x.bitwiseXOR(F.lit(salt)) for x in window])
    return F.array(*[F.xxhash64(F.lit(k), least(salt)) for k, salt in enumerate(_SALTS)])


def _single(shingle: Column) -> Column:
    return F.xxhash64(F.lit(-1), shingle)


def _probe_keys() -> Column:
    """Of every window its BANDS keys, then the keys of the STRIDE shingles it starts with."""
    own = lambda s: [F.get("ids", s + j) for j in range(STRIDE)]
    one = lambda s: F.concat(
        _bands(s), F.array(*[F.when(x.isNotNull(), _single(x)) for x in own(s)])
    )
    starts = F.sequence(F.lit(0), F.size("ids") - 1, F.lit(STRIDE))
    return F.when(F.size("ids") > 0, F.flatten(F.transform(starts, one)))


def _texts(words: Column) -> Column:
    """The shingles themselves."""
    return F.when(
        F.size(words) >= SHINGLE,
        F.array_distinct(
            F.transform(
                F.sequence(F.lit(1), F.size(words) - SHINGLE + 1),
                lambda i: F.array_join(F.slice(words, i, SHINGLE), " "),
            )
        ),
    ).otherwise(F.array().cast("array<string>"))


def template_keys(work: Stage, templates: DataFrame) -> DataFrame:
    """``license_id, key, offset``: band keys of the template's windows, or of its
    shingles if it is shorter than a window."""
    t = work.cut(_with_ids(templates.select("license_id", "text"), F.col("text")), "ids")
    long = F.size("ids") >= WINDOW
    starts = F.sequence(F.lit(0), F.size("ids") - WINDOW)
    windows = t.filter(long).select("license_id", "ids", F.explode(starts).alias("offset"))
    windows = windows.select("license_id", F.explode(_bands(F.col("offset"))).alias("key"), "offset")
    single = t.filter(~long).select("license_id", F.posexplode("ids").alias("offset", "id"))
    single = single.select("license_id", _single(F.col("id")).alias("key"), "offset")
    return windows.unionByName(single).distinct()


def license_matches(
    docs: DataFrame,
    templates: Mapping[str, str] | DataFrame = TEMPLATES,
    *,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """``doc_id, license_id, containment, first_word, n_places`` for every statement found."""
    spark = docs.sparkSession
    work = stage(spark, "license")
    if not isinstance(templates, DataFrame):
        templates = spark.createDataFrame(list(templates.items()), "license_id string, text string")
    templates = work.cut(
        templates.select("license_id", "text").withColumn("words", words_of(F.col("text"))), "templates"
    )
    if not templates.filter(F.size("words") < SHINGLE).isEmpty():
        raise ValueError(f"a template has fewer than {SHINGLE} words")
    known = templates.select(
        "license_id", _texts(F.col("words")).alias("wanted"), F.size("words").alias("n_words")
    )
    keys = template_keys(work, templates).join(known.select("license_id", "n_words"), "license_id")
    keys = work.cut(keys, "keys")

    # Only keys leave the texts here; a text's words never travel with them. The outer
    # form keeps Spark from testing the keys beforehand, which would compute them twice.
    probes = (
        _with_ids(docs.select("doc_id", "text"), F.col("text"))
        .select("doc_id", _probe_keys().alias("keys"))
        .select("doc_id", F.posexplode_outer("keys").alias("pos", "key"))
    )
    # Where the template would begin; a shingle's key stands at its own place.
    per_window = F.lit(BANDS + STRIDE)
    start = F.floor(F.col("pos") / per_window) * STRIDE
    shift = F.greatest(F.col("pos") % per_window - F.lit(BANDS), F.lit(0))
    at = F.greatest(start + shift - F.col("offset"), F.lit(0)).cast("int").alias("at")
    places = probes.join(keys, "key").select("doc_id", "license_id", "n_words", at).distinct()
    places = work.cut(places, "places")

    slack = F.lit(WINDOW) + (F.col("n_words") / 4).cast("int")
    first = F.greatest(F.col("at") - slack, F.lit(0))
    places = docs.select("doc_id", "text").join(places, "doc_id").select(
        "doc_id",
        "license_id",
        "at",
        F.slice(words_of(F.col("text")), first + 1, F.col("n_words") + 2 * slack).alias("stretch"),
    )
    shared = F.size(F.array_intersect(F.col("wanted"), _texts(F.col("stretch"))))
    checked = places.join(known, "license_id").select(
        "doc_id", "license_id", "at", (shared / F.size("wanted")).alias("share")
    )
    return (
        checked.filter(F.col("share") >= threshold)
        .groupBy("doc_id", "license_id")
        .agg(
            F.max("share").alias("containment"),
            F.min("at").cast("long").alias("first_word"),
            F.countDistinct("at").alias("n_places"),
        )
    )
