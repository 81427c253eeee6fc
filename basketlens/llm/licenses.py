"""License scans by MinHash over text windows (operator 8).

Texts and templates become sequences of two-word shingle hashes. A template is cut into
overlapping windows, and each of BANDS hash functions keeps the smallest value of a
window. A document is cut into blocks of half a window; a block whose smallest value under
one of the functions is a template's retrieves it, which holds for every pair of
overlapping windows that agree in it. Around the block the share of the template's
shingles is then counted exactly.

Bands of one row make retrieval all but certain: a notice of five words has four shingles,
and the smallest of them is that of a block of BLOCK shingles with probability 4 / 9 or
more, so twenty functions miss one notice in 10 ** 5. Longer notices are missed less.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketlens.llm.common import text_or_empty

BLOCK = 6
BANDS = 20
CONTAINMENT = 0.8

#: Notices to look for.
TEMPLATES = {
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-grant": "you may not use this file except in compliance with the License. You may obtain a copy of the License at",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "cc-by": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-later": "either version 3 of the License, or (at your option) any later version.",
    "isc": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
    "mit": "Released under the MIT License.",
    "mit-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
}

def _words(text: Column) -> Column:
    """Runs of letters and digits in lower case."""
    return F.array_remove(F.split(F.lower(text), "[^\\p{L}\\p{N}]+"), "")


def _shingles(words: Column) -> Column:
    """Hashes of all pairs of adjacent words, in order."""
    after = F.slice(words, 2, F.greatest(F.size(words) - 1, F.lit(0)))
    before = F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0)))
    return F.zip_with(before, after, lambda a, b: F.xxhash64(a, b))


def _smallest(shingles: Column, bands: int) -> Column:
    """The smallest value of a window under each hash function."""
    return F.transform(
        F.sequence(F.lit(1), F.lit(bands)),
        lambda band: F.array_min(F.transform(shingles, lambda h: F.xxhash64(h, band))),
    )


def _template_tables(spark: SparkSession, templates: dict[str, str], bands: int):
    """The smallest values of the templates' windows, and their shingle hashes by name.

    The templates are a parameter of the program, so they fit the driver.
    """
    rows = spark.createDataFrame(sorted(templates.items()), "license string, text string")
    rows = rows.select("license", _words(F.col("text")).alias("words")).select("license", _shingles(F.col("words")).alias("shingles")).where("size(shingles) > 0")
    shingles = {r["license"]: list(r["shingles"]) for r in rows.collect()}
    starts = F.sequence(F.lit(0), F.greatest(F.size("shingles") - 2 * BLOCK, F.lit(0)), F.lit(BLOCK))
    last = F.greatest(F.size("shingles") - 2 * BLOCK, F.lit(0))
    windows = rows.withColumn("start", F.explode(F.array_union(starts, F.array(last)))).select(
        F.slice("shingles", F.col("start") + 1, F.lit(2 * BLOCK)).alias("window")
    )
    values = windows.select(F.explode(_smallest(F.col("window"), bands)).alias("value")).distinct()
    return sorted(r["value"] for r in values.collect()), shingles


def scan_licenses(
    docs: DataFrame,
    templates: dict[str, str] = TEMPLATES,
    containment: float = CONTAINMENT,
    bands: int = BANDS,
) -> DataFrame:
    """One row per document and license found: doc_id, license, containment, near_word.

    Words are runs of letters and digits in lower case, so punctuation does not matter.
    ``containment`` is the share of the template's distinct two-word shingles that stand
    within a template's length of the place found, at least the parameter's value;
    ``near_word`` is the word at which the first block retrieved begins. Templates of
    fewer than two words find nothing; null, empty and one-word texts hold nothing.
    Rows that agree in doc_id and text are one document. Other columns are ignored; an
    empty table gives an empty result.
    """
    smallest, shingles = _template_tables(docs.sparkSession, templates, bands)
    known = F.array(
        *(
            F.struct(
                F.lit(name).alias("license"),
                F.lit(len(found)).alias("length"),
                F.array(*(F.lit(h) for h in sorted(set(found)))).alias("shingles"),
            )
            for name, found in shingles.items()
        )
    )
    hashed = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text_or_empty("text")).alias("text_hash"), _words(text_or_empty("text")).alias("words")
    )
    # Exploding an array of one keeps the shingles from being computed again per block.
    hashed = hashed.select("doc_id", "text_hash", F.explode(F.array(_shingles(F.col("words")))).alias("shingles"))
    # The hash functions are one to one, so a block without a template's shingle has no smallest value of one.
    of_templates = sorted({h for found in shingles.values() for h in found})
    blocks = F.array_distinct(
        F.array_compact(F.transform("shingles", lambda h, place: F.when(h.isin(of_templates), F.floor(place / F.lit(BLOCK)).cast("int"))))
    )

    def retrieves(number: Column) -> Column:
        block = F.slice("shingles", number * BLOCK + 1, BLOCK)
        return F.exists(_smallest(block, bands), lambda value: value.isin(smallest))

    hits = F.filter(blocks, retrieves)
    found = hashed.where("size(shingles) > 0").withColumn("hits", hits).where("size(hits) > 0")
    places = (
        found.select("doc_id", "text_hash", "shingles", F.explode("hits").alias("block"))
        .withColumn("template", F.explode(known))
    )
    start = F.greatest(F.col("block") * BLOCK - F.col("template.length"), F.lit(0))
    stop = F.col("block") * BLOCK + BLOCK + F.col("template.length")
    around = F.slice("shingles", start + 1, stop - start)
    share = F.size(F.array_intersect(around, F.col("template.shingles"))) / F.size("template.shingles")
    return (
        places.select("doc_id", "text_hash", F.col("template.license").alias("license"), "block", share.alias("containment"))
        .where(F.col("containment") >= containment)
        .groupBy("doc_id", "text_hash", "license")
        .agg(F.max("containment").alias("containment"), (F.min("block") * BLOCK).cast("long").alias("near_word"))
        .drop("text_hash")
    )
