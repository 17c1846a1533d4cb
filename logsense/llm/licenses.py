"""Licence notices in texts: MinHash bands over overlapping windows, then exact containment of shingles."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logsense.session import materialize

# Public licence notices.
NOTICES = {
    "apache-2.0-short": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at"
    ),
    "mit-short": "Released under the MIT License.",
    "mit": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction"
    ),
    "gpl-3-short": "This work is licensed under the GNU General Public License, version 3.",
    "gpl": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation"
    ),
    "bsd": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met"
    ),
    "cc-by-nc-4.0-short": "Licensed under CC BY-NC 4.0.",
    "cc-by-sa-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
}

#: Words of a shingle; shingles of a window, which is also the step from window to window of a document.
SHINGLE, STEP = 5, 2
#: Bands of one minimum each. The window at a copied shingle shares at least one of its two with the
#: template window there, so they meet with a probability of at least 1 - 0.5 ** 16 = 0.99998.
BANDS = 16
#: Least share of a template's shingles near the window.
CONTAINMENT = 0.8
#: Templates are part of every task; more words than this are refused.
MAX_TEMPLATE_WORDS = 100_000


def _shingles(text: Column) -> tuple[Column, Column]:
    """(tokens, hashes of their shingles), the second over a column named ``tok``."""
    tokens = F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), "[^a-z0-9]+"), "")
    shingle = lambda i: F.xxhash64(*[F.get("tok", i + k) for k in range(SHINGLE)])
    hashes = F.when(F.size("tok") >= SHINGLE, F.transform(F.sequence(F.lit(0), F.size("tok") - SHINGLE), shingle))
    return tokens, F.coalesce(hashes, F.array().cast("array<long>"))


def _minimum(band: int) -> Column:
    """The least of a window's shingle hashes ``s0``, ``s1`` (null beyond the text) after a XOR of the band's own."""
    pivot = F.xxhash64(F.lit(band), F.lit("band"))
    return F.least(*[F.col(f"s{k}").bitwiseXOR(pivot) for k in range(STEP)])


def _with_shingles(windows: DataFrame) -> DataFrame:
    return windows.select("*", *[F.get("sh", F.col("at") + k).alias(f"s{k}") for k in range(STEP)])


def template_table(spark: SparkSession, notices: dict[str, str]) -> DataFrame:
    """(license, sh, n): the distinct shingles of each template of at least five words."""
    if sum(len(text.split()) for text in notices.values()) > MAX_TEMPLATE_WORDS:
        raise ValueError(f"templates hold more than {MAX_TEMPLATE_WORDS} words")
    rows = F.array(*[F.struct(F.lit(name).alias("license"), F.lit(text).alias("text")) for name, text in notices.items()])
    texts = spark.range(1).select(F.inline(rows))
    tokens, hashes = _shingles(F.col("text"))
    found = texts.select("license", tokens.alias("tok")).select("license", hashes.alias("sh"))
    return found.where(F.size("sh") > 0).withColumn("n", F.size(F.array_distinct("sh")))


def _template_bands(templates: DataFrame) -> DataFrame:
    """(license, band, value) of every window of every template; windows start at each word."""
    starts = F.sequence(F.lit(0), F.greatest(F.size("sh") - STEP, F.lit(0)))
    windows = _with_shingles(templates.select("license", "sh", F.explode(starts).alias("at")))
    bands = F.array(*[F.struct(F.lit(b).alias("band"), _minimum(b).alias("value")) for b in range(BANDS)])
    return windows.select("license", F.inline(bands)).distinct()


def scan(
    docs: DataFrame, notices: dict[str, str] | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, license, containment): the licence templates that each document holds, whole or nearly so.

    Texts and templates are compared as lower-case runs of a-z and 0-9. Containment is the largest share
    of a template's distinct five-word shingles in a stretch of the document as long as the template
    and a window on either side; 0.8 is enough. Templates of fewer than five words are never found.
    Rows that share an id are reported as one. Rows without a match, null texts and empty texts give
    nothing, and neither does an empty table; other columns of ``docs`` are not read.

    One pass over the texts without a shuffle until matches are found: the templates travel as literals
    and a broadcast table, both bounded by ``MAX_TEMPLATE_WORDS``.
    """
    spark = docs.sparkSession
    templates = materialize(template_table(spark, NOTICES if notices is None else notices), "templates")
    bands = materialize(_template_bands(templates), "template-bands")
    values: dict[int, list[int]] = {}
    for band, value in bands.select("band", "value").distinct().collect():
        values.setdefault(band, []).append(value)
    tokens, hashes = _shingles(F.col("text"))
    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    shingled = slim.select("doc_id", tokens.alias("tok")).select("doc_id", hashes.alias("sh"))
    # no filter on computed arrays: it would be evaluated below them, with the split in the inner loop
    starts = F.when(F.size("sh") > 0, F.sequence(F.lit(0), F.size("sh") - 1, F.lit(STEP)))
    windows = _with_shingles(shingled.select("doc_id", "sh", F.explode(starts).alias("at")))
    meets = reduce(lambda x, y: x | y, [_minimum(b).isin(v) for b, v in sorted(values.items())], F.lit(False))
    minima = F.array(*[F.struct(F.lit(b).alias("band"), _minimum(b).alias("value")) for b in range(BANDS)])
    candidates = windows.where(meets).select("doc_id", "sh", "at", F.inline(minima))
    met = candidates.join(F.broadcast(bands), ["band", "value"]).join(
        F.broadcast(templates.select("license", F.col("sh").alias("want"), "n")), "license"
    )
    reach = (F.ceil(F.col("n") / STEP) * STEP).cast("int")
    begin = F.greatest(F.col("at") - reach, F.lit(0))
    near = F.slice("sh", begin + 1, F.col("at") + STEP + reach - begin)
    share = F.size(F.array_intersect("want", near)) / F.col("n")
    return (
        met.select("doc_id", "license", share.alias("containment")).where(F.col("containment") >= CONTAINMENT)
        .groupBy("doc_id", "license").agg(F.max("containment").alias("containment"))
    )
