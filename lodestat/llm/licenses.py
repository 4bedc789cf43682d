"""License scan by diagonal voting, with DataFrame functions only.

Every rolling word k-gram of every text is joined with the k-grams of the license
templates.  A match votes for (document, template, diagonal), the diagonal being the
document's position minus the template's.  A copied notice is a run on one diagonal,
a notice with words put in or left out is a run on neighbouring ones, which are merged.
A merged span counts when its matched k-grams cover enough of the template within a
span of about the template's length; k-grams are compared as texts, not only as hashes.

Rows in, rows out: a null text counts as empty (no words, no label, score 0), repeated
rows give repeated results, an empty table gives an empty result, and further columns
of the input are ignored.  Of a very long text all words are read; it is one row, and its
matches are as many as its text holds.  Equal labels are one; ties cannot change a result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodestat.llm.common import rows_with

#: What separates words, after A-Z are lower-cased.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Words of a k-gram.
GRAM = 4
#: Diagonals this close, with spans this close, are one occurrence.
DIAGONAL_GAP = 3
SPAN_GAP = 16
#: Share of a template's k-grams that a span must show, and the longest span for a template in parts of its length.
COVERAGE = 0.6
STRETCH = 1.5

# Phrases that carry a label by themselves.
PHRASES = (
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
)

# Notices in their public wording (opening passages), with their labels.
TEMPLATES = (
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files, to deal in the Software without restriction"),
    ("apache-2", "Licensed under the Apache License, Version 2.0"),
    ("apache-2", "you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("gpl-3", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
            "License as published by the Free Software Foundation"),
    ("lgpl", "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License"),
    ("agpl-3", "licensed under the GNU Affero General Public License, version 3"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
            "following conditions are met"),
    ("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-nc", "licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
    ("cc-by-sa", "licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("cc-by", "licensed under a Creative Commons Attribution 4.0 International License"),
    ("all-rights-reserved", "All rights reserved. No part of this publication may be reproduced"),
)

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _spaced(text):
    """Words with two spaces between them: each word then has a space of its own on either side."""
    return F.trim(F.regexp_replace(F.translate(text, _UPPER, _LOWER), SEPARATORS, "  "))


def _grams(rows: DataFrame, words: str, *keep: str) -> DataFrame:
    """One row per k-gram: its position and its words."""
    many = f"size({words})"
    grams = F.expr(
        f"CASE WHEN {many} >= {GRAM} THEN transform(slice({words}, 1, {many} - {GRAM - 1}), "
        f"(x, i) -> concat_ws(' ', x, {', '.join(f'get({words}, i + {j})' for j in range(1, GRAM))})) "
        f"ELSE cast(array() AS array<string>) END")
    return rows.select(*keep, F.posexplode(grams).alias("pos", "gram")).withColumn("hash", F.xxhash64("gram"))


def template_grams(spark: SparkSession, templates=TEMPLATES) -> DataFrame:
    """All k-grams of all templates; as many rows as the templates have words, whatever the corpus."""
    rows = spark.createDataFrame([(i, label, text) for i, (label, text) in enumerate(templates)], "template int, label string, text string")
    rows = rows.select("template", "label", F.split(_spaced("text"), "  ").alias("words"))
    grams = _grams(rows.withColumn("size", F.size("words") - (GRAM - 1)), "words", "template", "label", "size")
    return grams.select("template", "label", "size", F.col("pos").alias("at"), F.col("gram").alias("wanted"), F.col("hash").alias("wanted_hash"))


def license_spans(texts: DataFrame, templates=TEMPLATES) -> DataFrame:
    """Verified spans: ``key``, ``template``, ``label``, ``first`` and ``last`` word, ``coverage``.

    ``texts`` has a ``key`` that identifies a text and the array ``words``.  Only matching
    k-grams leave the scan: the template side is a fixed list and is broadcast.
    """
    wanted = F.broadcast(template_grams(texts.sparkSession, templates))
    hits = _grams(texts, "words", "key").join(wanted, (F.col("hash") == F.col("wanted_hash")) & (F.col("gram") == F.col("wanted")))
    votes = hits.groupBy("key", "template", "label", "size", (F.col("pos") - F.col("at")).alias("diagonal")).agg(
        F.collect_set("at").alias("ats"), F.min("pos").alias("first"), F.max("pos").alias("last"))
    order = Window.partitionBy("key", "template").orderBy("diagonal")
    apart = (F.col("diagonal") - F.lag("diagonal").over(order) > DIAGONAL_GAP) | (F.col("first") - F.lag("last").over(order) > SPAN_GAP) \
        | (F.lag("first").over(order) - F.col("last") > SPAN_GAP)
    merged = votes.withColumn("new", F.coalesce(apart.cast("int"), F.lit(1))).withColumn("run", F.sum("new").over(order))
    spans = merged.groupBy("key", "template", "label", "size", "run").agg(
        F.size(F.array_distinct(F.flatten(F.collect_list("ats")))).alias("matched"),
        F.min("first").alias("first"), (F.max("last") + GRAM - 1).alias("last"))
    length = F.col("last") - F.col("first") + 1
    return spans.withColumn("coverage", F.col("matched") / F.col("size")).where(
        (F.col("coverage") >= COVERAGE) & (length <= (F.col("size") + GRAM - 1) * STRETCH)
    ).select("key", "template", "label", "first", "last", "coverage")


def _phrase_places(spaced: str) -> dict:
    """Count, first and last start of every base phrase, as counts of the spaces before it."""
    out = {}
    for i, (phrase, _) in enumerate(PHRASES):
        wanted = " " + phrase.replace(" ", "  ") + " "
        without = F.replace(F.col(spaced), F.lit(wanted), F.lit(""))
        before = F.substring_index(F.col(spaced), wanted, 1)
        behind = F.substring_index(F.col(spaced), wanted, -1)
        spaces = lambda c: F.octet_length(c) - F.octet_length(F.replace(c, F.lit(" "), F.lit("")))
        count = ((F.octet_length(spaced) - F.octet_length(without)) / len(wanted)).cast("long")
        found = F.contains(F.col(spaced), F.lit(wanted))
        words = len(phrase.split(" "))
        out[f"count_{i}"] = F.when(found, count).otherwise(F.lit(0).cast("long"))
        out[f"first_{i}"] = F.when(found, (spaces(before) / 2).cast("long"))
        out[f"last_{i}"] = F.when(found, ((spaces(F.col(spaced)) - spaces(behind)) / 2).cast("long") - words)
    return out


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates=TEMPLATES) -> DataFrame:
    """Base phrases, labels and score of every document."""
    rows = rows_with(docs, doc_id=id_col, text=text_col).withColumn("text", F.coalesce("text", F.lit("")))
    # A text is known by its id and 128 bits of hash, so that rows that share an id keep their own labels.
    key = F.struct(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.xxhash64("text").alias("a"), F.xxhash64(F.lit(7), "text").alias("b"))
    keyed = rows.select("doc_id", key.alias("key"), _spaced("text").alias("body"))
    padded = keyed.select("doc_id", "key", F.when(F.col("body") == "", "").otherwise(F.concat(F.lit(" "), "body", F.lit(" "))).alias("spaced"))
    counted = padded.withColumns(_phrase_places("spaced"))
    every = range(len(PHRASES))
    base = counted.select(
        "doc_id", "key",
        ((F.octet_length("spaced") - F.octet_length(F.replace(F.col("spaced"), F.lit(" "), F.lit("")))) / 2).cast("long").alias("n_words"),
        sum((F.col(f"count_{i}") for i in every), F.lit(0).cast("long")).alias("n_base"),
        F.least(*[F.col(f"first_{i}") for i in every]).alias("first_word"),
        F.greatest(*[F.col(f"last_{i}") for i in every]).alias("last_word"),
        F.array_compact(F.array(*[F.when(F.col(f"count_{i}") > 0, F.lit(PHRASES[i][1])) for i in every])).alias("base"),
    )
    words = keyed.where(F.col("body") != "").select("key", F.split("body", "  ").alias("words"))
    found = license_spans(words, templates).groupBy(F.col("key").alias("of")).agg(
        F.collect_set("label").alias("found"), F.max("coverage").alias("best"))
    joined = base.join(found, F.col("key") == F.col("of"), "left")
    none = F.array().cast("array<string>")
    return joined.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word",
        F.array_join(F.sort_array(F.array_distinct("base")), ",").alias("base_labels"),
        F.array_join(F.sort_array(F.array_union("base", F.coalesce("found", none))), ",").alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"),
    )
