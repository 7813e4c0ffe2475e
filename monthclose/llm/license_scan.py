"""License scan as an exact set-similarity join. Built-in functions only.

Every line of a text, every window of ``WINDOW_LINES`` lines taken every ``WINDOW_STEP``, and windows of the text's word
sequence whatever its lines are blocks; a block belongs to a template if it holds at least ``THRESHOLD`` of the
template's distinct words. For a template of span t (its words and a quarter more, up to the next power of two) there is
a window of 2 t words every t words, so every stretch of up to t + 1 words lies in one, over however many lines it is
spread. A stretch of more words is found only if it lies in a line, a window of lines or by chance of its place. Words are ordered by how many documents hold them,
rarest first. With a template of t words of which a = ceil(THRESHOLD * t) must be met, only the first t - a + 1
words of the template and the first |block| - a + 1 of the block can be the first they share (prefix), the block
needs a words (length), and what follows the shared word must still suffice (position). Pairs that pass are
verified by intersecting the two sets. Words of no template are left out of blocks: they never count.

Besides, fixed phrases are found wherever their words stand in a row.

Nulls are empty texts. Rows are told apart by two 64-bit hashes of id and text; equal rows get equal results. A text without
words has 0 places, no labels and score 0. Other columns are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from monthclose.llm.common import settle, text_or_empty

THRESHOLD = 0.9
WINDOW_LINES, WINDOW_STEP = 8, 4

#: Opening sentences of published licenses and the usual notices.
TEMPLATES = (
    ("agpl", "This program is free software you can redistribute it under the terms of the GNU Affero General Public License as published by the Free Software Foundation"),
    ("apache", "Licensed under the Apache License, Version 2.0"),
    ("apache", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS basis, without warranties or conditions of any kind, either express or implied"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("cc-by", "This work is licensed under the Creative Commons Attribution 4.0 International License"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", "This program is free software you can redistribute it and or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("isc", "Permission to use, copy, modify, and or distribute this software for any purpose with or without fee is hereby granted"),
    ("lgpl", "This library is free software you can redistribute it and or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"),
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
)

_BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """Lower-case words. Full lower-casing differs from A-Z alone in characters that are no word breaks either way."""
    return F.array_remove(F.split(F.lower(text), _BREAK), "")


def _set(text: str) -> frozenset[str]:
    return frozenset("".join(c if c.isalnum() else " " for c in text.lower()).split())


def _span(text: str) -> int:
    """Words a notice after this template may take: a power of two."""
    n = len("".join(c if c.isalnum() else " " for c in text).split())
    return 1 << max(0, math.ceil(1.25 * n) - 1).bit_length()


def _key() -> Column:
    absent = F.col("text").isNull()
    return F.struct(F.xxhash64("doc_id", "text", absent).alias("a"), F.xxhash64(absent, "text", "doc_id", F.lit(1)).alias("b"))


def _phrases(rows: DataFrame) -> DataFrame:
    """Adds starts and kinds of the base phrases to rows with an array ``words``."""
    found = F.expr("""
        CASE WHEN array_contains(words, 'license') THEN
          filter(
            transform(words, (w, i) ->
              CASE WHEN w <> 'license' OR i = 0 THEN NULL
                   WHEN words[i - 1] IN ('mit', 'apache')
                     THEN named_struct('at', i - 1, 'label', words[i - 1])
                   WHEN i > 1 AND words[i - 1] = 'public' AND words[i - 2] = 'general'
                     THEN named_struct('at', i - 2, 'label', 'gpl') END),
            p -> p IS NOT NULL)
        END""")
    return rows.withColumn("places", found)


def scan(docs: DataFrame, threshold: float = THRESHOLD, templates=TEMPLATES) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels (array), labels (array), score of every row."""
    spark = docs.sparkSession
    sets = [(label, _set(text)) for label, text in templates]
    vocabulary = F.array(*[F.lit(w) for w in sorted(frozenset().union(*(s for _, s in sets)))])
    source = docs.select("doc_id", "text")
    worded = source.select("doc_id", _key().alias("key"), words_of(text_or_empty()).alias("words"))
    base = settle(
        _phrases(worded).select(
            "doc_id",
            "key",
            F.size("words").cast("long").alias("n_words"),
            "places",
            F.array_intersect("words", vocabulary).alias("held"),
        )
    )
    # One row per word of the templates, whatever the corpus.
    spread = base.select(F.explode("held").alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n")).collect()
    documents = {r.word: r.n for r in spread}
    order = sorted(frozenset().union(*(s for _, s in sets)), key=lambda w: (documents.get(w, 0), w))
    rank = {w: n for n, w in enumerate(order)}

    prefixes, first_words = [], set()
    for number, (label, words) in enumerate(sets):
        need = math.ceil(threshold * len(words) - 1e-9)
        ranked = sorted(words, key=rank.get)
        for place, word in enumerate(ranked[: len(words) - need + 1]):
            prefixes.append((word, number, label, place, len(words), need, ranked, _span(templates[number][1])))
            first_words.add(word)
    wanted = spark.createDataFrame(
        prefixes, "word string, template int, label string, place int, t int, need int, members array<string>, reach int"
    )
    least = min(math.ceil(threshold * len(s) - 1e-9) for _, s in sets)
    ordered = F.array(*[F.lit(w) for w in order])

    opening = F.array(*[F.lit(w) for w in sorted(first_words)])
    gated = source.where(F.arrays_overlap(words_of(text_or_empty()), opening))
    lines = gated.select(_key().alias("key"), F.split(text_or_empty(), "\n").alias("lines"))
    windows = F.expr(
        f"CASE WHEN size(lines) > 1 THEN transform(sequence(0, size(lines) - 1, {WINDOW_STEP}),"
        f" i -> concat_ws('\n', slice(lines, i + 1, {WINDOW_LINES}))) ELSE array() END"
    )
    by_lines = lines.select("key", F.lit(0).alias("span"), F.explode(F.concat("lines", windows)).alias("block")).select(
        "key", "span", words_of(F.col("block")).alias("words")
    )
    stretches = ", ".join(
        f"transform(sequence(0, size(words) - 1, {t}), i -> struct({t} AS span, slice(words, i + 1, {2 * t}) AS words))"
        for t in sorted({_span(text) for _, text in templates})
    )
    by_words = (
        gated.select(_key().alias("key"), words_of(text_or_empty()).alias("words"))
        .where(F.size("words") > 0)
        .select("key", F.explode(F.expr(f"concat({stretches})")).alias("block"))
        .select("key", "block.span", "block.words")
    )
    blocks = (
        by_lines.union(by_words)
        .select("key", "span", F.array_intersect(ordered, F.col("words")).alias("held"))  # rarest first
        .where(F.size("held") >= least)
    )
    pairs = (
        blocks.select("key", "span", "held", F.size("held").alias("b"), F.posexplode("held").alias("at", "word"))
        .where(F.col("at") <= F.col("b") - least)
        .join(F.broadcast(wanted), "word")  # one row per prefix word of the templates
        .where("span IN (0, reach)")
        .where("b >= need AND at <= b - need AND least(t - 1 - place, b - 1 - at) + 1 >= need - least(place, at)")
    )
    verified = pairs.withColumn("shared", F.size(F.array_intersect("held", "members"))).where("shared >= need")
    labelled = verified.groupBy("key").agg(
        F.collect_set("label").alias("found"), F.max(F.col("shared") / F.col("t")).alias("containment")
    )
    none = F.expr("cast(array() AS array<string>)")
    places = F.coalesce("places", F.expr("cast(array() AS array<struct<at: int, label: string>>)"))
    of_base = F.array_sort(F.array_distinct(F.transform(places, lambda p: p["label"])))
    return (
        base.join(labelled, "key", "left")
        .withColumn("base_labels", of_base)
        .select(
            "doc_id",
            "n_words",
            F.size(places).cast("long").alias("n_base"),
            F.array_min(F.transform(places, lambda p: p["at"])).cast("long").alias("first_word"),
            F.array_max(F.transform(places, lambda p: p["at"])).cast("long").alias("last_word"),
            "base_labels",
            F.array_sort(F.array_union("base_labels", F.coalesce("found", none))).alias("labels"),
            F.when(F.size("base_labels") > 0, 1.0).otherwise(F.coalesce("containment", F.lit(0.0))).alias("score"),
        )
    )
