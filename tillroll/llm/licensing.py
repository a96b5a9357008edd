"""License notices by an exact set-similarity join, in DataFrame functions only.

A text's blocks are its paragraphs, a block's tokens its distinct pairs of
neighbouring words.  A block holds a license template when at least 75 % of
the template's tokens are among its own.

Tokens outside all templates can be shared with none, so one pass over the
texts keeps, per block, only the tokens that some template has, and only
blocks that have as many as the least that any template needs; with them go
the counts of the base phrases.  The rest runs on this narrow table:

1. the tokens' document frequencies give the one global order, rare first;
2. a template that needs ``need`` of its ``n`` tokens is indexed under its
   first ``n - need + 1``, its prefix; a block likewise for each template;
3. blocks and templates that share a prefix token are candidates where the
   block is long enough and the places of the token leave room for ``need``
   shared ones;
4. the candidates' whole sets are compared.

Templates are an argument of the operator and small: their index is broadcast,
and so no token, however frequent, brings the blocks that hold it together.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import written

#: The base phrases and their labels.
PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
#: Wording of license notices, by label.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "mit": (
        "Released under the MIT License",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
        "files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, "
        "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software "
        "is furnished to do so, subject to the following conditions"),
    "apache-2": (
        "Licensed under the Apache License, Version 2.0",
        "you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    "cc-by-nc": (
        "Licensed under CC BY-NC 4.0",
        "Creative Commons Attribution-NonCommercial 4.0 International License"),
    "cc-by-sa": ("Creative Commons Attribution-ShareAlike 4.0 International License",),
    "cc0": ("To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work",),
    "gpl-3": ("This work is licensed under the GNU General Public License, version 3",),
    "gpl": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License "
        "as published by the Free Software Foundation",),
    "lgpl": ("under the terms of the GNU Lesser General Public License",),
    "bsd": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
        "conditions are met",),
    "mpl-2": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",),
    "isc": ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",),
    "unlicense": ("This is free and unencumbered software released into the public domain",),
}
PERCENT = 75
#: What separates words, after lower-casing, and paragraphs.
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
PARAGRAPH = r"\n[\x20\x09\x0B-\x0D]*\n"


def _lowered(text: Column) -> Column:
    """The text with A-Z lower-cased, as far as words of ASCII letters can tell.

    ``lower`` is the engine's fast path.  The two characters beyond ASCII whose
    lower case has ASCII letters are replaced by another character of words first;
    all others stay beyond ASCII, so no word's borders and no ASCII word change.
    """
    return F.lower(F.replace(F.replace(text, F.lit("K"), F.lit("é")), F.lit("İ"), F.lit("é")))


def _words(text: Column) -> Column:
    return F.array_remove(F.split(text, GAP, -1), "")


def _pairs(words: Column) -> Column:
    """The distinct pairs of neighbouring words."""
    return F.array_distinct(F.zip_with(F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0))), F.slice(words, 2, F.size(words)),
                                       lambda a, b: F.concat(a, F.lit(" "), b)))


def _needed(n: Column, percent: int) -> Column:
    return F.expr(f"({percent} * {n} + 99) div 100")


def _template_tokens(spark, templates: Mapping[str, Sequence[str]]) -> DataFrame:
    """``template, label, tokens``: a row per template, as the plan's own values."""
    flat = [(label, text) for label, texts in templates.items() for text in texts]
    rows = F.explode(F.array(*[F.struct(F.lit(i).alias("template"), F.lit(label).alias("label"), F.lit(text).alias("text"))
                               for i, (label, text) in enumerate(flat)]).cast("array<struct<template:int,label:string,text:string>>"))
    one = spark.range(1, numPartitions=1).select(rows.alias("t")).select("t.*")
    return one.select("template", "label", _pairs(_words(_lowered(F.col("text")))).alias("tokens"))


def _places(words: Column, phrase: str) -> Column:
    """Where a phrase's words stand one after the other."""
    p = phrase.split()
    rare = max(p, key=len) if len(p) < 4 else p[2]
    here = lambda i: [F.get(words, i + k) == F.lit(w) for k, w in enumerate(p)]

    def all_of(i: Column) -> Column:
        out = F.lit(True)
        for c in here(i):
            out = out & c
        return out
    none = F.array().cast("array<int>")
    some = F.filter(F.sequence(F.lit(0), F.size(words) - len(p)), all_of)
    return F.when((F.size(words) >= len(p)) & F.array_contains(words, rare), some).otherwise(none)


def _base(docs: DataFrame, vocabulary: list[str], least: int) -> DataFrame:
    """Written, per row: a number, the id, the counts of the base phrases, and the blocks that can hold a template, with their template tokens."""
    known = F.array(*[F.lit(t) for t in vocabulary]).cast("array<string>")
    split = docs.select(F.col("doc_id"), F.transform(F.split(_lowered(F.coalesce(F.col("text"), F.lit(""))), PARAGRAPH, -1), _words).alias("b"))
    flat = split.select("doc_id", "b", F.flatten("b").alias("w"))
    placed = flat.select("doc_id", "b", F.size("w").alias("n"), *[_places(F.col("w"), p).alias(f"p{i}") for i, p in enumerate(PHRASES)])
    blocks = F.transform("b", lambda w, i: F.struct(i.alias("block"), F.when(
        F.size(w) > least, F.array_intersect(_pairs(w), known)).alias("tokens")))
    blocks = F.filter(blocks, lambda x: F.coalesce(F.size(x["tokens"]), F.lit(0)) >= least)
    every = F.concat(*[F.col(f"p{i}") for i in range(len(PHRASES))])
    labels = F.array_compact(F.array(*[F.when(F.size(f"p{i}") > 0, F.lit(label)) for i, label in enumerate(PHRASES.values())]))
    return written(placed.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", F.col("n").cast("long").alias("n_words"), F.size(every).cast("long").alias("n_base"),
        F.array_min(every).cast("long").alias("first_word"), F.array_max(every).cast("long").alias("last_word"),
        F.array_sort(F.array_distinct(labels)).alias("base"), blocks.alias("blocks")), "license")


def _matches(base: DataFrame, templates: DataFrame, vocabulary: list[str], percent: int) -> DataFrame:
    """``row, block, label, containment``: the blocks that hold a template."""
    spark = base.sparkSession
    blocks = base.where(F.size("blocks") > 0).select("row", F.explode("blocks").alias("x")).select("row", "x.block", "x.tokens")
    counted = {r["token"]: r["n"] for r in blocks.select(F.explode("tokens").alias("token")).groupBy("token").agg(
        F.count(F.lit(1)).alias("n")).collect()}  # tokens of templates only
    order = F.array(*[F.lit(t) for t in sorted(vocabulary, key=lambda t: (counted.get(t, 0), t))]).cast("array<string>")
    indexed = templates.select("template", "label", F.array_intersect(order, F.col("tokens")).alias("t")).select(
        "*", F.size("t").alias("n"), _needed("size(t)", percent).alias("need"))
    prefix = F.slice(F.col("t"), F.lit(1), (F.col("n") - F.col("need") + 1).cast("int"))
    index = indexed.select("*", F.posexplode(prefix).alias("i", "token"))
    ordered = blocks.select("row", "block", F.array_intersect(order, F.col("tokens")).alias("b"))
    found = ordered.select("*", F.size("b").alias("m"), F.posexplode("b").alias("j", "token"))
    # The block's prefix for this template, its length, and the room that the token's places leave.
    room = F.least(F.col("n") - F.col("i"), F.col("m") - F.col("j"))
    met = found.join(F.broadcast(index), "token").where((F.col("m") >= F.col("need")) & (F.col("j") <= F.col("m") - F.col("need")) & (room >= F.col("need")))
    pairs = met.groupBy("row", "block", "template").agg(*[F.first(c).alias(c) for c in ("label", "b", "t", "n", "need")])
    shared = F.size(F.array_intersect("b", "t"))
    return pairs.where(shared >= F.col("need")).select("row", "block", "label", (shared / F.col("n")).alias("containment"))


def scan(docs: DataFrame, templates: Mapping[str, Sequence[str]] = TEMPLATES, percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """The base table, per row of ``docs``, and the blocks that hold a template, per ``row, block, label, containment``.

    The base table has ``row`` (a number), ``doc_id, n_words, n_base,
    first_word, last_word, base`` and the candidate ``blocks``.
    """
    spark = docs.sparkSession
    tokens = _template_tokens(spark, templates)
    sizes = tokens.select("tokens").collect()  # templates, given by the caller
    vocabulary = sorted({t for r in sizes for t in r["tokens"]})
    least = min(((percent * len(r["tokens"]) + 99) // 100 for r in sizes if r["tokens"]), default=1)
    base = _base(docs.select("doc_id", "text"), vocabulary, max(least, 1))
    return base, _matches(base, tokens, vocabulary, percent)


def licenses(docs: DataFrame, templates: Mapping[str, Sequence[str]] = TEMPLATES, percent: int = PERCENT) -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score``.

    ``labels`` are the base labels and those of all templates found; ``score``
    is the greatest containment of a template that was found, 1 where a base
    phrase stands, else 0.  Null, empty and blank texts have no words, no
    places (null) and no labels (an empty string).  Very long texts are one
    row's arrays of words.  Repeated rows and null ids are rows of their own;
    several templates may be found in one block, and equal containments are
    all kept.  An empty table gives no rows, no templates leave the base
    alone; other columns are ignored, whatever their names.
    """
    base, found = scan(docs, templates, percent)
    per_row = found.groupBy("row").agg(F.collect_set("label").alias("more"), F.max("containment").alias("best"))
    joined = base.drop("blocks").join(per_row, "row", "left")
    joined_labels = lambda c: F.array_join(F.array_sort(c), ",")
    more = F.coalesce("more", F.array().cast("array<string>"))
    return joined.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", joined_labels(F.col("base")).alias("base_labels"),
        joined_labels(F.array_union("base", more)).alias("labels"),
        F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"))


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def oracle(templates: Mapping[str, Sequence[str]] = TEMPLATES, percent: int = PERCENT) -> str:
    """DuckDB: every block against every template."""
    values = ", ".join(f"({_quoted(label)}, {_quoted(text)})" for label, texts in templates.items() for text in texts)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    pattern = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    words = lambda c: f"regexp_extract_all(translate({c}, '{upper}', '{lower}'), '{pattern}')"
    pairs = lambda c: f"list_distinct(list_transform(range(1, len({c})), lambda i: {c}[i] || ' ' || {c}[i + 1]))"
    places = "list_concat(" + ", ".join(
        f"list_filter(range(0, len(w)), lambda i: array_to_string(w[i + 1:i + {len(p.split())}], ' ') = '{p}')" for p in PHRASES) + ")"
    labels = ", ".join(f"CASE WHEN ' ' || array_to_string(w, ' ') || ' ' LIKE '% {p} %' THEN '{label}' END" for p, label in PHRASES.items())
    return f"""
WITH templates AS (SELECT label, {pairs('w')} AS t FROM (SELECT label, {words('text')} AS w FROM (VALUES {values}) v(label, text))),
docs AS (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text FROM documents),
base AS (SELECT row, doc_id, w, {places} AS found_at, list_filter([{labels}], lambda x: x IS NOT NULL) AS base FROM (SELECT *, {words('text')} AS w FROM docs)),
blocks AS (SELECT row, {pairs('w')} AS b FROM (
  SELECT row, {words('block')} AS w FROM (SELECT row, unnest(regexp_split_to_array(text, '\\n[\\x20\\x09\\x0B-\\x0D]*\\n')) AS block FROM docs))),
found AS (SELECT row, label, len(list_intersect(b, t)) / len(t) AS c FROM blocks CROSS JOIN templates
  WHERE 100 * len(list_intersect(b, t)) >= {percent} * len(t)),
best AS (SELECT row, list(DISTINCT label) AS more, max(c) AS c FROM found GROUP BY row)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(found_at) AS BIGINT) AS n_base, CAST(list_min(found_at) AS BIGINT) AS first_word,
  CAST(list_max(found_at) AS BIGINT) AS last_word, array_to_string(list_sort(list_distinct(base)), ',') AS base_labels,
  array_to_string(list_sort(list_distinct(list_concat(base, coalesce(more, [])))), ',') AS labels,
  CASE WHEN len(found_at) > 0 THEN 1.0 ELSE coalesce(c, 0.0) END::DOUBLE AS score
FROM base LEFT JOIN best USING (row)"""
