"""License notices by exact set-similarity join of text blocks with templates.

A block is any run of consecutive words, line and sentence ends or not, at most ``1 / least`` times as long as the
template; it matches if it holds at least ``least`` of the template's distinct words. Tokens are ordered by their
frequency in the whole corpus, rarest first. A template of ``n`` tokens that must meet in ``need`` has to share one of its
``n - need + 1`` rarest with the block (prefix filter): those are listed in an inverted index. Texts without any of them
are done after one scan; the words of the others are joined with the index, which gives pairs of text and template and
the places of the templates' words. The text has to hold ``need`` of them (length filter) and the rarest one it holds has
to leave as many behind it (positional filter). What passes is verified at every place where a block can begin, so every
match is found and no other.

The index is as large as the stated templates, so it is broadcast. One scan before that counts the vocabulary's words.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedertrace.session import materialize

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: (phrase, label) of the base counts.
PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))
#: Fixed values: (label, words) of public notices, in lower case and without punctuation.
TEMPLATES = (
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("mit", "to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions"),
    ("mit", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("mit", "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software"),
    ("apache", "licensed under the apache license version 2 0"),
    ("apache", "you may not use this file except in compliance with the license"),
    ("apache", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied see the license for the specific language governing permissions and limitations under the license"),
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose see the gnu general public license for more details"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("bsd", "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"),
    ("bsd", "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution"),
    ("bsd", "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("mpl", "if a copy of the mpl was not distributed with this file you can obtain one at https mozilla org mpl 2 0"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("unlicense", "anyone is free to copy modify publish use compile sell or distribute this software either in source code form or as a compiled binary for any purpose commercial or non commercial and by any means"),
    ("zlib", "this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages arising from the use of this software"),
    ("cc", "licensed under cc by nc 4 0"),
    ("cc", "licensed under cc by sa 4 0"),
    ("cc", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc0", "the person who associated a work with this deed has dedicated the work to the public domain by waiving all of his or her rights to the work worldwide under copyright law"),
)
MOST_TOKENS = 20_000


def _lower() -> Column:
    return F.translate(F.coalesce("text", F.lit("")), UPPER, LOWER)


def _words(text: Column | str) -> Column:
    return F.array_remove(F.split(text, SEPARATORS), "")


def token_order(docs: DataFrame, templates: tuple[tuple[str, str], ...]) -> list[str]:
    """The templates' words by how often the corpus has them, rarest first; ties by the word."""
    vocabulary = sorted({w for _, t in templates for w in t.split()})
    if len(vocabulary) > MOST_TOKENS:
        raise ValueError(f"{len(vocabulary)} words in templates; at most {MOST_TOKENS} are meant to go into a plan")
    words = docs.select(F.explode(_words(_lower())).alias("w")).where(F.col("w").isin(vocabulary))
    counts = {r.w: r.n for r in words.groupBy("w").agg(F.count(F.lit(1)).alias("n")).collect()}
    return sorted(vocabulary, key=lambda w: (counts.get(w, 0), w))


def _strings(values: list[str]) -> Column:
    return F.array(*map(F.lit, values)) if values else F.array().cast("array<string>")


def _index(spark: SparkSession, templates: tuple[tuple[str, str], ...], order: list[str], least: float) -> tuple[DataFrame, DataFrame]:
    """(w, rank, lists): each word with the templates whose prefix it is in; and (template, label, tokens, need, span):
    ``tokens`` are the ranks of the template's words, rarest first."""
    rank = {w: i for i, w in enumerate(order)}
    lists: dict[str, list[int]] = {w: [] for w in order}
    rows = []
    for i, (label, text) in enumerate(templates):
        tokens = sorted({rank[w] for w in text.split()})
        need = math.ceil(least * len(tokens) - 1e-9)
        for t in tokens[: len(tokens) - need + 1]:
            lists[order[t]].append(i)
        rows.append((i, label, tokens, need, math.ceil(len(text.split()) / least - 1e-9)))
    ints = lambda values: F.array(*map(F.lit, values)).cast("array<int>")
    words = [F.struct(F.lit(w).alias("w"), F.lit(rank[w]).alias("rank"), ints(lists[w]).alias("lists")) for w in order]
    entries = [F.struct(F.lit(i).alias("template"), F.lit(label).alias("label"), ints(tokens).alias("tokens"), F.lit(need).alias("need"), F.lit(span).alias("span")) for i, label, tokens, need, span in rows]
    shapes = ("array<struct<w:string,rank:int,lists:array<int>>>", "array<struct<template:int,label:string,tokens:array<int>,need:int,span:int>>")
    one = spark.range(1)
    return tuple(one.select(F.inline(F.array(*x).cast(shape))) for x, shape in zip((words, entries), shapes, strict=True))


def _matches(words: DataFrame, index: DataFrame, templates: DataFrame) -> DataFrame:
    """(rid, matches) from ``words`` (rid, ws): the best block of each template that one matches."""
    # Both tables are as large as the stated templates; MOST_TOKENS bounds them.
    rows = words.select("rid", F.posexplode("ws").alias("pos", "w")).join(F.broadcast(index), "w")
    own = rows.groupBy("rid").agg(F.array_sort(F.collect_list(F.struct("pos", "rank"))).alias("hits"), F.array_distinct(F.flatten(F.collect_set("lists"))).alias("lists"))
    pairs = own.select("rid", "hits", F.explode("lists").alias("template")).join(F.broadcast(templates), "template")
    pairs = pairs.withColumn("hits", F.filter("hits", lambda h: F.array_contains("tokens", h["rank"])))
    # Length filter: words of the template that the text has at all. Positional filter: behind the rarest shared one.
    held = F.array_sort(F.array_distinct(F.transform("hits", lambda h: h["rank"])))
    pairs = pairs.withColumn("held", held).where(F.size("held") >= F.col("need"))
    pairs = pairs.where(F.size("tokens") - F.array_position("tokens", F.element_at("held", 1)) + 1 >= F.col("need"))

    def best_of(own: Column) -> Column:
        # own: the hits and the span; bound here, they are made once.
        def block(i: Column) -> Column:
            at = F.element_at(own["hits"], i)["pos"]
            near = F.filter(F.slice(own["hits"], i, own["span"]), lambda h: h["pos"] < at + own["span"])
            return F.struct(F.size(F.array_distinct(F.transform(near, lambda h: h["rank"]))).alias("n"), (-at).alias("at"))

        return F.array_max(F.transform(F.sequence(F.lit(1), F.size(own["hits"])), block))

    best = F.element_at(F.transform(F.array(F.struct("hits", "span")), best_of), 1)
    found = pairs.withColumn("best", best).where(F.col("best.n") >= F.col("need"))
    match = F.struct("label", (-F.col("best.at")).alias("word"), (F.col("best.n") / F.size("tokens")).alias("share"))
    return found.groupBy("rid").agg(F.array_sort(F.collect_list(match)).alias("matches"))


def find_licenses(docs: DataFrame, *, templates: tuple[tuple[str, str], ...] = TEMPLATES, phrases: tuple[tuple[str, str], ...] = PHRASES, least: float = 0.8) -> DataFrame:
    """Per row of ``docs`` (doc_id, text; other columns are not read): doc_id, n_words, n_base, first_word, last_word,
    base_labels, labels, score (of the template words, the largest share found in a block; 1 with a base phrase; else 0)
    and matches (for each template found: label, the first word of its best block, share).

    A null or empty text has no words: counts 0, null places, empty labels, score 0. Repeated rows and rows with a null
    doc_id each give a row, an empty table an empty one. Equal words of a block or template count once; of equally good
    blocks the first counts. Texts of any length are taken whole, in time linear in their words.
    """
    index, entries = _index(docs.sparkSession, templates, token_order(docs, templates), least)
    # Prefix filter: only texts with a word of some template's prefix go on with their words.
    prefixes = _strings([r.w for r in index.where("size(lists) > 0").select("w").collect()])
    own = docs.select("doc_id", _words(_lower()).alias("_w"))

    def places(phrase: str) -> Column:
        words = phrase.split()
        at = lambda i: F.reduce(_strings(words), F.struct(F.lit(True).alias("ok"), i.alias("at")), lambda s, w: F.struct((s["ok"] & (F.get("_w", s["at"]) == w)).alias("ok"), (s["at"] + 1).alias("at")), lambda s: s["ok"])
        starts = F.filter(F.sequence(F.lit(0), F.size("_w") - len(words)), lambda i: F.coalesce(at(i), F.lit(False)))
        there = F.lit(True)
        for w in sorted(set(words)):
            there &= F.array_contains("_w", w)
        return F.when(there & (F.size("_w") >= len(words)), starts).otherwise(F.array().cast("array<int>"))

    names = [f"_p{i}" for i in range(len(phrases))]
    own = own.select("doc_id", F.size("_w").cast("long").alias("n_words"), F.when(F.arrays_overlap("_w", prefixes), F.col("_w")).alias("ws"), *(places(p).alias(n) for n, (p, _) in zip(names, phrases, strict=True)))
    base = F.array(*(F.when(F.size(n) > 0, F.lit(label)) for n, (_, label) in zip(names, phrases, strict=True)))
    own = own.withColumn("rid", F.monotonically_increasing_id()).withColumn("base", F.array_compact(base)).withColumn("at", F.concat(*names)).drop(*names)
    own = materialize(own, "licenses")
    found = _matches(own.where("ws IS NOT NULL").select("rid", "ws"), index, entries)
    own = own.drop("ws").join(found, "rid", "left")
    own = own.withColumn("matches", F.coalesce("matches", F.array().cast(found.schema["matches"].dataType)))
    said = lambda labels: F.array_join(F.array_sort(F.array_distinct(labels)), ",")
    return own.select(
        "doc_id",
        "n_words",
        F.size("at").cast("long").alias("n_base"),
        F.array_min("at").cast("long").alias("first_word"),
        F.array_max("at").cast("long").alias("last_word"),
        said(F.col("base")).alias("base_labels"),
        said(F.concat("base", F.transform("matches", lambda m: m["label"]))).alias("labels"),
        F.greatest(F.coalesce(F.array_max(F.transform("matches", lambda m: m["share"])), F.lit(0.0)), F.when(F.size("at") > 0, 1.0).otherwise(0.0)).alias("score"),
        "matches",
    )


def sql(templates: tuple[tuple[str, str], ...] = TEMPLATES, phrases: tuple[tuple[str, str], ...] = PHRASES, least: float = 0.8) -> str:
    """The same over the table ``documents``, by comparing every run of words with every template, for DuckDB."""
    values = ",\n".join(f"('{label}', {sorted(set(t.split()))}, {math.ceil(least * len(set(t.split())) - 1e-9)}, {math.ceil(len(t.split()) / least - 1e-9)})" for label, t in templates)
    spoken = ",\n".join(f"('{label}', {p.split()})" for p, label in phrases)
    return rf"""
WITH templates(label, tokens, need, span) AS (VALUES {values}),
phrases(label, words) AS (VALUES {spoken}),
d AS (SELECT row_number() OVER () AS r, doc_id, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS t FROM documents),
w AS (SELECT r, [x FOR x IN regexp_split_to_array(t, '{SEPARATORS}') IF x <> ''] AS ws FROM d),
p AS (SELECT r, label, unnest([i FOR i IN range(0, len(ws)) IF ws[i + 1:i + len(words)] = words]) AS i FROM w, phrases),
b AS (SELECT r, count(*) AS n_base, min(i) AS first_word, max(i) AS last_word, list_sort(list(DISTINCT label)) AS base FROM p GROUP BY r),
s AS (SELECT r, label, tokens, need, span, ws FROM w, templates WHERE len(list_intersect(tokens, ws)) >= need),
k AS (SELECT r, label, tokens, need, unnest([ws[i + 1:i + span] FOR i IN range(0, len(ws))]) AS block FROM s),
m AS (SELECT r, label, len(list_intersect(tokens, block)) / len(tokens) AS share FROM k WHERE len(list_intersect(tokens, block)) >= need),
g AS (SELECT r, max(share) AS share, list(DISTINCT label) AS own FROM m GROUP BY r)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
  coalesce(array_to_string(base, ','), '') AS base_labels,
  coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(base, []), coalesce(own, [])))), ','), '') AS labels,
  CASE WHEN n_base > 0 THEN 1.0 ELSE coalesce(share, 0.0) END::DOUBLE AS score
FROM d JOIN w USING (r) LEFT JOIN b USING (r) LEFT JOIN g USING (r)
"""
