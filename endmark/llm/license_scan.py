"""License scan: a set-similarity join of text blocks with license templates by containment.

Blocks are the lines of a text and, so that notices wrapped over lines are found whole, overlapping windows of its words: for a
template of n words, h being the next power of two from 8, windows of 2h words start at every h-th word, and so any h
words in a row lie in one of them. A block matches a template T if it holds at least `threshold` of T's distinct words:
need = ceil(threshold |T|) of them. Template words are ordered by how many documents of the whole corpus hold them,
rarest first. Three filters leave few candidates and lose none:
prefix - a matching block holds one of T's first |T| - need + 1 words, so blocks without any prefix word
of any template are skipped; length - it holds at least need words of the templates' vocabulary; position -
after the first common word at place i of T and j of the block (both in the global order) no more words can
be common than 1 + min(what is left of T, what is left of the block). Survivors are counted in full.

Only DataFrame functions are used, and the scan itself needs no shuffle; the frequencies are one count for each
vocabulary word, a number that the templates bound. Null texts are empty: no words, no labels, score 0.
Repeated rows and extra columns are kept; columns named like the results are replaced.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, text_of

# Opening words of public license notices. Those told apart by one word have at most nine, all of which a block must hold.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "apache-2.0": (
        "licensed under the apache license version 2.0",
        "licensed under the apache license version 2.0 the license you may not use this file except in compliance with the license",
    ),
    "mit": (
        "released under the mit license",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files",
    ),
    "bsd": (
        "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
        "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    ),
    "mpl-2.0": ("this source code form is subject to the terms of the mozilla public license v 2.0",),
    "gpl-3.0": (
        "licensed under the gnu general public license version 3",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation",
    ),
    "lgpl": ("licensed under the gnu lesser general public license",),
    "cc-by-nc": ("licensed under cc by nc 4.0", "creative commons attribution noncommercial 4.0 international license"),
    "cc-by-sa": ("licensed under cc by sa 4.0", "creative commons attribution sharealike 4.0 international license"),
    "cc-by-4.0": ("licensed under a creative commons attribution 4.0 international license",),
    "cc-by-nd": ("creative commons attribution noderivatives 4.0 international license",),
    "cc0": ("to the extent possible under law the author has waived all copyright and related or neighboring rights to this work",),
    "agpl-3.0": ("licensed under the gnu affero general public license",),
    "gfdl": ("permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license",),
    "epl-2.0": ("this program and the accompanying materials are made available under the terms of the eclipse public license 2.0",),
    "isc": ("permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",),
    "zlib": ("this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages arising from the use of this software",),
    "boost": ("distributed under the boost software license version 1.0",),
    "unlicense": ("this is free and unencumbered software released into the public domain",),
}
# Phrases that name a license wherever their words stand together.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

NOT_WORD = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(lowered: Column) -> Column:
    return F.array_remove(F.split(lowered, NOT_WORD), "")


def template_words(templates: dict[str, tuple[str, ...]]) -> list[tuple[str, list[str], int]]:
    """(label, distinct words, half its window) of every template."""
    cut = [(label, text.replace(".", " ").lower().split()) for label, texts in templates.items() for text in texts]
    return [(label, sorted(set(ws)), max(8, 1 << (len(ws) - 1).bit_length())) for label, ws in cut]


def _strings(values: list[str]) -> Column:
    return F.array(*map(F.lit, values)).cast("array<string>")


def frequencies(docs: DataFrame, vocabulary: list[str], text: str = "text") -> dict[str, int]:
    """In how many documents each word of the vocabulary stands."""
    w = words(F.translate(text_of(text), UPPER, LOWER))
    held = docs.select(F.explode(F.array_intersect(_strings(vocabulary), w)).alias("word"))
    return {**dict.fromkeys(vocabulary, 0), **{r["word"]: r["count"] for r in held.groupBy("word").count().collect()}}


Entry = tuple[str, list[str], int, int]  # label, words in the global order, need, half the window


def _index(templates: dict[str, tuple[str, ...]], threshold: float, counts: dict[str, int]) -> tuple[list[str], list[Entry]]:
    """The vocabulary in global order, and the entry of every template."""
    order = sorted(counts, key=lambda x: (counts[x], x))
    place = {x: k for k, x in enumerate(order)}
    return order, [(label, sorted(ws, key=place.get), max(1, math.ceil(threshold * len(ws) - 1e-9)), half) for label, ws, half in template_words(templates)]


def _prefixes(index: list[Entry]) -> Column:
    return _strings(sorted({x for _, ws, need, _ in index for x in ws[: len(ws) - need + 1]}))


def _lines(lowered: Column, separator: str) -> Column:
    return F.transform(F.split(lowered, separator), lambda b, k: F.struct(F.lit("line").alias("kind"), k.alias("block"), F.split(b, NOT_WORD).alias("words")))


def _windows(w: Column, half: int) -> Column:
    starts = F.when(F.size(w) > 0, F.sequence(F.lit(0), F.floor((F.size(w) - 1) / half).cast("int")))
    return F.transform(F.coalesce(starts, F.array().cast("array<int>")), lambda k: F.struct(F.lit("window").alias("kind"), (k * half).alias("block"), F.slice(w, k * half + 1, F.lit(2 * half)).alias("words")))


def _matches(blocks: Column, order: list[str], index: list[Entry]) -> Column:
    """For an array of blocks (kind, block, words): array of (kind, block, label, score) of every match."""
    prefixes = _prefixes(index)
    rows = F.array(*[F.struct(F.lit(label).alias("label"), _strings(ws).alias("words"), _strings(ws[: len(ws) - need + 1]).alias("prefix"), F.lit(need).alias("need"), F.lit(len(ws)).alias("n")) for label, ws, need, _ in index])
    held = F.filter(blocks, lambda b: F.arrays_overlap(b["words"], prefixes))
    # array_intersect keeps the order of its first argument: the global one
    held = F.transform(held, lambda b: F.struct(b["kind"].alias("kind"), b["block"].alias("block"), F.array_intersect(_strings(order), b["words"]).alias("words")))

    def joined(b: Column) -> Column:
        long_enough = F.filter(rows, lambda t: F.size(b["words"]) >= t["need"])
        first = F.transform(long_enough, lambda t: F.struct(t.alias("t"), F.get(F.array_intersect(t["prefix"], b["words"]), F.lit(0)).alias("first")))
        # no common prefix word: first is null, and so is the bound
        bound = lambda x: 1 + F.least(x["t"]["n"] - F.array_position(x["t"]["words"], x["first"]), F.size(b["words"]) - F.array_position(b["words"], x["first"]))
        close = F.filter(first, lambda x: x["first"].isNotNull() & (bound(x) >= x["t"]["need"]))
        counted = F.transform(close, lambda x: F.struct(x["t"]["label"].alias("label"), F.size(F.array_intersect(x["t"]["words"], b["words"])).alias("common"), x["t"]["need"].alias("need"), x["t"]["n"].alias("n")))
        return F.transform(F.filter(counted, lambda x: x["common"] >= x["need"]), lambda x: F.struct(b["kind"].alias("kind"), b["block"].alias("block"), x["label"].alias("label"), (x["common"] / x["n"]).alias("score")))

    return F.flatten(F.transform(held, joined))


def license_scan(docs: DataFrame, text: str = "text", templates: dict[str, tuple[str, ...]] = TEMPLATES, threshold: float = 0.9, separator: str = "\n") -> DataFrame:
    """docs with n_words, n_base, first_word, last_word (long), base_labels, labels (string), matches (array of kind, block, label, score)
    and score (double). Lines lie between matches of the regex `separator` and are numbered from 0, a window's block is its first word;
    score is the best containment of a matching template, 1 with a base phrase."""
    vocabulary = sorted({x for _, ws, _ in template_words(templates) for x in ws})
    order, index = _index(templates, threshold, frequencies(docs, vocabulary, text))
    new = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "matches", "score")
    docs = docs.drop(*[c for c in new if c != text])
    t, w, joined, places = fresh(docs, "t", "w", "joined", "places")
    d = docs.withColumn(t, F.translate(text_of(text), UPPER, LOWER)).withColumn(w, words(F.col(t)))
    d = d.withColumn(joined, F.concat(F.lit(" "), F.array_join(w, " "), F.lit(" ")))
    stands = F.lit(False)
    at = []
    for phrase, label in PHRASES.items():
        stands = stands | F.contains(F.col(joined), F.lit(f" {phrase} "))
        here = lambda i, parts=tuple(phrase.split()): [F.get(F.col(w), i + k) == part for k, part in enumerate(parts)]
        at.append((label, lambda i, here=here: _all(here(i))))
    spots = F.transform(F.sequence(F.lit(0), F.size(w) - 1), lambda i: F.struct(i.alias("at"), F.coalesce(*[F.when(test(i), F.lit(label)) for label, test in at]).alias("label")))
    spots = F.filter(spots, lambda x: x["label"].isNotNull())  # no two phrases begin with the same word
    none = F.array().cast("array<struct<at:int,label:string>>")
    d = d.withColumn(places, F.when(stands, spots).otherwise(none))
    found = [_matches(_lines(F.col(t), separator), order, index)]
    for half in sorted({x[3] for x in index}):
        found.append(_matches(_windows(F.col(w), half), order, [x for x in index if x[3] == half]))
    d = d.withColumn("matches", F.when(F.arrays_overlap(F.col(w), _prefixes(index)), F.concat(*found)).otherwise(F.array().cast("array<struct<kind:string,block:int,label:string,score:double>>")))
    base = F.transform(F.col(places), lambda x: x["label"])
    d = d.withColumns({
        "n_words": F.size(w).cast("long"), "n_base": F.size(places).cast("long"),
        "first_word": F.array_min(F.transform(F.col(places), lambda x: x["at"])).cast("long"), "last_word": F.array_max(F.transform(F.col(places), lambda x: x["at"])).cast("long"),
        "base_labels": F.array_join(F.array_sort(F.array_distinct(base)), ","),
        "labels": F.array_join(F.array_sort(F.array_union(base, F.transform("matches", lambda x: x["label"]))), ","),
        "score": F.when(F.size(places) > 0, F.lit(1.0)).otherwise(F.coalesce(F.array_max(F.transform("matches", lambda x: x["score"])), F.lit(0.0))),
    })
    return d.drop(t, w, joined, places)


def _all(tests: list[Column]) -> Column:
    out = tests[0]
    for x in tests[1:]:
        out = out & x
    return out
