"""License scan: an exact set-similarity join of text blocks with license templates, in DataFrame functions only."""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What stands between words, as a Java class: ASCII but digits and small letters.
_BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: Phrases whose words must stand consecutively, by label.
PHRASES = {"cc-by": "cc by", "gpl": "general public license", "reserved": "all rights reserved"}
#: Statements and notices of public licenses; a label may have several.
TEMPLATES = [
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("apache-2.0", "you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0"),
    ("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0"),
    ("cc0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work"),
    ("gpl-3.0", "licensed under the GNU General Public License, version 3"),
    ("gpl", "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
]
#: The share of a template's distinct words that a block must hold, in hundredths.
THRESHOLD = 90
#: Half of the smallest block, in words.
LEAST_STEP = 8


def words_of(text: str) -> list[str]:
    lowered = text.translate(str.maketrans(_UPPER, _LOWER))
    return [w for w in re.split(_BETWEEN, lowered) if w]


@dataclass(frozen=True)
class Template:
    """A label and its words; a phrase's words must stand consecutively.

    Blocks for it are windows of ``2 * step`` words, one each ``step`` words; the
    step is the least power of two that its words fit into, so each of its
    occurrences lies whole in a block.
    """

    label: str
    words: tuple[str, ...]
    phrase: bool = False

    @property
    def tokens(self) -> frozenset[str]:
        return frozenset(self.words)

    @property
    def step(self) -> int:
        return max(LEAST_STEP, 1 << (len(self.words) - 1).bit_length())

    def least(self, threshold: int) -> int:
        """Distinct words that a block must share."""
        return len(self.tokens) if self.phrase else math.ceil(len(self.tokens) * threshold / 100)


def default_templates() -> list[Template]:
    return [Template(label, tuple(words_of(t)), True) for label, t in PHRASES.items()] + [Template(label, tuple(words_of(t))) for label, t in TEMPLATES]


def _words(text: Column) -> Column:
    return F.filter(F.split(F.translate(F.coalesce(text.cast("string"), F.lit("")), _UPPER, _LOWER), _BETWEEN), lambda w: w != "")


def _strings(values: list[str]) -> Column:
    return F.array(*[F.lit(v) for v in values]) if values else F.array().cast("array<string>")


def global_order(docs: DataFrame, templates: list[Template]) -> list[str]:
    """The templates' words from the rarest in all documents; as many rows come back as the templates have words."""
    known = sorted(set().union(*[t.tokens for t in templates]))
    found = docs.select(F.explode(F.filter(_words(F.col("text")), lambda w: w.isin(known))).alias("w")).groupBy("w").count().collect()
    often = {r["w"]: r["count"] for r in found}
    return sorted(known, key=lambda w: (often.get(w, 0), w))


def license_blocks(docs: DataFrame, templates: list[Template] | None = None, threshold: int = THRESHOLD) -> DataFrame:
    """Every block that holds ``threshold`` % of a template's distinct words: ``doc_id, th, label, phrase, first, last, score``.

    ``first`` and ``last`` are the block's places among the document's words (for
    a phrase, the words of the occurrence itself), ``score`` is the share held.  ``th`` is
    ``xxhash64(text)``, as a doc_id may repeat.

    Exact set-similarity join: words are ordered from the rarest in the whole
    corpus.  Prefix filter: a block that shares ``a`` of a template's ``n``
    words holds one of its ``n - a + 1`` rarest, so only windows around these
    words become rows, and a window of ``m`` known words must have it among its own ``m - a + 1``
    rarest.  Length filter: a window with fewer known words than ``a`` goes.
    Positional filter: what is left of both after the first shared word must
    reach ``a``.  The rest is counted exactly.  Nothing is shuffled; a document
    gives each window once, so at most twice its words for each window size.
    """
    templates = default_templates() if templates is None else templates
    order = global_order(docs, templates)
    rank = {w: i for i, w in enumerate(order)}
    spark = docs.sparkSession
    index, by_step = [], {}
    for t in templates:
        tokens = sorted(t.tokens, key=rank.get)
        least = t.least(threshold)
        for i, w in enumerate(tokens[: len(tokens) - least + 1]):
            index.append((t.step, w, i, t.label, t.phrase, list(t.words), tokens, least))
            by_step.setdefault(t.step, set()).add(w)
    lists = spark.createDataFrame(index, "step int, w string, i int, label string, phrase boolean, words array<string>, tokens array<string>, least int")

    def windows(words: Column, step: int, prefix: list[str]) -> Column:
        """Windows of ``2 * step`` words around the prefix words."""
        places = F.filter(F.transform(words, lambda w, i: F.when(w.isin(prefix), (i / step).cast("int"))), lambda k: k.isNotNull())
        turns = F.array_distinct(F.flatten(F.transform(places, lambda k: F.array(k, F.greatest(k - 1, F.lit(0))))))
        return F.transform(turns, lambda k: F.struct(F.lit(step).alias("step"), (k * step).alias("at"), F.slice(words, k * step + 1, F.lit(2 * step)).alias("block")))

    known = _strings(order)
    texts = docs.select("doc_id", F.xxhash64(F.col("text").cast("string")).alias("th"), _words(F.col("text")).alias("words"))
    cuts = texts.select("doc_id", "th", F.inline(F.concat(*[windows(F.col("words"), step, sorted(p)) for step, p in sorted(by_step.items())])))
    held = cuts.withColumn("held", F.array_intersect(known, F.col("block")))
    met = held.withColumn("w", F.explode("held")).join(F.broadcast(lists), ["step", "w"])  # a few rows a template
    j, m, n, least = F.array_position("held", F.col("w")), F.size("held"), F.size("tokens"), F.col("least")
    passed = met.filter((m >= least) & (j <= m - least + 1) & (F.least(n - F.col("i"), m - j + 1) >= least))
    shared = F.size(F.array_intersect("tokens", "held"))
    good = passed.withColumn("shared", shared).filter(F.col("shared") >= least)
    # The starts of a phrase in the first half of its block, as the next block begins there.
    begins = lambda k: F.slice("block", k + 1, F.size("words")) == F.col("words")
    starts = F.when(F.col("phrase"), F.filter(F.sequence(F.lit(0), F.col("step") - 1), begins)).otherwise(F.array(F.lit(0)))
    placed = good.withColumn("k", F.explode(starts))
    first = F.col("at") + F.col("k")
    last = F.when(F.col("phrase"), first + F.size("words") - 1).otherwise(F.col("at") + F.size("block") - 1)
    return placed.select("doc_id", "th", "label", "phrase", first.cast("long").alias("first"), last.cast("long").alias("last"), (F.col("shared") / n).alias("score"))


def scan_licenses(docs: DataFrame, templates: list[Template] | None = None, threshold: int = THRESHOLD) -> DataFrame:
    """A row a document: ``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score``.

    ``n_base`` places of phrases, with their smallest and largest start;
    ``base_labels`` of phrases and ``labels`` of all blocks, distinct, sorted and
    joined by commas; ``score`` the largest share of a template that a block
    holds (0 where none is met).  Defined cases: null or empty text, and text
    without words, has no words and no labels; repeated rows each give a row; a null
    doc_id is kept; no rows give no rows; other columns are ignored.
    """
    docs = docs.select("doc_id", "text")
    blocks = license_blocks(docs, templates, threshold)
    base = F.when(F.col("phrase"), F.struct("label", "first"))
    joined = lambda c: F.array_join(F.sort_array(F.collect_set(c)), ",")
    found = blocks.groupBy(F.col("doc_id").alias("doc"), F.col("th").alias("at")).agg(
        F.count_distinct(base).alias("n_base"), F.min(base["first"]).alias("first_word"), F.max(base["first"]).alias("last_word"),
        joined(base["label"]).alias("base_labels"), joined(F.col("label")).alias("labels"), F.max("score").alias("score"),
    )
    all_docs = docs.select("doc_id", F.xxhash64(F.col("text").cast("string")).alias("th"), F.size(_words(F.col("text"))).cast("long").alias("n_words"))
    out = all_docs.join(found, F.col("doc_id").eqNullSafe(F.col("doc")) & (F.col("th") == F.col("at")), "left")
    return out.fillna({"n_base": 0, "base_labels": "", "labels": "", "score": 0.0}).select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")
