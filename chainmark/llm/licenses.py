"""Operator 13: license texts in documents, by an exact set-similarity join. DataFrame functions only.

A template is the set of words of a license text or phrase. A text's blocks, for templates of up to w words, are its runs
of 2w words that start at multiples of w, so that every run of w words lies in one block; w is a power of two. A block
matches when it holds at least ``percent`` of the template's words. The join finds all such pairs without trying all:

* words are ordered by how often they occur in all texts, rarest first;
* prefix filter: a matching block holds one of the template's first size - needed + 1 words, so only blocks around those
  words are listed, and they meet templates by an equality join on the word;
* length filter: a block holds at least ``needed`` words of templates at all;
* positional filter: behind the shared word, both the template and the block still have enough words;
* what is left is verified on the sets; a pair met by several words counts with the first of them only.

Templates marked ``phrase`` must have their words stand consecutively; each place counts once, in the block in whose first
half it starts. They are the base labels. ``score`` is the highest share of a matched template, 0 without a match.

Words are runs of digits, letters a-z (A-Z are lower-cased first) and all characters from U+0080 on. Null text is empty.
Every row is kept, also with null or repeated ids. Only the id and text columns are read, so other columns cannot clash.
No rows give no rows. The driver holds the counts of the templates' words, never more than the templates name; the prefix
index that is broadcast has one row for each word of a template at most.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chainmark.llm.joins import sized_join, stored


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    percent: int = 80
    phrase: bool = False

    @property
    def words(self) -> list[str]:
        """Words in order; template texts are plain ASCII."""
        return "".join(c if c.isalnum() else " " for c in self.text.lower()).split()

    @property
    def width(self) -> int:
        """Half the length of its blocks: the power of two that is not below its number of words, 4 at least."""
        return max(4, 1 << (len(self.words) - 1).bit_length())

    @property
    def needed(self) -> int:
        """Words that a matching block must hold."""
        return -(-len(set(self.words)) * self.percent // 100)


#: Phrases and labels that a scan must report.
BASE = (
    Template("cc-by", "cc by", 100, True),
    Template("gpl", "general public license", 100, True),
    Template("reserved", "all rights reserved", 100, True),
)
#: The usual notices of public licenses. Short ones must be held whole.
MORE = (
    Template("agpl", "GNU Affero General Public License", 100),
    Template("apache-2.0", "Licensed under the Apache License, Version 2.0", 100),
    Template("apache-2.0", "you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    Template("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
                    "following conditions are met"),
    Template("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License", 90),
    Template("cc-by-sa-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License", 95),
    Template("gpl-notice", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
                           "Public License as published by the Free Software Foundation"),
    Template("gpl-3.0", "licensed under the GNU General Public License, version 3", 100),
    Template("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    Template("mit", "Released under the MIT License", 100),
    Template("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
                    "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the "
                    "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"),
    Template("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
)

_KELVIN, _ANGSTROM = "K", "Å"


def words_of(text: Column) -> Column:
    """Words of a text. Of all letters beyond ASCII only the Kelvin sign has a lower case within it; it is to stay a letter of its own."""
    lowered = F.lower(F.replace(F.coalesce(text, F.lit("")), F.lit(_KELVIN), F.lit(_ANGSTROM)))
    return F.array_remove(F.split(lowered, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), "")


def word_counts(docs: DataFrame, vocabulary: list[str], text_col: str = "text") -> dict[str, int]:
    """How often each word of the templates occurs in all texts."""
    held = docs.select(F.explode(F.filter(words_of(F.col(text_col)), lambda w: w.isin(vocabulary))).alias("word"))
    return {r["word"]: r["n"] for r in held.groupBy("word").agg(F.count(F.lit(1)).alias("n")).collect()}


def _texts(values: list[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


@dataclass(frozen=True)
class Index:
    """Templates with their words in the global order, and that order itself."""

    order: list[str]
    rows: list[tuple]

    KIND = "width int, word string, label string, phrase boolean, size int, needed int, place int, words array<string>, run array<string>"

    @staticmethod
    def of(templates: tuple[Template, ...], counts: dict[str, int]) -> Index:
        order = sorted({w for t in templates for w in t.words}, key=lambda w: (counts.get(w, 0), w))
        rank, rows = {w: i for i, w in enumerate(order)}, []
        for t in templates:
            words = sorted(set(t.words), key=rank.__getitem__)
            for place, word in enumerate(words[:len(words) - t.needed + 1]):
                rows.append((t.width, word, t.label, t.phrase, len(words), t.needed, place, words, t.words))
        return Index(order, rows)

    def prefixes(self) -> dict[int, list[str]]:
        """Words of the templates' prefixes for each width."""
        out: dict[int, list[str]] = {}
        for width, word, *_ in self.rows:
            out.setdefault(width, []).append(word)
        return {w: sorted(set(v)) for w, v in sorted(out.items())}


def _around(text: Column, places: Column, width: int, words: list[str]) -> Column:
    """Blocks of a width around the given words: each word lies in the block that starts at or before it and in the one before that."""
    k = F.transform(F.filter(places, lambda p: p["w"].isin(words)), lambda p: F.floor(p["i"] / width).cast("int"))
    blocks = F.filter(F.array_union(k, F.transform(k, lambda x: x - 1)), lambda x: x >= 0)
    return F.transform(blocks, lambda x: F.struct(F.lit(width).alias("width"), x.alias("k"), F.slice(text, x * width + 1, 2 * width).alias("block")))


def listed_blocks(docs: DataFrame, index: Index, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per text: ``row`` (a number of its own once the table is stored), the id, ``n_words``, and the ``blocks`` around words of a prefix."""
    prefixes = index.prefixes()
    every = sorted({w for v in prefixes.values() for w in v})
    read = docs.select(id_col, words_of(F.col(text_col)).alias("_words"))
    places = F.array_compact(F.transform("_words", lambda w, i: F.when(w.isin(every), F.struct(i.alias("i"), w.alias("w")))))
    read = read.select(id_col, "_words", places.alias("_places"))
    found = [_around(F.col("_words"), F.col("_places"), width, words) for width, words in prefixes.items()]
    return read.select(F.monotonically_increasing_id().alias("row"), id_col, F.size("_words").cast("long").alias("n_words"), F.concat(*found).alias("blocks"))


def matches(table: DataFrame, index: Index) -> DataFrame:
    """``(row, label, phrase, starts, share)`` of every block that matches a template; ``starts`` are the places of a phrase."""
    blocks = table.select("row", F.explode("blocks").alias("b")).select("row", "b.width", "b.k", "b.block")
    prefix = sorted({r[1] for r in index.rows})
    met = blocks.withColumn("word", F.explode(F.array_intersect(_texts(prefix), "block")))
    known = table.sparkSession.createDataFrame(index.rows, Index.KIND)
    pairs = met.join(F.broadcast(known), ["width", "word"])
    held = F.array_intersect(_texts(index.order), F.col("block"))
    pairs = pairs.withColumn("held", held).where(F.size("held") >= F.col("needed"))
    behind = F.least(F.col("size") - F.col("place"), F.size("held") - F.array_position("held", F.col("word")).cast("int") + 1)
    pairs = pairs.where(behind >= F.col("needed"))
    shared = pairs.withColumn("shared", F.array_intersect("words", "block"))
    sure = shared.where((F.size("shared") >= F.col("needed")) & (F.get("shared", F.lit(0)) == F.col("word")))
    at = F.filter(F.sequence(F.lit(1), F.col("width")), lambda i: F.slice("block", i, F.size("run")) == F.col("run"))
    starts = F.when(F.col("phrase"), F.transform(at, lambda i: (F.col("k").cast("long") * F.col("width") + i - 1)))
    sure = sure.select("row", "label", "phrase", starts.alias("starts"), (F.size("shared") / F.col("size")).alias("share"))
    return sure.where(~F.col("phrase") | (F.size("starts") > 0))


def license_report(docs: DataFrame, base: tuple[Template, ...] = BASE, more: tuple[Template, ...] = MORE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, n_words, n_base, first_word, last_word, base_labels, labels, score)`` of each whole text."""
    templates = (*base, *more)
    counts = word_counts(docs, sorted({w for t in templates for w in t.words}), text_col)
    index = Index.of(templates, counts)
    table = stored(listed_blocks(docs, index, id_col, text_col), "license-blocks")

    def listed(labels: Column) -> Column:
        return F.array_join(F.sort_array(F.collect_set(labels)), ",")

    found = matches(table, index).groupBy("row").agg(
        F.sum(F.when(F.col("phrase"), F.size("starts")).otherwise(0)).alias("n"), F.min(F.array_min("starts")).alias("first_word"),
        F.max(F.array_max("starts")).alias("last_word"), listed(F.when(F.col("phrase"), F.col("label"))).alias("of_base"),
        listed(F.col("label")).alias("of_all"), F.max("share").alias("share"))
    rows = sized_join(table.drop("blocks"), stored(found, "license-matches"), ["row"], "left")
    return rows.select(
        id_col, "n_words", F.coalesce("n", F.lit(0).cast("long")).alias("n_base"), "first_word", "last_word", F.coalesce("of_base", F.lit("")).alias("base_labels"),
        F.coalesce("of_all", F.lit("")).alias("labels"), F.coalesce("share", F.lit(0.0)).alias("score"))
