"""License scan by diagonal voting.

1. One map over the texts gives the rolling word k-gram hashes of each. Spark
   joins them with the template positions that hold the same gram; the table
   of templates is a parameter whose size is checked before it is broadcast
   (beyond ``BROADCAST_GRAMS`` the join is a shuffle).
2. A hit votes for its diagonal, text position less template position. Votes
   are counted per (text, template, diagonal); equal texts are one, so a text
   copied a million times is counted once.
3. Neighbouring diagonals (words put in or left out move the rest of a
   license to the next diagonals) are merged where they lie close together.
4. Every merged span with enough votes is verified against the words of the
   text: the longest common subsequence with the template, over the
   template's length, must reach ``min_similarity``, and the words a template
   ``needs`` must stand in the span.

An exact template (a phrase) must stand word by word on one diagonal; its
places are never merged, so each place is a span.

Work per text is bounded by its length: a (text, template) group holds the
hits of one text. Long texts are exploded in chunks of ``CHUNK`` words.

Defined cases: a null text counts as empty; an empty one has no words and no
spans; a null or repeated id is carried as it is, each row with the spans of
its text; extra columns are ignored (names cannot clash); an empty table
gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .textops import PUNCTUATION, Words, mix, release, slices

K = 3
CHUNK = 1 << 16
BROADCAST_GRAMS = 1_000_000   # template positions
BROADCAST_SPANS = 200_000     # spans of all texts; beyond, texts and spans meet by a shuffle
_MULT = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    exact: bool = False
    needs: tuple[str, ...] = ()


# Phrases that name a license, and openings of public license texts.
PHRASES = (
    Template("mit", "mit license", exact=True),
    Template("apache", "apache license", exact=True),
    Template("gpl", "general public license", exact=True),
)
TEXTS = (
    Template("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
             "associated documentation files, to deal in the Software without restriction, including without limitation "
             "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"),
    Template("mit", "Released under the MIT License", needs=("mit",)),
    Template("apache", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in "
             "compliance with the License. You may obtain a copy of the License at", needs=("apache",)),
    Template("apache", "Licensed under the Apache License, Version 2.0", needs=("apache",)),
    Template("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
             "General Public License as published by the Free Software Foundation, either version 3 of the License, or "
             "(at your option) any later version", needs=("general", "public")),
    Template("gpl", "This work is licensed under the GNU General Public License, version 3", needs=("general", "public")),
    Template("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU "
             "Lesser General Public License as published by the Free Software Foundation", needs=("lesser",)),
    Template("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted "
             "provided that the following conditions are met"),
    Template("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee "
             "is hereby granted, provided that the above copyright notice and this permission notice appear in all copies"),
    Template("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the "
             "MPL was not distributed with this file, You can obtain one at", needs=("mozilla",)),
    Template("unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, "
             "modify, publish, use, compile, sell, or distribute this software"),
    Template("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License",
             needs=("creative", "commons")),
    Template("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
             needs=("creative", "commons", "sharealike")),
)
TEMPLATES = PHRASES + TEXTS


def word_hashes(text: str) -> np.ndarray:
    return Words(pa.array([text]), breaks=PUNCTUATION).hashes


def rolling(h: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of ``k`` words."""
    with np.errstate(over="ignore"):
        run = np.zeros(max(0, len(h) - k + 1), dtype=np.uint64)
        for j in range(k):
            run = run * _MULT + h[j:j + len(run)]
        return mix(run + np.uint64(k))


def common_words(template: np.ndarray, window: np.ndarray) -> int:
    """Length of the longest common subsequence, by bits of one integer."""
    places: dict[int, int] = {}
    for i, w in enumerate(template.tolist()):
        places[w] = places.get(w, 0) | 1 << i
    full = (1 << len(template)) - 1
    row = full
    for w in window.tolist():
        hit = row & places.get(w, 0)
        row = (row + hit | row - hit) & full
    return len(template) - row.bit_count()


def template_grams(templates: tuple[Template, ...], k: int) -> tuple[list[tuple], list[int]]:
    """(gram, template, position) of all templates, and the gram sizes used."""
    rows, sizes = [], set()
    for t, template in enumerate(templates):
        h = word_hashes(template.text)
        size = min(k, len(h))
        if not size:
            raise ValueError(f"template {t} has no words")
        sizes.add(size)
        rows += [(g, t, i) for i, g in enumerate(rolling(h, size).view(np.int64).tolist())]
    return rows, sorted(sizes)


def text_grams(texts: DataFrame, sizes: list[int]) -> DataFrame:
    """key, base, grams: per chunk of a text, the gram of each size at every
    word, null where the text ends before."""
    def run(batches):
        for b in slices(batches, "text"):
            w = Words(b.column("text"), breaks=PUNCTUATION)
            h, n = w.hashes, len(w.hashes)
            left = np.repeat(w.ptr[1:], w.counts()) - np.arange(n)
            grams, valid = np.zeros((n, len(sizes)), dtype=np.uint64), np.zeros((n, len(sizes)), dtype=bool)
            for j, size in enumerate(sizes):
                run_ = rolling(h, size)
                grams[:len(run_), j] = run_
                valid[:, j] = left >= size
            counts = w.counts()
            chunks = -(-counts // CHUNK)
            row = np.repeat(np.arange(w.n_docs), chunks)
            base = CHUNK * (np.arange(len(row)) - np.repeat(np.cumsum(chunks) - chunks, chunks))
            ptr = np.append(w.ptr[row] + base, n) * len(sizes)
            values = pa.array(grams.ravel().view(np.int64), mask=~valid.ravel())
            lists = pa.ListArray.from_arrays(pa.array(ptr, pa.int32()), values)
            yield pa.RecordBatch.from_arrays([b.column("key").take(pa.array(row)), pa.array(base, pa.int64()), lists],
                                             names=["key", "base", "grams"])

    return texts.mapInArrow(run, "key binary, base long, grams array<long>")


def candidates(texts: DataFrame, templates: tuple[Template, ...], k: int = K, shift: int = 6,
               min_similarity: float = 0.8) -> DataFrame:
    """key, spans (template, lowest and highest diagonal, first word, end):
    merged diagonals with enough votes, one row per distinct text."""
    spark = texts.sparkSession
    rows, sizes = template_grams(templates, k)
    grams = spark.createDataFrame(rows, "gram long, template int, at int")
    if len(rows) <= BROADCAST_GRAMS:
        grams = F.broadcast(grams)
    # needed votes: an edited word spoils at most k grams
    shape = []
    for t, template in enumerate(templates):
        m = len(word_hashes(template.text))
        size = min(k, m)
        votes = m - size + 1
        if not template.exact:
            votes = max(1, int(np.ceil(votes - k * (1 - min_similarity) * m)))
        shape.append((t, size, votes, template.exact))
    shape = spark.createDataFrame(shape, "template int, size int, needed int, exact boolean")

    found = text_grams(texts, sizes).select("key", "base", F.posexplode("grams").alias("i", "gram"))
    hits = found.join(grams, "gram").select(
        "key", "template", "at", (F.col("base") + F.floor(F.col("i") / len(sizes))).alias("word"))
    hits = hits.distinct().withColumn("diagonal", F.col("word") - F.col("at"))
    diagonals = hits.groupBy("key", "template", "diagonal").agg(
        F.count(F.lit(1)).alias("votes"), F.min("word").alias("first"), F.max("word").alias("last"))
    diagonals = diagonals.join(F.broadcast(shape), "template").withColumn("end", F.col("last") + F.col("size"))
    # a new span begins where the diagonal or the place jumps
    own = Window.partitionBy("key", "template").orderBy("first", "diagonal")
    before = own.rowsBetween(Window.unboundedPreceding, -1)
    jump = (F.abs(F.col("diagonal") - F.lag("diagonal").over(own)) > shift) | (
        F.col("first") - F.max("end").over(before) > 2 * shift)
    spans = (diagonals.withColumn("new", F.when(F.col("exact") | F.coalesce(jump, F.lit(True)), 1).otherwise(0))
             .withColumn("span", F.sum("new").over(own))
             .groupBy("key", "template", "span", "needed")
             .agg(F.sum("votes").alias("votes"), F.min("diagonal").alias("low"), F.max("diagonal").alias("high"),
                  F.min("first").alias("first"), F.max("end").alias("end"))
             .filter(F.col("votes") >= F.col("needed")))
    return spans.groupBy("key").agg(F.collect_list(F.struct("template", "low", "high", "first", "end")).alias("spans"))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: tuple[Template, ...] = TEMPLATES,
         k: int = K, shift: int = 6, min_similarity: float = 0.8,
         broadcast_spans: int = BROADCAST_SPANS) -> DataFrame:
    """doc_id, n_words, spans (label, exact, first_word, end_word, similarity)
    of every document; spans below ``min_similarity`` are left out."""
    docs = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    docs = docs.withColumn("key", F.unhex(F.md5(F.col("text").cast("binary"))))
    found = candidates(docs.select("key", "text"), templates, k, shift, min_similarity).checkpoint(eager=True)
    # what is held in the broadcast grows with the texts that have spans, so it is counted
    if (found.agg(F.sum(F.size("spans"))).first()[0] or 0) <= broadcast_spans:
        found = F.broadcast(found)
    hashed = [word_hashes(t.text) for t in templates]
    needed = [[int(x) for word in t.needs for x in word_hashes(word)] for t in templates]
    kind = docs.dtypes[0][1]

    def verified(words: np.ndarray, span: dict) -> tuple | None:
        t = span["template"]
        template, mine = templates[t], hashed[t]
        if template.exact:
            place = words[span["first"]:span["end"]]
            same = len(place) == len(mine) and bool((place == mine).all())
            return (template.label, True, span["first"], span["end"], 1.0) if same else None
        window = words[max(0, span["low"] - shift):span["high"] + len(mine) + shift]
        likeness = common_words(mine, window) / len(mine)
        if likeness < min_similarity or not set(needed[t]) <= set(window.tolist()):
            return None
        return template.label, False, span["first"], span["end"], likeness

    names = ["label", "exact", "first_word", "end_word", "similarity"]
    types = [pa.string(), pa.bool_(), pa.int64(), pa.int64(), pa.float64()]

    def run(batches):
        for b in slices(batches, "text"):
            w = Words(b.column("text"), breaks=PUNCTUATION)
            rows, ptr = [], [0]
            for i, spans in enumerate(b.column("spans").to_pylist()):
                words = w.hashes[w.ptr[i]:w.ptr[i + 1]]
                own = [v for v in (verified(words, s) for s in spans or ()) if v]
                rows += sorted(own, key=lambda v: (v[2], v[3], v[0], not v[1]))
                ptr.append(len(rows))
            columns = list(zip(*rows)) or [()] * len(names)
            items = pa.StructArray.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(w.counts(), pa.int64()),
                 pa.ListArray.from_arrays(pa.array(ptr, pa.int32()), items)], names=["doc_id", "n_words", "spans"])
        release()

    return docs.join(found, "key", "left").select("doc_id", "text", "spans").mapInArrow(
        run, f"doc_id {kind}, n_words long, spans array<struct<label string, exact boolean, first_word long, "
             "end_word long, similarity double>>")
