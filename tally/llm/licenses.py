"""Operator 3: license scan as an exact set-similarity join with templates.

A text block is a run of the text's words, line breaks or not. Its size follows
the template: for a template of up to L words, L a power of two, blocks of 2 L
words start at every L-th word, so any passage of up to L + 1 words lies whole
in a block. A block matches a template when it holds at least ``threshold`` of
the template's distinct words, and all that the template requires (such as a
license's name). Words of no template cannot count, so a block is its set of
template words, in a global order: rarest first, by the number of documents of
the whole table that hold the word.

* length filter: a block with fewer template words than needed cannot match;
* prefix filter: with n words and k needed, a match holds one of the
  template's first n - k + 1 words and has one of its own first there;
* positional filter: a shared word at places i and j leaves at most
  1 + min(n - 1 - i, m - 1 - j) further shared words from there on.

Survivors are verified by intersection, so the join finds every block that
meets the threshold. Only blocks with a word of some prefix are looked at.
Templates are a parameter of any size; the driver and every task hold them.

Base places are those where a phrase's words stand consecutively. Base labels
always stay; the join adds labels.

Defined cases: null and empty texts have no words, labels or places. Texts of
any length are read whole. Repeated rows give repeated results. An empty
table gives an empty result. Columns other than id and text are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tally.llm.common import chunks, id_and_text, table, tidy

# Base phrases and their labels.
PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))
# License notices as they are commonly worded, and their labels.
# The third entry: words that a block must hold in any case.
TEMPLATES = (
    ("mit", "Released under the MIT License.", "mit"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files", "permission granted software"),
    ("apache", "Licensed under the Apache License, Version 2.0.", "apache"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3.", "gnu general public"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
            "General Public License", "gnu general public"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0.", "cc by nc"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License.",
     "creative commons attribution"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted "
            "provided that the following conditions are met", "redistribution source binary"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "mozilla"),
    ("reserved", "All rights reserved. No part of this publication may be reproduced without prior permission.",
     "reserved reproduced"),
)
THRESHOLD = 0.8

# Word characters are digits, letters and everything beyond ASCII; A-Z are lower-cased.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
              for b in range(256))


def words_of(text: bytes) -> list[bytes]:
    """Lower-cased words of a UTF-8 text."""
    return text.translate(_FOLD).split()


class Index:
    """Templates in the global order, and an inverted index of their prefixes per block size."""

    def __init__(self, templates: Sequence[tuple[str, ...]], counts: dict[bytes, int], threshold: float) -> None:
        self.rank = {w: i for i, w in enumerate(sorted(counts, key=lambda w: (counts[w], w)))}
        self.sets, self.need, self.must, self.labels = [], [], [], [t[0] for t in templates]
        self.prefix: dict[int, dict[bytes, list[tuple[int, int]]]] = {}
        for t, (_, text, *must) in enumerate(templates):
            run = words_of(text.encode())
            words = sorted(set(run), key=self.rank.__getitem__)
            need = max(1, math.ceil(threshold * len(words) - 1e-9))
            self.sets.append(frozenset(words))
            self.need.append(need)
            self.must.append(frozenset(words_of(" ".join(must).encode())))
            size = 1 << max(0, len(run) - 1).bit_length()
            for i, w in enumerate(words[:len(words) - need + 1]):
                self.prefix.setdefault(size, {}).setdefault(w, []).append((t, i))
        self.keys = frozenset(w for p in self.prefix.values() for w in p)

    def match(self, block: set[bytes], size: int) -> list[tuple[int, float]]:
        """(template, containment) of each template of a size that the block meets."""
        mine = sorted(block.intersection(self.rank), key=self.rank.__getitem__)
        m, tried, out, prefix = len(mine), set(), [], self.prefix[size]
        for j, w in enumerate(mine):
            for t, i in prefix.get(w, ()):
                if t in tried:
                    continue
                n, need = len(self.sets[t]), self.need[t]
                if m < need or j > m - need:  # length; not in the block's own prefix
                    continue
                tried.add(t)  # the first shared word decides by position
                if 1 + min(n - 1 - i, m - 1 - j) < need:
                    continue
                shared = len(self.sets[t].intersection(mine))
                if shared >= need and self.must[t] <= block:
                    out.append((t, shared / n))
        return out

    def blocks(self, words: list[bytes]) -> Iterator[tuple[int, int, int, float]]:
        """(first word, number of words, template, containment) of every block of a text that meets a template."""
        at = [k for k, w in enumerate(words) if w in self.keys]
        for size, prefix in sorted(self.prefix.items()):
            starts = {k // size - d for k in at if words[k] in prefix for d in (0, 1)}
            for first in sorted(s * size for s in starts if s >= 0):
                block = words[first:first + 2 * size]
                for t, containment in self.match(set(block), size):
                    yield first, len(block), t, containment


def word_counts(docs: DataFrame, vocabulary: frozenset[bytes]) -> dict[bytes, int]:
    """Documents that hold each template word, over the whole table.

    Each task sends one row per template word; the result is no larger than
    the templates.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n: Counter[bytes] = Counter()
        for whole in batches:
            for b in chunks(whole):
                for text in b.column(1).cast(pa.binary()).to_pylist():
                    n.update(vocabulary.intersection(words_of(text)))
        yield pa.record_batch([pa.array([w.decode() for w in n], pa.string()), pa.array(list(n.values()), pa.int64())],
                              names=["word", "n"])
    got = docs.mapInArrow(tidy(run), "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()
    return dict.fromkeys(vocabulary, 0) | {r["word"].encode(): r["n"] for r in got}


def _places(words: list[bytes], phrases: Sequence[tuple[list[bytes], str]]) -> list[tuple[int, str]]:
    out = []
    for phrase, label in phrases:
        at = -1
        while True:
            try:
                at = words.index(phrase[0], at + 1)
            except ValueError:
                break
            if words[at:at + len(phrase)] == phrase:
                out.append((at, label))
    return out


def scan_licenses(docs: DataFrame, templates: Sequence[tuple[str, ...]] = TEMPLATES,
                  phrases: Sequence[tuple[str, str]] = PHRASES, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, n_words, places (array of start, label), blocks (array of start, words, label, containment).

    Templates are (label, text) or (label, text, required words).
    """
    vocabulary = frozenset(w for t in templates for w in words_of(t[1].encode()))
    docs = id_and_text(docs)
    index = Index(templates, word_counts(docs, vocabulary), threshold)
    wanted = [(words_of(p.encode()), label) for p, label in phrases]
    heads = [(frozenset(p), p, label) for p, label in wanted]
    kind = docs.schema["doc_id"].dataType.simpleString()
    places_t = pa.list_(pa.struct([("start", pa.int64()), ("label", pa.string())]))
    blocks_t = pa.list_(pa.struct([("start", pa.int64()), ("words", pa.int64()), ("label", pa.string()), ("containment", pa.float64())]))

    def one(text: bytes) -> tuple[int, list, list]:
        words = words_of(text)
        held = set(words)
        places = _places(words, [(p, label) for need, p, label in heads if need <= held])
        hits = []
        if not held.isdisjoint(index.keys):
            hits = [{"start": s, "words": n, "label": index.labels[t], "containment": c} for s, n, t, c in index.blocks(words)]
        return len(words), [{"start": s, "label": label} for s, label in sorted(places)], hits

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in chunks(whole):
                got = [one(t) for t in b.column(1).cast(pa.binary()).to_pylist()]
                yield pa.record_batch([b.column(0), pa.array([g[0] for g in got], pa.int64()),
                                       pa.array([g[1] for g in got], places_t), pa.array([g[2] for g in got], blocks_t)],
                                      names=["doc_id", "n_words", "places", "blocks"])
    return docs.mapInArrow(tidy(run), f"doc_id {kind}, n_words long, places array<struct<start:long,label:string>>, "
                                "blocks array<struct<start:long,words:long,label:string,containment:double>>")


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: base places, labels of both kinds and score of every document."""
    joined = lambda c: F.array_join(F.array_sort(F.array_distinct(c)), ",")
    base = F.col("places.label")
    return scan_licenses(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", F.size("places").cast("long").alias("n_base"),
        F.array_min("places.start").alias("first_word"), F.array_max("places.start").alias("last_word"),
        joined(base).alias("base_labels"), joined(F.concat(base, F.col("blocks.label"))).alias("labels"),
        F.when(F.size("places") > 0, 1.0).otherwise(F.coalesce(F.array_max("blocks.containment"), F.lit(0.0)))
        .alias("score"))
