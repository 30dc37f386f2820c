"""License notices by a positional index of rare words.

A template is the word sequence of a notice. Its words are weighed by their rarity over
all documents (1 + floor(1000 ln((N + 1) / (df + 1)))). A place is an offset at which the
template's words stand in the text, each at most ``slack`` words from where the offset
puts it; its support is the weight of the words that do, and it counts if that is at least
``percent`` of the template's weight and every key phrase stands there consecutively.

The index holds, for each template, the positions of its rarest words, as few as make up
more than the weight that a place may lack: any place has one of them. The rare words that
a text holds are looked up there, each gives offsets, and at these the other words are
intersected by relative position, rarest first, until an offset can no longer reach its
share. What is left is tested for the key phrases. Two passes over the texts: document
counts of the templates' words (added up by Spark), then the search; nothing but counters
of template words is shuffled or collected, and the index is as large as the templates.

Of places of one template closer than its length, the best supported stays, of equal ones
that with the most weight right where the offset puts it, then the first; of a template
without slack (a phrase) all places stay.

Defined results: A-Z in lower case; words are runs of digits, letters a-z and anything
beyond ASCII; a null text is empty; a text without words has no place; rows that repeat an
id, or have none, are searched each; further columns are ignored; an empty table gives an
empty result; one text must fit a task's memory.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from dataclasses import dataclass
from math import floor, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
ROWS = 500  # texts of an output batch
FOUND = "doc_id long, n_words long, places array<struct<template:int,start:long,score:double>>"


def words_of(text: str | None) -> list[bytes]:
    return WORD.findall((text or "").encode().lower())


@dataclass(frozen=True)
class Template:
    """A notice; ``keys`` are phrases that must stand in it word by word."""

    label: str
    text: str
    keys: tuple[str, ...] = ()
    percent: int = 80
    slack: int = 3

    @property
    def words(self) -> list[bytes]:
        return words_of(self.text)

    @property
    def key_words(self) -> list[list[bytes]]:
        return [words_of(key) for key in self.keys]


def phrase(label: str, text: str) -> Template:
    """A template all of whose words must stand consecutively."""
    return Template(label, text, percent=100, slack=0)


# Phrases that are reported wherever they stand.
PHRASES = (
    phrase("mit", "under the mit license"),
    phrase("apache-2", "apache license version 2"),
    phrase("cc-by-nc", "cc by nc"),
)

# The customary notices of public licenses, and what must be verbatim in them.
NOTICES = (
    Template(
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and"
        " associated documentation files (the Software), to deal in the Software without restriction, including"
        " without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell"
        " copies of the Software, and to permit persons to whom the Software is furnished to do so",
        ("permission is hereby granted free of charge", "without restriction"),
    ),
    Template(
        "apache-2",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in"
        " compliance with the License. You may obtain a copy of the License at",
        ("apache license version 2",),
    ),
    Template(
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided"
        " that the following conditions are met",
        ("redistribution and use in source and binary forms",),
    ),
    Template(
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is"
        " hereby granted, provided that the above copyright notice and this permission notice appear in all copies",
        ("with or without fee is hereby granted",),
    ),
    Template(
        "gpl-2",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU"
        " General Public License as published by the Free Software Foundation; either version 2 of the License",
        ("gnu general public license", "version 2"),
    ),
    Template(
        "gpl-3",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU"
        " General Public License as published by the Free Software Foundation, either version 3 of the License",
        ("gnu general public license", "version 3"),
    ),
    Template(
        "gpl-3",
        "This work is licensed under the GNU General Public License, version 3",
        ("gnu general public license", "version 3"),
    ),
    Template(
        "lgpl",
        "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
        ("gnu lesser general public license",),
    ),
    Template(
        "mpl-2",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
        ("mozilla public license",),
    ),
    Template(
        "cc-by",
        "This work is licensed under a Creative Commons Attribution 4.0 International License",
        ("creative commons attribution 4",),
    ),
    Template(
        "cc-by-nc",
        "This work is licensed under a Creative Commons Attribution NonCommercial 4.0 International License",
        ("creative commons attribution noncommercial",),
    ),
    Template("cc-by-nc", "Licensed under CC BY-NC 4.0", ("cc by nc",)),
    Template(
        "cc-by-sa",
        "This work is licensed under a Creative Commons Attribution ShareAlike 4.0 International License",
        ("creative commons attribution sharealike",),
    ),
    Template(
        "unlicense",
        "This is free and unencumbered software released into the public domain",
        ("free and unencumbered software",),
    ),
    Template("all-rights-reserved", "All rights reserved", ("all rights reserved",)),
)
TEMPLATES = PHRASES + NOTICES


def vocabulary(templates) -> dict[bytes, int]:
    """A number for every word of the templates and their keys."""
    words = {w for t in templates for part in (t.words, *t.key_words) for w in part}
    return {word: i for i, word in enumerate(sorted(words))}


def weight(documents: int, frequency: int) -> int:
    return 1 + floor(1000 * log((documents + 1) / (frequency + 1)))


def word_weights(docs: DataFrame, templates=TEMPLATES) -> list[int]:
    """Weight of every word of the templates, by its document frequency in ``docs``."""
    known = vocabulary(templates)
    schema = pa.schema([("word", pa.int32()), ("df", pa.int64())])

    def run(batches):
        for batch in batches:
            held: Counter[int] = Counter()
            for text in batch.column("text"):
                held.update(known[w] for w in known.keys() & set(words_of(text.as_py())))
            held[-1] = batch.num_rows
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*held.items()), schema.types)], schema=schema)

    sums = docs.select("text").mapInArrow(run, "word int, df long").groupBy("word").agg(F.sum("df").alias("df"))
    counted = {row.word: row.df for row in sums.collect()}  # a row for a word of the templates at most
    return [weight(counted.get(-1, 0), counted.get(i, 0)) for i in range(len(known))]


class Positions:
    """The positions of one template's words, rarest first."""

    def __init__(self, template: Template, known: dict[bytes, int], weights: list[int]):
        self.slack, self.size = template.slack, len(template.words)
        words = [known[w] for w in template.words]
        order = sorted(range(self.size), key=lambda p: (-weights[words[p]], p))
        self.places = [(p, words[p], weights[words[p]]) for p in order]
        self.total = sum(w for _, _, w in self.places)
        self.need = -(-template.percent * self.total // 100)
        self.keys = [np.array([known[w] for w in key]) for key in template.key_words]
        # without any of the anchors, a place cannot reach what it needs
        rest, self.anchors = self.total, []
        for p, word, w in self.places:
            if rest < self.need:
                break
            self.anchors.append((p, word))
            rest -= w

    def supported(self, ids: np.ndarray, pad: int, hits: dict[int, np.ndarray]) -> list[np.ndarray]:
        """Offset, support and support without slack of the places in a text; ``ids`` has
        ``pad`` fillers on both sides, ``hits`` where the rare words stand."""
        near = np.arange(-self.slack, self.slack + 1)
        starts = [hits[word] - p for p, word in self.anchors if word in hits]
        if not starts:
            return [np.empty(0, np.int64)] * 3
        at = np.unique((np.unique(np.concatenate(starts))[:, None] + near).ravel())
        support, rest = np.zeros(len(at), np.int64), self.total
        for p, word, w in self.places:
            there = np.zeros(len(at), bool)
            for d in near:
                there |= ids[at + (p + d + pad)] == word
            support[there] += w
            rest -= w
            alive = support + rest >= self.need
            at, support = at[alive], support[alive]
        for key in self.keys:
            n = len(ids) - len(key) + 1
            whole = np.ones(n, bool)
            for k, word in enumerate(key):
                whole &= ids[k : k + n] == word
            before = np.r_[0, np.cumsum(whole)]
            first = at + (pad - self.slack)
            last = at + (pad + self.size - len(key) + self.slack)
            there = before[np.minimum(last + 1, n)] > before[first]
            at, support = at[there], support[there]
        exact = np.zeros(len(at), np.int64)
        for p, word, w in self.places:
            exact[ids[at + (p + pad)] == word] += w
        return [at, support, exact]


class PositionIndex:
    """All templates, and the postings of their rare words."""

    def __init__(self, templates, weights: list[int]):
        self.known = vocabulary(templates)
        self.templates = [Positions(t, self.known, weights) for t in templates]
        self.postings: dict[int, list[int]] = {}
        for number, template in enumerate(self.templates):
            for _, word in template.anchors:
                self.postings.setdefault(word, []).append(number)
        self.pad = max(t.size + t.slack for t in self.templates) + max(t.slack for t in self.templates)

    def places(self, words: list[bytes]) -> list[tuple[int, int, float]]:
        """(template, start, score) in a text, by template and start."""
        number = self.known.get
        ids = np.fromiter((number(w, -1) for w in words), np.int64, len(words))
        held = [word for word in np.unique(ids).tolist() if word in self.postings]
        if not held:
            return []
        hits = {word: np.flatnonzero(ids == word) for word in held}
        padded = np.pad(ids, self.pad, constant_values=-1)
        out = []
        for number in sorted({t for word in held for t in self.postings[word]}):
            template = self.templates[number]
            places = list(zip(*(column.tolist() for column in template.supported(padded, self.pad, hits))))
            if template.slack:
                places = best_apart(places, template.size)
            out += [(number, max(start, 0), n / template.total) for start, n, _ in places]
        return out


def best_apart(places: list[tuple[int, int, int]], apart: int) -> list[tuple[int, int, int]]:
    """The best supported of (offset, support, exact support), ``apart`` from each other."""
    kept: list[tuple[int, int, int]] = []
    for place in sorted(places, key=lambda p: (-p[1], -p[2], p[0])):
        i = bisect_left(kept, place)
        if all(abs(other[0] - place[0]) >= apart for other in kept[max(0, i - 1) : i + 1]):
            kept.insert(i, place)
    return kept


def find(docs: DataFrame, templates=TEMPLATES) -> DataFrame:
    """(doc_id, n_words, places) of every row of ``docs`` (doc_id, text); a place has the
    number of its template, the word where it starts and its share of the weight."""
    index = PositionIndex(templates, word_weights(docs, templates))
    place = pa.struct([("template", pa.int32()), ("start", pa.int64()), ("score", pa.float64())])
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("places", pa.list_(place))])

    def run(batches):
        for whole in batches:
            for first in range(0, whole.num_rows, ROWS):
                batch = whole.slice(first, ROWS)
                numbers, found = [], []
                for text in batch.column("text"):
                    words = words_of(text.as_py())
                    numbers.append(len(words))
                    places = index.places(words)
                    found.append([{"template": t, "start": s, "score": score} for t, s, score in places])
                columns = [batch.column("doc_id"), pa.array(numbers, pa.int64()), pa.array(found, schema.types[2])]
                yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, FOUND)
