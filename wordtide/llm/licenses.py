"""Licence statements in documents: MinHash bands over overlapping windows find templates,
exact containment of shingles verifies them.

Words are digits, letters and everything beyond ASCII, A to Z lowered; a shingle is five
consecutive words. A template of m shingles is looked for in windows of 2c shingles that begin at
every c-th one, c being the power of two from m up, so wherever it stands some window holds it
whole. Of a template with at least `least` of its shingles in the window, the Jaccard similarity
to the window is then above `least * m / (2c + (1 - least) * m)`; with bands of one row, `b`
bands miss it with a probability of (1 - J)^b, and `b` is chosen for at most `MISS`.

Equal minima mean a shared shingle, so windows without any shingle of a template need no
signature: they are passed over after one look at a table per shingle.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from wordtide.llm import words as W

SHINGLE = 5
LEAST = 0.8
MISS = 1e-6

#: Fixed: statements by licence.
TEMPLATES = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0",
        "you may not use this file except in compliance with the License. You may obtain a copy of the License at",
    ),
    "MIT": (
        "Released under the MIT License",
        "Licensed under the MIT License",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files, to deal in the Software without restriction",
    ),
    "GPL-3.0": (
        "licensed under the GNU General Public License, version 3",
        "it under the terms of the GNU General Public License as published by the Free Software Foundation, "
        "either version 3 of the License, or (at your option) any later version",
    ),
    "BSD-3-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted "
        "provided that the following conditions are met",
    ),
    "MPL-2.0": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",),
    "CC-BY-4.0": ("Licensed under CC BY 4.0", "licensed under a Creative Commons Attribution 4.0 International License"),
    "CC-BY-SA-4.0": ("Licensed under CC BY-SA 4.0",),
    "CC-BY-NC-4.0": ("Licensed under CC BY-NC 4.0",),
}


def bands_needed(size: int, span: int, least: float, miss: float) -> int:
    """Bands of one row that miss a template of `size` shingles in a window of `2 * span` with `miss`."""
    similarity = least * size / (2 * span + (1 - least) * size)
    return math.ceil(math.log(miss) / math.log1p(-similarity))


@dataclass(frozen=True)
class _Template:
    license: str
    shingles: frozenset[bytes]
    hashes: np.ndarray
    span: int
    bands: int


class Catalogue:
    """Templates ready to be looked for; small, and shipped with the task."""

    def __init__(self, templates: Mapping[str, tuple[str, ...]], least: float = LEAST, miss: float = MISS):
        self.least, self.templates = least, []
        for license_, texts in templates.items():
            for text in texts:
                words = W.split(pa.array([text]), W.PLAIN)
                if len(words.hashes) < SHINGLE:
                    raise ValueError(f"a template of fewer than {SHINGLE} words: {text!r}")
                hashes = np.unique(W.runs(words, SHINGLE)[2])
                span = 1 << (len(words.hashes) - SHINGLE).bit_length()
                plain = _words(words, 0, len(words.hashes))
                self.templates.append(_Template(
                    license_, frozenset(_shingles(plain)), hashes, span, bands_needed(len(hashes), span, least, miss)
                ))
        self.known = np.unique(np.concatenate([t.hashes for t in self.templates] or [np.zeros(0, np.uint64)]))
        self.table = np.zeros(1 << 16, bool)
        self.table[(self.known & np.uint64(0xFFFF)).astype(np.int64)] = True
        self.spans = sorted({t.span for t in self.templates})

    def hits(self, hashes: np.ndarray) -> np.ndarray:
        """Places of shingles that some template has."""
        near = np.flatnonzero(self.table[(hashes & np.uint64(0xFFFF)).astype(np.int64)])
        return near[np.isin(hashes[near], self.known)]

    def find(self, texts: pa.Array) -> list[tuple[int, str, float, int, int]]:
        """Text, licence, containment and word range of each match, the best of a licence and text."""
        words = W.split(texts, W.PLAIN)
        text, first, hashes = W.runs(words, SHINGLE)
        counts = np.maximum(words.counts - SHINGLE + 1, 0)
        begin = np.cumsum(counts) - counts
        hit = self.hits(hashes)
        best: dict[tuple[int, str], tuple[float, int, int]] = {}
        for span in self.spans if len(hit) else []:
            place = (hit - begin[text[hit]]) // span
            window = np.concatenate([place, place - 1])
            owner = np.concatenate([text[hit]] * 2)[window >= 0]
            owner, window = np.unique(np.stack([owner, window[window >= 0]]), axis=1)
            low = window * span
            n = np.minimum(low + 2 * span, counts[owner]) - low
            starts = np.cumsum(n) - n
            index = np.arange(int(n.sum())) + np.repeat(begin[owner] + low - starts, n)
            for template, rows in self._collisions(hashes[index], starts, span):
                for row in rows:
                    i, a = int(owner[row]), int(low[row])
                    at = words.offsets[i] + a
                    inside = _shingles(_words(words, at, at + int(n[row]) + SHINGLE - 1))
                    share = len(template.shingles & set(inside)) / len(template.shingles)
                    if share < self.least - 1e-12:
                        continue
                    held = [k for k, s in enumerate(inside) if s in template.shingles]
                    found = (share, -(a + held[0]), a + held[-1] + SHINGLE)
                    key = i, template.license
                    best[key] = max(best.get(key, found), found)
        return [(i, name, share, -a, b) for (i, name), (share, a, b) in sorted(best.items())]

    def _collisions(self, hashes: np.ndarray, starts: np.ndarray, span: int):
        """Templates of this span, each with the windows that share a band with it."""
        these = [t for t in self.templates if t.span == span]
        found = [np.zeros(len(starts), bool) for _ in these]
        for band in range(max(t.bands for t in these)):
            salt = W.mix(np.array([band + 1], np.uint64))
            least = np.minimum.reduceat(W.mix(hashes ^ salt), starts)
            for met, t in zip(found, these, strict=True):
                if band < t.bands:
                    met |= least == W.mix(t.hashes ^ salt).min()
        return [(t, np.flatnonzero(met)) for t, met in zip(these, found, strict=True)]


def _words(words: W.Words, first: int, last: int) -> list[bytes]:
    data, starts, ends = words.data, words.starts, words.ends
    return [data[starts[i] : ends[i]].tobytes().lower() for i in range(first, last)]


def _shingles(words: list[bytes]) -> list[bytes]:
    return [b" ".join(words[i : i + SHINGLE]) for i in range(len(words) - SHINGLE + 1)]


def license_matches(
    docs: DataFrame, templates: Mapping[str, tuple[str, ...]] = TEMPLATES, least: float = LEAST, miss: float = MISS
) -> DataFrame:
    """`docs` with `matches`, which replaces a column of that name: structs of `license`,
    `containment`, `first_word`, `end_word`, the best match of each licence, by name.

    Containment is the share of a template's distinct shingles that one window holds. Null
    and empty texts, and those of fewer than five words, have no matches. Templates are a
    parameter, a short list, of five words or more each.
    """
    catalogue = Catalogue(templates, least, miss)
    own = [c for c in docs.columns if c != "matches"]
    named = docs.select(F.struct(*[F.col(f"`{c}`") for c in own]).alias("row"), "text")
    match = pa.struct([("license", pa.string()), ("containment", pa.float64()), ("first_word", pa.int64()), ("end_word", pa.int64())])
    schema = "row " + named.schema["row"].dataType.simpleString()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in W.portions(batches):
            lists: list[list[dict]] = [[] for _ in range(batch.num_rows)]
            for i, name, share, a, b in catalogue.find(batch.column("text")):
                lists[i].append({"license": name, "containment": share, "first_word": a, "end_word": b})
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(lists, pa.list_(match))], ["row", "matches"])

    found = named.mapInArrow(
        scan, f"{schema}, matches ARRAY<STRUCT<license STRING, containment DOUBLE, first_word BIGINT, end_word BIGINT>>"
    )
    return found.select("row.*", "matches")
