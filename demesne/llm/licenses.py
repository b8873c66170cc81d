"""License scans by MinHash bands over overlapping text windows (operator 6).

Templates are notices of public licenses. Templates and texts are five-word shingles of words in
lower case. Templates are classed by their number of shingles (at most c = 1, 4, 16, 64, ... of them). For each
class a text is cut into blocks of c / 2 shingles (1 at least), and a window is three blocks (two, where a
block is one shingle), each starting a block after the last; a template that stands anywhere is whole inside a window.
A window has a MinHash value for each of K functions, a band is one value, and a window retrieves
the templates that share a band with it. A window that has `least` of a template's shingles has at
least the similarity s = least * (c / 4) / (3 c / 2) with it, and misses all K bands with
probability (1 - s)^K; K is the least that keeps this below `MISS`. Retrieved templates are verified
by the exact share of their shingles in the window, so there are no false matches.

Defined results: null, empty and very short texts match nothing; equal templates under different
names each match; a repeated key has rows for each of its rows; an empty table, or no template, gives
no rows; other columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demesne.llm.common import lower, mix, per_piece, raw, span_hashes, words

SHINGLE, LEAST, MISS = 5, 0.8, 1e-3

# Notices by which public licenses are granted.
TEMPLATES = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    ],
    "MIT": [
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ],
    "GPL-2.0": [
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    ],
    "LGPL-2.1": [
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    ],
    "BSD": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    ],
    "ISC": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ],
    "Unlicense": ["This is free and unencumbered software released into the public domain."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0."],
    "CC-BY-4.0": ["This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-SA-4.0": ["This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
}

_BREAK = np.ones(256, bool)
_BREAK[48:58] = _BREAK[65:91] = _BREAK[97:123] = _BREAK[128:] = False
_FILTER_BITS = 16


def positions(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The shingle at each word position that has one, and the first position of each text."""
    data, offsets = raw(col)
    starts, ends, first = words(data, offsets, _BREAK)
    h = span_hashes(lower(data), starts, ends)
    m = max(len(h) - SHINGLE + 1, 0)
    whole = np.zeros(m, np.uint64)
    for k in range(SHINGLE):
        whole = mix(whole + h[k : k + m] * np.uint64(2 * k + 0x9FB21C651E98DF25))
    count = np.maximum(np.diff(first) - SHINGLE + 1, 0)
    at = np.repeat(first[:-1] - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(count.sum())
    return whole[at], np.concatenate([[0], np.cumsum(count)])


def functions_needed(size: int, least: float = LEAST, miss: float = MISS) -> int:
    """MinHash functions for templates of more than size / 4 shingles, so that a match escapes with probability `miss` at most."""
    window = 2 if size < 4 else 3 * size / 2
    similarity = least * max(1, size // 4 + 1 if size > 1 else 1) / window
    return max(1, math.ceil(math.log(miss) / math.log(1 - min(similarity, 1 - 1e-9))))


class Templates:
    """Band tables of the templates, by class of size."""

    def __init__(self, templates: dict[str, list[str]], least: float = LEAST):
        self.least = least
        flat = [(name, text) for name, texts in templates.items() for text in texts]
        found, first = positions(pa.array([t for _, t in flat], pa.large_string()))
        self.names = [n for n, _ in flat]
        self.sets = [np.unique(found[a:b]) for a, b in zip(first[:-1], first[1:], strict=True)]
        self.classes = {}
        top = max((len(s) for s in self.sets), default=0)
        size, below = 1, 0
        while below < top:
            own = [i for i, s in enumerate(self.sets) if below < len(s) <= size]
            if own:
                seeds = np.random.default_rng(size).integers(1, 2**63, (functions_needed(size, least), 2), dtype=np.uint64) | np.uint64(1)
                values = [(int((self.sets[i] * a + b).min()), k, i) for k, (a, b) in enumerate(seeds) for i in own]
                bits = np.zeros((len(seeds), 1 << _FILTER_BITS), bool)
                table: dict[tuple[int, int], list[int]] = {}
                for v, k, i in values:
                    bits[k, v >> (64 - _FILTER_BITS)] = True
                    table.setdefault((k, v), []).append(i)
                self.classes[size] = (seeds, bits, table)
            below, size = size, size * 4

    def scan(self, col: pa.Array) -> list[tuple[int, int, float, int]]:
        """(text, template, containment, first shingle) of every window that has `least` of a template, best window only."""
        grams, first = positions(col)
        best: dict[tuple[int, int], tuple[float, int]] = {}
        if not len(grams):
            return []
        for size, (seeds, bits, table) in self.classes.items():
            step = max(1, size // 2)
            reach = 2 if step == 1 else 3
            count = -(-np.diff(first) // step)
            base = np.concatenate([[0], np.cumsum(count)])
            text = np.repeat(np.arange(len(count)), count)
            begin = first[text] + (np.arange(base[-1]) - base[text]) * step
            pairs = set()
            for k, (a, b) in enumerate(seeds):
                low = np.minimum.reduceat(grams * a + b, begin)
                wide = low.copy()
                for back in range(1, reach):  # a window is a block and those after it in the same text
                    same = text[back:] == text[:-back]
                    wide[:-back] = np.where(same, np.minimum(wide[:-back], low[back:]), wide[:-back])
                for w in np.flatnonzero(bits[k][wide >> np.uint64(64 - _FILTER_BITS)]).tolist():
                    for i in table.get((k, int(wide[w])), ()):
                        pairs.add((w, i))
            for w, i in pairs:
                a = int(begin[w])
                part = grams[a : min(a + reach * step, int(first[text[w] + 1]))]
                share = float(np.isin(self.sets[i], part).mean())
                if share >= self.least:
                    key = (int(text[w]), i)
                    where = int(np.flatnonzero(np.isin(part, self.sets[i]))[0]) + a - int(first[text[w]])
                    best[key] = max(best.get(key, (0.0, 0)), (share, -where))
        return [(t, i, share, -where) for (t, i), (share, where) in sorted(best.items())]


SCHEMA = "doc_id bigint, license string, template int, containment double, first_word bigint"


def license_notices(docs: DataFrame, templates: dict[str, list[str]] | None = None, least: float = LEAST) -> DataFrame:
    """One row for each document and template found: its license, number, best containment and first word."""
    index = Templates(TEMPLATES if templates is None else templates, least)

    def run(part, col):
        rows = index.scan(col)
        ids = part.column(0)
        cols = [[ids[t].as_py() for t, *_ in rows], [index.names[i] for _, i, *_ in rows], *[[r[k] for r in rows] for k in (1, 2, 3)]]
        kinds = [pa.int64(), pa.string(), pa.int32(), pa.float64(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], ["doc_id", "license", "template", "containment", "first_word"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(per_piece(run), SCHEMA)
