"""License scan: MinHash bands over text windows retrieve templates, containment verifies them.

Words are taken without closing punctuation and with A-Z lower-cased; shingles
are five words. Templates fall into length classes of ratio ``RATIO``. For a
class of ``w`` shingles, windows of ``w + stride - 1`` shingles start at every
``stride``-th one, so one of them holds any whole occurrence. A template of which
``CONTAINMENT`` stands in that window has a Jaccard coefficient of 0.41 or more
with it, and with ``BANDS`` bands of ``ROWS`` minima such a pair shares a band
with probability ``collision(0.41)`` > 0.999. Equal minima mean a shared shingle
(the hashes are bijections), so windows without any template shingle are passed
over without changing a result. Found pairs are checked exactly: distinct
template shingles in the window, over those of the template.

Null, empty and short texts have no hits. Rows are scanned one by one, so
repeated rows repeat their hits. Templates are a parameter and go to all tasks.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from lowtide.llm.arrays import U64, Block, blocks, mix, runs

SHINGLE = 5
CONTAINMENT = 75
RATIO = 1.25
ROWS = 2
BANDS = 48

# fixed values: public license statements and notices
TEMPLATES = {
    "mit-line": "Released under the MIT License.",
    "apache-2.0-line": "Licensed under the Apache License, Version 2.0.",
    "gpl-3.0-line": "This work is licensed under the GNU General Public License, version 3.",
    "cc-by-nc-4.0-line": "Licensed under CC BY-NC 4.0.",
    "mit": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
           "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the "
           "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
           "persons to whom the Software is furnished to do so, subject to the following conditions:",
    "isc": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
           "provided that the above copyright notice and this permission notice appear in all copies.",
    "apache-2.0": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
                  "with the License. You may obtain a copy of the License at",
    "gpl-3.0": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
               "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later "
               "version.",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
           "following conditions are met: Redistributions of source code must retain the above copyright notice, this list of "
           "conditions and the following disclaimer.",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
               "distributed with this file, You can obtain one at",
}


def collision(jaccard: float) -> float:
    """Probability that a pair shares a band."""
    return 1 - (1 - jaccard**ROWS) ** BANDS


def _minima(tokens: np.ndarray) -> np.ndarray:
    """ROWS * BANDS minima over the last axis; the largest value stands for no shingle."""
    none = tokens == U64(2**64 - 1)
    out = []
    for k in range(ROWS * BANDS):
        hashed = mix(tokens ^ U64((k + 1) * 0x9E3779B97F4A7C15 & (2**64 - 1)))
        hashed[none] = U64(2**64 - 1)
        out.append(hashed.min(-1))
    return np.stack(out, -1)


def _shingles(block: Block) -> tuple[np.ndarray, np.ndarray]:
    return runs(*block.bare_words, SHINGLE)


def length_class(n: int) -> int:
    """Least class length, a rounded power of RATIO, that holds ``n`` shingles."""
    length = 1
    while length < n:
        length = max(length + 1, int(length * RATIO))
    return length


class Library:
    """Template shingle sets and their minima by length class."""

    def __init__(self, templates: dict[str, str]):
        self.names, self.sets, self.classes = list(templates), [], {}
        for i, text in enumerate(templates.values()):
            if len(text.split()) < SHINGLE:
                raise ValueError(f"template {self.names[i]} has fewer than {SHINGLE} words")
            found = _shingles(next(blocks(pa.array([text]))))[0]
            self.sets.append(np.unique(found))
            self.classes.setdefault(length_class(len(found)), []).append(i)
        self.minima = {w: np.stack([_minima(self.sets[i]) for i in members]) for w, members in self.classes.items()}
        self.any = np.unique(np.concatenate(self.sets))


def hits(block: Block, library: Library) -> list[tuple[int, int, int, int, int]]:
    """(text, template, first word, end word, shingles matched) of every hit; overlapping ones of a template are one, the fullest."""
    tokens, owner = _shingles(block)
    if not len(tokens):
        return []
    at = np.searchsorted(library.any, tokens)
    marked = np.flatnonzero(library.any[np.minimum(at, len(library.any) - 1)] == tokens)
    if not len(marked):
        return []
    begins = np.searchsorted(owner, np.arange(block.n + 1))
    found: dict[tuple[int, int], list[tuple[int, int, int]]] = {}
    for width, members in library.classes.items():
        stride = max(1, width // 4)
        length = width + stride - 1
        place = marked - begins[owner[marked]]
        last = place // stride
        first = np.maximum(0, (place - length) // stride + 1)
        window = np.unique(np.concatenate([
            (owner[marked] * len(tokens) + first + k)[first + k <= last] for k in range(int((last - first).max()) + 1)]))
        text, number = window // len(tokens), window % len(tokens)
        for low in range(0, len(window), 4096):
            own, start = text[low: low + 4096], begins[text[low: low + 4096]] + number[low: low + 4096] * stride
            index = start[:, None] + np.arange(length)
            inside = index < begins[own + 1][:, None]
            rows = np.where(inside, tokens[np.minimum(index, len(tokens) - 1)], U64(2**64 - 1))
            same = _minima(rows)[:, None, :] == library.minima[width][None]
            retrieved = same.reshape(len(rows), len(members), BANDS, ROWS).all(-1).any(-1)
            for w, m in zip(*np.nonzero(retrieved)):
                template = library.sets[members[m]]
                match = np.isin(rows[w], template)
                both = len(np.unique(rows[w][match]))
                if 100 * both >= CONTAINMENT * len(template):
                    places = np.flatnonzero(match) + start[w] - begins[own[w]]
                    found.setdefault((int(own[w]), members[m]), []).append((int(places[0]), int(places[-1]) + SHINGLE, both))
    out = []
    for (own, template), spans in found.items():
        group: list[tuple[int, int, int]] = []
        for span in sorted(set(spans)):
            if group and span[0] < group[-1][1]:
                group[-1] = max(group[-1], span, key=lambda s: (s[2], -s[0], -s[1]))
            else:
                group.append(span)
        out += [(own, template, *span) for span in group]
    return sorted(out)


def scan(docs: DataFrame, templates: dict[str, str] | None = None) -> DataFrame:
    """``doc_id, template, first_word, end_word, matched, containment`` of every hit; words count from 0, end exclusive."""
    given = templates or TEMPLATES

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        library = Library(given)
        for batch in batches:
            for block in blocks(batch.column(1)):
                rows = hits(block, library)
                columns = list(zip(*rows)) if rows else [()] * 5
                ids = batch.column(0).slice(block.first, block.n).take(pa.array(columns[0], pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array([library.names[t] for t in columns[1]], pa.string()), *(pa.array(c, pa.int64()) for c in columns[2:]),
                     pa.array([m / len(library.sets[t]) for t, m in zip(columns[1], columns[4])], pa.float64())],
                    ["doc_id", "template", "first_word", "end_word", "matched", "containment"])

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, template string, first_word long, end_word long, matched long, containment double")
