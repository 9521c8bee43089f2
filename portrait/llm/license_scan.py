"""License scans: MinHash bands retrieve templates, exact containment verifies.

Texts and templates are normalised to lower-case (A-Z) words of digits, letters
and non-ASCII characters; shingles are five words, or the whole template if it
has fewer.  For templates of L shingles a text is covered by windows of 2 L
shingles that start every L, so that each run of L shingles lies in one window.
A window matches a template when it holds 80 % of the template's shingles.

The template table holds whole licence texts (``licenses/``) and notices.  One word
tells a short notice's licence or version from another ("Version 1.1", "BSD
License"), so these have eight words or fewer, of which 80 % of the shingles
are all, and are listed in their usual wordings.  A name may have
several templates.  Texts that share 80 % of their shingles (GFDL 1.2 and 1.3)
are all reported; ``shared`` and ``total`` tell them apart.

Texts that hold fewer of a template's shingles than it needs are left out first
(a table lookup of each shingle, which loses no match), so that the work grows
with the texts, not with the table.

Candidates come from MinHash bands.  A window that matches has a Jaccard
similarity of at least ceil(0.8 L) / (2 L + L - ceil(0.8 L)); the number of
bands (of one row) is chosen so that such a window misses all of them with a
probability below ``MISS``.  A band is a hash function; a window's value is the
least one over its shingles, from minima of half windows.  Every candidate is
verified by counting the template's shingles in the window.

Defined cases: null and empty texts match nothing and keep their row; ties
between windows go to the first; templates without words are ignored; repeated
rows give repeated results; other columns are not read.  Templates are a
bounded list that travels with the tasks.
"""

from __future__ import annotations

import math
import pkgutil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from portrait.llm import bytesops as B

WORDS = 5
NEED = 80                      # percent of a template's shingles
MISS = 1e-6

_MIT_GRANT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
    "files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, "
    "copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom "
    "the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission "
    "notice shall be included in all copies or substantial portions of the Software.")
_AS_IS = (
    "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE "
    "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.")
_MIT_LIABILITY = (
    "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN "
    "ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER "
    "DEALINGS IN THE SOFTWARE.")
_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
    "conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and "
    "the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of "
    "conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. THIS "
    "SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, "
    "BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. ")

# License notices (fixed values), as (name, text).
NOTICES = [
    ("apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("apache-2.0-header", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file "
     "except in compliance with the License. You may obtain a copy of the License at "
     "http://www.apache.org/licenses/LICENSE-2.0"),
    ("mit", "Released under the MIT License."),
    ("mit-grant", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
     "associated documentation files (the \"Software\"), to deal in the Software without restriction"),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0."),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
     "that the following conditions are met"),
    ("all-rights-reserved", "All rights reserved."),
    ("apache-2.0", "Licensed under the Apache License 2.0"),
    ("apache-2.0", "Licensed under Apache-2.0"),
    ("mit", "Released under an MIT License"),
    ("mit", "Licensed under the MIT License"),
    ("mit", "Distributed under the MIT License"),
    ("mit-text", f"{_MIT_GRANT} {_AS_IS} {_MIT_LIABILITY}"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
     "granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("bsd-2-clause", _BSD + "IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, "
     "INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES"),
    ("unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, "
     "publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any "
     "purpose, commercial or non-commercial, and by any means."),
    ("zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held "
     "liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for "
     "any purpose, including commercial applications, and to alter it and redistribute it freely"),
    ("mpl-2.0-header", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the "
     "MPL was not distributed with this file, You can obtain one at"),
    ("mpl-1.1", "Mozilla Public License Version 1.1"),
    ("epl-1.0", "terms of the Eclipse Public License v1.0"),
    ("epl-2.0", "terms of the Eclipse Public License 2.0"),
    ("epl-2.0", "terms of the Eclipse Public License v2.0"),
    *[(f"{short}-header", f"under the terms of the GNU {kind} as published by the Free Software Foundation; either version "
       f"{version} of the License") for short, kind, version in [
        ("gpl-2.0", "General Public License", "2"), ("gpl-3.0", "General Public License", "3"),
        ("lgpl-2.0", "Library General Public License", "2"), ("lgpl-2.1", "Lesser General Public License", "2.1"),
        ("lgpl-3.0", "Lesser General Public License", "3"), ("agpl-3.0", "Affero General Public License", "3")]],
    *[(short, f"{kind} {word}{number}") for short, kind, number in [
        ("gpl-2.0", "GNU General Public License", "2"), ("gpl-3.0", "GNU General Public License", "3"),
        ("lgpl-2.1", "GNU Lesser General Public License", "2.1"), ("lgpl-3.0", "GNU Lesser General Public License", "3"),
        ("agpl-3.0", "GNU Affero General Public License", "3"), ("mpl-2.0", "Mozilla Public License", "2.0")]
      for word in ("version ", "v")],
    *[(f"cc-{short}-{version}", text) for short, kind in [
        ("by", "Attribution"), ("by-sa", "Attribution-ShareAlike"), ("by-nd", "Attribution-NoDerivatives"),
        ("by-nc", "Attribution-NonCommercial"), ("by-nc-sa", "Attribution-NonCommercial-ShareAlike"),
        ("by-nc-nd", "Attribution-NonCommercial-NoDerivatives")] for version in ("3.0", "4.0")
      for text in (f"Licensed under CC {short.upper()} {version}", f"Creative Commons {kind} {version}")],
]

# Whole licence texts, files of ``licenses/`` (Debian's common-licenses).
TEXTS = ["Apache-2.0", "Artistic", "BSD", "CC0-1.0", "GFDL-1.2", "GFDL-1.3", "GPL-1", "GPL-2", "GPL-3", "LGPL-2", "LGPL-2.1",
         "LGPL-3", "MPL-1.1", "MPL-2.0"]

TEMPLATES = NOTICES + [(f"{name.lower()}-text", pkgutil.get_data(__package__, f"licenses/{name}.txt").decode()) for name in TEXTS]

MATCHES = "doc_id long, n_templates long, templates string, matches array<struct<template: string, window: long, shared: long, total: long>>"


class Class:
    """Templates with equal shingle width and count, and their band values."""

    def __init__(self, width: int, size: int, templates: list[tuple[str, np.ndarray]]):
        self.width, self.size, self.templates = width, size, templates
        self.need = -(-NEED * size // 100)
        jaccard = self.need / (2 * size + size - self.need)
        self.bands = max(1, math.ceil(math.log(MISS) / math.log1p(-jaccard)))
        self.seeds = B.mix(np.arange(1, self.bands + 1, dtype=np.uint64) * np.uint64(B.GOLDEN)) | np.uint64(1)
        self.values = np.array([[band(t, s).min() for _, t in templates] for s in self.seeds])


def band(shingles: np.ndarray, seed: np.uint64) -> np.ndarray:
    x = (shingles ^ (seed >> np.uint64(7))) * seed
    return x ^ (x >> np.uint64(32))


def classes_of(templates: list[tuple[str, str]]) -> list[Class]:
    by: dict[tuple[int, int], list] = {}
    for name, text in templates:
        buf = np.frombuffer(text.encode(), np.uint8)
        start, stop, _ = B.words_of(buf, np.array([0, len(buf)]), B.ALNUM)
        if len(start):
            width = min(WORDS, len(start))
            shingles = np.unique(B.window_hashes(B.word_hashes(buf, start, stop), width))
            by.setdefault((width, len(shingles)), []).append((name, shingles))
    return [Class(w, n, t) for (w, n), t in sorted(by.items())]


class Lookup:
    """Shingles of all templates of one width: which texts hold enough of them."""

    def __init__(self, width: int, classes: list[Class]):
        self.width, self.classes = width, [c for c in classes if c.width == width]
        own = [np.concatenate([t for _, t in c.templates]) for c in self.classes]
        self.known = np.unique(np.concatenate(own))
        self.member = [np.isin(self.known, x) for x in own]
        self.mask = np.uint64((1 << max(12, (64 * len(self.known)).bit_length())) - 1)
        self.maybe = np.zeros(int(self.mask) + 1, bool)
        self.maybe[(self.known & self.mask).astype(np.int64)] = True

    def texts(self, grams: np.ndarray, first: np.ndarray):
        """(class, rows) that hold at least as many shingles as a match needs."""
        at = np.flatnonzero(self.maybe[(grams & self.mask).astype(np.int64)])
        place = np.minimum(np.searchsorted(self.known, grams[at]), len(self.known) - 1)
        row = np.searchsorted(first, at, "right") - 1
        own = (self.known[place] == grams[at]) & (at + self.width <= first[row + 1])
        row, place = row[own], place[own]
        for c, member in zip(self.classes, self.member, strict=True):
            rows = np.flatnonzero(np.bincount(row[member[place]], minlength=len(first) - 1) >= c.need)
            if len(rows):
                yield c, rows


def _windows(c: Class, hashes: np.ndarray, n_words: np.ndarray, first: np.ndarray):
    """Shingles of the class's width by row (of all, ``hashes``), and the half
    windows over them: shingles, half starts, row of each half."""
    n = np.maximum(n_words - c.width + 1, 0)
    row, rank = B.expand(n)
    grams = hashes[first[row] + rank] if len(row) else np.zeros(0, np.uint64)
    begin = np.cumsum(n) - n
    half_row, half = B.expand(-(-n // c.size))
    return grams, begin[half_row] + half * c.size, half_row, half


def _matches(c: Class, hashes, n_words, first):
    """(row, template, window, shared, total) of every verified match."""
    grams, starts, rows, half = _windows(c, hashes, n_words, first)
    if not len(starts):
        return
    follows = np.zeros(len(starts), bool)
    follows[:-1] = rows[1:] == rows[:-1]
    candidate = np.zeros((len(c.templates), len(starts)), bool)
    for seed, value in zip(c.seeds, c.values, strict=True):
        least = np.minimum.reduceat(band(grams, seed), starts)
        both = least.copy()
        both[:-1] = np.where(follows[:-1], np.minimum(least[:-1], least[1:]), least[:-1])
        for k, v in enumerate(value):
            candidate[k] |= both == v
    ends = np.append(starts[1:], len(grams))
    for k, w in zip(*np.nonzero(candidate), strict=True):
        stop = ends[w + 1] if follows[w] else ends[w]
        shared = int(np.isin(c.templates[k][1], grams[starts[w]:stop]).sum())
        if shared >= c.need:
            yield int(rows[w]), c.templates[k][0], int(half[w]) * c.size, shared, c.size


def _better(x: tuple[int, int, int], y: tuple[int, int, int]) -> bool:
    """Of two matches (window, shared, total) of a name: the template with more
    shingles, then the window with more of them, then the first."""
    return (x[2], x[1], -x[0]) > (y[2], y[1], -y[0])


def _scanner(classes: list[Class]):
    def run(batches):
        lookups = [Lookup(w, classes) for w in sorted({c.width for c in classes})]
        for batch in batches:
            for row, rows, buf, off in B.text_slices(batch.column(1)):
                start, stop, first = B.words_of(buf, off, B.ALNUM)
                hashes = B.word_hashes(buf, start, stop) if len(start) else np.zeros(0, np.uint64)
                best: list[dict[str, tuple[int, int, int]]] = [{} for _ in range(rows)]
                for k in lookups:
                    grams = B.window_hashes(hashes, k.width)
                    for c, some in k.texts(grams, first):
                        for i, name, window, shared, total in _matches(c, grams, np.diff(first)[some], first[some]):
                            r = int(some[i])
                            if name not in best[r] or _better((window, shared, total), best[r][name]):
                                best[r][name] = window, shared, total
                found = [[{"template": t, "window": w, "shared": s, "total": n} for t, (w, s, n) in sorted(b.items())]
                         for b in best]
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(row, rows), pa.array([len(x) for x in found], pa.int64()),
                    pa.array([",".join(m["template"] for m in x) for x in found], pa.string()),
                    pa.array(found, pa.list_(pa.struct([("template", pa.string()), ("window", pa.int64()),
                                                        ("shared", pa.int64()), ("total", pa.int64())])))],
                    names=["doc_id", "n_templates", "templates", "matches"])
    return run


def scan(docs: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """One row per document: the number and names of templates found, and for
    each its best window (first shingle of it) with shared and total shingles."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(_scanner(classes_of(templates)), MATCHES)
