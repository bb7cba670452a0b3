"""License scan: MinHash bands over overlapping windows, verified by exact shingle containment.

Every template is a set of shingles of ``SHINGLE`` words. A text is covered by windows a little
longer than each template, which begin at every quarter of a template's length, so some window
holds any whole copy. Windows and templates are compared by ``bands`` of one MinHash value: at
the smallest similarity a wanted match can have, the number of bands makes a common one as
likely as ``sure`` asks. A retrieved template is then checked exactly: the share of its shingles
inside the window must reach ``contained``. Of matches that overlap, the fullest stays; inside a
family of wordings that differ in few words (``FAMILIES``) the one whose own shingles are there in
the larger share, and without a difference in these only the family is told.

The templates are a parameter and travel with the code; their number does not depend on the data.

Defined cases: null and empty texts match nothing; a template shorter than a shingle is one
shingle of all its words, a template without words never matches; repeated rows each give their
matches; of equally full matches at one place the longest stays, then the first template by name;
only doc_id and text are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from provlake.llm.words import ALNUM, _spread, grams, pieces, words

SHINGLE, CONTAINED, SURE = 5, 0.75, 0.999

_BSD_HEAD = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"
_BSD_TWO = "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
_BSD_THIRD = "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
_BSD_TAIL = "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED."


def _gnu(what: str, name: str, version: str) -> str:
    return f"This {what} is free software: you can redistribute it and/or modify it under the terms of the GNU {name}General Public License as published by the Free Software Foundation, either version {version} of the License, or (at your option) any later version."


# Notices as their publishers word them.
TEMPLATES = {
    "AGPL-3.0 line": "This work is licensed under the GNU Affero General Public License, version 3.",
    "AGPL-3.0 notice": _gnu("program", "Affero ", "3"),
    "Apache-2.0 line": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0 notice": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at",
    "BSD notice": _BSD_HEAD,
    "BSD-2-Clause text": f"{_BSD_HEAD}: {_BSD_TWO} {_BSD_TAIL}",
    "BSD-3-Clause text": f"{_BSD_HEAD}: {_BSD_TWO} {_BSD_THIRD} {_BSD_TAIL}",
    "CC0-1.0 line": "This work is dedicated to the public domain under the Creative Commons CC0 1.0 Universal Public Domain Dedication.",
    **{f"CC-{kind}-4.0 line": f"This work is licensed under a Creative Commons {said} 4.0 International License." for kind, said in (
        ("BY", "Attribution"), ("BY-NC", "Attribution-NonCommercial"), ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives"),
        ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"), ("BY-ND", "Attribution-NoDerivatives"), ("BY-SA", "Attribution-ShareAlike"))},
    **{f"CC-{kind}-4.0 short": f"Licensed under CC {kind} 4.0." for kind in ("BY", "BY-NC", "BY-NC-ND", "BY-NC-SA", "BY-ND", "BY-SA")},
    "EPL-1.0 notice": "This program and the accompanying materials are made available under the terms of the Eclipse Public License v1.0 which accompanies this distribution, and is available at http://www.eclipse.org/legal/epl-v10.html",
    "EPL-2.0 notice": "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0",
    "GPL-2.0 line": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-2.0 notice": _gnu("program", "", "2"),
    "GPL-3.0 line": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0 notice": _gnu("program", "", "3"),
    "ISC notice": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "LGPL-2.1 line": "This work is licensed under the GNU Lesser General Public License, version 2.1.",
    "LGPL-2.1 notice": _gnu("library", "Lesser ", "2.1"),
    "LGPL-3.0 line": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "LGPL-3.0 notice": _gnu("program", "Lesser ", "3"),
    "MIT line": "Released under the MIT License.",
    "MIT notice": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction",
    "MPL-2.0 notice": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at",
    "Unlicense notice": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
}

#: Beginnings of names whose wordings differ in few words, and what a match is called that lacks those.
FAMILIES = {"AGPL-": "GNU, undecided", "GPL-": "GNU, undecided", "LGPL-": "GNU, undecided", "BSD": "BSD notice", "CC": "Creative Commons, undecided", "EPL-": "EPL, undecided"}


def family(name: str) -> str | None:
    return next((label for begin, label in FAMILIES.items() if name.startswith(begin)), None)


def shingles_of(text: str) -> tuple[int, np.ndarray]:
    """Words of a shingle, and the shingles."""
    raw = np.frombuffer(text.encode(), np.uint8)
    found = words(raw, np.array([0, len(raw)]), ALNUM)
    k = min(SHINGLE, len(found.hash))
    return k, grams(found.hash, found.row, k)[0] if k else np.zeros(0, np.uint64)


def stride(size: int) -> int:
    return max(1, size // 4)


def bands_for(size: int, contained: float, sure: float, distinct: int | None = None) -> int:
    """Bands that meet with probability ``sure`` for the least similar wanted window of a template."""
    held = distinct or size
    need, window = math.ceil(contained * held), size + stride(size) - 1
    least = need / (window + held - need)
    return 1 if least >= 1 else math.ceil(math.log(1 - sure) / math.log(1 - least))


class _Templates:
    """The templates' shingles, and where their smallest hash values lead."""

    def __init__(self, texts: dict[str, str], contained: float, sure: float):
        self.names = sorted(texts)
        self.sets: list[set[int]] = []
        self.need: list[int] = []
        self.step: list[int] = []
        #: words of a shingle -> shingles of a template -> band -> smallest value -> template numbers
        self.table: dict[int, dict[int, list[dict[int, list[int]]]]] = {}
        for i, name in enumerate(self.names):
            k, whole = shingles_of(texts[name])
            self.sets.append(set(whole.tolist()))
            size = len(whole)  # a window must hold shingles that a template repeats as often
            self.need.append(math.ceil(contained * len(self.sets[-1])))
            self.step.append(stride(size))
            if size:
                bands = self.table.setdefault(k, {}).setdefault(size, [])
                own = bands_for(size, contained, sure, len(self.sets[-1]))
                bands += [{} for _ in range(own - len(bands))]
                for f, band in enumerate(bands[:own]):
                    band.setdefault(int(_permuted(whole, f).min()), []).append(i)


def _permuted(value: np.ndarray, f: int) -> np.ndarray:
    return _spread(value ^ _spread(np.array([f + 1], np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)))


def _candidates(value: np.ndarray, by_size: dict[int, list[dict[int, list[int]]]]) -> set[tuple[int, int, int]]:
    """(first shingle, shingles, template) of windows that share a band with a template.

    The texts of a batch are one run; a window may reach into the next text, which the number of
    bands allows for as for any other words beside a match.
    """
    out: set[tuple[int, int, int]] = set()
    longest = max(size + stride(size) - 1 for size in by_size)
    for f in range(max(map(len, by_size.values()))):
        levels = [np.append(_permuted(value, f), np.full(longest, np.iinfo(np.uint64).max, np.uint64))]
        while 2 << (len(levels) - 1) <= longest:  # minima of 1, 2, 4, ... neighbours
            half = 1 << (len(levels) - 1)
            levels.append(np.minimum(levels[-1][:-half], levels[-1][half:]))
        for size, bands in by_size.items():
            if f >= len(bands):
                continue
            step, window = stride(size), size + stride(size) - 1
            level = window.bit_length() - 1
            at = np.arange(0, len(value), step)
            low = np.minimum(levels[level][at], levels[level][at + window - (1 << level)])
            hit = np.zeros(len(at), bool)
            for wanted in bands[f]:
                hit |= low == np.uint64(wanted)
            out |= {(i * step, window, t) for i in np.flatnonzero(hit).tolist() for t in bands[f][int(low[i])]}
    return out


def _decided(some: dict[tuple, frozenset[int]], sets: dict[str, set[int]]) -> list[tuple]:
    """Of matches that overlap the fullest; its family is told apart by the shingles that only one of two wordings has.

    A match whose family's others are as well borne out by such shingles takes the family's name.
    """
    out: list[tuple] = []
    for match in sorted(some):
        lo, hi = match[3:]
        if any(lo < b and a < hi for *_, a, b in out):
            continue
        best, label, tied = match, family(match[2]), False
        for other in sorted(some) if label else []:
            if other[2] == best[2] or family(other[2]) != label or other[3] >= best[4] or best[3] >= other[4] or any(other[3] < b and a < other[4] for *_, a, b in out):
                continue
            mine, its = sets[best[2]] - sets[other[2]], sets[other[2]] - sets[best[2]]
            here, there = len(some[best] & mine) / max(1, len(mine)), len(some[other] & its) / max(1, len(its))
            if there > here:
                best, tied = other, False
            elif there == here:
                tied = True
        out.append((best[0], best[1], label if tied else best[2], *best[3:]))
    return out


def _scan(texts: dict[str, str], contained: float, sure: float, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    templates = _Templates(texts, contained, sure)
    named = dict(zip(templates.names, templates.sets, strict=True))
    for batch in batches:
        ids, out = batch.column(0), []
        for at, to, data, offsets in pieces(batch):
            found = words(data, offsets, ALNUM)
            begin = np.searchsorted(found.row, np.arange(to - at + 1))
            matches: dict[int, dict[tuple, frozenset[int]]] = {}
            for k, by_size in templates.table.items():
                value, first = grams(found.hash, found.row, k)
                found_at = _candidates(value, by_size)
                # A window with part of a copy may be the one retrieved; the one with all of it begins near by.
                near = {(i, width, t) for start, width, t in found_at for i in (start + n * templates.step[t] for n in range(-2, 3)) if 0 <= i < len(value)}
                for start, width, t in near:
                    inside = np.array([v in templates.sets[t] for v in value[start:start + width].tolist()], bool)
                    place = first[start:start + width][inside]
                    for row in np.unique(found.row[place]):
                        own = place[found.row[place] == row]
                        held = frozenset(value[start:start + width][inside][found.row[place] == row].tolist())
                        share = len(held)
                        if share >= templates.need[t]:
                            matches.setdefault(int(row), {})[(-share / len(templates.sets[t]), -share, templates.names[t], int(own.min() - begin[row]), int(own.max() - begin[row]) + k)] = held
            for row, some in matches.items():
                for less, _, name, lo, hi in _decided(some, named):
                    out.append((ids[at + row].as_py(), name, lo, hi, -less))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), [ids.type, pa.string(), pa.int32(), pa.int32(), pa.float64()], strict=True)],
                                             names=["doc_id", "license", "start_word", "end_word", "contained"])


def scan_licenses(documents: DataFrame, templates: dict[str, str] = TEMPLATES, contained: float = CONTAINED, sure: float = SURE) -> DataFrame:
    """doc_id, license, start_word, end_word and contained of every match; words count from 0, the end is the word after it."""
    kind = dict(documents.dtypes)["doc_id"]
    return documents.select("doc_id", "text").mapInArrow(partial(_scan, dict(templates), contained, sure),
                                                         f"doc_id {kind}, license string, start_word int, end_word int, contained double")
