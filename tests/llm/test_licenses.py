import math
import re

from pyspark.sql import functions as F

from provlake.llm import licenses
from tests.llm.conftest import babble


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").lower())


def test_bands_are_as_sure_as_asked():
    for size in range(1, 60):
        need, window = math.ceil(0.75 * size), size + licenses.stride(size) - 1
        least = need / (window + size - need)
        assert 1 - (1 - least) ** licenses.bands_for(size, 0.75, 0.999) >= 0.999 - 1e-12


def test_every_notice_is_found_anywhere(docs, odd_rows):
    rows, want = [], []
    for i, (name, text) in enumerate(sorted(licenses.TEMPLATES.items())):
        for j in range(8):
            lead = babble(1000 + i * 10 + j, 3 * j + (j > 5) * 400)
            rows.append((i * 10 + j, f"{lead} {text.upper() if j % 2 else text} {babble(5000 + i + j, 7 * (j % 3))}"))
            want.append((i * 10 + j, name, len(words(lead)), len(words(lead)) + len(words(text))))
    table = docs(rows + [(9000 + k, t) for k, (_, t) in enumerate(odd_rows)]).withColumn("license", F.lit(1)).withColumn("contained", F.lit("x"))
    got = sorted((r["doc_id"], r["license"], r["start_word"], r["end_word"]) for r in licenses.scan_licenses(table).collect())
    assert got == sorted(want)


def test_changed_notices_and_others(docs):
    text = licenses.TEMPLATES["GPL-3.0 notice"].split()
    slightly, much = list(text), list(text)
    slightly[12] = "alter"
    much[5::5] = ["other"] * len(much[5::5])
    rows = [(1, " ".join(slightly)), (2, " ".join(much)), (3, "license " * 200), (4, None), (5, "MIT License"), (6, "Released under the MIT License. " * 2)]
    got = sorted((r["doc_id"], r["license"]) for r in licenses.scan_licenses(docs(rows)).collect())
    assert got == [(1, "GPL-3.0 notice"), (6, "MIT line"), (6, "MIT line")]
    short = {"tag": "SPDX MIT", "none": "!?"}
    assert [tuple(r) for r in licenses.scan_licenses(docs([(1, "x spdx mit y")]), short).collect()] == [(1, "tag", 1, 3, 1.0)]
    assert licenses.scan_licenses(docs([])).collect() == []


def test_families_are_told_apart_or_left_open(docs):
    """Wordings that differ in a version, a word or a clause; without the deciding words only the family is named."""
    gpl = "This program is free software; you can redistribute it and/or modify it under the terms of the GNU {}General Public License as published by the Free Software Foundation; either version {} of the License, or (at your option) any later version."
    bsd = licenses.TEMPLATES["BSD-3-Clause text"]
    third = bsd[bsd.index("3. Neither"):bsd.index("THIS SOFTWARE")]
    texts = [(gpl.format("", 2), "GPL-2.0 notice"), (gpl.format("", 3), "GPL-3.0 notice"), (gpl.format("Affero ", 3), "AGPL-3.0 notice"), (gpl.format("Lesser ", 3), "LGPL-3.0 notice"),
             (gpl.format("", "XX"), "GNU, undecided"), (bsd.replace(third, ""), "BSD-2-Clause text"), (bsd, "BSD-3-Clause text"), (bsd.replace("promote products", "advertise goods"), "BSD-3-Clause text"),
             (bsd[:bsd.index("1. Redis")], "BSD notice"), ("This work is licensed under the GNU General Public License, version 1.", "GNU, undecided"),
             ("This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.", "CC-BY-NC-SA-4.0 line")]
    got = sorted((r["doc_id"], r["license"]) for r in licenses.scan_licenses(docs([(i, f"{babble(i, 20)} {x} {babble(50 + i, 20)}") for i, (x, _) in enumerate(texts)])).collect())
    assert got == [(i, name) for i, (_, name) in enumerate(texts)]
