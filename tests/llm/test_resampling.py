import math
import random
import re
from collections import Counter
from hashlib import sha256
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from provlake.llm import resampling as r
from tests.llm.conftest import babble


def grams(text):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return len(w), [crc32(x.encode()) % 10_000 for x in [*w, *map(" ".join, zip(w, w[1:], strict=False))]]


def brute(docs, target):
    s, t = Counter(b for _, x in docs for b in grams(x)[1]), Counter(b for x in target for b in grams(x)[1])
    ns, nt = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (ns + 10_000) / ((s[b] + 1) * (nt + 10_000)))) for b in range(10_000)]
    rows = []
    for doc, text in docs:
        n, f = grams(text)
        h = int(sha256(f"7:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        rows.append([doc, n, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    fit = sorted((x for x in rows if x[1] >= 20), key=lambda x: (-x[4], math.inf if x[0] is None else x[0], x[3], x[2]))
    for i, x in enumerate(fit[:25 * len(fit) // 100]):
        x[5] = i + 1
    return sorted(((x[0], *x[2:]) for x in rows), key=str)


@pytest.mark.parametrize("reach", [r.REACH, 8])
def test_crc_of_spans(reach, monkeypatch):
    monkeypatch.setattr(r, "REACH", reach)
    r._tables.cache_clear()
    draw = random.Random(1)
    data = np.frombuffer(bytes(draw.randrange(256) for _ in range(9000)), np.uint8)
    size = np.array([*range(300), 1000, 4097, 9000])
    start = np.array([draw.randrange(len(data) - s + 1) for s in size])
    got = r.span_crc32(data, start, start + size)
    r._tables.cache_clear()
    assert got.tolist() == [crc32(data[a:a + s].tobytes()) for a, s in zip(start, size, strict=True)]


@pytest.mark.parametrize("piece", [r.PIECE, 64])
def test_equals_brute_force(spark, docs, odd_rows, piece, monkeypatch):
    monkeypatch.setattr(r, "PIECE", piece)
    long = [x for x in odd_rows if x[0] in (6, 7)] if piece == r.PIECE else []
    rows = [x for x in odd_rows if x[0] not in (6, 7)] + long + [(100 + i, babble(i, 15 + i % 30)) for i in range(150)]
    rows += [(400, "Same words " * 30)] * 4 + [(401, "w" * 500 + " " + "é" * 90), (402, "A1 b2, C3!")]
    target = [babble(3, 40), None, "", "same words", babble(4, 5)]
    table = docs(rows).withColumn("n_words", F.lit("x")).withColumn("rank", F.lit(1)).withColumn("score", F.lit(None).cast("int"))
    goal = spark.createDataFrame([(i, x) for i, x in enumerate(target)], "item_id bigint, text string")
    assert sorted(map(tuple, r.resample(table, goal).collect()), key=str) == brute(rows, target)


def test_empty_tables(spark, docs):
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert r.resample(docs([]), none).collect() == []
    rows = [(1, "one two"), (2, None)]
    assert sorted(map(tuple, r.resample(docs(rows), none).collect()), key=str) == brute(rows, [])


def test_draw_takes_the_highest(spark):
    scored = spark.range(1000).selectExpr("id as doc_id", "if(id % 10 = 0, 19L, 20L) as n_words", "1L as n_features", "0L as weight", "(id * 7919) % 50 as score")
    got = sorted((x["rank"], x["doc_id"], x["score"]) for x in r.draw(scored).collect() if x["rank"])
    want = sorted(((-((i * 7919) % 50), i) for i in range(1000) if i % 10))[:225]
    assert got == [(n, i, -s) for n, (s, i) in enumerate(want, 1)]
