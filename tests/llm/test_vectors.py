import math

import numpy as np
from pyspark.sql import functions as F

from provlake.llm import vectors


def brute(rows, threshold=0.95):
    good = [(i, np.array(v, np.float64)) for i, v in rows if v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    near = {i: set() for i, _ in rows}
    for i, a in good:
        for j, b in good:
            if i != j and len(a) == len(b) and a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= threshold:
                near[i].add(j)
    low = {}
    for i in near:
        seen, todo = {i}, [i]
        while todo:
            for j in near[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        low[i] = min(seen)
    return sorted((i, len(near[i]), low[i], i == low[i]) for i in near)


def sample(n, seed=5):
    draw = np.random.default_rng(seed)
    base = draw.standard_normal((n // 5, 16))
    return [(i, [float(x) for x in np.float32(base[i % len(base)] + (draw.standard_normal(16) * draw.choice([0.02, 0.1, 0.25]) if i >= len(base) else 0))]) for i in range(n)]


def test_links_of_good_and_odd_vectors(spark, monkeypatch):
    monkeypatch.setattr(vectors, "BLOCK", 16)  # buckets of several blocks
    rows = sample(300)
    rows += [(1000 + i, [float(x) for x in np.float32([1, 2, 3, 4]) + np.float32(i) * np.float32(0.01)]) for i in range(60)]
    rows += [(2000, None), (2001, []), (2002, [0.0] * 16), (2003, [1.0, None]), (2004, [float("nan"), 1.0]), (2005, [float("inf"), 1.0]),
             (2006, [1.0, 0.0]), (2007, [2.0, -0.0]), (2008, [1.0, 0.0]), (2009, [1.0, 0.0, 0.0]), (2010, [3.0, -0.0])]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").withColumn("rep", F.lit("x")).withColumn("weight", F.lit(9))
    got = sorted(tuple(r) for r in vectors.near_vectors(table, recall=0.999999).collect())
    assert got == brute(rows)


def test_recall_at_the_production_setting(spark):
    rows = sample(2000, 6)
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    got, want = ({r[0]: r[1] for r in part} for part in (vectors.near_vectors(table).collect(), brute(rows)))
    assert all(got[i] <= want[i] for i in want)
    assert sum(got.values()) >= 0.97 * sum(want.values()) > 0
    assert vectors.near_vectors(table.limit(0)).collect() == []


def test_repeated_rows(spark):
    table = spark.createDataFrame([(1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 1.0])], "vec_id bigint, embedding array<float>")
    assert sorted(tuple(r) for r in vectors.near_vectors(table).collect()) == [(1, 1, 1, True), (1, 1, 1, True), (2, 0, 2, True)]
