"""Near-duplicate vectors by Euclidean p-stable hashing and exact cosines.

Normalised vectors are projected on Gaussian directions, shifted and cut into steps of width
``WIDTH``; ``k`` such steps make a bucket and there are several tables of buckets. ``k`` grows
with the logarithm of the number of vectors, so that a vector meets few strangers in a bucket,
and the number of tables follows from it so that a pair at the threshold shares a bucket with
probability ``recall`` at least; closer pairs share one more often.

Equal vectors are one row with a count before hashing. A bucket is compared in blocks of
vectors, block against block, each pair of blocks in a task of its own, so large groups spread
over tasks. A pair counts in the first table whose bucket it shares. Blocks return link counts
and a few edges that keep their vectors connected, never all pairs.

Defined cases: vectors that are null, empty or zero, or hold null or non-finite parts, link with
nothing; vectors of different length do not link; rows with the same id count as rows of
their own; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from provlake.llm.graph import with_components
from provlake.session import cut

WIDTH, RECALL, BLOCK, SEED = 1.5, 0.98, 1024, 20
#: Strangers a vector should meet in one bucket.
STRANGERS = 64


def _chance(distance: float) -> float:
    """That two points at this distance fall into one step of a random projection."""
    x = WIDTH / distance
    below = 0.5 * (1 + math.erf(-x / math.sqrt(2)))
    return 1 - 2 * below - 2 / (math.sqrt(2 * math.pi) * x) * (1 - math.exp(-x * x / 2))


def settings(n: int, threshold: float, recall: float = RECALL) -> tuple[int, int]:
    """Steps in a bucket and number of tables for n vectors."""
    near, far = _chance(math.sqrt(max(1e-9, 2 - 2 * threshold))), _chance(math.sqrt(2))
    k = max(2, math.ceil(math.log(max(n, 2) / STRANGERS) / -math.log(far)))
    return k, max(1, math.ceil(math.log(1 - recall) / math.log(1 - near ** k)))


def _hashed(k: int, tables: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    planes: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    mix = np.random.default_rng(SEED).integers(1, 1 << 62, k, dtype=np.int64) | 1
    for batch in batches:
        rows = batch.column(1)
        size = np.diff(rows.offsets.to_numpy())
        for dim in np.unique(size):
            if dim not in planes:
                random = np.random.default_rng([SEED, int(dim)])
                planes[dim] = random.standard_normal((int(dim), k * tables)), random.uniform(0, WIDTH, k * tables)
            plane, shift = planes[dim]
            own = batch.filter(pa.array(size == dim))
            x = own.column(1).flatten().to_numpy().astype(np.float64).reshape(-1, dim)
            x = x / np.linalg.norm(x, axis=1, keepdims=True)
            steps = np.floor((x @ plane + shift) / WIDTH).astype(np.int64).reshape(len(x), tables, k)
            keys = ((steps * mix).sum(axis=2) * np.int64(0x1E3779B97F4A7C15) + dim) >> 32
            yield pa.RecordBatch.from_arrays([*own.columns, pa.array(list(keys.astype(np.int32)), pa.list_(pa.int32()))], names=["rep", "embedding", "weight", "keys"])


def _labels(near: np.ndarray, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Smallest node each row and column of a link matrix reaches; columns count on after the rows."""
    n, m = near.shape
    row, col = np.arange(n), np.arange(m) + (0 if same else n)
    far = n + m
    while True:
        new_col = np.minimum(col, np.where(near, row[:, None], far).min(axis=0))
        if same:
            new_col = np.minimum(new_col, row)
        new_row = np.minimum(row, np.where(near, new_col[None, :], far).min(axis=1))
        if same:
            new_col = np.minimum(new_col, new_row)
        if (new_row == row).all() and (new_col == col).all():
            return row, col
        row, col = new_row, new_col


def _compared(threshold: float, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Reads the rows of one block pair after the other; partial link counts and connecting edges."""

    def unit(rows: list[dict]) -> np.ndarray:
        x = np.array([r["embedding"] for r in rows], np.float64)
        return x / np.linalg.norm(x, axis=1, keepdims=True)

    def close(group: tuple, rows: list[dict]) -> pa.RecordBatch | None:
        table, _, i, j = group
        left = [r for r in rows if r["block"] == i]
        right = left if i == j else [r for r in rows if r["block"] == j]
        if not left or not right or len(rows) < 2 or len({len(r["embedding"]) for r in rows}) > 1:
            return None if not left or not right or len(rows) < 2 else by_length(group, rows)
        a, b = unit(left), unit(right)
        near = a @ b.T >= threshold
        if i == j:
            np.fill_diagonal(near, False)
        if not near.any():
            return None
        x, y = np.nonzero(near)
        key_a, key_b = (np.array([r["keys"][:table] for r in part], np.int32).reshape(len(part), table) for part in (left, right))
        new = np.ones(len(x), bool)
        for t in range(table):
            new &= key_a[x, t] != key_b[y, t]
        ids_a, ids_b = (np.array([r["rep"] for r in part], np.int64) for part in (left, right))
        w_a, w_b = (np.array([r["weight"] for r in part], np.int64) for part in (left, right))
        count_a = np.bincount(x[new], w_b[y[new]], len(left)).astype(np.int64)
        row, col = _labels(near, i == j)
        named = np.concatenate([ids_a, ids_b])
        out = [(ids_a, count_a, named[row])]
        if i != j:
            out.append((ids_b, np.bincount(y[new], w_a[x[new]], len(right)).astype(np.int64), named[col]))
        ids, counts, linked = (np.concatenate(z) for z in zip(*out, strict=True))
        keep = (counts > 0) | (linked != ids)
        return pa.RecordBatch.from_arrays([pa.array(z[keep]) for z in (ids, counts, linked)], names=["rep", "n", "other"])

    def by_length(group: tuple, rows: list[dict]) -> pa.RecordBatch | None:
        parts = [close(group, [r for r in rows if len(r["embedding"]) == d]) for d in {len(r["embedding"]) for r in rows}]
        parts = [p for p in parts if p is not None]
        return pa.Table.from_batches(parts).combine_chunks().to_batches()[0] if parts else None

    group, held = None, []
    for batch in batches:
        for r in batch.to_pylist():
            own = (r["t"], r["key"], r["i"], r["j"])
            if own != group:
                if len(held) > 1 and (out := close(group, held)) is not None:
                    yield out
                group, held = own, []
            held.append(r)
    if len(held) > 1 and (out := close(group, held)) is not None:
        yield out


def near_vectors(vectors: DataFrame, threshold: float = 0.95, recall: float = RECALL) -> DataFrame:
    """vec_id, n_links, component_id and kept for every row."""
    good = F.expr("embedding is not null and size(embedding) > 0 and forall(embedding, x -> x is not null and not isnan(x) and abs(x) < double('infinity')) and exists(embedding, x -> x <> 0)")
    plain = F.transform("embedding", lambda x: x + F.lit(0.0))  # -0.0 and 0.0 are one value
    rows = vectors.select("vec_id", F.when(good, plain.cast("array<double>")).alias("embedding"))
    reps = cut(rows.where("embedding is not null and vec_id is not null").groupBy("embedding").agg(F.min("vec_id").alias("rep"), F.count("*").alias("weight")), "vectors")
    k, tables = settings(reps.count(), threshold, recall)
    hashed = cut(reps.select("rep", "embedding", "weight").mapInArrow(partial(_hashed, k, tables), "rep bigint, embedding array<double>, weight bigint, keys array<int>"), "hashed")
    placed = hashed.select("rep", F.posexplode("keys").alias("t", "key"))
    blocks = placed.groupBy("t", "key").agg(F.count("*").alias("n")).where("n > 1").select("t", "key", F.expr(f"int((n + {BLOCK - 1}) div {BLOCK})").alias("n_blocks"))
    dealt = hashed.select("*", F.posexplode("keys").alias("t", "key")).join(blocks, ["t", "key"])
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("rep"), "n_blocks").cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)))
    dealt = dealt.select("t", "key", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "rep", "weight", "embedding", "keys")
    group = ["t", "key", "i", "j"]
    found = cut(dealt.repartition(*group).sortWithinPartitions(*group, "rep").mapInArrow(partial(_compared, threshold), "rep bigint, n bigint, other bigint"), "vector-links")
    counts = found.groupBy("rep").agg(F.sum("n").alias("n"))
    classed = with_components(reps.select("rep", "embedding", "weight"), found, "rep", "rep", "other").join(counts, "rep", "left")
    member = rows.join(classed, "embedding", "left")
    links = F.when(F.col("rep").isNull() | F.col("vec_id").isNull(), 0).otherwise(F.coalesce("n", F.lit(0)) + F.col("weight") - 1)
    return member.select("vec_id", links.cast("bigint").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id")).withColumn("kept", F.col("vec_id") == F.col("component_id"))
