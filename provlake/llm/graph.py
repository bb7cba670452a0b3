"""Connected components of a link table, by stars, over written tables.

Every round points each node at the smallest neighbour it can see: first all larger neighbours
of a node move to the node's minimum, then a node's smaller neighbours meet at theirs. The edge
table ends as stars around the smallest member. Tasks first drop edges that close a circle among
their own edges, so a dense group arrives as a tree. Rounds grow with the logarithm of a
component's diameter; the driver sees one count and one checksum for each round.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from provlake.session import cut


def _tree(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A spanning forest of the edges of each batch."""
    for batch in batches:
        a, b = (batch.column(i).to_numpy() for i in range(2))
        nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
        root = list(range(len(nodes)))
        keep = np.zeros(len(a), bool)
        for i, (x, y) in enumerate(zip(at[:len(a)].tolist(), at[len(a):].tolist(), strict=True)):
            while root[x] != x:
                root[x] = x = root[root[x]]
            while root[y] != y:
                root[y] = y = root[root[y]]
            if x != y:
                root[max(x, y)] = min(x, y)
                keep[i] = True
        yield batch.filter(pa.array(keep))


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """``node`` and ``component``, its smallest reachable node, for every node in a link to another.

    Both columns are bigints; null ends and loops link nothing; repeated and turned edges count once.
    """
    pairs = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where(f"{a} is not null and {b} is not null and {a} <> {b}")
    pairs = cut(pairs.mapInArrow(_tree, "u bigint, v bigint").distinct(), "links")
    state = None
    while True:
        both = pairs.union(pairs.select("v", "u")).toDF("n", "x")
        low = both.groupBy("n").agg(F.min("x").alias("m")).select("n", F.least("n", "m").alias("m"))
        large = both.where("x > n").join(low, "n").select(F.col("x").alias("u"), F.col("m").alias("v")).distinct()
        large = cut(large, "links")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        pairs = cut(small.distinct(), "links")
        seen = pairs.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.pmod(F.xxhash64("u", "v"), F.lit(1 << 30)))).first()
        if tuple(seen) == state or seen[0] == 0:
            break
        state = tuple(seen)
    members = pairs.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return members.union(pairs.select("v", "v").distinct())


def with_components(nodes: DataFrame, edges: DataFrame, key: str, a: str, b: str) -> DataFrame:
    """The rows with ``component_id``: a row without links is its own component."""
    found = components(edges, a, b)
    return nodes.join(found.withColumnRenamed("node", "__node"), F.col(key) == F.col("__node"), "left").withColumn(
        "component_id", F.coalesce("component", key)).drop("component", "__node")
