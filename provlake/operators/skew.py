"""Joins and ranks that hold when one key has a third of all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SALTS = 32
SLICES = 64


def join_facts(rows: DataFrame, facts: DataFrame, keys: list[str], spread: str, how: str = "inner", salts: int = SALTS) -> DataFrame:
    """Join many rows with facts that are unique per key (a crate, a session).

    Rows are spread over ``salts`` parts of their key by the hash of ``spread`` and each fact is
    repeated once per part, so a hot key is read by that many tasks. Facts number as many as
    keys, so the repetition is small next to the rows, and a following grouping by the key
    combines before it shuffles.
    """
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int"))
    copies = facts.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(copies, [*keys, "_salt"], how).drop("_salt")


def first_k(rows: DataFrame, keys: list[str], order: str, k: int) -> DataFrame:
    """The first ``k`` rows of each key by ``order``, exactly, with their ``rank``.

    Every slice of a key keeps its own first k, and only those meet: at most 64 k rows per key.
    """
    sliced = rows.withColumn("_slice", F.pmod(F.xxhash64(order), F.lit(SLICES)))
    near = F.row_number().over(Window.partitionBy(*keys, "_slice").orderBy(order))
    some = sliced.withColumn("rank", near).where(F.col("rank") <= k).drop("_slice", "rank")
    return some.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(order))).where(F.col("rank") <= k)
