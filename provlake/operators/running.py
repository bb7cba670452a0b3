"""Running counts over keys of any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def running_sum(df: DataFrame, keys: list[str], order: list[str], value: Column, block: Column,
                name: str) -> DataFrame:
    """Sum of ``value`` over the rows strictly before each row of its key.

    ``block`` must grow with ``order``. Rows are summed inside their block, and block totals
    (one row per key and block) carry the rest, so no key is ever one task's work.
    """
    rows = df.withColumn("_block", block).withColumn("_v", value)
    before = Window.partitionBy(*keys, "_block").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    totals = rows.groupBy(*keys, "_block").agg(F.sum("_v").alias("_t")).select(
        *keys, "_block", F.coalesce(F.sum("_t").over(earlier), F.lit(0)).alias("_off"))
    inner = rows.withColumn("_in", F.coalesce(F.sum("_v").over(before), F.lit(0)))
    return inner.join(totals, [*keys, "_block"]).withColumn(name, F.col("_in") + F.col("_off")) \
        .drop("_block", "_v", "_in", "_off")
