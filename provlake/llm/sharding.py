"""Shards cut from a Hilbert curve through several metadata dimensions.

Every dimension is quantised by approximate quantiles into at most 2**bits cells, the cells of a
row are one point of a grid, and the point's place on the Hilbert curve orders the rows. Shards
are runs of that order with row counts at most one apart, so a shard covers a small box of the
grid and a reader's filters on any of the dimensions skip most shards by their minima and maxima.

Ranks come from a range-partitioned, written table: place in the partition plus the rows before
it. The driver sees only the quantiles (a fixed number) and one count for each partition.

Defined cases: null dimensions share the lowest cell; a null text has no bytes and checksum 0;
equal rows may take each other's slot; fewer rows than shards leave shards empty; an empty table
gives no rows; only the named columns are read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from provlake.session import cut

BITS = 5
_PLACE = (1 << 33) - 1  # monotonically_increasing_id: partition above, place in it below


def hilbert_index(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place of each grid point on the Hilbert curve; ``cells`` has one row for each point.

    From the highest bit down, the curve inside a cell is the whole curve reflected or turned:
    a set bit flips the first axis below it, a clear bit exchanges it with the first axis. The
    Gray code of the turned bits, read across axes, is the place.
    """
    axes = [cells[:, i].astype(np.int64).copy() for i in range(cells.shape[1])]
    for level in range(bits - 1, 0, -1):
        below = (1 << level) - 1
        for axis in axes:
            is_set = (axis >> level) & 1 == 1
            swap = np.where(is_set, 0, (axes[0] ^ axis) & below)
            turned = np.where(is_set, axes[0] ^ below, axes[0] ^ swap)
            if axis is axes[0]:
                axes[0][:] = turned
            else:
                axis ^= swap
                axes[0][:] = turned
    for i in range(1, len(axes)):
        axes[i] ^= axes[i - 1]
    flip = np.zeros(len(cells), np.int64)
    for level in range(bits - 1, 0, -1):
        flip ^= np.where((axes[-1] >> level) & 1 == 1, (1 << level) - 1, 0)
    place = np.zeros(len(cells), np.int64)
    for level in range(bits - 1, -1, -1):
        for axis in axes:
            place = (place << 1) | (((axis ^ flip) >> level) & 1)
    return place


def ordered_number(name: str, kind: str) -> Column:
    """A number in the order of the values: the first seven bytes of texts, numbers as they are."""
    if kind == "string":
        return F.conv(F.rpad(F.hex(F.substring(F.col(name).cast("binary"), 1, 7)), 14, "0"), 16, 10).cast("double")
    return F.col(name).cast("double")


def _quantised(df: DataFrame, numbers: list[str], bits: int) -> DataFrame:
    shares = [i / (1 << bits) for i in range(1, 1 << bits)]
    found = df.agg(*[F.percentile_approx(n, F.array(*map(F.lit, shares)), 10_000).alias(n) for n in numbers]).first()
    for n in numbers:
        edges = sorted({float(x) for x in found[n] or []})
        cell = F.lit(0)
        for edge in edges:
            cell = cell + F.when(F.col(n) > edge, 1).otherwise(0)
        df = df.withColumn(n, cell.cast("int"))
    return df


def hilbert_order(rows: DataFrame, dimensions: list[str], keys: list[str], bits: int = BITS) -> DataFrame:
    """The rows with ``hilbert`` (place on the curve), ``rank`` (from 0, without gaps) and ``n_rows`` (of all).

    ``keys`` order rows of one cell.
    """
    numbers = [f"__cell_{i}" for i in range(len(dimensions))]
    kinds = dict(rows.dtypes)
    placed = rows.withColumns({n: ordered_number(d, kinds[d]) for n, d in zip(numbers, dimensions, strict=True)})
    placed = _quantised(placed, numbers, bits)

    @F.pandas_udf("bigint")
    def place(*cells: pd.Series) -> pd.Series:
        return pd.Series(hilbert_index(np.stack([c.to_numpy() for c in cells], axis=1), bits))

    placed = placed.withColumn("hilbert", place(*numbers)).drop(*numbers)
    order = ["hilbert", *keys]
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = cut(placed.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("__at", F.monotonically_increasing_id()), "hilbert")
    part = F.shiftright("__at", 33)
    counts = placed.groupBy(part.alias("__part")).agg(F.count("*").alias("n"))
    before = counts.select("__part", (F.sum("n").over(Window.orderBy("__part")) - F.col("n")).alias("__before"), F.sum("n").over(Window.partitionBy()).alias("n_rows"))
    return placed.withColumn("__part", part).join(before, "__part").withColumn("rank", F.col("__before") + F.col("__at").bitwiseAND(_PLACE)).drop("__at", "__part", "__before")


def hilbert_shards(rows: DataFrame, n_shards: int, dimensions: list[str], keys: list[str], bits: int = BITS) -> DataFrame:
    """The rows with hilbert, shard (0 to n_shards - 1) and slot (from 0 in each shard, without gaps)."""
    ranked = hilbert_order(rows, dimensions, keys, bits)
    shard = F.expr(f"((rank + 1) * {n_shards} - 1) div n_rows")
    return ranked.withColumn("shard", shard.cast("int")).withColumn("slot", F.expr(f"rank - (shard * n_rows) div {n_shards}")).drop("rank", "n_rows")


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder of sorted files for each shard; the files' minima and maxima prune later reads."""
    sharded.repartition("shard").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def shard_documents(documents: DataFrame, n_shards: int = 24, dimensions: tuple[str, ...] = ("lang", "source", "size")) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard by the law of equal row counts."""
    raw = F.coalesce("text", F.lit("")).cast("binary")
    taken = [d for d in dimensions if d != "size"]
    rows = documents.select("doc_id", *taken, (F.length(raw) + 8).cast("bigint").alias("size"), F.crc32(raw).alias("text_crc32"))
    sharded = hilbert_shards(rows, n_shards, list(dimensions), ["doc_id", "text_crc32", "size"])
    return sharded.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "hilbert")
