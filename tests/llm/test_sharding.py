import itertools
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from provlake.llm import sharding


def test_curve_visits_neighbours():
    for n, bits in ((2, 4), (3, 3), (4, 2)):
        cells = np.array(list(itertools.product(range(1 << bits), repeat=n)))
        place = sharding.hilbert_index(cells, bits)
        assert sorted(place) == list(range(len(cells)))
        assert (np.abs(np.diff(cells[np.argsort(place)], axis=0)).sum(axis=1) == 1).all()


def test_equal_counts_and_gapless_slots(docs, odd_rows):
    rows = odd_rows + [(100 + i, "same text" if i % 3 == 0 else "t" * (i % 97), "de" if i % 2 else None) for i in range(500)]
    table = docs(rows).withColumn("shard", F.lit("x")).withColumn("slot", F.lit(None).cast("int")).withColumn("size", F.lit(-1))
    got = sharding.shard_documents(table).collect()
    count = Counter(r["shard"] for r in got)
    assert len(got) == len(rows) and max(count.values()) - min(count.values()) <= 1 and set(count) == set(range(24))
    for s in range(24):
        assert sorted(r["slot"] for r in got if r["shard"] == s) == list(range(count[s]))
    want = Counter((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t, *_ in rows)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == want
    assert {(r["law"], r["grown_shard"]) for r in got} == {("rows", None)}
    assert sharding.shard_documents(docs([])).collect() == []
    assert sorted(r["shard"] for r in sharding.shard_documents(docs(rows[:3])).collect()) == [7, 15, 23]


def test_shards_prune_on_every_dimension(spark, tmp_path):
    rows = spark.range(8000).select(F.col("id").alias("doc_id"), (F.hash("id") % 1000).alias("a"), (F.hash("id", F.lit(1)) % 1000).alias("b"))
    sharded = sharding.hilbert_shards(rows, 16, ["a", "b"], ["doc_id"])
    sharding.write_shards(sharded, str(tmp_path / "shards"))
    bounds = spark.read.parquet(str(tmp_path / "shards")).groupBy("shard").agg(*[f(c).alias(f"{n}_{c}") for c in "ab" for n, f in (("low", F.min), ("high", F.max))]).collect()
    assert len(bounds) == 16
    for c in "ab":  # a filter on one value of either dimension leaves at most half of the shards
        assert sum(r[f"low_{c}"] <= 100 <= r[f"high_{c}"] for r in bounds) <= 8
