"""Benchmark decontamination by a prefix-filtered set join.

An item is cut into windows of ``window`` consecutive words (a shorter item is one window of
all its words). A window is a set of shingles of up to three words; a document window contains
it only if it holds every shingle, so one necessary shingle is enough to find all candidates.
Shingles are ordered by how many documents hold them and the rarest of each window is joined.
A candidate must fit its document (positional bound) and the document must be as long as the
window (length bound); words are then compared one by one over the item-sized window.

The windows go to the tasks in blocks of at most ``BLOCK`` windows, which bounds what is
broadcast whatever the size of the benchmark; more blocks mean more passes over the documents.

Defined cases: null and empty texts have no words and no hits; an item without words is in no
document; repeated documents and repeated items each keep their rows; null ids stay null (an
item with a null id marks words but is not listed); only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from provlake.llm.words import ALNUM, grams, pieces, word_text, words
from provlake.session import cut

WINDOW, SHINGLE = 10, 3
#: Windows in one broadcast: at most about 200 bytes each.
BLOCK = 100_000
_FOUND = "array<struct<start:bigint,end:bigint>>"
_SHINGLES = "item_id string, k int, words string, window bigint, shingle bigint, m int, offset int"


def _item_windows(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            for at, to, data, offsets in pieces(batch):
                got = words(data, offsets, ALNUM)
                rows = []
                for i, row in enumerate(range(at, to)):
                    lo, hi = np.searchsorted(got.row, [i, i + 1])
                    k = min(size, hi - lo)
                    if k == 0:
                        continue
                    m = min(k, SHINGLE)
                    value, _ = grams(got.hash[lo:hi], got.row[lo:hi], m)
                    whole, _ = grams(got.hash[lo:hi], got.row[lo:hi], k)
                    for w in range(hi - lo - k + 1):
                        said = word_text(got, lo + w, k).decode("utf-8", "replace")
                        rows += [(ids[row].as_py(), k, said, int(whole[w].view(np.int64)), int(value[w + j].view(np.int64)), m, j) for j in range(k - m + 1)]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), _ITEM_TYPES, strict=True)],
                                                     names=[x.split()[0] for x in _SHINGLES.split(", ")])
    return run


_ITEM_TYPES = [pa.string(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.int32()]


class _Filter:
    """Sorted keys behind a bit table, for quick tests of many hashes."""

    def __init__(self, keys: np.ndarray):
        self.keys = np.unique(keys)
        size = 1 << max(10, int(16 * len(self.keys)).bit_length())
        self.mask, self.bits = np.uint64(size - 1), np.zeros(size, bool)
        self.bits[(self.keys & self.mask).astype(np.int64)] = True

    def hits(self, value: np.ndarray) -> np.ndarray:
        maybe = np.flatnonzero(self.bits[(value & self.mask).astype(np.int64)])
        if not len(maybe) or not len(self.keys):
            return maybe[:0]
        at = np.minimum(np.searchsorted(self.keys, value[maybe]), len(self.keys) - 1)
        return maybe[self.keys[at] == value[maybe]]


def _count(shared, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In how many texts each shingle of the block occurs."""
    by_m = {m: _Filter(v) for m, v in shared.value.items()}
    total: dict[int, int] = {}
    for batch in batches:
        for _, _, data, offsets in pieces(batch):
            got = words(data, offsets, ALNUM)
            for m, keys in by_m.items():
                value, first = grams(got.hash, got.row, m)
                hit = keys.hits(value)
                pairs = np.unique(np.stack([value[hit], got.row[first[hit]].astype(np.uint64)]), axis=1)
                for v, n in zip(*np.unique(pairs[0], return_counts=True), strict=True):
                    total[int(v)] = total.get(int(v), 0) + int(n)
    if total:
        yield pa.RecordBatch.from_arrays([pa.array(np.array(list(total), np.uint64).view(np.int64)), pa.array(list(total.values()), pa.int64())], names=["shingle", "n"])


def _merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for lo, hi in sorted(spans):
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], hi))
        else:
            out.append((lo, hi))
    return out


def _search(shared, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds to every row what the block's windows hit: word spans and item ids."""
    block = shared.value
    index: dict[int, dict[int, list]] = {}
    for m, shingle, offset, k, window, said, items in block:
        index.setdefault(m, {}).setdefault(shingle, []).append((offset, k, window, said, items))
    by_m = {m: _Filter(np.array(list(x), np.uint64)) for m, x in index.items()}
    for batch in batches:
        spans = batch.column(batch.schema.get_field_index("spans")).to_pylist()
        found = batch.column(batch.schema.get_field_index("items")).to_pylist()
        count = np.zeros(len(batch), np.int64)
        for at, to, data, offsets in pieces(batch):
            got = words(data, offsets, ALNUM)
            begin = np.searchsorted(got.row, np.arange(to - at + 1))
            count[at:to] = np.diff(begin)
            whole: dict[int, dict[int, int]] = {}
            near: dict[int, list] = {}
            for m, keys in by_m.items():
                value, first = grams(got.hash, got.row, m)
                hit = keys.hits(value)
                for v, pos in zip(value[hit].tolist(), first[hit].tolist(), strict=True):
                    row = int(got.row[pos])
                    for offset, k, window, said, items in index[m][v]:
                        start = pos - offset
                        if start >= begin[row] and start + k <= begin[row + 1]:
                            near.setdefault(k, []).append((start, window, said, items, row))
            for k, some in near.items():
                starts = np.unique(np.array([x[0] for x in some]))
                take = (starts[:, None] + np.arange(k)).ravel()
                value, _ = grams(got.hash[take], np.repeat(np.arange(len(starts)), k), k)
                whole[k] = dict(zip(starts.tolist(), value.tolist(), strict=True))
                for start, window, said, items, row in some:
                    if whole[k][start] == window and word_text(got, start, k).decode("utf-8", "replace") == said:
                        lo = int(start - begin[row])
                        spans[at + row] = [*(spans[at + row] or []), {"start": lo, "end": lo + k}]
                        found[at + row] = [*(found[at + row] or []), *items]
        merged = [[{"start": a, "end": b} for a, b in _merge([(x["start"], x["end"]) for x in row or []])] for row in spans]
        columns = {"n_words": pa.array(count), "spans": pa.array(merged, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                   "items": pa.array([sorted(set(x or [])) for x in found], pa.list_(pa.string()))}
        yield pa.RecordBatch.from_arrays([columns.get(n, batch.column(i)) for i, n in enumerate(batch.schema.names)], names=batch.schema.names)


def _unsigned(rows, name: str) -> np.ndarray:
    return np.array([r[name] for r in rows], np.int64).view(np.uint64)


def item_hits(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, carry: list[str] | None = None) -> DataFrame:
    """Each document row with n_words, spans of hit words (disjoint, in order) and the items found.

    ``carry`` names further columns of the documents to keep.
    """
    spark, keep = documents.sparkSession, carry or ["doc_id"]
    shingles = cut(benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text").mapInArrow(_item_windows(window), _SHINGLES), "windows")
    n_windows = shingles.where("offset = 0").select("window", "k").distinct().count()
    blocks = max(1, -(-n_windows // BLOCK))
    docs = documents.select(*keep, *([] if "text" in keep else ["text"])).select(
        *[F.col(c).alias(f"kept_{i}") for i, c in enumerate(keep)], F.col("text").alias("text"),
        F.lit(0).cast("bigint").alias("n_words"), F.array().cast(_FOUND).alias("spans"), F.array().cast("array<string>").alias("items"))
    for b in range(blocks):
        if b:
            docs = cut(docs, "decontaminated")
        mine = shingles.where(F.pmod(F.xxhash64("window", "k"), F.lit(blocks)) == b)
        by_m: dict[int, list] = {}
        for r in mine.select("m", "shingle").distinct().toLocalIterator():  # at most BLOCK windows of 8 shingles, on average
            by_m.setdefault(r["m"], []).append(r["shingle"])
        to_count = spark.sparkContext.broadcast({m: np.array(v, np.int64).view(np.uint64) for m, v in by_m.items()})
        rarity = documents.select("text").mapInArrow(lambda it, s=to_count: _count(s, it), "shingle bigint, n bigint").groupBy("shingle").agg(F.sum("n").alias("n"))
        ranked = mine.join(rarity, "shingle", "left").groupBy("window", "k").agg(
            F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "shingle", "offset", "m")).alias("rare"), F.min("words").alias("words"),
            F.collect_set("item_id").alias("items"))
        block = [(r["rare"]["m"], r["rare"]["shingle"] % (1 << 64), r["rare"]["offset"], r["k"], r["window"] % (1 << 64), r["words"], r["items"])
                 for r in ranked.where("rare.n > 0").toLocalIterator()]
        shared = spark.sparkContext.broadcast(block)
        docs = docs.mapInArrow(lambda it, s=shared: _search(s, it), docs.schema)
    return docs.select(*[F.col(f"kept_{i}").alias(c) for i, c in enumerate(keep)], *([] if "n_words" in keep else ["n_words"]), "spans", "items")


def hit_words() -> Column:
    return F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, x: n + x["end"] - x["start"])


def decontaminate(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated for every document row."""
    found = item_hits(documents, benchmark)
    return found.select("doc_id", "n_words", hit_words().alias("n_hit"), F.size("items").cast("bigint").alias("n_items"),
                        F.sha2(F.concat_ws(",", F.array_sort("items")), 256).alias("items_sha256"),
                        (hit_words() > 0).alias("contaminated"))
