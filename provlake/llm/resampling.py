"""Importance resampling toward a target distribution, on hashed word features.

Features are runs of one and two words, hashed by CRC-32 into buckets. Every bucket's gain is the
logarithm of how much more common it is in the target than in the corpus; a document's weight is
its mean gain; Gumbel noise on the weights and a cut after the highest scores draw documents
without replacement in proportion to their importance.

CRC-32 is linear over the bits of its input: the checksum is the exclusive or of one contribution
for each byte, which depends only on the byte and on its distance from the end, and of a constant
for the length. Both stand in tables; the checksums of all features of a batch are one gather and
one ``bitwise_xor.reduceat`` over their spans. Spans longer than the tables are folded by blocks:
the state so far acts like four bytes in front of the next block.

Bucket counts come from all documents, one row of buckets for each task, and are added by Spark;
the driver sees one number for each bucket. Ranks come from a written, range-partitioned table
of scores: place in the partition plus the rows before it, one count for each partition.

Defined cases: a text without words (null, empty) has no features and weight 0; a null doc_id is
hashed as ``7:`` and comes last among ties; rows that share a doc_id are each scored, equal ones
keep both their ranks; without target texts all gains come from the smoothing; an empty table
gives no rows; a text's memory is its word list and some bytes for each byte of a piece (a word
longer than a piece is worked on whole); only the named columns are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from provlake.llm.words import ALNUM, Words, pieces, words
from provlake.session import cut

BUCKETS, GRAM, LEAST_WORDS, PERCENT, SEED = 10_000, 2, 20, 25, 7
#: Bytes of text hashed at once.
PIECE = 1 << 18
#: Distances from the end that the contribution table knows.
REACH = 64
_POLYNOMIAL, _ONES = 0xEDB88320, np.uint32(0xFFFFFFFF)
_PLACE = (1 << 33) - 1  # monotonically_increasing_id: partition above, place in it below
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


@cache
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Contribution of each byte at each distance from the end (flat, 256 a distance), and the constant of each length."""
    near = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        near = (near >> np.uint32(1)) ^ np.where(near & np.uint32(1), np.uint32(_POLYNOMIAL), np.uint32(0))
    table = np.zeros((REACH, 256), np.uint32)
    table[0] = near
    for d in range(1, REACH):
        table[d] = near[table[d - 1] & np.uint32(0xFF)] ^ (table[d - 1] >> np.uint32(8))
    length = np.zeros(REACH + 1, np.uint32)
    state = _ONES
    for n in range(1, REACH + 1):
        state = near[state & np.uint32(0xFF)] ^ (state >> np.uint32(8))
        length[n] = state ^ _ONES
    return table.ravel(), length


def _shifted(state: np.ndarray, n: np.ndarray) -> np.ndarray:
    """States after n more zero bytes, 4 <= n <= REACH: the state is four bytes in front of n - 4 others."""
    table, _ = _tables()
    out = np.zeros(len(state), np.uint32)
    for j in range(4):
        out ^= table[((n - 1 - j) << 8) + ((state >> np.uint32(8 * j)) & np.uint32(0xFF)).astype(np.int64)]
    return out


def _folded(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The exclusive or of the contributions of each span's bytes; spans of 1 to REACH bytes."""
    table, _ = _tables()
    size = end - start
    first = np.cumsum(size) - size
    at = np.repeat(start - first, size) + np.arange(size.sum())
    far = np.repeat(end - 1, size) - at
    return np.bitwise_xor.reduceat(table[(far << 8) + data[at]], first)


def span_crc32(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """CRC-32 of the bytes of each span, unsigned."""
    _, length = _tables()
    size = end - start
    out = np.zeros(len(start), np.uint32)
    short = np.flatnonzero((size > 0) & (size <= REACH))
    if len(short):
        out[short] = _folded(data, start[short], end[short]) ^ length[size[short]]
    long = np.flatnonzero(size > REACH)
    if len(long):
        at, state = start[long].copy(), np.full(len(long), _ONES)
        while len(long):
            left = end[long] - at
            step = np.where((left > REACH) & (left < REACH + 4), left - 4, np.minimum(left, REACH))  # no block of under 4 bytes
            state = _shifted(state, step) ^ _folded(data, at, at + step)
            at = at + step
            done = left == step
            out[long[done]] = state[done] ^ _ONES
            long, at, state = long[~done], at[~done], state[~done]
    return out


def _said(found: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The words lower-cased with a blank after each, and where they begin and end."""
    size = found.end - found.start
    end = np.cumsum(size + 1) - 1
    start = end - size
    out = np.full(int(end[-1]) + 1 if len(end) else 0, 0x20, np.uint8)
    at = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    out[np.repeat(start, size) + at] = _LOWER[found.data[np.repeat(found.start, size) + at]]
    return out, start, end


def features(found: Words, buckets: int = BUCKETS, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and row of every run of 1 to ``gram`` words of one text."""
    data, start, end = _said(found)
    bucket, row = [], []
    for k in range(1, gram + 1):
        n = max(0, len(start) - k + 1)
        whole = np.flatnonzero(found.row[:n] == found.row[k - 1:][:n])
        bucket.append(span_crc32(data, start[whole], end[whole + k - 1]) % np.uint32(buckets))
        row.append(found.row[whole])
    return np.concatenate(bucket).astype(np.int64), np.concatenate(row)


def _parts(found: Words, gram: int) -> Iterator[Words]:
    """The words in runs of bounded bytes; the first words of a run repeat the last gram - 1 of the run before."""
    at, n = 0, len(found.start)
    while at < n:
        to = max(at + gram, int(np.searchsorted(found.start, found.start[at] + PIECE)))
        yield Words(found.data, *(x[at:to] for x in found[1:]))
        if to >= n:
            break
        at = to - gram + 1


def _feature_rows(found: Words, buckets: int, gram: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Buckets and rows of all features, each once."""
    for i, part in enumerate(_parts(found, gram)):
        bucket, row = features(part, buckets, gram)
        if i and gram > 1:  # runs that lie within the repeated words were given before
            again = _within(part, gram)
            bucket, row = bucket[~again], row[~again]
        yield bucket, row


def _within(part: Words, gram: int) -> np.ndarray:
    """Which features of a part use only its first gram - 1 words."""
    out = []
    for k in range(1, gram + 1):
        n = max(0, len(part.start) - k + 1)
        whole = np.flatnonzero(part.row[:n] == part.row[k - 1:][:n])
        out.append(whole + k <= gram - 1)
    return np.concatenate(out)


def _bucket_counts(buckets: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, _, data, offsets in pieces(batch, size=PIECE):
                for bucket, _ in _feature_rows(words(data, offsets, ALNUM), buckets, gram):
                    total += np.bincount(bucket, minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(total[used])], names=["bucket", "n"])
    return run


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS, gram: int = GRAM) -> DataFrame:
    """``bucket`` and ``n``, how many features of all texts it holds; buckets without features are left out."""
    return texts.select("text").mapInArrow(_bucket_counts(buckets, gram), "bucket int, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln((t + 1)(S + buckets) / ((s + 1)(T + buckets)))) of every bucket, in doubles."""
    all_s, all_t, n = int(source.sum()), int(target.sum()), len(source)
    return np.array([math.floor(1000 * math.log(float((t + 1) * (all_s + n)) / float((s + 1) * (all_t + n)))) for s, t in zip(source.tolist(), target.tolist(), strict=True)], np.int64)


def _scored(shared, buckets: int, gram: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = shared.value
        for batch in batches:
            ids = batch.column(0).to_pylist()
            n_words, n_features, total = (np.zeros(len(batch), np.int64) for _ in range(3))
            for at, to, data, offsets in pieces(batch, size=PIECE):
                found = words(data, offsets, ALNUM)
                n_words[at:to] = np.bincount(found.row, minlength=to - at)
                for bucket, row in _feature_rows(found, buckets, gram):
                    n_features[at:to] += np.bincount(row, minlength=to - at)
                    order = np.argsort(row, kind="stable")
                    rows, first = np.unique(row[order], return_index=True)
                    if len(rows):
                        total[at + rows] += np.add.reduceat(gain[bucket[order]], first)
            weight = total // np.maximum(n_features, 1)
            noise = np.zeros(len(batch), np.int64)
            for i, doc in enumerate(ids):
                h = int(sha256(f"{seed}:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
                noise[i] = math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, (n_words, n_features, weight, weight + noise))],
                                             names=["doc_id", "n_words", "n_features", "weight", "score"])
    return run


def score_documents(documents: DataFrame, target: DataFrame, buckets: int = BUCKETS, gram: int = GRAM, seed: int = SEED) -> DataFrame:
    """doc_id, n_words, n_features, weight and score of every document row."""
    both = bucket_counts(documents, buckets, gram).withColumn("side", F.lit(0)).union(bucket_counts(target, buckets, gram).withColumn("side", F.lit(1)))
    count = np.zeros((2, buckets), np.int64)
    for r in both.collect():  # at most two rows a bucket
        count[r["side"], r["bucket"]] = r["n"]
    shared = documents.sparkSession.sparkContext.broadcast(gains(count[0], count[1]))
    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", "text").mapInArrow(_scored(shared, buckets, gram, seed), f"doc_id {kind}, n_words bigint, n_features bigint, weight bigint, score bigint")


def draw(scored: DataFrame, least_words: int = LEAST_WORDS, percent: int = PERCENT) -> DataFrame:
    """The rows with ``rank`` from 1 for the drawn ones: the highest scores of those long enough, floor(percent of them / 100) in number."""
    order = [F.col("fits").desc(), F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("weight"), F.col("n_features")]
    parts = int(scored.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = cut(scored.withColumn("fits", F.col("n_words") >= least_words), "scores")
    placed = rows.repartitionByRange(parts, *order, F.rand(SEED)).sortWithinPartitions(*order)  # equal rows may be many
    placed = cut(placed.withColumn("__at", F.monotonically_increasing_id()), "ranks")
    part = F.shiftright("__at", 33)
    counts = placed.groupBy(part.alias("__part")).agg(F.count("*").alias("n"), F.count_if("fits").alias("__n_fit"))
    before = counts.select("__part", (F.sum("n").over(Window.orderBy("__part")) - F.col("n")).alias("__before"), F.sum("__n_fit").over(Window.partitionBy()).alias("__fit"))
    rank = F.col("__before") + F.col("__at").bitwiseAND(_PLACE) + 1
    return placed.withColumn("__part", part).join(F.broadcast(before), "__part").withColumn(  # one row for each partition
        "rank", F.when(F.col("fits") & (rank <= F.expr(f"__fit * {percent} div 100")), rank)).drop("__at", "__part", "__before", "__fit", "fits")


def resample(documents: DataFrame, target: DataFrame) -> DataFrame:
    """doc_id, n_features, weight, score and rank (null: not drawn) of every document row."""
    return draw(score_documents(documents, target)).select("doc_id", "n_features", "weight", "score", "rank")
