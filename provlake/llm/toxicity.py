"""Toxicity by a chain of linear classifiers.

The categories are predicted one after the other. Each model is a sparse logistic regression on
the different words of a text and their beginnings (hashed), and from the second on also on the probabilities of the
categories before it. In training those probabilities are out-of-fold: a model that has not seen
the document gives them, so a later model meets the same kind of input as in prediction.

The chain is fitted on at most ``SAMPLE`` labelled documents with different texts, drawn by a
hash of the doc_id; prediction reads every word of every text.

Defined cases: null and empty texts have no words and get the chain's base rates; documents
labelled twice count once for each label row; without any label all probabilities are 0; only
the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from provlake.llm.linear import Examples, examples, margins, softmax, train
from provlake.llm.words import ALNUM, part_hashes, pieces, words
from provlake.session import cut

FEATURES, SAMPLE, FOLDS = 1 << 18, 10_000, 5
CHAIN = ("low_quality", "toxic")
#: Bytes of a word's beginning that are features of their own.
PREFIXES = (4, 5, 6, 7, 8)
_L1, _L2 = 6.0, 0.01


def word_features(data: np.ndarray, offsets: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Hashed different words of each text, and the beginnings of longer ones."""
    found = words(data, offsets, ALNUM)
    hashed = [found.hash, *(part_hashes(found, found.start, np.minimum(found.end, found.start + k)) + np.uint64(k) for k in PREFIXES)]
    index = np.stack([(h >> np.uint64(46)).astype(np.int64) for h in hashed], axis=1)
    at = np.searchsorted(found.row, np.arange(len(offsets)))
    out = []
    for a, b in zip(at, at[1:], strict=False):
        used = np.unique(index[a:b])
        out.append((used, np.ones(len(used))))
    return out


def _with(x: Examples, before: list[np.ndarray]) -> Examples:
    """The examples with one more feature for each earlier category."""
    k, n = len(before), len(x.start) - 1
    if not k:
        return x
    at = np.repeat(x.start[1:], k)
    index = np.insert(x.index, at, np.tile(FEATURES + np.arange(k), n))
    return Examples(index, np.insert(x.value, at, np.stack(before, axis=1).ravel()), x.start + k * np.arange(n + 1))


def _probability(x: Examples, weight: np.ndarray, bias: np.ndarray) -> np.ndarray:
    return softmax(margins(x, weight, bias))[:, 1]


def fit_chain(x: Examples, labels: np.ndarray, part: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """A model for each column of ``labels``; ``part`` deals the rows into folds."""
    models, before = [], []
    for j in range(labels.shape[1]):
        own = _with(x, before)
        size = FEATURES + len(before)
        models.append(train(own, labels[:, j], 2, size, _L1, _L2))
        if j + 1 < labels.shape[1]:
            apart = np.zeros(len(labels))
            for f in range(FOLDS):
                inside, outside = np.flatnonzero(part != f), np.flatnonzero(part == f)
                if len(outside):
                    apart[outside] = _probability(own.take(outside), *train(own.take(inside), labels[inside, j], 2, size, _L1, _L2)) if len(inside) else 0.5
            before.append(apart)
    return models


def _fitted(chain: tuple[str, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows, labels, part = [], [], []
    for batch in batches:
        for _, _, data, offsets in pieces(batch):
            rows += word_features(data, offsets)
        labels += list(zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in chain), strict=True))
        part += batch.column(batch.schema.get_field_index("part")).to_pylist()
    if not rows:
        return
    for j, (weight, bias) in enumerate(fit_chain(examples(rows), np.array(labels, np.int64), np.array(part))):
        margin, at = weight[:, 1] - weight[:, 0], np.flatnonzero(weight.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at) + 1, j)), pa.array(np.append(at, -1)), pa.array(np.append(margin[at], bias[1] - bias[0]))], names=["step", "feature", "weight"])


def _predicted(shared, chain: tuple[str, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    models = shared.value
    for batch in batches:
        out: list[list[np.ndarray]] = [[] for _ in chain]
        for _, _, data, offsets in pieces(batch):
            x, before = examples(word_features(data, offsets)), []
            for j, model in enumerate(models):
                index, weight, bias = model
                full = np.zeros((FEATURES + j, 1))
                full[index, 0] = weight
                before.append(1 / (1 + np.exp(-margins(_with(x, before), full, np.array([bias]))[:, 0])))
                out[j].append(before[-1])
        p = [pa.array(np.concatenate(o) if o else np.zeros(len(batch))) for o in out]
        yield pa.RecordBatch.from_arrays([batch.column(0), *p], names=["doc_id", *(f"p_{c}" for c in chain)])


def train_chain(documents: DataFrame, labels: DataFrame, chain: tuple[str, ...] = CHAIN, sample: int = SAMPLE) -> list:
    """``labels`` has doc_id and a 0/1 column for each category; rows with a null in one are left out."""
    kept = labels.select("doc_id", *chain).where(" and ".join(f"{c} is not null" for c in chain)).join(documents.select("doc_id"), "doc_id", "left_semi")
    drawn = kept.orderBy(F.xxhash64("doc_id"), *chain).limit(sample)
    rows = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(drawn), "doc_id")  # ``sample`` rows at most
    rows = rows.groupBy(F.xxhash64("text").alias("same")).agg(F.min_by(F.struct("text", *chain), "doc_id").alias("r")).select(
        "r.*", F.pmod(F.hash("same"), F.lit(FOLDS)).alias("part"))
    picked = cut(rows, "toxicity-sample").repartition(1).sortWithinPartitions(F.xxhash64("text"))
    model = picked.mapInArrow(partial(_fitted, chain), "step bigint, feature bigint, weight double").collect()  # at most FEATURES rows for each category
    out = []
    for j in range(len(chain)):
        own = [r for r in model if r["step"] == j]
        bias = next((r["weight"] for r in own if r["feature"] == -1), -50.0)
        own = [r for r in own if r["feature"] >= 0]
        out.append((np.array([r["feature"] for r in own], np.int64), np.array([r["weight"] for r in own], np.float64), bias))
    return out


def score_texts(texts: DataFrame, models: list, chain: tuple[str, ...] = CHAIN) -> DataFrame:
    """doc_id and p_<category> of every row."""
    shared = texts.sparkSession.sparkContext.broadcast(models)
    schema = f"doc_id {dict(texts.dtypes)['doc_id']}, " + ", ".join(f"p_{c} double" for c in chain)
    return texts.select("doc_id", "text").mapInArrow(partial(_predicted, shared, chain), schema)


def toxic_documents(documents: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """doc_id, p_low_quality, p_toxic and toxic of every document."""
    judged = labels.select("doc_id", (1 - F.col("quality")).alias("low_quality"), "toxic")
    return score_texts(documents, train_chain(documents, judged)).withColumn("toxic", F.col("p_toxic") >= threshold)
