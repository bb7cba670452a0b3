"""Language identification by sparse multinomial logistic regression on character n-grams.

Features are TF-IDF weights of hashed runs of one to three characters; letters are lower-cased
and everything else counts as a blank. The model is trained with follow-the-regularised-leader
and elastic-net penalties on at most ``SAMPLE`` documents, spread evenly over the stated
languages by a hash of the doc_id; document frequencies come from all documents that may be
learned from. One in five of the sampled documents is kept apart to fit the temperature that
calibrates the scores.

Learned from: text and non-null lang of documents whose crc32(doc_id) mod 5 is not 0.

Defined cases: a text that is null, empty or without letters is ``und`` with score 1; with
nothing to learn from every text is ``und`` with score 0; repeated rows each give a row; only
the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from provlake.llm.linear import examples, margins, softmax, temperature, train
from provlake.llm.words import pieces
from provlake.session import cut

FEATURES, SIZES, SAMPLE = 1 << 15, (1, 2, 3), 8_000
UNKNOWN = "und"
_TURN = np.uint64(0x9E3779B97F4A7C15)


@cache
def _folded() -> np.ndarray:
    """The lower-case letter of every code point, 32 for what is no letter."""
    out = np.full(0x110000, 32, np.uint32)
    for c in range(0x110000):
        if not 0xD800 <= c < 0xE000 and chr(c).isalpha():
            low = chr(c).lower()
            out[c] = ord(low) if len(low) == 1 else c
    return out


def char_features(data: np.ndarray, offsets: np.ndarray) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray]:
    """(feature, count) arrays of each text, and which texts have a letter."""
    points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    first = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=first[1:])
    at = first[offsets]
    char = _folded()[points]
    total = np.zeros(len(char) + 1, np.int64)
    np.cumsum(char != 32, out=total[1:])
    value = char.astype(np.uint64)
    hashed = []
    for n in SIZES:
        mixed = np.full(max(0, len(char) - n + 1), n, np.uint64)
        for j in range(n):
            mixed = (mixed * np.uint64(0x100000001B3) ^ value[j:len(value) - n + 1 + j]) * _TURN
        hashed.append((mixed >> np.uint64(64 - 15)).astype(np.int64))
    out = []
    for a, b in zip(at, at[1:], strict=False):
        count = np.zeros(FEATURES, np.int64)
        for n, h in zip(SIZES, hashed, strict=True):
            if b - a >= n:
                count += np.bincount(h[a:b - n + 1], minlength=FEATURES)
        used = np.flatnonzero(count)
        out.append((used, count[used]))
    return out, total[at[1:]] > total[at[:-1]]


def weighted(used: np.ndarray, count: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    value = (1 + np.log(count)) * idf[used]
    norm = np.sqrt((value ** 2).sum())
    return used, value / norm if norm > 0 else value


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total, n = np.zeros(FEATURES, np.int64), 0
    for batch in batches:
        for _, _, data, offsets in pieces(batch):
            found, lettered = char_features(data, offsets)
            for (used, _), ok in zip(found, lettered, strict=True):
                if ok:
                    total[used] += 1
                    n += 1
    used = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(np.append(used, -1)), pa.array(np.append(total[used], n))], names=["feature", "n"])


def _fitted(idf: np.ndarray, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Trains on the sample: rows of (feature, class, weight); feature -1 is the bias, -2 the temperature."""
    rows, langs, apart = [], [], []
    for batch in batches:
        named = dict(zip(batch.schema.names, batch.columns, strict=True))
        for at, to, data, offsets in pieces(batch):
            found, lettered = char_features(data, offsets)
            for i, ((used, count), ok) in enumerate(zip(found, lettered, strict=True), at):
                if ok and i < to:
                    rows.append(weighted(used, count, idf))
                    langs.append(named["lang"][i].as_py())
                    apart.append(named["fold"][i].as_py() == 1)
    if not rows:
        return
    names = sorted(set(langs))
    y, apart_now = np.array([names.index(x) for x in langs]), np.array(apart)
    x = examples(rows)
    if apart_now.all():
        apart_now[:] = False
    fit, held = np.flatnonzero(~apart_now), np.flatnonzero(apart_now)
    weight, bias = train(x.take(fit), y[fit], len(names), FEATURES, l1=0.02, l2=0.001)
    t = temperature(margins(x.take(held), weight, bias), y[held])
    at, c = np.nonzero(weight)
    feature = np.concatenate([at, np.full(len(names), -1), [-2]])
    label = [*(names[i] for i in c), *names, ""]
    yield pa.RecordBatch.from_arrays([pa.array(feature), pa.array(label), pa.array(np.concatenate([weight[at, c], bias, [t]]))], names=["feature", "lang", "weight"])


def _predicted(shared, idf: np.ndarray, with_text: bool, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names, weight, bias, t = shared.value
    for batch in batches:
        langs, scores = [], []
        for _, _, data, offsets in pieces(batch):
            found, lettered = char_features(data, offsets)
            if names:
                p = softmax(margins(examples([weighted(u, c, idf) for u, c in found]), weight, bias) / t)
                best = p.argmax(axis=1)
                langs += [names[b] if ok else UNKNOWN for b, ok in zip(best, lettered, strict=True)]
                scores += [float(p[i, b]) if ok else 1.0 for i, (b, ok) in enumerate(zip(best, lettered, strict=True))]
            else:
                langs += [UNKNOWN] * len(found)
                scores += [0.0] * len(found)
        kept = batch if with_text else batch.drop_columns(["text"])
        yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=[*kept.schema.names, "lang_pred", "score"])


def fold(doc_id: str = "doc_id"):
    return F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(5))


def train_languages(documents: DataFrame, sample: int = SAMPLE) -> tuple:
    """Language names, weights, biases and temperature, and the inverse document frequencies."""
    learn = documents.select("doc_id", "text", "lang", fold().alias("fold")).where("fold <> 0 and lang is not null and text is not null")
    counts = learn.select("text").mapInArrow(_frequencies, "feature bigint, n bigint").groupBy("feature").agg(F.sum("n").alias("n"))
    seen = {r["feature"]: r["n"] for r in counts.collect()}  # at most FEATURES + 1 rows
    df = np.array([seen.get(i, 0) for i in range(FEATURES)])
    idf = np.log((1 + seen.get(-1, 0)) / (1 + df)) + 1
    share = learn.groupBy("lang").agg(F.count("*").alias("n"))
    share = share.withColumn("n_langs", F.expr("count(*) over ()")).withColumn("quota", F.greatest(F.lit(1), F.lit(sample) / F.col("n_langs")))
    drawn = learn.select("doc_id", "lang").join(share, "lang").where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < F.col("quota") / F.col("n") * (1 << 30))
    drawn = drawn.select("doc_id").distinct().orderBy(F.xxhash64("doc_id")).limit(sample)
    picked = cut(learn.join(F.broadcast(drawn), "doc_id"), "language-sample").repartition(1)
    model = picked.mapInArrow(partial(_fitted, idf), "feature bigint, lang string, weight double").collect()  # at most FEATURES rows for each language
    names = sorted({r["lang"] for r in model if r["feature"] == -1})
    weight, bias, t = np.zeros((FEATURES, len(names))), np.zeros(len(names)), 1.0
    for r in model:
        if r["feature"] == -2:
            t = r["weight"]
        elif r["feature"] == -1:
            bias[names.index(r["lang"])] = r["weight"]
        else:
            weight[r["feature"], names.index(r["lang"])] = r["weight"]
    return (names, weight, bias, t), idf


def identify(documents: DataFrame, texts: DataFrame, keep: tuple[str, ...] = ("doc_id",), with_text: bool = False) -> DataFrame:
    """Learns from ``documents`` and adds lang_pred and score to the named columns of every row of ``texts``."""
    model, idf = train_languages(documents)
    shared = documents.sparkSession.sparkContext.broadcast(model)  # FEATURES weights for each language
    own = texts.select(*[F.col(c).alias(f"__k{i}") for i, c in enumerate(keep)], "text")
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in own.schema if with_text or f.name != "text") + ", lang_pred string, score double"
    done = own.mapInArrow(partial(_predicted, shared, idf, with_text), schema)
    return done.select(*[F.col(f"__k{i}").alias(c) for i, c in enumerate(keep)], *["text"] * with_text, "lang_pred", "score")


def predict_documents(documents: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every document."""
    return identify(documents, documents).select("doc_id", (fold() == 0).alias("held_out"), "lang_pred", "score")
