"""Language identification and toxicity: held-out accuracy, defined cases, and the trainer itself."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from provlake.llm import language, linear, toxicity
from tests.llm.conftest import babble

ALPHABET = {"aa": "abcde", "bb": "defgh", "cc": "ghéßa"}


def corpus(n):
    names = list(ALPHABET)
    return [(i, babble(1000 + i, 12, ALPHABET[names[i % 3]]).capitalize(), names[i % 3]) for i in range(n)]


def test_leader_finds_a_sparse_rule():
    draw = np.random.default_rng(1)
    rows = [(np.unique(draw.integers(0, 50, 8)), None) for _ in range(1500)]
    x = linear.examples([(i, np.ones(len(i))) for i, _ in rows])
    y = np.array([int(7 in i or 9 in i) for i, _ in rows])
    weight, bias = linear.train(x, y, 2, 60, l1=5.0, l2=0.01)
    p = linear.softmax(linear.margins(x, weight, bias))[:, 1]
    size = np.abs(weight[:, 1] - weight[:, 0])
    assert ((p > 0.5) == y).all() and set(np.argsort(-size)[:2]) == {7, 9}
    strict, _ = linear.train(x, y, 2, 60, l1=60.0, l2=0.01)
    assert set(np.flatnonzero(strict.any(axis=1))) >= {7, 9} and (strict == 0).sum() > (weight == 0).sum() + 20


def test_temperature_calibrates():
    draw = np.random.default_rng(2)
    margin = draw.standard_normal((4000, 3))
    p = linear.softmax(margin)
    y = np.array([draw.choice(3, p=q) for q in p])
    assert abs(linear.temperature(margin * 4, y) - 4) < 0.5 and linear.temperature(margin[:0], y[:0]) == 1.0


def test_held_out_accuracy_and_odd_rows(docs, odd_rows):
    table = docs(corpus(600) + [(5000 + i, t, None) for i, (_, t, *_) in enumerate(odd_rows)]).withColumn("score", F.lit("x")).withColumn("fold", F.lit(7)).withColumn("n", F.lit(1))
    got = {r["doc_id"]: r for r in language.predict_documents(table).collect()}
    assert len(got) == 600 + len(odd_rows)
    held = [i for i in range(600) if got[i]["held_out"]]
    assert 80 < len(held) < 160 and np.mean([got[i]["lang_pred"] == list(ALPHABET)[i % 3] for i in held]) >= 0.98
    assert [got[5000 + i]["lang_pred"] for i in (0, 1, 2)] == ["und"] * 3 and got[5003]["lang_pred"] in ALPHABET
    assert all(0 <= r["score"] <= 1 for r in got.values())


def test_predictions_ignore_labels_and_ids(docs):
    rows = corpus(300)
    table = docs(rows)
    other = docs([(100_000 - i, t, None) for i, t, _ in rows])
    seen = {r["doc_id"]: (r["lang_pred"], round(r["score"], 12)) for r in language.identify(table, table).collect()}
    again = {100_000 - r["doc_id"]: (r["lang_pred"], round(r["score"], 12)) for r in language.identify(table, other).collect()}
    assert seen == again
    extra = docs([*rows, *((5 * 10**6 + i, "zzz " * 50, "zz") for i in range(400))]).where("doc_id < 1000000 or crc32(cast(cast(doc_id as string) as binary)) % 5 = 0")
    assert {r["doc_id"]: r["lang_pred"] for r in language.identify(extra, table).collect()} == {i: v[0] for i, v in seen.items()}  # held-out rows teach nothing


def test_nothing_to_learn(docs):
    rows = docs([(1, "some text", None), (2, None, "en")])
    assert sorted((r["doc_id"], r["lang_pred"], r["score"]) for r in language.predict_documents(rows).collect()) == [(1, "und", 0.0), (2, "und", 0.0)]
    assert language.predict_documents(docs([])).collect() == []


@pytest.fixture(scope="module")
def toxic_corpus():
    draw, bad = random.Random(3), ["vilewordx", "nastyishq", "grimtermz"]
    rows, labels = [], []
    for i in range(1500):
        toxic, junk = draw.random() < 0.15, draw.random() < 0.2
        w = babble(i, draw.randint(5, 60)).split()
        if toxic:
            w.insert(draw.randrange(len(w)), draw.choice(bad))
        rows.append((i, " ".join([*w, *["buynow"] * junk])))
        labels.append((i, int(not junk), int(toxic)))
    return rows, labels


def test_chain_finds_planted_words(spark, docs, toxic_corpus, odd_rows):
    rows, labels = toxic_corpus
    known = spark.createDataFrame(labels[:1000] + [(1, None, 1), (10**7, 1, 1)], "doc_id bigint, quality int, toxic int")
    table = docs(rows + [(20_000, None), (20_001, ""), (20_002, babble(9, 50_000)), (20_003, babble(9, 50_000) + " vilewordx nastyishq")]).withColumn("p_toxic", F.lit("x")).withColumn("part", F.lit(0))
    got = {r["doc_id"]: r for r in toxicity.toxic_documents(table, known).collect()}
    assert len(got) == 1504
    unseen = range(1000, 1500)
    assert all(got[i]["toxic"] == bool(labels[i][2]) for i in unseen)
    assert all((got[i]["p_low_quality"] > 0.5) == (labels[i][1] == 0) for i in unseen)
    assert not any(got[i]["toxic"] for i in (20_000, 20_001, 20_002)) and got[20_003]["toxic"]


def test_no_labels_and_no_documents(spark, docs):
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert [(r["p_toxic"] < 1e-9, r["toxic"]) for r in toxicity.toxic_documents(docs([(1, "a b")]), none).collect()] == [(True, False)]
    assert toxicity.toxic_documents(docs([]), none).collect() == []


def test_later_models_see_out_of_fold_probabilities():
    draw = np.random.default_rng(4)
    rows = [np.unique(draw.integers(0, 40, 6)) for _ in range(900)]
    x = linear.examples([(r, np.ones(len(r))) for r in rows])
    first = np.array([int(3 in r) for r in rows])
    models = toxicity.fit_chain(x, np.stack([first, first], axis=1), np.arange(900) % 5)
    assert len(models) == 2 and models[1][0].shape[0] == toxicity.FEATURES + 1 and models[1][0][toxicity.FEATURES].any()
