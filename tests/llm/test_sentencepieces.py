import random
from hashlib import sha256

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from provlake.llm import sentencepieces as s

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def own():
    with open(PATH, "rb") as f:
        return s.model(f.read())


def test_every_code_point(library, own):
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for i in range(0, len(points), 4000):
        text = "".join(f" {chr(c)}b1{chr(c)}{chr(c)}\n" for c in points[i:i + 4000])
        ids = library.encode(text)
        assert own.encode(text) == ids and own.decode(ids) == library.decode(ids)


def test_mixed_texts(library, own):
    draw = random.Random(5)
    parts = [" ", "  ", " " * 7, "\n", "\t", "▁", "▁▁", "the", "ing", "s", "th", "1", "é", "中", "😀", "\x00", " ", "<s>", "</s>", "<unk>", "<0x41>", "ー", "ａ"]
    texts = ["".join(draw.choice(parts) for _ in range(draw.randrange(40))) for _ in range(3000)]
    texts += ["", " ", "▁", " " * 5000 + "x", " " * 33, "x" * 30_000, "ab" * 5000, "中" * 3000, "the" * 4000]
    for text in texts:
        ids = library.encode(text)
        assert own.encode(text) == ids, text[:100]
        assert own.decode(ids) == library.decode(ids), text[:100]


def test_decoding_of_any_ids(library, own):
    draw = random.Random(6)
    some = [*range(300), 28705, 264, 287, 28744]
    for _ in range(3000):
        ids = [draw.choice(some) if draw.random() < 0.8 else draw.randrange(32_000) for _ in range(draw.randrange(12))]
        assert own.decode(ids) == library.decode(ids), ids


def test_equal_hashes_of_different_chunks(library, own, monkeypatch):
    text = "one two three one two four"
    monkeypatch.setattr(s, "span_hashes", lambda data, start, end: (end - start).astype("uint64"))
    assert own.encode(text) == library.encode(text)


def test_only_fitting_models():
    with pytest.raises(ValueError):
        s.Model(b"")


@pytest.mark.parametrize("table", [0, 40, s.TABLE])
def test_rows(spark, docs, odd_rows, library, table):
    rows = [*odd_rows, (30, "▁a ▁ b"), (31, "a\x00b"), (32, " lead and trail "), (33, "x y" * 9000)]
    source = docs(rows).withColumn("ids", F.lit("x")).withColumn("n_tokens", F.lit(None).cast("int")).withColumn("chunk", F.lit(1))
    got = s.encode_documents(source, PATH, table=table).collect()
    want = []
    for doc, text in rows:
        ids = library.encode(text or "")
        want.append((doc, len(ids), sha256(",".join(map(str, ids)).encode()).hexdigest(), sha256(library.decode(ids).encode()).hexdigest()))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_ids_and_back(spark, docs, odd_rows, library):
    coded = s.encode_documents(docs(odd_rows), PATH, ids=True)
    back = s.decode_ids(coded.unionByName(coded.limit(1).withColumn("ids", F.lit(None).cast("array<int>")).withColumn("doc_id", F.lit(-1))), PATH)
    assert sorted(((r["doc_id"], r["text"]) for r in back.collect()), key=str) == sorted([*((d, t or "") for d, t in odd_rows), (-1, "")], key=str)
    assert s.encode_documents(docs([]), PATH).collect() == []


def test_counts_and_table(spark, docs):
    counts = s.chunk_counts(docs([(1, "a b a  b"), (2, "b a"), (3, None), (4, "a " + "x" * 80)]))
    assert {(bytes(r["chunk"]), r["n"]) for r in counts.collect()} == {(b" a", 4), (b" b", 2), (b"  b", 1)}
    with open(PATH, "rb") as f:
        shared = spark.sparkContext.broadcast(f.read())
    assert [bytes(r["chunk"]) for r in s.frequent_chunks(counts, shared, 1).collect()] == [b" a"]
    assert s.frequent_chunks(counts, shared, 0).count() == 0 and s.frequent_chunks(counts, shared, 9).count() == 3
