import random
from hashlib import sha256

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from provlake.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(PATH)
    t.no_truncation()
    t.no_padding()
    return t


@pytest.fixture(scope="module")
def own():
    with open(PATH, encoding="utf-8") as f:
        return bpe.vocabulary(f.read())


def test_every_code_point(library, own):
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for i in range(0, len(points), 4000):
        text = "".join(f" {chr(c)}b1{chr(c)}{chr(c)}\n" for c in points[i:i + 4000])
        assert own.encode(text) == library.encode(text, add_special_tokens=False).ids


def test_borders_of_the_pattern(library, own):
    draw = random.Random(3)
    parts = ["'", "s", "t", "re", "ll", " ", "  ", "\n", "1", "é", "!", "d", "ve", "m", "\t", "中", "😀", "\u0085", "<|endoftext|>"]
    texts = ["".join(draw.choice(parts) for _ in range(draw.randrange(40))) for _ in range(3000)]
    texts += ["", "we'll 'rex '", "x'", "a" * 30_000, " " * 5000 + "x", "<|endoftext|><|endoftext|>"]
    for text in texts:
        ids = library.encode(text, add_special_tokens=False).ids
        assert own.encode(text) == ids and own.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_cuts_never_split_a_token(own):
    for token in own.token.values():
        raw = list(token)
        if token not in map(str.encode, own.special):
            assert all(own.inside[a, b] for a, b in zip(raw, raw[1:], strict=False))


def test_rows(spark, docs, odd_rows, library):
    rows = [*odd_rows, (30, "in <|endoftext|> text"), (31, "a\x00b")]
    table = docs(rows).withColumn("ids", F.lit("x")).withColumn("n_tokens", F.lit(None).cast("int"))
    got = bpe.encode_documents(table, PATH).collect()
    want = []
    for doc, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        want.append((doc, len(ids), sha256(",".join(map(str, ids)).encode()).hexdigest(), sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    back = bpe.decode_ids(bpe.encode_documents(table, PATH, ids=True), PATH)
    assert sorted(((r["doc_id"], r["text"]) for r in back.collect()), key=str) == sorted(((d, t or "") for d, t in rows), key=str)
    assert bpe.encode_documents(docs([]), PATH).collect() == []
