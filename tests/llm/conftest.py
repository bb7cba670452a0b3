import random

import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def babble(seed, n, letters="abcdefghij"):
    draw = random.Random(seed)
    return " ".join("".join(draw.choice(letters) for _ in range(draw.randint(2, 6))) for _ in range(n))


@pytest.fixture(scope="session")
def docs(spark):
    """Rows of (doc_id, text[, lang]) as the documents table."""
    def make(rows):
        return spark.createDataFrame([(r[0], r[1], r[2] if len(r) > 2 else "en", "src", None if r[1] is None else len(r[1])) for r in rows], SCHEMA)
    return make


@pytest.fixture(scope="session")
def odd_rows():
    """Null, empty, wordless, short and very long texts, repeated rows, a null id, odd white space."""
    long = babble(1, 60_000)
    return [(1, None), (2, ""), (3, "?! \t\n"), (4, "One"), (5, "one TWO three"), (6, long), (7, long), (8, babble(2, 80)), (8, babble(2, 80)),
            (None, babble(3, 70)), (9, babble(2, 80).upper()), (10, "äöü 中文 words here and there 😀"), (11, "x" * 50_000)]
