import re
from hashlib import sha256

from pyspark.sql import functions as F

from provlake.llm import decontaminate as d
from tests.llm.conftest import babble


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, size=10):
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for item, said in items:
            x = words(said)
            k = min(size, len(x))
            for i in range(len(x) - k + 1 if k else 0):
                for p in range(len(w) - k + 1):
                    if w[p:p + k] == x[i:i + k]:
                        hit.update(range(p, p + k))
                        found.add(str(item))
        out.append((doc, len(w), len(hit), len(found), sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return out


def test_equals_brute_force(spark, docs, odd_rows, monkeypatch):
    item = babble(50, 30)
    items = [(1, item), (2, "a1 b2"), (3, ""), (4, None), (5, item), (10, babble(51, 10)), (11, babble(52, 12)), (12, "Überall ist 中文"), (13, "solo")]
    w = item.split()
    rows = [r for r in odd_rows if r[0] not in (6, 7)] + [
        (20, "x " + " ".join(w[3:13]).upper() + " y"), (21, " ".join(w[3:12])), (22, babble(51, 10)), (23, "a1, b2. a1 b2 b2"),
        (24, " ".join(w[:5] + ["cut"] + w[5:])), (25, f"{babble(52, 12)} {item}!"), (26, "überall IST 中文; solo"), (27, "ÜBERALL ist 中文")]
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    table = docs(rows).withColumn("n_words", F.lit("taken")).withColumn("items", F.lit(0)).withColumn("spans", F.lit(1))
    want = sorted(brute(rows, items), key=str)
    for block in (d.BLOCK, 7):  # one broadcast block, then many
        monkeypatch.setattr(d, "BLOCK", block)
        assert sorted((tuple(r) for r in d.decontaminate(table, benchmark).collect()), key=str) == want


def test_long_text_and_empty_tables(spark, docs, odd_rows):
    long = next(r[1] for r in odd_rows if r[0] == 6)
    benchmark = spark.createDataFrame([(1, " ".join(long.split()[59_900:59_990]))], "item_id bigint, text string")
    got = d.item_hits(docs(odd_rows), benchmark, carry=["doc_id", "source"]).where("size(items) > 0").collect()
    assert sorted((r["doc_id"], r["source"], [tuple(s) for s in r["spans"]]) for r in got) == [(i, "src", [(59_900, 59_990)]) for i in (6, 7)]
    assert d.decontaminate(docs([]), benchmark).collect() == []
    assert d.decontaminate(docs([(1, "a b")]), benchmark.limit(0)).first()["n_hit"] == 0
