import json
import random

import pytest

from provlake.sources import crates as S
from provlake.sources import items as I

SPACE = [" ", "\n", "\t", ""]


def value(draw, depth):
    kind = draw.randrange(8 if depth else 5)
    if kind < 3:
        return "".join(draw.choice(['"', "\\", "}", "{", "[", "]", ",", ":", "a", "é", '"@graph":[', "\n", "\\}"]) for _ in range(draw.randrange(6)))
    if kind == 3:
        return draw.choice([1, -2.5, True, None])
    if kind == 4:
        return {}
    if kind < 7:
        return {draw.choice(["a", "b}", "@graph", 'q"', "c{"]): value(draw, depth - 1) for _ in range(draw.randrange(4))}
    return [value(draw, depth - 1) for _ in range(draw.randrange(4))]


def made(seed):
    """A document with odd keys before and after its graph, and the objects of its graph by position."""
    draw = random.Random(seed)
    graph = [value(draw, 3) if draw.random() < 0.4 else {"@id": f"e{i}", "v": value(draw, 2)} for i in range(draw.randrange(7))]
    doc = {"@context": value(draw, 2), "x": {"@graph": [{"no": 1}]}} if draw.random() < 0.6 else {}
    doc["@graph"] = graph
    if draw.random() < 0.6:
        doc["after"] = [{"k": [{}]}, value(draw, 2)]
    text = json.dumps(doc, ensure_ascii=draw.random() < 0.5, indent=draw.choice([None, 1, "\t"]), separators=draw.choice([None, (",", ":"), (" , ", " :\n")]))
    return draw.choice(SPACE) + text + draw.choice(SPACE), {i: x for i, x in enumerate(graph) if isinstance(x, dict)}


def found(scan):
    out = {}
    for r in scan.items.collect():
        out.setdefault(r["crate_id"], {})[r["pos"]] = json.loads(r["json"])
    return out


@pytest.mark.parametrize("step", [I.STEP, 2])
def test_items_of_any_documents(spark, step, monkeypatch):
    monkeypatch.setattr(I, "STEP", step)
    docs = {str(i): made(i) for i in range(150)}
    scan = I.scan(I.document_chunks(spark.createDataFrame([(k, v[0]) for k, v in docs.items()], "crate_id string, json string")))
    got = found(scan)
    assert {k: got.get(k, {}) for k in docs} == {k: v[1] for k, v in docs.items()}
    assert scan.problems.collect() == []


def test_files_in_many_splits(spark, tmp_path):
    docs = {}
    for i in range(14):
        (tmp_path / f"d{i}").mkdir()
        text, want = made(1000 + i)
        (tmp_path / f"d{i}" / "crate.json").write_text(text, encoding="utf-8")
        docs[f"d{i}"] = want
    before = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "90")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        scan = I.scan(I.file_chunks(spark, str(tmp_path)))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before[0])
        spark.conf.set("spark.sql.files.openCostInBytes", before[1])
    got = {k.split("/")[-2]: v for k, v in found(scan).items()}
    assert {k: got.get(k, {}) for k in docs} == docs and scan.problems.collect() == []


def test_problems(spark, tmp_path):
    docs = [("cut", '{"@graph":[{"@id":"a"},{"@id":'), ("open", '{"@graph":[{"@id":"a"}]'), ("twice", '{"@graph":[{"@id":"a"}]}}'), ("glued", '{"@graph":[{"@id":"a"}{"@id":"b"}]}'),
            ("word", '{"@graph":[{"@id":a}]}'), ("frame", '{"x":y,"@graph":[{"@id":"a"}]}'), ("deep", '{"x":{"@graph":[{"@id":"a"}]}}'), ("list", '[{"@graph":[{"@id":"a"}]}]'),
            ("text", '{"x":"\\"@graph\\":[{}]"}'), ("map", '{"@graph":{"@id":"a"}}'), ("null", None), ("empty", ""), ("good", '{"@graph":[{"@id":"a"}]}'), ("none", '{"@graph":[]}')]
    table = spark.createDataFrame(docs, "crate_id string, json string")
    assert {r["crate_id"]: r["problem"] for r in S.unreadable(table).collect()} == dict.fromkeys(
        ("cut", "open", "twice", "glued", "word", "frame", "null", "empty"), "not JSON") | dict.fromkeys(("deep", "list", "text"), "no @graph") | {"map": "@graph is not a list"}
    (tmp_path / "a.json").write_text('{"@graph":[{"@id":"a"}]}}')
    (tmp_path / "b.json").write_text('{"@graph":[{"@id":"a"}]}}\n')
    (tmp_path / "c.json").write_text('{"@graph":[{"@id":"a"}]}\n')
    assert sorted(r["crate_id"][-6:] for r in I.scan(I.file_chunks(spark, str(tmp_path))).problems.collect()) == ["a.json", "b.json"]
    assert [(r["crate_id"], r["entity_id"]) for r in S.load_crates(table).entities.collect()] == [("good", "a")]


def test_a_document_above_the_parser_limit(spark, tmp_path):
    n, filler = 140_000, "x" * 960
    with open(tmp_path / "big.json", "w") as f:
        f.write('{"@context":{},"@graph":[')
        f.write(",".join(f'{{"@id":"e{i}","@type":"Dataset","description":"}} {filler}","usedDataset":[{{"@id":"e{i - 1}"}}]}}' for i in range(n)))
        f.write("]}")
    assert (tmp_path / "big.json").stat().st_size > 128 << 20
    chunks = I.file_chunks(spark, str(tmp_path))
    assert chunks.rdd.getNumPartitions() > 1
    g = S.read_crates(spark, str(tmp_path))
    e = g.entities.selectExpr("count(*) n", "count(distinct entity_id) m", "min(pos) a", "max(pos) b", "count_if(entity_id = 'e' || pos) k").first()
    assert tuple(e) == (n, n, 0, n - 1, n)
    assert g.edges.where("predicate = 'usedDataset'").count() == n
