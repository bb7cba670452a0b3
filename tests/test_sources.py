import hashlib
import json
import random

import pytest
from pyspark.sql import functions as F

from provlake.operators import audit as Q
from provlake.operators import containers, filetree, runs as R
from provlake.sources import crates as S
from provlake.sources import files as L
from provlake.sources import versions as V
from tests.crates import forecast


def pairs(spark, text):
    lines = spark.createDataFrame([("f", i, s) for i, s in enumerate(text.split("\n"))], "file string, line_no int, line string")
    return {(r["process"], r["tool"]): r["version"] for r in V.version_pairs(lines).collect()}


def test_version_files(spark):
    """Any quoting of names and values and any indent spell the same pairs; what is no pair under a name is left out."""
    held = {"REGRID": {"cdo": "2.4.0", "nco": "5.1.9"}, "TIDE_FIT": {"utide": "0.3"}}
    for quote in ("", "'", '"'):
        for indent in ("  ", "\t", " " * 7):
            text = "stray: 1\n".replace("stray", f"{indent}stray") + "".join(f"{quote}{p}{quote}:\n# by {p}\n\n" + "".join(f"{indent}{t}: {quote}{v}{quote}\n" for t, v in tools.items()) + f"{indent}empty:\n" for p, tools in held.items())
            assert pairs(spark, text) == {(p, t): v for p, tools in held.items() for t, v in tools.items()}
    assert pairs(spark, "MASK:\n  cdo: 1\n  cdo: 2\nBARE:\n") == {("MASK", "cdo"): "2"} and pairs(spark, "a log line, no names") == {}
    # a qualified name ends at its first colon
    assert pairs(spark, '"OCEAN:PREP:MASK":\n  cdo: 1\n') == {('"OCEAN', "cdo"): "1"}


def test_version_files_from_disk(spark, tmp_path):
    (tmp_path / "versions.yml").write_text('P:\n  a: 1\n')
    (tmp_path / "big_versions.yml").write_text("Q:\n" + "# filler\n" * 200_000 + "  b: 2\n")  # over a megabyte, over many blocks
    got = V.version_pairs(V.read_lines(spark, str(tmp_path))).collect()
    assert sorted((r["process"], r["tool"], r["version"]) for r in got) == [("P", "a", "1"), ("Q", "b", "2")]
    named = spark.createDataFrame([("x/versions.yml",), ("x/My_Versions.yaml",), ("x/versions.txt",)], "path string")
    assert [r["path"] for r in V.collated_files(named).collect()] == ["x/My_Versions.yaml"]


def test_lines_of_any_ending_in_many_splits(spark, tmp_path):
    draw = random.Random(2)
    want = {}
    for i in range(6):
        said = [draw.choice(["", "x", "long " * 9, "é"]) for _ in range(draw.randint(1, 60))] + ["end"]
        ends = [draw.choice(["\n", "\r\n", "\r"]) if after else "\n" for after in [*said[1:], "x"]]  # CR and an empty line's LF would be one ending
        (tmp_path / f"f{i}.yml").write_bytes("".join(s + e for s, e in zip(said, ends, strict=True)).encode())
        want[f"f{i}.yml"] = list(enumerate(said))
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    for key, small in zip(before, ("50", "0"), strict=True):
        spark.conf.set(key, small)
    try:
        lines = V.read_lines(spark, str(tmp_path)).collect()
    finally:
        for key, old in before.items():
            spark.conf.set(key, old)
    got = {}
    for r in sorted(lines, key=lambda r: r["line_no"]):
        got.setdefault(r["file"].rsplit("/", 1)[1], []).append((r["line_no"], r["line"]))
    assert got == want


def test_inspect_records(spark):
    """A record alone or in a list, with its repository's digest at any place; what is no record has no identity."""
    held = [f"sea/{n}@sha256:{i}" for i, n in enumerate(["mask", "regrid"])]
    rows = []
    for digests in (held, held[::-1], held[:1], []):
        want = held[1] if held[1] in digests else digests[0] if digests else None
        record = {"Id": "sha256:1d", "Size": 7, "RepoDigests": digests}
        rows += [(json.dumps(shape), want, "sha256:1d") for shape in (record, [record], [record, {"Id": "other"}])]
    rows += [(text, None, None) for text in (None, "", "{", "[]", "null", "7")]
    asked = spark.createDataFrame([(f"sea/regrid:{i}", text) for i, (text, _, _) in enumerate(rows)], "image string, json string")
    got = {r["image"]: (r["digest"], r["image_id"]) for r in containers.image_identities(asked).collect()}
    assert got == {f"sea/regrid:{i}": (digest, image_id) for i, (_, digest, image_id) in enumerate(rows)}


def test_listing_checksums_and_trees(spark, tmp_path):
    (tmp_path / "a" / "b").mkdir(parents=True)
    (tmp_path / "a" / "x.txt").write_text("hello")
    (tmp_path / "a" / "b" / "y.txt").write_text("hello!")
    want = hashlib.md5(b"hello").hexdigest()
    sums = {r["path"].rsplit("/", 1)[1]: r["md5"] for r in L.checksums(spark, str(tmp_path)).collect()}
    assert sums["x.txt"] == want
    names = L.listing(spark, str(tmp_path)).select("path")
    streamed = {r["path"].rsplit("/", 1)[1]: r["md5"] for r in L.stream_checksums(names.unionByName(spark.createDataFrame([("/no/such",)], "path string"))).collect()}
    assert streamed == {**sums, "such": None}
    assert {r["path"].rsplit("/", 1)[1]: r["md5"] for r in L.checksums(spark, str(tmp_path), row_bytes=5).collect()} == sums  # y.txt is read in pieces
    plain = L.listing(spark, str(tmp_path)).select(F.lit("s").alias("session_id"), F.regexp_replace("path", ".*(?=/a/)", "").alias("path"), "length", F.lit(False).alias("is_dir"))
    assert {(r["dir"], r["n_files"], r["size"]) for r in filetree.tree_sizes(plain).collect()} == {("/a", 2, 11), ("/a/b", 1, 6)}
    assert "content" not in L.listing(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()


def test_expansion_keeps_the_first_paths(spark):
    files = spark.createDataFrame([("s", f"out/d/{i:04d}.txt", 1, False) for i in range(500)] + [("s", "out/e/x.txt", 1, False)], "session_id string, path string, length int, is_dir boolean")
    folders = spark.createDataFrame([("s", "out/d")], "session_id string, dir string")
    kept, dropped = filetree.expand_folders(files, folders)
    assert kept.count() == 500 and dropped.first()["n_dropped"] == 0
    kept, dropped = filetree.expand_folders(files, folders, max_files=7)
    assert sorted(r["path"] for r in kept.collect()) == [f"out/d/{i:04d}.txt" for i in range(7)]
    assert [(r["n_files"], r["n_dropped"]) for r in dropped.collect()] == [(500, 493)]


def test_launch_scripts(spark, tmp_path):
    body = ("#!/bin/bash\nnxf_stage() {\n    true\n    rm -f a\n    ln -s /data/a.txt a.txt\n    mkdir -p in && ln -s '/data/b c.txt' in/b\n    cp -fRL /data/d.txt d.txt\n"
            "    ln -s relative x\n    ln -s \"/open\n}\n\nnxf_main() {\n  ln -s /not/staged y\n  docker run -i -v /w:/w reg:5000/t/x:1 /bin/bash -c 'run'\n}\n")
    (tmp_path / "a.run").write_text(body)
    scripts = L.read_scripts(spark, str(tmp_path))
    assert sorted(r["source"] for r in L.staged_sources(scripts).collect()) == ["/data/a.txt", "/data/b c.txt", "/data/d.txt"]
    assert scripts.select(L.launched_image("body")).first()[0] == "reg:5000/t/x:1"


@pytest.mark.parametrize("clause", ["ln -s '/a b' c", 'cp "x \\"y\\" \\n" z', "a\\ b 'c'\"d\"e", "'' x", 'open "quote', "it's", "plain words  here", "tail\\", "#no comment"])
def test_shell_words(value, clause):
    import shlex
    try:
        want = shlex.split(clause)
    except ValueError:
        want = []
    assert value(L.shell_words("c"), c=clause) == want


def test_newest_trace(spark, tmp_path):
    for run in ("r1", "r2"):
        (tmp_path / run).mkdir()
        (tmp_path / run / "trace_2024-01.txt").write_text("hash\tname\tstatus\nab/1\told\tCOMPLETED\n")
    (tmp_path / "r1" / "trace_2024-02.txt").write_text("hash\tname\tstatus\nab/1\tnew\tFAILED\n")
    got = {r["folder"].rsplit("/", 1)[1]: r["name"] for r in L.read_traces(spark, str(tmp_path)).collect()}
    assert got == {"r1": "new", "r2": "old"}


def test_copied_names(spark):
    src = spark.createDataFrame([("s", f"{i}/{n}", i) for i, n in enumerate(["a.conf", "a.conf", "b", "a.conf", "a-2.conf", "b"])], "session_id string, path string, seq int")
    got = [r["copied_as"] for r in R.copied_names(src).orderBy("seq").collect()]
    assert got == ["a.conf", "a-3.conf", "b", "a-4.conf", "a-2.conf", "b-2"]


def test_annotations(spark):
    kind = "session_id string, process string, ext map<string,string>, ext_is_map boolean"
    rows = spark.createDataFrame([("s", "ok", {"softwareName": "x"}, True), ("s", "odd", {"softwareName": "x", "made": "y"}, True), ("s", "bad", None, False), ("s", "none", None, True)], kind)
    assert {(r["process"], r["problem"], r["keys"]) for r in R.annotation_warnings(rows).collect()} == {("odd", "unrecognized keys", "made"), ("bad", "not a map", "")}


def test_sink_writes_lines_in_order(spark, tmp_path):
    g = S.load_crates(spark.createDataFrame([("c1", forecast()), ("c2", forecast(3))], "crate_id string, json string"))
    S.write_lines(S.entity_lines(g), str(tmp_path / "out"))
    back = spark.read.json(str(tmp_path / "out"))
    assert back.where("crate_id = 'c1'").count() == g.entities.where("crate_id = 'c1'").count()


def test_reconciliation_states(spark):
    trip = "crate_id string, identifier string, md5 string"
    said = spark.createDataFrame([("c", "t", "a"), ("c", "t", "a"), ("c", "t", "x"), ("c", "t", None)], trip)
    did = spark.createDataFrame([("c", "t", "a"), ("c", "t", "b")], trip)
    support = Q.edge_support(said, did)
    assert {(r["md5"], r["state"]) for r in support.collect()} == {("a", "covered"), ("x", "fabricated"), ("b", "omitted")}
    assert tuple(Q.coverage(support).first())[1:] == (1, 2, 1, 0.5)


def test_folder_sizes_and_locators(spark):
    data = spark.createDataFrame([("c", "d1", "t/x", None, None, "5"), ("c", "d2", None, "work/y", "m", "3"), ("c", "d3", "dir", None, None, "9"), ("c", "d4", "gone", None, None, None),
                                  ("c", "d5", None, "/abs/z", None, None), ("c", "d6", "s3://b/k", None, None, None), ("c", "d7", None, None, None, None)],
                                 "crate_id string, entity_id string, content_url string, local_path string, md5 string, content_size string")
    files = spark.createDataFrame([("c", "/run/results/t/x", 5, "h", False), ("c", "/run/work/y", 4, "n", False), ("c", "/run/results/dir", 0, None, True)], "crate_id string, path string, length bigint, md5 string, is_dir boolean")
    at = Q.locator_status(data, files, "/run/results", "/run")
    assert {r["entity_id"]: r["status"] for r in at.collect()} == {"d1": "crate", "d2": "local", "d3": "crate", "d4": "broken", "d5": "gone", "d6": "remote", "d7": "none"}
    tree = spark.createDataFrame([("c", "/run/results/dir", 8)], "crate_id string, path string, size bigint")
    assert {(r["entity_id"], r["problem"]) for r in Q.content_mismatches(at, tree).collect()} == {("d2", "md5"), ("d2", "size"), ("d3", "size")}


def test_graph_diff_ignores_order(spark):
    kind = "crate_id string, entity_id string, props map<string,string>"
    a = spark.createDataFrame([("c", "x", {"l": "[2, 1]", "m": '{"b":1,"a":2}', "v": "1"}), ("c", "only", {})], kind)
    b = spark.createDataFrame([("c", "x", {"l": "[1,2]", "m": '{"a":2,"b":1}', "v": "2", "n": "0"}), ("c", "new", {})], kind)
    assert {(r["entity_id"], r["key"], r["problem"]) for r in Q.graph_diff(a, b).collect()} == {
        ("only", None, "only left"), ("new", None, "only right"), ("x", "v", "differs"), ("x", "n", "only right")}
