import pytest
from pyspark.sql import functions as F

from provlake.functions import sizes as S
from provlake.functions import text as X
from provlake.functions import types as K
from provlake.functions import values as V


@pytest.mark.parametrize("name,slug", [
    ("Tide Gauge #7 (Brest)", "tide-gauge-7-brest"), ("île/ñandú.nc", "le-and-nc"), ("//..", "unnamed"), (None, "unnamed"),
    ("m" * 44, "m" * 40), ("q" * 39 + "--rest", "q" * 39)])
def test_slugs(value, name, slug):
    assert value(X.slugify("n"), n=name) == slug


def test_arks(value):
    mint = lambda src: value(X.mint_ark("dataset", "n", "s"), n="tide gauge.nc", s=src)
    assert mint("/sea/1/tide gauge.nc") == mint("/sea/1/tide gauge.nc") != mint("/sea/2/tide gauge.nc")
    assert mint("x").startswith("ark:59853/dataset-tide-gauge-nc-") and len(mint("x").rsplit("-", 1)[1]) == 7


@pytest.mark.parametrize("name,bare", [("REGRID", "REGRID"), ("OCEAN:PREP:REGRID", "REGRID"), ("OCEAN: MASK (coarse) ", "MASK (coarse)"), (None, None)])
def test_bare_names(value, name, bare):
    assert value(X.bare_name("n"), n=name) == bare


@pytest.mark.parametrize("path,expected", [
    ("scratch/7/tide.nc", (None, "scratch/7/tide.nc")), ("file:///sea/mask.nc", (None, "/sea/mask.nc")),
    ("s3://buoys/2020.nc", ("s3://buoys/2020.nc", None)), ("ftp://example.org/m", ("ftp://example.org/m", None)),
    ("gs://c/ports.csv", ("gs://c/ports.csv", None)), (None, (None, None)), ("", (None, None))])
def test_outside_locators(value, path, expected):
    assert tuple(value(X.outside_locator("p"), p=path)) == expected


def test_crate_locators(value):
    at = lambda p: tuple(value(X.file_locator("p", F.lit("/out/results")), p=p))
    assert at("/out/results/tables/x.tsv") == ("tables/x.tsv", None)
    assert at("/out/results2/x.tsv") == (None, "/out/results2/x.tsv")


def test_script_delimiters(value):
    cut = lambda s: value(X.strip_script_delimiters("s"), s=s)
    assert cut("n = 3\n\"\"\"\nregrid -n $n\n\"\"\"") == "n = 3\n\nregrid -n $n\n"
    assert cut("'''\nmask it\n'''\t\n") == "\nmask it\n"
    assert cut("plain\n  body") == "plain\n  body" and cut(None) is None


def test_unindent(value):
    plain = lambda s: value(X.unindent("s"), s=s)
    assert plain("\n    regrid\n      --fast\n\n    mask\n  ") == "\nregrid\n  --fast\n\nmask\n" and plain("a\n  b") == "a\n  b" and plain("") == "" and plain(None) is None


def test_repositories(spark):
    """Whatever tag or digest follows, the repository is what stands before it; a port is no tag."""
    hosts, paths, tags, digests = ("", "quay.example/", "lighthouse:8443/"), ("regrid", "sea/regrid", "sea/deep/mask"), ("", ":7", ":v2.1-rc3"), ("", "@sha256:" + "0f" * 32)
    rows = [(h + p + t + d, h + p) for h in hosts for p in paths for t in tags for d in digests] + [(None, None)]
    df = spark.createDataFrame(rows, "ref string, want string")
    assert df.where(~X.repository_of("ref").eqNullSafe(F.col("want"))).collect() == []


def test_digests(value):
    """The digest of the image's own repository wins wherever it stands, else the first one there is."""
    pick = lambda image, ds: value(X.pick_digest("i", "d"), "i string, d array<string>", i=image, d=ds)
    held = [f"sea/{name}@sha256:{i}" for i, name in enumerate(["regrid", "mask", "plot"])]
    assert [pick(f"sea/{name}:2024", held) for name in ("regrid", "mask", "plot", "tide")] == [*held, held[0]]
    assert [pick("sea/tide", none) for none in ([], None)] == [None, None]


def test_contributors(spark):
    """Authors are credited; where nobody is one, everybody is."""
    roles = [["author"], ["editor"], ["reviewer", "author"], []]
    teams = [[("Inês", a), ("Rui", b), ("Zé", c)] for a in roles for b in roles for c in roles]
    want = [", ".join([n for n, r in team if "author" in r] or [n for n, _ in team]) for team in teams]
    df = spark.createDataFrame(list(zip(teams, want, strict=True)) + [([], None), (None, None)], "c array<struct<name:string,contribution:array<string>>>, want string")
    assert df.where(~X.credited_names("c").eqNullSafe(F.col("want"))).collect() == []


def test_unquote_and_versions(value):
    for said in ("3.8.4", "r12 beta"):
        assert [value(X.unquote("v"), v=v) for v in (said, f" {said}\t", f'"{said}"', f" '{said}' ", f"'{said}")] == [said] * 4 + [f"'{said}"]
    kind, tools = "p array<struct<tool:string,version:string>>", [("gdal", "3.8.4"), ("proj", "9.3"), ("cdo", "2")]
    shown = [value(X.format_versions("p"), kind, p=tools[:n]) for n in range(4)]
    assert shown == [None, "3.8.4", "gdal 3.8.4, proj 9.3", "gdal 3.8.4, proj 9.3, cdo 2"]


@pytest.mark.parametrize("text,ok", [("a/b.csv", True), ("a/.hidden", False), ("a/b.", False), ("a.b/c", False), ("x.tar.gz", True)])
def test_file_shaped(value, text, ok):
    assert value(X.file_shaped("t"), t=text) is ok


@pytest.mark.parametrize("pattern,path,ok", [
    ("**/*.csv", "a/b/c.csv", True), ("*.csv", "a/c.csv", False), ("**.{csv,tsv}", "a/c.tsv", True), ("a/[!x]?.t", "a/yz.t", True), ("a/[!x]?.t", "a/xz.t", False)])
def test_globs(value, pattern, path, ok):
    assert value(X.matches_globs("p", [pattern]), p=path) is ok


def test_ancestors(value):
    assert value(X.ancestors("p"), p="a/b/c.txt") == ["a", "a/b"] and value(X.ancestors("p"), p="/a/b") == ["/a"] and value(X.ancestors("p"), p="x") == []


def test_blocks(value):
    has = lambda ran, said: value(X.contains_block(X.script_lines("a"), X.script_lines("b")), a=ran, b=said)
    assert has("#!/bin/bash\n  x 1\n\n y\nz", "x 1\ny") and not has("x\nq\ny", "x\ny") and has("x", "") and not has("xy", "x")


@pytest.mark.parametrize("v,dp,text", [(12.5, 0, "12"), (0.15, 1, "0.1"), (87.25, 1, "87.2"), (13.5, 0, "14"), (1234567.0, 1, "1234567.0")])
def test_fixed(value, v, dp, text):
    assert value(S.fixed("v", dp), "v double", v=v) == text


@pytest.mark.parametrize("text,decimal,binary", [
    ("1.2 TB", 1.2e12, int(1.2 * 1024 ** 4)), ("500 MB", 5e8, 500 * 1024 ** 2), ("42", 42.0, 42), ("945.6 MB", 945.6e6, 991533465), ("n/a", 0.0, None), ("", 0.0, None),
    ("3 kilobytes", 0.0, 3072), ("7 B", 7.0, 7), ("1e3 kb", 1e6, 1024000)])
def test_sizes(value, text, decimal, binary):
    assert value(S.parse_size_decimal("t"), t=text) == pytest.approx(decimal)
    assert value(S.parse_size_binary("t"), t=text) == binary


def test_formats(value):
    assert value(S.normal_format(F.array("t")), t="..CSV, json; unknown/ .Tsv") == "csv, json, tsv" and value(S.normal_format(F.array("t")), t=" ") == "unknown"


def test_types(value):
    def read(types):
        f = lambda c: value(c, "t array<string>", t=types)
        return f(K.normal_type("t")), f(K.last_type("t")), f(K.edge_type("t")), f(K.evi_type("t"))
    crate = ["Dataset", "https://w3id.org/EVI#ROCrate"]
    assert read(crate) == ("Dataset", crate[1], "Dataset", "ROCrate")
    assert read(["EVI:Schema"]) == ("Schema", "EVI:Schema", "EVI:Schema", "Schema")
    assert read([]) == ("Other", "", "", None)
    assert value(K.node_label_type("t"), "t array<string>", t=["prov:Entity", "evi:DatasetGroup"]) == "DatasetGroup"


def test_values(value):
    assert [value(V.present("v"), v=x) for x in ('"a"', '" "', "[]", "{ }", "null", None, "0")] == [True, False, False, False, False, False, True]
    assert value(V.delimited_list("v"), v='"a, b;c ;"') == ["a, b", "c"] and value(V.delimited_list("v"), v='["x"," "]') == ["x"]
    assert value(V.publications("v"), v='[{"name":"P"},"P",{"@id":"q"}]') == ["P", "q"]
    assert value(X.truncate_at_word("t", 5), t="ab cde f") == "ab" and value(X.truncate_at_word("t", 9), t="ab cde") == "ab cde"
    assert value(X.evidence_graph_id("t"), t="ark:59853/x-1") == "ark:59853/evidence-graph-x-1" and value(X.evidence_graph_id("t"), t="y") == "y-evidence-graph"
