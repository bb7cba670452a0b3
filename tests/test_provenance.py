"""Values the graph build states, over the smallest tables."""

import json
import os

import pytest
from pyspark.sql import functions as F

from provlake.plans import adapter as A
from provlake.plans import provenance as P

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="needs the test tables")


def test_parameters_keywords_digests_and_overlay(spark):
    log = A.run_log(A.Tables(spark, FOLDER))
    images = log.tasks.where("container <> ''").select(F.col("container").alias("image")).distinct()
    identities = images.select("image", F.concat("image", F.lit("@sha256:1")).alias("digest"), F.lit("sha256:2").alias("image_id"))
    crates = log.runs.select(F.col("session_id").alias("crate_id"))
    metadata = crates.select("crate_id", F.create_map(F.lit("license"), F.lit('"CC0"'), F.lit("@id"), F.lit('"no"'), F.lit("funder"), F.lit('"F"')).alias("metadata"))
    g = P.build_provenance(log, identities=identities, keywords=["a", "b"], metadata=metadata)
    props = lambda where: [json.loads(json.dumps(r["props"])) for r in g.entities.where(where).collect()]
    runs = props(F.array_contains("types", F.lit("https://w3id.org/EVI#ROCrate")))
    assert runs and all((p["license"], p["funder"], p["keywords"]) == ('"CC0"', '"F"', '["a", "b"]') and "@id" not in p for p in runs)
    stated = {r["session_id"]: r["n"] for r in log.params.groupBy("session_id").agg(F.count("*").alias("n")).collect()}
    told = {r["crate_id"]: json.loads(r["p"]) for r in g.entities.where("map_contains_key(props, 'parameter')").select("crate_id", F.col("props")["parameter"].alias("p")).collect()}
    assert {k: len(v) for k, v in told.items()} == stated and all(": " in x for v in told.values() for x in v)
    tasks = props("map_contains_key(props, 'containerDigest') and not map_contains_key(props, 'digest')")
    assert tasks and all(json.loads(p["containerDigest"]) == json.loads(p["containerImage"]) + "@sha256:1" for p in tasks if "containerImage" in p)
    parts = g.edges.where("predicate = 'hasPart'").join(g.entities.select("crate_id", F.col("entity_id").alias("dst"), "pos"), ["crate_id", "dst"])
    assert parts.where("ord <> pos").count() == 0 and parts.count() > 0


def test_checks_of_computations_make_only_their_part_of_the_graph(spark, tmp_path):
    """The same computations as from the written graph, without the line items and without writing a table."""
    from provlake.plans import catalog_audit, shared
    folder = str(tmp_path / "tables")
    os.symlink("/root/testdata/sf0.001", folder)
    lean = catalog_audit._computations(spark, folder)
    assert "l_partkey" not in lean._jdf.queryExecution().optimizedPlan().toString()
    rows = sorted(lean.collect(), key=str)
    made = {name for _, at, name in shared._MADE if at == folder}
    assert not made & {"graph", "resolved"}
    shared.graph(spark, folder)
    assert rows and rows == sorted(catalog_audit._computations(spark, folder).collect(), key=str)


def test_narrow_ids_are_those_of_the_graph(spark, tmp_path):
    from provlake.plans import catalog_graph, shared
    folder = str(tmp_path / "tables")
    os.symlink("/root/testdata/sf0.001", folder)
    ids = shared.entity_ids(spark, folder)
    assert ids.columns == ["crate_id", "entity_id", "pos", "types"]
    roots = sorted(catalog_graph.root_entities(spark, folder).collect())
    whole = shared.graph(spark, folder).entities.select(*ids.columns)
    assert ids.exceptAll(whole).isEmpty() and whole.exceptAll(ids).isEmpty()
    assert len(roots) == 5 and roots == sorted(catalog_graph.root_entities(spark, folder).collect())


def test_many_parameters_are_several_lists(spark, monkeypatch):
    """No row holds all parameters of a run, and none is lost, in the graph or in its lines."""
    from provlake.operators import runs as R
    from provlake.sources.crates import entity_lines
    monkeypatch.setattr(R, "PARAM_CHUNK", 40)
    log = A.run_log(A.Tables(spark, FOLDER))
    g = P.build_provenance(log)
    stated = sorted((r["session_id"], r["parameter"]) for r in R.folded_params(log.params).collect())
    own = g.entities.where("map_contains_key(props, 'parameter')").select("crate_id", F.col("props")["parameter"].alias("value"))
    lists = own.unionByName(g.more.select("crate_id", "value")).collect()
    assert own.count() == 5 and len(lists) > 10 and max(len(json.loads(r["value"])) for r in lists) < 80
    assert sorted((r["crate_id"], p) for r in lists for p in json.loads(r["value"])) == stated
    lines = [(r["crate_id"], json.loads(r["json"])) for r in entity_lines(g).where("json like '%\"parameter\":%'").collect()]
    assert sorted((crate, p) for crate, line in lines for p in line["parameter"]) == stated
    runs = {r["crate_id"]: r["entity_id"] for r in g.entities.where("map_contains_key(props, 'parameter')").collect()}
    assert all(line["@id"] == runs[crate] for crate, line in lines)
