"""Crates derived from the document and order tables, for profiling and scoring.

One crate per document source, whose root carries a varied set of properties, and the run
crates of the adapter enriched with samples, cell lines, experiments and foreign inputs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from provlake import model as M
from provlake.functions import text as X
from provlake.operators import runs as R
from provlake.plans import adapter as A
from provlake.plans.shared import graph
from provlake.session import cut_packed as cut


def _on(cond: str, value: Column) -> Column:
    return F.when(F.expr(cond), value)


def source_roots(t) -> DataFrame:
    """(crate_id, root_id, root_props): one root per document source."""
    d = t.documents.groupBy("source").agg(F.min_by("text", "doc_id").alias("text"), F.count("*").alias("n"), F.sum("n_chars").alias("chars"))
    d = d.withColumn("k", F.substring("source", 4, 9).cast("int"))
    q = M.quote_opt
    lit = lambda s: F.lit(s)
    ks = F.col("k").cast("string")
    values = {
        "name": _on("k % 9 <> 4", q(F.concat(lit("Source "), "source"))), "description": q("text"),
        "identifier": _on("k % 2 = 0", q(F.concat(lit("doi:10.1/"), "source"))),
        "license": _on("k % 3 <> 0", lit('"https://spdx.org/licenses/MIT"')),
        "author": _on("k % 4 = 0", lit('["Ann","Bo"]')).when(F.expr("k % 4 = 1"), F.concat(
            lit('[{"@id":"person-'), ks, lit('"},{"name":" Cy "},"Di",{"@id":"nobody"}]'))).when(F.expr("k % 4 = 2"), lit('"Eve"')),
        "publisher": _on("k % 3 = 0", lit('{"name":"Press"}')).when(F.expr("k % 3 = 1"), F.concat(lit('"House '), ks, lit('"'))),
        "principalInvestigator": _on("k % 5 = 0", F.concat(lit('"PI '), ks, lit('"'))),
        "rai:dataBiases": q("text"),
        "rai:dataCollectionMissingData": _on("k % 6 = 1", lit('"  "')).when(F.expr("k % 2 = 1"), lit('"none missing"')),
        "rai:dataUseCases": _on("k % 2 = 0", lit('["train"," test "]')),
        "rai:dataLimitations": _on("k % 3 = 0", lit('"few"')), "rai:dataCollection": _on("k % 4 = 2", lit('"scraped"')),
        "additionalProperty": _on("k % 3 = 1", lit(
            '[{"name":"Human Subject","value":"none"},{"name":"Data Governance Committee","value":"board"},'
            '{"name":"Prohibited Uses","value":"resale"},{"name":"Completeness","value":"full"}]')),
        "ethicalReview": _on("k % 5 = 1", lit('"ok"')),
        "confidentialityLevel": _on("k % 4 = 0", lit('"  "')).when(F.expr("k % 4 = 1"), lit('"public"')),
        "rai:dataReleaseMaintenancePlan": _on("k % 6 = 0", lit('"yearly"')),
        "contentSize": _on("k % 4 = 1", lit('"1.5 GB"')).when(F.expr("k % 4 = 2"), F.concat(lit('"'), F.col("chars").cast("string"), lit(' b"')))
        .when(F.expr("k % 8 = 3"), F.col("chars").cast("string")),
        "evi:datasetCount": _on("k % 7 = 0", F.col("n").cast("string")), "evi:totalEntities": _on("k % 7 = 0", (F.col("n") * 1000).cast("string")),
        "evi:entitiesWithChecksums": _on("k % 7 = 0", F.col("n").cast("string")), "evi:schemaCount": _on("k % 7 = 1", lit("3")),
        "evi:formats": _on("k % 5 = 2", lit('[".CSV","json","tsv","b","a","z","y/x"]')),
        "dateCreated": _on("k % 3 = 0", lit('"2024-03-05T10:11:12.5Z"')).when(F.expr("k % 3 = 1"), lit('"2024-03-05"')).otherwise(lit('"03/05/2024"')),
        "dateModified": lit('"soon"'), "keywords": _on("k % 2 = 0", lit('"a, b ,,c"')).otherwise(lit('["x","y"]')),
        "MD5": q(F.md5("source")), "deidentified": _on("k % 2 = 0", lit("true")), "irb": lit("5"),
        "associatedPublication": lit('[{"name":"P1"},"P2","P2",{"@id":"p3"}]'), "funder": lit('"A; B;"'),
    }
    return d.select(F.concat(lit("docs-"), "source").alias("crate_id"), F.concat(lit("root-"), "source").alias("root_id"), "k",
                    M.json_map(**values).alias("root_props"))


def document_entities(t) -> DataFrame:
    """Entities of the document crates: root, documents, tools per language, people."""
    d = t.documents.withColumn("crate_id", F.concat(F.lit("docs-"), "source"))
    by_lang = lambda **kw: F.coalesce(*[F.when(F.col("lang") == k, v) for k, v in kw.items()])
    no = F.lit(None).cast("string")
    n = F.col("n_chars").cast("string")
    docs = M.entity_frame(
        d, "dataset", entity_id=F.concat(F.lit("doc-"), A.text("doc_id")), pos=F.col("doc_id"), types=M.strings(M.DATASET_TYPES),
        name=F.concat(F.lit("document "), A.text("doc_id")),
        formats=by_lang(en=M.strings([".CSV, json"]), de=M.strings(["unknown"]), fr=M.strings(["text/csv; .tsv", "Bin"]), es=F.array().cast("array<string>")),
        content_url=by_lang(fr=F.lit("Embargoed"), en=F.concat(F.lit("https://docs.example/"), A.text("doc_id")), es=F.lit(""), de=no),
        content_size=by_lang(en=F.concat(n, F.lit(" KB")), de=F.lit("much"), fr=n, es=no),
        md5=F.when(F.col("lang") == "en", F.md5(A.text("doc_id"))), has_provenance=F.col("lang") == "en",
        has_generated_by=F.col("lang") == "en",
        props=M.json_map(hasSummaryStatistics=F.when(F.col("lang") == "es", F.lit('{"@id":"s"}'))))
    tools = M.entity_frame(
        d.select("crate_id", "source", "lang").distinct(), "process", entity_id=F.concat(F.lit("tool-"), "source", F.lit("-"), "lang"),
        types=M.strings(M.SOFTWARE_TYPES), name=F.col("lang"), formats=M.strings(["py"]),
        content_url=F.when(F.col("lang") != "de", F.lit("https://tools.example/")))
    roots = source_roots(t)
    root = M.entity_frame(roots, "root", entity_id=F.col("root_id"), types=M.strings(M.ROOT_TYPES), props=F.col("root_props"))
    people = M.entity_frame(roots, "config", entity_id=F.concat(F.lit("person-"), A.text("k")), types=M.strings(["Person"]),
                            name=F.concat(F.lit("Person "), A.text("k")))
    schemas = M.entity_frame(roots.where("k % 2 = 0"), "schema", entity_id=F.concat(F.lit("schema-"), A.text("k")), types=M.strings([M.SCHEMA]))
    return docs.unionByName(tools).unionByName(root).unionByName(people).unionByName(schemas)


def lab_graph(spark, folder: str) -> M.Graph:
    """The run crates with suppliers as samples, nations as cell lines and foreign inputs,
    customers as experiments."""
    t = A.Tables(spark, folder)
    g = graph(spark, folder)
    nat = A.nations(t).withColumnRenamed("session_id", "crate_id")
    cus = A.customers(t).join(t.customer.select("c_custkey", "c_acctbal"), "c_custkey").withColumnRenamed("session_id", "crate_id")
    sup = t.supplier.join(nat, F.col("s_nationkey") == F.col("n_nationkey"))
    key = lambda p, c: F.concat(F.lit(p), A.text(c))
    samples = M.entity_frame(sup, "config", entity_id=key("sample-", "s_suppkey"), types=M.strings(["prov:Entity", M.EVI + "Sample"]))
    lines = M.entity_frame(nat, "config", entity_id=key("line-", "n_nationkey"), types=M.strings(["BioChemEntity"]), name=F.col("n_name"),
                           props=M.json_map(organism=F.when(F.col("n_nationkey") % 3 != 0, F.concat(
                               F.lit('{"name":"species '), A.text(F.col("n_nationkey") % 4), F.lit('"}')))))
    exps = M.entity_frame(cus, "config", entity_id=key("exp-", "c_custkey"), types=M.strings(["prov:Activity", M.EVI + "Experiment"]),
                          props=M.json_map(experimentType=F.when(F.col("c_mktsegment") != "MACHINERY", M.quote_opt("c_mktsegment"))))
    ext = M.entity_frame(nat, "dataset", entity_id=key("ext-", "n_nationkey"), types=M.strings(M.DATASET_TYPES), name=F.col("n_name"),
                         formats=M.strings([".Parquet"]), props=M.json_map(rocrateName=M.quote_opt(F.concat(F.lit("A&B "), "n_name"))))
    ref = lambda df, src, pred, dst: M.edge_frame(df.select("crate_id", src.alias("src"), dst.alias("dst")), pred)
    region_task = X.mint_ark("computation", F.concat(F.lit("ROLLUP ("), A.text("n_regionkey"), F.lit(")")), key("r", "n_regionkey"))
    orders = A.orders(t).withColumnRenamed("session_id", "crate_id")
    extra = ref(sup.where("s_acctbal > 3000"), key("sample-", "s_suppkey"), "cellLineReference", key("line-", "n_nationkey")) \
        .unionByName(ref(sup.where("s_acctbal <= 3000 and s_acctbal > 0"), key("sample-", "s_suppkey"), "derivedFrom", key("line-", "n_nationkey"))) \
        .unionByName(ref(nat, region_task, "usedDataset", key("ext-", "n_nationkey"))) \
        .unionByName(ref(orders, key("exp-", "c_custkey"), "generated", R.dataset_ark(A.path_of("order", "o_orderkey", "json")))) \
        .unionByName(ref(cus.where("c_acctbal > 0"), key("exp-", "c_custkey"), "generated", R.dataset_ark(A.path_of("customer", "c_custkey"))))
    more = samples.unionByName(lines).unionByName(exps).unionByName(ext)
    # the run crates are written already
    return M.Graph(g.entities.unionByName(cut(more, "lab-entities")), g.edges.unionByName(cut(extra, "lab-edges")))
