"""Queries that check graphs against themselves, their runs, and each other."""

from __future__ import annotations

from pyspark.sql import functions as F

from provlake.functions import text as X
from provlake.functions import types as K
from provlake.functions.values import prop
from provlake.model import Graph, json_map, quote, quote_opt
from provlake.operators import audit as Q
from provlake.operators import entail, runs as R
from provlake.plans import adapter as A, provenance as P
from provlake.plans.shared import graph, graph_plan, once, resolved, table
from provlake.plans.sqlbase import ark, bare, data_ark, query
from provlake.sources import versions as V

QUERIES, SQL = {}, {}


def register(name, sql=None):
    def wrap(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return wrap


def crates(spark, folder):
    from provlake.sources.crates import crates_of
    return once(spark, folder, "crates", lambda: crates_of(graph(spark, folder)))


@register("profile_declared", query("SELECT session_id AS crate_id, true AS has_descriptor, true AS conforms, true AS has_root, true AS about_root FROM run", "run"))
def profile_declared(spark, folder):
    g = graph(spark, folder)
    return Q.profile_declared(g.entities, g.edges)


@register("dangling_refs", query("""SELECT crate_id, src, predicate, dst FROM edge e WHERE predicate IN ('hasPart', 'usedDataset', 'usedSoftware', 'generated', 'generatedBy', 'isPartOf', 'about')
    AND NOT EXISTS (SELECT 1 FROM kept k WHERE k.crate_id = e.crate_id AND k.id = e.dst)""", "edge", "ent", "data",
                                 extra={"kept": "SELECT crate_id, id FROM ent EXCEPT SELECT session_id, ark FROM data WHERE path LIKE '%.tsv'"}))
def dangling_refs(spark, folder):
    """References left open when the tab-separated files are taken out of the crates."""
    g = graph(spark, folder)
    return Q.dangling_references(g.entities.where(~F.array_contains("formats", "tsv")), g.edges)


@register("implausible_authors", """SELECT 'docs-' || source AS crate_id, '' AS author FROM documents GROUP BY source HAVING substr(source, 4)::INTEGER % 4 = 3
    UNION ALL SELECT 'docs-' || source, 'Eve' FROM documents GROUP BY source HAVING substr(source, 4)::INTEGER % 4 = 2""")
def implausible_authors(spark, folder):
    from provlake.plans import library as L
    return Q.implausible_authors(table(spark, folder, "source-roots", L.source_roots), user="Eve")


@register("missing_lineage", query("SELECT session_id AS crate_id FROM run WHERE r_regionkey > 2", "run"))
def missing_lineage(spark, folder):
    c = crates(spark, folder).withColumn("root_props", F.map_concat("root_props", F.create_map(F.lit("localEvidenceGraph"), F.lit('{"@id":"g"}'))))
    written = A.regions(A.Tables(spark, folder)).where("r_regionkey <= 2").select(F.col("session_id").alias("crate_id"))
    return Q.missing_lineage(c, written)


@register("stale_versions", query("""SELECT session_id AS crate_id, count(*)::BIGINT AS processes, count(*) FILTER (process NOT LIKE 'TRADE:CUSTOMERS:%')::BIGINT AS stale,
    false AS reports, 'note' AS verdict FROM procs GROUP BY ALL""", "procs"))
def stale_versions(spark, folder):
    g = graph(spark, folder)
    return Q.tool_versions(g.entities, g.edges, crates(spark, folder))


@register("stem_collisions", query("""SELECT session_id AS crate_id, regexp_replace(software, '-[^-]*$', '') AS stem, count(*)::BIGINT AS n FROM procs
    GROUP BY ALL HAVING count(*) > 1""", "procs"))
def stem_collisions(spark, folder):
    g = graph(spark, folder)
    return Q.stem_collisions(g.entities, g.edges)


@register("comment_headed", """SELECT doc_id::VARCHAR AS file, regexp_extract(text, '^([^,\\n]*)', 1) AS name FROM documents WHERE starts_with(text, '#')
    UNION ALL SELECT 'tagged-' || doc_id, '#' || lang FROM documents""")
def comment_headed(spark, folder):
    d = A.Tables(spark, folder).documents
    line = lambda text, file: d.select(file.alias("file"), F.posexplode(F.split(F.regexp_extract(text, r"\A([^\n]*)", 1), ",", -1)).alias("position", "name"))
    return Q.comment_headed(line(F.col("text"), A.text("doc_id")).unionByName(
        line(F.concat(F.lit("#"), "lang", F.lit(",x\n"), "text"), F.concat(F.lit("tagged-"), A.text("doc_id")))))


@register("duplicate_content", query("""SELECT crate_id, md5, count(*)::BIGINT AS n_files, count(DISTINCT producer)::BIGINT AS n_producers FROM (
    SELECT session_id AS crate_id, md5(o_custkey || '-' || o_orderpriority) AS md5, 'o' || o_orderkey AS producer FROM ord WHERE status <> 'FAILED'
    UNION ALL SELECT session_id, md5(p_name), NULL FROM part JOIN (SELECT DISTINCT session_id, regexp_extract(path, '(\\d+)\\.', 1)::BIGINT AS p_partkey FROM t_in
        WHERE path LIKE 'work/part/%') USING (p_partkey)) GROUP BY ALL HAVING count(DISTINCT producer) > 1""", "ord", "t_in"))
def duplicate_content(spark, folder):
    t = A.Tables(spark, folder)
    made = A.orders(t).where("status <> 'FAILED'").select(F.col("session_id").alias("crate_id"), F.md5(F.concat(
        A.text("o_custkey"), F.lit("-"), "o_orderpriority")).alias("md5"), F.concat(F.lit("o"), A.text("o_orderkey")).alias("producer"))
    staged = A.task_inputs(t).where(F.startswith("path", F.lit("work/part/"))).select("session_id", "path").distinct() \
        .withColumn("p_partkey", F.regexp_extract("path", r"(\d+)\.", 1).cast("bigint")).join(t.part.select("p_partkey", "p_name"), "p_partkey") \
        .select(F.col("session_id").alias("crate_id"), F.md5("p_name").alias("md5"), F.lit(None).cast("string").alias("producer"))
    return Q.duplicate_content(made.unionByName(staged))


def _located(spark, folder):
    """Datasets against a listing that lost the customers' work files and has other orders."""
    g = graph(spark, folder)
    data = g.entities.where(K.evi_type("types") == "Dataset")
    files = A.files(A.Tables(spark, folder)).where(~F.col("path").rlike(r"\Awork/part/.*\.tsv\z|\Aresults/nation/"))
    files = files.withColumn("length", F.when(F.startswith("path", F.lit("work/order/")), F.col("length") + 1).otherwise(F.col("length"))) \
        .withColumn("md5", F.when(F.startswith("path", F.lit("results/region/")), "x").otherwise(F.col("md5"))).withColumnRenamed("session_id", "crate_id")
    return Q.locator_status(data, files, "results", "")


@register("locator_status", query("""SELECT session_id AS crate_id, ark AS entity_id, CASE WHEN shown LIKE 'results/nation/%' THEN 'broken' WHEN shown LIKE 'results/%' THEN 'crate'
    WHEN shown LIKE '%.tsv' THEN 'gone' ELSE 'local' END AS status FROM data""", "data"))
def locator_status(spark, folder):
    return _located(spark, folder).select("crate_id", "entity_id", "status")


@register("content_mismatches", query("""SELECT session_id AS crate_id, ark AS entity_id, 'size' AS problem FROM data WHERE shown LIKE 'work/order/%'
    UNION ALL SELECT session_id, ark, 'md5' FROM data WHERE shown LIKE 'results/region/%'""", "data"))
def content_mismatches(spark, folder):
    return Q.content_mismatches(_located(spark, folder))


def _computations(spark, folder):
    g = graph_plan(spark, folder, ["run", "task"])
    part = g.edges.where("predicate = 'isPartOf'").select("crate_id", F.col("src").alias("entity_id"), F.lit(True).alias("is_part"))
    c = g.entities.where(K.evi_type("types") == "Computation").join(part, ["crate_id", "entity_id"], "left")
    return c.select("crate_id", F.col("entity_id").alias("comp"), prop("props", "identifier").alias("identifier"),
                    prop("props", "command").alias("command"), prop("props", "containerImage").alias("image"), F.col("is_part").isNull().alias("is_run"))


def _trace(t):
    """The run's own record: every task but orders without line items."""
    busy = t.lineitem.select(F.concat(F.lit("o"), A.text("l_orderkey")).alias("task_hash")).distinct()
    tasks = A.tasks(t)
    orders = F.startswith("task_hash", F.lit("o"))
    rows = tasks.where(~orders).unionByName(tasks.where(orders).join(busy, "task_hash", "left_semi").select(*tasks.columns))
    return rows.select(F.col("session_id").alias("crate_id"), F.col("task_hash").alias("identifier"), "status", "script", "container", "process")


@register("task_coverage", query("""SELECT session_id AS crate_id, task_hash AS identifier, 'missing' AS side FROM tasks WHERE status = 'FAILED'
        AND EXISTS (SELECT 1 FROM lineitem WHERE 'o' || l_orderkey = task_hash)
    UNION ALL SELECT session_id, task_hash, 'extra' FROM ok_tasks WHERE task_hash LIKE 'o%' AND NOT EXISTS (SELECT 1 FROM lineitem WHERE 'o' || l_orderkey = task_hash)""",
                                 "tasks", "ok_tasks"))
def task_coverage(spark, folder):
    return Q.task_coverage(_trace(A.Tables(spark, folder)), _computations(spark, folder))


@register("command_mismatches", query("""SELECT session_id AS crate_id, task_hash AS identifier FROM ok_tasks WHERE status = 'CACHED'""", "ok_tasks"))
def command_mismatches(spark, folder):
    """Cached tasks ran a script with another second line."""
    t = A.tasks(A.Tables(spark, folder))
    body = F.regexp_replace("script", r"\A#![^\n]*\n", "")
    script = F.concat(F.lit("#!/bin/bash -ue\n\n  "), F.when(F.col("status") == "CACHED", F.replace(body, F.lit("publish"), F.lit("push"))).otherwise(body), F.lit("\nenv > .env\n"))
    ran = t.select(F.col("session_id").alias("crate_id"), F.col("task_hash").alias("identifier"), script.alias("script"))
    return Q.command_mismatches(ran, _computations(spark, folder))


@register("image_mismatches", query("""SELECT session_id AS crate_id, task_hash AS identifier, container AS claimed, container || '-rc' AS ran FROM ok_tasks WHERE status = 'CACHED'""", "ok_tasks"))
def image_mismatches(spark, folder):
    t = A.tasks(A.Tables(spark, folder))
    image = F.concat("container", F.when(F.col("status") == "CACHED", "-rc").otherwise(""))
    launch = F.concat(F.lit("set -e\ndocker run -i --rm -v /w:/w "), image, F.lit(" /bin/bash -c run\n"))
    ran = t.select(F.col("session_id").alias("crate_id"), F.col("task_hash").alias("identifier"), launch.alias("launch"))
    return Q.image_mismatches(ran, _computations(spark, folder))


def _support(spark, folder):
    """Claimed inputs against a run that never staged the parts of returned lines."""
    def make():
        t = A.Tables(spark, folder)
        z = resolved(spark, folder)
        rows = lambda df: df.select(F.col("session_id").alias("crate_id"), F.col("task_hash").alias("identifier"), F.md5("path").alias("md5"))
        said = rows(z.inputs.where(~F.startswith("path", F.lit("work/nation/"))))
        did = rows(R.of_tasks(A.task_inputs(t, t.lineitem.where("l_returnflag <> 'R'")), z.tasks))
        from provlake.session import cut, workspace
        return cut(Q.edge_support(said, did), "support")
    return once(spark, folder, "support", make)


SUPPORT = {
    "lines": "SELECT DISTINCT l_orderkey, 'work/part/' || p_partkey || CASE WHEN p_size % 2 = 0 THEN '.csv' ELSE '.tsv' END AS path FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_returnflag <> 'R'",
    "said": "SELECT DISTINCT session_id AS crate_id, task_hash AS identifier, md5(path) AS md5 FROM k_in WHERE path NOT LIKE 'work/nation/%'",
    "did": """SELECT DISTINCT session_id AS crate_id, task_hash AS identifier, md5(path) AS md5 FROM (SELECT session_id, task_hash, path FROM k_in WHERE path NOT LIKE 'work/part/%'
        UNION ALL SELECT session_id, task_hash, path FROM lines JOIN ok_tasks ON task_hash = 'o' || l_orderkey)""",
}


@register("fabricated_edges", query("SELECT crate_id, identifier, md5 FROM said EXCEPT SELECT crate_id, identifier, md5 FROM did", "k_in", "ok_tasks", extra=SUPPORT))
def fabricated_edges(spark, folder):
    return _support(spark, folder).where("state = 'fabricated'").drop("state")


@register("edge_coverage", query("""SELECT d.crate_id, covered::BIGINT AS covered, n::BIGINT AS actual, (m - covered)::BIGINT AS fabricated, covered / n AS ratio FROM (
        SELECT crate_id, count(*) AS n FROM did GROUP BY ALL) d JOIN (SELECT crate_id, count(*) AS m FROM said GROUP BY ALL) s USING (crate_id)
    JOIN (SELECT crate_id, count(*) AS covered FROM said JOIN did USING (crate_id, identifier, md5) GROUP BY ALL) USING (crate_id)""", "k_in", "ok_tasks", extra=SUPPORT))
def edge_coverage(spark, folder):
    return Q.coverage(_support(spark, folder))


@register("broken_derivation", query("""SELECT i.session_id AS crate_id, sha1(i.task_hash) AS identifier,
    '/run/work/' || left(sha1(o.task_hash), 2) || '/' || substr(sha1(o.task_hash), 3) || '/' || regexp_extract(i.path, '([^/]*)$', 1) AS source
    FROM k_in i JOIN k_out o USING (session_id, path) WHERE i.path LIKE 'work/order/%' AND EXISTS (SELECT 1 FROM ord WHERE o_orderpriority = '1-URGENT'
        AND 'o' || o_orderkey = o.task_hash)""", "k_in", "k_out", "ord"))
def broken_derivation(spark, folder):
    """Attribution of urgent orders' files is withheld from the graph."""
    z = resolved(spark, folder)
    t = A.Tables(spark, folder)
    h = F.sha1("maker")
    makers = z.outputs.select("session_id", "path", F.col("task_hash").alias("maker"))
    staged = z.inputs.join(makers, ["session_id", "path"]).select(
        F.col("session_id").alias("crate_id"), F.sha1("task_hash").alias("identifier"), F.concat(
            F.lit("/run/work/"), F.substring(h, 1, 2), F.lit("/"), F.substring(h, 3, 38), F.lit("/"), X.basename("path")).alias("source"), F.md5("path").alias("md5"))
    comps = z.tasks.select(F.col("session_id").alias("crate_id"), F.sha1("task_hash").alias("identifier"), "comp")
    data = z.outputs.select(F.col("session_id").alias("crate_id"), F.col("ark").alias("entity_id"), F.md5("path").alias("md5"))
    urgent = A.orders(t).where("o_orderpriority = '1-URGENT'").select("session_id", F.concat(F.lit("o"), A.text("o_orderkey")).alias("task_hash"))
    said = z.outputs.join(urgent, ["session_id", "task_hash"], "left_anti").select(
        F.col("session_id").alias("crate_id"), F.col("ark").alias("src"), F.col("comp").alias("dst"))
    return Q.broken_derivations(staged, comps, data, said)


@register("failed_with_outputs", query("""SELECT session_id AS crate_id, task_hash AS identifier, status, 1::BIGINT AS n_generated FROM tasks WHERE status = 'FAILED'
    AND EXISTS (SELECT 1 FROM lineitem WHERE 'o' || l_orderkey = task_hash)""", "tasks"))
def failed_with_outputs(spark, folder):
    """A graph that claims the outputs of all tasks, failed ones too."""
    t = A.Tables(spark, folder)
    claims = A.task_outputs(t).select(F.col("session_id").alias("crate_id"), F.col("task_hash").alias("identifier"))
    return Q.failed_with_outputs(_trace(t), claims)


def _parts(t, side):
    p = t.part
    tags = F.concat(F.lit("["), quote("p_type"), F.lit(","), quote("p_brand"), F.lit("]"))
    back = F.concat(F.lit("["), quote("p_brand"), F.lit(","), quote("p_type"), F.lit("]"))
    if side == "left":
        p = p.where("p_size > 1")
        props = json_map(name=quote("p_name"), size=A.text("p_size"), tags=tags, shape=F.lit('{"a": 1, "b": [2]}'), old=F.when(F.col("p_size") > 40, F.lit("1")))
    else:
        p = p.where("p_size < 50")
        props = json_map(name=quote(F.when(F.col("p_type") == "PROMO", F.upper("p_name")).otherwise(F.col("p_name"))), size=A.text("p_size"), tags=back,
                         shape=F.lit('{"b":[2],"a":1}'), new=F.when(F.col("p_size") < 10, F.lit("true")))
    return p.select(F.col("p_brand").alias("crate_id"), A.text("p_partkey").alias("entity_id"), props.alias("props"))


@register("graph_diff", """SELECT p_brand AS crate_id, p_partkey::VARCHAR AS entity_id, key, problem FROM (
    SELECT *, NULL::VARCHAR AS key, 'only right' AS problem FROM part WHERE p_size <= 1 UNION ALL SELECT *, NULL, 'only left' FROM part WHERE p_size >= 50
    UNION ALL SELECT *, 'name', 'differs' FROM part WHERE p_size > 1 AND p_size < 50 AND p_type = 'PROMO'
    UNION ALL SELECT *, 'old', 'only left' FROM part WHERE p_size > 40 AND p_size < 50 UNION ALL SELECT *, 'new', 'only right' FROM part WHERE p_size > 1 AND p_size < 10)""")
def graph_diff(spark, folder):
    t = A.Tables(spark, folder)
    return Q.graph_diff(_parts(t, "left"), _parts(t, "right"))


# ---- version files made of conversations: a user or system turn opens a process, every turn reports tools

def _version_lines(t):
    c = t.conversations
    text = F.concat(F.when(F.col("role") == "assistant", F.lit("# reply\n")).otherwise(F.concat(F.lit("'"), F.upper("role"), F.lit("':\n"))),
                    F.lit('  chars: "'), F.length("text").cast("string"), F.lit('"\n    turn : v'), A.text("turn"), F.lit("\n  blank:\n\n"), "text")
    lines = c.select("conv_id", "turn", F.posexplode(F.split(text, "\n", -1)).alias("k", "line"))
    return lines.select(A.text("conv_id").alias("file"), (F.col("turn") * 1000000 + F.col("k")).alias("line_no"), "line")


PAIRS_CTE = """opened AS (SELECT conv_id, turn, length(text) AS n, max(CASE WHEN role <> 'assistant' THEN turn END) OVER (PARTITION BY conv_id ORDER BY turn) AS open_turn FROM conversations),
    named AS (SELECT o.conv_id, o.turn, n, upper(c.role) AS process FROM opened o JOIN conversations c ON c.conv_id = o.conv_id AND c.turn = o.open_turn),
    pairs AS (SELECT conv_id, process, tool, arg_max(version, turn) AS version, min(turn) AS first_turn FROM (
        SELECT conv_id, process, turn, unnest(['chars', 'turn']) AS tool, unnest([n::VARCHAR, 'v' || turn]) AS version FROM named) GROUP BY ALL)"""


@register("tool_versions", f"WITH {PAIRS_CTE} SELECT conv_id::VARCHAR AS file, process, tool, version FROM pairs")
def tool_versions(spark, folder):
    """Version files, one for each conversation, written with CRLF and read back in splits."""
    from provlake.session import workspace
    home = workspace(spark, "version-files")
    lines = _version_lines(A.Tables(spark, folder))
    lines.repartition("file").sortWithinPartitions("file", "line_no").select("file", F.col("line").alias("value")).write.partitionBy("file").text(home, lineSep="\r\n")
    pairs = V.version_pairs(V.read_lines(spark, home))
    return pairs.select(F.regexp_extract("file", "/file=([^/]*)/", 1).alias("file"), "process", "tool", "version")


@register("version_texts", f"WITH {PAIRS_CTE} SELECT conv_id::VARCHAR AS file, process, string_agg(tool || ' ' || version, ', ' ORDER BY tool) AS version FROM pairs GROUP BY conv_id, process")
def version_texts(spark, folder):
    pairs = V.version_pairs(_version_lines(A.Tables(spark, folder)))
    return V.version_texts(pairs, ["file", "process"], "first_line")


@register("merged_versions", f"WITH {PAIRS_CTE} SELECT process, tool, arg_max(version, conv_id) AS version FROM pairs GROUP BY ALL")
def merged_versions(spark, folder):
    pairs = V.version_pairs(_version_lines(A.Tables(spark, folder))).withColumn("file_seq", F.col("file").cast("bigint"))
    return V.merged_versions(pairs).select("process", "tool", "version")


@register("process_versions", query("""SELECT DISTINCT session_id, process, CASE WHEN process LIKE 'TRADE:NATIONS:%' THEN 'own' WHEN process LIKE 'TRADE:CUSTOMERS:%' THEN 'bare ' || regexp_extract(process, '([^:]*)$', 1)
    WHEN process LIKE 'TRADE:ORDERS:%' THEN 'full ' || process WHEN process LIKE 'TRADE:REGIONS:%' THEN 'bare ROLLUP' END AS version FROM tasks""", "tasks"))
def process_versions(spark, folder):
    p = A.processes(A.Tables(spark, folder))
    own = p.where("process like 'TRADE:NATIONS:%'").select("session_id", "process", F.lit("own").alias("version"))
    bare = p.where("process not like 'TRADE:ORDERS:%'").select("session_id", X.bare_name("process").alias("process")).distinct().withColumn("version", F.concat(F.lit("bare "), "process"))
    full = p.where("process like 'TRADE:ORDERS:%'").select("session_id", "process", F.concat(F.lit("full "), "process").alias("version"))
    return V.process_versions(p, own, bare.unionByName(full))


@register("collated_files", """SELECT page_id, url || '_software_Versions.YAML' AS path FROM pages WHERE page_id % 3 = 0 UNION ALL SELECT page_id, url || '/my.versions.yml' FROM pages WHERE page_id % 3 = 1""")
def collated_files(spark, folder):
    p = A.Tables(spark, folder).pages
    kind = F.col("page_id") % 3
    path = F.when(kind == 0, F.concat("url", F.lit("_software_Versions.YAML"))).when(kind == 1, F.concat("url", F.lit("/my.versions.yml"))).otherwise(F.concat("url", F.lit("/versions.yml")))
    return V.collated_files(p.select("page_id", path.alias("path")))
