"""Queries over run logs: tasks, files, identifiers, parameters, images."""

from __future__ import annotations

from pyspark.sql import functions as F

from provlake.functions import text as X
from provlake.operators import containers, filetree, runs as R
from provlake.plans import adapter as A, provenance as P
from provlake.plans.shared import graph, resolved
from provlake.plans.sqlbase import ark, bare, base, data_ark, query, slug, trim

QUERIES, SQL = {}, {}


def register(name, sql=None):
    def wrap(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return wrap


def kept(t):
    return R.kept_tasks(A.tasks(t), A.runs(t))


@register("kept_tasks", query("SELECT session_id, process, status, count(*) AS n FROM ok_tasks GROUP BY ALL", "ok_tasks"))
def kept_tasks(spark, folder):
    return kept(A.Tables(spark, folder)).groupBy("session_id", "process", "status").agg(F.count("*").alias("n"))


@register("producers", query("SELECT session_id, path, task_hash FROM k_out", "k_out"))
def producers(spark, folder):
    t = A.Tables(spark, folder)
    return R.producers(kept(t), A.task_outputs(t))


@register("run_inputs", query("SELECT session_id, path FROM r_in", "r_in"))
def run_inputs(spark, folder):
    t = A.Tables(spark, folder)
    tasks = kept(t)
    return R.run_inputs(R.of_tasks(A.task_inputs(t), tasks), R.of_tasks(A.task_outputs(t), tasks))


@register("staged_name_clashes", query("""SELECT session_id, task_hash, stage_name, count(DISTINCT path)::BIGINT AS n_paths
    FROM (SELECT session_id, 'n' || n_nationkey AS task_hash, regexp_extract(path, '([^/]*)$', 1) AS stage_name, path FROM (
        SELECT session_id, n_nationkey, 'work/' || c_mktsegment || '/' || o_orderkey % 100 || '.csv' AS path FROM ord JOIN cust USING (c_custkey, session_id, n_nationkey)))
    GROUP BY ALL HAVING count(DISTINCT path) > 1""", "ord", "cust"))
def staged_name_clashes(spark, folder):
    t = A.Tables(spark, folder)
    o = A.orders(t)
    path = F.concat(F.lit("work/"), "c_mktsegment", F.lit("/"), A.text(F.col("o_orderkey") % 100), F.lit(".csv"))
    staged = o.select("session_id", F.concat(F.lit("n"), A.text("n_nationkey")).alias("task_hash"),
                      F.create_map(X.basename(path), path).alias("inputs"))
    return R.staged_name_clashes(R.staged_inputs(staged))


@register("flat_outputs", query("""SELECT session_id, 'c' || c_custkey AS task_hash, k::INTEGER AS ord,
    CASE k WHEN 0 THEN 'work/customer/' || c_custkey || '.csv' WHEN 1 THEN 'work/nation/' || n_nationkey || '.csv'
        ELSE 'work/log/' || c_custkey || '.txt' END AS path FROM cust, (SELECT unnest([0, 1, 2]) AS k)""", "cust"))
def flat_outputs(spark, folder):
    c = A.customers(A.Tables(spark, folder))
    outs = F.array(F.array(A.path_of("customer", "c_custkey"), A.path_of("nation", "n_nationkey")),
                   F.array(A.path_of("log", "c_custkey", "txt")))
    return R.flat_outputs(c.select("session_id", F.concat(F.lit("c"), A.text("c_custkey")).alias("task_hash"),
                                   outs.alias("outputs"))).withColumn("ord", F.col("ord").cast("int"))


@register("publish_alias", query(f"""SELECT session_id, source AS key, target, {data_ark('source')} AS ark FROM pub""", "pub"))
def publish_alias(spark, folder):
    t = A.Tables(spark, folder)
    pub = R.successful_runs(R.latest_publishes(A.publishes(t)), A.runs(t), "target")
    rows = R.with_dataset_ark(pub.withColumn("path", F.col("target")).drop("key"), R.aliases(pub))
    return rows.join(R.aliases(pub).select("session_id", "path", "key"), ["session_id", "path"]).select(
        "session_id", "key", "target", "ark")


@register("publish_globs", query("""SELECT session_id, target FROM pub
    WHERE regexp_full_match(target, '.*/customer/[^/]*[05]\\.csv') OR regexp_full_match(target, '.*/[^/]*\\.(yml|yaml)')""", "pub"))
def publish_globs(spark, folder):
    t = A.Tables(spark, folder)
    return R.latest_publishes(A.publishes(t), ["customer/*[05].csv", "*.{yml,yaml}"]).select("session_id", "target")


@register("self_use_removed", query("""SELECT u.session_id, u.comp, count(*)::BIGINT AS n_used FROM used u
    WHERE NOT EXISTS (SELECT 1 FROM made m WHERE m.session_id = u.session_id AND m.comp = u.comp AND m.ark = u.ark)
    GROUP BY ALL""", "used", "made"))
def self_use_removed(spark, folder):
    t = A.Tables(spark, folder)
    used, made = P.uses(resolved(spark, folder), A.run_log(t))
    out = R.self_use_removed(used, made)
    return out.groupBy("session_id", "comp").agg(F.count("*").alias("n_used"))


@register("ark_ids", query(f"""SELECT session_id, task_hash, comp, {ark('software', bare('process'), "'flows/trade.flow#' || process")} AS software
    FROM ok_tasks""", "ok_tasks"))
def ark_ids(spark, folder):
    log = A.run_log(A.Tables(spark, folder))
    return P.keys_of(log, X.DEFAULT_NAAN)["tasks"].select(
        "session_id", "task_hash", "comp", P.software_ark("process", F.lit("flows/trade.flow")).alias("software"))


@register("slugs", f"""SELECT page_id, {slug('url')} AS url_slug, {slug("regexp_extract(html, '<title>([^<]*)', 1)")} AS title_slug FROM pages""")
def slugs(spark, folder):
    t = A.Tables(spark, folder)
    return t.pages.select("page_id", X.slugify("url").alias("url_slug"),
                          X.slugify(F.regexp_extract("html", "<title>([^<]*)", 1)).alias("title_slug"))


@register("bare_names", query(f"SELECT DISTINCT process, {bare('process')} AS bare_name FROM tasks", "tasks"))
def bare_names(spark, folder):
    return A.tasks(A.Tables(spark, folder)).select("process", X.bare_name("process").alias("bare_name")).distinct()


LOCATOR_SQL = """SELECT page_id,
    CASE WHEN starts_with(place, 'results/') THEN substr(place, 9) WHEN starts_with(place, 'file://') THEN NULL
         WHEN regexp_matches(place, '^[a-zA-Z][a-zA-Z0-9+.-]*://') THEN place END AS content_url,
    CASE WHEN starts_with(place, 'results/') THEN NULL WHEN starts_with(place, 'file://') THEN substr(place, 8)
         WHEN regexp_matches(place, '^[a-zA-Z][a-zA-Z0-9+.-]*://') THEN NULL ELSE place END AS local_path
    FROM (SELECT page_id, CASE page_id % 4 WHEN 0 THEN url WHEN 1 THEN 'file:///' || regexp_replace(url, '^https?://', '')
        WHEN 2 THEN 'results/' || regexp_replace(url, '^https?://', '') ELSE regexp_replace(url, '^https?://', '') END AS place FROM pages)"""


@register("dataset_locators", LOCATOR_SQL)
def dataset_locators(spark, folder):
    t = A.Tables(spark, folder)
    tail = F.regexp_replace("url", "^https?://", "")
    kind = F.col("page_id") % 4
    place = F.when(kind == 0, F.col("url")).when(kind == 1, F.concat(F.lit("file:///"), tail)) \
        .when(kind == 2, F.concat(F.lit("results/"), tail)).otherwise(tail)
    return t.pages.select("page_id", X.file_locator(place, F.lit("results")).alias("l")).select("page_id", "l.*")


@register("definition_locators", query("""SELECT session_id, process,
    CASE WHEN process LIKE '%ORDERS%' THEN 'workflow/trade.flow' END AS content_url,
    CASE WHEN process LIKE '%ORDERS%' THEN NULL ELSE 'flows/trade.flow' END AS local_path
    FROM (SELECT DISTINCT session_id, process FROM tasks)""", "tasks"))
def definition_locators(spark, folder):
    p = A.processes(A.Tables(spark, folder))
    copy = F.when(F.contains("process", F.lit("ORDERS")), "workflow/trade.flow")
    return p.select("session_id", "process", X.definition_locator("script_path", copy, F.lit("results")).alias("l")).select(
        "session_id", "process", "l.*")


@register("file_formats", query(f"""SELECT fmt AS format, tabular, count(*) AS n FROM (SELECT CASE {base('path').replace(chr(10), '')} WHEN '' THEN 'unknown' ELSE
    CASE regexp_extract(path, '\\.([^./]*)$', 1) WHEN 'csv' THEN 'text/csv' WHEN 'tsv' THEN 'text/tab-separated-values'
    WHEN 'json' THEN 'application/json' WHEN 'yml' THEN 'application/yaml' END END AS fmt,
    regexp_extract(path, '\\.([^./]*)$', 1) IN ('csv', 'tsv') AS tabular FROM data) GROUP BY ALL""", "data"))
def file_formats(spark, folder):
    t = A.Tables(spark, folder)
    f = P.file_table(resolved(spark, folder), A.run_log(t))
    return f.groupBy(filetree.file_format("first_path").alias("format"), filetree.is_tabular("first_path").alias("tabular")) \
        .agg(F.count("*").alias("n"))


@register("process_images", query("""SELECT session_id, process, min(container) AS container FROM ok_tasks
    GROUP BY ALL HAVING count(DISTINCT container) = 1""", "ok_tasks"))
def process_images(spark, folder):
    return R.process_images(kept(A.Tables(spark, folder)))


@register("param_files", query("""
    SELECT session_id, 'sheet_' || c_custkey AS name, 'results/customer/' || c_custkey || '.csv' AS path FROM cust
    UNION ALL SELECT session_id, 'remote_' || c_custkey, 's3://trade/in/' || c_custkey || '.csv' FROM cust""", "cust"))
def param_files(spark, folder):
    t = A.Tables(spark, folder)
    return R.param_files(A.params(t), A.files(t))


@register("folded_params", query("""SELECT session_id, 'sheet_' || c_custkey AS name, 'sheet_' || c_custkey || ': results/customer/' || c_custkey || '.csv' AS parameter FROM cust
    UNION ALL SELECT session_id, 'remote_' || c_custkey, 'remote_' || c_custkey || ': s3://trade/in/' || c_custkey || '.csv' FROM cust
    UNION ALL SELECT session_id, 'gone_' || c_custkey, 'gone_' || c_custkey || ': lost/customer/' || c_custkey || '.csv' FROM cust
    UNION ALL SELECT session_id, 'dir_' || c_custkey, 'dir_' || c_custkey || ': results/' || lower(c_mktsegment) FROM cust
    UNION ALL SELECT session_id, 'limits_' || c_custkey, 'limits_' || c_custkey || ': [' || c_custkey || ',' || n_nationkey || ']' FROM cust
    UNION ALL SELECT session_id, 'empty_' || c_custkey, 'empty_' || c_custkey || ': null' FROM cust""", "cust"))
def folded_params(spark, folder):
    return R.folded_params(A.params(A.Tables(spark, folder)))


@register("annotation_overlay", query("""SELECT DISTINCT session_id, process,
    CASE WHEN process LIKE 'TRADE:CUSTOMERS:%' THEN lower(regexp_extract(process, '([^:]*)$', 1)) ELSE process END AS name,
    CASE WHEN process LIKE 'TRADE:CUSTOMERS:%' THEN '8.32' ELSE '2.1' END AS version,
    CASE WHEN process LIKE 'TRADE:NATIONS:%' THEN 'https://example.org/rollup' END AS content_url,
    'def key = 1' || chr(10) || chr(10) || 'build ' || lower(regexp_extract(process, '([^:]*)$', 1)) AS description
    FROM tasks""", "tasks"))
def annotation_overlay(spark, folder):
    g = graph(spark, folder)
    procs = g.entities.where((F.col("pos") >= 5 * 10 ** 15) & (F.col("pos") < 6 * 10 ** 15))
    from provlake.functions.values import prop
    t = A.processes(A.Tables(spark, folder)).select(F.col("session_id").alias("crate_id"), "process",
                                                    P.software_ark("process", "script_path").alias("entity_id"))
    return procs.join(t, ["crate_id", "entity_id"]).select(
        F.col("crate_id").alias("session_id"), "process", "name", prop("props", "version").alias("version"), "content_url", "description")


@register("annotation_warnings", query("""SELECT DISTINCT session_id, process, 'unrecognized keys' AS problem, 'ownerTeam' AS keys
    FROM tasks WHERE process LIKE 'TRADE:CUSTOMERS:%'""", "tasks"))
def annotation_warnings(spark, folder):
    return R.annotation_warnings(A.processes(A.Tables(spark, folder)))


@register("script_blocks", query("""SELECT task_hash, 'def x = 1' || chr(10) || script AS stripped,
    ['build ' || level || ' --key ' || key, 'publish ' || key] = ['build ' || level || ' --key ' || key, 'publish ' || key] AS same
    FROM (SELECT *, regexp_extract(container, '/([a-z]+):', 1) AS level, substr(task_hash, 2) AS key FROM tasks)""", "tasks"))
def script_blocks(spark, folder):
    t = A.tasks(A.Tables(spark, folder))
    body = F.concat(F.lit('def x = 1\n"""'), "script", F.lit('"""\n'))
    ran = F.concat(F.lit("#!/bin/bash\nset -e\n"), F.regexp_replace("script", r"\A#![^\n]*\n", ""), F.lit("\n\ndone"))
    return t.select("task_hash", X.strip_script_delimiters(body).alias("stripped"),
                    X.contains_block(X.script_lines(ran), X.script_lines("script")).alias("same"))


@register("credited_names", """SELECT c_custkey, CASE WHEN c_acctbal > 0 THEN c_name || CASE WHEN c_acctbal > 5000 THEN ', ' || c_mktsegment ELSE '' END
    ELSE c_name || ', ' || c_mktsegment END AS author FROM customer""")
def credited_names(spark, folder):
    c = A.Tables(spark, folder).customer
    people = F.array(
        F.struct(F.col("c_name").alias("name"), F.when(F.col("c_acctbal") > 0, F.array(F.lit("Author"), F.lit("maintainer")))
                 .otherwise(F.array(F.lit("maintainer"))).alias("contribution")),
        F.struct(F.col("c_mktsegment").alias("name"), F.when(F.col("c_acctbal") > 5000, F.array(F.lit("author")))
                 .otherwise(F.array(F.lit("contributor"))).alias("contribution")))
    return c.select("c_custkey", X.credited_names(people).alias("author"))


@register("fallback_fields", """SELECT c_custkey, CASE WHEN c_acctbal > 0 THEN c_name ELSE 'Unknown' END AS author,
    CASE WHEN length(c_mktsegment) >= 10 THEN c_mktsegment ELSE 'Crate of ' || c_name END AS description FROM customer""")
def fallback_fields(spark, folder):
    c = A.Tables(spark, folder).customer
    return c.select("c_custkey", R.first_given(F.when(F.col("c_acctbal") > 0, F.col("c_name")).otherwise(""), F.lit("Unknown")).alias("author"),
                    X.ensure_description("c_mktsegment", F.concat(F.lit("Crate of "), "c_name")).alias("description"))


IMAGE_SQL = query("""SELECT image, CASE WHEN image LIKE '%/nation:%' OR image LIKE '%/region:%' THEN NULL
        ELSE repo || '@sha256:' || sha256(image) END AS digest,
    CASE WHEN image LIKE '%/nation:%' THEN NULL WHEN image LIKE '%/region:%' THEN sha256(image) ELSE 'sha256:' || sha256(repo) END AS image_id
    FROM (SELECT DISTINCT container AS image, regexp_replace(container, ':[^:/]*$', '') AS repo FROM tasks)""", "tasks")


@register("image_digest", IMAGE_SQL)
def image_digest(spark, folder):
    return containers.image_identities(A.inspect_log(A.Tables(spark, folder)))


@register("image_repositories", query("""SELECT task_hash, 'reg.example:5000/trade/' || regexp_extract(container, '/([a-z]+):', 1) AS tagged,
    'reg.example:5000/trade/' || regexp_extract(container, '/([a-z]+):', 1) AS pinned FROM tasks""", "tasks"))
def image_repositories(spark, folder):
    t = A.tasks(A.Tables(spark, folder))
    return t.select("task_hash", X.repository_of("container").alias("tagged"), X.repository_of(
        F.concat(F.regexp_replace("container", ":[^:/]*$", ""), F.lit("@sha256:"), F.sha2("container", 256))).alias("pinned"))


@register("container_entities", query(f"""SELECT DISTINCT session_id AS crate_id,
    {ark('container', 'image', 'coalesce(digest, image)')} AS entity_id, image, n_tasks FROM (
    SELECT t.session_id, image, digest, count(*)::BIGINT AS n_tasks FROM ok_tasks t JOIN ({IMAGE_SQL[IMAGE_SQL.index('SELECT image'):]}) i
    ON t.container = i.image GROUP BY ALL)""", "ok_tasks"))
def container_entities(spark, folder):
    t = A.Tables(spark, folder)
    g = P.build_provenance(A.run_log(t), identities=containers.image_identities(A.inspect_log(t)))
    uses = g.edges.where("predicate = 'usedContainer'").groupBy("crate_id", F.col("dst").alias("entity_id")).agg(F.count("*").alias("n_tasks"))
    return g.entities.where("pos between 6000000000000000 and 6999999999999999").join(uses, ["crate_id", "entity_id"]).select(
        "crate_id", "entity_id", F.col("name").alias("image"), "n_tasks")


@register("copied_names", query("""SELECT nn.session_id, path, CASE WHEN nth = 1 THEN name ELSE regexp_extract(name, '^(.*)\\.', 1) || '-' || v || '.conf' END AS copied_as
    FROM nn LEFT JOIN free f ON f.session_id = nn.session_id AND f.of = name AND j = nth - 1""", "cust", "nat", extra={
        "src": """SELECT session_id, c_custkey AS seq, 'conf/' || c_custkey || '/' || lower(c_mktsegment) || '.conf' AS path, lower(c_mktsegment) || '.conf' AS name FROM cust
        UNION ALL SELECT session_id, n_nationkey - 100, 'own/' || n_nationkey || '/building-' || (n_nationkey % 7 + 1) || '.conf', 'building-' || (n_nationkey % 7 + 1) || '.conf' FROM nat""",
        "nn": "SELECT *, row_number() OVER (PARTITION BY session_id, name ORDER BY seq, path) AS nth FROM src",
        "tk": """SELECT DISTINCT session_id, regexp_extract(name, '^(.*)-([0-9]+)\\.conf$', 1) AS stem, regexp_extract(name, '^(.*)-([0-9]+)\\.conf$', 2)::BIGINT AS number
        FROM src WHERE regexp_matches(name, '-([2-9]|[1-9][0-9]+)\\.conf$')""",
        "free": """SELECT session_id, name AS of, v, row_number() OVER (PARTITION BY session_id, name ORDER BY v) AS j
        FROM (SELECT session_id, name, unnest(range(2, count(*) + 40)) AS v FROM nn GROUP BY session_id, name) f WHERE NOT EXISTS (
            SELECT 1 FROM tk WHERE tk.session_id = f.session_id AND tk.stem = regexp_extract(f.name, '^(.*)\\.', 1) AND tk.number = v)"""}))
def copied_names(spark, folder):
    """Names of configuration files, some of which spell out numbers that repeats would take."""
    t = A.Tables(spark, folder)
    path = lambda top, key, name: F.concat(F.lit(top), A.text(key), F.lit("/"), name, F.lit(".conf")).alias("path")
    src = A.customers(t).select("session_id", path("conf/", "c_custkey", F.lower("c_mktsegment")), F.col("c_custkey").cast("bigint").alias("seq"))
    own = A.nations(t).select("session_id", path("own/", "n_nationkey", F.concat(F.lit("building-"), (F.col("n_nationkey") % 7 + 1).cast("string"))),
                              (F.col("n_nationkey") - 100).cast("bigint").alias("seq"))
    return R.copied_names(src.unionByName(own)).select("session_id", "path", "copied_as")


@register("tree_sizes", query("""SELECT session_id, dir, count(*)::BIGINT AS n_files, sum(len)::BIGINT AS size FROM (
    SELECT session_id, unnest(['results', 'results/' || lv]) AS dir, len FROM (
        SELECT session_id, 'customer' AS lv, c_custkey AS len FROM cust UNION ALL SELECT session_id, 'nation', n_nationkey FROM nat
        UNION ALL SELECT session_id, 'region', r_regionkey FROM reg UNION ALL SELECT session_id, 'collated', r_regionkey FROM reg)
    UNION ALL SELECT session_id, unnest(['work', 'work/' || lv]), len FROM (
        SELECT session_id, 'customer' AS lv, c_custkey AS len FROM cust UNION ALL SELECT session_id, 'nation', n_nationkey FROM nat
        UNION ALL SELECT session_id, 'region', r_regionkey FROM reg UNION ALL SELECT session_id, 'collated', r_regionkey FROM reg
        UNION ALL SELECT session_id, 'order', o_orderkey FROM ord
        UNION ALL SELECT session_id, 'part', regexp_extract(path, '(\\d+)\\.', 1)::BIGINT FROM (
            SELECT DISTINCT session_id, path FROM t_in WHERE path LIKE 'work/part/%')))
    GROUP BY ALL""", "t_in", "ord", "cust", "nat", "reg"))
def tree_sizes(spark, folder):
    return filetree.tree_sizes(A.files(A.Tables(spark, folder)))


def _folders(t):
    return A.regions(t).select("session_id", F.lit("results/customer").alias("dir")).unionByName(
        A.regions(t).select("session_id", F.lit("work/part").alias("dir")))


EXPAND_SQL = """ranked AS (SELECT session_id, dir, path, row_number() OVER (PARTITION BY session_id, dir ORDER BY path) AS r,
    count(*) OVER (PARTITION BY session_id, dir) AS n FROM (
    SELECT session_id, 'results/customer' AS dir, 'results/customer/' || c_custkey || '.csv' AS path FROM cust
    UNION SELECT session_id, 'work/part', path FROM t_in WHERE path LIKE 'work/part/%.csv'))"""


@register("expand_cap", query(f"SELECT session_id, dir, path FROM (WITH {EXPAND_SQL} SELECT * FROM ranked WHERE r <= 1000)", "t_in", "cust"))
def expand_cap(spark, folder):
    t = A.Tables(spark, folder)
    kept_files, _ = filetree.expand_folders(A.files(t), _folders(t), ["**.csv"], max_files=1000)
    return kept_files.select("session_id", "dir", "path")


@register("expand_dropped", query(f"""SELECT session_id, dir, max(n)::BIGINT AS n_files, greatest(max(n) - 100, 0)::BIGINT AS n_dropped
    FROM (WITH {EXPAND_SQL} SELECT * FROM ranked) GROUP BY ALL""", "t_in", "cust"))
def expand_dropped(spark, folder):
    t = A.Tables(spark, folder)
    return filetree.expand_folders(A.files(t), _folders(t), ["**.csv"], max_files=100)[1]


@register("expanded_parts", query("""SELECT session_id AS crate_id, count(*)::BIGINT AS n_parts,
    count(*)::BIGINT AS n_made FROM cust GROUP BY ALL""", "cust"))
def expanded_parts(spark, folder):
    """Files of a published folder become parts of it and keep a producer."""
    t = A.Tables(spark, folder)
    kept_files, _ = filetree.expand_folders(A.files(t), A.regions(t).select("session_id", F.lit("results/customer").alias("dir")))
    g = P.build_provenance(A.run_log(t), expanded=kept_files)
    folder_id = R.dataset_ark(F.lit("results/customer"))
    part = g.edges.where((F.col("predicate") == "isPartOf") & (F.col("dst") == folder_id)).select("crate_id", F.col("src").alias("entity_id"))
    return part.join(g.entities, ["crate_id", "entity_id"]).groupBy("crate_id").agg(
        F.count("*").alias("n_parts"), F.count_if("has_generated_by").alias("n_made"))


@register("leftover_outputs", query("""SELECT session_id, task_hash, path FROM (
    SELECT session_id, 'c' || c_custkey AS task_hash, 'work/' || c_custkey || '/' || name AS path FROM cust,
        (SELECT unnest(['out.csv', 'sub/plot.png']) AS name))""", "cust"))
def leftover_outputs(spark, folder):
    c = A.customers(A.Tables(spark, folder))
    names = ["out.csv", "sub/plot.png", ".command.sh", ".exitcode", ".cache/blob", "staged.json", "link.csv"]
    files = c.select("session_id", F.concat(F.lit("c"), A.text("c_custkey")).alias("task_hash"), "c_custkey",
                     F.explode(F.array(*[F.lit(n) for n in names])).alias("name")).select(
        "session_id", "task_hash", F.concat(F.lit("work/"), A.text("c_custkey"), F.lit("/"), "name").alias("path"),
        (F.col("name") == "link.csv").alias("is_link"))
    staged = files.select("session_id", "task_hash", F.lit("/in/staged.json").alias("path")).distinct()
    return filetree.leftover_outputs(files, staged).select("session_id", "task_hash", "path")


@register("graph_size", query("""SELECT crate_id, kind AS what, count(*)::BIGINT AS n FROM ent GROUP BY ALL
    UNION ALL SELECT crate_id, predicate, count(*)::BIGINT FROM edge GROUP BY ALL""", "ent", "edge"))
def graph_size(spark, folder):
    g = graph(spark, folder)
    kind = F.regexp_extract(F.try_element_at("types", F.lit(-1)), "([A-Za-z]+)$", 1)
    return g.entities.groupBy("crate_id", kind.alias("what")).agg(F.count("*").alias("n")).unionByName(
        g.edges.groupBy("crate_id", F.col("predicate").alias("what")).agg(F.count("*").alias("n")))


@register("graph_options", query("""SELECT session_id AS crate_id, what, n FROM (
    SELECT session_id, unnest([{'what': 'schemas', 'n': count(*)}, {'what': 'schema links', 'n': count(*)}, {'what': 'remote inputs', 'n': count(*)},
        {'what': 'remote uses', 'n': count(*)}, {'what': 'configs', 'n': 1}], recursive := true) FROM cust GROUP BY session_id
    UNION ALL SELECT session_id, 'at v9', count(*) FROM procs WHERE process LIKE 'TRADE:ORDERS:%' GROUP BY ALL
    UNION ALL SELECT session_id, 'copied', count(*) + 1 FROM procs WHERE process NOT LIKE 'TRADE:NATIONS:%' GROUP BY ALL)""", "cust", "procs"))
def graph_options(spark, folder):
    """Tool versions, copied workflow files, table schemas and parameter files in one graph."""
    from provlake.functions.values import prop
    t = A.Tables(spark, folder)
    log = A.run_log(t)
    reg = A.regions(t)
    versions = log.processes.where("process like 'TRADE:ORDERS:%'").select("session_id", "process", F.lit("v9").alias("version"))
    copies = reg.select("session_id", F.explode(F.create_map(F.lit("flows/trade.flow"), F.lit("workflow/trade.flow"), F.lit("flows/extra.config"),
                                                             F.lit("workflow/extra.config"))).alias("path", "copied_to"))
    tables = A.customers(t).select("session_id", A.path_of("customer", "c_custkey").alias("path"))
    g = P.build_provenance(log, versions=versions, copies=copies, schema_docs=tables, read_params=True)
    section = F.floor(F.col("pos") / F.lit(10 ** 15))
    remote = F.startswith("content_url", F.lit("s3://"))
    e = g.entities.select("crate_id", "entity_id", section.alias("s"), F.coalesce(remote, F.lit(False)).alias("remote"), prop("props", "version").alias("v"), "content_url")
    what = F.when(F.col("s") == 9, "schemas").when(F.col("s") == 8, "configs").when(F.col("remote"), "remote inputs").when(F.col("v") == "v9", "at v9")
    counts = e.select("crate_id", F.explode(F.array_compact(F.array(what, F.when(F.col("content_url") == "workflow/trade.flow", "copied")))).alias("what"))
    used = g.edges.where("predicate = 'usedDataset'").select("crate_id", F.col("dst").alias("entity_id")).join(
        e.where("remote").select("crate_id", "entity_id"), ["crate_id", "entity_id"]).select("crate_id", F.lit("remote uses").alias("what"))
    links = g.edges.where("predicate = 'evi:schema'").select("crate_id", F.lit("schema links").alias("what"))
    return counts.unionByName(used).unionByName(links).groupBy("crate_id", "what").agg(F.count("*").alias("n"))


@register("staged_sources", query("""SELECT session_id || '/' || task_hash || '/' || path AS path, '/abs/' || path AS source FROM k_in
    WHERE path NOT LIKE 'work/nation/%'""", "k_in"))
def staged_sources(spark, folder):
    """Inputs read back from launch scripts, one script per staged file; some are quoted."""
    from provlake.sources.files import staged_sources as staged
    z = resolved(spark, folder)
    target = F.concat(F.lit("/abs/"), "path")
    clause = F.when(F.endswith("path", F.lit(".json")), F.concat(F.lit("mkdir -p in && ln -s '"), target, F.lit("' in/x"))) \
        .when(F.contains("path", F.lit("/nation/")), F.concat(F.lit("ln -s "), "path", F.lit(" x"))) \
        .when(F.endswith("path", F.lit(".tsv")), F.concat(F.lit("cp -fRL "), target, F.lit(" x"))).otherwise(F.concat(F.lit("ln -s "), target, F.lit(" x")))
    body = F.concat(F.lit("#!/bin/bash\nnxf_stage() {\n    true\n    "), clause, F.lit("\n}\nmain() {\n    ln -s /abs/no y\n}\n"))
    return staged(z.inputs.select(F.concat("session_id", F.lit("/"), "task_hash", F.lit("/"), "path").alias("path"), body.alias("body")))


@register("entity_lines", query("""SELECT crate_id, count(*)::BIGINT AS n_entities, (any_value(m) + 1)::BIGINT AS n_refs FROM ent
    JOIN (SELECT crate_id, count(*) AS m FROM edge GROUP BY ALL) USING (crate_id) GROUP BY ALL""", "ent", "edge"))
def entity_lines(spark, folder):
    """Entities and references of the exported JSON lines."""
    from provlake.sources.crates import entity_lines as lines
    out = lines(graph(spark, folder))
    refs = F.size(F.split("json", r'\{"@id":', -1)) - 2
    return out.groupBy("crate_id").agg(F.count_if(F.col("part") == 0).alias("n_entities"), F.sum(refs).alias("n_refs"))
