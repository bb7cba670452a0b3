"""Queries over crate contents: census, formats, patterns, readiness, datasheet facts."""

from __future__ import annotations

from pyspark.sql import functions as F

from provlake.functions import sizes as S
from provlake.functions import text as X
from provlake.functions import values as V
from provlake.operators import datasheet as D
from provlake.operators import profile as P
from provlake.operators import readiness as RD
from provlake.operators import entail, runs as R
from provlake.plans import adapter as A, library as L
from provlake.plans.shared import graph, once, table
from provlake.plans.sqlbase import ark, data_ark, query
from provlake.session import workspace

QUERIES, SQL = {}, {}


def register(name, sql=None):
    def wrap(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return wrap


def lab(spark, folder):
    return once(spark, folder, "lab", lambda: L.lab_graph(spark, folder))


def docs(spark, folder):
    return table(spark, folder, "document-entities", L.document_entities)


def roots(spark, folder):
    return table(spark, folder, "source-roots", L.source_roots)


@register("census", query("""SELECT crate_id, count(*) FILTER (kind IN ('Dataset', 'ROCrate'))::BIGINT + 5 AS files_count,
    count(*) FILTER (kind = 'Software')::BIGINT AS software_count, 0::BIGINT AS instruments_count,
    (SELECT count(*) FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE 'region-' || n_regionkey = crate_id)::BIGINT AS samples_count,
    (SELECT count(*) FROM cust WHERE session_id = crate_id)::BIGINT AS experiments_count, count(*) FILTER (kind = 'Computation')::BIGINT AS computations_count,
    0::BIGINT AS schemas_count, 5::BIGINT AS other_count,
    (SELECT count(*) FROM data WHERE session_id = crate_id AND producer IS NOT NULL)::BIGINT AS with_provenance_count FROM ent GROUP BY ALL""", "ent", "cust", "data"))
def census(spark, folder):
    return P.census(lab(spark, folder).entities)


@register("class_counts", query("SELECT crate_id, kind AS class, count(*)::BIGINT AS n FROM ent GROUP BY ALL", "ent"))
def class_counts(spark, folder):
    return P.class_counts(graph(spark, folder).entities)


DOC_FORMATS = """SELECT 'docs-' || source AS crate_id, doc_id, unnest(CASE lang WHEN 'en' THEN ['csv', 'json'] WHEN 'fr' THEN ['text', 'csv', 'tsv', 'bin']
    ELSE [] END) AS format FROM documents"""


@register("format_histogram", f"""SELECT crate_id, 'Dataset' AS kind, format, count(*)::BIGINT AS n, min(doc_id)::BIGINT AS first_doc FROM ({DOC_FORMATS}) GROUP BY ALL
    UNION ALL SELECT 'docs-' || source, 'Software', 'py', count(DISTINCT lang)::BIGINT, 0 FROM documents GROUP BY ALL""")
def format_histogram(spark, folder):
    return P.format_histogram(docs(spark, folder)).select("crate_id", "kind", "format", "n", (F.col("first_pos") % 10 ** 15).alias("first_doc"))


@register("access_histogram", """SELECT 'docs-' || source AS crate_id, 'Dataset' AS kind,
        CASE lang WHEN 'fr' THEN 'Embargoed' WHEN 'en' THEN 'Available' ELSE 'No link' END AS access, count(*)::BIGINT + any_value(0) AS n
        FROM (SELECT source, lang FROM documents UNION ALL SELECT DISTINCT source, 'root' FROM documents) GROUP BY ALL
    UNION ALL SELECT 'docs-' || source, 'Software', CASE lang WHEN 'de' THEN 'No link' ELSE 'Available' END, count(*)::BIGINT
        FROM (SELECT DISTINCT source, lang FROM documents) GROUP BY ALL""")
def access_histogram(spark, folder):
    return P.access_histogram(docs(spark, folder))


LINES_SQL = """SELECT 'region-' || n_regionkey AS crate_id, 'sample-' || s_suppkey AS entity_id, CASE WHEN s_acctbal > 0 THEN 'line-' || n_nationkey END AS line,
    CASE WHEN s_acctbal > 0 THEN n_name END AS line_name,
    CASE WHEN s_acctbal > 0 AND n_nationkey % 3 <> 0 THEN 'species ' || (n_nationkey % 4) ELSE 'Unknown' END AS organism
    FROM supplier JOIN nation ON s_nationkey = n_nationkey"""


@register("sample_lines", LINES_SQL)
def sample_lines(spark, folder):
    g = lab(spark, folder)
    return P.sample_lines(g.entities, g.edges)


@register("species", f"SELECT crate_id, organism || ' (' || count(*) || ')' AS species FROM ({LINES_SQL}) GROUP BY crate_id, organism")
def species(spark, folder):
    g = lab(spark, folder)
    return P.species(P.sample_lines(g.entities, g.edges))


@register("experiment_types", query("""SELECT session_id AS crate_id, CASE c_mktsegment WHEN 'MACHINERY' THEN 'Unknown' ELSE c_mktsegment END AS experiment_type,
    count(*)::BIGINT AS n FROM cust GROUP BY ALL""", "cust"))
def experiment_types(spark, folder):
    return P.experiment_types(lab(spark, folder).entities)


EXT = "regexp_extract(path, '\\.([^./]*)$', 1)"


@register("patterns", query(f"""SELECT crate_id, kind, pattern, count(*)::BIGINT AS n FROM (
    SELECT crate_id, 'Computation' AS kind, comp, list_aggregate(ins, 'string_agg', ' + ') || ' <strong>&rarr;</strong> ' || list_aggregate(outs, 'string_agg', ' + ') AS pattern
    FROM (SELECT e.crate_id, e.src AS comp, list_sort(list(DISTINCT f) FILTER (predicate = 'usedDataset')) AS ins,
            list_sort(list(DISTINCT f) FILTER (predicate = 'generated')) AS outs
        FROM (SELECT crate_id, src, predicate, dst FROM edge UNION ALL SELECT session_id, {ark('computation', "'ROLLUP (' || n_regionkey || ')'", "'r' || n_regionkey")},
            'usedDataset', 'ext-' || n_nationkey FROM nat) e
        JOIN (SELECT session_id AS crate_id, ark AS dst, {EXT} AS f FROM data
            UNION ALL SELECT session_id, 'ext-' || n_nationkey, '<strong>A&amp;B ' || n_name || '</strong>: parquet' FROM nat) d
            ON d.crate_id = e.crate_id AND d.dst = e.dst
        WHERE predicate IN ('usedDataset', 'generated') GROUP BY ALL) WHERE len(ins) > 0 AND len(outs) > 0
    UNION ALL SELECT crate_id, 'Experiment', exp, 'Sample <strong>&rarr;</strong> ' || list_aggregate(list_sort(list(DISTINCT f)), 'string_agg', ' + ') FROM (
        SELECT session_id AS crate_id, c_custkey AS exp, 'json' AS f FROM ord
        UNION ALL SELECT c.session_id, c.c_custkey, 'csv' FROM cust c JOIN customer k ON k.c_custkey = c.c_custkey WHERE c_acctbal > 0) GROUP BY ALL)
    GROUP BY ALL""", "edge", "data", "nat", "cust", "ord"))
def patterns(spark, folder):
    g = lab(spark, folder)
    return P.patterns(g.entities, g.edges).select("crate_id", "kind", "pattern", "n")


@register("input_histogram", query(f"""SELECT crate_id, key, count(*)::BIGINT AS n FROM (
    SELECT session_id AS crate_id, {EXT} AS key FROM r_in
    UNION ALL SELECT session_id, 'A&B ' || n_name || ' (parquet)' FROM nat
    UNION ALL SELECT 'region-' || n_regionkey, 'unknown' FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE s_acctbal > 0
    UNION ALL SELECT 'region-' || n_regionkey, 'Sample' FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE s_acctbal <= 0) GROUP BY ALL""", "r_in", "nat"))
def input_histogram(spark, folder):
    """Derived inputs stated on the root; samples with a cell line are named by an id outside the crate."""
    g = lab(spark, folder)
    root = entail.root_entities(g.entities, g.edges)
    io = entail.crate_io(g.entities, g.edges).where("role = 'input'").join(root, "crate_id").where("entity_id <> root_id")
    lines = P.sample_lines(g.entities, g.edges).where("line is not null").select("crate_id", "entity_id", F.lit("?").alias("away"))
    io = io.join(lines, ["crate_id", "entity_id"], "left").withColumn("entity_id", F.concat("entity_id", F.coalesce("away", F.lit(""))))
    from provlake.model import edge_frame
    stated = edge_frame(io.withColumnRenamed("root_id", "src").withColumnRenamed("entity_id", "dst"), "EVI:inputs")
    return P.input_histogram(g.entities, g.edges.unionByName(stated), root)


SRC = """src AS (SELECT 'docs-' || source AS crate_id, 'root-' || source AS root_id, source, substr(source, 4)::INTEGER AS k, arg_min(text, doc_id) AS text,
    count(*) AS n, sum(n_chars) AS chars, sum(CASE lang WHEN 'en' THEN n_chars * 1000.0 WHEN 'fr' THEN n_chars ELSE 0 END)::DOUBLE AS size_sum,
    count(*) FILTER (lang = 'en') AS n_en, count(*) FILTER (lang = 'es') AS n_es, count(DISTINCT lang) AS n_lang,
    list_sort(list_filter([CASE WHEN count(*) FILTER (lang = 'en') > 0 THEN '.CSV, json' END, CASE WHEN count(*) FILTER (lang = 'de') > 0 THEN 'unknown' END,
        CASE WHEN count(*) FILTER (lang = 'fr') > 0 THEN 'text/csv; .tsv, Bin' END, 'py'], lambda x: x IS NOT NULL)) AS fmts
    FROM documents GROUP BY source)"""


def _lit(s):
    return "'" + s.replace("'", "''") + "'"


PUB = "CASE k % 3 WHEN 0 THEN 'Press' WHEN 1 THEN 'House ' || k END"
IDENT = "CASE WHEN k % 2 = 0 THEN 'Dataset has DOI: doi:10.1/' || source ELSE 'Dataset has persistent identifier: ' || root_id END"
SIZE = "(CASE WHEN k % 4 = 1 THEN 1.5e9 WHEN k % 4 = 2 OR k % 8 = 3 THEN chars::DOUBLE ELSE size_sum END)"
BOARD = "CASE WHEN k % 3 = 1 THEN 'board' END"
FOUND = {
    "findable": IDENT, "persistent": IDENT, "reusable": "CASE WHEN k % 3 <> 0 THEN 'License: https://spdx.org/licenses/MIT' END",
    "transparent": "n || ' dataset(s) documented'", "traceable": "NULL",
    "interpretable": "CASE WHEN k % 7 = 0 THEN NULL ELSE n_lang || ' software instances documented' END",
    "key_actors_identified": f"nullif(concat_ws(', ', CASE k % 4 WHEN 0 THEN '2 authors' WHEN 1 THEN '4 authors' WHEN 2 THEN 'Author specified' END, 'Publisher: ' || {PUB}, CASE WHEN k % 5 = 0 THEN 'PI: PI ' || k END), '')",
    "statistics": f"""nullif(concat_ws(', ', CASE WHEN {SIZE} > 0 THEN 'Total size: ' || CASE WHEN {SIZE} >= 1e12 THEN format('{{:.1f}} TB', {SIZE} / 1e12)
        WHEN {SIZE} >= 1e9 THEN format('{{:.1f}} GB', {SIZE} / 1e9) ELSE format('{{:.1f}} MB', {SIZE} / 1e6) END END,
        CASE WHEN n_es > 0 THEN 'Summary statistics available for ' || n_es || ' dataset(s)' END), '')""",
    "standards": "CASE WHEN k % 7 <> 1 AND k % 2 = 0 THEN '1 schema(s) documented' END",
    "potential_sources_of_bias": "CASE WHEN trim(text, ' ' || chr(10)) <> '' THEN CASE WHEN length(text) > 200 THEN left(text, 200) || '...' ELSE text END END",
    "data_quality": "CASE WHEN k % 6 <> 1 AND k % 2 = 1 THEN 'none missing' END",
    "fit_for_purpose": "nullif(concat_ws(', ', CASE WHEN k % 2 = 0 THEN 'Use cases: [\"train\",\" test \"]' END, CASE WHEN k % 3 = 0 THEN 'Limitations: few' END), '')",
    "verifiable": """CASE WHEN k % 7 = 0 THEN '0% of files have checksums (' || n || '/' || n * 1000 || ')'
        ELSE format('{:.0f}', (n_en + 1) / (n + n_lang + 1) * 100) || '% of files have checksums (' || (n_en + 1) || '/' || (n + n_lang + 1) || ')' END""",
    "ethically_acquired": "nullif(concat_ws(', ', CASE WHEN k % 4 = 2 THEN 'Data collection: scraped' END, CASE WHEN k % 3 = 1 THEN 'Human subject info: none' END), '')",
    "ethically_managed": f"nullif(concat_ws(', ', CASE WHEN k % 5 = 1 THEN 'Ethical review: ok' END, 'Governance: ' || {BOARD}), '')",
    "ethically_disseminated": "nullif(concat_ws(', ', CASE WHEN k % 3 <> 0 THEN 'License: https://spdx.org/licenses/MIT' END, CASE WHEN k % 3 = 1 THEN 'Prohibited uses: resale' END), '')",
    "secure": "CASE WHEN k % 4 = 1 THEN 'Confidentiality level: public' END",
    "domain_appropriate": "CASE WHEN k % 6 = 0 THEN 'Maintenance plan: yearly' END", "well_governed": f"'Governance committee: ' || {BOARD}",
    "standardized": """CASE WHEN k % 5 = 2 THEN 'Formats: .CSV, a, b, json, tsv...' ELSE 'Formats: ' || list_aggregate(fmts, 'string_agg', ', ') END""",
    "computationally_accessible": "CASE k % 3 WHEN 0 THEN 'Publisher: {\"name\":\"Press\"}' WHEN 1 THEN 'Publisher: House ' || k END",
}
SCORE = "score AS (SELECT crate_id, category, criterion, coalesce(found, CASE WHEN by_design THEN details END) IS NOT NULL AS has_content, coalesce(found, details) AS details FROM (" + \
    " UNION ALL ".join(f"SELECT crate_id, '{cat}' AS category, '{name}' AS criterion, ({FOUND.get(name, 'NULL')})::VARCHAR AS found, {str(fixed).lower()} AS by_design, {_lit(text)} AS details FROM src"
                       for cat, (_, crit) in RD.CATEGORIES.items() for name, (fixed, text) in crit.items()) + "))"


def score(spark, folder):
    return RD.readiness(docs(spark, folder), roots(spark, folder))


@register("readiness_long", f"WITH {SRC}, {SCORE} SELECT * FROM score")
def readiness_long(spark, folder):
    return score(spark, folder)


ROLL = """SELECT crate_id, category, label, earned, possible, format('{{:.1f}}', earned / possible * 100)::DOUBLE AS percentage,
    CASE WHEN earned / possible * 100 >= 75 THEN '#4CAF50' WHEN earned / possible * 100 >= 50 THEN '#8BC34A' WHEN earned / possible * 100 >= 25 THEN '#FFC107' ELSE '#f44336' END AS color
    FROM (SELECT crate_id, category, CASE category {labels} END AS label, count(*) FILTER (has_content)::BIGINT AS earned, count(*)::BIGINT AS possible FROM score GROUP BY ALL
    UNION ALL SELECT crate_id, 'all', 'Total', count(*) FILTER (has_content)::BIGINT, count(*)::BIGINT FROM score GROUP BY ALL)""".format(
    labels=" ".join(f"WHEN '{k}' THEN '{v[0]}'" for k, v in RD.CATEGORIES.items()))


@register("readiness_rollup", f"WITH {SRC}, {SCORE} {ROLL}")
def readiness_rollup(spark, folder):
    return RD.rollup(score(spark, folder))


@register("readiness_runs", query("""SELECT crate_id, criterion, details FROM (SELECT crate_id, unnest([
    {'criterion': 'transparent', 'details': count(*) FILTER (kind = 'Dataset') || ' dataset(s) documented'},
    {'criterion': 'traceable', 'details': count(*) FILTER (kind = 'Computation') || ' computation/experiment steps documented'},
    {'criterion': 'interpretable', 'details': count(*) FILTER (kind = 'Software') || ' software instances documented'},
    {'criterion': 'verifiable', 'details': format('{:.0f}', any_value(m) / count(*) FILTER (kind IN ('Dataset', 'Software', 'ROCrate')) * 100) || '% of files have checksums (' || any_value(m)
        || '/' || count(*) FILTER (kind IN ('Dataset', 'Software', 'ROCrate')) || ')'},
    {'criterion': 'standardized', 'details': 'Formats: application/java-archive, csv, json, tsv, workflow...'}], recursive := true)
    FROM ent JOIN (SELECT session_id AS crate_id, count(*) FILTER (path NOT LIKE '%/collated/%' OR true) AS m FROM data GROUP BY ALL) USING (crate_id) GROUP BY crate_id)""", "ent", "data"))
def readiness_runs(spark, folder):
    g = graph(spark, folder)
    root = entail.root_entities(g.entities, g.edges)
    props = g.entities.select("crate_id", F.col("entity_id").alias("root_id"), F.col("props").alias("root_props"))
    rows = RD.readiness(g.entities, root.join(props, ["crate_id", "root_id"]))
    return rows.where(F.col("criterion").isin("transparent", "traceable", "interpretable", "verifiable", "standardized")).select(
        "crate_id", "criterion", "details")


@register("readiness_documents", f"WITH {SRC} SELECT crate_id, 7::INTEGER AS n_categories FROM src")
def readiness_documents(spark, folder):
    out = RD.score_documents(score(spark, folder))
    return out.select("crate_id", F.size(F.json_object_keys("json")).alias("n_categories"))


Q = "to_json({})".format
_D4D = {
    "id": Q("root_id"), "name": f"CASE WHEN k % 9 <> 4 THEN {Q(chr(39) + 'Source ' + chr(39) + ' || source')} END", "title": f"CASE WHEN k % 9 <> 4 THEN {Q(chr(39) + 'Source ' + chr(39) + ' || source')} END",
    "license": "CASE WHEN k % 3 <> 0 THEN '\"https://spdx.org/licenses/MIT\"' END", "doi": "CASE WHEN k % 2 = 0 THEN '\"doi:10.1/' || source || '\"' END",
    "publisher": "CASE k % 3 WHEN 0 THEN '{\"name\":\"Press\"}' WHEN 1 THEN '\"House ' || k || '\"' END",
    "bytes": "CASE WHEN k % 4 = 1 THEN '1610612736' WHEN k % 4 = 2 OR k % 8 = 3 THEN chars::BIGINT::VARCHAR END",
    "encoding": "f", "format": "f", "compression": "f", "hash": "'\"' || md5(source) || '\"'", "md5": "'\"' || md5(source) || '\"'",
    "conforms_to": "'\"D4D Schema\"'", "created_by": "a",
    "created_on": "CASE k % 3 WHEN 0 THEN '\"2024-03-05 10:11:12\"' ELSE '\"2024-03-05 00:00:00\"' END",
    "keywords": "CASE WHEN k % 2 = 0 THEN '[\"a\",\"b\",\"c\"]' ELSE '[\"x\",\"y\"]' END",
    "purposes": "u", "tasks": "u", "intended_uses": "u", "known_limitations": "CASE WHEN k % 3 = 0 THEN '[{\"description\":\"few\"}]' END",
    "collection_mechanisms": "CASE WHEN k % 4 = 2 THEN '[{\"description\":\"scraped\"}]' END",
    "missing_data_documentation": "CASE WHEN k % 6 = 1 THEN '[{\"description\":\"  \"}]' WHEN k % 2 = 1 THEN '[{\"description\":\"none missing\"}]' END",
    "ethical_reviews": "CASE WHEN k % 5 = 1 THEN '[{\"description\":\"ok\"}]' END",
    "distribution_formats": "CASE WHEN k % 5 = 2 THEN '[' || list_aggregate(list_transform(['.CSV','json','tsv','b','a','z','y/x'], lambda x: '{\"description\":\"' || x || '\"}'), 'string_agg', ',') || ']' END",
    "creators": "CASE k % 4 WHEN 0 THEN '[{\"description\":\"Ann\"},{\"description\":\"Bo\"}]' WHEN 1 THEN '[{\"@id\":\"person-' || k || '\"},{\"name\":\" Cy \"},{\"description\":\"Di\"},{\"@id\":\"nobody\"}]' WHEN 2 THEN '[{\"description\":\"Eve\"}]' END",
}
D4D_SQL = f"""WITH {SRC}, d AS (SELECT *, CASE WHEN k % 5 = 2 THEN '[".CSV","json","tsv","b","a","z","y/x"]' END AS f,
    CASE k % 4 WHEN 0 THEN '["Ann","Bo"]' WHEN 1 THEN '[{{"@id":"person-' || k || '"}},{{"name":" Cy "}},"Di",{{"@id":"nobody"}}]' WHEN 2 THEN '"Eve"' END AS a,
    CASE WHEN k % 2 = 0 THEN '[{{"description":"train"}},{{"description":" test "}}]' END AS u FROM src)
    SELECT * FROM (""" + " UNION ALL ".join(f"SELECT crate_id, '{f}' AS field, ({e})::VARCHAR AS value FROM d" for f, e in _D4D.items()) + ") WHERE value IS NOT NULL"


@register("d4d_rows", D4D_SQL)
def d4d_rows(spark, folder):
    """Exported fields but for the two that carry a whole text (their escaping differs by engine)."""
    return D.d4d_rows(roots(spark, folder)).where(~F.col("field").isin("description", "known_biases"))


@register("d4d_texts", f"""WITH {SRC} SELECT crate_id, text AS description, text AS known_biases FROM src""")
def d4d_texts(spark, folder):
    docs_ = D.d4d_documents(D.d4d_rows(roots(spark, folder)))
    return docs_.select("crate_id", F.get_json_object("json", "$.description").alias("description"),
                        F.get_json_object("json", "$.known_biases[0].description").alias("known_biases"))


@register("overview_facts", f"""WITH {SRC} SELECT crate_id, CASE WHEN k % 9 = 4 THEN 'Untitled RO-Crate' ELSE 'Source ' || source END AS title, root_id AS id_value,
    text AS description, CASE WHEN k % 2 = 0 THEN 'doi:10.1/' || source ELSE '' END AS doi,
    CASE k % 4 WHEN 0 THEN 'Ann, Bo' WHEN 1 THEN 'Person ' || k || ', Cy, Di' WHEN 2 THEN 'Eve' ELSE '' END AS authors, 'A, B' AS funding,
    CASE WHEN k % 3 = 1 THEN 'full' ELSE '' END AS completeness, 'No' AS human_subject_research, 'Yes' AS deidentified_samples, 'N/A' AS irb,
    CASE WHEN k % 3 = 1 THEN 'board' ELSE '' END AS data_governance, 'P1; P2; p3' AS related_publications FROM src""")
def overview_facts(spark, folder):
    r = roots(spark, folder)
    out = D.overview_facts(r, D.resolved_authors(r, docs(spark, folder)))
    return out.select("crate_id", "title", "id_value", "description", "doi", "authors", "funding", "completeness", "human_subject_research",
                      "deidentified_samples", "irb", "data_governance", "related_publications")


@register("use_case_facts", f"""WITH {SRC} SELECT crate_id, CASE WHEN k % 2 = 0 THEN 'train, test' ELSE '' END AS intended_uses, CASE WHEN k % 3 = 0 THEN 'few' ELSE '' END AS limitations,
    CASE WHEN k % 3 = 1 THEN 'resale' ELSE '' END AS prohibited_uses, CASE WHEN k % 6 = 0 THEN 'yearly' ELSE '' END AS maintenance_plan,
    CASE WHEN k % 4 = 2 THEN 'scraped' ELSE '' END AS data_collection, CASE WHEN k % 3 <> 0 THEN 'https://spdx.org/licenses/MIT' ELSE '' END AS license_value,
    '' AS host FROM src""")
def use_case_facts(spark, folder):
    r = roots(spark, folder)
    return D.use_case_facts(r).join(D.distribution_facts(r), "crate_id").select(
        "crate_id", "intended_uses", "limitations", "prohibited_uses", "maintenance_plan", "data_collection", "license_value", "host")


@register("summary_counts", f"""WITH {SRC} SELECT crate_id, format('{{:,}}', CASE WHEN k % 7 = 0 THEN n * 1000 ELSE n + n_lang + 1 + CASE WHEN k % 2 = 0 THEN 1 ELSE 0 END END) AS total_entities,
    format('{{:,}}', n) AS dataset_count, CASE WHEN k % 7 = 0 THEN '0' ELSE n_lang::VARCHAR END AS software_count, '0' AS computation_count,
    CASE WHEN k % 5 = 2 THEN 'a, b, csv, json, tsv, x, y, z' ELSE '' END AS formats,
    CASE WHEN length(text) > 500 THEN CASE WHEN contains(left(text, 500), ' ') THEN regexp_extract(left(text, 500), '(?s)^(.*) ', 1) ELSE left(text, 500) END ELSE text END AS description,
    length(text) > 500 AS description_truncated FROM src""")
def summary_counts(spark, folder):
    return P.summary_counts(docs(spark, folder), roots(spark, folder)).drop("total_size")


@register("size_texts", """SELECT o_orderkey, CASE WHEN v >= 1e12 THEN format('{:.1f} TB', v / 1e12) WHEN v >= 1e9 THEN format('{:.1f} GB', v / 1e9)
    WHEN v >= 1e6 THEN format('{:.1f} MB', v / 1e6) WHEN v >= 1e3 THEN format('{:.1f} KB', v / 1e3) ELSE v || ' B' END AS decimal_text,
    CASE WHEN v < 1024 THEN format('{:.2f} B', v::DOUBLE) WHEN v < 1048576 THEN format('{:.2f} KB', v / 1024) WHEN v < 1073741824 THEN format('{:.2f} MB', v / 1048576)
    WHEN v < 1099511627776 THEN format('{:.2f} GB', v / 1073741824) ELSE format('{:.2f} TB', v / 1099511627776) END AS binary_text,
    format('{:,}', v) AS thousands FROM (SELECT o_orderkey, o_orderkey * o_orderkey * o_custkey AS v FROM orders)""")
def size_texts(spark, folder):
    o = A.Tables(spark, folder).orders.select("o_orderkey", (F.col("o_orderkey") * F.col("o_orderkey") * F.col("o_custkey")).alias("v"))
    return o.select("o_orderkey", S.format_size("v").alias("decimal_text"), S.format_size_binary("v").alias("binary_text"), S.thousands("v").alias("thousands"))


UNITS = ["", " B", "kb", " MB", "GB ", "tb", " bytes", " kilobytes", "x", " Megabyte"]


@register("size_parses", """SELECT o_orderkey, coalesce(n::DOUBLE * CASE WHEN i IN (0, 1) THEN 1.0 WHEN i = 2 THEN 1e3 WHEN i = 3 THEN 1e6 WHEN i = 4 THEN 1e9 WHEN i = 5 THEN 1e12 END, 0) AS decimal_bytes,
    CASE WHEN i = 0 THEN CASE WHEN contains(n, '.') THEN NULL ELSE n::BIGINT END WHEN i IN (1, 6) THEN trunc(n::DOUBLE)::BIGINT WHEN i IN (2, 7) THEN trunc(n::DOUBLE * 1024)::BIGINT
    WHEN i IN (3, 9) THEN trunc(n::DOUBLE * 1048576)::BIGINT WHEN i = 4 THEN trunc(n::DOUBLE * 1073741824)::BIGINT WHEN i = 5 THEN trunc(n::DOUBLE * 1099511627776)::BIGINT END AS binary_bytes
    FROM (SELECT o_orderkey, o_orderkey % 10 AS i, CASE WHEN o_orderstatus = 'F' THEN o_custkey || '.6' ELSE o_custkey::VARCHAR END AS n FROM orders)""")
def size_parses(spark, folder):
    o = A.Tables(spark, folder).orders
    unit = F.get(F.array(*[F.lit(u) for u in UNITS]), (F.col("o_orderkey") % 10).cast("int"))
    text = F.concat(A.text("o_custkey"), F.when(F.col("o_orderstatus") == "F", ".6").otherwise(""), unit)
    return o.select("o_orderkey", S.parse_size_decimal(text).alias("decimal_bytes"), S.parse_size_binary(text).alias("binary_bytes"))


@register("rounding", """SELECT o_orderkey, format('{:.0f}', v) AS r0, format('{:.1f}', v) AS r1, format('{:.2f}', v / 10) AS r2 FROM (SELECT o_orderkey, o_custkey / 8 AS v FROM orders)""")
def rounding(spark, folder):
    o = A.Tables(spark, folder).orders.select("o_orderkey", (F.col("o_custkey") / F.lit(8.0)).alias("v"))
    return o.select("o_orderkey", S.fixed("v", 0).alias("r0"), S.fixed("v", 1).alias("r1"), S.fixed(F.col("v") / 10, 2).alias("r2"))


@register("iso_dates", """SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN NULL ELSE CASE o_orderkey % 3 WHEN 0 THEN o_orderdate + INTERVAL 3723 SECOND ELSE o_orderdate END END AS parsed FROM orders""")
def iso_dates(spark, folder):
    o = A.Tables(spark, folder).orders
    d = F.col("o_orderdate")
    kind = F.col("o_orderkey") % 3
    text = F.when(F.col("o_orderstatus") == "F", "soon").when(kind == 0, F.date_format(d + F.expr("interval 3723 seconds"), "yyyy-MM-dd'T'HH:mm:ss'.25+02:00'")) \
        .when(kind == 1, F.date_format(d, "yyyy-MM-dd")).otherwise(F.date_format(d, "MM/dd/yyyy"))
    return o.select("o_orderkey", S.parse_iso(text).alias("parsed"))


@register("format_texts", """SELECT page_id, CASE WHEN len(t) = 0 THEN 'unknown' ELSE list_aggregate(t, 'string_agg', ', ') END AS formats FROM (SELECT page_id,
    list_filter(list_transform(regexp_split_to_array(url, '[/,;]'), lambda p: trim(regexp_replace(lower(trim(p)), '^\\.+', ''))), lambda x: x <> '' AND x <> 'unknown') AS t FROM pages)""")
def format_texts(spark, folder):
    return A.Tables(spark, folder).pages.select("page_id", S.normal_format(F.array("url")).alias("formats"))


@register("text_cuts", """SELECT doc_id, CASE WHEN length(text) > 200 THEN left(text, 200) || '...' ELSE text END AS short,
    CASE WHEN length(text) > 500 THEN CASE WHEN contains(left(text, 500), ' ') THEN regexp_extract(left(text, 500), '(?s)^(.*) ', 1) ELSE left(text, 500) END ELSE text END AS at_word,
    CASE WHEN length(text) > 50 THEN left(text, 47) || '...' ELSE text END AS label FROM documents""")
def text_cuts(spark, folder):
    return A.Tables(spark, folder).documents.select("doc_id", X.truncate("text", 200).alias("short"), X.truncate_at_word("text").alias("at_word"),
                                                    X.abbreviate("text").alias("label"))


@register("truthiness", """SELECT event_id, k % 7 NOT IN (0, 1, 2, 3) AS present, k % 7 NOT IN (0, 2, 3, 4) AS truthy, CASE k % 7 WHEN 6 THEN 'a, ' || k ELSE '' END AS listed
    FROM (SELECT event_id, json_extract(props, '$.k')::INTEGER AS k FROM events)""")
def truthiness(spark, folder):
    e = A.Tables(spark, folder).events
    k = F.get_json_object("props", "$.k").cast("int")
    forms = [F.lit("null"), F.lit('" "'), F.lit("[ ]"), F.lit("{}"), F.lit("false"), F.lit('{"a":1}'), F.concat(F.lit('["a"," ","'), k.cast("string"), F.lit('"]'))]
    v = F.get(F.array(*forms), k % 7)
    e = e.select("event_id", v.alias("v"))
    return e.select("event_id", V.present("v").alias("present"), V.truthy("v").alias("truthy"),
                    F.when(V.is_list("v"), V.list_to_text("v")).otherwise("").alias("listed"))


@register("root_overlay", f"""WITH {SRC} SELECT crate_id, CASE WHEN k % 2 = 0 THEN 'new' WHEN k % 9 <> 4 THEN 'Source ' || source END AS name,
    CASE WHEN k % 3 <> 0 THEN 'https://spdx.org/licenses/MIT' END AS license, 'x' AS extra, NULL::VARCHAR AS part FROM src""")
def root_overlay(spark, folder):
    r = roots(spark, folder)
    return R.overlay_root(r, _metadata(r)).select("crate_id", V.prop("root_props", "name").alias("name"), V.prop("root_props", "license").alias("license"),
                                                  V.prop("root_props", "extra").alias("extra"), V.prop("root_props", "hasPart").alias("part"))


def _metadata(r):
    from provlake.model import json_map
    q = lambda s: F.lit(f'"{s}"')
    return r.select("crate_id", F.map_concat(json_map(extra=q("x"), hasPart=q("no")), F.create_map(F.lit("license"), F.lit(None).cast("string")),
                                             F.when(F.col("k") % 2 == 0, F.create_map(F.lit("name"), q("new"), F.lit("@id"), q("no"))).otherwise(
                                                 F.create_map(F.lit("conformsTo"), q("no")))).alias("metadata"))


@register("refused_root_keys", f"""WITH {SRC} SELECT crate_id, 'hasPart' AS key FROM src UNION ALL SELECT crate_id, CASE WHEN k % 2 = 0 THEN '@id' ELSE 'conformsTo' END FROM src""")
def refused_root_keys(spark, folder):
    return R.refused_root_keys(_metadata(roots(spark, folder)))


def _json_documents(t):
    """One crate document per source and block of 1000 documents, as JSON text."""
    d = t.documents.withColumn("crate_id", F.concat("source", F.lit("/"), A.text(F.floor(F.col("doc_id") / 1000))))
    doc = F.struct(F.concat(F.lit("doc-"), A.text("doc_id")).alias("@id"), F.array(F.lit("prov:Entity"), F.lit("https://w3id.org/EVI#Dataset")).alias("@type"),
                   F.col("text").alias("name"), F.when(F.col("lang") != "es", F.col("lang")).alias("format"),
                   F.when(F.col("lang") == "en", F.array(F.struct(F.concat(F.lit("step-"), "lang").alias("@id")))).alias("generatedBy"),
                   F.when(F.col("lang") == "fr", F.array(F.lit("a text"))).alias("usedSoftware"), F.col("n_chars").alias("evi:size"))
    head = F.array(F.lit('{"@id":"ro-crate-metadata.json","@type":"CreativeWork","about":{"@id":"root"}}'),
                   F.lit('{"@id":"root","@type":["Dataset","https://w3id.org/EVI#ROCrate"],"name":null,"keywords":[]}'))
    body = d.groupBy("crate_id").agg(F.sort_array(F.collect_list(F.struct("doc_id", F.to_json(doc).alias("json")))).alias("rows"))
    return body.select("crate_id", F.concat(F.lit('{"@context":{},"@graph":['), F.array_join(
        F.concat(head, F.transform("rows", lambda r: r["json"])), ","), F.lit("]}")).alias("json"))


def _crate_files(spark, folder):
    """The chunks of one file for each source and block of documents; the folder's name is the crate's in hexadecimal."""
    from provlake.sources.items import file_chunks
    home = workspace(spark, "crate-files")
    _json_documents(A.Tables(spark, folder)).select(F.hex("crate_id").alias("id"), F.col("json").alias("value")).write.partitionBy("id").text(home)
    name = F.unhex(F.regexp_extract("crate_id", "/id=([^/]*)/", 1)).cast("string")
    return file_chunks(spark, home, "part-*").withColumn("crate_id", name)


@register("crate_scan", """SELECT source || '/' || doc_id // 1000 AS crate_id, 'doc-' || doc_id AS entity_id, 'Dataset' AS norm_type, text AS name,
        CASE WHEN lang = 'es' THEN 'unknown' ELSE lang END AS format, lang = 'en' AS has_generated_by, CASE lang WHEN 'en' THEN 'step-en' WHEN 'fr' THEN 'a text' END AS ref,
        CASE lang WHEN 'en' THEN true WHEN 'fr' THEN false END AS is_object_ref FROM documents
    UNION ALL SELECT DISTINCT source || '/' || doc_id // 1000, unnest(['root', 'ro-crate-metadata.json']), unnest(['Dataset', 'Other']), NULL, 'unknown', false,
        unnest([NULL, 'root']), unnest([NULL, true]) FROM documents""")
def crate_scan(spark, folder):
    """Crate documents, written as a file each and read in chunks, as entities and edges."""
    from provlake.functions.types import normal_type
    from provlake.sources.crates import load_items
    from provlake.sources.items import scan
    g = load_items(scan(_crate_files(spark, folder)).items)
    refs = g.edges.where("predicate in ('generatedBy', 'usedSoftware', 'about')").select("crate_id", F.col("src").alias("entity_id"), F.col("dst").alias("ref"), "is_object_ref")
    return g.entities.join(refs, ["crate_id", "entity_id"], "left").select(
        "crate_id", "entity_id", normal_type("types").alias("norm_type"), "name", S.normal_format("formats").alias("format"), "has_generated_by", "ref", "is_object_ref")
