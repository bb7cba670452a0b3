"""Queries over the provenance graph: entailment, lineage, condensation."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from provlake.functions import text as X
from provlake.functions import types as K
from provlake.model import Graph, edge_frame
from provlake.operators import condense as C
from provlake.operators import cycles as CY
from provlake.operators import entail, reach as W, runs as R
from provlake.plans import adapter as A, provenance as P
from provlake.plans.lineage import lineage, walk
from provlake.plans.shared import entity_ids, graph, graph_plan, once
from provlake.plans.sqlbase import base, data_ark, query
from provlake.session import cut

QUERIES, SQL = {}, {}


def register(name, sql=None):
    def wrap(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return wrap


def job(spark, folder):
    return once(spark, folder, "lineage", lambda: lineage(graph(spark, folder), walked=_walk(spark, folder)))


def _walk(spark, folder):
    return once(spark, folder, "walk", lambda: walk(graph(spark, folder)))


PAIRS = "pairs", "SELECT * FROM (VALUES " + ", ".join(
    f"('{a}', '{b}')" for p, q in entail.INVERSE_PAIRS for a, b in ((p, q), (q, p))) + ") v(predicate, inverse)"
ADDED = "added", """SELECT DISTINCT e.crate_id, e.dst AS src, inverse AS predicate, e.src AS dst FROM edge e JOIN pairs USING (predicate)
    JOIN ent t ON t.crate_id = e.crate_id AND t.id = e.dst
    WHERE e.src <> e.dst AND NOT EXISTS (SELECT 1 FROM edge h WHERE h.crate_id = e.crate_id AND h.src = e.dst
        AND h.predicate = inverse AND h.dst = e.src)"""


@register("link_inverses", query("SELECT crate_id, src, predicate, dst FROM added", "edge", "ent", extra=dict([PAIRS, ADDED])))
def link_inverses(spark, folder):
    g = graph(spark, folder)
    return entail.added_inverses(g.entities, g.edges).select("crate_id", "src", "predicate", "dst")


@register("inverse_gain", query("""SELECT crate_id, predicate, sum(added)::BIGINT AS n_added, count(*)::BIGINT AS n_total FROM (
    SELECT crate_id, predicate, 0 AS added FROM edge UNION ALL SELECT crate_id, predicate, 1 FROM added) GROUP BY ALL""",
                                "edge", "ent", extra=dict([PAIRS, ADDED])))
def inverse_gain(spark, folder):
    g = graph(spark, folder)
    linked = entail.link_inverses(g.entities, g.edges)
    return linked.groupBy("crate_id", "predicate").agg(
        F.count_if(F.col("ord") >= entail.ADDED_ORD).alias("n_added"), F.count("*").alias("n_total"))


@register("crate_io", query("""SELECT crate_id, 'output' AS role, id AS entity_id FROM ent e WHERE kind = 'Dataset'
        AND NOT EXISTS (SELECT 1 FROM edge u WHERE u.crate_id = e.crate_id AND predicate = 'usedDataset' AND dst = id)
        AND NOT EXISTS (SELECT 1 FROM edge u WHERE u.crate_id = e.crate_id AND predicate = 'isPartOf' AND src = id)
    UNION SELECT crate_id, 'input', id FROM (SELECT crate_id, id FROM ent WHERE kind = 'Dataset' UNION
        SELECT crate_id, dst FROM edge WHERE predicate = 'usedDataset') e
    WHERE NOT EXISTS (SELECT 1 FROM edge g WHERE g.crate_id = e.crate_id AND predicate = 'generatedBy' AND src = id)""", "ent", "edge"))
def crate_io(spark, folder):
    g = graph(spark, folder)
    return entail.crate_io(g.entities, g.edges)


@register("root_entities", query("SELECT session_id AS crate_id, root AS root_id FROM run", "run"))
def root_entities(spark, folder):
    return entail.root_entities(entity_ids(spark, folder), graph_plan(spark, folder).edges)


@register("entity_index", """SELECT lang AS crate_id, source AS entity_id, arg_min(text, doc_id) AS first_text, arg_max(text, doc_id) AS last_text
    FROM documents GROUP BY ALL""")
def entity_index(spark, folder):
    d = A.Tables(spark, folder).documents.select(
        F.col("lang").alias("crate_id"), F.col("source").alias("entity_id"), F.col("doc_id").alias("pos"), "text")
    first = entail.entity_index(d).select("crate_id", "entity_id", F.col("text").alias("first_text"))
    last = entail.entity_index(d, last_wins=True).select("crate_id", "entity_id", F.col("text").alias("last_text"))
    return first.join(last, ["crate_id", "entity_id"])


@register("dash_tolerant_lookup", query("""SELECT crate_id, ark, id AS entity_id, false AS exact FROM (
        SELECT crate_id, id, 'ark:/' || regexp_extract(id, '^ark:(\\d+)/', 1) || '/' || replace(regexp_extract(id, '^ark:\\d+/(.*)$', 1), '-', '') AS ark
        FROM ent WHERE kind <> 'CreativeWork')
    UNION ALL SELECT crate_id, id, id, true FROM ent WHERE kind = 'Software'
    UNION ALL SELECT crate_id, id || 'x', NULL, NULL FROM ent WHERE kind = 'Computation'""", "ent"))
def dash_tolerant_lookup(spark, folder):
    entities = entity_ids(spark, folder)
    ids = entities.where(F.startswith("entity_id", F.lit("ark:"))).select("crate_id", "entity_id", K.evi_type("types").alias("k"))
    squeezed = F.concat(F.lit("ark:/"), F.regexp_extract("entity_id", r"^ark:(\d+)/", 1), F.lit("/"),
                        F.replace(F.regexp_extract("entity_id", r"^ark:\d+/(.*)$", 1), F.lit("-"), F.lit("")))
    asked = ids.select("crate_id", squeezed.alias("ark")).unionByName(
        ids.where("k = 'Software'").select("crate_id", F.col("entity_id").alias("ark"))).unionByName(
        ids.where("k = 'Computation'").select("crate_id", F.concat("entity_id", F.lit("x")).alias("ark")))
    return entail.dash_tolerant(entities, asked)


def _crate_inputs(spark, folder):
    """Regions whose inputs are nation crates; a nation crate declares its customers' files."""
    t = A.Tables(spark, folder)
    n, c, r = A.nations(t), A.customers(t), A.regions(t)
    crate = lambda key: F.concat(F.lit("crate-"), A.text(key))
    ents = n.select(F.col("session_id").alias("crate_id"), crate("n_nationkey").alias("entity_id"),
                    F.col("n_nationkey").cast("bigint").alias("pos"), F.array(F.lit("Dataset"), F.lit("https://w3id.org/EVI#ROCrate")).alias("types"))
    outs = c.where(F.col("c_mktsegment") != "MACHINERY").select(
        F.col("session_id").alias("crate_id"), crate("n_nationkey").alias("src"), A.path_of("customer", "c_custkey").alias("dst"),
        F.when(F.col("n_nationkey") < 10, "EVI:outputs").otherwise("outputs").alias("predicate"))
    outs = outs.where("predicate = 'EVI:outputs'").select("crate_id", "src", "dst").transform(lambda d: edge_frame(d, "EVI:outputs")) \
        .unionByName(outs.where("predicate = 'outputs'").select("crate_id", "src", "dst").transform(lambda d: edge_frame(d, "outputs"))) \
        .unionByName(edge_frame(n.select(F.col("session_id").alias("crate_id"), crate("n_nationkey").alias("src"), F.lit("later").alias("dst"))
                                .where(F.col("src") == "crate-1"), "outputs"))
    uses = n.select(F.col("session_id").alias("crate_id"), F.concat(F.lit("sum-"), "session_id").alias("src"), crate("n_nationkey").alias("dst")) \
        .unionByName(r.select(F.col("session_id").alias("crate_id"), F.concat(F.lit("sum-"), "session_id").alias("src"),
                              A.path_of("collated", "r_regionkey", "yml").alias("dst")))
    return ents, outs, uses


@register("crate_outputs_resolved", query("""SELECT session_id AS crate_id, 'sum-' || session_id AS src, 'work/customer/' || c_custkey || '.csv' AS dst
        FROM cust WHERE c_mktsegment <> 'MACHINERY'
    UNION ALL SELECT session_id, 'sum-' || session_id, 'work/collated/' || r_regionkey || '.yml' FROM reg
    UNION ALL SELECT session_id, 'sum-' || session_id, CASE WHEN n_nationkey = 1 THEN 'later' ELSE 'crate-' || n_nationkey END FROM nat n
        WHERE NOT EXISTS (SELECT 1 FROM cust c WHERE c.n_nationkey = n.n_nationkey AND c_mktsegment <> 'MACHINERY')""", "cust", "reg", "nat"))
def crate_outputs_resolved(spark, folder):
    ents, outs, uses = _crate_inputs(spark, folder)
    return entail.resolve_used(uses, ents, outs)


LINEAGE_CTE = {
    "outs": """SELECT crate_id, id FROM ent e WHERE kind = 'Dataset'
        AND NOT EXISTS (SELECT 1 FROM edge u WHERE u.crate_id = e.crate_id AND predicate = 'usedDataset' AND dst = id)
        AND NOT EXISTS (SELECT 1 FROM edge u WHERE u.crate_id = e.crate_id AND predicate = 'isPartOf' AND src = id)""",
    "starts": "SELECT crate_id, id FROM outs UNION SELECT session_id, root FROM run",
    "paths": """SELECT crate_id, id AS node, 0 AS depth FROM starts
        UNION SELECT w.crate_id, w.dst, depth + 1 FROM paths p JOIN walk w ON w.crate_id = p.crate_id AND w.src = p.node""",
    "reached": "SELECT crate_id, node, min(depth)::INTEGER AS depth FROM paths GROUP BY ALL",
}


@register("backward_lineage", query("SELECT crate_id, depth, count(*)::BIGINT AS n_nodes FROM reached GROUP BY ALL",
                                    "walk", "ent", "run", extra=LINEAGE_CTE, recursive=True))
def backward_lineage(spark, folder):
    """Nodes behind each crate's outputs by distance."""
    return _reached(spark, folder).groupBy("crate_id", "depth").agg(F.count("*").alias("n_nodes"))


def _reached(spark, folder):
    return _walk(spark, folder).reached


@register("lineage_nodes", query("SELECT crate_id, node, depth FROM reached", "walk", "ent", "run", extra=LINEAGE_CTE, recursive=True))
def lineage_nodes(spark, folder):
    return _reached(spark, folder).select("crate_id", "node", "depth")


@register("lineage_depth", query("SELECT crate_id, max(depth)::INTEGER AS depth, count(*)::BIGINT AS n_nodes FROM reached GROUP BY ALL",
                                 "walk", "ent", "run", extra=LINEAGE_CTE, recursive=True))
def lineage_depth(spark, folder):
    return _reached(spark, folder).groupBy("crate_id").agg(F.max("depth").alias("depth"), F.count("*").alias("n_nodes"))


EXT = "regexp_extract(path, '\\.([^./]*)$', 1)"
SIG_CTE = {
    "sw": "SELECT crate_id, src AS comp, string_agg(dst, ',' ORDER BY dst) AS soft FROM edge WHERE predicate = 'usedSoftware' GROUP BY ALL",
    "fmt": f"SELECT session_id AS crate_id, ark AS node, {EXT} AS f, producer FROM data",
    "s0": "SELECT crate_id, node, 'leaf:' || f AS sig FROM fmt WHERE producer IS NULL",
}
for _i in range(4):
    SIG_CTE[f"s{_i + 1}"] = f"""SELECT * FROM s{_i} UNION ALL SELECT f.crate_id, f.node, md5(f.f || '(' || soft || ')' || coalesce(ins, '')) FROM fmt f
        JOIN sw ON sw.crate_id = f.crate_id AND sw.comp = f.producer
        LEFT JOIN (SELECT u.crate_id, u.src AS comp, string_agg(s.sig, ',' ORDER BY s.sig) AS ins, count(s.sig) AS n_signed, count(*) AS n
            FROM edge u LEFT JOIN s{_i} s ON s.crate_id = u.crate_id AND s.node = u.dst WHERE predicate = 'usedDataset' GROUP BY ALL) i
            ON i.crate_id = f.crate_id AND i.comp = f.producer
        WHERE producer IS NOT NULL AND coalesce(n_signed = n, true)
            AND NOT EXISTS (SELECT 1 FROM s{_i} p WHERE p.crate_id = f.crate_id AND p.node = f.node)"""


@register("signature_classes", query("SELECT crate_id, min(node) AS representative, count(*)::BIGINT AS n_datasets FROM s4 GROUP BY crate_id, sig",
                                     "edge", "data", extra={k: f"SELECT * FROM ({v})" for k, v in SIG_CTE.items()}))
def signature_classes(spark, folder):
    """Classes of datasets with the same provenance, named by their smallest member."""
    g = graph(spark, folder)
    data = g.entities.where(K.is_plain_dataset("types"))
    ids = data.select("crate_id", F.col("entity_id").alias("node"))
    return C.signatures(g.entities, g.edges).join(ids, ["crate_id", "node"], "left_semi").groupBy("crate_id", "sig").agg(
        F.min("node").alias("representative"), F.count("*").alias("n_datasets")).drop("sig")


@register("signatures_depth2", query("SELECT crate_id, min(node) AS representative, count(*)::BIGINT AS n_datasets FROM s2 GROUP BY crate_id, sig",
                                     "edge", "data", extra=SIG_CTE))
def signatures_depth2(spark, folder):
    """The same after two levels: what is further from the sources is still open."""
    g = graph(spark, folder)
    ids = g.entities.where(K.is_plain_dataset("types")).select("crate_id", F.col("entity_id").alias("node"))
    sigs = C.signatures(g.entities, g.edges, max_depth=2).where("sig <> 'cycle'")
    return sigs.join(ids, ["crate_id", "node"], "left_semi").groupBy("crate_id", "sig").agg(
        F.min("node").alias("representative"), F.count("*").alias("n_datasets")).drop("sig")


GROUP_CTE = dict(SIG_CTE)
GROUP_CTE["uses"] = """SELECT u.crate_id, u.src AS comp, u.dst AS node, sig FROM edge u JOIN s4 s ON s.crate_id = u.crate_id AND s.node = u.dst
    WHERE predicate = 'usedDataset' AND u.src NOT IN (SELECT run FROM run)"""
GROUP_CTE["grp"] = """SELECT crate_id, comp, sig, count(*)::BIGINT AS n_members, min(node) AS representative FROM uses GROUP BY ALL HAVING count(*) > 5"""
GROUP_CTE["mem"] = "SELECT u.crate_id, u.comp, u.sig, u.node, n_members, representative FROM uses u JOIN grp USING (crate_id, comp, sig)"
WALK_DS = "predicate IN ('generatedBy', 'usedDataset')"
GROUP_CTE["chain"] = f"""SELECT crate_id, comp, sig, representative AS node FROM grp UNION
    SELECT c.crate_id, c.comp, c.sig, e.dst FROM chain c JOIN edge e ON e.crate_id = c.crate_id AND e.src = c.node
    WHERE e.predicate IN ('generatedBy', 'usedDataset', 'usedSoftware')"""
GROUP_CTE["excl"] = f"""SELECT crate_id, comp, sig, node FROM mem m WHERE node <> representative AND NOT EXISTS (SELECT 1 FROM chain c
        WHERE c.crate_id = m.crate_id AND c.comp = m.comp AND c.sig = m.sig AND c.node = m.node) UNION
    SELECT x.crate_id, x.comp, x.sig, e.dst FROM excl x JOIN edge e ON e.crate_id = x.crate_id AND e.src = x.node AND {WALK_DS}
    WHERE NOT EXISTS (SELECT 1 FROM chain c WHERE c.crate_id = x.crate_id AND c.comp = x.comp AND c.sig = x.sig AND c.node = e.dst)"""
GROUP_CTE["gone"] = "SELECT DISTINCT crate_id, node FROM excl"


@register("condense_groups", query(f"""SELECT g.crate_id, g.comp, n_members, representative, f AS format FROM grp g
    JOIN fmt ON fmt.crate_id = g.crate_id AND fmt.node = representative""", "edge", "data", "run", extra=GROUP_CTE, recursive=True))
def condense_groups(spark, folder):
    return job(spark, folder).groups.select("crate_id", "comp", "n_members", "representative", "format")


@register("group_nodes", query(f"""SELECT g.crate_id, 'ark:group/' || replace(lower(task_name), ' ', '-') || '-' || f || '-inputs' AS group_id,
    n_members || ' ' || f || ' files with identical provenance structure.' || coalesce(' All processed by ' || list_aggregate(sw_names, 'string_agg', ', ') || '.', '') AS description,
    regexp_extract(shown, '([^/]*)$', 1) || ' (and ' || (n_members - 1) || ' similar)' AS name FROM grp g
    JOIN fmt ON fmt.crate_id = g.crate_id AND fmt.node = representative
    JOIN ok_tasks t ON t.session_id = g.crate_id AND t.comp = g.comp
    JOIN data d ON d.session_id = g.crate_id AND d.ark = representative
    LEFT JOIN (SELECT t2.session_id, comp, list(CASE WHEN process LIKE 'TRADE:CUSTOMERS:%' THEN lower(regexp_extract(process, '([^:]*)$', 1)) ELSE process END) AS sw_names
        FROM ok_tasks t2 GROUP BY ALL) s ON s.session_id = g.crate_id AND s.comp = d.producer""",
                               "edge", "data", "run", "ok_tasks", extra=GROUP_CTE, recursive=True))
def group_nodes(spark, folder):
    return job(spark, folder).groups.select("crate_id", "group_id", "description", "name")


@register("group_members_listed", query("""SELECT crate_id, comp, representative, list_aggregate(list_slice(list(node ORDER BY node), 1, 3), 'string_agg', '; ')
    || '; ... and ' || (max(n_members) - 3) || ' more (total: ' || max(n_members) || ')' AS member_ids FROM mem GROUP BY crate_id, comp, sig, representative""",
                                        "edge", "data", "run", extra=GROUP_CTE, recursive=True))
def group_members_listed(spark, folder):
    m = job(spark, folder).members
    rep = m.select("crate_id", "comp", "sig", "representative").distinct()
    return C.listed_members(m, 3).join(rep, ["crate_id", "comp", "sig"]).select(
        "crate_id", "comp", "representative", F.array_join("member_ids", "; ").alias("member_ids"))


@register("exclusive_removed", query("SELECT crate_id, node FROM gone", "edge", "data", "run", extra=GROUP_CTE, recursive=True))
def exclusive_removed(spark, folder):
    return job(spark, folder).removed


ALL_CTE = {**LINEAGE_CTE, **GROUP_CTE}


@register("condense_stats", query("""SELECT r.crate_id, coalesce(n_groups, 0) > 0 AS condensed, n AS original_entities,
    (n - coalesce(n_gone, 0) + coalesce(n_nodes, 0))::BIGINT AS condensed_entities, coalesce(n_groups, 0)::BIGINT AS group_count,
    coalesce(n_gone, 0)::BIGINT AS entities_removed
    FROM (SELECT crate_id, count(*)::BIGINT AS n FROM reached GROUP BY ALL) r
    LEFT JOIN (SELECT crate_id, count(*) AS n_gone FROM gone GROUP BY ALL) USING (crate_id)
    LEFT JOIN (SELECT g.crate_id, count(*) AS n_groups, count(DISTINCT (comp, f)) AS n_nodes FROM grp g
        JOIN fmt ON fmt.crate_id = g.crate_id AND fmt.node = representative GROUP BY ALL) USING (crate_id)""",
                                  "walk", "ent", "run", "edge", "data", extra=ALL_CTE, recursive=True))
def condense_stats(spark, folder):
    return job(spark, folder).stats


PROJECT_CTE = {**ALL_CTE}
PROJECT_CTE["gid"] = """SELECT g.*, 'ark:group/' || replace(lower(task_name), ' ', '-') || '-' || f || '-inputs' AS group_id FROM grp g
    JOIN fmt ON fmt.crate_id = g.crate_id AND fmt.node = representative JOIN ok_tasks t ON t.session_id = g.crate_id AND t.comp = g.comp"""
PROJECT_CTE["folded"] = """SELECT w.crate_id, w.src, w.dst FROM walk w WHERE NOT EXISTS (SELECT 1 FROM mem m WHERE m.crate_id = w.crate_id AND m.comp = w.src AND m.node = w.dst)
        AND NOT EXISTS (SELECT 1 FROM gone g WHERE g.crate_id = w.crate_id AND g.node = w.src)
    UNION SELECT crate_id, comp, group_id FROM gid g WHERE NOT EXISTS (SELECT 1 FROM gone x WHERE x.crate_id = g.crate_id AND x.node = g.comp)
    UNION SELECT crate_id, group_id, representative FROM gid"""
PROJECT_CTE["seen"] = """SELECT crate_id, id AS node FROM starts UNION
    SELECT f.crate_id, f.dst FROM seen s JOIN folded f ON f.crate_id = s.crate_id AND f.src = s.node"""
_P = dict(extra=PROJECT_CTE, recursive=True)


@register("projected_nodes", query("""SELECT s.crate_id, s.node, n_members AS member_count, g.node IS NOT NULL AS collapsed,
    CASE WHEN g.node IS NOT NULL THEN 'not found' END AS error FROM seen s
    LEFT JOIN gone g ON g.crate_id = s.crate_id AND g.node = s.node
    LEFT JOIN gid ON gid.crate_id = s.crate_id AND group_id = s.node""", "walk", "ent", "run", "edge", "data", "ok_tasks", **_P))
def projected_nodes(spark, folder):
    return job(spark, folder).nodes.select("crate_id", "node", "member_count", "collapsed", "error")


@register("projected_edges", query("""SELECT f.crate_id, f.src, f.dst FROM folded f JOIN seen s ON s.crate_id = f.crate_id AND s.node = f.src""",
                                   "walk", "ent", "run", "edge", "data", "ok_tasks", **_P))
def projected_edges(spark, folder):
    return job(spark, folder).edges.select("crate_id", "src", "dst")


# Orders point to their customer, a customer to the nation of the next key and a nation back to
# some customers: cycles of two and three nodes, edges between cycles, and long tails on both sides.
CORE_CTE = {"e": """SELECT DISTINCT crate_id, src, dst FROM (
        SELECT 'all' AS crate_id, 'o' || o_orderkey AS src, 'c' || o_custkey AS dst FROM orders
        UNION ALL SELECT 'all', 'c' || c_custkey, 'n' || c_nationkey FROM customer
        UNION ALL SELECT 'all', 'n' || n_nationkey, 'c' || n_nationkey FROM nation
        UNION ALL SELECT 'all', 'c' || c_custkey, 'o' || o_orderkey FROM orders JOIN customer ON c_custkey = o_custkey AND o_orderkey % 50 = 0
        UNION ALL SELECT 'all', 'n' || n_nationkey, 'r' || n_regionkey FROM nation)""",
            # what lies on a cycle (of two nodes, or through a nation), or between two: reached from one and reaching one
            "back": "SELECT DISTINCT src AS a, dst AS b FROM e",
            "tour": "SELECT a, b FROM back WHERE a LIKE 'n%' UNION SELECT tour.a, back.b FROM tour JOIN back ON back.a = tour.b",
            "near": "SELECT a.a AS x FROM back a JOIN back b ON b.a = a.b AND b.b = a.a UNION SELECT a FROM tour WHERE a = b",
            "down": "SELECT x FROM near UNION SELECT b FROM down JOIN back ON a = x",
            "up": "SELECT x FROM near UNION SELECT a FROM up JOIN back ON b = x"}


@register("acyclic_core", query("""SELECT DISTINCT crate_id, src, dst FROM e WHERE src IN (SELECT x FROM up) AND dst IN (SELECT x FROM up)
    AND src IN (SELECT x FROM down) AND dst IN (SELECT x FROM down)""", extra=CORE_CTE, recursive=True))
def acyclic_core(spark, folder):
    """What is left of a graph when ends and beginnings are peeled off: its cycles and the ways between them."""
    return W.acyclic_core(_looped(A.Tables(spark, folder)))


def _arrows(df, a, x, b, y):
    name = lambda letter, c: F.concat(F.lit(letter), F.col(c).cast("string"))
    return df.select(F.lit("all").alias("crate_id"), name(a, x).alias("src"), name(b, y).alias("dst"))


def _looped(t):
    closed = t.orders.where("o_orderkey % 50 = 0").join(t.customer.select(F.col("c_custkey").alias("o_custkey")), "o_custkey", "left_semi")
    return _arrows(t.orders, "o", "o_orderkey", "c", "o_custkey").unionByName(_arrows(t.customer, "c", "c_custkey", "n", "c_nationkey")) \
        .unionByName(_arrows(t.nation, "n", "n_nationkey", "c", "n_nationkey")).unionByName(_arrows(t.nation, "n", "n_nationkey", "r", "n_regionkey")) \
        .unionByName(_arrows(closed, "c", "o_custkey", "o", "o_orderkey")).distinct()


# The same graph with the suppliers of each nation as a ring: longer cycles that lead to others.
CYCLE_CTE = {
    "e": CORE_CTE["e"], "ring": """SELECT s_suppkey AS s, s_nationkey AS n, coalesce(lead(s_suppkey) OVER w, min(s_suppkey) OVER (PARTITION BY s_nationkey)) AS nxt
        FROM supplier WINDOW w AS (PARTITION BY s_nationkey ORDER BY s_suppkey)""",
    "g": "SELECT src, dst FROM e UNION SELECT 's' || s, 's' || nxt FROM ring UNION SELECT 's' || s, 'n' || n FROM ring",
    "tour": "SELECT src AS a, dst AS b FROM g UNION SELECT tour.a, g.dst FROM tour JOIN g ON g.src = tour.b",
    "mem": "SELECT t.a AS node, min(t.b) AS component FROM tour t JOIN tour r ON r.a = t.b AND r.b = t.a GROUP BY t.a",
    "st": "SELECT component, src, dst FROM g JOIN mem ON mem.node = src WHERE component = (SELECT m.component FROM mem m WHERE m.node = dst)",
    "bfs": "SELECT DISTINCT component, component AS node, 0 AS lv FROM mem UNION SELECT b.component, dst, lv + 1 FROM bfs b JOIN st ON st.component = b.component AND src = node WHERE lv < 60",
    "lvl": "SELECT component, node, min(lv) AS lv FROM bfs GROUP BY ALL",
    "par": "SELECT l.component, l.node, l.lv, min(src) AS parent FROM lvl l JOIN st ON st.component = l.component AND dst = l.node JOIN lvl p ON p.component = l.component AND p.node = src AND p.lv = l.lv - 1 GROUP BY ALL",
    "fin": "SELECT l.component, arg_min(l.node, (l.lv, l.node)) AS node, min(l.lv) AS lv FROM lvl l JOIN st ON st.component = l.component AND src = l.node AND dst = l.component GROUP BY l.component",
    "way": "SELECT component, node, lv FROM fin UNION ALL SELECT w.component, parent, w.lv - 1 FROM way w JOIN par ON par.component = w.component AND par.node = w.node AND par.lv = w.lv"}


@register("cycles", query("SELECT 'all' AS crate_id, component, lv::INTEGER AS pos, node FROM way", extra=CYCLE_CTE, recursive=True))
def cycles(spark, folder):
    """One shortest cycle of every strongly connected part, in order."""
    t = A.Tables(spark, folder)
    ring = Window.partitionBy("s_nationkey").orderBy("s_suppkey")
    s = t.supplier.select("s_suppkey", "s_nationkey", F.coalesce(F.lead("s_suppkey").over(ring), F.min("s_suppkey").over(Window.partitionBy("s_nationkey"))).alias("after"))
    return CY.cycles(_looped(t).unionByName(_arrows(s, "s", "s_suppkey", "s", "after")).unionByName(_arrows(s, "s", "s_suppkey", "n", "s_nationkey")))


NEAR_CTE = {
    "many": "SELECT crate_id, src, count(*) AS n FROM edge WHERE predicate = 'usedDataset' GROUP BY ALL HAVING count(*) > 1",
    "shown": """SELECT crate_id, src, predicate, dst, NULL::VARCHAR AS label FROM edge e WHERE predicate IN ('generatedBy', 'usedDataset', 'usedSoftware')
        AND NOT (predicate = 'usedDataset' AND EXISTS (SELECT 1 FROM many m WHERE m.crate_id = e.crate_id AND m.src = e.src))
        UNION ALL SELECT crate_id, src, 'usedDataset', src || '#inputs', 'Input Datasets (' || n || ')' FROM many""",
    "hop": f"""SELECT session_id AS crate_id, ark AS node, 0 AS depth FROM data WHERE path LIKE 'work/customer/%'
        UNION SELECT s.crate_id, s.dst, depth + 1 FROM hop h JOIN shown s ON s.crate_id = h.crate_id AND s.src = h.node WHERE depth < 6""",
    "near": "SELECT crate_id, node, min(depth)::INTEGER AS depth FROM hop GROUP BY ALL",
}


@register("neighbourhood", query("""SELECT n.crate_id, n.depth, s.src, s.predicate, s.dst, s.label FROM near n
    JOIN shown s ON s.crate_id = n.crate_id AND s.src = n.node WHERE depth < 6""", "edge", "data", extra=NEAR_CTE, recursive=True))
def neighbourhood(spark, folder):
    """Six levels around every customer result."""
    g = graph(spark, folder)
    t = A.Tables(spark, folder)
    start = A.customers(t).select(F.col("session_id").alias("crate_id"), R.dataset_ark(A.path_of("customer", "c_custkey")).alias("node"))
    shown = g.edges.where(F.col("predicate").isin("generatedBy", "usedDataset", "usedSoftware")).select("crate_id", "src", "predicate", "dst")
    return W.neighbourhood(shown, start, depth=6)


@register("evidence_graph_ids", query("""SELECT id, CASE WHEN id LIKE 'ark:%' THEN regexp_replace(id, '^ark:(\\d+)/', 'ark:\\1/evidence-graph-')
    ELSE id || '-evidence-graph' END AS graph_id FROM ent""", "ent"))
def evidence_graph_ids(spark, folder):
    return graph(spark, folder).entities.select(F.col("entity_id").alias("id"), X.evidence_graph_id("entity_id").alias("graph_id"))


@register("type_readings", query("""SELECT kind, count(*)::BIGINT AS n,
    CASE kind WHEN 'ROCrate' THEN 'Dataset' WHEN 'CreativeWork' THEN 'Other' ELSE kind END AS norm_type,
    CASE WHEN kind IN ('CreativeWork') THEN kind ELSE 'https://w3id.org/EVI#' || kind END AS last_type,
    CASE kind WHEN 'ROCrate' THEN 'Dataset' WHEN 'CreativeWork' THEN kind ELSE 'https://w3id.org/EVI#' || kind END AS edge_type,
    kind AS evi_type, kind = 'ROCrate' AS is_crate, kind AS label_type FROM ent GROUP BY ALL""", "ent"))
def type_readings(spark, folder):
    e = K.with_types(graph(spark, folder).entities)
    return e.groupBy(F.col("evi_type").alias("kind"), "norm_type", "last_type", "edge_type", "evi_type",
                     K.is_crate("types").alias("is_crate"), K.node_label_type("types").alias("label_type")).agg(F.count("*").alias("n"))
