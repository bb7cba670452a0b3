"""SQL fragments of the run-log adapter, for checking results on another engine.

``query(body, 'a', 'b')`` puts the named common tables and what they need before the body.
"""

from __future__ import annotations

NAAN = "59853"


def trim(x: str) -> str:
    return rf"regexp_replace({x}, '\A[\x00-\x20]+|[\x00-\x20]+\z', '', 'g')"


def slug(x: str) -> str:
    clean = f"regexp_replace(regexp_replace(lower(coalesce({x}, '')), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g')"
    return f"coalesce(nullif(regexp_replace(left({clean}, 40), '-+$', ''), ''), 'unnamed')"


def ark(prefix: str, name: str, source: str) -> str:
    return f"('ark:{NAAN}/{prefix}-' || {slug(name)} || '-' || left(sha1({source}), 7))"


def base(x: str) -> str:
    return f"regexp_extract({x}, '([^/]*)$', 1)"


def bare(x: str) -> str:
    return f"(CASE WHEN contains({x}, ':') THEN {trim(f'regexp_extract({x}, ' + chr(39) + '([^:]*)$' + chr(39) + ', 1)')} ELSE {x} END)"


def data_ark(key: str) -> str:
    return ark("dataset", base(key), key)


CTE: dict[str, tuple[list[str], str]] = {
    "cust": ([], """SELECT c_custkey, c_mktsegment, n_nationkey, n_regionkey, 'region-' || n_regionkey AS session_id
        FROM customer JOIN nation ON c_nationkey = n_nationkey"""),
    "ord": (["cust"], """SELECT o_orderkey, o_custkey, o_orderpriority, c_custkey, session_id, n_nationkey, n_regionkey,
        CASE WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'P' THEN 'FAILED' WHEN o_orderstatus = 'O' THEN 'CACHED'
             ELSE 'COMPLETED' END AS status FROM orders JOIN cust ON o_custkey = c_custkey"""),
    "nat": ([], "SELECT n_nationkey, n_name, n_regionkey, 'region-' || n_regionkey AS session_id FROM nation"),
    "reg": ([], "SELECT r_regionkey, r_name, 'region-' || r_regionkey AS session_id FROM region"),
    "tasks": (["cust", "ord", "nat", "reg"], "UNION ALL".join(f"""
        SELECT session_id, '{lv[0]}' || {key} AS task_hash, {proc} || ' (' || {key} || ')' AS task_name, {proc} AS process,
            '#!/bin/sh' || chr(10) || 'build {lv} --key ' || {key} || chr(10) || '  publish ' || {key} AS script,
            'reg.example:5000/trade/{lv}:' || {tag} AS container, {status} AS status,
            ({rank} * 1000000000000 + {key})::BIGINT AS seq FROM {src} """ for lv, rank, key, proc, tag, status, src in [
        ("order", 1, "o_orderkey", "'TRADE:ORDERS:' || o_orderpriority", "left(o_orderpriority, 1)", "status", "ord"),
        ("customer", 2, "c_custkey", "'TRADE:CUSTOMERS:' || c_mktsegment", "'1'", "'COMPLETED'", "cust"),
        ("nation", 3, "n_nationkey", "'TRADE:NATIONS:ROLLUP'", "'1'", "'COMPLETED'", "nat"),
        ("region", 4, "r_regionkey", "'TRADE:REGIONS:ROLLUP'", "'1'", "'COMPLETED'", "reg")])),
    "ok_tasks": (["tasks"], f"SELECT *, {ark('computation', bare('task_name'), 'task_hash')} AS comp FROM tasks WHERE status <> 'FAILED'"),
    "parts": ([], """SELECT DISTINCT l_orderkey, 'work/part/' || p_partkey || CASE WHEN p_size % 2 = 0 THEN '.csv' ELSE '.tsv' END AS path
        FROM lineitem JOIN part ON l_partkey = p_partkey"""),
    "t_in": (["cust", "ord", "nat", "reg", "parts"], """
        SELECT session_id, 'o' || o_orderkey AS task_hash, path FROM parts JOIN ord ON l_orderkey = o_orderkey
        UNION ALL SELECT session_id, 'c' || c_custkey, 'work/order/' || o_orderkey || '.json' FROM ord
        UNION ALL SELECT session_id, 'n' || n_nationkey, 'work/customer/' || c_custkey || '.csv' FROM cust
        UNION ALL SELECT session_id, 'r' || n_regionkey, 'work/nation/' || n_nationkey || '.csv' FROM nat
        UNION ALL SELECT session_id, 'r' || r_regionkey, 'work/collated/' || r_regionkey || '.yml' FROM reg"""),
    "t_out": (["cust", "ord", "nat", "reg"], """
        SELECT session_id, 'o' || o_orderkey AS task_hash, 'work/order/' || o_orderkey || '.json' AS path FROM ord
        UNION ALL SELECT session_id, 'c' || c_custkey, 'work/customer/' || c_custkey || '.csv' FROM cust
        UNION ALL SELECT session_id, 'n' || n_nationkey, 'work/nation/' || n_nationkey || '.csv' FROM nat
        UNION ALL SELECT session_id, 'r' || r_regionkey, 'work/region/' || r_regionkey || '.csv' FROM reg"""),
    "k_in": (["t_in", "ok_tasks"], "SELECT i.*, comp FROM t_in i JOIN ok_tasks t USING (session_id, task_hash)"),
    "k_out": (["t_out", "ok_tasks"], "SELECT o.*, comp, seq FROM t_out o JOIN ok_tasks t USING (session_id, task_hash)"),
    "r_in": (["k_in", "k_out"], """SELECT DISTINCT session_id, path FROM k_in i
        WHERE NOT EXISTS (SELECT 1 FROM k_out o WHERE o.session_id = i.session_id AND o.path = i.path)"""),
    "pub": (["cust", "nat", "reg"], """
        SELECT session_id, 'work/customer/' || c_custkey || '.csv' AS source, 'results/customer/' || c_custkey || '.csv' AS target,
            (2 * 1000000000000 + c_custkey)::BIGINT AS seq FROM cust
        UNION ALL SELECT session_id, 'work/nation/' || n_nationkey || '.csv', 'results/nation/' || n_nationkey || '.csv',
            (3 * 1000000000000 + n_nationkey)::BIGINT FROM nat
        UNION ALL SELECT session_id, 'work/region/' || r_regionkey || '.csv', 'results/region/' || r_regionkey || '.csv',
            (4 * 1000000000000 + r_regionkey)::BIGINT FROM reg
        UNION ALL SELECT session_id, 'work/collated/' || r_regionkey || '.yml', 'results/collated/' || r_regionkey || '.yml',
            (5 * 1000000000000 + r_regionkey)::BIGINT FROM reg"""),
    "run": (["reg"], f"""SELECT *, {ark('rocrate', 'run_name', 'session_id')} AS root, {ark('computation', 'run_name', "session_id || '#run'")} AS run,
        {ark('software', 'run_name', "'flows/trade.flow2.1'")} AS workflow, {ark('software', "'engine'", "'engine-1.0'")} AS engine
        FROM (SELECT session_id, 'Trade ' || lower(r_name) AS run_name, r_regionkey FROM reg)"""),
    "used": (["k_in", "r_in", "run", "pub", "k_out"], f"""SELECT DISTINCT session_id, comp, {data_ark('path')} AS ark FROM k_in
        UNION ALL SELECT session_id, run, {data_ark('path')} FROM (SELECT r.*, run FROM r_in r JOIN run USING (session_id)
            WHERE NOT EXISTS (SELECT 1 FROM pub p WHERE p.session_id = r.session_id AND p.source = r.path))"""),
    "made": (["k_out", "pub", "run"], f"""SELECT session_id, comp, {data_ark('path')} AS ark FROM k_out
        UNION ALL SELECT DISTINCT session_id, run, {data_ark('source')} FROM pub JOIN run USING (session_id)"""),
    "data": (["k_in", "k_out", "pub"], f"""SELECT session_id, {data_ark('path')} AS ark, path, coalesce(target, path) AS shown, comp AS producer
        FROM (SELECT session_id, path FROM k_in UNION SELECT session_id, path FROM k_out UNION SELECT session_id, source FROM pub) f
        LEFT JOIN (SELECT session_id, source AS path, target FROM pub) p USING (session_id, path)
        LEFT JOIN (SELECT session_id, path, comp FROM k_out) o USING (session_id, path)"""),
    "procs": (["ok_tasks", "run"], f"""SELECT DISTINCT t.session_id, process, {ark('software', bare('process'), "'flows/trade.flow#' || process")} AS software,
        workflow FROM ok_tasks t JOIN run USING (session_id)"""),
    "ent": (["data", "ok_tasks", "procs", "run"], """SELECT session_id AS crate_id, ark AS id, 'Dataset' AS kind FROM data
        UNION ALL SELECT session_id, comp, 'Computation' FROM ok_tasks
        UNION ALL SELECT session_id, run, 'Computation' FROM run
        UNION ALL SELECT session_id, root, 'ROCrate' FROM run
        UNION ALL SELECT session_id, 'ro-crate-metadata.json', 'CreativeWork' FROM run
        UNION ALL SELECT session_id, workflow, 'Software' FROM run
        UNION ALL SELECT session_id, engine, 'Software' FROM run
        UNION ALL SELECT session_id, software, 'Software' FROM procs"""),
    "edge": (["used", "made", "data", "ok_tasks", "procs", "run", "ent"], """
        SELECT session_id AS crate_id, comp AS src, 'usedDataset' AS predicate, ark AS dst FROM used
        UNION ALL SELECT session_id, comp, 'generated', ark FROM made
        UNION ALL SELECT session_id, ark, 'generatedBy', producer FROM data WHERE producer IS NOT NULL
        UNION ALL SELECT t.session_id, comp, 'usedSoftware', software FROM ok_tasks t JOIN procs USING (session_id, process)
        UNION ALL SELECT session_id, comp, 'isPartOf', run FROM ok_tasks t JOIN run USING (session_id)
        UNION ALL SELECT session_id, run, 'usedSoftware', workflow FROM run
        UNION ALL SELECT session_id, run, 'usedSoftware', engine FROM run
        UNION ALL SELECT session_id, software, 'isPartOf', workflow FROM procs
        UNION ALL SELECT session_id, 'ro-crate-metadata.json', 'about', root FROM run
        UNION ALL SELECT crate_id, root, 'hasPart', id FROM ent JOIN run ON crate_id = session_id
            WHERE id <> root AND id <> 'ro-crate-metadata.json'"""),
    "walk": (["edge"], """SELECT crate_id, src, dst FROM edge WHERE predicate IN ('generatedBy', 'usedDataset', 'usedSoftware')"""),
}


def query(body: str, *needs: str, extra: dict[str, str] | None = None, recursive: bool = False) -> str:
    done: list[str] = []

    def add(name: str):
        if name in done:
            return
        for dep in CTE[name][0]:
            add(dep)
        done.append(name)
    for n in needs:
        add(n)
    parts = [f"{n} AS MATERIALIZED ({CTE[n][1]})" for n in done]
    parts += [f"{n} AS ({s})" for n, s in (extra or {}).items()]
    return ("WITH " + ("RECURSIVE " if recursive else "") + ",\n".join(parts) + "\n" if parts else "") + body
