"""Queries over table files: header names, preamble, column types, folding."""

from __future__ import annotations

from pyspark.sql import functions as F

from provlake.functions import cells as C
from provlake.operators import tables as T
from provlake.plans import adapter as A
from provlake.plans.sqlbase import trim

QUERIES, SQL = {}, {}


def register(name, sql=None):
    def wrap(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return wrap


# Each column of the order "files" is one way to write an order as text: (Spark, SQL).
RENDERINGS = [
    ("cast(o_orderkey as string)", "o_orderkey::VARCHAR"),
    ("date_format(o_orderdate, 'yyyy-MM-dd')", "strftime(o_orderdate, '%Y-%m-%d')"),
    ("date_format(o_orderdate, 'yyyy-MM-dd HH:mm:ss')", "strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')"),
    ("o_orderpriority", "o_orderpriority"),
    ("date_format(o_orderdate, 'yyyy-MM')", "strftime(o_orderdate, '%Y-%m')"),
    ("case when o_orderstatus = 'P' then '' else cast(o_custkey as string) end", "CASE WHEN o_orderstatus = 'P' THEN '' ELSE o_custkey::VARCHAR END"),
    ("concat(cast(o_custkey % 200 as string), ',', cast(o_custkey % 90 as string), '.5')", "(o_custkey % 200) || ',' || (o_custkey % 90) || '.5'"),
    ("case when o_orderstatus = 'O' then 'n/a' else cast(o_orderkey as string) end", "CASE WHEN o_orderstatus = 'O' THEN 'n/a' ELSE o_orderkey::VARCHAR END"),
    ("concat('{\"k\": ', cast(o_custkey as string), '}')", "'{\"k\": ' || o_custkey || '}'"),
    ("concat('[', cast(o_custkey as string), ', 2]')", "'[' || o_custkey || ', 2]'"),
    ("case when o_orderstatus = 'F' then 'True' else 'false' end", "CASE WHEN o_orderstatus = 'F' THEN 'True' ELSE 'false' END"),
    ("case when o_orderstatus = 'P' then null else cast(o_orderkey as string) end", "CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderkey::VARCHAR END"),
    ("concat('P', cast(o_custkey % 30 as string), 'DT', cast(o_custkey % 24 as string), 'H')", "'P' || (o_custkey % 30) || 'DT' || (o_custkey % 24) || 'H'"),
    ("date_format(o_orderdate, 'HH:mm:ss')", "strftime(o_orderdate, '%H:%M:%S')"),
    ("concat('{\"type\": \"Point\", \"coordinates\": [', cast(o_custkey as string), ', 1]}')", "'{\"type\": \"Point\", \"coordinates\": [' || o_custkey || ', 1]}'"),
    ("''", "''"),
    ("date_format(o_orderdate, 'yyyy')", "strftime(o_orderdate, '%Y')"),
    ("concat(cast(o_custkey as string), case when o_orderstatus = 'F' then '.25e1' else '' end)", "o_custkey || CASE WHEN o_orderstatus = 'F' THEN '.25e1' ELSE '' END"),
    ("case when o_custkey % 16 = 3 then 'none' else concat(' ', cast(o_custkey as string)) end", "CASE WHEN o_custkey % 16 = 3 THEN 'none' ELSE ' ' || o_custkey END"),
    ("concat(date_format(o_orderdate, 'yyyy'), '-02-', cast(1 + o_custkey % 31 as string))", "strftime(o_orderdate, '%Y') || '-02-' || (1 + o_custkey % 31)"),
    ("case when o_orderstatus = 'P' then 'P' when o_orderstatus = 'O' then 'PT' else 'P1.5Y' end", "CASE WHEN o_orderstatus = 'P' THEN 'P' WHEN o_orderstatus = 'O' THEN 'PT' ELSE 'P1.5Y' END"),
    ("case when o_orderstatus = 'P' then '-1_000' when o_orderstatus = 'O' then 'NaN' else '.5' end", "CASE WHEN o_orderstatus = 'P' THEN '-1_000' WHEN o_orderstatus = 'O' THEN 'NaN' ELSE '.5' END"),
    ("case when o_orderstatus = 'P' then '{\"type\": \"Feature\"}' else '{\"type\": \"Feature\", \"geometry\": null}' end",
     "CASE WHEN o_orderstatus = 'P' THEN '{\"type\": \"Feature\"}' ELSE '{\"type\": \"Feature\", \"geometry\": null}' END"),
]


def order_cells(t):
    """(file, row, col, cell): one file per priority, one row per order."""
    orders = t.orders.select(F.concat(F.lit("orders-"), "o_orderpriority", F.lit(".csv")).alias("file"), F.col("o_orderkey").alias("row"),
                             F.posexplode(F.array(*[F.expr(s) for s, _ in RENDERINGS])).alias("col", "cell"))
    return orders


CELLS = " UNION ALL ".join(f"SELECT 'orders-' || o_orderpriority || '.csv' AS file, o_orderkey AS row, {i} AS col, {s} AS cell FROM orders"
                           for i, (_, s) in enumerate(RENDERINGS))


def sql_reader(kind: str, x: str = "cell") -> str:
    t = trim(x)
    num = r"[+-]?(\d+(_\d+)*(\.(\d+(_\d+)*)?)?|\.\d+(_\d+)*)([eE][+-]?\d+)?"
    word = r"(?i)[+-]?(inf|infinity|nan|snan)"
    integer = r"[+-]?\d+(_\d+)*"
    full = lambda v, p: f"regexp_full_match({v}, '{p}')"
    number = lambda v: f"({full(trim(v), num)} OR {full(trim(v), word)})"
    part = lambda sep, i: f"string_split({x}, '{sep}')[{i}]"
    whole = lambda v: f"try_cast(replace({trim(v)}, '_', '') AS INTEGER)"
    zone = r"([Zz]|[+-]\d{2}:?\d{2})?"
    a = r"\d+(\.\d+)?"
    js = f"try_cast({x} AS JSON)"
    jt = f"coalesce(json_type({js}), '')"
    y, m, d = (f"try_cast(regexp_extract({x}, '^(\\d{{1,4}})-(\\d{{1,2}})-(\\d{{1,2}})$', {i}) AS INTEGER)" for i in (1, 2, 3))
    gt = f"json_extract_string({js}, '$.type')"
    has = lambda k: f"list_contains(json_keys({js}), '{k}')"
    return {
        "string": "true", "integer": full(t, integer), "number": number(x),
        "boolean": f"{x} IN ('true', 'True', 'TRUE', '1', 'false', 'False', 'FALSE', '0')",
        "year": f"(length({x}) = 4 AND {full(t, integer)} AND {whole(x)} BETWEEN 0 AND 9999)",
        "yearmonth": f"(len(string_split({x}, '-')) = 2 AND {full(trim(part('-', 1)), integer)} AND {full(trim(part('-', 2)), integer)} AND coalesce({whole(part('-', 2))} BETWEEN 1 AND 12, false))",
        "date": f"({full(x, r'\d{1,4}-\d{1,2}-\d{1,2}')} AND {m} BETWEEN 1 AND 12 AND {d} BETWEEN 1 AND CASE WHEN {m} = 2 THEN CASE WHEN ({y} % 4 = 0 AND {y} % 100 <> 0) OR {y} % 400 = 0 THEN 29 ELSE 28 END WHEN {m} IN (4, 6, 9, 11) THEN 30 ELSE 31 END)",
        "datetime": full(x, r"\d{4}-\d{2}-\d{2}[Tt ]\d{2}:\d{2}:\d{2}(\.\d+)?" + zone),
        "time": full(x, r"\d{2}:\d{2}:\d{2}(\.\d+)?" + zone),
        "duration": f"({full(x, f'[+-]?P({a}Y)?({a}M)?({a}W)?({a}D)?(T({a}H)?({a}M)?({a}S)?)?')} AND {x} NOT IN ('P', '+P', '-P') AND NOT ends_with({x}, 'T'))",
        "geopoint": f"(len(string_split({x}, ',')) = 2 AND {number(part(',', 1))} AND {number(part(',', 2))} AND coalesce(abs(try_cast({trim(part(',', 1))} AS DECIMAL(38,18))) <= 180 AND abs(try_cast({trim(part(',', 2))} AS DECIMAL(38,18))) <= 90, false))",
        "array": f"({jt} = 'ARRAY')", "object": f"({jt} = 'OBJECT')",
        "geojson": f"""CASE WHEN {jt} = 'OBJECT' THEN coalesce(({gt} IN ('Point', 'MultiPoint', 'LineString', 'MultiLineString', 'Polygon', 'MultiPolygon') AND {has('coordinates')})
            OR ({gt} = 'GeometryCollection' AND {has('geometries')}) OR ({gt} = 'Feature' AND {has('geometry')}) OR ({gt} = 'FeatureCollection' AND {has('features')}), false) ELSE false END""",
    }[kind]


def sql_readable(kind: str) -> str:
    return f"(cell IS NULL OR cell = '' OR coalesce({sql_reader(kind)}, false))"


N = range(len(C.CANDIDATES))
RACE = f"""WITH cells AS ({CELLS}),
sized AS (SELECT *, count(*) OVER (PARTITION BY file, col) AS n FROM cells),
scored AS (SELECT file, row, col, n, CASE WHEN cell = '' THEN 1 ELSE 0 END AS miss, {', '.join(
    f"CASE WHEN cell = '' THEN 0 WHEN {sql_readable(k)} THEN 1 ELSE -1 END AS d{i}" for i, k in enumerate(C.CANDIDATES))} FROM sized),
run AS (SELECT file, row, col, n, n - sum(miss) OVER w AS best, {', '.join(f'sum(d{i}) OVER w AS s{i}' for i in N)} FROM scored
    WINDOW w AS (PARTITION BY file, col ORDER BY row ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
low AS (SELECT *, {', '.join(f'coalesce(min(s{i}) OVER w, 0) AS m{i}' for i in N)} FROM run
    WINDOW w AS (PARTITION BY file, col ORDER BY row ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
won AS (SELECT file, col, row, CASE {' '.join(
    f"WHEN m{i} >= n * (0.9::DOUBLE - 1) AND best > 0 AND s{i} >= best * 0.9::DOUBLE THEN '{k}'" for i, k in enumerate(C.CANDIDATES))} END AS kind FROM low),
race AS (SELECT file, col, coalesce(arg_min(kind, row) FILTER (kind IS NOT NULL), 'any') AS detected FROM won GROUP BY ALL),
props AS (SELECT *, CASE {' '.join(f"WHEN detected = '{k}' THEN '{v}'" for k, v in C.CANONICAL.items())} ELSE 'string' END AS type FROM race)
"""


def order_types(t, block_rows):
    cells = order_cells(t)
    counts = t.orders.groupBy(F.concat(F.lit("orders-"), "o_orderpriority", F.lit(".csv")).alias("file")).agg(F.count("*").alias("n_rows"))
    return T.type_race(cells, counts, block_rows)


def order_props(t, block_rows=1000):
    types = order_types(t, block_rows)
    return T.property_rows(types.select("file", "col", F.concat(F.lit("c"), A.text("col")).alias("name")), types)


@register("type_race", RACE + "SELECT file, col, type, CASE WHEN type <> detected THEN detected END AS source_type FROM props")
def type_race(spark, folder):
    """Column types of whole order files, running scores taken in blocks of rows."""
    return order_props(A.Tables(spark, folder)).select("file", "col", "type", "source_type")


@register("schema_documents", RACE + """SELECT file, string_agg('c' || col, ',' ORDER BY col) AS required, string_agg(type, ',' ORDER BY col) AS types,
    ',' AS separator, 'tabular' AS schema_type FROM props GROUP BY file""")
def schema_documents(spark, folder):
    docs = T.schema_documents(T.collapse_trailing(order_props(A.Tables(spark, folder)), 0))
    return docs.select("file", F.array_join("required", ",").alias("required"),
                       F.array_join(F.transform("properties", lambda p: p["type"]), ",").alias("types"), "separator", "schema_type")


@register("cell_readers", f"WITH cells AS ({CELLS}) " + " UNION ALL ".join(
    f"SELECT col, '{k}' AS type, count(*) FILTER ({sql_readable(k)})::BIGINT AS n_readable FROM cells GROUP BY col" for k in C.CANDIDATES))
def cell_readers(spark, folder):
    cells = order_cells(A.Tables(spark, folder))
    counts = C.prepared(cells).groupBy("col").agg(*[F.count_if(C.readable(k, "cell", ready=True)).alias(k) for k in C.CANDIDATES])
    return counts.unpivot("col", C.CANDIDATES, "type", "n_readable")


@register("header_names", """SELECT file, col, CASE WHEN nth > 1 THEN base || nth ELSE base END AS name FROM (
    SELECT *, row_number() OVER (PARTITION BY file, base ORDER BY col) AS nth FROM (
        SELECT 'parts-' || p_partkey // 100 || '.csv' AS file, (p_partkey % 100)::INTEGER AS col,
            CASE WHEN p_size = 1 THEN 'field' || (p_partkey % 100 + 1) ELSE p_type END AS base FROM part))""")
def header_names(spark, folder):
    p = A.Tables(spark, folder).part
    label = F.when(F.col("p_size") == 1, " \n").otherwise(F.concat(F.lit(" "), "p_type"))
    return T.header_names(p.select(F.concat(F.lit("parts-"), A.text(F.floor(F.col("p_partkey") / 100)), F.lit(".csv")).alias("file"),
                                   (F.col("p_partkey") % 100).cast("int").alias("col"), label.alias("label")))


PREAMBLE = "'# source: ' || source || chr(10) || CASE lang WHEN 'de' THEN '#lang,source' ELSE '# lang: ' || lang END || chr(10) || text"


@register("preamble_drop", f"""WITH rec AS (SELECT doc_id, k - 1 AS row, lines[k] AS line, len(string_split(lines[k], ',')) AS width FROM (
        SELECT doc_id, lines, unnest(range(1, len(lines) + 1)) AS k FROM (SELECT doc_id, string_split({PREAMBLE}, chr(10)) AS lines FROM documents))),
    flagged AS (SELECT *, row < 50 AND starts_with(line, '#') AND NOT coalesce(width > 1 AND width = lead(width) OVER (PARTITION BY doc_id ORDER BY row), false) AS comment FROM rec),
    head AS (SELECT doc_id, min(row) AS header_row FROM flagged WHERE NOT comment AND row <= 50 GROUP BY ALL)
    SELECT doc_id::VARCHAR AS file, header_row::INTEGER AS header_row, count(*)::BIGINT AS n_rows, sum(width)::BIGINT AS n_cells
    FROM rec JOIN head USING (doc_id) WHERE row >= header_row GROUP BY ALL""")
def preamble_drop(spark, folder):
    d = A.Tables(spark, folder).documents
    text = F.concat(F.lit("# source: "), "source", F.lit("\n"), F.when(F.col("lang") == "de", "#lang,source").otherwise(
        F.concat(F.lit("# lang: "), "lang")), F.lit("\n"), "text")
    lines = d.select(A.text("doc_id").alias("file"), F.posexplode(F.split(text, "\n", -1)).alias("row", "line"))
    records = lines.select("file", "row", F.size(F.split("line", ",", -1)).alias("width"),
                           F.substring_index("line", ",", 1).alias("first"))
    header = T.first_data_rows(records)
    return records.join(header, "file").where("row >= header_row").groupBy("file", "header_row").agg(
        F.count("*").alias("n_rows"), F.sum("width").alias("n_cells"))


@register("trailing_collapse", """SELECT 'vectors-' || label || '.tsv' AS file, name, idx AS index, type, item_type, span, required FROM (
    SELECT label, max(len(embedding)) AS d FROM embeddings GROUP BY label), LATERAL (SELECT 'id' AS name, '0' AS idx, 'integer' AS type, NULL AS item_type,
        NULL::INTEGER AS span, 'id,values' AS required UNION ALL SELECT 'values', '1::', 'array', 'number', d::INTEGER, 'id,values')""")
def trailing_collapse(spark, folder):
    """A vector table is an id and one spanning array."""
    e = A.Tables(spark, folder).embeddings
    file = F.concat(F.lit("vectors-"), A.text("label"), F.lit(".tsv"))
    values = F.concat(F.array(A.text("vec_id")), F.transform("embedding", lambda v: v.cast("string")))
    cells = e.select(file.alias("file"), F.col("vec_id").alias("row"), F.posexplode(values).alias("col", "cell"))
    counts = e.groupBy(file.alias("file")).agg(F.count("*").alias("n_rows"))
    types = T.type_race(cells, counts, block_rows=10000)
    name = F.when(F.col("col") == 0, "id").otherwise(A.text(F.col("col") - 1))
    props = T.collapse_trailing(T.property_rows(types.select("file", "col", name.alias("name")), types), threshold=4)
    docs = T.schema_documents(props).select("file", F.array_join("required", ",").alias("required"))
    return props.join(docs, "file").select("file", "name", "index", "type", "item_type", "span", "required")


@register("inferred_schemas", """SELECT DISTINCT p_brand AS brand, unnest(['p_partkey', 'p_name', 'p_type', 'p_size', 'note']) AS name,
    unnest(['integer', 'string', 'string', 'integer', 'any']) AS detected FROM part""")
def inferred_schemas(spark, folder):
    """Parts written as csv files and read back: every row of every file counts."""
    from provlake.session import workspace
    from provlake.sources.delimited import read_cells
    home = workspace(spark, "part-files")
    A.Tables(spark, folder).part.select("p_brand", "p_partkey", F.concat(F.lit('a "'), "p_name", F.lit('", x')).alias("p_name"), "p_type", "p_size",
                                        F.lit("").alias("note")).write.partitionBy("p_brand").csv(home, header=True, escape='"', emptyValue="")
    props = T.infer_schemas(read_cells(spark, home))
    brand = F.replace(F.regexp_extract("file", "p_brand=([^/]*)", 1), F.lit("%23"), F.lit("#"))
    return props.select(brand.alias("brand"), "name", "detected").distinct()
