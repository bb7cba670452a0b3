import json
import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from provlake.functions import cells as C
from provlake.operators import tables as T
from provlake.sources.delimited import parse_records, read_cells

# One column for each type, with values of this test's own; `mostly` reads as integer in nine cells of ten.
COLUMNS = {
    "integer": ["7", "-12", "+300"], "number": ["0.5", "6.02e23", "-1."], "boolean": ["TRUE", "false", "True"], "year": ["1815", "1969", "2042"],
    "yearmonth": ["1984-11", "2001-07", "1666-09"], "date": ["1755-11-01", "1989-11-09", "2004-02-29"], "time": ["23:15:00", "04:30:59.5", "12:00:00Z"],
    "datetime": ["1755-11-01T09:40:00", "2011-03-11 05:46:24Z", "1908-06-30T07:17:00+07:00"], "duration": ["P2W", "PT90M", "-P1DT1S"],
    "array": ["[]", "[[1],[2]]", '["x"]'], "object": ["{}", '{"k":null}', '{"a":{"b":1}}'], "geopoint": ["38.7,-9.1", "101.9, 60.9", "0,0"],
    "geojson": ['{"type":"Point","coordinates":[1,2]}'] * 3, "string": ["tin", "lead 9", "2 parts"], "any": ["", "", ""]}
EXPECTED = {f"c_{kind}": "integer" if kind == "year" else kind for kind in COLUMNS}


def _quoted(cell):
    return '"' + cell.replace('"', '""') + '"' if any(x in cell for x in ',"\n') else cell


KINDS_CSV = "".join(",".join(map(_quoted, line)) + "\n" for line in [[f"c_{k}" for k in COLUMNS], *zip(*COLUMNS.values(), strict=True)])
FILES = {
    "kinds.csv": KINDS_CSV, "gaps.tsv": "left\tright\n\t8\n\t\n\t9\n", "notes.tsv": "# made by hand\n# twice\ncity\tfounded\nPorto\t1123\nBraga\t16\n",
    "marked.tsv": "#contig\tfrom\tto\nq1\t5\t9\n", "long_preamble.csv": "".join(f"# remark {i}\n" for i in range(60)) + "unit,n\nkg,3\n", "remarks.tsv": "# nothing\n# else\n",
    "wide.tsv": "\n".join("\t".join(row) for row in [["buoy", *(f"hour{i}" for i in range(8))], ["Leixoes", *(f"{1.5 + i / 4}" for i in range(8))], ["Sines", *(f"{2.25 - i / 8}" for i in range(8))]]) + "\n",
    "only_header.csv": "x,y\n", "nothing.csv": "", "same.csv": "v,v, ,v\n9,8,7,6\n5\n", "other.txt": "no\n",
}


@pytest.fixture(scope="module")
def inferred(spark, tmp_path_factory):
    d = tmp_path_factory.mktemp("tables")
    for name, text in FILES.items():
        (d / name).write_text(text)
    cells = read_cells(spark, str(d)).withColumn("file", F.regexp_extract("file", "([^/]*)$", 1))
    props = T.infer_schemas(cells)
    out = {}
    for r in props.orderBy("file", "col").collect():
        out.setdefault(r["file"], []).append((r["name"], r["detected"]))
    return out, props


def test_detected_types(inferred):
    out, _ = inferred
    got = dict(out["kinds.csv"])
    assert got.pop("c_year") in ("integer", "year") and got == {k: v for k, v in EXPECTED.items() if k != "c_year"}
    assert out["gaps.tsv"] == [("left", "any"), ("right", "integer")]
    assert out["notes.tsv"] == [("city", "string"), ("founded", "integer")] and out["long_preamble.csv"] == [("unit", "string"), ("n", "integer")]
    assert [n for n, _ in out["marked.tsv"]] == ["#contig", "from", "to"]
    assert not {"remarks.tsv", "nothing.csv", "other.txt"} & set(out)
    assert dict(out["only_header.csv"]) == {"x": "any", "y": "any"}
    assert [n for n, _ in out["same.csv"]] == ["v", "v2", "field3", "v3"]


def test_wide_tables_fold(inferred):
    _, props = inferred
    got = T.collapse_trailing(props.where("file = 'wide.tsv'"), 4).orderBy("position").collect()
    assert [(r["name"], r["index"], r["type"], r["item_type"], r["span"]) for r in got] == [("buoy", "0", "string", None, None), ("values", "1::", "array", "number", 8)]
    doc = T.schema_documents(T.collapse_trailing(props.where("file = 'wide.tsv'"), 4)).first()
    text = json.loads(T.schema_texts(T.schema_documents(T.collapse_trailing(props.where("file in ('wide.tsv', 'kinds.csv')"), 4))).where("file = 'wide.tsv'").first()["json"])
    assert text["properties"]["values"] == {"description": "Columns hour0..hour7 (8 number values) collapsed into one spanning array", "index": "1::", "type": "array",
                                            "items": {"type": "number"}, "min-items": 8, "max-items": 8, "unique-items": False}
    assert text["properties"]["buoy"] == {"description": "Column buoy", "index": 0, "type": "string"} and text["separator"] == "\t" and text["examples"] == []
    dates = T.schema_documents(T.collapse_trailing(props.where("file = 'kinds.csv'"), 0)).first()["properties"]
    assert {p["name"]: (p["type"], p["source_type"]) for p in dates}["c_date"] == ("string", "date")
    assert doc["required"] == ["buoy", "values"] and doc["separator"] == "\t" and "(8 number values)" in doc["properties"][1]["description"]
    assert T.collapse_trailing(props.where("file = 'wide.tsv'"), 0).count() == 9


def test_array_name_moves_on(spark):
    rows = [("f.csv", c, n, "number" if c > 2 else "string", None, "number" if c > 2 else "string") for c, n in enumerate(["values", "_values", "x", "a", "b"])]
    props = spark.createDataFrame(rows, "file string, col int, name string, type string, source_type string, detected string")
    assert {r["name"] for r in T.collapse_trailing(props, 2).collect()} == {"values", "_values", "x", "__values"}


@pytest.mark.parametrize("text,delimiter,records", [
    ('k;"semi;colon"\n"two\nlines";"she said ""no"""\n', ";", [["k", "semi;colon"], ["two\nlines", 'she said "no"']]),
    ("\ufeffone,two\r\n\r\n3,", ",", [["one", "two"], [""], ["3", ""]]), ('5" pipe,"6"x\n', ",", [['5" pipe', "6x"]]), ("u\tv", "\t", [["u", "v"]])])
def test_records(text, delimiter, records):
    assert list(parse_records(text, delimiter)) == records


def reads(make, text):
    try:
        make(text)
    except (ValueError, TypeError, OverflowError):
        return False
    return True


def reader_rows():
    """(kind, cell, whether the kind reads it), made from what each kind is: Python's own readers, the calendar, the globe, shapes."""
    draw = random.Random(11)
    some = lambda letters, n: "".join(draw.choice(letters) for _ in range(n))
    for _ in range(400):
        s = some("0123456789_+- ", draw.randint(1, 6))
        yield "integer", s, reads(int, s)
        yield "year", s, len(s) == 4 and reads(int, s) and int(s) >= 0
        s = some("0123456789.eE+-", draw.randint(1, 7))
        yield "number", s, reads(float, s)
    for _ in range(300):
        y, m, d = draw.randint(1, 9999), draw.randint(0, 14), draw.randint(0, 33)
        day, on_calendar = f"{y:04d}-{m:02d}-{d:02d}", reads(lambda _: date(y, m, d), None)
        hh, mm, ss = draw.randint(0, 30), draw.randint(0, 70), draw.randint(0, 70)
        clock = f"{hh:02d}:{mm:02d}:{ss:02d}"
        yield "date", day, on_calendar
        yield "yearmonth", f"{y:04d}-{m:02d}", 1 <= m <= 12
        yield "yearmonth", day, False
        for kind, cell in (("time", clock), ("datetime", f"{day}{draw.choice('T ')}{clock}")):  # read by their shape, not by the clock
            yield kind, cell, True
            yield kind, cell[:-1], False
            yield kind, cell.replace(":", "."), False
        days, hours = ([(u, draw.randint(0, 99)) for u in units if draw.random() < 0.4] for units in ("YMD", "HMS"))
        text = "P" + "".join(f"{n}{u}" for u, n in days) + ("T" if hours else "") + "".join(f"{n}{u}" for u, n in hours)
        yield "duration", text, bool(days or hours)
        yield "duration", text + "T", False
        yield "duration", text[1:], text == "P"  # an empty cell reads as anything
        lon, lat = draw.uniform(-260, 260), draw.uniform(-130, 130)
        yield "geopoint", f"{lon:.3f},{lat:.4f}", abs(round(lon, 3)) <= 180 and abs(round(lat, 4)) <= 90
        yield "geopoint", f"{lon:.3f}", False
        value = draw.choice([[draw.random()], {"depth": draw.randint(0, 9)}, [{"k": []}], draw.randint(0, 9), "words", {}])
        spelled = json.dumps(value)
        yield "array", spelled, isinstance(value, list)
        yield "object", spelled, isinstance(value, dict)
        if isinstance(value, (list, dict)):
            yield "array", spelled[:-1], False
            yield "object", spelled[:-1], False
    for kind, member in [*((g, "coordinates") for g in C.GEOMETRIES), *C.COLLECTIONS.items()]:
        yield "geojson", json.dumps({"type": kind, member: []}), True
        yield "geojson", json.dumps({"type": kind, "depth": []}), False
        yield "geojson", json.dumps({"type": kind.lower() + "s", member: []}), False
    for word in ("true", "false"):
        for s in (word, word.title(), word.upper()):
            yield "boolean", s, True
            yield "boolean", s + "ish", False
    for kind in C.CANDIDATES:
        for cell in COLUMNS[kind] if kind in COLUMNS else []:
            yield kind, cell, True
        yield kind, None, True
        yield kind, "", True
        yield kind, "between two tides", kind == "string"


def test_cell_readers(spark):
    df = C.prepared(spark.createDataFrame(list(reader_rows()), "kind string, cell string, want boolean"))
    got = F.lit(None).cast("boolean")
    for k in C.CANDIDATES:
        got = F.when(F.col("kind") == k, C.readable(k, "cell", ready=True)).otherwise(got)
    assert df.where(~got.eqNullSafe(F.col("want"))).select("kind", "cell").collect() == []
    assert set([*C.TEXT_READERS, *C.JSON_READERS]) == set(C.CANDIDATES)


# Columns worked by hand. A column ends as soon as a reader has 90 % of the points there can be.
RACES = [
    (["4"] * 9 + ["x"], "integer"),  # nine points of ten after the ninth cell
    (["4"] * 8 + ["x", "4"], "string"),  # eight, seven, eight: too few for integer; every cell is a string
    (["4"] * 9 + [""], "integer"), (["x"] + ["4"] * 9, "string"),  # integer ends at eight
    (["", "", "4", "5"], "integer"), (["", ""], "any"), (["2.5", "3", "4"], "number"), (["true", "false", "1"], "boolean"),
    (["2001-02", "1999-12"], "yearmonth"), (["x", "x", "4", "4"], "string"), ([None, "4"], "integer"),  # a cell that a row is too short to have reads as anything
]


@pytest.mark.parametrize("block_rows", [None, 3])
def test_race_by_hand(spark, block_rows):
    rows = [(f"f{i}.csv", r, 0, c) for i, (column, _) in enumerate(RACES) for r, c in enumerate(column)]
    cells = spark.createDataFrame(rows, "file string, row int, col int, cell string")
    got = {r["file"]: r["source_type"] for r in T.type_race(cells, cells.groupBy("file").agg(F.count("*").alias("n_rows")), block_rows).collect()}
    assert got == {f"f{i}.csv": kind for i, (_, kind) in enumerate(RACES)}


def test_blocks_do_not_change_the_race(spark):
    rng = random.Random(7)
    pool = ["1", "2", "", None, "x", "1.5", "true", "2019-05-06", "[1]", "10:11:12", "2019-05"]
    rows = [(f"f{i}.csv", r, 0, rng.choice(pool[:rng.randint(1, 11)])) for i in range(100) for r in range(rng.randint(1, 40))]
    cells = spark.createDataFrame(rows, "file string, row int, col int, cell string")
    counts = cells.groupBy("file").agg(F.count("*").alias("n_rows"))
    one, many = ({r["file"]: r["source_type"] for r in T.type_race(cells, counts, b).collect()} for b in (None, 7))
    assert one == many and len(set(one.values())) >= 4
