import base64
import gzip
import hashlib
import json
from collections import Counter
from itertools import accumulate

import pytest
from pyarrow import fs
from pyspark.sql import functions as F

from provlake.llm import warc

SCHEMA = "page_id bigint, url string, html string"
ROWS = [(1, "http://a/?q=ü\r\nX: y", "<p>one</p>"), (2, None, None), (3, "u", ""), (4, "u", "<p>one</p>"), (5, "u", "\r\n\r\nWARC/1.1\r\n\r\n"), (6, "u", "é" * 300_000),
        (7, "u", "<p>one</p>"), (8, "u", "tiny"), (9, "u", "tiny"), (None, "u", "nobody"), (10, "u", "nobody"), (11, "u", "tw"), (11, "u", "tw")]


def want(rows, least=0):
    first = {}
    for i, _, html in rows:
        if i is not None and len((html or "").encode()) >= least:
            first[html or ""] = min(i, first.get(html or "", i))
    out = []
    for i, _, html in rows:
        raw = (html or "").encode()
        refers = first.get(html or "", i) if i is not None else None
        again = i is not None and refers != i
        out.append((i, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "revisit" if again else "response", refers if again else None))
    return Counter(out)


@pytest.mark.parametrize("least", [0, 5])
def test_round_trip(spark, least):
    pages = spark.createDataFrame(ROWS, SCHEMA).withColumn("digest", F.lit(1)).withColumn("first", F.lit("x")).withColumn("archive", F.lit(0))
    assert Counter(tuple(r) for r in warc.round_trip(pages, least).collect()) == want(ROWS, least)


def test_members_index_and_payloads(spark):
    pages = spark.createDataFrame(ROWS, SCHEMA).repartition(2)
    archives = warc.write_archives(pages, limit=2000)
    assert archives.count() >= 2 and archives.agg(F.sum("n_records")).first()[0] == len(ROWS)
    index = warc.normalise(archives)
    for path, in index.select("archive").distinct().collect():
        store, own = fs.FileSystem.from_uri(path)
        raw = store.open_input_file(own).read()
        lines = [json.loads(x) for x in store.open_input_stream(own + ".idx").read().decode().splitlines()]
        assert [x["offset"] for x in lines] == [0, *accumulate(x["length"] for x in lines)][:-1]
        members = [gzip.decompress(raw[x["offset"]:x["offset"] + x["length"]]) for x in lines]
        assert all(m.startswith(b"WARC/1.1\r\n") and m.endswith(b"\r\n\r\n") for m in members) and b"".join(members) == gzip.decompress(raw)
    html = {r["page_id"]: r["html"] for r in warc.read_records(index).where("record_type = 'response'").collect()}
    assert html[1] == "<p>one</p>" and html[6] == "é" * 300_000 and html[5] == ROWS[4][2] and 4 not in html


def test_damage_and_nothing(spark, tmp_path):
    whole = gzip.compress(warc.record(1, "u", b"x" * 5000, None))
    for name, raw in (("cut", whole[:-20]), ("half", gzip.compress(warc.record(1, "u", b"x", None)[:-9])), ("other", gzip.compress(b"no record\r\n\r\n"))):
        (tmp_path / f"{name}.warc.gz").write_bytes(raw)
        with pytest.raises(Exception, match=name):
            warc.normalise(spark.createDataFrame([(str(tmp_path / f"{name}.warc.gz"), 1)], "archive string, n_records bigint"))
    (tmp_path / "many.warc.gz").write_bytes(whole + whole)  # a file that has members already
    assert warc.normalise(spark.createDataFrame([(str(tmp_path / "many.warc.gz"), 2)], "archive string, n_records bigint")).count() == 2
    assert warc.round_trip(spark.createDataFrame([], SCHEMA)).collect() == []
