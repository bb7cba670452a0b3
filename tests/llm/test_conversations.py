import random
from collections import defaultdict
from hashlib import md5, sha256
from zlib import crc32

import pytest
from pyspark.sql import functions as F

from provlake.llm import conversations as c

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def brute(rows):
    by_conv = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = md5(f"{len(role.encode())}:{role}{text}".encode()).digest()
            by_conv[conv].append((turn is not None, turn or 0, digest, role, text))
    turns = {k: [x[3:] for x in sorted(v)] for k, v in by_conv.items()}
    built = {}
    for k, own in turns.items():
        h = crc32(str(k).encode()) % 9
        built[k] = tuple(turns.get(k - k % 5, [])[:h] + own[h:])
    members, ends = defaultdict(set), defaultdict(list)
    for k, seq in built.items():
        ends[seq].append(k)
        for d in range(len(seq) + 1):
            members[seq[:d]].add(k)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    out = []
    for node, inside in members.items():
        below, saved, leaf = [node], 0, 0
        while below:
            x = below.pop()
            saved += (len(members[x]) - 1) * len(x[-1][1].encode()) if x else 0
            leaf += not children[x]
            below += children[x]
        out.append((min(inside), len(node), min(members[node[:-1]]) if node else None, len(inside), len(children[node]), leaf, saved,
                    sha256(",".join(map(str, sorted(ends[node]))).encode()).hexdigest()))
    return sorted(out, key=str)


def some(n, seed, most=14):
    draw = random.Random(seed)
    rows = []
    for conv in range(n):
        if conv % 7 == 3:
            continue
        start = draw.randrange(3)
        for t in range(draw.randrange(1, most)):
            rows.append((conv, t, draw.choice(["user", "bot"]) if t > 3 else "user", f"said {t if t < 3 else draw.randrange(3)} {start if t == 0 else ''}é"))
    draw.shuffle(rows)
    return rows


@pytest.mark.parametrize("parts", [1, 13])
def test_equals_brute_force(spark, parts):
    rows = some(120, 1) + [(200, None, None, None), (200, None, "user", None), (200, 1, None, "x"), (200, 1, None, "x"), (200, 1, "", "w"), (201, 5, "a", "bc"), (202, 5, "ab", "c"),
                           (None, 1, "user", "nobody"), (203, 2, "user", ""), (204, 2, "user", None)]
    rows += [(300, t, "user", "long" if t % 9 else "other") for t in range(400)] + [(301, t, "user", "long" if t % 9 else "other") for t in range(390)]
    rows += [(1000 + i, t, "user", f"copy {t}") for i in range(40) for t in range(12)]
    table = spark.createDataFrame(rows, SCHEMA).withColumn("depth", F.lit("x")).withColumn("k1", F.lit(None).cast("int"))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        got = sorted(map(tuple, c.prefix_trie(table).collect()), key=str)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert got == brute(rows)


def test_blocks_of_ids_and_depths(spark, monkeypatch):
    monkeypatch.setattr(c, "STRETCH", 3)
    rows = [(i, t, "user", f"t{t}") for i in range(60) for t in range(10 + i % 2)]
    assert sorted(map(tuple, c.prefix_trie(spark.createDataFrame(rows, SCHEMA)).collect()), key=str) == brute(rows)


def test_empty_and_turnless(spark):
    assert c.prefix_trie(spark.createDataFrame([], SCHEMA)).collect() == []
    rows = [(k, 1, "user", "only") for k in range(1, 5)]  # no base, and fewer turns than are left out
    assert sorted(map(tuple, c.prefix_trie(spark.createDataFrame(rows, SCHEMA)).collect()), key=str) == brute(rows)


def test_prefix_names_do_not_depend_on_partitions(spark):
    table = spark.createDataFrame(some(40, 3), SCHEMA)
    seen = []
    for parts in (1, 3, 17):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        seen.append(sorted(map(tuple, c.turn_prefixes(table).collect())))
    spark.conf.set("spark.sql.shuffle.partitions", 4)
    assert seen[0] == seen[1] == seen[2]
