import random
from collections import defaultdict

from provlake.operators import cycles as C
from provlake.operators import reach as W


def brute(edges):
    """Components and one shortest cycle of each, by plain search."""
    out, back, ahead = {}, defaultdict(set), defaultdict(set)
    for crate, a, b in edges:
        ahead[crate, a].add(b)
        back[crate, b].add(a)

    def walk(side, crate, node):
        seen, todo = set(), [node]
        while todo:
            for x in side[crate, todo.pop()]:
                if x not in seen:
                    seen.add(x)
                    todo.append(x)
        return seen
    nodes = {(c, x) for c, a, b in edges for x in (a, b)}
    member = {}
    for c, x in nodes:
        both = walk(ahead, c, x) & walk(back, c, x)
        if x in both:
            member[c, x] = min(both)
    for c, root in {(c, m) for (c, _), m in member.items()}:
        level, parent = [root], {root: None}
        while True:
            last = sorted(x for x in level if root in ahead[c, x])
            if last:
                break
            new = {}
            for x in sorted(level):
                for y in ahead[c, x]:
                    if member.get((c, y)) == root and y not in parent:
                        new.setdefault(y, x)
            parent |= new
            level = list(new)
        path = [last[0]]
        while parent[path[-1]] is not None:
            path.append(parent[path[-1]])
        out[c, root] = path[::-1]
    return member, out


def graph(seed, n, m):
    draw = random.Random(seed)
    return {("c" + str(draw.randrange(2)), f"n{draw.randrange(n):02d}", f"n{draw.randrange(n):02d}") for _ in range(m)}


def compare(spark, edges):
    table = spark.createDataFrame(sorted(edges), "crate_id string, src string, dst string")
    member, paths = brute(edges)
    found = C.components(table)
    assert {(r["crate_id"], r["node"]): r["component"] for r in found.collect()} == member
    got = defaultdict(dict)
    for r in C.cycles(table, found).collect():
        got[r["crate_id"], r["component"]][r["pos"]] = r["node"]
    assert {k: [v[i] for i in range(len(v))] for k, v in got.items()} == paths


def test_random_graphs(spark):
    compare(spark, graph(1, 30, 55))


def test_rings_tails_and_loops(spark):
    ring = lambda name, n: {("r", f"{name}{i:02d}", f"{name}{(i + 1) % n:02d}") for i in range(n)}
    edges = ring("a", 2) | ring("b", 3) | ring("long", 9) | {("r", "self", "self"), ("r", "a00", "mid"), ("r", "mid", "b01"), ("r", "t1", "t2"), ("r", "t2", "a00"), ("r", "b02", "end")}
    compare(spark, edges)


def test_long_rings_take_few_rounds(spark):
    """A ring of 600 nodes with tails, one that it feeds and one that feeds it."""
    ring = lambda name, n: {("r", f"{name}{i:03d}", f"{name}{(i + 1) % n:03d}") for i in range(n)}
    edges = ring("up", 50) | ring("mid", 600) | ring("down", 70) | {("r", "up007", "mid100"), ("r", "mid200", "t1"), ("r", "t1", "t2"), ("r", "t2", "down009")}
    written = []
    save = C.save
    C.save = lambda df, path: (written.append(path), save(df, path))[1]
    try:
        compare(spark, edges)
    finally:
        C.save = save
    assert len(written) < 200


def test_nodes_with_one_predecessor_off_a_ring(spark):
    """Tails behind a ring and plain lines have one predecessor too, but are on no cycle."""
    line = {("r", f"a{i:02d}", f"a{i + 1:02d}") for i in range(40)} | {("r", "b1", "b2"), ("r", "b2", "b1"), ("r", "b2", "a00"), ("s", "x", "y")}
    table = spark.createDataFrame(sorted(line), "crate_id string, src string, dst string")
    assert {tuple(r) for r in C._rings(table).collect()} == {("r", "b1", "b1"), ("r", "b2", "b1")}


def test_graphs_without_cycles(spark):
    none = spark.createDataFrame([], "crate_id string, src string, dst string")
    assert C.components(none).collect() == [] and C.cycles(none).collect() == []
    line = spark.createDataFrame([("c", f"{i:02d}", f"{i + 1:02d}") for i in range(6)] + [("c", "00", "05")], "crate_id string, src string, dst string")
    assert C.cyclic_core(line).collect() == [] and C.cycles(line).collect() == []


def test_trimming_equals_peeling(spark):
    table = spark.createDataFrame(sorted(graph(5, 40, 50)), "crate_id string, src string, dst string")
    edges = {tuple(r) for r in table.collect()}
    while True:
        heads, tails = {(c, a) for c, a, _ in edges}, {(c, b) for c, _, b in edges}
        rest = {(c, a, b) for c, a, b in edges if (c, b) in heads and (c, a) in tails}
        if rest == edges:
            break
        edges = rest
    assert {tuple(r) for r in W.acyclic_core(table).collect()} == edges


def test_a_walk_reads_the_buckets_of_its_frontier(spark):
    edges = spark.range(2000).selectExpr("'c' as crate_id", "'n' || id as src", "'n' || (id + 1000) as dst")
    start = spark.createDataFrame([("c", "n7")], "crate_id string, node string")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", 16)
    try:
        got = W.reach(start, edges, ["crate_id"])
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert {(r["node"], r["depth"]) for r in got.collect()} == {("n7", 0), ("n1007", 1), ("n2007", 2)}
    home = got.inputFiles()[0].split("/seen/")[0]
    steps = W.Buckets(spark, f"{home}/steps", ["crate_id", "node"], 16)
    steps.schema, steps.held = "crate_id string, node string, dst string", {0: range(16)}
    assert all("/bucket=3/" in f or "/bucket=5/" in f for f in steps.at([3, 5]).inputFiles())
    assert {r["bucket"] for r in steps.at([3, 5]).collect()} == {3, 5} and steps.at([]).count() == 0
