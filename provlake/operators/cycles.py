"""Cycles of a graph: what is left when ends are trimmed, strongly connected components, one cycle of each.

Trimming counts degrees down: a node that lost all edges of one direction is dead, and only the
edges of newly dead nodes are looked up, by bucket, so every edge is read once from each end.
Rings, whose nodes all have one predecessor or all have one successor, are found first: every
node's pointer to it is doubled, so a ring of any length takes as many rounds as its length has
binary digits. Without rings components come from colours: every node takes the smallest node that reaches it, and what a
colour's own node is reached from inside its colour is a component. Components are taken out,
the rest is trimmed again, until nothing is left. One shortest cycle through the smallest node
of each component is found by levels and read back along smallest parents; a component that is
nothing but one cycle is put in order by doubling too.

Loops end on empty rounds; the driver sees bucket numbers and emptiness.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from provlake.operators.buckets import Buckets, bucket_count, numbers
from provlake.operators.reach import reach
from provlake.session import save, workspace

_KEY = ["crate_id", "node"]


def _parts(written: DataFrame) -> int:
    """Buckets for a table whose rows can be counted without work."""
    return bucket_count(written.count(), int(written.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def cyclic_core(edges: DataFrame) -> DataFrame:
    """(crate_id, src, dst) edges left after peeling nodes with nothing behind or ahead of them."""
    spark = edges.sparkSession
    home = workspace(spark, "trim")
    plain = save(edges.select("crate_id", "src", "dst").distinct(), f"{home}/edges")
    n = _parts(plain)
    table = lambda name, keys: Buckets(spark, f"{home}/{name}", keys, n)
    ahead, behind, lost, dead = table("ahead", _KEY), table("behind", _KEY), table("lost", _KEY), table("dead", _KEY)
    ahead.add(plain.select("crate_id", F.col("src").alias("node"), F.col("dst").alias("other")))
    behind.add(plain.select("crate_id", F.col("dst").alias("node"), F.col("src").alias("other")))
    ends = plain.select("crate_id", F.col("src").alias("node"), F.lit(0).alias("n_in"), F.lit(1).alias("n_out")).unionByName(
        plain.select("crate_id", F.col("dst").alias("node"), F.lit(1).alias("n_in"), F.lit(0).alias("n_out")))
    degrees = table("degrees", _KEY)
    newly = dead.add(degrees.add(ends.groupBy(*_KEY).agg(F.sum("n_in").alias("n_in"), F.sum("n_out").alias("n_out"))).where("n_in = 0 or n_out = 0").select(*_KEY))
    turn = 0
    while wanted := numbers(newly):
        turn += 1
        gone = newly.select(*_KEY)
        step = lambda side, i, o: side.at(wanted).join(gone, _KEY).select("crate_id", F.col("other").alias("node"), F.lit(i).alias("n_in"), F.lit(o).alias("n_out"))
        fell = step(ahead, 1, 0).unionByName(step(behind, 0, 1)).groupBy(*_KEY).agg(F.sum("n_in").alias("n_in"), F.sum("n_out").alias("n_out"))
        now = lost.add(fell, turn, dealt=True)
        if not (touched := numbers(now)):
            break
        total = lost.at(touched).join(now.select(*_KEY), _KEY, "left_semi").groupBy(*_KEY).agg(F.sum("n_in").alias("less_in"), F.sum("n_out").alias("less_out"))
        freed = degrees.at(touched).join(total, _KEY).where("n_in = less_in or n_out = less_out")
        newly = dead.add(freed.select(*_KEY).join(dead.at(touched).select(*_KEY), _KEY, "left_anti"), turn, dealt=True)
    for held in (ahead, behind, lost, dead, degrees):
        held.close()
    all_dead = dead.all().select(*_KEY)
    for end in ("src", "dst"):
        plain = plain.join(all_dead.withColumnRenamed("node", end), ["crate_id", end], "left_anti")
    return save(plain, f"{home}/core")


def _colours(edges: DataFrame) -> DataFrame:
    """(crate_id, node, colour): the smallest node that reaches each node, itself included."""
    spark = edges.sparkSession
    labels = Buckets(spark, workspace(spark, "colours"), _KEY, _parts(edges))
    nodes = edges.select("crate_id", F.col("src").alias("node")).union(edges.select("crate_id", "dst")).distinct()
    changed, turn = labels.add(nodes.withColumn("colour", F.col("node"))), 0
    steps = edges.select("crate_id", F.col("src").alias("node"), "dst")
    while numbers(changed):
        turn += 1
        offered = changed.join(steps, _KEY).groupBy("crate_id", F.col("dst").alias("node")).agg(F.min("colour").alias("offer"))
        held = labels.all().groupBy(*_KEY).agg(F.min("colour").alias("colour"))
        changed = labels.add(offered.join(held, _KEY).where("offer < colour").select(*_KEY, F.col("offer").alias("colour")), turn, dealt=True)
    labels.close()
    return labels.all().groupBy(*_KEY).agg(F.min("colour").alias("colour"))


def _rings(edges: DataFrame) -> DataFrame:
    """(crate_id, node, component) of the cycles whose nodes have one predecessor each.

    Nobody outside reaches such a cycle, so it is a whole component. After as many steps back as
    there are nodes with one predecessor, only nodes of rings are arrived at.
    """
    home = workspace(edges.sparkSession, "rings")
    one = edges.groupBy("crate_id", F.col("dst").alias("node")).agg(F.count("*").alias("n"), F.min("src").alias("at")).where("n = 1")
    state = save(one.select(*_KEY, "at", F.least("node", "at").alias("low")), f"{home}/turn-0")
    left, steps, turn = state.count(), 1, 0
    while left:
        # who is not led to a ring in this turn had more than ``steps`` nodes before it in the last one
        last = left <= steps
        turn, steps = turn + 1, 2 * steps
        ahead = state.select("crate_id", F.col("node").alias("at"), F.col("at").alias("far"), F.col("low").alias("far_low"))
        state = save(state.join(ahead, ["crate_id", "at"]).select(*_KEY, F.col("far").alias("at"), F.least("low", "far_low").alias("low")), f"{home}/turn-{turn}")
        if last:
            break
        left = state.count()
    on = state.select("crate_id", F.col("at").alias("node")).distinct()
    return state.join(on, _KEY, "left_semi").select(*_KEY, F.col("low").alias("component"))


def _turned(edges: DataFrame) -> DataFrame:
    return edges.select("crate_id", F.col("dst").alias("src"), F.col("src").alias("dst"))


def _coloured(rest: DataFrame, home: str, turn: int) -> DataFrame:
    """(crate_id, node, component) of one component of each colour."""
    colours = save(_colours(rest), f"{home}/colours-{turn}")
    of = lambda end: colours.select("crate_id", F.col("node").alias(end), F.col("colour").alias(f"{end}_colour"))
    inside = save(rest.join(of("src"), ["crate_id", "src"]).join(of("dst"), ["crate_id", "dst"]).where("src_colour = dst_colour").select(
        "crate_id", "src", "dst"), f"{home}/inside-{turn}")
    roots = colours.where("node = colour").select("crate_id", F.col("node"))
    reached = reach(roots, _turned(inside), ["crate_id"], buckets=_parts(inside)).select(*_KEY)
    return reached.join(colours, _KEY).withColumnRenamed("colour", "component")


def components(edges: DataFrame) -> DataFrame:
    """(crate_id, node, component) of the nodes on cycles; a component is named by its smallest node."""
    spark = edges.sparkSession
    home = workspace(spark, "components")
    rest, turn, found = cyclic_core(edges), 0, []
    while not rest.isEmpty():
        one = save(_rings(rest).unionByName(_rings(_turned(rest))).distinct(), f"{home}/found/turn={turn}")
        if one.isEmpty():
            one = save(_coloured(rest, home, turn), f"{home}/found/turn={turn}")
        found.append(one)
        for end in ("src", "dst"):
            rest = rest.join(one.select("crate_id", F.col("node").alias(end)), ["crate_id", end], "left_anti")
        rest, turn = cyclic_core(rest), turn + 1
    if not found:
        return edges.select("crate_id", F.col("src").alias("node"), F.col("src").alias("component")).limit(0)
    every = spark.read.schema(found[0].schema).parquet(f"{home}/found")
    # a node between two cycles is a component of its own, but on no cycle
    loops = edges.where("src = dst").select("crate_id", F.col("src").alias("component")).distinct()
    large = every.groupBy("crate_id", "component").agg(F.count("*").alias("n")).where("n > 1").select("crate_id", "component")
    return every.join(large.union(loops).distinct(), ["crate_id", "component"], "left_semi").select("crate_id", "node", "component")


def cycles(edges: DataFrame, members: DataFrame | None = None) -> DataFrame:
    """(crate_id, component, pos, node): one shortest cycle through the smallest node of each component, from that node on.

    Of several, parents and the last node are the smallest at each level.
    """
    spark = edges.sparkSession
    home = workspace(spark, "cycles")
    members = components(edges) if members is None else members
    of = lambda end: members.select("crate_id", "component", F.col("node").alias(end))
    steps = save(edges.select("crate_id", "src", "dst").distinct().join(of("src"), ["crate_id", "src"]).join(of("dst"), ["crate_id", "component", "dst"]), f"{home}/steps")
    key = ["crate_id", "component"]
    # a component with as many edges as nodes is nothing but one cycle
    size = members.groupBy(*key).agg(F.count("*").alias("n"))
    single = save(steps.groupBy(*key).agg(F.count("*").alias("n_edges")).join(size, key).select(*key, (F.col("n") == F.col("n_edges")).alias("ring")), f"{home}/kinds")
    alone = _in_order(steps.join(single.where("ring"), key, "left_semi"), home)
    level = save(single.where("not ring").select(*key, F.col("component").alias("node"), F.lit(None).cast("string").alias("parent")), f"{home}/levels/pos=0")
    closed, depth = [], 0
    while not level.isEmpty():
        near = save(level.select(*key, F.col("node").alias("src")).join(steps, [*key, "src"]).groupBy(*key, "dst").agg(F.min("src").alias("parent")), f"{home}/near-{depth}")
        closed.append(save(near.where("dst = component").select(*key, F.col("parent").alias("node"), F.lit(depth).alias("pos")), f"{home}/closed-{depth}"))
        seen = spark.read.schema(level.schema).parquet(f"{home}/levels").select(*key, "node")
        open_ = near.join(closed[-1], key, "left_anti").select(*key, F.col("dst").alias("node"), "parent")
        depth += 1
        level = save(open_.join(seen, [*key, "node"], "left_anti"), f"{home}/levels/pos={depth}")
    levels = spark.read.schema(f"{level.schema.simpleString()[7:-1].replace(':', ' ')}, pos int").parquet(f"{home}/levels")
    # back from the last node of each cycle, level by level, longest cycles first
    at = None
    for pos in range(depth - 1, -1, -1):
        here = closed[pos] if at is None else closed[pos].unionByName(at.where("pos > 0").select(*key, F.col("parent").alias("node"), F.lit(pos).alias("pos")))
        at = save(here.join(levels.where(F.col("pos") == pos).select(*key, "node", "parent"), [*key, "node"]), f"{home}/path/turn={pos}")
    if at is None:
        return alone
    return alone.unionByName(spark.read.schema(at.schema).parquet(f"{home}/path").select(*key, "pos", "node"))


def _in_order(steps: DataFrame, home: str) -> DataFrame:
    """(crate_id, component, pos, node) of components that are one cycle: how far behind the smallest node each is."""
    key = ["crate_id", "component"]
    at_start = F.col("dst") == F.col("component")
    state = save(steps.select(*key, F.col("dst").alias("node"), F.when(at_start, F.col("dst")).otherwise(F.col("src")).alias("at"),
                              F.when(at_start, 0).otherwise(1).alias("pos")), f"{home}/order-0")
    turn = 0
    while not state.where("at <> component").isEmpty():
        turn += 1
        back = state.select(*key, F.col("node").alias("at"), F.col("at").alias("far"), F.col("pos").alias("more"))
        state = save(state.join(back, [*key, "at"]).select(*key, "node", F.col("far").alias("at"), (F.col("pos") + F.col("more")).alias("pos")), f"{home}/order-{turn}")
    return state.select(*key, "pos", "node")
